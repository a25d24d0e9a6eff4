"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the distinct hashes of its words, pairs of neighbours and pairs with one word between them.
Training keeps a rate for each coordinate and an L1 term, so that only features that recur with the same label get a
weight; the few that do are broadcast. Weights: at most ``2 ** BITS``, whatever the corpus.

Cases: a null or empty text has no features and gets the score of the bias alone; without training rows every score is
0.5. Labels that are null, or have a null doc_id, teach nothing; of a doc_id with several labels the greatest counts.
Rows with the same doc_id are scored one by one. Only ``text`` enters a score; the caller's other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from adlake.llm.words import LETTERS, LOWER, Texts, distinct, grams, hashes, mix, pieces, texts, words

BITS = 20
#: The classifier is fitted on a sample by doc_id hash of about this many labelled rows at most.
MAX_ROWS = 30_000
EPOCHS = 4
#: Bytes of text whose features a worker holds at a time.
FEATURE_BYTES = 512 << 10
ALPHA, BETA, L1, L2 = 3.0, 1.0, 4.0, 0.0


def _slots(h: np.ndarray, kind: int) -> np.ndarray:
    return (mix(h + np.uint64(kind)) >> np.uint64(64 - BITS)).astype(np.int64)


def features(piece: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(text, slot) of all features, repeated ones included."""
    data = LOWER[piece.data]
    found = words(Texts(data, piece.offsets), LETTERS)
    h, text, last = hashes(data, found.start, found.end), found.text_of(), found.last()
    at = np.arange(len(h))
    pairs, skips = grams(h, 2), mix(h[:-2] * np.uint64(3) + h[2:])
    two, gap = np.flatnonzero(at[: len(pairs)] + 2 <= last[: len(pairs)]), np.flatnonzero(at[: len(skips)] + 3 <= last[: len(skips)])
    return np.concatenate([text, text[two], text[gap]]), np.concatenate([_slots(h, 1), _slots(pairs[two], 2), _slots(skips[gap], 3)])


def feature_slots(column: pa.Array) -> pa.Array:
    """Distinct slots of each text."""
    sizes, slots = np.zeros(len(column) + 1, np.int64), [np.zeros(0, np.int32)]
    for row, piece in pieces(texts(column), FEATURE_BYTES):
        text, slot = features(piece)
        both = distinct(text << BITS | slot)
        n = len(piece.offsets) - 1
        sizes[row + 1 : row + 1 + n] = np.bincount(both >> BITS, minlength=n)
        slots.append((both & ((1 << BITS) - 1)).astype(np.int32))
    return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes).astype(np.int32)), pa.array(np.concatenate(slots)))


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """FTRL-proximal over the rows in the order they come in; the last weight is the bias."""
    rows = []
    for batch in batches:
        slots = batch.column("slots")
        ends = slots.offsets.to_numpy()
        flat = slots.values.to_numpy()
        rows += [(flat[a:b], y) for a, b, y in zip(ends[:-1], ends[1:], batch.column("label").to_pylist(), strict=True)]
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    for _ in range(EPOCHS):
        for slots, label in rows:
            at = np.append(slots, 1 << BITS)
            za, na = z[at], n[at]
            strict = np.full(len(at), L1)
            strict[-1] = 0
            w = np.where(np.abs(za) <= strict, 0.0, (np.sign(za) * strict - za) / ((BETA + np.sqrt(na)) / ALPHA + L2))
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            z[at] = za + g - (np.sqrt(na + g * g) - np.sqrt(na)) / ALPHA * w
            n[at] = na + g * g
    strict = np.full(len(z), L1)
    strict[-1] = 0
    w = np.where(np.abs(z) <= strict, 0.0, (np.sign(z) * strict - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))
    some = np.flatnonzero(w)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(w[some].astype(np.float64))], ["slot", "weight"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = MAX_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """(slots, weights) learned from the texts of ``docs`` that ``labels`` marks."""
    marked = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).cast("double").alias("label"))
    total = marked.count()
    if total > max_rows:
        share = 1 << 30
        marked = marked.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(share)) < int(share * max_rows / total))
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(marked), "doc_id")
        # Of rows that repeat an id one is learned from, so the bound on labels is one on rows.
        .groupBy("doc_id")
        .agg(F.first("label").alias("label"), F.min_by("text", F.xxhash64("text")).alias("text"))
        .select(F.xxhash64("doc_id", "text").alias("turn"), "label", F.arrow_udf(feature_slots, "array<int>")("text").alias("slots"))
        .repartition(1)
        .sortWithinPartitions("turn", "label")
        .select("label", "slots")
    )
    learned = rows.mapInArrow(_fit, "slot int, weight double").toPandas()
    return learned["slot"].to_numpy(np.int64), learned["weight"].to_numpy(np.float64)


def scorer(spark, model: tuple[np.ndarray, np.ndarray]) -> Column:
    """The probability of the label for column ``text``."""
    sent = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def probability(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        dense = np.zeros((1 << BITS) + 1)
        dense[sent.value[0]] = sent.value[1]
        for column in batches:
            out = np.full(len(column), dense[-1])
            for row, piece in pieces(texts(column), FEATURE_BYTES):
                text, slot = features(piece)
                some = np.flatnonzero(dense[slot])
                both = distinct(text[some] << BITS | slot[some])
                n = len(piece.offsets) - 1
                out[row : row + n] += np.bincount(both >> BITS, dense[both & ((1 << BITS) - 1)], n)
            yield pa.array(1 / (1 + np.exp(-np.clip(out, -35, 35))))

    return probability(F.col("text"))
