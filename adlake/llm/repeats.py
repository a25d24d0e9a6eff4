"""Removal of repeated passages by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words. Its minimiser is the least hash among its runs of ``GRAM`` words, so equal
windows have equal minimisers, and consecutive windows with the same one travel together as one packed string. Slim
rows tell first which minimisers more than one document has; only their strings are packed. Equal strings are combined
before and after the shuffle into one with its smallest document, and each bucket sorts the windows of its distinct
strings and takes the smallest document of each exactly. A string has at most ``RUN`` windows, a longer run is several,
each with WINDOW - 1 words of the next. A bucket of more than ``HOT_STRINGS`` distinct strings, or whose windows would take
more than ``HOT_BYTES``, is not gathered: its windows are grouped by SHA-256 over all tasks instead. The words covered by a window that starts in a
document with a smaller id go. Every step reads written tables, so a lost executor costs the step at hand.

Cases: null or empty texts, and those of fewer words than a window, keep all words. A null doc_id is smaller than none
and keeps all words. Rows that repeat a doc_id don't remove each other's words. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from adlake.llm.shared import written
from adlake.llm.words import NOT_BLANK, Texts, Words, grams, hashes, lists, pieces, texts, words

WINDOW, GRAM = 50, 8
HOT_STRINGS = 4_000
#: A bucket's windows as Python strings in tuples, about WINDOW_BYTES each beside their text.
HOT_BYTES, WINDOW_BYTES = 64 << 20, 150
#: Windows of a string; runs are longer only where a text repeats itself.
RUN = 64
FIRSTS = "mini bigint, string bigint, low int, high int, first bigint"


def _least(g: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    have = 1
    while 2 * have <= width:
        g = np.minimum(g[:-have], g[have:])
        have *= 2
    return np.minimum(g[: len(g) - width + have], g[width - have :]) if have < width else g


def runs_of(piece: Texts, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first window, windows, minimiser) of the super-k-mers; windows are counted within their text."""
    found = words(piece, NOT_BLANK)
    h = hashes(piece.data, found.start, found.end)
    if len(h) < window:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    mini = _least(grams(h, gram), window - gram + 1).view(np.int64)
    whole = np.arange(len(mini)) + window <= found.last()[: len(mini)]
    new = whole.copy()
    new[1:] &= ~whole[:-1] | (mini[1:] != mini[:-1])
    start = np.flatnonzero(new)
    end = np.flatnonzero(whole & np.append(new[1:] | ~whole[1:], True)) + 1
    text = found.text_of()[start]
    return text, start - found.first[text], end - start, mini[start]


def _short(text: np.ndarray, start: np.ndarray, count: np.ndarray, mini: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The runs, those of more than ``RUN`` windows cut."""
    n = -(-count // RUN)
    of = np.repeat(np.arange(len(n)), n)
    skip = RUN * (np.arange(len(of)) - (np.cumsum(n) - n)[of])
    return text[of], start[of] + skip, np.minimum(count[of] - skip, RUN), mini[of]


def super_kmers(column: pa.Array) -> pa.Array:
    parts = [(row, _short(*runs_of(piece))) for row, piece in pieces(texts(column))]
    flat = lambda k: np.concatenate([np.zeros(0, np.int64), *(p[k] for _, p in parts)])
    rows = np.concatenate([np.zeros(0, np.int64), *(row + p[0] for row, p in parts)])
    values = pa.StructArray.from_arrays(
        [pa.array(flat(1).astype(np.int32)), pa.array(flat(2).astype(np.int32)), pa.array(flat(3))], ["start", "count", "mini"]
    )
    return lists(rows, values, len(column))


def _spaced(piece: Texts) -> tuple[Words, np.ndarray, np.ndarray]:
    """(words, bytes of the words with one space after each, where each word starts there)."""
    found = words(piece, NOT_BLANK)
    length = found.end - found.start + 1
    at = np.cumsum(length) - length
    out = np.full(int(length.sum()), 0x20, np.uint8)
    inside = NOT_BLANK[piece.data]
    slot = np.ones(len(out), bool)
    slot[at + length - 1] = False
    out[slot] = piece.data[inside]
    return found, out, at


def packed(column: pa.Array, runs: pa.Array) -> pa.Array:
    """The strings of the given runs of each text."""
    ends = runs.offsets.to_numpy()
    start, count = (runs.values.field(k).to_numpy() for k in ("start", "count"))
    strings = []
    for row, piece in pieces(texts(column)):
        found, out, at = _spaced(piece)
        for t in range(len(piece.offsets) - 1):
            base = found.first[t]
            for k in range(ends[row + t], ends[row + t + 1]):
                a, b = base + start[k], base + start[k] + count[k] + WINDOW - 2
                strings.append(out[at[a] : at[b] + found.end[b] - found.start[b]].tobytes())
    return pa.ListArray.from_arrays(pa.array(ends - ends[0], pa.int32()), pa.array(strings, pa.binary()).cast(pa.string()))


def _windows(string: str, count: int, window: int) -> list[str]:
    cuts = [-1, *(i for i, c in enumerate(string) if c == " "), len(string)]
    return [string[cuts[j] + 1 : cuts[j + window]] for j in range(count)]


def bucket_firsts(rows: list[tuple[int, str, int, int, int]], window: int = WINDOW) -> Iterator[tuple[int, int, int, int]]:
    """(string, first window, window after the last, smallest document) of a bucket's strings.

    A row is (string id, string, windows, smallest document, largest document); windows are left out if the string's
    own documents are one, and that has the window first.
    """
    if len(rows) == 1:
        string, _, count, low, high = rows[0]
        if low < high:
            yield string, 0, count, low
        return
    every = sorted((w, low, k, j) for k, (_, text, count, low, _) in enumerate(rows) for j, w in enumerate(_windows(text, count, window)))
    firsts = [[low] * count for _, _, count, low, _ in rows]
    for _, same in groupby(every, key=lambda x: x[0]):
        _, first, k, j = next(same)
        firsts[k][j] = first
        for _, _, k, j in same:
            firsts[k][j] = first
    for (string, _, _, low, high), first in zip(rows, firsts, strict=True):
        at = 0
        for value, run in groupby(first):
            n = len(list(run))
            if value < low or low < high:
                yield string, at, at + n, value
            at += n


def _sort_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by minimiser; one bucket is held at a time."""

    def rows():
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    out = []
    names = [f.split()[0] for f in FIRSTS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    for mini, bucket in groupby(rows(), key=lambda r: r[0]):
        out += [(mini, *x) for x in bucket_firsts([r[1:] for r in bucket])]
        if len(out) >= 20_000:
            yield batch()
            out = []
    if out:
        yield batch()


def _all_windows(strings: pa.Array, counts: pa.Array) -> pa.Array:
    """Digests of each string's windows."""
    from hashlib import sha256

    return pa.array(
        [[sha256(w.encode()).digest() for w in _windows(s, n, WINDOW)] for s, n in zip(strings.to_pylist(), counts.to_pylist(), strict=True)],
        pa.list_(pa.binary()),
    )


def _cut(column: pa.Array, low: pa.Array, high: pa.Array) -> pa.Array:
    """(words, words removed, the others joined by one space) of each text; ``low`` to ``high`` go."""
    ends = low.offsets.to_numpy()
    low, high = low.values.to_numpy(zero_copy_only=False), high.values.to_numpy(zero_copy_only=False)
    total, gone, kept = [], [], []
    for row, piece in pieces(texts(column)):
        found, out, at = _spaced(piece)
        at = np.append(at, len(out))
        for t in range(len(piece.offsets) - 1):
            base, n = found.first[t], found.first[t + 1] - found.first[t]
            a, b = ends[row + t], ends[row + t + 1]
            total.append(n)
            if a == b:
                gone.append(0)
                kept.append(out[at[base] : max(at[base + n] - 1, at[base])].tobytes())
                continue
            edge = np.zeros(n + 1, np.int64)
            np.add.at(edge, low[a:b], 1)
            np.add.at(edge, high[a:b], -1)
            covered = np.cumsum(edge[:-1]) > 0
            gone.append(int(covered.sum()))
            change = np.flatnonzero(np.diff(np.concatenate([[True], covered, [True]]).astype(np.int8)))
            parts = [out[at[base + i] : at[base + j] - 1].tobytes() for i, j in zip(change[::2], change[1::2], strict=True)]
            kept.append(b" ".join(parts))
    return pa.StructArray.from_arrays([pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], ["n_words", "n_removed", "kept"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row; ``kept`` is the words that stay, joined by one space."""
    source = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    found = written(
        source.where("doc_id is not null").select("doc_id", "h", F.explode(F.arrow_udf(super_kmers, "array<struct<start:int,count:int,mini:bigint>>")("text")).alias("r")).select("doc_id", "h", "r.*"),
        "runs",
    )
    shared = written(found.groupBy("mini").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("mini"), "minimisers")
    some = found.join(shared, "mini", "left_semi").groupBy("doc_id", "h").agg(F.collect_set(F.struct("start", "count", "mini")).alias("runs"))
    pack = F.arrow_udf(packed, "array<string>")("text", "runs")
    strings = source.join(some, ["doc_id", "h"]).select("doc_id", "h", F.explode(F.arrays_zip("runs", pack.alias("packed"))).alias("x"))
    strings = written(strings.select("doc_id", "h", "x.runs.*", "x.packed", F.xxhash64("x.packed").alias("string")), "strings")
    firsts = _firsts(strings)
    spans = (
        strings.select("doc_id", "h", "start", "mini", "string")
        .join(firsts, ["mini", "string"])
        .where("first < doc_id")
        .groupBy("doc_id", "h")
        .agg(F.collect_set(F.struct((F.col("start") + F.col("low")).alias("low"), (F.col("start") + F.col("high") + (WINDOW - 1)).alias("high"))).alias("spans"))
    )
    none = F.array().cast("array<int>")
    low, high = (F.coalesce(F.col(f"spans.{k}"), none) for k in ("low", "high"))
    cut = F.arrow_udf(_cut, "struct<n_words:bigint,n_removed:bigint,kept:string>")(F.col("text"), low, high)
    return source.join(spans, ["doc_id", "h"], "left").select("doc_id", cut.alias("cut")).select("doc_id", "cut.*")


def _firsts(strings: DataFrame) -> DataFrame:
    """For each distinct string the smallest documents of its windows, in runs."""
    once = written(strings.groupBy("mini", "string", "packed", "count").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")), "distinct")
    held = F.sum(F.col("count") * WINDOW_BYTES + F.octet_length("packed").cast("long") * F.least("count", F.lit(WINDOW)))
    sizes = once.groupBy("mini").agg(F.count(F.lit(1)).alias("strings"), held.alias("bytes"))
    hot = written(sizes.where((F.col("strings") > HOT_STRINGS) | (F.col("bytes") > HOT_BYTES)).select("mini"), "hot")
    rows = once.select("mini", "string", "packed", "count", "a", "b")
    cool = rows.join(hot, "mini", "left_anti").repartition("mini").sortWithinPartitions("mini")
    sorted_ = cool.mapInArrow(_sort_buckets, FIRSTS)
    digests = F.arrow_udf(_all_windows, "array<binary>")("packed", "count")
    windows = rows.join(hot, "mini", "left_semi").select("mini", "string", "a", "b", F.posexplode(digests).alias("low", "digest"))
    windows = written(windows, "windows")
    least = written(windows.groupBy("digest").agg(F.min("a").alias("first")), "least")
    spread = windows.join(least, "digest").where("first < a or a < b").select("mini", "string", "low", (F.col("low") + 1).alias("high"), "first")
    return written(sorted_.unionByName(spread.select("mini", "string", F.col("low").cast("int").alias("low"), F.col("high").cast("int").alias("high"), "first")), "firsts")
