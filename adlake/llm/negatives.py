"""Hard negatives of anchors by exact search with length buckets and coordinate lists.

Components are taken as whole numbers, floor(SCALE * x), so scores are exact inner products. Rows are dealt into buckets of
like lengths and into blocks of at most about ``BLOCK_ROWS`` of them; a frequent vector or label fills as many blocks as it needs. An
anchor visits each block whose lengths allow a score it still needs. There, rows stand by falling length in chunks, each
with a sorted list of every coordinate. A threshold t on the score means, for the unit vectors of anchor and row, an angle of at most
acos(t / (|anchor| * greatest length)), so for each focus coordinate, those in which the anchor is largest, only a range of its list
can hold partners. The ranges' rows are intersected, and what is left is scored exactly. The threshold of a search rises
as its best rows are found: the fifth best score of the anchor's own label for positives, for negatives the least
of what its positives still ask for.

Cases: rows with a null id, label or vector, or with any null or non-finite component, take no part; empty vectors and
zeros score 0. A shorter vector counts as filled up with zeros. Rows that repeat an id each take part, but none is a partner of its own
id; anchors that repeat whole are one. Equal scores go by the smaller id. Components and scores must fit 64 bits, else the query fails.
Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from adlake.llm.shared import written

SCALE = 256
BLOCK_ROWS, CHUNK_ROWS = 32_768, 4_096
#: Lengths of a bucket differ by this factor at most, so there are never more than about 700 buckets.
BUCKET_WIDTH = 1.1
FOCUS = 4
N_POSITIVES, N_NEGATIVES = 5, 5
#: A negative scores from LOW to HIGH percent of its positive.
LOW, HIGH = 80, 100
_SLACK = 1e-9
_POSITIVES = pa.schema({"anchor_id": pa.int64(), "anchor": pa.int64(), "id": pa.int64(), "score": pa.int64()})
_NEGATIVES = pa.schema({"anchor_id": pa.int64(), "anchor": pa.int64(), "place": pa.int32(), "id": pa.int64(), "score": pa.int64()})


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'int' if f.type == pa.int32() else 'bigint'}" for f in schema)


def whole_vectors(rows: DataFrame, label: Column, anchors: Column) -> DataFrame:
    """(id, label, v, size, is_anchor) of the rows that take part."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE))
    too_large = F.exists("embedding", lambda x: F.abs(x.cast("double") * SCALE) >= float(1 << 62))
    vector = F.when(too_large, F.raise_error(F.lit("a component doesn't fit 64 bits"))).otherwise(whole)
    taken = rows.select(F.col("vec_id").cast("long").alias("id"), label.alias("label"), "embedding", anchors.alias("is_anchor"))
    taken = taken.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    size = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    taken = taken.select("id", F.xxhash64("label").alias("label"), vector.cast("array<bigint>").alias("v"), F.coalesce("is_anchor", F.lit(False)).alias("is_anchor"))
    return taken.withColumn("size", size)


class Block:
    """Rows by falling length, in chunks with sorted coordinate lists."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        size = np.sqrt((vectors.astype(np.float64) ** 2).sum(1))
        order = np.lexsort((ids, -size))
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        self.size = size[order]
        self.unit = self.vectors / np.where(self.size > 0, self.size, 1)[:, None]
        self.largest = float(np.abs(self.vectors.astype(np.float64)).max(initial=0))
        self.chunks = [slice(k, min(k + CHUNK_ROWS, len(ids))) for k in range(0, len(ids), CHUNK_ROWS)]
        self.lists: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        self.as_float = self.vectors.astype(np.float64)

    def list_of(self, chunk: int, coordinate: int) -> tuple[np.ndarray, np.ndarray]:
        """(values in order, rows) of a coordinate, sorted when it is first asked for."""
        key = (chunk, coordinate)
        if key not in self.lists:
            values = self.unit[self.chunks[chunk], coordinate]
            order = np.argsort(values, kind="stable")
            self.lists[key] = values[order], order + self.chunks[chunk].start
        return self.lists[key]

    def scores(self, rows: np.ndarray | slice, anchor: np.ndarray) -> np.ndarray:
        d = min(len(anchor), self.vectors.shape[1])
        if self.largest * float(np.abs(anchor.astype(np.float64)).max(initial=0)) * max(d, 1) < 2**53:
            return (self.as_float[rows, :d] @ anchor[:d].astype(np.float64)).astype(np.int64)
        exact = self.vectors[rows, :d].astype(object) @ anchor[:d].astype(object)
        return np.array(exact, object).astype(np.int64)

    def candidates(self, chunk: int, anchor: np.ndarray, size: float, threshold: int | None) -> np.ndarray:
        """Rows of a chunk whose score may reach the threshold."""
        every = self.chunks[chunk]
        if threshold is None or threshold <= 0 or not len(anchor):
            return np.arange(every.start, every.stop)
        longest = self.size[every.start]
        cosine = threshold / (size * longest) if size * longest > 0 else 2.0
        if cosine > 1 + _SLACK:
            return np.zeros(0, np.int64)
        unit, reach = anchor / size, math.acos(min(cosine, 1.0)) + 1e-6
        d = min(len(anchor), self.vectors.shape[1])
        focus = np.argsort(-np.abs(unit[:d]), kind="stable")[:FOCUS]
        ranges = []
        for f in focus:
            angle = math.acos(max(-1.0, min(1.0, float(unit[f]))))
            low, high = math.cos(min(math.pi, angle + reach)) - _SLACK, math.cos(max(0.0, angle - reach)) + _SLACK
            values, rows = self.list_of(chunk, int(f))
            a, b = np.searchsorted(values, low), np.searchsorted(values, high, "right")
            ranges.append((b - a, rows[a:b], int(f), low, high))
        ranges.sort(key=lambda r: r[0])
        rows = ranges[0][1]
        for _, _, f, low, high in ranges[1:]:
            x = self.unit[rows, f]
            rows = rows[(x >= low) & (x <= high)]
        return rows


def _first(ids: np.ndarray, scores: np.ndarray, n: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:n]


def positives_in(block: Block, id_: int, label: int, anchor: np.ndarray, n: int = N_POSITIVES) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the block's best rows of the anchor's label."""
    size = float(np.sqrt((anchor.astype(np.float64) ** 2).sum()))
    ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for chunk in range(len(block.chunks)):
        rows = block.candidates(chunk, anchor, size, int(scores[-1]) if len(scores) == n else None)
        rows = rows[(block.labels[rows] == label) & (block.ids[rows] != id_)]
        ids, scores = np.concatenate([ids, block.ids[rows]]), np.concatenate([scores, block.scores(rows, anchor)])
        best = _first(ids, scores, n)
        ids, scores = ids[best], scores[best]
    return ids, scores


def negatives_in(
    block: Block, id_: int, label: int, anchor: np.ndarray, wanted: list[int], n: int = N_NEGATIVES
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(place of the positive, ids, scores) of the block's best rows of other labels for the score of each positive."""
    size = float(np.sqrt((anchor.astype(np.float64) ** 2).sum()))
    found = {k: (np.zeros(0, np.int64), np.zeros(0, np.int64)) for k, s in enumerate(wanted) if s >= 0}
    if not found:
        return
    least = {k: -(-LOW * wanted[k] // 100) for k in found}
    for chunk in range(len(block.chunks)):
        rows = block.candidates(chunk, anchor, size, min(max(least[k], int(found[k][1][-1]) if len(found[k][1]) == n else least[k]) for k in found))
        rows = rows[(block.labels[rows] != label) & (block.ids[rows] != id_)]
        score, ids = block.scores(rows, anchor), block.ids[rows]
        for k, (old, at) in found.items():
            inside = (score >= least[k]) & (score <= HIGH * wanted[k] // 100)
            if inside.any():
                all_ids, all_scores = np.concatenate([old, ids[inside]]), np.concatenate([at, score[inside]])
                best = _first(all_ids, all_scores, n)
                found[k] = all_ids[best], all_scores[best]
    for k, (ids, scores) in found.items():
        yield k, ids, scores


def _matrix(vectors: list) -> np.ndarray:
    width = max(map(len, vectors), default=0)
    if all(len(v) == width for v in vectors):
        return np.array(vectors, np.int64).reshape(len(vectors), width)
    out = np.zeros((len(vectors), width), np.int64)
    for k, v in enumerate(vectors):
        out[k, : len(v)] = v
    return out


def _visits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Block, Iterator[tuple]]]:
    """Each block with the anchors that visit it; rows come by block, those of the block itself before its anchors."""

    def rows():
        for batch in batches:
            flat = [batch.column(k).to_pylist() for k in (0, 1, 2, 3, 4, 6)]
            ends, values = batch.column(5).offsets.to_numpy(), batch.column(5).values.to_numpy(zero_copy_only=False)
            for k, r in enumerate(zip(*flat, strict=True)):
                yield (*r, values[ends[k] : ends[k + 1]])

    for _, own in groupby(rows(), key=lambda r: r[0]):
        block, held = None, []
        for visit, same in groupby(own, key=lambda r: r[1]):
            if visit:
                yield block or Block(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 0), np.int64)), same
            else:
                held = list(same)
                block = Block(np.array([r[2] for r in held], np.int64), np.array([r[3] for r in held], np.int64), _matrix([r[6] for r in held]))


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 20_000) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    for row in rows:
        out.append(row)
        if len(out) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
            out.clear()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


def _find_positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def found():
        for block, visits in _visits(batches):
            for _, _, id_, label, anchor, _, v in visits:
                for i, s in zip(*(x.tolist() for x in positives_in(block, id_, label, v)), strict=True):
                    yield id_, anchor, i, s

    yield from _batches(found(), _POSITIVES)


def _find_negatives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def found():
        for block, visits in _visits(batches):
            for _, _, id_, label, anchor, wanted, v in visits:
                for k, ids, scores in negatives_in(block, id_, label, v, wanted):
                    for i, s in zip(ids.tolist(), scores.tolist(), strict=True):
                        yield id_, anchor, k, i, s

    yield from _batches(found(), _NEGATIVES)


class _Dealt:
    """Rows in blocks of like lengths; ``buckets`` is (bucket, first block, blocks, greatest length) of each."""

    def __init__(self, rows: DataFrame, block_rows: int):
        bucket = F.when(F.col("size") > 0, F.floor(F.log("size") / math.log(BUCKET_WIDTH)).cast("int")).otherwise(-1)
        rows = rows.withColumn("bucket", bucket)
        self.buckets, first = [], 0
        for r in rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("longest")).orderBy("bucket").collect():
            n = -(-r["n"] // block_rows)
            self.buckets.append((r["bucket"], first, n, r["longest"]))
            first += n
        self.n_blocks = first
        starts = rows.sparkSession.createDataFrame([b[:3] for b in self.buckets], "bucket int, first int, n int")
        self.rows = rows.join(F.broadcast(starts), "bucket").withColumn("block", (F.col("first") + F.pmod(F.xxhash64("id"), "n")).cast("int"))

    def visited(self, anchors: DataFrame, least: Column) -> DataFrame:
        """(block, visit, id, label, anchor, v, wanted): the rows of all blocks, and the anchors at each that may hold a
        score of ``least``."""
        buckets = F.array(*(F.struct(F.lit(first).alias("first"), F.lit(first + n - 1).alias("last"), F.lit(longest).alias("longest")) for _, first, n, longest in self.buckets))
        needed = F.filter(buckets, lambda b: (least <= 0) | (b["longest"] * F.col("size") * (1 + _SLACK) >= least))
        there = F.flatten(F.transform(needed, lambda b: F.sequence(b["first"], b["last"])))
        shown = anchors.withColumn("block", F.explode(there)).select("block", F.lit(1).alias("visit"), "id", "label", "anchor", "v", "wanted")
        own = self.rows.select("block", F.lit(0).alias("visit"), "id", "label", F.lit(None).cast("long").alias("anchor"), "v", F.lit(None).cast("array<bigint>").alias("wanted"))
        return own.unionByName(shown).repartition(max(self.n_blocks, 1), "block").sortWithinPartitions("block", "visit")


def hard_negatives(rows: DataFrame, anchors: Column, label: Column | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score); ``anchors`` says which rows of (vec_id,
    label, embedding) are anchors."""
    taken = whole_vectors(rows, F.col("label") if label is None else label, anchors)
    dealt = _Dealt(taken, block_rows)
    if not dealt.n_blocks:
        return rows.sparkSession.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    asked = taken.where("is_anchor").select("id", "label", "v", "size", F.xxhash64("label", "v").alias("anchor")).dropDuplicates(["id", "anchor"])
    first = lambda key, n: F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("score"), "id")) <= n
    none = asked.withColumn("wanted", F.lit(None).cast("array<bigint>"))
    near = dealt.visited(none, F.lit(0)).mapInArrow(_find_positives, _ddl(_POSITIVES))
    key = ["anchor_id", "anchor"]
    near = near.withColumn("stays", first(key, N_POSITIVES)).where("stays").groupBy(*key)
    near = written(near.agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "id"))).alias("best")), "positives")
    asked = asked.join(near.withColumnRenamed("anchor_id", "id"), ["id", "anchor"])
    asked = asked.withColumn("wanted", F.transform("best", lambda x: -x["minus"]))
    least = F.array_min(F.filter("wanted", lambda s: s >= 0)).cast("double") * (LOW / 100 * (1 - _SLACK))
    shown = asked.where(F.exists("wanted", lambda s: s >= 0))
    far = dealt.visited(shown, least).mapInArrow(_find_negatives, _ddl(_NEGATIVES))
    order = Window.partitionBy("anchor_id", "anchor", "place").orderBy(F.desc("score"), "id")
    far = far.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= N_NEGATIVES)
    far = far.join(near, key).withColumn("positive", F.get("best", F.col("place")))
    return far.select(
        "anchor_id",
        F.col("positive.id").alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        (-F.col("positive.minus")).alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
