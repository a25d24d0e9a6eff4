"""Periodic runs of words, found octave by octave of the period in overlapping tiles.

A run is a longest stretch of words with smallest period q, of ``EXPONENT`` periods and ``LEAST`` words at least. Octave k
holds the periods from 2**k up to 2**(k + 1). Its boundaries lie so densely in a document that the matches of any run,
the words equal to the one q later, hold one of them. A tile is a stretch of the document with some boundaries of one or
more octaves and the words around them, so tiles overlap and are solved apart from each other: at each boundary the
Z-function gives, for every period of the octave at once, how far the words go on matching to the right and to the left,
for one spacing of the boundaries at most. What reaches so far may go on at the next boundary. These fragments are shuffled
by document and period, where those that touch are stitched to whole runs.

A document of at most ``TILE`` words is one tile for all its octaves. A longer one is dealt out over the cluster: the low
octaves share tiles of about ``TILE`` words, each higher octave has wider tiles of its own.

Words are told apart by 64-bit hashes, and stretches of words by 64-bit hashes of those.

Cases: null and empty texts have no words and no runs. A null doc_id is an id like any other, and rows that repeat an id
are told apart by their texts. Other columns pass through untouched, but for
those named like the two that are added.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from adlake.llm.shared import FEW_ROWS, written
from adlake.llm.words import NOT_BLANK, hashes, mix, pieces, texts, words

EXPONENT, LEAST = 3, 24
TILE = 1 << 16
RUNS = "array<struct<start:int,length:int,period:int>>"
_TILES = pa.schema({"id": pa.int64(), "h": pa.int64(), "low": pa.int32(), "high": pa.int32(), "core": pa.int64(), "stop": pa.int64(), "begin": pa.int64(), "n": pa.int64(), "words": pa.binary()})
_FRAGMENTS = pa.schema({"id": pa.int64(), "h": pa.int64(), "period": pa.int32(), "low": pa.int32(), "high": pa.int32()})
_ODD = np.uint64(0xD6E8FEB86659FD93)


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int32(): "int", pa.int64(): "bigint", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def spacing(octave: int) -> int:
    """Between boundaries: no more than the matches of any run, which are max(LEAST - q, (EXPONENT - 1) * q) at least."""
    return max(2 << octave, 16)


def n_octaves(n: int) -> int:
    return max(n // EXPONENT, 0).bit_length()


def tiles_of(n: int, size: int = TILE) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(first octave, octave after the last, first boundary at or after, boundaries before, first word, word after the
    last) of the tiles of n words."""
    top = n_octaves(n)
    if n <= size:
        if top:
            yield 0, top, 0, n, 0, n
        return
    low = 0
    while low < top:
        high = low + 1
        while high < top and 8 * spacing(high) <= size:
            high += 1
        reach = spacing(high - 1)
        step = max(size, 8 * reach) // reach * reach
        for core in range(0, n, step):
            stop = min(core + step, n)
            yield low, high, core, stop, max(core - reach, 0), min(stop + reach + (2 << (high - 1)), n)
        low = high


class _Blocks:
    """Hashes of 1, 2, 4, ... consecutive words from each word on."""

    def __init__(self, h: np.ndarray):
        self.of = [h]

    def __getitem__(self, level: int) -> np.ndarray:
        while len(self.of) <= level:
            g, half = self.of[-1], 1 << (len(self.of) - 1)
            self.of.append(mix(g[: max(len(g) - half, 0)] * _ODD + g[half:]))
        return self.of[level]


def z_right(blocks: _Blocks, at: np.ndarray, period: np.ndarray, most: int) -> np.ndarray:
    """How many words from ``at`` on equal the word ``period`` later; less than 2 * ``most`` are looked at."""
    z = np.zeros(len(at), np.int64)
    for level in range(most.bit_length() - 1, -1, -1):
        g = blocks[level]
        here = at + z
        live = np.flatnonzero(here + period < len(g))
        live = live[g[here[live]] == g[here[live] + period[live]]]
        z[live] += 1 << level
    return z


def z_left(blocks: _Blocks, at: np.ndarray, period: np.ndarray, most: int) -> np.ndarray:
    """The same for the words before ``at``, from the last one back."""
    z = np.zeros(len(at), np.int64)
    for level in range(most.bit_length() - 1, -1, -1):
        g = blocks[level]
        here = at - z - (1 << level)
        live = np.flatnonzero((here >= 0) & (here + period < len(g)))
        live = live[g[here[live]] == g[here[live] + period[live]]]
        z[live] += 1 << level
    return z


def _stitched(group: np.ndarray, period: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """Fragments of one group and period that touch, as one."""
    order = np.lexsort((low, period, group))
    group, period, low, high = group[order], period[order], low[order], high[order]
    new = np.ones(len(low), bool)
    new[1:] = (group[1:] != group[:-1]) | (period[1:] != period[:-1]) | (low[1:] > high[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(low))[: len(first)] - 1
    return group[first], period[first], low[first], high[last]


def fragments(h: np.ndarray, parts: list[tuple[int, int, int, int, int, int, int]]) -> tuple[np.ndarray, ...]:
    """(part, period, first match, place after the last match) of tiles that stand one after the other in ``h``.

    A part is (first octave, octave after the last, first boundary at or after, boundaries before, first word of the
    tile in its document, words of the document, first word of the tile in ``h``); the places are those in the document.
    """
    blocks, out = _Blocks(h), []
    ends = [p[6] for p in parts[1:]] + [len(h)]
    for octave in range(max((p[1] for p in parts), default=0)):
        d, width = spacing(octave), 1 << octave
        of = [k for k, p in enumerate(parts) if p[0] <= octave < p[1]]
        own = [np.arange(-(-parts[k][2] // d) * d, min(parts[k][3], parts[k][5]), d) for k in of]
        part = np.repeat(np.array(of, np.int64), [len(x) for x in own])
        bound = np.concatenate([np.zeros(0, np.int64), *own])
        shift = np.array([p[6] - p[4] for p in parts], np.int64)
        ceiling = np.array([p[5] // EXPONENT for p in parts], np.int64)
        first, end = np.array([p[6] for p in parts], np.int64), np.array(ends, np.int64)
        step = max(1, (1 << 18) // width)
        for k in range(0, len(bound), step):
            p, at = part[k : k + step], bound[k : k + step] + shift[part[k : k + step]]
            period = np.arange(width, 2 * width)
            other = at[:, None] + period
            inside = (other < end[p][:, None]) & (period <= ceiling[p][:, None])
            row, column = np.nonzero(inside & (h[np.minimum(other, len(h) - 1)] == h[at][:, None]))
            p, at, q = p[row], at[row], period[column]
            right = np.minimum(np.minimum(z_right(blocks, at, q, d), d), end[p] - at - q)
            left = np.minimum(np.minimum(z_left(blocks, at, q, d), d), at - first[p])
            keep = np.flatnonzero((left == d) | (right == d) | (left + right >= np.maximum(LEAST - q, (EXPONENT - 1) * q)))
            p, at = p[keep], at[keep]
            out.append((p, q[keep], at - left[keep] - shift[p], at + right[keep] - shift[p]))
    return _stitched(*(np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*out, strict=True) if out else [[]] * 4)))


def _tiles(batches: Iterator[pa.RecordBatch], size: int = TILE) -> Iterator[pa.RecordBatch]:
    """The tiles of the texts of (id, h, text)."""
    for batch in batches:
        ids, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for row, piece in pieces(texts(batch.column(2))):
            found = words(piece, NOT_BLANK)
            h = hashes(piece.data, found.start, found.end)
            rows, held = [], 0
            for t in range(len(piece.offsets) - 1):
                base, n = found.first[t], int(found.first[t + 1] - found.first[t])
                for low, high, core, stop, begin, end in tiles_of(n, size):
                    rows.append((ids[row + t], keys[row + t], low, high, core, stop, begin, n, h[base + begin : base + end].tobytes()))
                    held += end - begin
                    if held >= 1 << 18:
                        yield _batch(rows, _TILES)
                        rows, held = [], 0
            if rows:
                yield _batch(rows, _TILES)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The fragments of the tiles, about a quarter of a million words at a time."""
    for batch in batches:
        rows = list(zip(*(c.to_pylist() for c in batch.columns[:-1]), batch.column(8), strict=True))
        at = 0
        while at < len(rows):
            parts, tiles, held, stop = [], [], 0, at
            while stop < len(rows) and (stop == at or held < 1 << 18):
                _, _, low, high, core, end, begin, n, data = rows[stop]
                tiles.append(np.frombuffer(data.as_buffer(), np.uint64))
                parts.append((low, high, core, end, begin, n, held))
                held += len(tiles[-1])
                stop += 1
            part, period, low, high = fragments(np.concatenate(tiles), parts)
            part += at
            ids, keys = pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64())
            columns = [ids.take(pa.array(part)), keys.take(pa.array(part)), *(pa.array(x.astype(np.int32)) for x in (period, low, high))]
            yield pa.RecordBatch.from_arrays(columns, schema=_FRAGMENTS)
            at = stop


def _keys(doc_id: Column, text: Column) -> list[Column]:
    """A row by its id and its text."""
    return [F.xxhash64(doc_id).alias("id"), F.xxhash64(text).alias("h")]


def periodic_runs(docs: DataFrame, text: Column | None = None, tile: int = TILE) -> DataFrame:
    """(id, h, runs) of the documents that have any: hashes of doc_id and of the text, and runs by start, then period."""
    text = F.col("text") if text is None else text
    source = docs.select("doc_id", text.alias("text")).select(*_keys(F.col("doc_id"), F.col("text")), "text")
    long = F.octet_length("text") > 2 * tile

    # A document of one tile is solved where it is read.
    near = source.where(~long).mapInArrow(lambda batches: _solve(_tiles(batches, tile)), _ddl(_FRAGMENTS))
    wide = source.where(long).mapInArrow(lambda batches: _tiles(batches, tile), _ddl(_TILES)).repartition("id", "h", "low", "core")
    found = near.unionByName(wide.mapInArrow(_solve, _ddl(_FRAGMENTS)))
    key = ["id", "h", "period"]
    in_order = Window.partitionBy(*key).orderBy("low")
    opens = F.coalesce(F.col("low") > F.max("high").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True)).cast("int")
    island = F.sum("opens").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    whole = found.withColumn("opens", opens).withColumn("island", island).groupBy(*key, "island").agg(F.min("low").alias("start"), F.max("high").alias("last"))
    whole = whole.select("id", "h", "period", "start", (F.col("last") + F.col("period") - F.col("start")).alias("length"))
    whole = whole.where(F.col("length") >= F.greatest(F.lit(LEAST), EXPONENT * F.col("period")))
    least = whole.groupBy("id", "h", "start", "length").agg(F.min("period").alias("period"))
    by_start = F.array_sort(F.collect_list(F.struct("start", "period", "length")))
    runs = F.transform(by_start, lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length"), x["period"].alias("period")))
    return least.groupBy("id", "h").agg(runs.alias("runs"))


def _collapse(column: pa.Array, runs: pa.Array) -> pa.Array:
    """Each text's words joined by one space, without those that a run repeats."""
    ends = runs.offsets.to_numpy()
    start, length, period = (runs.values.field(k).to_numpy(zero_copy_only=False) for k in ("start", "length", "period"))
    out = []
    for row, piece in pieces(texts(column)):
        found = words(piece, NOT_BLANK)
        edge = np.zeros(len(found.start) + 1, np.int64)
        a, b = ends[row], ends[row + len(piece.offsets) - 1]
        base = np.repeat(found.first[:-1], np.diff(ends[row : row + len(piece.offsets)]))
        np.add.at(edge, base + start[a:b] + period[a:b], 1)
        np.add.at(edge, base + start[a:b] + length[a:b], -1)
        kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
        size = found.end[kept] - found.start[kept]
        to = np.cumsum(size + 1) - size - 1
        spaced = np.full(int(size.sum()) + len(kept), 0x20, np.uint8)
        slot = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        spaced[np.repeat(to, size) + slot] = piece.data[np.repeat(found.start[kept], size) + slot]
        cut = np.append(to, len(spaced))[np.searchsorted(kept, found.first)]
        out += [spaced[x : max(y - 1, x)].tobytes() for x, y in zip(cut[:-1], cut[1:], strict=True)]
    return pa.array(out, pa.binary()).cast(pa.string())


def collapse_runs(docs: DataFrame, text: Column | None = None, into: tuple[str, str] = ("runs", "kept")) -> DataFrame:
    """``docs`` with their runs and with the words that stay: of each run only its first period, joined by one space."""
    text = F.col("text") if text is None else text
    found = written(periodic_runs(docs, text), "runs").alias("found")
    few = found.agg(F.coalesce(F.sum(F.size("runs") + 1), F.lit(0)).alias("n")).first()["n"] <= FEW_ROWS
    own = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), text.alias("text"))
    own = own.select("row", "text", *_keys(F.col("row")["doc_id"], F.col("text")))
    joined = own.join(F.broadcast(found) if few else found, ["id", "h"], "left")
    runs = F.coalesce("runs", F.array().cast(RUNS))
    kept = F.arrow_udf(_collapse, "string")(F.col("text"), runs)
    others = [F.col("row")[c].alias(c) for c in docs.columns if c not in into]
    return joined.select(*others, runs.alias(into[0]), kept.alias(into[1]))
