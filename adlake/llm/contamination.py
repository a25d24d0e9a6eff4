"""Benchmark decontamination by winnowing.

Every text is cut into words. Of the hashes of ``GRAM`` consecutive words, the smallest of each ``WINDOW - GRAM + 1``
neighbours is a fingerprint, so two texts that share ``WINDOW`` words in a row share a fingerprint at the same place of
them. Fingerprints of documents are joined with those of benchmark items, and each meeting is extended to the windows
whose fingerprint it is: a window is a hit if items have it whole, and windows that overlap or touch are one span, so a span is as long as
what is shared. An item shorter than a window is looked up whole.

Windows of the benchmark are kept once each, with the set of items that have them, and equal sets are one. So the work
follows the number of words on either side, also where a text repeats itself or many items begin alike; no pair of places is
formed.

The benchmark is broadcast in blocks of at most ``BLOCK_BYTES`` of text, so that what is sent has a bound whatever its
size. Several blocks take one pass over the documents each, which keeps only the hits; those are joined to the documents
at the end.

Cases: null or empty texts have no words and hit nothing; items without words occur nowhere, and items of null id are
left out. Items with equal texts all count. Ids of items are of any type. Rows are judged one by one, repeated doc_ids included. The caller's columns
pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from adlake.llm.shared import FEW_ROWS, written
from adlake.llm.words import LETTERS, LOWER, Texts, Words, distinct, grams, hashes, lists, mix, pieces, texts, words

WINDOW, GRAM = 10, 5
BLOCK_BYTES = 8 << 20


class Table(NamedTuple):
    """Hashes in order, and for each the number of the set of items that have it."""

    keys: np.ndarray
    sets: np.ndarray

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, set) of the values that are keys."""
        if not len(self.keys) or not len(values):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.keys, values), len(self.keys) - 1)
        found = np.flatnonzero(self.keys[at] == values)
        return found, self.sets[at[found]]


class Index(NamedTuple):
    """Benchmark items of a block. ``windows``: of each length, a table of the windows' hashes; items of set s are
    ``members[first[s] : first[s + 1]]``, numbers of items."""

    prints: np.ndarray
    windows: dict[int, Table]
    first: np.ndarray
    members: np.ndarray


def folded_words(piece: Texts) -> tuple[Words, np.ndarray]:
    data = LOWER[piece.data]
    found = words(Texts(data, piece.offsets), LETTERS)
    return found, hashes(data, found.start, found.end)


def winnow(h: np.ndarray, last: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(word positions, hashes) of the fingerprints; ``last`` is where the text of each word ends."""
    g = grams(h, gram)
    n = len(h) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    best, at = g[:n].copy(), np.arange(n)
    for k in range(1, window - gram + 1):
        other = g[k : k + n]
        smaller = other <= best
        best[smaller] = other[smaller]
        at[smaller] = np.flatnonzero(smaller) + k
    chosen = np.zeros(len(h), bool)
    chosen[at[np.arange(n) + window <= last[:n]]] = True
    at = np.flatnonzero(chosen)
    return at, g[at]


def index(items: list[str], window: int = WINDOW, gram: int = GRAM) -> Index:
    """The index of the items' texts."""
    found, h = folded_words(texts(pa.array(items, pa.string())))
    last, n = found.last(), np.diff(found.first)
    owner = found.text_of()
    _, prints = winnow(h, last, window, gram)
    lengths, keys, members = [], [], []
    for length in sorted({min(int(x), window) for x in n if x}):
        g = grams(h, length)
        at = np.flatnonzero(np.arange(len(g)) + length <= last[: len(g)])
        if length < window:
            at = at[n[owner[at]] == length]
        lengths.append(np.full(len(at), length))
        keys.append(g[at])
        members.append(owner[at])
    length, key, member = (np.concatenate([np.zeros(0, k), *x]).astype(k) for k, x in ((np.int64, lengths), (np.uint64, keys), (np.int64, members)))
    order = np.lexsort((member, key, length))
    length, key, member = length[order], key[order], member[order]
    once = np.ones(len(key), bool)
    once[1:] = (length[1:] != length[:-1]) | (key[1:] != key[:-1]) | (member[1:] != member[:-1])
    length, key, member = length[once], key[once], member[once]
    begins = np.ones(len(key), bool)
    begins[1:] = (length[1:] != length[:-1]) | (key[1:] != key[:-1])
    group = np.flatnonzero(begins)
    size = np.diff(np.append(group, len(key)))
    # Sets are told apart by their sizes and two sums of hashes of their members.
    one = mix(member.astype(np.uint64) + np.uint64(1))
    sums = [np.add.reduceat(x, group) if len(group) else x for x in (one, mix(one))]
    _, where, number = np.unique(np.stack([size.astype(np.uint64), *sums], 1), axis=0, return_index=True, return_inverse=True)
    number = number.reshape(-1)
    kept = np.concatenate([np.zeros(0, np.int64), *(member[group[k] : group[k] + size[k]] for k in where)])
    first = np.concatenate([[0], np.cumsum(size[where])]).astype(np.int64)
    tables = {int(x): Table(key[group][length[group] == x], number[length[group] == x]) for x in np.unique(length)}
    return Index(distinct(prints), tables, first, kept.astype(np.int64))


def found_windows(found: Words, h: np.ndarray, bench: Index, window: int = WINDOW, gram: int = GRAM) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, first words, sets of items) of the windows that items have."""
    last = found.last()
    at, prints = winnow(h, last, window, gram)
    if window in bench.windows and len(at):
        close = np.minimum(np.searchsorted(bench.prints, prints), len(bench.prints) - 1)
        met = at[bench.prints[close] == prints]
        near = np.zeros(len(h) + 1, np.int64)  # a meeting is extended to the windows that hold it
        np.add.at(near, np.maximum(met - (window - gram), 0), 1)
        np.add.at(near, met + 1, -1)
        some = np.flatnonzero(np.cumsum(near[:-1]) > 0)
        some = some[some + window <= last[some]]
        hits, sets = bench.windows[window].find(_grams_at(h, some, window))
        yield window, some[hits], sets
    for length, table in bench.windows.items():
        if length < window:
            g = grams(h, length)
            hits, sets = table.find(g)
            inside = hits + length <= last[hits]
            yield length, hits[inside], sets[inside]


def _grams_at(h: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """``grams(h, n)`` at some places."""
    need = np.zeros(len(h), bool)
    for k in range(n):
        need[at + k] = True
    place = np.cumsum(need) - 1
    return grams(h[need], n)[place[at]] if len(at) else np.zeros(0, np.uint64)


def hits(column: pa.Array, bench: Index, ids: pa.Array) -> pa.Array:
    """(n_words, start and end of the spans, ids of the items) of each text."""
    n_words, owner, starts, ends, in_text, items = [], [], [], [], [], []
    for row, piece in pieces(texts(column)):
        found, h = folded_words(piece)
        n_words.append(np.diff(found.first))
        edge, pairs = np.zeros(len(h) + 1, np.int64), []
        for length, at, sets in found_windows(found, h, bench):
            np.add.at(edge, at, 1)
            np.add.at(edge, at + length, -1)
            pairs.append(np.stack([np.searchsorted(found.first, at, "right") - 1, sets], 1))
        covered = np.cumsum(edge[:-1]) > 0
        opens, closes = covered.copy(), covered.copy()
        opens[1:] &= ~covered[:-1] | (np.diff(found.text_of()) > 0)
        closes[:-1] &= ~covered[1:] | (np.diff(found.text_of()) > 0)
        a, b = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        text = np.searchsorted(found.first, a, "right") - 1
        owner.append(text + row)
        starts.append(a - found.first[text])
        ends.append(b - found.first[text])
        if pairs:
            text, number = np.unique(np.concatenate(pairs), axis=0).T
            size = bench.first[number + 1] - bench.first[number]
            spot = np.arange(int(size.sum())) + np.repeat(bench.first[number] - (np.cumsum(size) - size), size)
            text, item = np.unique(np.stack([np.repeat(text, size), bench.members[spot]], 1), axis=0).T
            in_text.append(text + row)
            items.append(item)
    flat = lambda parts, kind: np.concatenate([np.zeros(0, kind), *parts]).astype(kind)
    rows = flat(owner, np.int64)
    return pa.StructArray.from_arrays(
        [
            pa.array(flat(n_words, np.int64)),
            lists(rows, pa.array(flat(starts, np.int32)), len(column)),
            lists(rows, pa.array(flat(ends, np.int32)), len(column)),
            lists(flat(in_text, np.int64), ids.take(pa.array(flat(items, np.int64))), len(column)),
        ],
        ["n_words", "start", "end", "items"],
    )


def _look_up(items: DataFrame) -> Column:
    """A look-up of the column ``text`` in the items, which fit the driver and every worker."""
    rows = items.select("item_id", "text").toArrow()
    ids = rows.column("item_id").combine_chunks()
    sent = items.sparkSession.sparkContext.broadcast((index(rows.column("text").to_pylist()), ids))
    kind = items.schema["item_id"].dataType.simpleString()

    @F.arrow_udf(f"struct<n_words:bigint,start:array<int>,end:array<int>,items:array<{kind}>>")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bench, ids = sent.value
        for column in batches:
            yield hits(column, bench, ids)

    return found(F.col("text"))


def decontaminate(docs: DataFrame, bench: DataFrame, into: str = "hits", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with a struct: n_words, start and end of disjoint hit spans in words, ids of the items that occur."""
    items = bench.where("item_id is not null and text is not null").select("item_id", "text").distinct()
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-int(size) // block_bytes))
    if blocks == 1:
        return docs.withColumn(into, _look_up(items))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    # Texts are told apart by 128 bits; equal ones have equal hits.
    key = [F.xxhash64("text").alias("a"), F.xxhash64(F.reverse("text")).alias("b")]
    some = None
    for k in range(blocks):
        now = docs.select(*key, _look_up(items.where(block == k)).alias("h")).where(F.size("h.start") > 0).distinct()
        some = now if some is None else some.unionByName(now)
    every = written(some, "hits").groupBy("a", "b").agg(
        _union_of_spans(F.array_sort(F.flatten(F.collect_list(F.arrays_zip(F.col("h.start").alias("s"), F.col("h.end").alias("e")))))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("h.items"))).alias("items"),
    )
    every = written(every, "met")
    few = every.agg(F.coalesce(F.sum(F.size("spans") + F.size("items")), F.lit(0)).alias("n")).first()["n"] <= FEW_ROWS
    own = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), *key, _look_up(items.limit(0)).alias("none"))
    joined = own.join(F.broadcast(every) if few else every, ["a", "b"], "left")
    hit = F.struct(
        F.col("none.n_words").alias("n_words"),
        *(F.coalesce(F.col("spans")[k], F.array().cast("array<int>")).alias(name) for k, name in (("s", "start"), ("e", "end"))),
        F.coalesce("items", F.col("none.items")).alias("items"),
    )
    return joined.select(*(F.col("row")[c].alias(c) for c in docs.columns if c != into), hit.alias(into))


def _union_of_spans(spans: Column) -> Column:
    """Sorted spans (s, e); those that meet become one."""
    last = lambda done: F.try_element_at(done, F.lit(-1))

    def step(done: Column, x: Column) -> Column:
        longer = F.struct(last(done)["s"].alias("s"), F.greatest(last(done)["e"], x["e"]).alias("e"))
        others = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when((F.size(done) > 0) & (last(done)["e"] >= x["s"]), F.concat(others, F.array(longer))).otherwise(F.concat(done, F.array(x)))

    kind = "array<struct<s:int,e:int>>"
    return F.aggregate(spans.cast(kind), F.array().cast(kind), step)


def words_hit(hit: Column) -> Column:
    return F.aggregate(F.zip_with(hit["start"], hit["end"], lambda a, b: (b - a).cast("long")), F.lit(0).cast("long"), lambda x, y: x + y)
