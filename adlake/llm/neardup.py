"""Near duplicates: a multi-index join of b-bit minhash signatures, confirmed on full shingle sets.

A document's set holds its distinct two-word shingles. Its signature has ``CHUNKS * LANES`` lanes of 16 bits. Pairs whose
signatures differ in at most ``CHUNKS * 2 - 1`` lanes have, by pigeonhole, a chunk with at most one differing lane, and
meet in one of the keys that leave out one lane of that chunk; so all of them are candidates. Two sets of similarity 0.8
or more miss each other in all chunks with a probability below two in a million. Candidates are confirmed on full sets.

Documents of equal sets form classes, which one document represents. Buckets are not expanded into pairs. The documents of
a bucket go to the group of its smallest id, so that two that share any bucket share a group, and a document is in few. In
each of ``ROUNDS`` rounds every document meets the pivot of a group that is in another component. Where a group's
documents then still are in several components, those outside the largest are compared with all of them, set against
sets, in cells of at most about ``CELL_SHINGLES`` shingles a side; only links leave a cell. Components are the least labels
of a propagation with pointer jumping. Every step reads written tables, so a lost executor costs the step at hand.

Cases: an empty or null text, or one without words, has no set and is linked with nothing; a text of one word has that
word as its only shingle. Sets of fewer than four shingles can only be equal. A null doc_id gets a null component and is
kept. Rows that repeat a doc_id count as one document. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from adlake.llm.shared import if_few, written
from adlake.llm.words import LOWER, NOT_BLANK, Texts, distinct, grams, hashes, lists, mix, pieces, texts, words

CHUNKS, LANES = 10, 5
SIZE = CHUNKS * LANES
#: Similarity, in hundredths.
LEAST = 80
#: Pairs whose sketches of four bits a lane differ in more lanes aren't compared: one in a million of similarity 0.8.
SKETCH_DIFFERENT = 24
#: Rounds with pivots before the comparison of all that is left.
ROUNDS = 3
CELL_SHINGLES = 1_000_000
SKETCH = [f"s{k}" for k in range(-(-SIZE // 16))]
SIGNED = f"struct<n:bigint,hi:bigint,lo:bigint,{','.join(f'{s}:bigint' for s in SKETCH)},keys:array<bigint>>"

_RANDOM = np.random.default_rng(20_240_601)
_XOR = _RANDOM.integers(0, 1 << 64, SIZE, np.uint64)
_TIMES = _RANDOM.integers(0, 1 << 64, SIZE, np.uint64) | np.uint64(1)


def _sets(piece: Texts) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    data = LOWER[piece.data]
    found = words(Texts(data, piece.offsets), NOT_BLANK)
    h = hashes(data, found.start, found.end)
    pairs = grams(h, 2)
    return [distinct(pairs[a : b - 1] if b - a > 1 else mix(h[a:b])) for a, b in zip(found.first[:-1], found.first[1:], strict=True)]


def _signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(16-bit lanes, keys) of sets that aren't empty, a row each."""
    flat, starts = np.concatenate(sets), np.cumsum([0, *(len(s) for s in sets[:-1])])
    lanes = np.empty((len(sets), SIZE), np.uint64)
    for k in range(SIZE):
        lanes[:, k] = np.minimum.reduceat((flat ^ _XOR[k]) * _TIMES[k], starts)
    lanes = mix(lanes) & np.uint64(0xFFFF)
    keys = np.empty((len(sets), SIZE), np.uint64)
    for chunk in range(CHUNKS):
        for out in range(LANES):
            key = np.full(len(sets), chunk * LANES + out + 1, np.uint64)
            for lane in range(LANES):
                if lane != out:
                    key = mix(key * np.uint64(0xC2B2AE3D27D4EB4F) + lanes[:, chunk * LANES + lane])
            keys[:, chunk * LANES + out] = key
    return lanes, keys


def signed(column: pa.Array) -> pa.Array:
    """Size, 128-bit digest, sketch and keys of each text's set; no keys below four shingles."""
    n = len(column)
    sizes, ends = np.zeros(n, np.int64), np.zeros(n, np.int64)
    digest, sketch, all_keys, owners = np.zeros((n, 2), np.uint64), np.zeros((n, len(SKETCH)), np.uint64), [np.zeros(0, np.uint64)], [ends[:0]]
    for row, piece in pieces(texts(column)):
        sets = _sets(piece)
        sizes[row : row + len(sets)] = [len(s) for s in sets]
        some = np.array([k for k, s in enumerate(sets) if len(s)], np.int64)
        if not len(some):
            continue
        flat, starts = np.concatenate([sets[k] for k in some]), np.cumsum([0, *(len(sets[k]) for k in some[:-1])])
        digest[row + some, 0] = np.add.reduceat(mix(flat ^ np.uint64(0xA5A5)), starts)
        digest[row + some, 1] = np.bitwise_xor.reduceat(mix(flat * np.uint64(0x2545F4914F6CDD1D)), starts)
        lanes, keys = _signatures([sets[k] for k in some])
        for k in range(SIZE):
            sketch[row + some, k // 16] |= (lanes[:, k] & np.uint64(15)) << np.uint64(4 * (k % 16))
        large = sizes[row + some] >= 4
        all_keys.append(keys[large].ravel())
        owners.append(np.repeat(row + some[large], SIZE))
    signed_64 = lambda x: pa.array(np.ascontiguousarray(x).view(np.int64))
    return pa.StructArray.from_arrays(
        [pa.array(sizes), signed_64(digest[:, 0]), signed_64(digest[:, 1]), *(signed_64(sketch[:, k]) for k in range(len(SKETCH))), lists(np.concatenate(owners), signed_64(np.concatenate(all_keys)), n)],
        ["n", "hi", "lo", *SKETCH, "keys"],
    )


def shingles(column: pa.Array) -> pa.Array:
    """Distinct shingle hashes of each text."""
    sets = [s for _, piece in pieces(texts(column)) for s in _sets(piece)]
    flat = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(s) for s in sets)]).astype(np.int32)), pa.array(flat))


def _differing(a: str, b: str) -> Column:
    """In how many lanes two sketches differ."""
    total = F.lit(0)
    for s in SKETCH:
        x = F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))
        for by in (1, 2):
            x = x.bitwiseOR(F.shiftrightunsigned(x, by))
        total = total + F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))
    return total


def _alike(a: str, b: str) -> Column:
    """Sizes and sketches that leave the similarity open."""
    low, high = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
    return (low * 100 >= high * LEAST) & (_differing(a, b) <= SKETCH_DIFFERENT)


def components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(v, c): the least vertex that each one reaches. ``vertices`` has v, ``edges`` a and b."""
    both = written(edges.select("a", "b").union(edges.select("b", "a")).where("a != b").distinct(), "edges")
    labels = written(vertices.select("v", F.col("v").alias("c")), "labels")
    while True:
        near = both.join(labels, F.col("a") == F.col("v")).groupBy("b").agg(F.min("c").alias("m")).withColumnRenamed("b", "v")
        least = labels.join(near, "v", "left").select("v", "c", F.least("c", "m").alias("m"))
        at = labels.select(F.col("v").alias("m"), F.col("c").alias("of_m"))
        jumped = least.join(at, "m", "left").select("v", "c", F.least("m", "of_m").alias("new"))
        jumped = written(jumped, "labels")
        done = jumped.where("new != c").limit(1).count() == 0
        labels = jumped.select("v", F.col("new").alias("c"))
        if done:
            return labels


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those pairs (a, b) whose full sets are similar."""
    pairs = if_few(pairs)
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("of_a")).join(pairs, "a")
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("of_b")).join(pairs, "b")
    full = left.join(right, ["a", "b"])
    shared = F.size(F.array_intersect("of_a", "of_b"))
    return full.where(shared * 100 >= (F.size("of_a") + F.size("of_b") - shared) * LEAST).select("a", "b")


def _link(documents: DataFrame, sketches: DataFrame, groups: DataFrame) -> DataFrame:
    """(v, c) of all documents in groups. ``sketches``: doc_id, n and sketch of each; ``groups``: g, doc_id."""
    ids = sketches.select("doc_id")
    sets = written(
        documents.join(if_few(ids), "doc_id", "left_semi").select("doc_id", F.arrow_udf(shingles, "array<bigint>")("text").alias("shingles")),
        "sets",
    )
    comps = written(ids.select(F.col("doc_id").alias("v"), F.col("doc_id").alias("c")).distinct(), "components")
    for turn in range(ROUNDS + 1):
        rows = groups.join(comps, F.col("doc_id") == F.col("v")).select("g", "doc_id", "c")
        if turn < ROUNDS:
            links = _confirmed(written(_with_pivots(rows, sketches, turn), "pairs"), sets)
        else:
            links = _across(rows, sketches, sets)
        links = written(links, "links")
        if not links.limit(1).count():
            continue
        label = comps.select(F.col("v").alias("x"), F.col("c").alias("cx"))
        edges = links.join(label, F.col("a") == F.col("x")).select("b", F.col("cx").alias("a"))
        edges = edges.join(label, F.col("b") == F.col("x")).select("a", F.col("cx").alias("b"))
        merged = components(comps.select(F.col("c").alias("v")).distinct(), edges)
        comps = written(comps.join(merged.select(F.col("v").alias("c"), F.col("c").alias("new")), "c").select("v", F.col("new").alias("c")), "components")
    return comps


def _with_pivots(rows: DataFrame, sketches: DataFrame, turn: int) -> DataFrame:
    """Every document with the pivot of one of its groups that is in another component."""
    rank = F.col("doc_id") if turn == 0 else F.xxhash64("doc_id", "g", F.lit(turn))
    pivots = written(
        rows.groupBy("g").agg(F.min(F.struct(rank.alias("rank"), F.col("doc_id").alias("p"), F.col("c").alias("pc"))).alias("m")).select("g", "m.p", "m.pc"),
        "pivots",
    )
    met = rows.join(pivots, "g").where("c != pc").select(F.col("doc_id").alias("d"), "p").distinct()
    x, y = sketches.alias("x"), sketches.alias("y")
    alike = met.join(x, F.col("d") == F.col("x.doc_id")).join(y, F.col("p") == F.col("y.doc_id")).where(_alike("x", "y"))
    one = alike.groupBy("d").agg(F.min(F.struct(_differing("x", "y"), F.col("p"))).alias("m")).select("d", "m.p")
    return one.select(F.least("d", "p").alias("a"), F.greatest("d", "p").alias("b")).distinct()


def _across(rows: DataFrame, sketches: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between components that share a group: of each that has several, the documents outside the largest one are
    compared with all, in cells of bounded size."""
    grouped = written(rows.join(sketches.select("doc_id", "n", *SKETCH), "doc_id"), "sized")
    by_comp = grouped.groupBy("g", "c").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("n"))
    by_group = by_comp.groupBy("g").agg(F.max(F.struct("m", "c")).alias("top"), F.count(F.lit(1)).alias("comps"), F.sum("m").alias("m"), F.sum("n").alias("n"))
    cells = by_group.where("comps > 1").select(
        "g",
        F.col("top.c").alias("most"),
        F.ceil(F.col("n") / CELL_SHINGLES).cast("int").alias("blocks"),
        F.ceil((F.col("n") / F.col("m")) * (F.col("m") - F.col("top.m")) / CELL_SHINGLES).cast("int").alias("bands"),
    )
    slim = written(grouped.join(written(cells, "cells"), "g"), "slim")
    open_rows = written(sets.join(if_few(slim), "doc_id"), "open")
    own = lambda n: F.pmod(F.xxhash64("doc_id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["g", "block", "band", "doc_id", "c", *SKETCH, "shingles"]
    left = open_rows.where("c != most").withColumn("band", own("bands")).withColumn("block", every("blocks")).select(columns)
    right = open_rows.withColumn("block", own("blocks")).withColumn("band", every("bands")).select(columns)
    cell = ["g", "block", "band"]
    return left.groupBy(cell).cogroup(right.groupBy(cell)).applyInArrow(_compare, "a bigint, b bigint").distinct()


def _near_sketches(mine: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Which sketches, a row each, differ from mine in at most SKETCH_DIFFERENT lanes."""
    x = mine ^ others
    for by in (1, 2):
        x |= x >> np.uint64(by)
    return np.bitwise_count(x & np.uint64(0x1111111111111111)).sum(axis=1) <= SKETCH_DIFFERENT


def _sketches(rows: pa.Table) -> np.ndarray:
    return np.stack([rows.column(s).to_numpy().view(np.uint64) for s in SKETCH], axis=1)


def _compare(left: pa.Table, right: pa.Table) -> pa.Table:
    """A link from each document on the left to each other component on the right that has one like it. Full sets are
    compared where sizes and signatures allow it."""
    links: list[tuple[int, int]] = []
    if left.num_rows and right.num_rows:
        ids, comps, signs = right.column("doc_id").to_numpy(), right.column("c").to_numpy(), _sketches(right)
        own = right.column("shingles").combine_chunks()
        flat, ends = own.values.to_numpy(), own.offsets.to_numpy()
        flat, starts, sizes = flat[ends[0] : ends[-1]], ends[:-1] - ends[0], np.diff(ends)
        known = distinct(flat)
        place = np.searchsorted(known, flat)
        mark = np.zeros(len(known), np.uint8)
        rows = zip(left.column("doc_id").to_pylist(), left.column("c").to_pylist(), _sketches(left), left.column("shingles"), strict=True)
        for doc, comp, sign, mine in rows:
            mine = mine.values.to_numpy()
            n = len(mine)
            open_ = (comps != comp) & (np.minimum(sizes, n) * 100 >= np.maximum(sizes, n) * LEAST)
            open_ = np.flatnonzero(open_)
            open_ = open_[_near_sketches(sign, signs[open_])]
            if not len(open_):
                continue
            at = np.minimum(np.searchsorted(known, mine), len(known) - 1)
            at = at[known[at] == mine]
            mark[at] = 1
            first = np.cumsum(sizes[open_]) - sizes[open_]
            taken = np.arange(int(sizes[open_].sum())) + np.repeat(starts[open_] - first, sizes[open_])
            shared = np.add.reduceat(mark[place[taken]], first, dtype=np.int64)
            mark[at] = 0
            like = open_[shared * 100 >= (sizes[open_] + n - shared) * LEAST]
            if len(like):
                some = like[np.unique(comps[like], return_index=True)[1]]
                links += [(min(doc, int(x)), max(doc, int(x))) for x in ids[some]]
    a, b = zip(*links, strict=True) if links else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row; the component is its smallest doc_id, which is kept."""
    documents = docs.select("doc_id", "text")
    signs = written(documents.select("doc_id", F.arrow_udf(signed, SIGNED)("text").alias("s")).select("doc_id", "s.*"), "signatures")
    whole = signs.where("n > 0 and doc_id is not null")
    classes = written(whole.groupBy("hi", "lo", "n").agg(F.min("doc_id").alias("rep")), "classes")
    rep = F.col("doc_id") == F.col("rep")
    own = signs.where("n >= 4").join(classes.where("n >= 4").select("rep").distinct(), rep, "left_semi")
    buckets = own.select("doc_id", F.explode("keys").alias("key"))
    shared = written(buckets.groupBy("key").agg(F.min("doc_id").alias("g"), F.max("doc_id").alias("last")).where("g < last").select("key", "g"), "keys")
    groups = written(buckets.join(shared, "key").select("g", "doc_id").distinct(), "groups")
    sketches = written(
        signs.where("n >= 4").join(if_few(written(groups.select("doc_id").distinct(), "ids")), "doc_id", "left_semi").select("doc_id", "n", *SKETCH).dropDuplicates(["doc_id"]),
        "sketches",
    )
    comps = _link(documents, sketches, groups)
    named = signs.select("doc_id", "n", "hi", "lo").join(classes, ["hi", "lo", "n"], "left")
    ends = named.join(comps, F.col("rep") == F.col("v"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("c", "rep", "doc_id"))
    return ends.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
