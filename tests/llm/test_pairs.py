"""Near duplicates and repeated passages against brute force."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from adlake.llm import neardup, repeats
from adlake.llm.words import pieces, texts

WORD = re.compile("[^\x20\x09-\x0d]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = WORD.findall((text or "").translate(FOLD))
    return set(zip(words, words[1:], strict=False)) if len(words) > 1 else {tuple(words)} if words else set()


def groups(rows):
    """doc_id to (size, smallest reachable id), by comparing all pairs."""
    sets = {i: shingles(t) for i, t in rows if i is not None}
    least = {i: i for i in sets}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared):
                x, y = sorted((root(a), root(b)))
                least[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def changed(words, rng, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return words


@pytest.fixture
def copies(prose, rng):
    rows, i = [], 0
    for size in [1] * 40 + [2, 3, 5, 8, 40]:
        words = prose(rng.randint(4, 120)).split()
        for _ in range(size):
            rows.append((i, " ".join(changed(words, rng, rng.randrange(1 + len(words) // 12)))))
            i += 7
    chain = prose(100).split()
    for _ in range(12):  # each like the one before, the ends unlike
        chain = changed(chain, rng, 5)
        rows.append((i, " ".join(chain)))
        i += 7
    rows += [(i + 1, "a"), (i + 2, "A"), (i + 3, "a b"), (i + 4, "a b c d e"), (i + 5, "a b c d e f"), (i + 6, "x y z w v u"), (i + 7, " x  y z\nw v u q")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("rounds", "cell"), [(0, 300), (3, neardup.CELL_SHINGLES)])
def test_components_are_those_of_all_pairs(spark, copies, rounds, cell, monkeypatch):
    monkeypatch.setattr(neardup, "ROUNDS", rounds)
    monkeypatch.setattr(neardup, "CELL_SHINGLES", cell)
    out = neardup.near_duplicates(spark.createDataFrame(copies, "doc_id bigint, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == groups(copies)
    assert len(out) == len(copies) and all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_signature_pairs_within_the_distance_meet(rng):
    sets = [np.unique(np.array([rng.getrandbits(64) for _ in range(60)], np.uint64))]
    for _ in range(150):
        sets.append(np.unique(np.concatenate([sets[0][: rng.randint(20, 60)], np.array([rng.getrandbits(64) for _ in range(rng.randint(0, 40))], np.uint64)])))
    lanes, keys = neardup._signatures(sets)
    near = 0
    for k in range(1, len(sets)):
        different = int((lanes[0] != lanes[k]).sum())
        if different <= 2 * neardup.CHUNKS - 1:
            near += 1
            assert set(keys[0]) & set(keys[k])
    assert near > 10


def test_few_pairs_below_the_threshold_are_compared(rng):
    """Share of the pairs of a similarity whose full sets are compared."""
    shares = {}
    for similarity in (0.3, 0.5, 0.7, 0.8):
        passed = 0
        for _ in range(400):
            n = 200
            both = round(2 * n * similarity / (1 + similarity))
            pool = np.array([rng.getrandbits(64) for _ in range(2 * n - both)], np.uint64)
            lanes, _ = neardup._signatures([np.sort(pool[:n]), np.sort(pool[n - both :])])
            sketch = np.zeros((2, len(neardup.SKETCH)), np.uint64)
            for k in range(neardup.SIZE):
                sketch[:, k // 16] |= (lanes[:, k] & np.uint64(15)) << np.uint64(4 * (k % 16))
            passed += int(neardup._near_sketches(sketch[0], sketch[1:])[0])
        shares[similarity] = passed / 400
    assert shares[0.8] == 1 and shares[0.3] < 0.05 and shares[0.5] < 0.75


def test_near_duplicates_of_messy_tables(spark, messy, nothing):
    out = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(messy).collect()}
    assert neardup.near_duplicates(messy).count() == messy.count()
    assert out == {(1, 2, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 0, 4, True), (None, 3, None, True), (5, 2, 1, False), (6, 1, 6, True), (7, 3, 7, True)}
    assert neardup.near_duplicates(nothing).count() == 0


def test_components_of_long_chains(spark):
    chain = spark.range(60).selectExpr("id as a", "id + 1 as b")
    rows = neardup.components(spark.range(70).withColumnRenamed("id", "v"), chain).collect()
    assert {r.v: r.c for r in rows} == {v: 0 if v <= 60 else v for v in range(70)}


def removed(rows, window=repeats.WINDOW):
    first = {}
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, w in words:
        if i is not None:
            for k in range(len(w) - window + 1):
                g = tuple(w[k : k + window])
                first[g] = min(first.get(g, i), i)
    out = []
    for i, w in words:
        gone = {p for k in range(len(w) - window + 1) if i is not None and first[tuple(w[k : k + window])] < i for p in range(k, k + window)}
        out.append((str(i), len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return sorted(out)


def test_minimisers_are_those_of_each_window(prose):
    column = pa.array([prose(200), "", prose(49), prose(50), "a " * 300, prose(130)])
    for limit in (1, 1 << 20):
        for row, piece in pieces(texts(column), limit):
            text, start, count, mini = repeats.runs_of(piece)
            for t in range(len(piece.offsets) - 1):
                own = text == t
                n = len(WORD.findall(column[row + t].as_py()))
                at = [w for a, c in zip(start[own], count[own], strict=True) for w in range(a, a + c)]
                assert at == list(range(max(n - repeats.WINDOW + 1, 0)))
    _, _, count, _ = repeats.runs_of(texts(pa.array(["a " * 300])))
    assert list(count) == [251]


def sharing(prose, rng, n=70):
    passages = [prose(rng.randint(50, 90)) for _ in range(4)] + ["x " * 70, prose(500)]
    rows = []
    for i in range(n):
        parts = [prose(rng.randint(0, 60))]
        for _ in range(rng.choice([0, 0, 1, 2])):
            words = rng.choice(passages).split()
            a = rng.randrange(max(len(words) - 50, 1))
            parts += [rng.choice([" ", "\n", "  "]).join(words[a : a + rng.randint(40, 120)]), prose(rng.randint(0, 5))]
        rows.append((rng.randrange(10**6), " ".join(parts)))
    rows += [(10**7 + i, rows[0][1]) for i in range(5)] + [(10**8, passages[0]), (10**8, passages[0])]
    return rows


@pytest.mark.parametrize("hot", [repeats.HOT_STRINGS, 1])
def test_words_of_repeated_windows_go(spark, prose, rng, hot, monkeypatch):
    monkeypatch.setattr(repeats, "HOT_STRINGS", hot)
    rows = sharing(prose, rng)
    out = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in out) == removed(rows)
    assert Counter(r.n_removed > 0 for r in out)[True] > 10


def lines(n=60):
    """Documents that repeat one line, each another number of times."""
    return [(i, "to be continued on the next page " * (30 + 3 * i) + f"end {i}") for i in range(n)]


def test_strings_have_few_windows():
    runs = repeats.super_kmers(pa.array([t for _, t in lines()]))
    assert max(r["count"] for r in runs.flatten().to_pylist()) <= 64


def test_a_bucket_is_bounded_by_its_windows(spark, monkeypatch):
    tables = {}
    monkeypatch.setattr(repeats, "HOT_BYTES", 20_000)
    written = repeats.written

    def noted(df, name):
        tables[name] = written(df, name)
        return tables[name]

    monkeypatch.setattr(repeats, "written", noted)
    out = repeats.remove_repeats(spark.createDataFrame(lines(), "doc_id bigint, text string")).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in out) == removed(lines())
    hot = {r.mini for r in tables["hot"].collect()}
    held = Counter()
    for r in tables["distinct"].collect():
        held[r.mini] += r["count"] * repeats.WINDOW_BYTES + len(r.packed.encode()) * min(r["count"], repeats.WINDOW)
    assert hot and all((size > 20_000) == (mini in hot) for mini, size in held.items())


def test_removal_in_messy_tables(spark, messy, nothing):
    rows = [(r.doc_id, r.text) for r in messy.collect()]
    out = repeats.remove_repeats(messy).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in out) == removed(rows)
    assert repeats.remove_repeats(nothing).count() == 0


@pytest.mark.parametrize("width", [1, 2, 3, 7, 8, 43])
def test_least_of_neighbours(width, rng):
    g = np.array([rng.randrange(100) for _ in range(60)], np.uint64)
    assert list(repeats._least(g, width)) == [min(g[i : i + width]) for i in range(len(g) - width + 1)]
