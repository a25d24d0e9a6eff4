"""Periodic runs of words against a search over all periods."""

import random
import re

import numpy as np
import pytest

from adlake.llm import periods
from adlake.llm.words import hashes, texts, words, NOT_BLANK

WORD = re.compile("[^\x20\x09-\x0d]+")


def runs_of(ws):
    """(start, length, period) of all runs."""
    n, found = len(ws), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and ws[j] == ws[j + q]:
                j += 1
            if j > i and j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def collapsed(ws):
    gone = {i for s, length, q in runs_of(ws) for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(ws) if i not in gone)


def looped(rng, n, kinds):
    ws = [f"w{rng.randrange(kinds)}" for _ in range(n)]
    for _ in range(rng.randrange(4)):
        a = rng.randrange(n)
        p = 1 + rng.randrange(max(1, (n - a) // 3))
        for i in range(a, min(n, a + p * rng.randrange(2, 6) + rng.randrange(p))):
            ws[i] = ws[a + (i - a) % p]
    return ws


def corpus(rng):
    rows = [(k, " ".join(looped(rng, rng.choice([1, 23, 24, 60, 250, 700]), rng.choice([1, 2, 3, 40])))) for k in range(60)]
    lone = "a b c d e f g h i j k l".split()
    rows += [(100, "x " * 24), (101, "x " * 23), (102, " ".join(lone * 3)), (103, " ".join((lone * 3)[:-1])), (104, "ab\tba\n" * 12 + "ab")]
    # A period that itself repeats in part, and runs that overlap by less than a period.
    rows += [(105, " ".join((["a"] * 30 + ["b"]) * 4)), (106, " ".join(["p", "q", "r"] * 9 + ["s", "q", "r"] * 9))]
    return rows


@pytest.mark.parametrize("tile", [periods.TILE, 64, 100])
def test_runs_of_documents_of_one_or_many_tiles(spark, rng, tile):
    rows = corpus(rng)
    found = periods.periodic_runs(spark.createDataFrame(rows, "doc_id bigint, text string"), tile=tile).collect()
    got = sorted(sorted((x.start, x.length, x.period) for x in r.runs) for r in found)
    assert got == sorted(r for r in (runs_of(WORD.findall(t)) for _, t in rows) if r)


def test_runs_come_by_start_and_copies_are_collapsed(spark, rng):
    rows = corpus(rng)
    out = periods.collapse_runs(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: [(x.start, x.length, x.period) for x in r.runs] for r in out} == {i: runs_of(WORD.findall(t)) for i, t in rows}
    assert {r.doc_id: r.kept for r in out} == {i: collapsed(WORD.findall(t)) for i, t in rows}


def test_boundary_z_values(rng):
    ws = looped(random.Random(3), 400, 2)
    piece = texts(__import__("pyarrow").array([" ".join(ws)]))
    found = words(piece, NOT_BLANK)
    blocks = periods._Blocks(hashes(piece.data, found.start, found.end))
    at, q = np.meshgrid(np.arange(0, 300, 7), np.arange(1, 60, 5))
    at, q = at.ravel(), q.ravel()
    for k, (a, p) in enumerate(zip(at, q, strict=True)):
        right = next((i for i in range(400) if a + p + i >= 400 or ws[a + i] != ws[a + p + i]), 0)
        left = next((i for i in range(400) if a - 1 - i < 0 or ws[a - 1 - i] != ws[a + p - 1 - i]), 0)
        assert min(periods.z_right(blocks, at[k : k + 1], q[k : k + 1], 64)[0], 64) == min(right, 64)
        assert min(periods.z_left(blocks, at[k : k + 1], q[k : k + 1], 64)[0], 64) == min(left, 64)


def test_every_run_holds_a_boundary():
    for q in range(1, 300):
        octave = q.bit_length() - 1
        assert periods.spacing(octave) <= max(24, 3 * q) - q


def test_a_long_document_is_dealt_out():
    n = 3_000_000
    tiles = list(periods.tiles_of(n))
    assert {k for low, high, *_ in tiles for k in range(low, high)} == set(range(periods.n_octaves(n)))
    for low, high, core, stop, begin, end in tiles:
        reach = periods.spacing(high - 1)
        assert begin <= max(core - reach, 0) and end >= min(stop + reach, n) and end - begin <= max(2 * periods.TILE, 12 * reach)
    for octave in range(periods.n_octaves(n)):
        cores = sorted((core, stop) for low, high, core, stop, *_ in tiles if low <= octave < high)
        assert cores[0][0] == 0 and cores[-1][1] == n and all(a[1] == b[0] for a, b in zip(cores, cores[1:], strict=False))


def test_messy_tables(spark, messy, nothing):
    out = periods.collapse_runs(messy)
    assert set(out.columns) == {*messy.columns, "runs"}
    rows = out.collect()
    assert len(rows) == messy.count()
    for r, m in zip(sorted(rows, key=str), sorted(messy.collect(), key=str), strict=True):
        assert r.hits == m.hits
    text = {r.doc_id: r.text for r in messy.collect()}
    assert {(r.doc_id, r.kept) for r in rows} == {(i, collapsed(WORD.findall(t or "")) if i != 6 else "tail") for i, t in text.items()}
    assert periods.collapse_runs(nothing).count() == 0


def test_rows_that_repeat_an_id_keep_their_own_runs(spark):
    docs = spark.createDataFrame([(1, "a " * 30), (1, "b c " * 20), (1, "d"), (None, "a " * 30)], "doc_id bigint, text string")
    out = periods.collapse_runs(docs).collect()
    assert sorted((str(r.doc_id), r.kept) for r in out) == [("1", "a"), ("1", "b c"), ("1", "d"), ("None", "a")]
