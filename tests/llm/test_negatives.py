"""Hard negatives against scores of all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from adlake.llm import negatives


def mined(rows, is_anchor):
    """All answers by comparing everything; rows are (id, label, vector)."""
    rows = [(i, l, [math.floor(256 * x) for x in v]) for i, l, v in rows if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for a, label, v in [r for r in rows if is_anchor(r[0])]:
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=False)), i, l == label) for i, l, w in rows if i != a)
        for minus, p, _ in [s for s in scored if s[2]][:5]:
            fits = [(n, i) for n, i, same in scored if not same and 80 * -minus <= 100 * -n <= 100 * -minus]
            out |= {(a, p, k, i, -minus, -n) for k, (n, i) in enumerate(fits[:5], 1)}
    return out


def answer(spark, rows, block_rows=negatives.BLOCK_ROWS, every=5):
    docs = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>")
    out = negatives.hard_negatives(docs, F.col("vec_id") % every == 0, block_rows=block_rows)
    return [(r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in out.collect()]


def clustered(rng, n, d=8, spread=0.25):
    centres = [[rng.gauss(0, 1) for _ in range(d)] for _ in range(5)]
    rows = []
    for i in range(n):
        c, size = rng.choice(centres), rng.choice([0.01, 0.5, 1, 1, 3])
        rows.append((i, rng.randrange(4), [float(np.float32(size * (x + rng.gauss(0, spread)))) for x in c]))
    return rows


@pytest.mark.parametrize("block_rows", [negatives.BLOCK_ROWS, 17])
def test_equal_to_all_pairs(spark, rng, block_rows, monkeypatch):
    monkeypatch.setattr(negatives, "CHUNK_ROWS", 16)
    rows = clustered(rng, 400)
    got = answer(spark, rows, block_rows)
    assert len(got) == len(set(got)) > 500 and set(got) == mined(rows, lambda i: i % 5 == 0)


def test_ties_go_by_id_and_a_frequent_vector_fills_blocks(spark, rng):
    rows = clustered(rng, 60) + [(1000 + i, i % 3, [0.5, -0.5, 0.25, 0.0, 0.0, 0.0, 0.0, 1.0]) for i in range(200)]
    rng.shuffle(rows)
    assert set(answer(spark, rows, 20)) == mined(rows, lambda i: i % 5 == 0)


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    good = [(k, k % 2, [1.0, 0.1 * k]) for k in range(10)]
    bad = [(None, 0, [1.0, 1.0]), (20, None, [1.0, 1.0]), (25, 0, None), (30, 1, [nan, 1.0]), (31, 1, [1.0, -inf]), (32, 0, [None, 1.0])]
    odd = [(40, 0, []), (41, 1, [0.0, 0.0]), (42, 1, [1.0]), (43, 0, [1.0, 0.2, 5.0]), (44, 0, [-1.0, -1.0])]
    assert set(answer(spark, good + bad + odd)) == mined(good + bad + odd, lambda i: i % 5 == 0) != set()


def test_few_or_no_rows(spark):
    assert answer(spark, []) == []
    assert answer(spark, [(5, 1, [1.0])]) == []
    assert answer(spark, [(5, 1, [1.0]), (6, 2, [1.0])]) == []
    assert answer(spark, [(5, 1, [1.0]), (6, 2, [1.0]), (7, 1, [1.0])]) == [(5, 7, 1, 6, 65536, 65536)]


def test_repeated_ids_and_clashing_columns(spark):
    rows = [(5, 1, [1.0, 0.0]), (5, 1, [1.0, 0.0]), (6, 1, [1.0, 0.5]), (7, 2, [1.0, 0.1]), (7, 2, [1.0, 0.1])]
    docs = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>").selectExpr("*", "1 as block", "2 as id", "3 as score", "4 as anchor")
    out = negatives.hard_negatives(docs, F.col("vec_id") % 5 == 0).collect()
    assert sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id) for r in out) == [(5, 6, 1, 7), (5, 6, 2, 7)]


def test_large_components_are_exact(spark):
    rows = [(0, 1, [2.0**22, 3.0]), (1, 1, [2.0**22, 1.0]), (2, 2, [2.0**22, -1.0]), (3, 2, [2.0**22, 0.99609375])]
    assert set(answer(spark, rows)) == mined(rows, lambda i: i % 5 == 0) != set()


def test_lists_leave_out_what_cannot_reach_the_threshold(rng):
    rows = clustered(rng, 900, spread=0.05)
    vectors = np.array([[math.floor(256 * x) for x in v] for _, _, v in rows], np.int64)
    block = negatives.Block(np.arange(900), np.zeros(900, np.int64), vectors)
    seen = 0
    for anchor in vectors[::30]:
        size = float(np.sqrt((anchor.astype(float) ** 2).sum()))
        scores = vectors @ anchor
        threshold = int(np.sort(scores)[-20])
        rows_ = np.concatenate([block.candidates(k, anchor, size, threshold) for k in range(len(block.chunks))])
        assert set(np.flatnonzero(scores >= threshold)) <= set(block.ids[rows_])
        seen += len(rows_)
    assert seen < 0.6 * 30 * 900
