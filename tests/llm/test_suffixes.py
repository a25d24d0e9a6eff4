"""Repeated byte strings against a search over all of them, and the array functions against plain ones."""

import numpy as np
import pytest

from adlake.llm import suffixes


def removed(rows, depth=50):
    least = {}
    for i, t in rows:
        data = (t or "").encode()
        for k in range(len(data) - depth + 1):
            if i is not None:
                least[data[k : k + depth]] = min(i, least.get(data[k : k + depth], i))
    out = []
    for i, t in rows:
        data, gone = (t or "").encode(), set()
        for k in range(len(data) - depth + 1):
            if i is not None and least[data[k : k + depth]] < i:
                gone.update(range(k, k + depth))
        spans = sum(k - 1 not in gone for k in gone)
        out.append((str(i), len(data), len(gone), spans, bytes(b for k, b in enumerate(data) if k not in gone)))
    return sorted(out)


def answer(docs):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffixes.remove_repeats(docs).collect())


def sharing(prose, rng):
    """Documents that share passages of about the depth and more, whole texts, and stretches of one sign."""
    passages = [prose(n)[: rng.choice([49, 50, 51, 120, 400])] for n in [30, 30, 40, 60, 100, 150, 200] * 2]
    rows = []
    for _ in range(70):
        parts = [prose(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            a = rng.randrange(max(1, len(p) - 55))
            parts += [p[a : a + rng.randint(45, 300)], prose(rng.randint(0, 6)), rng.choice(["", "é日本" * 9, "=" * rng.randint(1, 90)])]
        rows.append((rng.randrange(10**6), "".join(parts)))
    rows += [(10**7 + i, rows[0][1]) for i in range(6)] + [(10**8, passages[4]), (10**8, passages[4]), (10**8, passages[5] + "!")]
    return rows + [(i, "boilerplate that stands in all of them, " + prose(8)) for i in range(50, 90)]


@pytest.mark.parametrize("hot", [suffixes.HOT_PLACES, 3])
def test_bytes_of_repeated_strings_go(spark, prose, rng, hot, monkeypatch):
    monkeypatch.setattr(suffixes, "HOT_PLACES", hot)
    rows = sharing(prose, rng)
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    assert answer(docs) == removed(rows)


def test_in_batches_of_few_rows(spark, prose, rng):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, 3)
    try:
        rows = sharing(prose, rng)
        assert answer(spark.createDataFrame(rows, "doc_id bigint, text string")) == removed(rows)
    finally:
        spark.conf.set(name, before)


def test_long_texts_in_stretches(spark, prose, rng, monkeypatch):
    rows = [(k, prose(rng.randint(100, 400))) for k in range(5)]
    rows += [(9, rows[1][1][200:900] + rows[3][1]), (10, "x" * 5000), (11, "y" * 700 + "x" * 900)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    import pyarrow as pa

    want = removed(rows)
    assert answer(docs) == want
    monkeypatch.setattr(suffixes, "STRETCH", 300)
    column = pa.array([t for _, t in rows])
    asked = list(suffixes._ask(iter([pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows]), pa.array(range(len(rows))), column], ["id", "h", "text"])]), 5))
    shared = [r for b in suffixes._share(iter(asked), 10**9) for r in b.to_pylist()]
    starts = [sorted(x for r in shared if r["h"] == k for x in r["starts"]) for k in range(len(rows))]
    sent = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows]), pa.array(range(len(rows))), column, pa.array(starts, pa.list_(pa.int32()))], ["id", "h", "text", "starts"])
    spans = [r for b in suffixes._find(suffixes._send(iter([sent]), 5, 3, np.zeros(0, np.uint64))) for r in b.to_pylist()]
    gone = {i: set() for i, _ in rows}
    for r in spans:
        for a, b in zip(r["low"], r["high"], strict=True):
            gone[r["id"]].update(range(a, b))
    assert {str(i): len(g) for i, g in gone.items()} == {w[0]: w[2] for w in want}


def test_messy_tables(spark, messy, nothing):
    docs = messy.where("doc_id is null or doc_id <> 6").unionByName(spark.createDataFrame([(6, "tail " * 100), (8, "tail " * 40 + "end")], "doc_id bigint, text string"), allowMissingColumns=True)
    assert answer(docs) == removed([(r.doc_id, r.text) for r in docs.collect()])
    assert answer(nothing) == []


def test_nearest_smaller_values(rng):
    for n in (0, 1, 2, 50, 400):
        v = np.array([rng.randrange(6) for _ in range(n)], np.int64)
        before, after = suffixes._smaller(v)
        for i in range(n):
            assert before[i] == max((j for j in range(i) if v[j] < v[i]), default=-1)
            assert after[i] == min((j for j in range(i + 1, n) if v[j] < v[i]), default=-1)


def test_longest_previous_factors(rng):
    text = "".join(rng.choice("ab") for _ in range(150)) * 2 + "a" * 120 + "".join(rng.choice("ab") for _ in range(300))
    data = np.frombuffer(text.encode(), np.uint8)
    at = np.arange(len(data) - suffixes.DEPTH + 1)
    owner = np.sort(np.array([rng.randrange(9) for _ in at]))
    got = suffixes.previous_factors(data, at, owner)

    def common(i, j):
        return next((k for k in range(suffixes.DEPTH) if data[i + k] != data[j + k]), suffixes.DEPTH)

    assert list(got) == [max((common(i, j) for j in at if owner[j] < owner[i]), default=0) for i in at]


def test_string_hashes_are_those_of_the_bytes(rng):
    data = np.array([rng.randrange(3) for _ in range(400)], np.uint8)
    for size, h in zip((16, 50, 1, 7), suffixes.string_hashes(data, 16, 50, 1, 7), strict=True):
        seen = {}
        for k in range(len(data) - size + 1):
            assert seen.setdefault(data[k : k + size].tobytes(), h[k]) == h[k]
        assert len(set(seen.values())) == len(seen) and len(h) == len(data) - size + 1


def test_buckets_answer_groups_of_documents(spark, prose, rng, monkeypatch):
    """A document's places come back in one row, whatever the number of buckets."""
    rows = sharing(prose, rng) + [(2 * 10**8 + k, prose(60) + prose(4) * 8) for k in range(900)]
    kept = []
    write = suffixes.written
    monkeypatch.setattr(suffixes, "written", lambda df, name: kept.append(write(df, name)) or kept[-1])
    monkeypatch.setattr(suffixes, "MINIMISER_BUCKET", 1 << 12)
    monkeypatch.setattr(suffixes, "PIECE_BUCKET", 1 << 12)
    assert answer(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)) == removed(rows)
    buckets = sum(len(t or "") for _, t in rows) // (1 << 12)
    back = kept[0].where("id is not null")
    assert buckets > 40 and back.count() == back.select("id", "h").distinct().count() > 100


def batch_of(rows, **more):
    import pyarrow as pa

    columns = {"id": pa.array([i for i, _ in rows], pa.int64()), "h": pa.array([1000 + k for k in range(len(rows))], pa.int64()), "text": pa.array([t for _, t in rows])}
    return pa.RecordBatch.from_pydict(columns | more)


def test_small_batches_are_sent_together(prose):
    import pyarrow as pa

    rows = [(k, prose(40)) for k in range(60)]
    batches = [batch_of(rows[k : k + 2]) for k in range(0, 60, 2)]
    assert sum(b.num_rows for b in suffixes._ask(iter(batches), 5)) <= 6
    every = [list(range(len(t))) for _, t in rows]
    wanted = [batch_of(rows[k : k + 2], starts=pa.array(every[k : k + 2], pa.list_(pa.int32()))) for k in range(0, 60, 2)]
    assert sum(b.num_rows for b in suffixes._send(iter(wanted), 5, 7, np.zeros(0, np.uint64))) <= 8


def test_documents_dealt_to_groups_come_back_whole(rng):
    import pyarrow as pa

    want, batches = {}, []
    for _ in range(9):
        docs = sorted({(rng.randrange(40), rng.choice([-(1 << 62), 5, 1 << 61])) for _ in range(30)})
        lows = [sorted(rng.randrange(1 << rng.choice([8, 31])) for _ in range(rng.randint(1, 5))) for _ in docs]
        for d, low in zip(docs, lows, strict=True):
            want.setdefault(d, []).extend((x, x + 50) for x in low)
        lists = [pa.array([[x + k if x + k < 1 << 31 else x for x in low] for low in lows], pa.list_(pa.int32())) for k in (0, 50)]
        batches.append(pa.RecordBatch.from_arrays([pa.array([d[0] for d in docs]), pa.array([d[1] for d in docs]), *lists], schema=suffixes._SPANS))
    dealt = pa.Table.from_batches(suffixes._deal(iter(batches), 2, suffixes._SPANS_DEALT))
    assert len(dealt) <= 18
    got = [r for b in suffixes._gather(iter(dealt.sort_by("group").combine_chunks().to_batches(max_chunksize=4)), suffixes._SPANS) for r in b.to_pylist()]
    assert len(got) == len(want)
    for r in got:
        spans = [(x, x + 50 if x + 50 < 1 << 31 else x) for x, _ in want[r["id"], r["h"]]]
        assert sorted(zip(r["low"], r["high"], strict=True)) == sorted(spans)


def test_pieces_hold_every_place_once(rng, monkeypatch):
    texts = ["".join(rng.choice("ab ") for _ in range(rng.choice([0, 3, 49, 50, 51, 300, 900]))) for _ in range(40)] + ["", "x" * 400, ""]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    want = suffixes.cut_places(data, offsets)
    (gram,) = suffixes.string_hashes(data, suffixes.GRAM)
    places = [(t, k) for t, x in enumerate(texts) for k in range(len(x) - suffixes.DEPTH + 1)]
    got = []
    for text, at, count, mini in zip(*want, strict=True):
        assert 1 <= count <= suffixes.RUN
        for k in range(at, at + count):
            assert mini == min(gram[k : k + suffixes.DEPTH - suffixes.GRAM + 1])
            got.append((text, k - offsets[text]))
    assert got == places
    names = suffixes._names(data, want[1], want[2])
    for block in (64, 100, 1000):
        monkeypatch.setattr(suffixes, "BLOCK", block)
        assert all((a == b).all() for a, b in zip(want, suffixes.cut_places(data, offsets), strict=True))
        assert (names == suffixes._names(data, want[1], want[2])).all() and (gram == suffixes.string_hashes(data, suffixes.GRAM)[0]).all()


def test_order_of_values(rng):
    for bits in (3, 40, 64):
        # Some differ in their low bits only, which a place covers.
        values = np.array([(rng.randrange(1 << bits) >> 2 << 2 if k % 3 else 7) ^ rng.randrange(4) for k in range(900)], np.uint64) & np.uint64((1 << bits) - 1)
        assert list(suffixes._order(values, bits)) == list(np.argsort(values, kind="stable"))
    assert len(suffixes._order(np.zeros(0, np.uint64))) == 0
