import random
import re
from collections import Counter, defaultdict
from math import log10

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from adlake.llm import archives, mixing
from adlake.llm.words import LOWER, pieces, texts

WORD = re.compile("[^\x20\x09-\x0d]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def normal(text):
    return " ".join(WORD.findall((text or "").translate(FOLD))).encode() + b"\n"


def test_stream_is_the_normal_text():
    source = ["Hello  World\n", "", None, " \t", "É a", "x" * 50, "end"]
    for limit in (1, 1 << 20):
        for row, piece in pieces(texts(pa.array(source)), limit):
            out, first, length = mixing.stream(piece)
            for k, (a, n) in enumerate(zip(first, length, strict=True)):
                want = normal(source[row + k])
                assert out[a : a + n].tobytes() == want and out[a - mixing.SPAN : a].tobytes() == b"\n" * mixing.SPAN
            keys, number = mixing.places(out, first, length)
            assert (keys[number] == mixing.keys_of(out, first, length)).all() and (np.diff(keys.astype(object)) > 0).all()


def test_places_with_all_kinds_of_bytes():
    rng = random.Random(1)
    source = pa.array(["".join(chr(rng.randrange(0x21, 0x3000)) for _ in range(4000)) for _ in range(3)])
    out = mixing.stream(texts(source))
    keys, number = mixing.places(*out)
    assert (keys[number] == mixing.keys_of(*out)).all()


def learned(rng):
    rand = np.random.default_rng(rng.randrange(10**6))
    code = mixing.huffman(rand.integers(0, 1000, 256))
    slots = int(mixing.BASES[-1])
    weights = rand.normal(0.3, 0.1, (mixing.GATES, len(mixing.ORDERS)))
    return mixing.Model(code, rand.integers(-60, 60, slots).astype(np.int8), rand.integers(0, mixing.GATES, slots).astype(np.uint8), weights, rand.random((255, mixing.STEPS)))


def test_probabilities_of_the_next_byte_sum_to_one(rng):
    model = learned(rng)
    for context in (0, 0x0A0A0A0A0A, 0x6568742061):
        keys = (np.arange(256, dtype=np.uint64) << np.uint64(8 * mixing.SPAN)) | np.uint64(context)
        assert abs((10.0 ** mixing.log10_probability(keys, model)).sum() - 1) < 1e-9


@pytest.fixture
def corpus(spark, prose):
    return spark.createDataFrame([(i, prose(60 + i % 30)) for i in range(400)], "doc_id bigint, text string")


def test_scores_beat_the_base_on_held_out_rows(corpus, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK_BYTES", 40_000)
    out = {r.doc_id: r for r in mixing.score(corpus, F.col("doc_id") % 10 == 0, F.col("doc_id") % 10 == 1).collect()}
    texts_of = {r.doc_id: normal(r.text).decode().split() + ["\n"] for r in corpus.collect()}
    counts = Counter(w for i, ws in texts_of.items() if i % 10 for w in ws)
    total, kinds = sum(counts.values()), len(counts)
    assert len(out) == 400
    for i, ws in texts_of.items():
        r = out[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (i % 10 == 0, len(ws), sum(counts[w] > 0 for w in ws), total)
        assert r.base_score == pytest.approx(sum(log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in ws), abs=1e-6)
    # 36 words of equal chance need 1.56 digits each, which is what the base gives too: the mixture comes near it from bytes alone.
    held = [out[i] for i in out if i % 10 == 0]
    assert sum(r.score for r in held) > 1.1 * sum(r.base_score for r in held)
    known = mixing.score(corpus.limit(0), F.col("doc_id") % 10 == 0, F.col("doc_id") % 10 == 1)
    assert known.count() == 0


def test_scores_do_not_depend_on_the_partition(corpus):
    model_rows = mixing.score(corpus, F.col("doc_id") % 10 == 0, F.col("doc_id") % 10 == 1)
    doubled = corpus.union(corpus.where("doc_id = 0"))
    a = {r.doc_id: r.score for r in model_rows.collect()}
    twice = [r.score for r in mixing.score(doubled, F.col("doc_id") % 10 == 0, F.col("doc_id") % 10 == 1).where("doc_id = 0").collect()]
    assert len(twice) == 2 and twice[0] == twice[1] == pytest.approx(a[0], rel=1e-3)


def test_predictors_learn_all_training_documents(spark, corpus):
    rare = spark.createDataFrame([(1000, "zqxj vwkq " * 5)], "doc_id bigint, text string")
    counts = np.ones(256, np.int64)
    model = mixing.fit(corpus, rare, counts)
    whole = mixing.fit(corpus.union(rare), rare.limit(0), counts)
    assert (model.gate == whole.gate).all() and (model.logit == whole.logit).all()
    assert (model.weights != mixing.START).any()


def digits(text, model, after):
    """log10 of the text's probability, bit by bit; ``after[order][context]`` counts the bytes that came there."""
    total, data = 0.0, b"\n" * mixing.SPAN + normal(text)
    paths = {b: [(int(model.code.node[b, d]), int(model.code.bit[b, d])) for d in range(model.code.depth[b])] for b in range(256)}
    for i in range(mixing.SPAN, len(data)):
        for d, (node, bit) in enumerate(paths[data[i]]):
            x, gate = [], 0
            for k, order in enumerate(mixing.ORDERS):
                context = data[i - order : i]
                if order in mixing.SHORT:
                    key = np.array([int.from_bytes(context, "little") * 0x9FB21C651E98DF25 + order + (node << 48) & (1 << 64) - 1], np.uint64)
                    slot = int(mixing.mix(key)[0]) >> (64 - mixing.SLOTS[k])
                    x.append(model.logit[mixing.BASES[k] + slot] / mixing.SCALE)
                    gate = max(gate, int(model.gate[mixing.BASES[k] + slot]))
                    continue
                here = [(paths[b][d][1], n) for b, n in after[order][context].items() if paths[b][:d] == paths[data[i]][:d]]
                seen, ones = sum(n for _, n in here), sum(n for v, n in here if v)
                x.append(min(max(np.log((ones + 0.4) / (seen - ones + 0.4)), -127 / mixing.SCALE), 127 / mixing.SCALE))
                if seen:
                    gate = max(gate, k * mixing.LEVELS + 1 + sum(seen >= edge for edge in (3, 16, 256)))
            t = float(model.weights[gate] @ x)
            place = (min(max(t, -mixing.LIMIT), mixing.LIMIT) + mixing.LIMIT) * (mixing.STEPS - 1) / (2 * mixing.LIMIT)
            low = min(int(place), mixing.STEPS - 2)
            refined = model.refined[node][low] + (model.refined[node][low + 1] - model.refined[node][low]) * (place - low)
            p = min(max((1 / (1 + np.exp(-t)) + refined) / 2, 1e-6), 1 - 1e-6)
            total += log10(p if bit else 1 - p)
    return total


def test_scores_are_those_of_plain_counts(spark, corpus, monkeypatch):
    """Small chunks, buckets and hands, so that contexts of one bucket come from several tasks and go to several chunks."""
    for name, value in (("CHUNK_BYTES", 30_000), ("BUCKET_BYTES", 20_000), ("HELD", 500), ("MODEL_PIECE", 3_000)):
        monkeypatch.setattr(mixing, name, value)
    fit, models = mixing.fit, []

    def noted(*args):
        models.append(fit(*args))
        return models[-1]

    monkeypatch.setattr(mixing, "fit", noted)
    odd = spark.createDataFrame([(400, "Größe 東京 naïve"), (401, "Größe 東京 zqx"), (402, None), (410, "never seen ~~~~")], "doc_id bigint, text string")
    docs = corpus.unionByName(odd).repartition(5)
    out = {r.doc_id: r for r in mixing.score(docs, F.col("doc_id") % 10 == 0, F.col("doc_id") % 10 == 1).collect()}
    text_of = {r.doc_id: r.text for r in docs.collect()}
    after = {order: defaultdict(Counter) for order in mixing.LONG}
    for i, text in text_of.items():
        if i % 10:
            data = b"\n" * mixing.SPAN + normal(text)
            for at in range(mixing.SPAN, len(data)):
                for order in mixing.LONG:
                    after[order][data[at - order : at]][data[at]] += 1
    (model,) = models
    assert model.contexts.select("bucket").distinct().count() > 3
    for i in (0, 1, 2, 10, 333, 400, 401, 402, 410):
        assert out[i].score == pytest.approx(digits(text_of[i], model, after), rel=1e-5)
        assert out[i].n_bytes == len(normal(text_of[i]))
        assert out[i].bits_per_byte == pytest.approx(-out[i].score / log10(2) / out[i].n_bytes)


def test_what_is_learned_grows_with_the_corpus(spark, corpus):
    """Every distinct context of five bytes is kept with each byte after it, however many there are."""
    counts = np.ones(256, np.int64)
    rng = random.Random(2)
    some = [(i, "".join(rng.choice("abcdefghijklmnop ") for _ in range(400))) for i in range(300)]
    for n in (30, 300):
        model = mixing.fit(spark.createDataFrame(some[:n], "doc_id bigint, text string"), corpus.limit(0), counts)
        kinds = set()
        for _, text in some[:n]:
            data = b"\n" * mixing.SPAN + normal(text)
            kinds |= {data[at - mixing.SPAN : at + 1] for at in range(mixing.SPAN, len(data))}
        assert sum(len(mixing._keys(pa.scalar(bytes(r["keys"])))) for r in model.contexts.collect()) == len(kinds)


def test_only_training_documents_teach_and_some_always_fit_the_mixture(spark, corpus, monkeypatch):
    fit, seen = mixing.fit, []

    def noted(train, aside, byte_counts):
        seen.append((train.count(), aside.count(), byte_counts, fit(train, aside, byte_counts)))
        return seen[-1][-1]

    monkeypatch.setattr(mixing, "fit", noted)
    held = spark.createDataFrame([(1000, "~~~~")], "doc_id bigint, text string")
    assert mixing.score(corpus.union(held), F.col("doc_id") == 1000, F.lit(False)).count() == 401
    ((train, aside, byte_counts, model),) = seen
    assert byte_counts[ord("~")] == 0 < byte_counts[ord("a")]
    assert train + aside == 400 and min(train, aside) > 100 and (model.weights != mixing.START).any()


def test_scores_of_messy_tables(messy):
    for held in (F.col("doc_id") == 1, F.lit(True)):
        out = mixing.score(messy, held, F.col("doc_id") == 6).collect()
        assert len(out) == messy.count()
        for r in out:
            assert r.score < 0 and r.base_score <= 0 and r.n_tokens >= 1
            assert r.doc_id is not None or r.held_out
        assert {r.n_tokens for r in out if r.doc_id in (2, 3, 4)} == {1}


def test_lowering_is_ascii_only():
    assert bytes(LOWER[np.frombuffer("AZ[É".encode(), np.uint8)]).decode() == "az[É"


PAGES = [
    (1, "http://A.example.org/x?y#z", "<p>" + "one " * 40),
    (2, "http://a.example.org/x?y", "<p>" + "one " * 40),
    (3, None, None),
    (4, "https://b.example.com/\r\nX-Evil: 1", "a\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\nb\r\n\r\n" + "é" * 60),
    (5, "http://a.example.org/x?y", "short"),
    (6, "http://a.example.org/x?y", "short"),
    (7, "not a url", ""),
    (7, "not a url", ""),
    (None, "http://a.example.org/x?y", "<p>" + "one " * 40),
    (9, "http://a.example.org/x?y", "\r\n"),
    (10, "http://a.example.org/x?y", "<p>" + "one " * 40),
]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id bigint, url string, html string").selectExpr("*", "'x' as digest", "1 as first", "2 as bytes", "'y' as archive")


def times():
    return F.timestamp_seconds(F.coalesce("page_id", F.lit(100)) + 1_700_000_000)


def test_archives_give_back_what_was_written(spark, pages, tmp_path):
    path = str(tmp_path / "warc")
    archives.write_archives(pages, times(), path)
    out = sorted((tuple(r) for r in archives.read_archives(spark, path, with_payload=True).collect()), key=str)
    assert len(out) == len(PAGES)
    by = {r[0]: r for r in out}
    for page, url, html in PAGES:
        r = by[page]
        body = (html or "").encode()
        assert r[4] == len(body) and r[1] == (url.replace("\r", "%0D").replace("\n", "%0A") if url else None)
        assert r[2] == ((100 if page is None else page) + 1_700_000_000) * 10**6
        assert (r[3], r[6]) == (("revisit", 1) if page in (2, 10) else ("response", None))
        assert r[8] == (None if r[3] == "revisit" else body)


def test_a_damaged_payload_is_found(spark, pages, tmp_path):
    import gzip
    from pathlib import Path

    path = tmp_path / "warc"
    archives.write_archives(pages.limit(1).coalesce(1), times(), str(path))
    (file,) = [p for p in Path(path).iterdir() if p.suffix == ".gz"]
    raw = gzip.decompress(file.read_bytes())
    lines = lambda data: (("x", line) for line in data.split(b"\r\n")[:-1])
    assert len(list(archives.parse(lines(raw), False))) == 1
    with pytest.raises(ValueError, match="damaged"):
        list(archives.parse(lines(raw.replace(b"one one", b"two one")), False))
    with pytest.raises(ValueError, match="cut short"):
        list(archives.parse(lines(raw[:-200]), False))


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 8, 13])
def test_loser_tree_merges_sorted_runs(n):
    rng = random.Random(n)
    runs = [sorted((rng.randrange(20), run, k) for k in range(rng.randint(0, 30))) for run in range(n)]
    assert list(archives.merge(runs)) == sorted(x for r in runs for x in r)


def test_index_orders_and_numbers_all_captures(spark, monkeypatch):
    monkeypatch.setattr(archives, "CAPTURES_PER_RANGE", 40)
    rng = random.Random(4)
    rows = [(i, f"http://h{rng.choice([1, 1, 1, 2, 3])}.org/{rng.choice('ab')}" if i % 50 else None, rng.randrange(50), f"run{i % 7}") for i in range(400)]
    captures = spark.createDataFrame(rows, "page_id bigint, url string, captured bigint, archive string")
    out = archives.merge_index(captures).orderBy("bucket", "position").collect()
    key = lambda r: (r.url_key is not None, r.url_key or "", r.captured, r.page_id)
    assert [key(r) for r in out] == sorted(key(r) for r in out) and len(out) == 400
    seen = Counter()
    for r in out:
        seen[r.url_key] += 1
        assert r.nth == seen[r.url_key]
    assert max(seen.values()) > 80 and len({r.bucket for r in out}) > 5


def test_archives_of_nothing(spark, pages):
    assert archives.archive_round_trip(pages.limit(0), times()).count() == 0


def test_runs_are_merged_as_they_come(rng):
    rows = [(run, (rng.choice("abc"), rng.randrange(9))) for run in range(5) for _ in range(rng.randrange(30))]
    for given in (sorted(rows), rows, rows[::-1], []):
        runs = archives.sorted_runs((run, key, k) for k, (run, key) in enumerate(given))
        assert all(run == sorted(run) and run for run in runs)
        assert list(archives.merge(runs)) == sorted((key, k) for k, (_, key) in enumerate(given))
    assert len(archives.sorted_runs((run, key, 0) for run, key in sorted(rows))) == len({run for run, _ in rows})


def test_the_index_sorts_runs_once(spark, monkeypatch):
    """Captures are sorted before they are dealt out, not after."""
    plans = []
    kept = archives.written
    monkeypatch.setattr(archives, "written", lambda df, name: (plans.append((name, df._jdf.queryExecution().executedPlan().toString())), kept(df, name))[1])
    pages = spark.createDataFrame([(i, f"http://h{i % 3}.org/{i % 5}", f"page {i}") for i in range(40)], "page_id bigint, url string, html string")
    assert archives.archive_round_trip(pages, times()).count() == 40
    assert "Sort [" in dict(plans)["runs"] and "Sort [" not in dict(plans)["index"]
