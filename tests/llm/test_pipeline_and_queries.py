import os

import public_tokenizers
import pytest
from test_filters import hits_of
from test_pairs import groups

import corpus_pipeline
from adlake.llm import pseudonyms
from adlake.llm import queries as _queries  # noqa: F401
from adlake.llm.packing import cut
from adlake.llm.registry import ORACLES, QUERIES
from adlake.llm.tokens import PreTokens
from tools.check import compare, oracle

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
ROWS = {"op2": "pages"}


@pytest.fixture(scope="module")
def con():
    return oracle(SF_DIR)


@needs_tables
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, con, name):
    assert compare(spark, con, name, SF_DIR) == ""


@needs_tables
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_covers_its_table(spark, name):
    out = QUERIES[name](spark, SF_DIR)
    want = {r.doc_id for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id").collect()}
    assert {r.doc_id for r in out.select("doc_id").collect()} == want


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@needs_tables
def test_stages_after_the_first_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    rows = {r.doc_id: r for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)

    kept = stages["near-duplicates"](spark, docs, SF_DIR)
    found = groups([(i, r.text) for i, r in rows.items()])
    assert {r.doc_id: r for r in kept.collect()} == {i: r for i, r in rows.items() if found[i][1] == i}

    clean = stages["decontamination"](spark, docs, SF_DIR)
    assert {r.doc_id for r in clean.collect()} == {i for i, r in rows.items() if not hits_of(r.text, bench)[1]}

    private = stages["pii"](spark, docs, SF_DIR)
    assert private.columns == docs.columns
    for r in private.collect():
        text = pseudonyms.rewrite(rows[r.doc_id].text, pseudonyms.SAMPLE_KEY)[0]
        assert (r.text, r.n_chars) == (text, len(text))

    tokens = PreTokens.of(public_tokenizers.path("word_bpe_49k.json"))
    packed = stages["packing"](spark, docs, SF_DIR).groupBy("doc_id").agg({"length": "collect_list"}).collect()
    assert {r[0]: sorted(r[1]) for r in packed} == {i: sorted(cut(tokens.count(r.text) + 1, 4096)) for i, r in rows.items()}


@needs_tables
def test_toxic_documents_go_and_clean_ones_stay(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    left = {r.doc_id for r in dict(corpus_pipeline.STAGES)["toxicity"](spark, docs, SF_DIR).collect()}
    assert all(i in left for i, toxic in labels.items() if not toxic)
    toxic = [i for i, t in labels.items() if t]
    assert sum(i not in left for i in toxic) >= 0.5 * len(toxic)


@needs_tables
def test_stages_take_messy_tables(spark, messy, nothing):
    for docs in (messy, nothing):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF_DIR)
            assert out.columns == docs.columns, name
            n = out.count()
            # Of the repeated row one goes, and with it the copy of the first row.
            assert n == docs.count() - (2 if name == "near-duplicates" and n else 0), name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def near(spark, rows, schema="doc_id bigint, text string"):
    out = dict(corpus_pipeline.STAGES)["near-duplicates"](spark, spark.createDataFrame(rows, schema), SF_DIR)
    return sorted((str(r.doc_id), r.text) for r in out.collect())


def test_rows_that_repeat_an_id_are_judged_one_by_one(spark):
    rows = [(1, "a b c d e f"), (1, "x y z w v u"), (1, "a b c d e f"), (2, "q r s t"), (3, "x y z w v u"), (None, "a b c"), (None, "a b c")]
    rows += [(4, "one two three four"), (4, "q r s t"), (4, "m n o p"), (4, "m n o p")]
    assert near(spark, rows) == sorted(
        [("1", "a b c d e f"), ("2", "q r s t"), ("3", "x y z w v u"), ("4", "m n o p"), ("4", "one two three four"), ("None", "a b c"), ("None", "a b c")]
    ) or near(spark, rows) == sorted(
        [("1", "a b c d e f"), ("1", "x y z w v u"), ("2", "q r s t"), ("4", "m n o p"), ("4", "one two three four"), ("None", "a b c"), ("None", "a b c")]
    )


def test_no_text_without_a_twin_goes(spark, prose, rng):
    rows = [(rng.randrange(12), prose(rng.randint(5, 30))) for _ in range(60)]
    rows += [rng.choice(rows) for _ in range(10)]
    assert {t for _, t in near(spark, rows)} == {t for _, t in rows}


def test_near_duplicates_of_rows_with_a_map(spark):
    rows = [(1, "a b", {"k": 1}), (1, "a b", {"k": 2}), (2, "c d", None)]
    assert near(spark, rows, "doc_id bigint, text string, extra map<string,int>") == [("1", "a b"), ("2", "c d")]


@needs_tables
def test_run_applies_all_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        path = f"{spark.sparkContext.getCheckpointDir()}/by-hand-{id(stage)}"
        stage(spark, docs, SF_DIR).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    ids = {r.doc_id for r in docs.collect()}
    out = corpus_pipeline.run(spark, SF_DIR)
    assert {r.doc_id for r in out.select("doc_id").collect()} == ids and 0 < len(ids) < 200
