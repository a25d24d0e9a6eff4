"""The corpus pipeline: five stages, each written and read again as the next one's documents."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from adlake.llm import contamination, neardup, packing, pseudonyms, toxicity
from adlake.llm.shared import if_few, shared_folder, small_batches, written

#: Documents of at least this probability go.
TOXIC = 0.7

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _own(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` doesn't have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from all labels of these documents, doesn't reject."""
    small_batches(spark)
    score = _own(docs, "toxic_score")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return docs.withColumn(score, toxicity.scorer(spark, toxicity.fit(docs, labels))).where(F.col(score) < TOXIC).drop(score)


def _numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a number for each id and text: the id, but of an id with several texts only for one of them; the others
    get numbers above all ids. Null where the id is null."""
    slim = docs.where("doc_id is not null").select(F.col("doc_id").alias("i"), F.xxhash64("text").alias("t"))
    several = written(slim.groupBy("i").agg(F.min("t").alias("first"), F.max("t").alias("last")).where("first < last").select("i", "first"), "several")
    if several.isEmpty():
        return docs.withColumn(name, F.col("doc_id"))
    others = slim.join(if_few(several), "i").where("t > first").select("i", "t").distinct()
    top = slim.agg(F.max("i")).first()[0]
    others = written(others.withColumn("k", F.monotonically_increasing_id() + F.lit(top + 1)), "others")
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    own = docs.select(row.alias("row"), F.col("doc_id").alias("i"), F.xxhash64("text").alias("t")).join(if_few(others), ["i", "t"], "left")
    return own.select("row.*", F.coalesce("k", "i").alias(name))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id, and all rows without an id.

    Rows that repeat an id with another text are documents of their own and come after all ids; of rows that repeat an
    id and its text one stays.
    """
    small_batches(spark)
    name = _own(docs, "near_number")
    numbered = _numbered(docs, name)
    decided = written(neardup.near_duplicates(numbered.select(F.col(name).alias("doc_id"), "text")).withColumnRenamed("doc_id", name), "decided")
    dropped = written(decided.where("not kept").select(name).distinct(), "dropped")
    left = numbered.join(if_few(dropped), name, "left_anti").select(numbered.columns)
    repeated = written(decided.where(F.col("kept") & F.col(name).isNotNull()).groupBy(name).count().where("count > 1").select(name), "repeated")
    if repeated.isEmpty():
        return left.drop(name)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    one = left.join(if_few(repeated), name, "left_semi").select(numbered.columns).groupBy(name).agg(F.min_by(row, F.to_json(row)).alias("row"))
    return left.join(if_few(repeated), name, "left_anti").select(docs.columns).unionByName(one.select("row.*"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    small_batches(spark)
    hits = _own(docs, "benchmark_hits")
    found = contamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), into=hits)
    return found.where(F.size(F.col(hits)["start"]) == 0).drop(hits)


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal values replaced; ``n_chars``, where there is one, is that of the new text."""
    small_batches(spark)
    new = docs.withColumn("text", pseudonyms.pseudonymise(F.col("text"))["text"])
    return new.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else new


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences of the documents."""
    small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", pseudonymise),
    ("packing", pack),
]

#: Classifier and tokenizer have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; what each returns is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
