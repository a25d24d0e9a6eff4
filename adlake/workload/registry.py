"""Names of the registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL that must give the same rows."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ROWS_A_FILE = 200_000


def landing_files(rows: DataFrame) -> int:
    """Files that rows are landed in: their number follows the rows, so no file, and no task that writes or reads one, does."""
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // ROWS_A_FILE))


def dealt(rows: DataFrame, by: str | None = None) -> DataFrame:
    """Rows in as many parts; by ranges of a column, or evenly."""
    return rows.repartition(landing_files(rows)) if by is None else rows.repartitionByRange(landing_files(rows), by)


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The files of a table as a stream; a table is one file or a folder of files."""
    path = f"{sf_dir}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(hadoop_path).isFile():
        # A file source watches folders.
        return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    return reader.parquet(path)


def props_k() -> Column:
    """The number inside the ``props`` text of an event."""
    return F.regexp_extract("props", "([0-9]+)", 1).cast("bigint")


PROPS_K_SQL = "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT)"


def money(c: str | Column) -> Column:
    """Exact two-digit decimal, so that sums do not depend on their order."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")
