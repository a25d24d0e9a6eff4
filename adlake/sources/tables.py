"""Table scans: incremental pulls, many tables at once, snapshots."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from adlake.operators.incremental import capped, incremental
from adlake.operators.project import union_rows
from adlake.spec import TableSpec


def pull_increment(
    table: DataFrame, spec: TableSpec, last: Any = None, limit: int | None = None, inclusive: bool = False
) -> DataFrame:
    """Rows of a source table past the mark, all of them unless a cap is asked for.

    A cap takes the oldest rows and never parts rows of one cursor value, so the next run can
    go on from the greatest value that was read. ``inclusive`` reads the mark's own value again.
    """
    rows = incremental(table, spec.cursor, last, inclusive)
    return rows if limit is None else capped(rows, spec.cursor, limit)


def read_jdbc_increment(
    spark: SparkSession,
    url: str,
    table: str,
    spec: TableSpec,
    last: Any = None,
    limit: int | None = None,
    properties: Mapping[str, str] | None = None,
    split: tuple[str, int, int, int] | None = None,
) -> DataFrame:
    """Incremental scan of a database table; the mark is pushed into the database's query.

    ``split`` (column, lower, upper, parts) reads the table in parallel; the bounds only
    place the cuts, no row is left out.
    """
    options: dict[str, Any] = {"url": url, "dbtable": table, "fetchsize": 4000, **(properties or {})}
    if split is not None:
        column, lower, upper, parts = split
        options |= {
            "partitionColumn": column,
            "lowerBound": lower,
            "upperBound": upper,
            "numPartitions": parts,
        }
    return pull_increment(spark.read.format("jdbc").options(**options).load(), spec, last, limit)


def read_entities(spark: SparkSession, paths: Mapping[str, str], label: str = "entity") -> DataFrame:
    """Landed files of many accounts or apps in one scan, each row labelled with its entity."""
    by_path = list(paths.items())
    rows = spark.read.parquet(*[p for _, p in by_path])
    path = F.col("_metadata.file_path")
    # The longest folder that fits names the entity, so nested folders do not clash.
    ordered = sorted(by_path, key=lambda e: len(e[1]), reverse=True)
    name = F.coalesce(*[F.when(path.contains(f"{p.rstrip('/')}/"), F.lit(e)) for e, p in ordered])
    return rows.withColumn(label, name)


def combine_entities(parts: Mapping[str, DataFrame], label: str = "entity") -> DataFrame:
    """Rows of several entities that were read apart, as one load."""
    return union_rows([df.withColumn(label, F.lit(name)) for name, df in parts.items()])

