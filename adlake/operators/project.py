"""Projections, filters, tags, schema conformance and nested-list tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T


def select_fields(df: DataFrame, fields: Sequence[str], strict: bool = True) -> DataFrame:
    """The named columns; unless strict, a column the data lacks becomes NULL text."""
    if strict:
        return df.select(*fields)
    have = set(df.columns)
    return df.select(*[F.col(f) if f in have else F.lit(None).cast("string").alias(f) for f in fields])


def filter_status(df: DataFrame, states: Sequence[str], column: str = "effective_status") -> DataFrame:
    """Rows in one of the states; no states means no filter."""
    return df.filter(F.col(column).isin(*states)) if states else df


def exclude_value(df: DataFrame, column: str, value: Any) -> DataFrame:
    return df.filter(F.col(column) != F.lit(value))


def recent(
    df: DataFrame, column: str, days: int, today: Any = None, limit: int | None = None, order_by: Sequence[str] = ()
) -> DataFrame:
    """Rows of the last ``days`` days before ``today`` (that day excluded); with a ``limit`` the first so many by ``order_by``."""
    day = F.current_date() if today is None else F.lit(today).cast("date")
    at = F.col(column)
    rows = df.filter((at >= F.date_sub(day, days).cast("timestamp_ntz")) & (at < day.cast("timestamp_ntz")))
    if limit is None:
        return rows
    return rows.orderBy(*(order_by or [column])).limit(limit)


def exclude_entities(df: DataFrame, column: str, skip: Iterable[Any] | DataFrame) -> DataFrame:
    """Rows of entities that are not in ``skip``: a list from configuration, or a table."""
    if isinstance(skip, DataFrame):
        return df.join(skip.select(F.col(skip.columns[0]).alias(column)).distinct(), column, "left_anti")
    values = list(skip)
    return df.filter(~F.col(column).isin(*values)) if values else df


def tag(df: DataFrame, **constants: Any) -> DataFrame:
    """Add constant columns; one that exists already is overwritten."""
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def project_dimension(df: DataFrame, paths: Mapping[str, str]) -> DataFrame:
    """Small dimension tables: struct paths to flat names, unset fields stay NULL."""
    return df.select(*[F.col(path).alias(name) for name, path in paths.items()])


def report_mapping(df: DataFrame, columns: Sequence[tuple[str, Column]]) -> DataFrame:
    """A report as one projection of (name, expression) pairs."""
    return df.select(*[c.alias(name) for name, c in columns])


def ensure_columns(df: DataFrame, names: Sequence[str], to: str = "string") -> DataFrame:
    """Add the columns a file's header lacks as NULL."""
    missing = [n for n in names if n not in df.columns]
    return df.withColumns({n: F.lit(None).cast(to) for n in missing}) if missing else df


def conform(df: DataFrame, columns: Mapping[str, T.DataType], mode: str = "evolve") -> DataFrame:
    """Hold a table to its declared column types.

    ``evolve`` casts or adds the declared columns and leaves all others as they are;
    ``exact`` keeps the declared columns only; ``strict`` also fails when one is missing.
    """
    if mode not in ("evolve", "exact", "strict"):
        raise ValueError(f"unknown mode {mode!r}")
    missing = [c for c in columns if c not in df.columns]
    if mode == "strict" and missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")

    def typed(name: str, to: T.DataType) -> Column:
        value = F.col(name) if name in df.columns else F.lit(None)
        return value.cast(to).alias(name)

    declared = {c: typed(c, t) for c, t in columns.items()}
    if mode != "evolve":
        return df.select(*declared.values())
    kept = [declared.get(c, F.col(c)) for c in df.columns]
    return df.select(*kept, *[declared[c] for c in missing])


def additive_only(old: T.StructType, new: T.StructType) -> list[str]:
    """Names of the columns a schema change adds; any change to an existing one is an error."""
    types = {f.name: f.dataType for f in new.fields}
    for f in old.fields:
        if types.get(f.name) != f.dataType:
            raise ValueError(f"column {f.name} changes from {f.dataType} to {types.get(f.name)}")
    return [f.name for f in new.fields if f.name not in old.names]


def json_to_string(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Nested columns as JSON text; columns that are text already stay."""
    nested = (T.StructType, T.ArrayType, T.MapType, T.VariantType)
    return df.withColumns(
        {c: F.to_json(c) for c in cols if c in df.columns and isinstance(df.schema[c].dataType, nested)}
    )


def child_table(df: DataFrame, keys: Sequence[str], field: str, outer: bool = False) -> DataFrame:
    """A list column as its own table: parent key, list index, value."""
    explode = F.posexplode_outer if outer else F.posexplode
    return df.select(*keys, explode(field).alias("list_idx", "value"))


def explode_catalogue(df: DataFrame, field: str) -> DataFrame:
    """A list of described things in a metadata document as a table."""
    return df.select(F.explode(field).alias("m")).select("m.*")


def union_rows(dfs: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column one input lacks is NULL there."""
    out = dfs[0]
    for df in dfs[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out
