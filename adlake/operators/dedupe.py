"""One row per key: latest, first, and checks for duplicates.

All of them aggregate with a map-side combine, so a key that holds a third of the rows is
reduced to one row per task before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T


def orderable(t: T.DataType) -> bool:
    if isinstance(t, (T.MapType, T.VariantType)):
        return False
    if isinstance(t, T.ArrayType):
        return orderable(t.elementType)
    if isinstance(t, T.StructType):
        return all(orderable(f.dataType) for f in t.fields)
    return True


def _one_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], last: bool) -> DataFrame:
    order = [c for c in order_by if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    if not order and not rest:
        return df.select(*keys).distinct()
    ties = [c for c in rest if orderable(df.schema[c].dataType)]
    if len(ties) == len(rest):
        # Later columns break ties, so the same input always keeps the same row.
        row = F.struct(*order, *rest)
        pick = F.max(row) if last else F.min(row)
    else:
        row, rank = F.struct(*order, *rest), F.struct(*order, *ties)
        pick = F.max_by(row, rank) if last else F.min_by(row, rank)
    best = df.groupBy(*keys).agg(pick.alias("_row"))
    return best.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """The row with the greatest ``order_by`` per key; NULL is the oldest."""
    return _one_per_key(df, keys, order_by, last=True)


def first_wins(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """The row with the smallest ``order_by`` per key."""
    return _one_per_key(df, keys, order_by, last=False)


def drop_seen(df: DataFrame, key: str, order_by: Sequence[str] = ()) -> DataFrame:
    """Rows of re-read pages once per id; rows without an id are all kept."""
    with_id = first_wins(df.filter(F.col(key).isNotNull()), [key], order_by)
    return with_id.unionByName(df.filter(F.col(key).isNull()))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise when a key repeats, naming a few of the repeated keys."""
    found = duplicate_keys(df, keys).limit(5).collect()
    if found:
        raise ValueError(f"duplicate keys {list(keys)}: {[tuple(r[k] for k in keys) for r in found]}")


def key_collisions(df: DataFrame, keys: Sequence[str], wide_keys: Sequence[str]) -> DataFrame:
    """Keys that stand for several rows of the wider key, i.e. where a merge loses rows."""
    per_wide = df.select(*keys, *[c for c in wide_keys if c not in keys]).distinct()
    return duplicate_keys(per_wide, keys)
