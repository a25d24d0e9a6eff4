"""Snapshot differences: which rows are new or changed since the last committed state."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from adlake.functions.text import fingerprint
from adlake.operators.dedupe import latest
from adlake.operators.merge import enrich, merge_upsert

REFRESH_MODES = ("auto", "incremental", "full")

# The light fields whose change makes a creative worth reading again.
LIGHT_FIELDS = ("id", "name", "status", "effective_object_story_id")


def refresh_mode(requested: str, has_state: bool, incomplete: bool) -> str:
    """Full when asked for, when there is nothing to compare with, or to repair a broken full run."""
    if requested not in REFRESH_MODES:
        raise ValueError(f"refresh mode must be one of {', '.join(REFRESH_MODES)}; got {requested!r}")
    return "full" if requested == "full" or not has_state or incomplete else "incremental"


def with_fingerprint(df: DataFrame, fields: Sequence[str] = LIGHT_FIELDS) -> DataFrame:
    return df.withColumn("fingerprint", fingerprint(fields))


def changed_rows(
    light: DataFrame, state: DataFrame, keys: Sequence[str], fields: Sequence[str] = LIGHT_FIELDS
) -> DataFrame:
    """Rows whose fingerprint is not the stored one; ``state`` has the keys and ``fingerprint``. NULL is a key like any other."""
    own = [f"_key{i}" for i in range(len(keys))]
    old = state.select(*[F.col(k).alias(o) for k, o in zip(keys, own, strict=True)], F.col("fingerprint").alias("_old"))
    same = [F.col(k).eqNullSafe(F.col(o)) for k, o in zip(keys, own, strict=True)]
    joined = with_fingerprint(light, fields).join(old, reduce(lambda a, b: a & b, same), "left")
    return joined.filter(~F.col("fingerprint").eqNullSafe(F.col("_old"))).drop("_old", *own)


def hydrate(changed: DataFrame, heavy: DataFrame, key: str) -> DataFrame:
    """Wide attributes of the changed rows only; an id that cannot be found fails them all."""
    return enrich(changed, heavy, key, require_all=True)


def next_state(state: DataFrame, emitted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """State after the emitted rows were stored; rows that were not emitted keep theirs."""
    new = latest(emitted.select(*keys, "fingerprint"), keys)
    return merge_upsert(state.select(*keys, "fingerprint"), new, keys)
