"""Keyed merges, overlays and enrichment as joins over one row per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from adlake.operators.dedupe import orderable, latest
from adlake.operators.quality import raise_if_rows


def _by_keys(rows: DataFrame, others: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    right = others.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)])
    same = [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]
    return rows.join(right, reduce(lambda a, b: a & b, same), how)


def with_keys(rows: DataFrame, others: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key the others have; NULL equals NULL."""
    return _by_keys(rows, others, keys, "left_semi")


def without_keys(rows: DataFrame, others: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key the others lack; NULL equals NULL."""
    return _by_keys(rows, others, keys, "left_anti")


def merge_upsert(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """Target with the rows of updated keys replaced whole; NULL is a key value like any other.

    Updates are cut to one row per key first, so no key can be hot in the join; which side
    is small enough to broadcast is left to the sizes Spark sees.
    """
    new = latest(updates, keys, order_by)
    return without_keys(target, new, keys).unionByName(new, allowMissingColumns=True)


_NUMBERS = (T.IntegralType, T.FractionalType)


def merge_report_rows(groups: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Outer union of report groups on the full key; a later group overrides, NULLs included.

    One shuffle for all groups: rows are tagged with their group, each group's row of a key
    is picked by an aggregate, and the picked rows are laid over each other. A group of one number needs no row:
    its greatest value and a mark are picked, and if all are such, they are picked in hash maps, without a sort.
    """
    values = [[c for c in g.columns if c not in keys] for g in groups]
    plain = [len(v) == 1 and isinstance(g.schema[v[0]].dataType, _NUMBERS) for g, v in zip(groups, values, strict=True)]

    def row(names: list[str]) -> Column:
        return F.struct(*(names or [F.lit(True).alias("_seen")]))

    tagged = []
    for i, g in enumerate(groups):
        mine = {f"_g{i}": F.col(f"`{values[i][0]}`") if plain[i] else row(values[i]), f"_m{i}": F.lit(True)}
        none = {f"{c}{j}": F.lit(None) for j in range(len(groups)) for c in ("_g", "_m") if j != i}
        columns = {**none, **mine}
        tagged.append(g.select(*keys, *[columns[f"{c}{j}"].alias(f"{c}{j}") for j, p in enumerate(plain) for c in ("_g", "_m")[: 1 + p]]))
    rows = tagged[0]
    for t in tagged[1:]:
        rows = rows.unionByName(t)
    picked = rows.groupBy(*keys).agg(*[F.max(c).alias(c) for c in rows.columns[len(keys) :]])

    def overlay(name: str) -> Column:
        out = F.lit(None)
        for i, names in enumerate(values):
            if name in names:
                found = F.col(f"_g{i}")
                out = F.when(F.col(f"_m{i}"), found).otherwise(out) if plain[i] else F.when(found.isNotNull(), found[name]).otherwise(out)
        return out.alias(name)

    columns: list[str] = []
    for names in values:
        columns += [n for n in names if n not in columns]
    return picked.select(*keys, *[overlay(n) for n in columns])


SALTS = 64
#: Ids that the sketch may name. Only their attributes are copied, so there are at most SALTS * MOST_HOT copies.
MOST_HOT = 64


def hot_ids(df: DataFrame, key: str, share: float) -> list:
    """Ids that hold about ``share`` of the rows or more, by a sketch of the frequent ones; NULL is not among them."""
    name = "`" + key.replace("`", "``") + "`"
    found = df.filter(F.col(name).isNotNull()).agg(
        F.expr(f"approx_top_k({name}, {MOST_HOT}, {64 * MOST_HOT})").alias("top"), F.count(F.lit(1)).alias("n")
    ).first()
    return [r["item"] for r in found["top"] or [] if r["count"] >= share * found["n"]]


def _salted_join(df: DataFrame, right: DataFrame, key: str, hot: Sequence) -> DataFrame:
    """Left join on ``key`` where the rows of hot ids, and those without an id, are dealt over ``SALTS`` parts.

    The part of a row follows from its values and its partition, so a task that runs again deals it the same way.
    """
    salts = [F.lit(i) for i in range(SALTS)]
    values = [c for c in df.columns if orderable(df.schema[c].dataType)]
    dealt = F.pmod(F.xxhash64(*values) + F.spark_partition_id(), F.lit(SALTS)).cast("int")
    spread = F.col(key).isNull() | F.col(key).isin(*hot)
    copies = F.when(F.col(key).isin(*hot), F.array(*salts)).otherwise(F.array(F.lit(0)))
    left = df.withColumn("_salt", F.when(spread, dealt).otherwise(0))
    return left.join(right.withColumn("_salt", F.explode(copies)), [key, "_salt"], "left").drop("_salt")


def enrich(
    df: DataFrame, extra: DataFrame, key: str, require_all: bool = False, hot_share: float | None = None
) -> DataFrame:
    """Lay the attributes of ``extra`` over the rows by id; where an id matches, they override.

    ``require_all`` fails the whole batch when any id has no match. ``hot_share`` looks for ids of at least that share
    of the rows and salts them on both sides, at the price of one scan of the ids.
    """
    attrs = [c for c in extra.columns if c != key]
    one = latest(extra, [key])
    if require_all:
        raise_if_rows(df.join(one, key, "left_anti").select(key), f"ids without a match on {key}")
    right = one.select(F.col(key), F.struct(*attrs).alias("_extra"))
    joined = df.join(right, key, "left") if hot_share is None else _salted_join(df, right, key, hot_ids(df, key, hot_share))
    hit = F.col("_extra").isNotNull()
    kept = [
        F.when(hit, F.col("_extra")[c]).otherwise(F.col(c)).alias(c) if c in attrs else F.col(c)
        for c in df.columns
    ]
    new = [F.col("_extra")[c].alias(c) for c in attrs if c not in df.columns]
    return joined.select(*kept, *new)


KEYS_A_TASK = 1_000_000


def missing_keys(a: DataFrame, b: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Ids of A that B lacks, and the reverse; rows that repeat an id all count.

    Both sides are dealt by id to as many tasks as their rows ask for, so what a task holds does not grow with them; no side
    is broadcast, whatever its files' size promises.
    """
    n = max(a.sparkSession.sparkContext.defaultParallelism, -(-(a.count() + b.count()) // KEYS_A_TASK))
    a, b = (rows.select(key).repartition(n, key) for rows in (a, b))
    return a.join(b.distinct().hint("merge"), key, "left_anti"), b.join(a.distinct().hint("merge"), key, "left_anti")


def children_of(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose parent was loaded."""
    ids = parents.select(F.col(parent_key).alias(child_key))
    return children.join(ids, child_key, "left_semi")


def apply_backfill(base: DataFrame, staged: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Fill only the new columns of existing rows; no row is added, no old column changes.

    A row without a staged one keeps the values it has. Staged rows that repeat an id are cut to the
    greatest, so none of them multiplies a row.
    """
    staged = latest(staged.select(key, *cols), [key])
    right = staged.select(F.col(key), F.struct(*cols).alias("_staged"))
    joined = base.join(right, key, "left")
    hit = F.col("_staged").isNotNull()

    def filled(c: str) -> Column:
        staged_value = F.col("_staged")[c]
        if c not in base.columns:
            return staged_value.alias(c)
        return F.when(hit, staged_value).otherwise(F.col(c)).alias(c)

    old = [c for c in base.columns if c not in cols]
    return joined.select(*old, *[filled(c) for c in cols])
