"""Carry values forward over an ordered log without putting the log into one task."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

BUCKET_BITS = 16


@dataclass(frozen=True)
class Carry:
    """Column ``out``: the last non-NULL ``value`` so far, within equal ``by`` columns."""

    value: Column
    out: str
    by: tuple[str, ...] = ()


def carry_forward(df: DataFrame, seq: str, carries: Sequence[Carry], bits: int = BUCKET_BITS, inclusive: bool = True) -> DataFrame:
    """Add the carried columns; a row sees its own value unless ``inclusive`` is off.

    The log is shuffled once, into ranges of ``2**bits`` of the unique ``seq``, and each range is scanned in
    its own group. One aggregate sums a range up for all carries: its last values, by the ``by`` columns, of which
    there is one set. Only these summaries, a row for each range and set of ``by`` values, are scanned in one order; packed
    to one row a range, they are joined to the ranges.

    A log of 2**40 messages has 2**24 ranges. A value should be of fixed
    width, such as a number that stands for a long text, so that they are summed up in hash maps.
    """
    by = next((list(c.by) for c in carries if c.by), [])
    if any(c.by and list(c.by) != by for c in carries):
        raise ValueError("the carries of one pass have one set of columns to go by")
    named = list(enumerate(carries))
    rows = df.withColumn("_slot", F.shiftright(F.col(seq), bits)).withColumns({f"_v{i}": c.value for i, c in named})
    reach = Window.currentRow if inclusive else -1

    out = rows
    for i, c in named:
        so_far = Window.partitionBy("_slot", *c.by).orderBy(seq).rowsBetween(Window.unboundedPreceding, reach)
        out = out.withColumn(f"_v{i}", F.last(f"_v{i}", ignorenulls=True).over(so_far))

    def at(i: int) -> Column:
        return F.when(F.col(f"_v{i}").isNotNull(), F.col(seq))

    heads = rows.groupBy("_slot", *by).agg(*[x for i, _ in named for x in (F.max_by(f"_v{i}", at(i)).alias(f"_h{i}"), F.max(at(i)).alias(f"_s{i}"))])
    # Earlier ranges: of a carry without ``by``, all of their rows; of another, those of equal ``by``.
    every = Window.orderBy("_slot").rangeBetween(Window.unboundedPreceding, -1)
    equal = Window.partitionBy(*by).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.withColumns({f"_i{i}": F.max_by(f"_h{i}", f"_s{i}").over(every) for i, c in named if not c.by})
    heads = heads.withColumns({f"_i{i}": F.last(f"_h{i}", ignorenulls=True).over(equal) for i, c in named if c.by})
    packed = [F.any_value(f"_i{i}").alias(f"_i{i}") for i, c in named if not c.by]
    if by:
        entry = F.struct(F.struct(*by).alias("k"), F.struct(*[f"_i{i}" for i, c in named if c.by]).alias("v"))
        packed.append(F.map_from_entries(F.collect_list(entry)).alias("_by"))
    joined = out.join(heads.groupBy("_slot").agg(*packed), "_slot", "left")
    mine = F.element_at("_by", F.struct(*by)) if by else None
    return joined.select(
        *df.columns, *[F.coalesce(f"_v{i}", mine[f"_i{i}"] if c.by else F.col(f"_i{i}")).alias(c.out) for i, c in named]
    )
