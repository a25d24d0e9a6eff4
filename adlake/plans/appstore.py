"""App-store analytics: raw text rows with metadata tags, and their typed tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from adlake.operators.project import conform, tag
from adlake.spec import APPEND, TableSpec

_COUNT, _MONEY = T.LongType(), T.DecimalType(18, 2)

# Typed columns of each report table, and the category it is fetched under.
TYPED_COLUMNS: Mapping[str, Mapping[str, T.DataType]] = {
    "app_store_engagement": {
        "Date": T.DateType(),
        "App_Name": T.StringType(),
        "Impressions": _COUNT,
        "Product_Page_Views": _COUNT,
        "Total_Downloads": _COUNT,
        "Conversion_Rate": T.DoubleType(),
    },
    "app_store_commerce": {
        "Date": T.DateType(),
        "App_Name": T.StringType(),
        "Total_Revenue": _MONEY,
        "Paying_Users": _COUNT,
        "Paying_Sessions": _COUNT,
        "Revenue_Per_Paying_User": _MONEY,
    },
    "app_usage": {
        "Date": T.DateType(),
        "App_Name": T.StringType(),
        "Active_Devices": _COUNT,
        "Installations": _COUNT,
        "Deletions": _COUNT,
        "Sessions": _COUNT,
        "Crashes": _COUNT,
    },
}
CATEGORIES = {
    "app_store_engagement": "APP_STORE_ENGAGEMENT",
    "app_store_commerce": "COMMERCE",
    "app_usage": "APP_USAGE",
}
META_COLUMNS = ("_app_id", "_app_name", "_group_name", "_report_name", "_granularity")

SPECS = [TableSpec(name, disposition=APPEND, columns=cols) for name, cols in TYPED_COLUMNS.items()]


def raw_rows(df: DataFrame, **meta: str) -> DataFrame:
    """Report rows as text plus their metadata (``app_id``, ``app_name``, ...)."""
    return tag(df, **{f"_{k}": v for k, v in meta.items()})


def _underscored(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(c.replace(" ", "_")) for c in df.columns])


def typed_rows(df: DataFrame, table: str, dedupe: bool = True, keep: Sequence[str] | None = None) -> DataFrame:
    """Typed table of the raw rows; appended re-runs leave copies, which go here.

    With ``keep``, the columns a report asks for, copies are told by 128 bits of the whole row, so
    that only these columns are shuffled.
    """
    columns = {**TYPED_COLUMNS[table], **{m: T.StringType() for m in META_COLUMNS}}
    typed = conform(_underscored(df), columns, mode="exact")
    if keep is None:
        return typed.distinct() if dedupe else typed
    if not dedupe:
        return typed.select(*keep)
    whole = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in typed.columns]
    row = [F.xxhash64(*whole).alias("_row_a"), F.xxhash64(F.lit("b"), *whole).alias("_row_b")]
    return typed.select(*keep, *row).distinct().drop("_row_a", "_row_b")
