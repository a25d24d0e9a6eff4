"""Order exports and replicated application tables: contracts and cursors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from adlake.operators.project import conform, json_to_string
from adlake.spec import MERGE, TableSpec, check_schema_version, disposition_for

# Pinned types of the order columns added by schema 1.2.
ORDER_COLUMNS: dict[str, T.DataType] = {
    "subtotal_eur": T.DecimalType(10, 2),
    "profit_eur": T.DecimalType(10, 2),
    "item_count": T.LongType(),
    "distinct_plan_count": T.LongType(),
    "is_cart": T.BooleanType(),
}

# Replicated tables whose new rows are told by another column than ``id``.
# Tables of one's own are passed with their cursor.
CURSORS = {
    "reports_report": "updated_at",
    "reports_domain": "updated_at",
    "users_application": "updated_at",
    "users_appuser": "updated_at",
    "users_conversions": "updated_at",
    "users_provider": "updated_at",
    "users_providerservice": "updated_at",
    "users_emailinfo": "updated_at",
    "users_pushnotificationinfo": "updated_at",
    "common_app": "updated_at",
    "common_coupon": "updated_at",
    "common_trackablepayload": "created_at",
    "sso_appinstance": "updated_at",
}


def export_spec(
    dataset: str,
    strategy: str,
    key: str | None = None,
    cursor: str | None = None,
    schema_version: str | None = None,
) -> TableSpec:
    """Contract of an exported dataset from its strategy; a full refresh has neither key nor cursor."""
    name = dataset.replace("-", "_")
    check_schema_version(name, schema_version)
    columns = ORDER_COLUMNS if name == "orders" else {}
    full = strategy.startswith("full-refresh")
    if not full and not (key and cursor):
        raise ValueError(f"dataset {name} needs a key and a cursor for strategy {strategy}")
    return TableSpec(
        name,
        () if full else (key,),
        disposition_for(strategy),
        columns,
        cursor="id" if full else cursor,
        order_by=() if full else (cursor,),
    )


def replicated_spec(table: str, cursor: str | None = None) -> TableSpec:
    return TableSpec(table, ("id",), MERGE, cursor=cursor or CURSORS.get(table, "id"))


def replicated_rows(df: DataFrame, json_columns: Sequence[str] = ()) -> DataFrame:
    """Rows of a replicated table with the named nested columns as JSON text."""
    return json_to_string(df, json_columns)


def order_rows(df: DataFrame) -> DataFrame:
    """Order rows with the pinned types; all other columns stay as they are."""
    return conform(df, ORDER_COLUMNS)
