"""Store statistics: file rows of four kinds to metric tables keyed by dimension."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from adlake.functions.dates import play_date_key
from adlake.functions.numbers import float_or_zero, int_or_zero
from adlake.functions.text import first_non_empty
from adlake.operators.project import ensure_columns, report_mapping
from adlake.spec import MERGE, TableSpec

ROLLING_MONTHS = 3


@dataclass(frozen=True)
class Statistics:
    """Header names that may hold the dimension, and (column, header, kind) of the metrics."""

    dimension_headers: Sequence[str]
    metrics: Sequence[tuple[str, str, str]]


# Headers of the statistics files and the columns they become.
_ALL_DIMENSIONS = ("Country", "Device", "App Version Code", "Carrier", "Language", "Android OS Version")
STATISTICS: Mapping[str, Statistics] = {
    "installs": Statistics(
        _ALL_DIMENSIONS,
        (
            ("daily_device_installs", "Daily Device Installs", "int"),
            ("daily_device_uninstalls", "Daily Device Uninstalls", "int"),
            ("daily_device_upgrades", "Daily Device Upgrades", "int"),
            ("total_user_installs", "Total User Installs", "int"),
            ("daily_user_installs", "Daily User Installs", "int"),
            ("daily_user_uninstalls", "Daily User Uninstalls", "int"),
            ("active_device_installs", "Active Device Installs", "int"),
            ("install_events", "Install events", "int"),
            ("update_events", "Update events", "int"),
            ("uninstall_events", "Uninstall events", "int"),
        ),
    ),
    "crashes": Statistics(
        ("Device", "App Version Code", "Android OS Version"),
        (("daily_crashes", "Daily Crashes", "int"), ("daily_anrs", "Daily ANRs", "int")),
    ),
    "ratings": Statistics(
        _ALL_DIMENSIONS,
        (
            ("daily_average_rating", "Daily Average Rating", "float"),
            ("total_average_rating", "Total Average Rating", "float"),
        ),
    ),
    "store_performance": Statistics(
        (),
        (
            ("store_listing_acquisitions", "Store listing acquisitions", "int"),
            ("store_listing_visitors", "Store listing visitors", "int"),
            ("store_listing_conversion_rate", "Store listing conversion rate", "float"),
        ),
    ),
}
# Columns that only traffic-source files fill, and their headers.
TRAFFIC_COLUMNS = (
    ("traffic_source", "Traffic source"),
    ("search_term", "Search term"),
    ("utm_source", "UTM source"),
    ("utm_campaign", "UTM campaign"),
)
# Dimension of a store-performance file and the header that holds its value.
PERFORMANCE_DIMENSIONS = (("country", "Country / region"), ("traffic_source", "Traffic source"))

KEYS = ("date", "package_name", "dimension_type", "dimension_value")


def specs(wide: bool = False) -> list[TableSpec]:
    """Metric tables. Store performance has columns outside its key: ``wide`` adds them to
    the key, otherwise they decide in order which row of a key stays."""
    out = []
    for kind in STATISTICS:
        extra = tuple(c for c, _ in TRAFFIC_COLUMNS) if kind == "store_performance" else ()
        out.append(
            TableSpec(
                f"google_play_{kind}",
                (*KEYS, *extra) if wide else KEYS,
                MERGE,
                cursor="date",
                order_by=() if wide else extra,
                partition_by=("date",),
            )
        )
    return out


def _performance_dimension(df: DataFrame) -> Column:
    """Value of the file's dimension; ``all`` only where the file has no such column."""
    out: Column | None = None
    for kind, header in PERFORMANCE_DIMENSIONS:
        value = F.col(f"`{header}`") if header in df.columns else F.lit("all")
        here = F.col("dimension_type") == kind
        out = F.when(here, value) if out is None else out.when(here, value)
    return out.otherwise(F.lit("all"))


def statistics_table(df: DataFrame, kind: str, package: str | Column, app: str | Column) -> DataFrame:
    """File rows (headers as columns, ``dimension_type`` from the file name) as metric rows."""
    stats = STATISTICS[kind]

    def header(name: str) -> Column:
        return F.col(f"`{name}`")

    if kind == "store_performance":
        dimension = _performance_dimension(df)
        df = ensure_columns(df, [h for _, h in TRAFFIC_COLUMNS])
        is_traffic = F.col("dimension_type") == "traffic_source"
        extra = [(c, F.when(is_traffic, header(h))) for c, h in TRAFFIC_COLUMNS]
    else:
        df = ensure_columns(df, stats.dimension_headers)
        dimension = first_non_empty([header(h) for h in stats.dimension_headers])
        extra = []
    df = ensure_columns(df, [h for _, h, _ in stats.metrics])
    parse = {"int": int_or_zero, "float": float_or_zero}
    return report_mapping(
        df,
        [
            ("date", F.to_timestamp_ntz(header("Date"), F.lit("yyyy-MM-dd"))),
            ("date_key_pt", play_date_key(header("Date"))),
            ("package_name", F.lit(package) if isinstance(package, str) else package),
            ("app_name", F.lit(app) if isinstance(app, str) else app),
            ("dimension_type", F.col("dimension_type")),
            ("dimension_value", dimension),
            *[(c, parse[how](header(h))) for c, h, how in stats.metrics],
            *extra,
        ],
    )
