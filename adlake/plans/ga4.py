"""Product-analytics reports: positional rows to named columns, and the six report tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from adlake.functions.dates import TIME_DIMENSIONS, ga_date_key, ga_time_dimension
from adlake.functions.numbers import metric_type_name, metric_value
from adlake.operators.project import report_mapping
from adlake.spec import MERGE, TableSpec

ROLLING_DAYS = 120


def report_rows(
    df: DataFrame, dimensions: Sequence[str], metrics: Sequence[tuple[str, str]]
) -> DataFrame:
    """Rows of value arrays as columns.

    ``dimensions`` and ``metrics`` (name, type) are the page headers. Time dimensions become
    times; metric columns carry their type in the name, e.g. ``sessions_INTEGER``.
    """
    columns = [
        (d, ga_time_dimension(d, F.get(F.col("dimension_values"), F.lit(i))))
        for i, d in enumerate(dimensions)
    ]
    columns += [
        (f"{name}_{metric_type_name(kind)}", metric_value(F.get(F.col("metric_values"), F.lit(i)), kind))
        for i, (name, kind) in enumerate(metrics)
    ]
    return report_mapping(df, columns)


@dataclass(frozen=True)
class Report:
    """A report table: (column, dimension) and (column, metric, Spark type) pairs."""

    dimensions: Sequence[tuple[str, str]]
    metrics: Sequence[tuple[str, str, str]]
    keys: Sequence[str]


# Names of the report service's dimensions and metrics, and of the tables.
REPORTS: Mapping[str, Report] = {
    "ga4_traffic_sources": Report(
        (("platform", "platform"), ("source", "source"), ("medium", "medium"), ("campaign", "campaignName")),
        (("conversions", "conversions", "double"), ("total_revenue", "totalRevenue", "double")),
        ("platform", "source", "medium"),
    ),
    "ga4_session_traffic_sources": Report(
        (
            ("platform", "platform"),
            ("session_source", "sessionSource"),
            ("session_medium", "sessionMedium"),
            ("session_campaign", "sessionCampaignName"),
        ),
        (
            ("sessions", "sessions", "bigint"),
            ("total_users", "totalUsers", "bigint"),
            ("new_users", "newUsers", "bigint"),
            ("screen_page_views", "screenPageViews", "bigint"),
        ),
        ("platform", "session_source", "session_medium"),
    ),
    "ga4_user_engagement": Report(
        (("platform", "platform"),),
        (
            ("sessions", "sessions", "bigint"),
            ("engagement_rate", "engagementRate", "double"),
            ("average_session_duration", "averageSessionDuration", "double"),
            ("bounce_rate", "bounceRate", "double"),
            ("screen_page_views_per_session", "screenPageViewsPerSession", "double"),
            ("event_count", "eventCount", "bigint"),
        ),
        ("platform",),
    ),
    "ga4_device_category": Report(
        (("platform", "platform"), ("device_category", "deviceCategory")),
        (
            ("sessions", "sessions", "bigint"),
            ("total_users", "totalUsers", "bigint"),
            ("conversions", "conversions", "double"),
            ("total_revenue", "totalRevenue", "double"),
        ),
        ("platform", "device_category"),
    ),
    "ga4_users": Report(
        (("platform", "platform"), ("new_vs_returning", "newVsReturning")),
        (("active_users", "activeUsers", "bigint"),),
        ("platform", "new_vs_returning"),
    ),
    "ga4_events": Report(
        (("platform", "platform"), ("event_name", "eventName")),
        (
            ("event_count", "eventCount", "bigint"),
            ("event_count_per_user", "eventCountPerUser", "double"),
            ("event_value", "eventValue", "double"),
            ("total_users", "totalUsers", "bigint"),
        ),
        ("platform", "event_name"),
    ),
}


def specs(wide: bool = False) -> list[TableSpec]:
    """Report tables. ``wide`` puts every dimension into the key; otherwise the dimensions
    outside the key decide, in order, which row of a key stays."""
    out = []
    for name, report in REPORTS.items():
        extra = tuple(c for c, _ in report.dimensions if c not in report.keys)
        keys = ("property_id", "date", *report.keys)
        out.append(
            TableSpec(
                name,
                (*keys, *extra) if wide else keys,
                MERGE,
                cursor="date",
                order_by=() if wide else extra,
                partition_by=("date",),
            )
        )
    return out


def _metric(df: DataFrame, metric: str, to: str) -> Column:
    """The metric under whatever type the page declared; 0 when the page lacks it."""
    found = [c for c in df.columns if c.rpartition("_")[0] == metric]
    return F.col(found[0]).cast(to) if found else F.lit(0).cast(to)


def report_table(df: DataFrame, name: str, property_id: int, group: str) -> DataFrame:
    """Named report rows (see ``report_rows``) as rows of one of the six tables."""
    report = REPORTS[name]
    have = set(df.columns)

    def dimension(d: str) -> Column:
        return F.col(d) if d in have else F.lit(None).cast("string")

    return report_mapping(
        df,
        [
            ("property_id", F.lit(str(property_id))),
            ("managing_system", F.lit(group)),
            ("date", dimension("date")),
            ("date_key_pt", ga_date_key(dimension("date").cast("date"))),
            *[(column, dimension(d)) for column, d in report.dimensions],
            *[(column, _metric(df, metric, to)) for column, metric, to in report.metrics],
        ],
    )


def report_dimensions(name: str) -> list[str]:
    return ["date", *[d for _, d in REPORTS[name].dimensions]]
