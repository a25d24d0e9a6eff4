"""Search-ad reports: ad metrics, campaign budgets, conversion actions, small dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from adlake.functions.numbers import micros_to_units
from adlake.operators.project import exclude_value, project_dimension, report_mapping
from adlake.spec import MERGE, REPLACE, TableSpec

ROLLING_DAYS = 30
ALL_CONVERSIONS = "All conversions"  # fixed value: the name of the total row

SPECS = [
    TableSpec("google_ads", ("account_id", "ad_id", "date"), MERGE, cursor="date", partition_by=("date",)),
    TableSpec("google_ads_campaigns", ("account_id", "campaign_id"), REPLACE),
    TableSpec(
        "google_ads_conversion_actions",
        ("account_id", "ad_id", "date", "conversion_action"),
        MERGE,
        cursor="date",
        partition_by=("date",),
    ),
    *[TableSpec(n) for n in ("customers", "campaigns", "change_events", "customer_clients")],
]

# Output columns and the report fields they come from.
_AD = (
    ("ad_id", "ad_group_ad.ad.id"),
    ("ad_name", "ad_group_ad.ad.name"),
)
_OWNER = (("account_id", "customer.id"), ("account_name", "customer.descriptive_name"))
_CAMPAIGN = (("campaign_id", "campaign.id"), ("campaign_name", "campaign.name"))
_AD_GROUP = (("ad_group_id", "ad_group.id"), ("ad_group_name", "ad_group.name"))
_AD_STATE = (
    ("ad_type", "ad_group_ad.ad.type"),
    ("ad_status", "ad_group_ad.status"),
    ("ad_primary_status", "ad_group_ad.primary_status"),
)
_METRICS = (
    ("cost_micros", "metrics.cost_micros"),
    ("impressions", "metrics.impressions"),
    ("clicks", "metrics.clicks"),
    ("ctr", "metrics.ctr"),
    ("average_cpc", "metrics.average_cpc"),
    ("average_cpm", "metrics.average_cpm"),
    ("conversions_by_conversion_date", "metrics.conversions_by_conversion_date"),
    ("conversions_value_by_conversion_date", "metrics.conversions_value_by_conversion_date"),
    ("conversions_by_click_date", "metrics.conversions"),
    ("conversions_value_by_click_date", "metrics.conversions_value"),
    ("cost_per_conversion", "metrics.cost_per_conversion"),
    ("all_conversions", "metrics.all_conversions"),
    ("all_conversions_value", "metrics.all_conversions_value"),
    ("video_views", "metrics.video_trueview_views"),
)
_ACTION_METRICS = ("conversions", "conversions_value", "all_conversions", "all_conversions_value")
DIMENSIONS = {
    "customers": {"id": "customer.id", "descriptive_name": "customer.descriptive_name"},
    "campaigns": {"id": "campaign.id", "labels": "campaign.labels"},
    "change_events": {"change_date_time": "change_event.change_date_time"},
    "customer_clients": {"status": "customer_client.status"},
}


def _columns(pairs) -> list[tuple[str, Column]]:
    return [(name, F.col(path)) for name, path in pairs]


def _report(group: str, before_metrics: list[tuple[str, Column]] = ()) -> list[tuple[str, Column]]:
    reason = F.get(F.col("ad_group_ad.primary_status_reasons"), F.lit(0))
    return [
        ("date", F.col("segments.date")),
        *_columns(_OWNER),
        ("managing_system", F.lit(group)),
        *_columns(_CAMPAIGN),
        *before_metrics,
        *_columns((*_AD_GROUP, *_AD, *_AD_STATE)),
        ("ad_primary_status_reason", reason),
        *_columns(_METRICS),
    ]


def ads_metrics(df: DataFrame, group: str) -> DataFrame:
    """Nested result rows as flat metric rows; only the first status reason is kept."""
    return report_mapping(df, _report(group))


def subscription_ads_metrics(df: DataFrame, group: str) -> DataFrame:
    """Ad metrics plus installs, and revenue for campaigns that bid on return on spend."""
    bidding = F.coalesce(F.col("campaign.bidding_strategy_type"), F.lit(""))
    installs = F.coalesce(F.col("metrics.conversions"), F.lit(0)).cast("double")
    value = F.coalesce(F.col("metrics.conversions_value"), F.lit(0)).cast("double")
    revenue = F.when(bidding.contains("ROAS"), value).otherwise(F.lit(0.0))
    columns = _report(group, [("bidding_strategy_type", bidding)])
    return report_mapping(df, [*columns, ("installs", installs), ("revenue", revenue)])


def campaign_budgets(df: DataFrame, group: str) -> DataFrame:
    """Daily budgets in units, with the target that is set (zero counts as not set)."""
    targets = ("campaign.target_roas.target_roas", "campaign.maximize_conversion_value.target_roas")
    target = F.coalesce(*[F.nullif(F.col(t), F.lit(0.0)) for t in targets])
    return report_mapping(
        df,
        [
            ("account_id", F.col("customer.id")),
            *_columns(_CAMPAIGN),
            ("bidding_strategy_type", F.col("campaign.bidding_strategy_type")),
            ("target_roas", target),
            ("daily_budget", micros_to_units(F.col("campaign_budget.amount_micros"))),
            ("managing_system", F.lit(group)),
        ],
    )


def conversion_actions(df: DataFrame, group: str) -> DataFrame:
    """Conversions per conversion action, without the total row."""
    actions = ("conversion_action", "conversion_action_name")
    flat = report_mapping(
        df,
        [
            ("date", F.col("segments.date")),
            *[(a, F.col(f"segments.{a}")) for a in actions],
            *_columns(_OWNER),
            ("managing_system", F.lit(group)),
            *_columns((*_CAMPAIGN, *_AD_GROUP, *_AD)),
            *[(m, F.col(f"metrics.{m}")) for m in _ACTION_METRICS],
        ],
    )
    return exclude_value(flat, "conversion_action_name", ALL_CONVERSIONS)


def dimension(df: DataFrame, name: str) -> DataFrame:
    return project_dimension(df, DIMENSIONS[name])
