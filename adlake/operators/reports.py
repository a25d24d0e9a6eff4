"""Report aggregates: day counts, conditional sums, grains and per-app rollups.

Facts are aggregated to the grain of a join before they are joined, so a day or an app that
holds a large share of the rows never multiplies into pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def sum_if(c: Column, pred: Column) -> Column:
    """Sum of the matching values, 0 when none match."""
    return F.coalesce(F.sum(F.when(pred, c)), F.lit(0))


def sum_or_null(c: Column) -> Column:
    """Sum, NULL over no rows."""
    return F.sum(c)


def top_days(df: DataFrame, n: int, key: str = "date_key", *ties: str) -> DataFrame:
    return df.orderBy(F.col(key).desc(), *ties).limit(n)


def daily_counts(df: DataFrame, key: str, start: str, end: str, n: int = 5) -> DataFrame:
    """Rows per day key, newest first."""
    in_range = df.filter(F.col(key).between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return top_days(in_range.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")), n, key)


def day_join_counts(
    a: DataFrame, b: DataFrame, key: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Number of row pairs two facts would join to per day; the pairs are never built."""

    def per_day(df: DataFrame, name: str) -> DataFrame:
        if start is not None:
            df = df.filter(F.col(key).between(F.lit(start).cast("date"), F.lit(end).cast("date")))
        return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))

    joined = per_day(a, "_na").join(per_day(b, "_nb"), key)
    return joined.select(key, (F.col("_na") * F.col("_nb")).alias("n_rows"))


def day_totals(
    events: DataFrame, performance: DataFrame, day: str, event_name: str = "first_open"
) -> DataFrame:
    """Both totals of one business day as a single row, in one aggregate over both facts."""
    at = F.col("date_key") == F.lit(day).cast("date")
    facts = events.filter(at).select("event_name", "event_count").unionByName(
        performance.filter(at).select("store_listing_acquisitions"), allowMissingColumns=True
    )
    return facts.agg(
        sum_if(F.col("event_count"), F.col("event_name") == event_name).alias(f"{event_name}_events"),
        sum_or_null(F.col("store_listing_acquisitions")).alias("store_listing_acquisitions"),
    ).select(F.lit(day).alias("date_key"), "*")


def per_app(
    performance: DataFrame,
    mapping: DataFrame,
    events: DataFrame,
    day: str | None = None,
    event_name: str = "first_open",
    fanout: str = "preaggregate",
) -> DataFrame:
    """Store acquisitions next to app events per app and day.

    ``preaggregate`` counts every acquisition and event once. ``literal`` gives the numbers
    of a plain left join before the sum, where acquisitions repeat for every matching event
    row; they are computed from counts, without building those rows.
    """
    if fanout not in ("preaggregate", "literal"):
        raise ValueError(f"unknown fanout {fanout!r}")
    if day is not None:
        at = F.col("date_key") == F.lit(day).cast("date")
        performance, events = performance.filter(at), events.filter(at)
    apps = performance.groupBy("date_key", "app_name", "package_name").agg(
        sum_or_null(F.col("store_listing_acquisitions")).alias("_acq"),
        F.count(F.lit(1)).alias("_np"),
    )
    per_property = events.groupBy("property_id", "date_key").agg(
        sum_if(F.col("event_count"), F.col("event_name") == event_name).alias("_opens"),
        F.count(F.lit(1)).alias("_ne"),
    )
    # Events are brought to the package grain first; the app side then joins one row.
    pairs = mapping.select("package_name", "property_id")
    per_package = (
        per_property.join(pairs, "property_id")
        .groupBy("date_key", "package_name")
        .agg(
            F.sum("_opens").alias("_opens"),
            (F.sum("_ne") - F.count(F.lit(1))).alias("_more"),
        )
    )
    # A mapped property without events still gives one joined row.
    properties = pairs.groupBy("package_name").agg(F.count(F.lit(1)).alias("_properties"))
    joined = apps.join(per_package, ["date_key", "package_name"], "left").join(
        properties, "package_name", "left"
    )
    n_properties = F.coalesce("_properties", F.lit(1))
    copies = n_properties + F.coalesce("_more", F.lit(0))
    opens = F.coalesce("_opens", F.lit(0))
    if fanout == "literal":
        opens, acq = opens * F.col("_np"), F.col("_acq") * copies
    else:
        acq = F.col("_acq")
    return joined.select(
        "date_key",
        "app_name",
        "package_name",
        opens.alias(f"{event_name}_events"),
        acq.alias("store_listing_acquisitions"),
    )


def engagement_daily(df: DataFrame, n: int = 30) -> DataFrame:
    """Impressions, downloads and mean conversion per day and app, newest first."""
    per_day = df.groupBy("Date", "_app_name").agg(
        F.sum("Impressions").alias("total_impressions"),
        F.sum("Total_Downloads").alias("total_downloads"),
        F.avg("Conversion_Rate").alias("avg_conversion_rate"),
    )
    return top_days(per_day, n, "Date", "_app_name")


def revenue_daily(df: DataFrame, n: int = 30) -> DataFrame:
    per_day = df.groupBy("Date", "_app_name").agg(
        F.sum("Total_Revenue").alias("revenue"), F.sum("Paying_Users").alias("paying_users")
    )
    return top_days(per_day, n, "Date", "_app_name")


def coverage_by_app(df: DataFrame) -> DataFrame:
    return df.groupBy("_app_name").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("Date").alias("earliest_date"),
        F.max("Date").alias("latest_date"),
    )


# Identity columns of each report level, outermost first.
LEVEL_KEYS = {
    "account": ("account_id",),
    "campaign": ("account_id", "campaign_id"),
    "adset": ("account_id", "campaign_id", "adset_id"),
    "ad": ("account_id", "campaign_id", "adset_id", "ad_id"),
}

# Breakdown presets and the columns each one adds to the grain.
BREAKDOWNS = {
    "ads_insights": (),
    "ads_insights_age_and_gender": ("age", "gender"),
    "ads_insights_country": ("country",),
    "ads_insights_platform_and_device": (
        "publisher_platform",
        "platform_position",
        "impression_device",
    ),
    "ads_insights_region": ("region",),
    "ads_insights_dma": ("dma",),
    "ads_insights_hourly_advertiser": ("hourly_stats_aggregated_by_advertiser_time_zone",),
}
ADDITIVE_METRICS = ("impressions", "clicks", "spend")
NON_ADDITIVE_METRICS = ("reach", "frequency", "unique_clicks", "unique_ctr", "cpp")


def report_grain(
    df: DataFrame,
    level: str = "ad",
    breakdown: str = "ads_insights",
    days: int = 1,
    since: str = "1970-01-01",
) -> DataFrame:
    """Ad-day rows at a coarser level and time step.

    Counts and spend add up, ratios are computed again from the sums; metrics over unique
    people cannot be added and are NULL. Steps of ``days`` are counted from ``since``.
    """
    keys = [*LEVEL_KEYS[level], *BREAKDOWNS[breakdown]]
    sums = _stepped(df, days, since).groupBy(*keys, "date_start").agg(*[F.sum(m).alias(m) for m in ADDITIVE_METRICS])
    return sums.select(*keys, *_grain_columns(days))


def report_grains(
    df: DataFrame,
    level: str = "ad",
    breakdowns: Sequence[str] = tuple(BREAKDOWNS),
    days: int = 1,
    since: str = "1970-01-01",
) -> DataFrame:
    """The rows of ``report_grain`` for several breakdowns, from one pass and one shuffle.

    ``breakdown`` names the preset of a row; columns that it does not break down by are NULL.
    """
    extra = list(dict.fromkeys(c for b in breakdowns for c in BREAKDOWNS[b]))
    keys = [*LEVEL_KEYS[level], "date_start", *extra]
    wanted = {b: [*LEVEL_KEYS[level], "date_start", *BREAKDOWNS[b]] for b in breakdowns}
    sums = _stepped(df, days, since).groupingSets([[F.col(c) for c in own] for own in wanted.values()], *keys)
    sums = sums.agg(*[F.sum(m).alias(m) for m in ADDITIVE_METRICS], F.grouping_id().alias("_left_out"))
    # A bit for each key, the first the highest, set where it is summed over.
    left_out = {b: sum(1 << (len(keys) - 1 - i) for i, c in enumerate(keys) if c not in own) for b, own in wanted.items()}
    name = F.coalesce(*[F.when(F.col("_left_out") == bits, b) for b, bits in left_out.items()])
    return sums.select(name.alias("breakdown"), *LEVEL_KEYS[level], *extra, *_grain_columns(days))


def _stepped(df: DataFrame, days: int, since: str) -> DataFrame:
    """The day of a row as the first one of its step."""
    offset = F.pmod(F.datediff(F.col("date_start"), F.lit(since).cast("date")), F.lit(days))
    return df.withColumn("date_start", F.date_sub(F.col("date_start"), offset))


def _grain_columns(days: int) -> list[Column]:
    def ratio(a: str, b: str, factor: float = 1.0) -> Column:
        return F.try_divide(F.col(a).cast("double") * F.lit(factor), F.col(b).cast("double"))

    return [
        F.col("date_start"),
        F.date_add("date_start", days - 1).alias("date_stop"),
        *map(F.col, ADDITIVE_METRICS),
        ratio("clicks", "impressions", 100.0).alias("ctr"),
        ratio("spend", "clicks").alias("cpc"),
        ratio("spend", "impressions", 1000.0).alias("cpm"),
        *[F.lit(None).cast("double").alias(m) for m in NON_ADDITIVE_METRICS],
    ]


def with_day_key(
    df: DataFrame, column: str, key: Column, partition_name: str = "date_key"
) -> DataFrame:
    """Add the day key as a column to partition the written table by."""
    if column not in df.columns:
        raise ValueError(f"no column {column}")
    return df.withColumn(partition_name, key)
