"""Business-day reports, store reports and report grains."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from adlake.functions.dates import BUSINESS_TZ, day_key, day_range_utc
from adlake.operators.reports import (
    coverage_by_app,
    daily_counts,
    day_join_counts,
    day_totals,
    engagement_daily,
    per_app,
    BREAKDOWNS,
    report_grain,
    report_grains,
    revenue_daily,
    top_days,
    with_day_key,
)
from adlake.operators.sinks import read_table, shared_dir, write_replace
from adlake.plans import appstore
from adlake.workload.registry import PROPS_K_SQL, money, props_k, query, table

_DAY_SQL = f"CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE '{BUSINESS_TZ}' AS DATE)"


def keyed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return with_day_key(events, "ts", day_key(F.col("ts"), BUSINESS_TZ))


@query(
    "day_key_counts",
    f"""
    SELECT CAST(d AS VARCHAR) AS date_key, count(*) AS n_rows
    FROM (SELECT {_DAY_SQL} AS d FROM events)
    WHERE d BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'
    GROUP BY d ORDER BY d DESC LIMIT 5
    """,
)
def day_key_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, last = "2024-01-05", "2024-01-25"
    pruned = keyed_events(spark, sf_dir).filter(day_range_utc(F.col("ts"), first, last, BUSINESS_TZ))
    counts = daily_counts(pruned, "date_key", first, last, 5)
    return counts.withColumn("date_key", F.col("date_key").cast("string"))


@query(
    "day_key_join",
    f"""
    WITH e AS (SELECT {_DAY_SQL} AS d, event_type FROM events)
    SELECT CAST(g.d AS VARCHAR) AS date_key, count(*) AS n_rows
    FROM e AS g JOIN e AS p ON g.d = p.d
    WHERE g.event_type = 'view' AND p.event_type = 'purchase'
    GROUP BY g.d
    """,
)
def day_key_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = keyed_events(spark, sf_dir)
    views, buys = [events.filter(F.col("event_type") == t) for t in ("view", "purchase")]
    joined = day_join_counts(views, buys, "date_key")
    return joined.withColumn("date_key", F.col("date_key").cast("string"))


def _app_events(events: DataFrame) -> DataFrame:
    name = F.when(F.col("event_type") == "signup", "first_open").otherwise(F.col("event_type"))
    return events.select(
        F.col("user_id").alias("property_id"),
        "date_key",
        name.alias("event_name"),
        props_k().alias("event_count"),
    )


def _store_performance(events: DataFrame) -> DataFrame:
    app = F.pmod(F.col("user_id"), F.lit(25)).cast("string")
    return events.filter(F.col("event_type") == "purchase").select(
        "date_key",
        F.concat(F.lit("App "), app).alias("app_name"),
        F.concat(F.lit("pkg."), app).alias("package_name"),
        props_k().alias("store_listing_acquisitions"),
    )


_FACTS_SQL = f"""
    g AS (
      SELECT user_id AS property_id, {_DAY_SQL} AS d,
             CASE WHEN event_type = 'signup' THEN 'first_open' ELSE event_type END AS event_name,
             {PROPS_K_SQL} AS event_count
      FROM events
    ),
    p AS (
      SELECT {_DAY_SQL} AS d, 'App ' || CAST(user_id % 25 AS VARCHAR) AS app_name,
             'pkg.' || CAST(user_id % 25 AS VARCHAR) AS package_name,
             {PROPS_K_SQL} AS acq
      FROM events WHERE event_type = 'purchase'
    ),
    m AS (SELECT c_custkey AS property_id, 'pkg.' || CAST(c_nationkey AS VARCHAR) AS package_name FROM customer)
"""


@query(
    "day_totals",
    f"""
    WITH {_FACTS_SQL}
    SELECT '2024-01-10' AS date_key,
      CAST((SELECT coalesce(sum(event_count) FILTER (WHERE event_name = 'first_open'), 0)
            FROM g WHERE d = DATE '2024-01-10') AS BIGINT) AS first_open_events,
      CAST((SELECT sum(acq) FROM p WHERE d = DATE '2024-01-10') AS BIGINT) AS store_listing_acquisitions
    """,
)
def day_totals_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = "2024-01-10"
    events = keyed_events(spark, sf_dir).filter(day_range_utc(F.col("ts"), day, day, BUSINESS_TZ))
    return day_totals(_app_events(events), _store_performance(events), day)


def _per_app(spark: SparkSession, sf_dir: str, fanout: str) -> DataFrame:
    events = keyed_events(spark, sf_dir)
    mapping = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("property_id"),
        F.concat(F.lit("pkg."), F.col("c_nationkey").cast("string")).alias("package_name"),
    )
    out = per_app(_store_performance(events), mapping, _app_events(events), fanout=fanout)
    return out.withColumn("date_key", F.col("date_key").cast("string"))


@query(
    "per_app",
    f"""
    WITH {_FACTS_SQL},
    opens AS (
      SELECT m.package_name, g.d,
             sum(CASE WHEN g.event_name = 'first_open' THEN g.event_count ELSE 0 END) AS n
      FROM g JOIN m ON m.property_id = g.property_id GROUP BY ALL
    ),
    acqs AS (SELECT d, app_name, package_name, sum(acq) AS acq FROM p GROUP BY ALL)
    SELECT CAST(a.d AS VARCHAR) AS date_key, app_name, a.package_name,
           CAST(coalesce(o.n, 0) AS BIGINT) AS first_open_events,
           CAST(a.acq AS BIGINT) AS store_listing_acquisitions
    FROM acqs a LEFT JOIN opens o ON o.package_name = a.package_name AND o.d = a.d
    """,
)
def per_app_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_app(spark, sf_dir, "preaggregate")


@query(
    "per_app_literal",
    f"""
    WITH {_FACTS_SQL}
    SELECT CAST(p.d AS VARCHAR) AS date_key, p.app_name, p.package_name,
           CAST(sum(CASE WHEN g.event_name = 'first_open' THEN g.event_count ELSE 0 END) AS BIGINT)
             AS first_open_events,
           CAST(sum(p.acq) AS BIGINT) AS store_listing_acquisitions
    FROM p LEFT JOIN m ON m.package_name = p.package_name
    LEFT JOIN g ON g.property_id = m.property_id AND g.d = p.d
    GROUP BY p.d, p.app_name, p.package_name
    """,
)
def per_app_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_app(spark, sf_dir, "literal")


@query(
    "top_days",
    f"""
    SELECT CAST(d AS VARCHAR) AS date_key, event_type, count(*) AS n_rows
    FROM (SELECT {_DAY_SQL} AS d, event_type FROM events)
    GROUP BY d, event_type ORDER BY d DESC, event_type LIMIT 30
    """,
)
def top_days_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = keyed_events(spark, sf_dir).groupBy("date_key", "event_type").agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    return top_days(counts, 30, "date_key", "event_type").withColumn(
        "date_key", F.col("date_key").cast("string")
    )


@query(
    "day_key_table",
    f"SELECT CAST({_DAY_SQL} AS VARCHAR) AS date_key, count(*) AS n_rows, max(event_id) AS last_id "
    "FROM events GROUP BY 1",
)
def day_key_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events written with their day key as partition column, and read back."""
    path = shared_dir(spark)
    write_replace(keyed_events(spark, sf_dir), path, ["date_key"])
    counts = read_table(spark, path).groupBy("date_key").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("event_id").alias("last_id")
    )
    return counts.withColumn("date_key", F.col("date_key").cast("string"))


def _store_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report rows as the store sends them: every column is text."""
    return table(spark, sf_dir, "lineitem").select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("Date"),
        F.concat("l_returnflag", F.lit(" app")).alias("App Name"),
        F.concat("l_returnflag", "l_linestatus").alias("_app_name"),
        F.col("l_quantity").cast("int").cast("string").alias("Impressions"),
        F.col("l_suppkey").cast("string").alias("Product Page Views"),
        F.col("l_linenumber").cast("string").alias("Total Downloads"),
        F.col("l_discount").cast("string").alias("Conversion Rate"),
        F.col("l_extendedprice").cast("string").alias("Total Revenue"),
        F.col("l_linenumber").cast("string").alias("Paying Users"),
        F.col("l_orderkey").cast("string").alias("Paying Sessions"),
        F.col("l_tax").cast("string").alias("Revenue Per Paying User"),
    )


def _store_rows(spark: SparkSession, sf_dir: str, name: str, *keep: str) -> DataFrame:
    text = _store_text(spark, sf_dir)
    raw = appstore.raw_rows(text.drop("_app_name"), app_id="1", group_name="g", report_name="r", granularity="DAILY")
    raw = raw.withColumn("_app_name", F.concat(F.substring("App Name", 1, 1), F.lit("-app")))
    return appstore.typed_rows(raw, name, keep=("Date", "_app_name", *keep))


_ENGAGEMENT_SQL = """
    e AS (
      SELECT DISTINCT CAST(l_shipdate AS DATE) AS d, l_returnflag || '-app' AS _app_name,
             l_returnflag || ' app' AS app_name, CAST(l_quantity AS BIGINT) AS impressions,
             l_suppkey AS views, CAST(l_linenumber AS BIGINT) AS downloads, l_discount AS rate
      FROM lineitem
    )
"""
_COMMERCE_SQL = """
    c AS (
      SELECT DISTINCT CAST(l_shipdate AS DATE) AS d, l_returnflag || '-app' AS _app_name,
             CAST(l_extendedprice AS DECIMAL(18,2)) AS revenue, CAST(l_linenumber AS BIGINT) AS users,
             l_orderkey AS sessions, l_tax AS per_user
      FROM lineitem
    )
"""


@query(
    "engagement_daily",
    f"""
    WITH {_ENGAGEMENT_SQL}
    SELECT CAST(d AS VARCHAR) AS day, _app_name, CAST(sum(impressions) AS BIGINT) AS total_impressions,
           CAST(sum(downloads) AS BIGINT) AS total_downloads, round(avg(rate), 6) AS avg_conversion_rate
    FROM e GROUP BY d, _app_name ORDER BY d DESC, _app_name LIMIT 30
    """,
)
def engagement_daily_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = engagement_daily(
        _store_rows(spark, sf_dir, "app_store_engagement", "Impressions", "Total_Downloads", "Conversion_Rate"), 30
    )
    return out.select(
        F.col("Date").cast("string").alias("day"),
        "_app_name",
        "total_impressions",
        "total_downloads",
        F.round("avg_conversion_rate", 6).alias("avg_conversion_rate"),
    )


@query(
    "revenue_daily",
    f"""
    WITH {_COMMERCE_SQL}
    SELECT CAST(d AS VARCHAR) AS day, _app_name, CAST(sum(revenue) AS DOUBLE) AS revenue,
           CAST(sum(users) AS BIGINT) AS paying_users
    FROM c GROUP BY d, _app_name ORDER BY d DESC, _app_name LIMIT 30
    """,
)
def revenue_daily_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = revenue_daily(_store_rows(spark, sf_dir, "app_store_commerce", "Total_Revenue", "Paying_Users"), 30)
    return out.select(
        F.col("Date").cast("string").alias("day"),
        "_app_name",
        F.col("revenue").cast("double").alias("revenue"),
        "paying_users",
    )


@query(
    "coverage_by_app",
    f"""
    WITH {_ENGAGEMENT_SQL}
    SELECT _app_name, count(*) AS n_rows, CAST(min(d) AS VARCHAR) AS earliest_date,
           CAST(max(d) AS VARCHAR) AS latest_date
    FROM e GROUP BY _app_name
    """,
)
def coverage_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = coverage_by_app(_store_rows(spark, sf_dir, "app_store_engagement"))
    return out.select(
        "_app_name",
        "n_rows",
        F.col("earliest_date").cast("string").alias("earliest_date"),
        F.col("latest_date").cast("string").alias("latest_date"),
    )


@query(
    "app_store_typed",
    """
    SELECT DISTINCT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day, l_returnflag || ' app' AS app_name,
           CAST(l_quantity AS BIGINT) AS devices, CAST(l_linenumber AS BIGINT) AS installs,
           CAST(l_suppkey AS BIGINT) AS deletions, CAST(l_orderkey AS BIGINT) AS sessions,
           CAST(l_partkey AS BIGINT) AS crashes, 'Usage' AS report, 'DAILY' AS granularity
    FROM lineitem
    """,
)
def app_store_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = table(spark, sf_dir, "lineitem").select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("Date"),
        F.concat("l_returnflag", F.lit(" app")).alias("App Name"),
        F.col("l_quantity").cast("int").cast("string").alias("Active Devices"),
        F.col("l_linenumber").cast("string").alias("Installations"),
        F.col("l_suppkey").cast("string").alias("Deletions"),
        F.col("l_orderkey").cast("string").alias("Sessions"),
        F.col("l_partkey").cast("string").alias("Crashes"),
    )
    raw = appstore.raw_rows(
        text, app_id="1", app_name="n", group_name="g", report_name="Usage", granularity="DAILY"
    )
    return appstore.typed_rows(raw, "app_usage").select(
        F.col("Date").cast("string").alias("day"),
        F.col("App_Name").alias("app_name"),
        F.col("Active_Devices").alias("devices"),
        F.col("Installations").alias("installs"),
        F.col("Deletions").alias("deletions"),
        F.col("Sessions").alias("sessions"),
        F.col("Crashes").alias("crashes"),
        F.col("_report_name").alias("report"),
        F.col("_granularity").alias("granularity"),
    )


def _ad_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("account_id"),
        F.pmod("l_suppkey", F.lit(10)).cast("string").alias("campaign_id"),
        F.col("l_suppkey").cast("string").alias("adset_id"),
        F.col("l_partkey").cast("string").alias("ad_id"),
        F.col("l_linestatus").alias("country"),
        F.to_date("l_shipdate").alias("date_start"),
        F.col("l_quantity").cast("bigint").alias("impressions"),
        F.col("l_linenumber").cast("bigint").alias("clicks"),
        money("l_extendedprice").alias("spend"),
    )


def _grain_sql(keys: str, select: str, days: int) -> str:
    return f"""
    WITH a AS (
      SELECT {keys},
             CAST(l_shipdate AS DATE)
               - CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) % {days} AS INTEGER) AS d,
             CAST(sum(l_quantity) AS BIGINT) AS impressions, CAST(sum(l_linenumber) AS BIGINT) AS clicks,
             CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS spend
      FROM lineitem GROUP BY ALL
    )
    SELECT {select}, CAST(d AS VARCHAR) AS date_start, CAST(d + {days - 1} AS VARCHAR) AS date_stop,
           impressions, clicks, spend, CAST(clicks AS DOUBLE) * 100 / CAST(impressions AS DOUBLE) AS ctr,
           spend / CAST(clicks AS DOUBLE) AS cpc, spend * 1000 / CAST(impressions AS DOUBLE) AS cpm
    FROM a
    """


def _grain_columns(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(
        *keys,
        F.col("date_start").cast("string").alias("date_start"),
        F.col("date_stop").cast("string").alias("date_stop"),
        "impressions",
        "clicks",
        F.col("spend").cast("double").alias("spend"),
        "ctr",
        "cpc",
        "cpm",
    )


@query(
    "report_grain",
    _grain_sql(
        "l_returnflag AS account_id, CAST(l_suppkey % 10 AS VARCHAR) AS campaign_id, "
        "CAST(l_suppkey AS VARCHAR) AS adset_id",
        "account_id, campaign_id, adset_id",
        7,
    ),
)
def report_grain_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    weekly = report_grain(_ad_days(spark, sf_dir), "adset", days=7, since="1995-01-01")
    return _grain_columns(weekly, ["account_id", "campaign_id", "adset_id"])


@query(
    "report_grain_country",
    _grain_sql(
        "l_returnflag AS account_id, l_linestatus AS country", "account_id, country", 1
    ),
)
def report_grain_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = report_grain(_ad_days(spark, sf_dir), "account", "ads_insights_country")
    return _grain_columns(daily, ["account_id", "country"])


# Columns of the line items that stand for what reports are broken down by.
_BROKEN_DOWN = {
    "age": "CAST(l_linenumber AS STRING)",
    "gender": "l_linestatus",
    "country": "l_linestatus",
    "publisher_platform": "CASE WHEN l_linenumber < 6 THEN l_returnflag END",
    "platform_position": "CAST(l_linenumber % 2 AS STRING)",
    "impression_device": "l_linestatus",
    "region": "CAST(l_suppkey % 5 AS STRING)",
    "dma": "CAST(l_partkey % 3 AS STRING)",
    "hourly_stats_aggregated_by_advertiser_time_zone": "CAST(l_orderkey % 24 AS STRING)",
}
_GRAINS_SQL = " UNION ALL ".join(
    f"""
    SELECT '{name}' AS breakdown, account_id, {', '.join(c if c in own else f"NULL AS {c}" for c in _BROKEN_DOWN)},
           date_start, date_stop, impressions, clicks, spend, ctr, cpc, cpm
    FROM ({_grain_sql(", ".join(["l_returnflag AS account_id", *(f"{_BROKEN_DOWN[c].replace('STRING', 'VARCHAR')} AS {c}" for c in own)]), ", ".join(["account_id", *own]), 28)})
    """
    for name, own in BREAKDOWNS.items()
)


@query("report_grains", _GRAINS_SQL)
def report_grains_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps of four weeks by all breakdowns at a time."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("account_id"),
        *[F.expr(e).alias(c) for c, e in _BROKEN_DOWN.items()],
        F.to_date("l_shipdate").alias("date_start"),
        F.col("l_quantity").cast("bigint").alias("impressions"),
        F.col("l_linenumber").cast("bigint").alias("clicks"),
        money("l_extendedprice").alias("spend"),
    )
    return _grain_columns(report_grains(rows, "account", days=28, since="1995-01-01"), ["breakdown", "account_id", *_BROKEN_DOWN])
