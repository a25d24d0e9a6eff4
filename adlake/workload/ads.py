"""Insight metrics and search-ad tables, from ad rows derived from the line items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adlake.functions.actions import subscribe_revenue
from adlake.operators.merge import merge_report_rows
from adlake.operators.sinks import shared_dir
from adlake.plans import gads, insights
from adlake.workload.registry import dealt, query, table

# First action type of a row, by line number; the SQL below spells out what follows from it.
_TYPES = (
    "omni_start_trial",
    "offsite_conversion.fb_pixel_start_trial",
    "start_trial_mobile_app",
    "omni_subscribe",
    "subscribe_mobile_app",
    "link_click",
    "omni_purchase",
)


def _entry(kind: Column, value: Column) -> Column:
    return F.struct(kind.alias("action_type"), value.cast("string").alias("value"))


def _labelled(kind: Column, label: Column, value: Column) -> Column:
    return F.struct(
        kind.cast("string").alias("action_type"),
        label.cast("string").alias("label"),
        value.cast("string").alias("value"),
    )


def ad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ad_rows(table(spark, sf_dir, "lineitem"))


def _ad_rows(items: DataFrame) -> DataFrame:
    """A report row per line item; its arrays are built from the row alone."""
    line, flag = F.col("l_linenumber"), F.col("l_returnflag")
    first = F.element_at(F.array(*[F.lit(t) for t in _TYPES]), line)
    second = F.when(flag == "A", "offsite_conversion.fb_pixel_subscribe").when(
        flag == "N", "link_click"
    ).otherwise("start_trial")
    broken = F.when(F.col("l_linestatus") == "F", "bad").otherwise((line * 10).cast("string"))
    search = F.when(line == 1, "1_000").when(line == 2, "5d").otherwise(line.cast("string"))
    quantity = F.col("l_quantity").cast("int")
    return items.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("ad"),
        line.alias("line"),
        F.array(
            _entry(first, quantity),
            _entry(second, broken),
            _entry(F.concat(F.lit(" "), F.upper(first), F.lit(" ")), F.lit("999")),
            _entry(F.lit("search"), search),
        ).alias("actions"),
        F.array(
            _entry(F.lit("omni_purchase"), F.col("l_extendedprice")),
            _entry(F.lit("offsite_conversion.fb_pixel_start_trial"), F.col("l_tax")),
        ).alias("action_values"),
        F.when(
            flag == "A", F.array(_labelled(F.lit("Subscribe_Mobile_App"), F.lit("x"), quantity + 100))
        ).alias("conversions"),
        F.array(
            _labelled(
                F.lit("offsite_conversion.custom.1"), F.lit("Annual Subscribe Complete"), F.col("l_extendedprice")
            ),
            _labelled(F.lit("subscribe_mobile_app"), F.lit(None), F.col("l_tax")),
            _labelled(F.lit("purchase"), F.lit("Purchase"), F.lit("99")),
        ).alias("conversion_values"),
        F.array(_entry(F.lit("link_click"), F.col("l_discount"))).alias("website_ctr"),
        F.array(
            _entry(F.lit("search"), F.col("l_tax")), _entry(F.lit("link_click"), F.lit("n/a"))
        ).alias("cost_per_action_type"),
        F.array(_entry(F.lit("omni_purchase"), F.col("l_discount"))).alias("purchase_roas"),
        F.when(
            line < 7,
            F.array(
                F.struct(
                    F.lit("i").alias("indicator"),
                    F.array(F.struct(F.col("l_discount").cast("string").alias("value"))).alias("values"),
                )
            ),
        ).alias("cost_per_result"),
    )


def landed_ad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as landed reports.

    Read from files, an array is searched as it lies there; derived in the same plan, each search would derive it anew,
    and outside of generated code. The line items are dealt out before their arrays are built.
    """
    path = shared_dir(spark)
    _ad_rows(dealt(table(spark, sf_dir, "lineitem"))).write.parquet(path)
    return spark.read.parquet(path)


_IDS_SQL = "l_orderkey AS order_id, l_partkey AS ad, l_linenumber AS line"
_ACTIONS_SQL = {
    "actions_link_click": "CASE WHEN l_linenumber = 6 THEN l_quantity "
    "WHEN l_returnflag = 'N' AND l_linestatus <> 'F' THEN l_linenumber * 10.0 END",
    "actions_omni_purchase": "CASE WHEN l_linenumber = 7 THEN l_quantity END",
    "actions_search": "CASE l_linenumber WHEN 1 THEN 1000.0 WHEN 2 THEN NULL "
    "ELSE CAST(l_linenumber AS DOUBLE) END",
}
_EVENTS_SQL = {
    "trial_starts": "CASE WHEN l_linenumber <= 3 THEN l_quantity "
    "WHEN l_returnflag = 'R' AND l_linestatus <> 'F' THEN l_linenumber * 10.0 ELSE 0.0 END",
    "trial_start_value": "l_tax",
    "subscriptions": "CASE WHEN l_linenumber = 4 THEN l_quantity "
    "WHEN l_returnflag = 'A' THEN l_quantity + 100 "
    "+ CASE WHEN l_linestatus <> 'F' THEN l_linenumber * 10 ELSE 0 END "
    "WHEN l_linenumber = 5 THEN l_quantity ELSE 0.0 END",
    "subscription_value": "l_tax",
}


def _select(columns: dict[str, str]) -> str:
    return ", ".join(f"CAST({e} AS DOUBLE) AS {n}" for n, e in columns.items())


@query("expand_actions", f"SELECT {_IDS_SQL}, {_select(_ACTIONS_SQL)} FROM lineitem")
def expand_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ad_rows(spark, sf_dir).select("order_id", "ad", "line", "actions")
    kept = ("link_click", "omni_purchase", "search")
    return insights.expand_actions(rows, "actions", kept, "actions_").drop("actions")


@query("event_metrics", f"SELECT {_IDS_SQL}, {_select(_EVENTS_SQL)} FROM lineitem")
def event_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = insights.add_event_metrics(landed_ad_rows(spark, sf_dir))
    return out.select("order_id", "ad", "line", *_EVENTS_SQL)


@query(
    "subscribe_revenue",
    f"SELECT {_IDS_SQL}, round(l_extendedprice + l_tax, 4) AS subscription_revenue FROM lineitem",
)
def subscribe_revenue_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    revenue = subscribe_revenue(F.col("conversion_values")).alias("subscription_revenue")
    return ad_rows(spark, sf_dir).select("order_id", "ad", "line", revenue)


_FLAT_SQL = {
    **_EVENTS_SQL,
    **_ACTIONS_SQL,
    "actions_omni_app_install": "NULL",
    "action_values_omni_purchase": "l_extendedprice",
    "action_values_donate_total": "NULL",
    "cpa_search": "l_tax",
    "cpa_link_click": "NULL",
    "website_ctr_link_click": "l_discount",
    "purchase_roas_omni_purchase": "l_discount",
    "cost_per_result": "CASE WHEN l_linenumber < 7 THEN l_discount END",
}


@query("flatten_insights", f"SELECT {_IDS_SQL}, {_select(_FLAT_SQL)} FROM lineitem")
def flatten_insights(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = insights.flatten_insights(landed_ad_rows(spark, sf_dir))
    return flat.select("order_id", "ad", "line", *_FLAT_SQL)


_REPORT_SQL = """
    k AS (
      SELECT 'c' || CAST(user_id % 7 AS VARCHAR) AS campaign_id, 's' || CAST(user_id AS VARCHAR) AS adset_id,
             'no_ad_id' AS ad_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS date_start, event_type, user_id
      FROM events
    ),
    core AS (
      SELECT campaign_id, adset_id, ad_id, date_start, count(*) AS impressions, 'core' AS account_name
      FROM k WHERE event_type IN ('view', 'click', 'error') GROUP BY ALL
    ),
    uniq AS (
      SELECT campaign_id, adset_id, ad_id, date_start, count(*) AS reach,
             CASE WHEN max(user_id) > 50 THEN 'unique' END AS account_name
      FROM k WHERE event_type IN ('purchase', 'signup') GROUP BY ALL
    )
"""


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.col("user_id").cast("string")
    events = table(spark, sf_dir, "events").select(
        F.concat(F.lit("c"), F.pmod("user_id", F.lit(7)).cast("string")).alias("campaign_id"),
        F.concat(F.lit("s"), user).alias("adset_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("date_start"),
        "event_type",
        "user_id",
    )
    return insights.with_report_keys(events)


@query(
    "report_merge",
    f"""
    WITH {_REPORT_SQL}
    SELECT coalesce(c.campaign_id, u.campaign_id) AS campaign_id, coalesce(c.adset_id, u.adset_id) AS adset_id,
           coalesce(c.ad_id, u.ad_id) AS ad_id, coalesce(c.date_start, u.date_start) AS date_start,
           CAST(c.impressions AS DOUBLE) AS impressions, CAST(u.reach AS DOUBLE) AS reach,
           CASE WHEN u.campaign_id IS NOT NULL THEN u.account_name ELSE c.account_name END AS account_name
    FROM core c FULL OUTER JOIN uniq u
      ON c.campaign_id = u.campaign_id AND c.adset_id = u.adset_id
     AND c.ad_id = u.ad_id AND c.date_start = u.date_start
    """,
)
def report_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, keys = _report(spark, sf_dir), list(insights.REPORT_KEYS)
    core = rows.filter(F.col("event_type").isin("view", "click", "error")).groupBy(*keys).agg(
        F.count(F.lit(1)).cast("double").alias("impressions"), F.lit("core").alias("account_name")
    )
    unique = rows.filter(F.col("event_type").isin("purchase", "signup")).groupBy(*keys).agg(
        F.count(F.lit(1)).cast("double").alias("reach"),
        F.when(F.max("user_id") > 50, "unique").alias("account_name"),
    )
    return merge_report_rows([core, unique], keys)


@query(
    "split_metrics",
    """
    SELECT l_orderkey AS ad_id, CAST(l_quantity AS BIGINT) AS metric, 'core' AS part FROM lineitem
    UNION ALL
    SELECT l_orderkey, l_linenumber, 'unique' FROM lineitem
    """,
)
def split_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("ad_id"),
        F.col("l_quantity").cast("bigint").alias("impressions"),
        F.col("l_linenumber").cast("bigint").alias("reach"),
    )
    core, unique = insights.split_metrics(report)
    return core.withColumnRenamed("impressions", "metric").withColumn("part", F.lit("core")).unionByName(
        unique.withColumnRenamed("reach", "metric").withColumn("part", F.lit("unique"))
    )


def result_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested result rows of the search-ad service, one per line item."""
    line = F.col("l_linenumber")

    def text(prefix: str, c: str) -> Column:
        return F.concat(F.lit(prefix), F.col(c).cast("string"))

    bidding = F.when(line <= 3, "TARGET_ROAS").when(line == 7, F.lit(None)).otherwise("MAXIMIZE_CLICKS")
    action = F.when(line == 1, "All conversions").otherwise(text("action ", "l_linenumber"))
    d = {c: F.col(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")}
    return table(spark, sf_dir, "lineitem").select(
        F.struct(
            F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
            text("customers/1/", "l_linenumber").alias("conversion_action"),
            action.alias("conversion_action_name"),
        ).alias("segments"),
        F.struct(F.col("l_suppkey").alias("id"), text("S", "l_suppkey").alias("descriptive_name")).alias(
            "customer"
        ),
        F.struct(
            F.col("l_orderkey").alias("id"),
            text("C", "l_orderkey").alias("name"),
            bidding.alias("bidding_strategy_type"),
        ).alias("campaign"),
        F.struct(F.col("l_partkey").alias("id"), text("G", "l_partkey").alias("name")).alias("ad_group"),
        F.struct(
            F.struct(
                (F.col("l_partkey") * 10 + line).alias("id"),
                text("A", "l_partkey").alias("name"),
                F.lit("RESPONSIVE").alias("type"),
            ).alias("ad"),
            F.col("l_returnflag").alias("status"),
            F.col("l_linestatus").alias("primary_status"),
            F.when(line > 2, F.array(F.concat("l_returnflag", "l_linestatus"), F.lit("later")))
            .otherwise(F.array().cast("array<string>"))
            .alias("primary_status_reasons"),
        ).alias("ad_group_ad"),
        F.struct(
            F.col("l_orderkey").alias("cost_micros"),
            F.col("l_partkey").alias("impressions"),
            line.cast("bigint").alias("clicks"),
            d["l_discount"].alias("ctr"),
            d["l_tax"].alias("average_cpc"),
            d["l_quantity"].alias("average_cpm"),
            d["l_quantity"].alias("conversions_by_conversion_date"),
            d["l_tax"].alias("conversions_value_by_conversion_date"),
            F.when(line != 2, d["l_quantity"]).alias("conversions"),
            d["l_extendedprice"].alias("conversions_value"),
            d["l_tax"].alias("cost_per_conversion"),
            d["l_quantity"].alias("all_conversions"),
            d["l_extendedprice"].alias("all_conversions_value"),
            F.col("l_suppkey").alias("video_trueview_views"),
        ).alias("metrics"),
    )


_OWNER_SQL = "l_suppkey AS account_id, 'S' || CAST(l_suppkey AS VARCHAR) AS account_name, 'g1' AS managing_system"
_CAMPAIGN_SQL = "l_orderkey AS campaign_id, 'C' || CAST(l_orderkey AS VARCHAR) AS campaign_name"
_AD_SQL = (
    "l_partkey AS ad_group_id, 'G' || CAST(l_partkey AS VARCHAR) AS ad_group_name, "
    "l_partkey * 10 + l_linenumber AS ad_id, 'A' || CAST(l_partkey AS VARCHAR) AS ad_name"
)
_AD_STATE_SQL = (
    "'RESPONSIVE' AS ad_type, l_returnflag AS ad_status, l_linestatus AS ad_primary_status, "
    "CASE WHEN l_linenumber > 2 THEN l_returnflag || l_linestatus END AS ad_primary_status_reason"
)
_METRICS_SQL = (
    "l_orderkey AS cost_micros, l_partkey AS impressions, CAST(l_linenumber AS BIGINT) AS clicks, "
    "l_discount AS ctr, l_tax AS average_cpc, l_quantity AS average_cpm, "
    "l_quantity AS conversions_by_conversion_date, l_tax AS conversions_value_by_conversion_date, "
    "CASE WHEN l_linenumber <> 2 THEN l_quantity END AS conversions_by_click_date, "
    "l_extendedprice AS conversions_value_by_click_date, l_tax AS cost_per_conversion, "
    "l_quantity AS all_conversions, l_extendedprice AS all_conversions_value, l_suppkey AS video_views"
)
_DATE_SQL = "CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS date"


@query(
    "ads_metrics",
    f"SELECT {_DATE_SQL}, {_OWNER_SQL}, {_CAMPAIGN_SQL}, {_AD_SQL}, {_AD_STATE_SQL}, {_METRICS_SQL} FROM lineitem",
)
def ads_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gads.ads_metrics(result_rows(spark, sf_dir), "g1")


@query(
    "subscription_ads_metrics",
    f"""
    SELECT {_DATE_SQL}, {_OWNER_SQL}, {_CAMPAIGN_SQL}, {_AD_SQL}, {_AD_STATE_SQL}, {_METRICS_SQL},
           CASE WHEN l_linenumber <= 3 THEN 'TARGET_ROAS' WHEN l_linenumber = 7 THEN ''
                ELSE 'MAXIMIZE_CLICKS' END AS bidding_strategy_type,
           CASE WHEN l_linenumber <> 2 THEN l_quantity ELSE 0.0 END AS installs,
           CASE WHEN l_linenumber <= 3 THEN l_extendedprice ELSE 0.0 END AS revenue
    FROM lineitem
    """,
)
def subscription_ads_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gads.subscription_ads_metrics(result_rows(spark, sf_dir), "g1")


@query(
    "conversion_actions",
    f"""
    SELECT {_DATE_SQL}, 'customers/1/' || CAST(l_linenumber AS VARCHAR) AS conversion_action,
           'action ' || CAST(l_linenumber AS VARCHAR) AS conversion_action_name,
           {_OWNER_SQL}, {_CAMPAIGN_SQL}, {_AD_SQL},
           CASE WHEN l_linenumber <> 2 THEN l_quantity END AS conversions, l_extendedprice AS conversions_value,
           l_quantity AS all_conversions, l_extendedprice AS all_conversions_value
    FROM lineitem WHERE l_linenumber <> 1
    """,
)
def conversion_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gads.conversion_actions(result_rows(spark, sf_dir), "g1")


@query(
    "campaign_budgets",
    """
    SELECT p_size AS account_id, p_partkey AS campaign_id, p_name AS campaign_name,
           p_type AS bidding_strategy_type,
           CASE WHEN p_type = 'PROMO' THEN p_retailprice WHEN p_type = 'SMALL' THEN NULL
                ELSE p_size / 10.0 END AS target_roas,
           p_partkey * 2500 / 1000000.0 AS daily_budget, 'g1' AS managing_system
    FROM part
    """,
)
def campaign_budgets(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("p_type")
    target = F.when(kind == "PROMO", F.col("p_retailprice")).when(kind == "SMALL", F.lit(None)).otherwise(0.0)
    other = F.when(kind == "SMALL", 0.0).otherwise(F.col("p_size") / 10.0)
    rows = table(spark, sf_dir, "part").select(
        F.struct(F.col("p_size").alias("id")).alias("customer"),
        F.struct(
            F.col("p_partkey").alias("id"),
            F.col("p_name").alias("name"),
            kind.alias("bidding_strategy_type"),
            F.struct(target.alias("target_roas")).alias("target_roas"),
            F.struct(other.alias("target_roas")).alias("maximize_conversion_value"),
        ).alias("campaign"),
        F.struct((F.col("p_partkey") * 2500).alias("amount_micros")).alias("campaign_budget"),
    )
    return gads.campaign_budgets(rows, "g1")


@query(
    "ads_dimensions",
    """
    SELECT 'customers' AS dimension, CAST(s_suppkey AS VARCHAR) AS id, s_name AS value FROM supplier
    UNION ALL SELECT 'campaigns', CAST(p_partkey AS VARCHAR), p_brand || ',' || p_type FROM part
    UNION ALL SELECT 'change_events', strftime(o_orderdate, '%Y-%m-%d'), NULL FROM orders
    UNION ALL SELECT 'customer_clients', c_mktsegment, NULL FROM customer
    """,
)
def ads_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four small projections, from rows nested as the service sends them."""

    def nested(name: str, root: str, **fields: Column) -> DataFrame:
        rows = table(spark, sf_dir, name)
        return rows.select(F.struct(*[c.alias(n) for n, c in fields.items()], F.lit("x").alias("unasked")).alias(root))

    labels = F.array("p_brand", "p_type")
    rows = {
        "customers": nested("supplier", "customer", id=F.col("s_suppkey"), descriptive_name=F.col("s_name")),
        "campaigns": nested("part", "campaign", id=F.col("p_partkey"), labels=labels),
        "change_events": nested("orders", "change_event", change_date_time=F.date_format("o_orderdate", "yyyy-MM-dd")),
        "customer_clients": nested("customer", "customer_client", status=F.col("c_mktsegment")),
    }
    out = None
    for name, df in rows.items():
        flat = gads.dimension(df, name)
        first, *rest = flat.columns
        value = F.lit(None).cast("string")
        if rest:
            value = F.array_join(rest[0], ",") if name == "campaigns" else F.col(rest[0])
        part = flat.select(F.lit(name).alias("dimension"), F.col(first).cast("string").alias("id"), value.alias("value"))
        out = part if out is None else out.unionByName(part)
    return out
