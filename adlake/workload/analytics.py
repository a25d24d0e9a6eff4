"""Product-analytics reports and store statistics, from orders and parts rendered as raw rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adlake.functions.text import dimension_type
from adlake.operators.dedupe import key_collisions
from adlake.operators.project import explode_catalogue
from adlake.operators.sinks import shared_dir
from adlake.plans import ga4, play
from adlake.plans.runs import Lake, load_statistics
from adlake.sources.files import list_files, read_play_csv, read_segments
from adlake.workload.registry import query, table


def _iso_week(c: str) -> Column:
    year = F.extract(F.lit("YEAROFWEEK"), F.col(c)).cast("string")
    week = F.lpad(F.extract(F.lit("WEEK"), F.col(c)).cast("string"), 2, "0")
    return F.concat(year, week)


@query(
    "ga_report_times",
    """
    SELECT o_orderkey AS order_id,
           strftime(o_orderdate, '%Y-%m-%d') AS day,
           strftime(o_orderdate + INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S') AS hour,
           strftime(o_orderdate + INTERVAL 307 MINUTE, '%Y-%m-%d %H:%M:%S') AS minute,
           strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month,
           strftime(date_trunc('week', o_orderdate), '%Y-%m-%d') AS week,
           strftime(date_trunc('year', o_orderdate), '%Y-%m-%d') AS year,
           o_orderstatus AS status, o_custkey AS sessions, o_totalprice AS revenue, o_orderpriority AS note
    FROM orders
    """,
)
def ga_report_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value arrays as the service sends them: every time dimension and every metric type."""
    at = F.col("o_orderdate")
    later = at + F.expr("INTERVAL 307 MINUTE")
    rows = table(spark, sf_dir, "orders").select(
        F.array(
            F.col("o_orderkey").cast("string"),
            F.date_format(at, "yyyyMMdd"),
            F.date_format(later, "yyyyMMddHH"),
            F.date_format(later, "yyyyMMddHHmm"),
            F.date_format(at, "yyyyMM"),
            _iso_week("o_orderdate"),
            F.date_format(at, "yyyy"),
            F.col("o_orderstatus"),
        ).alias("dimension_values"),
        F.array(
            F.col("o_custkey").cast("string"), F.col("o_totalprice").cast("string"), F.col("o_orderpriority")
        ).alias("metric_values"),
    )
    named = ga4.report_rows(
        rows,
        ["orderId", "date", "dateHour", "dateHourMinute", "yearMonth", "isoYearIsoWeek", "year", "status"],
        [
            ("sessions", "TYPE_INTEGER"),
            ("revenue", "TYPE_CURRENCY"),
            ("note", "METRIC_TYPE_UNSPECIFIED"),
        ],
    )

    def day(c: str) -> Column:
        return F.date_format(c, "yyyy-MM-dd")

    return named.select(
        F.col("orderId").cast("bigint").alias("order_id"),
        day("date").alias("day"),
        F.date_format("dateHour", "yyyy-MM-dd HH:mm:ss").alias("hour"),
        F.date_format("dateHourMinute", "yyyy-MM-dd HH:mm:ss").alias("minute"),
        day("yearMonth").alias("month"),
        day("isoYearIsoWeek").alias("week"),
        day("year").alias("year"),
        "status",
        F.col("sessions_INTEGER").alias("sessions"),
        F.col("revenue_CURRENCY").alias("revenue"),
        F.col("note_TYPE").alias("note"),
    )


# How each report's dimensions and metrics are read off an order: (Spark column, SQL).
_DIMENSION_SOURCES = {
    "platform": "o_orderpriority",
    "source": "o_orderstatus",
    "medium": "'m'",
    "campaignName": "'c' || CAST(o_custkey AS VARCHAR)",
    "sessionSource": "o_orderstatus",
    "sessionMedium": "'sm'",
    "sessionCampaignName": "'sc' || CAST(o_custkey AS VARCHAR)",
    "deviceCategory": "o_orderstatus",
    "newVsReturning": "o_orderstatus",
    "eventName": "o_orderstatus",
}
_INTEGER_METRICS = {
    "sessions": "o_custkey",
    "totalUsers": "o_orderkey",
    "newUsers": "o_custkey + 1",
    "screenPageViews": "o_custkey * 2",
    "eventCount": "o_orderkey + 3",
    "activeUsers": "o_custkey + 7",
}


def _report_rows(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    report = ga4.REPORTS[name]
    dimensions = [F.date_format("o_orderdate", "yyyyMMdd")] + [
        F.expr(_DIMENSION_SOURCES[d].replace("VARCHAR", "STRING")) for _, d in report.dimensions
    ]
    # Whole numbers come as integers, all else as a float; conversions also as a float,
    # which the table must accept. The last metric of engagement is missing from the page.
    page = [
        (m, "TYPE_INTEGER" if m in _INTEGER_METRICS else "TYPE_FLOAT")
        for _, m, _ in report.metrics
        if m != "bounceRate"
    ]
    values = [
        F.expr(_INTEGER_METRICS.get(m, "o_totalprice")).cast("string") for m, _ in page
    ]
    raw = table(spark, sf_dir, "orders").select(
        F.array(*dimensions).alias("dimension_values"), F.array(*values).alias("metric_values")
    )
    return ga4.report_rows(raw, ga4.report_dimensions(name), page)


def _report_sql(name: str) -> str:
    report = ga4.REPORTS[name]
    dims = ", ".join(f"{_DIMENSION_SOURCES[d]} AS {c}" for c, d in report.dimensions)

    def metric(m: str) -> str:
        return "0.0" if m == "bounceRate" else _INTEGER_METRICS.get(m, "o_totalprice")

    metrics = ", ".join(
        f"CAST({metric(m)} AS {'DOUBLE' if to == 'double' else 'BIGINT'}) AS {c}"
        for c, m, to in report.metrics
    )
    day = "strftime(o_orderdate, '%Y-%m-%d')"
    return (
        f"SELECT '42' AS property_id, 'g1' AS managing_system, {day} AS date, {day} AS date_key_pt, "
        f"{dims}, {metrics} FROM orders"
    )


def _register_report(name: str) -> None:
    @query(name, _report_sql(name))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = ga4.report_table(_report_rows(spark, sf_dir, name), name, 42, "g1")
        return out.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


for _name in ga4.REPORTS:
    _register_report(_name)


@query(
    "key_collisions",
    """
    SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, o_orderpriority AS platform, o_orderstatus AS source,
           count(DISTINCT o_custkey) AS n_rows
    FROM orders GROUP BY ALL HAVING count(DISTINCT o_custkey) > 1
    """,
)
def key_collisions_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the traffic table under which a merge would keep one of several campaigns."""
    rows = ga4.report_table(
        _report_rows(spark, sf_dir, "ga4_traffic_sources"), "ga4_traffic_sources", 42, "g1"
    )
    rows = rows.withColumn("date", F.date_format("date", "yyyy-MM-dd"))
    keys = ["date", "platform", "source"]
    return key_collisions(rows, keys, [*keys, "campaign"])


@query(
    "catalogue",
    """
    SELECT 'acctbal/' || CAST(c_custkey AS VARCHAR) AS api_name, 'TYPE_CURRENCY' AS type, c_name AS ui_name FROM customer
    UNION ALL
    SELECT 'nation/' || CAST(c_custkey AS VARCHAR), 'TYPE_INTEGER', c_mktsegment FROM customer
    """,
)
def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    def metric(name: str, kind: str, label: str) -> Column:
        return F.struct(
            F.concat(F.lit(f"{name}/"), F.col("c_custkey").cast("string")).alias("api_name"),
            F.lit(kind).alias("type"),
            F.col(label).alias("ui_name"),
        )

    documents = table(spark, sf_dir, "customer").select(
        F.array(
            metric("acctbal", "TYPE_CURRENCY", "c_name"), metric("nation", "TYPE_INTEGER", "c_mktsegment")
        ).alias("metrics")
    )
    return explode_catalogue(documents, "metrics")


# File ending of a part's statistics file, by its type.
_SUFFIX = {
    "ECONOMY": "_country.csv",
    "LARGE": "_device.csv",
    "MEDIUM": "_app_version.csv",
    "PROMO": "_os_version.csv",
    "SMALL": "_traffic_source.csv",
    "STANDARD": ".csv",
}
_KIND_SQL = (
    "CASE p_type WHEN 'ECONOMY' THEN 'country' WHEN 'LARGE' THEN 'device' WHEN 'MEDIUM' THEN 'app_version' "
    "WHEN 'PROMO' THEN 'os_version' WHEN 'SMALL' THEN 'traffic_source' ELSE 'overview' END"
)
_STATS_SQL = (
    "strftime(DATE '2024-01-01' + p_size, '%Y-%m-%d') AS date, "
    "strftime(DATE '2024-01-01' + p_size, '%Y-%m-%d') AS date_key_pt, "
    f"'com.app' AS package_name, 'App' AS app_name, {_KIND_SQL} AS dimension_type"
)


def _statistics(spark: SparkSession, sf_dir: str, columns: dict[str, Column]) -> DataFrame:
    """Statistics rows as the files hold them: all text, one path per part."""
    suffix = F.coalesce(*[F.when(F.col("p_type") == t, F.lit(s)) for t, s in _SUFFIX.items()])
    path = F.concat(F.lit("stats/x/x_com.app_202401"), suffix)
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("p_size")).cast("string")
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit(" "), day).alias("_padded"),
        day.alias("Date"),
        dimension_type(path).alias("dimension_type"),
        *[c.cast("string").alias(name) for name, c in columns.items()],
    ).drop("_padded")


def _finish(df: DataFrame) -> DataFrame:
    return df.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


_DIMENSION_SQL = "CASE WHEN p_size > 25 THEN p_brand WHEN p_size > 10 THEN p_name ELSE 'all' END AS dimension_value"


def _either_dimension() -> tuple[Column, Column]:
    """Values for two dimension headers: the first is empty for small parts, then the second."""
    first = F.when(F.col("p_size") > 25, F.col("p_brand")).otherwise("")
    second = F.when(F.col("p_size") > 10, F.col("p_name"))
    return first, second


@query(
    "play_installs",
    f"""
    SELECT {_STATS_SQL}, {_DIMENSION_SQL}, CAST(p_size AS BIGINT) AS daily_device_installs,
           p_partkey AS daily_device_uninstalls, CAST(0 AS BIGINT) AS daily_device_upgrades,
           CAST(CASE WHEN p_size > 40 THEN p_size ELSE 0 END AS BIGINT) AS total_user_installs,
           CAST(0 AS BIGINT) AS daily_user_installs, CAST(0 AS BIGINT) AS daily_user_uninstalls,
           CAST(0 AS BIGINT) AS active_device_installs, CAST(0 AS BIGINT) AS install_events,
           CAST(0 AS BIGINT) AS update_events, p_partkey + 1 AS uninstall_events
    FROM part
    """,
)
def play_installs(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _either_dimension()
    rows = _statistics(
        spark,
        sf_dir,
        {
            "Country": first,
            "Device": second,
            "Daily Device Installs": F.col("p_size"),
            "Daily Device Uninstalls": F.col("p_partkey"),
            "Total User Installs": F.when(F.col("p_size") > 40, F.col("p_size").cast("string")).otherwise(""),
            "Uninstall events": F.col("p_partkey") + 1,
        },
    )
    return _finish(play.statistics_table(rows, "installs", "com.app", "App"))


@query(
    "play_crashes",
    f"""
    SELECT {_STATS_SQL}, {_DIMENSION_SQL}, CAST(p_size AS BIGINT) AS daily_crashes, p_partkey AS daily_anrs
    FROM part
    """,
)
def play_crashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _either_dimension()
    rows = _statistics(
        spark,
        sf_dir,
        {
            "Device": first,
            "Android OS Version": second,
            "Daily Crashes": F.col("p_size"),
            "Daily ANRs": F.col("p_partkey"),
        },
    )
    return _finish(play.statistics_table(rows, "crashes", "com.app", "App"))


@query(
    "play_ratings",
    f"""
    SELECT {_STATS_SQL}, {_DIMENSION_SQL}, p_retailprice AS daily_average_rating,
           CASE WHEN p_size > 30 THEN p_retailprice ELSE 0.0 END AS total_average_rating
    FROM part
    """,
)
def play_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _either_dimension()
    rows = _statistics(
        spark,
        sf_dir,
        {
            "App Version Code": first,
            "Language": second,
            "Daily Average Rating": F.col("p_retailprice"),
            "Total Average Rating": F.when(F.col("p_size") > 30, F.col("p_retailprice").cast("string")),
        },
    )
    return _finish(play.statistics_table(rows, "ratings", "com.app", "App"))


@query(
    "play_store_performance",
    f"""
    SELECT {_STATS_SQL},
           CASE p_type WHEN 'ECONOMY' THEN p_brand WHEN 'SMALL' THEN p_name ELSE 'all' END AS dimension_value,
           p_partkey AS store_listing_acquisitions, CAST(p_size AS BIGINT) AS store_listing_visitors,
           p_retailprice AS store_listing_conversion_rate,
           CASE WHEN p_type = 'SMALL' THEN p_name END AS traffic_source,
           CASE WHEN p_type = 'SMALL' THEN p_brand END AS search_term,
           CAST(NULL AS VARCHAR) AS utm_source, CAST(NULL AS VARCHAR) AS utm_campaign
    FROM part
    """,
)
def play_store_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _statistics(
        spark,
        sf_dir,
        {
            "Country / region": F.col("p_brand"),
            "Traffic source": F.col("p_name"),
            "Search term": F.col("p_brand"),
            "Store listing acquisitions": F.col("p_partkey"),
            "Store listing visitors": F.col("p_size"),
            "Store listing conversion rate": F.col("p_retailprice"),
        },
    )
    return _finish(play.statistics_table(rows, "store_performance", "com.app", "App"))


# Header of the dimension in the crash files of a part type; files of the other types have none.
_CRASH_HEADER = {"ECONOMY": "Device", "LARGE": "Device", "MEDIUM": "App Version Code", "PROMO": "Android OS Version"}
_HAS_DIMENSION = f"p_type IN ({', '.join(repr(t) for t in _CRASH_HEADER)})"


@query(
    "play_csv_scan",
    f"""
    SELECT strftime(DATE '2024-01-01' + p_size, '%Y-%m-%d') AS date, {_KIND_SQL} AS dimension_type,
           CASE WHEN {_HAS_DIMENSION} THEN p_name || ', "x" é' ELSE 'all' END AS dimension_value,
           CASE WHEN p_type IN ('MEDIUM', 'STANDARD') THEN CAST(p_size AS BIGINT) ELSE 0 END AS daily_crashes,
           p_partkey AS daily_anrs
    FROM part
    """,
)
def play_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics files in UTF-16 of six dimensions with five kinds of header, written and scanned."""
    root, months = shared_dir(spark), set()
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("p_size")).cast("string").alias("Date")
    for kind, ending in _SUFFIX.items():
        rows = table(spark, sf_dir, "part").filter(F.col("p_type") == kind).select(
            day,
            *[F.concat("p_name", F.lit(', "x" é')).alias(_CRASH_HEADER[k]) for k in (kind,) if k in _CRASH_HEADER],
            *[F.col("p_name").alias("Traffic source") for k in (kind,) if k == "SMALL"],
            *[F.col("p_size").alias("Daily Crashes") for k in (kind,) if k in ("MEDIUM", "STANDARD")],
            F.col("p_partkey").alias("Daily ANRs"),
        )
        months |= _land_csv(spark, rows, root, "crashes", ending.removesuffix(".csv"))
    rows = read_play_csv(spark, root, "crashes", "com.app", sorted(months))
    out = play.statistics_table(rows, "crashes", "com.app", "App")
    return _finish(out).select("date", "dimension_type", "dimension_value", "daily_crashes", "daily_anrs")


@query(
    "statistics_run",
    f"""
    SELECT strftime(DATE '2024-01-01' + p_size, '%Y-%m-%d') AS date, {_KIND_SQL} AS dimension_type,
           CASE WHEN {_HAS_DIMENSION} THEN CAST(p_partkey AS VARCHAR) ELSE 'all' END AS dimension_value,
           CAST(sum(p_size) AS BIGINT) AS daily_crashes, CAST(count(*) AS BIGINT) AS daily_anrs
    FROM part GROUP BY ALL
    """,
)
def statistics_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics files of all months, loaded twice into their table; what was in the table for a key is replaced."""
    root, months = shared_dir(spark), set()
    lake = Lake(spark, f"{root}/lake")
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("p_size")).cast("string").alias("Date")
    for kind, ending in _SUFFIX.items():
        dimension = [F.col("p_partkey").alias(_CRASH_HEADER[kind])] if kind in _CRASH_HEADER else []
        rows = table(spark, sf_dir, "part").filter(F.col("p_type") == kind).groupBy(day, *dimension).agg(
            F.sum("p_size").alias("Daily Crashes"), F.count(F.lit(1)).alias("Daily ANRs")
        )
        months |= _land_csv(spark, rows, root, "crashes", ending.removesuffix(".csv"))
    last = dt.date(int(max(months)[:4]), int(max(months)[4:]), 1)
    for _ in range(2):
        load_statistics(lake, root, "crashes", "com.app", "App", last, n_months=len(months))
    return _finish(lake.table("google_play_crashes")).select("date", "dimension_type", "dimension_value", "daily_crashes", "daily_anrs")


def _land_csv(spark: SparkSession, df: DataFrame, root: str, kind: str, ending: str) -> set[str]:
    """Write UTF-16 files named as the store names them, one month per file; the months used."""
    staged = f"{root}/staged{ending}"
    df.write.option("header", True).option("encoding", "UTF-16").option("escape", '"').csv(staged)
    paths = spark._jvm.org.apache.hadoop.fs.Path
    fs = paths(staged).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(paths(f"{root}/stats/{kind}"))
    months = set()
    for i, part in enumerate(list_files(spark, f"{staged}/part-*.csv")):
        month = f"{2024 + i // 12}{i % 12 + 1:02d}"
        fs.rename(paths(part), paths(f"{root}/stats/{kind}/{kind}_com.app_{month}{ending}.csv"))
        months.add(month)
    return months


@query(
    "segment_scan",
    """
    SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS line,
           CASE WHEN l_linestatus = 'F' THEN l_returnflag END AS flag
    FROM lineitem
    """,
)
def segment_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report segments, some tab separated and compressed and some plain commas, read as one."""
    root, items = shared_dir(spark), table(spark, sf_dir, "lineitem")
    ids = [F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line")]
    tabs = items.filter(F.col("l_linestatus") == "F").select(*ids, F.col("l_returnflag").alias("flag"))
    commas = items.filter(F.col("l_linestatus") != "F").select(*ids)
    writer = tabs.write.option("header", True).option("sep", "\t").option("compression", "gzip")
    writer.csv(f"{root}/tabs")
    commas.write.option("header", True).csv(f"{root}/commas")
    paths = list_files(spark, f"{root}/tabs/part-*") + list_files(spark, f"{root}/commas/part-*")
    return read_segments(spark, paths).select("order_id", "line", "flag")
