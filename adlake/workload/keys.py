"""Scalar functions: dates, texts, numbers and byte fields over whole columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from adlake.functions.dates import (
    day_key_from_string,
    ga_date_key,
    months_back_column,
    pg_epoch,
    play_date_key,
)
from adlake.functions.numbers import bytea, float_or_zero, int_or_zero, lsn_hex, try_float
from adlake.functions.text import (
    first_non_empty,
    fingerprint,
    key_or_placeholder,
    last_segment,
    norm_case,
    py_str,
    row_rank_id,
)
from adlake.functions.variants import json_get
from adlake.workload.registry import PROPS_K_SQL, query, table


@query(
    "report_dates",
    """
    SELECT o_orderkey,
           CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%d')
                WHEN 'O' THEN strftime(o_orderdate, '%Y-%m-%d')
                ELSE strftime(o_orderdate, '%Y%m') END AS ga_key,
           CASE WHEN o_orderstatus = 'P' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS play_key,
           CASE WHEN o_orderstatus = 'P' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day,
           strftime(o_orderdate - INTERVAL 3 MONTH, '%Y%m') || ',' || strftime(o_orderdate - INTERVAL 2 MONTH, '%Y%m')
             || ',' || strftime(o_orderdate - INTERVAL 1 MONTH, '%Y%m') || ',' || strftime(o_orderdate, '%Y%m')
             AS months
    FROM orders
    """,
)
def report_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    at, status = F.col("o_orderdate"), F.col("o_orderstatus")
    iso = F.date_format(at, "yyyy-MM-dd")
    ga = F.when(status == "F", F.concat(F.lit("  "), iso, F.lit("\t"))).when(
        status == "O", F.date_format(at, "yyyyMMdd")
    ).otherwise(F.date_format(at, "yyyyMM"))
    store = F.when(status == "P", F.lit("  ")).otherwise(F.concat(iso, F.lit(" ")))
    key = play_date_key(store)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        ga_date_key(ga).alias("ga_key"),
        key.alias("play_key"),
        day_key_from_string(key).cast("string").alias("day"),
        F.array_join(months_back_column(3, F.to_date(at)), ",").alias("months"),
    )


@query(
    "text_keys",
    """
    SELECT p_partkey, lower(p_brand) AS low, upper(p_name) AS up,
           CASE WHEN p_size > 25 THEN p_type ELSE 'Brand' || p_type END AS segment,
           CAST(p_partkey AS VARCHAR) || '-' || CASE WHEN p_size > 25 THEN CAST(p_size AS VARCHAR) ELSE 'None' END
             AS rank_id,
           CASE WHEN p_size > 25 THEN p_brand ELSE 'None' END AS shown,
           CASE WHEN p_size > 40 THEN p_brand WHEN p_size > 20 THEN p_name ELSE 'all' END AS first_of,
           CASE WHEN p_size > 25 THEN p_brand ELSE 'no_ad_id' END AS ad_id
    FROM part
    """,
)
def text_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    big, size = F.col("p_size") > 25, F.col("p_size")
    path = F.when(big, F.concat_ws(".", "p_brand", "p_name", "p_type")).otherwise(
        F.concat(F.lit("Brand"), F.col("p_type"))
    )
    first = F.when(size > 40, F.col("p_brand")).otherwise("")
    second = F.when(size > 20, F.col("p_name"))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        norm_case(F.col("p_brand")).alias("low"),
        norm_case(F.col("p_name"), "upper").alias("up"),
        last_segment(path).alias("segment"),
        row_rank_id(F.col("p_partkey"), F.when(big, size)).alias("rank_id"),
        py_str(F.when(big, F.col("p_brand"))).alias("shown"),
        first_non_empty([first, second]).alias("first_of"),
        key_or_placeholder(F.when(big, F.col("p_brand")), "ad_id").alias("ad_id"),
    )


@query(
    "hex_and_epoch",
    """
    SELECT o_orderkey,
           upper(to_hex(o_custkey)) AS high,
           upper(to_hex(o_custkey)) || '/' || lpad(upper(to_hex(o_orderkey)), 8, '0') AS lsn,
           strftime(TIMESTAMP '2000-01-01' + to_microseconds(o_orderkey * 1000000), '%Y-%m-%d %H:%M:%S') AS committed,
           o_orderpriority AS decoded
    FROM orders
    """,
)
def hex_and_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    lsn = lsn_hex(F.shiftleft("o_custkey", 32) + key)
    text = F.concat(F.lit("\\x"), F.lower(F.hex("o_orderpriority")))
    wall = F.convert_timezone(
        F.current_timezone(), F.lit("UTC"), pg_epoch(key * 1000000).cast("timestamp_ntz")
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.substring_index(lsn, "/", 1).alias("high"),
        lsn.alias("lsn"),
        F.date_format(wall, "yyyy-MM-dd HH:mm:ss").alias("committed"),
        F.decode(bytea(text), "UTF-8").alias("decoded"),
    )


@query(
    "try_numbers",
    f"""
    WITH e AS (SELECT event_id, event_type, value, {PROPS_K_SQL} AS k FROM events)
    SELECT event_id,
           CASE event_type WHEN 'view' THEN value WHEN 'click' THEN NULL WHEN 'purchase' THEN k * 1000.0
                WHEN 'signup' THEN NULL ELSE k / 10.0 END AS tolerant,
           CASE WHEN event_type = 'error' THEN 0 ELSE k END AS whole,
           CASE WHEN event_type = 'view' THEN value ELSE 0.0 END AS floating
    FROM e
    """,
)
def try_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, k = F.col("event_type"), F.regexp_extract("props", "([0-9]+)", 1)
    text = (
        F.when(kind == "view", F.concat(F.lit(" "), F.col("value").cast("string")))
        .when(kind == "click", F.concat(k, F.lit("d")))
        .when(kind == "purchase", F.concat(k, F.lit("_000")))
        .when(kind == "signup", F.lit("n/a"))
        .otherwise(F.concat(k, F.lit("e-1")))
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        try_float(text).alias("tolerant"),
        int_or_zero(F.when(kind == "error", "").otherwise(k)).alias("whole"),
        float_or_zero(F.when(kind == "view", F.col("value").cast("string"))).alias("floating"),
    )


@query(
    "fingerprints",
    """
    SELECT o_orderkey AS id, sha256('{"name":' || coalesce('"' || nullif(o_orderpriority, '5-LOW') || '"', 'null')
                                    || ',"status":"' || o_orderstatus || '"}') AS fp
    FROM orders
    """,
)
def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SHA-256 of the fields as canonical JSON; a NULL is a value of its own."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("name"),
    )
    return orders.select("id", fingerprint(["status", "name"]).alias("fp"))


@query(
    "json_paths",
    f"""
    WITH e AS (SELECT event_id, event_type, {PROPS_K_SQL} AS k FROM events)
    SELECT event_id, CASE event_type WHEN 'view' THEN CAST(k AS VARCHAR) WHEN 'click' THEN NULL
                          ELSE 'default' END AS found
    FROM e
    """,
)
def json_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A missing key or broken path takes the default, a JSON null does not."""
    kind = F.col("event_type")
    text = (
        F.when(kind == "view", F.concat(F.lit('{"a": '), F.col("props"), F.lit("}")))
        .when(kind == "click", F.lit('{"a": {"k": null}}'))
        .when(kind == "purchase", F.lit('{"a": 5}'))
        .when(kind == "signup", F.lit('{"a": null}'))
        .otherwise(F.lit("{}"))
    )
    rows = table(spark, sf_dir, "events").select("event_id", F.try_parse_json(text).alias("v"))
    return rows.select("event_id", json_get(F.col("v"), "$.a.k", "string", F.lit("default")).alias("found"))
