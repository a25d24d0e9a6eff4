"""Application ad logs: one request per order, as the JSON each log shape has."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adlake.plans import adlogs
from adlake.workload.registry import query, table

# Log name of an order, by its priority.
_NAMES = {
    "1-URGENT": "InlineAdsViewSet.car",
    "2-HIGH": "InlineAdsViewSet.flight",
    "3-MEDIUM": "InlineAdsViewSet.hotel",
    "4-NOT SPECIFIED": "ad_fetch",
    "5-LOW": "OtherViewSet.list",
}


def _text(c: Column) -> Column:
    return F.concat(F.lit('"'), c.cast("string"), F.lit('"'))


def _object(**fields: Column) -> Column:
    """JSON object text; fields come as JSON texts, a NULL field is left out."""
    parts = [F.concat(F.lit(f'"{name}":'), value) for name, value in fields.items()]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def _array(*items: Column) -> Column:
    return F.concat(F.lit("["), F.concat_ws(",", *items), F.lit("]"))


def ad_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log row per order; what it lacks or holds as null depends on the order's status."""
    status, day = F.col("o_orderstatus"), F.date_format("o_orderdate", "yyyy-MM-dd")
    null = F.lit("null")
    finished, open_, partial = [status == s for s in ("F", "O", "P")]
    price = _object(price=F.col("o_totalprice").cast("string"), currency=F.lit('"USD"'))
    first = _object(
        rank=F.lit("1"),
        site=_text(F.concat(F.lit("site"), F.col("o_custkey").cast("string"))),
        headline=F.lit('"h"'),
        productType=F.lit("null"),
        cpcEstimate=price,
    )
    second = _object(site=F.lit('"other"'), description=F.lit('"d"'), bookingButtonText=F.lit('"Go"'))
    # Finished: no list at all; open: one ad; partial: two, the second without rank or price.
    items = F.when(open_, _array(first)).when(partial, _array(first, second))
    passengers = F.when(open_, F.lit("[1,2]")).when(partial, F.lit("[]"))
    leg = _object(date=_text(day), originAirport=F.lit('"SFO"'), destinationAirport=null)
    city = F.col("o_custkey").cast("string")
    car = _object(
        pickUpDate=_text(day),
        dropOffDate=F.when(open_, null),
        pickUpLocation=_object(locationQuery=_text(city)),
    )
    flight = _object(legs=_array(leg), cabin=F.lit('"eco"'), passengers=passengers)
    hotel = _object(
        checkinDate=_text(day),
        checkoutDate=F.when(open_, _text(day)),
        cityId=city,
        adults=F.lit("3"),
    )
    legacy = _object(
        legs=_array(leg),
        cityId=F.when(open_, city),
        pickUpDate=F.when(partial, null),
        adults=F.when(finished, F.lit("0")).when(open_, F.lit("4")),
        passengers=passengers,
        cabinClass=F.lit('"biz"'),
    )
    priority = F.col("o_orderpriority")
    params = F.when(priority == "1-URGENT", car).when(priority == "2-HIGH", flight).otherwise(hotel)
    facts = {
        "country": F.lit('"us"'),
        "deviceType": F.lit('"Phone"'),
        "source": F.when(open_, F.lit('"Home"')),
    }
    view = _object(kwargs=_object(os=F.lit('"iOS"'), **facts, params=params, inlineItems=items))
    fetch = _object(
        OS=F.lit('"Android"'),
        countryCode=F.lit('"de"'),
        deviceType=facts["deviceType"],
        source=facts["source"],
        params=legacy,
        response=F.when(~finished, _object(inlineItems=items)),
    )
    name = F.coalesce(*[F.when(priority == p, F.lit(n)) for p, n in _NAMES.items()])
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        name.alias("name"),
        F.col("o_custkey").alias("related_user_id"),
        F.lit("Stored").alias("vertical"),
        F.col("o_orderdate").alias("created_at"),
        F.when(priority == "4-NOT SPECIFIED", fetch).otherwise(view).alias("data"),
    )


_LOGS_SQL = """
    l AS (
      SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderstatus AS st,
             strftime(o_orderdate, '%Y-%m-%d') AS day, CAST(o_custkey AS VARCHAR) AS city,
             CASE o_orderpriority WHEN '1-URGENT' THEN 'car' WHEN '2-HIGH' THEN 'flight'
                  WHEN '3-MEDIUM' THEN 'hotel' WHEN '4-NOT SPECIFIED' THEN 'legacy' END AS shape
      FROM orders
    )
"""


@query(
    "inline_ads",
    f"""
    WITH {_LOGS_SQL},
    a AS (
      SELECT l.*, i FROM l, unnest(generate_series(1, 2)) AS t(i)
      WHERE shape IS NOT NULL AND ((st = 'O' AND i = 1) OR st = 'P')
    )
    SELECT CAST(o_orderkey AS VARCHAR) || CASE i WHEN 1 THEN '-1' ELSE '-None' END AS id, o_custkey AS user_id,
           CASE i WHEN 1 THEN 'site' || city ELSE 'other' END AS site,
           CASE i WHEN 1 THEN 'h' END AS headline, CASE i WHEN 2 THEN 'd' END AS description,
           CASE i WHEN 2 THEN 'Go' END AS booking_button_text,
           CASE i WHEN 1 THEN o_totalprice ELSE -1.0 END AS cpc_price, CASE i WHEN 1 THEN 'USD' END AS cpc_currency,
           CASE shape WHEN 'flight' THEN 'eco' WHEN 'legacy' THEN 'biz' END AS cabin_class,
           CAST(CASE shape WHEN 'car' THEN -1 WHEN 'flight' THEN CASE st WHEN 'O' THEN 2 ELSE 0 END
                      WHEN 'hotel' THEN 3 ELSE CASE st WHEN 'O' THEN 4 ELSE 0 END END AS BIGINT) AS travelers,
           CASE WHEN shape = 'legacy' AND st = 'P' THEN NULL ELSE day END AS start_date,
           CASE shape WHEN 'car' THEN NULL WHEN 'hotel' THEN CASE st WHEN 'O' THEN day END ELSE day END AS end_date,
           CASE shape WHEN 'flight' THEN 'SFO' WHEN 'legacy' THEN CASE st WHEN 'O' THEN city ELSE 'SFO' END
                ELSE city END AS origin,
           CASE shape WHEN 'car' THEN 'None' WHEN 'flight' THEN 'None' WHEN 'hotel' THEN city
                ELSE CASE st WHEN 'O' THEN city END END AS destination,
           CASE shape WHEN 'legacy' THEN 'Android' ELSE 'iOS' END AS os,
           CASE shape WHEN 'legacy' THEN 'de' ELSE 'us' END AS country, day AS created,
           CAST(CASE shape WHEN 'legacy' THEN 1.0 ELSE 2.0 END AS DOUBLE) AS version
    FROM a
    """,
)
def inline_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    ads = adlogs.inline_ads(ad_logs(spark, sf_dir))
    return ads.select(
        "id",
        "user_id",
        "site",
        "headline",
        "description",
        "booking_button_text",
        F.coalesce("cpc_price", F.lit(-1.0)).alias("cpc_price"),
        "cpc_currency",
        "cabin_class",
        F.coalesce("travelers", F.lit(-1)).alias("travelers"),
        "start_date",
        "end_date",
        "origin",
        "destination",
        "os",
        "country",
        F.date_format("created_at", "yyyy-MM-dd").alias("created"),
        F.col("version").cast("double").alias("version"),
    )


@query(
    "ad_request_stats",
    f"""
    WITH {_LOGS_SQL}
    SELECT o_orderkey AS id, o_custkey AS user_id,
           CASE shape WHEN 'car' THEN 'car' WHEN 'flight' THEN 'flight' WHEN 'hotel' THEN 'hotel' ELSE 'stored' END
             AS vertical,
           CASE shape WHEN 'legacy' THEN 'DE' ELSE 'US' END AS country,
           CASE shape WHEN 'legacy' THEN 'android' ELSE 'ios' END AS os, 'phone' AS device_type,
           CASE st WHEN 'O' THEN 'home' END AS source,
           CAST(CASE st WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS BIGINT) AS ad_count, day AS request_day
    FROM l
    """,
)
def ad_request_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = adlogs.ad_request_stats(ad_logs(spark, sf_dir))
    day = F.date_format("request_time", "yyyy-MM-dd")
    return stats.withColumn("request_day", day).drop("name", "request_time")


@query(
    "ad_log_scan",
    """
    SELECT o_orderkey AS id, CASE o_orderpriority WHEN '1-URGENT' THEN 'InlineAdsViewSet.car'
             WHEN '2-HIGH' THEN 'InlineAdsViewSet.flight' WHEN '3-MEDIUM' THEN 'InlineAdsViewSet.hotel'
             ELSE 'ad_fetch' END AS name
    FROM orders WHERE o_orderpriority <> '5-LOW' AND o_orderdate > TIMESTAMP '1999-06-01'
    """,
)
def ad_log_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = adlogs.read_ad_logs(ad_logs(spark, sf_dir), "created_at", dt.datetime(1999, 6, 1))
    return logs.select("id", "name")


@query(
    "unknown_log_names",
    "SELECT 'OtherViewSet.list' AS name, count(*) AS n_rows FROM orders WHERE o_orderpriority = '5-LOW'",
)
def unknown_log_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adlogs.unknown_names(ad_logs(spark, sf_dir))
