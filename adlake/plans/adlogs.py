"""Application request logs: ads shown inline, and one statistics row per request."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from adlake.functions.text import last_segment, log_route, norm_case, py_str, row_rank_id
from adlake.functions.variants import is_json_true, json_get, json_items
from adlake.operators.incremental import incremental
from adlake.spec import MERGE, TableSpec

# Log names that carry ads, and the prefix whose last part is the vertical.
AD_LOG_NAMES = (
    "InlineAdsViewSet.car",
    "InlineAdsViewSet.flight",
    "InlineAdsViewSet.hotel",
    "ad_fetch",
)
LEGACY_NAME = "ad_fetch"
VIEW_PREFIX = "InlineAdsViewSet."

INLINE_ADS = TableSpec("inline_ad_logs", ("id",), MERGE, cursor="created_at")
AD_REQUEST_STATS = TableSpec("ad_request_stats", ("id",), MERGE, cursor="id")


def read_ad_logs(logs: DataFrame, cursor: str, last: Any = None) -> DataFrame:
    """Log rows that carry ads, past the high-water mark; both filters reach the scan."""
    return incremental(logs.filter(F.col("name").isin(*AD_LOG_NAMES)), cursor, last)


def _parsed(logs: DataFrame) -> DataFrame:
    return logs.withColumn("_v", F.try_parse_json("data")).withColumn("_route", log_route(F.col("name")))


def unknown_names(logs: DataFrame) -> DataFrame:
    """Rows per log name that no ad shape fits; they are left out of the ad table."""
    lost = logs.filter(log_route(F.col("name")).isNull())
    return lost.groupBy("name").agg(F.count(F.lit(1)).alias("n_rows"))


def _ad_columns() -> list[Column]:
    """Columns every ad shape takes from the ad itself."""
    ad = F.col("_ad")
    rank = F.try_variant_get(ad, "$.rank", "string")
    # Output column and path within the ad.
    fields = (
        ("site", "$.site", "string"),
        ("headline", "$.headline", "string"),
        ("product_type", "$.productType", "string"),
        ("description", "$.description", "string"),
        ("booking_button_text", "$.bookingButtonText", "string"),
        ("cpc_price", "$.cpcEstimate.price", "double"),
        ("cpc_currency", "$.cpcEstimate.currency", "string"),
    )
    return [
        row_rank_id(F.col("id"), rank).alias("id"),
        F.col("related_user_id").alias("user_id"),
        F.try_variant_get(ad, "$.rank", "bigint").alias("rank"),
        *[F.try_variant_get(ad, path, to).alias(name) for name, path, to in fields],
    ]


def _inline_rows(parsed: DataFrame, items: Column, trip: dict[str, Column]) -> DataFrame:
    shown = parsed.withColumns({**trip, "_items": items})
    rows = shown.withColumn("_ad", F.explode("_items"))
    return rows.select(*_ad_columns(), *trip, "created_at")


def _trip_v2(v: Column, route: Column) -> dict[str, Column]:
    """The trip of a car, flight or hotel log, read by shape."""

    def param(path: str, to: str = "string") -> Column:
        return F.try_variant_get(v, f"$.kwargs.params.{path}", to)

    def by_shape(car: Column, flight: Column, hotel: Column) -> Column:
        return F.when(route == "car", car).when(route == "flight", flight).when(route == "hotel", hotel)

    # Without the key there is one passenger; a null list counts as none.
    passengers = json_get(v, "$.kwargs.params.passengers", "variant")
    n_passengers = F.when(passengers.isNull(), F.lit(1)).otherwise(
        F.size(json_items(v, "$.kwargs.params.passengers"))
    )
    none_text, none_int = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    return {
        "cabin_class": by_shape(none_text, param("cabin"), none_text),
        "travelers": by_shape(none_int, n_passengers.cast("bigint"), param("adults", "bigint")),
        "start_date": by_shape(param("pickUpDate"), param("legs[0].date"), param("checkinDate")),
        "end_date": by_shape(param("dropOffDate"), param("legs[0].date"), param("checkoutDate")),
        "origin": py_str(
            by_shape(
                param("pickUpLocation.locationQuery"), param("legs[0].originAirport"), param("cityId")
            )
        ),
        "destination": py_str(
            by_shape(
                param("dropOffLocation.locationQuery"),
                param("legs[0].destinationAirport"),
                param("cityId"),
            )
        ),
        "os": F.try_variant_get(v, "$.kwargs.os", "string"),
        "country": F.try_variant_get(v, "$.kwargs.country", "string"),
        "version": F.lit(2.0),
    }


def _trip_v1(v: Column) -> dict[str, Column]:
    """The trip of a legacy log: whatever of a flight, a stay and a rental is there.

    A later kind wins where its key exists, even with a null value.
    """

    def layered(leg: str, stay: str, rental: str) -> Column:
        flight = F.try_variant_get(v, f"$.params.legs[0].{leg}", "string")
        hotel = json_get(v, f"$.params.{stay}", "string", flight)
        return json_get(v, f"$.params.{rental}", "string", hotel)

    passengers = F.try_variant_get(v, "$.params.passengers", "variant")
    n_passengers = F.when(passengers.isNull(), F.lit(1)).otherwise(F.size(json_items(v, "$.params.passengers")))
    adults = F.try_variant_get(v, "$.params.adults", "bigint")
    return {
        "cabin_class": F.try_variant_get(v, "$.params.cabinClass", "string"),
        "travelers": F.when(is_json_true(v, "$.params.adults"), adults).otherwise(
            n_passengers.cast("bigint")
        ),
        "start_date": layered("date", "checkinDate", "pickUpDate"),
        "end_date": layered("date", "checkoutDate", "dropOffDate"),
        "origin": layered("originAirport", "cityId", "pickUpLocation.locationQuery"),
        "destination": layered("destinationAirport", "cityId", "dropOffLocation.locationQuery"),
        "os": F.try_variant_get(v, "$.OS", "string"),
        "country": F.try_variant_get(v, "$.countryCode", "string"),
        "version": F.lit(1.0),
    }


def inline_ads(logs: DataFrame) -> DataFrame:
    """All inline ads, one row per ad; rows with an unknown log name are dropped.

    One scan, one parse and one explode for all shapes.
    """
    parsed = _parsed(logs).filter(F.col("_route").isNotNull())
    v, route = F.col("_v"), F.col("_route")
    legacy, old, new = route == "legacy", _trip_v1(v), _trip_v2(v, route)
    items = F.when(legacy, json_items(v, "$.response.inlineItems")).otherwise(json_items(v, "$.kwargs.inlineItems"))
    return _inline_rows(parsed, items, {c: F.when(legacy, old[c]).otherwise(new[c]) for c in new})


def ad_request_stats(logs: DataFrame) -> DataFrame:
    """One row per request; where its facts are depends on the log name."""
    parsed = _parsed(logs)
    v, name = F.col("_v"), F.col("name")
    legacy = name == LEGACY_NAME

    def either(old: str, new: str) -> Column:
        return F.when(legacy, F.try_variant_get(v, old, "string")).otherwise(
            F.try_variant_get(v, new, "string")
        )

    items = F.when(legacy, json_items(v, "$.response.inlineItems")).otherwise(
        json_items(v, "$.kwargs.inlineItems")
    )
    vertical = F.when(~legacy & name.startswith(VIEW_PREFIX), last_segment(name)).otherwise(
        F.col("vertical")
    )
    return parsed.select(
        "id",
        F.col("related_user_id").alias("user_id"),
        "name",
        norm_case(vertical).alias("vertical"),
        norm_case(either("$.countryCode", "$.kwargs.country"), "upper").alias("country"),
        norm_case(either("$.OS", "$.kwargs.os")).alias("os"),
        norm_case(either("$.deviceType", "$.kwargs.deviceType")).alias("device_type"),
        norm_case(either("$.source", "$.kwargs.source")).alias("source"),
        F.size(items).cast("bigint").alias("ad_count"),
        F.col("created_at").alias("request_time"),
    )
