import datetime as dt
import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from adlake.functions import dates, numbers, pgtypes, text, variants


@pytest.mark.parametrize(
    "given,expected",
    [
        ("1.5", 1.5), (" 7 ", 7.0), ("1_000", 1000.0), (".5", 0.5), ("5.", 5.0), ("1e3", 1000.0),
        ("+2", 2.0), ("-inf", -math.inf), ("Infinity", math.inf), ("1d", None), ("1f", None),
        ("", None), ("bad", None), ("1__0", None), ("_1", None), (None, None), ("0x1", None),
    ],
)
def test_try_float_takes_what_a_python_float_takes(one, given, expected):
    assert one(numbers.try_float(F.col("x")), row=(given,)) == expected


def test_try_float_nan(one):
    assert math.isnan(one(numbers.try_float(F.col("x")), row=("-NaN",)))


def test_strict_numbers(one):
    assert one(numbers.int_or_zero(F.col("x")), row=("",)) == 0
    assert one(numbers.int_or_zero(F.col("x")), row=(None,)) == 0
    assert one(numbers.float_or_zero(F.col("x")), row=("2.5",)) == 2.5
    with pytest.raises(PySparkException):
        one(numbers.int_or_zero(F.col("x")), row=("n/a",))


@pytest.mark.parametrize(
    "given,expected",
    [
        ("20240105", "2024-01-05"), ("2024-01-05", "2024-01-05"), (" 20240105\t", "2024-01-05"),
        ("202401", "202401"), ("", None), ("  ", None), (None, None), ("(other)", "(other)"),
    ],
)
def test_ga_date_key(one, given, expected):
    assert one(dates.ga_date_key(F.col("x")), row=(given,)) == expected


def test_day_key_shifts_midnight_utc_to_the_day_before(one):
    at = F.expr("TIMESTAMP_NTZ '2025-10-06 00:00:00'")
    assert one(dates.day_key(at)) == dt.date(2025, 10, 6)
    assert one(dates.day_key(at, dates.BUSINESS_TZ)) == dt.date(2025, 10, 5)


def test_day_key_of_a_zoned_time_ignores_the_session_zone(spark):
    df = spark.sql("SELECT TIMESTAMP '2025-10-06 00:30:00 UTC' AS ts")
    key = dates.day_key(F.col("ts"), None, df.schema["ts"].dataType)
    assert df.select(key).first()[0] == dt.date(2025, 10, 6)


def test_day_range_equals_the_day_key_and_reaches_the_scan(spark, tmp_path):
    hours = spark.range(24 * 40).select(
        F.expr("TIMESTAMP_NTZ '2025-03-01 00:00:00' + make_interval(0, 0, 0, 0, cast(id AS int))").alias("ts")
    )
    path = str(tmp_path / "t")
    hours.write.parquet(path)
    df = spark.read.parquet(path)
    # The range spans the change to daylight saving time.
    ranged = df.filter(dates.day_range_utc(F.col("ts"), "2025-03-08", "2025-03-10", dates.BUSINESS_TZ))
    keyed = df.filter(
        dates.day_key(F.col("ts"), dates.BUSINESS_TZ).between(dt.date(2025, 3, 8), dt.date(2025, 3, 10))
    )
    assert ranged.count() == 71
    assert ranged.exceptAll(keyed).count() == 0 and keyed.exceptAll(ranged).count() == 0
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2025-03-08T08:00), LessThan(ts,2025-03-11T07:00)]" in plan


@pytest.mark.parametrize(
    "name,given,expected",
    [
        ("date", "20240105", "2024-01-05 00:00:00"),
        ("dateHour", "2024010513", "2024-01-05 13:00:00"),
        ("dateHourMinute", "202401051307", "2024-01-05 13:07:00"),
        ("yearMonth", "202402", "2024-02-01 00:00:00"),
        ("year", "2024", "2024-01-01 00:00:00"),
        ("isoYearIsoWeek", "202401", "2024-01-01 00:00:00"),
        ("isoYearIsoWeek", "202053", "2020-12-28 00:00:00"),
        ("isoYearIsoWeek", "202101", "2021-01-04 00:00:00"),
        ("country", "DE", "DE"),
    ],
)
def test_time_dimensions(one, name, given, expected):
    assert str(one(dates.ga_time_dimension(name, F.col("x")), row=(given,))) == expected


def test_months_back_rolls_over_the_year(one):
    assert dates.months_back(2, dt.date(2025, 1, 31)) == ["202411", "202412", "202501"]
    column = dates.months_back_column(2, F.lit(dt.date(2025, 1, 31)))
    assert one(column) == ["202411", "202412", "202501"]


@pytest.mark.parametrize(
    "path,expected",
    [
        ("stats/installs/installs_com.app_202410_country.csv", "country"),
        ("stats/installs/installs_com.app_202410_app_version.csv", "app_version"),
        ("stats/installs/installs_com.app_202410_os_version.csv", "os_version"),
        ("stats/installs/installs_com.app_202410.csv", "overview"),
    ],
)
def test_dimension_type(one, path, expected):
    assert one(text.dimension_type(F.col("x")), row=(path,)) == expected


def test_text_helpers(one):
    assert one(text.last_segment(F.col("x")), row=("A.b.car",)) == "car"
    assert one(text.last_segment(F.col("x")), row=("car",)) == "car"
    assert one(text.py_str(F.col("x"))) == "None"
    assert one(text.py_str(F.col("x"), parity=False)) is None
    assert one(text.row_rank_id(F.lit(7), F.col("x"))) == "7-None"
    assert one(text.first_non_empty([F.lit(""), F.col("x")])) == "all"
    assert one(text.key_or_placeholder(F.col("x"), "ad_id")) == "no_ad_id"
    assert one(text.log_route(F.col("x")), row=("ad_fetch",)) == "legacy"
    assert one(text.log_route(F.col("x")), row=("other",)) is None


def test_json_get_tells_missing_from_null(one):
    def found(body):
        v = F.parse_json(F.lit(body))
        return one(variants.json_get(v, "$.a.b", "string", F.lit("default")))

    assert found('{"a": {"b": 1}}') == "1"
    assert found('{"a": {"b": null}}') is None
    assert found('{"a": {}}') == "default"
    assert found('{"a": null}') == "default"
    assert found('{"a": 5}') == "default"


def test_json_truth(one):
    def truth(body):
        return one(variants.is_json_true(F.parse_json(F.lit(body)), "$.a"))

    assert truth('{"a": 2}') and truth('{"a": "x"}')
    assert not any(map(truth, ('{"a": 0}', '{"a": null}', "{}", '{"a": ""}', '{"a": false}')))


def test_byte_fields(one):
    assert one(numbers.lsn_hex(F.lit(26999999999).cast("bigint"))) == "6/49534DFF"
    assert one(numbers.lsn_hex(F.lit(255).cast("bigint"))) == "0/000000FF"
    assert bytes(one(numbers.bytea(F.lit("\\x00ff")))) == b"\x00\xff"
    epoch = dates.pg_epoch(F.lit(1).cast("bigint")).cast("bigint")
    assert one(epoch) == 946684800
    payload = F.lit(bytearray(b"\xff\xff\xff\xfb\x00\x00\x00\x01"))
    assert one(pgtypes.be_int32(payload, 1)) == -5
    assert one(pgtypes.be_int64(payload, 1)) == -21474836479


def test_database_types():
    assert pgtypes.pg_type(1700, ((10 << 16) | 2) + 4).simpleString() == "decimal(10,2)"
    assert pgtypes.pg_type(1700, ((50 << 16) | 4) + 4).simpleString() == "decimal(38,4)"
    assert pgtypes.pg_type(1700).simpleString() == "decimal(38,9)"
    assert pgtypes.pg_type(1114).simpleString() == "timestamp_ntz"
    assert pgtypes.pg_type(1184).simpleString() == "timestamp"
    assert pgtypes.pg_type(999999).simpleString() == "string"
