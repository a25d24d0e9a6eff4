import gzip
import json
import os
import zipfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.operators.dedupe import latest
from adlake.plans import adlogs, appstore, ga4, gads, play
from adlake.sources import files
from adlake.sources.tables import read_jdbc_increment  # noqa: F401  (no database driver here)

ITEM = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])


def test_json_pages(spark, tmp_path):
    pages = [{"items": [{"id": 1, "v": "a"}, {"id": 2}], "next": "c"}, {"items": []}, {"data": [{"id": 9}]}]
    (tmp_path / "p.json").write_text("\n".join(map(json.dumps, pages)))
    got = files.read_json_items(spark, str(tmp_path), ITEM)
    assert sorted(map(tuple, got.collect())) == [(1, "a"), (2, None)]
    assert files.read_json_items(spark, str(tmp_path), ITEM, "data").first().id == 9
    printed = tmp_path / "printed"
    printed.mkdir()
    (printed / "p.json").write_text(json.dumps(pages[0], indent=2))
    assert files.read_json_items(spark, str(printed), ITEM, multi_line=True).count() == 2


def stats(root, kind, name, text):
    folder = root / "stats" / kind
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(text.encode("utf-16"))


def test_play_csv_reads_each_header_by_itself(spark, tmp_path):
    head = "Date,Package Name,"
    stats(tmp_path, "crashes", "crashes_com.app_202401_device.csv", f'{head}Device,Daily Crashes,Daily ANRs\n2024-01-02,com.app,"Pixel, 8 ""é""",3,\n')
    stats(tmp_path, "crashes", "crashes_com.app_202401.csv", f"{head}Daily ANRs,Daily Crashes\n2024-01-02,com.app,5,4\n")
    stats(tmp_path, "crashes", "crashes_com.app_202312.csv", f"{head}Daily ANRs,Daily Crashes\n2023-12-02,com.app,1,1\n")
    stats(tmp_path, "crashes", "crashes_com.app_pro_202401.csv", f"{head}Daily ANRs,Daily Crashes\n2024-01-02,com.app_pro,7,7\n")
    rows = files.read_play_csv(spark, str(tmp_path), "crashes", "com.app", ["202401"])
    out = play.statistics_table(rows, "crashes", "com.app", "App").orderBy("dimension_type").collect()
    assert [(r.dimension_type, r.dimension_value, r.daily_crashes, r.daily_anrs, r.date_key_pt) for r in out] == [
        ("device", 'Pixel, 8 "é"', 3, 0, "2024-01-02"),
        ("overview", "all", 4, 5, "2024-01-02"),
    ]
    assert files.read_play_csv(spark, str(tmp_path), "crashes", "com.none", ["202401"]) is None


def test_play_bad_metric_is_an_error(spark):
    df = spark.createDataFrame([("2024-01-02", "device", "n/a")], "Date string, dimension_type string, `Daily Crashes` string")
    with pytest.raises(PySparkException):
        play.statistics_table(df, "crashes", "p", "a").collect()


def test_store_performance_dimension(spark):
    df = spark.createDataFrame(
        [("2024-01-02", "country", "DE", "search"), ("2024-01-02", "traffic_source", "DE", "search"), ("2024-01-02", "overview", "DE", "search")],
        "Date string, dimension_type string, `Country / region` string, `Traffic source` string",
    )
    out = play.statistics_table(df, "store_performance", "p", "a").collect()
    assert [(r.dimension_value, r.traffic_source, r.store_listing_visitors) for r in out] == [("DE", None, 0), ("search", "search", 0), ("all", None, 0)]
    no_column = play.statistics_table(df.drop("Country / region"), "store_performance", "p", "a").collect()
    assert [r.dimension_value for r in no_column] == ["all", "search", "all"]
    narrow = next(s for s in play.specs() if s.name == "google_play_store_performance")
    wide = next(s for s in play.specs(wide=True) if s.name == "google_play_store_performance")
    assert "search_term" in narrow.order_by and "search_term" in wide.keys


def test_segments_of_every_kind(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Date,App Name,Sessions\n2024-01-01,"My, App",5\n')
    with gzip.open(tmp_path / "b.tsv.gz", "wt") as f:
        f.write("Date\tApp Name\tSessions\n2024-01-02\tMy\t6\n")
    with zipfile.ZipFile(tmp_path / "c.zip", "w") as z:
        z.writestr("first.txt", 'Date\tApp Name\tCrashes\n2024-01-03\t"two\nlines"\t7\n\n')
        z.writestr("more/second.csv", "Date,Sessions\n2024-01-04,8\n")
        z.writestr("empty.csv", "")
    paths = [str(tmp_path / n) for n in ("a.csv", "b.tsv.gz", "c.zip")]
    raw = appstore.raw_rows(
        files.read_segments(spark, paths), app_id="1", app_name="App", group_name="g", report_name="r", granularity="DAILY"
    )
    typed = appstore.typed_rows(raw.union(raw), "app_usage")
    got = sorted((str(r.Date), r.App_Name or "-", r.Sessions, r.Crashes, r._granularity) for r in typed.collect())
    assert got == [
        ("2024-01-01", "My, App", 5, None, "DAILY"),
        ("2024-01-02", "My", 6, None, "DAILY"),
        ("2024-01-03", "two\nlines", None, 7, "DAILY"),
        ("2024-01-04", "-", 8, None, "DAILY"),
    ]
    with pytest.raises(FileNotFoundError):
        files.read_segments(spark, [])


@pytest.mark.parametrize("multi_line", [True, False])
@pytest.mark.parametrize("row", ["1", "1,2,3"])
def test_a_row_of_another_length_fails_the_load(spark, tmp_path, row, multi_line):
    (tmp_path / "a.csv").write_text(f"x,y\n1,2\n{row}\n")
    with zipfile.ZipFile(tmp_path / "b.zip", "w") as z:
        z.writestr("b.csv", f"x,y\n1,2\n{row}\n")
    for name in ("a.csv", "b.zip"):
        with pytest.raises(Exception, match="MALFORMED|fields, not 2"):
            files.read_segments(spark, [str(tmp_path / name)], multi_line).collect()


def test_headers_are_read_without_their_files(spark, tmp_path):
    paths = [str(tmp_path / f"{n}.csv") for n in ("few", "many", "none", "one")]
    for path, header, n in zip(paths, ('a,"b ""x",c', 'a,"b ""x",c', None, "a\tb"), (1, 400_000, 0, 1), strict=True):
        with open(path, "w", encoding="utf-16") as f:
            f.write("" if header is None else f"{header}\r\n" + "1,two,and some more of it\r\n" * n)

    def bytes_read():
        return sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())

    before = bytes_read()
    assert files._header_groups(spark, paths, "UTF-16") == {'a,"b ""x",c': paths[:2], "a\tb": paths[3:]}
    assert bytes_read() - before < 4_000_000 < os.path.getsize(paths[1]) / 4


# --- report rows -------------------------------------------------------------------------


def page(spark, dimensions, metrics):
    return spark.createDataFrame([(dimensions, metrics)], "dimension_values array<string>, metric_values array<string>")


def test_report_metric_is_found_under_any_type(spark):
    for kind in ("TYPE_INTEGER", "TYPE_FLOAT"):
        rows = ga4.report_rows(page(spark, ["20240105", "web"], ["7"]), ["date", "platform"], [("sessions", kind)])
        out = ga4.report_table(rows, "ga4_user_engagement", 42, "g").first()
        assert (out.sessions, out.bounce_rate, out.date_key_pt, out.property_id) == (7, 0.0, "2024-01-05", "42")


def test_narrow_report_key_keeps_one_row_for_good(spark):
    spec = next(s for s in ga4.specs() if s.name == "ga4_traffic_sources")
    assert spec.keys == ("property_id", "date", "platform", "source", "medium") and spec.order_by == ("campaign",)
    rows = [(["20240105", "web", "s", "m", c], ["1", v]) for c, v in (("b", "2"), ("a", "9"))]
    raw = spark.createDataFrame(rows, "dimension_values array<string>, metric_values array<string>")
    named = ga4.report_rows(raw, ga4.report_dimensions("ga4_traffic_sources"), [("conversions", "TYPE_FLOAT"), ("totalRevenue", "TYPE_CURRENCY")])
    table = ga4.report_table(named, "ga4_traffic_sources", 42, "g")
    assert [r.campaign for r in latest(table, spec.keys, spec.order_by).collect()] == ["b"]


def test_budget_target_takes_the_first_that_is_set(spark):
    df = spark.sql(
        "SELECT named_struct('id', 1) customer, named_struct('id', 2, 'name', 'c', 'bidding_strategy_type', 'T',"
        " 'target_roas', named_struct('target_roas', 0D), 'maximize_conversion_value', named_struct('target_roas', 2.5D)) campaign,"
        " named_struct('amount_micros', 1500000L) campaign_budget"
    )
    row = gads.campaign_budgets(df, "g").first()
    assert (row.target_roas, row.daily_budget) == (2.5, 1.5)


# --- ad logs -----------------------------------------------------------------------------

LOG = "id bigint, name string, related_user_id bigint, vertical string, created_at timestamp_ntz, data string"


def logs(spark, *rows):
    return spark.createDataFrame([(i, n, 1, "V", None, json.dumps(d)) for i, (n, d) in enumerate(rows)], LOG)


def test_inline_ads_of_every_shape(spark):
    ad = {"rank": 3, "site": "s", "cpcEstimate": {"price": 1.5, "currency": "EUR"}}
    got = adlogs.inline_ads(
        logs(
            spark,
            ("InlineAdsViewSet.car", {"kwargs": {"inlineItems": [ad, {}], "params": {"pickUpDate": "d1", "dropOffLocation": {"locationQuery": 5}}}}),
            ("InlineAdsViewSet.flight", {"kwargs": {"inlineItems": [ad], "params": {"legs": [{"date": "d", "originAirport": "A"}]}}}),
            ("InlineAdsViewSet.flight", {"kwargs": {"inlineItems": [ad], "params": {"legs": [], "passengers": None}}}),
            ("InlineAdsViewSet.hotel", {"kwargs": {"inlineItems": None, "params": {}}}),
            ("Something.else", {"kwargs": {"inlineItems": [ad]}}),
        )
    ).orderBy("id").collect()
    assert [(r.id, r.start_date, r.origin, r.destination, r.travelers, r.cpc_price) for r in got] == [
        ("0-3", "d1", "None", "5", None, 1.5),
        ("0-None", "d1", "None", "5", None, None),
        ("1-3", "d", "A", "None", 1, 1.5),
        ("2-3", None, "None", "None", 0, 1.5),
    ]


def test_legacy_ads_let_a_later_kind_win(spark):
    items = {"response": {"inlineItems": [{"rank": 1}]}}
    leg = {"date": "leg", "originAirport": "A", "destinationAirport": "B"}

    def trip(**params):
        row = adlogs.inline_ads(logs(spark, ("ad_fetch", {"params": params, **items}))).first()
        return row.start_date, row.end_date, row.origin, row.destination, row.travelers

    assert trip(legs=[leg]) == ("leg", "leg", "A", "B", 1)
    assert trip(legs=[leg], checkinDate="in", cityId=7, adults=2) == ("in", "leg", "7", "7", 2)
    assert trip(legs=[leg], checkinDate="in", pickUpDate=None, adults=0, passengers=[1, 2, 3]) == (None, "leg", "A", "B", 3)


def test_request_stats(spark):
    got = adlogs.ad_request_stats(
        logs(
            spark,
            ("ad_fetch", {"OS": "IOS", "countryCode": "de", "response": {"inlineItems": [{}, {}]}}),
            ("InlineAdsViewSet.Car", {"kwargs": {"os": "IOS", "country": "us"}}),
            ("other", {}),
        )
    ).orderBy("id").collect()
    assert [(r.vertical, r.country, r.os, r.ad_count) for r in got] == [("v", "DE", "ios", 2), ("car", "US", "ios", 0), ("v", None, None, 0)]


def test_log_scan_pushes_names_and_mark(spark, tmp_path):
    import datetime as dt

    path = str(tmp_path / "logs")
    logs(spark, ("ad_fetch", {})).withColumn("created_at", F.expr("TIMESTAMP_NTZ '2024-01-02 00:00:00'")).write.parquet(path)
    df = adlogs.read_ad_logs(spark.read.parquet(path), "created_at", dt.datetime(2024, 1, 1))
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = df._jdf.queryExecution().explainString(mode)
    assert df.count() == 1 and "GreaterThan(created_at" in plan and "In(name" in plan
