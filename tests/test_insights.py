import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from adlake.operators.merge import merge_report_rows
from adlake.operators.reports import report_grain
from adlake.plans import insights

PIXEL = "offsite_conversion.fb_pixel_"
ENTRY = "array<struct<action_type:string,value:string>>"
LABELLED = "array<struct<action_type:string,label:string,value:string>>"
SCHEMA = f"actions {ENTRY}, action_values {ENTRY}, conversions {LABELLED}, conversion_values {LABELLED}"


def metrics(spark, actions=None, action_values=None, conversions=None, conversion_values=None):
    df = spark.createDataFrame([(actions, action_values, conversions, conversion_values)], SCHEMA)
    row = insights.add_event_metrics(df).first()
    return row.trial_starts, row.trial_start_value, row.subscriptions, row.subscription_value


EVENTS = {
    "trial": (insights.TRIAL_EVENTS, 0, 1),
    "subscription": (insights.SUBSCRIPTION_EVENTS, 2, 3),
}


def by_rule(events, values):
    """The metric of (type, value) entries, spelled out: combined, else the parts added up, else the plain event."""
    first = {}
    for kind, value in values:
        try:
            first.setdefault(kind.strip().lower(), float(value))
        except (TypeError, ValueError):
            continue
    pick = lambda names: next((first[n] for n in names if n in first), None)
    parts = [pick(group) for group in events["components"]]
    total = sum(p for p in parts if p is not None) if any(p is not None for p in parts) else None
    return next((v for v in (pick(events["omni"]), total, pick(events["fallback"])) if v is not None), 0.0)


def test_malformed_or_missing_arrays_are_zero(spark):
    assert metrics(spark) == (0.0,) * 4
    assert metrics(spark, actions=[], conversion_values=[(None, "x", "3"), None, ("omni_start_trial", None, "much")]) == (0.0,) * 4


@pytest.mark.parametrize("kind", EVENTS)
def test_event_metrics_follow_the_rule(spark, kind):
    """Random arrays of the event's names, in odd spellings and with values that are no numbers."""
    events, count, value = EVENTS[kind]
    names = [*events["omni"], *(n for g in events["components"] for n in g), *events["fallback"], "other"]
    rng = random.Random(kind)
    rows = []
    for _ in range(60):
        own = [n for n in names if rng.random() < 0.25]
        spelled = [rng.choice([n, n.upper(), f" {n}\t"]) for n in own + own[:1]]
        rows.append([(n, rng.choice(["none", "", f"{rng.randint(1, 40) / 8}", f" {rng.randint(1, 9)}e1 "])) for n in spelled])
    df = spark.createDataFrame([(r, r[::-1], None, None) for r in rows], SCHEMA)
    found = insights.add_event_metrics(df).select("trial_starts", "trial_start_value", "subscriptions", "subscription_value").collect()
    assert [r[count] for r in found] == [by_rule(events, r) for r in rows]
    assert [r[value] for r in found] == [by_rule(events, r[::-1]) for r in rows]


def test_conversions_go_before_actions(spark):
    name = "subscribe_mobile_app"
    both = dict(actions=[(name, "31")], action_values=[(name, "310")])
    assert metrics(spark, **both)[2:] == (31.0, 310.0)
    assert metrics(spark, **both, conversions=[(name, None, "6")], conversion_values=[(name, None, "6.75")])[2:] == (6.0, 6.75)
    # An entry that is no number doesn't stand in the way of a later array.
    assert metrics(spark, **both, conversions=[(name, None, "-")])[2] == 31.0


def test_events_without_any_array(spark):
    row = insights.add_event_metrics(spark.createDataFrame([(1,)], "x int")).first()
    assert (row.trial_starts, row.subscription_value) == (0.0, 0.0)


def test_expand_takes_the_first_numeric_value_and_keeps_existing_columns(spark):
    df = spark.createDataFrame(
        [([("search", "bad"), ("search", "2"), ("search", "3"), ("Search", "9")], 5.0), (None, 6.0)],
        f"actions {ENTRY}, actions_link_click double",
    )
    rows = insights.expand_actions(df, "actions", ("search", "link_click"), "actions_").collect()
    assert [(r.actions_search, r.actions_link_click) for r in rows] == [(2.0, 5.0), (None, 6.0)]


def test_flatten_has_every_column_even_without_the_arrays(spark):
    out = insights.flatten_insights(spark.createDataFrame([("a",)], "ad_id string"))
    flat = [f"{p}{t}" for _, p, types in insights.EXPANDED_ACTIONS for t in types]
    assert set(flat) <= set(out.columns)
    assert out.first().actions_search is None


def test_cost_per_result_is_the_first_value(spark):
    schema = (
        "cost_per_result array<struct<indicator:string,values:array<struct<value:string,attribution_windows:array<string>>>>>"
    )
    rows = [([("i", [("0.97", ["default"])])],), ([("i", [])],), ([],), (None,), ([("i", [("x", None)])],)]
    out = insights.flatten_insights(spark.createDataFrame(rows, schema))
    assert [r.cost_per_result for r in out.collect()] == [0.97, None, None, None, None]


@pytest.mark.parametrize(
    "values,expected",
    [
        (
            [
                ("offsite_conversion.custom.8", "Yearly SUBSCRIBE done", "1.00004"),
                ("Subscribe_Mobile_App", None, "0.5"),
                ("offsite_conversion.custom.9", "Subscribed again", "2e1"),
                (f"{PIXEL}lead", "Lead", "700"),
            ],
            21.5,
        ),
        ([("subscribe_mobile_app", None, "?"), (None, "subscribe", None), None, ("other", None, "4")], 0.0),
        (None, 0.0),
    ],
)
def test_subscribe_revenue(spark, values, expected):
    df = spark.createDataFrame([(values,)], f"conversion_values {LABELLED}")
    assert insights.add_subscription_revenue(df).first().subscription_revenue == expected


KEYS = list(insights.REPORT_KEYS)
KEY_SCHEMA = "campaign_id string, adset_id string, ad_id string, date_start string"


def test_report_merge_keeps_rows_of_both_sides(spark):
    core = spark.createDataFrame(
        [("c1", "s1", "a1", "d1", 10), ("c2", "s2", "a1", "d1", 20)], f"{KEY_SCHEMA}, impressions int"
    )
    unique = spark.createDataFrame(
        [("c1", "s1", "a1", "d1", 7), ("c3", "s3", "a3", "d2", 3)], f"{KEY_SCHEMA}, reach int"
    )
    rows = merge_report_rows([core, unique], KEYS).collect()
    assert sorted((r.campaign_id, r.impressions or -1, r.reach or -1) for r in rows) == [
        ("c1", 10, 7), ("c2", 20, -1), ("c3", -1, 3),
    ]


def test_report_merge_lets_a_later_null_override(spark):
    a = spark.createDataFrame([("c", "s", "a", "d", "first")], f"{KEY_SCHEMA}, name string")
    b = spark.createDataFrame([("c", "s", "a", "d", None)], f"{KEY_SCHEMA}, name string")
    assert merge_report_rows([a, b], KEYS).first().name is None
    assert merge_report_rows([b, a], KEYS).first().name == "first"


def test_split_keeps_identity_on_both_sides(spark):
    df = spark.createDataFrame([("a", "x", 1, 2)], "ad_id string, ad_name string, reach int, clicks int")
    core, unique = insights.split_metrics(df)
    assert core.columns == ["ad_id", "ad_name", "clicks"]
    assert unique.columns == ["ad_id", "ad_name", "reach"]
    assert insights.split_metrics(core)[1] is None


def test_insights_table_types_and_placeholders(spark):
    df = spark.createDataFrame(
        [("1", "2024-01-05", "1.25", "12")], "ad_id string, date_start string, spend string, clicks string"
    )
    out = insights.insights_table(df, "act-1", "g1")
    row = out.first()
    assert (row.account_id, row.managing_system, row.campaign_id) == ("act-1", "g1", "no_campaign_id")
    assert row.date_start == dt.date(2024, 1, 5) and row.clicks == 12
    assert out.schema["spend"].dataType.simpleString() == "decimal(38,9)"
    assert out.schema["reach"].dataType.simpleString() == "bigint" and row.reach is None


def test_grain_recomputes_ratios_and_leaves_unique_metrics_out(spark):
    rows = [
        ("a", "c", "s", "1", dt.date(2024, 1, 1), 100, 10, 5.0),
        ("a", "c", "s", "2", dt.date(2024, 1, 3), 300, 10, 15.0),
        ("a", "c", "s", "2", dt.date(2024, 1, 8), 0, 0, 0.0),
    ]
    df = spark.createDataFrame(
        rows,
        "account_id string, campaign_id string, adset_id string, ad_id string, date_start date,"
        " impressions bigint, clicks bigint, spend double",
    )
    got = report_grain(df, "campaign", days=7, since="2024-01-01").orderBy("date_start").collect()
    assert [(str(r.date_start), str(r.date_stop), r.impressions, r.ctr, r.cpc) for r in got] == [
        ("2024-01-01", "2024-01-07", 400, 5.0, 1.0),
        ("2024-01-08", "2024-01-14", 0, None, None),
    ]
    assert got[0].reach is None


def test_landed_report_files_follow_the_line_items(spark, monkeypatch, tmp_path):
    from adlake.workload import ads, registry

    monkeypatch.setattr(registry, "ROWS_A_FILE", 10)
    row = F.struct(
        F.col("id").alias("l_orderkey"), F.lit(1).cast("bigint").alias("l_partkey"), F.lit(1).cast("int").alias("l_linenumber"),
        F.lit(2.0).alias("l_quantity"), F.lit(3.0).alias("l_extendedprice"), F.lit(0.1).alias("l_discount"), F.lit(0.2).alias("l_tax"),
        F.lit("A").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
    )
    spark.range(0, 200, 1, 1).select(row.alias("r")).select("r.*").write.parquet(str(tmp_path / "lineitem.parquet"))
    landed = ads.landed_ad_rows(spark, str(tmp_path))
    sizes = [r["count"] for r in landed.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 200 and len(sizes) == 20 and max(sizes) <= 12
