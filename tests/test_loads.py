import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.operators import dedupe, diff, incremental, merge, project, quality, reports, sinks, windows
from adlake.plans import exports
from adlake.sources.tables import pull_increment, read_entities
from adlake.spec import APPEND, MERGE, REPLACE, TableSpec, check_schema_version, disposition_for, table_name


def pairs(df):
    return sorted(map(tuple, df.collect()), key=str)


# --- windows -----------------------------------------------------------------------------

def plan(spark, end, checkpoint, cursor, **kwargs):
    df = spark.createDataFrame([("e", checkpoint, cursor)], "entity string, checkpoint string, cursor string")
    rows = windows.plan_windows(df, end, **kwargs).orderBy("start").collect()
    return [(r.start, r.end) for r in rows]


def due_from(end, mark, initial_days=windows.INITIAL_DAYS, lag_days=windows.LAG_DAYS):
    """The rule: a first load goes back its days, a later one to the mark (at most the end) less the lag."""
    return end - dt.timedelta(initial_days) if mark is None else min(mark, end) - dt.timedelta(lag_days)


LEAP, MONTH_END = dt.date(2024, 3, 4), dt.date(2025, 8, 31)


@pytest.mark.parametrize("end", [LEAP, MONTH_END])
@pytest.mark.parametrize(
    "ago,checkpoint,cursor",
    [
        (None, None, None),
        (None, " ", "soon"),
        (0, "{}", None),
        (4, "{}", "1999-12-31"),
        (-200, "{}", None),
        (12, "2024-02-30", "{}T23:59:59Z"),
        (35, None, "{}"),
    ],
)
def test_windows_follow_the_rule(spark, end, ago, checkpoint, cursor):
    """Marks of every kind, around a leap day and a month's end: on the end, after it, broken, and older ones."""
    mark = None if ago is None else end - dt.timedelta(ago)
    got = plan(spark, end, checkpoint and checkpoint.format(mark), cursor and cursor.format(mark))
    assert got[0][0] == due_from(end, mark) and got[-1][1] == end
    assert all((b - a).days < windows.MAX_DAYS for a, b in got)
    assert all(b[0] == a[1] + dt.timedelta(days=1) for a, b in zip(got, got[1:]))


def test_a_lag_longer_than_the_history_and_no_lag(spark):
    day = LEAP - dt.timedelta(3)
    assert plan(spark, LEAP, str(day), None, lag_days=90)[0][0] == day - dt.timedelta(90)
    assert plan(spark, LEAP, str(day), None, lag_days=0)[0] == (day, LEAP)


def test_windows_do_not_go_past_the_retention(spark):
    assert plan(spark, MONTH_END, None, None, initial_days=9_999)[0][0] == dt.date(2022, 7, 31)
    assert plan(spark, LEAP, "1970-01-01", None, retention_months=1)[0][0] == dt.date(2024, 2, 4)


@pytest.mark.parametrize("longest", [1, 3, 31])
def test_windows_are_cut_to_the_longest_load(spark, longest):
    got = plan(spark, LEAP, str(LEAP - dt.timedelta(6)), None, max_days=longest)
    days = [a + dt.timedelta(k) for a, b in got for k in range((b - a).days + 1)]
    assert days == [LEAP - dt.timedelta(k) for k in range(13, -1, -1)]
    assert [(b - a).days + 1 for a, b in got][:-1] == [longest] * (len(got) - 1)


def test_invalid_marks_are_named(spark):
    df = spark.createDataFrame(
        [("a", "not-a-date", None), ("b", "2026-01-01", None), ("c", None, "")],
        "entity string, checkpoint string, cursor string",
    )
    assert [(r.entity, r.mark) for r in windows.invalid_marks(df).collect()] == [("a", "checkpoint")]


def test_window_loop_commits_in_order_and_stops_at_a_failure(spark):
    df = spark.createDataFrame(
        [("a", "2026-01-08", None), ("b", "2026-01-16", None)], "entity string, checkpoint string, cursor string"
    )
    planned = windows.plan_windows(df, dt.date(2026, 1, 20))
    loaded, committed = [], []

    def load(start, end, entities):
        if start.day == 17:
            raise RuntimeError("service failed")
        loaded.append((start.day, end.day, sorted(r.entity for r in entities.collect())))

    def commit(rows):
        committed.extend((r.entity, r.checkpoint) for r in rows.collect())

    with pytest.raises(RuntimeError):
        windows.run_windows(planned, load, commit)
    assert loaded == [(1, 8, ["a"]), (9, 16, ["a", "b"])]
    assert sorted(committed) == [("a", "2026-01-08"), ("a", "2026-01-16"), ("b", "2026-01-16")]


# --- increments --------------------------------------------------------------------------


def test_increment_is_strict_unless_asked(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    assert incremental.incremental(df, "id").count() == 3
    assert incremental.incremental(df, "id", 2).count() == 1
    assert incremental.incremental(df, "id", 2, inclusive=True).count() == 2
    assert incremental.next_cursor(df, "id") == 3
    assert incremental.next_cursor(df.limit(0), "id") is None


def test_increment_of_times_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT TIMESTAMP_NTZ '2024-01-02 10:00:00' AS ts, 1 AS id").write.parquet(path)
    df = incremental.incremental(spark.read.parquet(path), "ts", dt.datetime(2024, 1, 2, 9))
    assert df.count() == 1
    assert "GreaterThan(ts,2024-01-02T09:00)" in df._jdf.queryExecution().executedPlan().toString()


def whole_ties(df, cursor, n):
    """The first n rows by cursor, with all that share the last one's value; those without a value come first."""
    values = sorted(r[cursor] for r in df.select(cursor).collect() if r[cursor] is not None)
    last = values[min(n, len(values)) - 1]
    edge = F.lit(str(last)).cast("timestamp_ntz") if isinstance(last, dt.datetime) else F.lit(last)
    return df.filter(F.col(cursor).isNull() | (F.col(cursor) <= edge))


@pytest.mark.parametrize("n", [1, 999, 1000, 5000, 9999, 20_000])
@pytest.mark.parametrize("kind", ["int", "string", "timestamp_ntz"])
def test_a_cap_never_parts_equal_cursor_values(spark, n, kind):
    # A third of the rows shares one cursor value, and some have none.
    number = F.when(F.col("id") % 3 == 0, F.lit(500)).when(F.col("id") % 100 != 1, F.pmod(F.xxhash64("id"), F.lit(10**6)))
    at = F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'") + F.make_interval(secs=number)
    df = spark.range(12_000).select("id", (at if kind == "timestamp_ntz" else number.cast(kind)).alias("c"))
    got, want = incremental.capped(df, "c", n), whole_ties(df, "c", n)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


@pytest.mark.parametrize("few", [incremental.FEW_VALUES, 0])
def test_the_last_position_is_exact(spark, monkeypatch, few):
    rng = random.Random(5)
    monkeypatch.setattr(incremental, "FEW_VALUES", few)
    values = [rng.choice([rng.randrange(10**12), 7, -5, rng.randrange(100)]) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "c bigint").repartition(3)
    for n in (1, 2, 700, 1500, 2999):
        assert incremental._last_position(df, F.col("c"), n) == sorted(values)[n - 1] == incremental._counted_position(df, F.col("c"), n)
    assert incremental._last_position(df, F.col("c"), 3000) is None and incremental._last_position(df.limit(0), F.col("c"), 1) is None


def test_a_sketch_that_errs_is_found_out(spark, monkeypatch):
    monkeypatch.setattr(incremental, "SKETCH_K", 8)
    monkeypatch.setattr(incremental, "SKETCH_ERROR", 0.0)
    df = spark.range(5000).select(F.col("id").alias("c"))
    for n in (1, 17, 2500, 4998):
        assert incremental._last_position(df, F.col("c"), n) == n - 1


@pytest.mark.parametrize("cap", [1, 2, 3, 100])
def test_capped_runs_load_every_row(spark, cap):
    df = spark.createDataFrame([(1, 1), (2, 2), (3, 2), (4, 2), (5, 3), (6, None), (7, None)], "id int, c int")
    spec = TableSpec("t", ("id",), MERGE, cursor="c")
    seen, mark = [], None
    while rows := pull_increment(df, spec, mark, cap).collect():
        seen += [r.id for r in rows]
        mark = max(r.c for r in rows if r.c is not None)
    assert sorted(seen) == [1, 2, 3, 4, 5, 6, 7]


def test_a_cap_over_rows_without_a_cursor_value(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, 5)], "id int, c int")
    assert incremental.capped(df, "c", 1).count() == 3
    assert incremental.capped(df.filter("c is null"), "c", 1).count() == 2
    assert incremental.capped(df.limit(0), "c", 1).count() == 0
    with pytest.raises(ValueError, match="at least one"):
        incremental.capped(df, "c", 0)


def test_pulls_have_no_cap_unless_asked(spark):
    spec = TableSpec("t", ("id",), MERGE, cursor="c")
    df = spark.createDataFrame([(1, 1), (2, 2), (3, 2)], "id int, c int")
    assert pull_increment(df, spec).count() == 3
    assert [r.id for r in pull_increment(df, spec, 2, inclusive=True).orderBy("id").collect()] == [2, 3]


def test_rolling_range_has_one_day_more(spark):
    start, end = incremental.rolling_range(30, dt.date(2024, 1, 31))
    assert (end - start).days + 1 == 31
    assert incremental.positive_or_default("12", 30) == 12
    assert [incremental.positive_or_default(t, 30) for t in ("x", "-1", "0", "", None)] == [30] * 5


def test_report_range():
    today = dt.date(2024, 5, 10)
    assert incremental.report_range(dt.date(2024, 5, 1), "2020-01-01", today) == (dt.date(2024, 5, 2), dt.date(2024, 5, 9))
    assert incremental.report_range(None, None, today)[0] == dt.date(2022, 8, 14)
    assert incremental.report_range(dt.date(2024, 5, 9), None, today) is None
    assert incremental.time_dimension(["country", "yearMonth", "date"])[0] == "yearMonth"
    assert incremental.time_dimension(["country"]) == ("date", ["country", "date"])


def test_report_increment_is_empty_when_up_to_date(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-05-09 00:00:00' AS date")
    assert incremental.report_increment(df, "date", dt.date(2024, 5, 9), dt.date(2024, 5, 10)).count() == 0
    assert incremental.report_increment(df, "date", dt.date(2024, 5, 8), dt.date(2024, 5, 10)).count() == 1


def test_pull_on_the_first_load_is_capped_in_cursor_order(spark):
    spec = TableSpec("t", ("id",), MERGE, cursor="updated_at")
    df = spark.createDataFrame([(1, 30), (2, 10), (3, 20)], "id int, updated_at int")
    first = pull_increment(df, spec, None, 2)
    assert sorted(r.id for r in first.collect()) == [2, 3]
    rest = pull_increment(df, spec, incremental.next_cursor(first, "updated_at"), 2)
    assert [r.id for r in rest.collect()] == [1]


# --- merges ------------------------------------------------------------------------------


def test_merge_is_idempotent_and_replaces_whole_rows(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id int, name string, v int")
    updates = spark.createDataFrame([(2, None, 5), (3, "c", 7), (3, "d", 6)], "id int, name string, v int")
    once = merge.merge_upsert(target, updates, ["id"], ["v"])
    assert pairs(once) == [(1, "a", 1), (2, None, 5), (3, "c", 7)]
    assert pairs(merge.merge_upsert(once, updates, ["id"], ["v"])) == pairs(once)


def test_latest_with_a_map_column(spark):
    df = spark.createDataFrame([(1, 1, {"a": 1}), (1, 2, {"a": 2})], "id int, v int, m map<string,int>")
    assert dedupe.latest(df, ["id"], ["v"]).first().m == {"a": 2}


def test_drop_seen_keeps_rows_without_an_id(spark):
    df = spark.createDataFrame([("c1", 1), ("c1", 2), ("c2", 2), (None, 1), (None, 1)], "id string, page int")
    assert pairs(dedupe.drop_seen(df, "id", ["page"])) == [("c1", 1), ("c2", 2), (None, 1), (None, 1)]


def test_unique_check(spark):
    with pytest.raises(ValueError, match="duplicate"):
        dedupe.assert_unique(spark.createDataFrame([(1,), (1,)], "id int"), ["id"])
    dedupe.assert_unique(spark.createDataFrame([(1,), (2,)], "id int"), ["id"])


def test_enrich_overrides_where_it_matches(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    extra = spark.createDataFrame([(1, None, "x")], "id int, name string, more string")
    assert pairs(merge.enrich(df, extra, "id")) == [(1, None, "x"), (2, "b", None)]
    with pytest.raises(ValueError, match="without a match"):
        merge.enrich(df, extra, "id", require_all=True)


# --- snapshot differences ----------------------------------------------------------------

LIGHT = "account_id string, id string, name string, status string, effective_object_story_id string"
KEYS = ["account_id", "id"]


def test_changed_rows_and_state(spark):
    """Each field is changed in a row of its own, one row is new, one gone, and one belongs to another account."""
    base = [("acc", f"c{k}", "title", "ON", "post") for k in range(5)]
    fields = ["name", "status", "effective_object_story_id"]
    now = spark.createDataFrame(base, LIGHT)
    for k, f in enumerate(fields):
        now = now.withColumn(f, F.when(F.col("id") == f"c{k}", F.lit(None)).otherwise(F.col(f)))
    now = now.filter("id <> 'c4'").union(spark.createDataFrame([("acc", "fresh", "t", "ON", None), ("other", "c3", "title", "ON", "post")], LIGHT))
    state = diff.with_fingerprint(spark.createDataFrame(base, LIGHT)).select(*KEYS, "fingerprint")
    changed = diff.changed_rows(now, state, KEYS)
    assert sorted((r.account_id, r.id) for r in changed.collect()) == [("acc", "c0"), ("acc", "c1"), ("acc", "c2"), ("acc", "fresh"), ("other", "c3")]
    # The state is that of the rows that were stored; the one that is gone keeps its own.
    partly = diff.next_state(state, changed.filter("id <> 'c1'"), KEYS)
    assert [r.id for r in diff.changed_rows(now, partly, KEYS).collect()] == ["c1"]
    whole = diff.next_state(state, changed, KEYS)
    assert diff.changed_rows(now, whole, KEYS).count() == 0 and whole.count() == 7
    heavy = spark.createDataFrame([("c0", 1.5), ("fresh", 2.5), ("c3", 0.5)], "id string, spend double")
    found = diff.hydrate(changed.filter("id in ('c0', 'fresh')"), heavy, "id")
    assert sorted((r.id, r.spend) for r in found.collect()) == [("c0", 1.5), ("fresh", 2.5)]
    with pytest.raises(ValueError, match="without a match"):
        diff.hydrate(changed, heavy, "id")


def test_null_is_not_the_empty_text(spark):
    a = spark.createDataFrame([("A", "1", None, "s", "")], LIGHT)
    b = spark.createDataFrame([("A", "1", "", "s", None)], LIGHT)
    state = diff.with_fingerprint(a).select(*KEYS, "fingerprint")
    assert diff.changed_rows(b, state, KEYS).count() == 1


def test_refresh_mode():
    assert diff.refresh_mode("incremental", False, False) == "full"
    assert diff.refresh_mode("auto", True, True) == "full"
    assert diff.refresh_mode("auto", True, False) == "incremental"
    assert diff.refresh_mode("full", True, False) == "full"
    with pytest.raises(ValueError):
        diff.refresh_mode("weekly", True, False)


# --- backfill and completeness -----------------------------------------------------------

STAGED = (
    "id string, subtotal_eur decimal(10,2), profit_eur decimal(10,2), item_count bigint,"
    " distinct_plan_count bigint, is_cart boolean"
)


def staged(spark, ids):
    from decimal import Decimal

    return spark.createDataFrame([(i, Decimal(20), Decimal(8), 3, 2, True) for i in ids], STAGED)


def test_staging_keeps_the_named_fields_only(spark, tmp_path):
    source = staged(spark, ["order-1"]).withColumn("total_eur", F.lit(18.0))
    out = sinks.stage_backfill(source, quality.BACKFILL_FIELDS, "id", str(tmp_path / "s"))
    assert out.columns == list(quality.BACKFILL_FIELDS)
    with pytest.raises(ValueError, match="lacks fields"):
        sinks.stage_backfill(source.select("id"), quality.BACKFILL_FIELDS, "id", str(tmp_path / "t"))
    with pytest.raises(ValueError, match="duplicate"):
        sinks.stage_backfill(source.union(source), quality.BACKFILL_FIELDS, "id", str(tmp_path / "u"))


def test_backfill_verdict(spark):
    ids = ["1", "2", "3"]
    existing = spark.createDataFrame([(i,) for i in ids + ["3"]], "id string")
    good = quality.backfill_stats(staged(spark, ids), existing).first().asDict()
    assert quality.backfill_verdict(good, 3)["row_count"] == 3
    bad = quality.backfill_stats(staged(spark, ids[:2]), existing).first().asDict()
    with pytest.raises(ValueError, match="missing_from_staging"):
        quality.backfill_verdict(bad, 2)
    extra = quality.backfill_stats(staged(spark, ids + ["4"]), existing).first().asDict()
    with pytest.raises(ValueError, match="extra_in_staging"):
        quality.backfill_verdict(extra, 4)


def test_backfill_changes_new_columns_only(spark):
    base = spark.createDataFrame([("1", 5.0, None), ("2", 6.0, 9)], "id string, total double, item_count bigint")
    out = merge.apply_backfill(base, staged(spark, ["1", "7"]), "id", ["item_count", "is_cart"])
    assert pairs(out) == [("1", 5.0, 3, True), ("2", 6.0, 9, None)]
    old = ["id", "total"]
    assert quality.old_column_checksum(base, old).first() == quality.old_column_checksum(out, old).first()
    other = base.withColumn("total", F.lit(5.0))
    assert quality.old_column_checksum(other, old).first() != quality.old_column_checksum(base, old).first()


def test_completeness(spark):
    schema = "resource string, entity string, complete boolean"
    expected = spark.createDataFrame([(r, e, True) for r in ("ads", "sets") for e in ("x", "y", "z")], schema)
    landed = spark.createDataFrame([("ads", "x", True), ("ads", "y", False), ("ads", "z", False), ("ads", "z", True), ("sets", "q", True)], schema)
    assert pairs(quality.completeness(expected, landed)) == [("ads", 1, ["y"]), ("sets", 3, ["x", "y", "z"])]
    assert pairs(quality.completeness(expected, landed, shown=2)) == [("ads", 1, ["y"]), ("sets", 3, ["x", "y"])]
    with pytest.raises(RuntimeError, match="ads: y; sets: x, y, z"):
        quality.completeness_gate(expected, landed)
    quality.completeness_gate(expected, expected)


def test_every_missing_entity_is_reported(spark, tmp_path):
    from adlake.workload.tables import completeness_query

    rows = [("a", k, 9600.0 if k == 3 else 1.0) for k in range(40)]
    spark.createDataFrame(rows, "c_mktsegment string, c_nationkey int, c_acctbal double").write.parquet(str(tmp_path / "customer.parquet"))
    gaps = sorted(str(k) for k in range(40) if k != 3)
    assert pairs(completeness_query(spark, str(tmp_path))) == [("a", 39, ",".join(gaps))]


# --- contracts ---------------------------------------------------------------------------


def test_export_contracts():
    spec = exports.export_spec("orders", "incremental", "id", "updated_at", "1.2")
    assert (spec.disposition, spec.keys, spec.cursor) == (MERGE, ("id",), "updated_at")
    assert {c: t.simpleString() for c, t in spec.columns.items()} == {
        "subtotal_eur": "decimal(10,2)", "profit_eur": "decimal(10,2)", "item_count": "bigint",
        "distinct_plan_count": "bigint", "is_cart": "boolean",
    }
    assert exports.export_spec("order-items", "full-refresh-snapshot").disposition == REPLACE
    assert disposition_for("append-only") == APPEND
    with pytest.raises(ValueError):
        check_schema_version("orders", "2.0")
    with pytest.raises(ValueError):
        exports.export_spec("orders", "sometimes", "id", "updated_at", "1.2")
    with pytest.raises(ValueError):
        exports.export_spec("orders", "incremental", "id", None, "1.2")
    assert exports.replicated_spec("reports_report").cursor == "updated_at"
    assert exports.replicated_spec("ad_request_stats").cursor == "id"
    assert exports.replicated_spec("other", "changed_at").cursor == "changed_at"
    assert table_name("db", "t") == "db.t"


def test_conform_modes(spark):
    df = spark.createDataFrame([("1.005", "x")], "subtotal_eur string, other string")
    evolved = project.conform(df, exports.ORDER_COLUMNS)
    assert evolved.columns == ["subtotal_eur", "other", "profit_eur", "item_count", "distinct_plan_count", "is_cart"]
    assert project.conform(df, exports.ORDER_COLUMNS, "exact").columns == list(exports.ORDER_COLUMNS)
    with pytest.raises(ValueError, match="missing"):
        project.conform(df, exports.ORDER_COLUMNS, "strict")
    wider = evolved.withColumn("extra", F.lit(1))
    assert project.additive_only(evolved.schema, wider.schema) == ["extra"]
    with pytest.raises(ValueError, match="subtotal_eur"):
        project.additive_only(df.schema, evolved.schema)


def test_json_columns_become_text(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('a', 1) AS map_json, 'x' AS note")
    out = exports.replicated_rows(df, ["map_json"])
    assert out.first().map_json == '{"a":1}'
    assert exports.replicated_rows(out, ["map_json", "absent"]).first().map_json == '{"a":1}'


# --- written tables ----------------------------------------------------------------------


def test_replace_makes_a_version_that_readers_switch_to(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.read_table(spark, path) is None
    for v in range(4):
        sinks.write_replace(spark.range(v + 1), path)
    assert sinks.read_table(spark, path).count() == 4
    assert sinks.versions(spark, path) == [3, 4]
    # A batch without its manifest belongs to a run that died: it is not read.
    (tmp_path / "t" / "_batch=5-dead").mkdir()
    assert sinks.read_table(spark, path).count() == 4
    sinks.write_replace(spark.range(9), path)
    assert sinks.read_table(spark, path).count() == 9


def test_partitioned_merge_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    spec = TableSpec("t", ("id",), MERGE, partition_by=("day",))
    sinks.load(spark.createDataFrame([(1, "01", "a"), (2, "02", "b"), (3, "03", "c")], "id int, day string, v string"), spec, path)
    (first,) = (tmp_path / "t").glob("_batch=1-*")
    kept = {p.name: p.stat().st_mtime_ns for p in (first / "day=03").iterdir()}
    changes = spark.createDataFrame([(1, "02", "moved"), (4, "04", "new")], "id int, day string, v string")
    for _ in range(2):
        sinks.load(changes, spec, path)
        rows = sinks.read_table(spark, path)
        assert pairs(rows.select("id", "day", "v")) == [(1, "02", "moved"), (2, "02", "b"), (3, "03", "c"), (4, "04", "new")]
    assert {p.name: p.stat().st_mtime_ns for p in (first / "day=03").iterdir()} == kept
    assert not (first / "day=01").exists()


def test_merge_with_a_new_column_evolves_the_whole_table(spark, tmp_path):
    path = str(tmp_path / "t")
    spec = TableSpec("t", ("id",), MERGE, partition_by=("day",))
    sinks.load(spark.createDataFrame([(1, "a1"), (2, "a2")], "id int, day string"), spec, path)
    sinks.load(spark.createDataFrame([(2, "a2", 5)], "id int, day string, item_count int"), spec, path)
    assert pairs(sinks.read_table(spark, path).select("id", "day", "item_count")) == [(1, "a1", None), (2, "a2", 5)]
    # And rows without the column do not drop it.
    sinks.load(spark.createDataFrame([(3, "a2")], "id int, day string"), spec, path)
    assert pairs(sinks.read_table(spark, path).select("id", "item_count")) == [(1, None), (2, 5), (3, None)]


def test_partition_written_from_a_hot_key_is_whole(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(20_000).withColumn("day", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("d"), F.col("id") % 7)))
    sinks.write_replace(df, path, ["day"])
    out = sinks.read_table(spark, path)
    assert out.count() == 20_000 and out.filter("day = 'hot'").count() == 6667


def test_read_entities_labels_every_row(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "a"))
    spark.range(2).write.parquet(str(tmp_path / "b"))
    df = read_entities(spark, {"act-a": str(tmp_path / "a"), "act-b": str(tmp_path / "b")})
    assert pairs(df.groupBy("entity").count()) == [("act-a", 3), ("act-b", 2)]


def test_append_keeps_one_set_of_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    spec = TableSpec("t", disposition=APPEND)
    sinks.load(spark.createDataFrame([(1, "a")], "id int, v string"), spec, path)
    sinks.load(spark.createDataFrame([(2, 7)], "id int, n int"), spec, path)
    sinks.load(spark.createDataFrame([(3,)], "id int"), spec, path)
    assert pairs(sinks.read_table(spark, path).select("id", "v", "n")) == [(1, "a", None), (2, None, 7), (3, None, None)]


def test_first_merge_without_rows_leaves_no_broken_table(spark, tmp_path):
    path = str(tmp_path / "t")
    spec = TableSpec("t", ("id",), MERGE, partition_by=("day",))
    empty = spark.createDataFrame([], "id int, day string")
    sinks.load(empty, spec, path)
    assert sinks.read_table(spark, path) is None
    sinks.load(spark.createDataFrame([(1, "x")], "id int, day string"), spec, path)
    sinks.load(empty, spec, path)
    assert pairs(sinks.read_table(spark, path).select("id", "day")) == [(1, "x")]


def test_merge_keeps_rows_of_a_null_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    spec = TableSpec("t", ("id",), MERGE, partition_by=("day", "kind"))
    columns = "id int, day string, kind int"
    sinks.load(spark.createDataFrame([(1, None, 1), (2, None, None), (3, "a", 1)], columns), spec, path)
    sinks.load(spark.createDataFrame([(4, None, 1), (2, "a", None)], columns), spec, path)
    assert pairs(sinks.read_table(spark, path)) == [(1, None, 1), (2, "a", None), (3, "a", 1), (4, None, 1)]


def test_merge_of_null_keys_repeats(spark, tmp_path):
    spec = TableSpec("t", ("a", "b"), MERGE)
    rows = spark.createDataFrame([(None, 1, "x"), (None, None, "y")], "a string, b int, v string")
    for _ in range(3):
        sinks.load(rows, spec, str(tmp_path / "t"))
    assert sinks.read_table(spark, str(tmp_path / "t")).count() == 2
    assert merge.merge_upsert(rows, rows, ["a", "b"]).count() == 2


@pytest.mark.parametrize("write", [lambda df, path: sinks.load(df, TableSpec("t", ("id",), MERGE, partition_by=("day",)), path), lambda df, path: sinks.write_append(df, path)])
def test_a_changed_type_fails_before_anything_is_written(spark, tmp_path, write):
    path = str(tmp_path / "t")
    sinks.write_replace(spark.createDataFrame([(1, "d", "x")], "id bigint, day string, v string"), path, ["day"])
    before = sorted(str(p) for p in (tmp_path / "t").rglob("*"))
    with pytest.raises(ValueError, match="column v changes"):
        write(spark.createDataFrame([(2, "d", 5)], "id bigint, day string, v int"), path)
    assert sorted(str(p) for p in (tmp_path / "t").rglob("*")) == before
    # A narrower number is widened.
    write(spark.createDataFrame([(2, "d", "y")], "id int, day string, v string"), path)
    assert pairs(sinks.read_table(spark, path).select("id", "v")) == [(1, "x"), (2, "y")]
    assert sinks.read_table(spark, path).schema["id"].dataType == T.LongType()


@pytest.mark.parametrize("step", ["_write_batch", "_commit"])
def test_a_writer_that_dies_leaves_the_old_table(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    spec = TableSpec("t", ("id",), MERGE, partition_by=("day",))
    columns = "id int, day string, v int"
    sinks.load(spark.createDataFrame([(1, "a", 1), (2, "b", 1)], columns), spec, path)
    changes = spark.createDataFrame([(1, "a", 2), (3, "c", 2)], columns)
    real = getattr(sinks, step)

    def dies(*args):
        if step == "_write_batch":
            real(*args)
        raise RuntimeError("killed")

    monkeypatch.setattr(sinks, step, dies)
    with pytest.raises(RuntimeError, match="killed"):
        sinks.load(changes, spec, path)
    assert pairs(sinks.read_table(spark, path)) == [(1, "a", 1), (2, "b", 1)]
    monkeypatch.setattr(sinks, step, real)
    sinks.load(changes, spec, path)
    assert pairs(sinks.read_table(spark, path)) == [(1, "a", 2), (2, "b", 1), (3, "c", 2)]


@pytest.mark.parametrize("write", [sinks.write_append, sinks.write_replace, lambda df, path: sinks.write_merge(df, TableSpec("t", ("id",), MERGE), path)])
def test_a_losing_writer_takes_no_rows_along(spark, tmp_path, monkeypatch, write):
    path = str(tmp_path / "t")
    sinks.write_append(spark.range(1), path)
    old = sinks.current(spark, path)
    write(spark.range(1, 2), path)
    won = pairs(sinks.read_table(spark, path))
    folders = sorted(p.name for p in (tmp_path / "t").glob("_batch=*"))
    # The other writer looked before the first one committed.
    monkeypatch.setattr(sinks, "current", lambda *_: old)
    with pytest.raises(RuntimeError, match="another run"):
        write(spark.range(2, 3), path)
    monkeypatch.undo()
    assert pairs(sinks.read_table(spark, path)) == won
    assert sorted(p.name for p in (tmp_path / "t").glob("_batch=*")) == folders
    write(spark.range(2, 3), path)
    assert (2,) in pairs(sinks.read_table(spark, path))


def test_one_of_many_writers_takes_a_name(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    (tmp_path / "m").mkdir()
    for n in range(5):
        with ThreadPoolExecutor(8) as pool:
            took = list(pool.map(lambda k: sinks._put_if_absent(spark, f"{tmp_path}/m/{n}", b"%d" % k), range(8)))
        assert sum(took) == 1 and (tmp_path / "m" / str(n)).read_bytes() == b"%d" % took.index(True)
    assert sorted(p.name for p in (tmp_path / "m").iterdir()) == [str(n) for n in range(5)]


def test_batches_come_in_any_order(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch in (7, 5, 7, 6, 5, 9, 0):
        sinks.write_append(spark.range(batch, batch + 1), path, source="s", batch=batch)
    assert pairs(sinks.read_table(spark, path)) == [(0,), (5,), (6,), (7,), (9,)]
    assert sinks.current(spark, path).applied == {"s": [[0, 0], [5, 7], [9, 9]]}


def test_ranges_of_batches(rng=__import__("random").Random(4)):
    for _ in range(200):
        ranges, want = [], set()
        for _ in range(rng.randrange(12)):
            n = rng.randrange(15)
            ranges = sinks.with_batch(ranges, n)
            want.add(n)
        assert [x for a, b in ranges for x in range(a, b + 1)] == sorted(want)
        assert all(a[1] + 1 < b[0] for a, b in zip(ranges, ranges[1:], strict=False))


def test_a_replayed_append_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch in (0, 0, 1, 0, 1):
        sinks.write_append(spark.range(batch * 10, batch * 10 + 10), path, source="s", batch=batch)
    sinks.write_append(spark.range(3), path, source="other", batch=0)
    assert sinks.read_table(spark, path).count() == 23


def test_staged_rows_that_repeat_do_not_multiply(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    staged = spark.createDataFrame([(1, 5), (1, 6)], "id int, extra int")
    assert pairs(merge.apply_backfill(base, staged, "id", ["extra"])) == [(1, "a", 6), (2, "b", None)]


def test_grains_in_one_pass_are_those_of_each(spark):
    keys = [c for own in reports.BREAKDOWNS.values() for c in own]
    df = spark.range(300).select(
        F.lit("a").alias("account_id"),
        F.pmod("id", F.lit(3)).cast("string").alias("campaign_id"),
        *[F.when(F.col("id") % 7 != i % 7, F.pmod(F.xxhash64("id", F.lit(c)), F.lit(2)).cast("string")).alias(c) for i, c in enumerate(keys)],
        F.date_add(F.lit(dt.date(2024, 1, 1)), F.pmod("id", F.lit(20)).cast("int")).alias("date_start"),
        F.col("id").alias("impressions"), (F.col("id") % 5).alias("clicks"), F.col("id").cast("double").alias("spend"),
    )
    every = reports.report_grains(df, "campaign", days=7, since="2024-01-01")
    plan = every._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    every = every.persist()
    for name, own in reports.BREAKDOWNS.items():
        want = reports.report_grain(df, "campaign", name, 7, "2024-01-01")
        assert pairs(every.filter(F.col("breakdown") == name).select(want.columns)) == pairs(want)
    every.unpersist()


def test_recent_rows_up_to_a_limit(spark):
    df = spark.range(30).select("id", F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'").alias("at"))
    assert project.recent(df, "at", 5, dt.date(2024, 1, 3)).count() == 30
    assert pairs(project.recent(df, "at", 5, dt.date(2024, 1, 3), limit=3, order_by=["at", "id"]).select("id")) == [(0,), (1,), (2,)]


def test_hot_ids_are_salted(spark):
    key = F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 5 == 0, None).otherwise(F.col("id"))
    df = spark.range(40_000).select(key.alias("k"), "id", F.lit("old").alias("v"))
    extra = spark.range(1000).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("v"), F.col("id").alias("w"))
    assert merge.hot_ids(df, "k", 0.01) == [7] and merge.hot_ids(df.limit(0), "k", 0.01) == []
    plain = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in plain}
    try:
        for k, v in plain.items():
            spark.conf.set(k, v)
        salted = merge.enrich(df, extra, "k", hot_share=0.01)
        of = salted.groupBy(F.spark_partition_id().alias("p")).agg(F.sum("w"), F.count(F.lit(1)).alias("n")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    sizes = sorted(r["n"] for r in of)
    assert len(sizes) > 1 and sizes[-1] < 2 * sizes[len(sizes) // 2]
    assert pairs(salted.orderBy("id")) == pairs(merge.enrich(df, extra, "k").orderBy("id"))


def test_salted_enrichment_of_odd_columns(spark):
    df = spark.sql("SELECT 1 AS k, map('a', 1) AS m UNION ALL SELECT 1, NULL UNION ALL SELECT NULL, NULL")
    extra = spark.createDataFrame([(1, "x"), (None, "no id")], "k int, v string")
    out = merge.enrich(df, extra, "k", hot_share=0.5)
    assert sorted((r.k or 0, r.v or "") for r in out.collect()) == [(0, ""), (1, "x"), (1, "x")]
    assert merge.enrich(df.limit(0), extra, "k", hot_share=0.5).count() == 0


def test_a_row_of_a_null_key_is_not_changed_for_ever(spark):
    light = spark.createDataFrame([(None, "a"), (1, "b"), (2, "c")], "id int, v string")
    state = diff.with_fingerprint(light.filter("v <> 'c'"), ["id", "v"]).select("id", "fingerprint")
    assert pairs(diff.changed_rows(light, state, ["id"], ["id", "v"]).select("id", "v")) == [(2, "c")]
    moved = light.withColumn("v", F.upper("v"))
    assert pairs(diff.changed_rows(moved, state, ["id"], ["id", "v"]).select("v")) == [("A",), ("B",), ("C",)]


def test_missing_keys_are_dealt_out_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(merge, "KEYS_A_TASK", 10)
    a = spark.createDataFrame([(k,) for k in [*range(0, 90), 3, 3, None]], "id int")
    b = spark.createDataFrame([(k,) for k in [*range(5, 100), 7, 7, 99, 99]], "id int")
    missing, extra = merge.missing_keys(a, b, "id")
    assert sorted(pairs(missing), key=str) == sorted([(k,) for k in (0, 1, 2, 3, 3, 3, 4, None)], key=str)
    assert sorted(pairs(extra)) == [(k,) for k in (*range(90, 100), 99, 99)]
    plan = missing._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "hashpartitioning(id#" in plan and ", 20)" in plan


def test_a_first_merge_computes_its_rows_once(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(type(spark.range(1)), "isEmpty", lambda self: pytest.fail("computed to be counted"))
    spec, path = TableSpec("t", ("k",), MERGE, partition_by=("d",)), str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "k int, d string, v int")
    sinks.load(rows.limit(0), spec, path)
    assert sinks.read_table(spark, path) is None and not [f for f in sinks.folders(spark, path) if f.startswith("_batch")]
    sinks.load(rows, spec, path)
    assert pairs(sinks.read_table(spark, path).select("k", "d", "v")) == [(1, "a", 5), (2, "b", 6)]


def test_groups_of_one_number_are_merged_without_a_sort(spark):
    a = spark.createDataFrame([("x", 1), ("x", 3), ("y", None), ("z", 4)], "k string, n bigint")
    b = spark.createDataFrame([("y", 2.0), ("z", None), ("w", 5.0)], "k string, m double")
    c = spark.createDataFrame([("z", None), ("x", 9)], "k string, n bigint")
    out = merge.merge_report_rows([a, b], ["k"])
    assert pairs(out) == [("w", None, 5.0), ("x", 3, None), ("y", None, 2.0), ("z", 4, None)]
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()
    assert pairs(merge.merge_report_rows([a, c], ["k"])) == [("x", 9), ("y", None), ("z", None)]
