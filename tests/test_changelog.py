import datetime as dt
import random
import re
import struct

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from adlake.operators.asof import Carry, carry_forward
from adlake.operators.sinks import read_table
from adlake.plans import changelog
from adlake.spec import APPEND, MERGE, TableSpec
from adlake.streaming.jobs import applied_rows, compact_changes, latest_state, stream_apply, stream_latest, stream_load, stream_messages

PG_EPOCH = dt.datetime(2000, 1, 1)


def begin(at):
    micros = int((at - PG_EPOCH) / dt.timedelta(microseconds=1))
    return b"B" + struct.pack(">qqi", 1, micros, 7)


def commit():
    return b"C" + struct.pack(">bqqq", 0, 1, 2, 3)


def relation(rel, name, columns, schema="public"):
    out = b"R" + struct.pack(">i", rel) + schema.encode() + b"\0" + name.encode() + b"\0d" + struct.pack(">h", len(columns))
    for key, column, oid, typmod in columns:
        out += struct.pack(">b", key) + column.encode() + b"\0" + struct.pack(">ii", oid, typmod)
    return out


def row(*values):
    out = struct.pack(">h", len(values))
    for v in values:
        if v is None:
            out += b"n"
        elif v is ...:
            out += b"u"
        else:
            out += b"t" + struct.pack(">i", len(v.encode())) + v.encode()
    return out


def insert(rel, *values):
    return b"I" + struct.pack(">i", rel) + b"N" + row(*values)


def update(rel, *values, old=None, kind=b"K"):
    before = kind + row(*old) if old is not None else b""
    return b"U" + struct.pack(">i", rel) + before + b"N" + row(*values)


def delete(rel, *values, kind=b"K"):
    return b"D" + struct.pack(">i", rel) + kind + row(*values)


def truncate(rel):
    return b"T" + struct.pack(">ibi", 1, 0, rel)


def log_of(spark, messages):
    rows = [(i, 100 + i, bytearray(m)) for i, m in enumerate(messages)]
    return spark.createDataFrame(rows, changelog.LOG_SCHEMA).repartition(3)


ID, NAME = (1, "id", 20, -1), (0, "name", 1043, 54)
T1, T2 = dt.datetime(2024, 1, 5, 10), dt.datetime(1999, 12, 31, 23)


def test_decode_types_values_and_marks_deletes(spark):
    columns = [
        ID, (0, "price", 1700, ((10 << 16) | 2) + 4), (0, "at", 1114, -1), (0, "atz", 1184, -1), (0, "day", 1082, -1),
        (0, "ok", 16, -1), (0, "raw", 17, -1), (0, "doc", 3802, -1), (0, "odd", 4711, -1), (0, "t", 1083, -1), (0, "f", 701, -1),
    ]
    values = (
        "1", "12.50", "2024-01-05 10:00:00.5", "2024-01-05 10:00:00+02", "2024-01-05", "t", "\\x00ff",
        '{"a": "é"}', "{1,2}", "10:11:12", "1.5",
    )
    log = log_of(
        spark,
        [begin(T1), relation(5, "things", columns), insert(5, *values), commit(), begin(T2), delete(5, "2", *[None] * 10), commit()],
    )
    changes = changelog.decode_changes(log)["things"]
    spark_types = {f.name: f.dataType.simpleString() for f in changes.schema.fields}
    assert spark_types["price"] == "decimal(10,2)" and spark_types["at"] == "timestamp_ntz" and spark_types["odd"] == "string"
    got = changes.withColumn("atz", F.unix_seconds("atz")).withColumn("deleted_ts", F.unix_seconds("deleted_ts")).orderBy("lsn").collect()
    first, second = got
    assert (first.id, str(first.price), first.at, first.day) == (1, "12.50", dt.datetime(2024, 1, 5, 10, 0, 0, 500000), dt.date(2024, 1, 5))
    assert first.atz == int(dt.datetime(2024, 1, 5, 8, tzinfo=dt.timezone.utc).timestamp())
    assert (first.ok, bytes(first.raw), first.doc, first.odd, first.t, first.f) == (True, b"\x00\xff", '{"a": "é"}', "{1,2}", "10:11:12", 1.5)
    assert first.deleted_ts is None and first.lsn == 102
    assert second.id == 2 and second.price is None
    assert second.deleted_ts == int(dt.datetime(1999, 12, 31, 23, tzinfo=dt.timezone.utc).timestamp())


def test_tables_of_one_name_in_two_schemas_stay_apart(spark):
    wide = [ID, *((0, f"c{k}", 25, -1) for k in range(300))]
    log = log_of(
        spark,
        [
            begin(T1), relation(5, "orders", [ID, NAME]), relation(6, "orders", wide, "archivé"),
            insert(5, "1", "a"), insert(6, "2", *(str(k) for k in range(300))), commit(),
        ],
    )
    found = changelog.decode_changes(log, include={"archivé.orders": ["id", "c0", "c299"]})
    assert set(found) == {"orders", "archivé.orders"}
    assert pairs(found["orders"].select("id", "name")) == [(1, "a")]
    assert [c for c in found["archivé.orders"].columns if c not in ("lsn", "deleted_ts")] == ["id", "c0", "c299"]
    assert pairs(found["archivé.orders"].select("id", "c0", "c299")) == [(2, "0", "299")]


def test_an_unbounded_numeric_fails_rather_than_lose_decimals(spark):
    def read(text):
        log = log_of(spark, [begin(T1), relation(5, "t", [ID, (0, "n", 1700, -1)]), insert(5, "1", text), commit()])
        return changelog.decode_changes(log)["t"].first().n

    assert str(read("12345678901234567890.123456789000")) == "12345678901234567890.123456789"
    with pytest.raises(PySparkException, match="more decimals"):
        read("0.1234567891")


def test_schema_change_in_the_log(spark):
    log = log_of(
        spark,
        [
            begin(T1), relation(5, "t", [ID, NAME]), relation(6, "other", [ID]), insert(5, "1", "old"), insert(6, "9"), commit(),
            begin(T1), relation(5, "t", [(0, "extra", 23, -1), ID, NAME]), insert(5, "7", "2", "new"), insert(6, "8"), commit(),
        ],
    )
    tables = changelog.decode_changes(log)
    got = sorted((r.id, r.name, r.extra) for r in tables["t"].collect())
    assert got == [(1, "old", None), (2, "new", 7)]
    assert sorted(r.id for r in tables["other"].collect()) == [8, 9]


def test_updates_with_old_tuples(spark):
    log = log_of(
        spark,
        [
            begin(T1), relation(5, "t", [ID, NAME]), update(5, "1", "a"), update(5, "2", "b", old=("1", None)),
            update(5, "3", "c", old=("3", "x"), kind=b"O"), delete(5, "3", "c", kind=b"O"),
        ],
    )
    decoded = changelog.decode_messages(log)
    columns = changelog.relation_columns(log)["t"]
    plain = changelog.table_changes(decoded, "t", columns)
    assert sorted((r.id, r.name, r.deleted_ts is None) for r in plain.collect()) == [
        (1, "a", True), (2, "b", True), (3, "c", False), (3, "c", True),
    ]
    # On request, the key that an update gave up is deleted.
    moved = changelog.table_changes(decoded, "t", columns, key_deletes=True)
    assert sorted(r.id for r in moved.filter("deleted_ts IS NOT NULL").collect()) == [1, 3]


def test_included_columns(spark):
    log = log_of(spark, [begin(T1), relation(5, "t", [ID, NAME]), insert(5, "1", "a")])
    assert changelog.decode_changes(log, {"t": ["id"]})["t"].columns == ["id", "lsn", "deleted_ts"]


def test_unchanged_values_fail_or_are_carried(spark):
    log = log_of(spark, [begin(T1), relation(5, "t", [ID, NAME]), insert(5, "1", "big"), update(5, "1", ...), update(5, "2", ...)])
    log = log.filter("seq < 4")
    with pytest.raises(PySparkException, match="unchanged value of t.name"):
        changelog.decode_changes(log)["t"].collect()
    changes = changelog.decode_changes(log, unchanged="carry")["t"]
    state = changelog.apply_changes(None, changes, ["id"])
    assert [tuple(r) for r in state.select("id", "name", "lsn").collect()] == [(1, "big", 103)]


def bad_log(spark, message):
    return log_of(spark, [begin(T1), relation(5, "t", [ID]), message])


@pytest.mark.parametrize(
    "message,text",
    [
        (b"X", "unknown replication message: X"),
        (b"I" + struct.pack(">i", 5) + b"O" + row("1"), "new tuple expected"),
        (b"D" + struct.pack(">i", 5) + b"N" + row("1"), "old tuple expected"),
        (insert(77, "1"), "change without a relation"),
        (b"I" + struct.pack(">i", 5) + b"N" + struct.pack(">h", 1) + b"b", "unknown value kind"),
    ],
)
def test_bad_messages_fail(spark, message, text):
    with pytest.raises(PySparkException, match=text):
        changelog.decode_messages(bad_log(spark, message)).collect()


def test_truncates_are_counted(spark):
    log = log_of(spark, [begin(T1), relation(5, "t", [ID]), truncate(5), insert(5, "1"), truncate(5)])
    assert changelog.count_truncates(log).first().n_truncates == 2
    assert changelog.decode_messages(log).count() == 1


@pytest.mark.parametrize("inclusive", [True, False])
def test_carry_forward_equals_a_walk_over_the_log(spark, inclusive):
    rng = random.Random(4)
    seqs = sorted(rng.sample(range(-50, 4000), 1200))
    # A third of the rows belongs to one source; values are rare and leave long gaps.
    rows = [(s, "hot" if rng.random() < 0.34 else f"k{rng.randrange(5)}", s if rng.random() < 0.02 else None) for s in seqs]
    last, last_by, want = None, {}, []
    for s, k, v in rows:
        before = (last, last_by.get(k))
        if v is not None:
            last, last_by[k] = v, v
        want.append((s, *((last, last_by.get(k)) if inclusive else before)))
    df = spark.createDataFrame(rows, "seq bigint, k string, v bigint").repartition(5)
    out = carry_forward(df, "seq", [Carry(F.col("v"), "a"), Carry(F.col("v"), "b", ("k",))], bits=4, inclusive=inclusive)
    assert [tuple(r) for r in out.select("seq", "a", "b").orderBy("seq").collect()] == want


# --- apply -------------------------------------------------------------------------------

CHANGES = "id int, v string, lsn bigint, deleted_ts timestamp"
GONE = dt.datetime(2024, 1, 1)


def pairs(df):
    return sorted(map(tuple, df.collect()))


def test_apply_is_free_of_order_and_idempotent(spark):
    rows = [(1, "a", 1, None), (1, "b", 2, None), (1, None, 3, GONE), (2, "x", 4, None), (3, None, 5, GONE), (3, "back", 6, None)]
    want = [(2, "x", 4), (3, "back", 6)]
    for seed in range(3):
        shuffled = random.Random(seed).sample(rows, len(rows))
        df = spark.createDataFrame(shuffled, CHANGES).repartition(4)
        state = changelog.apply_changes(None, df, ["id"])
        assert pairs(state) == want
        assert pairs(changelog.apply_changes(state, spark.createDataFrame(rows[3:], CHANGES), ["id"])) == want


def test_tombstones_keep_late_changes_from_reviving_a_row(spark):
    df = spark.createDataFrame([(1, None, 3, GONE)], CHANGES)
    late = spark.createDataFrame([(1, "old", 2, None)], CHANGES)
    state = changelog.apply_changes(None, df, ["id"], keep_tombstones=True)
    again = changelog.apply_changes(state, late, ["id"], keep_tombstones=True)
    assert pairs(changelog.live_rows(again)) == []


def test_bootstrap(spark):
    snapshot = changelog.snapshot_scan(spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string"), lsn=10)
    changes = spark.createDataFrame([(1, "stale", 9, None), (2, None, 11, GONE), (3, "c", 12, None)], CHANGES)
    merged = changelog.bootstrap(snapshot, changes, ["id"], ["insert", "delete"], 10)
    assert pairs(merged.select("id", "v")) == [(1, "a"), (3, "c")]
    inserts = changes.filter("deleted_ts IS NULL")
    appended = changelog.bootstrap(snapshot, inserts, ["id"], ["insert"], 10)
    assert pairs(appended.select("id", "v")) == [(1, "a"), (2, "b"), (3, "c")]
    assert changelog.change_disposition(["insert"]) == APPEND
    assert changelog.change_disposition(["insert", "update"]) == MERGE


# --- streams -----------------------------------------------------------------------------


def land(spark, path, rows):
    spark.createDataFrame(rows, CHANGES).coalesce(1).write.mode("append").parquet(path)


def change_stream(spark, path):
    return spark.readStream.schema(CHANGES).option("maxFilesPerTrigger", 1).parquet(path)


def test_stream_apply_over_runs_and_replays(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")

    def run(checkpoint):
        stream_apply(change_stream(spark, source), ["id"], target, str(tmp_path / checkpoint))
        return pairs(applied_rows(spark, target).select("id", "v", "lsn"))

    land(spark, source, [(1, "a", 1, None), (2, "b", 2, None)])
    land(spark, source, [(1, None, 3, GONE), (3, "c", 4, None)])
    assert run("c1") == [(2, "b", 2), (3, "c", 4)]
    land(spark, source, [(1, "back", 5, None), (3, "d", 6, None)])
    assert run("c1") == [(1, "back", 5), (2, "b", 2), (3, "d", 6)]
    # A lost checkpoint replays every file; nothing changes.
    assert run("c2") == [(1, "back", 5), (2, "b", 2), (3, "d", 6)]
    batch = changelog.apply_changes(None, spark.read.schema(CHANGES).parquet(source), ["id"])
    assert pairs(batch) == run("c2")


def test_batches_add_files_and_rewrite_none(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    for i in range(6):
        land(spark, source, [(k, f"v{i}", 10 * i + k, None) for k in range(3)])
    stream_apply(change_stream(spark, source), ["id"], target, str(tmp_path / "c"))
    written = {p: p.stat().st_mtime_ns for p in (tmp_path / "out").rglob("*.parquet")}
    assert pairs(applied_rows(spark, target).select("id", "v")) == [(k, "v5") for k in range(3)]
    land(spark, source, [(1, None, 100, GONE)])
    stream_apply(change_stream(spark, source), ["id"], target, str(tmp_path / "c"))
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "out").rglob("*.parquet")}
    assert written.items() <= after.items() and len(after) == len(written) + 1
    want = [(0, "v5"), (2, "v5")]
    for horizon in (None, 99, 100):
        compact_changes(spark, target, horizon)
        assert pairs(applied_rows(spark, target).select("id", "v")) == want
        assert read_table(spark, target).count() == (2 if horizon == 100 else 3)


def test_stream_load_takes_new_files_only(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    spec = TableSpec("rows", disposition=APPEND)

    def run():
        stream_load(change_stream(spark, source), spec, target, str(tmp_path / "c"), lambda df: df.filter("id > 1"))
        return read_table(spark, target).count()

    land(spark, source, [(1, "a", 1, None), (2, "b", 2, None)])
    assert run() == 1
    assert run() == 1
    land(spark, source, [(3, "c", 3, None)])
    assert run() == 2


def test_latest_state_stream(spark, tmp_path):
    source = str(tmp_path / "in")
    land(spark, source, [(1, "a", 1, None), (2, "b", 2, None)])
    land(spark, source, [(1, "late", 0, None), (2, "c", 5, None)])
    stream = change_stream(spark, source).select("id", "v", "lsn")
    query = (
        latest_state(stream, ["id"]).writeStream.outputMode("complete").format("memory").queryName("latest_rows")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert pairs(spark.table("latest_rows")) == [(1, "a", 1), (2, "c", 5)]


def test_state_expires_and_tables_stay_right(spark, tmp_path):
    """Twelve days with ten new keys each; those of the day before are changed or deleted once more."""
    schema = "id int, v string, lsn bigint, deleted_ts timestamp, at timestamp"
    source, want, held, days = str(tmp_path / "in"), {}, [], 12
    for day in range(days):
        at = dt.datetime(2024, 1, 1 + day, 12)
        rows = [(10 * day + i, f"new{day}", 100 * day + i, None, at) for i in range(10)]
        rows += [(k, f"old{day}", 100 * day + 50 + k % 10, at if k % 3 == 0 else None, at) for k in range(10 * day - 10, 10 * day) if day]
        want |= {k: None if gone else (k, v, seq) for k, v, seq, gone, _ in rows}
        spark.createDataFrame(rows, schema).repartition(2).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        held.append(stream_latest(stream, ["id"], str(tmp_path / "t"), str(tmp_path / "c"), "at", "2 days"))
    assert pairs(applied_rows(spark, str(tmp_path / "t")).select("id", "v", "lsn")) == sorted(r for r in want.values() if r)
    assert max(held) <= 6 * 20 and max(held[6:]) <= max(held[:6])


def test_a_change_without_a_time_fails(spark, tmp_path):
    spark.sql("SELECT 1 AS id, 1L AS lsn, CAST(NULL AS TIMESTAMP) AS at").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id int, lsn bigint, at timestamp").parquet(str(tmp_path / "in"))
    with pytest.raises(Exception, match="change without at"):
        stream_latest(stream, ["id"], str(tmp_path / "t"), str(tmp_path / "c"), "at", "2 days")


def test_message_stream_across_files_that_cut_transactions(spark, tmp_path):
    source, root = str(tmp_path / "log"), str(tmp_path / "tables")
    messages = [
        begin(T1), relation(5, "t", [ID, NAME]), relation(6, "u", [ID]), insert(5, "1", "a"), insert(6, "9"),
        # cut: the next file goes on in the same transaction
        insert(5, "2", "b"), commit(), begin(T2), update(5, "1", "a2"), delete(6, "9"),
        # cut: and the third changes the schema
        commit(), begin(T1), relation(5, "t", [ID, NAME, (0, "extra", 23, -1)]), update(5, "2", ..., "7"), insert(5, "3", "c", "8"), commit(),
    ]
    rows = [(i, 100 + i, bytearray(m)) for i, m in enumerate(messages)]

    def run(checkpoint, tables):
        log = changelog.read_changes(spark, source, streaming=True, files_per_batch=1)
        stream_messages(log, tables, str(tmp_path / checkpoint), unchanged="carry")

    for part in (rows[:5], rows[5:10], rows[10:]):
        spark.createDataFrame(part, changelog.LOG_SCHEMA).coalesce(1).write.mode("append").parquet(source)
        run("c1", root)
    want = [(1, "a2", -1), (2, "b", 7), (3, "c", 8)]
    state = applied_rows(spark, f"{root}/t").select("id", "name", F.coalesce("extra", F.lit(-1)))
    assert pairs(state) == want
    assert applied_rows(spark, f"{root}/u").count() == 0
    # All three files as batches of one run give the same tables.
    run("c2", str(tmp_path / "again"))
    again = applied_rows(spark, str(tmp_path / "again" / "t")).select("id", "name", F.coalesce("extra", F.lit(-1)))
    assert pairs(again) == want


def test_every_state_is_one_after_a_commit(spark, tmp_path):
    """Transactions of one to nine changes, cut into batches at every kind of place, also several batches in one transaction."""
    rng = random.Random(8)
    messages, states, live = [relation(5, "t", [ID, NAME])], {0: ()}, {}
    for k in range(14):
        messages.append(begin(T1))
        for _ in range(rng.randint(1, 9)):
            key = str(rng.randrange(6))
            if key in live and rng.random() < 0.3:
                messages.append(delete(5, key, None))
                del live[key]
            else:
                messages.append((update if key in live else insert)(5, key, f"v{len(messages)}"))
                live[key] = f"v{len(messages) - 1}"
        messages.append(commit())
        states[len(messages)] = tuple(sorted((int(i), v) for i, v in live.items()))
    rows = [(i, 100 + i, bytearray(m)) for i, m in enumerate(messages)]
    cuts = sorted(rng.sample(range(1, len(rows)), 11))
    source, root, seen = str(tmp_path / "log"), str(tmp_path / "tables"), []
    for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True):
        spark.createDataFrame(rows[a:b], changelog.LOG_SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream_messages(changelog.read_changes(spark, source, streaming=True), root, str(tmp_path / "c"))
        done = max(n for n in states if n <= b)
        state = applied_rows(spark, f"{root}/t").select("id", "name").collect() if done else []
        assert tuple(sorted(map(tuple, state))) == states[done]
        seen.append(done)
    assert len(set(seen)) < len(seen) and seen[-1] == len(rows)
    # What waits is kept once, and only the last batches are remembered.
    assert len(list((tmp_path / "tables" / "_open").iterdir())) == 2
    # All parts at a time, one file a batch, in one run.
    stream_messages(changelog.read_changes(spark, source, streaming=True, files_per_batch=1), str(tmp_path / "again"), str(tmp_path / "c2"))
    assert tuple(pairs(applied_rows(spark, str(tmp_path / "again" / "t")).select("id", "name"))) == states[len(rows)]


def test_moved_keys_and_a_subset_in_a_stream(spark, tmp_path):
    messages = [begin(T1), relation(5, "t", [ID, NAME, (0, "extra", 23, -1)]), insert(5, "1", "a", "7"), commit()]
    messages += [begin(T2), update(5, "2", "b", "8", old=("1", None, None)), commit()]
    rows = [(i, 100 + i, bytearray(m)) for i, m in enumerate(messages)]
    spark.createDataFrame(rows, changelog.LOG_SCHEMA).write.parquet(str(tmp_path / "log"))
    log = changelog.read_changes(spark, str(tmp_path / "log"), streaming=True)
    stream_messages(log, str(tmp_path / "tables"), str(tmp_path / "c"), include={"t": ["id", "name"]}, key_deletes=True)
    state = applied_rows(spark, str(tmp_path / "tables" / "t"))
    assert state.columns == ["id", "name", "lsn"] and pairs(state) == [(2, "b", 105)]


def test_decode_plan_shuffles_the_log_once(spark, tmp_path):
    messages = [begin(T1), relation(5, "t", [ID, NAME]), insert(5, "1", "a"), commit()]
    rows = [(i, 100 + i, bytearray(m)) for i, m in enumerate(messages)]
    spark.createDataFrame(rows, changelog.LOG_SCHEMA).write.parquet(str(tmp_path / "log"))
    decoded = changelog.decode_messages(changelog.read_changes(spark, str(tmp_path / "log")))
    plan = decoded._jdf.queryExecution().executedPlan().toString()
    count = lambda word: len(re.findall(rf"[-+] \*?(?:\(\d+\) )?{word}", plan))
    assert count("FileScan|Scan parquet") <= 2 and "FileScan" in plan
    assert count("Exchange") <= 4 and "SortAggregate" not in plan


def test_a_landed_log_lies_in_ranges_that_follow_the_orders(spark, monkeypatch, tmp_path):
    from adlake.workload import changes, registry

    monkeypatch.setattr(registry, "ROWS_A_FILE", 20)
    order = F.struct(
        F.pmod(F.col("id") * 7, F.lit(200)).alias("o_orderkey"), F.lit(1).cast("bigint").alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
        F.lit(1.5).alias("o_totalprice"), F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'").alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority"),
    )
    spark.range(0, 200, 1, 1).select(order.alias("o")).select("o.*").write.parquet(str(tmp_path / "orders.parquet"))
    changes.land_order_log(spark, str(tmp_path), str(tmp_path / "log"))
    log = changelog.read_changes(spark, str(tmp_path / "log"))
    ends = log.groupBy(F.input_file_name()).agg(F.min("seq").alias("a"), F.max("seq").alias("b"), F.count(F.lit(1)).alias("n")).filter("n > 1").orderBy("a").collect()
    assert log.count() == 801 and len(ends) >= 8 and max(r["n"] for r in ends) <= 200
    assert all(x["b"] < y["a"] for x, y in zip(ends, ends[1:]))


def test_a_repeated_definition_is_parsed_once(spark, monkeypatch):
    parsed = []
    real = changelog._relation
    monkeypatch.setattr(changelog, "_relation", lambda payload: parsed.append(payload) or real(payload))
    log = log_of(spark, [begin(T1), *[relation(5, "t", [ID, NAME])] * 50, insert(5, "1", "a"), commit()])
    plans = []
    collect = type(log).collect
    monkeypatch.setattr(type(log), "collect", lambda self: plans.append(self._jdf.queryExecution().optimizedPlan().toString()) or collect(self))
    assert [c.name for c in changelog.relation_columns(log)["t"]] == ["id", "name"]
    assert parsed and plans[-1].count("Aggregate [") == 2
