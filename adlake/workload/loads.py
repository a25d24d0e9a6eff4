"""Increments, refresh windows, written tables and file streams."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from adlake.operators.dedupe import latest
from adlake.operators.incremental import capped, next_cursor, report_increment, rolling_refresh
from adlake.operators.sinks import current, load, read_table, shared_dir, write_merge
from adlake.operators.windows import LAG_DAYS, plan_windows, run_windows
from adlake.sources.tables import pull_increment
from adlake.spec import APPEND, MERGE, TableSpec
from adlake.streaming.jobs import stream_load
from adlake.workload.registry import query, stream_table, table


@query(
    "incremental_pull",
    """
    SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM events WHERE ts > TIMESTAMP '2024-01-10 00:00:00'
    """,
)
def incremental_pull(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = TableSpec("events", ("event_id",), MERGE, cursor="ts")
    rows = pull_increment(table(spark, sf_dir, "events"), spec, dt.datetime(2024, 1, 10))
    return rows.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"))


@query(
    "capped_pull",
    """
    WITH last AS (
      SELECT o_orderdate AS edge FROM orders ORDER BY o_orderdate LIMIT 1
      OFFSET (SELECT greatest(count(*) * 4 // 5, 1) - 1 FROM orders)
    )
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders WHERE o_orderdate <= (SELECT edge FROM last)
    """,
)
def capped_pull(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that may take four fifths of the table; the orders of its last day are not parted."""
    orders = table(spark, sf_dir, "orders")
    rows = capped(orders, "o_orderdate", max(orders.count() * 4 // 5, 1))
    return rows.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@query("capped_pull_ties", "SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d') AS day FROM events")
def capped_pull_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole table in capped runs by a coarse text cursor: every run goes on where the last one ended."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    spec = TableSpec("events", ("event_id",), APPEND, cursor="day")
    path, cap, mark = shared_dir(spark), max(events.count() // 4, 1), None
    while True:
        rows = pull_increment(events, spec, mark, cap)
        reached = next_cursor(rows, "day")
        if reached is None:
            return read_table(spark, path)
        load(rows, spec, path, "events", int(reached.replace("-", "")))
        mark = reached


@query(
    "rolling_refresh",
    """
    SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS DATE) BETWEEN DATE '2001-07-02' AND DATE '2001-08-01'
                            THEN o_totalprice ELSE 0.0 END AS price
    FROM orders
    """,
)
def rolling_refresh_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored orders have no price yet; the last 30 days are read again."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", F.col("o_totalprice").alias("price"))
    stored = orders.withColumn("price", F.lit(0.0))
    fresh = rolling_refresh(stored, orders, ["o_orderkey"], "o_orderdate", 30, dt.date(2001, 8, 1))
    return fresh.select("o_orderkey", "price")


@query(
    "report_increment",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
    WHERE CAST(o_orderdate AS DATE) > DATE '2001-05-31' AND CAST(o_orderdate AS DATE) < DATE '2001-07-21'
    """,
)
def report_increment_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = report_increment(
        table(spark, sf_dir, "orders"), "o_orderdate", dt.date(2001, 5, 31), dt.date(2001, 7, 21)
    )
    return rows.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@query(
    "lag_refresh",
    f"""
    SELECT event_id, CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-30' - {LAG_DAYS} THEN value ELSE 0.0 END AS value
    FROM events
    """,
)
def lag_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late attribution: the last days are merged again in every run."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    stored = events.withColumn("value", F.lit(0.0))
    merged = rolling_refresh(stored, events, ["event_id"], "ts", LAG_DAYS, dt.date(2024, 1, 30))
    return merged.select("event_id", "value")


@query(
    "plan_windows",
    """
    WITH o AS (
      SELECT o_custkey, strftime(max(o_orderdate), '%Y-%m-%d') AS hi, strftime(min(o_orderdate), '%Y-%m-%d') AS lo
      FROM orders GROUP BY o_custkey
    ),
    c AS (
      SELECT c_custkey,
             CASE c_mktsegment WHEN 'BUILDING' THEN 'not-a-date' WHEN 'MACHINERY' THEN NULL ELSE hi END AS checkpoint,
             CASE c_mktsegment WHEN 'MACHINERY' THEN NULL ELSE lo || 'T00:00:00Z' END AS cursor
      FROM customer LEFT JOIN o ON o_custkey = c_custkey
    ),
    s AS (
      SELECT c_custkey,
             coalesce(TRY_CAST(substr(checkpoint, 1, 10) AS DATE), TRY_CAST(substr(cursor, 1, 10) AS DATE)) AS done
      FROM c
    ),
    b AS (
      SELECT c_custkey, CASE WHEN f < DATE '1998-07-05' THEN DATE '1998-07-05' ELSE f END AS first
      FROM (SELECT c_custkey, CASE WHEN done IS NULL THEN DATE '2001-07-06'
                                   WHEN done > DATE '2001-08-05' THEN DATE '2001-07-29' ELSE done - 7 END AS f FROM s)
    )
    SELECT c_custkey AS entity, strftime(first + 8 * CAST(i AS INTEGER), '%Y-%m-%d') AS start,
           strftime(CASE WHEN first + 8 * CAST(i AS INTEGER) + 7 > DATE '2001-08-05' THEN DATE '2001-08-05'
                         ELSE first + 8 * CAST(i AS INTEGER) + 7 END, '%Y-%m-%d') AS stop
    FROM b, unnest(generate_series(0, 200)) AS t(i)
    WHERE first + 8 * CAST(i AS INTEGER) <= DATE '2001-08-05'
    """,
)
def plan_windows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A refresh plan per customer, from marks of every kind: a date, none, an older one, a broken one."""
    marks = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max("o_orderdate").alias("hi"), F.min("o_orderdate").alias("lo")
    )
    segment = F.col("c_mktsegment")
    states = table(spark, sf_dir, "customer").join(marks, "c_custkey", "left").select(
        F.col("c_custkey").alias("entity"),
        F.when(segment == "BUILDING", F.lit("not-a-date"))
        .when(segment == "MACHINERY", F.lit(None))
        .otherwise(F.date_format("hi", "yyyy-MM-dd"))
        .alias("checkpoint"),
        F.when(segment != "MACHINERY", F.concat(F.date_format("lo", "yyyy-MM-dd"), F.lit("T00:00:00Z"))).alias(
            "cursor"
        ),
    )
    planned = plan_windows(states, dt.date(2001, 8, 5))
    return planned.select(
        "entity", F.col("start").cast("string").alias("start"), F.col("end").cast("string").alias("stop")
    )


@query(
    "load_windows",
    """
    WITH days AS (SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n_rows FROM events GROUP BY ALL)
    SELECT event_type AS entity, day, n_rows, '2024-01-30' AS checkpoint FROM days
    WHERE day >= CASE event_type WHEN 'view' THEN '2024-01-13' WHEN 'click' THEN '2024-01-18' ELSE '2024-01-01' END
    """,
)
def load_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of every event type loaded one after the other, with a checkpoint per window."""
    root = shared_dir(spark)
    events = table(spark, sf_dir, "events")
    facts = events.withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    spec = TableSpec("daily", ("entity", "day"), MERGE, partition_by=("day",))
    kind = F.col("event_type")
    states = events.select("event_type").distinct().select(
        kind.alias("entity"),
        F.when(kind == "view", "2024-01-20").alias("checkpoint"),
        F.when(kind == "click", "2024-01-25T10:00:00Z").alias("cursor"),
    )
    windows = plan_windows(states, dt.date(2024, 1, 30), initial_days=29)

    def load_window(start: dt.date, end: dt.date, entities: DataFrame) -> None:
        span = facts.filter(F.col("day").between(start.isoformat(), end.isoformat()))
        mine = span.withColumnRenamed("event_type", "entity").join(entities, "entity", "left_semi")
        write_merge(
            mine.groupBy("entity", "day").agg(F.count(F.lit(1)).alias("n_rows")), spec, f"{root}/daily"
        )

    marks = TableSpec("checkpoints", disposition=APPEND)
    run_windows(windows, load_window, lambda rows: load(rows, marks, f"{root}/checkpoints"))
    done = latest(read_table(spark, f"{root}/checkpoints"), ["entity"], ["checkpoint"])
    loaded = read_table(spark, f"{root}/daily").withColumn("day", F.col("day").cast("string"))
    return loaded.join(done.select("entity", "checkpoint"), "entity").select(
        "entity", "day", "n_rows", "checkpoint"
    )


@query(
    "merge_table",
    """
    SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'X' ELSE o_orderstatus END AS status,
           CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1.0 ELSE o_totalprice END AS price
    FROM orders
    """,
)
def merge_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partitioned table merged twice; some rows move to another partition, some change in place."""
    path = shared_dir(spark)
    spec = TableSpec("orders", ("o_orderkey",), MERGE, partition_by=("status",))
    orders = table(spark, sf_dir, "orders")
    rows = orders.select("o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))
    urgent = F.col("o_orderpriority") == "1-URGENT"
    changes = orders.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select(
        "o_orderkey",
        F.when(urgent, "X").otherwise(F.col("o_orderstatus")).alias("status"),
        F.lit(1.0).alias("price"),
    )
    load(rows, spec, path)
    load(changes, spec, path)
    load(changes, spec, path)
    return read_table(spark, path).select("o_orderkey", "status", "price")


_NULLED_SQL = """
    SELECT CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey // 4 END AS part_key, o_custkey AS cust_key,
           CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status, max(o_totalprice) AS price
    FROM orders GROUP BY ALL
"""


def _with_nulls(orders: DataFrame) -> DataFrame:
    """Orders under a key of three columns, two of which are often NULL."""
    key = F.col("o_orderkey")
    rows = orders.select(
        F.when(key % 3 != 0, F.floor(key / 4)).alias("part_key"),
        F.col("o_custkey").alias("cust_key"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"),
        F.col("o_totalprice").alias("price"),
    )
    return rows.groupBy("part_key", "cust_key", "status").agg(F.max("price").alias("price"))


@query("merge_null_keys", _NULLED_SQL)
def merge_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose keys hold NULLs, merged three times: none is added and none is lost."""
    path, rows = shared_dir(spark), _with_nulls(table(spark, sf_dir, "orders"))
    spec = TableSpec("orders", ("part_key", "cust_key", "status"), MERGE)
    for _ in range(3):
        load(rows, spec, path)
    return read_table(spark, path)


@query("merge_null_partition", _NULLED_SQL)
def merge_null_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same into partitions of which one is NULL, a third of the rows at a time."""
    path, rows = shared_dir(spark), _with_nulls(table(spark, sf_dir, "orders"))
    spec = TableSpec("orders", ("part_key", "cust_key", "status"), MERGE, partition_by=("status",))
    for k in range(3):
        load(rows.filter(F.col("cust_key") % 3 == k), spec, path)
    return read_table(spark, path)


@query(
    "load_dispositions",
    """
    SELECT 'append' AS kind, 2 * count(*) AS n_rows FROM nation
    UNION ALL SELECT 'replayed', count(*) FROM nation
    UNION ALL SELECT 'replace', count(*) FROM nation
    UNION ALL SELECT 'merge', count(*) FROM customer
    """,
)
def load_dispositions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every disposition written twice: an append doubles, unless it is the same batch; a replace and a merge do not."""
    root = shared_dir(spark)
    nation = table(spark, sf_dir, "nation")
    customer = table(spark, sf_dir, "customer")
    jobs = {
        "append": (nation, TableSpec("t", disposition=APPEND)),
        "replayed": (nation, TableSpec("t", disposition=APPEND)),
        "replace": (nation, TableSpec("t")),
        "merge": (customer, TableSpec("t", ("c_custkey",), MERGE)),
    }
    out = None
    for kind, (df, spec) in jobs.items():
        for _ in range(2):
            load(df, spec, f"{root}/{kind}", "nations" if kind == "replayed" else None, 0)
        n = read_table(spark, f"{root}/{kind}").agg(F.count(F.lit(1)).alias("n_rows"))
        row = n.select(F.lit(kind).alias("kind"), "n_rows")
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "load_conflicts",
    """
    SELECT 'append' AS kind, count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders
    UNION ALL SELECT 'merge', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders
    UNION ALL SELECT 'late', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders
    """,
)
def load_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in thirds: one writer dies before its commit, one loses against another and writes again, and numbered
    batches come late and twice."""
    root, orders = shared_dir(spark), table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    third = [orders.filter(F.col("o_orderkey") % 3 == k) for k in range(3)]
    specs = {"append": TableSpec("t", disposition=APPEND), "merge": TableSpec("t", ("o_orderkey",), MERGE, partition_by=("o_orderstatus",))}
    for kind, spec in specs.items():
        path = f"{root}/{kind}"
        load(third[0], spec, path)
        third[1].write.parquet(f"{path}/_batch=2-dead/o_orderstatus=O")  # all that is left of a writer that died
        behind = current(spark, path)
        load(third[1], spec, path)
        try:
            load(third[2], spec, path, base=behind)
        except RuntimeError:
            load(third[2], spec, path)
    for k in (2, 0, 2, 1, 0):
        load(third[k], specs["append"], f"{root}/late", "orders", k)
    out = None
    for kind in ("append", "merge", "late"):
        n = read_table(spark, f"{root}/{kind}").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("o_orderkey").alias("keys"))
        row = n.select(F.lit(kind).alias("kind"), "n_rows", "keys")
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "stream_load",
    """
    SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type
    FROM events WHERE event_type <> 'error' GROUP BY user_id
    """,
)
def stream_load_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event files taken as a stream, filtered, and merged to the last event per user."""
    root, stream = shared_dir(spark), stream_table(spark, sf_dir, "events")
    spec = TableSpec("last_event", ("user_id",), MERGE, order_by=("event_id",))
    stream_load(
        stream,
        spec,
        f"{root}/table",
        f"{root}/progress",
        lambda df: df.filter(F.col("event_type") != "error").select("user_id", "event_id", "event_type"),
    )
    return read_table(spark, f"{root}/table").select("user_id", "event_id", "event_type")

