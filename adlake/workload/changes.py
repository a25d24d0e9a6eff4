"""Change data capture over logs derived from events and orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adlake.operators.dedupe import latest
from adlake.operators.sinks import shared_dir
from adlake.plans.changelog import (
    SourceColumn,
    apply_changes,
    bootstrap,
    count_truncates,
    decode_messages,
    read_changes,
    snapshot_scan,
    table_changes,
)
from adlake.streaming.jobs import applied_rows, compact_changes, latest_state, stream_apply, stream_latest, stream_messages
from adlake.workload.registry import dealt, query, stream_table, table

KEYS = ["user_id"]


def event_changes(events: DataFrame, *more: Column) -> DataFrame:
    """Every event changes its user's row; an error deletes it."""
    return events.select(
        *more,
        "user_id",
        "event_type",
        "value",
        F.col("event_id").alias("lsn"),
        F.when(F.col("event_type") == "error", F.col("ts").cast("timestamp")).alias("deleted_ts"),
    )


_STATE_SQL = """
    SELECT * FROM (
      SELECT user_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value,
             max(event_id) AS lsn
      FROM events GROUP BY user_id
    ) WHERE event_type <> 'error'
"""


@query("cdc_apply", _STATE_SQL)
def cdc_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_changes(None, event_changes(table(spark, sf_dir, "events")), KEYS)


@query(
    "cdc_bootstrap",
    f"""
    WITH p AS (SELECT max(event_id) AS edge FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00')
    SELECT user_id, event_type, value, greatest(lsn, edge) AS lsn FROM ({_STATE_SQL}), p
    """,
)
def cdc_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state at a log position as snapshot, then the changes after it; a snapshot row has that position."""
    changes = event_changes(table(spark, sf_dir, "events"))
    before = table(spark, sf_dir, "events").filter(F.col("ts") < F.expr("TIMESTAMP_NTZ '2024-01-15 00:00:00'"))
    position = before.agg(F.max("event_id")).first()[0]
    state = apply_changes(None, changes.filter(F.col("lsn") <= position), KEYS)
    snapshot = snapshot_scan(state.drop("lsn"), lsn=position)
    merged = bootstrap(snapshot, changes, KEYS, ["insert", "update", "delete"], position)
    return merged.select("user_id", "event_type", "value", "lsn")


STREAM_BATCHES = 6


@query("cdc_stream", _STATE_SQL)
def cdc_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same changes as a stream of several batches, applied to a written table, which is then compacted."""
    root = shared_dir(spark)
    events = table(spark, sf_dir, "events")
    # Files of any order: what counts is the position of a change.
    part = F.pmod(F.xxhash64("event_id"), F.lit(STREAM_BATCHES))
    events.withColumn("part", part).repartition(STREAM_BATCHES, "part").drop("part").write.parquet(f"{root}/log")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/log")
    stream_apply(event_changes(stream), KEYS, f"{root}/table", f"{root}/progress")
    compact_changes(spark, f"{root}/table")
    return applied_rows(spark, f"{root}/table").select("user_id", "event_type", "value", "lsn")


@query(
    "cdc_latest_state",
    """
    SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS lsn
    FROM events GROUP BY user_id
    """,
)
def cdc_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest row per key held as streaming state and written out at the end."""
    root, stream = shared_dir(spark), stream_table(spark, sf_dir, "events")
    rows = event_changes(stream).select("user_id", "event_type", "lsn")

    def sink(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/state/epoch={epoch}")

    run = (
        latest_state(rows, KEYS)
        .writeStream.outputMode("update")
        .foreachBatch(sink)
        .option("checkpointLocation", f"{root}/progress")
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    # An update batch holds the keys that changed in it: the last batch of a key counts.
    return latest(spark.read.parquet(f"{root}/state"), KEYS, ["epoch"]).select("user_id", "event_type", "lsn")


LANDINGS = 5


@query("cdc_expiring_state", _STATE_SQL)
def cdc_expiring_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes that land a fifth of the time at once; state that is two days behind them is dropped."""
    root, events = shared_dir(spark), table(spark, sf_dir, "events")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    ends = events.agg(F.min(at).alias("a"), F.max(at).alias("b")).first()
    part = F.least(F.floor((at - ends["a"]) * LANDINGS / (ends["b"] - ends["a"] + 1)), F.lit(LANDINGS - 1))
    for k in range(LANDINGS):
        events.filter(part == k).write.mode("append").parquet(f"{root}/log")
        stream = spark.readStream.schema(events.schema).parquet(f"{root}/log")
        stream_latest(event_changes(stream, F.col("ts").cast("timestamp").alias("at")), KEYS, f"{root}/table", f"{root}/progress", "at", "2 days")
    return applied_rows(spark, f"{root}/table").select("user_id", "event_type", "value", "lsn")


ORDERS_RELATION = 16385
ORDER_COLUMNS = [
    SourceColumn("id", 20, -1, True),
    SourceColumn("status", 1043, 5),
    SourceColumn("price", 1700, ((12 << 16) | 2) + 4),
    SourceColumn("ordered_at", 1114),
]


def _hex_int(c: Column | int, digits: int) -> Column:
    value = F.lit(c) if isinstance(c, int) else c
    return F.lpad(F.hex(value), digits, "0")


def _hex_value(text: Column) -> Column:
    """A tuple entry: NULL, or length and bytes of the text."""
    sent = F.concat(F.lit("74"), _hex_int(F.octet_length(text), 8), F.hex(text))
    return F.coalesce(sent, F.lit("6E"))


def _hex_tuple(*texts: Column) -> Column:
    return F.concat(_hex_int(len(texts), 4), *[_hex_value(t) for t in texts])


def _hex_text(text: str) -> str:
    return text.encode().hex().upper() + "00"


def _relation_hex(relation: int, name: str, columns: list[SourceColumn]) -> str:
    parts = [f"52{relation:08X}", _hex_text("public"), _hex_text(name), "64", f"{len(columns):04X}"]
    for c in columns:
        parts += ["01" if c.key else "00", _hex_text(c.name), f"{c.oid:08X}", f"{c.typmod & 0xFFFFFFFF:08X}"]
    return "".join(parts)


def land_order_log(spark: SparkSession, sf_dir: str, path: str, moved: bool = False) -> None:
    """The messages as files, each of a range of the log; the orders are dealt out before they are encoded."""
    order_log(spark, sf_dir, moved, deal=True).write.parquet(path)


def order_log(spark: SparkSession, sf_dir: str, moved: bool = False, deal: bool = False) -> DataFrame:
    """Replication messages of the orders: one transaction each, encoded byte by byte.

    Finished orders are inserted, open ones updated with their old row, partial ones deleted
    by key. The table definition comes first, and again before each urgent order; low ones
    are preceded by a truncate message. With ``moved`` an open order is inserted under its negative
    key, which the update changes, and neither definitions nor truncates come in between.
    """
    orders = table(spark, sf_dir, "orders")
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    relation = F.lit(_relation_hex(ORDERS_RELATION, "orders", ORDER_COLUMNS))
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '2000-01-01 00:00:00', o_orderdate)")
    begin = F.concat(F.lit("42"), _hex_int(key, 16), _hex_int(micros, 16), F.lit("00000001"))
    commit = F.concat(F.lit("4300"), _hex_int(key, 16), _hex_int(key, 16), _hex_int(micros, 16))
    number = key.cast("string")
    price = F.when(F.col("o_orderpriority") != "3-MEDIUM", F.col("o_totalprice").cast("decimal(12,2)").cast("string"))
    row = _hex_tuple(number, status, price, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    old = _hex_tuple((-key).cast("string") if moved else number, F.lit("é"), F.lit(None).cast("string"), F.lit(None).cast("string"))
    to = f"{ORDERS_RELATION:08X}"
    change = (
        F.when(status == "F", F.concat(F.lit(f"49{to}4E"), row))
        .when(status == "O", F.concat(F.lit(f"55{to}4F"), old, F.lit("4E"), row))
        .otherwise(F.concat(F.lit(f"44{to}4B"), old))
    )
    extra = F.when(F.col("o_orderpriority") == "1-URGENT", relation).when(
        F.col("o_orderpriority") == "5-LOW", F.lit(f"540000000100{to}")
    )
    if moved:
        extra = F.when(status == "O", F.concat(F.lit(f"49{to}4E"), old))
    # Columns of their own first: inside the generator they would not be compiled.
    parts = {"begin": begin, "extra": extra, "change": change, "commit": commit}
    dealt_out = dealt(orders, "o_orderkey") if deal else orders
    encoded = dealt_out.select("o_orderkey", *[c.alias(f"_{k}") for k, c in parts.items()])
    messages = F.array(*[F.struct(F.lit(i).alias("at"), F.col(f"_{k}").alias("hex")) for i, k in enumerate(parts)])
    sent = F.filter(messages, lambda m: m["hex"].isNotNull())
    log = encoded.select("o_orderkey", F.explode(sent).alias("m")).select(
        (F.col("o_orderkey") * 4 + F.col("m.at")).alias("seq"), F.unhex("m.hex").alias("payload")
    )
    first = orders.agg(F.min(key).alias("k")).select(
        (F.col("k") * 4 - 1).alias("seq"), F.unhex(relation).alias("payload")
    )
    return first.unionByName(log).select("seq", (F.col("seq") + 1000).alias("lsn"), "payload")


@query(
    "cdc_decode",
    """
    SELECT o_orderkey AS id, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus ELSE 'é' END AS status,
           CASE WHEN o_orderstatus <> 'P' AND o_orderpriority <> '3-MEDIUM' THEN o_totalprice ELSE -1.0 END AS price,
           CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END AS ordered_at,
           o_orderkey * 4 + 1002 AS lsn,
           CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END AS deleted
    FROM orders
    """,
)
def cdc_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages landed as files, scanned, decoded and typed."""
    path = shared_dir(spark)
    land_order_log(spark, sf_dir, path)
    decoded = decode_messages(read_changes(spark, path))
    changes = table_changes(decoded, "orders", ORDER_COLUMNS)
    deleted = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col("deleted_ts").cast("timestamp_ntz"))
    return changes.select(
        "id",
        "status",
        F.coalesce(F.col("price").cast("double"), F.lit(-1.0)).alias("price"),
        F.date_format("ordered_at", "yyyy-MM-dd").alias("ordered_at"),
        "lsn",
        F.date_format(deleted, "yyyy-MM-dd").alias("deleted"),
    )


@query(
    "cdc_truncates",
    "SELECT count(*) AS n_truncates FROM orders WHERE o_orderpriority = '5-LOW'",
)
def cdc_truncates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_truncates(order_log(spark, sf_dir))


@query(
    "cdc_message_stream",
    """
    SELECT o_orderkey AS id, o_orderstatus AS status,
           CASE WHEN o_orderpriority <> '3-MEDIUM' THEN o_totalprice ELSE -1.0 END AS price, o_orderkey * 4 + 1002 AS lsn
    FROM orders WHERE o_orderstatus <> 'P'
    """,
)
def cdc_message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages read as a stream, decoded and applied to a table."""
    root = shared_dir(spark)
    land_order_log(spark, sf_dir, f"{root}/log")
    stream_messages(read_changes(spark, f"{root}/log", streaming=True), f"{root}/tables", f"{root}/progress")
    return applied_rows(spark, f"{root}/tables/orders").select(
        "id", "status", F.coalesce(F.col("price").cast("double"), F.lit(-1.0)).alias("price"), "lsn"
    )


MESSAGE_BATCHES = 6


@query(
    "cdc_message_batches",
    f"""
    WITH b AS (SELECT k, 4 * ((lo + (hi - lo) * (k + 1) // {MESSAGE_BATCHES})) + CASE WHEN k = {MESSAGE_BATCHES} - 1 THEN 3 ELSE k % 3 END AS edge
               FROM (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders), range({MESSAGE_BATCHES}) AS t(k))
    SELECT k AS batch, count(o_orderkey) AS n_rows, CAST(coalesce(sum(o_orderkey), 0) AS BIGINT) AS ids,
           coalesce(max(4 * o_orderkey + 1002), 0) AS lsn
    FROM b LEFT JOIN orders ON 4 * o_orderkey + 3 <= edge AND o_orderstatus <> 'P' GROUP BY k
    """,
)
def cdc_message_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages land in six parts, each but the last cut inside a transaction; the table after each."""
    root = shared_dir(spark)
    land_order_log(spark, sf_dir, f"{root}/all")
    log = read_changes(spark, f"{root}/all")
    low, high = table(spark, sf_dir, "orders").agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    last, out = None, None
    for k in range(MESSAGE_BATCHES):
        edge = 4 * (low + (high - low) * (k + 1) // MESSAGE_BATCHES) + (3 if k == MESSAGE_BATCHES - 1 else k % 3)
        part = log.filter(F.col("seq") <= edge) if last is None else log.filter((F.col("seq") > last) & (F.col("seq") <= edge))
        part.write.mode("append").parquet(f"{root}/log")
        stream_messages(read_changes(spark, f"{root}/log", streaming=True), f"{root}/tables", f"{root}/progress")
        state = applied_rows(spark, f"{root}/tables/orders")
        found = state.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum("id"), F.lit(0)).alias("ids"), F.coalesce(F.max("lsn"), F.lit(0)).alias("lsn"))
        # The state is read now: the next part changes the table.
        row = spark.createDataFrame([(k, *found.first())], "batch bigint, n_rows bigint, ids bigint, lsn bigint")
        out, last = row if out is None else out.unionByName(row), edge
    return out


@query("cdc_column_subset", "SELECT o_orderkey AS id, o_orderstatus AS status, o_orderkey * 4 + 1002 AS lsn FROM orders WHERE o_orderstatus <> 'P'")
def cdc_column_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns of the table alone are replicated, from keys that move; a moved key leaves nothing behind."""
    root = shared_dir(spark)
    land_order_log(spark, sf_dir, f"{root}/log", moved=True)
    stream = read_changes(spark, f"{root}/log", streaming=True)
    stream_messages(stream, f"{root}/tables", f"{root}/progress", include={"orders": ["id", "status"]}, key_deletes=True)
    return applied_rows(spark, f"{root}/tables/orders")
