"""Streams that take what has arrived, in bounded batches, and stop.

Each job keeps its read position in a Structured Streaming checkpoint, and a micro-batch that is
replayed after a failure changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from adlake.operators.dedupe import latest
from adlake.operators.sinks import current, cut_lineage, drop_folder, folders, load, read_table, write_append, write_replace
from adlake.plans.changelog import (
    LOG_SCHEMA,
    apply_changes,
    decode_messages,
    last_commit,
    open_messages,
    relation_columns,
    table_changes,
)
from adlake.spec import TableSpec

#: State on the disks of the executors instead of in their memory.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _run(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    query = (
        stream.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _stream_id(batch: DataFrame) -> str:
    """Id of the running stream, which lasts as long as its checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def _add_changes(changes: DataFrame, keys: Sequence[str], path: str, seq: str, source: str, epoch: int) -> None:
    """Append the changes of a batch; of a key only the last, unless later ones leave values out."""
    rows = changes if "_unchanged" in changes.columns else latest(changes, keys, [seq])
    write_append(rows, path, source=source, batch=epoch, notes={"keys": list(keys), "seq": seq})


def stream_apply(changes: DataFrame, keys: Sequence[str], path: str, checkpoint: str, seq: str = "lsn") -> None:
    """Apply a stream of changes to a table, hard deletes included.

    A batch adds its own changes to the table and rewrites nothing, so its cost follows the batch.
    Readers (``applied_rows``) take the change with the greatest ``seq`` of each key; a batch that is
    replayed is not added twice. ``compact_changes`` cuts the table to one row per key now and then.
    """

    def apply(batch: DataFrame, epoch: int) -> None:
        _add_changes(batch, keys, path, seq, _stream_id(batch), epoch)

    _run(changes, apply, checkpoint)


def stream_messages(
    log: DataFrame,
    root: str,
    checkpoint: str,
    include: Mapping[str, Sequence[str]] | None = None,
    unchanged: str = "fail",
    key_deletes: bool = False,
) -> None:
    """Decode a stream of replication messages and apply it, one table folder per relation.

    Tables take whole transactions: what a batch has after its last commit is held back, and goes with the next batch that has a
    commit, so every state of a table is one that its source had after some commit. A batch keeps its own rest under
    ``_held``, the batches whose rests wait under ``_waiting``, and the definitions in force under ``_open``. A
    transaction that fills many batches is written once. A batch that runs again starts from the same messages,
    so it gives the same tables. Files must arrive in log order.
    """

    def apply(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        kept = lambda name, n: f"{root}/{name}/{n}"
        new = batch.select("seq", "lsn", "payload")
        waiting = [r[0] for r in spark.read.parquet(kept("_waiting", epoch - 1)).collect()] if epoch > 0 else []
        end = last_commit(new)
        rest = new if end is None else new.filter(F.col("seq") > end)
        rest.write.mode("overwrite").parquet(kept("_held", epoch))
        now = [*waiting, epoch] if end is None else [epoch]
        rows = spark.createDataFrame([], LOG_SCHEMA) if end is None else new.filter(F.col("seq") <= end)
        before = [kept("_open", epoch - 1)] if epoch > 0 else []
        before += [kept("_held", n) for n in waiting if end is not None]
        if before:
            rows = rows.unionByName(spark.read.schema(LOG_SCHEMA).parquet(*before))
        open_messages(rows).write.mode("overwrite").parquet(kept("_open", epoch))
        if end is not None:
            decoded = cut_lineage(decode_messages(rows))
            for table, columns in relation_columns(rows).items():
                keys = [c.name for c in columns if c.key]
                if not keys:
                    raise ValueError(f"table {table} has no key to apply changes by")
                changes = table_changes(decoded, table, columns, (include or {}).get(table), unchanged, key_deletes)
                _add_changes(changes, keys, f"{root}/{table}", "lsn", _stream_id(batch), epoch)
        spark.createDataFrame([(n,) for n in now], "epoch bigint").coalesce(1).write.mode("overwrite").parquet(kept("_waiting", epoch))
        _forget(spark, root, epoch, {*waiting, *now})

    _run(log, apply, checkpoint)


def _forget(spark: SparkSession, root: str, epoch: int, needed: set[int]) -> None:
    """Drop what batches before the last kept; only the last can run again."""
    for name, stays in (("_open", {epoch - 1, epoch}), ("_waiting", {epoch - 1, epoch}), ("_held", needed)):
        for n in folders(spark, f"{root}/{name}"):
            if int(n) < epoch and int(n) not in stays:
                drop_folder(spark, f"{root}/{name}/{n}")


def _state(spark: SparkSession, path: str, keep_tombstones: bool) -> DataFrame:
    notes = current(spark, path).notes
    return apply_changes(None, read_table(spark, path), notes["keys"], notes["seq"], keep_tombstones)


def applied_rows(spark: SparkSession, path: str) -> DataFrame:
    """Live rows of a table that ``stream_apply`` keeps."""
    return _state(spark, path, keep_tombstones=False)


def compact_changes(spark: SparkSession, path: str, horizon: int | None = None) -> None:
    """Cut a change-applied table to the last row per key.

    Deleted keys stay as tombstones, so that an older change that arrives late cannot bring a row
    back; those up to position ``horizon``, before which nothing can arrive any more, go.
    """
    state = _state(spark, path, keep_tombstones=True)
    if horizon is not None:
        seq = current(spark, path).notes["seq"]
        state = state.filter(F.col("deleted_ts").isNull() | (F.col(seq) > horizon))
    write_replace(state, path)


def stream_load(
    stream: DataFrame,
    spec: TableSpec,
    path: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Load newly landed files through a transform into a table, by its disposition.

    A batch that is replayed changes nothing: merges repeat, and appends know the batches they took.
    """

    def sink(batch: DataFrame, epoch: int) -> None:
        load(transform(batch) if transform else batch, spec, path, _stream_id(batch), epoch)

    _run(stream, sink, checkpoint)


def latest_state(stream: DataFrame, keys: Sequence[str], seq: str = "lsn") -> DataFrame:
    """The latest row per key as streaming state (output mode ``update`` or ``complete``)."""
    rest = [c for c in stream.columns if c not in keys and c != seq]
    best = stream.groupBy(*keys).agg(F.max(F.struct(seq, *rest)).alias("_row"))
    return best.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in stream.columns])


def latest_within(stream: DataFrame, keys: Sequence[str], time: str, horizon: str, seq: str = "lsn") -> DataFrame:
    """The latest row per key and span of ``horizon``, as streaming state that expires (output mode ``update``).

    A span leaves the state once the watermark is past it. So the state follows the keys that changed lately, deleted
    ones included, not all keys there ever were. Of the rows that come out for a key, that with the greatest ``seq``
    counts. A change that comes more than ``horizon`` after later ones is too late and left out; one without a
    ``time`` fails.
    """
    known = F.coalesce(time, F.raise_error(F.lit(f"change without {time}")).cast(stream.schema[time].dataType))
    timed = stream.withColumn("_time", known).withWatermark("_time", horizon)
    rest = [c for c in stream.columns if c not in keys and c != seq]
    best = timed.groupBy(*keys, F.window("_time", horizon)).agg(F.max(F.struct(seq, *rest)).alias("_row"))
    return best.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in stream.columns])


def stream_latest(
    changes: DataFrame, keys: Sequence[str], path: str, checkpoint: str, time: str, horizon: str, seq: str = "lsn"
) -> int:
    """``stream_apply`` by way of ``latest_within``; the most rows that the state held.

    A change that an earlier batch already outdid is not written again, and one key's changes are combined before they
    are shuffled. State lies in RocksDB.
    """
    spark, setting, held = changes.sparkSession, "spark.sql.streaming.stateStore.providerClass", 0
    before = spark.conf.get(setting)
    spark.conf.set(setting, ROCKSDB)
    try:
        query = (
            latest_within(changes, keys, time, horizon, seq)
            .writeStream.outputMode("update")
            .foreachBatch(lambda batch, epoch: _add_changes(batch, keys, path, seq, _stream_id(batch), epoch))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.set(setting, before)
    query.awaitTermination()
    for progress in query.recentProgress:
        held = max([held, *(op["numRowsTotal"] for op in progress["stateOperators"])])
    return held
