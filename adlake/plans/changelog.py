"""Change data capture: decode replication messages, type them, apply them.

A log is a DataFrame of ``seq`` (position, unique), ``lsn`` and ``payload`` (binary message).
Decoding runs in column expressions; the relation and the transaction that a change belongs
to are carried forward over the log in bounded ranges (``carry_forward``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from adlake.functions.dates import pg_epoch
from adlake.functions.numbers import bytea
from adlake.functions.pgtypes import (
    BYTEA_OID,
    NUMERIC_OID,
    be_int32,
    be_int64,
    be_uint,
    char_at,
    numeric_precision_scale,
    pg_type,
)
from adlake.operators.asof import Carry, carry_forward
from adlake.operators.dedupe import latest
from adlake.operators.sinks import cut_lineage
from adlake.spec import APPEND, MERGE

LOG_SCHEMA = "seq BIGINT, lsn BIGINT, payload BINARY"
MESSAGE_KINDS = "BCRIUDT"  # begin, commit, relation, insert, update, delete, truncate
_SLICE = "struct<pos:int,size:int>"
_COLUMNS = "array<struct<key:boolean,name:string,oid:bigint,typmod:bigint>>"


def read_changes(spark, path: str, streaming: bool = False, files_per_batch: int | None = None):
    """Landed messages as a batch, or as a stream that takes a bounded number of files at a time."""
    if not streaming:
        return spark.read.schema(LOG_SCHEMA).parquet(path)
    reader = spark.readStream.schema(LOG_SCHEMA)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _utf8(latin: Column) -> Column:
    return F.decode(F.encode(latin, "ISO-8859-1"), "UTF-8")


# Lengths that stand for a value that was not sent.
_NULL, _UNCHANGED = -1, -2


def _slices_at(payload: Column, start: Column) -> Column:
    """Where the values of the tuple at ``start`` lie: (position, length), after a first mark.

    The length is negative for NULL and for an unchanged value.
    """

    def at(pos: Column, size: Column) -> Column:
        return F.struct(pos.cast("int").alias("pos"), size.cast("int").alias("size"))

    def step(acc: Column, _i: Column) -> Column:
        pos = _after(acc)
        tag = F.substring(payload, pos, F.lit(1))
        entry = (
            F.when(tag == F.lit(b"t"), at(pos + 5, be_uint(payload, pos + 1, 4)))
            .when(tag == F.lit(b"n"), at(pos + 1, F.lit(_NULL)))
            .when(tag == F.lit(b"u"), at(pos + 1, F.lit(_UNCHANGED)))
            .otherwise(
                F.raise_error(F.concat(F.lit("unknown value kind in tuple: "), F.hex(tag))).cast(_SLICE)
            )
        )
        return F.concat(acc, F.array(entry)).cast(f"array<{_SLICE}>")

    count = be_uint(payload, start, 2).cast("int")
    begin = F.array(at(start + 2, F.lit(0))).cast(f"array<{_SLICE}>")
    indexes = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(indexes, begin, step)


def _after(slices: Column) -> Column:
    """Position after the last value."""
    last = F.element_at(slices, -1)
    return last["pos"] + F.greatest(last["size"], F.lit(0))


def _values(payload: Column, slices: Column) -> Column:
    """The texts that the slices point at."""

    def value(s: Column) -> Column:
        kind = F.when(s["size"] >= 0, "t").when(s["size"] == _NULL, "n").otherwise("u")
        text = F.when(s["size"] >= 0, F.decode(F.substring(payload, s["pos"], s["size"]), "UTF-8"))
        return F.struct(kind.alias("cat"), text.alias("val"))

    return F.transform(F.slice(slices, F.lit(2), F.size(slices)), value)


def _relation(payload: Column) -> Column:
    """Name and columns of a relation message; byte positions are those of its Latin-1 text.

    A table outside the schema ``public`` has its schema before its name.
    """
    text = F.decode(payload, "ISO-8859-1")
    zero = F.lit("\0")
    schema_end = F.position(zero, text, F.lit(6))
    name_end = F.position(zero, text, schema_end + 1)
    plain = _utf8(F.substring(text, schema_end + 1, name_end - schema_end - 1))
    schema = _utf8(F.substring(text, F.lit(6), schema_end - 6))
    name = F.when(schema.isin("public", ""), plain).otherwise(F.concat(schema, F.lit("."), plain))
    count = be_uint(payload, name_end + 2, 2).cast("int")
    begin = F.struct((name_end + 4).cast("int").alias("pos"), F.array().cast(_COLUMNS).alias("cols"))

    def step(acc: Column, _i: Column) -> Column:
        end = F.position(zero, text, acc["pos"] + 1)
        column = F.struct(
            (be_uint(payload, acc["pos"], 1) != 0).alias("key"),
            _utf8(F.substring(text, acc["pos"] + 1, end - acc["pos"] - 1)).alias("name"),
            be_uint(payload, end + 1, 4).alias("oid"),
            be_int32(payload, end + 5).alias("typmod"),
        )
        return F.struct(
            (end + 9).cast("int").alias("pos"),
            F.concat(acc["cols"], F.array(column)).cast(_COLUMNS).alias("cols"),
        )

    indexes = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    return F.struct(name.alias("name"), F.aggregate(indexes, begin, step)["cols"].alias("cols"))


def message_kinds(log: DataFrame) -> DataFrame:
    """The log with the kind of each message; a byte that names no message is an error."""
    kind = char_at(F.col("payload"), 1)
    # NULL passes: filters may run after this check, so it must not fail on rows they drop.
    known = F.when(kind.isNull() | kind.isin(*MESSAGE_KINDS), kind).otherwise(
        F.raise_error(F.concat(F.lit("unknown replication message: "), kind)).cast("string")
    )
    return log.withColumn("kind", known)


def count_truncates(log: DataFrame) -> DataFrame:
    """Truncate messages are not applied; this is how many there were."""
    return message_kinds(log).agg(F.count_if(F.col("kind") == "T").alias("n_truncates"))


MAX_DEFINITIONS = 10_000  # table definitions that may be broadcast, and their bytes; more are joined
MAX_DEFINITION_BYTES = 8 << 20


def _definition_id(payload: Column) -> Column:
    """A fixed-width stand-in for a relation message."""
    return F.xxhash64(payload)


def _definitions(messages: DataFrame) -> DataFrame:
    """Each distinct relation message parsed once: one row per table and schema change."""
    distinct = messages.filter("kind = 'R'").select("payload").distinct()
    parsed = distinct.select(_definition_id(F.col("payload")).alias("definition"), _relation(F.col("payload")).alias("relation"), "payload")
    # The names on their own, found once for each definition and not in each message.
    names = F.transform(F.col("relation")["cols"], lambda c: c["name"])
    parsed = parsed.withColumn("relation", F.col("relation").withField("names", names))
    parsed = cut_lineage(parsed)
    size = parsed.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("definition").alias("ids"), F.coalesce(F.sum(F.octet_length("payload")), F.lit(0)).alias("bytes")).first()
    if size["ids"] != size["n"]:
        raise ValueError("two table definitions have one hash")
    parsed = parsed.drop("payload")
    return F.broadcast(parsed) if size["n"] <= MAX_DEFINITIONS and size["bytes"] <= MAX_DEFINITION_BYTES else parsed


def decode_messages(log: DataFrame) -> DataFrame:
    """One row per insert, update or delete, with the relation and commit time it belongs to.

    Columns: seq, lsn, kind, relation (name, cols, names), commit_ts, vals (the new tuple, or the
    old one of a delete) and old_vals (key or old tuple an update carried, else NULL).
    """
    payload, kind = F.col("payload"), F.col("kind")
    kinds = message_kinds(log).filter(kind.isin("B", "R", "I", "U", "D"))
    # Bytes of a begin message: final LSN from 2, commit time from 10. The others have the
    # relation id from 2.
    begin = F.when(kind == "B", be_int64(payload, 10))
    ids = kinds.withColumn("rel_id", F.when(kind != "B", be_uint(payload, 2, 4)))
    carries = [Carry(begin, "commit_us"), Carry(F.when(kind == "R", _definition_id(payload)), "definition", ("rel_id",))]
    changes = carry_forward(ids, "seq", carries).filter(kind.isin("I", "U", "D"))
    with_relation = changes.join(_definitions(kinds), "definition", "left")

    # Byte 6 says which tuple follows; an update may carry a key or old tuple before the new one.
    has_old = (F.col("kind") == "U") & char_at(payload, 6).isin("K", "O")
    bad = F.when(
        F.col("relation").isNull(), F.lit("change without a relation message")
    ).when(
        F.col("kind").isin("I", "U") & ~has_old & (char_at(payload, 6) != "N"), F.lit("new tuple expected")
    ).when((F.col("kind") == "D") & ~char_at(payload, 6).isin("K", "O"), F.lit("old tuple expected"))
    message = F.concat(F.lit("message "), F.col("seq").cast("string"), F.lit(": "), bad)
    checked = with_relation.withColumn(
        "kind", F.when(bad.isNotNull(), F.raise_error(message).cast("string")).otherwise(F.col("kind"))
    )
    sliced = checked.withColumn("_first", _slices_at(payload, F.lit(7))).withColumn("_has_old", has_old)
    both = sliced.withColumn("_new", F.when(F.col("_has_old"), _slices_at(payload, _after(F.col("_first")) + 1)))
    return both.select(
        "seq",
        "lsn",
        "kind",
        "relation",
        pg_epoch(F.col("commit_us")).alias("commit_ts"),
        _values(payload, F.coalesce("_new", "_first")).alias("vals"),
        F.when(F.col("_has_old"), _values(payload, F.col("_first"))).alias("old_vals"),
    )


@dataclass(frozen=True)
class SourceColumn:
    name: str
    oid: int
    typmod: int = -1
    key: bool = False


def relation_columns(log: DataFrame) -> dict[str, list[SourceColumn]]:
    """Columns per table from the relation messages; a later definition adds to an earlier one.

    The driver sees the distinct definitions: one per table and schema change.
    """
    # A definition comes again and again: each distinct one is parsed once.
    sent = message_kinds(log).filter("kind = 'R'").groupBy("payload").agg(F.max("seq").alias("seq"))
    defs = sent.select("seq", _relation(F.col("payload")).alias("r"))
    found = defs.groupBy("r.name", "r.cols").agg(F.max("seq").alias("seq")).orderBy("seq").collect()
    tables: dict[str, dict[str, SourceColumn]] = {}
    for row in found:
        known = tables.setdefault(row["name"], {})
        for c in row["cols"]:
            known[c["name"]] = SourceColumn(c["name"], c["oid"], c["typmod"], c["key"])
    return {name: list(cols.values()) for name, cols in tables.items()}


def _typed(text: Column, column: SourceColumn) -> Column:
    if column.oid == BYTEA_OID:
        return bytea(text)
    if column.oid == NUMERIC_OID and numeric_precision_scale(column.typmod) is None:
        lost = F.concat(F.lit(f"{column.name} has more decimals than are kept: "), text)
        kind = pg_type(column.oid, column.typmod)
        return F.when(text.rlike(r"\.\d{9}\d*[1-9]"), F.raise_error(lost).cast(kind)).otherwise(text.cast(kind))
    return text.cast(pg_type(column.oid, column.typmod))


def table_changes(
    decoded: DataFrame,
    table: str,
    columns: Sequence[SourceColumn],
    include: Sequence[str] | None = None,
    unchanged: str = "fail",
    key_deletes: bool = False,
) -> DataFrame:
    """Typed changes of one table: its columns, ``lsn`` and ``deleted_ts`` (set on a delete).

    An update may leave out a large value that did not change. ``unchanged="fail"`` raises;
    ``"carry"`` gives NULL and lists the column in ``_unchanged`` for ``apply_changes``.
    ``key_deletes`` also deletes the old key of an update that changed it.
    """
    if unchanged not in ("fail", "carry"):
        raise ValueError(f"unknown choice {unchanged!r}")
    kept = [c for c in columns if include is None or c.name in include]
    rows = decoded.filter(F.col("relation")["name"] == table)
    names = F.col("relation")["names"]

    def entry(vals: str, c: SourceColumn) -> Column:
        # Position 0 means the definition in force does not have the column.
        at = F.array_position(names, c.name).cast("int") - 1
        return F.when(at >= 0, F.get(F.col(vals), at))

    def value(vals: str, c: SourceColumn) -> Column:
        e = entry(vals, c)
        typed = _typed(e["val"], c)
        if unchanged == "carry":
            return typed.alias(c.name)
        text = F.concat(F.lit(f"unchanged value of {table}.{c.name} in message "), F.col("seq").cast("string"))
        return (
            F.when(e["cat"] == "u", F.raise_error(text).cast(typed_name(c))).otherwise(typed).alias(c.name)
        )

    deleted = F.when(F.col("kind") == "D", F.col("commit_ts")).alias("deleted_ts")
    extra = []
    if unchanged == "carry":
        extra = [F.array_compact(F.array(
            *[F.when(entry("vals", c)["cat"] == "u", F.lit(c.name)) for c in kept]
        )).alias("_unchanged")]
    out = rows.select(*[value("vals", c) for c in kept], "lsn", deleted, *extra)
    if not key_deletes:
        return out
    moved = rows.filter(F.col("old_vals").isNotNull()).select(
        *[value("old_vals", c) if c.key else F.lit(None).cast(pg_type(c.oid, c.typmod)).alias(c.name) for c in kept],
        "lsn",
        F.col("commit_ts").alias("deleted_ts"),
        *([F.array().cast("array<string>").alias("_unchanged")] if extra else []),
    )
    keys = [c.name for c in kept if c.key]
    same = out.select(*keys, "lsn")
    return out.unionByName(moved.join(same, [*keys, "lsn"], "left_anti"))


def typed_name(column: SourceColumn) -> str:
    return pg_type(column.oid, column.typmod).simpleString()


def decode_changes(
    log: DataFrame,
    include: Mapping[str, Sequence[str]] | None = None,
    unchanged: str = "fail",
) -> dict[str, DataFrame]:
    """Typed changes per table of the log."""
    decoded = decode_messages(log)
    return {
        table: table_changes(decoded, table, columns, (include or {}).get(table), unchanged)
        for table, columns in relation_columns(log).items()
    }


def apply_changes(
    target: DataFrame | None,
    changes: DataFrame,
    keys: Sequence[str],
    seq: str = "lsn",
    keep_tombstones: bool = False,
) -> DataFrame:
    """State after the changes: per key the row with the greatest ``seq``, deleted ones gone.

    The result does not depend on the order of the changes, and applying them again changes
    nothing. ``keep_tombstones`` keeps deleted keys with their ``deleted_ts``, so that an
    older change that arrives late cannot bring the row back.
    """
    rows = changes
    if "deleted_ts" not in rows.columns:
        rows = rows.withColumn("deleted_ts", F.lit(None).cast("timestamp"))
    if target is not None:
        rows = target.unionByName(rows, allowMissingColumns=True)
    if "_unchanged" in rows.columns:
        state = _latest_with_carry(rows, keys, seq)
    else:
        state = latest(rows, keys, [seq])
    return state if keep_tombstones else live_rows(state)


def live_rows(state: DataFrame) -> DataFrame:
    return state.filter(F.col("deleted_ts").isNull()).drop("deleted_ts")


def _latest_with_carry(rows: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """Latest value per column, skipping the changes that left the column out."""
    plain = [c for c in rows.columns if c not in keys and c not in (seq, "deleted_ts", "_unchanged")]
    left_out = F.coalesce(F.col("_unchanged"), F.array().cast("array<string>"))

    def carried(c: str) -> Column:
        sent = ~F.array_contains(left_out, F.lit(c))
        return F.max(F.when(sent, F.struct(F.col(seq).alias("s"), F.col(c).alias("v"))))["v"].alias(c)

    last = F.max(F.struct(F.col(seq).alias("s"), F.col("deleted_ts").alias("d")))
    state = rows.groupBy(*keys).agg(
        *[carried(c) for c in plain], last["s"].alias(seq), last["d"].alias("deleted_ts")
    )
    return state.select(*[c for c in rows.columns if c != "_unchanged"])


def change_disposition(ops: Sequence[str]) -> str:
    """Inserts alone can be appended; updates or deletes need a merge."""
    return MERGE if {"update", "delete"} & set(ops) else APPEND


def snapshot_scan(table: DataFrame, columns: Sequence[str] | None = None, lsn: int = 0) -> DataFrame:
    """State of a source table at a log position, as rows a change log can follow."""
    kept = table.select(*columns) if columns is not None else table
    return kept.withColumn("lsn", F.lit(lsn).cast("bigint"))


def bootstrap(
    snapshot: DataFrame, changes: DataFrame, keys: Sequence[str], ops: Sequence[str], snapshot_lsn: int
) -> DataFrame:
    """Snapshot plus the changes after it."""
    later = changes.filter(F.col("lsn") > F.lit(snapshot_lsn))
    if change_disposition(ops) == APPEND:
        return snapshot.unionByName(later.drop("deleted_ts"), allowMissingColumns=True)
    return apply_changes(snapshot, later, keys)


def last_commit(log: DataFrame) -> int | None:
    """Position of the last commit message."""
    return message_kinds(log).filter("kind = 'C'").agg(F.max("seq")).first()[0]


def open_messages(log: DataFrame) -> DataFrame:
    """Messages that later changes depend on: the last begin, and the last definition per relation.

    Their positions, one more than there are relations, are found in hash maps and read back by the driver; messages are not sorted.
    """
    kind = F.col("kind")
    messages = message_kinds(log).filter(kind.isin("B", "R")).withColumn("rel_id", F.when(kind == "R", be_uint(F.col("payload"), 2, 4)))
    last = messages.groupBy("kind", "rel_id").agg(F.max("seq").alias("seq")).collect()
    return log.filter(F.col("seq").isin([r["seq"] for r in last])).distinct()
