"""Types and byte fields of the database's logical replication messages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

# Type ids of the database and the Spark type a value of each becomes.
# Precision and scale of numeric (1700) come from the type modifier.
PG_TYPES: dict[int, T.DataType] = {
    16: T.BooleanType(),
    17: T.BinaryType(),
    20: T.LongType(),
    21: T.LongType(),
    23: T.LongType(),
    701: T.DoubleType(),
    1043: T.StringType(),
    1082: T.DateType(),
    1083: T.StringType(),
    1114: T.TimestampNTZType(),
    1184: T.TimestampType(),
    3802: T.StringType(),
    114: T.StringType(),
}
NUMERIC_OID = 1700
BYTEA_OID = 17


def numeric_precision_scale(typmod: int) -> tuple[int, int] | None:
    """Declared precision and scale, or None for an unbounded numeric."""
    if typmod == -1:
        return None
    return ((typmod - 4) >> 16) & 65535, (typmod - 4) & 65535


def pg_type(oid: int, typmod: int = -1) -> T.DataType:
    """Spark type of a column; unknown types are text, precision is capped at 38."""
    if oid == NUMERIC_OID:
        declared = numeric_precision_scale(typmod)
        if declared is None:
            return T.DecimalType(38, 9)
        precision = min(declared[0], 38)
        return T.DecimalType(precision, min(declared[1], precision))
    return PG_TYPES.get(oid, T.StringType())


def be_uint(payload: Column, pos: Column | int, length: int) -> Column:
    """Unsigned big-endian integer of up to four bytes; ``pos`` counts from 1."""
    at = F.lit(pos) if isinstance(pos, int) else pos
    return F.conv(F.hex(F.substring(payload, at, F.lit(length))), 16, 10).cast("bigint")


def be_int32(payload: Column, pos: Column | int) -> Column:
    raw = be_uint(payload, pos, 4)
    return F.when(raw > 2147483647, raw - 4294967296).otherwise(raw)


def be_int64(payload: Column, pos: Column | int) -> Column:
    at = F.lit(pos) if isinstance(pos, int) else pos
    return F.conv(F.hex(F.substring(payload, at, F.lit(8))), 16, -10).cast("bigint")


def char_at(payload: Column, pos: Column | int) -> Column:
    at = F.lit(pos) if isinstance(pos, int) else pos
    return F.decode(F.substring(payload, at, F.lit(1)), "ISO-8859-1")
