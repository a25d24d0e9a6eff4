"""Number parsing: tolerant, strict with a zero default, and typed by a report header."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from adlake.functions.text import blank_to_null

_PLAIN = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
_DIGITS = r"\d+(_\d+)*"
_GROUPED = rf"^\s*[+-]?({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})([eE][+-]?{_DIGITS})?\s*$"
_INFINITE = r"(?i)^\s*[+-]?(inf|infinity)\s*$"
_NAN = r"(?i)^\s*[+-]?nan\s*$"


def try_float(c: Column) -> Column:
    """Float of a text, or NULL where the text is not a number.

    The patterns keep out what Spark alone would take (``1d``) and let in grouped digits
    (``1_000``), so the accepted texts are those of a Python float.
    """
    return (
        F.when(c.rlike(_PLAIN), c.try_cast("double"))
        .when(c.rlike(_GROUPED), F.replace(c, F.lit("_"), F.lit("")).try_cast("double"))
        .when(c.rlike(_INFINITE), F.lower(c).try_cast("double"))
        .when(c.rlike(_NAN), F.lit(float("nan")))
    )


def _strict(c: Column, to: str) -> Column:
    """Cast that fails on bad text whatever the session's ANSI setting is."""
    value = F.coalesce(blank_to_null(c.cast("string")), F.lit("0"))
    out = value.try_cast(to)
    return F.when(out.isNotNull(), out).otherwise(
        F.raise_error(F.concat(F.lit(f"not a valid {to}: "), value)).cast(to)
    )


def int_or_zero(c: Column) -> Column:
    """Integer with 0 for missing or empty; any other bad text is an error."""
    return _strict(c, "bigint")


def float_or_zero(c: Column) -> Column:
    return _strict(c, "double")


# Metric header types that stay text or become whole numbers; the rest are floats.
TEXT_METRIC_TYPE = "METRIC_TYPE_UNSPECIFIED"
INTEGER_METRIC_TYPE = "TYPE_INTEGER"


def metric_type_name(header_type: str) -> str:
    """Second word of the header type, as used in column names (``TYPE_FLOAT`` gives ``FLOAT``)."""
    return header_type.split("_")[1]


def metric_value(c: Column, header_type: str) -> Column:
    if header_type == TEXT_METRIC_TYPE:
        return c
    return c.cast("bigint") if header_type == INTEGER_METRIC_TYPE else c.cast("double")


def micros_to_units(c: Column) -> Column:
    return c.cast("double") / F.lit(1000000.0)


def lsn_hex(c: Column) -> Column:
    """Log position as the database prints it: high word, slash, eight low digits."""
    low = c.bitwiseAND(F.lit(4294967295).cast("bigint"))
    return F.format_string("%X/%08X", F.shiftrightunsigned(c, 32), low)


def bytea(c: Column) -> Column:
    r"""Bytes of a hex text such as ``\x00ff``."""
    return F.unhex(F.replace(c, F.lit("\\x"), F.lit("")))
