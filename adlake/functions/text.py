"""Text keys, routing and fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

_SPACES = " \t\n\r\f\v"


def strip(c: Column) -> Column:
    """Trim every kind of white space (Spark's ``trim`` only removes blanks)."""
    return F.btrim(c, F.lit(_SPACES))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def norm_case(c: Column, case: str = "lower") -> Column:
    return F.upper(c) if case == "upper" else F.lower(c)


def last_segment(c: Column, sep: str = ".") -> Column:
    """Text after the last separator; the whole text when there is none."""
    return F.substring_index(c, sep, -1)


def py_str(c: Column, parity: bool = True) -> Column:
    """Text of a value; a missing one prints ``None`` under parity, else NULL."""
    text = c.cast("string")
    return F.coalesce(text, F.lit("None")) if parity else text


def row_rank_id(row_id: Column, rank: Column) -> Column:
    return F.concat(row_id.cast("string"), F.lit("-"), py_str(rank))


def first_non_empty(cols: Sequence[Column], default: str = "all") -> Column:
    return F.coalesce(*[blank_to_null(c) for c in cols], F.lit(default))


def key_or_placeholder(c: Column, name: str) -> Column:
    """Report keys stay text, so that a missing one can read ``no_<name>``."""
    return F.coalesce(c.cast("string"), F.lit(f"no_{name}"))


# File-name endings and the dimension each one stands for, in match order.
DIMENSION_SUFFIXES = (
    ("_country.csv", "country"),
    ("_device.csv", "device"),
    ("_app_version.csv", "app_version"),
    ("_carrier.csv", "carrier"),
    ("_language.csv", "language"),
    ("_os_version.csv", "os_version"),
    ("_traffic_source.csv", "traffic_source"),
)


def dimension_type(path: Column) -> Column:
    """Breakdown dimension named by a statistics file; files without one are ``overview``."""
    hits = [F.when(path.contains(suffix), F.lit(name)) for suffix, name in DIMENSION_SUFFIXES]
    return F.coalesce(*hits, F.lit("overview"))


# Log-name endings and the ad shape each one carries, in match order.
LOG_ROUTES = (("car", "car"), ("flight", "flight"), ("hotel", "hotel"), ("ad_fetch", "legacy"))


def log_route(name: Column) -> Column:
    """Shape of an ad-log row by its name ending; NULL for an unknown name."""
    return F.coalesce(*[F.when(name.endswith(end), F.lit(kind)) for end, kind in LOG_ROUTES])


def fingerprint(fields: Sequence[str]) -> Column:
    """SHA-256 of the fields as JSON: names sorted, NULLs kept."""
    payload = F.struct(*[F.col(f).cast("string").alias(f) for f in sorted(fields)])
    return F.sha2(F.to_json(payload, {"ignoreNullFields": "false"}), 256)
