"""Day keys, report dates and time dimensions.

Everything works on ``TIMESTAMP_NTZ`` or text, so no result depends on the session time zone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

from adlake.functions.text import blank_to_null, strip

BUSINESS_TZ = "America/Los_Angeles"


def _utc_wall_clock(c: Column, data_type: T.DataType | None) -> Column:
    if isinstance(data_type, T.TimestampType):
        return F.convert_timezone(F.current_timezone(), F.lit("UTC"), c.cast("timestamp_ntz"))
    return c


def day_key(c: Column, tz: str | None = None, data_type: T.DataType | None = None) -> Column:
    """Calendar day of a UTC time, or of that time seen in ``tz``.

    Pass ``data_type`` when the column may be a zoned ``TimestampType``.
    """
    wall = _utc_wall_clock(c, data_type)
    if tz is not None:
        wall = F.convert_timezone(F.lit("UTC"), F.lit(tz), wall)
    return F.to_date(wall)


def day_range_utc(c: Column, start: str, end: str, tz: str | None = None) -> Column:
    """``day_key(c, tz) BETWEEN start AND end`` written as bounds on the raw time.

    The bounds are constants, so the filter reaches the file scan; a filter on the
    converted key would not.
    """

    def edge(day: dt.date) -> str:
        text = f"TIMESTAMP_NTZ '{day.isoformat()} 00:00:00'"
        return text if tz is None else f"convert_timezone('{tz}', 'UTC', {text})"

    first = dt.date.fromisoformat(start)
    after = dt.date.fromisoformat(end) + dt.timedelta(days=1)
    return (c >= F.expr(edge(first))) & (c < F.expr(edge(after)))


def day_key_from_string(c: Column) -> Column:
    """Day of an ISO date text; text that is not a date gives NULL."""
    return c.try_cast("date")


def ga_date_key(c: Column) -> Column:
    """ISO day text of a report date: eight digits are split, other text passes through.

    Cast date or timestamp columns with ``cast('date')`` first; their text is ISO already.
    """
    s = blank_to_null(strip(c.cast("string")))
    dashed = F.concat_ws("-", F.substring(s, 1, 4), F.substring(s, 5, 2), F.substring(s, 7, 2))
    return F.when(s.rlike(r"^\d{8}$"), dashed).otherwise(s)


def play_date_key(c: Column) -> Column:
    return blank_to_null(strip(c.cast("string")))


# Time dimensions of the report service and the text format of each one.
TIME_DIMENSION_FORMATS = {
    "date": "yyyyMMdd",
    "dateHour": "yyyyMMddHH",
    "dateHourMinute": "yyyyMMddHHmm",
    "yearMonth": "yyyyMM",
    "year": "yyyy",
}
ISO_WEEK_DIMENSION = "isoYearIsoWeek"
TIME_DIMENSIONS = frozenset((*TIME_DIMENSION_FORMATS, ISO_WEEK_DIMENSION))


def iso_week_start(c: Column) -> Column:
    """Monday of an ISO year-week text such as ``202401``."""
    year, week = F.substring(c, 1, 4).cast("int"), F.substring(c, 5, 2).cast("int")
    first_monday = F.trunc(F.make_date(year, F.lit(1), F.lit(4)), "WEEK")
    return F.date_add(first_monday, (week - 1) * 7)


def ga_time_dimension(name: str, c: Column) -> Column:
    """Time value of a dimension as UTC ``TIMESTAMP_NTZ``; other dimensions stay as they are."""
    if name == ISO_WEEK_DIMENSION:
        return iso_week_start(c).cast("timestamp_ntz")
    if name in TIME_DIMENSION_FORMATS:
        return F.to_timestamp_ntz(c, F.lit(TIME_DIMENSION_FORMATS[name]))
    return c


def months_back(n: int, today: dt.date) -> list[str]:
    """The last ``n`` months and the current one as ``YYYYMM``, oldest first."""
    current = today.year * 12 + today.month - 1
    return [f"{m // 12}{m % 12 + 1:02d}" for m in range(current - n, current + 1)]


def months_back_column(n: int, today: Column) -> Column:
    """``months_back`` as an array column, for a reference day that is data."""
    start = F.add_months(F.trunc(today, "MM"), -n)
    span = F.sequence(start, F.trunc(today, "MM"), F.expr("INTERVAL 1 MONTH"))
    return F.transform(span, lambda m: F.date_format(m, "yyyyMM"))


def pg_epoch(micros: Column) -> Column:
    """Microseconds since 2000-01-01 UTC as a timestamp."""
    return F.timestamp_micros(F.lit(946684800000000).cast("bigint") + micros)
