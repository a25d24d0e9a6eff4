"""Paths into free-form JSON, telling a missing key from a JSON null."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def json_get(v: Column, path: str, to: str = "string", default: Column | None = None) -> Column:
    """Value at ``path`` cast to ``to``.

    ``default`` stands in only when the key is missing or a step of the path is not a
    container; a JSON null at the end of the path stays NULL.
    """
    value = F.try_variant_get(v, path, to)
    if default is None:
        return value
    found = F.try_variant_get(v, path, "variant")
    return F.when(found.isNull(), default).otherwise(value)


def json_items(v: Column, path: str) -> Column:
    """Array at ``path``; anything else, a JSON null included, counts as empty."""
    return F.coalesce(
        F.try_variant_get(v, path, "array<variant>"),
        F.array().cast("array<variant>"),
    )


def is_json_true(v: Column, path: str) -> Column:
    """Whether the value is one a Python test would take: not null, zero, empty or false."""
    text = F.coalesce(F.try_variant_get(v, path, "string"), F.lit(""))
    number = text.try_cast("double")
    return ~((text == "") | (F.lower(text) == "false") | F.coalesce(number == 0, F.lit(False)))


def item_count(c: Column) -> Column:
    return F.size(c)
