"""Registered queries: every operator over the whole given tables, with its SQL where one exists."""

from adlake.workload import ads, analytics, changes, keys, loads, logs, reports, runs, tables  # noqa: F401
from adlake.workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
