"""Scans of landed data: JSON pages, statistics files, report segments, tables and logs."""
