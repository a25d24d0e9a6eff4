"""Operators for preparing training text: filters, near duplicates, scoring, packing, archives."""
