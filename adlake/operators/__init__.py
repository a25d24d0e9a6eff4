"""DataFrame operators: loads, merges, diffs, windows, checks and report aggregates."""
