"""Structured Streaming jobs: change apply and incremental file loads."""
