"""Streams: the usage ledger as it grows, and alerts without repeats."""
