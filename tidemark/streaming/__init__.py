"""Freshness of event streams, and incremental loads."""
