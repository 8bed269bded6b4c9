"""Spark-native engine for snapshots and daily series of regional statistics."""

from snapstats.session import session

__all__ = ["session"]
