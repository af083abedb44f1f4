"""Grouping of a stream by time, where a burst id is not given, and state that ages out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sessions(events: DataFrame, by: list[str], time: str, gap: str, delay: str | None = None) -> DataFrame:
    """Runs of events of one key with pauses of less than ``gap``: by, start, end, n. With ``delay``, as
    a stream whose late events beyond it are dropped."""
    e = events.withWatermark(time, delay) if delay else events
    w = F.session_window(time, gap)
    return e.groupBy(*by, w.alias("w")).agg(F.count("*").alias("n")).select(*by, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def expired(time: Column, now: Column, age: str = "3 hours") -> Column:
    """Whether something of ``time`` is older than ``age``."""
    return time < now - F.expr(f"interval {age}")
