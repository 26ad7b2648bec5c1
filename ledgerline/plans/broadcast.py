"""Broadcast only behind a proven size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_count_at_most(df: DataFrame, limit: int) -> bool:
    """True when ``df`` has at most ``limit`` rows. Reads at most
    ``limit + 1`` rows' worth of counting, never the rows themselves."""
    return df.limit(limit + 1).count() <= limit


def broadcast_if_bounded(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint when the side is checked to be small; otherwise the
    frame is returned untouched and Spark (with AQE's run-time statistics)
    picks a shuffle join."""
    if row_count_at_most(df, max_rows):
        return F.broadcast(df)
    return df
