"""Join helpers: broadcast only what is proven small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 100_000


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only after checking the row count (one bounded probe);
    larger tables are left to the planner (shuffle join, AQE may still switch)."""
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
