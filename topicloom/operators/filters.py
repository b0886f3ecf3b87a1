"""Row filters (FLT-01..04)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.functions.text import strip_ws


def usable_text(df: DataFrame, text_column: str) -> DataFrame:
    """FLT-03: keep rows whose text, stripped of Unicode whitespace, is non-empty.

    A missing column is an analysis-time error, as in the reference."""
    if text_column not in df.columns:
        raise ValueError(f"no column {text_column!r} to take texts from")
    return df.where(F.length(strip_ws(F.coalesce(F.col(text_column), F.lit("")))) > 0)


def supervised_rows(df: DataFrame, text_column: str, target_column: str) -> DataFrame:
    """FLT-04: drop rows with a NULL text or target and keep non-empty text (not stripped)."""
    for c in (text_column, target_column):
        if c not in df.columns:
            raise ValueError(f"no column {c!r} to train on")
    return df.dropna(subset=[text_column, target_column]).where(F.length(text_column) > 0)


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Fail fast when a filter leaves nothing (one cheap ``isEmpty`` probe)."""
    if df.isEmpty():
        raise ValueError(message)
    return df
