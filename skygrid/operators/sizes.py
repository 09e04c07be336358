"""Broadcasts behind a check of their size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMALL_ROWS = 100_000


def small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """``df`` with a broadcast hint, if it has no more than ``rows`` rows; a
    larger one is joined by a shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def spread(df: DataFrame, *key: str) -> DataFrame:
    """``df`` dealt to all tasks by ``key``, for steps that cost far more than
    the bytes of what they read; a stated number keeps adaptive execution from
    judging by those."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *key)
