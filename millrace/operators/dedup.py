"""Repeated deliveries of the same event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from millrace.operators.joins import spread_join


def first_delivery(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the earliest. Map tasks keep one row per key before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def repeated_deliveries(df: DataFrame, key: str, salt: Sequence[str]) -> DataFrame:
    """All deliveries of events delivered more than once, with ``replay_count``.

    Counting is partially aggregated before the shuffle; the rows then join their
    count, keys with very many rows in pieces.
    """
    counts = df.groupBy(key).agg(F.count("*").alias("replay_count")).filter(F.col("replay_count") > 1)
    return spread_join(df, counts, [key], "replay_count", salt)
