"""Columns that are computed once per row, by all cores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Like ``withColumns``, but later filters and projections read the result.

    Catalyst pushes a filter below a projection by repeating the projected
    expression, and merges projections by nesting their expressions. For parsing
    steps that build on each other this evaluates the same work many times. A
    one-row ``inline`` ends that: its output is a plain column to what follows.
    """
    kept = [name for name in df.columns if name not in columns]
    computed = df.select(*kept, *[value.alias(f"_once_{name}") for name, value in columns.items()])
    row = F.struct(*[F.col(f"_once_{name}").alias(name) for name in columns])
    return computed.select(*kept, F.inline(F.array(row)))


def spread_scan(df: DataFrame, key: str) -> DataFrame:
    """Spread a scan with fewer splits than half the cores before row-by-row parsing.

    One small file is one split and would be parsed by one core. Large tables have
    more splits than there are cores and are left as they are, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() * 2 < cores else df
