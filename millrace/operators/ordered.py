"""Ordered windows per key at any skew, by a segmented prefix scan.

A plain window sends all rows of a key to one task. That is right for keys of up to ``hot_rows`` rows. Rows of larger
keys are range-partitioned by key and order instead, so that a range is bounded whatever the key or the time. Each
(range, key) is reduced to one associative summary: its number of rows, its extreme, its first and its last row. A
window over the summaries carries counts, extremes and edge rows from range to range, and the rows take them up again.
There are at most rows / ``hot_rows`` large keys and about two summaries a range, so both are small.

Ranges are written to the shared work folder once: sampling for range bounds need not come out the same twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.operators.joins import HOT_ROWS, null_safe_join
from millrace.session import work_dir

PRECEDING = (Window.unboundedPreceding, -1)


def _heavy(df: DataFrame, key: str, hot_rows: int) -> DataFrame:
    """Keys above ``hot_rows`` rows, with their numbers: at most rows / ``hot_rows``, which bounds their broadcast."""
    return df.groupBy(key).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > hot_rows)


def _ranged(df: DataFrame, key: str, order: Sequence[str], rows: int, range_rows: int) -> DataFrame:
    """``df`` in ranges of about ``range_rows`` rows by key and order, numbered by ``_range``."""
    spark, path = df.sparkSession, work_dir(df.sparkSession, "ranges")
    ranges = df.repartitionByRange(-(-rows // range_rows), key, *order).withColumn("_range", F.spark_partition_id())
    ranges.write.parquet(path)
    return spark.read.schema(ranges.schema).parquet(path)


class _Scan:
    """What is asked of a scan: ``plain`` over whole keys, or ``local`` within a range and ``final`` with what is carried."""

    def __init__(self, key: str, order: Sequence[str], previous: dict[str, str], following: dict[str, str],
                 sequence: str | None, running_max: dict[str, str]):
        self.key, self.order, self.previous, self.following = key, list(order), previous, following
        self.sequence, self.running_max = sequence, running_max
        self.edge = sorted({*previous.values(), *following.values()}) or list(order)

    def columns(self, *partition: str) -> dict[str, Column]:
        within = Window.partitionBy(*partition).orderBy(*self.order)
        out = {name: F.lag(source).over(within) for name, source in self.previous.items()}
        out |= {name: F.lead(source).over(within) for name, source in self.following.items()}
        out |= {name: F.max(source).over(within.rowsBetween(*PRECEDING)) for name, source in self.running_max.items()}
        if self.sequence:
            out[self.sequence] = F.row_number().over(within)
        return out

    def plain(self, df: DataFrame) -> DataFrame:
        return df.withColumns(self.columns(self.key))

    def summaries(self, ranged: DataFrame) -> DataFrame:
        at, edge = F.struct(*self.order), F.struct(*self.edge)
        return ranged.groupBy("_range", self.key).agg(
            F.count("*").alias("_n"), F.min_by(edge, at).alias("_first"), F.max_by(edge, at).alias("_last"),
            *[F.max(source).alias(f"_top_{name}") for name, source in self.running_max.items()])

    def carried(self, summaries: DataFrame) -> DataFrame:
        """Per range and key: what lies before and after it."""
        ranges = Window.partitionBy(self.key).orderBy("_range")
        before = ranges.rowsBetween(*PRECEDING)
        return summaries.select(
            "_range", self.key, "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
            F.lag("_last").over(ranges).alias("_left"), F.lead("_first").over(ranges).alias("_right"),
            *[F.max(f"_top_{name}").over(before).alias(f"_top_{name}") for name in self.running_max])

    def scanned(self, df: DataFrame, rows: int, range_rows: int) -> DataFrame:
        ranged = _ranged(df, self.key, self.order, rows, range_rows)
        place = F.row_number().over(Window.partitionBy("_range", self.key).orderBy(*self.order))
        local = ranged.withColumns({"_place": place, **self.columns("_range", self.key)})
        out = null_safe_join(local, self.carried(self.summaries(ranged)), ["_range", self.key])
        final = {name: F.when(F.col("_place") == 1, F.col("_left")[source]).otherwise(F.col(name)) for name, source in self.previous.items()}
        final |= {name: F.when(F.col("_place") == F.col("_n"), F.col("_right")[source]).otherwise(F.col(name)) for name, source in self.following.items()}
        final |= {name: F.greatest(name, f"_top_{name}") for name in self.running_max}
        if self.sequence:
            final[self.sequence] = (F.col("_before") + F.col(self.sequence)).cast("long")
        return out.select(*df.columns, *[value.alias(name) for name, value in final.items()])

    def run(self, df: DataFrame, hot_rows: int, range_rows: int) -> DataFrame:
        heavy = _heavy(df, self.key, hot_rows)
        found = heavy.agg(F.count("*").alias("keys"), F.sum("_rows").alias("rows")).first()
        if not found["keys"]:
            out = self.plain(df)
        else:
            keys = heavy.select(F.col(self.key).alias("_heavy"))
            same = F.col(self.key).eqNullSafe(F.col("_heavy"))
            light = df.join(F.broadcast(keys), same, "left_anti")
            out = self.plain(light).unionByName(self.scanned(df.join(F.broadcast(keys), same, "left_semi"), found["rows"], range_rows))
        return out.withColumn(self.sequence, F.col(self.sequence).cast("long")) if self.sequence else out


def with_neighbours(df: DataFrame, key: str, order: Sequence[str], previous: dict[str, str] | None = None,
                    following: dict[str, str] | None = None, sequence: str | None = None,
                    hot_rows: int = HOT_ROWS, range_rows: int | None = None) -> DataFrame:
    """Add sequence number, previous and following values in order within a key.

    ``order`` must be unique per key. ``previous`` and ``following`` map new columns to source columns. NULL is a key
    like any other. Ranges hold about ``range_rows`` rows, by default ``hot_rows``.
    """
    return _Scan(key, order, previous or {}, following or {}, sequence, {}).run(df, hot_rows, range_rows or hot_rows)


def with_running_max(df: DataFrame, key: str, order: Sequence[str], value: str, name: str,
                     hot_rows: int = HOT_ROWS, range_rows: int | None = None) -> DataFrame:
    """Add the largest ``value`` among the rows before each row of a key."""
    return _Scan(key, order, {}, {}, None, {name: value}).run(df, hot_rows, range_rows or hot_rows)
