"""Exact interpolated percentiles per group without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from millrace.operators.joins import fits, null_safe_join


def exact_percentiles(df: DataFrame, group: Sequence[str], value: str, probabilities: dict[str, float],
                      bin_width: float) -> DataFrame:
    """One row per group with the percentiles and ``n``.

    Rows are counted per bin, which partial aggregation cuts to a few rows per task before the first shuffle; only the
    values in bins that hold a wanted rank are then counted one by one. NULL values are skipped.
    """
    group = list(group)
    rows = df.filter(F.col(value).isNotNull()).select(*group, F.col(value).cast("double").alias("_v")).withColumn(
        "_bin", F.floor(F.col("_v") / bin_width))
    ordered_bins = Window.partitionBy(*group).orderBy("_bin")
    bins = rows.groupBy(*group, "_bin").agg(F.count("*").alias("_c")).select(
        *group, "_bin",
        (F.sum("_c").over(ordered_bins) - F.col("_c")).alias("_start"),
        F.sum("_c").over(ordered_bins).alias("_end"),
        F.sum("_c").over(Window.partitionBy(*group)).alias("_total"))
    rank = lambda p: F.lit(p) * (F.col("_total") - 1)
    wanted = F.array(*[
        F.struct(F.lit(name).alias("name"), rank(p).alias("rank"),
                 F.floor(rank(p)).alias("low"), F.ceil(rank(p)).alias("high"))
        for name, p in probabilities.items()])
    chosen = bins.withColumn("_wanted", F.filter(
        wanted, lambda w: (w["low"] < F.col("_end")) & (w["high"] >= F.col("_start")))
    ).filter(F.size("_wanted") > 0).drop("_end")
    # A group has at most two chosen bins per percentile; where that is few rows in all, the others are dropped unshuffled.
    few = fits(chosen)
    inside = null_safe_join(rows, F.broadcast(chosen.select(*group, "_bin")) if few else chosen.select(*group, "_bin"), [*group, "_bin"])
    counts = inside.groupBy(*group, "_bin", "_v").agg(F.count("*").alias("_c"))
    in_bin = Window.partitionBy(*group, "_bin").orderBy("_v")
    placed = (
        null_safe_join(counts, chosen, [*group, "_bin"])
        .withColumn("_upto", F.col("_start") + F.sum("_c").over(in_bin))
        .withColumn("_w", F.explode("_wanted")))
    covers = lambda r: (F.col("_upto") - F.col("_c") <= F.col(f"_w.{r}")) & (F.col(f"_w.{r}") < F.col("_upto"))
    picked = placed.filter(covers("low") | covers("high"))
    at = lambda name, r: F.max(F.when((F.col("_w.name") == name) & covers(r), F.col("_v")))
    share = lambda name: F.max(F.when(F.col("_w.name") == name, F.col("_w.rank") - F.col("_w.low")))
    return picked.groupBy(*group).agg(
        F.max("_total").alias("n"),
        *[(at(name, "low") + share(name) * (at(name, "high") - at(name, "low"))).alias(name)
          for name in probabilities])
