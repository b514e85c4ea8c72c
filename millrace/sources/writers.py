"""Sinks: golden Parquet, quarantine JSON, raw document layouts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from millrace.operators.dedup import first_delivery

# Partition columns and the tags stored with each column.
GOLDEN_PARTITIONS = ("event_date", "format_partition")
FILE_TAGS = {"pipeline": "millrace", "pipeline_version": "1.0", "lineage_enabled": "true"}
RAW_KEY = ("source_system", "event_type", "event_id")


def _require(df: DataFrame, columns: Sequence[str]) -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def tagged(df: DataFrame, tags: dict[str, str] | None = None) -> DataFrame:
    """Attach pipeline tags to every column; Parquet keeps them in the footer."""
    tags = FILE_TAGS if tags is None else tags
    return df.select(*[F.col(f"`{name}`").alias(name, metadata=tags) for name in df.columns])


def write_golden(df: DataFrame, path: str, mode: str = "append") -> Observation:
    """Append Parquet by event_date and format_partition; returns the row count observed.

    Rows are rebalanced on the partition columns before writing: small partitions
    get one file, and adaptive execution splits a large one over several tasks.
    """
    _require(df, GOLDEN_PARTITIONS)
    written = Observation("golden")
    (
        tagged(df).observe(written, F.count(F.lit(1)).alias("written_records"))
        .hint("rebalance", *GOLDEN_PARTITIONS)
        .write.mode(mode).partitionBy(*GOLDEN_PARTITIONS).parquet(path))
    return written


def write_quarantine(df: DataFrame, path: str, mode: str = "append", error_date: Column | None = None) -> None:
    """Append rejected rows as JSON by error_date. Any columns, but error_reason is needed."""
    _require(df, ["error_reason"])
    day = F.current_date() if error_date is None else error_date
    df.withColumn("error_date", day).hint("rebalance", "error_date").write.mode(mode).partitionBy("error_date").json(path)


def write_raw_zone(documents: DataFrame, path: str, newest: str = "transmission_timestamp") -> None:
    """Append JSON by source_system and event_type, one document per key.

    ``read_raw_zone`` shows only the latest document of a key, so a later document
    replaces an earlier one without rewriting what else its partition holds.
    """
    _require(documents, (*RAW_KEY, newest))
    last = first_delivery(documents, RAW_KEY, [F.col(newest).desc()])
    last.hint("rebalance", "source_system", "event_type").write.mode("append").partitionBy("source_system", "event_type").json(path)


def read_raw_zone(spark: SparkSession, path: str, schema: str, newest: str = "transmission_timestamp") -> DataFrame:
    """The latest document per key. ``schema`` includes the key and ``newest``."""
    return first_delivery(spark.read.schema(schema).json(path), RAW_KEY, [F.col(newest).desc()])


def compact_raw_zone(spark: SparkSession, source: str, target: str, schema: str, newest: str = "transmission_timestamp") -> None:
    """The latest document per key of ``source`` to a new folder, from which reading goes on without the history."""
    last = read_raw_zone(spark, source, schema, newest)
    last.hint("rebalance", "source_system", "event_type").write.mode("overwrite").partitionBy("source_system", "event_type").json(target)


def by_day(df: DataFrame, at: str, names: Sequence[str] = ("yyyy", "mm", "dd")) -> DataFrame:
    """Add year, month and day columns as zero-padded text."""
    formats = ("yyyy", "MM", "dd")
    return df.withColumns({name: F.date_format(at, fmt) for name, fmt in zip(names, formats)})


def write_raw_by_day(documents: DataFrame, path: str, at: str = "produced_at") -> None:
    by_day(documents, at).hint("rebalance", "yyyy", "mm", "dd").write.mode("append").partitionBy("yyyy", "mm", "dd").json(path)


def write_canonical_layout(df: DataFrame, path: str, at: str = "produced_at") -> None:
    """Parquet by event_type, year, month and day."""
    parts = ("year", "month", "day")
    (
        by_day(df, at, parts).hint("rebalance", "event_type", *parts)
        .write.mode("append").partitionBy("event_type", *parts).parquet(path))


def compact_golden(spark: SparkSession, source: str, target: str) -> Observation:
    """Rewrite a golden folder with few files per partition."""
    return write_golden(spark.read.parquet(source), target, mode="overwrite")
