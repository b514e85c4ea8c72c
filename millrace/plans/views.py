"""The analysts' views over golden rows and object-access logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.clock import whole_units
from millrace.functions.jsonx import key_count
from millrace.operators.dedup import repeated_deliveries

# Thresholds and labels of the views.
LATE_MINUTES = 5
EXPECTED_SCHEMA_VERSION = "1.0"
MAX_CANONICAL_KEYS = 20
VERSION_DRIFT, FIELD_DRIFT = "SCHEMA_VERSION_DRIFT", "CANONICAL_EVENT_FIELD_DRIFT"

LINEAGE_COLUMNS = (
    "event_id", "trace_id", "span_id", "source_system", "format", "produced_at", "ingest_timestamp",
    "canonicalization_timestamp", "write_timestamp", "transmission_timestamp", "dispatched_at",
    "s3_last_modified", "glue_processed_at", "lineage_json")

LATENCIES = {
    "ms_ingest_to_canonical": ("ingest_timestamp", "canonicalization_timestamp"),
    "ms_canonical_to_write": ("canonicalization_timestamp", "write_timestamp"),
    "ms_write_to_transmission": ("write_timestamp", "transmission_timestamp"),
    "ms_transmission_to_s3": ("transmission_timestamp", "s3_last_modified"),
    "ms_s3_to_glue": ("s3_last_modified", "glue_processed_at"),
    "ms_end_to_end": ("ingest_timestamp", "glue_processed_at"),
}


def lineage_view(golden: DataFrame) -> DataFrame:
    return golden.select(*LINEAGE_COLUMNS)


def latency_view(golden: DataFrame) -> DataFrame:
    return golden.select(
        "event_id", "trace_id", "produced_at", "ingest_timestamp", "canonicalization_timestamp", "write_timestamp",
        "transmission_timestamp", "s3_last_modified", "glue_processed_at",
        *[whole_units("MILLISECOND", F.col(a), F.col(b)).alias(name) for name, (a, b) in LATENCIES.items()])


def replays(golden: DataFrame) -> DataFrame:
    """Deliveries of events that arrived more than once; the count includes the first."""
    times = ("transmission_timestamp", "s3_last_modified", "glue_processed_at")
    return repeated_deliveries(
        golden.select("event_id", "trace_id", *times), "event_id", salt=["trace_id", *times])


def replay_view(golden: DataFrame) -> DataFrame:
    return replays(golden).orderBy("event_id", "transmission_timestamp")


def is_late() -> Column:
    return whole_units("MINUTE", F.col("transmission_timestamp"), F.col("s3_last_modified")) > LATE_MINUTES


def late_arrivals(golden: DataFrame) -> DataFrame:
    return golden.filter(is_late()).select(
        "event_id", "trace_id", "transmission_timestamp", "s3_last_modified", "glue_processed_at",
        whole_units("SECOND", F.col("transmission_timestamp"), F.col("s3_last_modified")).alias("delay_seconds"))


def late_arrival_view(golden: DataFrame) -> DataFrame:
    return late_arrivals(golden).orderBy(F.desc("delay_seconds"))


def slowest_events(golden: DataFrame, k: int = 100) -> DataFrame:
    """The k latest arrivals; only k rows per task take part in the final sort."""
    return late_arrivals(golden).orderBy(F.desc("delay_seconds"), "event_id", "transmission_timestamp").limit(k)


def schema_version_view(golden: DataFrame) -> DataFrame:
    return golden.filter(F.col("schema_version").isNotNull()).select(
        "event_id", "trace_id", "lineage_json", "schema_version")


def drift_type(version: Column, keys: Column) -> Column:
    return (
        F.when(version.isNotNull() & (version != EXPECTED_SCHEMA_VERSION), F.lit(VERSION_DRIFT))
        .when(keys > MAX_CANONICAL_KEYS, F.lit(FIELD_DRIFT)))


def drifted(golden: DataFrame) -> DataFrame:
    """Rows of another schema version or with too many keys in the canonical document."""
    return golden.withColumn(
        "drift_type", drift_type(F.col("schema_version"), key_count(F.col("canonical_json")))
    ).filter(F.col("drift_type").isNotNull())


def schema_drift_view(golden: DataFrame) -> DataFrame:
    return drifted(golden).select(
        "event_id", "trace_id", "schema_version", "s3_last_modified", "glue_processed_at", "drift_type"
    ).orderBy(F.desc("glue_processed_at"))


def ingestion_hourly(object_writes: DataFrame) -> DataFrame:
    return object_writes.groupBy(F.date_trunc("hour", "eventtime").alias("hour"), "bucket_name").agg(
        F.count("*").alias("object_count"), F.sum("size_bytes").alias("total_bytes")).orderBy(F.desc("hour"))


def register_views(golden: DataFrame, object_writes: DataFrame | None = None) -> None:
    """Make the views available to SQL under their names."""
    views = {
        "events_lineage_view": lineage_view(golden),
        "events_latency_view": latency_view(golden),
        "events_replay_view": replay_view(golden),
        "events_late_arrival_view": late_arrival_view(golden),
        "events_schema_version_view": schema_version_view(golden),
        "events_schema_drift_view": schema_drift_view(golden),
    }
    if object_writes is not None:
        views |= {"s3_ingestion_events": object_writes, "s3_ingestion_hourly": ingestion_hourly(object_writes)}
    for name, view in views.items():
        view.createOrReplaceTempView(name)
