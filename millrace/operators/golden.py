"""Stored documents to golden rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.clock import elapsed_ms, parse_timestamp
from millrace.functions.lineage import stage_time

INVALID_REASON = "Missing required canonical_event or envelope fields"  # fixed value

# Hops of the batch job: metric -> (start column, end column).
HOPS = {
    "ms_produced_to_ingest": ("produced_at", "ingest_timestamp"),
    "ms_ingest_to_canonicalized": ("ingest_timestamp", "canonicalization_timestamp"),
    "ms_canonicalized_to_transmission": ("canonicalization_timestamp", "transmission_timestamp"),
    "ms_transmission_to_stored": ("transmission_timestamp", "s3_last_modified"),
    "ms_stored_to_processed": ("s3_last_modified", "glue_processed_at"),
    "ms_end_to_end": ("produced_at", "glue_processed_at"),
}


def partition_columns(df: DataFrame, produced_at: str = "produced_at", format: str = "format") -> DataFrame:
    """Add event_date and format_partition. produced_at may be text or a timestamp."""
    return df.withColumns({
        "event_date": F.to_date(F.try_to_timestamp(F.col(produced_at).cast("string"))),
        "format_partition": F.col(format),
    })


def is_valid(document: str = "canonical_event", envelope: str = "envelope") -> Column:
    return (
        F.col(f"{document}.event_id").isNotNull()
        & F.col(f"{document}.format").isNotNull()
        & F.col(f"{envelope}.produced_at").isNotNull())


def split_validity(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid documents, and the complement with its reason. Both are filters over one input."""
    marked = documents.withColumn("is_valid", is_valid())
    valid = marked.filter("is_valid").drop("is_valid")
    invalid = marked.filter(~F.col("is_valid")).drop("is_valid").withColumn("error_reason", F.lit(INVALID_REASON))
    return valid, invalid


def split_counts(documents: DataFrame) -> DataFrame:
    """What the split makes of its input, in one aggregate: rows in all, in either part, and in none."""
    valid = is_valid()
    return documents.agg(
        F.count("*").alias("total"), F.count_if(valid).alias("valid"), F.count_if(~valid).alias("invalid"),
        F.count_if(valid.isNull()).alias("missing"))


def flatten(documents: DataFrame, processed_at: Column) -> DataFrame:
    """Golden rows with flat columns. ``processed_at`` is one time for the whole run."""
    stage = lambda name: parse_timestamp(stage_time(F.col("lineage"), name))
    dispatched = parse_timestamp(F.col("dispatched_at"))
    out = documents.select(
        F.col("canonical_event.event_id").alias("event_id"),
        "trace_id", "span_id",
        F.coalesce("canonical_event.source_system", "envelope.source_system").alias("source_system"),
        F.col("envelope.event_type").alias("event_type"),
        F.col("envelope.event_version").alias("schema_version"),
        F.col("canonical_event.format").alias("format"),
        parse_timestamp(F.col("envelope.produced_at")).alias("produced_at"),
        stage("ingest").alias("ingest_timestamp"),
        stage("normalized").alias("normalization_timestamp"),
        stage("canonicalized").alias("canonicalization_timestamp"),
        stage("compliance").alias("compliance_stage_timestamp"),
        F.coalesce(stage("written"), dispatched).alias("write_timestamp"),
        parse_timestamp(F.col("transmission_timestamp")).alias("transmission_timestamp"),
        dispatched.alias("dispatched_at"),
        *[c for c in ("s3_uri", "s3_last_modified") if c in documents.columns],
        processed_at.cast("timestamp").alias("glue_processed_at"),
        F.to_json("lineage").alias("lineage_json"),
        F.to_json("canonical_event").alias("canonical_json"),
        F.col("canonical_event.patient").alias("patient"),
        F.col("canonical_event.encounter").alias("encounter"),
        F.col("canonical_event.observation").alias("observation"),
        *[F.col(f"canonical_event.{c}").alias(c) for c in (
            "compliance_applied", "compliance_flag", "compliance_reason", "compliance_rule_type",
            "compliance_rule_id")])
    return partition_columns(out)


def hop_latencies(golden: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Tall table (metric, ms) with one row per hop that has both times."""
    pairs = F.array(*[
        F.struct(F.lit(name).alias("metric"), elapsed_ms(F.col(a), F.col(b)).alias("ms"))
        for name, (a, b) in HOPS.items()])
    return (
        golden.select(*extra, F.explode(pairs).alias("hop")).select(*extra, "hop.metric", "hop.ms")
        .filter(F.col("ms").isNotNull()))


def latency_totals(golden: DataFrame) -> DataFrame:
    """Sum, count and average per hop."""
    return hop_latencies(golden).groupBy("metric").agg(
        F.sum("ms").alias("sum_ms"), F.count("*").alias("n"), F.avg("ms").alias("avg_ms"))


def record_counters(documents: DataFrame) -> DataFrame:
    """Total, valid and invalid documents in one pass."""
    return documents.agg(
        F.count("*").alias("total_records"),
        F.count_if(is_valid()).alias("valid_records"),
        F.count_if(~is_valid()).alias("invalid_records"))
