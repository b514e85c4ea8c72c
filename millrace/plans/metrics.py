"""Windowed metrics and alarms."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, functions as F

from millrace.functions.clock import elapsed_ms
from millrace.functions.jsonx import key_count
from millrace.operators.golden import hop_latencies
from millrace.operators.percentiles import exact_percentiles
from millrace.plans import views

# Percentiles of the dashboards, size limits, log events of failed jobs.
PERCENTILES = {"p50": 0.50, "p95": 0.95, "p99": 0.99}
LARGE_OBJECT_BYTES = 5_242_880
FAILED_JOB_EVENTS = ("job_failed", "glue_job_failed")
BASE_PERIOD = "5 minutes"  # every alarm period is a multiple of this
HISTOGRAM_EDGES = (0, 10, 50, 100, 250, 500, 1000, 5000, 60000, 600000)


def window_start(at: str, size: str) -> Column:
    return F.window(at, size)["start"]


# --- latency ------------------------------------------------------------------------

def latency_percentiles(golden: DataFrame, size: str = "1 minute") -> DataFrame:
    """p50, p95 and p99 end to end per window of the processing time."""
    rows = golden.select(
        window_start("glue_processed_at", size).alias("window_start"),
        elapsed_ms(F.col("produced_at"), F.col("glue_processed_at")).alias("ms"))
    return exact_percentiles(rows, ["window_start"], "ms", PERCENTILES, bin_width=1000.0)


def stage_latency_avg(golden: DataFrame, size: str = "1 minute") -> DataFrame:
    rows = hop_latencies(golden, ("glue_processed_at",))
    return rows.groupBy(window_start("glue_processed_at", size).alias("window_start"), "metric").agg(
        F.avg("ms").alias("avg_ms"))


def stage_latency_histogram(golden: DataFrame) -> DataFrame:
    """Counts per stage, event type, source and latency bucket."""
    rows = hop_latencies(golden, ("event_type", "source_system"))
    bucket = F.size(F.filter(F.array(*[F.lit(float(e)) for e in HISTOGRAM_EDGES]), lambda e: e <= F.col("ms")))
    return rows.groupBy("metric", "event_type", "source_system", bucket.alias("bucket")).agg(F.count("*").alias("n"))


# --- objects ------------------------------------------------------------------------

def object_metrics(object_writes: DataFrame, size: str = "1 hour") -> DataFrame:
    size_bytes = F.col("size_bytes")
    return object_writes.groupBy(window_start("eventtime", size).alias("window_start")).agg(
        F.count("*").alias("object_count"),
        F.coalesce(F.sum(F.when(size_bytes > 0, size_bytes)), F.lit(0)).alias("total_bytes"),
        F.count_if(size_bytes > LARGE_OBJECT_BYTES).alias("large_objects"),
        F.count_if(size_bytes == 0).alias("zero_byte_objects"))


def hours_without_gaps(hourly: DataFrame, at: str = "window_start", count: str = "object_count") -> DataFrame:
    """Every hour between the first and the last one, with 0 where nothing arrived."""
    span = hourly.agg(F.min(at).alias("a"), F.max(at).alias("b"))
    hours = span.select(F.explode(F.expr("sequence(a, b, interval 1 hour)")).alias(at))
    return hours.join(hourly.select(at, count), at, "left").select(at, F.coalesce(count, F.lit(0)).alias(count))


# --- requests and logs --------------------------------------------------------------

def request_metrics(requests: DataFrame) -> DataFrame:
    return requests.groupBy("method", "status").agg(
        F.count("*").alias("requests"), F.avg("latency_ms").alias("avg_latency_ms"),
        F.count_if(F.col("status") >= 500).alias("errors"))


def ingest_errors(requests: DataFrame, route: str = "ingest") -> DataFrame:
    return requests.filter(F.col("reason") != "accepted").groupBy(F.lit(route).alias("route"), "reason").agg(
        F.count("*").alias("errors"))


def ingest_summary(requests: DataFrame, size: str = "5 minutes") -> DataFrame:
    return requests.groupBy(window_start("received_at", size).alias("window_start")).agg(
        F.count("*").alias("attempts"), F.count_if(F.col("status") == 202).alias("accepted"),
        F.count_if(F.col("status") != 202).alias("rejected"))


def error_rates(requests: DataFrame, size: str = "1 minute") -> DataFrame:
    """4xx and 5xx counts and response-time percentiles per window."""
    rows = requests.withColumn("window_start", window_start("received_at", size))
    counts = rows.groupBy("window_start").agg(
        F.count_if(F.col("status").between(400, 499)).alias("errors_4xx"),
        F.count_if(F.col("status") >= 500).alias("errors_5xx"))
    times = exact_percentiles(rows, ["window_start"], "latency_ms", PERCENTILES, bin_width=10.0).drop("n")
    return counts.join(times, "window_start", "left")


def is_failed_job() -> Column:
    return F.col("message").isin(*FAILED_JOB_EVENTS) | F.coalesce(F.col("event").isin(*FAILED_JOB_EVENTS), F.lit(False))


def job_failures(log_records: DataFrame, size: str = "5 minutes") -> DataFrame:
    """Failed jobs per window; the name may be in the message or the event field."""
    return log_records.filter(is_failed_job()).groupBy(window_start("logged_at", size).alias("window_start")).agg(
        F.count("*").alias("failures"))


def success_rate(rows: DataFrame, at: str, ok: Column, size: str = "1 hour") -> DataFrame:
    return rows.groupBy(window_start(at, size).alias("window_start")).agg(
        F.avg(ok.cast("double")).alias("success_rate"), F.count("*").alias("n"))


# --- canonical events ---------------------------------------------------------------

# Reasons of failure counters, by stage; a lookup that fails has one of its own.
FAILURE_REASONS = {
    "normalize": "normalization_failed", "transform": "transformation_failed", "compliance": "compliance_stage_failed", "dispatch": "dispatch_failed"}
LOOKUP_REASONS = {"normalize": ("no normalizer for format", "normalizer_lookup_failed"), "transform": ("no transformer for format", "transformer_lookup_failed")}


def lineage_counts(canonical: DataFrame, event_type: Column) -> DataFrame:
    """Events that reached dispatch, per source and type."""
    return canonical.filter(F.col("error_reason").isNull()).groupBy(
        F.lit("dispatch").alias("stage"), "source_system", event_type.alias("event_type")).agg(F.count("*").alias("events"))


def lineage_failures(canonical: DataFrame, dispatch_failed: Column | None = None) -> DataFrame:
    """Failures per stage and reason. ``dispatch_failed`` marks accepted events whose dispatch failed."""
    stage = F.col("error_stage")
    if dispatch_failed is not None:
        stage = F.coalesce(stage, F.when(dispatch_failed, F.lit("dispatch")))
    lookups = [F.when((F.col("stage") == s) & F.col("error_reason").startswith(text), F.lit(r)) for s, (text, r) in LOOKUP_REASONS.items()]
    reason = F.coalesce(*lookups, *[F.when(F.col("stage") == s, F.lit(r)) for s, r in FAILURE_REASONS.items()])
    return canonical.withColumn("stage", stage).filter(F.col("stage").isNotNull()).groupBy("stage", reason.alias("reason")).agg(
        F.count("*").alias("failures"))


def compliance_hits(enriched: DataFrame) -> DataFrame:
    return enriched.filter(F.col("compliance_rule_id") != "").groupBy(
        "compliance_rule_id", "compliance_rule_type", "compliance_flag").agg(F.count("*").alias("hits"))


def compliance_fallbacks(enriched: DataFrame) -> DataFrame:
    miss = F.col("compliance_rule_id") == ""
    return enriched.groupBy("entity_type").agg(
        F.count_if(miss).alias("rule_misses"), F.count_if(miss & ~F.col("compliance_flag")).alias("fallbacks"),
        F.count_if(~miss).alias("rule_hits"))


# Error codes of the compliance stage.
COMPLIANCE_ERRORS = {
    "missing_identifiers": "INVALID_EVENT_MISSING_IDENTIFIERS", "derive_failed": "INVALID_EVENT_DERIVE_FAILED"}


def compliance_errors(canonical: DataFrame) -> DataFrame:
    kind = F.coalesce(*[F.when(F.col("error_reason") == r, F.lit(code)) for r, code in COMPLIANCE_ERRORS.items()])
    return canonical.filter(F.col("error_stage") == "compliance").groupBy(kind.alias("error_type")).agg(
        F.count("*").alias("errors"))


# --- alarms -------------------------------------------------------------------------


@dataclass(frozen=True)
class AlarmRule:
    alarm: str
    metric: str
    comparison: str
    threshold: float
    statistic: str = "sum"
    period: str = "5 minutes"


# Alarm thresholds.
ALARM_RULES = (
    AlarmRule("job_failures", "job_failures", ">", 0),
    AlarmRule("invalid_records", "invalid_records", ">", 100),
    AlarmRule("schema_drift", "schema_drift", ">", 0),
    AlarmRule("volume_low", "object_count", "<", 10, period="1 hour"),
    AlarmRule("volume_high", "object_count", ">", 50_000, period="1 hour"),
    AlarmRule("end_to_end_latency", "end_to_end_ms", ">", 300_000, statistic="avg"),
    AlarmRule("replay_spike", "replays", ">", 10),
    AlarmRule("late_spike", "late_arrivals", ">", 10),
    AlarmRule("byte_volume", "object_bytes", ">", 10_737_418_240, period="1 hour"),
    AlarmRule("large_objects", "large_objects", ">", 10, period="1 hour"),
    AlarmRule("zero_byte_objects", "zero_byte_objects", ">", 0, period="1 hour"),
    AlarmRule("rejected_requests", "rejected_requests", ">", 10),
    AlarmRule("write_latency", "write_ms", ">", 2000, statistic="p99"),
)


@dataclass(frozen=True)
class Points:
    """Tall rows (metric, at, value) and the metrics they can hold."""

    metrics: tuple[str, ...]
    rows: DataFrame


def points(df: DataFrame, metrics: dict[str, tuple[Column, Column]]) -> Points:
    """One scan to tall rows; NULL values are left out."""
    entries = F.array(*[
        F.struct(F.lit(name).alias("metric"), at.cast("timestamp_ntz").alias("at"), value.cast("double").alias("value"))
        for name, (at, value) in metrics.items()])
    return Points(tuple(metrics), df.select(F.inline(entries)).filter(F.col("value").isNotNull()))


def golden_points(golden: DataFrame) -> Points:
    """Drift is of either kind where the canonical document is at hand (``canonical_json``), else of the version."""
    done = F.col("glue_processed_at")
    drifts = F.col("schema_version") != views.EXPECTED_SCHEMA_VERSION
    if "canonical_json" in golden.columns:
        drifts = views.drift_type(F.col("schema_version"), key_count(F.col("canonical_json"))).isNotNull()
    return points(golden, {
        "schema_drift": (done, F.when(drifts, 1)),
        "late_arrivals": (done, F.when(views.is_late(), 1)),
        "end_to_end_ms": (done, elapsed_ms(F.col("produced_at"), done)),
        "write_ms": (done, elapsed_ms(F.col("canonicalization_timestamp"), F.col("write_timestamp"))),
    })


def replay_points(golden: DataFrame) -> Points:
    return points(views.replays(golden), {"replays": (F.col("glue_processed_at"), F.lit(1))})


def object_points(object_writes: DataFrame) -> Points:
    at, size = F.col("eventtime"), F.col("size_bytes")
    return points(object_writes, {
        "object_count": (at, F.lit(1)),
        "object_bytes": (at, F.when(size > 0, size)),
        "large_objects": (at, F.when(size > LARGE_OBJECT_BYTES, 1)),
        "zero_byte_objects": (at, F.when(size == 0, 1)),
    })


def request_points(requests: DataFrame) -> Points:
    return points(requests, {"rejected_requests": (F.col("received_at"), F.when(F.col("status") != 202, 1))})


def job_points(log_records: DataFrame) -> Points:
    return points(log_records.filter(is_failed_job()), {"job_failures": (F.col("logged_at"), F.lit(1))})


def invalid_points(quarantine: DataFrame, at: str) -> Points:
    return points(quarantine, {"invalid_records": (F.col(at), F.lit(1))})


def _union(sources: Sequence[Points], metrics: Sequence[str]) -> DataFrame | None:
    """Rows of the sources that can hold one of the metrics."""
    used = [s.rows for s in sources if set(s.metrics) & set(metrics)]
    return reduce(DataFrame.unionByName, used).filter(F.col("metric").isin(*metrics)) if used else None


def alarm_state(sources: Sequence[Points], rules: Sequence[AlarmRule] = ALARM_RULES) -> DataFrame:
    """State of every alarm per period that has data; where too little is the alarm, also per period without any.

    All sums and counts come from one aggregate over the finest period, partially
    aggregated before its shuffle; each of its rows then counts towards one window
    per period length. Percentiles are taken from the points of their own sources.
    """
    periods = sorted({r.period for r in rules})
    base = _union(sources, sorted({r.metric for r in rules if r.statistic in ("sum", "avg")})).groupBy(
        "metric", window_start("at", BASE_PERIOD).alias("_base")).agg(F.sum("value").alias("sum"), F.count("*").alias("n"))
    for metric, period in sorted({(r.metric, r.period) for r in rules if r.comparison == "<"}):
        base = base.unionByName(_empty_periods(base, metric, period))
    for i, period in enumerate(periods):
        base = base.withColumn(f"_w{i}", window_start("_base", period))
    windows = F.array(*[
        F.struct(F.lit(period).alias("period"), F.col(f"_w{i}").alias("window_start")) for i, period in enumerate(periods)])
    totals = base.select("metric", "sum", "n", F.inline(windows)).groupBy("metric", "period", "window_start").agg(
        F.sum("sum").alias("sum"), F.try_divide(F.sum("sum"), F.sum("n")).alias("avg"))
    values = [_tall(totals, ("sum", "avg"))]
    for period in periods:
        ranked = sorted({r.metric for r in rules if r.period == period and r.statistic in PERCENTILES})
        rows = _union(sources, ranked) if ranked else None
        if rows is not None:
            values.append(_tall(exact_percentiles(
                rows.withColumn("window_start", window_start("at", period)), ["metric", "window_start"], "value",
                PERCENTILES, bin_width=100.0).withColumn("period", F.lit(period)), PERCENTILES))
    table = base.sparkSession.createDataFrame([Row(**r.__dict__ | {"threshold": float(r.threshold)}) for r in rules])
    above = F.when(F.col("comparison") == ">", F.col("value") > F.col("threshold")).otherwise(F.col("value") < F.col("threshold"))
    joined = reduce(DataFrame.unionByName, values).join(
        F.broadcast(table), ["metric", "statistic", "period"])  # a dozen fixed rules
    return joined.select("alarm", "window_start", "value", F.when(above, F.lit("ALARM")).otherwise(F.lit("OK")).alias("state"))


def _empty_periods(base: DataFrame, metric: str, period: str) -> DataFrame:
    """A zero for every period between the first and the last one of a metric, which adds nothing where there is data."""
    start = window_start("_base", period)
    span = base.filter(F.col("metric") == metric).agg(F.min(start).alias("a"), F.max(start).alias("b")).filter("a IS NOT NULL")
    return span.select(
        F.lit(metric).alias("metric"), F.explode(F.expr(f"sequence(a, b, interval {period})")).alias("_base"),
        F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("n"))


def _tall(df: DataFrame, statistics) -> DataFrame:
    """One row per statistic."""
    entries = F.array(*[F.struct(F.lit(s).alias("statistic"), F.col(s).alias("value")) for s in statistics])
    return df.select("metric", "window_start", "period", F.inline(entries))
