"""Ingest requests and the metrics over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.operators import ingest
from millrace.plans import metrics
from millrace.sources.readers import parse_log_lines
from workload.fixtures import Lake
from workload.registry import oracle_view, query

oracle_view("requests", ("request_log",), """
SELECT *, j IS NOT NULL AS valid_json, coalesce(j ->> '$.envelope.event_id', '') AS event_id,
 coalesce(j ->> '$.envelope.event_type', '') AS event_type, coalesce(j ->> '$.envelope.source_system', '') AS source_system,
 CASE WHEN regexp_matches(j ->> '$.envelope.produced_at', '^\\d{4}-\\d\\d-\\d\\dT\\d\\d:\\d\\d:\\d\\d(\\.\\d+)?(Z|[+-]\\d\\d:\\d\\d)$')
  THEN CAST(replace(j ->> '$.envelope.produced_at', 'Z', '') AS TIMESTAMP) END AS produced_at,
 coalesce(list_contains(json_keys(j), 'payload'), false) AS payload_present
FROM (SELECT *, CASE WHEN json_valid(body) THEN body END AS j FROM request_log)""".replace("\\\\", "\\"))
oracle_view("outcomes", ("requests",), """
SELECT *, CASE WHEN method <> 'POST' THEN 405 WHEN NOT valid_json THEN 400 WHEN produced_at IS NULL THEN 422
  WHEN event_id = '' OR event_type = '' OR source_system = '' THEN 422 WHEN NOT payload_present THEN 400 ELSE 202 END AS status,
 CASE WHEN method <> 'POST' THEN 'invalid_method' WHEN NOT valid_json THEN 'json_error' WHEN produced_at IS NULL THEN 'envelope_error'
  WHEN event_id = '' OR event_type = '' OR source_system = '' THEN 'validation_error' WHEN NOT payload_present THEN 'payload_error' ELSE 'accepted' END AS reason
FROM requests""")


def decoded(lake: Lake) -> DataFrame:
    return ingest.decode_requests(lake.fixture("request_log"))


def outcomes(lake: Lake) -> DataFrame:
    return ingest.classify_requests(decoded(lake), method="method")


@query("decode_requests", uses="requests", sql="""
SELECT request_no, valid_json, CAST(j -> '$.envelope' AS VARCHAR) AS envelope, nullif(CAST(j -> '$.payload' AS VARCHAR), 'null') AS payload FROM requests""")
def decode_requests(lake):
    return decoded(lake).select("request_no", F.coalesce("valid_json", F.lit(False)).alias("valid_json"), "envelope", "payload")


@query("envelope_decode", uses="requests", sql="""
SELECT request_no, event_id, event_type, source_system, produced_at FROM requests WHERE valid_json AND produced_at IS NOT NULL""")
def envelope_decode(lake):
    rows = decoded(lake).filter("valid_json AND produced_at IS NOT NULL")
    return rows.select("request_no", "event_id", "event_type", "source_system", F.col("produced_at").cast("timestamp_ntz").alias("produced_at"))


@query("envelope_invalid_fields", uses="requests", sql="""
SELECT request_no, concat_ws(',', CASE WHEN event_id = '' THEN 'envelope.event_id' END,
 CASE WHEN event_type = '' THEN 'envelope.event_type' END, CASE WHEN source_system = '' THEN 'envelope.source_system' END) AS fields
FROM requests WHERE valid_json AND produced_at IS NOT NULL AND (event_id = '' OR event_type = '' OR source_system = '')""")
def envelope_invalid_fields(lake):
    rows = outcomes(lake).filter(F.size("invalid_fields") > 0)
    return rows.select("request_no", F.array_join("invalid_fields", ",").alias("fields"))


@query("payload_missing", uses="requests", sql="SELECT request_no FROM requests WHERE valid_json AND NOT payload_present")
def payload_missing(lake):
    return decoded(lake).filter("valid_json AND NOT payload_present").select("request_no")


@query("ingest_outcomes", uses="outcomes", sql="SELECT status, reason, count(*) AS n FROM outcomes GROUP BY 1, 2")
def ingest_outcomes(lake):
    return outcomes(lake).groupBy("status", "reason").agg(F.count("*").alias("n"))


@query("ingest_error_counts", uses="outcomes", sql="""
SELECT 'ingest' AS route, reason, count(*) AS errors FROM outcomes WHERE reason <> 'accepted' GROUP BY 2""")
def ingest_error_counts(lake):
    return metrics.ingest_errors(outcomes(lake))


@query("request_metrics", uses="outcomes", sql="""
SELECT method, status, count(*) AS requests, round(avg(latency_ms), 6) AS avg_latency_ms,
 count(*) FILTER (WHERE status >= 500) AS errors FROM outcomes GROUP BY 1, 2""")
def request_metrics(lake):
    return metrics.request_metrics(outcomes(lake)).withColumn("avg_latency_ms", F.round("avg_latency_ms", 6))


@query("ingest_summary", uses="outcomes", sql="""
SELECT time_bucket(INTERVAL 5 minutes, received_at) AS window_start, count(*) AS attempts,
 count(*) FILTER (WHERE status = 202) AS accepted, count(*) FILTER (WHERE status <> 202) AS rejected FROM outcomes GROUP BY 1""")
def ingest_summary(lake):
    return metrics.ingest_summary(outcomes(lake))


PERCENTILE_SQL = ", ".join(f"round(quantile_cont({{0}}, {p}), 6) AS {name}" for name, p in metrics.PERCENTILES.items())


@query("error_rates", uses="outcomes", sql=f"""
SELECT date_trunc('hour', received_at) AS window_start, count(*) FILTER (WHERE status BETWEEN 400 AND 499) AS errors_4xx,
 count(*) FILTER (WHERE status >= 500) AS errors_5xx, {PERCENTILE_SQL.format('latency_ms')} FROM outcomes GROUP BY 1""")
def error_rates(lake):
    out = metrics.error_rates(outcomes(lake), size="1 hour")
    return out.withColumns({p: F.round(p, 6) for p in metrics.PERCENTILES})


@query("error_rates_per_minute", uses="outcomes", sql=f"""
SELECT date_trunc('minute', received_at) AS window_start, count(*) FILTER (WHERE status BETWEEN 400 AND 499) AS errors_4xx,
 count(*) FILTER (WHERE status >= 500) AS errors_5xx, {PERCENTILE_SQL.format('latency_ms')} FROM outcomes GROUP BY 1""")
def error_rates_per_minute(lake):
    return metrics.error_rates(outcomes(lake)).withColumns({p: F.round(p, 6) for p in metrics.PERCENTILES})


@query("slo_success_rate", uses="outcomes", sql="""
SELECT date_trunc('hour', received_at) AS window_start, round(avg(CASE WHEN status = 202 THEN 1.0 ELSE 0.0 END), 6) AS success_rate,
 count(*) AS n FROM outcomes GROUP BY 1""")
def slo_success_rate(lake):
    rate = metrics.success_rate(outcomes(lake), "received_at", F.col("status") == 202)
    return rate.withColumn("success_rate", F.round("success_rate", 6))


def log_lines(lake: Lake) -> DataFrame:
    """Requests as log lines: JSON text and epoch milliseconds."""
    kind = (F.when(F.col("request_no") % 31 == 0, "glue_job_failed").when(F.col("request_no") % 37 == 0, "job_failed")
            .otherwise("ingest_request_received"))
    record = F.struct(
        F.when(F.col("request_no") % 37 == 0, "error").otherwise("info").alias("level"), kind.alias("message"),
        F.col("request_no").cast("string").alias("event_id"), F.lit("ingest").alias("service"))
    return lake.fixture("request_log").select(
        F.to_json(record).alias("message"), F.unix_millis(F.col("received_at").cast("timestamp")).alias("timestamp"))


oracle_view("logs", ("request_log",), """
SELECT CAST(request_no AS VARCHAR) AS event_id, date_trunc('millisecond', received_at) AS logged_at,
 CASE WHEN request_no % 31 = 0 THEN 'glue_job_failed' WHEN request_no % 37 = 0 THEN 'job_failed' ELSE 'ingest_request_received' END AS message,
 CASE WHEN request_no % 37 = 0 THEN 'error' ELSE 'info' END AS level, 'ingest' AS service FROM request_log""")


@query("log_lines", uses="logs", sql="SELECT event_id, logged_at, message, level, service FROM logs")
def parsed_log_lines(lake):
    rows = parse_log_lines(log_lines(lake))
    return rows.select("event_id", F.col("logged_at").cast("timestamp_ntz").alias("logged_at"), "message", "level", "service")


@query("job_failures", uses="logs", sql="""
SELECT time_bucket(INTERVAL 5 minutes, logged_at) AS window_start, count(*) AS failures FROM logs
WHERE message IN ('job_failed', 'glue_job_failed') GROUP BY 1""")
def job_failures(lake):
    out = metrics.job_failures(parse_log_lines(log_lines(lake)))
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
