"""Windowed metrics and alarms over deliveries and object accesses."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import golden as gold
from millrace.plans import metrics
from millrace.sources.readers import object_writes, parse_log_lines
from workload.queries.ingest import PERCENTILE_SQL, log_lines, outcomes
from workload.queries.golden import documents
from workload.queries.views import access_log, golden
from workload.registry import oracle_view, query

MS = "(epoch_us({1}) - epoch_us({0})) / 1000.0"
HOP_ROWS = " UNION ALL ".join(
    f"SELECT event_id, event_type, source_system, glue_processed_at, '{name}' AS metric, {MS.format(a, b)} AS ms FROM deliveries"
    for name, (a, b) in gold.HOPS.items())
oracle_view("hops", ("deliveries",), f"SELECT * FROM ({HOP_ROWS}) WHERE ms IS NOT NULL")


@query("latency_totals", uses="hops", sql="""
SELECT metric, round(sum(ms), 3) AS sum_ms, count(*) AS n, round(avg(ms), 6) AS avg_ms FROM hops GROUP BY 1""")
def latency_totals(lake):
    out = gold.latency_totals(lake.fixture("deliveries"))
    return out.withColumns({"sum_ms": F.round("sum_ms", 3), "avg_ms": F.round("avg_ms", 6)})


@query("latency_percentiles", uses="hops", sql=f"""
SELECT date_trunc('minute', glue_processed_at) AS window_start, count(*) AS n, {PERCENTILE_SQL.format('ms')}
FROM hops WHERE metric = 'ms_end_to_end' GROUP BY 1""")
def latency_percentiles(lake):
    out = metrics.latency_percentiles(lake.fixture("deliveries"))
    return out.withColumns({p: F.round(p, 6) for p in metrics.PERCENTILES})


@query("latency_percentiles_daily", uses="hops", sql=f"""
SELECT date_trunc('day', glue_processed_at) AS window_start, count(*) AS n, {PERCENTILE_SQL.format('ms')}
FROM hops WHERE metric = 'ms_end_to_end' GROUP BY 1""")
def latency_percentiles_daily(lake):
    out = metrics.latency_percentiles(lake.fixture("deliveries"), size="1 day")
    return out.withColumns({p: F.round(p, 6) for p in metrics.PERCENTILES})


@query("stage_latency_avg", uses="hops", sql="""
SELECT date_trunc('minute', glue_processed_at) AS window_start, metric, round(avg(ms), 6) AS avg_ms FROM hops GROUP BY 1, 2""")
def stage_latency_avg(lake):
    return metrics.stage_latency_avg(lake.fixture("deliveries")).withColumn("avg_ms", F.round("avg_ms", 6))


EDGES = " + ".join(f"CASE WHEN ms >= {e} THEN 1 ELSE 0 END" for e in metrics.HISTOGRAM_EDGES)


@query("stage_latency_hist", uses="hops", sql=f"""
SELECT metric, event_type, source_system, {EDGES} AS bucket, count(*) AS n FROM hops GROUP BY 1, 2, 3, 4""")
def stage_latency_hist(lake):
    return metrics.stage_latency_histogram(lake.fixture("deliveries"))


oracle_view("object_hours", ("object_writes",), """
SELECT date_trunc('hour', eventtime) AS window_start, count(*) AS object_count,
 CAST(coalesce(sum(size_bytes) FILTER (WHERE size_bytes > 0), 0) AS BIGINT) AS total_bytes,
 count(*) FILTER (WHERE size_bytes > 5242880) AS large_objects, count(*) FILTER (WHERE size_bytes = 0) AS zero_byte_objects
FROM object_writes GROUP BY 1""")


@query("s3_object_metrics", uses="object_hours", sql="SELECT * FROM object_hours")
def s3_object_metrics(lake):
    return metrics.object_metrics(object_writes(access_log(lake)))


@query("ingestion_gaps", uses="object_hours", sql="""
WITH hours AS (SELECT unnest(generate_series(min(window_start), max(window_start), INTERVAL 1 HOUR)) AS window_start FROM object_hours)
SELECT window_start, coalesce(object_count, 0) AS object_count, CASE WHEN coalesce(object_count, 0) < 10 THEN 'ALARM' ELSE 'OK' END AS state
FROM hours LEFT JOIN object_hours USING (window_start)""")
def ingestion_gaps(lake):
    hourly = metrics.object_metrics(object_writes(access_log(lake)))
    low = next(r for r in metrics.ALARM_RULES if r.alarm == "volume_low").threshold
    state = F.when(F.col("object_count") < low, F.lit("ALARM")).otherwise(F.lit("OK"))
    return metrics.hours_without_gaps(hourly).withColumn("state", state)


def _alarm_sql() -> str:
    bucket = lambda at, period: f"time_bucket(INTERVAL {period}, {at})"
    parts = []
    source = {
        "job_failures": "SELECT 'job_failures' AS metric, logged_at AS at_ts, 1.0 AS value FROM logs WHERE message IN ('job_failed', 'glue_job_failed')",
        "invalid_records": "SELECT 'invalid_records', received_at, 1.0 FROM outcomes WHERE reason = 'json_error'",
        "schema_drift": "SELECT 'schema_drift', glue_processed_at, 1.0 FROM deliveries WHERE schema_version <> '1.0'",
        "late_arrivals": "SELECT 'late_arrivals', glue_processed_at, 1.0 FROM deliveries WHERE date_sub('minute', transmission_timestamp, s3_last_modified) > 5",
        "end_to_end_ms": f"SELECT 'end_to_end_ms', glue_processed_at, {MS.format('produced_at', 'glue_processed_at')} FROM deliveries",
        "write_ms": f"SELECT 'write_ms', glue_processed_at, {MS.format('canonicalization_timestamp', 'write_timestamp')} FROM deliveries WHERE canonicalization_timestamp IS NOT NULL",
        "replays": "SELECT 'replays', glue_processed_at, 1.0 FROM deliveries QUALIFY count(*) OVER (PARTITION BY event_id) > 1",
        "object_count": "SELECT 'object_count', eventtime, 1.0 FROM object_writes",
        "object_bytes": "SELECT 'object_bytes', eventtime, size_bytes FROM object_writes WHERE size_bytes > 0",
        "large_objects": "SELECT 'large_objects', eventtime, 1.0 FROM object_writes WHERE size_bytes > 5242880",
        "zero_byte_objects": "SELECT 'zero_byte_objects', eventtime, 1.0 FROM object_writes WHERE size_bytes = 0",
        "rejected_requests": "SELECT 'rejected_requests', received_at, 1.0 FROM outcomes WHERE status <> 202",
    }
    points = " UNION ALL ".join(source.values())
    statistic = {"sum": "sum(value)", "avg": "avg(value)", "p99": "quantile_cont(value, 0.99)"}
    for r in metrics.ALARM_RULES:
        if r.metric in source:
            value = f"CAST({statistic[r.statistic]} AS DOUBLE)"
            parts.append(
                f"SELECT '{r.alarm}' AS alarm, {bucket('at_ts', r.period)} AS window_start, round({value}, 4) AS value, "
                f"CASE WHEN {value} {r.comparison} {r.threshold} THEN 'ALARM' ELSE 'OK' END AS state "
                f"FROM points WHERE metric = '{r.metric}' GROUP BY 2")
    hour = "time_bucket(INTERVAL 1 hour, eventtime)"
    parts.append(
        f"SELECT 'volume_low', h, 0.0, 'ALARM' FROM (SELECT unnest(generate_series(min({hour}), max({hour}), INTERVAL 1 HOUR)) AS h FROM object_writes) "
        f"WHERE h NOT IN (SELECT {hour} FROM object_writes)")
    parts.append(
        f"SELECT 'volume_high', h, 0.0, 'OK' FROM (SELECT unnest(generate_series(min({hour}), max({hour}), INTERVAL 1 HOUR)) AS h FROM object_writes) "
        f"WHERE h NOT IN (SELECT {hour} FROM object_writes)")
    return f"WITH points AS ({points}) " + " UNION ALL ".join(parts)


@query("alarm_state", uses=("deliveries", "object_writes", "outcomes", "logs"), sql=_alarm_sql())
def alarm_state(lake):
    golden, requests = lake.fixture("deliveries"), outcomes(lake)
    invalid = requests.filter("reason = 'json_error'")
    sources = [
        metrics.golden_points(golden), metrics.replay_points(golden), metrics.object_points(object_writes(access_log(lake))),
        metrics.request_points(requests), metrics.invalid_points(invalid, "received_at"),
        metrics.job_points(parse_log_lines(log_lines(lake)))]
    return metrics.alarm_state(sources).withColumn("value", F.round("value", 4))


JOB_RULES = tuple(r for r in metrics.ALARM_RULES if r.metric in ("schema_drift", "invalid_records"))


@query("job_alarms", uses=("golden", "docs"), sql="""
SELECT 'schema_drift' AS alarm, time_bucket(INTERVAL 5 minutes, glue_processed_at) AS window_start, CAST(count(*) AS DOUBLE) AS value, 'ALARM' AS state
FROM golden WHERE schema_version <> '1.0' OR canonical_keys > 20 GROUP BY 2
UNION ALL SELECT 'invalid_records', time_bucket(INTERVAL 5 minutes, transmission_timestamp), CAST(count(*) AS DOUBLE), CASE WHEN count(*) > 100 THEN 'ALARM' ELSE 'OK' END
FROM docs WHERE NOT is_valid GROUP BY 2""")
def job_alarms(lake):
    """Alarms of the golden job on what it wrote itself: both kinds of drift, and its rejected documents."""
    _, rejected = gold.split_validity(documents(lake))
    rejected = rejected.withColumn("at", F.to_timestamp_ntz(F.col("transmission_timestamp"), F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")))
    return metrics.alarm_state([metrics.golden_points(golden(lake)), metrics.invalid_points(rejected, "at")], JOB_RULES)
