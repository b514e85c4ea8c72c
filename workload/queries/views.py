"""Analysts' views over deliveries and object-access logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions import lineage as lin
from millrace.operators import dedup
from millrace.plans import views
from millrace.sources import readers
from workload.fixtures import Lake
from workload.registry import oracle_view, query

KEYS_PER_DOCUMENT = 5, 25  # canonical_json gets 5 + event_id % 25 keys


def golden(lake: Lake) -> DataFrame:
    """Deliveries with the remaining golden columns."""
    d = lake.fixture("deliveries", spread=True)
    base, span = KEYS_PER_DOCUMENT
    keys = F.sequence(F.lit(0), (F.lit(base - 1) + F.col("event_id") % span).cast("int"))
    return d.withColumns({
        "span_id": F.lit(None).cast("string"),
        "dispatched_at": F.col("write_timestamp"),
        "lineage": lin.build_lineage(
            ingest=F.col("ingest_timestamp"), canonicalized=F.col("canonicalization_timestamp"),
            written=F.col("write_timestamp")),
        "canonical_json": F.to_json(F.map_from_arrays(
            F.transform(keys, lambda i: F.concat(F.lit("k"), i.cast("string"))), keys)),
    }).withColumn("lineage_json", F.to_json("lineage"))


def access_log(lake: Lake) -> DataFrame:
    """Object accesses in the nested form in which audit logs arrive."""
    o = lake.fixture("object_access")
    return o.select(
        "eventtime", F.struct(F.col("principal_id").alias("principalid")).alias("useridentity"),
        F.struct(F.col("bucket_name").alias("bucketName"), F.col("object_key").alias("key")).alias("requestparameters"),
        F.struct(F.col("size_bytes").alias("bytesTransferredIn")).alias("additionalEventData"),
        F.col("event_name").alias("eventname"), F.lit("10.0.0.1").alias("sourceipaddress"))


oracle_view("golden", ("deliveries",), "SELECT *, 5 + event_id % 25 AS canonical_keys FROM deliveries")
oracle_view("object_writes", ("object_access",), """
SELECT *, '10.0.0.1' AS source_ip FROM object_access WHERE event_name IN ('PutObject', 'CompleteMultipartUpload')""")

TIMES = "transmission_timestamp, s3_last_modified, glue_processed_at"


@query("replay_view", uses="deliveries", sql=f"""
SELECT event_id, trace_id, {TIMES}, count(*) OVER (PARTITION BY event_id) AS replay_count
FROM deliveries QUALIFY count(*) OVER (PARTITION BY event_id) > 1 ORDER BY event_id, transmission_timestamp""")
def replay_view(lake):
    return views.replay_view(lake.fixture("deliveries"))


@query("lineage_view", uses="golden", sql=f"""
SELECT event_id, trace_id, source_system, format, produced_at, ingest_timestamp, canonicalization_timestamp,
 write_timestamp, write_timestamp AS dispatched_at, CAST(NULL AS VARCHAR) AS span_id, {TIMES},
 CASE WHEN canonicalization_timestamp IS NULL THEN 2 ELSE 3 END AS lineage_stages FROM golden""")
def lineage_view(lake):
    # The text form of timestamps differs between engines; the check counts stages instead.
    return views.lineage_view(golden(lake)).withColumn(
        "lineage_stages", F.json_array_length("lineage_json").cast("int")).drop("lineage_json")


@query("latency_view", uses="deliveries", sql=f"""
SELECT event_id, trace_id, produced_at, ingest_timestamp, canonicalization_timestamp, write_timestamp, {TIMES},
 date_sub('millisecond', ingest_timestamp, canonicalization_timestamp) AS ms_ingest_to_canonical,
 date_sub('millisecond', canonicalization_timestamp, write_timestamp) AS ms_canonical_to_write,
 date_sub('millisecond', write_timestamp, transmission_timestamp) AS ms_write_to_transmission,
 date_sub('millisecond', transmission_timestamp, s3_last_modified) AS ms_transmission_to_s3,
 date_sub('millisecond', s3_last_modified, glue_processed_at) AS ms_s3_to_glue,
 date_sub('millisecond', ingest_timestamp, glue_processed_at) AS ms_end_to_end FROM deliveries""")
def latency_view(lake):
    return views.latency_view(lake.fixture("deliveries"))


LATE_SQL = f"""
SELECT event_id, trace_id, {TIMES}, date_sub('second', transmission_timestamp, s3_last_modified) AS delay_seconds
FROM deliveries WHERE date_sub('minute', transmission_timestamp, s3_last_modified) > 5"""


@query("late_arrival_view", uses="deliveries", sql=LATE_SQL + " ORDER BY delay_seconds DESC")
def late_arrival_view(lake):
    return views.late_arrival_view(lake.fixture("deliveries"))


@query("slowest_events", uses="deliveries",
       sql=LATE_SQL + " ORDER BY delay_seconds DESC, event_id, transmission_timestamp LIMIT 100")
def slowest_events(lake):
    return views.slowest_events(lake.fixture("deliveries"))


@query("schema_version_view", uses="deliveries",
       sql="SELECT event_id, trace_id, schema_version FROM deliveries WHERE schema_version IS NOT NULL")
def schema_version_view(lake):
    return views.schema_version_view(golden(lake)).drop("lineage_json")


DRIFT_SQL = """
SELECT event_id, trace_id, schema_version, s3_last_modified, glue_processed_at,
 CASE WHEN schema_version <> '1.0' THEN 'SCHEMA_VERSION_DRIFT' ELSE 'CANONICAL_EVENT_FIELD_DRIFT' END AS drift_type
FROM golden WHERE schema_version <> '1.0' OR canonical_keys > 20"""


@query("schema_drift_view", uses="golden", sql=DRIFT_SQL + " ORDER BY glue_processed_at DESC")
def schema_drift_view(lake):
    return views.schema_drift_view(golden(lake))


@query("drifted_events", uses="golden", sql=f"SELECT drift_type, count(*) AS n FROM ({DRIFT_SQL}) GROUP BY 1")
def drifted_events(lake):
    return views.drifted(golden(lake)).groupBy("drift_type").agg(F.count("*").alias("n"))


@query("s3_ingestion_events", uses="object_writes", sql="""
SELECT eventtime, principal_id, bucket_name, object_key, size_bytes, event_name, source_ip FROM object_writes""")
def s3_ingestion_events(lake):
    return readers.object_writes(access_log(lake))


@query("s3_ingestion_hourly", uses="object_writes", sql="""
SELECT date_trunc('hour', eventtime) AS hour, bucket_name, count(*) AS object_count,
 CAST(sum(size_bytes) AS BIGINT) AS total_bytes FROM object_writes GROUP BY 1, 2 ORDER BY hour DESC""")
def s3_ingestion_hourly(lake):
    out = views.ingestion_hourly(readers.object_writes(access_log(lake)))
    return out.withColumn("hour", F.col("hour").cast("timestamp_ntz"))


@query("dedup_events", uses="deliveries", sql="""
SELECT event_id, trace_id, delivery_no, transmission_timestamp FROM deliveries
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY transmission_timestamp, delivery_no) = 1""")
def dedup_events(lake):
    rows = lake.fixture("deliveries").select("event_id", "trace_id", "delivery_no", "transmission_timestamp")
    return dedup.first_delivery(rows, ["event_id"], ["transmission_timestamp", "delivery_no"])


@query("lineage_stage_times", uses="deliveries", sql="""
SELECT event_id, delivery_no, ingest_timestamp AS ingest_at, CAST(NULL AS TIMESTAMP) AS normalized_at,
 canonicalization_timestamp AS canonicalized_at, write_timestamp AS written_at FROM deliveries""")
def lineage_stage_times(lake):
    at = lambda name: lin.stage_time(F.col("lineage"), name)
    return golden(lake).select(
        "event_id", "delivery_no", at("ingest").alias("ingest_at"), at("normalized").alias("normalized_at"),
        at("canonicalized").alias("canonicalized_at"), at("written").alias("written_at"))


@query("lineage_has_stage", uses="deliveries", sql="""
SELECT event_id, delivery_no, canonicalization_timestamp IS NOT NULL AS has_canonicalized, true AS has_appended,
 CASE WHEN canonicalization_timestamp IS NULL THEN 3 ELSE 4 END AS stages FROM deliveries""")
def lineage_has_stage(lake):
    longer = lin.append_stage(F.col("lineage"), "compliance", F.col("write_timestamp"))
    return golden(lake).withColumn("longer", longer).select(
        "event_id", "delivery_no", lin.has_stage(F.col("lineage"), "canonicalized").alias("has_canonicalized"),
        lin.has_stage(F.col("longer"), "compliance").alias("has_appended"), F.size("longer").alias("stages"))


@query("lineage_gaps", uses="deliveries", sql="""
SELECT CASE WHEN canonicalization_timestamp IS NULL THEN 'normalized,canonicalized,compliance'
 ELSE 'normalized,compliance' END AS missing, count(*) AS n FROM deliveries GROUP BY 1""")
def lineage_gaps(lake):
    missing = F.array_join(lin.missing_stages(F.col("lineage")), ",")
    return golden(lake).groupBy(missing.alias("missing")).agg(F.count("*").alias("n"))
