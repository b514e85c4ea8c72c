"""Stored documents, golden rows, sinks and layouts."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.lineage import build_lineage
from millrace.operators import golden as gold
from millrace.operators.detect import detect_format
from millrace.session import work_dir
from millrace.sources import merge_table, observed, readers, writers
from millrace.sources.merge_table import MergeTable
from workload.fixtures import Lake
from workload.queries.messages import messages
from workload.registry import oracle_view, query

RUN_TIME = "2024-03-01 00:00:00"  # the one processing time of a batch run


def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def documents(lake: Lake) -> DataFrame:
    """Deliveries as stored documents; some lack a required field."""
    n, col = F.col("event_id"), F.col
    text = lambda name: F.lit(None).cast("string").alias(name)
    return lake.fixture("deliveries", spread=True).select(
        F.struct(
            n.cast("string").alias("event_id"), "event_type", "source_system",
            F.when(n % 47 != 0, iso(col("produced_at"))).alias("produced_at"),
            col("schema_version").alias("event_version")).alias("envelope"),
        F.struct(
            F.when(n % 41 != 0, n.cast("string")).alias("event_id"), col("source_system"),
            F.when(n % 43 != 0, col("format")).alias("format"),
            F.struct((n % 100).cast("string").alias("id"), text("first_name"), text("last_name")).alias("patient"),
            F.lit(True).alias("compliance_applied"), (n % 2 == 0).alias("compliance_flag")).alias("canonical_event"),
        F.lit("raw text").alias("raw"),
        build_lineage(ingest=iso(col("ingest_timestamp")), canonicalized=iso(col("canonicalization_timestamp")),
                      written=iso(col("write_timestamp"))).alias("lineage"),
        "trace_id", text("span_id"), iso(col("transmission_timestamp")).alias("transmission_timestamp"),
        iso(col("write_timestamp")).alias("dispatched_at"), "delivery_no")


def stored(lake: Lake) -> DataFrame:
    """Documents written as JSON and read back through the document reader."""
    path = work_dir(lake.spark, "documents")
    documents(lake).drop("delivery_no").write.json(path)
    return readers.read_documents(lake.spark, path, multi_line=False)


def golden_rows(lake: Lake) -> DataFrame:
    valid, _ = gold.split_validity(stored(lake))
    return gold.flatten(valid, F.lit(RUN_TIME))


oracle_view("docs", ("deliveries",), """
SELECT *, CAST(event_id AS VARCHAR) AS doc_id, event_id % 41 <> 0 AND event_id % 43 <> 0 AND event_id % 47 <> 0 AS is_valid FROM deliveries""")
NTZ = lambda *names: [F.col(n).cast("timestamp_ntz").alias(n) for n in names]


@query("scan_raw_docs", uses="docs", sql="""
SELECT doc_id AS event_id, CASE WHEN event_id % 43 <> 0 THEN format END AS format, CASE WHEN canonicalization_timestamp IS NULL THEN 2 ELSE 3 END AS stages,
 false AS corrupt FROM docs""")
def scan_raw_docs(lake):
    return stored(lake).select(
        F.col("envelope.event_id").alias("event_id"), F.col("canonical_event.format").alias("format"),
        F.size("lineage").alias("stages"), F.col("_corrupt_record").isNotNull().alias("corrupt"))


@query("golden_valid", uses="docs", sql="SELECT doc_id AS event_id, format, trace_id FROM docs WHERE is_valid")
def golden_valid(lake):
    valid, _ = gold.split_validity(documents(lake))
    return valid.select("canonical_event.event_id", "canonical_event.format", "trace_id")


@query("golden_invalid", uses="docs", sql="""
SELECT doc_id AS event_id, 'Missing required canonical_event or envelope fields' AS error_reason FROM docs WHERE NOT is_valid""")
def golden_invalid(lake):
    _, invalid = gold.split_validity(documents(lake))
    return invalid.select("envelope.event_id", "error_reason")


@query("split_invariant", uses="docs", sql="""
SELECT count(*) AS total, count(*) FILTER (WHERE is_valid) AS valid, count(*) FILTER (WHERE NOT is_valid) AS invalid, CAST(0 AS BIGINT) AS missing FROM docs""")
def split_invariant(lake):
    return gold.split_counts(documents(lake))


@query("record_counters", uses="docs", sql="""
SELECT count(*) AS total_records, count(*) FILTER (WHERE is_valid) AS valid_records, count(*) FILTER (WHERE NOT is_valid) AS invalid_records FROM docs""")
def record_counters(lake):
    return gold.record_counters(documents(lake))


def job_run(lake: Lake) -> tuple[str, dict]:
    """Valid and invalid documents written, each with the report of its write."""
    path = work_dir(lake.spark, "job-run")
    valid, invalid = gold.split_validity(stored(lake))
    rows = gold.flatten(valid, F.lit(RUN_TIME))
    rejected = invalid.select("error_reason", "trace_id", F.to_date(F.lit(RUN_TIME)).alias("error_date"))
    return path, {
        "golden": observed.observed_write(writers.tagged(rows), f"{path}/golden", writers.GOLDEN_PARTITIONS),
        "quarantine": observed.observed_write(rejected, f"{path}/quarantine", ["error_date"], format="json")}


@query("write_counters", uses="docs", sql="""
SELECT CASE WHEN is_valid THEN 'golden' ELSE 'quarantine' END AS target, count(*) AS written_records,
 CASE WHEN is_valid THEN count(DISTINCT (CAST(produced_at AS DATE), format)) ELSE 1 END AS partitions, true AS bytes_agree, true AS timed FROM docs GROUP BY is_valid""")
def write_counters(lake):
    """Records, bytes and time as the writes report them; bytes are compared with the files that a reader finds."""
    path, reports = job_run(lake)
    size = lambda df: df.select("_metadata.file_path", "_metadata.file_size").distinct().agg(F.sum("file_size").alias("found"))
    found = size(lake.spark.read.parquet(f"{path}/golden")).withColumn("target", F.lit("golden")).unionByName(
        size(lake.spark.read.schema("error_reason string").json(f"{path}/quarantine")).withColumn("target", F.lit("quarantine")))
    return observed.counters(lake.spark, reports).join(found, "target").select(
        "target", "written_records", "partitions", (F.col("bytes_written") == F.col("found")).alias("bytes_agree"),
        (F.col("write_seconds") > 0).alias("timed"))


@query("catalogue_refresh", uses="docs", sql="""
SELECT CAST(produced_at AS DATE) AS event_date, format AS format_partition, count(*) AS n, count(*) FILTER (WHERE event_id % 2 = 1) AS later
FROM docs WHERE is_valid GROUP BY 1, 2""")
def catalogue_refresh(lake):
    """A table registered from the reports of two writes, the second with a column more."""
    path, name = work_dir(lake.spark, "catalogue"), f"golden_{uuid.uuid4().hex}"
    rows = golden_rows(lake)
    odd = F.col("event_id").cast("long") % 2 == 1
    for part in (rows.filter(~odd), rows.filter(odd).withColumn("later", F.lit(True))):
        report = observed.observed_write(part, path, writers.GOLDEN_PARTITIONS)
        observed.register_written(lake.spark, name, path, part.schema, writers.GOLDEN_PARTITIONS, report)
    return lake.spark.table(name).groupBy("event_date", "format_partition").agg(
        F.count("*").alias("n"), F.count_if(F.col("later")).alias("later"))


FLAT = ("produced_at", "ingest_timestamp", "canonicalization_timestamp", "write_timestamp", "transmission_timestamp",
        "dispatched_at", "glue_processed_at")
FLAT_SQL = f"""
SELECT doc_id AS event_id, trace_id, source_system, event_type, format, schema_version, produced_at, ingest_timestamp, canonicalization_timestamp,
 write_timestamp, transmission_timestamp, write_timestamp AS dispatched_at, TIMESTAMP '{RUN_TIME}' AS glue_processed_at,
 CAST(event_id % 100 AS VARCHAR) AS patient_id, CAST(produced_at AS DATE) AS event_date, format AS format_partition FROM docs WHERE is_valid"""


def _flat(df: DataFrame) -> DataFrame:
    return df.select("event_id", "trace_id", "source_system", "event_type", "format", "schema_version", *NTZ(*FLAT),
                     F.col("patient.id").alias("patient_id"), "event_date", "format_partition")


@query("golden_flatten", uses="docs", sql=FLAT_SQL)
def golden_flatten(lake):
    return _flat(golden_rows(lake))


@query("golden_roundtrip", uses="docs", sql=FLAT_SQL)
def golden_roundtrip(lake):
    path = work_dir(lake.spark, "golden")
    writers.write_golden(golden_rows(lake), path)
    return _flat(readers.read_golden(lake.spark, path))


@query("compact_golden", uses="docs", sql=FLAT_SQL)
def compact_golden(lake):
    source, target = work_dir(lake.spark, "golden"), work_dir(lake.spark, "compacted")
    writers.write_golden(golden_rows(lake), source)
    writers.compact_golden(lake.spark, source, target)
    return _flat(readers.read_golden(lake.spark, target))


@query("quarantine_roundtrip", uses="docs", sql="""
SELECT doc_id AS event_id, 'Missing required canonical_event or envelope fields' AS error_reason, trace_id FROM docs WHERE NOT is_valid""")
def quarantine_roundtrip(lake):
    path = work_dir(lake.spark, "quarantine")
    _, invalid = gold.split_validity(documents(lake))
    writers.write_quarantine(invalid, path)
    return lake.spark.read.schema("envelope struct<event_id:string>, error_reason string, trace_id string, error_date date").json(
        path).select("envelope.event_id", "error_reason", "trace_id")


RAW_ZONE_SQL = """
SELECT source_system, event_type, doc_id AS event_id, trace_id, CAST(delivery_no AS BIGINT) AS delivery_no FROM docs
QUALIFY row_number() OVER (PARTITION BY source_system, event_type, event_id ORDER BY transmission_timestamp DESC) = 1"""


@query("raw_zone_merge", uses="docs", sql=RAW_ZONE_SQL)
def raw_zone_merge(lake):
    """Documents as a merge table, one commit per delivery; the first is folded into the base before the others come."""
    rows = documents(lake).select(
        "envelope.source_system", "envelope.event_type", "envelope.event_id", "trace_id", F.col("delivery_no").cast("bigint").alias("delivery_no"),
        "transmission_timestamp")
    table = MergeTable(lake.spark, work_dir(lake.spark, "raw-table"), rows.schema, writers.RAW_KEY,
                       merge_table.last_row(writers.RAW_KEY, [F.col("transmission_timestamp")]))
    table.commit(rows.filter("delivery_no = 0"))
    table.compact()
    table.commit(rows.filter("delivery_no = 1"))
    table.commit(rows.filter("delivery_no = 2"))
    return table.read().select("source_system", "event_type", "event_id", "trace_id", "delivery_no")


@query("raw_zone_write", uses="docs", sql=RAW_ZONE_SQL)
def raw_zone_write(lake):
    path = work_dir(lake.spark, "raw")
    rows = documents(lake).select(
        "envelope.source_system", "envelope.event_type", "envelope.event_id", "trace_id", "delivery_no", "transmission_timestamp")
    # Replays arrive as a batch of their own.
    writers.write_raw_zone(rows.filter("delivery_no = 0"), path)
    writers.write_raw_zone(rows.filter("delivery_no > 0"), path)
    return writers.read_raw_zone(
        lake.spark, path,
        "event_id string, trace_id string, delivery_no bigint, transmission_timestamp string, source_system string, event_type string"
    ).select("source_system", "event_type", "event_id", "trace_id", "delivery_no")


@query("raw_zone_by_day", uses="docs", sql="""
SELECT event_id, CAST(delivery_no AS BIGINT) AS delivery_no, CAST(year(produced_at) AS INTEGER) AS yyyy, CAST(month(produced_at) AS INTEGER) AS mm,
 CAST(day(produced_at) AS INTEGER) AS dd FROM docs""")
def raw_zone_by_day(lake):
    path = work_dir(lake.spark, "raw-by-day")
    writers.write_raw_by_day(lake.fixture("deliveries").select("event_id", "delivery_no", "produced_at"), path)
    return lake.spark.read.schema("event_id bigint, delivery_no bigint, yyyy int, mm int, dd int").json(path)


@query("canonical_layout", uses="docs", sql="""
SELECT event_id, delivery_no, event_type, CAST(year(produced_at) AS INTEGER) AS year, CAST(month(produced_at) AS INTEGER) AS month,
 CAST(day(produced_at) AS INTEGER) AS day FROM docs""")
def canonical_layout(lake):
    path = work_dir(lake.spark, "canonical")
    writers.write_canonical_layout(lake.fixture("deliveries").select("event_id", "delivery_no", "event_type", "produced_at"), path)
    return lake.spark.read.parquet(path).select("event_id", "delivery_no", "event_type", "year", "month", "day")


@query("merged_schema_scan", uses="docs", sql="""
SELECT event_id, delivery_no, format, CASE WHEN delivery_no > 0 THEN schema_version END AS schema_version FROM docs""")
def merged_schema_scan(lake):
    """Later batches carry one column more; the scan unites both layouts."""
    path = work_dir(lake.spark, "evolving")
    rows = gold.partition_columns(lake.fixture("deliveries").select("event_id", "delivery_no", "format", "produced_at", "schema_version"))
    writers.write_golden(rows.filter("delivery_no = 0").drop("schema_version"), path)
    writers.write_golden(rows.filter("delivery_no > 0"), path)
    return readers.read_golden(lake.spark, path, merge_schema=True).select("event_id", "delivery_no", "format", "schema_version")


@query("file_lineage", uses="docs", sql="""
SELECT doc_id AS event_id, true AS has_uri, true AS has_modified, CAST(produced_at AS DATE) AS event_date FROM docs WHERE is_valid""")
def file_lineage(lake):
    path = work_dir(lake.spark, "golden")
    writers.write_golden(golden_rows(lake), path)
    rows = readers.with_file_lineage(readers.read_golden(lake.spark, path))
    in_partition = F.contains("s3_uri", F.concat(F.lit("event_date="), F.col("event_date").cast("string")))
    return rows.select("event_id", in_partition.alias("has_uri"), F.col("s3_last_modified").isNotNull().alias("has_modified"), "event_date")


@query("tagged_write", uses="docs", sql="""
SELECT doc_id AS event_id, format, 'millrace' AS pipeline, '1.0' AS pipeline_version FROM docs WHERE is_valid""")
def tagged_write(lake):
    path = work_dir(lake.spark, "tagged")
    writers.write_golden(golden_rows(lake), path)
    back = readers.read_golden(lake.spark, path)
    tags = back.schema["event_id"].metadata
    return back.select("event_id", "format", *[F.lit(tags.get(t)).alias(t) for t in ("pipeline", "pipeline_version")])


@query("partition_columns", uses="deliveries", sql="""
SELECT event_id, delivery_no, CAST(produced_at AS DATE) AS event_date, format AS format_partition FROM deliveries""")
def partition_columns(lake):
    return gold.partition_columns(lake.fixture("deliveries")).select("event_id", "delivery_no", "event_date", "format_partition")


DETECTION_FILE = """{"rules": [
 {"name": "hl7_msh_prefix", "format": "hl7", "prefix": "MSH|"},
 {"name": "x12_isa_prefix", "format": "x12", "prefix": "ISA*"},
 {"name": "fhir_resource_type", "format": "fhir", "contains_key": "resourceType"}]}"""


@query("detection_rules", uses="detected", sql="""
SELECT format, CASE format WHEN 'hl7' THEN 'hl7_msh_prefix' WHEN 'x12' THEN 'x12_isa_prefix' WHEN 'fhir' THEN 'fhir_resource_type' END AS rule, count(*) AS n
FROM detected GROUP BY 1, 2""")
def detection_rules(lake):
    path = work_dir(lake.spark, "detection")
    lake.spark.createDataFrame([(DETECTION_FILE,)], "value string").coalesce(1).write.text(path)
    rules = readers.read_detection_rules(lake.spark, path)
    named = readers.detection_rule_table(lake.spark, path).select("format", F.col("name").alias("rule"))
    counts = detect_format(messages(lake), rules).groupBy("format").agg(F.count("*").alias("n"))
    return counts.join(named, "format", "left").select("format", "rule", "n")
