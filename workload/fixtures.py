"""Event-lake tables derived from the given Parquet tables.

One SQL text serves Spark and the checking engine. ADD_MS(n, t) stands for
"n milliseconds after t".
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.once import spread_scan
from millrace.session import configure

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

FIXTURES = {
    "raw_messages": r"""
SELECT o_orderkey AS msg_id,
 concat('evt-', CAST(o_orderkey AS STRING)) AS event_id,
 concat('src-', CAST(c_nationkey AS STRING)) AS source_system,
 o_orderdate AS produced_at,
 CASE o_orderkey % 6 WHEN 0 THEN
   concat('MSH|^~', chr(92), '&|ADT|HOSP|LAKE|INGEST|202601010000||', CASE WHEN o_orderkey % 4 = 0 THEN 'ADT^A01' ELSE 'ORU^R01' END, '|', CAST(o_orderkey AS STRING), '|P|2.5', chr(13),
     CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE concat('PID|1||', CAST(o_custkey AS STRING), '^^^HOSP^MR||', c_mktsegment, '^', c_name, chr(13)) END,
     'PV1|1|I|WARD', repeat('|', 17), 'ENC', CAST(o_orderkey AS STRING))
  WHEN 1 THEN
   concat('ISA*00*          *00*          *ZZ*S*ZZ*R*260101*1200*^*00501*', CAST(o_orderkey AS STRING), '*0*T*:~', chr(13), 'GS*HC*S*R*20260101*1200*1*X*005010X222A1~ST*837*0001~',
     CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE concat('NM1*IL*1*', c_mktsegment, '*', c_name, '****MI*', CAST(o_custkey AS STRING), '~') END,
     CASE WHEN o_orderkey % 4 = 1 THEN concat('NM1*85*2*CLINIC*****XX*', CASE WHEN o_orderkey % 16 = 1 THEN '12345' ELSE '1234567893' END, '~') ELSE '' END,
     'CLM*ENC', CAST(o_orderkey AS STRING), '*', CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS STRING), '***11:B:1~DTP*472*D8*', replace(CAST(CAST(o_orderdate AS DATE) AS STRING), '-', ''), '~')
  WHEN 2 THEN concat('{"resourceType":"', CASE o_orderkey % 8 WHEN 0 THEN 'Patient' WHEN 2 THEN 'Encounter' WHEN 4 THEN 'Observation' ELSE 'Claim' END, '","id":"', CAST(o_custkey AS STRING), '"', CASE WHEN o_orderkey % 8 = 2 THEN concat(',"subject":{"reference":"', CASE WHEN o_orderkey % 7 = 0 THEN 'Group/' ELSE 'Patient/' END, CAST(o_custkey + CASE WHEN o_orderkey % 5 = 0 THEN 1000000 ELSE 0 END AS STRING), '"},"status":"', CASE WHEN o_orderkey % 3 = 0 THEN 'unheard' ELSE 'finished' END, '"') ELSE '' END, ',"class":{"code":"AMB"},"code":{"coding":[{"code":"', o_orderpriority, '"}]},"valueQuantity":{"value":', CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS STRING), '},"meta":{"profile":["p1"]}}')
  WHEN 3 THEN concat('{"encounter_id":"', CAST(o_orderkey AS STRING), '","member_id":"M', CAST(o_custkey AS STRING), '"}')
  WHEN 4 THEN concat('{"wrap":{"items":[{"resourceType":"Patient","id":"', CAST(o_custkey AS STRING), '"}]}}')
  ELSE concat('{bad json ', CAST(o_orderkey AS STRING)) END AS payload
FROM orders JOIN customer ON o_custkey = c_custkey""",

    "deliveries": r"""
SELECT event_id, concat('trace-', CAST(event_id % 1000 AS STRING)) AS trace_id, delivery_no, event_type,
 concat('src-', CAST(user_id % 5 AS STRING)) AS source_system,
 CASE event_id % 4 WHEN 0 THEN 'hl7' WHEN 1 THEN 'x12' WHEN 2 THEN 'fhir' ELSE 'generic' END AS format,
 ts AS produced_at,
 ADD_MS(event_id % 7 * 100, ts) AS ingest_timestamp,
 CASE WHEN event_id % 13 = 0 THEN NULL ELSE ADD_MS(event_id % 7 * 100 + event_id % 5 * 40, ts) END AS canonicalization_timestamp,
 ADD_MS(event_id % 7 * 100 + event_id % 5 * 40 + 15, ts) AS write_timestamp,
 ADD_MS(event_id % 7 * 100 + event_id % 5 * 40 + 3600000 * delivery_no + 30, ts) AS transmission_timestamp,
 ADD_MS(event_id % 7 * 100 + event_id % 5 * 40 + 3600000 * delivery_no + 30 + event_id * 37 % 900 * 1000, ts) AS s3_last_modified,
 ADD_MS(event_id % 7 * 100 + event_id % 5 * 40 + 3600000 * delivery_no + 60030 + event_id * 37 % 900 * 1000, ts) AS glue_processed_at,
 CASE WHEN event_id % 17 = 0 THEN '2.0' WHEN event_id % 19 = 0 THEN NULL ELSE '1.0' END AS schema_version
FROM (SELECT *, 0 AS delivery_no FROM events
 UNION ALL SELECT *, 1 AS delivery_no FROM events WHERE event_id % 11 = 0
 UNION ALL SELECT *, 2 AS delivery_no FROM events WHERE event_id % 33 = 0) d""",

    "rules": r"""
SELECT concat('r-', CAST(c_custkey AS STRING), '-', CAST(v AS STRING)) AS id, 'patient' AS entity_type, CAST(c_custkey AS STRING) AS entity_id,
 CASE WHEN v = 1 THEN 'hl7_patient_id_valid' ELSE 'fhir_patient_reference_valid' END AS rule_type,
 c_custkey % 3 <> 0 AS compliance_flag, CASE WHEN c_custkey % 3 = 0 THEN 'DOB_INVALID' ELSE NULL END AS reason_code,
 CASE WHEN v = 1 THEN 'hl7' ELSE 'fhir' END AS source_format, 'ADT' AS event_type, v AS version_no
FROM (SELECT *, 1 AS v FROM customer UNION ALL SELECT *, 2 AS v FROM customer) x
WHERE c_custkey % 4 <> 0""",

    "object_access": r"""
SELECT ts AS eventtime, concat('role-', CAST(user_id % 7 AS STRING)) AS principal_id, concat('bucket-', CAST(user_id % 4 AS STRING)) AS bucket_name,
 concat('raw/', CAST(event_id AS STRING), '.json') AS object_key,
 CAST(CASE WHEN event_id % 97 = 0 THEN 0 WHEN event_id % 53 = 0 THEN 6000000 + event_id ELSE event_id * 13 % 100000 + 1 END AS BIGINT) AS size_bytes,
 CASE event_id % 4 WHEN 0 THEN 'PutObject' WHEN 1 THEN 'CompleteMultipartUpload' WHEN 2 THEN 'GetObject' ELSE 'DeleteObject' END AS event_name
FROM events""",

    "request_log": r"""
SELECT event_id AS request_no, ts AS received_at,
 CASE WHEN event_id % 50 = 0 THEN 'GET' ELSE 'POST' END AS method, value AS latency_ms,
 CASE WHEN event_id % 23 = 0 THEN '{broken'
  ELSE concat('{"envelope":{"event_id":"', CASE WHEN event_id % 7 = 0 THEN '' ELSE CAST(event_id AS STRING) END,
   '","event_type":"', CASE WHEN event_id % 11 = 0 THEN '' ELSE event_type END,
   '","source_system":"', CASE WHEN event_id % 13 = 0 THEN '' ELSE 'web' END,
   '","produced_at":"', CASE WHEN event_id % 17 = 0 THEN 'not-a-timestamp' ELSE '2025-01-01T12:00:00Z' END, '"}',
   CASE WHEN event_id % 19 = 0 THEN '' WHEN event_id % 29 = 0 THEN ',"payload":null' ELSE ',"payload":{"a":1}' END, '}') END AS body
FROM events""",

    "envelopes": r"""
SELECT concat(substr(md5(CAST(event_id AS STRING)),1,8), '-', substr(md5(CAST(event_id AS STRING)),9,4), CASE WHEN event_id % 31 = 0 THEN '-1' ELSE '-4' END, substr(md5(CAST(event_id AS STRING)),14,3), '-a', substr(md5(CAST(event_id AS STRING)),18,3), '-', substr(md5(CAST(event_id AS STRING)),21,12)) AS event_uuid,
 event_id AS event_no,
 CASE event_id % 6 WHEN 0 THEN 'claims.adjudication.completed' WHEN 1 THEN 'member.enrollment.updated' WHEN 2 THEN 'provider.directory.failed' WHEN 3 THEN 'pharmacy.order.created' WHEN 4 THEN 'MemberEnrollmentCompleted' ELSE 'enrollment.complete' END AS event_type,
 CASE event_id % 5 WHEN 0 THEN 'phi' WHEN 1 THEN 'pii' WHEN 2 THEN 'internal' WHEN 3 THEN 'public' ELSE 'secret' END AS data_classification,
 CASE event_id % 9 WHEN 0 THEN NULL WHEN 1 THEN '7y' WHEN 2 THEN '3y' WHEN 3 THEN '1y' WHEN 4 THEN '90d' WHEN 5 THEN '6y' ELSE NULL END AS retention_policy,
 concat('tenant-', CAST(user_id % 3 AS STRING)) AS tenant_id, concat('src-', CAST(user_id % 5 AS STRING)) AS source_system,
 concat('corr-', CAST(user_id AS STRING)) AS correlation_id,
 CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 41 = 0 THEN event_id + 100000000 ELSE event_id - 1 END AS causation_no,
 CASE WHEN event_id % 37 = 0 THEN '1.0.0' ELSE '2.1.0' END AS event_version,
 ts AS produced_at, props AS payload
FROM events""",

    "replay_requests": r"""
SELECT concat('rq-', CAST(c_custkey AS STRING)) AS request_id,
 CASE c_custkey % 3 WHEN 0 THEN 'event' WHEN 1 THEN 'correlation' ELSE 'window' END AS replay_kind,
 CASE WHEN c_custkey % 3 = 0 THEN c_custkey * 5 END AS event_no,
 CASE WHEN c_custkey % 3 = 1 THEN concat('corr-', CAST(c_custkey AS STRING)) END AS correlation_id,
 CASE WHEN c_custkey % 10 = 9 THEN NULL ELSE concat('tenant-', CAST(c_custkey % 9 AS STRING)) END AS tenant_id,
 CASE c_custkey % 7 WHEN 0 THEN 'claims.adjudication.completed' WHEN 1 THEN 'member.enrollment.updated' WHEN 2 THEN 'provider.directory.failed' ELSE 'pharmacy.order.created' END AS event_type,
 ADD_MS(c_custkey % 20 * 86400000, from_ts) AS window_from,
 ADD_MS(c_custkey % 20 * 86400000 + c_custkey % 6 * 3600000, from_ts) AS window_to,
 CASE c_custkey % 8 WHEN 0 THEN 'REQUESTED' WHEN 1 THEN 'APPROVED' WHEN 2 THEN 'PREPARED' WHEN 3 THEN 'EXECUTING' WHEN 4 THEN 'COMPLETED' WHEN 5 THEN 'REJECTED' ELSE 'UNKNOWN' END AS state,
 CASE c_custkey % 5 WHEN 0 THEN 'COMPLETED' WHEN 1 THEN 'APPROVED' WHEN 2 THEN 'PREPARED' WHEN 3 THEN 'REJECTED' ELSE 'EXECUTING' END AS next_state,
 CASE WHEN c_custkey % 6 = 0 THEN '' ELSE 'consumer bug fix' END AS justification,
 concat('team-', CAST(c_nationkey AS STRING)) AS requesting_team
FROM (SELECT *, CAST('2024-01-01 00:00:00' AS TIMESTAMP_TYPE) AS from_ts FROM customer) c""",

    "state_log": r"""
SELECT event_id AS event_no, concat('corr-', CAST(user_id AS STRING)) AS correlation_id, ts AS at,
 CASE event_id * 7 % 9 WHEN 0 THEN 'PRODUCED' WHEN 1 THEN 'INGESTED' WHEN 2 THEN 'CANONICALIZED' WHEN 3 THEN 'COMPLIANCE_EVALUATED' WHEN 4 THEN 'ROUTED' WHEN 5 THEN 'CONSUMED' WHEN 6 THEN 'RETAINED' WHEN 7 THEN 'ARCHIVED' ELSE 'REPLAYED' END AS state
FROM events""",
}

# Source table of each derived table with its key.
SOURCES = {
    "raw_messages": ("orders", "o_orderkey"), "deliveries": ("events", "event_id"), "rules": ("customer", "c_custkey"),
    "object_access": ("events", "event_id"), "request_log": ("events", "event_id"), "envelopes": ("events", "event_id"),
    "replay_requests": ("customer", "c_custkey"), "state_log": ("events", "event_id"),
}
PARSED = ("raw_messages", "request_log")  # parsed row by row in every plan

_ADD_MS = re.compile(r"ADD_MS\(([^,]+), (\w+)\)")
_TABLE_REF = re.compile(r"\b(FROM|JOIN) (" + "|".join(BASE_TABLES) + r")\b")


def oracle_text(name: str) -> str:
    text = _ADD_MS.sub(r"(\2 + to_milliseconds(\1))", FIXTURES[name])
    return text.replace("TIMESTAMP_TYPE", "TIMESTAMP").strip()


class Lake:
    """The given tables and the tables derived from them, as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        text = _ADD_MS.sub(r"timestampadd(MILLISECOND, \1, \2)", text).replace("TIMESTAMP_TYPE", "TIMESTAMP_NTZ")
        return self.spark.sql(_TABLE_REF.sub(
            lambda m: f"{m.group(1)} parquet.`{self.sf_dir}/{m.group(2)}.parquet` {m.group(2)}", text))

    def fixture(self, name: str, spread: bool = False) -> DataFrame:
        """The derived table. ``spread`` is for plans that work hard on every row."""
        source, key = SOURCES[name]
        base = self.table(source)
        if spread or name in PARSED:
            base = spread_scan(base, key)
        return self.derive(name, base)

    def derive(self, name: str, base: DataFrame) -> DataFrame:
        """The derived table over any frame shaped like its source, streams included."""
        source, _ = SOURCES[name]
        text = FIXTURES[name]
        if name == "deliveries":  # one scan instead of a union of three
            base = base.withColumn("delivery_no", F.explode(F.array_compact(F.array(
                F.lit(0), F.when(F.col("event_id") % 11 == 0, F.lit(1)), F.when(F.col("event_id") % 33 == 0, F.lit(2))))))
            text = text.split("\nFROM (")[0] + f"\nFROM {source}"
        view = f"derived_{source}"
        base.createOrReplaceTempView(view)
        return self.sql(re.sub(rf"\bFROM {source}\b", f"FROM {view}", text))

    def stream(self, name: str) -> DataFrame:
        """The table as a file stream; the glob accepts a file as well as a folder."""
        return self.spark.readStream.schema(self.table(name).schema).parquet(
            f"{self.sf_dir}/{name[:-1]}[{name[-1]}].parquet")
