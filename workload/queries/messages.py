"""Messages: clean-up, detection, parsing, canonical events."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions.jsonx import as_text, json_has_key, json_part
from millrace.functions.text import md5_base64, plain_base64
from millrace.operators import canonical as can
from millrace.operators.detect import DetectionRule, detect_format
from millrace.operators.formats import FORMATS, FORMATS_WITH_GENERIC_IDS, base, hl7
from workload.fixtures import Lake
from workload.registry import oracle_view, query

# --- the same steps in SQL ---------------------------------------------------------

oracle_view("detected", ("raw_messages",), """
SELECT *, CASE WHEN starts_with(payload, 'MSH|') THEN 'hl7' WHEN starts_with(payload, 'ISA*') THEN 'x12'
 WHEN len(json_extract(j, '$..resourceType')) > 0 THEN 'fhir' ELSE 'generic' END AS format
FROM (SELECT *, CASE WHEN json_valid(payload) THEN payload END AS j FROM raw_messages)""")
oracle_view("hl7_lines", ("detected",), """
SELECT *, list_filter(list_transform(string_split(payload, chr(13)), lambda x: trim(x)), lambda x: x <> '') AS lines
FROM detected WHERE format = 'hl7'""")
oracle_view("hl7_parts", ("hl7_lines",), """
SELECT *, string_split(list_filter(lines, lambda x: starts_with(x, 'MSH|'))[-1], '|') AS msh,
 string_split(list_filter(lines, lambda x: starts_with(x, 'PID|'))[-1], '|') AS pid,
 string_split(list_filter(lines, lambda x: starts_with(x, 'PV1|'))[-1], '|') AS pv1 FROM hl7_lines""")
oracle_view("x12_lines", ("detected",), """
SELECT *, list_filter(list_transform(string_split(replace(replace(payload, chr(13), ''), chr(10), ''), '~'), lambda x: trim(x)), lambda x: x <> '') AS lines
FROM detected WHERE format = 'x12'""")
oracle_view("x12_parts", ("x12_lines",), """
SELECT *, string_split(list_filter(lines, lambda x: starts_with(x, 'ISA*'))[-1], '*') AS isa,
 string_split(list_filter(lines, lambda x: starts_with(x, 'GS*'))[-1], '*') AS gs,
 string_split(list_filter(lines, lambda x: starts_with(x, 'ST*'))[-1], '*') AS st,
 string_split(list_filter(lines, lambda x: starts_with(x, 'NM1*IL*'))[-1], '*') AS nm1,
 string_split(list_filter(lines, lambda x: starts_with(x, 'NM1*85*'))[-1], '*') AS provider,
 string_split(list_filter(lines, lambda x: starts_with(x, 'CLM*'))[-1], '*') AS clm,
 string_split(list_filter(lines, lambda x: starts_with(x, 'DTP*472*'))[-1], '*') AS dtp FROM x12_lines""")
oracle_view("hl7_out", ("hl7_parts",), """
SELECT msg_id, CASE WHEN msh IS NULL THEN 'missing MSH segment' WHEN pid IS NULL THEN 'missing PID segment'
 WHEN pv1 IS NULL THEN 'missing PV1 segment' END AS err, coalesce(msh[9], '') AS message_type, coalesce(pid[4], '') AS pid3,
 coalesce(string_split(pid[6], '^')[2], '') AS first_name, coalesce(string_split(pid[6], '^')[1], '') AS last_name,
 coalesce(pv1[21], '') AS encounter_id, coalesce(pv1[3], '') AS encounter_type FROM hl7_parts""")
oracle_view("x12_out", ("x12_parts",), """
SELECT msg_id, CASE WHEN isa IS NULL THEN 'x12: missing ISA segment' WHEN gs IS NULL THEN 'x12: missing GS segment'
 WHEN st IS NULL THEN 'x12: missing ST segment' WHEN nm1 IS NULL THEN 'x12: missing NM1*IL patient segment'
 WHEN clm IS NULL THEN 'x12: missing CLM segment' END AS err, coalesce(st[2], '') AS transaction_set,
 CASE WHEN len(nm1) > 8 THEN coalesce(nm1[10], '') ELSE '' END AS patient_id,
 CASE WHEN len(nm1) > 8 THEN coalesce(nm1[5], '') ELSE '' END AS first_name,
 CASE WHEN len(nm1) > 8 THEN coalesce(nm1[4], '') ELSE '' END AS last_name,
 coalesce(clm[2], '') AS encounter_id, coalesce(dtp[4], '') AS service_date FROM x12_parts""")
oracle_view("fhir_out", ("detected",), """
SELECT msg_id, coalesce(j ->> '$.resourceType', '') AS kind, coalesce(j ->> '$.id', '') AS id,
 coalesce(j ->> '$.code.coding[0].code', '') AS code, CAST(j ->> '$.valueQuantity.value' AS DOUBLE) AS value_num,
 coalesce(j ->> '$.class.code', '') AS class_code, CAST(j -> '$.meta.profile' AS VARCHAR) AS profile,
 j ->> '$.subject.reference' AS subject, j ->> '$.status' AS status,
 CASE WHEN coalesce(j ->> '$.resourceType', '') = '' THEN 'missing resourceType'
  WHEN (j ->> '$.resourceType') NOT IN ('Patient', 'Encounter', 'Observation') THEN concat('unsupported resourceType: ', j ->> '$.resourceType') END AS err
FROM detected WHERE format = 'fhir'""")
oracle_view("shaped", ("detected", "hl7_out", "x12_out", "fhir_out"), """
SELECT d.msg_id, d.event_id, d.source_system, d.produced_at, d.payload, d.format,
 CASE d.format WHEN 'hl7' THEN h.err WHEN 'x12' THEN x.err WHEN 'fhir' THEN f.err END AS parse_err,
 CASE WHEN d.format IN ('hl7', 'x12') THEN 'normalize' ELSE 'transform' END AS parse_stage,
 CASE WHEN d.format = 'hl7' AND h.err IS NULL THEN h.pid3 WHEN d.format = 'x12' AND x.err IS NULL THEN x.patient_id WHEN f.kind = 'Patient' THEN f.id END AS patient_id,
 CASE WHEN d.format = 'hl7' AND h.err IS NULL THEN h.first_name WHEN d.format = 'x12' AND x.err IS NULL THEN x.first_name WHEN f.kind = 'Patient' THEN '' END AS first_name,
 CASE WHEN d.format = 'hl7' AND h.err IS NULL THEN h.last_name WHEN d.format = 'x12' AND x.err IS NULL THEN x.last_name WHEN f.kind = 'Patient' THEN '' END AS last_name,
 CASE WHEN d.format = 'hl7' AND h.err IS NULL THEN h.encounter_id WHEN d.format = 'x12' AND x.err IS NULL THEN x.encounter_id WHEN f.kind = 'Encounter' THEN f.id END AS encounter_id,
 CASE WHEN d.format = 'hl7' AND h.err IS NULL THEN h.encounter_type WHEN d.format = 'x12' AND x.err IS NULL THEN '' WHEN f.kind = 'Encounter' THEN f.class_code END AS encounter_type,
 CASE WHEN d.format = 'hl7' AND h.err IS NULL THEN h.message_type WHEN d.format = 'x12' AND x.err IS NULL THEN x.transaction_set WHEN f.kind = 'Observation' THEN f.code END AS observation_code,
 CASE WHEN f.kind = 'Observation' THEN f.value_num END AS observation_value
FROM detected d LEFT JOIN hl7_out h USING (msg_id) LEFT JOIN x12_out x USING (msg_id) LEFT JOIN fhir_out f USING (msg_id)""")
oracle_view("canon", ("shaped",), """
SELECT *, CASE WHEN parse_err IS NOT NULL THEN parse_stage WHEN entity_id IS NULL THEN 'compliance' END AS error_stage,
 CASE WHEN parse_err IS NOT NULL THEN parse_err WHEN patient_id IS NULL AND encounter_id IS NULL AND observation_code IS NULL THEN 'missing_identifiers'
  WHEN entity_id IS NULL THEN 'derive_failed' END AS error_reason
FROM (SELECT *, CASE WHEN patient_id <> '' THEN 'patient' WHEN encounter_id <> '' THEN 'encounter' WHEN observation_code <> '' THEN 'observation' END AS entity_type,
 coalesce(nullif(CASE WHEN format = 'hl7' THEN string_split(patient_id, '^')[1] ELSE patient_id END, ''), nullif(encounter_id, ''), nullif(observation_code, '')) AS entity_id
 FROM shaped)""")

CANON_COLUMNS = ("msg_id", "event_id", "source_system", "format", "patient_id", "first_name", "last_name",
                 "encounter_id", "encounter_type", "observation_code", "observation_value", "entity_type",
                 "entity_id", "error_stage", "error_reason")


# --- Spark plans -------------------------------------------------------------------


def messages(lake: Lake) -> DataFrame:
    return lake.fixture("raw_messages")


def canonical(lake: Lake, **options) -> DataFrame:
    return can.canonicalize(messages(lake), **options)


def flat(df: DataFrame) -> DataFrame:
    """Canonical rows with flat columns."""
    return df.withColumns({
        "patient_id": F.col("patient.id"), "first_name": F.col("patient.first_name"),
        "last_name": F.col("patient.last_name"), "encounter_id": F.col("encounter.id"),
        "encounter_type": F.col("encounter.type"), "observation_code": F.col("observation.code"),
        "observation_value": F.col("observation.value").try_cast("double"),
    })


def parsed(lake: Lake, format: str) -> DataFrame:
    return can.normalize(detect_format(can.sanitize(messages(lake)))).filter(F.col("format") == format)


@query("presanitize", uses="raw_messages", sql="SELECT msg_id, payload AS clean FROM raw_messages")
def presanitize(lake):
    framed = F.concat(F.lit('"'), F.replace("payload", F.lit("\r"), F.lit("\\r")), F.lit('"'))
    return can.sanitize(messages(lake).withColumn("payload", framed)).select("msg_id", F.col("payload").alias("clean"))


@query("detect_format", uses="detected", sql="SELECT msg_id, format FROM detected")
def detect(lake):
    return detect_format(messages(lake)).select("msg_id", "format")


@query("json_has_key", uses="detected", sql="""
SELECT msg_id, coalesce(len(json_extract(j, '$..resourceType')) > 0, false) AS has_type,
 coalesce(len(json_extract(j, '$..coding')) > 0, false) AS has_coding FROM detected""")
def has_key(lake):
    return messages(lake).select(
        "msg_id", json_has_key(F.col("payload"), "resourceType").alias("has_type"),
        json_has_key(F.col("payload"), "coding").alias("has_coding"))


@query("hl7_segments", uses="hl7_lines", sql="""
SELECT msg_id, CAST(n AS INTEGER) AS position, string_split(lines[n], '|')[1] AS segment,
 CAST(len(string_split(lines[n], '|')) AS INTEGER) AS fields
FROM (SELECT msg_id, lines, unnest(range(1, len(lines) + 1)) AS n FROM hl7_lines)""")
def hl7_segments(lake):
    return _segment_table(lake, "hl7", "\\|")


@query("x12_segments", uses="x12_lines", sql="""
SELECT msg_id, CAST(n AS INTEGER) AS position, string_split(lines[n], '*')[1] AS segment,
 CAST(len(string_split(lines[n], '*')) AS INTEGER) AS fields
FROM (SELECT msg_id, lines, unnest(range(1, len(lines) + 1)) AS n FROM x12_lines)""")
def x12_segments(lake):
    return _segment_table(lake, "x12", "\\*")


def _segment_table(lake: Lake, format: str, separator: str) -> DataFrame:
    spec = next(s for s in FORMATS if s.name == format)
    rows = detect_format(can.sanitize(messages(lake))).filter(F.col("format") == format)
    tall = rows.select("msg_id", F.posexplode(spec.segments(F.col("payload"))).alias("n", "line"))
    fields = F.split("line", separator)
    return tall.select("msg_id", (F.col("n") + 1).alias("position"), F.get(fields, F.lit(0)).alias("segment"),
                       F.size(fields).alias("fields"))


@query("hl7_fields", uses="hl7_out", sql="""
SELECT msg_id, message_type, pid3 AS pid_id, string_split(pid3, '^')[1] AS pid_component, first_name, last_name,
 encounter_id, encounter_type FROM hl7_out WHERE err IS NULL""")
def hl7_fields(lake):
    f = F.col("fields")
    return parsed(lake, "hl7").filter("error_reason IS NULL").select(
        "msg_id", f["msh.message_type"].alias("message_type"), f["pid.id"].alias("pid_id"),
        f["pid.id_component"].alias("pid_component"), f["pid.first_name"].alias("first_name"),
        f["pid.last_name"].alias("last_name"), f["pv1.encounter_id"].alias("encounter_id"),
        f["pv1.encounter_type"].alias("encounter_type"))


@query("x12_fields", uses="x12_out", sql="""
SELECT msg_id, transaction_set, patient_id, first_name, last_name, encounter_id, service_date
FROM x12_out WHERE err IS NULL""")
def x12_fields(lake):
    f = F.col("fields")
    return parsed(lake, "x12").filter("error_reason IS NULL").select(
        "msg_id", f["st.transaction_set"].alias("transaction_set"), f["nm1.patient_id"].alias("patient_id"),
        f["nm1.first_name"].alias("first_name"), f["nm1.last_name"].alias("last_name"),
        f["clm.encounter_id"].alias("encounter_id"), f["dtp.service_date"].alias("service_date"))


@query("fhir_fields", uses="fhir_out", sql="""
SELECT msg_id, kind AS resource_type, id, CASE WHEN kind = 'Observation' THEN code END AS code,
 CASE WHEN kind = 'Observation' THEN value_num END AS value_num, CASE WHEN kind = 'Encounter' THEN class_code END AS class_code,
 profile FROM fhir_out""")
def fhir_fields(lake):
    f = F.col("fields")
    return parsed(lake, "fhir").select(
        "msg_id", f["fhir.resource_type"].alias("resource_type"), f["fhir.id"].alias("id"), f["fhir.code"].alias("code"),
        f["fhir.value"].try_cast("double").alias("value_num"), f["fhir.class.code"].alias("class_code"),
        F.col("metadata")["meta.profile"].alias("profile"))


@query("generic_fields", uses="detected", sql="SELECT msg_id, payload AS raw FROM detected WHERE format = 'generic'")
def generic_fields(lake):
    return parsed(lake, "generic").select("msg_id", F.col("fields")["raw"].alias("raw"))


@query("normalized_fields_tall", uses=("hl7_out", "x12_out"), sql="""
SELECT msg_id, key, value FROM (
 SELECT msg_id, unnest([{'key': 'msh.message_type', 'value': message_type}, {'key': 'pid.id', 'value': pid3},
  {'key': 'pid.id_component', 'value': string_split(pid3, '^')[1]}, {'key': 'pid.first_name', 'value': first_name},
  {'key': 'pid.last_name', 'value': last_name}, {'key': 'pv1.encounter_id', 'value': encounter_id},
  {'key': 'pv1.encounter_type', 'value': encounter_type}], recursive := true) FROM hl7_out WHERE err IS NULL
 UNION ALL
 SELECT msg_id, unnest([{'key': 'st.transaction_set', 'value': transaction_set}, {'key': 'nm1.patient_id', 'value': patient_id},
  {'key': 'nm1.first_name', 'value': first_name}, {'key': 'nm1.last_name', 'value': last_name},
  {'key': 'clm.encounter_id', 'value': encounter_id}, {'key': 'dtp.service_date', 'value': service_date}], recursive := true)
 FROM x12_out WHERE err IS NULL)""")
def normalized_fields_tall(lake):
    rows = can.normalize(detect_format(can.sanitize(messages(lake)))).filter(F.col("format").isin("hl7", "x12"))
    return rows.select("msg_id", F.explode("fields")).filter(~F.col("key").isin("isa.raw", "gs.raw"))


def _canonical_of(lake: Lake, format: str) -> DataFrame:
    return flat(canonical(lake)).filter((F.col("format") == format) & (
        F.col("error_stage").isNull() | (F.col("error_stage") == can.COMPLIANCE)))


PERSON = "patient_id, first_name, last_name, encounter_id, encounter_type, observation_code"


@query("canonical_hl7", uses="canon", sql=f"SELECT msg_id, {PERSON} FROM canon WHERE format = 'hl7' AND parse_err IS NULL")
def canonical_hl7(lake):
    return _canonical_of(lake, "hl7").select("msg_id", *PERSON.split(", "))


@query("canonical_x12", uses="canon", sql=f"SELECT msg_id, {PERSON} FROM canon WHERE format = 'x12' AND parse_err IS NULL")
def canonical_x12(lake):
    return _canonical_of(lake, "x12").select("msg_id", *PERSON.split(", "))


@query("canonical_fhir", uses="canon",
       sql=f"SELECT msg_id, {PERSON}, observation_value FROM canon WHERE format = 'fhir' AND parse_err IS NULL")
def canonical_fhir(lake):
    return _canonical_of(lake, "fhir").select("msg_id", *PERSON.split(", "), "observation_value")


@query("canonical_generic", uses="canon", sql="""
SELECT msg_id, payload AS raw, patient_id IS NULL AND encounter_id IS NULL AND observation_code IS NULL AS bare
FROM canon WHERE format = 'generic'""")
def canonical_generic(lake):
    stored = F.get_json_object(F.col("metadata")["generic_fields"], "$.raw")
    bare = F.col("patient").isNull() & F.col("encounter").isNull() & F.col("observation").isNull()
    return _canonical_of(lake, "generic").select("msg_id", stored.alias("raw"), bare.alias("bare"))


@query("canonicalize", uses="canon", sql=f"SELECT {', '.join(CANON_COLUMNS)} FROM canon")
def canonicalize(lake):
    return flat(canonical(lake)).select(*CANON_COLUMNS)


@query("canonicalize_generic_ids", uses="detected", sql="""
SELECT msg_id, j ->> '$.member_id' AS patient_id, j ->> '$.encounter_id' AS encounter_id,
 CASE WHEN (j ->> '$.member_id') IS NULL THEN 'missing_identifiers' END AS error_reason
FROM (SELECT msg_id, format, j FROM detected) WHERE format = 'generic'""")
def canonicalize_generic_ids(lake):
    rows = flat(canonical(lake, formats=FORMATS_WITH_GENERIC_IDS)).filter("format = 'generic'")
    return rows.select("msg_id", "patient_id", "encounter_id", "error_reason")


@query("as_string", uses="fhir_out", sql="""
SELECT msg_id, kind AS text_value, value_num AS number_value, profile AS array_value, '' AS absent_value FROM fhir_out""")
def as_string(lake):
    rows = detect_format(messages(lake)).filter("format = 'fhir'")
    text = lambda path: as_text(json_part(F.col("document"), path))
    return rows.select(
        "msg_id", text("$.resourceType").alias("text_value"),
        text("$.valueQuantity.value").try_cast("double").alias("number_value"),
        F.nullif(text("$.meta.profile"), F.lit("")).alias("array_value"), text("$.nothing").alias("absent_value"))


@query("doc_digest", uses="raw_messages", sql="""
SELECT msg_id, to_base64(unhex(md5(payload))) AS content_md5, octet_length(encode(payload)) AS content_bytes,
 to_base64(encode(payload)) AS raw_value FROM raw_messages""")
def doc_digest(lake):
    text = F.col("payload")
    return messages(lake).select(
        "msg_id", md5_base64(text).alias("content_md5"), F.octet_length(text).cast("bigint").alias("content_bytes"),
        plain_base64(text.cast("binary")).alias("raw_value"))


@query("hl7_errors", uses="hl7_out", sql="SELECT msg_id, err AS error_reason FROM hl7_out WHERE err IS NOT NULL")
def hl7_errors(lake):
    return parsed(lake, "hl7").filter("error_reason IS NOT NULL").select("msg_id", "error_reason")


@query("x12_errors", uses="x12_out", sql="SELECT msg_id, err AS error_reason FROM x12_out WHERE err IS NOT NULL")
def x12_errors(lake):
    return parsed(lake, "x12").filter("error_reason IS NOT NULL").select("msg_id", "error_reason")


@query("fhir_errors", uses="fhir_out", sql="SELECT msg_id, err AS error_reason FROM fhir_out WHERE err IS NOT NULL")
def fhir_errors(lake):
    return canonical(lake).filter("format = 'fhir' AND error_stage = 'transform'").select("msg_id", "error_reason")


@query("format_mismatch", uses="detected", sql="""
SELECT msg_id, declared, format FROM (
 SELECT msg_id, format, CASE msg_id % 3 WHEN 0 THEN 'hl7' WHEN 1 THEN 'x12' ELSE 'fhir' END AS declared FROM detected)
WHERE declared <> format""")
def format_mismatch(lake):
    declared = F.element_at(F.array(*[F.lit(f) for f in ("hl7", "x12", "fhir")]), (F.col("msg_id") % 3 + 1).cast("int"))
    rows = detect_format(messages(lake)).withColumn("declared", declared)
    return can.format_mismatch(rows, "declared").select("msg_id", "declared", "format")


@query("missing_identifiers", uses="canon",
       sql="SELECT msg_id, error_reason FROM canon WHERE error_stage = 'compliance'")
def missing_identifiers(lake):
    return canonical(lake).filter("error_stage = 'compliance'").select("msg_id", "error_reason")


@query("derive_entity", uses="canon",
       sql="SELECT msg_id, entity_type, entity_id FROM canon WHERE entity_id IS NOT NULL")
def derive_entity(lake):
    return canonical(lake).filter("entity_id IS NOT NULL").select("msg_id", "entity_type", "entity_id")


@query("ingest_ack", uses="canon", sql="SELECT event_id, format FROM canon WHERE error_reason IS NULL")
def ingest_ack(lake):
    return canonical(lake).filter("error_reason IS NULL").select("event_id", "format")


@query("format_outcomes", uses="canon", sql="""
SELECT format, coalesce(error_stage, 'accepted') AS outcome, count(*) AS n, count(DISTINCT source_system) AS sources
FROM canon GROUP BY 1, 2""")
def format_outcomes(lake):
    return canonical(lake).groupBy("format", F.coalesce("error_stage", F.lit("accepted")).alias("outcome")).agg(
        F.count("*").alias("n"), F.countDistinct("source_system").alias("sources"))


# A format of one's own is one more entry in the registry and one more detection rule.
WRAPPED = base.FormatSpec(
    name="wrapped",
    error=lambda m: F.when(m.document.isNull(), F.lit("invalid json")),
    fields=lambda m: base.sparse_map({"wrap.id": json_part(m.document, "$.wrap.items[0].id").cast("string")}),
    canonical=lambda f: {"patient": base.patient(f["wrap.id"])})


@query("custom_format", uses="detected", sql="""
SELECT msg_id, CASE WHEN (j -> '$.wrap') IS NOT NULL THEN 'wrapped' ELSE format END AS format,
 j ->> '$.wrap.items[0].id' AS wrapped_id FROM detected""")
def custom_format(lake):
    rules = (DetectionRule("wrap_key", "wrapped", contains_key="wrap"),
             DetectionRule("hl7_msh_prefix", "hl7", prefix="MSH|"), DetectionRule("x12_isa_prefix", "x12", prefix="ISA*"),
             DetectionRule("fhir_resource_type", "fhir", contains_key="resourceType"))
    rows = canonical(lake, formats=(WRAPPED, *FORMATS), rules=rules)
    return rows.select("msg_id", "format", F.when(F.col("format") == "wrapped", F.col("patient.id")).alias("wrapped_id"))
