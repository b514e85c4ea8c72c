"""Contracts, retention, masking, routing, access, sequences and replay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import masking
from millrace.operators import canonical as can, compliance, curated, governance as gov, ordered, replay, schema_registry, structure, vault
from millrace.operators.joins import lookup_join
from millrace.session import work_dir
from workload.fixtures import Lake
from workload.queries.compliance import OUTCOME, rules
from workload.queries.messages import canonical, messages
from workload.registry import oracle_view, query

AS_OF = "2024-02-15 00:00:00"
TIER_DAY = "2024-04-10"
REGISTERED = ("src-0", "src-1", "src-2", "src-3")
AUDIT_TYPES = ("claims.adjudication.completed",)
SENSITIVE_CODES = ("1-URGENT", "2-HIGH")
SALT = "pepper"


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp_ntz")


def stored_canonical(lake: Lake) -> DataFrame:
    """Accepted canonical events as a table, for plans that read them more than once."""
    path = work_dir(lake.spark, "canonical-events")
    canonical(lake).filter("error_reason IS NULL").select(
        "msg_id", "event_id", "format", "entity_type", "entity_id", "patient", "encounter", "observation",
        F.col("metadata")["subject.reference"].alias("subject")).write.parquet(path)
    return lake.spark.read.parquet(path)


def envelopes(lake: Lake) -> DataFrame:
    """Envelopes whose payloads carry the defects and flags the rules look for."""
    n = F.col("event_no")
    payload = (
        F.when(n % 29 == 0, F.lit('{"audit_critical":true,"k":1}')).when(n % 7 == 1, F.lit('{"dob":"1990-01-01","k":1}'))
        .when(n % 43 == 0, F.lit('{"envelope":{},"k":1}')).when(n % 47 == 0, F.lit("[1,2]")).when(n % 53 == 0, F.lit("not json"))
        .otherwise(F.col("payload")))
    return lake.fixture("envelopes").withColumns({"event_id": F.col("event_uuid"), "payload": payload})


oracle_view("env", ("envelopes",), """
SELECT * REPLACE (CASE WHEN event_no % 29 = 0 THEN '{"audit_critical":true,"k":1}' WHEN event_no % 7 = 1 THEN '{"dob":"1990-01-01","k":1}'
 WHEN event_no % 43 = 0 THEN '{"envelope":{},"k":1}' WHEN event_no % 47 = 0 THEN '[1,2]' WHEN event_no % 53 = 0 THEN 'not json' ELSE payload END AS payload)
FROM envelopes""")


def registered(lake: Lake) -> DataFrame:
    return lake.spark.createDataFrame([(s,) for s in REGISTERED], "source_system string")


VIOLATIONS = {
    "invalid_event_id": "NOT regexp_matches(event_uuid, '^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$')",
    "invalid_event_type": "NOT regexp_matches(event_type, '^[a-z][a-z0-9_]*\\.[a-z][a-z0-9_]*\\.[a-z][a-z0-9_]*$')",
    "invalid_data_classification": "data_classification NOT IN ('phi', 'pii', 'internal', 'public')",
    "invalid_retention_policy": "retention_policy NOT IN ('7y', '3y', '1y', '90d')",
    "produced_in_future": "produced_at > TIMESTAMP '2024-01-25' + INTERVAL 5 MINUTE",
    "unregistered_source": "source_system NOT IN ('src-0', 'src-1', 'src-2', 'src-3')",
}


@query("contract_violations", uses="envelopes", sql=" UNION ALL ".join(
    f"SELECT event_no, '{name}' AS violation FROM envelopes WHERE {test}" for name, test in VIOLATIONS.items()))
def contract_violations(lake):
    return gov.contract_violations(
        envelopes(lake), registered(lake), F.lit("2024-01-25").cast("timestamp_ntz")).select("event_no", "violation")


@query("payload_contract", uses="env", sql="""
SELECT event_no, reason FROM (SELECT event_no, CASE WHEN NOT json_valid(payload) OR NOT starts_with(payload, '{') THEN 'payload_not_object'
 WHEN starts_with(payload, '{"envelope"') THEN 'payload_holds_envelope' END AS reason FROM env) WHERE reason IS NOT NULL""")
def payload_contract(lake):
    rows = envelopes(lake).select("event_no", gov.payload_contract(F.col("payload")).alias("reason"))
    return rows.filter(F.col("reason").isNotNull())


@query("unregistered_sources", uses="envelopes", sql="SELECT event_no, source_system FROM envelopes WHERE source_system = 'src-4'")
def unregistered_sources(lake):
    return gov.unregistered_sources(envelopes(lake), registered(lake)).select("event_no", "source_system")


# --- retention and routing ----------------------------------------------------------

oracle_view("kept", ("env",), """
SELECT *, CASE WHEN retention_policy IN ('7y', '3y', '1y', '90d') THEN retention_policy
 ELSE CASE data_classification WHEN 'phi' THEN '7y' WHEN 'pii' THEN '7y' WHEN 'internal' THEN '3y' WHEN 'public' THEN '90d' END END AS retention FROM env""")
oracle_view("mismatch", ("kept",), """
SELECT * REPLACE (CASE WHEN fired THEN '7y' ELSE retention END AS retention) FROM (
 SELECT *, regexp_matches(payload, '"(dob|address|phone|ssn|lab_code)"\\s*:') AND data_classification NOT IN ('phi', 'pii') AS fired FROM kept)""")


def kept(lake: Lake) -> DataFrame:
    return envelopes(lake).withColumn("retention", gov.retention(F.col("data_classification"), F.col("retention_policy")))


@query("retention_assign", uses="kept", sql="SELECT event_no, retention FROM kept")
def retention_assign(lake):
    return kept(lake).select("event_no", "retention")


@query("retention_override", uses="kept", sql="""
SELECT event_no, CASE WHEN hit THEN '7y' ELSE retention END AS retention, CASE WHEN hit THEN 'retention_override: audit_critical' END AS compliance_reason
FROM (SELECT *, event_type = 'claims.adjudication.completed' OR contains(payload, '"audit_critical":true') AS hit FROM kept)""")
def retention_override(lake):
    flag = F.get_json_object("payload", "$.audit_critical") == "true"
    return gov.audit_critical(kept(lake), AUDIT_TYPES, flag).select("event_no", "retention", "compliance_reason")


@query("retention_override_tenants", uses="kept", sql="""
SELECT event_no, CASE WHEN hit THEN '7y' ELSE retention END AS retention, CASE WHEN hit THEN 'retention_override: audit_critical' END AS compliance_reason
FROM (SELECT *, event_type IN ('claims.adjudication.completed', 'pharmacy.order.created') OR contains(payload, '"audit_critical":true') OR tenant_id = 'tenant-2' AS hit FROM kept)""")
def retention_override_tenants(lake):
    """All triggers: several critical types, flagged payloads, and a tenant with extended retention."""
    flag = F.get_json_object("payload", "$.audit_critical") == "true"
    out = gov.audit_critical(kept(lake), (*AUDIT_TYPES, "pharmacy.order.created"), flag, ("tenant-2",))
    return out.select("event_no", "retention", "compliance_reason")


@query("classification_mismatch", uses="mismatch", sql="""
SELECT event_no, fired AS rule_fired, CASE WHEN fired THEN 'classification_mismatch' ELSE '' END AS compliance_reason, retention,
 fired OR data_classification IN ('phi', 'pii') AS restricted FROM mismatch""")
def classification_mismatch(lake):
    return gov.classification_mismatch(kept(lake)).select("event_no", "rule_fired", "compliance_reason", "retention", "restricted")


ROUTE_SQL = """SELECT event_no, concat(tenant_id, '/', CASE WHEN fired OR data_classification = 'phi' THEN 'phi-restricted'
 WHEN data_classification = 'pii' THEN 'pii-restricted' WHEN data_classification = 'internal' THEN 'internal'
 WHEN data_classification = 'public' THEN 'public' ELSE 'quarantine' END) AS route FROM mismatch"""


@query("route_events", uses="mismatch", sql=ROUTE_SQL)
def route_events(lake):
    """Written by route and read back."""
    path = work_dir(lake.spark, "routes")
    rows = gov.classification_mismatch(kept(lake))
    target = gov.route(F.col("data_classification"), F.col("tenant_id"), F.col("rule_fired"))
    rows.select("event_no", target.alias("route")).hint("rebalance", "route").write.partitionBy("route").parquet(path)
    return lake.spark.read.parquet(path).select("event_no", "route")


TIER_SQL = f"""SELECT *, CASE WHEN date_diff('day', CAST(produced_at AS DATE), DATE '{TIER_DAY}') < 90 THEN 'active'
 WHEN DATE '{TIER_DAY}' < CAST(CASE retention WHEN '7y' THEN CAST(produced_at AS DATE) + INTERVAL 84 MONTH WHEN '3y' THEN CAST(produced_at AS DATE) + INTERVAL 36 MONTH
  WHEN '1y' THEN CAST(produced_at AS DATE) + INTERVAL 12 MONTH WHEN '90d' THEN CAST(produced_at AS DATE) + INTERVAL 90 DAY END AS DATE) THEN 'archive' ELSE 'expired' END AS tier FROM kept"""


def tiers(lake: Lake) -> DataFrame:
    return kept(lake).withColumn("tier", gov.archive_tier(F.col("produced_at"), F.col("retention"), F.lit(TIER_DAY).cast("date")))


@query("archive_tiers", uses="kept", sql=f"SELECT event_no, retention, tier FROM ({TIER_SQL})")
def archive_tiers(lake):
    return tiers(lake).select("event_no", "retention", "tier")


@query("expired_events", uses="kept", sql=f"SELECT event_no FROM ({TIER_SQL}) WHERE tier = 'expired'")
def expired_events(lake):
    return tiers(lake).filter("tier = 'expired'").select("event_no")


def routes(lake: Lake) -> DataFrame:
    return lake.spark.createDataFrame(
        [("src-0", "tenant-0"), ("src-1", "tenant-1"), ("src-2", "tenant-2"), ("src-3", "tenant-0"), ("src-4", "tenant-1")],
        "source_system string, target_tenant string")


@query("tenant_violations", uses="envelopes", sql="""
SELECT event_no, tenant_id, target_tenant, true AS rule_fired, 'tenant_restriction' AS compliance_reason FROM envelopes
JOIN (VALUES ('src-0', 'tenant-0'), ('src-1', 'tenant-1'), ('src-2', 'tenant-2'), ('src-3', 'tenant-0'), ('src-4', 'tenant-1')) r(source_system, target_tenant)
 USING (source_system) WHERE tenant_id <> target_tenant""")
def tenant_violations(lake):
    return gov.tenant_violations(envelopes(lake), routes(lake)).select(
        "event_no", "tenant_id", "target_tenant", "rule_fired", "compliance_reason")


ACL = (
    ("billing", "tenant-0", "claims.adjudication.completed", "phi"), ("billing", "tenant-0", "*", "internal"),
    ("billing", "tenant-0", "claims.adjudication.completed", "internal"), ("care", "tenant-1", "*", "phi"),
    ("care", "tenant-1", "member.enrollment.updated", "pii"), ("open-data", "tenant-0", "*", "public"),
    ("open-data", "tenant-1", "*", "public"), ("open-data", "tenant-2", "*", "public"))


@query("consumer_view", uses="envelopes", sql=f"""
SELECT DISTINCT consumer, event_no FROM envelopes e JOIN (VALUES {', '.join(str(a) for a in ACL)}) a(consumer, tenant_id, t, data_classification)
 ON e.tenant_id = a.tenant_id AND e.data_classification = a.data_classification
 AND (a.t = e.event_type OR (a.t = '*' AND e.data_classification NOT IN ('phi', 'pii')))""")
def consumer_view(lake):
    acl = lake.spark.createDataFrame(list(ACL), "consumer string, tenant_id string, event_type string, data_classification string")
    return gov.consumer_view(envelopes(lake), acl).select("consumer", "event_no")


# --- rule catalogue -----------------------------------------------------------------

CATALOGUE = (
    gov.CatalogueRule("PHI-001", "phi_masking", r".*", "data_classification IN ('phi','pii') AND payload LIKE '%lab_code%'", "warning"),
    gov.CatalogueRule("PHI-002", "phi_masking", r".*", "data_classification IN ('phi','pii') AND payload LIKE '%\"dob\"%'", "warning"),
    gov.CatalogueRule("RET-004", "retention_override", r"^claims\..*", "true", "informational"),
    gov.CatalogueRule("TENANT-010", "tenant_restriction", r".*", "source_system = 'src-4'", "blocking", tenant="tenant-2"),
    gov.CatalogueRule("CLASS-020", "classification_enforcement", r".*", "data_classification NOT IN ('phi','pii') AND payload LIKE '%\"dob\"%'", "warning"))


@query("rule_catalogue_match", uses="env", sql="""
SELECT event_no, rule_id FROM env JOIN (VALUES ('PHI-001', '.*', NULL), ('PHI-002', '.*', NULL), ('RET-004', '^claims\\..*', NULL),
 ('TENANT-010', '.*', 'tenant-2'), ('CLASS-020', '.*', NULL)) c(rule_id, pattern, tenant)
 ON regexp_matches(event_type, pattern) AND (tenant IS NULL OR tenant = tenant_id)""")
def rule_catalogue_match(lake):
    table = lake.spark.createDataFrame(
        [(r.rule_id, r.rule_type, r.event_pattern, r.tenant, r.severity) for r in CATALOGUE],
        "rule_id string, rule_type string, event_pattern string, tenant string, severity string")
    return gov.catalogue_match(envelopes(lake).select("event_no", "event_id", "event_type", "tenant_id"), table).select("event_no", "rule_id")


oracle_view("judged", ("env",), """
SELECT *, CASE WHEN r4 THEN 'blocking' WHEN r2 OR r5 THEN 'warning' WHEN r3 THEN 'informational' END AS severity,
 CASE WHEN r4 THEN 'TENANT-010' WHEN r2 THEN 'PHI-002' WHEN r5 THEN 'CLASS-020' WHEN r3 THEN 'RET-004' ELSE '' END AS outcome_rule_id,
 CAST(r2 AS INTEGER) + CAST(r3 AS INTEGER) + CAST(r4 AS INTEGER) + CAST(r5 AS INTEGER) AS rules_fired
FROM (SELECT *, data_classification IN ('phi', 'pii') AND contains(payload, '"dob"') AS r2, starts_with(event_type, 'claims.') AS r3,
 source_system = 'src-4' AND tenant_id = 'tenant-2' AS r4, data_classification NOT IN ('phi', 'pii') AND contains(payload, '"dob"') AS r5 FROM env)""")


def judged(lake: Lake) -> DataFrame:
    return gov.rule_outcomes(envelopes(lake), CATALOGUE)


@query("rule_outcomes", uses="judged", sql="""
SELECT event_no, rules_fired, rules_fired > 0 AS rule_fired, outcome_rule_id, severity, coalesce(severity = 'blocking', false) AS rejected FROM judged""")
def rule_outcomes(lake):
    return judged(lake).select("event_no", "rules_fired", "rule_fired", "outcome_rule_id", "severity", "rejected")


@query("audit_log", uses="judged", sql=f"""
SELECT event_no, 'rule_evaluation' AS action, outcome_rule_id AS rule_id, rules_fired > 0 AS rule_fired, TIMESTAMP '{AS_OF}' AS evaluated_at FROM judged""")
def audit_log(lake):
    """One append-only record per evaluation."""
    path = work_dir(lake.spark, "audit")
    judged(lake).select(
        "event_no", F.lit("rule_evaluation").alias("action"), F.col("outcome_rule_id").alias("rule_id"), "rule_fired",
        as_of().alias("evaluated_at")).write.mode("append").parquet(path)
    return lake.spark.read.parquet(path)


EVALUATED_SQL = {
    "PHI-001": ("true", "data_classification IN ('phi', 'pii') AND contains(payload, 'lab_code')"),
    "PHI-002": ("true", "data_classification IN ('phi', 'pii') AND contains(payload, '\"dob\"')"),
    "RET-004": ("starts_with(event_type, 'claims.')", "true"),
    "TENANT-010": ("tenant_id = 'tenant-2'", "source_system = 'src-4'"),
    "CLASS-020": ("true", "data_classification NOT IN ('phi', 'pii') AND contains(payload, '\"dob\"')"),
}


@query("audit_evaluations", uses="env", sql=" UNION ALL ".join(f"""
SELECT event_no, 'rule_evaluation' AS action, 'rule-engine' AS actor, '{name}' AS rule_id, '1' AS rule_version, {fired} AS fired,
 TIMESTAMP '{AS_OF}' AS evaluated_at, correlation_id, causation_no, source_system, produced_at FROM env WHERE {applies}"""
    for name, (applies, fired) in EVALUATED_SQL.items()))
def audit_evaluations(lake):
    """One append-only record per event and rule that applies, with the rule's version and the event's lineage."""
    path = work_dir(lake.spark, "audit-evaluations")
    gov.audit_records(gov.rule_evaluations(envelopes(lake), CATALOGUE), "rule-engine", as_of()).write.mode("append").parquet(path)
    return lake.spark.read.parquet(path).select("*", "lineage.*").drop("lineage")


# --- masking ------------------------------------------------------------------------


def classified(lake: Lake) -> DataFrame:
    """Canonical events, every second one classified phi."""
    return canonical(lake).filter("error_reason IS NULL").withColumn(
        "data_classification", F.when(F.col("msg_id") % 4 < 2, "phi").otherwise("internal"))


@query("mask_lab_values", uses="canon", sql="""
SELECT msg_id, observation_code, CASE WHEN msg_id % 4 < 2 AND observation_code IN ('1-URGENT', '2-HIGH') THEN '***' ELSE CAST(observation_value AS VARCHAR) END AS value
FROM canon WHERE error_reason IS NULL AND format = 'fhir' AND observation_code IS NOT NULL""")
def mask_lab_values(lake):
    rows = classified(lake).filter("format = 'fhir' AND observation IS NOT NULL")
    secret = F.col("data_classification").isin(*gov.SENSITIVE) & F.col("observation.code").isin(*SENSITIVE_CODES)
    return rows.select("msg_id", F.col("observation.code").alias("observation_code"), masking.redact_when(secret, F.col("observation.value").cast("double").cast("string")).alias("value"))


LAB_OBX = "MSH|^~&|LAB\rPID|1||77\rOBX|1|NM|{code}^Lab^L||{value}|mg\rOBX|2|NM|OTHER^Lab^L||8.25|mg"
LAB_JSON = '{{"results":[{{"lab_code":"{code}","lab_value":{value},"unit":"mg"}},{{"lab_value":2.50,"lab_code":"OTHER"}}]}}'


def _lab_text(template: str, code: str, value: str) -> list:
    """The parts of a template around its code and value."""
    before, _, rest = template.replace("{{", "{").replace("}}", "}").partition("{code}")
    middle, _, after = rest.partition("{value}")
    return [before, code, middle, value, after]


def _duck(parts: list, columns: tuple[str, ...]) -> str:
    quoted = lambda x: " || chr(13) || ".join("'" + p.replace("'", "''") + "'" for p in x.split("\r"))
    return " || ".join(p if p in columns else quoted(p) for p in parts)


_LAB_SQL = {kind: _duck(_lab_text(template, "code", "masked"), ("code", "masked")) for kind, template in (("obx", LAB_OBX), ("json", LAB_JSON))}


@query("mask_lab_messages", uses="envelopes", sql=f"""
SELECT event_no, 'hl7' AS format, {_LAB_SQL['obx']} AS payload FROM (SELECT event_no, CASE event_no % 3 WHEN 0 THEN '1-URGENT' WHEN 1 THEN '2-HIGH' ELSE '5-LOW' END AS code,
 CASE WHEN event_no % 3 < 2 THEN '***' ELSE concat(event_no, '.5') END AS masked FROM envelopes)
UNION ALL SELECT event_no, 'generic', {_LAB_SQL['json']} FROM (SELECT event_no, CASE event_no % 3 WHEN 0 THEN '1-URGENT' WHEN 1 THEN '2-HIGH' ELSE '5-LOW' END AS code,
 CASE WHEN event_no % 3 < 2 THEN '"***"' ELSE concat(event_no, '.50') END AS masked FROM envelopes)""")
def mask_lab_messages(lake):
    """Lab values in HL7 observation segments and in generic JSON, by their code."""
    n = F.col("event_no")
    code = F.when(n % 3 == 0, "1-URGENT").when(n % 3 == 1, "2-HIGH").otherwise("5-LOW")

    def text(template, value):
        parts = dict(zip(("{c}", "{v}"), (code, value)))
        return F.concat(*[parts.get(p, F.lit(p)) for p in _lab_text(template, "{c}", "{v}")])

    rows = lake.fixture("envelopes").select("event_no")
    hl7 = masking.mask_obx(text(LAB_OBX, F.concat(n.cast("string"), F.lit(".5"))), SENSITIVE_CODES)
    generic = masking.mask_json(text(LAB_JSON, F.concat(n.cast("string"), F.lit(".50"))), lab_codes=SENSITIVE_CODES)
    return rows.select("event_no", F.lit("hl7").alias("format"), hl7.alias("payload")).unionByName(
        rows.select("event_no", F.lit("generic").alias("format"), generic.alias("payload")))


@query("mask_demographics", uses="canon", sql="""
SELECT msg_id, CASE WHEN msg_id % 4 < 2 THEN '***' ELSE first_name END AS first_name, CASE WHEN msg_id % 4 < 2 THEN '***' ELSE last_name END AS last_name
FROM canon WHERE error_reason IS NULL AND patient_id IS NOT NULL""")
def mask_demographics(lake):
    rows = classified(lake).filter("patient IS NOT NULL")
    hide = lambda name: masking.redact_when(F.col("data_classification").isin(*gov.SENSITIVE), F.col(f"patient.{name}")).alias(name)
    return rows.select("msg_id", hide("first_name"), hide("last_name"))


# A document with the named keys at several depths and with every kind of value, before and after masking.
NESTED = ('{"k":', ',"patient":{"dob":"1990-01-01","address":{"street":"1 \\"Main\\" St","geo":[1,2.50,{"phone":"x"}]}},"phone":["555",{"a":1}],'
          '"dob":null,"note":"say \\"dob\\":1","items":[{"address":12.50},{"phone":true,"x":1.10}]}')
NESTED_MASKED = ('{"k":', ',"patient":{"dob":"***","address":"***"},"phone":"***","dob":null,"note":"say \\"dob\\":1",'
                 '"items":[{"address":"***"},{"phone":"***","x":1.10}]}')


@query("mask_payload_keys", uses="env", sql=f"""
SELECT event_no, CASE WHEN sensitive AND broken THEN 'quarantine' ELSE 'kept' END AS target,
 CASE WHEN sensitive AND broken THEN NULL WHEN broken THEN '{{broken "dob":"1990"' WHEN sensitive THEN concat('{NESTED_MASKED[0]}', event_no, '{NESTED_MASKED[1]}')
  ELSE concat('{NESTED[0]}', event_no, '{NESTED[1]}') END AS payload
FROM (SELECT event_no, data_classification IN ('phi', 'pii') AS sensitive, event_no % 13 = 0 AS broken FROM env)""")
def mask_payload_keys(lake):
    n = F.col("event_no")
    payload = F.when(n % 13 == 0, F.lit('{broken "dob":"1990"')).otherwise(F.concat(F.lit(NESTED[0]), n.cast("string"), F.lit(NESTED[1])))
    secret = F.col("data_classification").isin(*gov.SENSITIVE)
    rows = envelopes(lake).select("event_no", "data_classification", payload.alias("payload"))
    hidden = masking.mask_json(F.when(secret, F.col("payload")), ("address", "phone", "dob"))
    out = rows.withColumn("hidden", hidden)
    lost = secret & F.col("hidden").isNull()
    return out.select("event_no", F.when(lost, "quarantine").otherwise("kept").alias("target"), F.when(secret, F.col("hidden")).otherwise(F.col("payload")).alias("payload"))


oracle_view("customer_tokens", (), """
SELECT CAST(c_custkey AS VARCHAR) AS entity_id, concat('tok-', CAST(c_custkey * 7 AS VARCHAR)) AS token FROM customer""")


@query("mask_functions", uses=("canon", "customer_tokens"), sql=f"""
SELECT msg_id, sha256(concat('{SALT}', entity_id)) AS hashed_id, token, '***' AS redacted_id
FROM canon LEFT JOIN customer_tokens USING (entity_id) WHERE error_reason IS NULL AND entity_type = 'patient'""")
def mask_functions(lake):
    rows = classified(lake).filter("entity_type = 'patient'")
    tokens = lake.sql("SELECT CAST(c_custkey AS STRING) AS entity_id, concat('tok-', CAST(c_custkey * 7 AS STRING)) AS token FROM customer")
    joined = lookup_join(rows, tokens, ["entity_id"], "left", ["event_id"])
    out = joined.select("msg_id", "entity_id", masking.hash_value(F.col("entity_id"), SALT).alias("hashed_id"), "token",
                        masking.redact(F.col("entity_id")).alias("redacted_id"))
    return masking.remove(out, "entity_id")


@query("tokenise_ids", uses="canon", sql="""
SELECT msg_id, entity_id AS restored, true AS kept FROM canon WHERE error_reason IS NULL AND entity_type = 'patient'""")
def tokenise_ids(lake):
    """Tokens over two runs: given in the first they hold in the second, and lead back to their values."""
    rows = stored_canonical(lake).filter("entity_type = 'patient'").select("msg_id", "entity_id")
    store, path = vault.TokenVault(lake.spark, work_dir(lake.spark, "vault")), work_dir(lake.spark, "first-tokens")
    store.tokenise(rows.filter("msg_id % 4 < 2"), "entity_id", salt=("msg_id",)).select("msg_id", F.col("token").alias("earlier")).write.parquet(path)
    second = store.tokenise(rows, "entity_id", salt=("msg_id",)).join(lake.spark.read.parquet(path), "msg_id", "left")
    return store.restore(second, "token", "restored", ("msg_id",)).select(
        "msg_id", "restored", F.coalesce(F.col("earlier") == F.col("token"), F.lit(True)).alias("kept"))


# --- structure and curated data -----------------------------------------------------

STRUCT_SQL = {
    "x12_837_required_segments_present": "SELECT msg_id, '{}' AS rule, nm1 IS NOT NULL AND clm IS NOT NULL AS passed FROM x12_parts",
    "billing_provider_npi_valid": "SELECT msg_id, '{}' AS rule, coalesce(regexp_matches(provider[10], '^[0-9]{{10}}$'), false) AS passed FROM x12_parts",
    "x12_encounter_requires_clm": "SELECT msg_id, '{}' AS rule, clm IS NOT NULL AND coalesce(clm[2], '') <> '' AS passed FROM x12_parts",
    "hl7_pid_required": "SELECT msg_id, '{}' AS rule, pid IS NOT NULL AS passed FROM hl7_parts",
    "hl7_patient_id_valid": "SELECT msg_id, '{}' AS rule, coalesce(regexp_matches(string_split(pid[4], '^')[1], '^[A-Za-z0-9]+$'), false) AS passed FROM hl7_parts",
    "fhir_encounter_status_required": "SELECT msg_id, '{}' AS rule, coalesce(status = 'finished', false) AS passed FROM fhir_out WHERE kind = 'Encounter'",
    "fhir_patient_reference_valid": "SELECT msg_id, '{}' AS rule, coalesce(starts_with(subject, 'Patient/'), false) AS passed FROM fhir_out WHERE kind = 'Encounter'",
    "generic_encounter_id_required": "SELECT msg_id, '{}' AS rule, coalesce((j ->> '$.encounter_id') <> '', false) AS passed FROM detected WHERE format = 'generic'",
    "generic_member_id_valid": "SELECT msg_id, '{}' AS rule, coalesce(regexp_matches(j ->> '$.member_id', '^[A-Za-z0-9]+$'), false) AS passed FROM detected WHERE format = 'generic'",
}


@query("structural_rules", uses=("x12_parts", "hl7_parts", "fhir_out", "detected"),
       sql=" UNION ALL ".join(text.format(name) for name, text in STRUCT_SQL.items()))
def structural_rules(lake):
    return structure.structural_rules(messages(lake)).select("msg_id", "rule", "passed")


@query("patient_reference_valid", uses="fhir_out", sql="""
SELECT msg_id, subject AS reference, coalesce(subject IN (SELECT concat('Patient/', id) FROM fhir_out WHERE kind = 'Patient'), false) AS resolved FROM fhir_out WHERE kind = 'Encounter'""")
def patient_reference_valid(lake):
    rows = stored_canonical(lake).filter("format = 'fhir'")
    known = rows.filter("patient IS NOT NULL").select(F.col("patient.id").alias("patient_id"))
    visits = rows.filter("encounter IS NOT NULL").select(
        "msg_id", "event_id", F.col("subject").alias("reference"))
    return structure.resolve_patients(visits, known).select("msg_id", "reference", "resolved")


@query("curated_encounters", uses=("canon", "fhir_out"), sql=f"""
WITH p AS (SELECT patient_id AS person, count(*) AS patient_records FROM canon WHERE format = 'fhir' AND error_reason IS NULL AND patient_id IS NOT NULL GROUP BY 1),
 e AS (SELECT substr(f.subject, 9) AS person, count(*) AS ambulatory_visits FROM canon c JOIN fhir_out f USING (msg_id)
  WHERE c.format = 'fhir' AND c.error_reason IS NULL AND c.encounter_id IS NOT NULL AND starts_with(f.subject, 'Patient/') GROUP BY 1)
SELECT msg_id, format, encounter_id, observation_code, sha256(concat('{SALT}', entity_id)) AS patient_key,
 coalesce(patient_records, 0) AS patient_records, coalesce(ambulatory_visits, 0) AS ambulatory_visits
FROM canon LEFT JOIN p ON p.person = entity_id LEFT JOIN e ON e.person = entity_id
WHERE error_reason IS NULL AND format IN ('hl7', 'x12') AND entity_type = 'patient'""")
def curated_encounters(lake):
    return curated.encounters(stored_canonical(lake), SALT)


# --- sequences ----------------------------------------------------------------------


@query("causation_links", uses="envelopes", sql="""
SELECT e.event_no, e.causation_no, CASE WHEN c.event_no % 71 <> 1 THEN c.event_type END AS cause_type, c.event_no IS NULL AS orphan
FROM envelopes e LEFT JOIN envelopes c ON e.causation_no = c.event_no WHERE e.causation_no IS NOT NULL""")
def causation_links(lake):
    """Some causes have no type, which makes no orphan of their effects."""
    return gov.causation_links(envelopes(lake).withColumn("event_type", F.when(F.col("event_no") % 71 != 1, F.col("event_type"))))


@query("correlation_sequence", uses="envelopes", sql="""
SELECT event_no, correlation_id, row_number() OVER w AS sequence_no, lag(event_no) OVER w AS previous_event FROM envelopes
WINDOW w AS (PARTITION BY correlation_id ORDER BY produced_at, event_no)""")
def correlation_sequence(lake):
    rows = envelopes(lake).select("event_no", "correlation_id", "produced_at")
    return ordered.with_neighbours(
        rows, "correlation_id", ["produced_at", "event_no"], previous={"previous_event": "event_no"}, sequence="sequence_no"
    ).drop("produced_at")


oracle_view("timeline", ("state_log",), """
SELECT event_no, correlation_id, at, state, lag(state) OVER w AS previous_state, lead(state) OVER w AS next_state,
 date_sub('millisecond', at, lead(at) OVER w) AS dwell_ms FROM (SELECT * FROM state_log) s
WINDOW w AS (PARTITION BY correlation_id ORDER BY s."at", event_no)""".replace("at,", '"at",').replace("(at)", '("at")'))


def timeline(lake: Lake) -> DataFrame:
    rows = ordered.with_neighbours(
        lake.fixture("state_log"), "correlation_id", ["at", "event_no"], previous={"previous_state": "state"},
        following={"next_state": "state", "_next_at": "at"})
    return rows.withColumn("dwell_ms", F.timestamp_diff("MILLISECOND", F.col("at"), F.col("_next_at"))).drop("_next_at")


@query("lifecycle_timeline", uses="timeline", sql="SELECT event_no, correlation_id, state, previous_state, next_state, dwell_ms FROM timeline")
def lifecycle_timeline(lake):
    return timeline(lake).select("event_no", "correlation_id", "state", "previous_state", "next_state", "dwell_ms")


ALLOWED_SQL = ", ".join(f"'{a}>{b}'" for a, b in replay.LIFECYCLE_TRANSITIONS)


@query("invalid_transitions", uses="timeline", sql=f"""
SELECT event_no, previous_state, state FROM timeline WHERE previous_state IS NOT NULL AND concat(previous_state, '>', state) NOT IN ({ALLOWED_SQL})""")
def invalid_transitions(lake):
    ok = replay.is_transition(F.col("previous_state"), F.col("state"), replay.LIFECYCLE_TRANSITIONS)
    return timeline(lake).filter(F.col("previous_state").isNotNull() & ~ok).select("event_no", "previous_state", "state")


@query("out_of_order", uses="deliveries", sql="""
SELECT event_id, delivery_no, source_system, latest_before FROM (
 SELECT *, max(transmission_timestamp) OVER (PARTITION BY source_system ORDER BY s3_last_modified, event_id, delivery_no
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest_before FROM deliveries) WHERE transmission_timestamp < latest_before""")
def out_of_order(lake):
    rows = lake.fixture("deliveries").select("event_id", "delivery_no", "source_system", "transmission_timestamp", "s3_last_modified")
    seen = ordered.with_running_max(
        rows, "source_system", ["s3_last_modified", "event_id", "delivery_no"], "transmission_timestamp", "latest_before")
    return seen.filter(F.col("transmission_timestamp") < F.col("latest_before")).select(
        "event_id", "delivery_no", "source_system", "latest_before")


@query("arrival_offsets", uses="deliveries", sql="""
SELECT event_id, delivery_no, source_system, row_number() OVER w AS offset_no, lag(event_id) OVER w AS previous_event, lead(event_id) OVER w AS next_event
FROM deliveries WINDOW w AS (PARTITION BY source_system ORDER BY s3_last_modified, event_id, delivery_no)""")
def arrival_offsets(lake):
    """The place of every delivery in its source's order of arrival. Sources are few and large, so ranges are kept short."""
    rows = lake.fixture("deliveries").select("event_id", "delivery_no", "source_system", "s3_last_modified")
    return ordered.with_neighbours(
        rows, "source_system", ["s3_last_modified", "event_id", "delivery_no"], previous={"previous_event": "event_id"},
        following={"next_event": "event_id"}, sequence="offset_no", hot_rows=1_000).drop("s3_last_modified")


# --- replay -------------------------------------------------------------------------

oracle_view("replayed", ("judged", "replay_requests"), """
SELECT r.request_id, e.* FROM judged e JOIN replay_requests r ON r.replay_kind = 'event' AND r.event_no = e.event_no
UNION ALL SELECT r.request_id, e.* FROM judged e JOIN replay_requests r ON r.replay_kind = 'correlation' AND r.correlation_id = e.correlation_id
UNION ALL SELECT r.request_id, e.* FROM judged e JOIN replay_requests r ON r.replay_kind = 'window' AND r.tenant_id = e.tenant_id
 AND r.event_type = e.event_type AND e.produced_at >= r.window_from AND e.produced_at < r.window_to""")


def replayed(lake: Lake) -> DataFrame:
    """Judged once for each event, in the scan that selects; after it an event would be judged for every request that selects it."""
    return replay.select_events(gov.rule_outcomes(envelopes(lake), CATALOGUE), lake.fixture("replay_requests"))


@query("replay_select", uses="replayed", sql="SELECT request_id, event_no FROM replayed")
def replay_select(lake):
    return replay.select_events(envelopes(lake), lake.fixture("replay_requests")).select("request_id", "event_no")


@query("replay_summary", uses=("replayed", "replay_requests"), sql="""
SELECT q.request_id, count(r.event_no) AS events, min(r.produced_at) AS first_at, max(r.produced_at) AS last_at,
 count(*) FILTER (WHERE r.rules_fired > 0) AS rules_fired, count(*) FILTER (WHERE r.severity = 'blocking') AS rejected
FROM replay_requests q LEFT JOIN replayed r USING (request_id) GROUP BY 1""")
def replay_summary(lake):
    return replay.summarise(replayed(lake), lake.fixture("replay_requests"))


REQUEST_SQL = {
    "missing_tenant": "coalesce(tenant_id, '') = ''", "missing_justification": "coalesce(justification, '') = ''",
    "empty_window": "replay_kind = 'window' AND window_to <= window_from",
    "window_exceeds_retention": "replay_kind = 'window' AND date_diff('day', CAST(window_from AS DATE), DATE '2024-02-15') > 40",
    "unknown_state": "state = 'UNKNOWN'",
    "invalid_transition": "concat(state, '>', next_state) NOT IN (" + ", ".join(f"'{a}>{b}'" for a, b in replay.REQUEST_TRANSITIONS) + ")",
}


@query("replay_request_check", uses="replay_requests", sql=" UNION ALL ".join(
    f"SELECT request_id, '{name}' AS violation FROM replay_requests WHERE {test}" for name, test in REQUEST_SQL.items()))
def replay_request_check(lake):
    return replay.request_violations(lake.fixture("replay_requests"), F.lit(AS_OF).cast("timestamp_ntz"), 40)


RETENTION_DAYS = 40
oracle_view("runs", ("replayed", "replay_requests"), f"""
SELECT r.*, q.requesting_team, q.justification, row_number() OVER (PARTITION BY r.request_id ORDER BY r.produced_at, r.event_no) AS replay_no
FROM replayed r JOIN replay_requests q USING (request_id) WHERE q.state = 'APPROVED' AND q.next_state = 'PREPARED'
 AND NOT ({' OR '.join(f"coalesce({test}, false)" for test in REQUEST_SQL.values())})""".replace("coalesce(tenant_id", "coalesce(q.tenant_id"))
oracle_view("replay_results", ("runs", "canon", "enriched"), """
SELECT r.*, CASE WHEN c.msg_id IS NULL THEN 'message_missing' ELSE coalesce(c.error_reason, 'accepted') END AS outcome,
 e.compliance_flag, e.compliance_reason, e.compliance_rule_id
FROM runs r LEFT JOIN canon c ON c.msg_id = r.event_no LEFT JOIN enriched e ON e.msg_id = r.event_no""")


def executed(lake: Lake) -> tuple[DataFrame, DataFrame, str]:
    """(requests run, one row per request and replayed event, the folder of this replay)."""
    requests = replay.runnable(lake.fixture("replay_requests"), as_of(), RETENTION_DAYS)
    path = work_dir(lake.spark, "replay")
    results = replay.reprocess(
        replay.select_events(envelopes(lake), requests), messages(lake), path, can.canonicalize,
        lambda events: compliance.enrich(events, rules(lake)), (*OUTCOME[1:3], OUTCOME[4]))
    return requests, results, path


@query("replay_reprocess", uses="replay_results", sql="""
SELECT request_id, event_no, replay_no, compliance_flag, compliance_reason, compliance_rule_id FROM replay_results WHERE outcome = 'accepted'""")
def replay_reprocess(lake):
    """Approved requests executed; what their own output holds."""
    _, results, path = executed(lake)
    return lake.spark.read.schema(results.schema).parquet(f"{path}/events").select(
        "request_id", "event_no", "replay_no", "compliance_flag", "compliance_reason", "compliance_rule_id")


@query("replay_failures", uses="replay_results", sql="SELECT request_id, event_no, outcome FROM replay_results WHERE outcome <> 'accepted'")
def replay_failures(lake):
    _, results, path = executed(lake)
    return lake.spark.read.schema(results.schema).parquet(f"{path}/failures").select("request_id", "event_no", "outcome")


@query("replay_audit", uses="replay_results", sql=f"""
SELECT request_id, event_no, 'replay' AS action, requesting_team AS actor, justification, replay_no, outcome, compliance_rule_id AS rule_id,
 TIMESTAMP '{AS_OF}' AS evaluated_at, correlation_id, causation_no, source_system, produced_at FROM replay_results""")
def replay_audit(lake):
    requests, results, _ = executed(lake)
    path = work_dir(lake.spark, "replay-audit")
    replay.audit(results, requests, as_of()).write.mode("append").parquet(path)
    return lake.spark.read.parquet(path).select("*", "lineage.*").drop("lineage")


@query("replay_report", uses=("replay_results", "runs", "replay_requests"), sql=f"""
WITH seen AS (SELECT DISTINCT r.request_id, a.consumer FROM replay_results r JOIN (VALUES {', '.join(str(a) for a in ACL)}) a(consumer, tenant_id, t, data_classification)
 ON r.tenant_id = a.tenant_id AND r.data_classification = a.data_classification AND (a.t = r.event_type OR (a.t = '*' AND r.data_classification NOT IN ('phi', 'pii')))),
 c AS (SELECT request_id, count(*) AS consumers FROM seen GROUP BY 1),
 q AS (SELECT request_id FROM replay_requests WHERE state = 'APPROVED' AND next_state = 'PREPARED' AND NOT ({' OR '.join(f"coalesce({test}, false)" for test in REQUEST_SQL.values())}))
SELECT q.request_id, count(r.event_no) AS events, min(r.produced_at) AS first_at, max(r.produced_at) AS last_at,
 count(*) FILTER (WHERE r.rules_fired > 0) AS rules_fired, count(*) FILTER (WHERE r.severity = 'blocking') AS rejected,
 count(*) FILTER (WHERE r.outcome <> 'accepted') AS failures, coalesce(any_value(c.consumers), 0) AS consumers
FROM q LEFT JOIN replay_results r USING (request_id) LEFT JOIN c USING (request_id) GROUP BY 1""")
def replay_report(lake):
    """The summary of executed requests: events, rule outcomes, failures and the consumers affected."""
    requests, results, _ = executed(lake)
    acl = lake.spark.createDataFrame(list(ACL), "consumer string, tenant_id string, event_type string, data_classification string")
    consumers = gov.consumer_view(results.select("event_no", "event_id", "tenant_id", "event_type", "data_classification").distinct(), acl).select("consumer", "event_no")
    return replay.summarise(gov.rule_outcomes(results, CATALOGUE), requests, consumers, "outcome")


# --- schemas ------------------------------------------------------------------------


def versioned(lake: Lake) -> DataFrame:
    """Envelopes whose payload fields and types depend on type and version."""
    n, old = F.col("event_no"), F.col("event_version") == "1.0.0"
    old_text = F.concat(F.lit('{"k":1,"code":"x","legacy_id":"a","gone_'), (n % 3).cast("string"), F.lit('":1,"amount":1}'))
    new_text = F.concat(F.lit('{"k":1,"code":5,"record_id":"a","must":true,"added_'), (n % 4).cast("string"), F.lit('":"x","amount":1.5}'))
    return lake.fixture("envelopes").withColumn("payload", F.when(old, old_text).otherwise(new_text))


oracle_view("payload_fields", ("envelopes",), """
SELECT DISTINCT event_type, event_version, unnest(CASE WHEN event_version = '1.0.0'
 THEN [{'field': 'k', 'type': 'BIGINT'}, {'field': 'code', 'type': 'STRING'}, {'field': 'record_id', 'type': 'STRING'}, {'field': concat('gone_', event_no % 3), 'type': 'BIGINT'}, {'field': 'amount', 'type': 'BIGINT'}]
 ELSE [{'field': 'k', 'type': 'BIGINT'}, {'field': 'code', 'type': 'BIGINT'}, {'field': 'record_id', 'type': 'STRING'}, {'field': 'must', 'type': 'BOOLEAN'}, {'field': concat('added_', event_no % 4), 'type': 'STRING'}, {'field': 'amount', 'type': 'DECIMAL'}] END, recursive := true)
FROM envelopes""")


@query("schema_compat", uses="payload_fields", sql="""
WITH o AS (SELECT * FROM payload_fields WHERE event_version = '1.0.0'), n AS (SELECT * FROM payload_fields WHERE event_version = '2.1.0')
SELECT coalesce(o.event_type, n.event_type) AS event_type, coalesce(o.field, n.field) AS field,
 CASE WHEN o.field IS NULL AND n.field = 'must' THEN 'added_required' WHEN o.field IS NULL THEN 'added' WHEN n.field IS NULL THEN 'removed' WHEN n.field = 'record_id' THEN 'renamed' WHEN o.type = n.type THEN 'same'
  WHEN o.type = 'BIGINT' AND n.type IN ('DECIMAL', 'DOUBLE') THEN 'widened' ELSE 'retyped' END AS change,
 CASE WHEN o.field IS NULL AND n.field <> 'must' THEN 'minor' WHEN o.field IS NULL OR n.field IS NULL OR n.field = 'record_id' THEN 'major' WHEN o.type = n.type THEN 'none'
  WHEN o.type = 'BIGINT' AND n.type IN ('DECIMAL', 'DOUBLE') THEN 'minor' ELSE 'major' END AS level
FROM o FULL JOIN n ON o.event_type = n.event_type AND o.field = n.field""")
def schema_compat(lake):
    fields = schema_registry.observed_fields(versioned(lake))
    return schema_registry.compare_versions(fields, "1.0.0", "2.1.0", {"legacy_id": "record_id"})


@query("payload_schema_violations", uses="envelopes", sql="""
SELECT event_no, '' AS field, 'not_an_object' AS violation FROM envelopes WHERE event_no % 11 = 0
UNION ALL SELECT event_no, 'code', 'missing' FROM envelopes WHERE event_no % 11 <> 0 AND event_no % 7 = 0
UNION ALL SELECT event_no, 'k', 'retyped' FROM envelopes WHERE event_no % 11 <> 0 AND event_no % 5 = 0
UNION ALL SELECT event_no, concat('f_', event_no % 3), 'unlisted' FROM envelopes WHERE event_no % 11 <> 0 AND event_no % 3 <> 0""")
def payload_schema_violations(lake):
    """Payloads that lack a field, hold one of another type or one that is not listed, or are no object."""
    n = F.col("event_no")
    payload = F.when(n % 11 == 0, F.lit("[1]")).otherwise(F.concat(
        F.when(n % 5 == 0, F.lit('{"k":"one"')).otherwise(F.lit('{"k":1')), F.when(n % 7 == 0, F.lit("")).otherwise(F.lit(',"code":"x"')),
        F.lit(',"f_'), (n % 3).cast("string"), F.lit('":1,"amount":3}')))
    events = lake.fixture("envelopes").withColumn("payload", payload)
    schema = (("k", "BIGINT", True), ("code", "STRING", True), ("f_0", "BIGINT", False), ("amount", "DOUBLE", False))
    listed = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.lit(t).alias("type"), F.lit(r).alias("required")) for f, t, r in schema]))
    registry = events.select("event_type", "event_version").distinct().withColumn("s", listed).select("event_type", "event_version", "s.*")
    return schema_registry.payload_violations(events, registry)
