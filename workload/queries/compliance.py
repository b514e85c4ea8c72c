"""Rules: sources, upkeep, lookup, counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.operators import compliance
from millrace.operators.detect import DEFAULT_RULES, DetectionRule
from millrace.plans import metrics
from millrace.session import work_dir
from millrace.sources.merge_table import MergeTable
from millrace.sources.readers import flatten_key_value_rules
from workload.fixtures import Lake
from workload.queries.messages import canonical
from workload.registry import oracle_view, query

RULE_COLUMNS = ("id", "entity_type", "entity_id", "rule_type", "compliance_flag", "reason_code", "source_format", "event_type")


def rules(lake: Lake) -> DataFrame:
    """Rules with a modification time: one hour per version."""
    at = F.timestamp_add("HOUR", F.col("version_no"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    return lake.fixture("rules").withColumns({"created_at": at, "updated_at": at}).drop("version_no")


oracle_view("timed_rules", ("rules",), """
SELECT * EXCLUDE (version_no), TIMESTAMP '2024-01-01' + to_hours(version_no) AS created_at,
 TIMESTAMP '2024-01-01' + to_hours(version_no) AS updated_at FROM rules""")
oracle_view("last_rules", ("timed_rules",), """
SELECT * FROM timed_rules QUALIFY row_number() OVER (PARTITION BY entity_type, entity_id ORDER BY updated_at DESC, id) = 1""")
oracle_view("enriched", ("canon", "last_rules"), """
SELECT c.*, true AS compliance_applied, coalesce(r.compliance_flag, false) AS compliance_flag,
 CASE WHEN r.id IS NULL THEN 'FALLBACK_DEFAULT' ELSE coalesce(r.reason_code, '') END AS compliance_reason,
 coalesce(r.rule_type, '') AS compliance_rule_type, coalesce(r.id, '') AS compliance_rule_id
FROM canon c LEFT JOIN last_rules r ON c.entity_type = r.entity_type AND c.entity_id = r.entity_id WHERE c.error_reason IS NULL""")

OUTCOME = ("compliance_applied", "compliance_flag", "compliance_reason", "compliance_rule_type", "compliance_rule_id")


def enriched(lake: Lake) -> DataFrame:
    return compliance.enrich(canonical(lake), rules(lake))


@query("rules_scan", uses="timed_rules", sql=f"SELECT {', '.join(RULE_COLUMNS)}, updated_at FROM timed_rules")
def rules_scan(lake):
    return rules(lake).select(*RULE_COLUMNS, "updated_at")


@query("kv_rules_flatten", uses="rules", sql=f"SELECT {', '.join(RULE_COLUMNS[1:])} FROM rules")
def kv_rules_flatten(lake):
    text = lambda name: F.struct(F.col(name).alias("S")).alias(name)
    items = lake.fixture("rules").select(F.struct(
        *[text(n) for n in RULE_COLUMNS[1:] if n != "compliance_flag"],
        F.struct(F.col("compliance_flag").alias("BOOL")).alias("compliance_flag")).alias("Item"))
    return flatten_key_value_rules(items)


@query("latest_rules", uses="last_rules", sql=f"SELECT {', '.join(RULE_COLUMNS)} FROM last_rules")
def latest_rules(lake):
    return compliance.latest_rules(rules(lake)).select(*RULE_COLUMNS)


@query("compliance_enrich", uses="enriched", sql=f"SELECT msg_id, entity_type, entity_id, {', '.join(OUTCOME)} FROM enriched")
def compliance_enrich(lake):
    return enriched(lake).select("msg_id", "entity_type", "entity_id", *OUTCOME)


@query("compliance_enrich_match_format", uses=("canon", "timed_rules"), sql=f"""
WITH r AS (SELECT * FROM timed_rules QUALIFY row_number() OVER (PARTITION BY entity_type, entity_id, source_format, event_type ORDER BY updated_at DESC, id) = 1)
SELECT c.msg_id, coalesce(r.id, '') AS compliance_rule_id, CASE WHEN r.id IS NULL THEN 'FALLBACK_DEFAULT' ELSE coalesce(r.reason_code, '') END AS compliance_reason
FROM canon c LEFT JOIN r ON c.entity_type = r.entity_type AND c.entity_id = r.entity_id AND c.format = r.source_format AND r.event_type = 'ADT'
WHERE c.error_reason IS NULL""")
def compliance_enrich_match_format(lake):
    rows = canonical(lake).withColumn("event_type", F.lit("ADT"))
    return compliance.enrich(rows, rules(lake), match_format=True).select("msg_id", "compliance_rule_id", "compliance_reason")


@query("compliance_enrich_salted", uses="enriched", sql="SELECT msg_id, compliance_rule_id, compliance_reason FROM enriched")
def compliance_enrich_salted(lake):
    """The same result by the route taken when the rules are too many to broadcast."""
    return compliance.enrich(canonical(lake), rules(lake), max_rows=0).select("msg_id", "compliance_rule_id", "compliance_reason")


@query("compliance_noop", uses="canon", sql="""
SELECT msg_id, true AS compliance_applied, false AS compliance_flag, 'NOOP_GUARD' AS compliance_reason,
 'noop' AS compliance_rule_type, 'noop' AS compliance_rule_id FROM canon WHERE parse_err IS NULL""")
def compliance_noop(lake):
    rows = canonical(lake).filter("error_stage IS NULL OR error_stage = 'compliance'")
    return compliance.enrich_noop(rows).select("msg_id", *OUTCOME)


@query("rule_precedence", uses="timed_rules", sql="""
WITH stores AS (
 SELECT *, 'cache' AS store, 0 AS p FROM timed_rules WHERE source_format = 'hl7' AND CAST(entity_id AS BIGINT) % 5 = 0
 UNION ALL SELECT *, 'primary' AS store, 1 AS p FROM timed_rules WHERE source_format = 'fhir' AND CAST(entity_id AS BIGINT) % 2 = 0
 UNION ALL SELECT *, 'secondary' AS store, 2 AS p FROM timed_rules)
SELECT entity_type, entity_id, id, store FROM stores
QUALIFY row_number() OVER (PARTITION BY entity_type, entity_id ORDER BY p, updated_at DESC, id) = 1""")
def rule_precedence(lake):
    all_rules, number = rules(lake), F.col("entity_id").cast("bigint")
    cache = all_rules.filter((F.col("source_format") == "hl7") & (number % 5 == 0))
    # Blank cache entries count as misses.
    blank = all_rules.filter("source_format = 'fhir'").withColumns(
        {"id": F.lit(""), "rule_type": F.lit(""), "compliance_flag": F.lit(False)})
    primary = all_rules.filter((F.col("source_format") == "fhir") & (number % 2 == 0))
    stores = [("cache", cache.unionByName(blank)), ("primary", primary), ("secondary", all_rules)]
    return compliance.first_store_wins(stores).select("entity_type", "entity_id", "id", "store")


def changes(lake: Lake) -> DataFrame:
    """Changed flags for some rules and rules of a new type for others."""
    number = F.col("entity_id").cast("bigint")
    later = F.timestamp_add("HOUR", F.lit(24), F.col("updated_at"))
    return rules(lake).filter(number % 2 == 0).withColumns({
        "id": F.concat("id", F.lit("-c")), "compliance_flag": ~F.col("compliance_flag"), "reason_code": F.lit("CHANGED"),
        "rule_type": F.when(number % 6 == 2, F.lit("new_rule")).otherwise(F.col("rule_type")),
        "created_at": later, "updated_at": later})


UPSERT_SQL = """
WITH changes AS (SELECT concat(id, '-c') AS id, entity_type, entity_id,
 CASE WHEN CAST(entity_id AS BIGINT) % 6 = 2 THEN 'new_rule' ELSE rule_type END AS rule_type, NOT compliance_flag AS compliance_flag,
 'CHANGED' AS reason_code, source_format, event_type, created_at + INTERVAL 24 HOUR AS created_at, updated_at + INTERVAL 24 HOUR AS updated_at
 FROM timed_rules WHERE CAST(entity_id AS BIGINT) % 2 = 0)
SELECT coalesce(b.id, c.id) AS id, coalesce(c.entity_id, b.entity_id) AS entity_id, coalesce(c.rule_type, b.rule_type) AS rule_type,
 coalesce(c.compliance_flag, b.compliance_flag) AS compliance_flag, CASE WHEN c.id IS NOT NULL THEN c.reason_code ELSE b.reason_code END AS reason_code,
 coalesce(b.created_at, c.created_at) AS created_at, coalesce(c.updated_at, b.updated_at) AS updated_at
FROM timed_rules b FULL JOIN changes c ON b.entity_type = c.entity_type AND b.entity_id = c.entity_id AND b.rule_type = c.rule_type
 AND b.source_format = c.source_format AND b.event_type = c.event_type"""


@query("rules_upsert", uses="timed_rules", sql=UPSERT_SQL)
def rules_upsert(lake):
    return compliance.upsert_rules(rules(lake), changes(lake)).select(
        "id", "entity_id", "rule_type", "compliance_flag", "reason_code", "created_at", "updated_at")


@query("rules_merge_table", uses="timed_rules", sql=UPSERT_SQL)
def rules_merge_table(lake):
    """The rules as a merge table: a base, a change in two commits, and a writer that died before publishing a third."""
    base = rules(lake)
    table = MergeTable(lake.spark, work_dir(lake.spark, "rule-table"), base.schema, compliance.RULE_KEY, compliance.merge_rules)
    table.commit(base)
    table.compact()
    later, half = changes(lake), F.col("entity_id").cast("bigint") % 4 == 0
    table.commit(later.filter(half))
    later.withColumn("reason_code", F.lit("LOST")).write.parquet(f"{table.path}/runs/unpublished")
    table.commit(later.filter(~half))
    return table.read().select("id", "entity_id", "rule_type", "compliance_flag", "reason_code", "created_at", "updated_at")


@query("rules_unique_violations", uses="timed_rules", sql="""
SELECT entity_type, entity_id, rule_type, source_format, event_type, CAST(2 AS BIGINT) AS copies FROM timed_rules
WHERE CAST(entity_id AS BIGINT) % 2 = 0 AND CAST(entity_id AS BIGINT) % 6 <> 2""")
def rules_unique_violations(lake):
    return compliance.unique_violations(rules(lake).unionByName(changes(lake)))


@query("lineage_counts", uses="canon", sql="""
SELECT 'dispatch' AS stage, source_system, format AS event_type, count(*) AS events FROM canon WHERE error_reason IS NULL GROUP BY 2, 3""")
def lineage_counts(lake):
    return metrics.lineage_counts(canonical(lake), F.col("format"))


@query("lineage_failures", uses="canon", sql="""
SELECT stage, CASE WHEN stage = 'normalize' AND msg_id % 6 = 5 THEN 'normalizer_lookup_failed' WHEN stage = 'normalize' THEN 'normalization_failed'
 WHEN stage = 'transform' THEN 'transformation_failed' WHEN stage = 'dispatch' THEN 'dispatch_failed' ELSE 'compliance_stage_failed' END AS reason, count(*) AS failures
FROM (SELECT msg_id, CASE WHEN msg_id % 6 = 5 THEN 'normalize' WHEN error_stage IS NULL AND msg_id % 97 = 0 THEN 'dispatch' ELSE error_stage END AS stage FROM canon)
WHERE stage IS NOT NULL GROUP BY 1, 2""")
def lineage_failures(lake):
    """One detected format has no normalizer, and some accepted events can't be dispatched."""
    odd = DetectionRule("odd", "odd", prefix="{bad")
    return metrics.lineage_failures(canonical(lake, rules=(odd, *DEFAULT_RULES)), F.col("msg_id") % 97 == 0)


@query("compliance_hits", uses="enriched", sql="""
SELECT compliance_rule_id, compliance_rule_type, compliance_flag, count(*) AS hits FROM enriched
WHERE compliance_rule_id <> '' GROUP BY 1, 2, 3""")
def compliance_hits(lake):
    return metrics.compliance_hits(enriched(lake))


@query("compliance_fallbacks", uses="enriched", sql="""
SELECT entity_type, count(*) FILTER (WHERE compliance_rule_id = '') AS rule_misses,
 count(*) FILTER (WHERE compliance_rule_id = '' AND NOT compliance_flag) AS fallbacks,
 count(*) FILTER (WHERE compliance_rule_id <> '') AS rule_hits FROM enriched GROUP BY 1""")
def compliance_fallbacks(lake):
    return metrics.compliance_fallbacks(enriched(lake))


@query("compliance_errors", uses="canon", sql="""
SELECT CASE error_reason WHEN 'missing_identifiers' THEN 'INVALID_EVENT_MISSING_IDENTIFIERS' ELSE 'INVALID_EVENT_DERIVE_FAILED' END AS error_type,
 count(*) AS errors FROM canon WHERE error_stage = 'compliance' GROUP BY 1""")
def compliance_errors(lake):
    return metrics.compliance_errors(canonical(lake))


@query("compliance_success_rate", uses="enriched", sql="""
SELECT date_trunc('hour', produced_at) AS window_start, round(avg(CASE WHEN compliance_rule_id <> '' THEN 1.0 ELSE 0.0 END), 6) AS success_rate,
 count(*) AS n FROM enriched GROUP BY 1""")
def compliance_success_rate(lake):
    rate = metrics.success_rate(enriched(lake), "produced_at", F.col("compliance_rule_id") != "")
    return rate.withColumn("success_rate", F.round("success_rate", 6))
