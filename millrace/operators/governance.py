"""Envelope contracts, retention, classification, routing and access."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.jsonx import is_object, may_hold_keys, strict_document
from millrace.operators import patterns
from millrace.operators.joins import lookup_join

# Patterns, enumerations, defaults and periods of the event contract.
UUID_V4 = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
EVENT_TYPE = r"^[a-z][a-z0-9_]*\.[a-z][a-z0-9_]*\.[a-z][a-z0-9_]*$"
SEMVER = r"^\d+\.\d+\.\d+$"
CLASSIFICATIONS = ("phi", "pii", "internal", "public")
RETENTION_POLICIES = ("7y", "3y", "1y", "90d")
DEFAULT_RETENTION = {"phi": "7y", "pii": "7y", "internal": "3y", "public": "90d"}
RETENTION_MONTHS = {"7y": 84, "3y": 36, "1y": 12}
RETENTION_DAYS = {"90d": 90}
ACTIVE_DAYS = 90
MAX_CLOCK_SKEW_MINUTES = 5
REQUIRED_FIELDS = ("event_id", "event_type", "event_version", "produced_at", "source_system",
                   "correlation_id", "tenant_id", "data_classification")
SENSITIVE = ("phi", "pii")
PHI_KEYS = ("dob", "address", "phone", "ssn", "lab_code")
AUDIT_CRITICAL_REASON = "retention_override: audit_critical"
MISMATCH_REASON = "classification_mismatch"
TENANT_REASON = "tenant_restriction"


def _case(column: Column, values: dict[str, str]) -> Column:
    return F.coalesce(*[F.when(column == k, F.lit(v)) for k, v in values.items()])


# --- contracts ----------------------------------------------------------------------

def contract_violations(envelopes: DataFrame, registered: DataFrame, as_of: Column) -> DataFrame:
    """One row per event and broken rule. ``registered`` lists the allowed source systems."""
    known = registered.select("source_system").distinct().withColumn("_known", F.lit(True))
    rows = lookup_join(envelopes, known, ["source_system"], "left", salt=["event_id"])
    absent = {f"missing_{name}": F.col(name).isNull() for name in REQUIRED_FIELDS}
    latest = F.timestamp_add("MINUTE", F.lit(MAX_CLOCK_SKEW_MINUTES), as_of)
    broken = absent | {
        "invalid_event_id": ~F.col("event_id").rlike(UUID_V4),
        "invalid_event_type": ~F.col("event_type").rlike(EVENT_TYPE),
        "invalid_event_version": ~F.col("event_version").rlike(SEMVER),
        "invalid_data_classification": ~F.col("data_classification").isin(*CLASSIFICATIONS),
        "invalid_retention_policy": ~F.col("retention_policy").isin(*RETENTION_POLICIES),
        "produced_in_future": F.col("produced_at") > latest,
        "unregistered_source": F.col("_known").isNull(),
    }
    if "ingested_at" in envelopes.columns:
        broken["ingested_at_present"] = F.col("ingested_at").isNotNull()
    found = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in broken.items()]))
    return rows.select(*[c for c in envelopes.columns if c in ("event_no", "event_id")], F.explode(found).alias("violation"))


def payload_contract(payload: Column) -> Column:
    """Reason a payload breaks the contract, or NULL."""
    valid = F.when(may_hold_keys(payload), strict_document(payload)).isNotNull()
    return (
        F.when(~valid | ~is_object(payload), F.lit("payload_not_object"))
        .when(F.array_contains(F.json_object_keys(payload), "envelope"), F.lit("payload_holds_envelope")))


def unregistered_sources(events: DataFrame, registered: DataFrame) -> DataFrame:
    """Events of sources that are not registered."""
    return lookup_join(events, registered.select("source_system").distinct(), ["source_system"], "left_anti", ["event_id"])


# --- retention ----------------------------------------------------------------------

def retention(classification: Column, declared: Column) -> Column:
    """The declared policy if it is valid, else the default of the classification."""
    return F.when(declared.isin(*RETENTION_POLICIES), declared).otherwise(_case(classification, DEFAULT_RETENTION))


def audit_critical(df: DataFrame, critical_types: Sequence[str], flag: Column, tenants: Sequence[str] = ()) -> DataFrame:
    """Raise retention to 7y for audit-critical types, flagged payloads and tenants that require it."""
    hit = F.coalesce(F.col("event_type").isin(*critical_types), F.lit(False)) | F.coalesce(flag, F.lit(False))
    hit = hit | F.coalesce(F.col("tenant_id").isin(*tenants), F.lit(False)) if tenants else hit
    return df.withColumns({
        "retention": F.when(hit, F.lit("7y")).otherwise(F.col("retention")),
        "compliance_reason": F.when(hit, F.lit(AUDIT_CRITICAL_REASON)),
    })


def holds_phi(payload: Column, keys: Sequence[str] = PHI_KEYS) -> Column:
    return payload.rlike('"(' + "|".join(keys) + r')"\s*:')


def classification_mismatch(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Flag events that hold PHI under another classification, keep them 7y, restrict them."""
    hit = holds_phi(F.col(payload)) & ~F.col("data_classification").isin(*SENSITIVE)
    return df.withColumns({
        "rule_fired": hit,
        "compliance_reason": F.when(hit, F.lit(MISMATCH_REASON)).otherwise(F.lit("")),
        "retention": F.when(hit, F.lit("7y")).otherwise(F.col("retention")),
        "restricted": hit | F.col("data_classification").isin(*SENSITIVE),
    })


def expires_on(produced_at: Column, policy: Column) -> Column:
    day = F.to_date(produced_at)
    by_month = [F.when(policy == p, F.add_months(day, m)) for p, m in RETENTION_MONTHS.items()]
    by_day = [F.when(policy == p, F.date_add(day, d)) for p, d in RETENTION_DAYS.items()]
    return F.coalesce(*by_month, *by_day)


def archive_tier(produced_at: Column, policy: Column, as_of: Column) -> Column:
    """active, archive or expired."""
    return (
        F.when(F.datediff(as_of, F.to_date(produced_at)) < ACTIVE_DAYS, F.lit("active"))
        .when(as_of < expires_on(produced_at, policy), F.lit("archive"))
        .otherwise(F.lit("expired")))


# --- routing and access -------------------------------------------------------------

def route(classification: Column, tenant: Column, fired: Column) -> Column:
    """Target stream from tenant, classification and rule outcome."""
    stream = (
        F.when(fired | (classification == "phi"), F.lit("phi-restricted"))
        .when(classification == "pii", F.lit("pii-restricted"))
        .when(classification == "internal", F.lit("internal"))
        .when(classification == "public", F.lit("public"))
        .otherwise(F.lit("quarantine")))
    return F.concat_ws("/", tenant, stream)


def tenant_violations(events: DataFrame, routes: DataFrame) -> DataFrame:
    """Events whose route leads to another tenant. ``routes``: source_system, target_tenant."""
    joined = lookup_join(events, routes, ["source_system"], "inner", ["event_id"])
    return joined.filter(F.col("target_tenant") != F.col("tenant_id")).withColumns({
        "rule_fired": F.lit(True), "compliance_reason": F.lit(TENANT_REASON)})


def consumer_view(events: DataFrame, acl: DataFrame) -> DataFrame:
    """Events each consumer may see. ``acl``: consumer, tenant_id, event_type, data_classification.

    Event type '*' is honoured only outside phi and pii. A grant for one type is left out where its consumer holds '*'
    as well, so an event matches each consumer at most once; events offer both keys and are scanned once.
    """
    scope = ["tenant_id", "data_classification"]
    grants = acl.select("consumer", *scope, F.col("event_type").alias("_type")).distinct()
    wide = grants.filter((F.col("_type") == "*") & ~F.col("data_classification").isin(*SENSITIVE))
    narrow = grants.filter(F.col("_type") != "*").join(wide.drop("_type"), ["consumer", *scope], "left_anti").select(*grants.columns)
    offered = events.select("*", F.explode(F.array_distinct(F.array(F.col("event_type"), F.lit("*")))).alias("_type"))
    return lookup_join(offered, narrow.unionByName(wide), [*scope, "_type"], "inner", ["event_id"]).drop("_type")


# --- rule catalogue -----------------------------------------------------------------


@dataclass(frozen=True)
class CatalogueRule:
    rule_id: str
    rule_type: str
    event_pattern: str
    condition: str
    severity: str
    tenant: str | None = None
    version: str = "1"


SEVERITIES = ("informational", "warning", "blocking")  # fixed values, rising


def catalogue_match(events: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Pairs of event and applicable rule, by the keys of the rules' patterns."""
    rules = catalogue.select("rule_id", "rule_type", "severity", "event_pattern", F.col("tenant").alias("_tenant"))
    own = F.col("_tenant").isNull() | (F.col("_tenant") == F.col("tenant_id"))
    return patterns.match(events, rules, ["event_id"]).filter(own).drop("_tenant", "event_pattern")


def rule_outcomes(events: DataFrame, rules: Sequence[CatalogueRule]) -> DataFrame:
    """Evaluate rules per event and keep the most severe one that fired.

    All rules of an event are columns of its own row, so nothing is shuffled.
    """
    def fired(r: CatalogueRule) -> Column:
        applies = F.col("event_type").rlike(r.event_pattern) & F.coalesce(F.expr(r.condition), F.lit(False))
        if r.tenant is not None:
            applies = applies & (F.col("tenant_id") == r.tenant)
        rank = SEVERITIES.index(r.severity)
        return F.when(applies, F.struct(
            F.lit(rank).alias("rank"), F.lit(r.rule_id).alias("rule_id"), F.lit(r.rule_type).alias("rule_type")))

    hits = F.array_compact(F.array(*[fired(r) for r in rules]))
    out = events.withColumn("_hits", hits).withColumn("_top", F.array_max("_hits"))
    return out.withColumns({
        "rules_fired": F.size("_hits"),
        "rule_fired": F.size("_hits") > 0,
        "outcome_rule_id": F.coalesce("_top.rule_id", F.lit("")),
        "outcome_rule_type": F.coalesce("_top.rule_type", F.lit("")),
        "severity": F.get(F.array(*[F.lit(s) for s in SEVERITIES]), F.col("_top.rank")),
        "rejected": F.coalesce(F.col("_top.rank") == len(SEVERITIES) - 1, F.lit(False)),
    }).drop("_hits", "_top")


def rule_evaluations(events: DataFrame, rules: Sequence[CatalogueRule]) -> DataFrame:
    """One row per event and rule that applies to it, whether it fired or not: rule_id, rule_version, rule_type, severity, fired."""
    def evaluated(r: CatalogueRule) -> Column:
        applies = F.col("event_type").rlike(r.event_pattern)
        if r.tenant is not None:
            applies = applies & (F.col("tenant_id") == r.tenant)
        return F.when(applies, F.struct(
            F.lit(r.rule_id).alias("rule_id"), F.lit(r.version).alias("rule_version"), F.lit(r.rule_type).alias("rule_type"),
            F.lit(r.severity).alias("severity"), F.coalesce(F.expr(r.condition), F.lit(False)).alias("fired")))

    return events.select(*events.columns, F.inline(F.array_compact(F.array(*[evaluated(r) for r in rules]))))


def audit_records(evaluations: DataFrame, actor: str, at: Column) -> DataFrame:
    """One record per evaluation: who judged, by which version of which rule, what came of it, when, and the event's lineage."""
    lineage = F.struct("correlation_id", "causation_no", "source_system", "produced_at")
    return evaluations.select(
        "event_no", F.lit("rule_evaluation").alias("action"), F.lit(actor).alias("actor"), "rule_id", "rule_version",
        "fired", at.alias("evaluated_at"), lineage.alias("lineage"))


def causation_links(events: DataFrame) -> DataFrame:
    """Each event with a cause, the type of that cause, and whether the cause is unknown (an orphan)."""
    effects = events.filter("causation_no IS NOT NULL").select("event_no", "causation_no")
    causes = events.select(F.col("event_no").alias("causation_no"), F.col("event_type").alias("cause_type"), F.lit(True).alias("found"))
    return effects.join(causes, "causation_no", "left").select("event_no", "causation_no", "cause_type", F.col("found").isNull().alias("orphan"))
