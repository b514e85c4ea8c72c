"""Rule lookup for canonical events, and upkeep of the rule table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.operators.joins import BROADCAST_ROWS, lookup_join

ENTITY_KEY = ("entity_type", "entity_id")
# Identity of a rule, and what is recorded without a rule.
RULE_KEY = ("entity_type", "entity_id", "rule_type", "source_format", "event_type")
FALLBACK_REASON = "FALLBACK_DEFAULT"
NOOP_REASON, NOOP_RULE = "NOOP_GUARD", "noop"
FORMAT_ALIASES = {"json": "generic"}


def latest_rules(rules: DataFrame, key: Sequence[str] = ENTITY_KEY, newest: str = "updated_at") -> DataFrame:
    """The most recent rule per key; equal times are settled by the rule id.

    Spark cuts each key to its first row before the shuffle (WindowGroupLimit).
    """
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(F.col(newest).desc(), F.col("id")))
    return rules.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def with_entity_aliases(rules: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """Rename rule entity types, e.g. member to patient."""
    renamed = F.coalesce(*[F.when(F.col("entity_type") == a, F.lit(b)) for a, b in aliases.items()], F.col("entity_type"))
    return rules.withColumn("entity_type", renamed)


def _outcome(hit: Column) -> dict[str, Column]:
    blank = F.lit("")
    return {
        "compliance_applied": F.lit(True),
        "compliance_flag": F.coalesce("compliance_flag", F.lit(False)),
        "compliance_reason": F.when(hit, F.coalesce("reason_code", blank)).otherwise(F.lit(FALLBACK_REASON)),
        "compliance_rule_type": F.coalesce("rule_type", blank),
        "compliance_rule_id": F.coalesce("id", blank),
    }


def lookup_of(rules: DataFrame, key: Sequence[str] = ENTITY_KEY, newest: str = "updated_at") -> DataFrame:
    """The columns of each key's most recent rule that ``enrich`` reads."""
    return latest_rules(rules, key, newest).select(*key, "id", "rule_type", "compliance_flag", "reason_code")


def enrich(events: DataFrame, rules: DataFrame, newest: str = "updated_at", match_format: bool = False,
           at: Column | None = None, salt: Sequence[str] = ("event_id",),
           max_rows: int = BROADCAST_ROWS, prepared: bool = False) -> DataFrame:
    """Annotate accepted events with their entity's rule, or with the fallback.

    With ``prepared`` the rules are a stored result of ``lookup_of``.
    """
    key = [*ENTITY_KEY]
    if match_format:
        alias = F.coalesce(*[F.when(F.lower("source_format") == a, F.lit(b)) for a, b in FORMAT_ALIASES.items()],
                           F.lower("source_format"))
        rules = rules.withColumn("format", alias)
        key += ["format", "event_type"]
    lookup = rules if prepared else lookup_of(rules, key, newest)
    joined = lookup_join(events.filter(F.col("error_reason").isNull()), lookup, key, "left", salt, max_rows)
    out = joined.withColumns(_outcome(F.col("id").isNotNull()))
    if at is not None:
        out = out.withColumn("compliance_timestamp", at)
    return out.drop("id", "rule_type", "reason_code")


def enrich_noop(events: DataFrame) -> DataFrame:
    """Constant annotation when no rules are in use; accepts every event."""
    return events.withColumns({
        "compliance_applied": F.lit(True),
        "compliance_flag": F.lit(False),
        "compliance_reason": F.lit(NOOP_REASON),
        "compliance_rule_type": F.lit(NOOP_RULE),
        "compliance_rule_id": F.lit(NOOP_RULE),
    })


def first_store_wins(stores: Sequence[tuple[str, DataFrame]], newest: str = "updated_at") -> DataFrame:
    """One rule per entity from stores in order of precedence; blank rules are misses."""
    blank = (F.coalesce("id", F.lit("")) == "") & (F.coalesce("rule_type", F.lit("")) == "") & ~F.coalesce("compliance_flag", F.lit(False))
    ranked = None
    for priority, (name, store) in enumerate(stores):
        part = store.filter(~blank).withColumns({"store": F.lit(name), "_priority": F.lit(priority)})
        ranked = part if ranked is None else ranked.unionByName(part)
    order = Window.partitionBy(*ENTITY_KEY).orderBy("_priority", F.col(newest).desc(), "id")
    return ranked.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") == 1).drop("_rank", "_priority")


def merge_rules(rows: DataFrame) -> DataFrame:
    """One row per rule key of rows marked by ``_run``: flag, reason and updated_at of the last, id and created_at of the first."""
    age = F.struct("_run", "updated_at", "id")
    merged = rows.groupBy(*RULE_KEY).agg(
        F.max_by(F.struct("compliance_flag", "reason_code", "updated_at"), age).alias("_now"),
        F.min_by(F.struct("id", "created_at"), age).alias("_first"))
    return merged.select(*RULE_KEY, "_now.*", "_first.*")


def upsert_rules(base: DataFrame, changes: DataFrame) -> DataFrame:
    """Insert changes; on an equal rule key update flag, reason and updated_at.

    The id and created_at of an existing rule are kept.
    """
    both = base.withColumn("_run", F.lit(0)).unionByName(changes.withColumn("_run", F.lit(1)))
    return merge_rules(both).select(*base.columns)


def unique_violations(rules: DataFrame) -> DataFrame:
    """Rule keys that occur more than once."""
    return rules.groupBy(*RULE_KEY).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)
