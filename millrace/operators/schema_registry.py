"""Payload schemas: observed fields, compatibility of versions, unlisted fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions.once import once
from millrace.operators.joins import lookup_join

# Type changes that lose nothing.
WIDENINGS = (("BIGINT", "DECIMAL"), ("BIGINT", "DOUBLE"), ("DECIMAL", "DOUBLE"))


def _kind(value):
    return F.regexp_replace(F.schema_of_variant(value), r"[(<].*$", "")


def observed_fields(events: DataFrame) -> DataFrame:
    """Distinct (event_type, event_version, field, type) of payload keys, with ``required``: every payload has the field.

    Both counts are partially aggregated, so the shuffles carry the few combinations only.
    """
    entries = F.try_variant_get(F.try_parse_json("payload"), "$", "map<string,variant>")
    version = ["event_type", "event_version"]
    seen = events.select(*version, F.explode(entries).alias("field", "value")).groupBy(*version, "field", _kind("value").alias("type")).agg(F.count("*").alias("n"))
    totals = events.groupBy(*version).agg(F.count("*").alias("total"))
    in_field = seen.groupBy(*version, "field").agg(F.sum("n").alias("in_field"))
    return seen.join(in_field, [*version, "field"]).join(totals, version).select(*version, "field", "type", (F.col("in_field") == F.col("total")).alias("required"))


def compare_versions(fields: DataFrame, before: str, after: str, renames: dict[str, str] | None = None) -> DataFrame:
    """Change of every field between two versions and the version step it needs.

    ``renames`` names fields that were renamed (old: new). A field that is new and required breaks writers, one that was
    renamed breaks readers: both need a major step.
    """
    old = fields.filter(F.col("event_version") == before).select("event_type", "field", F.col("type").alias("old"))
    new = fields.filter(F.col("event_version") == after).select("event_type", "field", F.col("type").alias("new"), "required")
    named = F.create_map(*[F.lit(x) for pair in (renames or {}).items() for x in pair]) if renames else None
    target = F.coalesce(named[F.col("field")], F.col("field")) if renames else F.col("field")
    old = old.select("event_type", target.alias("field"), "old", (target != F.col("field")).alias("renamed"))
    wider = F.lit(False)
    for a, b in WIDENINGS:
        wider = wider | ((F.col("old") == a) & (F.col("new") == b))
    change = (
        F.when(F.col("old").isNull() & F.col("required"), "added_required").when(F.col("old").isNull(), "added")
        .when(F.col("new").isNull(), "removed").when(F.col("renamed"), "renamed")
        .when(F.col("old") == F.col("new"), "same").when(wider, "widened").otherwise("retyped"))
    level = F.when(F.col("change") == "same", "none").when(F.col("change").isin("added", "widened"), "minor").otherwise("major")
    return old.join(new, ["event_type", "field"], "full").select("event_type", "field", change.alias("change")).withColumn("level", level)


def payload_violations(events: DataFrame, registry: DataFrame) -> DataFrame:
    """(event_no, field, violation) of payloads against their type's and version's schema (field, type, required):
    ``unlisted`` keys, ``missing`` required fields, ``retyped`` values, and ``not_an_object``.

    The schema of a version is one row, so events meet it in one lookup and are checked where they are.
    """
    version = ["event_type", "event_version"]
    schemas = registry.groupBy(*version).agg(F.collect_list(F.struct("field", "type", "required")).alias("listed"))
    rows = lookup_join(events.select("event_no", *version, "payload"), schemas, version, "left", ["event_no"])
    entries = F.try_variant_get(F.try_parse_json("payload"), "$", "map<string,variant>")
    present = F.transform(F.map_entries(entries), lambda e: F.struct(e["key"].alias("field"), _kind(e["value"]).alias("type")))
    rows = once(rows.withColumn("listed", F.coalesce("listed", F.expr("cast(array() as array<struct<field: string, type: string, required: boolean>>)"))), {"present": present})

    def has(column, field):
        return F.exists(column, lambda x: x["field"] == field)

    def fits(declared, found):
        out = (declared == found) | (found == "VOID")
        for a, b in WIDENINGS:
            out = out | ((found == a) & (declared == b))
        return out

    def named(items, violation):
        return F.transform(items, lambda x: F.struct(x["field"].alias("field"), F.lit(violation).alias("violation")))

    unlisted = F.filter("present", lambda p: ~has(F.col("listed"), p["field"]))
    missing = F.filter("listed", lambda x: x["required"] & ~has(F.col("present"), x["field"]))
    retyped = F.filter("present", lambda p: F.exists("listed", lambda x: (x["field"] == p["field"]) & ~fits(x["type"], p["type"])))
    found = F.concat(named(unlisted, "unlisted"), named(missing, "missing"), named(retyped, "retyped"))
    whole = F.array(F.struct(F.lit("").alias("field"), F.lit("not_an_object").alias("violation")))
    return rows.select("event_no", F.inline(F.when(F.col("present").isNull(), whole).otherwise(found)))
