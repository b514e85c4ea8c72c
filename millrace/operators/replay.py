"""Replay requests: validation, selection, summary."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators import intervals, ordered
from millrace.operators.joins import lookup_join, pair_join

# Request states and allowed transitions, event lifecycle states.
REQUEST_STATES = ("REQUESTED", "APPROVED", "PREPARED", "EXECUTING", "COMPLETED", "REJECTED")
REQUEST_TRANSITIONS = (
    ("REQUESTED", "APPROVED"), ("REQUESTED", "REJECTED"), ("APPROVED", "PREPARED"), ("APPROVED", "REJECTED"),
    ("PREPARED", "EXECUTING"), ("EXECUTING", "COMPLETED"))
LIFECYCLE_STATES = ("PRODUCED", "INGESTED", "CANONICALIZED", "COMPLIANCE_EVALUATED", "ROUTED", "CONSUMED",
                    "RETAINED", "ARCHIVED", "REPLAYED")
LIFECYCLE_TRANSITIONS = tuple(zip(LIFECYCLE_STATES, LIFECYCLE_STATES[1:]))


def is_transition(before: Column, after: Column, allowed) -> Column:
    return F.concat_ws(">", before, after).isin(*[f"{a}>{b}" for a, b in allowed])


# Levels of the index that are no time blocks: single events, and correlations.
EVENT_LEVEL, CORRELATION_LEVEL = -1, -2
INDEX = ["_block", "_who", "_what", "_level"]
FEW_ENTRIES = 20_000  # index entries of requests that are broadcast; beyond, the plan is the same at every size


def _entry(level: Column, block: Column, who: Column, what: Column) -> Column:
    return F.struct(level.cast("int").alias("_level"), block.cast("long").alias("_block"), who.cast("string").alias("_who"), what.cast("string").alias("_what"))


def _index_of_event(event_no: Column) -> Column:
    return F.array(_entry(F.lit(EVENT_LEVEL), event_no, F.lit(""), F.lit("")))


def _index_of_correlation(correlation_id: Column) -> Column:
    return F.array(_entry(F.lit(CORRELATION_LEVEL), F.xxhash64(correlation_id), correlation_id, F.lit("")))


def _indexed_windows(blocks: Column, tenant: Column, event_type: Column) -> Column:
    return F.transform(blocks, lambda b: _entry(b["level"], b["block"], tenant, event_type))


def select_events(events: DataFrame, requests: DataFrame, max_rows: int = FEW_ENTRIES) -> DataFrame:
    """Pairs of request and event, by event, by correlation, or by tenant, type and window, in one scan of the events.

    All three kinds share one index: a level, a block and whose it is. A window takes the few blocks it meets at the
    level of its length, an event one entry for itself, one for its correlation and one per level in use; each pair
    meets at most once. Entries hold the keys themselves, so that of the join's candidates only a window's edges are
    left to check, and what is shuffled beside them is just the columns that are read later.
    """
    kind = F.col("replay_kind")
    spans = [intervals.micros(F.col(name)) for name in ("window_from", "window_to")]
    entries = (
        F.when(kind == "event", _index_of_event(F.col("event_no")))
        .when(kind == "correlation", _index_of_correlation(F.col("correlation_id")))
        .when(kind == "window", _indexed_windows(intervals.covering_blocks(*spans), F.col("tenant_id"), F.col("event_type"))))
    edges = [F.when(kind == "window", F.col(name)).alias(f"_{name}") for name in ("window_from", "window_to")]
    wanted = requests.select("request_id", *edges, F.inline(entries))
    levels = sorted(r[0] for r in wanted.select("_level").distinct().collect())    # at most one per bit of a long, and two
    at = intervals.micros(F.col("produced_at"))
    offered = F.concat(
        _index_of_event(F.col("event_no")), _index_of_correlation(F.col("correlation_id")),
        _indexed_windows(intervals.blocks_at(at, [k for k in levels if k >= 0]), F.col("tenant_id"), F.col("event_type")))
    candidates = pair_join(events.select(*events.columns, F.inline(offered)), wanted, INDEX, ["event_no"], max_rows)
    inside = (F.col("produced_at") >= F.col("_window_from")) & (F.col("produced_at") < F.col("_window_to"))
    return candidates.filter((F.col("_level") < 0) | inside).select("request_id", *events.columns)


def request_violations(requests: DataFrame, as_of: Column, retention_days: int) -> DataFrame:
    """One row per request and broken rule."""
    blank = lambda name: F.coalesce(F.col(name), F.lit("")) == ""
    windowed = F.col("replay_kind") == "window"
    broken = {
        "missing_tenant": blank("tenant_id"),
        "missing_event_type": blank("event_type"),
        "missing_team": blank("requesting_team"),
        "missing_justification": blank("justification"),
        "empty_window": windowed & (F.col("window_to") <= F.col("window_from")),
        "window_exceeds_retention": windowed & (F.datediff(as_of, F.to_date("window_from")) > retention_days),
        "unknown_state": ~F.col("state").isin(*REQUEST_STATES),
        "invalid_transition": ~is_transition(F.col("state"), F.col("next_state"), REQUEST_TRANSITIONS),
    }
    found = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in broken.items()]))
    return requests.select("request_id", F.explode(found).alias("violation"))


def runnable(requests: DataFrame, as_of: Column, retention_days: int) -> DataFrame:
    """Requests that may be executed: approved, about to be prepared, and breaking no rule."""
    broken = request_violations(requests, as_of, retention_days).select("request_id").distinct()
    ready = (F.col("state") == "APPROVED") & (F.col("next_state") == "PREPARED")
    return requests.filter(ready).join(broken, "request_id", "left_anti")


MESSAGE_MISSING, ACCEPTED = "message_missing", "accepted"


def reprocess(selected: DataFrame, messages: DataFrame, path: str, canonicalize: Callable[[DataFrame], DataFrame],
              enrich: Callable[[DataFrame], DataFrame], outcome_columns: tuple[str, ...]) -> DataFrame:
    """Replay what was selected, in an area of its own below ``path``; returns one row per request and event.

    Only messages of selected events (msg_id = event_no) are canonicalised, each once however many requests want it, and
    enriched by the rules of today. Accepted events go to ``events/request_id=...``, numbered in their order within the
    request, everything else with its reason to ``failures/request_id=...``; tables of live traffic are not touched.
    """
    spark = selected.sparkSession
    numbered = ordered.with_neighbours(selected, "request_id", ["produced_at", "event_no"], sequence="replay_no")
    numbered.write.parquet(f"{path}/selected")
    chosen = spark.read.schema(numbered.schema).parquet(f"{path}/selected")
    wanted = chosen.select(F.col("event_no").alias("msg_id")).distinct()
    canonicalize(lookup_join(messages, wanted, ["msg_id"], "left_semi", ["msg_id"])).write.parquet(f"{path}/canonical")
    canonical = spark.read.parquet(f"{path}/canonical")
    accepted = enrich(canonical.filter("error_reason IS NULL")).select("msg_id", F.lit(ACCEPTED).alias("outcome"), *outcome_columns)
    nothing = [F.lit(None).cast(accepted.schema[c].dataType).alias(c) for c in outcome_columns]
    rejected = canonical.filter("error_reason IS NOT NULL").select("msg_id", F.col("error_reason").alias("outcome"), *nothing)
    results = accepted.unionByName(rejected).withColumnRenamed("msg_id", "event_no")
    out = chosen.join(results, "event_no", "left").withColumn("outcome", F.coalesce("outcome", F.lit(MESSAGE_MISSING)))
    out.write.parquet(f"{path}/results")
    out = spark.read.schema(out.schema).parquet(f"{path}/results")
    done = F.col("outcome") == ACCEPTED
    for name, rows in (("events", out.filter(done)), ("failures", out.filter(~done))):
        rows.hint("rebalance", "request_id").write.partitionBy("request_id").parquet(f"{path}/{name}")
    return out


def audit(results: DataFrame, requests: DataFrame, at: Column) -> DataFrame:
    """One record per replayed event: who asked, what became of it under which rule, when, and where it came from."""
    actors = requests.select("request_id", F.col("requesting_team").alias("actor"), "justification")
    lineage = F.struct("correlation_id", "causation_no", "source_system", "produced_at")
    return lookup_join(results, actors, ["request_id"], "left", ["event_no"]).select(
        "request_id", "event_no", F.lit("replay").alias("action"), "actor", "justification", "replay_no", "outcome",
        F.col("compliance_rule_id").alias("rule_id"), at.alias("evaluated_at"), lineage.alias("lineage"))


def summarise(replayed: DataFrame, requests: DataFrame, consumers: DataFrame | None = None, outcome: str | None = None) -> DataFrame:
    """Events, time span and rule outcomes per request, requests without events included.

    With ``consumers`` (consumer, event_no) also how many consumers are affected; with ``outcome`` (a column that says
    ``accepted`` or why not) also how many events failed.
    """
    totals = replayed.groupBy("request_id").agg(
        F.count("*").alias("events"), F.min("produced_at").alias("first_at"), F.max("produced_at").alias("last_at"),
        F.count_if("rule_fired").alias("rules_fired"), F.count_if("rejected").alias("rejected"))
    counts = ["rules_fired", "rejected"]
    if outcome:
        failed = replayed.groupBy("request_id").agg(F.count_if(F.col(outcome) != ACCEPTED).alias("failures"))
        totals, counts = totals.join(failed, "request_id"), [*counts, "failures"]
    if consumers is not None:
        seen = replayed.select("request_id", "event_no").join(consumers, "event_no")
        affected = seen.select("request_id", "consumer").distinct().groupBy("request_id").agg(F.count("*").alias("consumers"))
        totals, counts = totals.join(affected, "request_id", "left"), [*counts, "consumers"]
    zero = lambda name: F.coalesce(name, F.lit(0)).alias(name)
    return requests.select("request_id").join(totals, "request_id", "left").select(
        "request_id", zero("events"), "first_at", "last_at", *[zero(c) for c in counts])
