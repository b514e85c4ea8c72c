"""Streams over the given tables, in several micro-batches with late, repeated and untimed rows; results equal those of the batch plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.operators import canonical as can, compliance, epochs, replay
from millrace.session import work_dir
from millrace.streaming import jobs, lifecycle
from millrace.streaming.tables import Refreshed, append_to, run_available
from workload.fixtures import Lake
import workload.queries.governance  # noqa: F401  (the timeline's SQL)
from workload.queries.compliance import rules
from workload.queries.golden import RUN_TIME, documents
from workload.queries.views import LATE_SQL
from workload.registry import oracle_view, query


ARRIVALS = 4  # each a micro-batch of its own
FILES = 8     # files of one arrival

# Arrivals without a time, in both engines.
UNTIMED = "event_id % 101 = 7"
oracle_view("arrivals", ("deliveries",), f"""
SELECT * REPLACE (CASE WHEN {UNTIMED} THEN NULL ELSE transmission_timestamp END AS transmission_timestamp) FROM deliveries""")


def arriving(lake: Lake, rows: DataFrame, number: str) -> DataFrame:
    """``rows`` as a stream of ARRIVALS micro-batches of FILES files. ``number`` deals them out, so that repeats and late rows
    of one key come in other batches than its first row."""
    path = f"{work_dir(lake.spark, 'arriving')}/files"
    for k in range(ARRIVALS):
        rows.filter(F.expr(f"pmod({number}, {ARRIVALS}) = {k}")).repartition(FILES).write.mode("append").parquet(path)
    return lake.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", FILES).parquet(path)


def deliveries(lake: Lake) -> DataFrame:
    rows = lake.fixture("deliveries")
    timed = F.when(~F.expr(UNTIMED), F.col("transmission_timestamp"))
    return arriving(lake, rows.withColumn("transmission_timestamp", timed), "event_id * 7 + delivery_no * 3")


def states(lake: Lake) -> DataFrame:
    return arriving(lake, lake.fixture("state_log"), "event_no * 5")


def _paths(lake: Lake, name: str) -> tuple[str, str]:
    base = work_dir(lake.spark, name)
    return f"{base}/table", f"{base}/checkpoint"


@query("stream_ingest", uses="docs", sql="""
SELECT CASE WHEN is_valid THEN 'golden' ELSE 'quarantine' END AS target, CASE WHEN is_valid THEN format END AS format, count(*) AS n FROM docs GROUP BY 1, 2""")
def stream_ingest(lake):
    base = work_dir(lake.spark, "stream-ingest")
    documents(lake).drop("delivery_no").repartition(4).write.json(f"{base}/arriving")
    source = jobs.document_stream(lake.spark, f"{base}/arriving", max_files=2)
    jobs.ingest(source, f"{base}/golden", f"{base}/quarantine", f"{base}/checkpoint", F.lit(RUN_TIME))
    good = lake.spark.read.parquet(f"{base}/golden").select(F.lit("golden").alias("target"), "format")
    bad = lake.spark.read.schema("event_id string").json(f"{base}/quarantine").select(
        F.lit("quarantine").alias("target"), F.lit(None).cast("string").alias("format"))
    return good.unionByName(bad).groupBy("target", "format").agg(F.count("*").alias("n"))


@query("stream_late", uses="deliveries", sql=LATE_SQL)
def stream_late(lake):
    path, checkpoint = _paths(lake, "stream-late")
    jobs.late_rows(arriving(lake, lake.fixture("deliveries"), "event_id * 7 + delivery_no * 3"), path, checkpoint)
    return lake.spark.read.parquet(path).drop("batch_id")


@query("stream_dedup", uses="arrivals", sql="SELECT DISTINCT event_id FROM arrivals")
def stream_dedup(lake):
    path, checkpoint = _paths(lake, "stream-dedup")
    jobs.first_rows(deliveries(lake).select("event_id", "transmission_timestamp"), path, f"{path}-quarantine", checkpoint, "event_id")
    return lake.spark.read.parquet(path).select("event_id")


@query("stream_alarm_metrics", uses="arrivals", sql="""
SELECT time_bucket(INTERVAL 5 minutes, transmission_timestamp) AS window_start, source_system, count(*) AS n FROM arrivals GROUP BY 1, 2""")
def stream_alarm_metrics(lake):
    path, checkpoint = _paths(lake, "stream-metrics")
    jobs.count_windows(deliveries(lake), path, checkpoint, "transmission_timestamp", "5 minutes", "source_system")
    out = jobs.window_totals(lake.spark, path, "source_system")
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("stream_replay_spike", uses="arrivals", sql="""
SELECT time_bucket(INTERVAL 5 minutes, transmission_timestamp) AS window_start, count(*) AS replays FROM (
 SELECT * FROM arrivals QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY transmission_timestamp NULLS LAST, delivery_no) > 1) GROUP BY 1""")
def stream_replay_spike(lake):
    path, checkpoint = _paths(lake, "stream-replays")
    jobs.count_windows(deliveries(lake), path, checkpoint, "transmission_timestamp", "5 minutes", "event_id")
    spikes = jobs.replay_spikes(jobs.window_totals(lake.spark, path, "event_id"))
    return spikes.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("stream_lifecycle", uses="state_log", sql="""
SELECT correlation_id, arg_max(state, "at") AS state, count(*) AS steps, min("at") AS first_at, max("at") AS last_at FROM state_log GROUP BY 1""")
def stream_lifecycle(lake):
    path, checkpoint = _paths(lake, "stream-lifecycle")
    jobs.follow_lifecycles(states(lake), path, checkpoint, "correlation_id", "at", "state", "event_no")
    return jobs.lifecycles(lake.spark, path, "correlation_id")


@query("stream_transitions", uses="timeline", sql="SELECT event_no, correlation_id, state, previous_state FROM timeline")
def stream_transitions(lake):
    """Followed with keyed state over several micro-batches; equal to the ordered batch plan."""
    path, checkpoint = _paths(lake, "stream-transitions")
    lifecycle.follow(states(lake), path, checkpoint, "correlation_id", "at", "state", "event_no", replay.LIFECYCLE_TRANSITIONS, horizon_ms=3650 * lifecycle.DAY_MS)
    return lifecycle.transitions(lake.spark, path).select(
        F.col("tie").alias("event_no"), F.col("key").alias("correlation_id"), "state", "previous_state")


@query("stream_enrich", uses=("canon", "enriched"), sql="""
SELECT msg_id, 'accepted' AS outcome, compliance_flag, compliance_reason, compliance_rule_id FROM enriched
UNION ALL SELECT msg_id, error_reason, NULL, NULL, NULL FROM canon WHERE error_reason IS NOT NULL""")
def stream_enrich(lake):
    path, checkpoint = _paths(lake, "stream-enrich")
    orders = arriving(lake, lake.table("orders"), "o_orderkey")

    def canonical(arrived: DataFrame) -> DataFrame:
        return can.canonicalize(lake.derive("raw_messages", arrived))

    lookup = Refreshed(lake.spark, f"{path}-rules", lambda: compliance.lookup_of(rules(lake)))

    def enrich(events: DataFrame) -> DataFrame:
        return compliance.enrich(events, lookup.current(), prepared=True)

    jobs.enrich_batches(orders, path, f"{path}-quarantine", checkpoint, canonical, enrich)
    good = lake.spark.read.parquet(path).select("msg_id", F.lit("accepted").alias("outcome"), "compliance_flag", "compliance_reason", "compliance_rule_id")
    none = F.lit(None)
    bad = lake.spark.read.parquet(f"{path}-quarantine").select(
        "msg_id", F.col("error_reason").alias("outcome"), none.cast("boolean").alias("compliance_flag"),
        none.cast("string").alias("compliance_reason"), none.cast("string").alias("compliance_rule_id"))
    return good.unionByName(bad)


# Two versions of a rule per customer, changed at some second between 1992 and 1998.
CHANGED = "timestampadd(SECOND, CAST((c_custkey * 37 + v * 911) % 2400 * 86400 + c_custkey % 86400 AS INT), TIMESTAMP_NTZ '1992-01-01 00:00:00')"
oracle_view("rule_history", (), """
SELECT c_custkey, concat('r-', c_custkey, '-', v) AS rule_id, TIMESTAMP '1992-01-01' + to_seconds((c_custkey * 37 + v * 911) % 2400 * 86400 + c_custkey % 86400) AS changed_at
FROM customer, (VALUES (1), (2)) t(v) WHERE c_custkey % 4 <> 0""")
oracle_view("rule_epochs", ("rule_history",), """
SELECT c_custkey, rule_id, TIMESTAMP '1970-01-01' + to_seconds(CAST(ceil(epoch(changed_at) / 300) * 300 AS BIGINT)) AS visible_from
FROM rule_history QUALIFY row_number() OVER (PARTITION BY c_custkey, ceil(epoch(changed_at) / 300) ORDER BY changed_at DESC, rule_id) = 1""")
AT_TIME_SQL = """
SELECT o_orderkey, r.rule_id FROM orders ASOF LEFT JOIN rule_epochs r ON o_custkey = r.c_custkey AND o_orderdate >= r.visible_from"""


def rule_versions(lake: Lake) -> DataFrame:
    history = lake.sql(f"""
SELECT c_custkey AS o_custkey, concat('r-', CAST(c_custkey AS STRING), '-', CAST(v AS STRING)) AS id, {CHANGED} AS updated_at
FROM customer LATERAL VIEW explode(array(1, 2)) t AS v WHERE c_custkey % 4 <> 0""")
    return epochs.versions(history.withColumn("rule_id", F.col("id")), ["o_custkey"])


@query("rules_at_event_time", uses="rule_epochs", sql=AT_TIME_SQL)
def rules_at_event_time(lake):
    """Each order's rule as it stood at the order's time, rules being read every 300 s."""
    orders = lake.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return epochs.rules_at(orders, rule_versions(lake), ["o_custkey"], "o_orderdate", "o_orderkey", ["rule_id"]).select("o_orderkey", "rule_id")


@query("stream_rules_at_event_time", uses="rule_epochs", sql=AT_TIME_SQL)
def stream_rules_at_event_time(lake):
    path, checkpoint = _paths(lake, "stream-epochs")
    history = Refreshed(lake.spark, f"{path}-rules", lambda: rule_versions(lake))

    def each(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select("o_orderkey", "o_custkey", "o_orderdate")
        held = epochs.versions_for(rows, history.current(), ["o_custkey"])
        append_to(path)(epochs.rules_at(rows, held, ["o_custkey"], "o_orderdate", "o_orderkey", ["rule_id"]), batch_id)

    run_available(arriving(lake, lake.table("orders"), "o_orderkey"), checkpoint, each)
    return lake.spark.read.parquet(path).select("o_orderkey", "rule_id")
