"""Ordered windows at any skew, and the dyadic interval index, against plain loops."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import intervals, ordered, replay

START = dt.datetime(2024, 1, 1)


def walked(rows):
    """Sequence, neighbours and running maximum by a loop per key. Rows: n, key, at, v."""
    by_key, out = {}, {}
    for row in sorted(rows, key=lambda r: (r[2], r[0])):
        by_key.setdefault(row[1], []).append(row)
    for members in by_key.values():
        top = None
        for k, (n, _, _, v) in enumerate(members):
            before = members[k - 1][0] if k else None
            after = members[k + 1][0] if k + 1 < len(members) else None
            out[n] = (k + 1, before, after, top)
            top = v if top is None or v is not None and v > top else top
    return out


def scanned(spark, rows, **sizes):
    df = spark.createDataFrame(rows, "n int, key string, at timestamp_ntz, v int").repartition(5)
    near = ordered.with_neighbours(df, "key", ["at", "n"], {"before": "n"}, {"after": "n"}, "seq", **sizes)
    assert near.columns == ["n", "key", "at", "v", "before", "after", "seq"]
    top = ordered.with_running_max(df, "key", ["at", "n"], "v", "top", **sizes)
    tops = {r["n"]: r["top"] for r in top.collect()}
    return {r["n"]: (r["seq"], r["before"], r["after"], tops[r["n"]]) for r in near.collect()}


def some_rows(kind, count=300):
    rng = random.Random(kind)
    keys = {"one key": ["k"], "one hot key": ["k"] * 9 + ["a", "b", None], "null is hot": [None] * 9 + ["a"], "many keys": [str(i) for i in range(90)]}[kind]
    span = 1 if kind == "one key" else 10**6
    return [(n, rng.choice(keys), START + dt.timedelta(seconds=rng.randrange(span)), rng.choice([None, *range(50)])) for n in range(count)]


@pytest.mark.parametrize("kind", ["one key", "one hot key", "null is hot", "many keys"])
@pytest.mark.parametrize("sizes", [{}, {"hot_rows": 20, "range_rows": 7}, {"hot_rows": 0, "range_rows": 25}])
def test_windows_equal_a_loop(spark, kind, sizes):
    rows = some_rows(kind)
    assert scanned(spark, rows, **sizes) == walked(rows)


def test_rows_of_one_key_at_one_time_are_spread_over_ranges(spark):
    df = spark.range(4000).select(F.lit("k").alias("key"), F.lit(START).cast("timestamp_ntz").alias("at"), F.col("id").cast("int").alias("n"))
    sizes = [r["count"] for r in ordered._ranged(df, "key", ["at", "n"], 4000, 500).groupBy("_range").count().collect()]
    assert len(sizes) > 4 and max(sizes) < 1500


def test_no_rows(spark):
    assert scanned(spark, [], hot_rows=0) == {}


def test_covers_are_disjoint_and_close(spark):
    rng = random.Random(1)
    spans = [(a, a + rng.randrange(10 ** rng.randint(1, 14))) for a in (rng.randrange(10 ** rng.randint(1, 15)) for _ in range(400))]
    spans += [(-50, 70), (5, 5), (9, 3), (0, 1)]
    rows = spark.createDataFrame(spans, "a long, b long").withColumn("blocks", intervals.covering_blocks(F.col("a"), F.col("b"))).collect()
    for r in rows:
        found = sorted((x["block"] << x["level"], (x["block"] + 1) << x["level"]) for x in r["blocks"])
        if r["a"] >= r["b"]:
            assert not found
            continue
        assert len(found) <= 2 * (intervals.FINE + 1)
        assert all(x[1] == y[0] for x, y in zip(found, found[1:]))
        assert found[0][0] <= r["a"] and found[-1][1] >= r["b"]
        assert found[-1][1] - found[0][0] <= (r["b"] - r["a"]) * (1 + 2 ** (2 - intervals.FINE)) + 2


def test_windows_of_like_length_cost_an_event_one_block(spark):
    """Each level in use is one more row to shuffle for every event."""
    hours = lambda n: n * 3_600_000_000
    spans = [(k * hours(7), k * hours(7) + hours(n)) for k in range(20) for n in (2, 5)]
    rows = spark.createDataFrame(spans, "a long, b long").select(intervals.covering_blocks(F.col("a"), F.col("b")).alias("blocks")).collect()
    assert len({x["level"] for r in rows for x in r["blocks"]}) == 2
    assert max(len(r["blocks"]) for r in rows) <= 5


@pytest.mark.parametrize("hot", [{}, {"hot_rows": 20}, {"hot_pairs": 100}, {"hot_rows": 0}])
def test_pair_join_equals_plain_join(spark, hot):
    from millrace.operators.joins import pair_join

    rows = spark.range(200).select(F.col("id").alias("n"), F.when(F.col("id") % 3 > 0, F.col("id") % 50).otherwise(8).alias("a"), F.expr("nullif(id % 2, 1)").alias("b"))
    rows = rows.union(rows.limit(40)).repartition(3)
    lookup = spark.range(60).select((F.col("id") % 20).alias("a"), F.expr("nullif(id % 4, 3) % 2").alias("b"), F.concat(F.lit("v"), "id").alias("v"))
    found = pair_join(rows, lookup, ["a", "b"], ["n"], 0, **hot)
    assert sorted(map(tuple, found.select("n", "a", "b", "v").collect())) == sorted(map(tuple, rows.join(lookup, ["a", "b"]).select("n", "a", "b", "v").collect()))
    assert ("_slice" in found._jdf.queryExecution().optimizedPlan().toString()) == bool(hot)


def test_pair_join_splits_only_what_is_hot(spark):
    from millrace.operators.joins import pair_join

    rows = spark.range(2000).select(F.col("id").alias("n"), F.when(F.col("id") < 1000, F.lit(-1)).otherwise(F.col("id")).alias("a"))
    lookup = spark.range(-1, 3000).select(F.col("id").alias("a"), F.col("id").alias("v"))
    found = pair_join(rows, lookup, ["a"], ["n"], 0, hot_rows=500)
    assert found.filter("a = -1").count() == 1000 and found.count() == 2000
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" in text and text.count("explode") == 1


EVENT = "event_no long, correlation_id string, tenant_id string, event_type string, produced_at timestamp_ntz"
REQUEST = "request_id string, replay_kind string, event_no long, correlation_id string, tenant_id string, event_type string, window_from timestamp_ntz, window_to timestamp_ntz"


@pytest.mark.parametrize("max_rows", [200_000, 0])
def test_selection_equals_all_pairs(spark, max_rows):
    rng = random.Random(4)
    minute = lambda m: START + dt.timedelta(minutes=m)
    events = [(n, rng.choice(["c1", "c2", None]), rng.choice(["t1", "t2", None]), rng.choice(["x", "y"]), minute(rng.randrange(500))) for n in range(400)]
    requests = [(f"e{n}", "event", n, None, None, None, None, None) for n in (3, 5, 5000)] + [("c", "correlation", None, "c1", None, None, None, None)]
    requests += [("e-null", "event", None, None, None, None, None, None), ("odd", "other", 1, "c1", "t1", "x", minute(0), minute(9))]
    for k in range(40):
        start = rng.randrange(500)
        requests.append((f"w{k}", "window", None, None, rng.choice(["t1", "t2", None]), rng.choice(["x", "y"]), minute(start), minute(start + rng.choice([-3, 0, 1, 7, 300]))))
    requests.append(("w-null", "window", None, None, "t1", "x", None, minute(9)))
    wanted = set()
    for q in requests:
        for e in events:
            if ((q[1] == "event" and q[2] == e[0]) or (q[1] == "correlation" and q[3] == e[1])
                    or (q[1] == "window" and None not in (q[6], e[2]) and q[4:6] == e[2:4] and q[6] <= e[4] < q[7])):
                wanted.add((q[0], e[0]))
    found = replay.select_events(spark.createDataFrame(events, EVENT).repartition(3), spark.createDataFrame(requests, REQUEST), max_rows)
    pairs = [(r["request_id"], r["event_no"]) for r in found.collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == wanted


def test_many_requests_are_shuffled_not_broadcast(spark):
    """The index entries of many requests are copied for the join; the estimate of their size says nothing of the copies."""
    at = F.lit(START).cast("timestamp_ntz")
    events = spark.range(50).select(
        F.col("id").alias("event_no"), F.lit("c").alias("correlation_id"), F.lit("t").alias("tenant_id"), F.lit("x").alias("event_type"), at.alias("produced_at"))
    requests = spark.range(200).select(
        F.concat(F.lit("r"), "id").alias("request_id"), F.when(F.col("id") < 199, F.lit("event")).otherwise(F.lit("window")).alias("replay_kind"),
        F.col("id").alias("event_no"), F.lit(None).cast("string").alias("correlation_id"), F.lit("t").alias("tenant_id"), F.lit("x").alias("event_type"),
        at.alias("window_from"), F.timestamp_add("HOUR", F.lit(2), at).alias("window_to"))
    found = replay.select_events(events, requests, max_rows=100)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 50 + 50


def test_summary_shuffles_no_payloads(spark, tmp_path):
    """Events are judged in the scan that selects them: only verdicts go through the join, not what they are read from."""
    from workload.fixtures import Lake
    from workload.queries import governance

    at = F.lit(START).cast("timestamp_ntz")
    spark.range(30_000).select(F.col("id").alias("c_custkey"), F.lit(1).alias("c_nationkey")).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(60).select(
        F.col("id").alias("event_id"), at.alias("ts"), (F.col("id") % 9).alias("user_id"), F.lit("view").alias("event_type"), F.lit(1.0).alias("value"),
        F.lit('{"k": 1}').alias("props")).write.parquet(f"{tmp_path}/events.parquet")
    found = governance.replay_summary(Lake(spark, str(tmp_path)))
    plan = found._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.split("\n") if "Exchange hashpartitioning(_block" in line]
    sorts = [line for line in plan.split("\n") if "Generate inline" in line]
    assert len(joins) == 2 and sorts and not any("payload" in line or "data_classification" in line for line in sorts)
    assert found.count() == 30_000


def test_copies_of_many_patients_are_not_broadcast(spark):
    """A broadcast of the copies weighs on every task that reads it; the estimate of their size says nothing of the copies."""
    from millrace.operators import joins, structure

    patients = spark.range(joins.BROADCAST_ROWS + 1).select(F.col("id").cast("string").alias("patient_id"))
    rows = spark.range(3).select(F.col("id").alias("event_id"), F.concat(F.lit("Patient/"), F.col("id") * 150_000).alias("reference"))
    found = structure.resolve_patients(rows, patients)
    assert {r["event_id"]: r["resolved"] for r in found.collect()} == {0: True, 1: True, 2: False}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_copies_are_not_broadcast_on_a_measured_size(spark):
    """Adaptive execution plans again when the distinct patients are shuffled, by their size before they are copied."""
    from millrace.operators import joins, structure

    often = 5 * (joins.BROADCAST_ROWS + 1)  # estimated above Spark's limit, measured below it
    patients = spark.range(often).select(F.expr("string(id div 5)").alias("patient_id"))
    rows = spark.range(3).select(F.col("id").alias("event_id"), F.concat(F.lit("Patient/"), F.col("id") * 150_000).alias("reference"))
    found = structure.resolve_patients(rows, patients)
    plan = found._jdf.queryExecution().executedPlan()
    assert "Broadcast" not in plan.toString()
    assert {r["event_id"]: r["resolved"] for r in found.collect()} == {0: True, 1: True, 2: False}
    assert "isFinalPlan=true" in plan.toString() and "SortMergeJoin" in plan.toString() and "Broadcast" not in plan.toString()


def test_selection_without_requests(spark):
    events = spark.createDataFrame([(1, "c", "t", "x", START)], EVENT)
    assert replay.select_events(events, spark.createDataFrame([], REQUEST)).count() == 0


def test_lookups_are_measured_in_rows_and_bytes(spark):
    from millrace.operators.joins import fits

    rows = spark.range(10).select("id", F.repeat(F.lit("é"), 50).alias("odd name"), F.array(F.struct("id")).alias("a"), F.lit(None).cast("binary").alias("b"))
    assert fits(rows) and fits(rows, 10) and not fits(rows, 9)
    assert not fits(rows, 10, 1000) and fits(rows, 10, 1500)
    assert fits(rows.limit(0), 0)
