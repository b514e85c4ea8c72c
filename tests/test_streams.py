"""Streaming jobs over several micro-batches, with restarts: key history."""

import datetime as dt
import random

from pyspark.sql import functions as F

from millrace.session import work_dir
from millrace.streaming import jobs, keys, lifecycle


def longs(spark, values):
    return spark.createDataFrame([(v,) for v in values], "id long")


def found(history, values, batch_id):
    return sorted(r["id"] for r in history.known(longs(history.spark, values), batch_id).collect())


def test_history_finds_exactly_what_was_stored(spark):
    history = keys.KeyHistory(spark, work_dir(spark, "keys"), "id", buckets=4)
    assert found(history, [1, 2], 0) == []
    history.add(longs(spark, range(0, 3000)), 0)
    history.add(longs(spark, range(5000, 5100)), 1)
    history.add(longs(spark, []), 2)
    some = [*range(2900, 3100), *range(5050, 5200), -1]
    assert found(history, some, 3) == [*range(2900, 3000), *range(5050, 5100)]
    assert found(history, some, 1) == list(range(2900, 3000))
    assert found(history, some, 0) == []
    history.compact()
    assert [g[:2] for g in history.generations()] == [(0, 2)]
    assert found(history, some, 3) == [*range(2900, 3000), *range(5050, 5100)]
    history.add(longs(spark, [77_777]), 3)
    history.add(longs(spark, [88_888]), 3)                       # the same batch again
    assert found(history, [77_777, 88_888], 4) == [88_888]


def test_filters_spare_other_keys(spark):
    history = keys.KeyHistory(spark, work_dir(spark, "keys"), "id", buckets=4)
    history.add(longs(spark, range(20_000)), 0)
    assert history.generations()[0][2] == 2                     # blocks grow with the keys
    mistaken = history.candidates(longs(spark, range(10**6, 10**6 + 20_000)), 1).count()
    assert mistaken < 20_000 * 0.05
    assert history.candidates(longs(spark, range(20_000)), 1).count() == 20_000


def arrive(spark, folder, rows):
    spark.createDataFrame(rows, "id long, n int").coalesce(1).write.mode("append").parquet(folder)


def test_first_rows_over_restarts_and_compaction(spark):
    rng = random.Random(2)
    base = work_dir(spark, "dedup")
    expected = set()
    for k in range(5):
        rows = [(rng.choice([None, *range(60)]), k) for _ in range(40)]
        expected |= {i for i, _ in rows if i is not None}
        arrive(spark, f"{base}/in", rows)
        stream = spark.readStream.schema("id long, n int").parquet(f"{base}/in")
        jobs.first_rows(stream, f"{base}/out", f"{base}/none", f"{base}/checkpoint", "id", generations=3)
        ids = [r["id"] for r in spark.read.parquet(f"{base}/out").select("id").collect()]
        assert sorted(ids) == sorted(expected)
    assert len(keys.KeyHistory(spark, f"{base}/out-keys", "id").generations()) <= 3
    assert spark.read.parquet(f"{base}/none").filter(F.col("id").isNull()).count() > 0


# --- lifecycles with state -------------------------------------------------------------------------------------------

ALLOWED = [("A", "B"), ("B", "C")]
START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
STATES = "no long, key string, at timestamp, state string"


def follow(spark, base, rows, **options):
    spark.createDataFrame(rows, STATES).coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = spark.readStream.schema(STATES).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    lifecycle.follow(stream, f"{base}/out", f"{base}/checkpoint", "key", "at", "state", "no", ALLOWED, **options)


def current(spark, base):
    return {r["tie"]: (r["key"], r["state"], r["previous_state"], r["valid"]) for r in lifecycle.transitions(spark, f"{base}/out").collect()}


def test_transitions_over_restarts_and_late_rows_equal_an_ordered_walk(spark):
    rng, base = random.Random(5), work_dir(spark, "life")
    rows = [(n, rng.choice(["k", "l", "m"]), START + dt.timedelta(minutes=rng.randrange(50)), rng.choice("ABC")) for n in range(90)]
    for part in (rows[::3], rows[1::3], rows[2::3] + rows[:3]):                  # each a restart; some rows come again
        follow(spark, base, part)
    expected = {}
    for key in "klm":
        own = sorted((at, n, state) for n, k, at, state in rows if k == key)
        for k, (_, n, state) in enumerate(own):
            before = own[k - 1][2] if k else None
            expected[n] = (key, state, before, before is None or (before, state) in {("A", "B"), ("B", "C")})
    assert current(spark, base) == expected


def test_rows_behind_the_horizon_are_reported_late(spark):
    base, hour = work_dir(spark, "life"), 3_600_000
    at = lambda h: START + dt.timedelta(hours=h)
    follow(spark, base, [(1, "k", at(0), "A"), (2, "k", at(10), "B"), (3, "l", at(1), "C")], horizon_ms=hour)
    follow(spark, base, [(4, "k", at(11), "C"), (5, "k", at(-5), "A"), (6, "k", at(9), "A")], horizon_ms=hour)
    assert [(r["kind"], r["tie"]) for r in lifecycle.alerts(spark, f"{base}/out").collect() if r["kind"] == "late"] == [("late", 5)]
    found = current(spark, base)
    assert found[2][2] == "A" and found[6] == ("k", "A", "A", False) and found[4] == ("k", "C", "B", True)


def test_silence_is_overdue(spark):
    base = work_dir(spark, "life")
    rows = [(1, "k", START, "A"), (2, "k", START + dt.timedelta(hours=1), "B"), (3, "done", START, "C")]
    spark.createDataFrame(rows, STATES).coalesce(1).write.mode("append").parquet(f"{base}/in")
    query = lifecycle.watch(spark.readStream.schema(STATES).parquet(f"{base}/in"), f"{base}/out", f"{base}/checkpoint", "key", "at", "state", "no",
                            ALLOWED, ["C"], deadline_ms=1, every="1 second")
    try:
        for _ in range(40):
            query.awaitTermination(1)
            try:
                found = [(r["kind"], r["tie"]) for r in lifecycle.alerts(spark, f"{base}/out").collect()]
            except Exception:                                   # nothing written yet
                found = []
            if ("overdue", 2) in found:
                break
    finally:
        query.stop()
    assert found.count(("overdue", 2)) == 1 and ("overdue", 3) not in found
