"""Observed writes, the catalogue fed by them, and rules at a point in time."""

import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import functions as F

from millrace.operators import epochs
from millrace.session import work_dir
from millrace.sources import observed
from millrace.streaming.tables import Refreshed


def test_reports_count_only_their_own_write(spark):
    path = work_dir(spark, "observed")
    rows = lambda n: spark.range(n).select("id", F.when(F.col("id") % 3 > 0, F.concat(F.lit("a/b="), F.col("id") % 3)).alias("odd name"))
    first = observed.observed_write(rows(100), path, ["odd name"])
    second = observed.observed_write(rows(5).filter("id % 3 = 1"), path, ["odd name"])
    assert (first.rows, len(first.partitions), second.rows, second.partitions) == (100, 3, 2, (("a/b=1",),))
    sizes = {r[0]: r[1] for r in spark.read.parquet(path).select("_metadata.file_path", "_metadata.file_size").distinct().collect()}
    assert first.bytes + second.bytes == sum(sizes.values()) and first.files + second.files == len(sizes)
    assert first.seconds > 0 and second.bytes > 0


def test_a_write_without_rows(spark):
    report = observed.observed_write(spark.range(0).withColumn("p", F.lit("x")), work_dir(spark, "observed"), ["p"])
    assert (report.rows, report.bytes, report.partitions) == (0, 0, ())


def test_catalogue_takes_partitions_and_columns_from_reports(spark):
    path, name = work_dir(spark, "observed"), f"t_{uuid.uuid4().hex}"
    for k, more in enumerate((None, "extra")):
        rows = spark.range(10).select("id", F.when(F.col("id") > 0, F.concat(F.lit(f"it's {k} "), F.col("id") % 2)).alias("p"))
        rows = rows if more is None else rows.withColumn(more, F.lit(k))
        report = observed.observed_write(rows, path, ["p"])
        observed.register_written(spark, name, path, rows.schema, ["p"], report)
        observed.register_written(spark, name, path, rows.schema, ["p"], report)          # the same report again
    table = spark.table(name)
    assert table.count() == 20 and table.filter("extra = 1").count() == 10 and table.filter("p = 'it\\'s 1 0'").count() == 4
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 5
    spark.sql(f"DROP TABLE {name}")


START = dt.datetime(2024, 1, 1)


@pytest.mark.parametrize("hot_rows", [1_000_000, 10])
def test_rules_at_equal_a_loop(spark, hot_rows):
    rng = random.Random(6)
    at = lambda s: START + dt.timedelta(seconds=s)
    rules = [(rng.choice("abc"), rng.choice(["x", None]), at(rng.randrange(5000)), f"r{n}") for n in range(40)]
    events = [(n, rng.choice(["a", "b", "c", "d", None]), rng.choice(["x", None]), at(rng.randrange(6000))) for n in range(150)]
    expected = {}
    for n, k, f, when in events:
        seen = [(c, r) for kk, ff, c, r in rules if None not in (k, f) and (kk, ff) == (k, f)
                and -(-(c - START).total_seconds() // 300) * 300 <= (when - START).total_seconds()]
        last = max((c for c, _ in seen), default=None)
        expected[n] = min((r for c, r in seen if c == last), default=None)
    held = epochs.versions(spark.createDataFrame(rules, "k string, f string, updated_at timestamp_ntz, id string"), ["k", "f"])
    frame = spark.createDataFrame(events, "n int, k string, f string, at timestamp_ntz")
    found = epochs.rules_at(frame, held.withColumn("rule", F.col("id")), ["k", "f"], "at", "n", ["rule"], hot_rows)
    assert found.columns == ["n", "k", "f", "at", "rule"]
    assert {r["n"]: r["rule"] for r in found.collect()} == expected
    some = epochs.versions_for(frame.filter("k = 'a'"), held, ["k", "f"])
    assert {r["k"] for r in some.collect()} <= {"a"}


def test_refreshed_tables_are_loaded_again_only_after_their_time(spark):
    loads = []
    load = lambda: loads.append(1) or spark.range(len(loads))
    held = Refreshed(spark, work_dir(spark, "held"), load, seconds=1000)
    assert held.current().count() == held.current().count() == 1
    held.stored_at -= 2000
    assert held.current().count() == 2 and len(loads) == 2
