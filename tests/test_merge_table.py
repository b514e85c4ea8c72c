"""Merge tables: commits, half commits, compaction and readers against a dictionary."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from millrace.session import work_dir
from millrace.sources.merge_table import MergeTable, last_row

SCHEMA = StructType([StructField("k", StringType()), StructField("v", IntegerType()), StructField("n", IntegerType())])


def table(spark, **options):
    return MergeTable(spark, work_dir(spark, "merge"), SCHEMA, ["k"], last_row(["k"], [F.col("n")]), **options)


def rows_of(t):
    return sorted(((r["k"], r["v"]) for r in t.read().collect()), key=str)


@pytest.mark.parametrize("options", [{}, {"max_keys": 0}, {"most_runs": 3}])
def test_reads_equal_a_dictionary(spark, options):
    rng, t, held = random.Random(1), table(spark, **options), {}
    assert rows_of(t) == []
    for n in range(5):
        run = [(rng.choice([None, *"abcdef"]), rng.randrange(100), n) for _ in range(4)]
        run = list({k: (k, v, n) for k, v, n in run}.values())
        t.commit(spark.createDataFrame(run, SCHEMA))
        held |= {k: v for k, v, _ in run}
        if n == 2:
            t.compact()
        assert rows_of(t) == sorted(held.items(), key=str)
    assert len(t.state()[1]["runs"]) < 5


def test_older_rows_do_not_replace_newer_ones(spark):
    t = table(spark)
    t.commit(spark.createDataFrame([("a", 1, 9), ("b", 1, 1)], SCHEMA))
    t.compact()
    t.commit(spark.createDataFrame([("a", 2, 3), ("b", 2, 1)], SCHEMA))
    assert rows_of(t) == [("a", 1), ("b", 2)]


def test_half_commits_do_not_show(spark):
    t = table(spark)
    t.commit(spark.createDataFrame([("a", 1, 1)], SCHEMA))
    spark.createDataFrame([("a", 2, 2)], SCHEMA).write.parquet(f"{t.path}/runs/dead")            # died before its manifest
    t._fs.create(t._path(f"{t.path}/manifests/2"), False).close()                                 # died within it
    assert rows_of(t) == [("a", 1)]
    t.commit(spark.createDataFrame([("b", 3, 3)], SCHEMA))
    assert rows_of(t) == [("a", 1), ("b", 3)]


def test_a_commit_during_compaction_is_kept(spark):
    t = table(spark)
    t.commit(spark.createDataFrame([("a", 1, 1)], SCHEMA))
    store = t._store

    def slow(rows, kind):
        name = store(rows, kind)
        if kind == "bases":
            t._store = store
            t.commit(spark.createDataFrame([("b", 2, 2)], SCHEMA))
        return name

    t._store = slow
    t.compact()
    assert rows_of(t) == [("a", 1), ("b", 2)] and len(t.state()[1]["runs"]) == 1


def test_the_base_is_not_shuffled(spark):
    t = table(spark)
    t.commit(spark.range(1000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"), F.lit(1).alias("n")))
    t.compact()
    t.commit(spark.createDataFrame([("5", 2, 2)], SCHEMA))
    plan = t.read()._jdf.queryExecution().toString()
    base = plan[plan.index("Union", plan.index("== Physical Plan ==")):]
    assert "BroadcastHashJoin" in base.split("FileScan")[0] and "Exchange hashpartitioning" not in base.split("FileScan")[0]
