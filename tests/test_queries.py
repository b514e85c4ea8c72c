"""Every registered query against its SQL on the smallest tables."""

import pathlib

import pytest

import __spark_entry__ as entry
from workload.compare import duck, rows_of_duck, rows_of_spark
from workload.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(SF_DIR).exists(), reason="no test tables")

MASKS = ("mask_lab_messages", "mask_payload_keys")  # values inside JSON can only be changed in Arrow batches


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and ("PythonUDF" not in plan or name in MASKS)
    if name != "rule_catalogue_match":  # patterns against the distinct event types
        assert "NestedLoopJoin" not in plan
    columns, rows = rows_of_spark(df)
    want_columns, want = rows_of_duck(con, ORACLES[name])
    assert columns == want_columns
    assert rows == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
