"""Patterns as join keys against regular expressions on every pair; grants against a loop."""

import re

import pytest
from pyspark.sql import functions as F

from millrace.operators import governance, patterns

TYPES = ["claims.adjudication.completed", "claims.adjudication.failed", "claims.intake.created", "member.enrollment.updated", "claimsx.a.b", "Odd", "a.b", "", None]
FORMS = {  # pattern: the key it has (None: another form)
    "*": "", ".*": "", "^.*$": "", r"^claims\..*": "claims.", r"^claims\.adjudication\..*": "claims.adjudication.", "claims.*": "claims.",
    "claims.adjudication.*": "claims.adjudication.", r"^claims\.intake\.created$": "claims.intake.created=", "claims.intake.created": "claims.intake.created=",
    "Odd": None, "Od": None, r"^claims.*": None, r".*\.updated$": None, r"(claims|member)\..*": None, r"claims\.intake": None, r"^a\.b$": "a.b="}


def meaning(pattern, kind):
    """The expression that a pattern stands for; plain forms name segments."""
    if kind is None or "\\" in pattern or pattern.startswith("^"):
        return re.compile(pattern) if pattern != "*" else re.compile("")
    return re.compile("" if pattern in ("*", ".*") else "^" + re.escape(pattern[:-1]) if pattern.endswith(".*") else "^" + re.escape(pattern) + "$")


def test_keys_of_patterns(spark):
    rows = spark.createDataFrame([(p,) for p in FORMS], "p string").select("p", patterns.pattern_key(F.col("p")).alias("k")).collect()
    assert {r["p"]: r["k"] for r in rows} == FORMS


@pytest.mark.parametrize("free", [True, False])
def test_matches_equal_expressions_on_every_pair(spark, free):
    forms = {p: k for p, k in FORMS.items() if free or k is not None}
    events = spark.createDataFrame([(n, t, str(n)) for n, t in enumerate(TYPES)], "n int, event_type string, event_id string")
    catalogue = spark.createDataFrame([(p,) for p in forms], "event_pattern string")
    found = [(r["n"], r["event_pattern"]) for r in patterns.match(events, catalogue, ["event_id"]).collect()]
    expected = {(n, p) for n, t in enumerate(TYPES) for p, k in forms.items()
                if (t is not None or k == "") and meaning(p, k).search(t or "")}
    assert len(found) == len(set(found)) and set(found) == expected


def test_a_consumer_sees_an_event_once(spark):
    acl = [("c", "t", "x", "internal"), ("c", "t", "*", "internal"), ("c", "t", "*", "phi"), ("d", "t", "x", "phi"), ("d", "t", "x", "phi")]
    events = [(1, "t", "x", "internal"), (2, "t", "y", "internal"), (3, "t", "x", "phi"), (4, "u", "x", "internal"), (5, "t", "*", "internal")]
    found = governance.consumer_view(
        spark.createDataFrame([(n, t, e, c, str(n)) for n, t, e, c in events], "n int, tenant_id string, event_type string, data_classification string, event_id string"),
        spark.createDataFrame(acl, "consumer string, tenant_id string, event_type string, data_classification string"))
    assert sorted((r["consumer"], r["n"]) for r in found.collect()) == [("c", 1), ("c", 2), ("c", 5), ("d", 3)]
