import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import compliance, dedup, governance as gov, ingest, ordered, replay
from millrace.operators.joins import fits, lookup_join, spread_join
from millrace.operators.percentiles import exact_percentiles

T0 = dt.datetime(2024, 1, 1)


def hot_rows(spark, n=3000):
    """One key holds a third of all rows."""
    rng = random.Random(7)
    rows = [("hot" if rng.random() < 0.33 else f"k{rng.randrange(200)}", i, T0 + dt.timedelta(seconds=rng.randrange(40_000))) for i in range(n)]
    return rows, spark.createDataFrame(rows, "key string, n int, at timestamp_ntz")


def test_fits(spark):
    assert fits(spark.range(10), 10) and not fits(spark.range(11), 10)


@pytest.mark.parametrize("how", ["left", "inner", "left_anti"])
def test_salted_lookup_equals_broadcast(spark, how):
    _, df = hot_rows(spark)
    lookup = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("zzz", 4)], "key string, x int")
    a = lookup_join(df, lookup, ["key"], how)
    b = lookup_join(df, lookup, ["key"], how, salt=["n"], max_rows=0, slices=5)
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)
    plan = b._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(key" in plan and "_slice" in plan


def test_copies_of_a_large_lookup_are_not_broadcast(spark):
    """Their size is estimated by that of the lookup's files, far below what 16 copies take in memory."""
    lookup = spark.range(1000).select(F.col("id").alias("key"), F.lit(1).alias("x"))
    rows = spark.range(5000).select((F.col("id") % 1200).alias("key"))
    for how, n in (("left", 5000), ("inner", 4200), ("left_semi", 4200), ("left_anti", 800)):
        out = lookup_join(rows, lookup, ["key"], how, max_rows=999)
        assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
        assert out.count() == n


def test_spread_join_splits_hot_keys_and_keeps_all_rows(spark):
    rows, df = hot_rows(spark)
    counts = df.groupBy("key").agg(F.count("*").alias("c"))
    out = spread_join(df, counts, ["key"], "c", ["n"], hot_rows=100).collect()
    sizes = {}
    for key, *_ in rows:
        sizes[key] = sizes.get(key, 0) + 1
    assert len(out) == len(rows) and all(r["c"] == sizes[r["key"]] for r in out)


def test_spread_join_splits_exact_copies(spark):
    copies = spark.range(0, 4000, 1, 16).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).alias("key"), F.lit(1).alias("n"))
    counts = copies.groupBy("key").agg(F.count("*").alias("c"))
    out = spread_join(copies, counts, ["key"], "c", ["n"], hot_rows=500)
    got = {(r["key"], r["c"]): r["count"] for r in out.groupBy("key", "c").count().collect()}
    assert got == {("hot", 2666): 2666, (None, 1334): 1334}
    from millrace.operators.joins import _slice_of

    slices = copies.filter("key = 'hot'").select(_slice_of(["n"], F.lit(6)).alias("s")).distinct().count()
    assert slices > 2


def test_null_keys_and_times_are_kept(spark):
    rows = [(None, 1, T0), (None, 2, T0 + dt.timedelta(hours=2)), ("a", 3, None), ("a", 4, T0)]
    df = spark.createDataFrame(rows, "key string, n int, at timestamp_ntz")
    out = {r["n"]: (r["seq"], r["before"]) for r in ordered.with_neighbours(df, "key", ["at", "n"], {"before": "n"}, sequence="seq").collect()}
    assert out == {1: (1, None), 2: (2, 1), 3: (1, None), 4: (2, 3)}
    top = {r["n"]: r["top"] for r in ordered.with_running_max(df, "key", ["at", "n"], "n", "top").collect()}
    assert top == {1: None, 2: 1, 3: None, 4: 3}
    (low,) = exact_percentiles(df.filter("key IS NULL"), ["key"], "n", {"p50": 0.5}, 1.0).collect()
    assert (low["p50"], low["n"]) == (1.5, 2)


def test_repeated_deliveries_and_first_delivery(spark):
    rows = [("a", 1, T0), ("a", 2, T0), ("b", 3, T0), ("a", 4, T0 + dt.timedelta(hours=1))]
    df = spark.createDataFrame(rows, "event_id string, n int, at timestamp_ntz")
    again = dedup.repeated_deliveries(df, "event_id", ["n"]).collect()
    assert sorted((r["n"], r["replay_count"]) for r in again) == [(1, 3), (2, 3), (4, 3)]
    first = dedup.first_delivery(df, ["event_id"], ["at", "n"])
    assert sorted(r["n"] for r in first.collect()) == [1, 3]
    assert dedup.first_delivery(first, ["event_id"], ["at", "n"]).count() == 2


def test_dedup_cuts_keys_before_the_shuffle(spark):
    _, df = hot_rows(spark)
    plan = dedup.first_delivery(df, ["key"], ["at", "n"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_neighbours_across_slices(spark):
    rows, df = hot_rows(spark)
    out = ordered.with_neighbours(df, "key", ["at", "n"], {"before": "n"}, {"after": "n"}, "seq")
    got = {r["n"]: (r["seq"], r["before"], r["after"]) for r in out.collect()}
    by_key = {}
    for key, n, at in rows:
        by_key.setdefault(key, []).append((at, n))
    for items in by_key.values():
        order = [n for _, n in sorted(items)]
        for i, n in enumerate(order):
            assert got[n] == (i + 1, order[i - 1] if i else None, order[i + 1] if i + 1 < len(order) else None)


def test_running_max_across_slices(spark):
    rows, df = hot_rows(spark)
    df = df.withColumn("v", F.pmod(F.col("n") * 7919, F.lit(1000)))
    got = {r["n"]: r["top"] for r in ordered.with_running_max(df, "key", ["at", "n"], "v", "top").collect()}
    by_key = {}
    for key, n, at in rows:
        by_key.setdefault(key, []).append((at, n))
    for items in by_key.values():
        top = None
        for _, n in sorted(items):
            assert got[n] == top
            top = max(top if top is not None else -1, n * 7919 % 1000)


@pytest.mark.parametrize("width", [0.5, 10.0, 1e6])
def test_percentiles_equal_numpy(spark, width):
    rng = np.random.default_rng(3)
    values = {"hot": rng.exponential(50, 2000), "one": np.array([4.0]), "same": np.full(50, 7.0), "neg": rng.normal(0, 5, 333)}
    rows = [(g, float(v)) for g, vs in values.items() for v in vs] + [("hot", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    out = exact_percentiles(df, ["g"], "v", {"p50": 0.5, "p95": 0.95, "p99": 0.99, "p0": 0.0, "p100": 1.0}, width)
    for r in out.collect():
        expected = np.percentile(values[r["g"]], [50, 95, 99, 0, 100])
        assert np.allclose([r["p50"], r["p95"], r["p99"], r["p0"], r["p100"]], expected)
        assert r["n"] == len(values[r["g"]])


# --- compliance ---------------------------------------------------------------------

RULE_TYPES = "id string, entity_type string, entity_id string, rule_type string, compliance_flag boolean, reason_code string, source_format string, event_type string, created_at timestamp_ntz, updated_at timestamp_ntz"
# One clinic's rules: id -> (entity, key, rule type, flag, reason, format, event type).
CLINIC = {
    "id-check": ("patient", "K-4410", "identity_confirmed", True, None, "hl7", "ADT"),
    "consent": ("patient", "K-5000", "consent_on_file", False, "NO_CONSENT", "fhir", "Patient"),
    # Three sources disagree about one visit at the same time; the lowest id settles it.
    "visit-b": ("encounter", "V-902", "visit_open", False, "CLOSED", "hl7", "ADT"),
    "visit-a": ("encounter", "V-902", "visit_billed", True, None, "x12", "837"),
    "visit-c": ("encounter", "V-902", "visit_coded", True, None, "fhir", "Encounter"),
    "policy": ("member", "Q-20-55", "policy_active", True, None, "json", "generic"),
}


def clinic_rules(spark):
    return spark.createDataFrame([(i, *r, T0, T0) for i, r in CLINIC.items()], RULE_TYPES)


def events(spark, rows):
    return spark.createDataFrame(
        rows, "event_id string, format string, event_type string, entity_type string, entity_id string, error_reason string")


def test_enrich_hit_miss_and_rejected(spark):
    df = events(spark, [("hit", "hl7", "ADT", "patient", "K-4410", None), ("tie", "fhir", "x", "encounter", "V-902", None),
                        ("miss", "x12", "837", "patient", "K-1", None), ("bad", "x12", "837", None, None, "missing_identifiers"),
                        ("no", "fhir", "Patient", "patient", "K-5000", None)])
    out = {r["event_id"]: r for r in compliance.enrich(df, clinic_rules(spark)).collect()}
    assert set(out) == {"hit", "tie", "miss", "no"}
    assert out["hit"]["compliance_flag"] and out["hit"]["compliance_reason"] == "" and out["hit"]["compliance_rule_id"] == "id-check"
    assert out["tie"]["compliance_rule_id"] == "visit-a"
    assert not out["miss"]["compliance_flag"] and out["miss"]["compliance_reason"] == "FALLBACK_DEFAULT"
    assert out["miss"]["compliance_applied"] and out["miss"]["compliance_rule_id"] == ""
    assert (out["no"]["compliance_flag"], out["no"]["compliance_reason"]) == (False, "NO_CONSENT")


def test_later_rule_wins_over_lower_id(spark):
    newer = clinic_rules(spark).filter("id = 'visit-c'").withColumn("updated_at", F.lit("2024-03-01 00:00:00").cast("timestamp_ntz"))
    rules = clinic_rules(spark).filter("id <> 'visit-c'").unionByName(newer)
    df = events(spark, [("v", "hl7", "ADT", "encounter", "V-902", None)])
    assert compliance.enrich(df, rules).first()["compliance_rule_id"] == "visit-c"


def test_enrich_match_format_and_aliases(spark):
    df = events(spark, [("b", "hl7", "ADT", "encounter", "V-902", None), ("m", "generic", "generic", "patient", "Q-20-55", None)])
    rules = compliance.with_entity_aliases(clinic_rules(spark), {"member": "patient"})
    out = {r["event_id"]: r["compliance_rule_type"] for r in compliance.enrich(df, rules, match_format=True).collect()}
    assert out == {"b": "visit_open", "m": "policy_active"}


def test_first_store_wins(spark):
    rules = clinic_rules(spark)
    blank = rules.filter("id = 'id-check'").withColumns({"id": F.lit(""), "rule_type": F.lit(""), "compliance_flag": F.lit(False)})
    other = rules.filter("id = 'consent'").withColumn("id", F.lit("consent-cached"))
    out = {r["entity_id"]: (r["store"], r["id"]) for r in
           compliance.first_store_wins([("cache", blank.unionByName(other)), ("primary", rules)]).filter("entity_type = 'patient'").collect()}
    assert out == {"K-4410": ("primary", "id-check"), "K-5000": ("cache", "consent-cached")}


def test_upsert_keeps_identity_and_is_idempotent(spark):
    base = clinic_rules(spark)
    at = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    change = base.filter("id = 'consent'").withColumns({
        "id": F.lit("new"), "compliance_flag": F.lit(True), "reason_code": F.lit(None).cast("string"), "updated_at": at, "created_at": at})
    merged = compliance.upsert_rules(base, change)
    row = merged.filter("entity_id = 'K-5000'").first()
    assert merged.count() == len(CLINIC) and row["id"] == "consent" and row["compliance_flag"] and row["reason_code"] is None
    assert row["created_at"] == T0 and row["updated_at"] == dt.datetime(2024, 2, 1)
    again = compliance.upsert_rules(merged, change)
    assert sorted(map(str, again.collect())) == sorted(map(str, merged.collect()))
    assert compliance.unique_violations(base).count() == 0
    assert compliance.unique_violations(base.unionByName(change)).first()["copies"] == 2


# --- ingest -------------------------------------------------------------------------

ENVELOPE = '"envelope":{"event_id":"1","event_type":"t","source_system":"s","produced_at":"2025-01-01T12:00:00Z"}'
BODIES = {
    "{" + ENVELOPE + ',"payload":{"a":1}}': (202, "accepted"),
    "{" + ENVELOPE + ',"payload":null}': (202, "accepted"),
    "{" + ENVELOPE + "}": (400, "payload_error"),
    "{broken": (400, "json_error"),
    "[1]": (400, "json_error"),
    '{"payload":{}}': (422, "envelope_error"),
    '{"envelope":null,"payload":{}}': (422, "envelope_error"),
    "{" + ENVELOPE.replace("2025-01-01T12:00:00Z", "2025-01-01") + ',"payload":{}}': (422, "envelope_error"),
    "{" + ENVELOPE.replace('"event_id":"1"', '"event_id":1') + ',"payload":{}}': (422, "envelope_error"),
    "{" + ENVELOPE.replace('"event_id":"1"', '"event_id":""') + ',"payload":{}}': (422, "validation_error"),
    "{" + ENVELOPE.replace("2025-01-01T", "0001-01-01T").replace("T12:", "T00:") + ',"payload":{}}': (422, "validation_error"),
}


def test_request_outcomes(spark):
    df = spark.createDataFrame([(i, b) for i, b in enumerate(BODIES)], "i int, body string")
    rows = ingest.classify_requests(ingest.decode_requests(df)).drop("produced_at").orderBy("i").collect()
    assert [(r["status"], r["reason"]) for r in rows] == list(BODIES.values())
    assert rows[9]["invalid_fields"] == ["envelope.event_id"]
    assert rows[10]["invalid_fields"] == ["envelope.produced_at (empty)"]


def test_all_invalid_fields_are_collected(spark):
    body = '{"envelope":{"produced_at":"2025-01-01T12:00:00Z"},"payload":{}}'
    row = ingest.classify_requests(ingest.decode_requests(spark.createDataFrame([(body,)], "body string"))).first()
    assert row["invalid_fields"] == ["envelope.event_id", "envelope.event_type", "envelope.source_system"]


def test_string_payload_keeps_its_quoting(spark):
    body = "{" + ENVELOPE + ',"payload":"MSH|^~\\\\&|A\\rPID"}'
    row = ingest.decode_requests(spark.createDataFrame([(body,)], "body string")).first()
    assert row["payload"] == '"MSH|^~\\\\&|A\\rPID"'


# --- governance ---------------------------------------------------------------------


def test_naming_and_uuid_patterns(one):
    names = {"ward.bed.assigned": True, "WardBedAssigned": False, "ward-bed-assigned": False, "ward.bed": False, "w.b.a.x": False}
    assert one(list(names), lambda c: c.rlike(gov.EVENT_TYPE)) == list(names.values())
    ids = {"0b7de9a4-58c1-4f02-8d3e-6a1f9c20b755": True, "0b7de9a4-58c1-3f02-8d3e-6a1f9c20b755": False, "0b7de9a4": False}
    assert one(list(ids), lambda c: c.rlike(gov.UUID_V4)) == list(ids.values())


def test_retention_and_tiers(spark):
    rows = [("phi", None, "7y"), ("pii", "6y", "7y"), ("internal", None, "3y"), ("public", None, "90d"), ("public", "1y", "1y"), ("secret", None, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, c string, d string, want string")
    assert all(r["got"] == r["want"] for r in df.withColumn("got", gov.retention(F.col("c"), F.col("d"))).collect())
    tiers = spark.createDataFrame([("2024-01-01", "90d"), ("2024-01-01", "7y"), ("2024-05-01", "90d"), ("2017-01-01", "7y")], "p string, r string")
    got = [r[0] for r in tiers.select(gov.archive_tier(F.col("p").cast("date"), F.col("r"), F.lit("2024-05-10").cast("date"))).collect()]
    assert got == ["expired", "archive", "active", "expired"]


def test_transitions(one):
    pairs = {"REQUESTED>APPROVED": True, "REQUESTED>REJECTED": True, "REJECTED>APPROVED": False, "COMPLETED>EXECUTING": False}
    split = lambda c: replay.is_transition(F.split_part(c, F.lit(">"), F.lit(1)), F.split_part(c, F.lit(">"), F.lit(2)), replay.REQUEST_TRANSITIONS)
    assert one(list(pairs), split) == list(pairs.values())
