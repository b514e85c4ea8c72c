import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.operators import golden as gold
from millrace.sources import readers, writers
from millrace.streaming import jobs, tables


@pytest.fixture
def folder(tmp_path):
    return lambda name: str(tmp_path / name)


def golden_frame(spark):
    rows = [("e1", "2025-01-01T00:00:00Z", "hl7", 1), ("e2", "2025-01-02T23:59:59Z", "fhir", 2), ("e3", "junk", "x12", 3)]
    return gold.partition_columns(spark.createDataFrame(rows, "event_id string, produced_at string, format string, value int"))


def test_partition_columns(spark):
    rows = golden_frame(spark).orderBy("event_id").collect()
    assert [r["event_date"] for r in rows] == [dt.date(2025, 1, 1), dt.date(2025, 1, 2), None]
    assert [r["format_partition"] for r in rows] == ["hl7", "fhir", "x12"]


def test_write_golden_counts_partitions_and_tags(spark, folder):
    path = folder("golden")
    observed = writers.write_golden(golden_frame(spark), path)
    assert observed.get == {"written_records": 3}
    back = spark.read.parquet(path)
    assert back.count() == 3 and back.schema["value"].metadata["pipeline_version"] == "1.0"
    plan = back.filter("event_date = DATE'2025-01-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    writers.write_golden(golden_frame(spark), path)
    assert spark.read.parquet(path).count() == 6


def test_writers_require_their_columns(spark, folder):
    df = spark.createDataFrame([(1,)], "value int")
    with pytest.raises(ValueError, match="event_date"):
        writers.write_golden(df, folder("x"))
    with pytest.raises(ValueError, match="error_reason"):
        writers.write_quarantine(df, folder("x"))


def test_quarantine_accepts_any_columns(spark, folder):
    df = spark.createDataFrame([("e1", None, {"a": "b"}, "bad")], "event_id string, format string, metadata map<string,string>, error_reason string")
    writers.write_quarantine(df, folder("q"))
    row = spark.read.json(folder("q")).first()
    assert row["event_id"] == "e1" and row["error_reason"] == "bad" and row["error_date"] is not None


def test_raw_zone_replaces_equal_keys_only(spark, folder):
    schema = "source_system string, event_type string, event_id string, transmission_timestamp string, v int"
    make = lambda rows: spark.createDataFrame(rows, schema)
    writers.write_raw_zone(make([("s", "t", "1", "a", 1), ("s", "t", "1", "b", 2), ("s", "t", "2", "a", 5), ("s", "u", "2", "a", 3)]), folder("raw"))
    writers.write_raw_zone(make([("s", "t", "1", "c", 9)]), folder("raw"))
    rows = writers.read_raw_zone(spark, folder("raw"), schema).collect()
    assert sorted((r["event_type"], r["event_id"], r["v"]) for r in rows) == [("t", "1", 9), ("t", "2", 5), ("u", "2", 3)]


DOC = '{"envelope":{"event_id":"%s","event_type":"ADT","source_system":"s","produced_at":"2025-01-01T00:00:00Z"},"canonical_event":{"event_id":"%s","format":"hl7"},"raw":"x","lineage":[{"name":"ingest","timestamp":"2025-01-01T00:00:00.123456789Z"}],"trace_id":"t","span_id":"p","transmission_timestamp":"2025-01-01T00:00:02Z","dispatched_at":"2025-01-01T00:00:03Z"}'


def write_text(path, name, text):
    path.mkdir(exist_ok=True)
    (path / name).write_text(text)


def test_document_scan_multi_line_and_corrupt(spark, tmp_path):
    write_text(tmp_path / "docs", "a.json", (DOC % ("1", "1")).replace(",", ",\n"))
    write_text(tmp_path / "docs", "b.json", "{broken")
    docs = readers.with_file_lineage(readers.read_documents(spark, str(tmp_path / "docs")))
    rows = {bool(r["_corrupt_record"]): r for r in docs.collect()}
    assert rows[True]["envelope"] is None and rows[False]["s3_uri"].endswith("a.json")
    flat = gold.flatten(docs.filter("_corrupt_record IS NULL"), F.lit("2025-01-02 00:00:00")).first()
    assert flat["ingest_timestamp"] == dt.datetime(2025, 1, 1, 0, 0, 0, 123456)
    assert flat["canonicalization_timestamp"] is None and flat["write_timestamp"] == dt.datetime(2025, 1, 1, 0, 0, 3)
    valid, invalid = gold.split_validity(docs)
    assert (valid.count(), invalid.count()) == (1, 1)


def test_empty_folder_gives_no_documents(spark, tmp_path):
    (tmp_path / "none").mkdir()
    assert readers.read_documents(spark, str(tmp_path / "none")).isEmpty()


def test_detection_rules_fall_back_to_the_defaults(spark, tmp_path):
    assert readers.read_detection_rules(spark, str(tmp_path / "missing.json")) == readers.DEFAULT_RULES
    (tmp_path / "bad.json").write_text("{oops")
    assert readers.read_detection_rules(spark, str(tmp_path / "bad.json")) == readers.DEFAULT_RULES
    (tmp_path / "good.json").write_text('{"rules":[{"name":"n","format":"f","prefix":"P"}]}')
    (rule,) = readers.read_detection_rules(spark, str(tmp_path / "good.json"))
    assert (rule.format, rule.prefix, rule.contains_key) == ("f", "P", None)


def test_key_value_rules(spark, tmp_path):
    (tmp_path / "kv.json").write_text(
        '{"Item":{"entity_type":{"S":"provider"},"entity_id":{"S":"P001"},"rule_type":{"S":"NPI_VALIDATION"},"compliance_flag":{"BOOL":true},"reason_code":{"S":"NPI_OK"},"source_format":{"S":"HL7"},"event_type":{"S":"ADT_A01"}}}\n')
    row = readers.read_key_value_rules(spark, str(tmp_path / "kv.json")).first()
    assert row["entity_id"] == "P001" and row["compliance_flag"] is True


def test_stream_ingest_takes_each_file_once(spark, tmp_path):
    source, at = tmp_path / "in", F.lit("2025-01-02 00:00:00")
    write_text(source, "a.json", DOC % ("1", "1"))
    write_text(source, "b.json", (DOC % ("2", "2")).replace('"format":"hl7"', '"format":null'))
    go = lambda: jobs.ingest(jobs.document_stream(spark, str(source), 1), str(tmp_path / "g"), str(tmp_path / "q"), str(tmp_path / "c"), at)
    go()
    go()
    assert spark.read.parquet(str(tmp_path / "g")).count() == 1
    write_text(source, "c.json", DOC % ("3", "3"))
    go()
    assert spark.read.parquet(str(tmp_path / "g")).count() == 2


def test_repeated_batch_replaces_its_own_files(spark, folder):
    write = tables.append_to(folder("t"))
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    write(df, 0)
    write(df, 0)
    write(df.withColumn("v", F.lit(5)), 1)
    assert spark.read.parquet(folder("t")).count() == 2
    assert [r["v"] for r in tables.latest_updates(spark, folder("t"), ["k"]).collect()] == [5]


def test_table_registration(spark, folder):
    writers.write_golden(golden_frame(spark), folder("golden"))
    readers.register_table(spark, "golden_events", folder("golden"), ("event_date", "format_partition"))
    assert spark.sql("SELECT count(*) FROM golden_events WHERE format_partition = 'hl7'").first()[0] == 1
    spark.sql("DROP TABLE golden_events")


def test_partial_counts_survive_repeats_late_rows_and_compaction(spark, tmp_path):
    source, table = str(tmp_path / "in"), str(tmp_path / "t")
    batches = [[("a", "2024-01-01 10:00:00"), ("b", "2024-01-01 10:01:00")], [("a", None), ("c", "2024-01-01 12:00:00")], [("b", "2024-01-01 09:59:00")]]
    go = lambda: jobs.count_windows(
        spark.readStream.schema("k string, at timestamp").option("maxFilesPerTrigger", 1).parquet(source), table, str(tmp_path / "c"), "at", "5 minutes", "k")
    read = lambda: {(r["k"], r["window_start"] and r["window_start"].strftime("%H:%M")): r["n"] for r in jobs.window_totals(spark, table, "k").collect()}
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, "k string, at string").select("k", F.col("at").cast("timestamp")).coalesce(1).write.mode("append").parquet(source)
        go()
        if k == 1:
            upto = tables.compact(spark, table, lambda parts: parts.groupBy("window_start", "k").agg(F.sum("n").alias("n")))
            assert upto == 1
    want = {("a", "10:00"): 1, ("b", "10:00"): 1, ("a", None): 1, ("c", "12:00"): 1, ("b", "09:55"): 1}
    assert read() == want
    last = spark.read.parquet(tables.batch_path(table, 2))
    tables.append_to(table)(spark.createDataFrame(last.collect(), last.schema), 2)      # the last batch runs again
    assert read() == want


def test_first_rows_ignore_their_own_failed_run(spark, tmp_path):
    source, table, bad = (str(tmp_path / x) for x in ("in", "t", "q"))
    frame = lambda rows: spark.createDataFrame(rows, "k string, v int").coalesce(1)
    frame([("a", 1), (None, 2)]).write.mode("append").parquet(source)
    frame([("b", 7)]).write.parquet(tables.batch_path(table, 1))                     # left by a run of batch 1 that failed
    for rows in ([("a", 3), ("b", 4)], [("b", 5), ("c", 6)]):
        stream = spark.readStream.schema("k string, v int").option("maxFilesPerTrigger", 1).parquet(source)
        jobs.first_rows(stream, table, bad, str(tmp_path / "c"), "k")
        frame(rows).write.mode("append").parquet(source)
    stream = spark.readStream.schema("k string, v int").option("maxFilesPerTrigger", 1).parquet(source)
    jobs.first_rows(stream, table, bad, str(tmp_path / "c"), "k")
    assert sorted((r["k"], r["v"]) for r in spark.read.parquet(table).collect()) == [("a", 1), ("b", 4), ("c", 6)]
    assert [r["v"] for r in spark.read.parquet(bad).collect()] == [2]
