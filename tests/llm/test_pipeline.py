"""The pipeline against a plain version of each stage, the queries against DuckDB, and odd rows through all stages."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_duplicates import brute_components
from test_text_operators import WORD, library_ids, lowered

import corpus_pipeline
from millrace.llm import secrets, toxicity
from millrace.llm.common import keyed, stored
from millrace.llm.queries import ORACLES, QUERIES
from workload.compare import duck, rows_of_duck, rows_of_spark

SF = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"


def contaminated(text, items):
    words = WORD.findall(lowered(text))
    for _, body in items:
        own = WORD.findall(lowered(body))
        n = min(10, len(own))
        windows = {tuple(own[k:k + n]) for k in range(len(own) - n + 1)} if n else set()
        if any(tuple(words[k:k + n]) in windows for k in range(len(words) - n + 1)):
            return True
    return False


def test_pipeline_equals_plain_stages(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{LARGER}/benchmark.parquet").select("item_id", "text").collect()]
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    model = toxicity.fit(keyed(docs), labels)
    rejected = {r["doc_id"] for r in toxicity.severity(docs, model).where("rejected").collect()}
    toxic = {r["doc_id"] for r in labels.where("toxic = 1").collect()}
    assert rejected & toxic and len(rejected - toxic) < 0.1 * len(text)
    left = [(i, t) for i, t in sorted(text.items()) if i not in rejected]
    component = brute_components(left, 5, 8, 10)
    left = [(i, t) for i, t in left if component[i] == i]
    left = [(i, t) for i, t in left if not contaminated(t, items)]
    want = {}
    for i, t in left:
        out, at = [], 0
        for kind, a, b in secrets.find(t):
            out += [t[at:a], f"<{kind}>"] if a >= at else []
            at = max(at, b)
        ids = library_ids(["".join(out) + t[at:]])[0]
        want[i] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"]) for r in corpus_pipeline.run(spark, LARGER).collect()}
    assert got == want


def test_odd_rows_pass_every_stage(spark):
    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(0, None), (1, ""), (2, text), (3, text), (3, text), (None, text), (5, "password: abcdefgh12 ñ"), (6, "y" * 50_000)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, "x", 2) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, spans string, kept int")
    columns = docs.columns
    for table in (docs, docs.limit(0)):
        out = table
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stored(stage(spark, out, SF), "odd")
            assert k == len(corpus_pipeline.STAGES) - 1 or out.columns == columns
            if k == 3 and table is docs:
                kept = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
                assert kept == sorted([(0, None), (1, ""), (2, text), (None, text), (5, "<assign> ñ"), (6, "y" * 50_000)], key=str)
                assert out.where("doc_id = 5").first()["n_chars"] == len("<assign> ñ")
        assert out.count() == (6 if table is docs else 0)


def test_tokens_are_decoded_again(spark):
    texts = ["plain words", "Ñandú 🙂\n\ttabs  and blanks ", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["decoded_sha256"] for r in corpus_pipeline.encode_tokens(spark, docs, SF).collect()}
    assert got == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in enumerate(texts)}


def test_stages_are_the_five_in_order():
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["drop_toxic", "drop_near_copies", "drop_contaminated", "mask_secrets", "encode_tokens"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    assert rows_of_spark(QUERIES[name](spark, SF)) == rows_of_duck(duck(SF), ORACLES[name])


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_work_folder_is_the_shared_one(spark):
    df = stored(spark.range(3).withColumn("x", F.lit(1)), "probe")
    assert spark.conf.get("spark.checkpoint.dir").removeprefix("file:") + "/probe-" in df.inputFiles()[0]
