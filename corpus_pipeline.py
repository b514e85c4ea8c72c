"""The training-data pipeline: toxic documents out, near copies out, benchmark passages out, secrets masked, then tokens.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return the columns of
``documents``.

Defined results: a null text is an empty one to every stage and stays null where a stage changes nothing; a null id is
never rejected, nor linked to other documents; repeated rows of one id are judged alike; other columns are carried along;
an empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from millrace.llm import bpe, decontaminate, near_dedup, secrets, toxicity
from millrace.llm.common import stored, table
from millrace.llm.queries import tokenizer_path

ORACLE_SQL = None


# Up to so many rejected ids (8 bytes each) are broadcast; more of them meet the documents in a shuffle.
BROADCAST_ROWS = 500_000


def _without(docs: DataFrame, rejected: DataFrame, label: str) -> DataFrame:
    """``docs`` but for those with an id in ``rejected``."""
    rejected = stored(rejected.select("doc_id").where("doc_id is not null").distinct(), label)
    few = rejected.count() <= BROADCAST_ROWS
    return docs.join(F.broadcast(rejected) if few else rejected, "doc_id", "left_anti").select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    graded = toxicity.grade_documents(docs, table(spark, sf_dir, "labels"))
    return _without(docs, graded.where("rejected"), "toxic")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    one_each = _without(docs, near_dedup.classes(docs, size=5, num=8, den=10).where("not kept"), "copies")
    if docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1).count():
        # An id stands for one document; only equal rows of it go, as the others hold texts of their own.
        one_each = one_each.where("doc_id is null").union(one_each.where("doc_id is not null").dropDuplicates(["doc_id", "text"]))
    return one_each


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, found.where("size(spans) > 0"), "contaminated")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    @pandas_udf("string")
    def masked(text):
        return text.map(lambda t: None if t is None else secrets.redacted(t))

    out = docs.withColumn("text", masked("text"))
    if "n_chars" in docs.columns:
        n_chars = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(n_chars))
    return out.select(*docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs, tokenizer_path()).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), "ids",
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic), ("near copies", drop_near_copies), ("contamination", drop_contaminated),
    ("secrets", mask_secrets), ("tokens", encode_tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, "pipeline-" + name.replace(" ", "-"))
    return docs
