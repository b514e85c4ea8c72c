"""Tables fed by streams, with files that survive a repeated micro-batch.

Each micro-batch writes below ``batch_id=N`` in overwrite mode. A batch that is
run again after a failure replaces its own files and nothing else.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from millrace.operators.epochs import REFRESH_SECONDS


def batch_path(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def run_available(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Process what has arrived so far, in micro-batches, then stop."""
    (
        stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).foreachBatch(each).start().awaitTermination())


def append_to(path: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batch_path(path, batch_id))

    return write


def merged(spark: SparkSession, path: str, merge: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The merged rows of a table of partial results: the last compacted state and the batches after it."""
    batches, done = spark.read.parquet(path), _generations(spark, path)
    if not done:
        return merge(batches.drop("batch_id"))
    state = spark.read.parquet(f"{path}-compact/upto={max(done)}")
    return merge(state.unionByName(batches.filter(F.col("batch_id") > max(done)).drop("batch_id")))


def compact(spark: SparkSession, path: str, merge: Callable[[DataFrame], DataFrame]) -> int:
    """Merges all batches so far into one state, which later reads start from; the folders of merged batches may then be
    removed by whoever owns retention. Returns the last batch merged."""
    upto = spark.read.parquet(path).agg(F.max("batch_id")).first()[0]
    merged(spark, path, merge).write.mode("overwrite").parquet(f"{path}-compact/upto={upto}")
    return upto


def _generations(spark: SparkSession, path: str) -> list[int]:
    """The batches up to which there is a compacted state that was written to its end."""
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{path}-compact/upto=*/_SUCCESS")
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern)
    return [int(f.getPath().getParent().getName().split("=")[1]) for f in found or ()]


def latest_updates(spark: SparkSession, path: str, key: Sequence[str], where: Column | None = None) -> DataFrame:
    """Current rows of a table written in update mode: the last batch wins per key."""
    rows = spark.read.parquet(path)
    rows = rows if where is None else rows.filter(where)
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("batch_id")))
    return rows.withColumn("_rank", rank).filter("_rank = 1").drop("_rank", "batch_id")


class Refreshed:
    """A table derived and stored once, and again when it is used after ``seconds`` have passed."""

    def __init__(self, spark: SparkSession, path: str, load: Callable[[], DataFrame], seconds: float = REFRESH_SECONDS):
        self.spark, self.path, self.load, self.seconds = spark, path, load, seconds
        self.times, self.stored_at, self.frame = 0, 0.0, None

    def current(self) -> DataFrame:
        if self.frame is None or time.monotonic() - self.stored_at >= self.seconds:
            rows = self.load()
            rows.write.mode("overwrite").parquet(f"{self.path}/refresh={self.times}")
            self.frame = self.spark.read.schema(rows.schema).parquet(f"{self.path}/refresh={self.times}")
            self.times, self.stored_at = self.times + 1, time.monotonic()
        return self.frame
