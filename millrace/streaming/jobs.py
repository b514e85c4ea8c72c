"""Streaming jobs: arrival, late rows, deduplication, metrics, lifecycle, enrichment."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace import schemas
from millrace.operators import golden as gold
from millrace.plans import views
from millrace.sources import writers
from millrace.streaming.keys import GENERATIONS, KeyHistory
from millrace.streaming.tables import append_to, batch_path, compact, merged, run_available

def document_stream(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Stored documents as they arrive, each file once."""
    return spark.readStream.schema(schemas.RAW_DOCUMENT).option("maxFilesPerTrigger", max_files).json(path)


def ingest(stream: DataFrame, golden_path: str, quarantine_path: str, checkpoint: str, processed_at: Column | None = None) -> None:
    """Arriving documents to golden Parquet and quarantine JSON.

    The batch is kept for its two writes; lost blocks are simply read again.
    """
    at = processed_at if processed_at is not None else F.current_timestamp()

    def each(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        valid, invalid = gold.split_validity(kept)
        writers.write_golden(gold.flatten(valid, at), batch_path(golden_path, batch_id), mode="overwrite")
        writers.write_quarantine(invalid, batch_path(quarantine_path, batch_id), mode="overwrite")
        kept.unpersist()

    run_available(stream, checkpoint, each)


def late_rows(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Report late rows before any watermark could drop them."""
    run_available(views.late_arrivals(stream), checkpoint, append_to(path))


def count_windows(stream: DataFrame, path: str, checkpoint: str, at: str, size: str, *keys: str) -> None:
    """Tumbling counts, one partial result per micro-batch; ``window_totals`` adds them up.

    A row counts in its window however late it comes, as no watermark drops it. Rows without a time count under a null
    window. Nothing is kept in state.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        window = F.window(F.col(at).cast("timestamp"), size)["start"]
        # Grouping by the window itself would drop rows without a time.
        timed = batch.filter(F.col(at).isNotNull()).groupBy(window.alias("window_start"), *keys).agg(F.count("*").alias("n"))
        untimed = batch.filter(F.col(at).isNull()).groupBy(*keys).agg(F.count("*").alias("n")).select(
            F.lit(None).cast("timestamp").alias("window_start"), *keys, "n")
        timed.unionByName(untimed).write.mode("overwrite").parquet(batch_path(path, batch_id))

    run_available(stream, checkpoint, each)


def window_totals(spark: SparkSession, path: str, *keys: str) -> DataFrame:
    return merged(spark, path, lambda parts: parts.groupBy("window_start", *keys).agg(F.sum("n").alias("n")))


def first_rows(stream: DataFrame, path: str, quarantine: str, checkpoint: str, key: str, generations: int = GENERATIONS) -> None:
    """First row per key over all micro-batches; repeats may come at any time. Rows without a key go to quarantine.

    Keys of earlier batches are found through a history in hash buckets behind Bloom filters (``<path>-keys``), so a
    batch opens only what may hold its keys, however long the history. A batch run again replaces its own files.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        history = KeyHistory(batch.sparkSession, f"{path}-keys", key)
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        fresh = kept.filter(F.col(key).isNotNull()).dropDuplicates([key])
        fresh = fresh.join(history.known(fresh.select(key), batch_id), key, "left_anti").select(*batch.columns)
        fresh.write.mode("overwrite").parquet(batch_path(path, batch_id))
        kept.filter(F.col(key).isNull()).write.mode("overwrite").parquet(batch_path(quarantine, batch_id))
        kept.unpersist()
        history.release()
        history.add(batch.sparkSession.read.schema(batch.schema).parquet(batch_path(path, batch_id)), batch_id)
        if len(history.generations()) >= generations:
            history.compact()

    run_available(stream, checkpoint, each)


def replay_spikes(counts: DataFrame) -> DataFrame:
    """Deliveries beyond the first per window, from counts per event and window.

    The first delivery of an event lies in its earliest window. Deliveries without a time are all replays of a timed
    one, or else all but one are; they are reported under a null window.
    """
    first = counts.groupBy("event_id").agg(F.min("window_start").alias("window_start")).groupBy("window_start").agg(
        F.count("*").alias("firsts"))
    total = counts.groupBy("window_start").agg(F.sum("n").alias("deliveries"))
    joined = total.join(first.withColumnRenamed("window_start", "first_start"), F.col("window_start").eqNullSafe(F.col("first_start")), "left")
    replays = F.col("deliveries") - F.coalesce("firsts", F.lit(0))
    return joined.select("window_start", replays.alias("replays")).filter("replays > 0")


def follow_lifecycles(stream: DataFrame, path: str, checkpoint: str, key: str, at: str, state: str, tie: str) -> None:
    """Partial lifecycle per key and micro-batch; ``lifecycles`` merges them. Nothing is kept in state."""
    def each(batch: DataFrame, batch_id: int) -> None:
        batch.groupBy(key).agg(
            F.max(F.struct(F.col(at).alias("at"), F.col(tie).alias("tie"), F.col(state).alias("state"))).alias("last"), F.count("*").alias("steps"),
            F.min(at).alias("first_at")).write.mode("overwrite").parquet(batch_path(path, batch_id))

    run_available(stream, checkpoint, each)


def _merge_lifecycles(key: str) -> Callable[[DataFrame], DataFrame]:
    return lambda parts: parts.groupBy(key).agg(F.max("last").alias("last"), F.sum("steps").alias("steps"), F.min("first_at").alias("first_at"))


def lifecycles(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Current state, step count and time span per key."""
    return merged(spark, path, _merge_lifecycles(key)).select(key, "last.state", "steps", "first_at", F.col("last.at").alias("last_at"))


def compact_lifecycles(spark: SparkSession, path: str, key: str) -> None:
    compact(spark, path, _merge_lifecycles(key))


def enrich_batches(stream: DataFrame, path: str, quarantine: str, checkpoint: str, canonical: Callable[[DataFrame], DataFrame],
                   enrich: Callable[[DataFrame], DataFrame]) -> None:
    """Apply ``canonical`` to the stream and ``enrich`` to each micro-batch: accepted events to ``path``, rejected ones to quarantine.

    ``canonical`` is a projection, so the stream itself carries it and its large plan is analysed once, not per batch.

    ``enrich`` decides how old its rules may be, for instance by a ``Refreshed`` lookup.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        events = batch.persist(StorageLevel.MEMORY_AND_DISK)
        enrich(events.filter("error_reason IS NULL")).write.mode("overwrite").parquet(batch_path(path, batch_id))
        events.filter("error_reason IS NOT NULL").write.mode("overwrite").parquet(batch_path(quarantine, batch_id))
        events.unpersist()

    run_available(canonical(stream), checkpoint, each)
