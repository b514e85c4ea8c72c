"""Lifecycles followed with keyed state: transitions as they happen, corrected when rows come late, and overdue states.

State holds a key's recent timeline. Every arriving row is put in its place by time; a row is reported with the state
before it, and again if a late row has come between. Later reports replace earlier ones (``transitions``), so after any
order of arrival they equal the ordered batch plan. State is bounded by ``horizon``: rows further behind the newest one
leave, but for the last of them, and rows that would belong before it are reported as late instead of judged. ``watch``
runs on and sets a timer per key in an unfinished state, which reports it as overdue once nothing has come for the
deadline; ``follow`` takes what has arrived and stops, without timers, which would keep it going.

No watermark is set, as Spark would drop the rows behind it. Reports of a micro-batch that is run again replace their own.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from millrace.streaming.tables import append_to, latest_updates, run_available

TIMELINE = "at array<long>, tie array<long>, state array<string>"
REPORT = "key string, kind string, tie long, at timestamp, state string, previous_state string, valid boolean"
TRANSITION, LATE, OVERDUE = "transition", "late", "overdue"
DAY_MS = 86_400_000


class LifecycleProcessor(StatefulProcessor):
    def __init__(self, allowed: set[tuple[str, str]], finished: set[str], deadline_ms: int | None, horizon_ms: int):
        self.allowed, self.finished, self.deadline_ms, self.horizon_us = allowed, finished, deadline_ms, horizon_ms * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.timeline = handle.getValueState("timeline", TIMELINE)

    def _report(self, key, kind: str, place: tuple, state: str, before: str | None) -> Row:
        import datetime as dt

        at = dt.datetime.fromtimestamp(place[0] // 1_000_000, dt.timezone.utc).replace(microsecond=place[0] % 1_000_000)
        valid = before is None or (before, state) in self.allowed
        return Row(key=key[0], kind=kind, tie=place[1], at=at, state=state, previous_state=before, valid=valid)

    def _stored(self) -> dict[tuple[int, int], str]:
        found = self.timeline.get() if self.timeline.exists() else None
        return dict(zip(zip(found[0], found[1]), found[2])) if found else {}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self._stored()
        old = sorted(held)
        before_of = dict(zip(old[1:], old))
        floor = old[0] if old else None
        for row in rows:
            place = (row["at_us"], row["tie"])
            if floor is not None and place < floor and self._cut(old):
                yield self._report(key, LATE, place, row["state"], None)
            else:
                held[place] = row["state"]
        new = sorted(held)
        for k, place in enumerate(new):
            before = new[k - 1] if k else None
            if (place not in before_of and not (old and place == old[0] and before is None)) or (place in before_of and before_of[place] != before):
                yield self._report(key, TRANSITION, place, held[place], None if before is None else held[before])
        keep = [p for p in new if p[0] >= new[-1][0] - self.horizon_us] if new else []
        if len(keep) < len(new):
            keep = [new[len(new) - len(keep) - 1], *keep]          # the last row behind the horizon stands before the others
        if keep:
            self.timeline.update(tuple(list(x) for x in (*zip(*keep), [held[p] for p in keep])))
        if keep and self.deadline_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer if isinstance(timer, int) else timer[0])
            if held[keep[-1]] not in self.finished:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.deadline_ms)

    def _cut(self, old: list) -> bool:
        """Whether the first row held may have had others before it: it lies behind the horizon."""
        return old[0][0] < old[-1][0] - self.horizon_us

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self._stored()
        if held:
            last = max(held)
            yield self._report(key, OVERDUE, last, held[last], None)

    def close(self) -> None:
        pass


def _reports(stream: DataFrame, key: str, at: str, state: str, tie: str, processor: LifecycleProcessor, mode: str) -> DataFrame:
    rows = stream.select(
        F.col(key).cast("string").alias("key"), F.unix_micros(F.col(at).cast("timestamp")).alias("at_us"),
        F.col(tie).cast("long").alias("tie"), F.col(state).alias("state"))
    return rows.groupBy("key").transformWithState(processor, REPORT, "Update", mode)


def follow(stream: DataFrame, path: str, checkpoint: str, key: str, at: str, state: str, tie: str, allowed,
           horizon_ms: int = 30 * DAY_MS) -> None:
    """Process what has arrived and append reports below ``path``. ``allowed``: pairs of states that may follow one another."""
    processor = LifecycleProcessor(set(allowed), set(), None, horizon_ms)
    run_available(_reports(stream, key, at, state, tie, processor, "none"), checkpoint, append_to(path), "update")


def watch(stream: DataFrame, path: str, checkpoint: str, key: str, at: str, state: str, tie: str, allowed, finished,
          deadline_ms: int = DAY_MS, horizon_ms: int = 30 * DAY_MS, every: str = "1 minute") -> StreamingQuery:
    """As ``follow``, but running until it is stopped, with overdue states reported; ``finished`` states are never overdue."""
    processor = LifecycleProcessor(set(allowed), set(finished), deadline_ms, horizon_ms)
    reports = _reports(stream, key, at, state, tie, processor, "processingTime")
    return (reports.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(processingTime=every)
            .foreachBatch(append_to(path)).start())


def transitions(spark: SparkSession, path: str) -> DataFrame:
    """The last report of each row: key, tie, at, state, previous_state, valid."""
    return latest_updates(spark, path, ["key", "tie"], F.col("kind") == TRANSITION).drop("kind")


def alerts(spark: SparkSession, path: str) -> DataFrame:
    """Everything reported as late or overdue, and the invalid transitions that still stand."""
    found = spark.read.parquet(path).filter(F.col("kind") != TRANSITION).select("key", "kind", "tie", "at", "state", "previous_state")
    return found.unionByName(transitions(spark, path).filter("NOT valid").select(
        "key", F.lit("invalid").alias("kind"), "tie", "at", "state", "previous_state"))
