"""Rules as they were at a point in time.

Rules are read again every ``refresh`` seconds, so a change takes effect at the first refresh at or after it. Each
version of a rule thus holds from its refresh until the next version's. Events meet the versions of their key by
carrying the last one forward in time: both tables are put in one order per key, and a running maximum over the
versions' start gives each event the one that holds. The order is a segmented scan, so a key with a third of all events
is cut by time. A batch of a stream gives the same as a whole table, since nothing but the event's own time counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.operators import ordered
from millrace.operators.joins import HOT_ROWS, lookup_join

REFRESH_SECONDS = 300  # fixed value: how long rules are kept before they are read again
MILLION = 1_000_000


def next_refresh(at: Column, seconds: int = REFRESH_SECONDS) -> Column:
    """The first refresh at or after a time, in microseconds since 1970."""
    step = seconds * MILLION
    micros = F.unix_micros(at.cast("timestamp"))
    return micros + F.pmod(-micros, F.lit(step))


def versions(rules: DataFrame, key: Sequence[str], changed_at: str = "updated_at", seconds: int = REFRESH_SECONDS) -> DataFrame:
    """``rules`` with ``visible_from``; of several changes before one refresh the last counts, of equal ones the smallest id."""
    timed = rules.dropna(subset=[*key, changed_at]).withColumn("visible_from", next_refresh(F.col(changed_at), seconds))
    rank = F.row_number().over(Window.partitionBy(*key, "visible_from").orderBy(F.col(changed_at).desc(), F.col("id")))
    return timed.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def rules_at(events: DataFrame, of: DataFrame, key: Sequence[str], at: str, tie: str, columns: Sequence[str],
             hot_rows: int = HOT_ROWS) -> DataFrame:
    """``events`` with ``columns`` of the version (a row of ``versions``) that held at their time; null before the first.

    ``tie`` tells events of one key and time apart.
    """
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
    one_key = F.when(complete, F.struct(*key))
    event_type = events.select(F.struct("*").alias("_event")).schema["_event"].dataType
    changes = of.select(
        one_key.alias("_key"), F.col("visible_from").alias("_at"), F.lit(0).alias("_kind"), F.lit(None).cast(events.schema[tie].dataType).alias("_tie"),
        F.struct(F.col("visible_from").alias("_from"), *columns).alias("_rule"), F.lit(None).cast(event_type).alias("_event"))
    asked = events.select(
        one_key.alias("_key"), F.unix_micros(F.col(at).cast("timestamp")).alias("_at"), F.lit(1).alias("_kind"), F.col(tie).alias("_tie"),
        F.lit(None).cast(changes.schema["_rule"].dataType).alias("_rule"), F.struct("*").alias("_event"))
    seen = ordered.with_running_max(changes.unionByName(asked), "_key", ["_at", "_kind", "_tie"], "_rule", "_held", hot_rows)
    return seen.filter(F.col("_kind") == 1).select("_event.*", *[F.col("_held")[c].alias(c) for c in columns])


def versions_for(events: DataFrame, of: DataFrame, key: Sequence[str]) -> DataFrame:
    """The versions that a small batch of events can meet."""
    return lookup_join(of, events.select(*key).distinct(), key, "left_semi")
