"""Lineage arrays: ARRAY<STRUCT<name STRING, timestamp TIMESTAMP>>."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Stage names in processing order.
STAGES = ("ingest", "normalized", "canonicalized", "compliance", "written")


def build_lineage(**stage_times: Column) -> Column:
    """Array of the stages whose time is not NULL."""
    return F.array_compact(F.array(*[
        F.when(ts.isNotNull(), F.struct(F.lit(name).alias("name"), ts.alias("timestamp")))
        for name, ts in stage_times.items()]))


def stage_time(lineage: Column, name: str) -> Column:
    """Time of the first entry with that name, NULL if there is none."""
    return F.get(F.filter(lineage, lambda s: s["name"] == name), F.lit(0))["timestamp"]


def has_stage(lineage: Column, name: str) -> Column:
    return F.exists(lineage, lambda s: s["name"] == name)


def append_stage(lineage: Column, name: str, at: Column) -> Column:
    return F.array_append(lineage, F.struct(F.lit(name).alias("name"), at.alias("timestamp")))


def missing_stages(lineage: Column, expected: tuple[str, ...] = STAGES) -> Column:
    return F.array_except(
        F.array(*[F.lit(s) for s in expected]), F.transform(lineage, lambda s: s["name"]))
