"""Points in time windows by a grid of time blocks, as one equi-join.

Time is cut into blocks of 2^level microseconds, aligned at every level. A window takes the blocks it meets at the one
level that suits its length; a point carries the blocks it lies in, one for each level that any window uses, so windows
of like length cost a point one block. They meet in an equi-join on (level, block), at most once for a point and a
window, as a window's blocks are disjoint. A window's blocks are ``FINE`` halvings or one less below its length, so they
reach beyond it by less than one block on either side; an exact check of the edges settles what lies there.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

FINE = 2
BLOCKS = "array<struct<level:int,block:bigint>>"


def micros(at: Column) -> Column:
    """Microseconds since 1970; times without a zone are taken as they stand in the session's zone."""
    return F.unix_micros(at.cast("timestamp"))


def covering_blocks(start: Column, end: Column) -> Column:
    """The blocks (level, block) that cover the microseconds from ``start`` up to but not including ``end``; none if empty."""
    level = F.greatest(F.length(F.bin(end - start)) - F.lit(FINE), F.lit(0))
    first, last = F.call_function("shiftright", start, level), F.call_function("shiftright", end - 1, level)
    found = F.transform(F.sequence(first, last), lambda block: F.struct(level.alias("level"), block.alias("block")))
    return F.when(start < end, found).otherwise(F.array().cast(BLOCKS))


def blocks_at(at: Column, levels: Iterable[int]) -> Column:
    """The block of each of ``levels`` that a point in time lies in."""
    return F.array(*[F.struct(F.lit(k).alias("level"), F.call_function("shiftright", at, F.lit(k)).alias("block")) for k in levels]).cast(BLOCKS)
