"""Joins that stay safe when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

BROADCAST_ROWS = 200_000  # a lookup is broadcast only after counting no more rows than this
BROADCAST_BYTES = 64 << 20  # and no more bytes than this
SLICES = 16               # pieces a key is split into when the lookup is too large for that
HOT_ROWS = 1_000_000      # keys with more rows than this are split into pieces of this size
HOT_PAIRS = 1 << 24       # so are keys that lead to more pairs of rows than this
BUCKETS = 1 << 16         # of keys, in which rows are counted to find those
HOT_BUCKETS = 1000        # if more buckets than this are hot, all keys are split


def _row_bytes(df: DataFrame) -> Column:
    """About what a row takes: the bytes of texts, 8 for each number or time, nested values by their text."""
    def size(field) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (StringType, BinaryType)):
            return F.coalesce(F.octet_length(column), F.lit(0)).cast("long")
        if isinstance(field.dataType, (StructType, ArrayType, MapType)):
            return F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)).cast("long")
        return F.lit(8).cast("long")

    return reduce(lambda a, b: a + b, [size(f) for f in df.schema])


def fits(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True if the table has at most ``max_rows`` rows and ``max_bytes`` bytes, by one aggregate over its partitions."""
    found = df.agg(F.count("*").alias("rows"), F.sum(_row_bytes(df)).alias("bytes")).first()
    return found["rows"] <= max_rows and (found["bytes"] or 0) <= max_bytes


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on columns of equal names where NULL equals NULL, as in GROUP BY and PARTITION BY."""
    renamed = right.select(*[F.col(c).alias(f"_right_{c}" if c in on else c) for c in right.columns])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in on])
    return left.join(renamed, same, how).drop(*[f"_right_{c}" for c in on])


def _slice_of(salt: Sequence[str], slices: Column) -> Column:
    """Slice of a row. The partition number separates exact copies of a row, which
    agree in all columns, and stays the same when a task is run again."""
    return F.pmod(F.xxhash64(F.spark_partition_id(), *salt), slices).cast("int")


def lookup_join(rows: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "left",
                salt: Sequence[str] = (), max_rows: int = BROADCAST_ROWS, slices: int = SLICES) -> DataFrame:
    """Equi-join a large table with a lookup table.

    The lookup is counted first, in rows and bytes. Up to ``max_rows`` it is broadcast and the large
    table is not shuffled. Beyond, both sides are shuffled on the key plus a slice
    number taken from the ``salt`` columns, so no key lands in a single task. Spark's size
    estimate does not see that ``explode`` copies the lookup, nor how well its files were
    compressed, so the copies are marked for a merge join: they must not be broadcast by it.
    """
    on = list(on)
    if fits(lookup, max_rows):
        return rows.join(F.broadcast(lookup), on, how)
    sliced = rows.withColumn("_slice", _slice_of(salt or on, F.lit(slices)))
    copies = lookup.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    return sliced.join(copies.hint("merge"), [*on, "_slice"], how).drop("_slice")


def pair_join(rows: DataFrame, lookup: DataFrame, on: Sequence[str], salt: Sequence[str], max_rows: int = BROADCAST_ROWS,
              slices: int = SLICES, hot_rows: int = HOT_ROWS, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """Inner equi-join of two large tables, in which a key may have many rows on both sides.

    As ``lookup_join``, but only keys that need it are split, so the lookup is not copied for the others. Rows are
    counted on both sides by buckets of keys; a bucket with too many rows or pairs is hot, and its keys are split.
    """
    on = list(on)
    if fits(lookup, max_rows):
        return rows.join(F.broadcast(lookup), on)
    bucket = F.pmod(F.xxhash64(*on), F.lit(BUCKETS))
    count = lambda df, name: df.dropna(subset=on).groupBy(bucket.alias("_bucket")).agg(F.count("*").alias(name))
    found = count(rows, "_rows").join(count(lookup, "_copies"), "_bucket").filter(
        (F.col("_rows") > hot_rows) | (F.col("_rows") * F.col("_copies") > hot_pairs)).select("_bucket").limit(HOT_BUCKETS + 1).collect()
    if not found:
        return rows.join(lookup.hint("merge"), on)
    hot = F.lit(True) if len(found) > HOT_BUCKETS else bucket.isin([r[0] for r in found])
    sliced = rows.withColumn("_slice", F.when(hot, _slice_of(salt, F.lit(slices))).otherwise(0))
    copies = lookup.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.when(hot, slices - 1).otherwise(0))))
    return sliced.join(copies.hint("merge"), [*on, "_slice"]).drop("_slice")


def spread_join(rows: DataFrame, per_key: DataFrame, on: Sequence[str], weight: str,
                salt: Sequence[str], how: str = "inner", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Join rows back to a per-key aggregate that knows each key's row count.

    Keys above ``hot_rows`` are split into pieces of about that size. There are at
    most total rows / ``hot_rows`` such keys, which bounds the broadcast list.
    """
    on = list(on)
    pieces = F.ceil(F.col(weight) / hot_rows).cast("int")
    hot = per_key.filter(F.col(weight) > hot_rows).select(*on, pieces.alias("_pieces"))
    sliced = null_safe_join(rows, F.broadcast(hot), on, "left").withColumn(
        "_slice", _slice_of(salt, F.coalesce("_pieces", F.lit(1)))).drop("_pieces")
    copies = per_key.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.greatest(pieces, F.lit(1)) - 1)))
    return null_safe_join(sliced, copies, [*on, "_slice"], how).drop("_slice")
