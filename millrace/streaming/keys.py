"""A history of keys in hash buckets, each batch of it behind Bloom filters.

A generation holds the keys of some consecutive micro-batches: ``from=F/upto=U`` below ``keys`` and ``filters``, both cut
into ``buckets`` by the key's hash. Within a bucket, filters are blocks of 2^15 bits; a generation has as many blocks as
its keys need at ``BITS`` bits a key, and a key sets ``PROBES`` bits of one block. A batch reads the filter blocks of its
own buckets, and opens a generation's bucket of keys only where a filter says that it may hold one of its keys; the keys
read there decide, so a filter's mistakes cost a look and nothing else.

Folders are complete when Spark has marked them so. A batch that is run again replaces its own generation and looks at
earlier ones only. ``compact`` folds generations into one with filters of its size; generations inside another are no
longer read and may be removed by whoever owns retention.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BITS = 10
PROBES = 4
BLOCK_BITS = 1 << 15        # what one bitmap of Spark's holds
BUCKETS = 16
GENERATIONS = 16            # so many are folded into one


def _hash(key: str, seed: int) -> Column:
    return F.xxhash64(F.col(key), F.lit(seed))


def _probe(key: str, number: int) -> Column:
    first, step = (F.pmod(_hash(key, seed), F.lit(BLOCK_BITS)) for seed in (1, 2))
    return F.pmod(first + F.lit(number) * step, F.lit(BLOCK_BITS)).cast("long")


def _bit(bitmap: Column, place: Column) -> Column:
    """Whether a bit of a bitmap is set."""
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.pmod(F.call_function("shiftright", byte, F.pmod(place, F.lit(8)).cast("int")), F.lit(2)) == 1


class KeyHistory:
    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.buckets = spark, path, key, buckets
        self._held: DataFrame | None = None

    def generations(self, before: int | None = None) -> list[tuple[int, int, int]]:
        """(from, upto, blocks) of the generations in use: complete, and not inside another one."""
        jvm = self.spark.sparkContext._jvm
        pattern = jvm.org.apache.hadoop.fs.Path(f"{self.path}/filters/from=*/upto=*/blocks=*/_SUCCESS")
        files = pattern.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern) or ()
        found = [tuple(map(int, re.findall(r"=(\d+)/", f.getPath().toString()[-80:].partition("/filters/")[2]))) for f in files]
        found = [g for g in found if before is None or g[1] < before]
        return sorted(g for g in found if not any(o[0] <= g[0] and g[1] <= o[1] and o[:2] != g[:2] for o in found))

    def _folder(self, kind: str, generation: tuple[int, int, int]) -> str:
        return f"{self.path}/{kind}/from={generation[0]}/upto={generation[1]}/blocks={generation[2]}"

    def _write(self, keys: DataFrame, first: int, last: int) -> None:
        """One generation from its distinct keys; the filters come last, and complete it."""
        bucket = F.pmod(_hash(self.key, 3), F.lit(self.buckets)).cast("int")
        count = keys.count()
        blocks = 1
        while blocks * self.buckets * BLOCK_BITS < count * BITS:
            blocks *= 2
        generation = (first, last, blocks)
        rows = keys.select(self.key, bucket.alias("bucket"))
        rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(self._folder("keys", generation))
        stored = self.spark.read.schema(rows.schema).parquet(self._folder("keys", generation)) if count else rows
        places = F.array(*[_probe(self.key, k) for k in range(PROBES)])
        bits = stored.select("bucket", F.pmod(_hash(self.key, 4), F.lit(blocks)).cast("int").alias("block"), F.explode(places).alias("place"))
        filters = bits.groupBy("bucket", "block").agg(F.bitmap_construct_agg("place").alias("bitmap"))
        filters.write.mode("overwrite").partitionBy("bucket").parquet(self._folder("filters", generation))

    def add(self, keys: DataFrame, batch_id: int) -> None:
        """The keys (distinct, not null) that a batch brought."""
        self._write(keys.select(self.key), batch_id, batch_id)

    def candidates(self, keys: DataFrame, batch_id: int) -> DataFrame:
        """(key, from, upto, bucket): where a key may be stored, by the filters of earlier batches."""
        generations = self.generations(batch_id)
        places = F.array(*[F.struct(*[F.lit(x).alias(n) for n, x in zip(("from", "upto", "blocks"), g)]) for g in generations]).cast(
            "array<struct<from:int,upto:int,blocks:int>>")
        bucket = F.pmod(_hash(self.key, 3), F.lit(self.buckets)).cast("int").alias("bucket")
        placed = keys.select(self.key, bucket, F.inline(places)).withColumn("block", F.pmod(_hash(self.key, 4), F.col("blocks")).cast("int"))
        if not generations:
            return placed.select(self.key, "from", "upto", "bucket")
        wanted = [r[0] for r in keys.select(bucket).distinct().collect()]       # at most one per bucket
        filters = self.spark.read.schema("block int, bitmap binary, from int, upto int, blocks int, bucket int").option(
            "basePath", f"{self.path}/filters").parquet(*[self._folder("filters", g) for g in generations]).where(F.col("bucket").isin(wanted))
        probed = placed.join(filters, ["from", "upto", "blocks", "bucket", "block"])
        for k in range(PROBES):
            probed = probed.filter(_bit(F.col("bitmap"), _probe(self.key, k)))
        return probed.select(self.key, "from", "upto", "bucket")

    def known(self, keys: DataFrame, batch_id: int) -> DataFrame:
        """Those of ``keys`` that an earlier batch brought, by the stored keys of the buckets that may hold them."""
        schema = keys.select(self.key).schema
        generations = self.generations(batch_id)
        if not generations:
            return self.spark.createDataFrame([], schema)
        candidates = self._held = self.candidates(keys, batch_id).persist(StorageLevel.MEMORY_AND_DISK)
        opened = {tuple(r) for r in candidates.select("from", "upto", "bucket").distinct().collect()}      # at most generations x buckets
        paths = [f"{self._folder('keys', g)}/bucket={b}" for g in generations for b in range(self.buckets) if (*g[:2], b) in opened]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths).join(candidates.select(self.key), self.key, "left_semi")

    def release(self) -> None:
        """Give back what ``known`` keeps until its result has been used."""
        if self._held is not None:
            self._held.unpersist()
            self._held = None

    def _holds_keys(self, generation: tuple[int, int, int]) -> bool:
        filters = self.spark.read.schema("block int, bucket int").parquet(self._folder("filters", generation))
        return filters.limit(1).count() > 0

    def compact(self) -> None:
        """Fold all generations into one."""
        old = self.generations()
        if len(old) > 1:
            stored = [self.spark.read.parquet(f"{self._folder('keys', g)}").select(self.key) for g in old if self._holds_keys(g)]
            if stored:
                self._write(reduce(DataFrame.unionByName, stored), old[0][0], old[-1][1])
