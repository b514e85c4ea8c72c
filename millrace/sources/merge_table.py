"""Tables in which later rows of a key change earlier ones, without rewriting or shuffling the history.

A table is a base, unique by key, and the runs committed since. A commit writes its run to a folder of its own and then
publishes manifest N+1, a small file that names base and runs and can be created once only: a writer that dies before has
added nothing, and of two writers with the same number one takes the next. A reader follows the last complete manifest.

Reading scans the base in place. Only base rows whose key occurs in a run, with the runs themselves, are grouped and merged;
the others pass by a join with the runs' keys, broadcast up to ``BROADCAST_ROWS`` of them. ``compact`` folds the runs into a
new base; a commit does so by itself after ``MOST_RUNS`` runs or when their keys pass that size, so reads stay cheap. Folders
that no manifest names any more may be removed by whoever owns retention.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from millrace.operators.joins import BROADCAST_ROWS, fits, null_safe_join

MOST_RUNS = 8
BASE_RUN = -1


def last_row(key: Sequence[str], newest: Sequence[Column]) -> Callable[[DataFrame], DataFrame]:
    """A merge that keeps the newest row of a key as it is; of equal ones that of the later run."""
    def merge(rows: DataFrame) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*key).orderBy(*[c.desc() for c in newest], F.col("_run").desc()))
        return rows.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank", "_run")

    return merge


class MergeTable:
    """``merge`` makes of all rows of some keys, marked by ``_run`` (the base's is -1), one row per key without that mark."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: Sequence[str], merge: Callable[[DataFrame], DataFrame],
                 max_keys: int = BROADCAST_ROWS, most_runs: int = MOST_RUNS):
        self.spark, self.path, self.schema, self.key, self.merge = spark, path.rstrip("/"), schema, list(key), merge
        self.max_keys, self.most_runs = max_keys, most_runs
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._text = jvm.org.apache.commons.io.IOUtils

    # --- manifests ---

    def _read_manifest(self, number: int) -> dict | None:
        stream = self._fs.open(self._path(f"{self.path}/manifests/{number}"))
        try:
            return json.loads(self._text.toString(stream, "UTF-8"))
        except json.JSONDecodeError:                    # its writer has not closed it yet, or died
            return None
        finally:
            stream.close()

    def state(self) -> tuple[int, dict]:
        """The highest number taken, and the last complete manifest."""
        found = self._fs.globStatus(self._path(f"{self.path}/manifests/*")) or ()
        numbers = sorted((int(f.getPath().getName()) for f in found if f.getPath().getName().isdigit()), reverse=True)
        for number in numbers:
            manifest = self._read_manifest(number)
            if manifest is not None:
                return numbers[0], manifest
        return (numbers[0] if numbers else 0), {"base": None, "runs": []}

    def _publish(self, change: Callable[[dict], dict]) -> None:
        while True:
            number, manifest = self.state()
            try:
                out = self._fs.create(self._path(f"{self.path}/manifests/{number + 1}"), False)
            except Py4JJavaError as error:
                if "FileAlreadyExists" not in str(error):
                    raise
                continue                                # another writer took the number
            out.writeBytes(json.dumps(change(manifest)))
            out.close()
            return

    # --- rows ---

    def _store(self, rows: DataFrame, kind: str) -> str:
        name = f"{kind}/{uuid.uuid4().hex}"
        rows.select(*self.schema.names).write.parquet(f"{self.path}/{name}")
        return name

    def _stored(self, name: str) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{name}")

    def commit(self, rows: DataFrame) -> None:
        run = self._store(rows, "runs")
        self._publish(lambda m: {"base": m["base"], "runs": [*m["runs"], run]})
        runs = self.state()[1]["runs"]
        if len(runs) >= self.most_runs or not fits(self._keys(runs), self.max_keys):
            self.compact()

    def _keys(self, runs: Sequence[str]) -> DataFrame:
        return reduce(DataFrame.unionByName, [self._stored(r).select(*self.key) for r in runs]).distinct()

    def _merged(self, manifest: dict) -> DataFrame:
        if not manifest["runs"]:
            return self._stored(manifest["base"]) if manifest["base"] else self.spark.createDataFrame([], self.schema)
        marked = [self._stored(r).withColumn("_run", F.lit(k)) for k, r in enumerate(manifest["runs"])]
        rows = reduce(DataFrame.unionByName, marked)
        if not manifest["base"]:
            return self.merge(rows).select(*self.schema.names)
        base, keys = self._stored(manifest["base"]), self._keys(manifest["runs"])
        keys = F.broadcast(keys) if fits(keys, self.max_keys) else keys
        touched = null_safe_join(base, keys, self.key, "left_semi").withColumn("_run", F.lit(BASE_RUN))
        return null_safe_join(base, keys, self.key, "left_anti").unionByName(self.merge(touched.unionByName(rows)).select(*self.schema.names))

    def read(self) -> DataFrame:
        """The current rows, one per key."""
        return self._merged(self.state()[1])

    def compact(self) -> None:
        """Fold the runs there are into a new base; runs committed meanwhile stay runs."""
        manifest = self.state()[1]
        base = self._store(self._merged(manifest), "bases")
        folded = set(manifest["runs"])

        def switch(now: dict) -> dict:
            if now["base"] != manifest["base"]:         # someone else was faster; their base holds
                return now
            return {"base": base, "runs": [r for r in now["runs"] if r not in folded]}

        self._publish(switch)
