"""Writes that report what they wrote, and a catalogue kept up to date by these reports.

A report comes from the write itself: rows and partitions are observed while rows pass, the time is taken around the
job, and its files carry a tag in their names, by which their bytes are summed. Only the folders of partitions that were
written are listed, each once. ``register_written`` adds just those partitions, and columns that the table lacks; no
footer is read and no folder of older data is listed, however large the table.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the folder of rows without a partition value


@dataclass(frozen=True)
class WriteReport:
    """What one write added. ``partitions`` holds one tuple of values (as in folder names) per partition."""

    rows: int
    bytes: int
    files: int
    seconds: float
    partitions: tuple[tuple[str | None, ...], ...]


def _folder(spark: SparkSession, path: str, columns: Sequence[str], values: Sequence[str | None]) -> str:
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    parts = [f"{escape(c)}={DEFAULT_PARTITION if v is None or v == '' else escape(v)}" for c, v in zip(columns, values)]
    return "/".join([path.rstrip("/"), *parts])


def _tagged_files(spark: SparkSession, folder: str, tag: str) -> list[int]:
    """Sizes of the files in a folder whose names begin with the tag."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [f.getLen() for f in fs.listStatus(where) if f.getPath().getName().startswith(tag)] if fs.exists(where) else []


def observed_write(df: DataFrame, path: str, partitions: Sequence[str], mode: str = "append", format: str = "parquet") -> WriteReport:
    """Write ``df`` rebalanced and partitioned by ``partitions``, and report it.

    A write makes a folder per partition in any case, so the set of partitions it observes is bounded by its layout.
    """
    spark, tag, seen = df.sparkSession, f"w{uuid.uuid4().hex}", Observation()
    values = F.struct(*[F.col(c).cast("string").alias(f"p{k}") for k, c in enumerate(partitions)])
    watched = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.collect_set(values).alias("partitions"))
    started = time.perf_counter()
    (watched.hint("rebalance", *[f"`{c}`" for c in partitions]).write.mode(mode).format(format).partitionBy(*partitions)
     .option("mapreduce.output.basename", tag).save(path))
    seconds = time.perf_counter() - started
    found = tuple(sorted((tuple(r) for r in seen.get["partitions"]), key=str))
    sizes = [n for p in found for n in _tagged_files(spark, _folder(spark, path, partitions, p), tag)]
    return WriteReport(seen.get["rows"], sum(sizes), len(sizes), seconds, found)


def _literal(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_written(spark: SparkSession, name: str, path: str, schema: StructType, partitions: Sequence[str], report: WriteReport) -> None:
    """Make a table over ``path`` show what a write added: its partitions, and its columns if they are new."""
    columns = lambda fields: ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    quoted = [f"`{c}`" for c in partitions]
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE {name} ({columns(schema)}) USING parquet PARTITIONED BY ({', '.join(quoted)}) LOCATION '{path}'")
    else:
        known = {c.name for c in spark.catalog.listColumns(name)}
        added = [f for f in schema if f.name not in known]
        if added:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns(added)})")
    if report.partitions:
        specs = " ".join("PARTITION (" + ", ".join(f"{c} = {_literal(v)}" for c, v in zip(quoted, p)) + ")" for p in report.partitions)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {specs}")
        spark.catalog.refreshTable(name)


def counters(spark: SparkSession, reports: dict[str, WriteReport]) -> DataFrame:
    """One row per target of a job: records, files, bytes, seconds and partitions written."""
    return spark.createDataFrame(
        [(target, r.rows, r.files, r.bytes, r.seconds, len(r.partitions)) for target, r in reports.items()],
        "target string, written_records long, files long, bytes_written long, write_seconds double, partitions long")
