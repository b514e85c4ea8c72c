"""Tokens in place of values: lasting, distinct and reversible.

The vault is a merge table of (value, token) in which the first token committed for a value holds. A run gives tokens to
the values that have none, each task out of a range of its own, so nothing is numbered across the whole table; tokens
carry the run's mark, so runs at the same time never hand out one token twice. After its commit a run reads what the
vault says: where another run was first, its token is taken. Values meet the vault by joins; rows are not collected.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from millrace.operators.joins import BROADCAST_ROWS, lookup_join
from millrace.sources.merge_table import MergeTable

ENTRY = StructType([StructField("value", StringType()), StructField("token", StringType())])


def first_token(rows: DataFrame) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("value").orderBy("_run", "token"))
    return rows.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank", "_run")


class TokenVault:
    def __init__(self, spark: SparkSession, path: str, max_rows: int = BROADCAST_ROWS):
        self.table = MergeTable(spark, path, ENTRY, ["value"], first_token)
        self.max_rows = max_rows

    def admit(self, values: DataFrame) -> None:
        """Give tokens to the values (first column, as text) that have none; null has no token."""
        wanted = values.select(F.col(values.columns[0]).cast("string").alias("value")).filter("value IS NOT NULL").distinct()
        fresh = wanted.join(self.table.read(), "value", "left_anti")
        number = F.lower(F.hex(F.monotonically_increasing_id()))       # the task's range, and the place within it
        token = F.concat(F.lit(f"tok-{uuid.uuid4().hex[:12]}-"), number)
        self.table.commit(fresh.withColumn("token", token))

    def tokenise(self, rows: DataFrame, column: str, into: str = "token", salt: tuple[str, ...] = ()) -> DataFrame:
        """``rows`` with the token of ``column``; values that are new get theirs first."""
        self.admit(rows.select(column))
        tokens = self.table.read().select(F.col("value").alias("_value"), F.col("token").alias(into))
        keyed = rows.withColumn("_value", F.col(column).cast("string"))
        return lookup_join(keyed, tokens, ["_value"], "left", salt, self.max_rows).select(*rows.columns, into)

    def restore(self, rows: DataFrame, column: str, into: str, salt: tuple[str, ...] = ()) -> DataFrame:
        """``rows`` with the value behind the token in ``column``; null where it is no token of the vault."""
        values = self.table.read().select(F.col("token").alias(column), F.col("value").alias(into))
        return lookup_join(rows, values, [column], "left", salt, self.max_rows).select(*rows.columns, into)
