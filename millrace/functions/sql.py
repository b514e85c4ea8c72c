"""Functions for SQL text."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import SparkSession, functions as F
from pyspark.sql.types import BooleanType

from millrace.functions.jsonx import MAX_KEY_DEPTH


def _reject_constant(name: str):
    raise ValueError(name)


def _has_key(text: str | None, key: str) -> bool:
    """Search level by level, objects nested at most MAX_KEY_DEPTH deep."""
    try:
        level = [json.loads(text or "", parse_constant=_reject_constant)]
    except (ValueError, RecursionError):
        return False
    for _ in range(MAX_KEY_DEPTH + 1):
        objects = [node for node in level if isinstance(node, dict)]
        if any(key in node for node in objects):
            return True
        level = [v for node in objects for v in node.values()] + [v for node in level if isinstance(node, list) for v in node]
    return False


def json_has_key(text: pd.Series, key: pd.Series) -> pd.Series:
    return pd.Series([_has_key(t, k) for t, k in zip(text, key)])


def register_functions(spark: SparkSession) -> None:
    """json_has_key(text, key) for SQL, where the key may differ per row.

    DataFrame code with a fixed key uses the built-in form in ``jsonx`` instead.
    """
    spark.udf.register("json_has_key", F.pandas_udf(json_has_key, BooleanType()))
