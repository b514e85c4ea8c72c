"""Masking expressions: hash, tokenise, redact, remove."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

REDACTED = "***"
_MARK = "\ue000"  # a private character
_NUMBER = re.compile(f'"{_MARK}([^"{_MARK}]*){_MARK}"')


def hash_value(value: Column, salt: str) -> Column:
    return F.sha2(F.concat(F.lit(salt), value), 256)


def redact(value: Column) -> Column:
    return F.when(value.isNotNull(), F.lit(REDACTED))


def redact_when(condition: Column, value: Column) -> Column:
    return F.when(condition & value.isNotNull(), F.lit(REDACTED)).otherwise(value)


def _masked(text: str, keys: frozenset[str], lab_codes: frozenset[str]) -> str | None:
    """The JSON text with masked values, None unless it is one JSON value nested no deeper than the parser allows."""
    def members(pairs):
        out = dict(pairs)
        hidden = [k for k in out if k in keys]
        if isinstance(out.get("lab_code"), str) and out["lab_code"] in lab_codes:
            hidden.append("lab_value")
        return out | {k: REDACTED for k in hidden if out.get(k) is not None}

    try:
        # Fractions are carried as marked text, so that they are written as they were read.
        plain = _MARK in text or "\\ue000" in text.lower()
        value = json.loads(text, object_pairs_hook=members, parse_float=None if plain else lambda x: f"{_MARK}{x}{_MARK}")
        out = json.dumps(value, ensure_ascii=False, separators=(",", ":"))
    except (ValueError, RecursionError):
        return None
    return out if plain else _NUMBER.sub(r"\1", out)


def mask_json(document: Column, keys: tuple[str, ...] = (), lab_codes: tuple[str, ...] = ()) -> Column:
    """JSON text in which the values of the named keys, at any depth and of any kind, are redacted, and ``lab_value`` next
    to a ``lab_code`` of the given ones. Null values stay null. Text that is not JSON becomes null: callers send such rows
    to quarantine instead of passing them on unmasked. No built-in function changes a value inside JSON, hence the Arrow
    batches."""
    named, codes = frozenset(keys), frozenset(lab_codes)

    @F.pandas_udf("string")
    def masked(text: pd.Series) -> pd.Series:
        return text.map(lambda t: None if t is None else _masked(t, named, codes))

    return masked(document)


def mask_obx(message: Column, codes: tuple[str, ...]) -> Column:
    """HL7 text in which the values (field 5) of OBX segments with one of the codes are redacted."""
    field, names = r"[^|\r\n]*", "|".join(re.escape(c) for c in codes)
    pattern = rf"((?:^|[\r\n])\s*OBX\|{field}\|{field}\|(?:{names})(?:\^{field})?\|{field}\|){field}"
    return F.regexp_replace(message, pattern, f"$1{REDACTED}")


def remove(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)
