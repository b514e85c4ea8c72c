"""Strict JSON handling with built-in expressions.

Spark's JSON functions stop at the end of the first value and ignore what
follows. A document counts here only if the whole text is one JSON value.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

MAX_KEY_DEPTH = 10  # fixed value: objects nested deeper than this are not searched

_MARK = "\u0001"  # cannot occur in strict JSON


def strict_document(payload: Column) -> Column:
    """The parsed VARIANT, or NULL unless the whole text is exactly one JSON value.

    The text becomes the first element of an array whose second and last element is
    the hash of the text. Text that ends the array early or adds elements moves the
    hash away from there.
    """
    mark = F.xxhash64(payload)
    pair = F.try_parse_json(F.concat(F.lit("["), payload, F.lit(","), mark.cast("string"), F.lit("]")))
    return F.when(F.try_variant_get(pair, "$[1]", "bigint") == mark, F.try_variant_get(pair, "$[0]", "variant"))


def may_hold_keys(payload: Column) -> Column:
    """Cheap test before parsing: only objects and arrays can contain keys."""
    return F.left(F.ltrim(payload, F.lit(" \t\r\n")), F.lit(1)).isin("{", "[")


def is_object(payload: Column) -> Column:
    """For text already known to be strict JSON."""
    return F.startswith(F.ltrim(payload, F.lit(" \t\r\n")), F.lit("{"))


def json_part(document: Column, path: str) -> Column:
    return F.try_variant_get(document, path, "variant")


def json_string(document: Column, path: str) -> Column:
    """Value at the path if it is a JSON string, else NULL."""
    part = json_part(document, path)
    return F.when(F.schema_of_variant(part) == "STRING", part.cast("string"))


def as_text(part: Column) -> Column:
    """Any JSON value as text: strings bare, null and absent as '', the rest as JSON."""
    kind = F.schema_of_variant(part)
    return (
        F.when(part.isNull() | (kind == "VOID"), F.lit(""))
        .when(kind == "STRING", part.cast("string"))
        .otherwise(F.to_json(part))
    )


def key_count(document_text: Column) -> Column:
    """Number of top-level keys of a JSON object."""
    return F.size(F.json_object_keys(document_text))


def document_has_key(document: Column, payload: Column, key: str, max_depth: int = MAX_KEY_DEPTH) -> Column:
    """True if some object nested at most ``max_depth`` deep has the key.

    ``document`` is ``strict_document(payload)``. A top-level hit is read off the
    VARIANT. Otherwise the text is reduced to brackets and key marks; a fold over
    those gives the nesting of each mark. It runs only for texts that contain the
    key and more brackets than the allowed depth.
    """
    name = re.escape(key)
    text = F.when(F.contains(payload, F.lit("\\u")), F.to_json(document)).otherwise(payload)
    flat = F.replace(F.replace(text, F.lit("\\\\"), F.lit("??")), F.lit('\\"'), F.lit("?"))
    key_pattern = f'"{name}"[ \\t\\r\\n]*:'
    marks = F.regexp_replace(
        F.regexp_replace(flat, key_pattern, _MARK), f'"[^"]*"|[^\\[\\]{{}}{_MARK}]', "")
    opened = F.length(F.regexp_replace(marks, r"[^\[{]", ""))
    shallow = F.aggregate(
        F.split(marks, ""),
        F.struct(F.lit(0).alias("level"), F.lit(False).alias("hit")),
        lambda acc, c: F.struct(
            (acc["level"] + F.when(c.isin("{", "["), 1).when(c.isin("}", "]"), -1).otherwise(0)).alias("level"),
            (acc["hit"] | ((c == _MARK) & (acc["level"] <= max_depth + 1))).alias("hit")),
        lambda acc: acc["hit"])
    top_level = F.try_variant_get(document, f"$['{key}']", "variant").isNotNull()
    return (
        F.when(document.isNull(), F.lit(False))
        .when(top_level, F.lit(True))
        .when(~flat.rlike(key_pattern), F.lit(False))
        .when(opened <= max_depth + 1, F.lit(True))
        .otherwise(shallow)
    )


def json_has_key(payload: Column, key: str, max_depth: int = MAX_KEY_DEPTH) -> Column:
    document = F.when(may_hold_keys(payload), strict_document(payload))
    return F.coalesce(document_has_key(document, payload, key, max_depth), F.lit(False))
