"""Format detection by ordered rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.jsonx import document_has_key, may_hold_keys, strict_document
from millrace.functions.once import once

DEFAULT_FORMAT = "generic"


@dataclass(frozen=True)
class DetectionRule:
    name: str
    format: str
    prefix: str | None = None
    contains_key: str | None = None


# Default rules, first match wins.
DEFAULT_RULES = (
    DetectionRule("hl7_msh_prefix", "hl7", prefix="MSH|"),
    DetectionRule("x12_isa_prefix", "x12", prefix="ISA*"),
    DetectionRule("fhir_resource_type", "fhir", contains_key="resourceType"),
)


def with_document(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Add ``document``: the strict JSON VARIANT of object or array texts."""
    text = F.col(payload)
    return once(df, {"document": F.when(may_hold_keys(text), strict_document(text))})


def format_column(payload: Column, document: Column, rules=DEFAULT_RULES) -> Column:
    chain = F
    for rule in rules:
        if rule.prefix:
            chain = chain.when(F.startswith(payload, F.lit(rule.prefix)), F.lit(rule.format))
        if rule.contains_key:
            chain = chain.when(document_has_key(document, payload, rule.contains_key), F.lit(rule.format))
    return F.lit(DEFAULT_FORMAT) if chain is F else chain.otherwise(F.lit(DEFAULT_FORMAT))


def detect_format(df: DataFrame, rules=DEFAULT_RULES, payload: str = "payload") -> DataFrame:
    """Add ``document`` and ``format``; a map-side step without shuffle or Python."""
    return once(with_document(df, payload), {"format": format_column(F.col(payload), F.col("document"), rules)})
