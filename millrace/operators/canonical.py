"""Message text to canonical events: one pass, no shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.once import once
from millrace.functions.text import plain_base64, presanitize
from millrace.operators.detect import DEFAULT_RULES, detect_format
from millrace.operators.formats import FORMATS, FormatSpec, Message
from millrace.operators.formats import base

# Stages and reasons of rejected events.
NORMALIZE, TRANSFORM, COMPLIANCE = "normalize", "transform", "compliance"
MISSING_IDENTIFIERS = "missing_identifiers"
DERIVE_FAILED = "derive_failed"


def _by_format(formats, make, otherwise: Column) -> Column:
    """CASE over ``format`` with one branch per registered format."""
    cases = [(spec.name, make(spec)) for spec in formats]
    cases = [(name, value) for name, value in cases if value is not None]
    if not cases:
        return otherwise
    chain = reduce(lambda acc, c: acc.when(F.col("format") == c[0], c[1]), cases, F)
    return chain.otherwise(otherwise)


def _null(type_: str) -> Column:
    return F.lit(None).cast(type_)


def sanitize(df: DataFrame) -> DataFrame:
    return once(df, {"payload": presanitize(F.col("payload"))})


def _message(spec: FormatSpec) -> Message:
    parsed = F.col(f"parsed_{spec.name}") if spec.parse else _null("string")
    return Message(F.col("payload"), F.col("segments"), F.col("document"), parsed)


def normalize(df: DataFrame, formats=FORMATS) -> DataFrame:
    """Add ``fields``, ``metadata``, ``error_stage`` and ``error_reason``.

    Segments, parsed parts and fields are separate projections so that each is
    computed once per row and only for rows of its format.
    """
    out = once(df, {"segments": _by_format(
        formats, lambda s: s.segments(F.col("payload")) if s.segments else None, _null("array<string>"))})
    parses = {f"parsed_{s.name}": F.when(F.col("format") == s.name, s.parse(_message(s))) for s in formats if s.parse}
    out = once(out, parses) if parses else out
    out = once(out, {"error_reason": _by_format(
        formats, lambda s: s.error(_message(s)), F.concat(F.lit("no normalizer for format: "), F.col("format")))})
    ok = F.col("error_reason").isNull()
    out = once(out, {
        "fields": F.when(ok, _by_format(formats, lambda s: s.fields(_message(s)), _null(base.TEXT_MAP))),
        "error_stage": F.when(~ok, F.lit(NORMALIZE)),
    })
    # A plain projection, so that plans which do not read it never compute it.
    out = out.withColumn("metadata", F.when(ok, _by_format(
        formats,
        lambda s: s.metadata(_message(s), F.col("event_id"), F.col("source_system")) if s.metadata else None,
        _null(base.TEXT_MAP))))
    return out.drop("segments", "document", *[f"parsed_{s.name}" for s in formats if s.parse])


def transform(df: DataFrame, formats=FORMATS) -> DataFrame:
    """Add patient, encounter and observation; reject what has no canonical shape."""
    fields = F.col("fields")
    shape = {s.name: s.canonical(fields) for s in formats}
    reason = _by_format(formats, lambda s: s.transform_error(fields) if s.transform_error else None, _null("string"))
    out = once(df, {"_reason": F.when(F.col("error_reason").isNull(), reason)})
    ok = F.col("error_reason").isNull() & F.col("_reason").isNull()
    part = lambda key, type_: F.when(ok, _by_format(formats, lambda s: shape[s.name].get(key), _null(type_)))
    return once(out, {
        "patient": part("patient", base.PATIENT),
        "encounter": part("encounter", base.ENCOUNTER),
        "observation": part("observation", base.OBSERVATION),
        "error_stage": F.coalesce("error_stage", F.when(F.col("_reason").isNotNull(), F.lit(TRANSFORM))),
        "error_reason": F.coalesce("error_reason", "_reason"),
    }).drop("_reason")


def derive_entity(df: DataFrame) -> DataFrame:
    """Add the first non-empty identifier as ``entity_type``, ``entity_id``.

    Only the first component of an HL7 patient id names the patient.
    """
    patient_id = F.when(F.col("format") == "hl7", F.substring_index("patient.id", "^", 1)).otherwise(F.col("patient.id"))
    ids = (("patient", patient_id), ("encounter", F.col("encounter.id")), ("observation", F.col("observation.code")))
    return once(df, {
        "entity_type": F.coalesce(*[F.when(value != "", F.lit(name)) for name, value in ids]),
        "entity_id": F.coalesce(*[F.nullif(value, F.lit("")) for _, value in ids]),
    })


def check_identifiers(df: DataFrame) -> DataFrame:
    """Reject events without any canonical part or without any identifier."""
    absent = F.col("patient").isNull() & F.col("encounter").isNull() & F.col("observation").isNull()
    reason = F.when(absent, F.lit(MISSING_IDENTIFIERS)).when(F.col("entity_id").isNull(), F.lit(DERIVE_FAILED))
    out = df.withColumn("_reason", F.when(F.col("error_reason").isNull(), reason))
    return once(out, {
        "error_stage": F.coalesce("error_stage", F.when(F.col("_reason").isNotNull(), F.lit(COMPLIANCE))),
        "error_reason": F.coalesce("error_reason", "_reason"),
    }).drop("_reason")


def canonicalize(df: DataFrame, formats=FORMATS, rules=DEFAULT_RULES) -> DataFrame:
    """Clean, detect, normalise, transform and identify a table of messages.

    Needs event_id, source_system and payload. Rejected rows stay in the table
    with ``error_stage`` and ``error_reason``.
    """
    out = detect_format(sanitize(df), rules)
    return check_identifiers(derive_entity(transform(normalize(out, formats), formats)))


def raw_value(df: DataFrame) -> DataFrame:
    """Add the payload as base64, the way the raw zone stores it."""
    return df.withColumn("raw_value", plain_base64(F.col("payload").cast("binary")))


def format_mismatch(df: DataFrame, declared: str) -> DataFrame:
    """Rows whose declared format disagrees with the detected one."""
    return df.filter(F.col(declared) != F.col("format"))
