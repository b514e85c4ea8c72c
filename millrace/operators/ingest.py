"""Ingest requests: decode, validate, classify."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.clock import parse_rfc3339
from millrace.functions.jsonx import is_object, json_part, json_string, may_hold_keys, strict_document
from millrace.functions.once import once

# Names of invalid fields, statuses and reasons.
INVALID_FIELDS = {
    "event_id": "envelope.event_id",
    "event_type": "envelope.event_type",
    "produced_at": "envelope.produced_at (empty)",
    "source_system": "envelope.source_system",
}
ZERO_TIME = "0001-01-01 00:00:00"
ACCEPTED, BAD_REQUEST, BAD_METHOD, UNPROCESSABLE = 202, 400, 405, 422


def decode_requests(df: DataFrame, body: str = "body") -> DataFrame:
    """Split request bodies into envelope fields and payload text.

    A string payload keeps its JSON quoting, as cleaning removes it later.
    """
    text, doc = F.col(body), F.col("document")
    out = once(df, {"document": F.when(may_hold_keys(text), strict_document(text))})
    out = once(out, {
        "valid_json": doc.isNotNull() & is_object(text),
        "event_id": json_string(doc, "$.envelope.event_id"),
        "event_type": json_string(doc, "$.envelope.event_type"),
        "source_system": json_string(doc, "$.envelope.source_system"),
        "produced_at": parse_rfc3339(json_string(doc, "$.envelope.produced_at")),
        "envelope_typed": _strings_or_absent(doc, "event_id", "event_type", "source_system"),
        "payload_present": json_part(doc, "$.payload").isNotNull(),
    })
    # Plain projections: computed only by plans that read them.
    return out.withColumns({
        "envelope": F.when(doc.isNotNull(), F.get_json_object(text, "$.envelope")),
        "payload": F.when(json_string(doc, "$.payload").isNotNull(), F.to_json(json_part(doc, "$.payload")))
        .when(doc.isNotNull(), F.get_json_object(text, "$.payload")),
    }).drop("document")


def _strings_or_absent(doc: Column, *names: str) -> Column:
    """True if each envelope value is a string, null or absent."""
    ok = F.lit(True)
    for name in names:
        kind = F.schema_of_variant(json_part(doc, f"$.envelope.{name}"))
        ok = ok & (kind.isNull() | kind.isin("STRING", "VOID"))
    return ok


def invalid_fields() -> Column:
    """All envelope fields that are empty, as an array."""
    blank = lambda name: F.coalesce(F.col(name), F.lit("")) == ""
    checks = {
        "event_id": blank("event_id"), "event_type": blank("event_type"),
        "produced_at": F.col("produced_at") == F.lit(ZERO_TIME).cast("timestamp"),
        "source_system": blank("source_system"),
    }
    return F.array_compact(F.array(*[F.when(bad, F.lit(INVALID_FIELDS[name])) for name, bad in checks.items()]))


def classify_requests(decoded: DataFrame, method: str | None = None, routing_error: Column | None = None) -> DataFrame:
    """Add status and reason; the first failing check decides."""
    rejected = F.lit(False) if routing_error is None else routing_error.isNotNull()
    wrong_method = F.lit(False) if method is None else F.col(method) != "POST"
    envelope_ok = F.col("envelope_typed") & F.col("produced_at").isNotNull()
    out = decoded.withColumn("invalid_fields", F.when(F.col("valid_json") & envelope_ok, invalid_fields()))
    checks = (
        (wrong_method, BAD_METHOD, "invalid_method"),
        (~F.col("valid_json"), BAD_REQUEST, "json_error"),
        (~envelope_ok, UNPROCESSABLE, "envelope_error"),
        (F.size("invalid_fields") > 0, UNPROCESSABLE, "validation_error"),
        (~F.col("payload_present"), BAD_REQUEST, "payload_error"),
        (rejected, UNPROCESSABLE, "routing_error"))
    outcome = F
    for failed, status, reason in checks:
        outcome = outcome.when(failed, F.struct(F.lit(status).alias("status"), F.lit(reason).alias("reason")))
    outcome = outcome.otherwise(F.struct(F.lit(ACCEPTED).alias("status"), F.lit("accepted").alias("reason")))
    return once(out, {"outcome": outcome}).select(*out.columns, "outcome.*")
