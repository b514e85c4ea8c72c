"""Structural rules of the message formats, and resolution of patient references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.jsonx import json_string
from millrace.functions.once import once
from millrace.operators.canonical import sanitize
from millrace.operators.detect import detect_format
from millrace.operators.formats import base, hl7, x12
from millrace.operators.joins import lookup_join

# Patterns and code lists of the rules.
NPI = r"^\d{10}$"
IDENTIFIER = r"^[A-Za-z0-9]+$"
ENCOUNTER_STATUSES = ("planned", "arrived", "triaged", "in-progress", "onleave", "finished", "cancelled")
PATIENT_REFERENCE = r"^Patient/.+$"


def _true(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def structural_rules(messages: DataFrame, keep: tuple[str, ...] = ("msg_id", "event_id")) -> DataFrame:
    """Tall table of message, rule and outcome; one row per rule of the message's format."""
    rows = detect_format(sanitize(messages))
    doc, segs, kind = F.col("document"), F.col("segments"), F.col("format")
    rows = once(rows, {"segments": F.when(kind == "hl7", hl7.segments(F.col("payload"))).when(kind == "x12", x12.segments(F.col("payload")))})
    x12_part = lambda name, qualifier=None: F.when(kind == "x12", base.last_segment(segs, name, "*", qualifier))
    rows = once(rows, {
        "nm1": x12_part("NM1", "IL"), "provider": x12_part("NM1", "85"), "clm": x12_part("CLM"),
        "pid": F.when(kind == "hl7", base.last_segment(segs, "PID", "|")),
        "resource": F.when(kind == "fhir", json_string(doc, "$.resourceType")),
        "status": F.when(kind == "fhir", json_string(doc, "$.status")),
        "reference": F.when(kind == "fhir", json_string(doc, "$.subject.reference")),
        "encounter_id": F.when(kind == "generic", json_string(doc, "$.encounter_id")),
        "member_id": F.when(kind == "generic", json_string(doc, "$.member_id")),
    })
    col = F.col
    is_encounter = col("resource") == "Encounter"
    outcomes = {
        "x12_837_required_segments_present": (kind == "x12", col("nm1").isNotNull() & col("clm").isNotNull()),
        "billing_provider_npi_valid": (kind == "x12", base.field(col("provider"), 9).rlike(NPI)),
        "x12_encounter_requires_clm": (kind == "x12", col("clm").isNotNull() & (base.field(col("clm"), 1) != "")),
        "hl7_pid_required": (kind == "hl7", col("pid").isNotNull()),
        "hl7_patient_id_valid": (kind == "hl7", F.substring_index(base.field(col("pid"), 3), "^", 1).rlike(IDENTIFIER)),
        "fhir_encounter_status_required": (is_encounter, col("status").isin(*ENCOUNTER_STATUSES)),
        "fhir_patient_reference_valid": (is_encounter, col("reference").rlike(PATIENT_REFERENCE)),
        "generic_encounter_id_required": (kind == "generic", col("encounter_id") != ""),
        "generic_member_id_valid": (kind == "generic", col("member_id").rlike(IDENTIFIER)),
    }
    checked = F.array_compact(F.array(*[
        F.when(applies, F.struct(F.lit(name).alias("rule"), _true(test).alias("passed")))
        for name, (applies, test) in outcomes.items()]))
    kept = [c for c in keep if c in messages.columns]
    return rows.select(*kept, "format", F.inline(checked))


def resolve_patients(rows: DataFrame, patients: DataFrame, reference: str = "reference") -> DataFrame:
    """Add ``resolved``: the reference names a patient that exists."""
    known = patients.select(F.concat(F.lit("Patient/"), F.col("patient_id")).alias(reference)).distinct().withColumn("_known", F.lit(True))
    joined = lookup_join(rows, known, [reference], "left", ["event_id"])
    return joined.withColumn("resolved", F.col("_known").isNotNull()).drop("_known")
