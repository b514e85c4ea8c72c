"""FHIR resources as JSON objects."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from millrace.functions.jsonx import as_text, is_object, json_part, json_string
from millrace.operators.formats import base

# Resource types with a canonical shape, and error texts.
RESOURCE_TYPES = ("Patient", "Encounter", "Observation")
EMPTY = "empty fhir payload"
INVALID = "invalid fhir json"
NOT_OBJECT = "invalid fhir json: expected object"
MISSING_TYPE = "missing resourceType"
UNSUPPORTED = "unsupported resourceType: "


def error(m: base.Message) -> Column:
    return (
        F.when(F.length(m.payload) == 0, F.lit(EMPTY))
        .when(m.document.isNull(), F.lit(INVALID))
        .when(~is_object(m.payload), F.lit(NOT_OBJECT)))


def parse(m: base.Message) -> Column:
    doc = m.document
    kind = json_string(doc, "$.resourceType")
    value = json_part(doc, "$.valueQuantity.value")
    profile = json_part(doc, "$.meta.profile")
    return F.struct(
        F.coalesce(kind, F.lit("")).alias("resource_type"),
        F.coalesce(json_string(doc, "$.id"), F.lit("")).alias("id"),
        F.when(kind == "Observation", json_string(doc, "$.code.coding[0].code")).alias("code"),
        F.when((kind == "Observation") & value.isNotNull(), as_text(value)).alias("value"),
        F.when(kind == "Encounter", json_string(doc, "$.class.code")).alias("class_code"),
        F.when(kind == "Encounter", json_string(doc, "$.subject.reference")).alias("subject"),
        F.when(profile.isNotNull(), as_text(profile)).alias("profile"))


def fields(m: base.Message) -> Column:
    return base.sparse_map({
        "fhir.resource_type": m.parsed["resource_type"],
        "fhir.id": m.parsed["id"],
        "fhir.code": m.parsed["code"],
        "fhir.value": m.parsed["value"],
        "fhir.class.code": m.parsed["class_code"],
    })


def metadata(m: base.Message, event_id: Column, source_system: Column) -> Column:
    return base.sparse_map({"meta.profile": m.parsed["profile"], "subject.reference": m.parsed["subject"]})


def transform_error(f: Column) -> Column:
    kind = f["fhir.resource_type"]
    return (
        F.when(kind == "", F.lit(MISSING_TYPE))
        .when(~kind.isin(*RESOURCE_TYPES), F.concat(F.lit(UNSUPPORTED), kind)))


def canonical(f: Column) -> dict[str, Column]:
    kind, id_ = f["fhir.resource_type"], f["fhir.id"]
    return {
        "patient": F.when(kind == "Patient", base.patient(id_)),
        "encounter": F.when(kind == "Encounter", base.encounter(id_, f["fhir.class.code"])),
        "observation": F.when(kind == "Observation", base.observation(f["fhir.code"], f["fhir.value"])),
    }


SPEC = base.FormatSpec(
    name="fhir", parse=parse, error=error, fields=fields, metadata=metadata,
    transform_error=transform_error, canonical=canonical)
