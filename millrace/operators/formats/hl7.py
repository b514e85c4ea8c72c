"""HL7 v2: lines of pipe-separated fields."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from millrace.operators.formats import base

# Required segments in the order they are checked, and error texts.
REQUIRED = ("MSH", "PID", "PV1")
ERRORS = {name: f"missing {name} segment" for name in REQUIRED}

MESSAGE_TYPE, PATIENT_ID, PATIENT_NAME, ENCOUNTER_TYPE, ENCOUNTER_ID = 8, 3, 5, 2, 20


def segments(payload: Column) -> Column:
    return base.split_segments(payload, "[\r\n]+")


def parse(m: base.Message) -> Column:
    return F.struct(*[base.last_segment(m.segments, n, "|").alias(n.lower()) for n in REQUIRED])


def error(m: base.Message) -> Column:
    return F.coalesce(*[F.when(m.parsed[n.lower()].isNull(), F.lit(ERRORS[n])) for n in REQUIRED])


def fields(m: base.Message) -> Column:
    msh, pid, pv1 = (m.parsed[n.lower()] for n in REQUIRED)
    name = F.split(base.field(pid, PATIENT_NAME), "\\^")
    return base.full_map({
        "msh.message_type": base.field(msh, MESSAGE_TYPE),
        "pid.id": base.field(pid, PATIENT_ID),
        "pid.id_component": F.substring_index(base.field(pid, PATIENT_ID), "^", 1),
        "pid.first_name": base.field(name, 1),
        "pid.last_name": base.field(name, 0),
        "pv1.encounter_id": base.field(pv1, ENCOUNTER_ID),
        "pv1.encounter_type": base.field(pv1, ENCOUNTER_TYPE),
    })


def metadata(m: base.Message, event_id: Column, source_system: Column) -> Column:
    return base.sparse_map({"event_id": event_id, "source_system": source_system})


def canonical(f: Column) -> dict[str, Column]:
    return {
        "patient": base.patient(f["pid.id"], f["pid.first_name"], f["pid.last_name"]),
        "encounter": base.encounter(f["pv1.encounter_id"], f["pv1.encounter_type"]),
        "observation": base.observation(f["msh.message_type"]),
    }


SPEC = base.FormatSpec(
    name="hl7", segments=segments, parse=parse, error=error, fields=fields,
    metadata=metadata, canonical=canonical)
