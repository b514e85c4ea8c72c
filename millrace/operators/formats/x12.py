"""X12 837: tilde-terminated segments of star-separated fields."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from millrace.operators.formats import base

# Segments with their qualifier, required ones in checking order.
SEGMENTS = {
    "isa": ("ISA", None), "gs": ("GS", None), "st": ("ST", None),
    "nm1": ("NM1", "IL"), "clm": ("CLM", None), "dtp": ("DTP", "472"),
}
ERRORS = {
    "isa": "x12: missing ISA segment",
    "gs": "x12: missing GS segment",
    "st": "x12: missing ST segment",
    "nm1": "x12: missing NM1*IL patient segment",
    "clm": "x12: missing CLM segment",
}


def segments(payload: Column) -> Column:
    return base.split_segments(F.translate(payload, "\r\n", ""), "~")


def parse(m: base.Message) -> Column:
    return F.struct(*[
        base.last_segment(m.segments, name, "*", qualifier).alias(key)
        for key, (name, qualifier) in SEGMENTS.items()])


def error(m: base.Message) -> Column:
    return F.coalesce(*[F.when(m.parsed[key].isNull(), F.lit(text)) for key, text in ERRORS.items()])


def fields(m: base.Message) -> Column:
    p = m.parsed
    named = F.size(p["nm1"]) > 8  # identifiers only count in a full-length NM1
    member = {i: F.when(named, base.field(p["nm1"], i)).otherwise(F.lit("")) for i in (3, 4, 9)}
    return base.full_map({
        "isa.raw": F.to_json(p["isa"]),
        "gs.raw": F.to_json(p["gs"]),
        "st.transaction_set": base.field(p["st"], 1),
        "nm1.patient_id": member[9],
        "nm1.first_name": member[4],
        "nm1.last_name": member[3],
        "clm.encounter_id": base.field(p["clm"], 1),
        "dtp.service_date": base.field(p["dtp"], 3),
    })


def metadata(m: base.Message, event_id: Column, source_system: Column) -> Column:
    return base.sparse_map({"event_id": event_id, "source_system": source_system})


def canonical(f: Column) -> dict[str, Column]:
    return {
        "patient": base.patient(f["nm1.patient_id"], f["nm1.first_name"], f["nm1.last_name"]),
        "encounter": base.encounter(f["clm.encounter_id"]),
        "observation": base.observation(f["st.transaction_set"]),
    }


SPEC = base.FormatSpec(
    name="x12", segments=segments, parse=parse, error=error, fields=fields,
    metadata=metadata, canonical=canonical)
