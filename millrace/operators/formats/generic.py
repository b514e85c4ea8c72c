"""Everything else: the text is kept whole."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from millrace.functions.jsonx import json_string
from millrace.operators.formats import base

NULL_PAYLOAD = "nil raw payload"  # fixed value


def error(m: base.Message) -> Column:
    return F.when(m.payload.isNull(), F.lit(NULL_PAYLOAD))


def fields(m: base.Message) -> Column:
    return base.full_map({"raw": m.payload})


def metadata(m: base.Message, event_id: Column, source_system: Column) -> Column:
    return base.full_map({"generic_fields": F.to_json(fields(m))})


def canonical(f: Column) -> dict[str, Column]:
    return {}


SPEC = base.FormatSpec(
    name="generic", error=error, fields=fields, metadata=metadata, canonical=canonical)


def _fields_with_ids(m: base.Message) -> Column:
    return base.sparse_map({
        "raw": m.payload,
        "generic.encounter_id": json_string(m.document, "$.encounter_id"),
        "generic.member_id": json_string(m.document, "$.member_id"),
    })


def _canonical_with_ids(f: Column) -> dict[str, Column]:
    member, visit = f["generic.member_id"], f["generic.encounter_id"]
    return {
        "patient": F.when(member.isNotNull(), base.patient(member)),
        "encounter": F.when(visit.isNotNull(), base.encounter(visit)),
    }


# Optional variant that reads encounter_id and member_id from JSON objects.
SPEC_WITH_IDS = base.FormatSpec(
    name="generic", error=error, fields=_fields_with_ids, metadata=metadata,
    canonical=_canonical_with_ids)
