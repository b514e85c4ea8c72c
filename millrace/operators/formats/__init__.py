"""Registry of message formats. Adding a format is one more entry."""

from __future__ import annotations

from millrace.operators.formats import fhir, generic, hl7, x12
from millrace.operators.formats.base import FormatSpec, Message

FORMATS: tuple[FormatSpec, ...] = (hl7.SPEC, x12.SPEC, fhir.SPEC, generic.SPEC)
FORMATS_WITH_GENERIC_IDS: tuple[FormatSpec, ...] = (hl7.SPEC, x12.SPEC, fhir.SPEC, generic.SPEC_WITH_IDS)

__all__ = ["FORMATS", "FORMATS_WITH_GENERIC_IDS", "FormatSpec", "Message"]
