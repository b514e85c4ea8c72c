"""Timestamps and differences."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed pattern: RFC 3339 with mandatory zone.
RFC3339 = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d+)?(Z|[+-]\d\d:\d\d)$"


def parse_rfc3339(text: Column) -> Column:
    """TIMESTAMP, or NULL when the text is not strict RFC 3339."""
    return F.when(text.rlike(RFC3339), F.try_to_timestamp(text))


def parse_timestamp(text: Column) -> Column:
    return F.try_to_timestamp(text)


def whole_units(unit: str, start: Column, end: Column) -> Column:
    """Complete units between two timestamps, truncated towards zero."""
    return F.timestamp_diff(unit, start, end)


def elapsed_ms(start: Column, end: Column) -> Column:
    """Milliseconds with a fraction, as DOUBLE."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return micros / F.lit(1000.0)
