"""What a message format has to provide, and small helpers shared by formats."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from millrace.functions.text import trim_space

TEXT_MAP = "map<string,string>"
PATIENT = "struct<id:string,first_name:string,last_name:string>"
ENCOUNTER = "struct<id:string,type:string>"
OBSERVATION = "struct<code:string,value:string>"


@dataclass(frozen=True)
class Message:
    """Columns a format may read: clean text, its segments, its JSON document."""

    payload: Column
    segments: Column
    document: Column
    parsed: Column


@dataclass(frozen=True)
class FormatSpec:
    """One entry per format; every callable returns column expressions.

    ``fields`` yields the flat ``segment.field`` map, ``canonical`` builds the
    patient, encounter and observation structs from that map.
    """

    name: str
    fields: Callable[[Message], Column]
    error: Callable[[Message], Column]
    canonical: Callable[[Column], dict[str, Column]]
    segments: Callable[[Column], Column] | None = None
    parse: Callable[[Message], Column] | None = None
    metadata: Callable[[Message, Column, Column], Column] | None = None
    transform_error: Callable[[Column], Column] | None = None


def split_segments(text: Column, separator: str) -> Column:
    """Trimmed, non-blank segments."""
    return F.filter(F.transform(F.split(text, separator), trim_space), lambda s: s != "")


def last_segment(segments: Column, name: str, separator: str, qualifier: str | None = None) -> Column:
    """Fields of the last segment with that name (and qualifier), NULL if absent."""
    if qualifier is None:
        wanted = F.filter(segments, lambda s: (s == name) | s.startswith(name + separator))
    else:
        wanted = F.filter(segments, lambda s: s.startswith(separator.join([name, qualifier, ""])))
    return F.split(F.try_element_at(wanted, F.lit(-1)), f"\\{separator}")


def field(segment: Column, index: int) -> Column:
    """Field text, '' where the segment is too short."""
    return F.coalesce(F.get(segment, F.lit(index)), F.lit(""))


def sparse_map(entries: dict[str, Column]) -> Column:
    """Map without the entries whose value is NULL."""
    return F.map_from_entries(F.array_compact(F.array(*[
        F.when(value.isNotNull(), F.struct(F.lit(key).alias("key"), value.alias("value")))
        for key, value in entries.items()])))


def full_map(entries: dict[str, Column]) -> Column:
    return F.create_map(*[c for key, value in entries.items() for c in (F.lit(key), value)])


def patient(id: Column, first_name: Column | None = None, last_name: Column | None = None) -> Column:
    blank = F.lit("")
    return F.struct(
        id.alias("id"),
        F.coalesce(first_name if first_name is not None else blank, blank).alias("first_name"),
        F.coalesce(last_name if last_name is not None else blank, blank).alias("last_name"))


def encounter(id: Column | None = None, type: Column | None = None) -> Column:
    blank = F.lit("")
    return F.struct(
        F.coalesce(id if id is not None else blank, blank).alias("id"),
        F.coalesce(type if type is not None else blank, blank).alias("type"))


def observation(code: Column, value: Column | None = None) -> Column:
    return F.struct(
        F.coalesce(code, F.lit("")).alias("code"),
        (value if value is not None else F.lit(None).cast("string")).alias("value"))
