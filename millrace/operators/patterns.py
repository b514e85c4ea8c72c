"""Patterns over event types as keys of an equi-join.

An event type is ``domain.entity.action``. A pattern that fixes its first segments and leaves the rest open is a node of a
trie over segments, and its key is the path to that node; an event carries the keys of all nodes on its own path. So
events meet the patterns that apply by an equi-join on the key, in one scan, whatever the size of the catalogue. Patterns of
another form are tried on the distinct event types only, and become keys of the types they match.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.joins import fits, lookup_join

SEGMENTS = 3
EXACT = "="          # ends the key of one whole event type
MOST_FREE = 10_000   # patterns of another form, tried one by one on each event type
SEGMENT = r"[A-Za-z0-9_]+"


def pattern_key(pattern: Column) -> Column:
    r"""The key of a pattern: '' for all types, 'a.' or 'a.b.' for open ends, 'a.b.c=' for one type; null for other forms.

    Understood are ``*``, ``a.*``, ``a.b.*`` and whole types, and anchored expressions for the same (``^a\.b\..*``).
    """
    plain_open = F.regexp_extract(pattern, rf"^((?:{SEGMENT}\.){{1,{SEGMENTS - 1}}})\*$", 1)
    open_end = F.regexp_extract(pattern, rf"^\^((?:{SEGMENT}\\\.){{1,{SEGMENTS - 1}}})\.\*\$?$", 1)
    whole = F.regexp_extract(pattern, rf"^\^({SEGMENT}(?:\\\.{SEGMENT})*)\$$", 1)
    unescaped = lambda c: F.replace(c, F.lit("\\."), F.lit("."))
    return (
        F.when(pattern.isin("*", ".*", "^.*", "^.*$", ".*$"), F.lit(""))
        .when(plain_open != "", plain_open)
        .when(open_end != "", unescaped(open_end))
        .when(whole != "", F.concat(unescaped(whole), F.lit(EXACT)))
        .when(pattern.rlike(rf"^{SEGMENT}(\.{SEGMENT}){{{SEGMENTS - 1}}}$"), F.concat(pattern, F.lit(EXACT))))


def type_keys(event_type: Column) -> Column:
    """The keys of all patterns that an event type may meet."""
    parts = F.split(event_type, r"\.")
    opened = [F.when(F.size(parts) > k, F.concat(F.concat_ws(".", F.slice(parts, 1, k)), F.lit("."))) for k in range(1, SEGMENTS)]
    return F.array_compact(F.array(F.lit(""), *opened, F.concat(event_type, F.lit(EXACT))))


def keyed_patterns(catalogue: DataFrame, types: DataFrame, pattern: str = "event_pattern") -> DataFrame:
    """``catalogue`` with ``_key``. ``types``: one column event_type, read only if some pattern has another form."""
    marked = catalogue.withColumn("_key", pattern_key(F.col(pattern)))
    free = marked.filter(F.col("_key").isNull() & F.col(pattern).isNotNull()).drop("_key")
    if not free.limit(1).count():
        return marked.filter(F.col("_key").isNotNull())
    if not fits(free, MOST_FREE):
        raise ValueError(f"more than {MOST_FREE} patterns that fix no leading segments")
    matched = types.select("event_type").distinct().join(F.broadcast(free), F.rlike("event_type", F.col(pattern)))
    return marked.filter(F.col("_key").isNotNull()).unionByName(
        matched.withColumn("_key", F.concat("event_type", F.lit(EXACT))).drop("event_type"))


def match(events: DataFrame, catalogue: DataFrame, salt: Sequence[str], pattern: str = "event_pattern") -> DataFrame:
    """Pairs of event and row of the catalogue whose pattern its type meets."""
    keyed = keyed_patterns(catalogue, events, pattern)
    offered = events.select("*", F.explode(type_keys(F.coalesce("event_type", F.lit("")))).alias("_key"))
    return lookup_join(offered, keyed, ["_key"], "inner", salt).drop("_key")
