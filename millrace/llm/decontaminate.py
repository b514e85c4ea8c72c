"""Benchmark decontamination by Wu-Manber search.

Words of both sides are lower-cased (A-Z) and joined by single blanks, with a blank at either end, so a window of words
is a byte string that can only match at word borders. Windows of similar length share one set of tables: for every
block of ``BLOCK`` bytes the distance by which the search may move on, and for blocks that end a window's head the
bucket of windows to compare directly. A text is read from left to right and most of it is skipped.

The benchmark is measured first and searched in packs of at most ``PACK_BYTES`` of text; each pack goes over all
documents once, map-side, and hits are carried along. Nothing else is shuffled or broadcast.

Defined results: a null or empty text has no words and is never contaminated; items without words or with a null id are
ignored; rows that repeat an item id are parts of one item; every row of documents gives one row, repeated or not; other
columns are ignored; with an empty benchmark nothing is hit.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from millrace.llm.common import ALNUM, LOWER, keyed, stored

WINDOW = 10
BLOCK = 8
PACK_BYTES = 8 << 20
# Lower-cases A-Z and turns every byte outside words into a blank.
PLAIN = bytes(int(LOWER[b]) if ALNUM[LOWER[b]] else 32 for b in range(256))


def plain_words(text: str) -> list[bytes]:
    return text.encode().translate(PLAIN).split()


def windows(words: list[bytes], size: int) -> set[tuple[bytes, int]]:
    """The windows of an item with their numbers of words."""
    if not words:
        return set()
    size = min(size, len(words))
    return {(b" " + b" ".join(words[i:i + size]) + b" ", size) for i in range(len(words) - size + 1)}


class Tables:
    """Wu-Manber tables of the windows of one length class."""

    def __init__(self, patterns: list[bytes]):
        self.m = min(map(len, patterns))
        self.block = min(BLOCK, self.m)
        self.default = self.m - self.block + 1
        self.shift: dict[bytes, int] = {}
        self.buckets: dict[bytes, dict[int, set[bytes]]] = {}
        for p in patterns:
            for end in range(self.block, self.m + 1):
                key = p[end - self.block:end]
                if self.m - end < self.shift.get(key, self.default):
                    self.shift[key] = self.m - end
            tail = p[self.m - self.block:self.m]
            self.buckets.setdefault(tail, {}).setdefault(len(p), set()).add(p)

    def find(self, text: bytes):
        """All (start, window) in the text."""
        m, block, default, get, n = self.m, self.block, self.default, self.shift.get, len(text)
        end = m
        while end <= n:
            key = text[end - block:end]
            step = get(key, default)
            if step:
                end += step
                continue
            start = end - m
            for length, group in self.buckets[key].items():
                found = text[start:start + length]
                if found in group:
                    yield start, found
            end += 1


class Matcher:
    def __init__(self, items: list[tuple[str, str]], size: int = WINDOW):
        self.owners: dict[bytes, set[str]] = {}
        self.n_words: dict[bytes, int] = {}
        for item, text in items:
            for window, n in windows(plain_words(text), size):
                self.owners.setdefault(window, set()).add(item)
                self.n_words[window] = n
        classes: dict[int, list[bytes]] = {}
        for window in self.owners:
            classes.setdefault(len(window).bit_length(), []).append(window)
        self.tables = [Tables(group) for group in classes.values()]

    def search(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Runs of words (first, last) inside occurrences, and the items found."""
        text = b" " + b" ".join(words) + b" "
        hits = [hit for t in self.tables for hit in t.find(text)]
        if not hits:
            return [], set()
        blanks = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
        spans, items = [], set()
        for start, window in hits:
            first = int(np.searchsorted(blanks, start))
            spans.append((first, first + self.n_words[window] - 1))
            items |= self.owners[window]
        return spans, items


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


RESULT = "doc_id long, n_words long, spans array<struct<first: long, last: long>>, item_ids array<string>"


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, n_words, spans (runs of hit words), item_ids (sorted as strings) of every document."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text).alias("text")).where(
        "item is not null and text is not null")
    total = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    packs = max(1, math.ceil(total / PACK_BYTES))
    empty = "cast(array() as array<struct<first: long, last: long>>)"
    state = keyed(docs, id_col, text_col).select("doc_id", "text", F.expr(empty).alias("spans"), F.expr("cast(array() as array<string>)").alias("item_ids"))
    for k in range(packs):
        # A pack holds about PACK_BYTES; an item's rows stay together.
        pack = [(r["item"], r["text"]) for r in items.where(F.pmod(F.xxhash64("item"), F.lit(packs)) == k).collect()]
        state = _scan(state, spark.sparkContext.broadcast(pack), window, last=k == packs - 1)
        if k < packs - 1:
            state = stored(state, "decontaminate")
    return state


def _scan(state: DataFrame, pack, size: int, last: bool) -> DataFrame:
    schema = StructType.fromDDL(RESULT if last else RESULT.replace("n_words long", "text string"))

    def run(batches):
        matcher, arrow = Matcher(pack.value, size), to_arrow_schema(schema)
        for batch in batches:
            texts, middle, spans, found = batch.column(1).to_pylist(), [], [], []
            for text, old_spans, old_items in zip(texts, batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                words = plain_words(text)
                new, items = matcher.search(words)
                middle.append(len(words) if last else text)
                runs = united([(s["first"], s["last"]) for s in old_spans] + new)
                spans.append([{"first": a, "last": b} for a, b in runs])
                found.append(sorted({*old_items, *items}))
            columns = [batch.column(0), pa.array(middle, arrow.field(1).type), pa.array(spans, arrow.field(2).type), pa.array(found, arrow.field(3).type)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return state.mapInArrow(run, schema)


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    n_hit = F.expr("aggregate(spans, 0L, (n, s) -> n + s.last - s.first + 1)")
    return decontaminate(docs, benchmark).select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL = f"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all({LOWERED}, '{WORD}'), []) AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({LOWERED}, '{WORD}') AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
sized AS (SELECT item_id, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS t
        FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM sized)),
sizes AS (SELECT DISTINCT n FROM win),
occ AS (SELECT o.doc_id, o.i, o.n, win.item_id
        FROM (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS t
              FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)) o
        JOIN win ON win.t = o.t AND win.n = o.n),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM occ) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n, string_agg(s, ',' ORDER BY s) AS s
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM occ) GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(its.n, 0) AS BIGINT) AS n_items, sha256(coalesce(its.s, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN its ON its.doc_id = d.doc_id
"""
