"""Removal of repeated byte strings across documents with suffix arrays.

A byte goes if a string of ``SPAN`` bytes that covers it also starts earlier (in a smaller id, or earlier in the same
document). Repeats are found exactly, without one suffix array over everything:

1. Each string of SPAN bytes (a window) is known by its least-hashed k-gram, the leftmost of equals, and by where in the
   window that k-gram stands. Equal windows agree in both. Neighbouring windows with the same k-gram place form a run;
   one row per run (about one for every 35 bytes) is shuffled by the k-gram's hash.
2. Rows of one k-gram come sorted. Runs equal to an earlier one are repeats as a whole. If a k-gram has several different
   runs, the first of each is looked at more closely.
3. Those runs are cut into pieces by the place of the k-gram; pieces that share the bytes common to all their windows
   meet. A suffix array over the different pieces of such a group puts equal windows side by side; all but the earliest
   are repeats. A group of more than ``PIECES`` different pieces, which one task should not hold, sends each of its
   windows by its own hash instead, and windows are grouped by Spark.
4. Spans of all repeats meet their documents again.

Rows of a frequent k-gram are streamed in sorted order and never held; small tables are broadcast only up to
``BROADCAST_ROWS`` rows.

Defined results: a null or empty text has no bytes; a text shorter than SPAN keeps all; repeated or null ids: rows are
ordered by id (null first), then by a hash of the text and the text, and each keeps a row of its own; other columns are
ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from millrace.llm.common import _powers, keyed, mix, pieces, stored
from millrace.llm.suffix_array import suffix_array, suffix_arrays

SPAN = 100
GRAM = 32
STEP = 16                    # offsets per piece
PIECES = 256
SECTION = 16 << 20           # bytes of one document looked at together; the next section starts where windows go on
PLACE_BITS = 25              # places of a section
BROADCAST_ROWS = 500_000     # long columns: at most a few MB
OTHER_VALUES = mix(np.arange(1000, 1256, dtype=np.uint64))
SHORT = 1024                 # longest text that goes through a suffix array in step with others


class Rolling:
    """Hashes of any byte span of one array, from one value per kind of byte."""

    def __init__(self, data: np.ndarray, values: np.ndarray = np.arange(1, 257, dtype=np.uint64)):
        power, self.inverse = _powers(len(data))
        self.total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(values.take(data) * power[:len(data)], out=self.total[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.total[end] - self.total[start]) * self.inverse[start])


def least_grams(rolling: Rolling, n: int, span: int = SPAN, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(place of the least k-gram of the window at each place, all k-grams' hashes)."""
    grams = rolling.of(np.arange(n - gram + 1), np.arange(gram, n + 1))
    low = np.uint64((1 << PLACE_BITS) - 1)
    least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)         # the leftmost among equals
    width, size = span - gram + 1, 1
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < width:
        least = np.minimum(least[:len(least) - (width - size)], least[width - size:])
    return (least & low).astype(np.int64), grams


def sections(batch: pa.RecordBatch, size: int):
    """(ids, first byte in its document, data, offsets) of whole documents, or of parts of long ones."""
    for p in pieces(batch):
        if len(p) > 1 or len(p.data) <= size:
            yield p.ids, np.zeros(len(p), dtype=np.int64), p.data, p.offsets
            continue
        for at in range(0, len(p.data) - SPAN + 1, size):
            part = p.data[at:at + size + SPAN - 1]
            yield p.ids, np.array([at]), part, np.array([0, len(part)])


RUN = "h long, c long, doc long, start long, shape int"


def window_runs(docs: DataFrame, section: int = SECTION) -> DataFrame:
    """One row per run of windows: its k-gram's hash, a hash of its bytes and shape, document, first byte, and shape
    (offset of the k-gram from the first window * 128 + number of windows). A run known to be a repeat has its shape
    negated and a hash of its place for the k-gram's, so that it is dealt out evenly."""
    schema = StructType.fromDDL(RUN)

    def run(batches):
        arrow = to_arrow_schema(schema)
        for batch in batches:
            for ids, base, data, offsets in sections(batch, section):
                if len(data) < SPAN:
                    continue
                rolling = Rolling(data)
                place, grams = least_grams(rolling, len(data))
                s = np.arange(len(place))
                doc = np.searchsorted(offsets, s, "right") - 1
                s = s[s + SPAN <= offsets[doc + 1]]
                if not len(s):
                    continue
                doc, place = doc[s], place[s]
                new = np.ones(len(s), dtype=bool)
                new[1:] = (place[1:] != place[:-1]) | (s[1:] != s[:-1] + 1)
                a = np.flatnonzero(new)
                b = np.append(a[1:], len(s)) - 1
                first, n, offset = s[a], b - a + 1, place[a] - s[a]
                shape = offset * 128 + n
                c = mix(rolling.of(first, s[b] + SPAN) + shape.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                h, own, at = grams[place[a]], ids[doc[a]], base[doc[a]] + first - offsets[doc[a]]
                # Repeats within this batch are known here; only the first of equal runs is shuffled by its k-gram.
                order = np.lexsort((c, h) if (own[1:] >= own[:-1]).all() else (at, own, c, h))
                again = order[1:][(h[order][1:] == h[order][:-1]) & (c[order][1:] == c[order][:-1])]
                shape[again] *= -1
                h[again] = mix(own[again].astype(np.uint64) + at[again].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                yield pa.RecordBatch.from_arrays([
                    pa.array(h.view(np.int64)), pa.array(c.view(np.int64)), pa.array(own), pa.array(at), pa.array(shape.astype(np.int32))], schema=arrow)

    return docs.mapInArrow(run, schema)


FOUND = "doc long, start long, stop long, h long, shape int"


def compared_runs(rows: DataFrame) -> DataFrame:
    """FOUND: spans of runs equal to an earlier one (shape is null), and the first of each different run of a k-gram
    that has several (h and shape are set)."""
    schema = StructType.fromDDL(FOUND)

    def run(batches):
        arrow = to_arrow_schema(schema)
        held = None                                       # the last row so far, and whether its k-gram has had another run
        waiting = None                                    # the first run of a k-gram, as long as it is the only one

        def give(t, keep, repeat):
            n = (np.abs(t["shape"]) & 127) + SPAN - 1
            return pa.RecordBatch.from_arrays([
                pa.array(t["doc"][keep]), pa.array(t["start"][keep]), pa.array((t["start"] + n)[keep]), pa.array(t["h"][keep]),
                pa.array(t["shape"][keep], mask=repeat[keep])], schema=arrow)

        for batch in batches:
            if not batch.num_rows:
                continue
            t = {name: np.asarray(batch.column(i)) for i, name in enumerate(("h", "c", "doc", "start", "shape"))}
            new_h, new_c = np.ones(len(t["h"]), dtype=bool), np.ones(len(t["h"]), dtype=bool)
            new_h[1:] = t["h"][1:] != t["h"][:-1]
            new_c[1:] = new_h[1:] | (t["c"][1:] != t["c"][:-1])
            if held is not None and held[0] == t["h"][0]:
                new_h[0], new_c[0] = False, held[1] != t["c"][0]
            repeat = ~new_c | (t["shape"] < 0)
            new_c = ~repeat
            group = np.cumsum(new_h)                      # 0: goes on from the batch before
            kinds = np.bincount(group, weights=new_c, minlength=group[-1] + 1)
            several = kinds > 1
            if held is not None:
                several[0] = held[2] + kinds[0] > 1
            else:
                held = (None, None, 0)
            last = int(group[-1])
            keep = repeat | (new_c & several[group])
            if waiting is not None and (several[0] if group[0] == 0 else False):
                yield give(waiting, np.ones(1, dtype=bool), np.zeros(1, dtype=bool))
                waiting = None
            if last > 0 or group[0] > 0:
                waiting = None
            total = int(kinds[last]) + (held[2] if last == 0 else 0)
            if total == 1 and not several[last]:
                at = np.flatnonzero((group == last) & new_c)
                if len(at):
                    waiting = {k: v[at] for k, v in t.items()}
            held = (t["h"][-1], t["c"][-1], total)
            if keep.any():
                yield give(t, keep, repeat)

    return rows.repartition("h").sortWithinPartitions("h", "c", "doc", "start").mapInArrow(run, schema)


PIECE = "k1 long, k2 long, before binary, after binary, doc long, start long"


def run_pieces(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """PIECE: the runs in ``wanted`` (FOUND with a shape) cut by the place of their k-gram. The bytes that all windows of
    a whole piece share are known by two hashes (with k-gram and place); only the bytes before and after are kept."""
    schema = StructType.fromDDL(PIECE)
    by_doc = wanted.groupBy("doc").agg(F.collect_list(F.struct("start", "h", "shape")).alias("runs"))      # bounded by the document
    texts = _only(docs, by_doc.select("doc")).join(by_doc.withColumnRenamed("doc", "doc_id"), "doc_id").select("doc_id", "text", "runs")

    def run(batches):
        arrow = to_arrow_schema(schema)
        for batch in batches:
            at = 0
            for p in pieces(batch.select([0, 1])):
                lists = batch.column(2).slice(at, len(p))
                at += len(p)
                owner = np.repeat(np.arange(len(p)), np.diff(np.asarray(lists.offsets)))
                flat = lists.flatten()
                start, h, shape = (np.asarray(flat.field(i)) for i in range(3))
                start = start + p.offsets[owner]
                offset, n = shape.astype(np.int64) >> 7, shape.astype(np.int64) & 127
                gram = start + offset
                # Windows of a run stand offset, offset - 1, ... bytes before the k-gram; STEP of these offsets share a piece.
                low, high = (offset - n + 1) // STEP, offset // STEP
                each = np.repeat(np.arange(len(start)), high - low + 1)
                step = low[each] + np.arange(len(each)) - np.repeat(np.cumsum(high - low + 1) - (high - low + 1), high - low + 1)
                first = gram[each] - np.minimum(offset[each], step * STEP + STEP - 1)
                last = gram[each] - np.maximum(offset[each] - n[each] + 1, step * STEP)
                rolling = Rolling(p.data)
                common = rolling.of(gram[each] - step * STEP, gram[each] - step * STEP - STEP + 1 + SPAN)
                k1 = mix(common + h[each].view(np.uint64) * np.uint64(3) + step.astype(np.uint64))
                inner, outer = gram[each] - step * STEP, gram[each] - step * STEP - STEP + 1 + SPAN
                k2 = Rolling(p.data, OTHER_VALUES).of(inner, outer)
                raw = p.data.tobytes()
                yield pa.RecordBatch.from_arrays([
                    pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)),
                    pa.array([raw[a:b] for a, b in zip(first.tolist(), inner.tolist())], pa.binary()),
                    pa.array([raw[a:b] for a, b in zip(outer.tolist(), (last + SPAN).tolist())], pa.binary()),
                    pa.array(p.ids[owner[each]]), pa.array(first - p.offsets[owner[each]])], schema=arrow)

    return texts.mapInArrow(run, schema)


def equal_windows(groups: list[list[tuple[bytes, bytes]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(group, piece, window, class) of windows that stand more than once among the pieces of a group, by class.

    The pieces of a group, (bytes before, bytes after) what they share, go through one suffix array, in which one symbol
    stands for the shared bytes. Equal windows are neighbours in it."""
    lengths = np.array([sum(len(a) + len(b) + 2 for a, b in g) for g in groups], dtype=np.int64)
    by_width: dict[int, list[int]] = {}
    for i, n in enumerate(lengths.tolist()):
        by_width.setdefault(-(-n // 32) * 32 if n <= SHORT else -i - 1, []).append(i)
    found = [(np.zeros(0, np.int64),) * 4]
    for width, members in by_width.items():
        step = max(1, (1 << 20) // width) if width > 0 else 1
        for at in range(0, len(members), step):
            part = members[at:at + step]
            found.append(_equal_in_step(groups, np.array(part), lengths[part], width))
    columns = [np.concatenate(c) for c in zip(*found)]
    # Classes are numbered per call; with the group they are unique.
    return tuple(columns)


SHARED, BETWEEN, LAST = 258, 1, 0            # symbols besides bytes, which are counted from 2


def _equal_in_step(groups, part: np.ndarray, n: np.ndarray, width: int):
    rows = np.full((len(part), width if width > 0 else int(n[0])), -1, dtype=np.int64)
    pieces = [x for i in part for x in groups[i]]
    befores, afters = np.array([len(a) for a, _ in pieces]), np.array([len(b) for _, b in pieces])
    size = befores + afters + 2
    row = np.repeat(np.arange(len(part)), [len(groups[i]) for i in part])
    own_piece = np.concatenate([np.arange(len(groups[i])) for i in part])
    head = np.cumsum(size) - size
    head -= head[np.searchsorted(row, row)]                   # the piece's place in its row
    joined = np.frombuffer(b"".join(a + b"\0" + b + b"\0" for a, b in pieces), np.uint8).astype(np.int64) + 2
    flat = rows.ravel()
    place = np.repeat(row * rows.shape[1] + head - (np.cumsum(size) - size), size) + np.arange(len(joined))
    flat[place] = joined
    base = row * rows.shape[1] + head
    flat[base + befores] = SHARED
    flat[base + size - 1] = BETWEEN
    flat[np.arange(len(part)) * rows.shape[1] + n - 1] = LAST
    order = suffix_arrays(rows, n) if width > 0 else np.array([suffix_array(flat.tolist())])
    # Which piece each place belongs to, and how many of the bytes after the shared ones its window takes.
    piece_at = np.full(len(flat), -1, dtype=np.int64)
    piece_at[place] = np.repeat(np.arange(len(pieces)), size)
    spot = (order + np.arange(len(part))[:, None] * rows.shape[1])[order >= 0]
    piece = piece_at[spot]
    window = spot - base[piece]
    tail = window + STEP - 1 - befores[piece]                 # SPAN less the bytes before and the shared ones
    ok = (window <= befores[piece]) & (tail <= afters[piece])
    spot, piece, window, tail = spot[ok], piece[ok], window[ok], tail[ok]
    if len(spot) < 2:
        return (np.zeros(0, np.int64),) * 4
    length = befores[piece] - window + 1 + tail               # symbols of the window
    same = (row[piece][1:] == row[piece][:-1]) & (length[1:] == length[:-1]) & (tail[1:] == tail[:-1])
    pair = np.flatnonzero(same)
    longest = 2 * STEP
    index = np.arange(longest)
    first = np.minimum(spot[pair, None] + index, len(flat) - 1)
    second = np.minimum(spot[pair + 1, None] + index, len(flat) - 1)
    same[pair] = ((flat[first] == flat[second]) | (index >= length[pair, None])).all(axis=1)
    klass = np.cumsum(np.concatenate([[False], ~same]))
    many = np.bincount(klass)[klass] > 1
    return part[row[piece[many]]], own_piece[piece[many]], window[many], klass[many]


REPEAT = "doc long, start long, stop long, w1 long, w2 long"


def piece_repeats(rows: DataFrame, limit: int = PIECES) -> DataFrame:
    """REPEAT: spans of pieces' windows that stand in an earlier piece; for groups too large to hold, each window by its
    hashes (w1, w2) instead."""
    schema = StructType.fromDDL(REPEAT)

    def run(batches):
        arrow = to_arrow_schema(schema)
        for spans, loose, groups in _together(_gathered(batches, limit)):
            if groups:
                group, piece, window, klass = equal_windows([[r[:2] for r in g] for g in groups])
                first = np.cumsum([0] + [len(g) for g in groups])[group] + piece
                docs, starts = (np.array([r[k] for g in groups for r in g], dtype=np.int64) for k in (2, 3))
                doc, start = docs[first], starts[first] + window
                order = np.lexsort((start, doc, klass, group))
                later = order[1:][(klass[order][1:] == klass[order][:-1]) & (group[order][1:] == group[order][:-1])]
                spans += zip(doc[later].tolist(), start[later].tolist(), (start[later] + SPAN).tolist())
            merged = united(spans)
            columns = [[r[i] for r in merged] + [r[i] for r in loose] for i in range(3)] + [[None] * len(merged) + [r[i] for r in loose] for i in (3, 4)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=arrow)

    return rows.repartition("k1").sortWithinPartitions("k1", "k2", "before", "after", "doc", "start").mapInArrow(run, schema)


def _together(parts, pieces_held: int = 20_000):
    """Several of ``_gathered``'s results as one, so that many suffix arrays are built in step."""
    spans, loose, groups, held = [], [], [], 0
    for a, b, c in parts:
        spans += a
        loose += b
        groups += c
        held += sum(map(len, c)) + len(b) + len(a) // 4
        if held >= pieces_held:
            yield spans, loose, groups
            spans, loose, groups, held = [], [], [], 0
    yield spans, loose, groups


def _windows(key: tuple, piece: tuple) -> list[tuple]:
    """Each window of a piece: its place and two hashes, of the shared bytes' hashes and of its own other bytes."""
    before, after, doc, start = piece
    out = []
    for i in range(len(before) + 1):
        tail = i + STEP - 1 - len(before)
        if 0 <= tail <= len(after):
            own = hashlib.blake2b(repr((key, before[i:], after[:tail])).encode(), digest_size=16).digest()
            out.append((doc, start + i, start + i + SPAN, *np.frombuffer(own, "<i8").tolist()))
    return out


def _gathered(batches, limit: int):
    """From pieces sorted by keys, bytes and place: spans of pieces equal to the one before, windows of groups with more
    than ``limit`` different pieces, and the different pieces of each other group. No more than those are held of a group."""
    key, group, many = None, [], False
    for batch in batches:
        spans, loose, ready = [], [], []
        for k1, k2, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if key != (k1, k2):
                if len(group) > 1 and not many:
                    ready.append(group)
                key, group, many = (k1, k2), [], False
            if group and group[-1][0] == row[0] and group[-1][1] == row[1]:
                spans.append((row[2], row[3], row[3] + len(row[0]) + len(row[1]) + SPAN - STEP + 1))
                continue
            if many:
                loose += _windows(key, tuple(row))
                group = [tuple(row)]                          # only to know equal ones
                continue
            group.append(tuple(row))
            if len(group) > limit:
                loose += [w for piece in group for w in _windows(key, piece)]
                many, group = True, group[-1:]
        yield spans, loose, ready
    yield [], [], [group] if len(group) > 1 and not many else []


def united(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(document, start, stop) with overlapping and touching spans joined."""
    out: list[list[int]] = []
    for doc, start, stop in sorted(spans):
        if out and out[-1][0] == doc and start <= out[-1][2]:
            out[-1][2] = max(out[-1][2], stop)
        else:
            out.append([doc, start, stop])
    return [tuple(x) for x in out]


def _only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without some that are not in ``ids`` (doc), if the ids are few enough to be broadcast; else all."""
    ids = ids.select(F.col("doc").alias("doc_id")).distinct()
    return docs.join(F.broadcast(ids), "doc_id", "left_semi") if ids.count() <= BROADCAST_ROWS else docs


def ordered(docs: DataFrame) -> tuple[DataFrame, bool]:
    """Documents under an ascending key of their own (doc_id), and whether that is not the id: only where ids repeat or
    are null, rows are sorted and numbered."""
    odd = docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").limit(1).count()
    if not odd:
        return docs, False
    order = ["doc_id", "mark", "text"]
    numbered = docs.withColumn("mark", F.xxhash64("text")).repartitionByRange("doc_id", "mark").sortWithinPartitions(*order).select(
        F.monotonically_increasing_id().alias("key"), "doc_id", "text")
    return stored(numbered, "suffix-ordered"), True


def repeated_spans(docs: DataFrame, limit: int = PIECES, section: int = SECTION) -> DataFrame:
    """(doc, start, stop): spans of bytes to remove, not yet joined, of documents under unique ids (doc_id, text)."""
    found = stored(compared_runs(window_runs(docs, section)), "suffix-runs")
    whole = found.where("shape is null").select("doc", "start", "stop")
    close = stored(piece_repeats(run_pieces(docs, found.where("shape is not null")), limit), "suffix-pieces")
    loose = close.where("w1 is not null")
    first = loose.groupBy("w1", "w2").agg(F.min(F.struct("doc", "start")).alias("first"))
    later = loose.join(first, ["w1", "w2"]).where(F.struct("doc", "start") > F.col("first"))
    return whole.union(close.where("w1 is null").select("doc", "start", "stop")).union(later.select("doc", "start", "stop"))


RESULT = "key long, n_bytes long, removed array<struct<start: long, stop: long>>, kept binary"


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = PIECES, section: int = SECTION) -> DataFrame:
    """doc_id, n_bytes, removed (maximal spans, in bytes) and kept (the remaining bytes) of every row of ``docs``."""
    docs, numbered = ordered(keyed(docs, id_col, text_col))
    ids = docs.select("key", "doc_id") if numbered else None
    if numbered:
        docs = docs.select(F.col("key").alias("doc_id"), "text")
    spans = repeated_spans(docs, limit, section).groupBy("doc").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))      # bounded by the document
    both = docs.join(spans.withColumnRenamed("doc", "doc_id"), "doc_id", "left").select("doc_id", "text", "spans")
    schema = StructType.fromDDL(RESULT)

    def run(batches):
        arrow = to_arrow_schema(schema)
        for batch in batches:
            removed, kept, sizes = [], [], []
            for text, spans in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()):
                runs_of = united([(0, s["start"], s["stop"]) for s in spans or ()])
                parts, at = [], 0
                for _, start, stop in runs_of:
                    parts.append(text[at:start])
                    at = stop
                kept.append(b"".join([*parts, text[at:]]))
                removed.append([{"start": a, "stop": b} for _, a, b in runs_of])
                sizes.append(len(text))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, arrow.field(2).type), pa.array(kept, pa.binary())], schema=arrow)

    out = both.mapInArrow(run, schema)
    if numbered:
        return ids.join(out, "key").select("doc_id", "n_bytes", "removed", "kept")
    return out.select(F.col("key").alias("doc_id"), "n_bytes", "removed", "kept")


def report(docs: DataFrame, **settings: int) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return remove_repeats(docs, **settings).select(
        "doc_id", "n_bytes", F.expr("aggregate(removed, 0L, (n, s) -> n + s.stop - s.start)").alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT doc_id, s, md5(substring(x, 2 * s + 1, 200)) AS m FROM (SELECT doc_id, x, unnest(range(0, n - 99)) AS s FROM d WHERE n >= 100)),
later AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY m ORDER BY doc_id, s) AS r FROM w) WHERE r > 1),
steps AS (SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 100 THEN 0 ELSE 1 END AS fresh FROM later),
isle AS (SELECT doc_id, s, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s) AS g FROM steps),
span AS (SELECT doc_id, min(s) AS a, max(s) + 100 AS b FROM isle GROUP BY doc_id, g),
gap AS (SELECT doc_id, b AS a, coalesce(lead(a) OVER (PARTITION BY doc_id ORDER BY a), -1) AS b FROM span
        UNION ALL SELECT doc_id, 0 AS a, min(a) AS b FROM span GROUP BY doc_id),
kept AS (SELECT gap.doc_id, string_agg(substring(x, 2 * gap.a + 1, 2 * ((CASE WHEN b < 0 THEN n ELSE b END) - gap.a)), '' ORDER BY gap.a) AS x
         FROM gap JOIN d ON d.doc_id = gap.doc_id GROUP BY gap.doc_id),
sums AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS spans FROM span GROUP BY doc_id)
SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_bytes, CAST(coalesce(sums.removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(sums.spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept.x, d.x))) AS kept_sha256
FROM d LEFT JOIN sums ON sums.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id
"""
