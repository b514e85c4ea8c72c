"""Token files: ids of whole documents under a static range asymmetric numeral system.

Documents are put in ascending order of id by a range shuffle; the ``tokenizers`` library encodes them; whole documents
are gathered into blocks of about ``BLOCK_TOKENS`` ids. One table of frequencies, counted over all ids, serves all
blocks. A block is coded on its own by ``LANES`` interleaved coders: id i belongs to coder i mod LANES. Every
``CHECKPOINT`` steps it notes the coders' states and the place in the stream, so its stretches can be decoded side by
side, and a CRC-32 of the coded bytes is checked before decoding.

A file set is a folder: ``table`` (id, frequency) and ``blocks``, Parquet rows whose ``payload`` is one coded block:
a header (``HEADER``), places and states of checkpoints, 32-bit words. Blocks are written and read by Spark, so a lost
task is simply run again.

Defined results: a null or empty text has only the end id; rows are ordered by id (null first), then by a hash of the
text and the text, so repeated ids and rows have places of their own; other columns are ignored; an empty table gives
files without blocks. A block with a wrong checksum or another table raises.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from millrace.llm.common import keyed, stored

SCALE = 20                               # frequencies add up to 2 ** SCALE
LOW = np.uint64(1 << 31)                 # states stay in [2 ** 31, 2 ** 63)
LANES = 1024
CHECKPOINT = 32
BLOCK_TOKENS = 1 << 17
SHARD_BYTES = 32 << 20                   # text per shard
REMEMBERED = 700_000
SLICE_BYTES = 8 << 20                    # of text cut and put together at once
RUN = 256                                # stretches that the library is asked for in one text
BLANK = "\u0120"                         # how byte-level vocabularies write a blank
IRREGULAR = (r"\A[ \n]|[ \n]\z|[ \n][ \n]|[\x00-\x09\x0b-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
             r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
HEADER = struct.Struct("<4sIQIIIQQI")    # magic, version, table, lanes, checkpoint steps, checkpoints, ids, words, crc


class Table:
    """Frequencies of ids in parts of 2 ** SCALE."""

    def __init__(self, counts: dict[int, int]):
        size = 1 + max(counts, default=0)
        c = np.zeros(size, dtype=np.int64)
        for i, n in counts.items():
            c[i] = n
        if np.count_nonzero(c) >= 1 << SCALE:
            raise ValueError("more ids than the scale can hold")
        total = max(1, int(c.sum()))
        f = np.where(c > 0, np.maximum(1, (c.astype(object) * (1 << SCALE) // total).astype(np.int64)), 0)
        # What rounding left over or took too much goes to and from the most frequent ids.
        for i in np.argsort(-c, kind="stable").tolist():
            left = (1 << SCALE) - int(f.sum())
            if not left or not c[i]:
                break
            f[i] = max(1, f[i] + left)
        self.use(f)

    def use(self, frequencies: np.ndarray) -> None:
        self.f = frequencies.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(self.f)[:-1]]).astype(np.uint64)
        self.mark = zlib.crc32(self.f.tobytes())
        self._symbols: np.ndarray | None = None

    @property
    def symbols(self) -> np.ndarray:
        if self._symbols is None:
            self._symbols = np.repeat(np.arange(len(self.f), dtype=np.uint32), self.f.astype(np.int64))
        return self._symbols

    def __getstate__(self):
        return {"f": self.f}

    def __setstate__(self, state):
        self.use(state["f"])


def encode_block(ids: np.ndarray, table: Table, lanes: int = LANES, every: int = CHECKPOINT) -> bytes:
    n = len(ids)
    steps = -(-n // lanes)
    state = np.full(lanes, LOW, dtype=np.uint64)
    f, start = table.f.take(ids), table.start.take(ids)
    chunks, places, states, written = [], [], [], 0
    for t in range(steps - 1, -1, -1):
        a, b = t * lanes, min(n, (t + 1) * lanes)
        x, fi = state[:b - a], f[a:b]
        over = x >= fi << np.uint64(63 - SCALE)
        words = x[over].astype("<u4")                       # the low 32 bits
        x = np.where(over, x >> np.uint64(32), x)
        q = x // fi
        state[:b - a] = (q << np.uint64(SCALE)) + (x - q * fi) + start[a:b]
        chunks.append(words)
        written += len(words)
        if t % every == 0:
            places.append(written)
            states.append(state.copy())
    stream = np.concatenate(chunks[::-1]) if chunks else np.zeros(0, "<u4")
    at = (written - np.array(places[::-1], dtype="<u8")).astype("<u8")
    body = at.tobytes() + b"".join(s.astype("<u8").tobytes() for s in states[::-1]) + stream.tobytes()
    return HEADER.pack(b"TANS", 1, table.mark, lanes, every, len(at), n, written, zlib.crc32(body)) + body


def decode_block(payload: bytes, table: Table, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of a block from checkpoint ``first`` up to but not including ``last`` (all by default), side by side."""
    magic, version, mark, lanes, every, points, n, n_words, crc = HEADER.unpack_from(payload)
    body = memoryview(payload)[HEADER.size:]
    if magic != b"TANS" or version != 1 or zlib.crc32(body) != crc:
        raise ValueError("not a token block, or damaged")
    if mark != table.mark:
        raise ValueError("the block was coded with another table")
    last = points if last is None else min(last, points)
    count = last - first
    if count <= 0:
        return np.zeros(0, dtype=np.uint32)
    at = np.frombuffer(body, "<u8", points)[first:last].astype(np.int64)
    state = np.frombuffer(body, "<u8", points * lanes, 8 * points).reshape(points, lanes)[first:last].copy()
    words = np.append(np.frombuffer(body, "<u4", n_words, 8 * points * (1 + lanes)), np.uint32(0)).astype(np.uint64)
    out = np.zeros((count, every, lanes), dtype=np.uint32)
    place = (first + np.arange(count))[:, None] * every * lanes + np.arange(lanes)
    mask, f, start, symbols = np.uint64((1 << SCALE) - 1), table.f, table.start, table.symbols
    for t in range(every):
        live = place + t * lanes < n
        if not live.any():
            break
        slot = state & mask
        s = symbols.take(slot.astype(np.int64))
        x = f.take(s) * (state >> np.uint64(SCALE)) + slot - start.take(s)
        need = (x < LOW) & live
        rank = np.cumsum(need, axis=1)
        where = np.where(need, at[:, None] + rank - 1, len(words) - 1)
        x = np.where(need, (x << np.uint64(32)) | words.take(where), x)
        state = np.where(live, x, state)
        at += rank[:, -1]
        out[:, t] = s
    return out.reshape(-1)[:min(n, last * every * lanes) - first * every * lanes]


def text_bytes(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, and where each begins and the last one ends."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    return np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


class LibraryEncoder:
    """The tokenizers library, which is asked once for stretches of text that come again and again."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"       # Spark already runs a task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = self.tokenizer
        self.added = [t.content for t in spec.get_added_tokens_decoder().values()]
        self.dtype = "<u2" if spec.get_vocab_size() <= 1 << 16 else "<u4"
        pre = str(spec.pre_tokenizer)
        # Cutting before single blanks, at line ends and after letters is only right for plain byte-level words.
        self.cuts = pre.startswith("ByteLevel(add_prefix_space=False") and "use_regex=True" in pre and spec.normalizer is None
        line_end = spec.encode("\n", add_special_tokens=False).ids
        self.line_end = line_end[0] if self.cuts and len(line_end) == 1 and not any("\n" in a for a in self.added) else None
        vocabulary = spec.get_vocab()
        self.opens = np.zeros(1 + max(vocabulary.values(), default=0), dtype=bool)
        self.opens[[i for t, i in vocabulary.items() if t.startswith(BLANK)]] = True
        # Stretch number i has the next sizes[i] ids of the pool.
        self.known: dict[str, int] = {}
        self.pool, self.sizes = np.zeros(0, self.dtype), np.zeros(0, np.int64)

    def regular(self, texts: pa.LargeStringArray) -> np.ndarray:
        """Which texts may be cut: their blanks are single ones and line ends, each between other characters."""
        odd = pc.match_substring_regex(texts, IRREGULAR) if self.cuts else pa.array([True] * len(texts))
        for a in self.added:
            odd = pc.or_(odd, pc.match_substring(texts, a))
        return ~odd.to_numpy(zero_copy_only=False)

    def cut(self, texts: pa.LargeStringArray) -> tuple[pa.LargeStringArray, np.ndarray]:
        """Stretches of regular texts, and the place of each text's first one: before blanks, after line ends and letters' ends."""
        data, offsets = text_bytes(texts)
        line_end = data == 0x0A
        first = line_end | (data == 0x20)
        first[1:] |= line_end[:-1]
        # Letters of ASCII, and those of two bytes up to U+01FF; what follows in ASCII is a word of its own.
        letter = ((data | 0x20) - np.uint8(0x61)) < 26
        letter[1:] |= (data[:-1] >= 0xC3) & (data[:-1] <= 0xC7) & ~((data[:-1] == 0xC3) & ((data[1:] | 0x20) == 0xB7))
        first[1:] |= letter[:-1] & ~letter[1:] & (data[1:] < 0x80)
        first[offsets[:-1][np.diff(offsets) > 0]] = True
        at = np.append(np.flatnonzero(first), len(data))
        return pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(data)), np.searchsorted(at, offsets)

    def stretches(self, text: str) -> list[str] | None:
        """The stretches of one text; None if it must be encoded as a whole."""
        texts = pa.array([text], pa.large_string())
        return self.cut(texts)[0].to_pylist() if self.regular(texts)[0] else None

    def asked(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def asked_in_runs(self, stretches: list[str]) -> tuple[list[str], list[np.ndarray], list[np.ndarray]]:
        """The stretches in some order, their ids and sizes. Many go in one text, told apart by the blanks that they begin
        with, or by line ends put between them."""
        opened, ended, alone, order, ids, sizes = [], [], [], [], [], []
        for t in stretches:
            (alone if self.line_end is None or "\n" in t else opened if t[0] == " " and t[1:].isalpha() else ended).append(t)
        for group, between in ((opened, ""), (ended, "\n")):
            runs = [group[i:i + RUN] for i in range(0, len(group), RUN)]
            for run, got in zip(runs, self.asked([between.join(r) for r in runs])):
                ends = np.flatnonzero(got == self.line_end) if between else np.flatnonzero(self.opens[got])[1:]
                if len(ends) != len(run) - 1:
                    alone += run
                    continue
                order += run
                sizes.append(np.diff(ends, prepend=-1 if between else 0, append=len(got)) - len(between))
                ids.append(np.delete(got, ends) if between else got)
        whole = self.asked(alone)
        return order + alone, ids + whole, [*sizes, np.array([len(x) for x in whole], np.int64)]

    def numbers(self, stretches: list[str]) -> np.ndarray:
        """Numbers of different stretches; the library is asked for those that are not known."""
        found = np.fromiter(map(self.known.get, stretches, repeat(-1)), np.int64, len(stretches))
        unknown = np.flatnonzero(found < 0)
        if not len(unknown):
            return found
        if len(self.known) + len(unknown) > REMEMBERED:
            kept = np.zeros(len(self.sizes), dtype=bool)
            kept[-REMEMBERED // 3:] = kept[found[found >= 0]] = True
            moved = np.cumsum(kept) - 1
            self.known = dict(zip(compress(self.known, kept), range(len(kept))))
            self.pool, self.sizes = self.pool[np.repeat(kept, self.sizes)], self.sizes[kept]
            found[found >= 0] = moved[found[found >= 0]]
        fresh = [stretches[i] for i in unknown.tolist()]
        order, ids, sizes = self.asked_in_runs(fresh)
        self.known.update(zip(order, range(len(self.known), len(self.known) + len(order))))
        self.pool, self.sizes = np.concatenate([self.pool, *ids]), np.concatenate([self.sizes, *sizes])
        found[unknown] = np.fromiter(map(self.known.__getitem__, fresh), np.int64, len(fresh))
        return found

    def put_together(self, texts: pa.LargeStringArray, end: bytes) -> list[bytes]:
        """Ids of regular texts: each different stretch is looked up once."""
        words, first = self.cut(texts)
        coded = words.dictionary_encode()
        listed = pa.LargeListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int64()), coded.dictionary)
        joined = pc.binary_join(listed, pa.scalar("\0", pa.large_string()))[0].as_py()          # to_pylist is slower
        found = self.numbers(joined.split("\0") if joined else [])
        starts, size, index = (np.cumsum(self.sizes) - self.sizes)[found], self.sizes[found], coded.indices.to_numpy()
        n = size[index]
        ends = np.concatenate([[0], np.cumsum(n)])
        small = np.int32 if max(ends[-1], len(self.pool)) < 1 << 31 else np.int64
        raw = self.pool[np.repeat((starts[index] - ends[:-1]).astype(small), n) + np.arange(ends[-1], dtype=small)].tobytes()
        bounds = (ends[first] * self.pool.itemsize).tolist()
        return [raw[a:b] + end for a, b in zip(bounds, bounds[1:])]

    def encode(self, texts: list[str | None] | pa.Array, end_id: int) -> list[bytes]:
        end = np.array([end_id], self.dtype).tobytes()
        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        texts = pc.fill_null(texts, "")
        offsets, out, at = text_bytes(texts)[1] if len(texts) else None, [], 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, "right")) - 1)
            part, at = texts.slice(at, to - at), to
            regular = self.regular(part)
            got = iter(self.put_together(part.filter(pa.array(regular)), end) if regular.any() else ())
            whole = iter(self.asked(part.filter(pa.array(~regular)).to_pylist()))
            out += [next(got) if r else next(whole).tobytes() + end for r in regular.tolist()]
        return out


@lru_cache(maxsize=2)
def library(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
    """Ids and texts of so many batches that the texts have ``SLICE_BYTES``; what is left comes last."""
    held, size = [], 0
    for batch in batches:
        held.append((batch.column(0), batch.column(1).cast(pa.large_string())))
        size += batch.column(1).nbytes
        if size >= SLICE_BYTES:
            yield [pa.concat_arrays(c) for c in zip(*held)]
            held, size = [], 0
    if held:
        yield [pa.concat_arrays(c) for c in zip(*held)]


BLOCK = "shard int, block int, doc_ids array<long>, lengths array<long>, n_tokens long"


def token_blocks(docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of whole documents in ascending order, gathered into blocks: BLOCK and ids (binary, 16 or 32 bits each)."""
    schema = StructType.fromDDL(f"{BLOCK}, ids binary")

    def run(batches):
        encoder, arrow, shard, block = library(path), to_arrow_schema(schema), TaskContext.get().partitionId(), 0
        doc_ids, ids, held = [], [], 0
        width = np.dtype(encoder.dtype).itemsize

        def full():
            return pa.RecordBatch.from_pylist([{
                "shard": shard, "block": block, "doc_ids": doc_ids, "lengths": [len(x) // width for x in ids], "n_tokens": held,
                "ids": b"".join(ids)}], schema=arrow)

        for some_ids, texts in gathered(batches):
            for doc, got in zip(some_ids.to_pylist(), encoder.encode(texts, end_id)):
                doc_ids.append(doc)
                ids.append(got)
                held += len(got) // width
                if held >= BLOCK_TOKENS:
                    yield full()
                    doc_ids, ids, held, block = [], [], 0, block + 1
        if doc_ids:
            yield full()

    docs = keyed(docs, id_col, text_col)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    order = ["doc_id", F.xxhash64("text"), "text"]
    ordered = docs.repartitionByRange(max(1, -(-size // SHARD_BYTES)), *order[:2]).sortWithinPartitions(*order)
    return ordered.mapInArrow(run, schema)


def count_ids(blocks: DataFrame, path: str) -> dict[int, int]:
    """How often each id occurs; at most one row per id of the vocabulary is collected."""
    schema = StructType.fromDDL("id int, n long")

    def run(batches):
        dtype, total = library(path).dtype, np.zeros(0, np.int64)
        for batch in batches:
            for ids in batch.column(0):
                c = np.bincount(np.frombuffer(ids.as_py(), dtype))
                if len(c) > len(total):
                    total = np.pad(total, (0, len(c) - len(total)))
                total[:len(c)] += c
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], schema=to_arrow_schema(schema))

    return {r["id"]: r["n"] for r in blocks.select("ids").mapInArrow(run, schema).groupBy("id").agg(F.sum("n").alias("n")).collect()}


def write_tokens(docs: DataFrame, path: str, folder: str, end_id: int = 2) -> None:
    """Encodes every document and writes the file set to ``folder``; ``path`` names the tokenizer's file."""
    spark = docs.sparkSession
    blocks = stored(token_blocks(docs, path, end_id), "token-blocks", compression="zstd")
    table = Table(count_ids(blocks, path))
    used = np.flatnonzero(table.f)
    spark.createDataFrame([(int(i), int(table.f[i])) for i in used], "id int, frequency long").coalesce(1).write.parquet(f"{folder}/table")
    shared = spark.sparkContext.broadcast(table)
    schema = StructType.fromDDL(f"{BLOCK}, payload binary")

    def run(batches):
        arrow, table, dtype = to_arrow_schema(schema), shared.value, library(path).dtype
        for batch in batches:
            for i in range(batch.num_rows):
                payload = encode_block(np.frombuffer(batch.column(5)[i].as_py(), dtype), table)
                yield pa.RecordBatch.from_arrays([*(c.slice(i, 1) for c in batch.columns[:5]), pa.array([payload], pa.binary())], schema=arrow)

    blocks.mapInArrow(run, schema).write.option("compression", "none").parquet(f"{folder}/blocks")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, shard, block, offset (of the document in its block), n_tokens, ids (little-endian unsigned 32-bit)."""
    frequencies = {r["id"]: r["frequency"] for r in spark.read.parquet(f"{folder}/table").collect()}
    f = np.zeros(1 + max(frequencies, default=0), dtype=np.int64)
    f[list(frequencies)] = list(frequencies.values())
    table = Table({})
    table.use(f)
    shared = spark.sparkContext.broadcast(table)
    schema = StructType.fromDDL("doc_id long, shard int, block int, offset long, n_tokens long, ids binary")

    def run(batches):
        arrow, table = to_arrow_schema(schema), shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                doc_ids, lengths = batch.column(2)[i].values, np.asarray(batch.column(3)[i].values)
                ids = decode_block(batch.column(4)[i].as_py(), table).astype("<u4")
                ends = np.cumsum(lengths)
                n = len(lengths)
                yield pa.RecordBatch.from_arrays([
                    doc_ids, pa.array([batch.column(0)[i].as_py()] * n, pa.int32()), pa.array([batch.column(1)[i].as_py()] * n, pa.int32()),
                    pa.array(ends - lengths), pa.array(lengths), pa.array([ids[a:b].tobytes() for a, b in zip(ends - lengths, ends)], pa.binary())], schema=arrow)

    return spark.read.parquet(f"{folder}/blocks").select("shard", "block", "doc_ids", "lengths", "payload").mapInArrow(run, schema)


def block_starts(spark: SparkSession, folder: str) -> DataFrame:
    """shard, block, start: the ids before each block. Only shards, one row for ``SHARD_BYTES`` of text, meet in one task."""
    sizes = spark.read.parquet(f"{folder}/blocks").select("shard", "block", "n_tokens")
    before = F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shards = sizes.groupBy("shard").agg(F.sum("n_tokens").alias("n")).select("shard", before.alias("before"))
    inside = F.coalesce(F.sum("n_tokens").over(Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return sizes.select("shard", "block", inside.alias("inside")).join(shards, "shard").select("shard", "block", (F.col("before") + F.col("inside")).alias("start"))


def report(docs: DataFrame, path: str, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read from the files just written."""
    spark = docs.sparkSession
    write_tokens(docs, path, folder)
    read = read_tokens(spark, folder).select("doc_id", "shard", "block", "offset", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    return read.join(block_starts(spark, folder), ["shard", "block"]).select(
        "doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")
