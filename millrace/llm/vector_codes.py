"""Vectors compressed to one codebook index per part, with exact integer arithmetic.

Components become integers, floor(``SCALE`` x), and vectors are cut into equal parts, each position with a codebook of its
own. A task gathers up to ``CHUNK`` vectors; at each position it sorts their parts along a Hilbert curve and cuts them
into flat blocks of ``BLOCK`` that carry the least and greatest components and the sums. Every round compares boxes with
entries first: an entry whose least distance to a box passes the smallest of the greatest distances can be nearest to no
part inside. What is left is the block's shortlist. Where it is one entry, the whole block goes there by its sums; else
small integer kernels, one call for all blocks with equally many entries left, measure each part exactly (ties to the
lower index). Sums and counts are added up in Spark, and the codebooks replaced; at last every part is assigned again.

Chunks are written once and read again each round; a round shuffles entries' sums only, never vectors. What reaches the
driver is bounded by the codebooks' size: the rows they start from and one sum per component of an entry. Chunks sort
their own vectors, so more rows mean more chunks of the same shape. Totals by label are broadcast up to
``BROADCAST_ROWS`` labels, beyond that joined by a shuffle.

Defined results: vectors that are null, empty or hold null or non-finite components are dropped; so are those of another
length than most (of the lengths that can be cut; the smaller of equally common ones) and those with a component beyond
2^45 in size, which is all that the arithmetic covers. Repeated rows and ids are rows of their own. Codebooks start
from the smallest ids, equal ids by their components, null ids last; with fewer rows than entries there are as many
entries as rows. An error too large for a long becomes the largest long. Null labels are one label. Other columns are
ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from contextlib import contextmanager
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from millrace.llm.common import stored

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
CHUNK = 8_192
BLOCK = 32
# Numbers that one kernel call holds at once.
KERNEL = 1 << 20
BROADCAST_ROWS = 200_000
LARGEST = 2.0 ** 45
LONG_MAX = (1 << 63) - 1


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """So many rows per Arrow batch for the jobs run inside."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place of each row of ``cells`` (coordinates of ``bits`` bits) along a Hilbert curve (Skilling's transform)."""
    x = cells.astype(np.int64).T.copy()
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for axis in x:
            flip = (axis >> level) & 1 == 1
            swapped = np.where(flip, 0, (x[0] ^ axis) & low)
            x[0] ^= np.where(flip, low, swapped)
            axis ^= swapped
    for before, axis in zip(x[:-1], x[1:]):
        axis ^= before
    turned = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turned ^= np.where((x[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= turned
    keys = np.zeros_like(turned)
    for level in range(bits - 1, -1, -1):
        for axis in x:
            keys = (keys << 1) | ((axis >> level) & 1)
    return keys


class Blocks:
    """The parts of one chunk: for each position in Hilbert order, in blocks of ``BLOCK``, the last one filled up with its
    last part. Arrays have one row per block, position by position."""

    FIELDS = "n int, dim int, wide int, places binary, parts binary, low binary, high binary, sums binary"

    def __init__(self, n: int, dim: int, places: np.ndarray, parts: np.ndarray, low: np.ndarray, high: np.ndarray, sums: np.ndarray):
        self.n, self.dim, self.places, self.parts, self.low, self.high, self.sums = n, dim, places, parts, low, high, sums

    @classmethod
    def of(cls, vectors: np.ndarray) -> Blocks:
        """From whole vectors, n by PARTS by dim integers."""
        n, _, dim = vectors.shape
        flat = vectors.transpose(1, 0, 2)                                    # position, vector, component
        axes = flat[:, :, :62]
        bits = max(1, min(8, 62 // axes.shape[2]))
        least = axes.min(axis=1, keepdims=True)
        span = np.maximum(axes.max(axis=1, keepdims=True) - least, 1)
        cells = ((axes - least) / span * ((1 << bits) - 1)).astype(np.int64)
        keys = hilbert_keys(cells.reshape(-1, axes.shape[2]), bits).reshape(PARTS, n)
        places = keys.argsort(axis=1, kind="stable")
        places = np.pad(places, ((0, 0), (0, -n % BLOCK)), mode="edge")
        parts = np.take_along_axis(flat, places[:, :, None], axis=1).reshape(-1, BLOCK, dim)
        real = (np.arange(places.shape[1]) < n).reshape(1, -1, BLOCK, 1)
        sums = np.where(np.broadcast_to(real, (PARTS, *real.shape[1:])).reshape(-1, BLOCK, 1), parts, 0).sum(axis=1)
        return cls(n, dim, places.astype(np.int32), parts, parts.min(axis=1), parts.max(axis=1), sums)

    def row(self) -> tuple:
        size = max(abs(int(self.low.min())), abs(int(self.high.max())))
        wide = 2 if size < 1 << 15 else 4 if size < 1 << 31 else 8
        small = [a.astype(f"<i{wide}").tobytes() for a in (self.parts, self.low, self.high)]
        return (self.n, self.dim, wide, self.places.astype("<i4").tobytes(), *small, self.sums.astype("<i8").tobytes())

    @classmethod
    def read(cls, n: int, dim: int, wide: int, places: bytes, parts: bytes, low: bytes, high: bytes, sums: bytes) -> Blocks:
        parts, low, high = (np.frombuffer(x, f"<i{wide}").astype(np.int64) for x in (parts, low, high))
        return cls(n, dim, np.frombuffer(places, "<i4").reshape(PARTS, -1), parts.reshape(-1, BLOCK, dim), low.reshape(-1, dim),
                   high.reshape(-1, dim), np.frombuffer(sums, "<i8").reshape(-1, dim))

    def numbers(self, books: np.ndarray):
        """The smallest number type that holds every sum of squared differences exactly."""
        size = max(abs(int(x)) for x in (self.low.min(), self.high.max(), books.min(), books.max()))
        largest = PARTS * self.dim * (2 * size) ** 2
        return np.int32 if largest < 1 << 31 else np.int64 if largest < 1 << 63 else object

    def shortlists(self, books: np.ndarray, numbers) -> tuple[np.ndarray, np.ndarray]:
        """(position of each block, its entries that may be nearest to some part in it)."""
        position = np.repeat(np.arange(PARTS), self.places.shape[1] // BLOCK)
        least, greatest = 0, 0
        for axis in range(self.dim):
            entry = books[:, :, axis].astype(numbers)[position]
            under = self.low[:, axis].astype(numbers)[:, None] - entry
            over = entry - self.high[:, axis].astype(numbers)[:, None]
            gap = np.maximum(np.maximum(under, over), 0)
            reach = np.maximum(-under, -over)                     # to the farther side of the box
            least, greatest = least + gap * gap, greatest + reach * reach
        return position, least <= greatest.min(axis=1)[:, None]

    def assign(self, books: np.ndarray, totals: bool):
        """With ``totals``: sums and counts per position and entry. Else: codes and squared distances, n by PARTS."""
        numbers = self.numbers(books)
        position, listed = self.shortlists(books, numbers)
        width = listed.sum(axis=1)
        real = np.tile((np.arange(self.places.shape[1]) < self.n).reshape(-1, BLOCK), (PARTS, 1))
        entries = books.shape[1]
        codes = np.zeros((len(width), BLOCK), dtype=np.int64)
        error = np.zeros((len(width), BLOCK), dtype=numbers)
        for size in np.unique(width).tolist():
            of_size = np.flatnonzero(width == size)
            entry = np.nonzero(listed[of_size])[1].reshape(-1, size)
            if size == 1 and totals:
                codes[of_size] = entry
                continue
            step = max(1, KERNEL // (BLOCK * size))
            for at in range(0, len(of_size), step):
                some, near = of_size[at:at + step], entry[at:at + step]
                distance = 0
                for axis in range(self.dim):
                    to = books[position[some, None], near, axis].astype(numbers)
                    apart = self.parts[some, :, axis].astype(numbers)[:, :, None] - to[:, None, :]
                    distance = distance + apart * apart
                best = distance.argmin(axis=2)
                codes[some] = np.take_along_axis(near, best, axis=1)
                error[some] = np.take_along_axis(distance, best[:, :, None], axis=2)[:, :, 0]
        if not totals:
            out_codes, out_error = np.zeros((self.n, PARTS), np.uint8), np.zeros((self.n, PARTS), numbers)
            for k in range(PARTS):
                out_codes[self.places[k, :self.n], k] = codes.reshape(PARTS, -1)[k, :self.n]
                out_error[self.places[k, :self.n], k] = error.reshape(PARTS, -1)[k, :self.n]
            return out_codes, out_error
        sums = np.zeros((PARTS * entries, self.dim + 1), dtype=object)
        whole = np.flatnonzero(width == 1)
        slot = position[whole] * entries + codes[whole, 0]
        np.add.at(sums, slot, np.column_stack([self.sums[whole], real[whole].sum(axis=1)]).astype(object))
        rest = np.flatnonzero(width > 1)
        held = real[rest].ravel()
        slot = (position[rest, None] * entries + codes[rest]).ravel()[held]
        parts = self.parts[rest].reshape(-1, self.dim)[held]
        sums[:, self.dim] += np.bincount(slot, minlength=len(sums))
        if numbers is object:
            np.add.at(sums[:, :self.dim], slot, parts.astype(object))
        else:                                     # so small that a double holds a chunk's sums exactly
            for axis in range(self.dim):
                sums[:, axis] += np.bincount(slot, weights=parts[:, axis], minlength=len(sums)).astype(np.int64)
        return sums


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """vec_id, label and embedding (doubles) of the vectors that take part, but for their length."""
    fits = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST))
    return vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
        F.col(vector_col).cast("array<double>").alias("embedding")).where((F.size("embedding") > 0) & fits)


def integers(column: pa.Array, dim: int) -> np.ndarray:
    values = np.asarray(column.flatten(), dtype=np.float64)
    return np.floor(values * SCALE).astype(np.int64).reshape(-1, PARTS, dim)


def chunked(rows: DataFrame, dim: int) -> DataFrame:
    """One row per chunk: its ids and labels, and its blocks."""
    label = rows.schema["label"].dataType
    schema = StructType([StructField("ids", ArrayType(LongType())), StructField("labels", ArrayType(label)),
                         *StructType.fromDDL(Blocks.FIELDS).fields])

    def run(batches):
        arrow = to_arrow_schema(schema)
        waiting, held = [], 0

        def chunk(rows: pa.Table) -> pa.RecordBatch:
            rows = rows.combine_chunks()
            ids, labels, vectors = (rows.column(k).chunk(0) for k in range(3))
            ends = pa.array([0, len(ids)], pa.int32())
            lists = [pa.ListArray.from_arrays(ends, x).cast(arrow.field(k).type) for k, x in enumerate((ids, labels))]
            row = Blocks.of(integers(vectors, dim)).row()
            return pa.RecordBatch.from_arrays([*lists, *(pa.array([x], arrow.field(k + 2).type) for k, x in enumerate(row))], schema=arrow)

        for batch in batches:
            if not batch.num_rows:
                continue
            waiting.append(batch)
            held += batch.num_rows
            if held >= CHUNK:
                rows = pa.Table.from_batches(waiting)
                whole = held - held % CHUNK
                for at in range(0, whole, CHUNK):
                    yield chunk(rows.slice(at, CHUNK))
                waiting, held = (rows.slice(whole).to_batches() if whole < held else []), held - whole
        if held:
            yield chunk(pa.Table.from_batches(waiting))

    return rows.mapInArrow(run, schema)


def blocks_of(batch: pa.RecordBatch):
    for row in batch.select(list(range(batch.num_columns))[-8:]).to_pylist():
        yield Blocks.read(**row)


def round_sums(chunks: DataFrame, books: np.ndarray) -> DataFrame:
    """(slot, total): the sum of each component, and the count, of the parts nearest to each entry."""
    schema = StructType.fromDDL("slot int, total decimal(38,0)")

    def run(batches):
        sums = 0
        for batch in batches:
            for blocks in blocks_of(batch):
                sums = sums + blocks.assign(books, totals=True)
        if not isinstance(sums, int):
            flat = sums.ravel().tolist()
            some = [k for k, x in enumerate(flat) if x]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), pa.array([Decimal(flat[k]) for k in some], pa.decimal128(38, 0))], schema=to_arrow_schema(schema))

    fields = StructType.fromDDL(Blocks.FIELDS).fieldNames()
    return chunks.select(*fields).mapInArrow(run, schema).groupBy("slot").agg(F.sum("total").cast("decimal(38,0)").alias("total"))


def assigned(chunks: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code, error of every vector."""
    label = chunks.schema["labels"].dataType.elementType
    schema = StructType([StructField("vec_id", LongType()), StructField("label", label), StructField("code", StringType()), StructField("error", LongType())])

    def run(batches):
        arrow = to_arrow_schema(schema)
        for batch in batches:
            for k, blocks in enumerate(blocks_of(batch)):
                codes, error = blocks.assign(books, totals=False)
                text = codes.tobytes().hex()
                error = error.astype(np.int64 if error.dtype != object else object).sum(axis=1)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0)[k].values, batch.column(1)[k].values.cast(arrow.field(1).type),
                    pa.array([text[at:at + 2 * PARTS] for at in range(0, len(text), 2 * PARTS)], pa.string()),
                    pa.array([min(int(e), LONG_MAX) for e in error], pa.int64())], schema=arrow)

    return chunks.mapInArrow(run, schema)


def compress(vectors: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS, id_col: str = "vec_id", vector_col: str = "embedding",
             label_col: str = "label") -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) of every usable vector, and the codebooks: position, entry, component."""
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col, label_col)
    label = rows.schema["label"].dataType
    lengths = rows.groupBy(F.size("embedding").alias("n")).count().where(F.col("n") % PARTS == 0).orderBy(F.desc("count"), "n").first()
    if lengths is None:
        empty = StructType([StructField("vec_id", LongType()), StructField("label", label), StructField("code", StringType()), StructField("error", LongType())])
        return spark.createDataFrame([], empty), np.zeros((PARTS, 0, 0), dtype=np.int64)
    dim = lengths["n"] // PARTS
    rows = rows.where(F.size("embedding") == lengths["n"])
    start = rows.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).select("embedding").toArrow().combine_chunks()
    books = integers(start.column(0).chunk(0), dim).transpose(1, 0, 2).copy()
    with arrow_rows(spark, 4_096):
        chunks = stored(chunked(rows.select("vec_id", "label", "embedding"), dim), "vector-blocks")
    with arrow_rows(spark, 8):
        for _ in range(rounds):
            sums = np.zeros(PARTS * books.shape[1] * (dim + 1), dtype=object)
            for r in round_sums(chunks, books).collect():                   # at most one row per number in the codebooks
                sums[r["slot"]] = int(r["total"])
            sums = sums.reshape(PARTS, books.shape[1], dim + 1)
            for part, entry in zip(*np.nonzero(sums[:, :, dim])):
                books[part, entry] = [x // sums[part, entry, dim] for x in sums[part, entry, :dim]]
        return stored(assigned(chunks, books), "vector-codes"), books


def report(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256."""
    codes, books = compress(vectors)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    of_label = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG_MAX).cast("decimal(38,0)")).cast("long")
    totals = stored(codes.groupBy(F.col("label").alias("of")).agg(of_label.alias("label_error")), "label-errors")
    few = totals.count() <= BROADCAST_ROWS
    joined = codes.join(F.broadcast(totals) if few else totals, F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _sql() -> str:
    """For vectors of 64 components."""
    x = [f"x{j}" for j in range(4)]
    parts = ", ".join(f"CAST(floor({SCALE} * CAST(e[4 * part + {j + 1}] AS DOUBLE)) AS BIGINT) AS x{j}" for j in range(4))
    steps = []
    for k in range(ROUNDS + 1):
        distance = " + ".join(f"(p.{c} - b.{c}) * (p.{c} - b.{c})" for c in x)
        steps.append(f"a{k} AS (SELECT p.r, p.part, min(({distance}) * {ENTRIES} + b.entry) AS best FROM p JOIN b{k} b USING (part) GROUP BY ALL)")
        if k < ROUNDS:
            means = ", ".join(f"coalesce(n.{c}, b.{c}) AS {c}" for c in x)
            new = ", ".join(f"CAST(floor(CAST(sum(p.{c}) AS DOUBLE) / count(*)) AS BIGINT) AS {c}" for c in x)
            steps.append(f"n{k} AS (SELECT p.part, a.best % {ENTRIES} AS entry, {new} FROM p JOIN a{k} a USING (r, part) GROUP BY ALL)")
            steps.append(f"b{k + 1} AS (SELECT b.part, b.entry, {means} FROM b{k} b LEFT JOIN n{k} n USING (part, entry))")
    return f"""
WITH v AS (SELECT vec_id, label, embedding AS e, row_number() OVER (ORDER BY vec_id) - 1 AS r FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT r, part, {parts} FROM v, range({PARTS}) t(part)),
b0 AS (SELECT part, r AS entry, {", ".join(x)} FROM p WHERE r < {ENTRIES}),
{", ".join(steps)},
c AS (SELECT r, string_agg(printf('%02x', best % {ENTRIES}), '' ORDER BY part) AS code, CAST(sum(best // {ENTRIES}) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY r),
s AS (SELECT sha256(string_agg(concat_ws(',', {", ".join(x)}), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM v JOIN c USING (r), s
"""


# The same by assigning every part to every entry; for vectors of 64 components and ids without repeats.
SQL = _sql()
