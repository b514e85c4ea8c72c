"""What the text operators share: reading, Arrow batches and vectorised words.

Texts stay in Arrow buffers inside a task. ``TextBatch`` holds the UTF-8 bytes of some whole documents in one array;
``words`` finds all their words at once. A batch is cut into pieces of about ``PIECE_BYTES``, always between documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from millrace.session import work_dir

# Rows per Arrow batch: documents can be long, so few of them travel at once.
ARROW_ROWS = 512
PIECE_BYTES = 1 << 21

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Bytes of words: digits, letters and everything beyond ASCII; or all but blanks.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
NONBLANK = np.ones(256, dtype=bool)
NONBLANK[0x20] = NONBLANK[0x09:0x0E] = False

_BASE = 0x9E3779B97F4A7C15
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, under fixed names; a null text is an empty one. Other columns never reach Python.

    Sets the session's rows per Arrow batch to ``ARROW_ROWS``, which bounds what a task holds of long texts."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def per_text(docs: DataFrame, fn: Callable[[str], tuple], schema: str) -> DataFrame:
    """One row per document: its id and what ``fn`` makes of the text. ``schema`` lists the fields after doc_id."""
    fields = StructType.fromDDL(f"doc_id long, {schema}")
    arrow = to_arrow_schema(fields)

    def run(batches):
        for batch in batches:
            rows = [fn(t) for t in batch.column(1).to_pylist()]
            columns = zip(*rows) if rows else [[] for _ in arrow.names[1:]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), *(pa.array(list(c), type=f.type) for c, f in zip(columns, list(arrow)[1:]))],
                schema=arrow)

    return docs.mapInArrow(run, fields)


class TextBatch:
    """Whole documents as one byte array: ``data[offsets[i]:offsets[i + 1]]`` is document i."""

    def __init__(self, ids: np.ndarray, valid: np.ndarray, data: np.ndarray, offsets: np.ndarray):
        self.ids, self.valid, self.data, self.offsets = ids, valid, data, offsets

    def __len__(self) -> int:
        return len(self.ids)


def pieces(batch: pa.RecordBatch, size: int = PIECE_BYTES) -> Iterator[TextBatch]:
    """The batch (doc_id, text) in pieces of about ``size`` bytes, a longer document alone."""
    text = batch.column(1)
    text = text.cast(pa.large_binary()) if not pa.types.is_large_binary(text.type) else text
    offsets = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset:text.offset + len(text) + 1]
    data = np.frombuffer(text.buffers()[2], dtype=np.uint8) if text.buffers()[2] else np.zeros(0, np.uint8)
    valid = np.asarray(batch.column(0).is_valid())
    ids = np.asarray(batch.column(0).fill_null(-1)).astype(np.int64)
    at = 0
    while at < len(ids):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        lo, hi = int(offsets[at]), int(offsets[end])
        yield TextBatch(ids[at:end], valid[at:end], data[lo:hi], offsets[at:end + 1] - lo)
        at = end


def id_array(batch: TextBatch) -> pa.Array:
    return pa.array(batch.ids, type=pa.int64(), mask=~batch.valid)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n + 1:
        size = max(n + 1, PIECE_BYTES + 1)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS[0], _POWERS[1]


class Words:
    """All words of a piece: document, byte span and a 64-bit hash of the lower-cased bytes."""

    def __init__(self, doc: np.ndarray, start: np.ndarray, end: np.ndarray, total: np.ndarray, inverse: np.ndarray, n_docs: int):
        self.doc, self.start, self.end, self._total, self._inverse = doc, start, end, total, inverse
        self.hashes = self.hashed(start, end)
        self.count = np.bincount(doc, minlength=n_docs)
        self.first = np.concatenate([[0], np.cumsum(self.count)])

    def hashed(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of byte spans, words or parts of them."""
        return mix((self._total[end] - self._total[start]) * self._inverse[start] + (end - start).astype(np.uint64))


def words(batch: TextBatch, kind: np.ndarray = NONBLANK) -> Words:
    data = LOWER[batch.data]
    inside = kind[data]
    n = len(data)
    before = np.zeros(n + 1, dtype=bool)
    before[1:] = inside
    before[batch.offsets] = False                     # words end with their document
    after = np.zeros(n + 1, dtype=bool)
    after[:n] = inside
    after[batch.offsets] = False
    start = np.flatnonzero(inside & ~before[:n])
    end = np.flatnonzero(inside & ~after[1:]) + 1
    power, inverse = _powers(n)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=total[1:])
    doc = np.searchsorted(batch.offsets, start, "right") - 1
    return Words(doc, start, end, total, inverse, len(batch))


def hash_bytes(data: bytes, kind: np.ndarray = NONBLANK) -> np.ndarray:
    """Hashes of the words of one text, equal to those of ``words``."""
    array = np.frombuffer(data, dtype=np.uint8)
    return words(TextBatch(np.zeros(1, np.int64), np.ones(1, bool), array, np.array([0, len(array)])), kind).hashes


def stored(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """``df`` written as Parquet to the folder all executors share and read again: its lineage ends there."""
    spark = df.sparkSession
    path = work_dir(spark, label)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
