"""Toxicity grades by cumulative-link ordinal regression.

Features are the distinct words of a text and their beginnings (``PREFIXES``), hashed to ``BUCKETS``; one weight per feature is shared by all thresholds, so
P(grade > k) = sigmoid(w.x - t_k) with t_0 < t_1, and the expected severity is the sum of these probabilities.

Training rows are labelled documents: at most ``FIT_ROWS`` of them, those whose ids hash lowest, so the choice does not
depend on order. The labels only tell toxic from not; a toxic row's grade is 2 if it holds more of the features that
set toxic rows apart than the median toxic row, else 1. Only features that set grades apart are kept (``LEAST_ROWS``,
``LEAST_LIFT``, ``LEAST_Z``), so that a long text does not gather the noise of thousands of weights; the bounds are fixed, so that a
rare kind of toxicity or a small language is not measured against the most frequent mark. Only ids of buckets reach the
driver, and the fitted model is at most one weight per bucket.

Defined results: a null or empty text has the severity of no features; labels that are null are left out; without both
toxic and other labels there is no model, every severity is 0 and nothing is rejected; repeated rows and null ids stay;
other columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import dataclasses

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from millrace.llm.common import ALNUM, TextBatch, id_array, keyed, pieces, words

BUCKETS = 1 << 18
FIT_ROWS = 20_000
LEAST_ROWS = 5
LEAST_LIFT = 8.0
LEAST_Z = 6.0
# Beginnings of words, in bytes, that are features besides whole words: inflected words share them.
PREFIXES = (4, 5, 6)
# A text is rejected from this expected severity on.
REJECT = 0.5


@dataclasses.dataclass
class Model:
    weights: np.ndarray           # by bucket; 0 for features left out
    thresholds: np.ndarray

    def above(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for each score and k."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - scores[:, None], -60, 60)))


def distinct_buckets(p: TextBatch) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of each distinct feature of each document: its words and their beginnings."""
    w = words(p, ALNUM)
    doc, hashes = [w.doc], [w.hashes]
    for n in PREFIXES:
        longer = w.end - w.start > n
        doc.append(w.doc[longer])
        hashes.append(w.hashed(w.start[longer], w.start[longer] + n) + np.uint64(n))
    hashed = np.concatenate(hashes) % np.uint64(BUCKETS)
    both = np.unique(np.concatenate(doc).astype(np.int64) * BUCKETS + hashed.astype(np.int64))
    return both // BUCKETS, both % BUCKETS


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, buckets): the distinct buckets of each text as 32-bit integers."""
    schema = StructType.fromDDL("doc_id long, buckets binary")

    def run(batches):
        for batch in batches:
            for p in pieces(batch):
                doc, bucket = distinct_buckets(p)
                ends = np.searchsorted(doc, np.arange(len(p) + 1))
                flat = bucket.astype("<u4")
                rows = [flat[a:b].tobytes() for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays([id_array(p), pa.array(rows, pa.binary())], schema=to_arrow_schema(schema))

    return docs.mapInArrow(run, schema)


def fit_rows(rows: list[np.ndarray], toxic: np.ndarray, steps: int = 300, ridge: float = 1e-3) -> Model | None:
    """The model of these rows (arrays of buckets) and their labels."""
    n, n_toxic = len(rows), int(toxic.sum())
    if not 0 < n_toxic < n:
        return None
    row = np.repeat(np.arange(n), [len(r) for r in rows])
    col = np.concatenate(rows).astype(np.int64)
    in_toxic = np.bincount(col[toxic[row]], minlength=BUCKETS)
    in_other = np.bincount(col[~toxic[row]], minlength=BUCKETS)
    lift = ((in_toxic + 0.5) / (n_toxic + 1)) / ((in_other + 0.5) / (n - n_toxic + 1))
    expected = (in_toxic + in_other) * n_toxic / n
    z = (in_toxic - expected) / np.sqrt(np.maximum(expected, 1e-9))
    marks = (in_toxic >= LEAST_ROWS) & (lift >= LEAST_LIFT) & (z >= LEAST_Z)
    # Features against toxicity would let clean words outweigh toxic ones in a long text; the intercept does their work.
    held = np.bincount(row, weights=marks[col], minlength=n)
    grade = toxic.astype(int) + (toxic & (held > np.median(held[toxic])))
    chosen = np.flatnonzero(marks)
    if not len(chosen):
        return None
    place = np.full(BUCKETS, -1)
    place[chosen] = np.arange(len(chosen))
    used = place[col] >= 0
    row, col = row[used], place[col[used]]
    w, t = np.zeros(len(chosen)), np.array([1.0, 3.0])
    first, second = np.zeros(len(chosen) + 2), np.zeros(len(chosen) + 2)
    weight = np.where(toxic, n / (2 * n_toxic), n / (2 * (n - n_toxic)))     # both classes count alike
    edges = np.arange(2)
    for step in range(1, steps + 1):                                        # Adam on the negative log likelihood
        score = np.bincount(row, weights=w[col], minlength=n)
        up = 1 / (1 + np.exp(np.clip(t - score[:, None], -60, 60)))          # P(grade > k)
        low, high = np.column_stack([np.ones(n), up]), np.column_stack([up, np.zeros(n)])
        p = np.maximum(low - high, 1e-12)[np.arange(n), grade]
        slope = up * (1 - up)
        d_low = np.column_stack([np.zeros(n), slope])[np.arange(n), grade]
        d_high = np.column_stack([slope, np.zeros(n)])[np.arange(n), grade]
        g = -weight * (d_low - d_high) / p
        g_w = np.bincount(col, weights=g[row], minlength=len(chosen)) / n + ridge * w
        g_t = np.array([(weight / p * ((grade == k + 1) * slope[:, k] - (grade == k) * slope[:, k])).sum() for k in edges]) / n
        grad = np.concatenate([g_w, g_t])
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad ** 2
        move = 0.1 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
        w, t = np.maximum(w - move[:-2], 0), t - move[-2:]
        t[1] = max(t[1], t[0] + 1e-3)
    weights = np.zeros(BUCKETS)
    weights[chosen] = w
    return Model(weights, t)


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model | None:
    """Fits on at most ``rows`` labelled documents (keyed columns doc_id, text; labels doc_id, toxic)."""
    chosen = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # ``rows`` bounds both the broadcast and what is collected.
    some = docs.join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi")
    toxic = {r["doc_id"]: bool(r["toxic"]) for r in chosen.collect()}
    seen: dict[int, np.ndarray] = {}
    for r in features(some).toLocalIterator(prefetchPartitions=True):
        seen.setdefault(r["doc_id"], np.frombuffer(r["buckets"], "<u4"))
    ids = sorted(seen)
    return fit_rows([seen[i] for i in ids], np.array([toxic[i] for i in ids], dtype=bool)) if ids else None


def severity(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, severity (expected grade), grade (the likeliest), rejected."""
    keyed_docs = keyed(docs, id_col, text_col)
    if model is None:
        return keyed_docs.select("doc_id", F.lit(0.0).alias("severity"), F.lit(0).alias("grade"), F.lit(False).alias("rejected"))
    schema = StructType.fromDDL("doc_id long, severity double, grade int, rejected boolean")
    shared = docs.sparkSession.sparkContext.broadcast(model)     # at most BUCKETS weights

    def run(batches):
        model, arrow = shared.value, to_arrow_schema(schema)
        for batch in batches:
            for p in pieces(batch):
                doc, bucket = distinct_buckets(p)
                up = model.above(np.bincount(doc, weights=model.weights[bucket], minlength=len(p)))
                each = -np.diff(np.column_stack([np.ones(len(p)), up, np.zeros(len(p))]), axis=1)
                expected = up.sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [id_array(p), pa.array(expected), pa.array(each.argmax(axis=1).astype(np.int32)), pa.array(expected >= REJECT)], schema=arrow)

    return keyed_docs.mapInArrow(run, schema)


def grade_documents(docs: DataFrame, labels: DataFrame, train: DataFrame | None = None) -> DataFrame:
    """Severities of ``docs`` by a model fitted on the labelled rows of ``train`` (by default ``docs``)."""
    return severity(docs, fit(keyed(docs if train is None else train), labels))
