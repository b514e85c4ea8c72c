"""Language-model scores by a hashed maximum-entropy model with class-factored softmax.

P(word | history) = P(class | history) P(word | class). Every frequent word (``TOP``) is a class of its own, all others
are classed by the hash of their last two bytes. P(class | history) is a softmax over ``CLASSES`` whose features are
hashed to ``BUCKETS`` or more buckets (``Facts.buckets``, by the distinct words of training): the previous word, the one before it (skip), both, and both their classes. P(word | class) is the
word's count in its class, one added; a word that training never saw counts as one more word of its class.

1. Whole documents are packed into blocks of about ``BLOCK_TOKENS``: distinct words once, most frequent first, tokens as
   places in that list, compressed.
2. Counts of words are summed over all training rows and come back to the blocks that hold the words, so that a task
   needs a block and nothing else: the vocabulary is never broadcast.
3. Each of ``ROUNDS`` rounds trains on its share of all training tokens: every task makes AdaGrad updates over its blocks
   and hands over its change; changes are averaged, weighted by tokens, in a tree of groups of ``FAN_IN``.
4. Every document is scored in sparse batches.

Broadcast and collected are only the weights (buckets * CLASSES), the top words and sums per class.

Defined results: a null or empty text has one token, its end; a null id belongs to training; repeated rows count and are
scored each; other columns are ignored; an empty table gives an empty one; without training rows every probability is
the model's start.
"""

from __future__ import annotations

import dataclasses

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from millrace.llm.common import NONBLANK, keyed, mix, pieces, stored, words

BLOCK_TOKENS = 4_000_000
TOP, ENDINGS = 16, 32
CLASSES = TOP + ENDINGS
BUCKETS = 1 << 14                        # at least; a power of two
ROUNDS = 2
BATCH = 8192
RATE = 0.3
SLICES = 16
FAN_IN = 64
END = np.uint64(0x5E17D0C7)              # stands for the end of a document
SEEDS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)

PACKED = "block long, doc_ids array<long>, held array<boolean>, lengths binary, tokens binary, words binary, endings binary, counts binary"


def squeezed(values: np.ndarray) -> bytes:
    """Small integers, byte planes one after the other, compressed."""
    return zstandard.compress(values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unsqueezed(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1).T).view("<u4").ravel()


def pack(docs: DataFrame) -> DataFrame:
    """Blocks of whole documents (PACKED); ``counts`` are of the block's training rows."""
    schema = StructType.fromDDL(PACKED)
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))

    def run(batches):
        arrow, seq, parts = to_arrow_schema(schema), 0, []

        def block():
            doc_ids, out, n, hashes, endings = (np.concatenate(c) for c in zip(*parts))
            own, first, tokens, often = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
            order = np.argsort(-often, kind="stable")
            rank = np.empty(len(order), dtype=np.int64)
            rank[order] = np.arange(len(order))
            tokens = rank[tokens]
            counts = np.bincount(tokens[np.repeat(~out, n)], minlength=len(own))
            return pa.RecordBatch.from_pydict({
                "block": [TaskContext.get().partitionId() << 32 | seq], "doc_ids": [doc_ids.tolist()], "held": [out.tolist()],
                "lengths": [n.astype("<i4").tobytes()], "tokens": [squeezed(tokens)], "words": [own[order].astype("<u8").tobytes()],
                "endings": [endings[first][order].tobytes()], "counts": [squeezed(counts)]}, schema=arrow)

        for batch in batches:
            at = 0
            for p in pieces(batch.select([0, 1])):
                out = np.asarray(batch.column(2).slice(at, len(p)))
                at += len(p)
                w = words(p, NONBLANK)
                n = w.count + 1
                ends = np.cumsum(n)
                is_end = np.zeros(int(ends[-1]), dtype=bool)
                is_end[ends - 1] = True
                hashes, endings = np.full(len(is_end), END), np.zeros(len(is_end), dtype=np.uint8)
                hashes[~is_end] = w.hashes
                endings[~is_end] = (w.hashed(np.maximum(w.end - 2, w.start), w.end) % np.uint64(ENDINGS)).astype(np.uint8)
                ids = p.ids.astype(object)
                ids[~p.valid] = None
                parts.append((ids, out, n, hashes, endings))
                if sum(len(x[3]) for x in parts) >= BLOCK_TOKENS:
                    yield block()
                    parts, seq = [], seq + 1
        if parts:
            yield block()

    return docs.withColumn("held", held).mapInArrow(run, schema)


@dataclasses.dataclass
class Facts:
    """What all blocks share: tokens and distinct words of training, the top words, sums per class."""

    n: int
    v: int
    top: np.ndarray                      # hashes, ascending
    class_n: np.ndarray
    class_v: np.ndarray

    @property
    def buckets(self) -> int:
        """Grows with the square root of the distinct words: every task hands over its change of all buckets, and tasks grow with the rows."""
        return max(BUCKETS, 1 << int(np.ceil(np.log2(16 * max(self.v, 1) ** 0.5))))

    def classes(self, hashes: np.ndarray, endings: np.ndarray) -> np.ndarray:
        out = TOP + endings.astype(np.int64)
        if len(self.top):
            at = np.minimum(np.searchsorted(self.top, hashes), len(self.top) - 1)
            out = np.where(self.top[at] == hashes, at, out)
        return out


def counted(packed: DataFrame) -> tuple[DataFrame, Facts]:
    """The blocks with each word's count over all training rows, and the facts."""
    row = StructType.fromDDL("word long, ending int, block long, place int, n long")

    def unfold(batches):
        arrow = to_arrow_schema(row)
        for batch in batches:
            for i in range(batch.num_rows):
                own = np.frombuffer(batch.column(1)[i].as_py(), "<i8")
                endings, counts = np.frombuffer(batch.column(2)[i].as_py(), np.uint8), unsqueezed(batch.column(3)[i].as_py())
                for at in range(0, len(own), 100_000):
                    part = slice(at, at + 100_000)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(own[part]), pa.array(endings[part].astype(np.int32)), pa.array(np.full(len(own[part]), batch.column(0)[i].as_py())),
                        pa.array(np.arange(at, at + len(own[part]), dtype=np.int32)), pa.array(counts[part].astype(np.int64))], schema=arrow)

    rows = packed.select("block", "words", "endings", "counts").mapInArrow(unfold, row)
    totals = stored(rows.groupBy("word").agg(F.sum("n").alias("total"), F.min("ending").alias("ending")), "lm-counts")
    seen = totals.where("total > 0")
    top = np.sort(np.array([r["word"] for r in seen.orderBy(F.desc("total"), "word").limit(TOP).collect()], dtype=np.int64).view(np.uint64))
    of_class, klass = {}, F.when(F.col("word").isin(top.view(np.int64).tolist()), -1).otherwise(F.col("ending"))
    for r in seen.where(klass >= 0).groupBy("ending").agg(F.sum("total").alias("n"), F.count("*").alias("v")).collect():
        of_class[TOP + r["ending"]] = (r["n"], r["v"])
    for r in seen.where(klass < 0).collect():                        # the top words
        of_class[int(np.searchsorted(top, np.int64(r["word"]).view(np.uint64)))] = (r["total"], 1)
    n, v = (np.array([of_class.get(c, (0, 0))[k] for c in range(CLASSES)], dtype=np.int64) for k in (0, 1))
    facts = Facts(int(n.sum()), int(v.sum()), top, n, v)
    back = rows.select("word", "block", "place").join(totals.select("word", "total"), "word").select("block", "place", "total")
    schema = StructType.fromDDL(PACKED)

    def put(left: pa.Table, right: pa.Table) -> pa.Table:
        total = np.zeros(right.num_rows, dtype=np.int64)
        total[right.column("place").to_numpy()] = right.column("total").to_numpy()
        left = left.select([f.name for f in schema.fields])
        return left.set_column(7, "counts", pa.array([zstandard.compress(total.astype("<i8").tobytes(), 1)], pa.binary())).cast(to_arrow_schema(schema))

    blocks = packed.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(put, schema)
    return stored(blocks, "lm-blocks", compression="zstd"), facts


class Block:
    """The tokens of a block with their features."""

    def __init__(self, batch: pa.RecordBatch, i: int, facts: Facts):
        column = lambda name: batch.column(batch.schema.get_field_index(name))[i]
        self.doc_ids, self.held = column("doc_ids").values, np.asarray(column("held").values)
        self.lengths = np.frombuffer(column("lengths").as_py(), "<i4").astype(np.int64)
        self.tokens, self.words = unsqueezed(column("tokens").as_py()), np.frombuffer(column("words").as_py(), "<u8")
        self.word_counts = np.frombuffer(zstandard.decompress(column("counts").as_py()), "<i8")
        self.word_class = facts.classes(self.words, np.frombuffer(column("endings").as_py(), np.uint8)).astype(np.uint8)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.place = np.arange(len(self.tokens), dtype=np.int32) - np.repeat(self.starts.astype(np.int32), self.lengths)

    def klass(self, at: np.ndarray) -> np.ndarray:
        return self.word_class.take(self.tokens.take(at)).astype(np.int64)

    def features(self, at: np.ndarray, buckets: int) -> np.ndarray:
        """The buckets of the features of the tokens at these places, one row per feature."""
        place, h, c = self.place.take(at), [], []
        for back in (1, 2):
            token = self.tokens.take(np.maximum(at - back, 0))
            inside = place >= back
            h.append(np.where(inside, self.words.take(token), np.uint64(0)))
            c.append(np.where(inside, self.word_class.take(token), CLASSES).astype(np.uint64))
        raw = (h[0] * SEEDS[0], h[1] * SEEDS[1], h[0] * SEEDS[2] + mix(h[1]), (c[0] * np.uint64(CLASSES + 1) + c[1]) * SEEDS[3] + SEEDS[2])
        return np.stack([(mix(x) & np.uint64(buckets - 1)).astype(np.int64) for x in raw])      # a power of two


def log_softmax(weights: np.ndarray, bias: np.ndarray, buckets: np.ndarray, of: np.ndarray | None = None) -> np.ndarray:
    """Per row the log-probability of each class, or with ``of`` that of one class."""
    score = bias + weights.take(buckets[0], axis=0)
    for row in buckets[1:]:
        score += weights.take(row, axis=0)
    score -= score.max(axis=1, keepdims=True)
    total = np.log(np.exp(score).sum(axis=1, keepdims=True))
    if of is not None:
        return score[np.arange(len(of)), of] - total[:, 0]
    score -= total
    return score


class Trainer:
    """AdaGrad updates of a copy of the weights."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray):
        self.weights, self.bias, self.tokens = weights.copy(), bias.copy(), 0
        self.seen, self.seen_bias = np.full(len(weights), 1e-3, np.float32), np.float32(1e-3)

    def learn(self, buckets: np.ndarray, klass: np.ndarray) -> None:
        n = len(klass)
        slope = np.exp(log_softmax(self.weights, self.bias, buckets))
        slope[np.arange(n), klass] -= 1
        self.tokens += n
        self.seen_bias += np.float32((slope.mean(axis=0) ** 2).sum())
        self.bias -= RATE * slope.mean(axis=0) / np.sqrt(self.seen_bias)
        for row in buckets:
            # Sorted by radix where the numbers fit into two bytes; the order is the same.
            order = np.argsort(row.astype(np.uint16) if len(self.weights) <= 1 << 16 else row, kind="stable")
            own = row[order]
            first = np.flatnonzero(np.diff(own, prepend=-1))
            total = np.add.reduceat(slope.take(order, axis=0), first, axis=0) / n
            at = own[first]
            self.seen[at] += (total ** 2).sum(axis=1)
            self.weights[at] -= RATE * total / np.sqrt(self.seen[at])[:, None]


def train(blocks: DataFrame, facts: Facts, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(weights, bias) after all rounds."""
    spark = blocks.sparkSession
    weights = np.zeros((facts.buckets, CLASSES), dtype=np.float32)
    bias = np.log((facts.class_n + 1) / (facts.n + CLASSES)).astype(np.float32)
    change = StructType.fromDDL("slice int, task long, tokens long, delta binary")

    def updates(batches):
        trainer = Trainer(*shared.value)
        for batch in batches:
            for i in range(batch.num_rows):
                b = Block(batch, i, facts)
                use = np.flatnonzero(np.repeat(~b.held, b.lengths))
                for at in range(part * BATCH, len(use), rounds * BATCH):
                    some = use[at:at + BATCH]
                    trainer.learn(b.features(some, facts.buckets), b.klass(some))
        if trainer.tokens:
            delta = np.concatenate([(trainer.weights - shared.value[0]).ravel(), trainer.bias - shared.value[1]])
            cuts = np.array_split(delta.astype("<f4"), SLICES)
            yield pa.RecordBatch.from_pydict({
                "slice": list(range(SLICES)), "task": [TaskContext.get().partitionId()] * SLICES, "tokens": [trainer.tokens] * SLICES,
                "delta": [c.tobytes() for c in cuts]}, schema=to_arrow_schema(change))

    def add(table: pa.Table) -> pa.Table:
        """The mean of changes, weighted by tokens."""
        tokens = table.column("tokens").to_pylist()
        total = np.zeros(len(table.column("delta")[0].as_py()) // 4, dtype=np.float64)
        for n, delta in zip(tokens, table.column("delta")):
            total += n / sum(tokens) * np.frombuffer(delta.as_py(), "<f4")
        return pa.table({
            "slice": pa.array([table.column("slice")[0].as_py()], pa.int32()), "task": pa.array([table.column("task")[0].as_py()], pa.int64()),
            "tokens": pa.array([sum(tokens)], pa.int64()), "delta": pa.array([total.astype("<f4").tobytes()], pa.binary())})

    for part in range(rounds):
        shared = spark.sparkContext.broadcast((weights, bias))
        deltas = stored(blocks.mapInArrow(updates, change), "lm-updates")
        while deltas.count() > SLICES:
            deltas = stored(deltas.withColumn("task", (F.col("task") / FAN_IN).cast("long")).groupBy("slice", "task").applyInArrow(add, change), "lm-updates")
        got = sorted(deltas.collect(), key=lambda r: r["slice"])     # SLICES rows
        if not got:
            break
        delta = np.concatenate([np.frombuffer(r["delta"], "<f4") for r in got])
        weights, bias = weights + delta[:-CLASSES].reshape(weights.shape), bias + delta[-CLASSES:]
    return weights, bias


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """RESULT for every row of ``docs``; rows with crc32(id) mod 7 = 2 are held out of training."""
    docs = keyed(docs, id_col, text_col)
    blocks, facts = counted(stored(pack(docs), "lm-packed", compression="zstd"))
    shared = docs.sparkSession.sparkContext.broadcast(train(blocks, facts))
    schema = StructType.fromDDL(RESULT)

    def run(batches):
        weights, bias = shared.value
        in_class = np.log10(np.maximum(1, facts.class_n + facts.class_v + 1))
        for batch in batches:
            for i in range(batch.num_rows):
                b = Block(batch, i, facts)
                known, base, own = (np.zeros(len(b.tokens), dtype=t) for t in (np.int64, np.float64, np.float64))
                for at in range(0, len(b.tokens), BATCH):
                    some = np.arange(at, min(at + BATCH, len(b.tokens)))
                    klass, count = b.klass(some), b.word_counts.take(b.tokens.take(some))
                    seen = np.log10(count + 1.0)
                    by_class = log_softmax(weights, bias, b.features(some, facts.buckets), klass)
                    known[some], base[some] = count > 0, seen - np.log10(facts.n + facts.v + 1)
                    own[some] = by_class / np.log(10) + seen - in_class.take(klass)
                sums = [np.add.reduceat(x, b.starts) for x in (known, base, own)]
                yield pa.RecordBatch.from_arrays([
                    b.doc_ids, pa.array(b.held), pa.array(b.lengths), pa.array(sums[0]), pa.array(np.full(len(b.lengths), facts.n)),
                    pa.array(sums[1]), pa.array(sums[2])], schema=to_arrow_schema(schema))

    return blocks.mapInArrow(run, schema)
