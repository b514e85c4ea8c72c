"""Nearest neighbours by an inverted multi-index.

Vectors are cut into two halves; each half has ``CENTROIDS`` centroids of its own, so an entry falls into one of
CENTROIDS^2 cells. A query walks over pairs of centroids by their summed distance, with a heap that starts from the
nearest of either half, until the cells passed hold at least ``share`` of all entries (and at least ``least``); the
entries of those cells are reranked by the exact distance. Of the cells left, those are read too that may hold an entry
as near as the k-th found, by the distance to their centroids and their radius; so the neighbours are exact at every size.

Centroids are fitted on at most ``FIT_ROWS`` vectors, those whose ids hash lowest; every vector is indexed. Entries are
dealt out to shards by the hash of their id, so a cell that holds a third of all rows is spread over all shards. Each
block of queries meets each shard once and leaves its nearest ``k`` of the shard. What is collected or broadcast is
bounded: the fit's rows, the centroids and a count and two radii per cell.

Defined results: vectors that are null, zero, hold null or non-finite components, have a null id or another length than
most of the others take no part; rows that repeat an id are one vector, the smallest; ties go to the smaller id; a query with
fewer than k candidates gets all of them; other columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from millrace.llm.common import stored

CENTROIDS = 64
FIT_ROWS = 10_000
SHARE = 0.55
LEAST = 100
SHARD_ROWS = 4_096
QUERY_ROWS = 1_024


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a ** 2).sum(1)[:, None] - 2 * a @ b.T + (b ** 2).sum(1), 0)


def centroids(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Lloyd's method from k rows spread over the sample."""
    c = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(rounds):
        nearest = squared(x, c).argmin(1)
        count = np.bincount(nearest, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, nearest, x)
        c[count > 0] = total[count > 0] / count[count > 0, None]
    return c


class Index:
    """Two codebooks and the number of entries per cell."""

    def __init__(self, sample: np.ndarray, k: int = CENTROIDS):
        self.half = sample.shape[1] // 2
        self.books = [centroids(sample[:, :self.half], k), centroids(sample[:, self.half:], k)]
        self.width = len(self.books[1])
        self.counts = np.zeros(len(self.books[0]) * self.width, dtype=np.int64)
        self.radii = np.zeros((2, len(self.counts)))

    def parts(self, x: np.ndarray):
        return x[:, :self.half], x[:, self.half:]

    def cells(self, x: np.ndarray) -> np.ndarray:
        first, second = (squared(p, b).argmin(1) for p, b in zip(self.parts(x), self.books))
        return first * self.width + second

    def reach(self, x: np.ndarray) -> list[np.ndarray]:
        """Distances of the halves to their centroids."""
        return [np.sqrt(((p - b[squared(p, b).argmin(1)]) ** 2).sum(1)) for p, b in zip(self.parts(x), self.books)]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """No entry of a cell is nearer to a query than this."""
        first, second = (np.sqrt(squared(p, b)) for p, b in zip(self.parts(queries), self.books))
        first, second = np.repeat(first, self.width, axis=1), np.tile(second, (1, len(self.books[0])))
        return np.sqrt(np.maximum(first - self.radii[0], 0) ** 2 + np.maximum(second - self.radii[1], 0) ** 2)

    def walk(self, first: np.ndarray, second: np.ndarray, wanted: int) -> list[int]:
        """The cells by summed distance until they hold ``wanted`` entries; first, second: distances to the centroids."""
        rows, cols = first.argsort(kind="stable").tolist(), second.argsort(kind="stable").tolist()
        a, b = first[rows].tolist(), second[cols].tolist()
        heap, below, cells, held, counts = [(a[0] + b[0], 0, 0)], [0] * len(a), [], 0, self.counts
        while heap and held < wanted:
            _, i, j = heapq.heappop(heap)
            cell = rows[i] * self.width + cols[j]
            cells.append(cell)
            held += counts[cell]
            below[i] = j + 1
            # The next of this row, and the first of the next row, once nothing before them is left out.
            if j + 1 < len(b) and (i == 0 or below[i - 1] > j + 1):
                heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
            if i + 1 < len(a) and below[i + 1] == j:
                heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))
        return cells

    def visited(self, queries: np.ndarray, wanted: int) -> list[bytes]:
        """Each query's cells as packed bits."""
        out = []
        for first, second in zip(*(squared(p, b) for p, b in zip(self.parts(queries), self.books))):
            bits = np.zeros(len(self.counts), dtype=bool)
            bits[self.walk(first, second, wanted)] = True
            out.append(np.packbits(bits).tobytes())
        return out


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and embedding (doubles) of the vectors that take part, but for their length; ids may repeat."""
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding")).where(
        F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0)).where(finite & F.exists(v, lambda x: x != 0))
    return rows


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, dim)


def nearest(vectors: DataFrame, k: int = 10, every: int = 100, share: float = SHARE, least: int = LEAST, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query (rows whose id is divisible by ``every``)."""
    spark = vectors.sparkSession
    schema = StructType.fromDDL("query_id long, rank int, vec_id long, score double")
    rows = usable(vectors, id_col, vector_col)
    lengths = rows.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if lengths is None:
        return spark.createDataFrame([], schema)
    dim = lengths["dim"]
    rows = rows.where(F.size("embedding") == dim).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(FIT_ROWS).select("embedding").toArrow()
    if not len(sample):
        return spark.createDataFrame([], schema)
    index = Index(np.concatenate([matrix(c, dim) for c in sample.column(0).chunks if len(c)]))
    books = spark.sparkContext.broadcast(index)
    indexed = StructType.fromDDL("vec_id long, embedding array<double>, cell int, near double, far double")

    def assign(batches):
        arrow = to_arrow_schema(indexed)
        for batch in batches:
            x = matrix(batch.column(1), dim)
            cell, reach = (books.value.cells(x).astype(np.int32), books.value.reach(x)) if len(batch) else ([], [[], []])
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1).cast(arrow.field(1).type), pa.array(cell, pa.int32()), *[pa.array(r, pa.float64()) for r in reach]], schema=arrow)

    entries = stored(rows.mapInArrow(assign, indexed), "vectors")
    for r in entries.groupBy("cell").agg(F.count("*").alias("n"), F.max("near").alias("near"), F.max("far").alias("far")).collect():   # at most CENTROIDS^2 rows
        index.counts[r["cell"]] = r["n"]
        index.radii[:, r["cell"]] = r["near"], r["far"]
    total = int(index.counts.sum())
    walker = spark.sparkContext.broadcast(index)
    wanted = max(least, int(np.ceil(share * total)))
    asked = StructType.fromDDL("query_id long, embedding array<double>, cells binary")

    def ask(batches):
        arrow = to_arrow_schema(asked)
        for batch in batches:
            bits = walker.value.visited(matrix(batch.column(1), dim), wanted) if len(batch) else []
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(arrow.field(1).type), pa.array(bits, pa.binary())], schema=arrow)

    shards = max(1, -(-total // SHARD_ROWS))
    blocks = max(1, -(-entries.where(F.col("vec_id") % every == 0).count() // QUERY_ROWS))
    queries = entries.where(F.col("vec_id") % every == 0).select("vec_id", "embedding").mapInArrow(ask, asked).withColumn(
        "block", F.pmod(F.xxhash64("query_id"), F.lit(blocks))).withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    candidates = entries.select("vec_id", "embedding", "cell").withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards))).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def rerank(asking: pa.Table, entry: pa.Table) -> pa.Table:
        out_query, out_vec, out_score = [], [], []
        if len(asking) and len(entry):
            q, x = (np.concatenate([matrix(c, dim) for c in t.column("embedding").chunks]) for t in (asking, entry))
            ids, cell = entry.column("vec_id").to_numpy(), entry.column("cell").to_numpy()
            bits = np.unpackbits(np.frombuffer(b"".join(asking.column("cells").to_pylist()), np.uint8).reshape(len(q), -1), axis=1).astype(bool)
            distance = np.full((len(q), len(x)), np.inf)
            order = np.argsort(cell, kind="stable")
            starts = np.flatnonzero(np.diff(cell[order], prepend=-1))
            asked_ids = asking.column("query_id").to_numpy()

            def read(wanted):
                for members in np.split(order, starts[1:]):
                    near = np.flatnonzero(wanted[:, cell[members[0]]])
                    for at in range(0, len(members), 256):
                        some = members[at:at + 256]
                        for block in range(0, len(near), 128):
                            to = near[block:block + 128]
                            distance[np.ix_(to, some)] = np.sqrt(((q[to, None, :] - x[None, some, :]) ** 2).sum(axis=2))
                distance[asked_ids[:, None] == ids[None]] = np.inf

            read(bits)
            farthest = np.partition(distance, k - 1, axis=1)[:, k - 1] if len(x) > k else np.full(len(q), np.inf)
            bounds = walker.value.bounds(q)
            # A little slack for rounding.
            read((bounds <= farthest[:, None] + 1e-6 * (1 + bounds)) & ~bits[:, :bounds.shape[1]])
            for i, own in enumerate(asked_ids):
                row = distance[i]
                edge = np.partition(row, k - 1)[k - 1] if len(row) > k else np.inf
                some = np.flatnonzero((row <= edge) & np.isfinite(row))
                some = some[np.lexsort((ids[some], row[some]))][:k]
                out_query += [own] * len(some)
                out_vec += ids[some].tolist()
                out_score += row[some].tolist()
        return pa.table({"query_id": pa.array(out_query, pa.int64()), "vec_id": pa.array(out_vec, pa.int64()), "score": pa.array(out_score, pa.float64())})

    found = queries.groupBy("shard", "block").cogroup(candidates.groupBy("shard", "block")).applyInArrow(rerank, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


# Exact neighbours, at every size.
SQL = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
d AS (SELECT q.vec_id AS query_id, x.vec_id AS vec_id, list_distance(q.e, x.e) AS score
      FROM v q JOIN v x ON q.vec_id % 100 = 0 AND x.vec_id <> q.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM d) WHERE rank <= 10
"""
