"""Near-duplicate documents by a multi-index Hamming join of b-bit MinHash signatures.

1. Every document gets its set of hashed word shingles, its size and a signature of ``symbols`` symbols of 16 bits.
   Documents with equal sets are one class, represented by the smallest id.
2. Two sets of the wanted similarity differ in more than ``distance`` symbols with a probability below 1e-5
   (``plan_for``). A signature is split into (distance + 1) / 2 chunks. By the pigeonhole principle two signatures within
   the distance have a chunk with at most one wrong symbol, so each chunk is indexed once for each place at which the
   error may stand: all pairs within the distance meet under some key.
3. Under each key the signatures are compared; groups that hang together within the distance become clusters. A key with
   more than ``BLOCK_ROWS`` signatures is cut into blocks, and each pair of blocks is a group of its own.
4. Inside each cluster, likewise in blocks, the full sets are compared exactly (den * intersection >= num * union).
   Only links of a spanning forest leave a task, never all pairs; components of these links are the result.

Defined results: a null or empty text has no shingles and is linked with nothing; a text shorter than a shingle is one
shingle; rows that repeat an id are one document, linked with what any of them resembles; a null id is linked with
nothing, its component is null and it is kept; other columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from millrace.llm.common import NONBLANK, TextBatch, Words, id_array, keyed, mix, pieces, stored, words
from millrace.llm.components import components

CHUNK = 4                    # symbols per chunk; one of them may be wrong
BLOCK_ROWS = 1024
BLOCK_SETS = 128
BROADCAST_ROWS = 500_000     # two long columns: at most 8 MB; beyond it the join is shuffled
MISS = 1e-5


def plan_for(num: int, den: int) -> tuple[int, int]:
    """(symbols, distance) for a similarity of num / den."""
    p, chunks = 1 - num / den, 4
    while True:
        symbols, distance = CHUNK * chunks, 2 * chunks - 1
        miss = sum(math.comb(symbols, i) * p ** i * (1 - p) ** (symbols - i) for i in range(distance + 1, symbols + 1))
        if miss < MISS:
            return symbols, distance
        if symbols > 512:
            raise ValueError("the similarity is too low for this signature")
        chunks += 1


def shingle_sets(batch: TextBatch, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each document."""
    w: Words = words(batch, NONBLANK)
    h = w.hashes
    n = len(h) - size + 1
    rolled = np.full(max(n, 0), size, dtype=np.uint64)
    for k in range(size):
        rolled = mix(rolled * np.uint64(0x9E3779B97F4A7C15) + h[k:k + len(rolled)])
    out = []
    for d in range(len(batch)):
        a, b = int(w.first[d]), int(w.first[d + 1])
        if b - a >= size:
            out.append(np.unique(rolled[a:b - size + 1]))
        elif b > a:
            x = np.full(1, b - a, dtype=np.uint64)
            for k in range(a, b):
                x = mix(x * np.uint64(0x9E3779B97F4A7C15) + h[k:k + 1])
            out.append(x)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


class Minima:
    """MinHash symbols of 16 bits."""

    def __init__(self, symbols: int):
        seeds = mix(np.arange(1, 2 * symbols + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
        self.factor, self.add = seeds[:symbols] | np.uint64(1), seeds[symbols:]

    def of(self, hashes: np.ndarray) -> np.ndarray:
        least = np.full(len(self.factor), np.iinfo(np.uint64).max, dtype=np.uint64)
        for at in range(0, len(hashes), 4096):
            part = hashes[at:at + 4096, None] * self.factor + self.add
            np.minimum(least, part.min(axis=0), out=least)
        return (mix(least) & np.uint64(0xFFFF)).astype("<u2")


def signatures(docs: DataFrame, size: int, symbols: int) -> DataFrame:
    """doc_id, n_shingles, two hashes of the whole set, signature."""
    schema = StructType.fromDDL("doc_id long, n_shingles long, h1 long, h2 long, signature binary")

    def run(batches):
        minima, arrow = Minima(symbols), to_arrow_schema(schema)
        for batch in batches:
            for p in pieces(batch):
                sets = shingle_sets(p, size)
                h1 = np.array([s.sum(dtype=np.uint64) for s in sets], dtype=np.uint64).view(np.int64)
                h2 = np.array([mix(s).sum(dtype=np.uint64) for s in sets], dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([
                    id_array(p), pa.array([len(s) for s in sets], pa.int64()), pa.array(h1), pa.array(h2),
                    pa.array([minima.of(s).tobytes() for s in sets], pa.binary())], schema=arrow)

    return docs.mapInArrow(run, schema)


def index_keys(classes: DataFrame, symbols: int) -> DataFrame:
    """(key, rep): for each chunk and each place of an allowed error, a hash of the chunk without that place."""
    schema = StructType.fromDDL("key long, rep long")

    def run(batches):
        arrow = to_arrow_schema(schema)
        for batch in batches:
            s = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u2").reshape(batch.num_rows, symbols).astype(np.uint64)
            rep, keys = np.asarray(batch.column(0)), []
            for chunk in range(0, symbols, CHUNK):
                for wrong in range(CHUNK):
                    key = np.full(len(s), chunk * CHUNK + wrong + 1, dtype=np.uint64)
                    for k in range(CHUNK):
                        if k != wrong:
                            key = (key << np.uint64(16)) | s[:, chunk + k]
                    keys.append(mix(key).view(np.int64))
            if len(s):
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.tile(rep, len(keys)))], schema=arrow)

    return classes.select("rep", "signature").mapInArrow(run, schema)


def runs(batches, n_keys: int):
    """The rows of each group, given rows sorted by their first ``n_keys`` columns: (columns, starts and ends of groups).
    Groups are whole; several of them come at a time."""
    held = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = t if held is None else pa.concat_tables([held, t])
        if not len(t):
            continue
        change = np.zeros(len(t), dtype=bool)
        for c in range(n_keys):
            x = t.column(c).to_numpy()
            change[1:] |= x[1:] != x[:-1]
        last = int(np.flatnonzero(change)[-1]) if change.any() else 0
        held = t.slice(last)
        if last:
            yield t.slice(0, last), np.concatenate([[0], np.flatnonzero(change[:last]), [last]])
    if held is not None and len(held):
        yield held, np.array([0, len(held)])


def forest(adjacent: np.ndarray, nodes: np.ndarray) -> list[tuple[int, int]]:
    """(node, smallest node) for each part of two or more nodes that hangs together; ``nodes`` ascend."""
    n, out = len(nodes), []
    free = np.ones(n, dtype=bool)
    for root in range(n):
        if not free[root]:
            continue
        free[root] = False
        front = np.array([root])
        while len(front):
            front = np.flatnonzero(adjacent[front].any(axis=0) & free)
            free[front] = False
            out += [(int(nodes[i]), int(nodes[root])) for i in front]
    return out


def in_blocks(rows: DataFrame, key: str, size: str, block_rows: int) -> DataFrame:
    """``rows`` with lo and hi: the pairs of blocks in which a row of a large group takes part; (0, 0) in a small one."""
    blocks = F.ceil(F.col(size) / (block_rows / 2))
    own = F.pmod(F.xxhash64(F.lit(7), "rep"), blocks)
    others = F.expr("transform(filter(sequence(0L, n_blocks - 1), i -> i <> block), i -> struct(least(i, block) as lo, greatest(i, block) as hi))")
    pairs = F.when(F.col(size) <= block_rows, F.array(F.struct(F.lit(0).cast("long").alias("lo"), F.lit(0).cast("long").alias("hi")))).otherwise(others)
    return rows.withColumn("n_blocks", blocks.cast("long")).withColumn("block", own.cast("long")).withColumn(
        "pair", F.explode(pairs)).select("*", "pair.lo", "pair.hi").drop("n_blocks", "block", "pair", size)


LINKS = "a long, b long"


def cluster_links(classes: DataFrame, symbols: int, distance: int) -> DataFrame:
    """Links that connect all classes whose signatures are within the distance."""
    keys = index_keys(classes, symbols)
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    met = keys.join(shared, "key")
    rows = in_blocks(met, "key", "n", BLOCK_ROWS).join(classes.select("rep", "signature"), "rep").select("key", "lo", "hi", "rep", "signature")
    schema = StructType.fromDDL(LINKS)

    def run(batches):
        arrow = to_arrow_schema(schema)
        for t, bounds in runs(batches, 3):
            rep = t.column(3).to_numpy()
            s = np.frombuffer(b"".join(t.column(4).to_pylist()), "<u2").reshape(len(t), symbols)
            size, links = np.diff(bounds), []
            two = bounds[:-1][size == 2]
            near = two[(s[two] != s[two + 1]).sum(axis=1) <= distance]
            links += zip(rep[near + 1].tolist(), rep[near].tolist())
            for a, b in zip(bounds[:-1][size > 2], bounds[1:][size > 2]):
                part = s[a:b]
                adjacent = np.zeros((b - a, b - a), dtype=bool)
                for i in range(0, b - a, 64):
                    adjacent[i:i + 64] = (part[i:i + 64, None, :] != part[None]).sum(axis=2) <= distance
                links += forest(adjacent, rep[a:b])
            links = sorted(set(links))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], schema=arrow)

    return rows.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "rep").mapInArrow(run, schema)


def similar(sets: list[np.ndarray], num: int, den: int) -> np.ndarray:
    """Which of these sets are at least num / den similar, from exact intersections."""
    n = len(sets)
    counts = np.array([len(s) for s in sets], dtype=np.int64)
    flat, owner = np.concatenate(sets), np.repeat(np.arange(n), counts)
    _, column, often = np.unique(flat, return_inverse=True, return_counts=True)
    use = often[column] > 1
    column, owner = column[use], owner[use]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    inter = np.zeros((n, n), dtype=np.float64)
    at = 0
    while at < len(column):
        end = int(np.searchsorted(column, column[at] + 8192))
        part = np.zeros((n, 8192), dtype=np.float32)
        part[owner[at:end], column[at:end] - column[at]] = 1
        inter += part @ part.T
        at = end
    inter = inter.astype(np.int64)
    return den * inter >= num * (counts[:, None] + counts[None] - inter)


def exact_links(docs: DataFrame, members: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """Links that connect all classes of one cluster whose full sets are similar enough.

    members: rep, h1, h2, cluster, n (classes in the cluster)."""
    few = members.count() <= BROADCAST_ROWS
    wanted = members.select(F.col("rep").alias("doc_id"), "h1", "h2", "cluster", "n")
    texts = docs.join(F.broadcast(wanted) if few else wanted, "doc_id").select("doc_id", "text", "h1", "h2", "cluster", "n")
    with_sets = StructType.fromDDL("rep long, shingles binary, cluster long, n long")

    def sets(batches):
        arrow = to_arrow_schema(with_sets)
        for batch in batches:
            at = 0
            for p in pieces(batch.select([0, 1])):
                part, own = batch.slice(at, len(p)), shingle_sets(p, size)
                at += len(p)
                # A repeated id may have other texts: only the one that represents its class counts.
                h1, h2 = np.asarray(part.column(2)), np.asarray(part.column(3))
                same = [s.sum(dtype=np.uint64).view(np.int64) == a and mix(s).sum(dtype=np.uint64).view(np.int64) == b for s, a, b in zip(own, h1, h2)]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([s.tobytes() for s in own], pa.binary()), part.column(4), part.column(5)],
                    schema=arrow).filter(pa.array(same, pa.bool_()))

    schema = StructType.fromDDL(LINKS)

    def run(batches):
        arrow = to_arrow_schema(schema)
        for t, bounds in runs(batches, 3):
            rep, raw, links = t.column(3).to_numpy(), t.column(4), []
            for a, b in zip(bounds, bounds[1:]):
                own, first = np.unique(rep[a:b], return_index=True)
                if len(own) > 1:
                    links += forest(similar([np.frombuffer(raw[int(a + i)].as_py(), np.uint64) for i in first], num, den), own)
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], schema=arrow)

    cells = in_blocks(texts.mapInArrow(sets, with_sets), "cluster", "n", BLOCK_SETS).select("cluster", "lo", "hi", "rep", "shingles")
    return cells.repartition("cluster", "lo", "hi").sortWithinPartitions("cluster", "lo", "hi", "rep").mapInArrow(run, schema)


def classes(docs: DataFrame, size: int = 5, num: int = 8, den: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``; documents are linked from a similarity of num / den."""
    symbols, distance = plan_for(num, den)
    docs = keyed(docs, id_col, text_col)
    signed = stored(signatures(docs, size, symbols), "signatures")
    linked = signed.where("n_shingles > 0 and doc_id is not null")
    by_set = ["h1", "h2", "n_shingles"]
    groups = stored(linked.groupBy(*by_set).agg(F.min("doc_id").alias("rep"), F.first("signature").alias("signature")), "classes")
    clusters = components(cluster_links(groups, symbols, distance))
    clustered = groups.select("rep", "h1", "h2").join(clusters.withColumnRenamed("node", "rep"), "rep")
    sizes = clustered.groupBy("component").agg(F.count("*").alias("n"))
    members = stored(clustered.join(sizes, "component").select("rep", "h1", "h2", F.col("component").alias("cluster"), "n"), "clusters")
    # An id with several texts links the classes of all of them.
    ids = linked.select("doc_id", *by_set).join(groups.drop("signature"), by_set).select("doc_id", "rep")
    of_id = ids.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("top")).where("a < top").select("doc_id", "a")
    repeated = ids.join(of_id, "doc_id").select(F.col("rep").alias("a"), F.col("a").alias("b"))
    final = components(exact_links(docs, members, size, num, den).union(repeated)).withColumnRenamed("node", "rep")
    of_set = groups.drop("signature").join(final, "rep", "left").select(*by_set, F.coalesce("component", "rep").alias("component"))
    own = F.coalesce("component", "doc_id")
    return signed.select("doc_id", *by_set).join(of_set, by_set, "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), own).alias("component_id"),
        F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"))


LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all({LOWERED}, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
sh AS (SELECT doc_id, unnest(list_distinct(CASE
           WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))
           WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s FROM d),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
inter AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM inter JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, comp.component_id, d.doc_id = comp.component_id AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN comp ON comp.doc_id = d.doc_id
"""
