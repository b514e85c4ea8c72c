"""A trie of conversation prefixes by truncation peeling.

Each conversation becomes the chain of its prefixes' keys: key d is a 128-bit digest of key d-1 and turn d's role and
text, so equal keys are equal prefixes, and chains sort so that prefixes shared stand together. ``peel`` starts at the
maximum depth, merges the conversations that end there with the nodes that survived from below, closes every node
found, strips the last turn and regroups what is left one level up; members, children, leaves and savings are added up
while nodes are discovered, in one pass.

Conversations are range-partitioned by chain and id and peeled in runs of ``RUN`` chains, so memory does not grow with
a partition. Only nodes on the first and the last chain of a run may have members elsewhere: they stay open and go on as
items that stand for all that was closed below them. Items are few (``RUN`` chains leave as many as there are branchings
on two chains), so another round or two end in one run that closes the root. Texts are reduced to a digest and their
number of bytes before anything is shuffled. A conversation that a third of all share is split by id; runs of its ids
become blobs of text, and only these are hashed one after another, as SHA-256 demands. Parents that were open when their
children closed are looked up at the end; up to ``BROADCAST_ROWS`` of them are broadcast, beyond that children are
spread over slices. One conversation must fit in memory by its digests (24 bytes a turn).

Defined results: rows without conv_id are left out; turns are ordered by turn, null first, equal ones by their digest (equal
rows stay repeated); null role or text is empty; other columns are ignored; an empty table gives no node.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from millrace.llm.common import stored

KEY = 16
# Chains peeled together, and the bytes that they may have.
RUN = 20_000
RUN_BYTES = 16 << 20
# Bytes of ids, as text, in one blob; and rows in a batch handed back to Spark.
BLOB = 1 << 20
ROWS = 4_096
BROADCAST_ROWS = 500_000
SLICES = 32
# Conversations in families of this many start with turns of their first; below so many turns are taken over.
FAMILY = 5
MOST_SHARED = 9

CHAINED = "conv_id long, chain binary, sizes array<long>"
# kind: what a row is. A node waits if its parent was still open; ids are some members of one conversation's chain.
NODE, WAITING, ITEM, IDS = 0, 1, 2, 3
PEELED = ("kind int, key binary, parent binary, depth int, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
          "saved_tokens long, ends_sha256 string, chain binary, sizes array<long>, ids binary")
NOBODY = hashlib.sha256(b"").hexdigest()


def shared_turns(conv_id: int) -> int:
    return zlib.crc32(str(conv_id).encode()) % MOST_SHARED


def chained(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
            shared=shared_turns) -> DataFrame:
    """(conv_id, chain, sizes) of every rebuilt conversation: its prefixes' keys, and the UTF-8 bytes of each turn's text."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    turns = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), digest.alias("digest"), F.octet_length(text).cast("long").alias("size"))
    families = turns.groupBy((F.col("conv_id") - F.col("conv_id") % FAMILY).alias("first")).agg(
        F.sort_array(F.collect_list(F.struct("conv_id", "turn", "digest", "size"))).alias("turns")).select("first", "turns.conv_id", "turns.digest", "turns.size")
    schema = StructType.fromDDL(CHAINED)

    def run(batches):
        arrow = to_arrow_schema(schema)
        for batch in batches:
            rows = []
            for first, ids, digests, sizes in zip(*(c.to_pylist() for c in batch.columns)):
                own: dict[int, list] = {}
                for conv, digest, size in zip(ids, digests, sizes):
                    own.setdefault(conv, []).append((digest, size))
                base = own.get(first, [])
                for conv, turns in own.items():
                    n = shared(conv)
                    turns = base[:n] + turns[n:]
                    key, chain = b"", []
                    for digest, _ in turns:
                        key = hashlib.md5(key + digest).digest()
                        chain.append(key)
                    rows.append((conv, b"".join(chain), [size for _, size in turns]))
            for at in range(0, len(rows), ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[at:at + ROWS]), arrow)], schema=arrow)

    return families.mapInArrow(run, schema)


class Item:
    """What is known of one node: its chain, and what its own conversations and its closed children add up to."""

    __slots__ = ("chain", "sizes", "n", "least", "children", "leaves", "saved", "ends", "below")

    def __init__(self, chain: bytes, sizes: list[int], n: int, least: int, children: int = 0, leaves: int = 0, saved: int = 0, ends: str | None = None):
        self.chain, self.sizes, self.n, self.least = chain, sizes, n, least
        self.children, self.leaves, self.saved, self.ends = children, leaves, saved, ends
        self.below = []                           # rows of closed children, which wait for this node's least member

    def add(self, n: int, least: int, children: int, leaves: int, saved: int, ends: str | None) -> None:
        self.n += n
        self.least = min(self.least, least)
        self.children += children
        self.leaves += leaves
        self.saved += saved
        self.ends = ends or self.ends


def key_at(chain: bytes, depth: int) -> bytes:
    return chain[KEY * (depth - 1):KEY * depth] if depth else b""


def peel(items: list[Item], last_run: bool) -> Iterator[tuple]:
    """Rows of ``PEELED``: the nodes closed, and the items that stay open. ``items`` are sorted by chain."""
    open_keys = set()
    if not last_run:
        for item in (items[0], items[-1]):
            open_keys.update(key_at(item.chain, d) for d in range(len(item.chain) // KEY + 1))
    ending: dict[int, list[Item]] = {}
    for item in items:
        ending.setdefault(len(item.chain) // KEY, []).append(item)
    live: dict[bytes, Item] = {}
    for depth in range(max(ending), -1, -1):
        for item in ending.get(depth, ()):
            key = key_at(item.chain, depth)
            node = live.get(key)
            if node is None:
                live[key] = item
            else:
                node.add(item.n, item.least, item.children, item.leaves, item.saved, item.ends)
        above: dict[bytes, Item] = {}
        for key, node in live.items():
            if key in open_keys:
                for row in node.below:
                    row[0] = WAITING
                    yield tuple(row)
                yield (ITEM, key, None, depth, node.least, None, node.n, node.children, node.leaves, node.saved, node.ends,
                       node.chain[:KEY * depth], node.sizes[:depth], None)
                continue
            leaves = node.leaves if node.children else 1
            saved = node.saved + ((node.n - 1) * node.sizes[depth - 1] if depth else 0)
            for row in node.below:
                row[5] = node.least
                yield tuple(row)
            up = key_at(node.chain, depth - 1) if depth else None
            row = [NODE, key, up, depth, node.least, None, node.n, node.children, leaves, saved, node.ends or NOBODY, None, None, None]
            if not depth:
                yield tuple(row)
                continue
            parent = above.get(up)
            if parent is None:
                parent = above[up] = Item(node.chain, node.sizes, node.n, node.least, 1, leaves, saved)
            else:
                parent.add(node.n, node.least, 1, leaves, saved, None)
            parent.below.append(row)
        live = above


def in_runs(items: Iterable[Item], last_run: bool) -> Iterator[tuple]:
    run, size = [], 0
    for item in items:
        run.append(item)
        size += len(item.chain)
        if not last_run and (len(run) >= RUN or size >= RUN_BYTES):
            yield from peel(run, False)
            run, size = [], 0
    if run:
        yield from peel(run, last_run)


def batches_of(rows: Iterable[tuple], arrow: pa.Schema) -> Iterator[pa.RecordBatch]:
    def batch(some):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), arrow)], schema=arrow)

    some = []
    for row in rows:
        some.append(row)
        if len(some) == ROWS:
            yield batch(some)
            some = []
    if some:
        yield batch(some)


def members(batches) -> Iterator[tuple[bytes, list[int], list[int]]]:
    """(chain, sizes, ids) of sorted rows: ids of one chain in pieces of bounded length."""
    chain, sizes, ids = None, None, []
    for batch in batches:
        for conv, own, of in zip(*(c.to_pylist() for c in batch.columns)):
            if own != chain or len(ids) >= BLOB // 20:
                if ids:
                    yield chain, sizes, ids
                chain, sizes, ids = own, of, []
            ids.append(conv)
    if ids:
        yield chain, sizes, ids


def joined(ids: list[int]) -> bytes:
    return ",".join(map(str, ids)).encode()


def first_round(rows: DataFrame) -> DataFrame:
    """Sorted (conv_id, chain, sizes) to rows of ``PEELED``. The first and last chain of a task may go on in others: their
    members are handed on as blobs."""
    schema = StructType.fromDDL(PEELED)

    def run(batches):
        arrow, loose = to_arrow_schema(schema), []

        def blob(chain, sizes, ids):
            return (IDS, key_at(chain, len(sizes)), None, len(sizes), ids[0], None, len(ids), None, None, None, None, chain, sizes, joined(ids))

        def items():
            pieces = members(batches)
            before = next(pieces, None)
            first = before and before[0]
            for piece in pieces:
                if before[0] in (first, piece[0]) or (loose and loose[-1] == before[0]):
                    loose.append(before[0])
                    waiting.append(blob(*before))
                else:
                    chain, sizes, ids = before
                    yield Item(chain, sizes, len(ids), ids[0], ends=hashlib.sha256(joined(ids)).hexdigest())
                before = piece
            if before:
                waiting.append(blob(*before))

        waiting: list[tuple] = []

        def all_rows():
            for row in in_runs(items(), False):
                yield row
                while waiting:
                    yield waiting.pop()
            yield from waiting

        yield from batches_of(all_rows(), arrow)

    return rows.mapInArrow(run, schema)


def merged_ids(blobs: DataFrame) -> DataFrame:
    """One item per chain whose members came in several blobs: these are hashed in order, one at a time."""
    schema = StructType.fromDDL(PEELED)
    rows = blobs.repartition("key").sortWithinPartitions("key", "depth", "conv_id").select("key", "depth", "conv_id", "n_convs", "chain", "sizes", "ids")

    def run(batches):
        arrow = to_arrow_schema(schema)

        def items():
            now, node, digest, n, least = None, None, None, 0, 0

            def done():
                key, depth = now
                return (ITEM, key, None, depth, least, None, n, 0, 0, 0, digest.hexdigest(), *node, None)

            for batch in batches:
                for key, depth, first, count, chain, sizes, ids in zip(*(c.to_pylist() for c in batch.columns)):
                    if (key, depth) != now:
                        if now:
                            yield done()
                        now, node, digest, n, least = (key, depth), (chain, sizes), hashlib.sha256(ids), count, first
                    else:
                        digest.update(b"," + ids)
                        n += count
            if now:
                yield done()

        yield from batches_of(items(), arrow)

    return rows.mapInArrow(run, schema)


def next_round(items: DataFrame, last_run: bool) -> DataFrame:
    schema = StructType.fromDDL(PEELED)
    rows = items.select("chain", "sizes", "n_convs", "conv_id", "n_children", "n_leaves", "saved_tokens", "ends_sha256")

    def run(batches):
        found = (Item(*row) for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        yield from batches_of(in_runs(found, last_run), to_arrow_schema(schema))

    return rows.mapInArrow(run, schema)


def trie(conversations: DataFrame, run: int | None = None, **columns) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    size = run or RUN
    chains = stored(chained(conversations, **columns), "chains")
    parts = max(1, chains.rdd.getNumPartitions())
    ordered = chains.repartitionByRange(parts, "chain", "conv_id").sortWithinPartitions("chain", "conv_id")
    peeled = stored(first_round(ordered), "peeled")
    found = [peeled.where(F.col("kind") <= WAITING)]
    items = stored(peeled.where(F.col("kind") == ITEM).union(merged_ids(peeled.where(F.col("kind") == IDS))), "items")
    left = items.count()
    while left:
        last_run = left <= size
        parts = 1 if last_run else -(-left // size)
        ordered = (items.coalesce(1) if last_run else items.repartitionByRange(parts, "chain")).sortWithinPartitions("chain")
        peeled = stored(next_round(ordered, last_run), "peeled")
        found.append(peeled.where(F.col("kind") <= WAITING))
        items = peeled.where(F.col("kind") == ITEM)
        before, left = left, 0 if last_run else items.count()
        if left > before // 2:
            size *= 2                              # runs too short for chains so long and branched
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    nodes = found[0]
    for more in found[1:]:
        nodes = nodes.union(more)
    done = nodes.where(F.col("kind") == NODE)
    # Parents that stayed open were closed by a later round.
    later = conversations.sparkSession.createDataFrame([], "up binary, at int, of long")
    for more in found[1:]:
        later = later.union(more.select("key", (F.col("depth") + 1), "conv_id"))
    later = stored(later, "parents")
    waiting = nodes.where(F.col("kind") == WAITING).drop("parent_conv_id")
    if later.count() <= BROADCAST_ROWS:
        waiting = waiting.join(F.broadcast(later), (F.col("parent") == F.col("up")) & (F.col("depth") == F.col("at")))
    else:
        spread = later.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))))
        waiting = waiting.withColumn("own", F.pmod(F.hash("key"), F.lit(SLICES))).join(
            spread, (F.col("parent") == F.col("up")) & (F.col("depth") == F.col("at")) & (F.col("own") == F.col("slice")))
    waiting = waiting.withColumn("parent_conv_id", F.col("of"))
    return done.select(*columns).union(waiting.select(*columns)).withColumn("depth", F.col("depth").cast("long"))


# A 32-bit cyclic redundancy check in SQL: bit by bit over the digits.
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]),
        lambda y, z: CASE WHEN y % 2 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END)))"""

# The same from all prefixes, and all pairs of a prefix and one above it.
SQL = f"""
WITH o AS (SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS turns
           FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT *, {_CRC} % {MOST_SHARED} AS h FROM o),
r AS (SELECT h.conv_id, list_concat(coalesce(b.turns[1:h.h], []), h.turns[h.h + 1:]) AS turns
      FROM h LEFT JOIN h b ON b.conv_id = h.conv_id - h.conv_id % {FAMILY}),
p AS (SELECT conv_id, d, md5(CAST(to_json(turns[1:d]) AS VARCHAR)) AS key, md5(CAST(to_json(turns[1:d - 1]) AS VARCHAR)) AS up,
             CASE WHEN d = 0 THEN 0 ELSE strlen(turns[d].text) END AS size, d = len(turns) AS ended
      FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM r)),
n AS (SELECT d, key, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n, any_value(size) AS size,
             sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ended), '')) AS ends
      FROM p GROUP BY d, key),
c AS (SELECT d - 1 AS d, up AS key, count(*) AS children FROM n WHERE d > 0 GROUP BY ALL),
m AS (SELECT n.*, coalesce(children, 0) AS children FROM n LEFT JOIN c USING (d, key)),
a AS (SELECT DISTINCT x.d AS top_d, x.key AS top_key, y.d, y.key FROM p x JOIN p y ON x.conv_id = y.conv_id AND x.d <= y.d),
s AS (SELECT top_d AS d, top_key AS key, count(*) FILTER (children = 0) AS leaves, sum((n - 1) * size) AS saved FROM a JOIN m USING (d, key) GROUP BY ALL)
SELECT m.conv_id, m.d AS depth, f.conv_id AS parent_conv_id, m.n AS n_convs, m.children AS n_children, s.leaves AS n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, m.ends AS ends_sha256
FROM m JOIN s USING (d, key) LEFT JOIN n f ON f.d = m.d - 1 AND f.key = m.up AND m.d > 0
"""
