"""Byte-level BPE encoding and decoding with a segment tree over adjacent pair ranks.

A word starts as its bytes. The tree's leaves hold the rank of each adjacent pair of symbols (with its place, so that
the root is the leftmost pair of the lowest rank); a merge changes three leaves and walks up from them, until the root
says that no pair can be merged. Many short words go through their trees together as rows of one array; a long word
has a tree of its own, so a word of n bytes costs O(n log n).

The vocabulary is a file of the ``tokenizers`` library (``path``), read on each executor, where it must exist.

Defined results: a null or empty text has no ids; the file's added tokens are found anywhere in a text, as the library
does by default; repeated rows and null ids stay as they are; other columns are ignored; an empty table gives an empty
one. Decoding turns bytes that are not UTF-8 into U+FFFD; an id outside the vocabulary raises.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

from millrace.llm.common import keyed

# Fixed value: how byte-level BPE splits a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The same by the standard library, much faster, for texts without the characters that its classes take otherwise.
PLAIN = re.compile(r"'(?:[stmd]|re|ve|ll)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
UNLIKE = frozenset(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) in ("No", "Nl") or "\x1c" <= c <= "\x1f")
# Bytes that a worker spends on remembered words and other stretches of text, about; what one costs besides its letters and ids.
REMEMBERED = 64 << 20
OVERHEAD = 200
# Words of up to this many bytes go through their trees together.
SHORT = 64
NONE = np.int64(1) << 62


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary file."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = {b: chr(b) for b in own}, 256
    for b in range(256):
        if b not in letters:
            letters[b], extra = chr(extra), extra + 1
    return [letters[b] for b in range(256)]


class Vocabulary:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        if model["type"] != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or spec.get("normalizer"):
            raise ValueError("not a plain byte-level BPE vocabulary")
        ids, letters = model["vocab"], byte_letters()
        self.byte_id = np.array([ids[x] for x in letters], dtype=np.int64)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        keys = np.array([(ids[a] << 32) | ids[b] for a, b in merges], dtype=np.int64)
        self.place_pairs(keys, np.arange(len(keys), dtype=np.int64))
        self.made = np.array([ids[a + b] for a, b in merges], dtype=np.int64)      # by rank
        self.rank_of = {k: r for r, k in enumerate(keys.tolist())}
        self.added = {}
        for t in spec.get("added_tokens", []):
            if t["single_word"] or t["lstrip"] or t["rstrip"]:
                raise ValueError("added tokens that take in blanks are not supported")
            self.added[t["content"]] = t["id"]
        back = {x: b for b, x in enumerate(letters)}
        self.bytes_of = [b""] * (1 + max([*ids.values(), *self.added.values()]))
        for t, i in ids.items():
            self.bytes_of[i] = bytes(back[x] for x in t) if all(x in back for x in t) else t.encode()
        for t, i in self.added.items():
            self.bytes_of[i] = t.encode()
        self.split_added = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.split_words = regex.compile(PATTERN)
        self.known: dict[str, bytes] = {}
        self.seen: set[str] = set()
        self.held = 0

    def place_pairs(self, keys: np.ndarray, ranks: np.ndarray) -> None:
        """Hash tables of pair -> rank without chains: what finds its place taken goes to the next, smaller table."""
        self.tables, level = [], 0
        while len(keys):
            bits = max(8, 19 - 2 * level)
            shift, factor = np.uint64(64 - bits), np.uint64(0x9E3779B97F4A7C15 + 2 * level * 0x632BE59BD9B4E019 & (1 << 64) - 1)
            slot = ((keys.astype(np.uint64) * factor) >> shift).astype(np.int64)
            held, first = np.unique(slot, return_index=True)
            table_keys, table_ranks = np.full(1 << bits, -1, np.int64), np.full(1 << bits, NONE, np.int64)
            table_keys[held], table_ranks[held] = keys[first], ranks[first]
            self.tables.append((shift, factor, table_keys, table_ranks))
            rest = np.ones(len(keys), bool)
            rest[first] = False
            keys, ranks, level = keys[rest], ranks[rest], level + 1

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, NONE where it never merges (or a symbol is -1)."""
        key = (left << 32) | right                      # negative if the left is -1; no stored key has a right of -1
        hashed, out = key.astype(np.uint64), None
        for shift, factor, table_keys, table_ranks in self.tables:
            slot = ((hashed * factor) >> shift).astype(np.int64)
            found = np.where((table_keys.take(slot) == key) & (key >= 0), table_ranks.take(slot), NONE)
            out = found if out is None else np.minimum(out, found)
        return out

    def merge_rows(self, symbols: np.ndarray) -> np.ndarray:
        """Merges the words in the rows of ``symbols``, padded with -1; merged-away places become -1."""
        rows, width = symbols.shape                     # the width is a power of two
        bits = width.bit_length() - 1
        tree = np.full((rows, 2 * width), NONE, dtype=np.int64)
        ranks = self.pair_ranks(symbols[:, :-1].ravel(), symbols[:, 1:].ravel()).reshape(rows, width - 1)
        tree[:, width:2 * width - 1] = np.where(ranks < NONE, (ranks << bits) + np.arange(width - 1), NONE)
        for node in range(width - 1, 0, -1):
            np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1], out=tree[:, node])
        live = np.flatnonzero(tree[:, 1] < NONE)
        # One more place on either side, which never merges; places count from 1 in the links.
        symbols = np.pad(symbols, ((0, 0), (1, 1)), constant_values=-1).ravel()
        after = np.tile(np.arange(1, width + 3), rows)
        before = np.tile(np.arange(-1, width + 1), rows)
        tree = tree.ravel()
        while len(live):
            best, row, link = tree.take(2 * width * live + 1), 2 * width * live, (width + 2) * live
            at = (best & (width - 1)) + 1
            gone, left = after.take(link + at), before.take(link + at)
            right, own = after.take(link + gone), self.made.take(best >> bits)
            symbols[link + at], symbols[link + gone] = own, -1
            after[link + at], before[link + right] = right, at
            follow = self.pair_ranks(own, symbols.take(link + right))
            lead = self.pair_ranks(symbols.take(link + left), own)
            leaf = row + width - 1
            tree[leaf + gone] = NONE
            tree[leaf + np.maximum(left, 1)] = np.where((left > 0) & (lead < NONE), (lead << bits) + left - 1, NONE)
            tree[leaf + at] = np.where(follow < NONE, (follow << bits) + at - 1, NONE)
            nodes = [width - 1 + gone, width - 1 + at, width - 1 + np.maximum(left, 1)]
            for _ in range(bits):
                nodes = [x >> 1 for x in nodes]
                for x in nodes:
                    child = row + 2 * x
                    tree[row + x] = np.minimum(tree.take(child), tree.take(child + 1))
            live = live[tree.take(row + 1) < NONE]
        return symbols.reshape(rows, width + 2)[:, 1:-1]

    def merge_long(self, symbols: list[int]) -> list[int]:
        """The ids of one long word, by a tree of its own."""
        n, none = len(symbols), int(NONE)
        width = 1 << max(1, (n - 1).bit_length())
        rank, made = self.rank_of, self.made
        tree = [none] * (2 * width)

        def leaf(i: int, j: int) -> int:
            r = rank.get((symbols[i] << 32) | symbols[j])
            return none if r is None else r * width + i

        for i in range(n - 1):
            tree[width + i] = leaf(i, i + 1)
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]

        def put(i: int, value: int) -> None:
            node = width + i
            tree[node] = value
            while node > 1:
                node >>= 1
                least = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == least:
                    break
                tree[node] = least

        while tree[1] < none:
            r, i = divmod(tree[1], width)
            j = after[i]
            right, left = after[j], before[i]
            symbols[i], symbols[j] = int(made[r]), -1
            after[i] = right
            if right >= 0:
                before[right] = i
            put(j, none)
            put(i, leaf(i, right) if right >= 0 else none)
            if left >= 0:
                put(left, leaf(left, i))
        return [s for s in symbols if s >= 0]

    def merge(self, texts: list[str]) -> dict[str, bytes]:
        """Each word's ids as little-endian unsigned 32-bit integers."""
        by_width: dict[int, list[tuple[str, bytes]]] = {}
        out = {}
        for t in texts:
            raw = t.encode()
            if len(raw) > SHORT:
                symbols = self.byte_id[np.frombuffer(raw, np.uint8)].tolist()
                out[t] = np.array(self.merge_long(symbols), "<u4").tobytes()
            else:
                by_width.setdefault(max(4, 1 << (len(raw) - 1).bit_length()), []).append((t, raw))
        for width, group in by_width.items():
            for i in range(0, len(group), 8192):
                part = group[i:i + 8192]
                lengths = np.array([len(r) for _, r in part])
                symbols = np.full((len(part), width), -1, dtype=np.int64)
                symbols[np.arange(width) < lengths[:, None]] = self.byte_id[np.frombuffer(b"".join(r for _, r in part), np.uint8)]
                symbols = self.merge_rows(symbols)
                kept = symbols >= 0
                flat, ends = symbols[kept].astype("<u4").tobytes(), (4 * np.cumsum(kept.sum(axis=1))).tolist()
                at = 0
                for (t, _), end in zip(part, ends):
                    out[t], at = flat[at:end], end
        return out

    def cut(self, text: str) -> list[str]:
        """The words of a text."""
        return (PLAIN if UNLIKE.isdisjoint(text) else self.split_words).findall(text)

    def stretches(self, text: str) -> list[str]:
        """The text cut at some of the places where words are cut: before single blanks and around single line ends, if
        it has no other blanks; else into words."""
        parts, blanks = text.split(), text.count(" ") + text.count("\n")
        if "\0" not in text and len(parts) == 1 + blanks and len(text) == blanks + len("".join(parts)):
            return text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")
        return self.cut(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = []
        for text in texts:
            if self.split_added and self.split_added.search(text):
                cut.append([x for part in self.split_added.split(text) if part for x in ([part] if part in self.added else self.stretches(part))])
            else:
                cut.append(self.stretches(text) if text else [])
        wanted = set().union(*cut)
        known = self.known
        fresh = [t for t in wanted if t not in known]
        if self.held > REMEMBERED:
            # What has come again since the last such cut stays known; the rest is worked out again when it comes.
            keep = self.seen if sum(OVERHEAD + 2 * len(t) for t in self.seen) < REMEMBERED // 2 else set()
            known = self.known = {t: ids for t, ids in known.items() if t in keep or t in wanted}
            self.seen = set()
            self.held = sum(OVERHEAD + 2 * len(t) + len(ids) for t, ids in known.items())
        else:
            self.seen |= wanted.difference(fresh)
        words, split = set(), {}
        for t in fresh:
            if t[1:].isalpha() and (t[0] == " " or t[0].isalpha()):
                words.add(t)
                continue
            if t[-1] in ",." and t[1:-1].isalpha() and (t[0] == " " or t[0].isalpha()):
                parts = [t[:-1], t[-1]]
            else:
                parts = self.cut(t)
            split[t] = parts
            words.update(p for p in parts if p not in known)
        known.update(self.merge(list(words)))
        for t, parts in split.items():
            known[t] = b"".join([known[p] for p in parts])
        for t, i in self.added.items():
            known[t] = np.array([i], "<u4").tobytes()
        self.held += sum(OVERHEAD + 2 * len(t) + len(known[t]) for part in (fresh, words) for t in part)
        return [b"".join(map(known.__getitem__, c)) for c in cut]

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the ids of each whole text as little-endian unsigned 32-bit integers in one binary value."""
    schema = StructType.fromDDL("doc_id long, ids binary")

    def run(batches):
        vocab = vocabulary(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(vocab.encode(part.column(1).to_pylist()), pa.binary())],
                    schema=to_arrow_schema(schema))

    return keyed(docs, id_col, text_col).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``encoded`` with the text in place of the ids; other columns stay. Null ids give a null text."""
    rest = [f for f in encoded.schema.fields if f.name not in (ids_col, text_col)]
    schema = StructType([*rest, StructField(text_col, StringType())])

    def run(batches):
        vocab, arrow = vocabulary(path), to_arrow_schema(schema)
        for batch in batches:
            texts = [None if x is None else vocab.decode(x) for x in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], schema=arrow)

    return encoded.select(*[F.col(f"`{f.name}`") for f in rest], F.col(ids_col)).mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, text): encoded, and decoded from these ids by the same worker, so that a core holds one vocabulary."""
    schema = StructType.fromDDL("doc_id long, ids binary, text string")

    def run(batches):
        vocab, arrow = vocabulary(path), to_arrow_schema(schema)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = vocab.encode(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), pa.array(map(vocab.decode, ids), pa.string())], schema=arrow)

    return keyed(docs, id_col, text_col).mapInArrow(run, schema)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: every text encoded and decoded again."""
    return round_trip(docs, path).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
