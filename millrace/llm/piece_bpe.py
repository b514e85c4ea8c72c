"""SentencePiece BPE encoding and decoding with a table of each prefix's last token.

Merging by score leaves every prefix of a text with one last token, whatever follows. An automaton over the vocabulary
finds all pieces that end at each place; of those, exactly one fits the last token of what lies before it: the pair
stays a pair when merged on its own. So the table is filled from left to right, and the ids are read off backwards.
A pair is tested along the pieces' own merges, undone from the latest one: if at any moment the symbols on both sides of
the seam would have merged before their own next merge, the pair does not stand. A text of n characters costs O(n).

Characters without a piece become bytes and stop every merge. No piece runs across the places where ``cut`` parts a text
(checked when a file is read), so equal words are worked out once in a batch and remembered within ``REMEMBERED`` bytes.
The file must be of the BPE kind with byte fallback and leave texts as they are, but for blanks and the blank put before.
It is read on each executor, where it must exist; the library serves for reading it only.

Defined results: a null or empty text has only its begin and end ids; U+2581 is encoded as a blank, as the library does;
repeated rows and null ids stay as they are; other columns are ignored; an empty table gives an empty one. Decoding
leaves out begin and end ids and one blank before the first piece, and turns each byte that is not UTF-8 into U+FFFD;
null ids give a null text; an id outside the vocabulary raises.
"""

from __future__ import annotations

import codecs
import re
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

from millrace.llm.common import keyed

BLANK = "▁"
# Bytes that a worker spends on remembered words, about; and pairs whose test it remembers.
REMEMBERED = 48 << 20
PAIRS = 1 << 18
# What a remembered word costs besides its letters and ids.
OVERHEAD = 160
# Texts encoded at once.
TEXTS = 256
LETTERS = r"[^\W\d_]"
CUT = re.compile(rf" *{LETTERS}+| *(?:[^\w ]|[\d_])+| +")
LETTER = re.compile(LETTERS)
NEVER = 1 << 60

codecs.register_error("one-mark-per-byte", lambda e: ("�" * (e.end - e.start), e.end))


class Pieces:
    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        spec = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        norm, trained = spec.normalizer_spec, spec.trainer_spec
        if (trained.model_type != trained.BPE or not trained.byte_fallback or norm.precompiled_charsmap or norm.remove_extra_whitespaces
                or not norm.add_dummy_prefix or not norm.escape_whitespaces or trained.treat_whitespace_as_suffix):
            raise ValueError("not a plain BPE file with byte fallback")
        library = SentencePieceProcessor(model_file=path)
        self.n = library.get_piece_size()
        self.begin, self.end = library.bos_id(), library.eos_id()
        self.surface, self.control, self.high = [""] * self.n, set(), {}
        self.byte_id, ids, scores = [0] * 256, [], []
        for i in range(self.n):
            piece = library.id_to_piece(i)
            if library.is_control(i):
                self.control.add(i)
            elif library.is_unknown(i):
                self.surface[i] = trained.unk_surface
            elif library.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_id[value] = i
                if value < 128:
                    self.surface[i] = chr(value)
                else:
                    self.high[i] = value
            elif library.is_unused(i) or spec.pieces[i].type == spec.pieces[i].USER_DEFINED:
                raise ValueError("unused or user-defined pieces are not supported")
            else:
                self.surface[i] = piece.replace(BLANK, " ")
                ids.append(i)
                scores.append(library.get_score(i))
        self.is_high = np.zeros(self.n, bool)
        self.is_high[list(self.high)] = True
        order = np.unique(-np.array(scores), return_inverse=True)[1].tolist()
        self.rank = dict(zip((self.surface[i] for i in ids), order))
        self.id_of = {self.surface[i]: i for i in ids}
        self._read_merges(ids)
        self._check_cuts()
        self.pairs: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        self.held = 0

    def merged(self, text: str) -> tuple[list[str], list[tuple[str, str]]]:
        """A short text merged step by step, best score first, the leftmost of equals; and the merges made."""
        parts, made, rank = list(text), [], self.rank
        while True:
            best, at = NEVER, -1
            for k in range(len(parts) - 1):
                r = rank.get(parts[k] + parts[k + 1], NEVER)
                if r < best:
                    best, at = r, k
            if at < 0:
                return parts, made
            made.append((parts[at], parts[at + 1]))
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _read_merges(self, ids: list[int]) -> None:
        """Each piece's last merge, the pairs that join into a piece, and the automaton over all pieces."""
        self.length, self.birth = [0] * self.n, [-1] * self.n
        self.left, self.right = [0] * self.n, [0] * self.n
        self.plain, whole = [True] * self.n, []
        for i in ids:
            text = self.surface[i]
            parts, made = self.merged(text)
            if len(parts) > 1:
                continue                                    # never the outcome of merging
            whole.append(i)
            self.length[i] = len(text)
            if made:
                self.left[i], self.right[i] = self.id_of[made[-1][0]], self.id_of[made[-1][1]]
                self.birth[i] = self.rank[text]
        for i in sorted(whole, key=lambda i: self.length[i]):
            if self.birth[i] >= 0:
                halves = self.left[i], self.right[i]
                self.plain[i] = all(self.plain[h] and self.birth[h] < self.birth[i] for h in halves)
        self.joined = {}
        for i in ids:
            text = self.surface[i]
            for k in range(1, len(text)):
                a, b = self.id_of.get(text[:k]), self.id_of.get(text[k:])
                if a is not None and b is not None and self.length[a] and self.length[b]:
                    self.joined[a * self.n + b] = self.rank[text]
        self.automaton = ahocorasick.Automaton()
        for i in whole:
            self.automaton.add_word(self.surface[i], i)
        self.automaton.make_automaton()

    def _check_cuts(self) -> None:
        """Pairs of characters that some piece holds although ``CUT`` parts them; texts with such a pair are cut at blanks only."""
        self.glued, self.cuttable = set(), True
        for text in self.id_of:
            for x, y in zip(text, text[1:]):
                if y == " " and x != " ":
                    self.cuttable = False
                elif x != " " and bool(LETTER.match(x)) != bool(LETTER.match(y)):
                    self.glued.add(x + y)
        self.glue = re.compile("|".join(map(re.escape, sorted(self.glued)))) if self.glued else None

    def cut(self, text: str) -> list[str]:
        """The text, blank first, in parts that no piece runs across."""
        text = " " + text.replace(BLANK, " ")
        if not self.cuttable:
            return [text]
        return re.findall(" +[^ ]*", text) if self.glue and self.glue.search(text) else CUT.findall(text)

    def stands(self, a: int, b: int) -> bool:
        """Whether the pieces a and b stay apart when their texts are merged side by side."""
        if not (self.plain[a] and self.plain[b]):
            return self.merged(self.surface[a] + self.surface[b])[0] == [self.surface[a], self.surface[b]]
        joined, birth, n = self.joined, self.birth, self.n
        next_a = next_b = NEVER                             # when each side's symbol merges within its own piece
        while True:
            seam = joined.get(a * n + b, NEVER)
            if seam < next_a and seam <= next_b and seam < NEVER:
                return False                                # of equal merges the left one goes first
            if birth[a] > birth[b]:
                next_a, a = birth[a], self.right[a]
            elif birth[b] >= 0:
                next_b, b = birth[b], self.left[b]
            else:
                return True

    def encode_word(self, word: str) -> list[int]:
        last, length, pairs, n = [-1] * (len(word) + 1), self.length, self.pairs, self.n
        for end, piece in self.automaton.iter(word):
            end += 1
            if last[end] >= 0:
                continue
            before = last[end - length[piece]]
            if before >= 0:                                 # else the word's start or a character without a piece
                pair = before * n + piece
                fits = pairs.get(pair)
                if fits is None:
                    if len(pairs) >= PAIRS:
                        pairs.clear()
                    fits = pairs[pair] = self.stands(before, piece)
                if not fits:
                    continue
            last[end] = piece
        out, end = [], len(word)
        while end:
            piece = last[end]
            if piece >= 0:
                out.append(piece)
                end -= length[piece]
            else:
                end -= 1
                out.extend(self.byte_id[x] for x in reversed(word[end].encode()))
        out.reverse()
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids, begin and end included, as little-endian unsigned 32-bit integers."""
        cuts = [self.cut(t) if t else [] for t in texts]
        wanted = set().union(*cuts)
        known = self.known
        fresh = [w for w in wanted if w not in known]
        cost = 0
        for w in fresh:
            ids = known[w] = np.array(self.encode_word(w), "<u4").tobytes()
            cost += OVERHEAD + 2 * len(w) + len(ids)
        self.held += cost
        begin, end = (np.array([i], "<u4").tobytes() for i in (self.begin, self.end))
        out = [b"".join([begin, *map(known.__getitem__, c), end]) for c in cuts]
        if self.held > REMEMBERED:
            # Start anew, with the words of this batch that were known before.
            kept = wanted.difference(fresh)
            self.known = {w: known[w] for w in kept}
            self.held = sum(OVERHEAD + 2 * len(w) + len(self.known[w]) for w in kept)
            if self.held > REMEMBERED // 2:
                self.known, self.held = {}, 0
        return out

    def decode(self, ids: bytes) -> str:
        array = np.frombuffer(ids, "<u4")
        values = array.tolist()
        if self.is_high[array].any():
            parts, run = [], bytearray()
            for i in values:
                if i in self.high:
                    run.append(self.high[i])
                else:
                    if run:
                        parts.append(run.decode("utf-8", "one-mark-per-byte"))
                        run.clear()
                    parts.append(self.surface[i])
            parts.append(run.decode("utf-8", "one-mark-per-byte"))
            text = "".join(parts)
        else:
            text = "".join(map(self.surface.__getitem__, values))
        first = next((i for i in values if i not in self.control), None)
        led = first is not None and self.surface[first][:1] == " " and self.surface[first] in self.id_of
        return text[1:] if led else text


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Pieces:
    return Pieces(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): begin id, the ids of each whole text and end id, little-endian unsigned 32-bit integers in one binary value."""
    schema = StructType.fromDDL("doc_id long, ids binary")

    def run(batches):
        vocab, arrow = vocabulary(path), to_arrow_schema(schema)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(vocab.encode(part.column(1).to_pylist()), pa.binary())], schema=arrow)

    return keyed(docs, id_col, text_col).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``encoded`` with the text in place of the ids; other columns stay."""
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
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                ids = vocab.encode(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), pa.array(map(vocab.decode, ids), pa.string())], schema=arrow)

    return keyed(docs, id_col, text_col).mapInArrow(run, schema)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: every text encoded and decoded again."""
    return round_trip(docs, path).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
