"""Vector codes, the prefix trie and SentencePiece against brute force or the library, and on odd rows."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from millrace.llm import piece_bpe, prefix_trie, vector_codes

# --- vector codes ----------------------------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>, label int, code string, error int, of string, ids string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, "c", 1, "o", "x") for i, v, label in rows], VECTORS)


def brute_codes(rows, entries=64, rounds=2):
    kept = [(i, v, label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    dim = len(kept[0][1]) // 16
    cut = [[[math.floor(256 * x) for x in v[p * dim:(p + 1) * dim]] for p in range(16)] for _, v, _ in kept]
    first = sorted(range(len(kept)), key=lambda r: (kept[r][0] is None, kept[r][0], kept[r][1]))[:entries]
    books = [[cut[r][p] for r in first] for p in range(16)]

    def nearest(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(16):
            members = defaultdict(list)
            for r in range(len(kept)):
                members[nearest(p, cut[r][p])[1]].append(cut[r][p])
            books[p] = [[sum(c) // len(members[k]) for c in zip(*members[k])] if members[k] else e for k, e in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = [[nearest(p, parts[p]) for p in range(16)] for parts in cut]
    errors = [sum(d for d, _ in f) for f in found]
    totals = Counter()
    for (_, _, label), e in zip(kept, errors):
        totals[label] += e
    return sorted(((i, "".join(f"{k:02x}" for _, k in f), e, totals[label], digest) for (i, _, label), f, e in zip(kept, found, errors)), key=str)


def codes(df):
    out = vector_codes.report(df)
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def random_rows(n, dim, seed, spread=0.4):
    rng = random.Random(seed)
    near = [[rng.gauss(0, spread) for _ in range(16 * dim)] for _ in range(7)]
    return [(k * 3, [c + rng.gauss(0, 0.05) for c in rng.choice(near)], rng.choice([1, 2, None])) for k in range(n)]


@pytest.mark.parametrize("dim", [1, 3, 4])
def test_codes_equal_brute_force(spark, monkeypatch, dim):
    monkeypatch.setattr(vector_codes, "CHUNK", 100)
    monkeypatch.setattr(vector_codes, "BLOCK", 8)
    monkeypatch.setattr(vector_codes, "KERNEL", 500)
    rows = random_rows(330, dim, dim)
    assert codes(vectors(spark, rows).repartition(3)) == brute_codes(rows)


def test_codes_of_odd_rows(spark):
    usual = random_rows(70, 1, 9)
    odd = [(1, None, 1), (2, [], 1), (4, [0.1] * 15 + [None], 1), (5, [0.1] * 15 + [math.nan], 1), (7, [math.inf] * 16, 2), (8, [0.5] * 32, 2),
           (10, [0.5] * 17, 2), (11, [1e30] * 16, 2)]
    same = [(13, [0.25] * 16, 3), (13, [0.25] * 16, 3), (13, [-0.25] * 16, None), (None, [0.0] * 16, 4)]
    assert codes(vectors(spark, usual + odd + same)) == brute_codes(usual + same)


def test_codes_with_large_components_are_exact(spark):
    rng = random.Random(3)
    rows = [(k, [rng.choice([1.0, -1.0]) * 2.0 ** rng.randint(0, 21) + rng.random() for _ in range(16)], k % 3) for k in range(90)]
    assert codes(vectors(spark, rows)) == brute_codes(rows)


def test_codes_of_few_and_no_rows(spark):
    rows = random_rows(5, 2, 1)
    assert codes(vectors(spark, rows)) == brute_codes(rows)
    assert codes(vectors(spark, [(1, None, 1)])) == []
    assert codes(vectors(spark, [])) == []


def test_codes_of_many_labels_are_joined_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "BROADCAST_ROWS", 0)
    rows = random_rows(60, 1, 4)
    assert codes(vectors(spark, rows)) == brute_codes(rows)


def test_an_error_beyond_a_long_is_the_largest_long(spark):
    rows = [(k, [0.0] * 16, 1) for k in range(64)] + [(100, [2.0 ** 40] * 16, 1), (101, [-2.0 ** 40] * 16, 2)]
    found = {r[0]: r for r in codes(vectors(spark, rows))}
    assert found[101][2] == found[100][3] == vector_codes.LONG_MAX or found[100][2] == vector_codes.LONG_MAX


def test_hilbert_neighbours_touch():
    grid = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    order = vector_codes.hilbert_keys(grid, 3).argsort()
    assert (np.abs(np.diff(grid[order], axis=0)).sum(axis=1) == 1).all()


def test_shortlists_hold_the_nearest_and_spare_others():
    rng = np.random.default_rng(1)
    x = rng.integers(-60, 60, (3000, 16, 4))
    blocks, books = vector_codes.Blocks.of(x), x[:64].transpose(1, 0, 2)
    position, listed = blocks.shortlists(books, np.int64)
    nearest = ((blocks.parts[:, :, None] - books[position][:, None]) ** 2).sum(axis=3).argmin(axis=2)
    assert np.take_along_axis(listed, nearest, axis=1).all() and listed.mean() < 0.75


# --- prefix trie -----------------------------------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, depth int, chain string, n_convs int"


def turns(spark, rows):
    return spark.createDataFrame([(*r, 1, "c", 2) for r in rows], TURNS)


def brute_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts, key=lambda t: t[:2])] for c, ts in own.items()}
    members, ends = defaultdict(set), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9
        path = tuple(own.get(c - c % 5, [])[:h] + own[c][h:])
        ends[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].add(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    below = {}
    for node in sorted(members, key=len, reverse=True):
        saved = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        below[node] = (sum(below[k][0] for k in kids[node]) or 1, saved + sum(below[k][1] for k in kids[node]))
    return sorted((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(kids[node]), *below[node],
                   hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest()) for node, m in members.items())


def nodes(df, **options):
    out = prefix_trie.trie(df, **options)
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=lambda r: tuple((x is not None, x) for x in r))


def by_none(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def talk(n, seed, depth=6, words=2):
    rng = random.Random(seed)
    return [(c, t, ("user", "bot")[t % 2], "wé " * rng.randint(0, words)) for c in range(n) for t in range(rng.randint(1, depth))]


@pytest.mark.parametrize("run", [2, 16, 20_000])
def test_trie_equals_brute_force(spark, monkeypatch, run):
    monkeypatch.setattr(prefix_trie, "RUN", run)
    rows = talk(150, 3)
    assert nodes(turns(spark, rows).repartition(5)) == by_none(brute_trie(rows))


def test_trie_with_a_hot_conversation_and_a_long_one(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "RUN", 8)
    monkeypatch.setattr(prefix_trie, "BLOB", 100)
    monkeypatch.setattr(prefix_trie, "BROADCAST_ROWS", 0)
    rows = [(c, t, "user", f"same {t}") for c in range(200) for t in range(12)] + [(c + 300, *rest) for c, *rest in talk(40, 5, depth=14)]
    rows += [(c + 1000, t, "user", f"same {t}") for c in range(3) for t in range(300)]
    assert nodes(turns(spark, rows).repartition(6)) == by_none(brute_trie(rows))


def test_trie_of_odd_rows(spark):
    rows = [(None, 0, "user", "lost"), (5, None, None, None), (5, 0, "user", ""), (5, 3, "user", "x" * 100_000), (6, 1, "", "a"), (6, 1, "", "a"),
            (7, 0, "a", "bc"), (8, 0, "ab", "c"), (12, 0, "user", "no family"), (10**12, 0, None, "日本")]
    assert nodes(turns(spark, rows)) == by_none(brute_trie(rows))
    assert nodes(turns(spark, [])) == [] and nodes(turns(spark, [(None, 1, "a", "b")])) == []


def test_trie_of_turns_with_equal_numbers_is_the_same_in_any_order(spark):
    rows = [(1, 0, "u", str(k)) for k in range(6)] + [(2, 0, "u", str(k)) for k in range(9)]
    assert nodes(turns(spark, rows)) == nodes(turns(spark, rows[::-1]).repartition(4))


# --- SentencePiece ---------------------------------------------------------------------------------------------------

PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "  " * 40, "a" * 40_000, "\0\x1c\t\n", "▁x▁▁y", "<s> <0x0A> </s>", "ÄÖÜ ñ 日本 🙂 é", "².", "plain words", "plain words", "�"]


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PIECES)


def same_as_library(vocab, library, texts):
    wanted = library.encode(texts, add_bos=True, add_eos=True)
    assert [np.frombuffer(x, "<u4").tolist() for x in vocab.encode(texts)] == wanted
    assert [vocab.decode(np.array(ids, "<u4").tobytes()) for ids in wanted] == [library.decode(ids) for ids in wanted]


def test_pieces_equal_the_library_on_random_text(library):
    rng, vocab = random.Random(7), piece_bpe.vocabulary(PIECES)
    pieces = list(vocab.id_of)
    texts = ["".join(rng.choice("ab c\n.▁ 1²é") for _ in range(rng.randrange(60))) for _ in range(500)]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randrange(20))) for _ in range(500)]
    texts += [" " * rng.randrange(40) + rng.choice(pieces) * rng.randrange(6) + " " * rng.randrange(40) for _ in range(300)]
    texts += ["".join(chr(rng.choice([rng.randrange(256), rng.randrange(0x300, 0xD000), 0x1F600, 32, 101])) for _ in range(30)) for _ in range(300)]
    same_as_library(vocab, library, texts + [t or "" for t in ODD])


def test_decoding_any_ids_equals_the_library(library):
    rng, vocab = random.Random(8), piece_bpe.vocabulary(PIECES)
    some = [0, 1, 2, 13, 3 + 0xE2, 3 + 0x81, 3 + 0xA1, 259, 264, 28705]
    for _ in range(3000):
        ids = [rng.choice([*some, rng.randrange(32000)]) for _ in range(rng.randrange(8))]
        assert vocab.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids), ids
    with pytest.raises(IndexError):
        vocab.decode(np.array([40_000], "<u4").tobytes())


def test_pieces_forget_words_without_changing_results(library, monkeypatch):
    monkeypatch.setattr(piece_bpe, "REMEMBERED", 2000)
    monkeypatch.setattr(piece_bpe, "PAIRS", 5)
    vocab = piece_bpe.Pieces(PIECES)
    for i in range(60):
        same_as_library(vocab, library, [f"some words number {i % 7} and {i} again"])


def test_a_pair_stands_as_merging_says():
    vocab = piece_bpe.vocabulary(PIECES)
    rng = random.Random(9)
    ids = list(vocab.id_of.values())
    for _ in range(4000):
        a, b = rng.choice(ids), rng.choice(ids)
        assert vocab.stands(a, b) == (vocab.merged(vocab.surface[a] + vocab.surface[b])[0] == [vocab.surface[a], vocab.surface[b]])


def test_pieces_of_odd_rows(spark, library):
    schema = "doc_id long, text string, ids string, n_tokens int"
    docs = spark.createDataFrame([(None if i == 4 else 7 if i in (10, 11) else i, t, "x", 1) for i, t in enumerate(ODD)], schema)
    found = piece_bpe.digests(docs, PIECES).collect()
    wanted = []
    for r in docs.collect():
        ids = library.encode(r["text"] or "", add_bos=True, add_eos=True)
        wanted.append((r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert sorted(map(tuple, found), key=str) == sorted(wanted, key=str)
    assert piece_bpe.digests(docs.limit(0), PIECES).count() == 0
    back = piece_bpe.decode(piece_bpe.encode(docs, PIECES).union(spark.createDataFrame([(99, None)], "doc_id long, ids binary")), PIECES)
    assert {r["doc_id"]: r["text"] for r in back.collect()}[99] is None
