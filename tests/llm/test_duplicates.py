"""Suffix arrays, removal of repeats and near-duplicates against brute force."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import near_dedup, suffix_dedup
from millrace.llm.components import components
from millrace.llm.suffix_array import suffix_array, suffix_arrays

CLASH = "doc_id long, text string, h long, c long, doc int, start int, stop int, key string, rep int, n int, cluster int"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, 3, 4, 5, "k", 6, 7, 8) for i, t in rows], CLASH)


def naive(text):
    return sorted(range(len(text)), key=lambda i: text[i:])


@given(st.lists(st.integers(1, 4), max_size=60))
@settings(max_examples=300, deadline=None)
def test_suffix_array_of_one_text(symbols):
    assert suffix_array([*symbols, 0]) == naive([*symbols, 0])


def test_suffix_arrays_in_step():
    rng = random.Random(1)
    texts = [[rng.randint(1, rng.choice([1, 2, 3, 257])) for _ in range(rng.randint(0, 70))] + [0] for _ in range(400)]
    texts += [[1, 2] * 20 + [0], [5] * 50 + [0], [0]]
    rows = np.full((len(texts), 71), -1)
    for i, t in enumerate(texts):
        rows[i, :len(t)] = t
    got = suffix_arrays(rows, np.array([len(t) for t in texts]))
    assert all(got[i, :len(t)].tolist() == naive(t) for i, t in enumerate(texts))


def brute_removed(texts, span=100):
    """For each text the removed byte places; the texts in order."""
    seen, out = set(), []
    for text in texts:
        raw, gone = (text or "").encode(), set()
        for s in range(len(raw) - span + 1):
            window = raw[s:s + span]
            if window in seen:
                gone |= set(range(s, s + span))
            seen.add(window)
        out.append(gone)
    return out


def check_removed(rows, order):
    """rows by position; ``order`` are the (position, text) in their order."""
    for (i, text), gone in zip(order, brute_removed([t for _, t in order])):
        raw = (text or "").encode()
        kept = bytes(b for k, b in enumerate(raw) if k not in gone)
        spans = sum(1 for k in gone if k - 1 not in gone)
        r = rows[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (len(raw), len(gone), spans)
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def texts_with_repeats(seed, n=50):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgñ") for _ in range(rng.randint(1, 7)))
    parts = [" ".join(word() for _ in range(rng.randint(10, 60))) for _ in range(8)]
    out = []
    for _ in range(n):
        body = [rng.choice([" ".join(word() for _ in range(rng.randint(0, 40))), rng.choice(parts)]) for _ in range(rng.randint(0, 5))]
        text = list(" ".join(body))
        for _ in range(rng.randint(0, 3)):
            if text:
                text[rng.randrange(len(text))] = rng.choice("xyzÄ")
        out.append("".join(text))
    return out


def test_repeats_equal_brute_force(spark):
    texts = texts_with_repeats(3) + [None, "", "a" * 700, "ab" * 300, "ab" * 300, "x" * 99, "x" * 100, "x" * 101, "🙂é" * 60]
    rows = {r["doc_id"]: r for r in suffix_dedup.report(documents(spark, list(enumerate(texts)))).collect()}
    check_removed(rows, list(enumerate(texts)))


def test_large_groups_go_by_window_and_long_texts_in_sections(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BROADCAST_ROWS", 0)
    rng = random.Random(9)
    common = "".join(rng.choice("abcdefgh ") for _ in range(95))
    texts = ["".join(rng.choice("stuvw ") for _ in range(60)) + common + "".join(rng.choice("qr") for _ in range(60)) for _ in range(60)] + texts_with_repeats(4, 20)
    rows = {r["doc_id"]: r for r in suffix_dedup.report(documents(spark, list(enumerate(texts))), limit=3, section=150).collect()}
    check_removed(rows, list(enumerate(texts)))


def test_gathering_holds_no_large_group():
    import pyarrow as pa

    step = suffix_dedup.STEP - 1
    pieces = [(bytes([97 + i] * (step - i)), bytes([98 + i] * i)) for i in range(8)]     # each has one window
    rows = [(5, 7, *p, i, 0) for i, p in enumerate(pieces)] + [(5, 7, *pieces[-1], 99, 3), (6, 7, *pieces[0], 1, 0), (6, 7, *pieces[1], 2, 0), (6, 8, *pieces[1], 2, 0)]
    batches = [pa.RecordBatch.from_pylist([dict(zip("kqbads", r)) for r in rows[i:i + 2]]) for i in range(0, len(rows), 2)]
    spans, loose, groups = [], [], []
    for a, b, c in suffix_dedup._gathered(batches, 3):
        spans, loose, groups = spans + a, loose + b, groups + c
    assert spans == [(99, 3, 103)] and len(loose) == 8 and [len(g) for g in groups] == [2]
    assert len({x[3:] for x in loose}) == 8


def test_repeated_and_null_ids_keep_rows_of_their_own(spark):
    body = texts_with_repeats(6, 4)[0] * 3 + "tail of the first text"
    rows = [(1, body), (1, body), (None, body), (2, None), (2, "")]
    got = suffix_dedup.report(documents(spark, rows)).collect()
    assert len(got) == 5 and {r["doc_id"] for r in got} == {None, 1, 2}
    whole = [r for r in got if r["n_bytes"] and r["n_removed"] < r["n_bytes"]]
    assert len(whole) == 1 and whole[0]["doc_id"] is None           # nulls come first
    assert suffix_dedup.report(documents(spark, rows).limit(0)).count() == 0


# --- near-duplicates -------------------------------------------------------------------------------------------------

def shingles(text, size):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w]
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def brute_components(rows, size, num, den):
    sets = [(i, shingles(t, size)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if x and y and den * len(x & y) >= num * len(x | y):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return {i: root(i) for i in parent}


def near_copies(seed, groups=6, copies=25):
    rng, out = random.Random(seed), []
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6)))
    for _ in range(groups):
        base = [word() for _ in range(rng.choice([30, 80, 300]))]
        for _ in range(copies):
            text = base[:]
            for _ in range(rng.randint(0, max(1, len(base) // 14))):
                text[rng.randrange(len(text))] = word()
            out.append(" ".join(text))
            if rng.random() < 0.3:
                base = text
    return out


@pytest.mark.parametrize("size, num, den", [(3, 85, 100), (5, 8, 10)])
def test_components_equal_brute_force(spark, size, num, den):
    texts = near_copies(size) + ["", None, " \t ", "one", "ONE", "one two", "one two", "Ä b c d e f", "ä b c d e f"]
    rows = list(enumerate(texts))
    got = {r["doc_id"]: r for r in near_dedup.classes(documents(spark, rows), size, num, den).collect()}
    want = brute_components(rows, size, num, den)
    for i, text in rows:
        assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (len(shingles(text, size)), want[i], want[i] == i)


def test_large_groups_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", 8)
    monkeypatch.setattr(near_dedup, "BLOCK_SETS", 6)
    monkeypatch.setattr(near_dedup, "BROADCAST_ROWS", 0)
    rows = list(enumerate(near_copies(11, groups=2, copies=50)))
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.classes(documents(spark, rows), 3, 85, 100).collect()}
    assert got == brute_components(rows, 3, 85, 100)


def test_repeated_and_null_ids(spark):
    a, b = near_copies(5, groups=2, copies=1)
    rows = [(4, a), (4, a), (4, b), (9, b), (7, a), (None, a), (12, None)]
    got = near_dedup.classes(documents(spark, rows), 3, 85, 100).collect()
    assert len(got) == 7
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in got} == {(4, 4, True), (9, 4, False), (7, 4, False), (None, None, True), (12, 12, True)}
    assert near_dedup.classes(documents(spark, rows).limit(0), 3, 85, 100).count() == 0


def test_plan_guarantees_few_misses_and_shared_keys():
    for num, den in ((85, 100), (8, 10), (95, 100)):
        symbols, distance = near_dedup.plan_for(num, den)
        chunks = symbols // near_dedup.CHUNK
        # With two errors in every chunk there would be more than ``distance``.
        assert 2 * chunks > distance


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(500, 501), (501, 502), (502, 500), (7, 7), (None, 3)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(60)}, 500: 500, 501: 500, 502: 500}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
