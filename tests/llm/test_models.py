"""Toxicity, language model, neighbours and token files: held-out accuracy, brute force, round trips, odd rows."""

import collections
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import ann, lm, token_output, toxicity

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [(0, None), (1, ""), (2, " \t"), (3, "x" * 30_000), (4, "same text"), (4, "same text"), (None, "no id at all")]
CLASH = "doc_id long, text string, severity string, held int, block int, shard int, start int, score int, label int"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "s", 1, 2, 3, 4, 5, 6) for i, t in rows], CLASH)


# --- toxicity --------------------------------------------------------------------------------------------------------

def toxic_rows(seed, n):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    rows = []
    for i in range(n):
        words = [word() for _ in range(rng.randint(20, 200))]
        toxic = i % 5 == 0
        for _ in range(rng.randint(2, 6) if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice(["zorro", "zorros", "zorrin", "wukko", "wukkos"])
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_toxic_documents_are_graded_above_others(spark):
    rows = toxic_rows(1, 900)
    train, held = rows[:600], rows[600:]
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in train] + [(10_000, 1, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    graded = {r["doc_id"]: r for r in toxicity.grade_documents(documents(spark, [(i, t) for i, t, _ in held]), labels, documents(spark, [(i, t) for i, t, _ in train])).collect()}
    right = [graded[i]["rejected"] == bool(y) for i, _, y in held]
    assert sum(right) / len(right) > 0.98
    assert all(0 <= r["severity"] <= 2 and r["grade"] in (0, 1, 2) for r in graded.values())
    by_hits = collections.defaultdict(list)
    for i, t, _ in held:
        by_hits[len(set(re.findall("zorro|zorros|zorrin|wukko|wukkos", t)))].append(graded[i]["severity"])
    assert np.mean(by_hits[0]) < np.mean(by_hits[1] + by_hits[2]) < np.mean(sum((v for k, v in by_hits.items() if k > 2), [])) + 1e-9


def test_thresholds_are_ordered_and_probabilities_add_up():
    rows = toxic_rows(2, 400)
    rng = np.random.default_rng(0)
    buckets = [np.unique(rng.integers(0, 50, 20) + (1000 if y else 0) * rng.integers(0, 2, 20)) for *_, y in rows]
    model = toxicity.fit_rows(buckets, np.array([bool(y) for *_, y in rows]))
    assert model.thresholds[0] < model.thresholds[1] and (model.weights >= 0).all()
    up = model.above(np.linspace(-5, 50, 30))
    assert (up[:, 0] >= up[:, 1]).all() and ((up >= 0) & (up <= 1)).all()


def test_marks_of_a_rare_kind_are_kept_beside_a_frequent_one():
    rng = np.random.default_rng(1)
    rows = [rng.integers(100, 5000, 20) for _ in range(4000)]
    toxic = np.arange(4000) % 10 == 0
    for k, i in enumerate(np.flatnonzero(toxic)):
        rows[i] = np.append(rows[i], 2 if k % 50 == 0 else 1)            # 8 rows against 392
    model = toxicity.fit_rows([np.unique(r) for r in rows], toxic)
    assert model.weights[1] > 0 and model.weights[2] > 0
    up = model.above(model.weights[[2]])
    assert up.sum() >= toxicity.REJECT


def test_toxicity_without_a_model_and_on_odd_rows(spark):
    docs = documents(spark, ODD)
    none = spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    rows = toxicity.grade_documents(docs, none).collect()
    assert len(rows) == len(ODD) and not any(r["rejected"] for r in rows)
    train = toxic_rows(3, 300)
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in train], "doc_id long, quality int, toxic int")
    model = toxicity.fit(toxicity.keyed(documents(spark, [(i, t) for i, t, _ in train])), labels)
    rows = toxicity.severity(docs, model).collect()
    assert len(rows) == len(ODD) and not any(r["rejected"] for r in rows)
    assert toxicity.severity(docs.limit(0), model).count() == 0
    assert toxicity.grade_documents(docs.limit(0), labels).count() == 0
    assert toxicity.grade_documents(docs, labels.limit(0)).count() == len(ODD)


# --- language model --------------------------------------------------------------------------------------------------

def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [None]


def languages(seed, n):
    """Documents of two languages whose words depend on the word before."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        own = "xy" if i % 2 else "pq"
        words = [own[0]]
        for _ in range(rng.randint(20, 120)):
            words.append(own + words[-1][-1] + rng.choice("abc"))
        out.append((i, " ".join(words).upper() if i % 7 == 3 else " ".join(words)))
    return out


def test_base_score_equals_brute_force_and_the_model_beats_it(spark):
    rows = languages(1, 240) + [(1000 + k, t) for k, (_, t) in enumerate(ODD[:4])]
    got = {r["doc_id"]: r for r in lm.score(documents(spark, rows)).collect()}
    count = collections.Counter()
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            count.update(tokens(t))
    n, v = sum(count.values()), len(count)
    base = model = 0.0
    for i, t in rows:
        r, own = got[i], tokens(t)
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 7 == 2)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(count[w] > 0 for w in own), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own), rel=1e-9)
        if r["held_out"]:
            base, model = base + r["base_score"], model + r["score"]
    assert model > base


def test_probabilities_add_up_to_one():
    rng = np.random.default_rng(1)
    weights, bias = rng.normal(size=(lm.BUCKETS, lm.CLASSES)).astype(np.float32), rng.normal(size=lm.CLASSES).astype(np.float32)
    p = np.exp(lm.log_softmax(weights, bias, rng.integers(0, lm.BUCKETS, (4, 50))))
    assert np.allclose(p.sum(axis=1), 1, atol=1e-4)


def test_updates_lower_the_loss():
    rng = np.random.default_rng(2)
    buckets = np.stack([rng.integers(0, 40, 4000) for _ in range(4)])
    klass = buckets[0] % lm.CLASSES
    trainer = lm.Trainer(np.zeros((lm.BUCKETS, lm.CLASSES), np.float32), np.zeros(lm.CLASSES, np.float32))
    loss = lambda: -lm.log_softmax(trainer.weights, trainer.bias, buckets)[np.arange(4000), klass].mean()
    before = loss()
    for _ in range(200):
        trainer.learn(buckets, klass)
    assert loss() < 0.5 * before


def test_buckets_grow_with_the_words_and_weights_have_them_all(spark):
    none = np.zeros(lm.CLASSES, dtype=np.int64)
    sizes = [lm.Facts(v, v, np.zeros(0, np.uint64), none, none).buckets for v in (0, 1000, 4_000_000, 240_000_000)]
    assert sizes[0] >= 1 << 14 and sizes == sorted(sizes) and sizes[0] < sizes[2] < sizes[3]
    blocks, facts = lm.counted(lm.stored(lm.pack(lm.keyed(documents(spark, languages(3, 60)), "doc_id", "text")), "lm-test"))
    facts.v = 4_000_000
    weights, _ = lm.train(blocks, facts)
    assert weights.shape == (facts.buckets, lm.CLASSES) and np.flatnonzero(weights.any(axis=1)).max() > 1 << 14


def test_language_model_on_odd_rows(spark):
    rows = lm.score(documents(spark, ODD)).collect()
    assert len(rows) == len(ODD) and all(r["score"] < 0 and r["n_tokens"] >= 1 for r in rows)
    assert lm.score(documents(spark, ODD).limit(0)).count() == 0
    held = [(i, "a b") for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    rows = lm.score(documents(spark, held)).collect()
    assert {(r["train_tokens"], r["n_known"], r["base_score"]) for r in rows} == {(0, 0, 0.0)}


# --- neighbours ------------------------------------------------------------------------------------------------------

def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "c") for i, v in rows], "vec_id long, embedding array<float>, cell int, shard string")


def brute_nearest(rows, k=10):
    x = {i: np.array(v, dtype=np.float32).astype(np.float64) for i, v in rows}
    out = []
    for q in sorted(x):
        if q % 100 == 0:
            near = sorted((float(np.sqrt(((x[q] - y) ** 2).sum())), i) for i, y in x.items() if i != q)[:k]
            out += [(q, r, i, d) for r, (d, i) in enumerate(near, 1)]
    return out


def test_neighbours_of_a_small_table_are_exact(spark):
    rng = np.random.default_rng(3)
    good = [(i, rng.normal(size=6).tolist()) for i in range(0, 700, 7)] + [(800 + i, [1.0] * 6) for i in range(15)]
    bad = [(2, None), (3, [0.0] * 6), (4, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (5, [float("nan")] + [1.0] * 5), (6, [float("inf")] + [1.0] * 5), (None, [1.0] * 6), (9, [1.0] * 5), (10, [])]
    again = [good[3], good[4]]
    got = sorted(tuple(r) for r in ann.nearest(vectors(spark, good + bad + again)).collect())
    want = brute_nearest(good)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in got], [r[3] for r in want], rtol=1e-12)


def test_recall_of_the_index(spark):
    rng = np.random.default_rng(4)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(6000, 16)) + 2 * rng.integers(0, 3, (6000, 1)))]
    got = {(r["query_id"], r["vec_id"]) for r in ann.nearest(vectors(spark, rows), share=0.4, least=100).collect()}
    want = {(q, i) for q, _, i, _ in brute_nearest(rows)}
    assert len(got & want) / len(want) >= 0.9


@pytest.mark.parametrize("n, dim", [(1500, 16), (2500, 64), (6000, 64)])
def test_neighbours_are_exact_at_every_size(spark, n, dim):
    rows = [(i, v.tolist()) for i, v in enumerate(np.random.default_rng(n).normal(size=(n, dim)))]
    assert sorted(tuple(r)[:3] for r in ann.nearest(vectors(spark, rows)).collect()) == [r[:3] for r in brute_nearest(rows)]


def test_cells_are_no_nearer_than_their_bounds():
    rng = np.random.default_rng(6)
    x, q = rng.normal(size=(500, 8)), rng.normal(size=(20, 8))
    index = ann.Index(x[:300], 5)
    cells, reach = index.cells(x), index.reach(x)
    for c in range(25):
        index.radii[:, c] = [r[cells == c].max(initial=0) for r in reach]
    assert (np.sqrt(ann.squared(q, x)) >= index.bounds(q)[:, cells] - 1e-9).all()


def test_walk_is_by_summed_distance():
    rng = np.random.default_rng(5)
    index = ann.Index(rng.normal(size=(400, 8)), 7)
    index.counts[:] = rng.integers(0, 5, len(index.counts))
    first, second = rng.random(7), rng.random(7)
    cells = index.walk(first, second, int(index.counts.sum()) + 1)
    total = [first[c // 7] + second[c % 7] for c in cells]
    assert sorted(cells) == list(range(49)) and total == sorted(total)


def test_few_or_no_vectors(spark):
    assert ann.nearest(vectors(spark, [(0, [1.0, 2.0])])).count() == 0
    assert [tuple(r) for r in ann.nearest(vectors(spark, [(0, [1.0, 2.0]), (3, [1.0, 2.0])])).collect()] == [(0, 1, 3, 0.0)]
    assert ann.nearest(vectors(spark, [(1, None)])).count() == 0
    assert ann.nearest(vectors(spark, [(1, None)]).limit(0)).count() == 0


# --- token files -----------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 1025, 70_001])
def test_block_round_trip(n):
    ids = (np.random.default_rng(n).zipf(1.3, n) % 60_000).astype("<u4")
    used, counts = np.unique(ids, return_counts=True)
    table = token_output.Table(dict(zip(used.tolist(), counts.tolist())))
    payload = token_output.encode_block(ids, table)
    assert (token_output.decode_block(payload, table) == ids).all()
    step = token_output.LANES * token_output.CHECKPOINT
    assert (token_output.decode_block(payload, table, 1, 2) == ids[step:2 * step]).all()


def test_damaged_blocks_and_other_tables_are_refused():
    table = token_output.Table({1: 5, 2: 3})
    payload = token_output.encode_block(np.array([1, 2, 1, 1]), table)
    with pytest.raises(ValueError, match="damaged"):
        token_output.decode_block(payload[:-1] + bytes([payload[-1] ^ 1]), table)
    with pytest.raises(ValueError, match="another table"):
        token_output.decode_block(payload, token_output.Table({1: 5, 2: 4}))


def test_token_files_equal_the_library(spark, tmp_path):
    rng = random.Random(6)
    rows = [(rng.randrange(10_000), "".join(rng.choice("abc eñ\n'!1🙂\t ") for _ in range(rng.randint(0, 80)))) for _ in range(300)]
    rows = list(dict(rows).items()) + [(20_000, None), (20_001, ""), (20_002, "a <|endoftext|> b"), (20_003, "word, " * 20_000)]
    got = {r["doc_id"]: r for r in token_output.report(documents(spark, rows).repartition(5), PATH, str(tmp_path / "files")).collect()}
    tokenizer, at = Tokenizer.from_file(PATH), 0
    for i, text in sorted(rows):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        r = got[i]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    back = token_output.read_tokens(spark, str(tmp_path / "files"))
    assert back.agg(F.sum("n_tokens")).first()[0] == at


def test_library_is_asked_for_many_stretches_in_one_text():
    class Counted:
        def __init__(self, tokenizer):
            self.tokenizer, self.texts = tokenizer, 0

        def encode_batch_fast(self, texts, **options):
            self.texts += len(texts)
            return self.tokenizer.encode_batch_fast(texts, **options)

    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcñé'日1.,-\u1680\u0301") for _ in range(rng.randint(1, 7)))
    texts = ["".join(word() + rng.choice(" \n") for _ in range(30)) + word() for _ in range(100)]
    odd = [None, "", " ", "\n", "a\n\nb", " a", "a\0b c", "a <|endoftext|> b", "it's\n'tis don't", "x\x1fy z", "a. b, c.\n.", "\n."]
    encoder = token_output.LibraryEncoder(PATH)
    encoder.tokenizer = counted = Counted(encoder.tokenizer)
    whole = sum(bool(t) and encoder.stretches(t) is None for t in texts)
    got = encoder.encode(texts, 2)
    assert counted.texts <= whole + 20 + len(texts) * 31 // token_output.RUN
    got += encoder.encode(odd + texts, 2)
    plain = lambda t: counted.tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
    assert [np.frombuffer(x, encoder.dtype).tolist() for x in got] == [plain(t) for t in texts + odd + texts]


def test_library_is_asked_once_for_a_word_with_different_marks_behind(monkeypatch):
    class Counted:
        def __init__(self, tokenizer):
            self.tokenizer, self.chars = tokenizer, 0

        def encode_batch_fast(self, texts, **options):
            self.chars += sum(map(len, texts))
            return self.tokenizer.encode_batch_fast(texts, **options)

    rng = random.Random(9)
    words = ["".join(rng.choice("abcñß") for _ in range(12)) for _ in range(40)]
    marks = ["".join(rng.choice("!,.%*'1") for _ in range(4)) for _ in range(40)]
    texts = [" ".join(w + m for w in words) for m in marks]
    encoder = token_output.LibraryEncoder(PATH)
    plain = lambda t: encoder.tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
    expected = [plain(t) for t in texts]
    encoder.tokenizer = counted = Counted(encoder.tokenizer)
    got = encoder.encode(texts, 2)
    assert [np.frombuffer(x, encoder.dtype).tolist() for x in got] == expected
    assert counted.chars < 4 * sum(map(len, words + marks))     # not 40 times, for each pair of word and marks

    encoder.tokenizer = counted.tokenizer
    odd = ["", None, "×a÷b ×", "Ǆ! ǆ? ȡ. Ж, µ1 ªb", "don't 's 'll we'Re l'été's", "a\u200bb c\u180e d\x7fe", "a\u2003b c", "a  b", "1a2b3 4\n5\na", "Ġa Ġ Ċ"]
    odd += ["".join(rng.choice("aZñ×÷ÿß'sl1.,!-Ж日\u0301\u00a0 \n") for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    odd += [" ".join("".join(rng.choice("aZñ×÷ÿß'stl1.,!-Ж日\u0301") for _ in range(rng.randint(1, 9))) for _ in range(20)) for _ in range(500)]
    monkeypatch.setattr(token_output, "REMEMBERED", 300)
    monkeypatch.setattr(token_output, "SLICE_BYTES", 1000)
    for _ in range(2):
        assert [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(odd, 2)] == [plain(t) for t in odd]
    assert len(encoder.known) < 2000 and len(encoder.known) == len(encoder.sizes) and encoder.sizes.sum() == len(encoder.pool)
    end = np.array([2], encoder.dtype).tobytes()
    assert encoder.encode([], 2) == [] and encoder.encode([""], 2) == [end] and encoder.encode([None, ""], 2) == [end] * 2
    assert token_output.LibraryEncoder(PATH).encode(["", None], 2) == [end] * 2


def test_token_files_of_odd_rows(spark, tmp_path):
    rows = token_output.report(documents(spark, ODD), PATH, str(tmp_path / "odd")).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [None, 0, 1, 2, 3, 4, 4]
    assert [r["start"] for r in rows] == np.concatenate([[0], np.cumsum([r["n_tokens"] for r in rows])[:-1]]).tolist()
    assert token_output.report(documents(spark, ODD).limit(0), PATH, str(tmp_path / "none")).count() == 0


def test_vectors_that_take_no_part_do_not_decide_the_length(spark):
    rows = [(k, [0.0, 0.0]) for k in range(1, 6)] + [(100, [1.0, 2.0, 3.0]), (101, [1.0, 2.0, 4.0]), (102, [5.0, 2.0, 3.0])]
    got = [tuple(r) for r in ann.nearest(vectors(spark, rows)).collect()]
    assert sorted(got) == [(100, 1, 101, 1.0), (100, 2, 102, 4.0)]


def test_scoring_asks_for_one_class_and_gets_the_same_number():
    rng = np.random.default_rng(3)
    weights, bias = rng.normal(size=(64, lm.CLASSES)).astype(np.float32), rng.normal(size=lm.CLASSES).astype(np.float32)
    buckets, klass = rng.integers(0, 64, (4, 500)), rng.integers(0, lm.CLASSES, 500)
    whole = lm.log_softmax(weights, bias, buckets)
    assert np.array_equal(lm.log_softmax(weights, bias, buckets, klass), whole[np.arange(500), klass])
