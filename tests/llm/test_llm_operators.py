"""The operators against brute force, exact round trips and held-out rows, over awkward tables."""

import base64
import hashlib
import itertools
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import sentencepiece
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import bpe, decontam, fingerprints, lattice_lm, neardup, preference, quality, sharding, substrings, token_files
from tidemark.llm import words as W
from tidemark.llm.components import components
from tidemark.session import scratch_dir

RANKS, JSON, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model"))
LIBRARY = Tokenizer.from_file(JSON)
SF = "/root/testdata/sf0.001"


def split(text, lower=False):
    if lower:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def pairs(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


def of(df):
    return {r["doc_id"]: r.asDict() for r in df.collect()}


# --- words ---

@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB é\t\n\x0b日.", max_size=30)), max_size=6))
@settings(max_examples=200, deadline=None)
def test_words_of_a_batch(column):
    found = W.Words(pa.array(column, pa.string()), lower=True)
    assert [w.decode() for w in found.array().to_pylist()] == [w for t in column for w in split(t, True)]
    assert found.counts.tolist() == [len(split(t)) for t in column]
    assert len({(w, h) for w, h in zip(found.array().to_pylist(), found.hashes().tolist(), strict=True)}) == len(set(found.array().to_pylist()))


# --- sharding ---

def test_shards_and_slots(docs):
    got = sharding.shard_documents(docs, 5).collect()
    texts = dict(pairs(docs))
    for r in got:
        bid = [-1 / math.log((int(hashlib.md5(f"{r['doc_id']}:{s}".encode()).hexdigest()[:13], 16) + 0.5) / 16**13) for s in range(6)]
        assert r["shard"] == max(range(5), key=lambda s: bid[s])
        assert r["grown_shard"] in (r["shard"], 5) and r["grown_shard"] == max(range(6), key=lambda s: bid[s])
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
    for s in range(5):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))


def test_shards_follow_weights(spark):
    many = spark.range(20_000).selectExpr("id as doc_id")
    shares = Counter(r["shard"] for r in sharding.shard(many, "doc_id", {0: 1, 1: 3, 2: 0}).collect())
    assert set(shares) == {0, 1} and 0.73 < shares[1] / 20_000 < 0.77
    with pytest.raises(ValueError):
        sharding.rendezvous(None, {0: 0})


def test_shards_of_odd_rows(odd, empty):
    assert sharding.shard_documents(empty).count() == 0
    got = sharding.shard_documents(odd, 1).collect()
    assert sorted(r["slot"] for r in got) == [0, 1, 2, 3, 4]


# --- decontamination ---

def test_masks_survive_two_substitutions():
    for gone in itertools.combinations(range(decontam.LEAST), 2):
        assert any(all(s + o not in gone for o in m) for m in decontam.MASKS for s in range(decontam.LEAST - m[-1]))


@pytest.fixture
def items(spark):
    other = [" ".join(f"q{k}x{i}" for i in range(n)) for k, n in enumerate((30, 13, 5, 20))]
    return spark.createDataFrame([*enumerate(other), (9, None), (10, ""), (None, "nothing"), (0, other[0])], "item_id long, text string")


def test_leaks(spark, items, docs):
    item = {r["item_id"]: r["text"] for r in items.collect() if r["text"]}
    swapped = item[0].split()
    swapped[3], swapped[9], swapped[15] = "other", "other", "other"
    planted = [
        (100_000, "before " + item[0].upper().replace(" ", ", ") + " after"), (100_001, "x y " + " ".join(swapped)), (100_002, " ".join(item[0].split()[8:21])),
        (100_003, " ".join(item[0].split()[8:18]) + " end"), (100_004, "so " + item[2] + " it is"), (100_005, " ".join(item[2].split()[:3]) + " and no more"),
        (100_006, item[3] + " " + item[1]), (100_007, " ".join(w for x in item[3].split() for w in (x, "gap"))), (None, item[0])]
    rows = spark.createDataFrame([(i, t, *[None] * 14) for i, t in planted], docs.schema).unionByName(docs)
    got = {(r["doc_id"], r["item_id"]): r for r in decontam.leaks(rows, items).collect()}
    assert set(got) == {(100_000, 0), (100_001, 0), (100_002, 0), (100_004, 2), (100_006, 3), (100_006, 1)}
    r = got[100_001, 0]
    assert (r["doc_start"], r["item_start"], r["n_words"], r["n_equal"]) == (2, 0, 30, 27)
    kept = decontam.without_leaks(rows, items)
    assert kept.columns == rows.columns and kept.count() == docs.count() + 4
    assert decontam.leaks(docs.limit(0), items).count() == 0 and decontam.leaks(docs, items.limit(0)).count() == 0


@given(st.lists(st.integers(0, 3), max_size=12), st.lists(st.integers(0, 3), max_size=12), st.integers(-6, 12))
@settings(max_examples=300, deadline=None)
def test_overlap_is_the_best_stretch(doc, item, shift):
    first, length, equal = decontam.overlap(np.array(doc, int), np.array(item, int), shift)
    best = 0
    for a, b in itertools.combinations(range(len(item) + 1), 2):
        if all(0 <= shift + i < len(doc) for i in range(a, b)):
            same = sum(doc[shift + i] == item[i] for i in range(a, b))
            best = max(best, 3 * same - 2 * (b - a))
    assert 3 * equal - 2 * length == best or best <= 0


def best_passage(doc, item, shift):
    """(equal, -length) by the law as it is written, over all stretches; None if none counts."""
    same = [0 <= shift + k < len(doc) and doc[shift + k] == x for k, x in enumerate(item)]
    enough, found = min(13, -(-4 * len(item) // 5)), []
    for a, b in itertools.combinations(range(len(item) + 1), 2):
        equal = sum(same[a:b])
        if equal >= enough and 5 * equal >= 4 * (b - a) and 0 <= shift + a and shift + b <= len(doc):
            found.append((equal, a - b))
    return max(found, default=None)


@given(st.integers(1, 60), st.integers(-3, 3), st.integers(15, 30), st.randoms(use_true_random=False))
@settings(max_examples=200, deadline=None)
def test_passage_is_the_best_by_the_law(n, shift, percent, rng):
    item = list(range(n))
    doc = [-1 if rng.randrange(100) < percent else k - shift for k in range(n)]
    first, length, equal = decontam.passage(np.array(doc), np.array(item), shift, min(13, -(-4 * n // 5)))
    assert best_passage(doc, item, shift) == ((equal, -length) if equal else None)
    assert equal == sum(0 <= shift + k < n and doc[shift + k] == k for k in range(first, first + length))


def test_leaks_beside_loose_edits(spark):
    rng = random.Random(11)
    item, docs = [f"q{i}" for i in range(59)], {}
    docs[0] = ["other" if k > 16 and (k - 17) % 7 in (0, 3) else w for k, w in enumerate(item)]
    for d in range(1, 150):
        docs[d] = ["other" if rng.random() < 0.15 + 0.001 * d else w for w in item]
    want = {d: best for d, w in docs.items() if (best := best_passage(w, item, 0))}
    table = spark.createDataFrame([(d, " ".join(w)) for d, w in docs.items()], "doc_id long, text string")
    got = decontam.leaks(table, spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")).collect()
    assert 0 in want and {r["doc_id"]: (r["n_equal"], -r["n_words"]) for r in got} == want and len(want) < len(docs)


def test_masks_miss_no_passage():
    for n in range(1, decontam.SHORT + 1):
        for gone in itertools.combinations(range(n), n - min(13, -(-4 * n // 5))):
            assert any(all(s + o not in gone for o in m) for m in (*decontam.MASKS, *decontam.gaps(n)) for s in range(n - m[-1]))
    # Most spare words (equal - 4 * other) of all stretches without a whole window, by their last 8 words and equal ones.
    best = {((), 0): 0}
    for n in range(1, 60):
        then = {}
        for ((last, equal), spare), same in itertools.product(best.items(), (0, 1)):
            w = (*last, same)
            if not any(len(w) > m[-1] and all(w[len(w) - 1 - m[-1] + o] for o in m) for m in decontam.MASKS):
                key = (w[-8:], min(13, equal + same))
                then[key] = max(then.get(key, -1000), spare + (1 if same else -4))
        best = then
        assert all(spare < 0 for (_, equal), spare in best.items() if equal == 13)


def test_leaks_of_short_items(spark):
    docs, items = [], {n: [f"q{n}x{k}" for k in range(n)] for n in range(3, 17)}
    for n, item in items.items():
        for gone in itertools.combinations(range(n), n - min(13, -(-4 * n // 5))):
            docs.append((" ".join(["so", *("other" if k in gone else w for k, w in enumerate(item)), "it", "is"]), n))
    table = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(docs)], "doc_id long, text string")
    got = decontam.leaks(table, spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(i, n) for i, (_, n) in enumerate(docs)}
    fewer = [(n, " ".join(w[: min(13, -(-4 * n // 5)) - 1])) for n, w in items.items()]
    assert decontam.leaks(spark.createDataFrame(fewer, "doc_id long, text string"), spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id long, text string")).count() == 0


def test_short_items_drop_no_clean_documents(spark):
    items = spark.createDataFrame([(1, "yes"), (2, "The"), (3, "of the end"), (4, "one two three four"), (5, "a b c d e")], "item_id long, text string")
    texts = ["yes the end of the end", "the", " Of the END! ", "the the", "one two three four five", "one, two three four", "x a b c d e y", "end the of", "yes yes", "x a b c"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"] for r in decontam.without_leaks(docs, items).collect()} == {0, 3, 4, 7, 8, 9}
    reported = {(r["doc_id"], r["item_id"]) for r in decontam.leaks(docs, items).collect()}
    assert reported == {(0, 1), (0, 2), (0, 3), (1, 2), (2, 2), (2, 3), (3, 2), (4, 4), (5, 4), (6, 5), (7, 2), (8, 1)}


# --- substring dedup ---

def removal(rows, n):
    first, want = {}, {}
    ordered = sorted(((d, split(t)) for d, t in rows), key=lambda x: x[0])
    for d, w in ordered:
        for i in range(len(w) - n + 1):
            first.setdefault(tuple(w[i : i + n]), d)
    for d, w in ordered:
        gone = [False] * len(w)
        for i in range(len(w) - n + 1):
            if first[tuple(w[i : i + n])] < d:
                gone[i : i + n] = [True] * n
        want[d] = [g for g in gone], w
    return want


@given(st.lists(st.lists(st.integers(0, 2), max_size=40), max_size=4), st.integers(2, 14))
@settings(max_examples=300, deadline=None)
def test_equal_windows_have_equal_anchors(texts, window):
    hashes = W.mix(np.array([x for t in texts for x in t], np.uint64) + np.uint64(99))
    names = substrings.anchors(hashes, np.repeat(np.arange(len(texts)), [len(t) for t in texts]), window)
    windows = [tuple(t[i : i + window]) for t in texts for i in range(len(t) - window + 1)]
    assert len(names) == len(windows) and len(set(zip(windows, names.tolist(), strict=True))) == len(set(windows))


def test_most_windows_are_named_by_symbols():
    names = substrings.anchors(W.mix(np.arange(5000, dtype=np.uint64)), np.zeros(5000, np.int64), 13)
    assert (names >> np.uint64(62) == 3).mean() < 0.02 and len(set(names.tolist())) < 2500


@pytest.mark.parametrize("window", [3, 13])
def test_repeats_are_removed(docs, window):
    got = of(substrings.removal_digests(docs, window))
    for d, (gone, w) in removal(pairs(docs), window).items():
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        assert (got[d]["n_words"], got[d]["n_removed"], got[d]["kept_sha256"]) == (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()), d


def test_cut_keeps_the_rest(docs, empty, odd):
    got, want = of(substrings.cut(docs, 13)), removal(pairs(docs), 13)
    for d, text in pairs(docs):
        gone, w = want[d]
        assert split(got[d]["text"]) == [x for x, g in zip(w, gone, strict=True) if not g]
        assert got[d]["n_chars"] == (None if text is None else len(got[d]["text"])) and got[d]["spans"] == "clash"
        if not any(gone):
            assert got[d]["text"] == text
    assert substrings.cut(empty, 13).count() == 0 and substrings.removal_digests(empty).count() == 0
    assert sorted(str(r["text"]) for r in substrings.cut(odd, 3).collect()) == sorted(str(r["text"]) for r in odd.collect())


def test_one_id_at_different_texts(spark):
    """Two texts under one doc_id share no places, and no name of a user's column is taken."""
    long, tail = " ".join(f"w{i}" for i in range(60)), " ".join(f"t{i}" for i in range(40))
    table = [(1, long), (2, tail + " " + long), (2, "short text here"), (3, "tail"), (3, long + " " + tail), (3, long + " " + tail), (None, long)]
    for order in (table, table[::-1]):
        got = substrings.removal_digests(spark.createDataFrame(order, "doc_id long, text string"), 13).collect()
        assert len(got) == len(table) and all(r["n_removed"] <= r["n_words"] for r in got)
        assert {r["n_removed"] for r in got if r["doc_id"] in (1, None)} == {0}
        removed = sorted((r["doc_id"], r["n_words"], r["n_removed"]) for r in got if r["doc_id"] in (2, 3))
        assert removed.count((2, 3, 0)) == 1 and (2, 100, 60) in removed or (2, 100, 0) in removed
    clash = spark.createDataFrame([(1, long, "a", "b", "c"), (2, long, "d", "e", "f")], "doc_id long, text string, __of string, __spans string, keep string")
    kept = {r["doc_id"]: r for r in substrings.cut(clash, 13).collect()}
    assert kept[2]["text"] == "" and kept[1]["text"] == long and (kept[2]["__of"], kept[2]["__spans"], kept[2]["keep"]) == ("d", "e", "f")


# --- quality ---

def test_trees_flattened_and_walked():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 6))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    trees = quality.fit(x[:400], y[:400], trees=30, depth=3)
    for row, got in zip(x[:40], trees.score(x[:40]), strict=True):
        total = trees.bias
        for f, c, leaf in zip(trees.feature, trees.cut, trees.leaf, strict=True):
            at = 0
            while at < len(f):
                at = 2 * at + (2 if row[f[at]] > c[at] else 1)
            total += leaf[at - len(f)]
        assert math.isclose(got, 1 / (1 + math.exp(-total)))
    assert ((trees.score(x[400:]) > 0.5) == y[400:]).mean() > 0.9
    assert len(quality.fit(x, np.ones(500)).leaf) == 0 and 0 < quality.fit(x[:0], y[:0]).score(x[:1])[0] < 1


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = of(quality.score_documents(spark.read.parquet(f"{sf}/documents.parquet"), labels))
    held = [(got[r["doc_id"]]["predicted"], r["quality"]) for r in labels.collect() if got[r["doc_id"]]["held_out"]]
    assert len(held) > 40 and np.mean([p == q for p, q in held]) > 0.93
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())


def test_quality_of_awkward_tables(spark, docs, empty, odd):
    labels = spark.createDataFrame([(1, 1, 0), (8, 0, 0), (8, None, 0), (None, 1, 1), (15, 1, None), (22, 0, 0), (29, 1, 0), (10**9, 0, 0)], "doc_id long, quality long, toxic long")
    rows = quality.score_documents(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert quality.score_documents(empty, labels).count() == 0 and quality.score_documents(odd, labels.limit(0)).count() == 5
    kept = quality.accepted(docs, labels)
    assert kept.columns == docs.columns and set(kept.select("score").distinct().collect()) == {("clash",)}


# --- language model ---

def test_lattice_sums_all_segmentations():
    vocabulary = lattice_lm.pieces(PIECES)
    score = dict(zip(vocabulary.texts, np.exp(vocabulary.first), strict=True))

    def brute(raw):
        return 1.0 if not raw else sum(score[raw[:k]] * brute(raw[k:]) for k in range(1, len(raw) + 1) if raw[:k] in score)

    names = ["the", "ing", "a", "é", "日", "xq", "there"]
    raw = [n.encode() for n in names]
    got = lattice_lm.word_log_probability(vocabulary, vocabulary.first, np.frombuffer(b"".join(raw), np.uint8), np.array([len(r) for r in raw]))
    for r, g in zip(raw, got, strict=True):
        assert math.isclose(math.log(brute(b" " + r)), g, rel_tol=1e-9)
    assert math.isclose(lattice_lm.expected(vocabulary, vocabulary.first, np.frombuffer(b"the", np.uint8), np.array([3])) @ [len(t) for t in vocabulary.texts], 4)
    assert len(vocabulary.texts) > 31_000 and sentencepiece is not None


def test_long_words_as_short_ones(monkeypatch):
    vocabulary = lattice_lm.pieces(PIECES)
    rng = random.Random(3)
    raw = ["".join(rng.choice("abcxyzÉ日t") for _ in range(rng.randrange(1, 300))).encode() for _ in range(20)] + [b"a" * 400]
    data, lengths = np.frombuffer(b"".join(raw), np.uint8), np.array([len(r) for r in raw])
    monkeypatch.setattr(lattice_lm, "_LONG", 10**9)
    p, e = lattice_lm.word_log_probability(vocabulary, vocabulary.first, data, lengths), lattice_lm.expected(vocabulary, vocabulary.first, data, lengths)
    monkeypatch.setattr(lattice_lm, "_LONG", 5)
    monkeypatch.setattr(lattice_lm, "_STRETCH", 64)
    assert np.allclose(lattice_lm.word_log_probability(vocabulary, vocabulary.first, data, lengths), p, rtol=1e-9)
    assert np.allclose(lattice_lm.expected(vocabulary, vocabulary.first, data, lengths), e, rtol=1e-6, atol=1e-9)


def test_a_word_of_20000_bytes_is_quick():
    vocabulary, data = lattice_lm.pieces(PIECES), np.frombuffer(random.Random(1).randbytes(20_000).hex()[:20_000].encode(), np.uint8)
    began = time.process_time()
    assert -1e6 < lattice_lm.word_log_probability(vocabulary, vocabulary.first, data, np.array([20_000]))[0] < -1e4
    assert time.process_time() - began < 5


def test_words_of_many_lengths_are_quick_and_blocks_change_nothing(monkeypatch):
    vocabulary, rng = lattice_lm.pieces(PIECES), random.Random(4)
    lengths = np.array([*range(400), 0, 3, 3, 7])
    data = np.frombuffer("".join(rng.choice("etaoin s.\0") for _ in range(lengths.sum())).encode(), np.uint8)
    began = time.process_time()
    p, e = lattice_lm.word_log_probability(vocabulary, vocabulary.first, data, lengths), lattice_lm.expected(vocabulary, vocabulary.first, data, lengths)
    assert time.process_time() - began < 5
    assert math.isclose(e @ [len(t) for t in vocabulary.texts], lengths.sum() + len(lengths), rel_tol=1e-9)
    monkeypatch.setattr(lattice_lm, "_CELLS", 300)
    assert np.allclose(lattice_lm.word_log_probability(vocabulary, vocabulary.first, data, lengths), p, rtol=1e-12)
    assert np.allclose(lattice_lm.expected(vocabulary, vocabulary.first, data, lengths), e, rtol=1e-9, atol=1e-12)
    # A piece is expected as often as the logarithm of the words' probability grows with its score.
    for i in np.argsort(e)[-5:]:
        more = vocabulary.first.copy()
        more[i] += 1e-5
        grown = lattice_lm.word_log_probability(vocabulary, more, data, lengths).sum() - p.sum()
        assert math.isclose(grown / 1e-5, e[i], rel_tol=1e-3)


@pytest.mark.parametrize("hot", [0, 5, 1 << 18])
def test_lm_scores(docs, hot):
    rows = pairs(docs)
    tokens = {d: [*split(t, True), None] for d, t in rows}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in tokens}
    c = Counter(x for d, w in tokens.items() if not held[d] for x in w)
    n, v = sum(c.values()), len(c)
    got = of(lattice_lm.score_documents(docs, PIECES, hot))
    assert len(got) == len(rows)
    for d, w in tokens.items():
        r = got[d]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[d], len(w), sum(c[x] > 0 for x in w), n)
        assert math.isclose(r["base_score"], sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), rel_tol=1e-9)
        assert -1e9 < r["score"] < 0
    # The score by the model's law, with each word's lattice summed over all segmentations one by one.
    train = docs.where(F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)), F.lit(-1)) != 2)
    model, _ = lattice_lm.learn(train, PIECES)
    weight = dict(zip(lattice_lm.pieces(PIECES).texts, np.exp(model.score).tolist(), strict=True))
    own = Counter(x for d, w in tokens.items() if not held[d] for x in w if x is not None)
    once, twice = (sum(k == j for k in own.values()) for j in (1, 2))
    off = min(0.95, max(0.05, once / (once + 2 * twice)))
    assert (model.words, model.types, model.discount) == (sum(own.values()), len(own), off)
    documents = sum(not h for h in held.values())

    def lattice(raw):
        ways = [1.0] + [0.0] * len(raw)
        for e in range(1, len(raw) + 1):
            ways[e] = sum(ways[b] * weight.get(raw[b:e], 0.0) for b in range(max(0, e - 60), e))
        return ways[-1]

    def law(x):
        whole = model.words + documents + 2
        if x is None:
            return (documents + 1) / whole
        return (max(own[x] - off, 0) + off * len(own) * lattice(b" " + x.encode())) / model.words * (model.words + 1) / whole

    for d, w in tokens.items():
        if len(w) < 500 and max(len(x or "") for x in w) < 60:
            assert math.isclose(got[d]["score"], sum(math.log10(law(x)) for x in w), rel_tol=1e-6), d


def test_lm_probabilities_of_words_sum_to_less_than_one(docs):
    model, counts = lattice_lm.learn(docs, PIECES)
    rows = counts.collect()
    raw = [bytes(r["word"]) for r in rows]
    p = 10 ** model.log10(np.frombuffer(b"".join(raw), np.uint8), np.array([len(r) for r in raw]), np.array([float(r["n"]) for r in rows]))
    assert 0.2 < p.sum() + 10 ** model.end() <= 1


def test_lm_of_awkward_tables(empty, odd):
    assert lattice_lm.score_documents(empty, PIECES).count() == 0
    assert {(r["doc_id"], r["n_tokens"]) for r in lattice_lm.score_documents(odd, PIECES).collect()} == {(None, 8), (5, 15)}


# --- byte-level BPE ---

@pytest.fixture(scope="module")
def coder():
    return bpe.ByteBPE(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_bpe_as_the_library(coder, library, text):
    ids = coder.encode([text])[0]
    assert ids == library.encode_ordinary(text) and coder.decode(ids) == text.encode()


def test_perfect_hash(coder):
    keys = [f"k{i}".encode() for i in range(3000)] + [b""]
    table = bpe.PerfectHash(keys)
    assert table.find(np.frombuffer(b"".join(keys), np.uint8), np.array([len(k) for k in keys])).tolist() == list(range(3001))
    assert sorted(table.index.tolist()) == list(range(3001))
    other = [f"x{i}".encode() for i in range(3000)]
    assert set(table.find(np.frombuffer(b"".join(other), np.uint8), np.array([len(k) for k in other])).tolist()) == {-1}


def test_bpe_of_a_table(docs, empty, odd, library):
    got, plain = of(bpe.encode_digests(docs, RANKS, public_tokenizers.PATTERN)), of(bpe.encode(docs, RANKS, public_tokenizers.PATTERN))
    for d, text in pairs(docs):
        ids = library.encode_ordinary(text or "")
        assert plain[d]["ids"] == ids and plain[d]["key"] == "clash"
        assert got[d]["n_tokens"] == len(ids) and got[d]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[d]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe.encode_digests(empty, RANKS, public_tokenizers.PATTERN).count() == 0
    assert bpe.encode_digests(odd, RANKS, public_tokenizers.PATTERN).count() == 5


# --- fingerprints ---

def fives(text):
    w = split(text)
    return set(zip(*[w[i:] for i in range(5)], strict=False)) if len(w) >= 5 else {tuple(w)} if w else set()


def likeness(a, b):
    a, b = fives(a), fives(b)
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("blocks", [1, 7, 60])
def test_fingerprints(docs, blocks):
    got, rows = of(fingerprints.compare_with_edits(docs, blocks)), sorted(pairs(docs))
    by_text = {}
    for i, (d, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        k = len(text) // 4
        edit = text[: len(text) - k] + after[:k]
        r = got[d]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edit.encode()).hexdigest())
        assert abs(r["near_edited"] - likeness(text, edit)) < 0.15 and abs(r["near_next"] - likeness(text, after)) < 0.15
        assert by_text.setdefault(text, r["fingerprint"]) == r["fingerprint"] and len(r["fingerprint"]) == (512 if split(text) else 0)
        if text == edit:
            assert r["near_edited"] == 1.0


def test_fingerprints_of_awkward_tables(spark, empty, odd):
    assert fingerprints.compare_with_edits(empty).count() == 0 and fingerprints.compare_with_edits(odd).count() == 5
    one = spark.createDataFrame([(3, "a b c d e f g h")], "doc_id long, text string")
    assert [r["near_next"] for r in fingerprints.compare_with_edits(one).collect()] == [1.0]


# --- near duplicates ---

def groups(rows, width, share):
    def shingles(t):
        w = split(t, True)
        return frozenset(zip(*[w[i:] for i in range(width)], strict=False)) if len(w) >= width else frozenset([tuple(w)]) if w else frozenset()

    sets, root = {d: shingles(t) for d, t in rows}, {d: d for d, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= share * len(x | y):
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    return {d: (len(sets[d]), find(d)) for d in sets}


@pytest.mark.parametrize(("width", "share", "block"), [(3, 85, 1 << 19), (5, 80, 1 << 19), (3, 85, 300)])
def test_near_duplicates(docs, width, share, block):
    got = of(neardup.near_duplicates(docs, width, share, block_shingles=block))
    assert {d: (r["n_shingles"], r["component_id"]) for d, r in got.items()} == groups(pairs(docs), width, share)
    assert all(r["kept"] == (r["component_id"] == d) for d, r in got.items())


def test_near_duplicates_of_awkward_tables(empty, odd, docs):
    assert neardup.near_duplicates(empty).count() == 0
    assert Counter(r["n_shingles"] for r in neardup.near_duplicates(odd).collect()) == {2: 2, 0: 1}
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {d for d, (_, c) in groups(pairs(docs), 5, 80).items() if c == d}


def test_joint_estimate_is_unbiased():
    rng, sketch = np.random.default_rng(4), neardup.Sketch()
    for shared, one, two in ((800, 100, 100), (300, 500, 100), (50, 400, 400)):
        found = []
        for _ in range(20):
            pool = rng.integers(0, 1 << 63, shared + one + two, np.uint64)
            sets = [np.concatenate([pool[:shared], pool[shared : shared + one]]), np.concatenate([pool[:shared], pool[shared + one :]])]
            sizes = np.array([len(s) for s in sets])
            a, b = neardup.registers(W.mix(np.concatenate(sets)), sizes, sketch)
            equal, more = (a == b).sum(), (a > b).sum()
            found.append(neardup.similarity(np.array([equal]), np.array([more]), np.array([len(a) - equal - more]), *(np.array([float(s)]) for s in sizes), sketch.base)[0])
        assert abs(np.mean(found) - shared / (shared + one + two)) < 0.03


@given(st.lists(st.tuples(st.integers(0, 14), st.integers(0, 14)), min_size=1, max_size=14))
@settings(max_examples=3, deadline=None)
def test_components(spark, edges):
    root = {x: x for e in edges for x in e}
    for _ in range(20):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    touched = {x for a, b in edges if a != b for x in (a, b)}
    got = components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert {r["node"]: r["component"] for r in got} == {x: root[x] for x in touched} and len(got) == len(touched)


# --- token files ---

@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("ab'stmdrevl  \n\t\u00a0\u3000é日1²!?\x1c\x85"), st.characters(codec="utf-8")), max_size=30), max_size=5))
@settings(max_examples=500, deadline=None)
def test_pre_tokens_as_the_pattern(texts):
    data, lengths, counts = token_files.pre_tokens(pa.array(texts, pa.string()))
    raw, ends = data.tobytes(), np.cumsum(lengths).tolist()
    got = [raw[e - n : e].decode() for e, n in zip(ends, lengths.tolist(), strict=True)]
    want = [regex.findall(public_tokenizers.PATTERN, t) for t in texts]
    assert got == [x for w in want for x in w] and counts.tolist() == [len(w) for w in want]


@given(st.lists(st.one_of(st.integers(0, 2**32 - 1), st.integers(0, 300)), max_size=40))
@settings(max_examples=200, deadline=None)
def test_code_round_trip(values):
    control, data = token_files.pack(np.array(values, np.uint32))
    assert token_files.unpack(control, data, len(values)).tolist() == values
    assert len(control) == -(-len(values) // 4) and len(data) == sum(max(1, -(-v.bit_length() // 8)) for v in values)


def test_token_files(spark, docs):
    path = scratch_dir(spark, "test-token-files")
    token_files.write(docs, path, JSON)
    library = Tokenizer.from_file(JSON)
    library.encode_special_tokens = True
    got, at = of(token_files.read(spark, path)), 0
    for d, text in sorted(pairs(docs)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        r = got[d]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_added_tokens_as_the_library(spark):
    mark = "<|endoftext|>"
    texts = [f"end {mark} start", mark, mark * 3, f" {mark}\n\n{mark}it's", None, "", f"plain {mark[:-1]} text", f"a{mark}", f"{mark}'s b", "é 日 " + mark + " \t", "none"]
    assert LIBRARY.encode(texts[0], add_special_tokens=False).ids == [437, 220, 50256, 923]
    path, at = scratch_dir(spark, "test-token-files"), 0
    token_files.write(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path, JSON)
    got = of(token_files.read(spark, path))
    for d, text in enumerate(texts):
        ids = [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 2]
        assert (got[d]["start"], got[d]["n_tokens"], got[d]["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


@given(st.lists(st.lists(st.sampled_from(["<|endoftext|>", "<|endoftext|", "|>", " ", "  ", "\n", "it's", "end", "é"]), max_size=8).map("".join), max_size=5))
@settings(max_examples=200, deadline=None)
def test_encoder_as_the_library(texts):
    flat, counts = token_files.encoder(JSON).encode(pa.array(texts, pa.string()))
    want = [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]
    assert flat.tolist() == [i for w in want for i in w] and counts.tolist() == [len(w) for w in want]


def test_token_files_of_awkward_tables(spark, empty, odd):
    for table, n in ((empty, 0), (odd, 5)):
        path = scratch_dir(spark, "test-token-files")
        token_files.write(table, path, JSON)
        assert token_files.read(spark, path).count() == n


# --- preference formatting ---

def test_preferences(spark):
    rng = random.Random(5)
    turns, convs = [], {}
    for c in [3, 9, 4, 100, 7]:
        convs[c] = [("user" if k % 2 == 0 else "assistant", f"text {rng.randrange(3)}") for k in range(rng.randrange(1, 6))]
        turns += [(c, k, role, text, "clash") for k, (role, text) in enumerate(convs[c])]
    rng.shuffle(turns)
    got = {r["conv_id"]: r for r in preference.preferences(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, opening string")).collect()}
    order = sorted(convs)
    show = lambda ts: "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in ts)
    marks = lambda ts: ",".join(f"{len(r) + 13}:0,{len(t) + 11}:{int(r == 'assistant')}" for r, t in ts)
    for i, c in enumerate(order):
        chosen = convs[c]
        reply = next((t for r, t in reversed(convs[order[(i + 1) % len(order)]]) if r == "assistant"), "")
        at = max((k for k, (r, _) in enumerate(chosen) if r == "assistant"), default=len(chosen))
        rejected = [*chosen[:at], ("assistant", reply), *chosen[at + 1 :]]
        n = next((k for k, (x, y) in enumerate(zip(chosen, rejected, strict=False)) if x != y), min(len(chosen), len(rejected)))
        want = (n, show(chosen[:n]), show(chosen[n:]), marks(chosen[n:]), show(rejected[n:]), marks(rejected[n:]))
        assert tuple(got[c][k] for k in ("n_common", "prompt", "chosen", "chosen_mask", "rejected", "rejected_mask")) == want


def test_preferences_of_awkward_tables(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert preference.preferences(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, None, None, None), (1, 0, "user", None), (1, 0, "user", None), (2, None, "assistant", "x" * 100_000), (2, 1, None, "b")]
    got = {r["conv_id"]: r for r in preference.preferences(spark.createDataFrame(rows, schema)).collect()}
    assert set(got) == {None, 1, 2} and got[1]["n_common"] == 2 and got[1]["chosen"] == ""
