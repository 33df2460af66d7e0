"""SentencePiece encoding, lexical search and the Merkle manifest against the library and brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.llm import lexical, merkle, pieces, ranks, token_files

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)


# --- SentencePiece ---

@pytest.fixture(scope="module")
def coder():
    return pieces.PieceBPE(MODEL)


def each(coder, texts):
    flat, counts = coder.encode(pa.array(texts, pa.string()))
    ends = np.cumsum(counts)
    return [flat[e - c : e].tolist() for e, c in zip(ends, counts, strict=True)], coder.decode(flat, counts)


TEXT = st.one_of(st.text(max_size=40), st.text(alphabet=" ▁\n\t\r<0x41>/s;)}the日😀é\x00", max_size=60), st.text(alphabet=" ab", max_size=60))


@given(st.lists(TEXT, max_size=6))
@settings(max_examples=300, deadline=None)
def test_pieces_as_the_library(texts):
    coder = pieces.coder(MODEL)
    ids, shown = each(coder, texts)
    assert ids == [LIBRARY.encode(t) for t in texts] and shown == [LIBRARY.decode(i) for i in ids]


@given(st.lists(st.one_of(st.integers(0, 31_999), st.integers(0, 300)), max_size=12))
@settings(max_examples=300, deadline=None)
def test_any_ids_decode_as_the_library(ids):
    got = pieces.coder(MODEL).decode(np.array(ids, np.int32), np.array([len(ids)]))
    assert got == [LIBRARY.decode(ids)]


def test_long_words_and_runs(coder):
    rng = random.Random(1)
    noise = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEF0123456789+/") for _ in range(60_000))
    texts = [noise, "a" * 30_000, " " * 5_000 + "x", "日本語の文章" * 3_000, "\n" * 999, None, ""]
    assert each(coder, texts)[0] == [LIBRARY.encode(t or "") for t in texts]


def test_failed_places_are_left_for_good(coder):
    """Texts whose longest first token is wrong: the encoder goes back and still meets the merges."""
    rng = random.Random(2)
    back = 0
    vocabulary = sorted(coder.tokens, key=len)[-4000:]
    for _ in range(400):
        text = "".join(rng.choice(vocabulary)[: rng.randrange(2, 9)] for _ in range(3)).replace(" ", "▁")
        got = coder.split(text)
        assert got == coder.merge(text) and "".join(got) == text
        back += got[0] != max((t for t in coder.tokens if text.startswith(t)), key=len, default=text[0])
    assert back > 20


def test_pieces_of_a_table(docs, empty, odd):
    got = {r["doc_id"]: r for r in pieces.encode_digests(docs, MODEL).collect()}
    for r in docs.collect():
        ids = LIBRARY.encode(r["text"] or "")
        assert got[r["doc_id"]]["n_tokens"] == len(ids)
        assert got[r["doc_id"]]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[r["doc_id"]]["decoded_sha256"] == hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()
    back = pieces.decode(pieces.encode(docs, MODEL), MODEL)
    for r in back.collect():
        assert r["ids"] == LIBRARY.encode(r["text"] or "") and r["decoded"] == LIBRARY.decode(r["ids"]) and r["key"] == "clash"
    assert pieces.encode_digests(empty, MODEL).count() == 0 and pieces.encode_digests(odd, MODEL).count() == 5
    with pytest.raises(Exception, match="Error parsing|identity"):
        pieces.PieceBPE(public_tokenizers.path("byte_bpe_50k.json"))


# --- token files: long texts and foreign files ---

def test_long_texts_are_cut_between_pre_tokens(monkeypatch):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library, coder = Tokenizer.from_file(path), token_files.Encoder(path)
    monkeypatch.setattr(token_files, "CHUNK_BYTES", 40)
    rng = random.Random(4)
    words = ["it's", "we'll", " ", "  ", "a", "1234", "É", "日本", "\n", "<|endoftext|>", "!!", "x" * 70, ". "]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(60))) for _ in range(60)] + ["", "x" * 500]
    flat, counts = coder.encode(pa.array(texts))
    ends = np.cumsum(counts)
    assert [flat[e - c : e].tolist() for e, c in zip(ends, counts, strict=True)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert any(len(token_files.parts_of(t, 40)) > 2 for t in texts)
    real = token_files.hash_pieces
    monkeypatch.setattr(token_files, "hash_pieces", lambda data, lengths, seed=1: (lengths % 3).astype(np.uint64) if seed == 1 else real(data, lengths, 2))
    flat, counts = token_files.Encoder(path).encode(pa.array(texts))  # nearly all hashes clash
    ends = np.cumsum(counts)
    assert [flat[e - c : e].tolist() for e, c in zip(ends, counts, strict=True)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    with pytest.raises(ValueError, match="byte-level"):
        token_files.Encoder(public_tokenizers.path("word_bpe_49k.json"))


# --- lexical search ---

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranked(docs, items, k):
    """{item: [(rank, doc_id, score)]} by the formula, over all documents."""
    tf = [(d, Counter(terms(t))) for d, t in docs]
    n_docs, total = sum(bool(c) for _, c in tf), sum(sum(c.values()) for _, c in tf)
    df = Counter(t for _, c in tf for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = {}
    for i, wanted in asked.items():
        scores = []
        for d, c in tf:
            m = 50 + 50 * sum(c.values()) * n_docs // max(total, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in wanted if c[t])
            if s > 0:
                scores.append((-s, d is not None, d or 0))
        if scores:
            out[i] = [(r, d if there else None, -s) for r, (s, there, d) in enumerate(sorted(scores)[:k], 1)]
    return out


def grouped(df):
    out = {}
    for r in df.orderBy("rank").collect():
        out.setdefault(r["item_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    return out


@given(st.lists(st.lists(st.tuples(st.integers(0, 29), st.integers(0, 6)), max_size=30), max_size=6), st.integers(1, 8), st.integers(1, 4))
@settings(max_examples=300, deadline=None)
def test_interval_reads_end_with_the_exact_best(lists, k, step):
    """Few distinct gains, so that ties at the last place are common."""
    total, ready = np.zeros(30, np.int64), []
    for entries in lists:
        gains = dict(entries)
        place, gain = np.array(list(gains), np.int64), np.array(list(gains.values()), np.int64)
        np.add.at(total, place, gain)
        down = np.argsort(-gain, kind="stable")
        ready.append((place[down], gain[down]))
    lexical.FIRST_READ, kept = step, lexical.FIRST_READ
    place, score = lexical.best(ready, 30, k)
    lexical.FIRST_READ = kept
    floor = max(1, sorted(total.tolist())[-k])
    assert dict(zip(place.tolist(), score.tolist(), strict=True)) == {i: t for i, t in enumerate(total.tolist()) if t >= floor}


def test_reading_stops_early():
    n = 100_000
    place, gain = np.arange(n), np.concatenate([np.arange(1000, 900, -1), np.ones(n - 100, int)])
    one, score = lexical.best([(place, gain)], n, 10)
    assert sorted(one.tolist()) == list(range(10)) and score.max() == 1000


@pytest.mark.parametrize("block, group", [(6 << 20, 256), (3_000, 2)])
def test_search(spark, docs, monkeypatch, block, group):
    monkeypatch.setattr(lexical, "BLOCK_BYTES", block)
    monkeypatch.setattr(lexical, "ITEMS", group)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    extra = [(None, rows[7][1]), (50_000, "w1 w2 w3"), (50_001, "w1 w2 w3"), (50_001, "w1 w2 w3")]
    table = docs.select("doc_id", "text", "score").unionByName(spark.createDataFrame(extra, "doc_id long, text string"), allowMissingColumns=True)
    items = [(1, "W1, w2! w3"), (2, (rows[8][1] or "")[:300]), (3, "nothing like this"), (4, None), (5, ""), (None, "w5 Straße w7"), (6, "w9"), (6, "w10 w9"),
             (7, " ".join(f"w{i}" for i in range(400)))]
    got = grouped(lexical.rank(table, spark.createDataFrame(items, "item_id long, text string"), 5))
    assert got == ranked(rows + extra, items, 5)


def test_search_of_empty_tables(spark, docs, empty, odd):
    items = spark.createDataFrame([(1, "p q")], "item_id long, text string")
    assert lexical.rank(empty, items).count() == 0 and lexical.rank(docs, items.limit(0)).count() == 0
    three = odd.unionByName(spark.createDataFrame([(9, "other", *[None] * 14), (10, "more", *[None] * 14), (11, "than p", *[None] * 14), (12, "x", *[None] * 14)], odd.schema))
    assert grouped(lexical.rank(three, items)) == ranked([(r["doc_id"], r["text"]) for r in three.collect()], [(1, "p q")], 50)


# --- Merkle manifest ---

def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(r, more=0):
    values = [r["doc_id"], r["source"], r["lang"], None if r["n_chars"] is None else r["n_chars"] + more, r["text"]]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes, fanout):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + fanout]) for i in range(0, len(levels[-1]), fanout)])
    return levels


def path(levels, i, fanout):
    out = []
    for level in levels[:-1]:
        first = i // fanout * fanout
        out.append(("".join(level[first:i]), "".join(level[i + 1 : first + fanout])))
        i //= fanout
    return out


def manifest(rows, fanout=2):
    by = {}
    for r in rows:
        by.setdefault(r["lang"], []).append(r)
    langs = sorted(by, key=lambda g: (g is not None, (g or "").encode()))
    leaves = {g: sorted(by[g], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r))) for g in langs}
    trees = {g: tree([leaf_of(r) for r in leaves[g]], fanout) for g in langs}
    crown = tree([trees[g][-1][0] for g in langs], fanout)
    return [(r, trees[g][-1][0], crown[-1][0], path(trees[g], i, fanout) + path(crown, k, fanout)) for k, g in enumerate(langs) for i, r in enumerate(leaves[g])]


def many(spark):
    rng = random.Random(6)
    rows = [(i if i % 11 else None, f"t{i}", rng.choice(["en", "en", "en", "de", None, "é", "z"]), "s", rng.choice([None, i])) for i in range(300)]
    rows += [(5_000, "same", "one", "s", 1), (77, "x", "en", None, 7), (77, "y", "en", "s", 7), (77, "y", "en", "s", 7), (14, None, "fr", None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)


def test_verified_as_by_hand(spark, docs, empty):
    for table in (many(spark), docs):
        rows = [r.asDict() for r in table.collect()]
        want = []
        for r, subroot, root, steps in manifest(rows):
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            at = leaf_of(r, 1 if hit else 0)
            for before, after in steps:
                at = h(before, at, after)
            want.append((r["doc_id"], leaf_of(r), subroot, root, h(*[b + a for b, a in steps]), at, at == root))
        got = [tuple(r) for r in merkle.verified(table).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
        assert any(not g[-1] for g in got) and any(g[-1] for g in got)
    assert merkle.verified(empty).count() == 0


@pytest.mark.parametrize("fanout, levels", [(2, 1), (2, 3), (3, 2), (16, 1)])
def test_proofs_of_some_rows(spark, fanout, levels):
    """Segments of any height, runs of any width, requests for a few leaves, one of them twice."""
    table = many(spark)
    made = merkle.build(table, None, fanout, levels)
    asked = made.leaves.where("doc_id % 40 = 3 or lang = 'one'")
    got = merkle.proofs(made, asked.unionByName(asked.where("lang = 'one'")), levels).collect()
    want = {leaf_of(r): (subroot, root, steps) for r, subroot, root, steps in manifest([r.asDict() for r in table.collect()], fanout)}
    assert len(got) == asked.count() + 1 and all((r["subroot"], r["root"], [tuple(s) for s in r["path"]]) == want[r["leaf"]] for r in got)
    records = {d["digest"]: d["children"] for part in made.trees.bundles for row in part.collect() for d in row["records"]}
    assert all(h(*children) == digest for digest, children in records.items())  # content-addressed


def test_a_place_that_is_not_there(spark):
    made = merkle.build(many(spark), levels=2)
    ask = spark.createDataFrame([(0, 10**6, 1), (99, 0, 1)], "tree long, place long, request int")
    assert merkle.prove(made.trees, ask, levels=2).count() == 0


def test_places(spark):
    rng = random.Random(8)
    rows = [(rng.choice("aab") if rng.random() < 0.9 else None, rng.choice([1, 1, 1, 2, 3, None])) for _ in range(500)]
    df = spark.createDataFrame(rows, "g string, v int").repartition(6)
    key = lambda r: (r[1] is not None, r[1] or 0)
    got = ranks.placed(df, "g", [F.col("v").asc_nulls_first()], "p").collect()
    for g in ("a", "b", None):
        mine = sorted((r for r in got if r["g"] == g), key=lambda r: r["place"])
        assert [r["place"] for r in mine] == list(range(len(mine))) and {r["places"] for r in mine} == {len(mine)}
        assert [key((g, r["v"])) for r in mine] == sorted(key(r) for r in rows if r[0] == g)
    assert sorted(r["place"] for r in ranks.placed(df, None, [F.col("v").asc_nulls_first()], "p").collect()) == list(range(500))
