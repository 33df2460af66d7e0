"""The stages against brute force on the smallest documents, each on its own input, and run() from end to end."""

import base64
import itertools
import math
import re

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from tidemark.llm import quality

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def split(text, lower=False):
    return re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text) if lower else text)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").cache()


def stage(spark, docs, k):
    out = corpus_pipeline.STAGES[k][1](spark, docs, SF)
    return out, {r["doc_id"]: r.asDict() for r in out.collect()}


def test_classifier_walks_its_trees(spark, docs):
    out, kept = stage(spark, docs, 0)
    trees = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    want = set()
    for r in docs.collect():
        x = quality.features(quality.pa.array([r["text"]]))[0]
        total = trees.bias
        for f, c, leaf in zip(trees.feature, trees.cut, trees.leaf, strict=True):
            at = 0
            while at < len(f):
                at = 2 * at + (2 if x[f[at]] > c[at] else 1)
            total += leaf[at - len(f)]
        if 1 / (1 + math.exp(-total)) >= 0.3:
            want.add(r["doc_id"])
    assert out.columns == COLUMNS and set(kept) == want


def test_one_of_each_group_stays(spark, docs):
    out, kept = stage(spark, docs, 1)
    sets = {}
    for r in docs.collect():
        w = split(r["text"], True)
        sets[r["doc_id"]] = set(zip(*[w[i:] for i in range(5)], strict=False)) if len(w) >= 5 else {tuple(w)} if w else set()
    low = {d: d for d in sets}
    links = [(a, b) for a, b in itertools.combinations(sorted(sets), 2)
             if sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    for _ in range(len(sets)):
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
    assert out.columns == COLUMNS and set(kept) == {d for d in low if low[d] == d}


def test_repeated_passages_go(spark, docs):
    out, got = stage(spark, docs, 2)
    n, first = corpus_pipeline.PASSAGE_WORDS, {}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for d, text in rows:
        w = split(text)
        for i in range(len(w) - n + 1):
            first.setdefault(tuple(w[i : i + n]), d)
    cut = 0
    for d, text in rows:
        w = split(text)
        gone = [any(first[tuple(w[i : i + n])] < d for i in range(max(0, k - n + 1), min(k, len(w) - n) + 1)) for k in range(len(w))]
        assert split(got[d]["text"]) == [x for x, g in zip(w, gone, strict=True) if not g]
        assert got[d]["n_chars"] == len(got[d]["text"])
        cut += any(gone)
    assert out.columns == COLUMNS and cut > 0


def test_leaks_go(spark, docs):
    out, kept = stage(spark, docs, 3)
    tokens = lambda t: re.findall(r"[^\s!-/:-@\[-`{-~]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    items = [tokens(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = set()
    for r in docs.collect():
        w = tokens(r["text"])
        at = {}
        for i, x in enumerate(w):
            at.setdefault(x, []).append(i)
        for item in items:
            shifts = {i - k for k, x in enumerate(item) for i in at.get(x, ())}
            for shift in shifts:
                same = [0 <= k + shift < len(w) and w[k + shift] == x for k, x in enumerate(item)]
                if sum(same) < 13:
                    continue
                for a in range(len(item)):
                    for b in range(a + 13, len(item) + 1):
                        if sum(same[a:b]) >= 13 and sum(same[a:b]) >= 0.8 * (b - a) and all(same[a : a + 6]):
                            leaked.add(r["doc_id"])
    assert out.columns == COLUMNS and leaked and set(kept) == {r["doc_id"] for r in docs.collect()} - leaked


def test_tokens(spark, docs):
    _, got = stage(spark, docs, 4)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in docs.collect():
        assert got[r["doc_id"]]["ids"] == library.encode_ordinary(r["text"]) and got[r["doc_id"]]["n_tokens"] == len(got[r["doc_id"]]["ids"])


def test_run_is_the_stages_one_after_another(spark, docs):
    out = corpus_pipeline.run(spark, SF)
    left, now = docs, None
    for _, f in corpus_pipeline.STAGES:
        now = f(spark, left, SF)
        left = now
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near-dedup", "substring-dedup", "decontamination", "byte-bpe"]
    assert {(r["doc_id"], tuple(r["ids"])) for r in out.collect()} == {(r["doc_id"], tuple(r["ids"])) for r in now.collect()}
