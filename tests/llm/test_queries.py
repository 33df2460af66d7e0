"""Registered queries of the operators against their SQL, on the smallest scale factor."""

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from check import compare, connect
from tidemark.llm.queries import QUERIES
from tidemark.llm.sql import ORACLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_agrees_with_sql(spark, duck, name):
    outcome, _ = compare(spark, duck, name, SF)
    assert outcome.startswith("ok"), outcome


def test_queries_are_registered():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLES) <= set(oracle_sql())
    assert [name for name, _ in corpus_pipeline.STAGES] and corpus_pipeline.run is queries()["pipeline"]


def test_classifier_learns_what_its_features_tell(spark):
    """Trees fitted by the operator rank held-out labels as well as plain logistic regression on the same texts does, or better."""
    import numpy as np

    from tidemark.llm import quality

    rng = np.random.default_rng(5)
    words = ["alpha", "beta", "gamma", "delta", "Epsilon."]
    good = [" ".join(rng.choice(words, 60)) for _ in range(150)]
    bad = ["!! $$ " * int(rng.integers(5, 40)) + " ".join(rng.choice(words, 10)) for _ in range(50)]
    rows = [(i, t) for i, t in enumerate(good + bad)]
    labels = spark.createDataFrame([(i, int(i < 150), 0) for i, _ in rows], "doc_id long, quality long, toxic long")
    docs = spark.createDataFrame(rows + rows[:1] * 3, "doc_id long, text string")
    got = quality.score_documents(docs, labels).collect()
    held = [(r["score"], r["doc_id"] < 150) for r in got if r["held_out"]]
    assert len(got) == 203 and sum((s >= 0.3) == y for s, y in held) / len(held) > 0.97
    assert {r["predicted"] for r in got if r["doc_id"] == 199} == {0}
    kept = quality.accepted(docs.selectExpr("doc_id", "text", "0.25 as score", "'x' as score_", "'y' as __score"), labels)
    assert kept.columns == ["doc_id", "text", "score", "score_", "__score"] and {str(r["score"]) for r in kept.collect()} == {"0.25"}
