import random

import pytest
from pyspark.sql import types as T

from tidemark.llm.ship import ship

#: Documents' columns, and others whose names clash with what operators call their own.
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    *[T.StructField(n, T.StringType()) for n in ("key", "node", "spans", "ids", "score", "component", "shard", "print", "word", "n", "going")]])


def words(n, seed, size=400):
    rng = random.Random(seed)
    return [f"w{rng.randrange(size)}" if rng.random() < 0.9 else "É" + "xyz" * rng.randrange(1, 9) for _ in range(n)]


def edited(text, share, seed):
    rng = random.Random(seed)
    return " ".join("changed" + str(rng.randrange(10**6)) if rng.random() < share else w for w in text.split(" "))


def texts():
    base, passage = " ".join(words(200, 1)), " ".join(words(60, 2))
    out = [None, "", " \t\n ", "one", "one two", "a b c", "A B C", "Straße É 日本語\ttab\x0bfeed", base, base.upper(), base, None, ""]
    out += [edited(base, 0.01 * k, k) for k in range(1, 12)]
    out += [" ".join(words(40, 50 + k)) + "\n" + passage + "\r\n" + " ".join(words(30, 90 + k)) for k in range(6)]
    out += ["a " * 300, "a " * 40 + "b", "x" * 5000 + " y", " ".join(words(30_000, 7, 10**6)), "!!! ??? ...", "ab " * 25 + "ab"]
    return out


def rows(ids=None):
    found = texts()
    ids = ids or list(range(len(found)))
    return [(i, t, None if k % 3 else "en", f"s{k % 2}", None if t is None else len(t), *["clash"] * 11) for k, (i, t) in enumerate(zip(ids, found, strict=True))]


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def docs(spark):
    """Nulls, empty and long texts, copies, near copies, shared passages; ids with gaps, out of order."""
    ids = list(range(len(texts())))
    random.Random(3).shuffle(ids)
    return spark.createDataFrame(rows([7 * i + 1 for i in ids]), SCHEMA).repartition(3)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def odd(spark):
    """Rows without a doc_id, and rows that repeat one."""
    return spark.createDataFrame([(None, "p q r s t u", *[None] * 14), (5, None, *[None] * 14), (5, "p q r s t u", *[None] * 14), (5, "p q r s t u", *[None] * 14), (None, None, *[None] * 14)], SCHEMA)
