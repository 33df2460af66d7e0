"""Version history: chaining, ties, hot keys, as-of, overlaps."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from pyspark.sql import functions as F
from tidemark.operators import scd2
from tidemark.operators.dedup import dedup_latest, exact_sample
from tidemark.operators.copies import expand_copies
from tidemark.operators.hotkeys import SLICE, hot_keys, with_next, with_slice

SHAPE = "customer_id string, segment string, updated_at timestamp_ntz"
DAY = dt.datetime(2024, 1, 1)


def at(minutes):
    return DAY + dt.timedelta(minutes=minutes)


def versions(spark, data):
    return spark.createDataFrame([(k, s, None if m is None else at(m)) for k, s, m in data], SHAPE)


def lead_of(data):
    """Plain Python: (key, segment, minute) -> next minute of the key."""
    out = []
    for key in {k for k, _, _ in data}:
        mine = sorted(((m, s) for k, s, m in data if k == key))
        for i, (m, s) in enumerate(mine):
            out.append((key, s, m, mine[i + 1][0] if i + 1 < len(mine) else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot_rows", [10**6, 3, 0])
def test_next_is_the_same_however_keys_are_cut(spark, hot_rows):
    rng = random.Random(7)
    data = [(rng.choice("aaaaabc"), f"s{i}", rng.randrange(0, 20_000)) for i in range(120)]
    got = with_next(versions(spark, data), "customer_id", "updated_at", "nxt", ["segment"],
                    hot_rows)
    minutes = lambda t: None if t is None else int((t - DAY).total_seconds() // 60)
    found = sorted(((r.customer_id, r.segment, minutes(r.updated_at), minutes(r.nxt))
                    for r in got.collect()), key=str)
    assert found == lead_of(data)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from("xyz"),
                          st.integers(0, 6000)), min_size=1, max_size=25),
       st.sampled_from([0, 4, 10**6]))
def test_history_is_a_chain(spark, data, hot_rows):
    dim = scd2.scd2(versions(spark, data), "customer_id", "updated_at", hot_rows=hot_rows)
    by_key = {}
    for r in dim.collect():
        by_key.setdefault(r.customer_natural_key, []).append(r)
    assert sum(map(len, by_key.values())) == len(data)
    for mine in by_key.values():
        mine.sort(key=lambda r: (r.valid_from, r.valid_to))
        assert sum(r.is_current for r in mine) == 1
        assert all(a.valid_to == b.valid_from for a, b in zip(mine, mine[1:]))
        assert mine[-1].is_current and mine[-1].valid_to == dt.datetime(9999, 12, 31)


def test_as_of_is_half_open(spark, rows):
    dim = scd2.scd2(versions(spark, [("a", "x", 0), ("a", "y", 60)]), "customer_id", "updated_at")
    seen = lambda t: rows(scd2.scd2_as_of(dim, t), "segment")
    assert seen("2024-01-01 00:59:59") == [("x",)]
    assert seen("2024-01-01 01:00:00") == [("y",)]
    assert seen("2023-12-31 23:59:59") == []
    assert rows(scd2.scd2_current(dim), "segment") == [("y",)]


def test_open_end_may_be_null(spark, rows):
    dim = spark.createDataFrame(
        [("a", at(0), None)], "k string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    assert len(rows(scd2.scd2_as_of(dim, "2030-01-01 00:00:00"))) == 1


@pytest.mark.parametrize("strategy,hot_rows", [("search", 10**6),
                                               ("merge", 10**6), ("merge", 5), ("merge", 0)])
def test_asof_join_agrees_with_search(spark, strategy, hot_rows):
    rng = random.Random(3)
    history = [(k, f"{k}{i}", m) for k in "ab" for i, m in enumerate(
        sorted(rng.sample(range(500, 9000), 9)))]
    dim = scd2.scd2(versions(spark, history), "customer_id", "updated_at")
    facts = [(i, rng.choice(["a", "a", "a", "b", "c", None]),
              None if i % 17 == 0 else rng.randrange(0, 10_000)) for i in range(80)]
    facts += [(100 + i, k, m) for i, (k, _, m) in enumerate(history)]  # exactly on a boundary
    df = spark.createDataFrame([(i, k, None if m is None else at(m)) for i, k, m in facts],
                               "id int, customer_id string, ts timestamp_ntz")
    got = scd2.scd2_asof_join(df, dim, "customer_id", "ts", ["segment"], strategy=strategy,
                              hot_rows=hot_rows)

    def expected(key, minute):
        started = [(m, s) for k, s, m in history if k == key and minute is not None and m <= minute]
        return max(started)[1] if started else None

    assert sorted((r.id, r.segment) for r in got.collect()) == sorted(
        (i, expected(k, m)) for i, k, m in facts)


@pytest.mark.parametrize("strategy,hot_rows", [("search", 10**6), ("merge", 10**6), ("merge", 4)])
def test_asof_join_on_damaged_history(spark, strategy, hot_rows):
    """Overlaps, nested and equal intervals, and gaps: the covering version that starts last."""
    rng = random.Random(8)
    history = [("k", f"s{i}", a, a + rng.choice([1, 5, 30, 400])) for i, a in enumerate(rng.choices(range(200), k=25))]
    history += [("k", "x", 7, 20), ("k", "y", 7, 20), ("z", "only", 3, 4)]
    dim = spark.createDataFrame([(k, s, at(a), at(b)) for k, s, a, b in history],
                                "customer_natural_key string, segment string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    facts = [(i, k, m) for i, (k, m) in enumerate((k, m) for k in "kz" for m in range(0, 230, 3))]
    df = spark.createDataFrame([(i, k, at(m)) for i, k, m in facts], "id int, customer_id string, ts timestamp_ntz")
    got = scd2.scd2_asof_join(df, dim, "customer_id", "ts", ["segment"], strategy=strategy, hot_rows=hot_rows)

    def expected(key, minute):
        found = [(a, b, s) for k, s, a, b in history if k == key and a <= minute < b]
        return max(found)[2] if found else None

    assert sorted((r.id, r.segment) for r in got.collect()) == [(i, expected(k, m)) for i, k, m in facts]


def brute_overlaps(intervals):
    out = {}
    for i, a in enumerate(intervals):
        for j, b in enumerate(intervals):
            if i != j and a[0] == b[0] and a[2] < b[3] and a[3] > b[2]:
                pair = (a[0], a[2], a[3], b[2], b[3])
                out[pair] = out.get(pair, 0) + 1
    return out


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 3), st.integers(0, 40),
                          st.integers(0, 30)), min_size=1, max_size=12))
def test_overlaps_are_all_pairs(spark, drawn):
    intervals = [(k, f"v{v}", at(m), at(m + n)) for k, v, m, n in drawn]
    dim = spark.createDataFrame(intervals, "customer_natural_key string, customer_key string, "
                                "valid_from timestamp_ntz, valid_to timestamp_ntz")
    found = {}
    for r in scd2.scd2_overlaps(dim).collect():
        pair = (r[0], r[1], r[2], r[3], r[4])
        found[pair] = found.get(pair, 0) + r.pairs
    assert found == brute_overlaps(intervals)


def test_healthy_history_has_no_overlap_and_ties_are_not_hidden(spark):
    healthy = scd2.scd2(versions(spark, [("a", "x", 0), ("a", "y", 5), ("b", "x", 1)]),
                        "customer_id", "updated_at")
    assert scd2.scd2_overlaps(healthy).isEmpty()
    loaded_twice = healthy.unionByName(healthy)  # same surrogate keys
    assert scd2.scd2_overlaps(loaded_twice).count() == 3


def test_dedup_keeps_the_latest(spark, rows):
    df = versions(spark, [("a", "old", 1), ("a", "new", 9), ("b", "only", 3), ("b", "none", None)])
    assert rows(dedup_latest(df, ["customer_id"], ["updated_at"]), "customer_id", "segment") == [
        ("a", "new"), ("b", "only")]


def test_dedup_limits_groups_before_the_shuffle(spark):
    df = versions(spark, [("a", "x", 1)])
    plan = dedup_latest(df, ["customer_id"], ["updated_at"])._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    assert physical.count("WindowGroupLimit") == 2 and "Partial" in physical


def test_copies_are_numbered_in_any_chunking(spark):
    df = spark.createDataFrame([("a", 1, 23), ("b", None, 4), ("c", 2, 1)], "k string, v int, copies long")
    for chunk in (5, 10, 1000):
        got = sorted((r.k, r.n) for r in expand_copies(df, "copies", "n", chunk).collect())
        assert got == [("a", i) for i in range(1, 24)] + [("b", i) for i in range(1, 5)] + [("c", 1)]


def test_hot_keys_hold_more_than_a_tasks_share(spark):
    df = versions(spark, [("a", "x", i) for i in range(9)] + [("b", "x", i) for i in range(5)]
                  + [("c", "x", 1)] + [(None, "x", 1)] * 20)
    keys = lambda *a: sorted(r[0] for r in hot_keys(df, "customer_id", "updated_at", *a).collect())
    assert keys() == ["a", "b"]  # of 15 rows over 4 partitions
    assert keys(5) == ["a"] and keys(0) == ["a", "b", "c"]
    assert hot_keys(df, "customer_id", "updated_at", 9) is None
    assert hot_keys(df.limit(0), "customer_id", "updated_at") is None


def test_a_key_with_all_rows_is_cut_into_even_slices(spark):
    """Also where most of its rows lie within one second."""
    rows = [("a", "x", i) for i in range(200)]
    df = versions(spark, rows).withColumn("updated_at", F.when(
        F.col("segment") == "x", F.timestamp_seconds(F.lit(1.7e9) + F.expr("ln(1 + minute(updated_at) + 60 * hour(updated_at)) / 10")).cast("timestamp_ntz")))
    hot = hot_keys(df, "customer_id", "updated_at")
    sizes = [r["count"] for r in with_slice(df, "customer_id", "updated_at", hot).groupBy(SLICE).count().collect()]
    assert len(sizes) > 10 and max(sizes) < 40


@pytest.mark.parametrize("hot_rows", [None, 4, 0])
def test_overlapping_versions_as_by_pairs(spark, hot_rows):
    rng = random.Random(5)
    rows = []
    for i in range(150):
        begin = rng.randrange(4000)
        rows.append((rng.choice("aaaab"), f"s{i}", at(begin), at(begin + rng.choice([0, 1, 5, 900]))))
    rows += [rows[0], ("c", "x", at(1), None), ("c", "y", at(5), at(6)), (None, "z", at(1), None), (None, "z", at(1), None)]
    dim = spark.createDataFrame(rows, "customer_natural_key string, customer_key string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    got = sorted((r.customer_key, r.covered_until) for r in scd2.scd2_overlapping(dim, hot_rows=hot_rows).collect())
    end, want = dt.datetime(9999, 12, 31), []
    for key in "abc":
        until = None
        for f, t, s in sorted((f, t or end, s) for k, s, f, t in rows if k == key):
            if until and until > f:
                want.append((s, until))
            until = max(until or t, t)
    assert got == sorted(want)


@pytest.mark.parametrize("hot_rows", [10**6, 10, 0])
def test_a_hot_key_within_one_instant(spark, hot_rows):
    """A third of the table is one redelivered row, another part lies within one second."""
    data = [("a", "x", 5)] * 40 + [("a", "y", 5)] * 3 + [("a", "z", 9)] + [("b", "q", 1)] * 2
    data += [("c", "n", None), ("a", "n", None)]
    got = with_next(versions(spark, data), "customer_id", "updated_at", "nxt", ["segment"], hot_rows)
    count = {}
    for r in got.collect():
        count[(r.customer_id, r.segment, r.nxt)] = count.get((r.customer_id, r.segment, r.nxt), 0) + 1
    assert count == {("a", "x", at(5)): 40, ("a", "y", at(5)): 2, ("a", "y", at(9)): 1,
                     ("a", "z", None): 1, ("a", "n", None): 1, ("c", "n", None): 1,
                     ("b", "q", at(1)): 1, ("b", "q", None): 1}


def test_sample_keeps_rows_without_a_key(spark):
    df = spark.createDataFrame([(None, i) for i in range(400)] + [(str(i), i) for i in range(100)], "k string, v int")
    assert [exact_sample(df, n, "k", sorted_rows=50).count() for n in (0, 200, 400, 900)] == [0, 200, 400, 500]
    few = exact_sample(df, 200, "k", sorted_rows=3).collect()
    assert sorted(few, key=str) == sorted(exact_sample(df.repartition(5), 200, "k").collect(), key=str)


@pytest.mark.parametrize("n", [0, 1, 37, 500, 1000, 5000])
def test_sample_is_exact_and_repeatable(spark, n):
    df = spark.range(1000).selectExpr("cast(id as string) as id", "id % 3 as v")
    one = exact_sample(df, n, "id").collect()
    assert len(one) == min(n, 1000)
    assert sorted(one) == sorted(exact_sample(df.repartition(7), n, "id").collect())


def test_rows_of_small_keys_are_not_written_out_by_blocks(spark, monkeypatch):
    """Three overlapping rows of one key meet each other; forty of another go through the blocks."""
    day = lambda i: dt.datetime(2020, 1, 1) + dt.timedelta(days=i)
    spans = [("a", f"a{i}", day(i), day(i + 9)) for i in range(3)] + [("b", f"b{i}", day(i), day(i + 2)) for i in range(40)]
    dim = spark.createDataFrame(spans, "customer_natural_key string, customer_key string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    seen, through = [], scd2.starts_inside
    monkeypatch.setattr(scd2, "starts_inside", lambda df, *names: seen.append(df) or through(df, *names))
    found = scd2.scd2_overlaps(dim).groupBy("customer_natural_key").count().collect()
    assert {r[0]: r[1] for r in found} == {"a": 6, "b": 78}
    assert {r[0] for r in seen[0].select("customer_natural_key").distinct().collect()} == {"b"}
