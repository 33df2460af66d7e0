"""Dimensions whose rows are few are sent to all tasks; the fact is not shuffled for them."""

import pytest

from tidemark.operators import channels, lookup as lookups

NO_GUESS = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture
def measured_only(spark):
    """Spark itself broadcasts nothing."""
    before = {k: spark.conf.get(k, None) for k in NO_GUESS}
    for k, v in NO_GUESS.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def fact(spark):
    return spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, "x"), (5, "b")], "id long, k string")


@pytest.fixture
def dim(spark):
    """One key twice, one null, many that no row names."""
    return spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4), *[(f"n{i}", i) for i in range(2000)]], "d string, v int")


def test_lookup_used_sends_only_named_rows(spark, rows, measured_only, monkeypatch, fact, dim):
    monkeypatch.setattr(lookups, "SENT_BYTES", 4096)  # the dimension has more, the rows named by the fact have not
    found = lookups.lookup_used(fact, dim, "k", "d", "id")
    assert "BroadcastHashJoin" in plan_of(found)
    want = [(1, "a", 1), (2, "a", 1), (3, None, None), (4, "x", None), (5, "b", 2), (5, "b", 3)]
    assert rows(found, "id", "k", "v") == want
    assert rows(lookups.lookup(fact, dim, "k", "d", "id"), "id", "k", "v") == want


def test_lookup_used_shuffles_where_many_rows_are_named(spark, rows, measured_only, monkeypatch, fact, dim):
    monkeypatch.setattr(lookups, "SENT_BYTES", 0)
    found = lookups.lookup_used(fact, dim, "k", "d", "id")
    assert "BroadcastHashJoin" not in plan_of(found)
    assert rows(found, "id", "k", "v") == [(1, "a", 1), (2, "a", 1), (3, None, None), (4, "x", None), (5, "b", 2), (5, "b", 3)]


def test_card_rows_are_shuffled_for_their_labels_alone(spark, measured_only):
    card = spark.createDataFrame([(1, "2020-01-01 00:00:00", 5, 7, "$1.00", "Swipe Transaction", 9, "A", "B", 3, "b0")],
                                 "id long, date string, client_id long, card_id long, amount string, use_chip string, merchant_id long, "
                                 "merchant_city string, merchant_state string, mcc int, _batch_id string")
    labels = spark.createDataFrame([(1, "Yes")], "transaction_id long, fraud_label string")
    mcc = spark.createDataFrame([(3, "Food")], "mcc int, mcc_category string")
    plan = plan_of(channels.harmonize_card(card, labels, mcc))
    assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 1
