"""States of batches give the verdict that the whole table gives."""

import random

import pytest

from tidemark.quality.rules import Rule, evaluate
from tidemark.quality.state import RuleState

RULES = [
    Rule("not_null", "id"), Rule("unique", "id"), Rule("max_share", "kind", {"max": 0.5}),
    Rule("distinct_ratio_between", "kind", {"min": 0.01, "max": 0.4}), Rule("in_set", "kind", {"values": ["a", "b"]}, 0.9),
    Rule("mean_between", "amount", {"min": 0, "max": 5}), Rule("between", "amount", {"min": 0}),
    Rule("row_count_between", None, {"min": 3}), Rule("columns_present", None, {"columns": ["id", "kind", "extra"]}),
    Rule("fresh", "at", {"as_of": "2024-01-10 00:00:00", "max_age_days": 5}), Rule("matches", "kind", {"pattern": "^[a-c]$"}),
]
SCHEMA = "id string, kind string, amount double, at timestamp_ntz"


def _batch(spark, seed, n):
    from datetime import datetime
    dice = random.Random(seed)
    return spark.createDataFrame([
        (dice.choice([None, str(dice.randint(0, 12))]), dice.choice(["a", "a", "b", "c", None]),
         dice.choice([None, -1.0, 2.5, 9.0]), datetime(2024, 1, dice.randint(1, 9))) for _ in range(n)], SCHEMA)


def _same(state, table, rows):
    assert rows(state.results().drop("suite")) == rows(evaluate(table, "s", RULES).drop("suite"))


def test_merged_states_equal_the_whole_table(spark, tmp_path, rows):
    held = {}

    def whole():
        parts = list(held.values())
        table = parts[0]
        for p in parts[1:]:
            table = table.unionByName(p)
        return table

    state = RuleState(spark, str(tmp_path / "state"), "s", RULES)
    with pytest.raises(ValueError):
        state.results()
    # New batches, an empty one, then ones that come again: changed, emptied, as they were; then a new one.
    for name, seed, n in [("b1", 1, 9), ("b2", 2, 7), ("b3", 0, 0), ("b1", 4, 3), ("b2", 0, 0), ("b1", 4, 3), ("b4", 5, 8)]:
        held[name] = _batch(spark, seed, n)
        state.add(held[name], name)
        _same(state, whole(), rows)


def test_a_run_that_died_is_repeated(spark, tmp_path, rows, monkeypatch):
    state = RuleState(spark, str(tmp_path / "state"), "s", RULES)
    first, second = _batch(spark, 1, 6), _batch(spark, 2, 6)
    state.add(first, "b1")
    with monkeypatch.context() as patch:
        patch.setattr(RuleState, "_added", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            state.add(second, "b2")
    _same(state, first, rows)
    state.add(second, "b2")
    _same(state, first.unionByName(second), rows)


def test_only_the_new_batch_is_read(spark, tmp_path):
    """A later batch doesn't reach the rows of earlier ones: their files may be gone."""
    state = RuleState(spark, str(tmp_path / "state"), "s", [Rule("unique", "id"), Rule("not_null", "id")])
    for name, seed in (("b1", 1), ("b2", 2)):
        path = tmp_path / name
        _batch(spark, seed, 9).write.parquet(str(path))
        state.add(spark.read.parquet(str(path)), name)
        for file in path.iterdir():
            file.unlink()
    assert state.results().where("rule = 'not_null'").first()["evaluated"] == 18


def test_other_rules_have_a_state_of_their_own(spark, tmp_path):
    RuleState(spark, str(tmp_path), "s", RULES[:2]).add(_batch(spark, 1, 5), "b1")
    with pytest.raises(ValueError):
        RuleState(spark, str(tmp_path), "s", RULES[:3]).results()
