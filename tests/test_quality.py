"""Rules, suites, gate and status board, with injected faults."""

import json

import pytest
from pyspark.sql import functions as F

from fixtures import adapter
from tidemark.operators import silver
from tidemark.quality import rules as q
from tidemark.quality import suites

SF = "/root/testdata/sf0.001"


def verdicts(df, *rules):
    return [(r.success, r.unexpected) for r in q.evaluate(df, "s", list(rules)).orderBy("rule_no").collect()]


@pytest.fixture(scope="module")
def sample(spark):
    return spark.createDataFrame(
        [("a", 1.0), ("a", 5.0), ("b", None), (None, 9.0)], "k string, v double")


def test_nulls_only_break_not_null(spark, sample):
    assert verdicts(sample, q.Rule("not_null", "k"), q.Rule("in_set", "k", {"values": ["a", "b"]}),
                    q.Rule("between", "v", {"min": 1, "max": 9}),
                    q.Rule("matches", "k", {"pattern": "^[ab]$"})) == [
        (False, 1), (True, 0), (True, 0), (True, 0)]


def test_every_member_of_a_repeated_group_is_unexpected(spark, sample, rows):
    assert verdicts(sample, q.Rule("unique", "k")) == [(False, 2)]
    assert rows(q.violations(sample, q.Rule("unique", "k")), "k") == [("a",), ("a",)]


def test_tolerance_is_a_share_of_the_non_null_rows(spark, sample):
    rule = lambda m: q.Rule("in_set", "k", {"values": ["a"]}, m)
    assert verdicts(sample, rule(0.66), rule(0.67)) == [(True, 1), (False, 1)]


def test_table_level_rules(spark, sample):
    assert [s for s, _ in verdicts(
        sample, q.Rule("row_count_between", None, {"min": 4, "max": 4}),
        q.Rule("mean_between", "v", {"min": 5, "max": 5}),
        q.Rule("columns_present", None, {"columns": ["k"]}),
        q.Rule("columns_present", None, {"columns": ["k", "zz"]}),
        q.Rule("distinct_ratio_between", "k", {"min": 0.6, "max": 0.7}),
        q.Rule("max_share", "k", {"max": 0.5}),
        q.Rule("between", "v", {"min": 2}))] == [True, True, True, False, True, False, False]


def test_rules_on_an_empty_table(spark, sample):
    none = sample.limit(0)
    assert [s for s, _ in verdicts(
        none, q.Rule("not_null", "k"), q.Rule("unique", "k"),
        q.Rule("mean_between", "v", {"min": 0, "max": 1}),
        q.Rule("row_count_between", None, {"min": 1}))] == [True, True, False, False]


def test_all_row_rules_take_one_pass(spark):
    df = silver.stg_transactions(adapter(spark, SF, "txn"))
    rules = [r for r in suites.silver_transactions() if r.kind not in q.GROUPED]
    plan = q.evaluate(df, "s", rules)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1


def test_suite_sizes(spark):
    assert [len(suites.bronze_transactions()), len(suites.bronze_customers()),
            len(suites.silver_transactions())] == [23, 13, 12]
    kinds = [r.kind for rules in suites.table_tests().values() for r in rules]
    assert [kinds.count(k) for k in ("not_null", "unique", "in_set")] == [26, 9, 11]


def test_suite_from_json(spark, sample):
    text = json.dumps({"expectation_suite_name": "n", "expectations": [
        {"expectation_type": "expect_column_values_to_be_in_set",
         "kwargs": {"column": "k", "value_set": ["a"], "mostly": 0.5}},
        {"expectation_type": "expect_table_row_count_to_be_between",
         "kwargs": {"min_value": 1, "max_value": 3}}]})
    name, rules = q.suite_from_json(text)
    assert name == "n" and [s for s, _ in verdicts(sample, *rules)] == [True, False]


def test_unknown_type_row_stops_the_gate(spark, tmp_path):
    good = silver.stg_transactions(adapter(spark, SF, "txn"))
    suite = {"silver_transactions": (good, suites.silver_transactions())}
    results = str(tmp_path / "results")
    assert suites.checkpoint(suite, "2024-01-01 00:00:00", "silver", results).count() == 12
    bad = good.withColumn("transaction_type", F.when(F.col("transaction_id") == "T5", "BARTER")
                          .otherwise(F.col("transaction_type")))
    with pytest.raises(suites.QualityGateError) as stop:
        suites.checkpoint({"silver_transactions": (bad, suites.silver_transactions())},
                          "2024-01-02 00:00:00", "silver", results)
    assert [r["column_name"] for r in stop.value.failures] == ["transaction_type"]
    # The group leaves out other suites; both runs are on record.
    assert spark.read.parquet(results).select("run_time").distinct().count() == 2
    board = {r.suite: r for r in suites.latest_status(
        spark.read.parquet(results), ["silver_transactions", "bronze_customers"]).collect()}
    assert board["silver_transactions"].failed == 1 and not board["silver_transactions"].success
    assert board["bronze_customers"].evaluated == 0 and board["bronze_customers"].overall_status == "FAIL"


def test_violations_list_rows(spark, sample, rows):
    assert rows(q.violations(sample, q.Rule("not_null", "v")), "k") == [("b",)]
    listed = q.fact_violations(sample.withColumn("id", F.monotonically_increasing_id()), "id", [
        q.Rule("not_null", "k"), q.Rule("between", "v", {"max": 4})])
    assert rows(listed, "rule_no") == [(1,), (2,), (2,)]
    with pytest.raises(ValueError):
        q.violations(sample, q.Rule("mean_between", "v", {}))


def test_freshness(spark):
    df = spark.createDataFrame([("2024-01-10",)], "t string")
    rule = lambda at: q.Rule("fresh", "t", {"as_of": at, "max_age_days": 2})
    assert [s for s, _ in verdicts(df, rule("2024-01-12 00:00:00"), rule("2024-01-13 00:00:00"))] == [
        True, False]


def test_result_files(spark, tmp_path):
    def write(suite, run, body):
        folder = tmp_path / suite / run
        folder.mkdir(parents=True)
        (folder / "r.json").write_text(body)

    document = lambda ok, n, bad, at: json.dumps({
        "success": ok, "statistics": {"evaluated_expectations": n,
                                      "successful_expectations": n - bad,
                                      "unsuccessful_expectations": bad},
        "meta": {"run_id": {"run_time": at}}}, indent=1)
    write("a", "20240101", document(False, 5, 2, "t1"))
    write("a", "20240102", document(True, 5, 0, "t2"))
    write("b", "20240101", "{ not json")
    board = {r.suite: r for r in suites.read_result_files(spark, str(tmp_path), ["a", "b", "c"]).collect()}
    assert (board["a"].success, board["a"].evaluated, board["a"].run_time) == (True, 5, "t2")
    assert (board["b"].success, board["b"].evaluated) == (False, 0)
    assert (board["c"].success, board["c"].overall_status) == (False, "FAIL")


def test_fraud_without_flag_is_reported_as_mislabelled(spark):
    alerts = spark.createDataFrame([("TRUE_NEGATIVE",), ("TRUE_POSITIVE",)], "detection_outcome string")
    assert suites.mislabelled_alerts(alerts).count() == 1


def test_ids_that_are_too_long_break_the_suite_of_the_given_tables(spark):
    """Accounts without a partner have eight digits: the rule on account ids has to find them."""
    from catalog import transaction_suite

    ids = spark.createDataFrame([("ACC1", "CUST1"), ("ACC90000001", "CUST99999"), ("ACC12345", "CUST123456")],
                                "account_id string, customer_id string")
    wanted = [r for r in transaction_suite() if r.kind == "matches" and r.column in ids.columns]
    assert [r.column for r in wanted] == ["account_id", "customer_id"]
    assert verdicts(ids, *wanted) == [(False, 1), (False, 1)]
