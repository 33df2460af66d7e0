"""Declarative data-quality rules.

All row-level rules of a suite are counted in one aggregation over the table. Rules about
distinct values (unique, distinct ratio) need the values grouped: one ``groupBy`` per column,
which combines on the map side, answers all of them for that column. Nothing but counters leaves
the executors.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Rule:
    """``kind`` is one of not_null, unique, in_set, between, mean_between, row_count_between,
    columns_present, matches, distinct_ratio_between, fresh, max_share."""

    kind: str
    column: str | None = None
    args: dict[str, Any] = field(default_factory=dict)
    mostly: float = 1.0

    def failing(self) -> Column | None:
        """Condition of a row that breaks the rule, for rules about single rows. NULLs break
        only ``not_null``."""
        c = F.col(self.column) if self.column else None
        if self.kind == "not_null":
            return c.isNull()
        if self.kind == "in_set":
            return c.isNotNull() & ~c.isin(list(self.args["values"]))
        if self.kind == "between":
            low, high = self.args.get("min"), self.args.get("max")
            inside = F.lit(True)
            if low is not None:
                inside = inside & (c >= low)
            if high is not None:
                inside = inside & (c <= high)
            return c.isNotNull() & ~inside
        if self.kind == "matches":
            return c.isNotNull() & ~c.rlike(self.args["pattern"])
        return None


GROUPED = ("unique", "distinct_ratio_between", "max_share")
RESULT_COLUMNS = ["suite", "rule_no", "rule", "column_name", "observed", "unexpected",
                  "evaluated", "success"]


def _within(value: Column, args: dict[str, Any]) -> Column:
    ok = value.isNotNull()
    if args.get("min") is not None:
        ok = ok & (value >= float(args["min"]))
    if args.get("max") is not None:
        ok = ok & (value <= float(args["max"]))
    return ok


def _outcome(number: int, rule: Rule, observed: Column, unexpected: Column, evaluated: Column,
             success: Column) -> Column:
    return F.struct(
        F.lit(number).alias("rule_no"), F.lit(rule.kind).alias("rule"),
        F.lit(rule.column).cast("string").alias("column_name"),
        observed.cast("double").alias("observed"), unexpected.cast("bigint").alias("unexpected"),
        evaluated.cast("bigint").alias("evaluated"), success.cast("boolean").alias("success"))


def _row_rule(number: int, rule: Rule, present: set[str]) -> tuple[list[Column], Column]:
    """Aggregates a rule needs, and its outcome in terms of them."""
    bad, seen = f"_bad{number}", f"_seen{number}"
    nothing = F.lit(None).cast("bigint")
    if rule.kind == "columns_present":
        missing = len(set(rule.args["columns"]) - present)
        return [], _outcome(number, rule, F.lit(float(missing)), F.lit(missing),
                            F.lit(len(rule.args["columns"])), F.lit(missing == 0))
    if rule.kind == "row_count_between":
        n = F.col("_rows")
        return [], _outcome(number, rule, n, nothing, n, _within(n, rule.args))
    if rule.kind == "mean_between":
        m = F.col(bad)
        aggregates = [F.avg(F.col(rule.column).cast("double")).alias(bad),
                      F.count(rule.column).alias(seen)]
        return aggregates, _outcome(number, rule, F.round(m, 6), nothing, F.col(seen),
                                    _within(m, rule.args))
    if rule.kind == "fresh":
        newest = F.col(bad)
        limit = F.lit(rule.args["as_of"]).cast("timestamp_ntz") - F.expr(
            f"INTERVAL {int(rule.args['max_age_days'])} DAYS")
        aggregates = [F.max(F.col(rule.column).cast("timestamp_ntz")).alias(bad),
                      F.count(rule.column).alias(seen)]
        age = F.datediff(F.lit(rule.args["as_of"]).cast("date"), newest.cast("date"))
        return aggregates, _outcome(number, rule, age, nothing, F.col(seen),
                                    F.coalesce(newest >= limit, F.lit(False)))
    failing = rule.failing()
    if failing is None:
        raise ValueError(f"unknown rule kind {rule.kind!r}")
    everything = rule.kind == "not_null"
    aggregates = [F.count_if(failing).alias(bad)]
    if not everything:
        aggregates.append(F.count(rule.column).alias(seen))
    evaluated = F.col("_rows") if everything else F.col(seen)
    good = F.when(evaluated > 0, 1 - F.col(bad) / evaluated).otherwise(F.lit(1.0))
    return aggregates, _outcome(number, rule, F.round(good, 6), F.col(bad), evaluated,
                                good >= rule.mostly)


def _grouped_rules(df: DataFrame, column: str, rules: list[tuple[int, Rule]]) -> DataFrame:
    sizes = (df.where(F.col(column).isNotNull()).groupBy(column)
             .agg(F.count(F.lit(1)).alias("n")))
    totals = sizes.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("values"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("repeated"),
        F.max("n").alias("largest"))
    return totals.select(F.inline(F.array(*_grouped_outcomes(rules))))


def _grouped_outcomes(rules: list[tuple[int, Rule]]) -> list[Column]:
    """Outcomes in terms of rows, values, repeated and largest of one column."""
    rows, outcomes = F.col("rows"), []
    for number, rule in rules:
        if rule.kind == "unique":
            outcomes.append(_outcome(number, rule, F.col("repeated"), F.col("repeated"), rows,
                                     F.col("repeated") == 0))
            continue
        part = F.col("values") if rule.kind == "distinct_ratio_between" else F.col("largest")
        ratio = F.when(rows > 0, part / rows)
        outcomes.append(_outcome(number, rule, F.round(ratio, 6), F.lit(None), rows,
                                 _within(ratio, rule.args)))
    return outcomes


def evaluate(df: DataFrame, suite: str, rules: list[Rule]) -> DataFrame:
    """One result row per rule."""
    numbered = list(enumerate(rules, start=1))
    by_row = [(i, r) for i, r in numbered if r.kind not in GROUPED]
    aggregates, outcomes = [F.count(F.lit(1)).alias("_rows")], []
    for i, rule in by_row:
        wanted, outcome = _row_rule(i, rule, set(df.columns))
        aggregates += wanted
        outcomes.append(outcome)
    parts = []
    if outcomes:
        parts.append(df.agg(*aggregates).select(F.inline(F.array(*outcomes))))
    grouped: dict[str, list[tuple[int, Rule]]] = {}
    for i, rule in numbered:
        if rule.kind in GROUPED:
            grouped.setdefault(rule.column, []).append((i, rule))
    parts += [_grouped_rules(df, column, found) for column, found in grouped.items()]
    result = parts[0]
    for p in parts[1:]:
        result = result.unionByName(p)
    return result.withColumn("suite", F.lit(suite)).select(*RESULT_COLUMNS)


def suite_summary(results: DataFrame) -> DataFrame:
    """Passed and failed rules and the verdict per suite."""
    return results.groupBy("suite").agg(
        F.bool_and("success").alias("success"), F.count_if(F.col("success")).alias("passed"),
        F.count_if(~F.col("success")).alias("failed"), F.count(F.lit(1)).alias("total"))


def violations(df: DataFrame, rule: Rule) -> DataFrame:
    """The rows that break a rule; empty means the test passes.

    For ``unique`` every member of a repeated group is returned: the repeated values are found by
    a combined count and joined back.
    """
    if rule.kind == "unique":
        repeated = (df.where(F.col(rule.column).isNotNull()).groupBy(rule.column).count()
                    .where(F.col("count") > 1).select(rule.column))
        return df.join(repeated, rule.column, "left_semi").select(*df.columns)
    failing = rule.failing()
    if failing is None:
        raise ValueError(f"{rule.kind} is not about single rows")
    return df.where(failing)


def fact_violations(df: DataFrame, key: str, rules: list[Rule]) -> DataFrame:
    """Broken row-level rules of every row as (key, rule_no, rule, column), in one pass."""
    broken = F.array(*[
        F.when(r.failing(), F.struct(F.lit(i).alias("rule_no"), F.lit(r.kind).alias("rule"),
                                     F.lit(r.column).alias("column_name")))
        for i, r in enumerate(rules, start=1)])
    return (df.select(F.col(key).alias("row_key"),
                      F.filter(broken, lambda b: b.isNotNull()).alias("b"))
            .where(F.size("b") > 0).select("row_key", F.inline("b")))


# fixed values: rule names of the JSON suite format
JSON_KINDS = {
    "expect_column_values_to_not_be_null": "not_null",
    "expect_column_values_to_be_unique": "unique",
    "expect_column_values_to_be_in_set": "in_set",
    "expect_column_values_to_be_between": "between",
    "expect_column_mean_to_be_between": "mean_between",
    "expect_table_row_count_to_be_between": "row_count_between",
    "expect_table_columns_to_match_set": "columns_present",
    "expect_column_values_to_match_regex": "matches",
    "expect_column_proportion_of_unique_values_to_be_between": "distinct_ratio_between",
}
JSON_ARGS = {"value_set": "values", "min_value": "min", "max_value": "max", "regex": "pattern",
             "column_set": "columns"}
# Say nothing about which rows pass.
JSON_PLAIN = ("column", "mostly", "result_format", "include_config", "catch_exceptions", "meta")


def suite_from_json(text: str) -> tuple[str, list[Rule]]:
    """Name and rules of a suite kept as JSON. An argument that would change a rule's meaning and isn't
    known here is an error, not ignored; bounds are inclusive and a column set is a subset."""
    document = json.loads(text)
    rules = []
    for entry in document["expectations"]:
        given = entry.get("kwargs", {})
        if entry["expectation_type"] not in JSON_KINDS:
            raise ValueError(f"unknown rule {entry['expectation_type']}")
        odd = sorted(k for k, v in given.items() if k not in JSON_ARGS and k not in JSON_PLAIN and v not in (None, False))
        if odd:
            raise ValueError(f"{entry['expectation_type']} does not know {odd}")
        args = {JSON_ARGS[k]: v for k, v in given.items() if k in JSON_ARGS and v is not None}
        rules.append(Rule(JSON_KINDS[entry["expectation_type"]], given.get("column"), args,
                          float(given.get("mostly", 1.0))))
    return document["expectation_suite_name"], rules
