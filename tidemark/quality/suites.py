"""The standard suites, the gate, and the status board."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.contracts import (ACCOUNT_TYPES, AMOUNT_BUCKETS, AUDIT_COLUMNS, CURRENCIES,
                                DETECTION_OUTCOMES, KYC_STATUSES, LOAN_STATUSES,
                                MERCHANT_CATEGORIES, PRODUCT_TIERS, SEGMENTS, TRANSACTIONS,
                                TRANSACTION_TYPES)
from tidemark.quality.rules import Rule, evaluate, suite_summary, violations

# --- fixed values: patterns and bounds --------------------------------------------------

UUID_PATTERN = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
ACCOUNT_PATTERN = r"^ACC\d{4}$"
CUSTOMER_PATTERN = r"^CUST\d{3,4}$"
PARTY_PATTERN = r"^[CM]\d+$"
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
AMOUNT_RANGE = {"min": 0, "max": 100_000_000}
AMOUNT_MEAN = {"min": 50_000, "max": 500_000}
TRANSACTION_ROWS = {"min": 1_000, "max": 10_000_000}
CUSTOMER_ROWS = {"min": 1_000, "max": 100_000}
SEGMENT_RATIO = {"min": 0.001, "max": 0.01}
TOLERANCE = 0.99


def _not_null(*columns: str) -> list[Rule]:
    return [Rule("not_null", c) for c in columns]


def _in_set(**sets: list) -> list[Rule]:
    return [Rule("in_set", c, {"values": v}) for c, v in sets.items()]


def bronze_transactions(id_pattern: str = UUID_PATTERN, account_pattern: str = ACCOUNT_PATTERN,
                        customer_pattern: str = CUSTOMER_PATTERN,
                        rows: dict = TRANSACTION_ROWS, mean: dict = AMOUNT_MEAN) -> list[Rule]:
    """23 rules on raw transactions. Row and mean bounds are for the default feed size."""
    return [
        *_not_null("transaction_id", "account_id", "customer_id", "amount", "transaction_type",
                   "is_fraud", "is_flagged_fraud", "created_at", "transaction_date"),
        Rule("unique", "transaction_id"),
        *_in_set(transaction_type=TRANSACTION_TYPES, currency=CURRENCIES,
                 merchant_category=MERCHANT_CATEGORIES, is_fraud=[0, 1],
                 is_flagged_fraud=[0, 1]),
        Rule("between", "amount", AMOUNT_RANGE),
        Rule("mean_between", "amount", mean),
        Rule("row_count_between", None, rows),
        Rule("columns_present", None, {"columns": TRANSACTIONS.fieldNames() + AUDIT_COLUMNS}),
        Rule("matches", "transaction_id", {"pattern": id_pattern}, TOLERANCE),
        Rule("matches", "account_id", {"pattern": account_pattern}),
        Rule("matches", "customer_id", {"pattern": customer_pattern}),
        Rule("matches", "orig_account_id", {"pattern": PARTY_PATTERN}, TOLERANCE),
    ]


def bronze_customers(customer_pattern: str = CUSTOMER_PATTERN, rows: dict = CUSTOMER_ROWS,
                     segment_ratio: dict = SEGMENT_RATIO) -> list[Rule]:
    """13 rules on raw customer versions. The id is not unique: several versions per customer."""
    return [
        *_not_null("customer_id", "full_name", "email", "segment", "kyc_status", "created_at",
                   "updated_at"),
        *_in_set(segment=SEGMENTS, kyc_status=KYC_STATUSES),
        Rule("matches", "customer_id", {"pattern": customer_pattern}),
        Rule("matches", "email", {"pattern": EMAIL_PATTERN}, TOLERANCE),
        Rule("row_count_between", None, rows),
        Rule("distinct_ratio_between", "segment", segment_ratio),
    ]


def silver_transactions(rows: dict = TRANSACTION_ROWS) -> list[Rule]:
    """12 rules on cleaned transactions."""
    return [
        *_not_null("transaction_id", "amount", "transaction_type", "is_fraud",
                   "is_flagged_fraud", "transaction_date"),
        Rule("unique", "transaction_id"),
        *_in_set(transaction_type=TRANSACTION_TYPES, currency=CURRENCIES,
                 merchant_category=MERCHANT_CATEGORIES),
        Rule("between", "amount", AMOUNT_RANGE),
        Rule("row_count_between", None, rows),
    ]


def table_tests() -> dict[str, list[Rule]]:
    """46 column tests over nine models: 26 not null, 9 unique, 11 accepted values."""
    key = lambda c: [Rule("not_null", c), Rule("unique", c)]
    return {
        "stg_transactions": [
            *key("transaction_id"), *_not_null("amount", "transaction_type"),
            *_in_set(transaction_type=TRANSACTION_TYPES, currency=CURRENCIES),
            *_not_null("is_fraud", "is_flagged_fraud")],
        "stg_customers": [
            *_not_null("customer_id", "segment", "email"),
            *_in_set(segment=SEGMENTS, kyc_status=KYC_STATUSES)],
        "stg_accounts": [
            *key("account_id"), *_in_set(account_type=ACCOUNT_TYPES), *_not_null("customer_id")],
        "stg_loans": [*key("loan_id"), *_not_null("principal"),
                      *_in_set(loan_status=LOAN_STATUSES)],
        "dim_customer": [
            *key("customer_key"), *_not_null("customer_natural_key", "is_current", "valid_from",
                                             "valid_to"), *_in_set(segment=SEGMENTS)],
        "dim_account": [*key("account_key"), *key("account_natural_key"),
                        *_in_set(account_type=ACCOUNT_TYPES)],
        "dim_product": [*key("product_key"), *_in_set(product_tier=PRODUCT_TIERS)],
        "fact_transactions": [
            *key("transaction_id"), *_not_null("amount", "is_fraud", "is_flagged_fraud"),
            *_in_set(amount_bucket=AMOUNT_BUCKETS)],
        "fact_fraud_alerts": [*key("transaction_id"), *_not_null("detection_outcome"),
                              *_in_set(detection_outcome=DETECTION_OUTCOMES)],
    }


def negative_amounts(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Rows with a negative amount; a fact must have none."""
    return df.where(F.col("amount") < 0).select(key, "amount")


def mislabelled_alerts(alerts: DataFrame) -> DataFrame:
    """Alerts labelled TRUE_NEGATIVE: fraud whose flag is missing ends there by the ladder."""
    return violations(alerts, Rule("in_set", "detection_outcome",
                                   {"values": DETECTION_OUTCOMES[:3]}))


class QualityGateError(RuntimeError):
    """A suite failed; ``failures`` holds its failed result rows."""

    def __init__(self, failures: list) -> None:
        self.failures = failures
        lines = [f"{r['suite']}: {r['rule']} on {r['column_name'] or 'table'}" for r in failures]
        super().__init__(f"{len(failures)} rule(s) failed: " + "; ".join(lines))


GROUPS = {"bronze": ["bronze_transactions", "bronze_customers"], "silver": ["silver_transactions"]}


def run_suites(tables: dict[str, tuple[DataFrame, list[Rule]]], run_time: str) -> DataFrame:
    """Evaluate several suites; ``tables`` maps suite name to (table, rules)."""
    parts = [evaluate(df, name, rules) for name, (df, rules) in tables.items()]
    result = parts[0]
    for p in parts[1:]:
        result = result.unionByName(p)
    return result.withColumn("run_time", F.lit(run_time).cast("timestamp_ntz"))


def checkpoint(tables: dict[str, tuple[DataFrame, list[Rule]]], run_time: str,
               which: str = "all", results_path: str | None = None) -> DataFrame:
    """Run the suites of a group (``all``, ``bronze`` or ``silver``), keep the result rows and
    raise :class:`QualityGateError` if any rule failed.

    A suite result has one row per rule, so collecting the failures is bounded by the suites.
    """
    if which != "all":
        tables = {n: t for n, t in tables.items() if n in GROUPS[which]}
    results = run_suites(tables, run_time)
    spark = results.sparkSession
    rows = results.collect()
    kept = spark.createDataFrame(rows, results.schema)
    if results_path:
        kept.write.mode("append").parquet(results_path)
    failures = [r for r in rows if not r["success"]]
    if failures:
        raise QualityGateError(failures)
    return kept


def latest_status(results: DataFrame, suites: list[str]) -> DataFrame:
    """Latest run of every suite and the overall verdict; a suite without a run has failed."""
    spark = results.sparkSession
    runs = results.groupBy("suite", "run_time").agg(
        F.bool_and("success").alias("success"), F.count(F.lit(1)).alias("evaluated"),
        F.count_if(F.col("success")).alias("successful"),
        F.count_if(~F.col("success")).alias("failed"))
    return _board(spark, runs, suites)


def _board(spark: SparkSession, runs: DataFrame, suites: list[str]) -> DataFrame:
    """``runs``: suite, run_time, success, evaluated, successful, failed."""
    newest = runs.groupBy("suite").agg(F.max(F.struct(
        "run_time", "success", "evaluated", "successful", "failed")).alias("r")) \
        .select("suite", "r.*")
    wanted = spark.createDataFrame([(s,) for s in suites], "suite string")
    none = F.lit(0).cast("bigint")
    board = wanted.join(newest, "suite", "left").select(
        "suite", F.coalesce("success", F.lit(False)).alias("success"),
        *[F.coalesce(c, none).alias(c) for c in ("evaluated", "successful", "failed")],
        "run_time")
    overall = F.bool_and("success").over(Window.partitionBy())  # one row per suite
    return board.withColumn("overall_status", F.when(overall, "PASS").otherwise("FAIL"))


RESULT_FILE_SCHEMA = (
    "success boolean, statistics struct<evaluated_expectations: bigint, "
    "successful_expectations: bigint, unsuccessful_expectations: bigint>, "
    "meta struct<run_id: struct<run_time: string>>")


def read_result_files(spark: SparkSession, folder: str, suites: list[str]) -> DataFrame:
    """Status board from result JSON files kept as ``<folder>/<suite>/<run>/…json``.

    Unreadable files and missing counters count as failed runs with zero rules.
    """
    files = (spark.read.schema(RESULT_FILE_SCHEMA).option("multiLine", True)
             .option("mode", "PERMISSIVE").option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.json").json(folder))
    none = F.lit(0).cast("bigint")
    path = F.col("_metadata.file_path")
    runs = files.select(
        F.element_at(F.split(path, "/"), -3).alias("suite"),
        F.element_at(F.split(path, "/"), -2).alias("run"),
        F.coalesce("success", F.lit(False)).alias("success"),
        F.coalesce("statistics.evaluated_expectations", none).alias("evaluated"),
        F.coalesce("statistics.successful_expectations", none).alias("successful"),
        F.coalesce("statistics.unsuccessful_expectations", none).alias("failed"),
        F.col("meta.run_id.run_time").alias("at"))
    # The run's folder name orders the runs; the time inside the file is only shown.
    latest = runs.groupBy("suite").agg(F.max(F.struct(
        "run", "at", "success", "evaluated", "successful", "failed")).alias("r"))
    shown = latest.select("suite", F.col("r.at").alias("run_time"), "r.success", "r.evaluated",
                          "r.successful", "r.failed")
    return _board(spark, shown, suites)


__all__ = ["QualityGateError", "bronze_customers", "bronze_transactions", "checkpoint",
           "latest_status", "mislabelled_alerts", "negative_amounts", "read_result_files",
           "run_suites", "silver_transactions", "suite_summary", "table_tests"]
