"""Reporting queries over the stars. All of them aggregate first and sort or window the result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.contracts import TRANSACTION_TYPES
from tidemark.functions import percent


def _count_true(c: Column) -> Column:
    return F.sum(F.when(c, 1).otherwise(0))


def daily_volume(fact: DataFrame, as_of: str | None = None, days: int = 30) -> DataFrame:
    """Rows, volume and frauds per day and type; with ``as_of`` the last ``days`` days only."""
    if as_of is not None:
        fact = fact.where(F.col("transaction_date") >= F.date_sub(F.lit(as_of).cast("date"), days))
    return (fact.groupBy(F.col("transaction_date").alias("date"), "transaction_type")
            .agg(F.count(F.lit(1)).alias("tx_count"), F.sum("amount").alias("total_volume"),
                 _count_true(F.col("is_fraud")).alias("fraud_count"))
            .orderBy("date", "transaction_type"))


def kpis(fact: DataFrame) -> DataFrame:
    """One row, also on an empty fact (then with fraud count NULL)."""
    return fact.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.coalesce(F.sum("amount"), F.lit(0)).alias("total_volume"),
        _count_true(F.col("is_fraud")).alias("fraud_transactions"),
        F.coalesce(F.avg("amount").cast("double"), F.lit(0.0)).alias("avg_amount"))


def type_totals(daily: DataFrame) -> DataFrame:
    return (daily.groupBy("transaction_type")
            .agg(F.sum("tx_count").alias("tx_count"), F.sum("total_volume").alias("total_volume"),
                 F.sum("fraud_count").alias("fraud_count"))
            .orderBy(F.col("tx_count").desc(), "transaction_type"))


def fraud_rate_by_type(daily: DataFrame) -> DataFrame:
    return type_totals(daily).withColumn(
        "fraud_rate", percent(F.col("fraud_count"), F.col("tx_count"), 2))


def type_rollup(fact: DataFrame) -> DataFrame:
    """Per type and over all types (``transaction_type`` NULL, ``is_total`` true) in one pass."""
    grouped = fact.rollup("transaction_type").agg(
        F.grouping("transaction_type").alias("_level"), F.count(F.lit(1)).alias("tx_count"),
        F.sum("amount").alias("total_volume"), _count_true(F.col("is_fraud")).alias("fraud_count"))
    total = F.col("_level") == 1
    rate = F.when(total, F.coalesce(percent(F.col("fraud_count"), F.col("tx_count"), 3),
                                    F.lit(0.0))) \
            .otherwise(percent(F.col("fraud_count"), F.col("tx_count"), 2))
    return grouped.select("transaction_type", total.alias("is_total"), "tx_count",
                          "total_volume", "fraud_count", rate.alias("fraud_rate"))


def daily_pivot(daily: DataFrame, types: list[str] = TRANSACTION_TYPES) -> DataFrame:
    """One row per date, one column of counts per type; a missing cell stays NULL."""
    return daily.groupBy("date").pivot("transaction_type", types).agg(F.sum("tx_count")) \
                .orderBy("date")


def segment_share(dim_customer: DataFrame) -> DataFrame:
    """Distinct customers per segment among current versions and their share in percent."""
    counts = (dim_customer.where("is_current").groupBy("segment")
              .agg(F.countDistinct("customer_natural_key").alias("customer_count")))
    total = F.sum("customer_count").over(Window.partitionBy())  # one row per segment
    return (counts.withColumn("pct", percent(F.col("customer_count"), total, 1))
            .orderBy(F.col("customer_count").desc(), "segment"))


def kyc_status(customers: DataFrame) -> DataFrame:
    """Counts over all versions, not only current ones."""
    return (customers.groupBy("kyc_status").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), "kyc_status"))


# --- fraud ------------------------------------------------------------------------------

def outcome_matrix(alerts: DataFrame) -> DataFrame:
    return (alerts.groupBy("transaction_type", "detection_outcome")
            .agg(F.count(F.lit(1)).alias("n")).orderBy("transaction_type", "detection_outcome"))


def fraud_values(alerts: DataFrame) -> DataFrame:
    """Value at risk, value missed and number of missed frauds above 100,000."""
    missed = F.col("detection_outcome") == "FALSE_NEGATIVE"
    big = F.col("is_missed_fraud") & (F.col("amount") > 100_000)
    return alerts.agg(
        F.sum(F.when(F.col("is_fraud"), F.col("amount"))).alias("fraud_value"),
        F.sum(F.when(missed, F.col("amount"))).alias("missed_fraud_value"),
        F.count_if(big).alias("high_value_misses"))


def missed_fraud(alerts: DataFrame, above: float | None = None) -> DataFrame:
    """The missed frauds themselves, optionally only those above an amount."""
    missed = alerts.where(F.col("detection_outcome") == "FALSE_NEGATIVE")
    return missed if above is None else missed.where(F.col("amount") > above)


def detection_rates(alerts: DataFrame) -> DataFrame:
    """``flagged_share`` averages over the mart, which also holds false alarms; recall and
    precision are the rates proper."""
    count = lambda label: F.count_if(F.col("detection_outcome") == label)
    tp, fp, fn = count("TRUE_POSITIVE"), count("FALSE_POSITIVE"), count("FALSE_NEGATIVE")
    ratio = lambda a, b: F.when(b > 0, F.round(a / b, 6))
    flagged = F.when(F.col("is_flagged_fraud"), 1).otherwise(0)
    return alerts.agg(F.round(F.avg(flagged), 6).alias("flagged_share"),
                      ratio(tp, tp + fn).alias("recall"),
                      ratio(tp, tp + fp).alias("precision"))


def fraud_by_type(alerts: DataFrame) -> DataFrame:
    return (alerts.groupBy("transaction_type").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), "transaction_type"))


# --- profiles ---------------------------------------------------------------------------

def feed_profile(transactions: DataFrame) -> DataFrame:
    fraud = F.sum(F.col("is_fraud").cast("bigint"))
    rows = F.count(F.lit(1))
    return transactions.agg(
        rows.alias("row_count"), fraud.alias("fraud_count"),
        percent(fraud, rows, 3).alias("fraud_pct"),
        F.min("transaction_date").alias("first_date"), F.max("transaction_date").alias("last_date"))


def type_share(transactions: DataFrame) -> DataFrame:
    counts = transactions.groupBy("transaction_type").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # one row per type
    return (counts.withColumn("share", percent(F.col("n"), total, 2))
            .orderBy(F.col("n").desc(), "transaction_type"))


def channel_summary(unified: DataFrame, channels: DataFrame) -> DataFrame:
    """Rows and frauds per channel and over both; rates over all and over labelled rows.

    Amounts are summed per channel only, since the channels do not share a currency basis.
    """
    rows, labelled = F.count(F.lit(1)), F.count_if(F.col("is_fraud_labeled"))
    frauds = F.count_if(F.col("is_fraud"))
    level = F.grouping("channel")
    grouped = unified.rollup("channel").agg(
        level.alias("_level"), rows.alias("transactions"), frauds.alias("frauds"),
        labelled.alias("labelled"), percent(frauds, rows, 3).alias("fraud_pct"),
        percent(frauds, labelled, 3).alias("fraud_pct_labelled"),
        F.when(level == 0, F.sum("amount")).alias("amount"))
    return (grouped.join(F.broadcast(channels), "channel", "left")  # two rows
            .select(F.when(F.col("_level") == 1, "TOTAL").otherwise(F.col("channel"))
                    .alias("channel"), "currency_basis", "transactions", "frauds", "labelled",
                    "fraud_pct", "fraud_pct_labelled", "amount"))


def table_counts(**tables: DataFrame) -> DataFrame:
    """Row count per table. Without columns to read, Parquet scans answer from footers."""
    counts = [df.agg(F.count(F.lit(1)).alias("row_count"))
              .select(F.lit(name).alias("table_name"), "row_count")
              for name, df in tables.items()]
    result = counts[0]
    for c in counts[1:]:
        result = result.unionByName(c)
    return result


def batch_audit(bronze: DataFrame) -> DataFrame:
    """Batches present and what each one landed."""
    return bronze.groupBy("_batch_id").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("_loaded_at").alias("first_loaded_at"),
        F.countDistinct("_source_file").alias("files"))


def batch_rows(bronze: DataFrame, batch_id: str) -> DataFrame:
    """What one batch landed; prunes to its directory where bronze is partitioned by batch."""
    return bronze.where(F.col("_batch_id") == batch_id)
