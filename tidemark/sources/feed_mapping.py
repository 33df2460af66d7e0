"""Mapping of the raw mobile-money feed onto the transaction contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.contracts import TRANSACTIONS
from tidemark.functions import stable_bucket, step_instant
from tidemark.operators.channels import money_ids
from tidemark.operators.dedup import exact_sample

# fixed values: id pools and the categories of merchant payments
ACCOUNT_POOL = (1000, 3001)    # first number, size
CUSTOMER_POOL = (100, 1000)
DEPOSIT_CATEGORIES = ["RETAIL", "FOOD", "UTILITIES", "HEALTHCARE", "TRAVEL"]


def map_feed(feed: DataFrame, sample_rows: int | None = None) -> DataFrame:
    """The 17 contract columns in order, from the feed's 11 columns.

    Ids come from the content, accounts, customers and merchant categories from hash buckets:
    mapping the same feed twice gives the same rows.
    """
    batched = feed if "_batch_id" in feed.columns else feed.withColumn("_batch_id", F.lit(""))
    rows = money_ids(batched)
    if sample_rows is not None:
        rows = exact_sample(rows, sample_rows, "row_id")
    at = step_instant("step")
    account = stable_bucket(F.concat(F.lit("a"), "row_id"), ACCOUNT_POOL[1]) - 1 + ACCOUNT_POOL[0]
    customer = (stable_bucket(F.concat(F.lit("c"), "row_id"), CUSTOMER_POOL[1]) - 1
                + CUSTOMER_POOL[0])
    category = F.element_at(
        F.array(*[F.lit(c) for c in DEPOSIT_CATEGORIES]),
        stable_bucket(F.concat(F.lit("m"), "row_id"), len(DEPOSIT_CATEGORIES)).cast("int"))
    mapped = rows.select(
        F.col("row_id").alias("transaction_id"),
        F.concat(F.lit("ACC"), account.cast("string")).alias("account_id"),
        F.concat(F.lit("CUST"), customer.cast("string")).alias("customer_id"),
        F.col("type").alias("transaction_type"), F.col("amount").cast("double"),
        F.lit("USD").alias("currency"),
        F.when(F.col("nameDest").startswith("M"), category).otherwise(F.lit("TRANSFER"))
        .alias("merchant_category"),
        F.col("nameOrig").alias("orig_account_id"), F.col("nameDest").alias("dest_account_id"),
        F.col("oldbalanceOrg").cast("double").alias("balance_before"),
        F.col("newbalanceOrig").cast("double").alias("balance_after"),
        F.col("oldbalanceDest").cast("double").alias("dest_balance_before"),
        F.col("newbalanceDest").cast("double").alias("dest_balance_after"),
        F.col("isFraud").cast("bigint").alias("is_fraud"),
        F.col("isFlaggedFraud").cast("bigint").alias("is_flagged_fraud"),
        F.date_format(at, "yyyy-MM-dd").alias("transaction_date"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss").alias("created_at"),
    )
    return mapped.select(*TRANSACTIONS.fieldNames())
