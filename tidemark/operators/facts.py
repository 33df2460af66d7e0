"""Facts of the core star."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import amount_bucket, detection_outcome, is_high_risk
from tidemark.operators.lookup import lookup
from tidemark.operators.scd2 import scd2_current


def fact_transactions(transactions: DataFrame, customers: DataFrame, accounts: DataFrame,
                      products: DataFrame) -> DataFrame:
    """Transactions with keys of the current customer version, the account and its product.

    Account and product are joined to each other first: the fact is then joined, and at most
    shuffled, once per natural key it carries (customer, account) rather than once per dimension.
    Every join is n:1 and left, so no row is lost or repeated.
    """
    customer = scd2_current(customers).select(
        F.col("customer_natural_key").alias("_customer"), "customer_key",
        F.col("segment").alias("customer_segment"))
    product = products.select(F.col("product_natural_key").alias("product_id"), "product_key")
    account = (accounts.select(F.col("account_natural_key").alias("_account"), "account_key",
                               "account_type", "product_id")
               .join(product, "product_id", "left").drop("product_id"))
    joined = lookup(transactions, customer, "customer_id", "_customer", "transaction_id")
    joined = lookup(joined, account, "account_id", "_account", "transaction_id")
    return joined.select(
        "transaction_id", "customer_key", "account_key", "product_key",
        "amount", "balance_before", "balance_after",
        (F.col("balance_after") - F.col("balance_before")).alias("balance_delta"),
        "transaction_type", "currency", "merchant_category", "orig_account_id",
        "dest_account_id", "is_fraud", "is_flagged_fraud", "is_missed_fraud",
        amount_bucket("amount").alias("amount_bucket"),
        is_high_risk("transaction_type", "amount").alias("is_high_risk_pattern"),
        "transaction_date", "created_at", "customer_segment", "account_type", "_batch_id",
    )


def fact_fraud_alerts(fact: DataFrame) -> DataFrame:
    """Transactions that are fraud or were flagged, labelled by how detection did."""
    return fact.where(F.col("is_fraud") | F.col("is_flagged_fraud")).select(
        "transaction_id", "customer_key", "account_key", "transaction_type", "amount",
        "balance_before", "balance_after", "balance_delta", "orig_account_id",
        "dest_account_id", "is_fraud", "is_flagged_fraud", "is_missed_fraud",
        detection_outcome("is_fraud", "is_flagged_fraud").alias("detection_outcome"),
        "amount_bucket", "is_high_risk_pattern", "transaction_date", "created_at",
        "customer_segment", "_batch_id",
    )
