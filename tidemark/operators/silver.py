"""Silver layer: typed, trimmed, filtered. Lazy functions, so pushdown reaches the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import MONEY, clean_code, clean_email, is_missed_fraud


def _audit(df: DataFrame, *names: str) -> list[str]:
    return [n for n in names if n in df.columns]


def stg_transactions(raw: DataFrame) -> DataFrame:
    kept = raw.where(F.col("transaction_id").isNotNull() & F.col("amount").isNotNull()
                     & (F.col("amount") > 0))
    fraud, flagged = F.col("is_fraud").cast("boolean"), F.col("is_flagged_fraud").cast("boolean")
    money = ["amount", "balance_before", "balance_after", "dest_balance_before",
             "dest_balance_after"]
    return kept.select(
        "transaction_id", "account_id", "customer_id",
        *[clean_code(c).alias(c) for c in ("transaction_type", "currency", "merchant_category")],
        *[F.col(c).cast(MONEY).alias(c) for c in money],
        "orig_account_id", "dest_account_id",
        fraud.alias("is_fraud"), flagged.alias("is_flagged_fraud"),
        is_missed_fraud(fraud, flagged).alias("is_missed_fraud"),
        F.col("transaction_date").cast("date").alias("transaction_date"),
        F.col("created_at").cast("timestamp_ntz").alias("created_at"),
        *_audit(raw, "_loaded_at", "_batch_id"),
    )


def stg_customers(raw: DataFrame) -> DataFrame:
    """All versions are kept; history is built from them later."""
    return raw.where(F.col("customer_id").isNotNull()).select(
        "customer_id", F.trim("full_name").alias("full_name"),
        clean_email("email").alias("email"),
        F.trim("phone").alias("phone"), F.trim("address").alias("address"),
        clean_code("segment").alias("segment"), clean_code("kyc_status").alias("kyc_status"),
        F.col("created_at").cast("timestamp_ntz").alias("created_at"),
        F.col("updated_at").cast("timestamp_ntz").alias("updated_at"),
    )


def stg_accounts(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("account_id").isNotNull()).select(
        "account_id", "customer_id", clean_code("account_type").alias("account_type"),
        F.col("balance").cast(MONEY).alias("balance"),
        F.col("opened_date").cast("date").alias("opened_date"),
        clean_code("status").alias("account_status"), "product_id",
    )


def stg_loans(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("loan_id").isNotNull() & F.col("principal").isNotNull()).select(
        "loan_id", "customer_id", "account_id",
        F.col("principal").cast(MONEY).alias("principal"),
        F.col("interest_rate").cast("decimal(6,4)").alias("interest_rate"),
        F.col("term_months").cast("int").alias("term_months"),
        F.col("disbursement_date").cast("date").alias("disbursement_date"),
        F.col("maturity_date").cast("date").alias("maturity_date"),
        clean_code("status").alias("loan_status"),
    )
