"""Dimensions of the core star and of the two-channel star."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.contracts import CALENDAR, EPOCH_START
from tidemark.functions import (account_balance_tier, customer_value_tier, ntz, parse_money,
                                product_attributes, surrogate_key, text_key, typed_null,
                                whole_years)
from tidemark.operators.dedup import dedup_latest
from tidemark.operators.scd2 import scd2


def dim_customer(customers: DataFrame, **options) -> DataFrame:
    return scd2(customers, "customer_id", "updated_at", **options)


def dim_account(accounts: DataFrame, as_of: str) -> DataFrame:
    """Type 1. Ages are taken at ``as_of``, never at the time of the run."""
    return accounts.select(
        surrogate_key("account_id").alias("account_key"),
        F.col("account_id").alias("account_natural_key"),
        "customer_id", "account_type", "balance", "opened_date", "account_status", "product_id",
        account_balance_tier("balance").alias("balance_tier"),
        whole_years("opened_date", as_of).alias("account_age_years"),
    )


def dim_product(accounts: DataFrame) -> DataFrame:
    products = accounts.select("product_id").where(F.col("product_id").isNotNull()).distinct()
    return products.select(
        surrogate_key("product_id").alias("product_key"),
        F.col("product_id").alias("product_natural_key"),
        *[c.alias(n) for n, c in product_attributes("product_id").items()],
    )


def customer_latest(customers: DataFrame) -> DataFrame:
    """Latest version per customer; ties on the instant are broken by the attributes."""
    picked = customers.select("customer_id", "full_name", "email", "segment", "kyc_status",
                              "updated_at")
    return dedup_latest(picked, ["customer_id"],
                        ["updated_at", "segment", "kyc_status", "full_name", "email"])


def customer_accounts(customers: DataFrame, accounts: DataFrame) -> DataFrame:
    """Latest version of each customer with the statistics of their accounts."""
    has = lambda kind: F.max(F.when(F.col("account_type") == kind, 1).otherwise(0))
    stats = accounts.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_accounts"), F.sum("balance").alias("total_balance"),
        has("LOAN").alias("has_loan"), has("CHECKING").alias("has_checking"),
        has("SAVINGS").alias("has_savings"))
    return (customer_latest(customers).drop("updated_at").join(stats, "customer_id", "left")
            .withColumn("value_tier", customer_value_tier("total_balance")))


# --- two-channel star ------------------------------------------------------------------

# fixed values: channel key, channel, description, currency basis
CHANNELS = [
    (1, "CARD", "IBM credit-card issuing platform", "USD"),
    (2, "MOBILE_MONEY", "PaySim mobile-money platform", "LOCAL"),
]


def dim_channel(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        CHANNELS, "channel_key int, channel string, description string, currency_basis string")


def dim_date(spark: SparkSession, start: str = CALENDAR[0], end: str = CALENDAR[1]) -> DataFrame:
    """One row per day. Sunday is 0, Saturday 6."""
    day = F.col("date_key")
    days = spark.range(1).select(F.explode(F.sequence(
        F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("date_key"))
    return days.select(
        day,
        F.year(day).cast("bigint").alias("year"), F.quarter(day).cast("bigint").alias("quarter"),
        F.month(day).cast("bigint").alias("month"), F.day(day).cast("bigint").alias("day"),
        (F.dayofweek(day) - 1).cast("bigint").alias("day_of_week"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
    )


def dim_customer_master(users: DataFrame) -> DataFrame:
    """One open-ended version per user of the card system."""
    optional = [c for c in ("latitude", "longitude") if c in users.columns]
    return users.select(
        text_key("id").alias("customer_key"), F.col("id").alias("customer_natural_key"),
        "current_age", "retirement_age", "gender", "address", *optional,
        *[parse_money(c).alias(c) for c in ("per_capita_income", "yearly_income", "total_debt")],
        "credit_score", "num_credit_cards",
        ntz(EPOCH_START).alias("valid_from"), typed_null("timestamp_ntz").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def dim_card(cards: DataFrame) -> DataFrame:
    return cards.select(
        text_key("id").alias("card_key"), F.col("id").alias("card_natural_key"),
        F.col("client_id").alias("customer_natural_key"), "card_brand", "card_type", "has_chip",
        "num_cards_issued", parse_money("credit_limit").alias("credit_limit"),
        "card_on_dark_web",
    )


def dim_merchant(transactions: DataFrame, mcc: DataFrame, consistent: bool = False) -> DataFrame:
    """One row per merchant with the smallest code, city and state seen.

    The three minima are independent of each other; ``consistent=True`` takes the smallest
    (code, city, state) that occurs together in one row instead. Both combine on the map side,
    so a merchant with a third of all rows sends one row per map task.
    """
    sold = transactions.where(F.col("merchant_id").isNotNull())
    if consistent:
        per = (sold.groupBy("merchant_id")
               .agg(F.min(F.struct("mcc", "merchant_city", "merchant_state")).alias("m"))
               .select("merchant_id", "m.*"))
    else:
        per = sold.groupBy("merchant_id").agg(
            *[F.min(c).alias(c) for c in ("mcc", "merchant_city", "merchant_state")])
    return per.join(mcc, "mcc", "left").select(
        text_key("merchant_id").alias("merchant_key"),
        F.col("merchant_id").cast("string").alias("merchant_natural_key"), "mcc",
        F.coalesce("mcc_category", F.lit("UNKNOWN")).alias("merchant_category"),
        "merchant_city", "merchant_state",
    )
