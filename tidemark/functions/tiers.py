"""Classification ladders. NULL inputs fall through every condition to the last label."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.functions.columns import as_column

__all__ = [
    "account_balance_tier", "amount_bucket", "customer_value_tier", "detection_outcome",
    "entry_mode", "is_high_risk", "is_missed_fraud", "product_attributes",
    "deposit_category", "sign_type",
]

# --- fixed values ----------------------------------------------------------------------

AMOUNT_BELOW = [(1_000, "MICRO"), (10_000, "SMALL"), (100_000, "MEDIUM"), (1_000_000, "LARGE")]
AMOUNT_REST = "XLARGE"

BALANCE_FROM = [(50_000, "HIGH"), (5_000, "MEDIUM"), (0, "LOW")]
BALANCE_REST = "NEGATIVE"

VALUE_FROM = [(100_000, "HIGH_VALUE"), (10_000, "MID_VALUE")]
VALUE_REST = "STANDARD"

# first number, last number, tier, description, monthly fee
PRODUCT_RANGES = [
    (1, 5, "BASIC", "Entry-level banking product", "0.00"),
    (6, 10, "PREMIUM", "Premium banking product with benefits", "9.99"),
    (11, 15, "CORPORATE", "Corporate treasury product", "49.99"),
]
PRODUCT_REST = ("SPECIALIZED", "Specialized financial instrument", "99.99")

ENTRY_MODES = {
    "Swipe Transaction": "SWIPE",
    "Chip Transaction": "CHIP",
    "Online Transaction": "ONLINE",
}
ENTRY_REST = "OTHER"

RISKY_TYPES = ["CASH_OUT", "TRANSFER"]
RISKY_ABOVE = 200_000


# --- ladders ---------------------------------------------------------------------------

def _first_match(cases: list[tuple[Column, object]], rest: object) -> Column:
    chain = F
    for condition, label in cases:
        chain = chain.when(condition, F.lit(label))
    return chain.otherwise(F.lit(rest))


def amount_bucket(amount: Column | str) -> Column:
    c = as_column(amount)
    return _first_match([(c < bound, label) for bound, label in AMOUNT_BELOW], AMOUNT_REST)


def account_balance_tier(balance: Column | str) -> Column:
    c = as_column(balance)
    return _first_match([(c >= bound, label) for bound, label in BALANCE_FROM], BALANCE_REST)


def customer_value_tier(total: Column | str) -> Column:
    c = as_column(total)
    return _first_match([(c >= bound, label) for bound, label in VALUE_FROM], VALUE_REST)


def product_attributes(product_id: Column | str) -> dict[str, Column]:
    """tier, description and fee of a ``PRODnnn`` code."""
    number = F.replace(as_column(product_id), F.lit("PROD"), F.lit("")).cast("int")
    ranges = [number.between(low, high) for low, high, *_ in PRODUCT_RANGES]
    pick = lambda i: _first_match(
        [(r, p[2 + i]) for r, p in zip(ranges, PRODUCT_RANGES)], PRODUCT_REST[i])
    return {
        "product_tier": pick(0),
        "product_description": pick(1),
        "monthly_fee": pick(2).cast("decimal(4,2)"),
    }


def entry_mode(use_chip: Column | str) -> Column:
    c = as_column(use_chip)
    return _first_match([(c == raw, label) for raw, label in ENTRY_MODES.items()], ENTRY_REST)


def sign_type(amount: Column | str) -> Column:
    return _first_match([(as_column(amount) < 0, "REFUND")], "PURCHASE")


def deposit_category(dest: Column | str) -> Column:
    """Merchant payment when the receiving party is a merchant (``M`` prefix)."""
    return _first_match([(as_column(dest).startswith("M"), "MERCHANT_PAYMENT")], "P2P_TRANSFER")


def is_missed_fraud(fraud: Column | str, flagged: Column | str) -> Column:
    return F.coalesce(as_column(fraud) & ~as_column(flagged), F.lit(False))


def is_high_risk(kind: Column | str, amount: Column | str) -> Column:
    risky = as_column(kind).isin(RISKY_TYPES) & (as_column(amount) > RISKY_ABOVE)
    return F.coalesce(risky, F.lit(False))


def detection_outcome(fraud: Column | str, flagged: Column | str) -> Column:
    f, g = as_column(fraud), as_column(flagged)
    return _first_match(
        [(f & g, "TRUE_POSITIVE"), (~f & g, "FALSE_POSITIVE"), (f & ~g, "FALSE_NEGATIVE")],
        "TRUE_NEGATIVE")
