"""Declared column contracts and accepted values of every layer."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _L, _I = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in columns.items()])


# --- fixed values: names and raw types of the incoming files -----------------------------

TRANSACTIONS = _struct(
    transaction_id=_S, account_id=_S, customer_id=_S, transaction_type=_S, amount=_D,
    currency=_S, merchant_category=_S, orig_account_id=_S, dest_account_id=_S,
    balance_before=_D, balance_after=_D, dest_balance_before=_D, dest_balance_after=_D,
    is_fraud=_L, is_flagged_fraud=_L, transaction_date=_S, created_at=_S,
)
CUSTOMERS = _struct(
    customer_id=_S, full_name=_S, email=_S, phone=_S, address=_S, segment=_S,
    kyc_status=_S, created_at=_S, updated_at=_S,
)
ACCOUNTS = _struct(
    account_id=_S, customer_id=_S, account_type=_S, balance=_D, opened_date=_S,
    status=_S, product_id=_S,
)
LOANS = _struct(
    loan_id=_S, customer_id=_S, account_id=_S, principal=_D, interest_rate=_D,
    term_months=_L, disbursement_date=_S, maturity_date=_S, status=_S,
)
CARD_TRANSACTIONS = _struct(
    id=_L, date=T.TimestampNTZType(), client_id=_L, card_id=_L, amount=_S, use_chip=_S,
    merchant_id=_L, merchant_city=_S, merchant_state=_S, zip=_S, mcc=_I, errors=_S,
)
CARD_USERS = _struct(
    id=_L, current_age=_I, retirement_age=_I, birth_year=_I, birth_month=_I, gender=_S,
    address=_S, latitude=_D, longitude=_D, per_capita_income=_S, yearly_income=_S,
    total_debt=_S, credit_score=_I, num_credit_cards=_I,
)
CARDS = _struct(
    id=_L, client_id=_L, card_brand=_S, card_type=_S, card_number=_S, expires=_S, cvv=_S,
    has_chip=_S, num_cards_issued=_I, credit_limit=_S, acct_open_date=_S,
    year_pin_last_changed=_I, card_on_dark_web=_S,
)
MONEY_TRANSACTIONS = _struct(
    step=_I, type=_S, amount=_D, nameOrig=_S, oldbalanceOrg=_D, newbalanceOrig=_D,
    nameDest=_S, oldbalanceDest=_D, newbalanceDest=_D, isFraud=_L, isFlaggedFraud=_L,
)

CONTRACTS: dict[str, T.StructType] = {
    "transactions": TRANSACTIONS,
    "customers": CUSTOMERS,
    "accounts": ACCOUNTS,
    "loans": LOANS,
}
FEEDS: dict[str, T.StructType] = {
    "card_transactions": CARD_TRANSACTIONS,
    "card_users": CARD_USERS,
    "cards": CARDS,
    "money_transactions": MONEY_TRANSACTIONS,
}
AUDIT_COLUMNS = ["_loaded_at", "_source_file", "_batch_id"]

# --- fixed values: accepted values -----------------------------------------------------

TRANSACTION_TYPES = ["CASH_OUT", "PAYMENT", "CASH_IN", "TRANSFER", "DEBIT"]
CURRENCIES = ["USD"]
MERCHANT_CATEGORIES = ["RETAIL", "FOOD", "TRAVEL", "UTILITIES", "HEALTHCARE", "TRANSFER"]
SEGMENTS = ["RETAIL", "PREMIUM", "CORPORATE"]
KYC_STATUSES = ["VERIFIED", "PENDING", "FAILED", "EXPIRED"]
ACCOUNT_TYPES = ["CHECKING", "SAVINGS", "LOAN"]
LOAN_STATUSES = ["ACTIVE", "CLOSED", "DEFAULTED", "RESTRUCTURED"]
AMOUNT_BUCKETS = ["MICRO", "SMALL", "MEDIUM", "LARGE", "XLARGE"]
PRODUCT_TIERS = ["BASIC", "PREMIUM", "CORPORATE", "SPECIALIZED"]
DETECTION_OUTCOMES = ["TRUE_POSITIVE", "FALSE_POSITIVE", "FALSE_NEGATIVE", "TRUE_NEGATIVE"]

# --- fixed values: dates and sentinels --------------------------------------------------

OPEN_END = "9999-12-31 00:00:00"          # valid_to of the version in force
EPOCH_START = "1900-01-01 00:00:00"       # watermark of an empty table, valid_from of the master
STEP_ZERO = "2024-01-01 00:00:00"         # instant of step 0 in the mobile-money feed
CALENDAR = ("2010-01-01", "2024-12-31")   # default span of the date dimension
