"""Cleaning, classification, dimensions and facts on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.contracts import (ACCOUNTS, CARD_TRANSACTIONS, CUSTOMERS, LOANS,
                                MONEY_TRANSACTIONS, TRANSACTIONS)
from tidemark.functions import (account_balance_tier, amount_bucket, batch_label,
                                customer_value_tier, detection_outcome, entry_mode,
                                instant_micros, is_high_risk, is_missed_fraud, parse_money,
                                product_attributes, stable_bucket, step_instant, surrogate_key,
                                whole_years)
from tidemark.operators import channels, dimensions, facts, silver
from tidemark.operators.lookup import lookup, measured_bytes, orphans
from tidemark.plans import reports
from tidemark.sources.feed_mapping import map_feed


def one(spark, expression, **values):
    names = list(values)
    df = spark.createDataFrame([tuple(values.values())], ", ".join(
        f"{n} {'string' if isinstance(v, str) or v is None else 'boolean' if isinstance(v, bool) else 'double'}"
        for n, v in values.items())) if names else spark.range(1)
    return df.select(expression.alias("x")).first()["x"]


@pytest.mark.parametrize("amount,bucket", [
    (0.01, "MICRO"), (999.99, "MICRO"), (1000.0, "SMALL"), (9999.99, "SMALL"),
    (10000.0, "MEDIUM"), (99999.99, "MEDIUM"), (100000.0, "LARGE"), (999999.99, "LARGE"),
    (1e6, "XLARGE")])
def test_amount_bucket(spark, amount, bucket):
    assert one(spark, amount_bucket("a"), a=amount) == bucket


def test_null_falls_to_the_last_label(spark):
    null = F.lit(None).cast("double")
    assert one(spark, account_balance_tier(null)) == "NEGATIVE"
    assert one(spark, customer_value_tier(null)) == "STANDARD"
    assert one(spark, product_attributes(F.lit(None).cast("string"))["product_tier"]) == "SPECIALIZED"
    assert one(spark, entry_mode(F.lit(None).cast("string"))) == "OTHER"


@pytest.mark.parametrize("code,tier,fee", [
    ("PROD001", "BASIC", "0.00"), ("PROD005", "BASIC", "0.00"), ("PROD006", "PREMIUM", "9.99"),
    ("PROD015", "CORPORATE", "49.99"), ("PROD016", "SPECIALIZED", "99.99"),
    ("PROD000", "SPECIALIZED", "99.99")])
def test_product_ranges(spark, code, tier, fee):
    got = product_attributes("p")
    assert one(spark, got["product_tier"], p=code) == tier
    assert str(one(spark, got["monthly_fee"], p=code)) == fee


def test_three_valued_fraud_logic(spark):
    t, f, n = F.lit(True), F.lit(False), F.lit(None).cast("boolean")
    label = lambda a, b: one(spark, detection_outcome(a, b))
    assert [label(t, t), label(f, t), label(t, f), label(f, f)] == [
        "TRUE_POSITIVE", "FALSE_POSITIVE", "FALSE_NEGATIVE", "TRUE_NEGATIVE"]
    assert label(t, n) == "TRUE_NEGATIVE"  # the known wrong label, caught by a rule
    assert one(spark, is_missed_fraud(t, n)) is False
    assert one(spark, is_missed_fraud(t, f)) is True
    assert one(spark, is_high_risk(n.cast("string"), F.lit(1e9))) is False


def test_keys_tell_nulls_apart(spark):
    a, null = F.lit("a"), F.lit(None).cast("string")
    assert one(spark, surrogate_key(a, null)) != one(spark, surrogate_key(null, a))
    assert one(spark, surrogate_key(a)) == "0cc175b9c0f1b6a831c399e269772661"


def test_small_functions(spark):
    assert str(one(spark, parse_money("m"), m="$-77.00")) == "-77.00"
    assert one(spark, stable_bucket("c", 2000), c="C1231006815") == 1329
    assert one(spark, step_instant(F.lit(25))) == dt.datetime(2024, 1, 2, 1)
    opened = F.lit("2021-07-01").cast("date")
    assert one(spark, whole_years(opened, "2024-01-01")) == 2  # 2.5 is not rounded up
    assert one(spark, batch_label(F.lit("2024-05-16 20:38:41").cast("timestamp_ntz"))) == "20240516_203841"
    early = F.lit("1969-12-31 23:59:59.5").cast("timestamp_ntz")
    assert one(spark, instant_micros(early)) == -500_000


def raw_transaction(**change):
    row = dict(transaction_id="t1", account_id="A1", customer_id="C1",
               transaction_type=" cash_out", amount=250000.0, currency="usd",
               merchant_category="retail ", orig_account_id="C1", dest_account_id="M1",
               balance_before=10.0, balance_after=4.5, dest_balance_before=0.0,
               dest_balance_after=0.0, is_fraud=1, is_flagged_fraud=0,
               transaction_date="2024-01-05", created_at="2024-01-05 10:00:00")
    return {**row, **change}


def transactions(spark, *changes):
    data = [tuple(raw_transaction(**c)[f] for f in TRANSACTIONS.fieldNames()) for c in changes]
    return spark.createDataFrame(data, TRANSACTIONS).withColumn("_batch_id", F.lit("b"))


def test_transaction_filter_uses_the_raw_amount(spark, rows):
    raw = transactions(spark, {}, {"transaction_id": None}, {"amount": None}, {"amount": 0.0},
                       {"transaction_id": "t2", "amount": -1.0},
                       {"transaction_id": "t3", "amount": 0.001})
    clean = silver.stg_transactions(raw)
    assert rows(clean, "transaction_id") == [("t1",), ("t3",)]  # 0.001 passes, then rounds to 0
    first = clean.where("transaction_id = 't1'").first()
    assert (first.transaction_type, first.currency, first.merchant_category) == (
        "CASH_OUT", "USD", "RETAIL")
    assert first.is_missed_fraud is True and first.created_at == dt.datetime(2024, 1, 5, 10)


def test_loading_a_table_twice_doubles_it(spark):
    raw = transactions(spark, {})
    assert silver.stg_transactions(raw.unionByName(raw)).count() == 2


def star(spark):
    customers = spark.createDataFrame(
        [("C1", " Ann", "A@X.org ", "1", "x", "retail", "verified", "2020-01-01", "2020-01-01"),
         ("C1", " Ann", "A@X.org ", "1", "x", "premium", "verified", "2020-01-01", "2023-01-01"),
         ("C2", "Bo", None, "1", "x", "RETAIL", "failed", "2020-01-01", "2020-01-01"),
         (None, "No", None, "1", "x", "RETAIL", "failed", "2020-01-01", "2020-01-01")], CUSTOMERS)
    accounts = spark.createDataFrame(
        [("A1", "C1", "loan", -5.0, "2020-01-01", "active", "PROD007"),
         ("A2", "C1", "savings", 200000.0, "2020-01-01", "active", None)], ACCOUNTS)
    c, a = silver.stg_customers(customers), silver.stg_accounts(accounts)
    return c, a, dimensions.dim_customer(c), dimensions.dim_account(a, "2024-01-01"), \
        dimensions.dim_product(a)


def test_fact_keeps_every_row_and_takes_the_current_version(spark):
    _, _, customer, account, product = star(spark)
    t = silver.stg_transactions(transactions(
        spark, {}, {"transaction_id": "t2", "account_id": "A2"},
        {"transaction_id": "t3", "account_id": "A9", "customer_id": "C9"},
        {"transaction_id": "t4", "account_id": None, "customer_id": None}))
    fact = {r.transaction_id: r for r in facts.fact_transactions(t, customer, account, product).collect()}
    assert len(fact) == 4
    assert fact["t1"].customer_segment == "PREMIUM" and fact["t1"].account_type == "LOAN"
    assert fact["t1"].product_key is not None and fact["t1"].is_high_risk_pattern
    assert str(fact["t1"].balance_delta) == "-5.50" and fact["t1"].amount_bucket == "LARGE"
    assert fact["t2"].account_key is not None and fact["t2"].product_key is None
    assert fact["t3"].customer_key is None and fact["t4"].account_key is None
    assert orphans(t, account, "account_id", "account_natural_key").collect()[0][:] == ("A9", 1)


def test_customer_accounts(spark):
    c, a, *_ = star(spark)
    got = {r.customer_id: r for r in dimensions.customer_accounts(c, a).collect()}
    assert got["C1"].segment == "PREMIUM" and got["C1"].value_tier == "HIGH_VALUE"
    assert (got["C1"].has_loan, got["C1"].has_checking, got["C1"].has_savings) == (1, 0, 1)
    assert got["C2"].total_accounts is None and got["C2"].value_tier == "STANDARD"


def test_kpis_of_an_empty_fact(spark):
    _, _, customer, account, product = star(spark)
    t = silver.stg_transactions(transactions(spark, {"amount": 0.0}))
    k = reports.kpis(facts.fact_transactions(t, customer, account, product)).first()
    assert (k.total_transactions, k.total_volume, k.fraud_transactions, k.avg_amount) == (0, 0, None, 0.0)


def test_calendar(spark):
    days = dimensions.dim_date(spark)
    assert days.count() == 5479 and days.where("is_weekend").count() == 1566
    sunday = days.where("date_key = '2024-12-29'").first()
    assert (sunday.day_of_week, sunday.month_name, sunday.quarter) == (0, "December", 4)


def test_loans_and_exact_rate(spark):
    raw = spark.createDataFrame(
        [("L1", "C", "A", 1000.0, 3.55555, 12, "2020-01-01", "2021-01-01", " active"),
         ("L2", "C", "A", None, 3.5, 12, "2020-01-01", "2021-01-01", "closed"),
         (None, "C", "A", 1.0, 3.5, 12, "2020-01-01", "2021-01-01", "closed")], LOANS)
    got = silver.stg_loans(raw).collect()
    assert len(got) == 1 and str(got[0].interest_rate) == "3.5556" and got[0].loan_status == "ACTIVE"


def card_feed(spark, *data):
    full = {f: None for f in CARD_TRANSACTIONS.fieldNames()}
    rows_ = [tuple({**full, "date": dt.datetime(2015, 1, 1), "use_chip": "Chip Transaction",
                    "client_id": 1, "card_id": 1, "mcc": 1, **d}[f]
                   for f in CARD_TRANSACTIONS.fieldNames()) for d in data]
    return spark.createDataFrame(rows_, CARD_TRANSACTIONS).withColumn("_batch_id", F.lit("b"))


def money_feed(spark, *data):
    base = dict(step=1, type="PAYMENT", amount=5.0, nameOrig="C1", oldbalanceOrg=9.0,
                newbalanceOrig=4.0, nameDest="M1", oldbalanceDest=0.0, newbalanceDest=5.0,
                isFraud=0, isFlaggedFraud=0)
    rows_ = [tuple({**base, **d}[f] for f in MONEY_TRANSACTIONS.fieldNames()) for d in data]
    return spark.createDataFrame(rows_, MONEY_TRANSACTIONS).withColumn("_batch_id", F.lit("b"))


def test_unified_fact(spark):
    card = card_feed(spark, {"id": 1, "amount": "$10.00", "merchant_id": 7},
                     {"id": 2, "amount": "$-3.50", "merchant_id": None, "mcc": 99},
                     {"id": 3, "amount": "$1.00", "merchant_id": 7, "card_id": 55})
    labels = spark.createDataFrame([(1, "Yes"), (3, "No")], "transaction_id bigint, fraud_label string")
    mcc = spark.createDataFrame([(1, "Grocery")], "mcc int, mcc_category string")
    users = spark.createDataFrame(
        [(i, 30, 65, "F", "x", "$1.00", "$2.00", "$3.00", 700, 1) for i in (1, 4, 9)],
        "id bigint, current_age int, retirement_age int, gender string, address string, "
        "per_capita_income string, yearly_income string, total_debt string, credit_score int, "
        "num_credit_cards int")
    cards = spark.createDataFrame(
        [(1, 1, "V", "D", "YES", 1, "$10.00", "No")],
        "id bigint, client_id bigint, card_brand string, card_type string, has_chip string, "
        "num_cards_issued int, credit_limit string, card_on_dark_web string")
    money = money_feed(spark, {}, {}, {"type": "TRANSFER", "amount": 300000.0, "nameDest": "C2"})
    h, m = channels.harmonize_card(card, labels, mcc), channels.harmonize_money(money, users)
    assert h.schema.fieldNames() == m.schema.fieldNames() and len(h.columns) == 19
    u = channels.unify(h, m, dimensions.dim_channel(spark), dimensions.dim_customer_master(users),
                       dimensions.dim_card(cards), dimensions.dim_merchant(card, mcc),
                       dimensions.dim_date(spark))
    got = {r.transaction_id: r for r in u.collect()}
    assert len(got) == 6  # equal money rows got different ids
    assert got["CARD-1"].is_fraud is True and got["CARD-1"].merchant_key is not None
    assert got["CARD-2"].is_fraud is None and got["CARD-2"].is_fraud_labeled is False
    assert (got["CARD-2"].transaction_type, got["CARD-2"].merchant_category) == ("REFUND", "UNKNOWN")
    assert got["CARD-3"].card_key is None and got["CARD-3"].is_fraud is False
    money_rows = [r for i, r in got.items() if i.startswith("MM-")]
    assert all(r.customer_key and r.card_key is None and r.date_key for r in money_rows)
    assert [r.is_high_risk for r in money_rows].count(True) == 1
    summary = {r.channel: r for r in reports.channel_summary(u, dimensions.dim_channel(spark)).collect()}
    assert summary["TOTAL"].transactions == 6 and summary["TOTAL"].amount is None
    assert summary["CARD"].fraud_pct == 33.333 and summary["CARD"].fraud_pct_labelled == 50.0


def test_merchant_minima_may_not_occur_together(spark):
    card = card_feed(spark, {"id": 1, "amount": "$1.00", "merchant_id": 7, "mcc": 1,
                             "merchant_city": "Z", "merchant_state": "Z"},
                     {"id": 2, "amount": "$1.00", "merchant_id": 7, "mcc": 2,
                      "merchant_city": "A", "merchant_state": "A"})
    mcc = spark.createDataFrame([(1, "x")], "mcc int, mcc_category string")
    loose, tight = (dimensions.dim_merchant(card, mcc, consistent=c).first() for c in (False, True))
    assert (loose.mcc, loose.merchant_city) == (1, "A")
    assert (tight.mcc, tight.merchant_city) == (1, "Z")


def test_content_ids_survive_a_reload(spark, rows):
    feed = money_feed(spark, {}, {}, {"step": 2})
    first = rows(channels.money_ids(feed), "row_id")
    assert first == rows(channels.money_ids(feed.repartition(3)), "row_id")
    assert len(set(first)) == 3
    mapped = map_feed(feed)
    assert mapped.columns == TRANSACTIONS.fieldNames()
    assert rows(mapped) == rows(map_feed(feed.repartition(2)))
    assert map_feed(feed, sample_rows=2).count() == 2


@pytest.mark.parametrize("limit", [10**6, 700])
def test_pool_is_numbered_in_key_order(spark, limit):
    pool = spark.range(0, 9000, 3).toDF("id").repartition(5)
    got = [(r.id, r.rn) for r in channels.number_pool(pool, "id", limit).orderBy("rn").collect()]
    assert got == [(3 * i, i + 1) for i in range(3000)]


def test_entity_bucket_of_an_empty_pool(spark):
    names = spark.createDataFrame([("a",)], "name string")
    pool = spark.createDataFrame([], "id bigint")
    assert channels.entity_bucket(names, "name", pool, "id", "who").first().who is None


def test_lookup_keeps_rows_and_matches_keys(spark, rows):
    fact = spark.createDataFrame([(i, None if i % 3 else f"k{i % 4}") for i in range(60)],
                                 "id int, k string")
    dim = spark.createDataFrame([("k0", "zero"), ("k1", "one"), ("", "empty"), (None, "none")],
                                "d string, name string")
    plain = fact.join(dim, fact.k == dim.d, "left").drop("d")
    assert rows(lookup(fact, dim, "k", "d", "id")) == rows(plain)


def test_hot_and_null_keys_are_split(spark):
    """Without broadcast, half of the rows on one key, a quarter on NULL."""
    settings_ = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                 "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                 "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
                 "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                 "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
                 "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
                 "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k, None) for k in settings_}
    try:
        for k, v in settings_.items():
            spark.conf.set(k, v)
        n = F.col("id") % 4
        key = F.when(n < 2, F.lit("hot")).when(n == 2, F.col("id").cast("string"))
        fact = spark.range(0, 200_000, 1, 8).withColumn("k", key).withColumn("p", F.md5(F.col("id").cast("string")))
        versions = spark.range(50_000).selectExpr("if(id = 1, 'hot', cast(id as string)) as d",
                                                  "timestamp_ntz'2024-01-01 00:00:00' as t")
        dim = dimensions.scd2(versions, "d", "t").select(F.col("customer_natural_key").alias("d"), "customer_key")
        joined = lookup(fact, dim, "k", "d", "id")
        result = joined.agg(F.count("customer_key"), F.max(F.xxhash64("p", "id", "k")))
        assert result.collect()[0][0] == 100_000 + 12_500
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_measured_bytes_grows_with_text(spark):
    short = spark.createDataFrame([("a",)] * 3, "s string")
    long = spark.createDataFrame([("a" * 1000,)] * 3, "s string")
    assert measured_bytes(long) - measured_bytes(short) == 3 * 999


def test_a_large_pool_has_no_more_ranges_than_partitions(spark):
    numbered = channels.number_pool(spark.range(1000).select((F.col("id") * 7).alias("id")), "id", 2)
    assert len(set(numbered.inputFiles())) <= 4
    assert [(r.id, r.rn) for r in numbered.orderBy("rn").collect()] == [(i * 7, i + 1) for i in range(1000)]
