"""Every registered query: operators of the package over tables derived from the given ones."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from fixtures import adapter
from tidemark.contracts import CONTRACTS, CUSTOMERS, FEEDS
from tidemark.functions import MONEY, clean_code
from tidemark.operators import channels, dedup, dimensions, facts, incremental, lookup, scd2, silver
from tidemark.plans import channels as channel_run
from tidemark.plans import pipeline, reports
from tidemark.quality import rules as quality
from tidemark.quality import suites
from tidemark.quality.state import RuleState
from tidemark.session import keep_correct, scratch_dir
from tidemark.sources import drift, feed_mapping, landing, readers
from tidemark.sources.versioned import VersionedTable, bring_up_to_date
from tidemark.streaming import jobs

AS_OF = "2024-01-01"          # date at which account ages are taken
REPORT_DAY = "2001-08-01"     # last day of the order feed
CUT = "2000-01-01 00:00:00"   # what came before is the stored history, the rest is the increment
CALENDAR = ("1996-01-01", "2024-12-31")  # leaves the first year without a date key


class Star:
    """Lazy models over one scale factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return adapter(self.spark, self.dir, name)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def transactions(self) -> DataFrame:
        return silver.stg_transactions(self.raw("txn"))

    @cached_property
    def customers(self) -> DataFrame:
        return silver.stg_customers(self.raw("cust_v"))

    @cached_property
    def accounts(self) -> DataFrame:
        return silver.stg_accounts(self.raw("acct"))

    @cached_property
    def dim_customer(self) -> DataFrame:
        return dimensions.dim_customer(self.customers)

    @cached_property
    def dim_account(self) -> DataFrame:
        return dimensions.dim_account(self.accounts, AS_OF)

    @cached_property
    def dim_product(self) -> DataFrame:
        return dimensions.dim_product(self.accounts)

    def build_fact(self, transactions: DataFrame) -> DataFrame:
        return facts.fact_transactions(transactions, self.dim_customer, self.dim_account,
                                       self.dim_product)

    @cached_property
    def fact(self) -> DataFrame:
        return self.build_fact(self.transactions)

    @cached_property
    def alerts(self) -> DataFrame:
        return facts.fact_fraud_alerts(self.fact)

    @cached_property
    def daily(self) -> DataFrame:
        return reports.daily_volume(self.fact)

    @cached_property
    def card(self) -> DataFrame:
        return channels.harmonize_card(self.raw("card"), self.raw("labels"), self.raw("mcc"))

    @cached_property
    def money(self) -> DataFrame:
        return channels.harmonize_money(self.raw("money"), self.raw("users"))

    @cached_property
    def dim_merchant(self) -> DataFrame:
        return dimensions.dim_merchant(self.raw("card"), self.raw("mcc"))

    @cached_property
    def unified(self) -> DataFrame:
        return channels.unify(
            self.card, self.money, dimensions.dim_channel(self.spark),
            dimensions.dim_customer_master(self.raw("users")),
            dimensions.dim_card(self.raw("cards")), self.dim_merchant,
            dimensions.dim_date(self.spark, *CALENDAR))


def portable(df: DataFrame) -> DataFrame:
    """Types both engines print alike: decimals as double, dates and timestamps as text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(f.dataType, T.IntegerType):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


CATALOG: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(make: Callable[[Star], DataFrame]) -> Callable[[Star], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        keep_correct(spark)
        return portable(make(Star(spark, sf_dir)))
    CATALOG[make.__name__] = run
    return make


# --- silver -----------------------------------------------------------------------------

@query
def stg_transactions(s):
    return s.transactions


@query
def stg_customers(s):
    return s.customers


@query
def stg_accounts(s):
    return s.accounts


@query
def stg_loans(s):
    return silver.stg_loans(s.raw("loans"))


@query
def map_feed(s):
    return feed_mapping.map_feed(s.raw("money"))


# --- history ----------------------------------------------------------------------------

@query
def dim_customer_scd2(s):
    return s.dim_customer


@query
def dim_customer_scd2_dense(s):
    """Many versions of few keys, some keys treated as hot and cut by day."""
    versions = s.raw("cust_events")
    return scd2.scd2(versions, "customer_id", "updated_at", hot_rows=50)


@query
def scd2_current(s):
    return scd2.scd2_current(s.dim_customer)


@query
def scd2_as_of(s):
    return scd2.scd2_as_of(s.dim_customer, "1998-01-01 00:10:00")


def _segment_at(s, strategy, hot_rows=None):
    facts_ = s.transactions.select("transaction_id", "customer_id", "created_at", "amount")
    return scd2.scd2_asof_join(facts_, s.dim_customer, "customer_id", "created_at",
                               ["customer_key", "segment"], strategy=strategy, hot_rows=hot_rows)


@query
def scd2_asof_join(s):
    return _segment_at(s, "search")


@query
def scd2_asof_join_merge(s):
    """The route for large dimensions, with hot keys cut by day."""
    return _segment_at(s, "merge", hot_rows=10)


def _damaged(s):
    """History in which every customer of one segment has a second row that starts too early."""
    dim = s.dim_customer
    early = (dim.where(F.col("segment") == "CORPORATE")
             .withColumn("customer_key", F.md5(F.concat("customer_key", F.lit("x"))))
             .withColumn("valid_from", F.col("valid_from") - F.expr("INTERVAL 30 DAYS"))
             .withColumn("valid_to", F.col("valid_from") + F.expr("INTERVAL 400 DAYS")))
    return dim.unionByName(early)


@query
def scd2_overlaps(s):
    return scd2.scd2_overlaps(_damaged(s))


@query
def scd2_overlapping(s):
    return scd2.scd2_overlapping(_damaged(s))


def _damaged_at(s, strategy, hot_rows=None):
    facts_ = s.transactions.select("transaction_id", "customer_id", "created_at")
    return scd2.scd2_asof_join(facts_, _damaged(s), "customer_id", "created_at",
                               ["customer_key", "segment"], strategy=strategy, hot_rows=hot_rows)


@query
def scd2_asof_damaged_search(s):
    return _damaged_at(s, "search")


@query
def scd2_asof_damaged_merge(s):
    return _damaged_at(s, "merge", hot_rows=10)


@query
def multi_version_customers(s):
    return scd2.multi_version_keys(s.customers, "customer_id")


@query
def customer_latest(s):
    return dedup.dedup_latest(s.table("orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query
def dedup_latest(s):
    lines = s.table("lineitem")
    rest = [c for c in lines.columns if c not in ("l_orderkey", "l_linenumber", "l_shipdate")]
    return dedup.dedup_latest(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate", *rest])


# --- core star --------------------------------------------------------------------------

@query
def customer_accounts(s):
    return dimensions.customer_accounts(s.customers, s.accounts)


@query
def dim_account(s):
    return s.dim_account


@query
def dim_product(s):
    return dimensions.dim_product(silver.stg_accounts(s.raw("acct_brand")))


@query
def fact_transactions(s):
    return s.fact


@query
def fact_fraud_alerts(s):
    return s.alerts


# --- reports ----------------------------------------------------------------------------

@query
def daily_volume(s):
    return s.daily


@query
def daily_volume_30d(s):
    return reports.daily_volume(s.fact, REPORT_DAY, 30)


@query
def kpis(s):
    return reports.kpis(s.fact)


@query
def type_totals(s):
    return reports.type_totals(s.daily)


@query
def fraud_rate_by_type(s):
    return reports.fraud_rate_by_type(s.daily)


@query
def type_rollup(s):
    return reports.type_rollup(s.fact)


@query
def daily_pivot(s):
    return reports.daily_pivot(s.daily)


@query
def segment_share(s):
    return reports.segment_share(s.dim_customer)


@query
def kyc_status(s):
    return reports.kyc_status(s.customers)


@query
def outcome_matrix(s):
    return reports.outcome_matrix(s.alerts)


@query
def missed_fraud_value(s):
    return reports.fraud_values(s.alerts)


@query
def high_value_misses(s):
    return reports.missed_fraud(s.alerts, above=100_000).select(
        "transaction_id", "transaction_type", "amount", "transaction_date")


@query
def detection_rates(s):
    return reports.detection_rates(s.alerts)


@query
def fraud_by_type(s):
    return reports.fraud_by_type(s.alerts)


@query
def feed_profile(s):
    return reports.feed_profile(s.transactions)


@query
def type_share(s):
    return reports.type_share(s.transactions)


@query
def table_counts(s):
    return reports.table_counts(transactions=s.raw("txn"), customers=s.raw("cust_v"),
                                accounts=s.raw("acct"), loans=s.raw("loans"),
                                card_transactions=s.raw("card"), money_transactions=s.raw("money"))


@query
def batch_audit(s):
    return reports.batch_audit(s.raw("txn"))


@query
def batch_rows(s):
    return reports.batch_rows(s.raw("txn"), "batch_3").select(
        "transaction_id", "amount", "_loaded_at", "_source_file", "_batch_id")


@query
def exact_sample(s):
    return dedup.exact_sample(s.raw("txn"), 1000, "transaction_id").select(
        "transaction_id", "customer_id", "amount")


# --- two channels -----------------------------------------------------------------------

@query
def harmonize_card(s):
    return s.card


@query
def harmonize_money(s):
    return s.money


@query
def entity_bucket(s):
    """Senders mapped onto the customer master, the master numbered in groups."""
    senders = s.raw("money").groupBy("nameOrig").agg(F.count(F.lit(1)).alias("rows"))
    users = s.raw("users")
    numbered = channels.number_pool(users, "id", one_task_rows=50)
    bucketed = channels.entity_bucket(senders, "nameOrig", users, "id", "client_id")
    return bucketed.join(numbered.withColumnRenamed("id", "client_id"), "client_id")


@query
def unified_transactions(s):
    return s.unified


@query
def channel_summary(s):
    return reports.channel_summary(s.unified, dimensions.dim_channel(s.spark))


@query
def dim_merchant(s):
    return s.dim_merchant


@query
def dim_merchant_consistent(s):
    return dimensions.dim_merchant(s.raw("card"), s.raw("mcc"), consistent=True)


@query
def dim_date(s):
    """A calendar over all days of both channels, with the rows that fall on each day."""
    card, money = s.raw("card"), s.money
    span = channels.calendar_of(s.spark, (card, "date"), (money, "txn_date"))
    days = dimensions.dim_date(s.spark, *span)
    both = (card.select(F.to_date("date").alias("date_key"))
            .unionByName(money.select(F.col("txn_date").alias("date_key"))))
    activity = both.groupBy("date_key").agg(F.count(F.lit(1)).alias("transactions"))
    return days.join(activity, "date_key", "left")


@query
def dim_card(s):
    return dimensions.dim_card(s.raw("cards"))


@query
def dim_customer_master(s):
    return dimensions.dim_customer_master(s.raw("users"))


@query
def dim_channel(s):
    """The channels with the rows each brings."""
    rows = s.unified.groupBy("channel").agg(F.count(F.lit(1)).alias("transactions"))
    return dimensions.dim_channel(s.spark).join(rows, "channel", "left")


@query
def fk_orphans(s):
    keys = [("account", s.transactions, s.dim_account, "account_id", "account_natural_key"),
            ("customer", s.transactions, scd2.scd2_current(s.dim_customer), "customer_id", "customer_natural_key"),
            ("owner", s.accounts, scd2.scd2_current(s.dim_customer), "customer_id", "customer_natural_key"),
            ("product", s.accounts, dimensions.dim_product(s.accounts), "product_id", "product_natural_key")]
    found = [lookup.orphans(rows, dim, key, dim_key).select(F.lit(name).alias("dimension"), "orphan_key", "fact_rows")
             for name, rows, dim, key, dim_key in keys]
    return reduce(DataFrame.unionByName, found)


@query
def dq_relationships(s):
    """All foreign keys of the stars against the tables they point to, one pass over each fact."""
    current = scd2.scd2_current(s.dim_customer)
    both = s.card.unionByName(s.money)
    dates = dimensions.dim_date(s.spark, *CALENDAR)
    return reduce(DataFrame.unionByName, [
        lookup.broken_references(s.transactions, {"account": ("account_id", s.dim_account, "account_natural_key"),
                                                  "customer": ("customer_id", current, "customer_natural_key")}),
        lookup.broken_references(s.accounts, {"owner": ("customer_id", current, "customer_natural_key"),
                                              "product": ("product_id", s.dim_product, "product_natural_key")}),
        lookup.broken_references(both, {"card": ("card_id", dimensions.dim_card(s.raw("cards")), "card_natural_key"),
                                        "merchant": ("merchant_id", s.dim_merchant, "merchant_natural_key"),
                                        "channel": ("channel", dimensions.dim_channel(s.spark), "channel"),
                                        "date": ("txn_date", dates, "date_key"),
                                        "customer_master": ("customer_natural_key", dimensions.dim_customer_master(s.raw("users")), "customer_natural_key")})])


# --- quality ----------------------------------------------------------------------------

ID_PATTERN = r"^T\d+$"
WIDE_CUSTOMER = r"^CUST\d+$"
# Ids of the given tables (FIXTURES.md): what is longer, as the accounts without a partner, breaks the rule.
GIVEN_ACCOUNT = r"^ACC\d{1,5}$"
GIVEN_CUSTOMER = r"^CUST\d{1,5}$"


def transaction_suite(account_pattern=GIVEN_ACCOUNT, customer_pattern=GIVEN_CUSTOMER):
    return suites.bronze_transactions(ID_PATTERN, account_pattern, customer_pattern)


@query
def dq_bronze_transactions(s):
    return quality.evaluate(s.raw("txn"), "bronze_transactions", transaction_suite())


@query
def dq_customers(s):
    return quality.evaluate(s.raw("cust_v"), "bronze_customers",
                            suites.bronze_customers(WIDE_CUSTOMER))


@query
def dq_silver_transactions(s):
    return quality.evaluate(s.transactions, "silver_transactions", suites.silver_transactions())


@query
def dq_suite_summary(s):
    return quality.suite_summary(suites.run_suites({
        "bronze_transactions": (s.raw("txn"), transaction_suite()),
        "bronze_customers": (s.raw("cust_v"), suites.bronze_customers(GIVEN_CUSTOMER)),
        "silver_transactions": (s.transactions, suites.silver_transactions())}, CUT))


@query
def dq_violations(s):
    return quality.fact_violations(s.raw("txn"), "transaction_id", transaction_suite_rows())


def transaction_suite_rows():
    return [r for r in transaction_suite(suites.ACCOUNT_PATTERN, WIDE_CUSTOMER)
            if r.kind in ("not_null", "in_set", "between", "matches")]


@query
def dq_duplicate_keys(s):
    lines = s.table("lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_key"), "l_partkey", "l_suppkey")
    return quality.violations(lines, quality.Rule("unique", "line_key"))


def _day_suite() -> list[quality.Rule]:
    return [*transaction_suite(suites.ACCOUNT_PATTERN, WIDE_CUSTOMER), quality.Rule("max_share", "transaction_type", {"max": 0.5}),
            quality.Rule("fresh", "created_at", {"as_of": REPORT_DAY, "max_age_days": 3})]


def _kept_state(s) -> RuleState:
    state = RuleState(s.spark, scratch_dir(s.spark, "rule-state"), "bronze_transactions", _day_suite())
    for day in range(5):
        state.add(s.raw("txn").where(F.col("_batch_id") == f"batch_{day}"), f"batch_{day}")
    return state


@query
def dq_merged_state(s):
    """Five batches, each read once: the merged state gives the verdict on all rows."""
    return _kept_state(s).results()


@query
def dq_merged_state_redelivered(s):
    """Two batches come again: one as it was, one with what two others hold; each replaces what it had brought."""
    state, txn = _kept_state(s), s.raw("txn")
    state.add(txn.where(F.col("_batch_id") == "batch_1"), "batch_1")
    state.add(txn.where(F.col("_batch_id").isin("batch_2", "batch_4")), "batch_2")
    return state.results()


@query
def dq_freshness(s):
    return quality.evaluate(s.transactions, "freshness", [
        quality.Rule("fresh", "created_at", {"as_of": "2001-08-03 00:00:00", "max_age_days": 7}),
        quality.Rule("fresh", "created_at", {"as_of": "2001-09-03 00:00:00", "max_age_days": 7}),
        quality.Rule("max_share", "transaction_type", {"max": 0.5}),
        quality.Rule("max_share", "transaction_type", {"max": 0.1})])


@query
def dq_latest_status(s):
    first = suites.run_suites({
        "bronze_transactions": (s.raw("txn"), transaction_suite(suites.ACCOUNT_PATTERN)),
        "bronze_customers": (s.raw("cust_v"), suites.bronze_customers(GIVEN_CUSTOMER))},
        "2024-01-01 06:00:00")
    second = suites.run_suites(
        {"bronze_transactions": (s.raw("txn"), transaction_suite())}, "2024-01-02 06:00:00")
    return suites.latest_status(first.unionByName(second), list(CONTRACT_SUITES))


CONTRACT_SUITES = ("bronze_transactions", "bronze_customers", "silver_transactions")


@query
def negative_amounts(s):
    return suites.negative_amounts(s.card)


@query
def drift_report(s):
    """The transaction feed after an upstream change: one column dropped, one added, two as text."""
    raw = s.raw("txn")
    amount = F.when(F.col("transaction_type") == "DEBIT", F.lit("n/a")) \
              .otherwise(F.col("amount").cast("string"))
    changed = (raw.drop("currency").withColumn("channel_hint", F.col("merchant_category"))
               .withColumn("amount", amount)
               .withColumn("is_fraud", F.col("is_fraud").cast("string"))
               .withColumn("is_flagged_fraud", F.col("is_flagged_fraud").cast("bigint"))
               .withColumn("transaction_date", F.col("transaction_date").cast("string"))
               .withColumn("created_at", F.col("created_at").cast("string")))
    return drift.drift_report(changed, "transactions")


# --- incremental ------------------------------------------------------------------------

def _stored_fact(s, path, source, **options):
    incremental.incremental(
        s.spark, path, source,
        lambda t: incremental.by_month(s.build_fact(t), "transaction_date"),
        "transaction_id", "created_at", "transaction_month", **options)
    return s.spark.read.parquet(path)


@query
def incremental_fact(s):
    """History stored first, then one increment over the whole source."""
    path = scratch_dir(s.spark, "incremental_fact")
    history = s.transactions.where(F.col("created_at") < F.lit(CUT).cast("timestamp_ntz"))
    _stored_fact(s, path, history)
    return _stored_fact(s, path, s.transactions).drop("transaction_month")


@query
def incremental_late_rows(s):
    """One batch arrives after newer rows were stored; the lateness window picks it up."""
    path = scratch_dir(s.spark, "late_rows")
    _stored_fact(s, path, s.transactions.where(F.col("_batch_id") != "batch_4"))
    return _stored_fact(s, path, s.transactions, lateness="4000 days").drop("transaction_month")


@query
def incremental_vs_full(s):
    path = scratch_dir(s.spark, "versus")
    history = s.transactions.where(F.col("created_at") < F.lit(CUT).cast("timestamp_ntz"))
    _stored_fact(s, path, history)
    stored = _stored_fact(s, path, s.transactions).drop("transaction_month")
    differing = incremental.differences(stored, s.fact).agg(F.count(F.lit(1)).alias("differing"))
    counts = reports.table_counts(incremental=stored, full=s.fact)
    pairs = counts.groupBy().pivot("table_name", ["incremental", "full"]).agg(F.sum("row_count"))
    return pairs.select("incremental", "full", F.lit(differing.first()[0]).alias("differing"))


@query
def upsert_corrections(s):
    """Corrected rows change amount and month; the old version disappears from its month."""
    path = scratch_dir(s.spark, "corrections")
    columns = ["transaction_id", "amount", "transaction_type", "transaction_date", "created_at"]
    base = incremental.by_month(s.transactions.select(*columns), "transaction_date")
    incremental.upsert(s.spark, path, base, "transaction_id", "transaction_month", ["created_at"])
    wrong = s.transactions.where(F.col("transaction_type") == "CASH_OUT").select(*columns)
    fixed = (wrong.withColumn("amount", (F.col("amount") + 1).cast(MONEY))
             .withColumn("transaction_date", F.date_add("transaction_date", 45))
             .withColumn("created_at", F.col("created_at") + F.expr("INTERVAL 45 DAYS")))
    # Each correction is delivered twice, the outdated delivery must not win.
    delivered = fixed.unionByName(wrong)
    incremental.upsert(s.spark, path, incremental.by_month(delivered, "transaction_date"),
                       "transaction_id", "transaction_month", ["created_at"])
    return s.spark.read.parquet(path)


@query
def full_refresh(s):
    """A stored history is replaced whole, after an increment has been added to it."""
    path = scratch_dir(s.spark, "full_refresh")
    _stored_fact(s, path, s.transactions.where(F.col("created_at") < F.lit(CUT).cast("timestamp_ntz")))
    _stored_fact(s, path, s.transactions)
    return _stored_fact(s, path, s.transactions, full_refresh=True).drop("transaction_month")


@query
def upsert_out_of_order(s):
    """Each correction comes in a batch before the row it corrects: the older delivery must not win."""
    path = scratch_dir(s.spark, "out_of_order")
    columns = ["transaction_id", "amount", "transaction_type", "transaction_date", "created_at"]
    base = s.transactions.select(*columns)
    later = (base.where(F.col("transaction_type") == "CASH_OUT")
             .withColumn("amount", (F.col("amount") + 1).cast(MONEY))
             .withColumn("transaction_date", F.date_add("transaction_date", 45))
             .withColumn("created_at", F.col("created_at") + F.expr("INTERVAL 45 DAYS")))
    for batch in (later, base, later.unionByName(base)):
        incremental.upsert(s.spark, path, incremental.by_month(batch, "transaction_date"),
                           "transaction_id", "transaction_month", ["created_at"])
    return s.spark.read.parquet(path)


@query
def upsert_null_and_repeated_keys(s):
    """Debits lose their key: all of them stay, and a batch delivered again adds nothing."""
    path = scratch_dir(s.spark, "null_keys")
    lost = F.when(F.col("transaction_type") != "DEBIT", F.col("transaction_id"))
    base = incremental.by_month(s.transactions.select(
        lost.alias("transaction_id"), "account_id", "transaction_date", "created_at"), "transaction_date")
    for batch in (base, base.unionByName(base)):
        incremental.upsert(s.spark, path, batch, "transaction_id", "transaction_month", ["created_at"])
    return s.spark.read.parquet(path)


def _versioned(s, name, key="transaction_id", ts="created_at"):
    return VersionedTable(s.spark, scratch_dir(s.spark, name), key, ts, "transaction_month")


def _applied(s, table, source, **options):
    return bring_up_to_date(table, source, lambda t: incremental.by_month(s.build_fact(t), "transaction_date"), **options)


@query
def incremental_ledger(s):
    """Batches come one after another, an old one last; the ledger finds it without a lateness window."""
    table = _versioned(s, "ledger")
    for batches in (["batch_0", "batch_2"], ["batch_0", "batch_2", "batch_3", "batch_4"], None):
        _applied(s, table, s.transactions if batches is None else s.transactions.where(F.col("_batch_id").isin(batches)))
    return table.read().drop("transaction_month")


@query
def incremental_by_mark(s):
    """No ledger: rows beyond the mark that the last version holds."""
    table = _versioned(s, "mark")
    _applied(s, table, s.transactions.where(F.col("created_at") < F.lit(CUT).cast("timestamp_ntz")), batch=None)
    _applied(s, table, s.transactions, batch=None)
    return table.read().drop("transaction_month")


@query
def versions_read_back(s):
    """An older version is read after a newer one was published."""
    table = _versioned(s, "versions")
    for source in (s.transactions.where(F.col("_batch_id") == "batch_1"), s.transactions):
        _applied(s, table, source)
    seen = [table.read(n).select(F.lit(n).alias("version"), "transaction_id", "amount") for n in table.versions()]
    return seen[0].unionByName(seen[1])


@query
def upsert_key_index(s):
    """Corrections are merged into the files that hold their keys; amount and month change."""
    table = _versioned(s, "key_index")
    columns = ["transaction_id", "amount", "transaction_type", "transaction_date", "created_at"]
    base = s.transactions.select(*columns)
    table.replace(incremental.by_month(base, "transaction_date"))
    wrong = base.where(F.col("transaction_type") == "CASH_OUT")
    fixed = (wrong.withColumn("amount", (F.col("amount") + 1).cast(MONEY))
             .withColumn("transaction_date", F.date_add("transaction_date", 45))
             .withColumn("created_at", F.col("created_at") + F.expr("INTERVAL 45 DAYS")))
    table.merge(incremental.by_month(fixed.unionByName(wrong), "transaction_date"))
    return table.read()


@query
def incremental_unified(s):
    """The unified fact in two increments, each with a batch of both channels."""
    card = s.raw("card").withColumn("_batch_id", F.when(F.col("date") < F.lit(CUT).cast("date"), "b0").otherwise("b1"))
    money = s.raw("money").withColumn("_batch_id", F.when(F.col("step") < 360, "b0").otherwise("b1"))
    dims = {"dim_channel": dimensions.dim_channel(s.spark), "dim_customer_master": dimensions.dim_customer_master(s.raw("users")),
            "dim_card": dimensions.dim_card(s.raw("cards")), "dim_merchant": s.dim_merchant,
            "dim_date": dimensions.dim_date(s.spark, *CALENDAR)}
    table, ledger = _versioned(s, "unified", ts="txn_timestamp"), scratch_dir(s.spark, "occurrences")
    for batches in (["b0"], ["b0", "b1"]):
        channel_run.update_unified(table, card.where(F.col("_batch_id").isin(batches)), money.where(F.col("_batch_id").isin(batches)),
                                   s.raw("labels"), s.raw("mcc"), s.raw("users"), dims, ledger)
    return table.read().drop("transaction_month", "_batch_id")


@query
def money_ids_over_batches(s):
    """A batch repeats half of the payments of an earlier one, which is then delivered again."""
    first = s.raw("money")
    second = first.where("step % 2 = 0").withColumn("_batch_id", F.lit("b1"))
    path = scratch_dir(s.spark, "money_ledger")
    for turn, feed in enumerate((first, second)):
        ledger = s.spark.read.parquet(path) if turn else None
        channels.occurrences(feed, turn, ledger).write.mode("append").partitionBy("_batch_id").parquet(path)
    ledger = s.spark.read.parquet(path)
    again = channels.money_ids(first, ledger).unionByName(channels.money_ids(second, ledger))
    return again.select("_batch_id", "row_id", "step", "nameOrig")


# --- whole runs -------------------------------------------------------------------------

def _csv_feed(s, name, contract, whole_ids=False):
    """A raw table as a CSV feed with the columns of its contract; what the given tables lack is empty."""
    folder, df = scratch_dir(s.spark, "csv"), adapter(s.spark, s.dir, name, whole_ids)
    text = [(F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None)).cast("string").alias(f.name) for f in contract.fields]
    df.select(*text).write.option("header", True).csv(folder)
    return folder


@query
def pipeline_run(s):
    """The core star from CSV feeds, in two daily runs: bronze, gates, silver, gold, tests."""
    feeds = {t: _csv_feed(s, n, CONTRACTS[t]) for t, n in (("transactions", "txn"), ("customers", "cust_v"), ("accounts", "acct"))}
    feeds["loans"] = _csv_feed(s, "loans", CONTRACTS["loans"], whole_ids=True)  # the run tests that they are unique
    rules = {"bronze_transactions": [quality.Rule("not_null", "transaction_id"), quality.Rule("unique", "transaction_id")],
             "bronze_customers": [quality.Rule("not_null", "customer_id")], "silver_transactions": [quality.Rule("between", "amount", {"min": 0})]}
    root = scratch_dir(s.spark, "lake")
    pipeline.run_pipeline(s.spark, root, feeds, AS_OF, "first", suites=rules)
    tables = pipeline.run_pipeline(s.spark, root, {"transactions": feeds["transactions"]}, AS_OF, "first", suites=rules)
    return tables["fact_transactions"].drop("transaction_month", "_batch_id")


LABELS_A_DOCUMENT = 1_000  # a document is one row of one task


def _labels_by_line(labels, most, folder):
    """The labels, ``most`` at most, as JSON documents by line: as many as keep them at LABELS_A_DOCUMENT each on average, 16 at least."""
    documents = max(16, -(-most // LABELS_A_DOCUMENT))
    pairs = F.map_from_entries(F.collect_list(F.struct(F.col("transaction_id").cast("string"), "fraud_label")))
    part = F.pmod(F.xxhash64("transaction_id"), F.lit(documents)).alias("part")
    labels.groupBy(part).agg(pairs.alias("target")).drop("part").write.json(folder)


@query
def channels_run(s):
    """The two-channel star from six raw feeds: four CSV feeds, labels and codes as JSON."""
    feeds = {t: _csv_feed(s, n, FEEDS[t]) for t, n in (("card_transactions", "card"), ("money_transactions", "money"), ("card_users", "users"), ("cards", "cards"))}
    feeds |= {n: scratch_dir(s.spark, n) for n in ("labels", "mcc")}
    _labels_by_line(s.raw("labels"), s.table("lineitem").count(), feeds["labels"])
    codes = F.map_from_entries(F.collect_list(F.struct(F.col("mcc").cast("string"), "mcc_category")))
    s.raw("mcc").agg(F.to_json(codes).alias("value")).write.text(feeds["mcc"])
    rules = {"card_transactions": [quality.Rule("not_null", "id")], "money_transactions": [quality.Rule("not_null", "step")]}
    tables = channel_run.run_channels(s.spark, scratch_dir(s.spark, "channels"), feeds, "b0", rules, CALENDAR, labels_by_line=True)
    return tables["fact_unified_transactions"].drop("transaction_month", "_batch_id")


# --- sources and sinks ------------------------------------------------------------------

def _customer_file(s):
    """Customer versions as a CSV feed with quoted commas."""
    folder = scratch_dir(s.spark, "feed")
    feed = s.raw("cust_v").withColumn("address", F.concat("address", F.lit(", Main \"St\" 1")))
    text = [F.col(f).cast("string").alias(f) for f in CUSTOMERS.fieldNames()]
    (feed.select(*text).write.option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(folder))
    return folder


@query
def load_bronze(s):
    root = scratch_dir(s.spark, "load")
    landing.load_bronze(s.spark, _customer_file(s), "customers", root, batch_id="20240101_060000",
                        loaded_at="2024-01-01T06:00:00")
    bronze = landing.read_layer(s.spark, root, "bronze", "customers")
    return silver.stg_customers(bronze).join(
        bronze.select("customer_id", F.col("updated_at").cast("timestamp_ntz"), "_loaded_at",
                      "_batch_id"), ["customer_id", "updated_at"])


@query
def load_bronze_many_files(s):
    """One feed in three kinds of files: columns in another order, compressed, and with line breaks in quotes."""
    folder, root = scratch_dir(s.spark, "many"), scratch_dir(s.spark, "load")
    feed = s.raw("cust_v").withColumn("address", F.concat(F.lit("1st\nline, "), "address"))
    names = CUSTOMERS.fieldNames()
    for i, (segment, order, compression) in enumerate(
            [("RETAIL", names, "none"), ("PREMIUM", names[::-1], "gzip"), ("CORPORATE", names[2:] + names[:2], "none")]):
        (feed.where(clean_code("segment") == segment).select(*[F.col(c).cast("string").alias(c) for c in order])
         .write.option("header", True).option("escape", '"').option("compression", compression)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{folder}/{i}"))
    landing.load_bronze(s.spark, f"{folder}/*", "customers", root, batch_id="20240101_060000",
                        loaded_at="2024-01-01T06:00:00", multi_line=True)
    bronze = landing.read_layer(s.spark, root, "bronze", "customers")
    return bronze.select("customer_id", "address", F.trim("segment").alias("segment"), "updated_at",
                         F.col("_source_file").endswith(".csv.gz").alias("compressed"), "_batch_id")


@query
def read_dirty_csv(s):
    """Rows of one segment lack their last two fields: they are padded, kept and flagged."""
    folder = scratch_dir(s.spark, "dirty")
    v = s.raw("cust_v")
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in CUSTOMERS.fieldNames()]
    quoted = [F.concat(F.lit('"'), f, F.lit(', x"')) if n == "address" else f
              for n, f in zip(CUSTOMERS.fieldNames(), fields)]
    short = clean_code("segment") == "CORPORATE"
    line = F.when(short, F.concat_ws(",", *quoted[:-2])).otherwise(F.concat_ws(",", *quoted))
    v.select(line.alias("value")).write.text(folder)
    read = readers.read_csv(s.spark, folder, CUSTOMERS, CUSTOMERS.fieldNames(), header=False,
                            name_filter="*.txt")
    return read.select("customer_id", "address", "segment", "created_at", "updated_at",
                       F.col(readers.CORRUPT).isNotNull().alias("flagged"))


@query
def read_json_map(s):
    folder = scratch_dir(s.spark, "codes")
    codes = s.raw("mcc").select(F.struct(F.col("mcc").cast("string").alias("k"),
                                         F.col("mcc_category").alias("v")).alias("e"))
    # The code list has one entry per part size, a fixed domain of 50 values.
    (codes.agg(F.to_json(F.map_from_entries(F.collect_list("e"))).alias("value"))
     .coalesce(1).write.text(folder))
    return readers.read_map_json(s.spark, folder, "mcc", "mcc_category")


@query
def read_multiline_csv(s):
    """Rows whose quoted fields hold line breaks, quotes and separators, cut into byte ranges and put together."""
    folder = scratch_dir(s.spark, "notes")
    note = F.concat(F.lit("said \"no\",\n"), F.regexp_replace("o_orderpriority", "[- ]", "\n"), F.lit("\n\"\n"))
    (s.table("orders").select(F.col("o_orderkey").cast("string").alias("id"), note.alias("note"), F.col("o_orderstatus").alias("status"))
     .write.option("header", True).option("escape", '"').option("ignoreTrailingWhiteSpace", False).csv(folder))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("note", T.StringType()),
                           T.StructField("status", T.StringType())])
    read = readers.read_csv(s.spark, folder, schema, multi_line=True)
    return read.select("id", "note", "status", F.col(readers.CORRUPT).isNotNull().alias("flagged"))


LABELS_PER_DOCUMENT = 5_000


def _label_documents(s) -> DataFrame:
    labels = s.raw("labels")
    documents = labels.count() // LABELS_PER_DOCUMENT + 1
    entry = F.struct(F.col("transaction_id").cast("string"), "fraud_label")
    return (labels.groupBy(F.pmod(F.xxhash64("transaction_id"), F.lit(documents)).alias("d"))
            .agg(F.to_json(F.struct(F.map_from_entries(F.collect_list(entry)).alias("target"))).alias("value")))


@query
def read_label_json(s):
    folder = scratch_dir(s.spark, "labels")
    _label_documents(s).select("value").write.text(folder)
    return readers.read_label_json(s.spark, folder, multi_line=False)


@query
def read_label_documents(s):
    """A file is one document; byte ranges of it are read apart."""
    folder = scratch_dir(s.spark, "documents")
    _label_documents(s).write.partitionBy("d").text(folder)
    return readers.read_label_json(s.spark, f"{folder}/*")


@query
def replace_and_append(s):
    """Two appended batches stay side by side, a replace leaves only its own batch."""
    path, kept = scratch_dir(s.spark, "append"), scratch_dir(s.spark, "replace")
    accounts, loans = s.raw("acct"), s.raw("acct_brand")
    at = "2024-01-01T06:00:00"
    for folder, second in ((path, "append"), (kept, "replace")):
        landing.write_bronze(landing.with_audit(accounts, "20240101_060000", at, "a.csv"), folder)
        landing.write_bronze(landing.with_audit(loans, "20240102_060000", at, "b.csv"), folder,
                             second)
    audit = lambda p: reports.batch_audit(s.spark.read.parquet(p))
    return (audit(path).withColumn("table_mode", F.lit("append"))
            .unionByName(audit(kept).withColumn("table_mode", F.lit("replace"))))


@query
def partition_pruned_archive(s):
    """Two days archived, one day read back and parsed."""
    root, feed = scratch_dir(s.spark, "archive"), _customer_file(s)
    landing.archive_raw(s.spark, feed, "customers", root, "2024-01-01")
    landing.archive_raw(s.spark, feed, "customers", root, "2024-01-02")
    lines = landing.read_archive(s.spark, root, "customers", "2024-01-02")
    parsed = lines.where(~F.col("value").startswith("customer_id,")).select(
        F.from_csv("value", CUSTOMERS.simpleString()[len("struct<"):-1].replace(":", " "),
                   {"escape": '"'}).alias("c"))
    return parsed.groupBy("c.segment").agg(F.count(F.lit(1)).alias("row_count"))


# --- streams ----------------------------------------------------------------------------

def _typed_events(batch):
    typed = batch.select("event_id", "user_id", clean_code("event_type").alias("event_type"),
                         F.col("value").cast(MONEY).alias("amount"), "ts", F.to_date("ts").alias("event_date"))
    return incremental.by_month(typed, "event_date", "event_month")


def _event_stream(s):
    return jobs.read_stream(s.spark, s.dir, s.table("events").schema,
                            name_filter="events.parquet")


@query
def stream_daily_volume(s):
    out = scratch_dir(s.spark, "windows")
    windows = jobs.daily_windows(_event_stream(s), "ts", "event_type", "value",
                                 F.col("event_type") == "error", "2 hours")
    jobs.stream_daily_volume(windows, out, scratch_dir(s.spark, "ckpt"),
                             "event_type").awaitTermination()
    return s.spark.read.parquet(out).drop("window_key")


@query
def stream_dedup(s):
    """Every event delivered twice."""
    out = scratch_dir(s.spark, "once")
    twice = _event_stream(s).unionByName(_event_stream(s))
    jobs.stream_dedup(twice, "event_id", "ts", "1 hour", out,
                      scratch_dir(s.spark, "ckpt")).awaitTermination()
    return s.spark.read.parquet(out).select("event_id", "ts", "user_id", "event_type", "value")


@query
def stream_upsert(s):
    out = scratch_dir(s.spark, "upserted")

    jobs.stream_upsert(_event_stream(s), _typed_events, out, scratch_dir(s.spark, "ckpt"), "event_id",
                       "event_month", ["ts"]).awaitTermination()
    return s.spark.read.parquet(out).drop("event_month")


@query
def stream_merge(s):
    """Events in several files, a micro-batch each; older versions of a third of them come in a file of their own, last."""
    feed, events = scratch_dir(s.spark, "events"), s.table("events")
    stale = events.where("event_id % 3 = 0").withColumns({"ts": F.col("ts") - F.expr("INTERVAL 1 DAY"), "value": F.col("value") + 1})
    for part in (events.where("event_id % 2 = 0"), events.where("event_id % 2 = 1"), stale):
        part.coalesce(1).write.mode("append").parquet(feed)
    table = VersionedTable(s.spark, scratch_dir(s.spark, "merged"), "event_id", "ts", "event_month")
    stream = jobs.read_stream(s.spark, feed, events.schema, files_per_trigger=1)
    jobs.stream_merge(stream, _typed_events, table, scratch_dir(s.spark, "ckpt")).awaitTermination()
    return table.read().drop("event_month")
