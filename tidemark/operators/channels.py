"""Two unlike payment systems conformed into one fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.session import scratch_dir
from tidemark.contracts import STEP_ZERO
from tidemark.functions import (MONEY, content_hash, deposit_category, entry_mode, is_high_risk,
                                parse_money, sign_type, stable_bucket, step_instant, typed_null)
from tidemark.operators.copies import COPY_CHUNK, expand_copies
from tidemark.operators.lookup import lookup, lookup_used, sent_if_small

ONE_TASK_ROWS = 100_000   # keys that one task numbers


def harmonize_card(transactions: DataFrame, labels: DataFrame, mcc: DataFrame, few: bool = False) -> DataFrame:
    """Card feed in the common schema.

    The label table is as large as the feed, so both are shuffled on the transaction id (or read
    from tables bucketed on it, see ``save_bucketed``). Unlabelled rows keep ``is_fraud`` NULL. With ``few`` the
    transactions are an increment: the labels are first reduced to their ids, by a semi-join that Spark can broadcast
    the ids for, so that the label table is read but not shuffled.
    """
    if few:
        labels = labels.join(transactions.select(F.col("id").alias("transaction_id")).distinct(), "transaction_id", "left_semi")
    verdict = labels.select(F.col("transaction_id").alias("id"), "fraud_label",
                            F.lit(True).alias("_labelled"))
    amount = parse_money("amount")
    return (transactions.join(verdict, "id", "left").join(sent_if_small(mcc), "mcc", "left").select(
        F.concat(F.lit("CARD-"), F.col("id").cast("string")).alias("transaction_id"),
        F.lit("CARD").alias("channel"),
        F.col("client_id").cast("bigint").alias("customer_natural_key"),
        F.col("card_id").cast("string").alias("card_id"),
        F.col("merchant_id").cast("string").alias("merchant_id"),
        F.col("mcc").cast("int").alias("mcc"),
        F.coalesce("mcc_category", F.lit("UNKNOWN")).alias("merchant_category"),
        sign_type(amount).alias("transaction_type"),
        entry_mode("use_chip").alias("entry_mode"),
        amount.alias("amount"), F.abs(amount).alias("abs_amount"),
        typed_null(MONEY).alias("balance_before"), typed_null(MONEY).alias("balance_after"),
        (F.col("fraud_label") == "Yes").alias("is_fraud"),
        typed_null("boolean").alias("is_flagged_fraud"),
        F.col("_labelled").isNotNull().alias("is_fraud_labeled"),
        F.col("date").cast("timestamp_ntz").alias("txn_timestamp"),
        F.col("date").cast("date").alias("txn_date"), "_batch_id",
    ))


_MONEY_AMOUNTS = ("amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest")
_MONEY_CONTENT = ("step", "type", "amount", "nameOrig", "oldbalanceOrg", "newbalanceOrig",
                  "nameDest", "oldbalanceDest", "newbalanceDest", "isFraud", "isFlaggedFraud")


def _counted(feed: DataFrame) -> DataFrame:
    """Distinct normalised mobile-money rows of each batch, their content hash and number of copies."""
    typed = feed.select(*[F.col(c).cast(MONEY).alias(c) if c in _MONEY_AMOUNTS else F.col(c)
                          for c in _MONEY_CONTENT], "_batch_id")
    return (typed.groupBy(*typed.columns).agg(F.count(F.lit(1)).alias("_copies"))
            .withColumn("_content", content_hash(*_MONEY_CONTENT)))


def _placed(counted: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """counted with ``_turn`` (when its batch was first numbered) and ``_before`` (copies of the content numbered earlier).

    A window over one content holds one row for each batch that brought it.
    """
    earlier = Window.partitionBy("_content").orderBy("_turn", "_batch_id").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_copies").over(earlier), F.lit(0))
    if ledger is None:
        return counted.withColumn("_turn", F.lit(0).cast("bigint")).withColumn("_before", before)
    held = ledger.select(F.col("content").alias("_c"), F.col("_batch_id").alias("_b"),
                         F.col("copies").alias("_n"), F.col("turn").alias("_t"))
    same = (F.col("_content") == F.col("_c")) & F.col("_batch_id").eqNullSafe(F.col("_b"))
    mine = (counted.join(held, same, "left").drop("_c", "_b", "_n")
            .withColumn("_turn", F.coalesce("_t", F.lit(1 << 62))).drop("_t")  # new batches come after all in the ledger
            .withColumn("_mine", F.lit(True)))
    brought = counted.select("_content", "_batch_id")
    others = (held.join(brought, same, "left_anti").join(brought, F.col("_content") == F.col("_c"), "left_semi")
              .select(F.col("_c").alias("_content"), F.col("_b").alias("_batch_id"), F.col("_n").alias("_copies"), F.col("_t").alias("_turn")))
    both = mine.unionByName(others, allowMissingColumns=True)
    return both.withColumn("_before", before).where("_mine").drop("_mine")


def money_ids(feed: DataFrame, ledger: DataFrame | None = None, chunk: int = COPY_CHUNK) -> DataFrame:
    """Normalised mobile-money rows with an id made from their content.

    The feed has no key. Equal rows get the same hash and are told apart by an occurrence number, which goes on over the
    batches: the same content in two batches is two payments. Batches that ``ledger`` (see :func:`occurrences`) knows
    keep their numbers, so that a batch delivered again has the ids it had, in whatever order batches came; new ones follow
    in the order of their ids. Without a ledger all batches count in the order of their ids.
    """
    placed = _placed(_counted(feed), ledger)
    return (expand_copies(placed, "_copies", "_copy", chunk)
            .withColumn("row_id", F.concat("_content", F.lit("-"), (F.col("_before") + F.col("_copy")).cast("string")))
            .select(*_MONEY_CONTENT, "_batch_id", "row_id"))


def occurrences(feed: DataFrame, turn: int, ledger: DataFrame | None = None) -> DataFrame:
    """Ledger rows (content, _batch_id, copies, turn) of a feed's batches; those known already keep their turn.

    ``turn`` must rise from one call to the next. Adding these rows to the ledger, a batch's in place of its old ones,
    before the ids are used makes a rerun give the same ids.
    """
    counted = _counted(feed).select(F.col("_content").alias("content"), "_batch_id", F.col("_copies").alias("copies"))
    if ledger is None:
        return counted.withColumn("turn", F.lit(turn).cast("bigint"))
    known = ledger.groupBy(F.col("_batch_id").alias("_b")).agg(F.min("turn").alias("_t"))
    return (counted.join(known, F.col("_batch_id").eqNullSafe(F.col("_b")), "left")
            .withColumn("turn", F.coalesce("_t", F.lit(turn).cast("bigint"))).drop("_b", "_t"))


def number_pool(pool: DataFrame, key: str, one_task_rows: int = ONE_TASK_ROWS,
                size: int | None = None) -> DataFrame:
    """(key, rn) with rn = 1..N in key order.

    Keys are dealt out by ranges of about ``one_task_rows`` keys, each range is numbered by itself and
    shifted by the number of keys before it: one way at every size, with as many ranges as the pool
    needs. Small ranges are for small pools: beyond the shuffle partitions there is one more for each ONE_TASK_ROWS keys,
    as the driver hears from every task and samples every range. The ranges are written once, so that counting and
    numbering see the same ones.
    """
    keys = pool.select(key)
    size = keys.count() if size is None else size
    path = scratch_dir(pool.sparkSession, "pool")
    most = max(int(pool.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // ONE_TASK_ROWS))
    (keys.repartitionByRange(max(1, min(most, -(-size // max(1, one_task_rows)))), key).sortWithinPartitions(key)
     .withColumn("_id", F.monotonically_increasing_id()).write.parquet(path))
    ranged = (pool.sparkSession.read.parquet(path)
              .select(key, F.shiftright("_id", 33).alias("_range"), F.col("_id").bitwiseAND((1 << 33) - 1).alias("_n")))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("n"))  # a row for each range
              .select(F.col("_range").alias("_r"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_shift")))
    return (ranged.join(shifts, F.col("_range") == F.col("_r"))
            .select(key, (F.col("_n") + F.col("_shift") + 1).cast("bigint").alias("rn")))


def entity_bucket(df: DataFrame, name: str, pool: DataFrame, key: str, out: str) -> DataFrame:
    """Map foreign ids onto a master deterministically: hash bucket n takes the n-th master key."""
    size = pool.count()
    if size == 0:
        kind = pool.schema[key].dataType
        return df.withColumn(out, F.lit(None).cast(kind))
    numbered = number_pool(pool, key, size=size).select(F.col(key).alias(out), "rn")
    return (df.withColumn("rn", stable_bucket(name, size)).join(numbered, "rn", "left").drop("rn"))


def harmonize_money(feed: DataFrame, users: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """Mobile-money feed in the common schema; senders are mapped onto the customer master."""
    mapped = entity_bucket(money_ids(feed, ledger), "nameOrig", users, "id", "_client")
    at = step_instant("step", STEP_ZERO)
    return mapped.select(
        F.concat(F.lit("MM-"), F.col("row_id")).alias("transaction_id"),
        F.lit("MOBILE_MONEY").alias("channel"),
        F.col("_client").cast("bigint").alias("customer_natural_key"),
        typed_null("string").alias("card_id"), typed_null("string").alias("merchant_id"),
        typed_null("int").alias("mcc"),
        deposit_category("nameDest").alias("merchant_category"),
        F.col("type").alias("transaction_type"), typed_null("string").alias("entry_mode"),
        "amount", F.abs("amount").alias("abs_amount"),
        F.col("oldbalanceOrg").alias("balance_before"),
        F.col("newbalanceOrig").alias("balance_after"),
        (F.col("isFraud") == 1).alias("is_fraud"),
        (F.col("isFlaggedFraud") == 1).alias("is_flagged_fraud"),
        F.lit(True).alias("is_fraud_labeled"),
        at.alias("txn_timestamp"), at.cast("date").alias("txn_date"), "_batch_id",
    )


def unify(card: DataFrame, money: DataFrame, channel: DataFrame, customer: DataFrame,
          cards: DataFrame, merchant: DataFrame, dates: DataFrame) -> DataFrame:
    """One fact over both channels.

    Mobile money has neither card nor merchant, so those two lookups run on the card rows only:
    its NULL keys are never shuffled into one task. Each lookup of the card rows measures which rows of the
    dimension they name: they are shuffled again only where these are many. No side is broadcast by a hint that
    does not rest on a measured size.
    """
    card_keys = cards.select(F.col("card_natural_key").cast("string").alias("_card"), "card_key")
    merchant_keys = merchant.select("merchant_natural_key", "merchant_key")
    customer_keys = customer.select(F.col("customer_natural_key").alias("_customer"),
                                    "customer_key")
    row = "transaction_id"
    customer_of_card = lookup_used(card, customer_keys, "customer_natural_key", "_customer", row)
    with_card = lookup_used(customer_of_card, card_keys, "card_id", "_card", row)
    with_card = lookup_used(with_card, merchant_keys, "merchant_id", "merchant_natural_key", row)
    both = with_card.unionByName(
        lookup(money, customer_keys, "customer_natural_key", "_customer", row)
        .select("*", typed_null("string").alias("card_key"), typed_null("string").alias("merchant_key")))
    u = (both.join(channel.select("channel", "channel_key"), "channel", "left")
         .join(sent_if_small(dates.select("date_key")), F.col("txn_date") == F.col("date_key"),
               "left"))
    return u.select(
        "transaction_id", "channel_key", "customer_key", "card_key", "merchant_key", "date_key",
        "channel", "transaction_type", "entry_mode", "merchant_category", "amount", "abs_amount",
        "balance_before", "balance_after",
        (F.col("balance_after") - F.col("balance_before")).alias("balance_delta"),
        "is_fraud", "is_flagged_fraud", "is_fraud_labeled",
        is_high_risk("transaction_type", "abs_amount").alias("is_high_risk"),
        "txn_timestamp", "txn_date", "_batch_id",
    )


def calendar_of(spark: SparkSession, *dated: tuple[DataFrame, str]) -> tuple[str, str]:
    """First and last day over several (table, date column), for a date dimension covering all."""
    spans = [df.agg(F.min(F.to_date(c)).alias("a"), F.max(F.to_date(c)).alias("b"))
             for df, c in dated]
    merged = spans[0]
    for s in spans[1:]:
        merged = merged.unionByName(s)
    row = merged.agg(F.min("a").alias("a"), F.max("b").alias("b")).first()
    return str(row["a"]), str(row["b"])
