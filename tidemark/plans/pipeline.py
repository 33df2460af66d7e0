"""The daily run: bronze, gate, silver, gate, gold, tests. An ordinary driver of Spark jobs."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import dimensions, facts, silver
from tidemark.operators.incremental import Folder, by_month
from tidemark.operators.lookup import broken_references
from tidemark.operators.scd2 import scd2_overlapping
from tidemark.quality.rules import Rule
from tidemark.quality.suites import (QualityGateError, bronze_customers, bronze_transactions,
                                     checkpoint, mislabelled_alerts, negative_amounts,
                                     silver_transactions, table_tests)
from tidemark.sources.landing import load_bronze, new_batch_id, read_layer, save_table, write_bronze
from tidemark.sources.versioned import VersionedTable, bring_up_to_date

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Model:
    """``build`` gets the tables it ``needs`` in order, plus ``as_of`` where ``dated``."""

    build: Callable[..., DataFrame]
    needs: tuple[str, ...]
    layer: str
    stored: bool = True
    dated: bool = False


# In dependency order.
MODELS: dict[str, Model] = {
    "stg_transactions": Model(silver.stg_transactions, ("transactions",), "silver", stored=False),
    "stg_customers": Model(silver.stg_customers, ("customers",), "silver", stored=False),
    "stg_accounts": Model(silver.stg_accounts, ("accounts",), "silver", stored=False),
    "stg_loans": Model(silver.stg_loans, ("loans",), "silver", stored=False),
    "int_customer_accounts": Model(dimensions.customer_accounts,
                                   ("stg_customers", "stg_accounts"), "silver"),
    "dim_customer": Model(dimensions.dim_customer, ("stg_customers",), "gold"),
    "dim_account": Model(dimensions.dim_account, ("stg_accounts",), "gold", dated=True),
    "dim_product": Model(dimensions.dim_product, ("stg_accounts",), "gold"),
    "fact_transactions": Model(facts.fact_transactions,
                               ("stg_transactions", "dim_customer", "dim_account", "dim_product"),
                               "gold"),
    "fact_fraud_alerts": Model(facts.fact_fraud_alerts, ("fact_transactions",), "gold"),
}
RAW_TABLES = ("customers", "accounts", "loans", "transactions")


def build_models(tables: dict[str, DataFrame], as_of: str,
                 only: tuple[str, ...] | None = None) -> dict[str, DataFrame]:
    """All models as lazy DataFrames over the given raw tables."""
    built = dict(tables)
    for name, model in MODELS.items():
        if only is not None and name not in only:
            continue
        inputs = [built[n] for n in model.needs]
        built[name] = model.build(*inputs, as_of) if model.dated else model.build(*inputs)
    return built


def run_pipeline(spark: SparkSession, root: str, feeds: dict[str, str], as_of: str,
                 batch_id: str | None = None, mode: str = "append",
                 suites: dict[str, list[Rule]] | None = None,
                 full_refresh: bool = False, register: bool = False,
                 run_time: str | None = None, keep_versions: int = 5) -> dict[str, DataFrame]:
    """Run every layer below ``root``; returns all tables.

    ``feeds`` maps raw table names to CSV paths. A batch is landed beside bronze, passes the gate
    there, and only then becomes part of bronze; a refused batch leaves no row behind, and a batch id
    that comes again replaces what it brought. A failed gate or test raises and nothing after it
    runs. Results carry the time the run really started (or ``run_time``), so that two runs of one
    day are told apart. The fact is a versioned table: batches that its ledger lacks are merged in, or all with
    ``full_refresh``, and readers keep the version they opened; the newest ``keep_versions`` stay.
    ``register`` also creates a temporary view per table for SQL users.
    """
    batch_id = batch_id or new_batch_id()
    run_time = run_time or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
    suites = suites or {"bronze_transactions": bronze_transactions(),
                        "bronze_customers": bronze_customers(),
                        "silver_transactions": silver_transactions()}
    waiting = f"{root}/landing/{batch_id}"
    landed = {}
    for table in RAW_TABLES:
        if table in feeds:
            load_bronze(spark, feeds[table], table, waiting, "replace", batch_id)
            landed[table] = read_layer(spark, waiting, "bronze", table)
    results = f"{root}/quality/results"
    gated = {f"bronze_{t}": (landed[t], suites[f"bronze_{t}"]) for t in ("transactions", "customers") if t in landed}
    if gated:
        checkpoint(gated, run_time, "bronze", results)
    if "transactions" in landed:  # what silver would refuse must not reach bronze either
        cleaned = silver.stg_transactions(landed["transactions"])
        checkpoint({"landed_silver_transactions": (cleaned, suites["silver_transactions"])}, run_time, results_path=results)
    for table, rows in landed.items():
        write_bronze(rows, f"{root}/bronze/{table}", mode)
    Folder(spark, waiting).delete()
    tables = {t: read_layer(spark, root, "bronze", t) for t in RAW_TABLES}

    for name, model in MODELS.items():
        inputs = [tables[n] for n in model.needs]
        if name == "fact_transactions":
            transactions, *dims = inputs
            fact = VersionedTable(spark, f"{root}/gold/{name}", "transaction_id", "created_at", "transaction_month")
            bring_up_to_date(fact, transactions, lambda t, d=dims: by_month(model.build(t, *d), "transaction_date"),
                             replay={batch_id}, full_refresh=full_refresh)
            fact.vacuum(keep_versions)
            tables[name] = fact.read()
            continue
        built = model.build(*inputs, as_of) if model.dated else model.build(*inputs)
        tables[name] = save_table(built, root, model.layer, name) if model.stored else built
        if name == "stg_transactions":
            checkpoint({"silver_transactions": (built, suites["silver_transactions"])},
                       run_time, "silver", results)

    run_tests(tables, run_time)
    if register:
        for name, df in tables.items():
            df.createOrReplaceTempView(name)
    log.info("batch %s done", batch_id)
    return tables


def run_tests(tables: dict[str, DataFrame], run_time: str) -> DataFrame:
    """All column tests and the tests that must return no row; raises if any fails."""
    tests = {name: (tables[name], rules) for name, rules in table_tests().items()}
    done = checkpoint(tests, run_time)
    must_be_empty = {
        "no negative amounts": negative_amounts(tables["fact_transactions"]),
        "no overlapping versions": scd2_overlapping(tables["dim_customer"]),
        "no keys without a dimension row": broken_references(tables["fact_transactions"], {
            "customer": ("customer_key", tables["dim_customer"], "customer_key"),
            "account": ("account_key", tables["dim_account"], "account_key"),
            "product": ("product_key", tables["dim_product"], "product_key")}),
        "no mislabelled alerts": mislabelled_alerts(tables["fact_fraud_alerts"]),
    }
    broken = [{"suite": "singular", "rule": name, "column_name": None}
              for name, rows in must_be_empty.items() if not rows.isEmpty()]
    if broken:
        raise QualityGateError(broken)
    return done


def failed_rules(results: DataFrame) -> DataFrame:
    return results.where(~F.col("success"))
