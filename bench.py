"""Headline timings on one scale factor; prints one JSON line.

Raw tables are landed once (untimed, as bronze is in a running warehouse). All measures are run in
turn, first untimed to warm the JVM, then several times; the best time of each counts. Builds
write their result to Parquet.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from catalog import AS_OF, CALENDAR, CUT, REPORT_DAY, transaction_suite  # noqa: E402
from fixtures import ADAPTERS, adapter  # noqa: E402
from tidemark import build_session  # noqa: E402
from tidemark.operators import channels, dimensions, facts, incremental, scd2, silver  # noqa: E402
from tidemark.plans import reports  # noqa: E402
from tidemark.plans.pipeline import MODELS, build_models  # noqa: E402
from tidemark.quality import rules as quality  # noqa: E402
from tidemark.sources import landing  # noqa: E402
from tidemark.sources.versioned import VersionedTable, bring_up_to_date  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
# Published rows per second of the reference on one node, for the builds that have one.
BASELINE_ROWS_PER_SEC = {"fact_full_refresh": 406_000, "fact_incremental": 114_000,
                         "unified_full_refresh": 488_000, "unified_incremental": 37_000,
                         "core_build": 424_000}
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))


class Bench:
    def __init__(self, spark, sf_dir):
        self.spark, self.root = spark, tempfile.mkdtemp(prefix="run-", dir="/tmp")
        self.n = 0
        for name in ADAPTERS:
            # As many files as landing tasks; the given tables are one file each.
            adapter(spark, sf_dir, name).repartition(int(CPUS)).write.parquet(
                f"{self.root}/bronze/{name}")
        self.raw = {n: spark.read.parquet(f"{self.root}/bronze/{n}") for n in ADAPTERS}
        self.counts = {n: self.raw[n].count() for n in ("txn", "card", "money")}
        core = build_models({"transactions": self.raw["txn"], "customers": self.raw["cust_v"],
                             "accounts": self.raw["acct"], "loans": self.raw["loans"]}, AS_OF)
        self.core = core
        for dim in ("dim_customer", "dim_account", "dim_product"):
            core[dim] = landing.save_table(core[dim], self.root, "gold", dim)
        self.dims = {
            "channel": dimensions.dim_channel(spark),
            "customer": landing.save_table(
                dimensions.dim_customer_master(self.raw["users"]), self.root, "gold", "master"),
            "cards": landing.save_table(
                dimensions.dim_card(self.raw["cards"]), self.root, "gold", "card"),
            "merchant": landing.save_table(
                dimensions.dim_merchant(self.raw["card"], self.raw["mcc"]), self.root, "gold",
                "merchant"),
            "dates": landing.save_table(
                dimensions.dim_date(spark, *CALENDAR), self.root, "gold", "date"),
        }
        # Stored facts for the reports and, without the last 5 %, for the increments.
        self.fact = landing.save_table(self.build_fact(self.transactions()), self.root, "gold",
                                       "fact")
        self.unified = landing.save_table(self.build_unified(), self.root, "gold", "unified")
        self.alerts = facts.fact_fraud_alerts(self.fact)
        self.fact_cut = self.cut(self.fact, "created_at")
        self.unified_cut = self.cut(self.unified, "txn_timestamp")

    @staticmethod
    def cut(df, ts):
        seconds = F.unix_seconds(F.col(ts).cast("timestamp"))
        at = df.agg(F.percentile_approx(seconds, 0.95).alias("p")).first()["p"]
        return df.sparkSession.range(1).select(
            F.timestamp_seconds(F.lit(at)).cast("timestamp_ntz").cast("string")).first()[0]

    def fresh(self):
        self.n += 1
        return f"{self.root}/out/{self.n}"

    def transactions(self):
        return silver.stg_transactions(self.raw["txn"])

    def build_fact(self, t):
        return facts.fact_transactions(t, self.core["dim_customer"], self.core["dim_account"],
                                       self.core["dim_product"])

    def build_unified(self):
        card = channels.harmonize_card(self.raw["card"], self.raw["labels"], self.raw["mcc"])
        money = channels.harmonize_money(self.raw["money"], self.raw["users"])
        return channels.unify(card, money, **self.dims)

    # Each measure returns a function to time; preparing it is not timed.

    def fact_full_refresh(self):
        path = self.fresh()
        return lambda: self.build_fact(self.transactions()).write.parquet(path)

    def _increment(self, source, build, key, ts, cut, month_of):
        partitioned = lambda df: incremental.by_month(build(df), month_of)
        history = source.where(F.col(ts) <= F.lit(cut).cast("timestamp_ntz"))
        table = VersionedTable(self.spark, self.fresh(), key, ts, "transaction_month")
        bring_up_to_date(table, history, partitioned, batch=None)
        return lambda: bring_up_to_date(table, source, partitioned, batch=None)

    def fact_incremental(self):
        return self._increment(self.transactions(), self.build_fact, "transaction_id",
                               "created_at", self.fact_cut, "transaction_date")

    def unified_full_refresh(self):
        path = self.fresh()
        return lambda: self.build_unified().write.parquet(path)

    def unified_incremental(self):
        return self._increment(self.build_unified(), lambda df: df, "transaction_id",
                               "txn_timestamp", self.unified_cut, "txn_date")

    def core_build(self):
        """All ten core models from bronze; stored ones are written."""
        root = self.fresh()
        raw = {"transactions": self.raw["txn"], "customers": self.raw["cust_v"],
               "accounts": self.raw["acct"], "loans": self.raw["loans"]}

        def run():
            tables = dict(raw)
            for name, model in MODELS.items():
                inputs = [tables[n] for n in model.needs]
                built = model.build(*inputs, AS_OF) if model.dated else model.build(*inputs)
                tables[name] = (landing.save_table(built, root, model.layer, name)
                                if model.stored else built)
        return run

    def bronze_load(self):
        path, out = self.fresh(), self.fresh()
        text = [F.col(f).cast("string").alias(f) for f in
                landing.CONTRACTS["transactions"].fieldNames()]
        self.raw["txn"].select(*text).write.option("header", True).csv(path)
        return lambda: landing.load_bronze(self.spark, path, "transactions", out)

    def scd2_history(self):
        path = self.fresh()
        return lambda: scd2.scd2(self.raw["cust_events"], "customer_id", "updated_at") \
            .write.parquet(path)

    def scd2_asof_join(self):
        path = self.fresh()
        return lambda: scd2.scd2_asof_join(
            self.transactions(), self.core["dim_customer"], "customer_id", "created_at",
            ["customer_key", "segment"]).write.parquet(path)

    def quality_suite(self):
        return lambda: quality.evaluate(self.raw["txn"], "bronze_transactions",
                                        transaction_suite()).collect()

    def daily_volume(self):
        return lambda: reports.daily_volume(self.fact).collect()

    def daily_volume_30d(self):
        return lambda: reports.daily_volume(self.fact, REPORT_DAY).collect()

    def kpis(self):
        return lambda: reports.kpis(self.fact).collect()

    def segment_share(self):
        return lambda: reports.segment_share(self.core["dim_customer"]).collect()

    def outcome_matrix(self):
        return lambda: reports.outcome_matrix(self.alerts).collect()

    def channel_summary(self):
        return lambda: reports.channel_summary(self.unified, self.dims["channel"]).collect()

    def rows_of(self, name):
        if name in ("fact_full_refresh", "core_build"):
            return self.counts["txn"]
        if name == "unified_full_refresh":
            return self.counts["card"] + self.counts["money"]
        if name == "fact_incremental":
            return self.fact.where(F.col("created_at") > F.lit(self.fact_cut)
                                   .cast("timestamp_ntz")).count()
        if name == "unified_incremental":
            return self.unified.where(F.col("txn_timestamp") > F.lit(self.unified_cut)
                                      .cast("timestamp_ntz")).count()
        return None


MEASURES = ["fact_full_refresh", "fact_incremental", "unified_full_refresh",
            "unified_incremental", "core_build", "bronze_load", "scd2_history", "scd2_asof_join",
            "quality_suite", "daily_volume", "daily_volume_30d", "kpis", "segment_share",
            "outcome_matrix", "channel_summary"]


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g")})
    spark.sparkContext.setLogLevel("ERROR")
    bench = Bench(spark, SF_DIR)
    names = sys.argv[1:] or MEASURES
    timings: dict[str, float] = {}
    for attempt in range(REPEATS + 1):
        for name in names:
            run = getattr(bench, name)()
            start = time.perf_counter()
            run()
            took = round(time.perf_counter() - start, 3)
            if attempt:
                timings[name] = min(took, timings.get(name, took))
            print(f"{attempt} {name:24s} {took:7.3f}", file=sys.stderr, flush=True)
    throughput = {}
    for name in names:
        rows = bench.rows_of(name)
        if rows:
            base = BASELINE_ROWS_PER_SEC.get(name)
            throughput[name] = {"rows": rows, "rows_per_sec": round(rows / timings[name]),
                                "baseline_rows_per_sec": base}
    print(json.dumps({"metric": "headline_total", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings,
                      "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                      "cpus": CPUS, "throughput": throughput, "history_before": CUT}))


if __name__ == "__main__":
    main()
