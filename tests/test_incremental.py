"""High-water mark, upsert, recovery, equality, streams and the pipeline."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fixtures import adapter
from tidemark.contracts import CONTRACTS
from tidemark.operators import incremental as inc
from tidemark.operators import silver
from tidemark.plans import pipeline
from tidemark.quality import suites
from tidemark.quality.suites import QualityGateError
from tidemark.session import scratch_dir, shared_folder
from tidemark.sources.drift import SchemaDriftError
from tidemark.streaming import jobs

SF = "/root/testdata/sf0.001"
SHAPE = "id string, v int, day date, ts timestamp_ntz"


def frame(spark, *data):
    return spark.createDataFrame(
        [(i, v, None if d is None else dt.date(2024, 1, d), dt.datetime(2024, 1, d or 1, h))
         for i, v, d, h in data], SHAPE)


def stored(spark, path):
    return sorted((r.id, r.v, r.day.day if r.day else 0) for r in spark.read.parquet(path).collect())


def put(spark, path, *data, **options):
    inc.upsert(spark, path, frame(spark, *data), "id", "day", ["ts"], **options)


def test_upsert_replaces_by_key_and_touches_few_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, ("a", 1, 1, 0), ("b", 1, 1, 0), ("c", 1, 2, 0))
    untouched = {p.name for p in (tmp_path / "t" / "day=2024-01-02").iterdir()}
    put(spark, path, ("a", 2, 1, 5), ("d", 2, 3, 0))
    assert stored(spark, path) == [("a", 2, 1), ("b", 1, 1), ("c", 1, 2), ("d", 2, 3)]
    assert {p.name for p in (tmp_path / "t" / "day=2024-01-02").iterdir()} == untouched
    assert not (tmp_path / "t_staging").exists()


def test_a_key_that_moved_leaves_no_old_row(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, ("a", 1, 1, 0), ("b", 1, 2, 0))
    put(spark, path, ("a", 2, 2, 5))
    assert stored(spark, path) == [("a", 2, 2), ("b", 1, 2)]
    assert not (tmp_path / "t" / "day=2024-01-01").exists()


def test_null_partitions_keep_their_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, ("a", 1, None, 0), ("b", 1, None, 0), ("c", 1, 1, 0))
    put(spark, path, ("a", 2, None, 5))
    assert stored(spark, path) == [("a", 2, 0), ("b", 1, 0), ("c", 1, 1)]
    put(spark, path, ("b", 3, 2, 6))
    assert stored(spark, path) == [("a", 2, 0), ("b", 3, 2), ("c", 1, 1)]


def test_a_key_twice_in_one_batch_is_stored_once(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, ("a", 1, 1, 0), ("a", 2, 1, 9))
    put(spark, path, ("b", 1, 1, 3), ("b", 2, 1, 1))
    put(spark, path, ("b", 1, 1, 3), ("b", 2, 1, 1))  # a retry changes nothing
    assert stored(spark, path) == [("a", 2, 1), ("b", 1, 1)]


def test_interrupted_upserts(spark, tmp_path):
    path, staging = str(tmp_path / "t"), tmp_path / "t_staging"
    put(spark, path, ("a", 1, 1, 0), ("b", 1, 2, 0))
    before = stored(spark, path)
    rows = frame(spark, ("a", 2, 3, 5))
    # Died while staging: the staging is dropped, the table is as it was.
    inc.write_partitioned(rows, str(staging / "rows"), "day")
    assert inc.recover(spark, path) is False
    assert stored(spark, path) == before and not staging.exists()
    # Died while placing partitions: the rest is placed.
    inc.write_partitioned(rows, str(staging / "rows"), "day")
    (staging / "emptied" / "day=2024-01-01").mkdir(parents=True)
    (staging / "complete").mkdir()
    assert inc.recover(spark, path) is True
    assert stored(spark, path) == [("a", 2, 3), ("b", 1, 2)]
    assert inc.recover(spark, path) is False


def test_strict_mark_loses_ties_and_late_rows_and_lateness_does_not(spark, tmp_path):
    source = frame(spark, ("a", 1, 10, 0), ("b", 1, 11, 0))
    later = source.unionByName(frame(spark, ("tie", 1, 11, 0), ("late", 1, 9, 0), ("new", 1, 12, 0)))
    for lateness, found in ((None, ["a", "b", "new"]), ("3 days", ["a", "b", "late", "new", "tie"])):
        path = str(tmp_path / f"t{lateness}".replace(" ", ""))
        run = lambda s, p=path, late=lateness: inc.incremental(
            spark, p, s, lambda d: d, "id", "ts", "day", lateness=late)
        run(source)
        run(later)
        run(later)
        assert [i for i, *_ in stored(spark, path)] == found


def test_the_mark_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "s")
    frame(spark, ("a", 1, 1, 0)).write.parquet(path)
    df = inc.high_water_filter(spark.read.parquet(path), "ts", "2024-01-01 00:00:00")
    assert "GreaterThan(ts,2024-01-01" in df._jdf.queryExecution().toString()
    assert inc.high_water_mark(None, "ts") == "1900-01-01 00:00:00"
    assert inc.high_water_mark(df.limit(0), "ts") == "1900-01-01 00:00:00"


def test_differences_compare_bags(spark):
    a = frame(spark, ("a", 1, 1, 0), ("a", 1, 1, 0), ("b", 1, 1, 0))
    b = frame(spark, ("a", 1, 1, 0), ("b", 1, 1, 0), ("c", 1, 1, 0))
    got = {r.id: r.surplus for r in inc.differences(a, b).collect()}
    assert got == {"a": 1, "c": -1} and inc.differences(a, a.repartition(3)).isEmpty()


# --- streams ----------------------------------------------------------------------------

def test_stream_upsert_equals_batch_over_several_runs(spark, tmp_path):
    feed, out = str(tmp_path / "feed"), str(tmp_path / "out")
    run = lambda: jobs.stream_upsert(
        jobs.read_stream(spark, feed, frame(spark).schema, files_per_trigger=1),
        lambda b: b.withColumn("v", F.col("v") * 10), out, str(tmp_path / "ckpt"), "id", "day",
        ["ts"]).awaitTermination()
    frame(spark, ("a", 1, 1, 0), ("b", 1, 2, 0)).coalesce(1).write.mode("append").parquet(feed)
    run()
    frame(spark, ("a", 2, 1, 9), ("late", 1, 1, 0)).coalesce(1).write.mode("append").parquet(feed)
    run()
    assert stored(spark, out) == [("a", 20, 1), ("b", 10, 2), ("late", 10, 1)]


def test_stream_windows_and_late_rows(spark, tmp_path):
    feed = str(tmp_path / "feed")
    windows = lambda: jobs.daily_windows(
        jobs.read_stream(spark, feed, frame(spark).schema, files_per_trigger=1), "ts", "id", "v",
        F.col("v") > 5, "1 day")
    frame(spark, ("x", 1, 1, 0), ("x", 9, 1, 3), ("x", 1, 20, 0)).coalesce(1).write.mode(
        "append").parquet(feed)
    run = lambda: (jobs.stream_daily_volume(
        windows(), str(tmp_path / "all"), str(tmp_path / "c1"), "id").awaitTermination(),
        jobs.stream_closed_windows(
            windows(), str(tmp_path / "closed"), str(tmp_path / "c2")).awaitTermination())
    run()
    frame(spark, ("x", 1, 2, 0), ("x", 1, 20, 5)).coalesce(1).write.mode("append").parquet(feed)
    run()
    days = lambda p: sorted((r.date.day, r.tx_count, r.fraud_count)
                            for r in spark.read.parquet(str(tmp_path / p)).collect())
    assert days("all") == [(1, 2, 1), (20, 2, 0)]   # the row of day 2 came too late
    assert days("closed") == [(1, 2, 1)]            # day 20 is still open


def test_redelivery_is_dropped_across_runs(spark, tmp_path):
    feed, out = str(tmp_path / "feed"), str(tmp_path / "out")
    for _ in range(2):
        frame(spark, ("a", 1, 1, 0), ("b", 1, 1, 1)).coalesce(1).write.mode("append").parquet(feed)
        jobs.stream_dedup(jobs.read_stream(spark, feed, frame(spark).schema), "id", "ts", "2 days",
                          out, str(tmp_path / "ckpt")).awaitTermination()
    assert spark.read.parquet(out).count() == 2


# --- pipeline ---------------------------------------------------------------------------

def write_feeds(spark, root, keep=lambda t, df: df):
    feeds = {}
    for table, name in (("transactions", "txn"), ("customers", "cust_v"), ("accounts", "acct"),
                        ("loans", "loans")):
        df = adapter(spark, SF, name)
        text = [F.col(c).cast("string").alias(c) for c in CONTRACTS[table].fieldNames()]
        feeds[table] = f"{root}/{table}"
        keep(table, df.select(*text)).write.option("header", True).csv(feeds[table])
    return feeds


def wide_suites():
    bounds = {"min": 1, "max": 10_000_000}
    lenient = [r for r in suites.bronze_transactions(
        r"^T\d+$", r"^ACC\d+$", r"^CUST\d+$", bounds, {"min": 0, "max": 1e9})
        if not (r.column in ("amount", "transaction_type", "currency", "merchant_category"))]
    customers = [r for r in suites.bronze_customers(r"^CUST\d+$", bounds, {"min": 0, "max": 1})
                 if r.column not in ("segment", "kyc_status")]
    return {"bronze_transactions": lenient, "bronze_customers": customers,
            "silver_transactions": suites.silver_transactions(bounds)}


def test_pipeline_end_to_end_and_increment(spark, tmp_path):
    root = str(tmp_path / "lake")
    early = F.col("created_at") < "2000"
    feeds = write_feeds(spark, tmp_path / "f1",
                        lambda t, df: df.where(early) if t == "transactions" else df)
    pipeline.run_pipeline(spark, root, feeds, "2024-01-01", "20240101_060000", "replace",
                          wide_suites())
    second = write_feeds(spark, tmp_path / "f2",
                         lambda t, df: df.where(~early) if t == "transactions" else df)
    tables = pipeline.run_pipeline(spark, root, {"transactions": second["transactions"]},
                                   "2024-01-02", "20240102_060000", "append", wide_suites(),
                                   register=True)
    full = pipeline.build_models({t: tables[t] for t in pipeline.RAW_TABLES}, "2024-01-02")
    assert inc.differences(tables["fact_transactions"].drop("transaction_month"),
                           full["fact_transactions"]).isEmpty()
    expected = silver.stg_transactions(adapter(spark, SF, "txn")).count()
    assert spark.sql("select count(*) from fact_transactions").first()[0] == expected
    assert spark.read.parquet(f"{root}/quality/results").where("not success").isEmpty()


def test_pipeline_stops_at_the_gate(spark, tmp_path):
    root = str(tmp_path / "lake")
    feeds = write_feeds(spark, tmp_path / "f", lambda t, df: df.withColumn(
        "transaction_type", F.lit("BARTER")) if t == "transactions" else df)
    with pytest.raises(QualityGateError, match="transaction_type"):
        pipeline.run_pipeline(spark, root, feeds, "2024-01-01", suites=wide_suites())
    assert not (tmp_path / "lake" / "gold").exists()


def test_a_refused_batch_leaves_nothing_behind(spark, tmp_path):
    root = str(tmp_path / "lake")
    bad = write_feeds(spark, tmp_path / "bad", lambda t, df: df.withColumn(
        "transaction_type", F.lit("BARTER")) if t == "transactions" else df)
    with pytest.raises(QualityGateError):
        pipeline.run_pipeline(spark, root, bad, "2024-01-01", "b1", suites=wide_suites())
    good = write_feeds(spark, tmp_path / "good", lambda t, df: df)
    for _ in range(2):  # the second run brings the same batch again
        tables = pipeline.run_pipeline(spark, root, good, "2024-01-01", "b2", suites=wide_suites())
    assert {r[0] for r in tables["transactions"].select("_batch_id").distinct().collect()} == {"b2"}
    assert tables["transactions"].count() == adapter(spark, SF, "txn").count()
    results = spark.read.parquet(f"{root}/quality/results")
    assert results.select("run_time").distinct().count() == 3
    board = suites.latest_status(results, ["bronze_transactions"]).first()
    assert board.overall_status == "PASS"


def keyed(spark, *data):
    return spark.createDataFrame(list(data), "id string, day string, ts int, v int")


def test_older_deliveries_repeats_and_missing_keys(spark, tmp_path, rows):
    """Batches in any order, and all at once, give one table."""
    data = [("a", "d1", 1, 1), ("a", "d2", 5, 2), ("a", "d1", 3, 3), (None, "d1", 1, 4), (None, "d1", 1, 4),
            (None, "d1", 1, 5), ("b", "d1", None, 6), ("b", "d1", 2, 7), ("c", "d1", 2, 8), ("c", "d1", 2, 9)]
    want = [(None, "d1", 1, 4), (None, "d1", 1, 5), ("a", "d2", 5, 2), ("b", "d1", 2, 7), ("c", "d1", 2, 9)]
    for k, order in enumerate((data, data[::-1], data[5:] + data[:5])):
        path = str(tmp_path / f"t{k}")
        for first in range(0, len(order), 3):
            inc.upsert(spark, path, keyed(spark, *order[first:first + 3]), "id", "day", ["ts"])
        inc.upsert(spark, path, keyed(spark, *order[:4]), "id", "day", ["ts"])  # a retry
        assert rows(spark.read.parquet(path).select("id", "day", "ts", "v")) == want
    whole = str(tmp_path / "whole")
    for refresh in (False, True):
        inc.incremental(spark, whole, keyed(spark, *data), lambda d: d, "id", "ts", "day", full_refresh=refresh)
        assert rows(spark.read.parquet(whole).select("id", "day", "ts", "v")) == want


def test_columns_a_table_lacks_are_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    inc.upsert(spark, path, keyed(spark, ("a", "d1", 1, 1)), "id", "day", ["ts"])
    more = keyed(spark, ("b", "d1", 1, 1)).withColumn("added", F.lit(1))
    with pytest.raises(ValueError, match="added"):
        inc.upsert(spark, path, more, "id", "day", ["ts"])


def test_pipeline_stops_on_drift(spark, tmp_path):
    feeds = write_feeds(spark, tmp_path / "f",
                        lambda t, df: df.drop("amount") if t == "transactions" else df)
    with pytest.raises(SchemaDriftError, match="amount"):
        pipeline.run_pipeline(spark, str(tmp_path / "lake"), feeds, "2024-01-01")
    assert not (tmp_path / "lake" / "bronze" / "transactions").exists()


class Conf(dict):
    def set(self, key, value):
        self[key] = value


class Session:
    def __init__(self, **conf):
        self.conf = Conf({k.replace("_", "."): v for k, v in conf.items()})


def test_scratch_follows_the_session(spark):
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")
    assert shared_folder(Session(spark_checkpoint_dir="hdfs://shared/a/")) == "hdfs://shared/a"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session(spark_master="spark://host:7077"))
    local = Session(spark_master="local[2]")
    assert shared_folder(local) == shared_folder(local)


def _plain(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("most", [0, 500_000])
def test_stored_rows_are_ranked_only_where_keys_repeat(spark, tmp_path, monkeypatch, most):
    """The rows that one_per_key gives, with a shuffle of hashes; whatever the number of hashes that may be sent to all tasks."""
    monkeypatch.setattr(inc, "REPEATS", most)
    given = [("a", 1, "x"), ("a", 2, None), ("a", 2, "y"), ("b", 1, "x"), (None, 1, "x"), (None, 1, "x"), (None, 2, "x"), ("c", None, "z"), ("c", 0, "q")]
    spark.createDataFrame(given, "k string, t int, v string").write.parquet(f"{tmp_path}/rows")
    stored = spark.read.parquet(f"{tmp_path}/rows")
    want = [("a", 2, "y"), ("b", 1, "x"), ("c", 0, "q"), (None, 1, "x"), (None, 2, "x")]
    assert _plain(inc.one_per_key(stored, "k", ["t"])) == sorted(want, key=str)
    assert _plain(inc.one_per_stored_key(stored, "k", ["t"])) == sorted(want, key=str)
    batch = spark.createDataFrame([("b", 1, "a"), ("c", 5, "n"), ("d", 1, "d"), (None, 2, "x"), (None, 3, "x")], stored.schema)
    old = spark.createDataFrame(want, stored.schema)
    assert _plain(inc.merged_latest(old, batch, "k", ["t"])) == sorted(
        [("a", 2, "y"), ("b", 1, "x"), ("c", 5, "n"), ("d", 1, "d"), (None, 1, "x"), (None, 2, "x"), (None, 3, "x")], key=str)


def test_rows_of_unique_keys_are_not_shuffled_to_be_ranked(spark, tmp_path):
    spark.range(100).selectExpr("cast(id as string) as k", "id as t").write.parquet(f"{tmp_path}/rows")
    stored = spark.read.parquet(f"{tmp_path}/rows")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan(inc.one_per_stored_key(stored, "k", ["t"]))
    assert "Exchange" not in plan(inc.merged_latest(stored.where("t < 50"), stored.where("t >= 50"), "k", ["t"]))
    ranked = inc.one_per_key(stored, "k", ["t"])._jdf.queryExecution().optimizedPlan().toString()
    assert "_w0" not in ranked  # a copy of the row to rank by
