"""Whole runs that are registered as queries, over tables made here."""

import datetime

import pytest

from catalog import CATALOG


@pytest.fixture
def tables(spark, tmp_path):
    """Two customers and orders, and suppliers whose numbers have six digits and differ in the last one."""
    day = datetime.datetime(1999, 5, 4)
    made = {
        "customer": ([(k, f"Customer {k}", 1, 100.0 * k, "BUILDING") for k in (1, 2)],
                     "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "supplier": ([(k, f"Supplier {k}", 1, 50.0) for k in (7, 12345, 100001, 100002, 100003)],
                     "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "orders": ([(k, k, "O", 1000.0, day, "5-LOW") for k in (1, 2)],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
    }
    for name, (values, schema) in made.items():
        spark.createDataFrame(values, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def test_pipeline_run_takes_loans_of_suppliers_with_long_numbers(spark, rows, tables):
    """Cut to five digits, the ids of three loans were one, which the run's own test of the key refuses."""
    assert rows(CATALOG["pipeline_run"](spark, tables), "transaction_id") == [("T1",), ("T2",)]
    from fixtures import adapter
    assert rows(adapter(spark, tables, "loans", whole_ids=True), "loan_id") == [
        ("LOAN00007",), ("LOAN100001",), ("LOAN100002",), ("LOAN100003",), ("LOAN12345",)]


def test_labels_by_line_are_in_documents_of_bounded_size(spark, tmp_path):
    """Sixteen documents whatever the size held 2,500 labels each here."""
    from pyspark.sql import functions as F

    from catalog import LABELS_A_DOCUMENT, _labels_by_line
    from tidemark.sources.readers import read_label_json
    n, folder = 40_000, str(tmp_path / "labels")
    labels = spark.range(n).select(F.col("id").alias("transaction_id"), F.when(F.col("id") % 7 == 0, "Yes").otherwise("No").alias("fraud_label"))
    _labels_by_line(labels, n, folder)
    sizes = spark.read.schema("target map<string,string>").json(folder).select(F.size("target")).collect()
    assert sum(r[0] for r in sizes) == n and max(r[0] for r in sizes) < 2 * LABELS_A_DOCUMENT
    back = read_label_json(spark, folder, multi_line=False)
    assert back.exceptAll(labels).isEmpty() and back.count() == n
