"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Fact rows of a hot customer or merchant end up in one shuffle partition; AQE
    # splits that partition across tasks and repeats only the dimension side.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Lets AQE broadcast a dimension that turns out small at run time, and build a
    # hash table instead of sorting where every partition of the dimension is small.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": str(64 << 20),
    "spark.sql.parquet.filterPushdown": "true",
    # Spark 4.1 takes a union of equally partitioned inputs for partitioned alike. Where adaptive execution then merges
    # their partitions unlike, rows of one key are apart and a window over the union gives wrong results.
    "spark.sql.unionOutputPartitioning": "false",
    # Recording the Python call site of every column expression doubles plan-building time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; ``**{"spark.…": "…"}`` adds to or overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def keep_correct(spark: SparkSession) -> None:
    """Sets what results depend on, for sessions that build_session() has not made."""
    spark.conf.set("spark.sql.unionOutputPartitioning", SETTINGS["spark.sql.unionOutputPartitioning"])


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session may go without one; it then gets a temporary folder, which is
    remembered in the session so that later calls find it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = spark.conf.get("tidemark.local.scratch", None)
    if not folder:
        folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("tidemark.local.scratch", folder)
    return folder


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; never reused, so a retry cannot see old files."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


_Result = TypeVar("_Result")
#: Spark's own setting: shuffle files of a query go when it ends, not when the driver's memory is next collected.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def tidied(spark: SparkSession, write: Callable[[], _Result]) -> _Result:
    """What ``write`` returns. Spark deletes the shuffle files of each query that it runs when that has ended; a DataFrame
    that was acted on inside and is used again computes its shuffles again."""
    before = spark.conf.get(TIDY, None)
    spark.conf.set(TIDY, "true")
    try:
        return write()
    finally:
        spark.conf.unset(TIDY) if before is None else spark.conf.set(TIDY, before)
