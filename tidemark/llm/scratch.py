"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import scratch_dir

#: Spark's own setting: shuffle files of a query go when it ends, not when the driver's memory is next collected.
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written once to the shared folder and read back: the lineage ends here, and lost executors cost nothing."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_and_tidied(df: DataFrame, name: str) -> DataFrame:
    """stored(), after which Spark deletes the shuffle files that writing needed; df itself is not to be run again."""
    conf = df.sparkSession.conf
    before = conf.get(_TIDY, None)
    conf.set(_TIDY, "true")
    try:
        return stored(df, name)
    finally:
        conf.unset(_TIDY) if before is None else conf.set(_TIDY, before)


def discard(spark: SparkSession, folder: str) -> None:
    """Deletes a folder that scratch_dir() named, once nothing reads it any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
