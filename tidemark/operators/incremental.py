"""Incremental facts: high-water mark, key upsert into partitioned Parquet, equality check."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from tidemark.contracts import EPOCH_START
from tidemark.functions import ntz
from tidemark.operators.dedup import dedup_latest
from tidemark.session import scratch_dir, tidied


def high_water_mark(target: DataFrame | None, column: str) -> str:
    """Latest instant of the target as text, or the sentinel for an empty or absent target."""
    if target is None:
        return EPOCH_START
    return target.agg(F.coalesce(F.max(column).cast("string"), F.lit(EPOCH_START))
                      .alias("m")).first()["m"]


def high_water_filter(df: DataFrame, column: str, mark: str, lateness: str | None = None
                      ) -> DataFrame:
    """Rows strictly after the mark. The mark is a literal, so it reaches the Parquet scan.

    A strict comparison never sees rows that arrive late or tie the mark. ``lateness`` (such as
    ``"2 days"``) reads that much again; the key upsert makes re-reading harmless. Rows without an
    instant are never before the mark: every run reads them, as a full refresh does.
    """
    limit = ntz(mark)
    if lateness:
        limit = limit - F.expr(f"INTERVAL {lateness}")
    after = F.col(column) >= limit if lateness else F.col(column) > limit
    return df.where(after | F.col(column).isNull())


def by_month(df: DataFrame, date: str, out: str = "transaction_month") -> DataFrame:
    """Add the first day of the month: partition column of a stored fact."""
    return df.withColumn(out, F.trunc(date, "MM"))


def write_partitioned(df: DataFrame, path: str, partition: str) -> None:
    """Overwrite a table partitioned by one column.

    ``rebalance`` gathers each partition's rows into files of the advisory size: small partitions
    share a task, a partition holding a large part of the table is split over many.
    """
    (df.hint("rebalance", partition).write.mode("overwrite")
     .option("partitionOverwriteMode", "static").partitionBy(partition).parquet(path))


def one_per_key(df: DataFrame, key: str, latest: list[str | Column]) -> DataFrame:
    """The rule for repeats, the same in a first run, a full refresh and an increment.

    Of the rows with one key the one greatest in ``latest`` stays; ties go by the other columns, so
    the order of arrival does not matter. A NULL key identifies nothing: different rows without a
    key all stay, equal ones are one row delivered again.
    """
    others = df.columns
    # Column by column: a struct of them all would travel with each row as its copy.
    ties = [F.col(c) for c in others if c not in latest]
    # 256 bits of the row's own bytes: two different rows without key are never taken for one.
    text = F.to_json(F.struct(*[F.col(c) for c in others]), {"ignoreNullFields": "false"})
    content = F.when(F.col(key).isNull(), F.sha2(text, 256))
    keyed = df.withColumn("_content", content)
    return dedup_latest(keyed, [key, "_content"], [*latest, *ties]).drop("_content")


REPEATS = 500_000         # keys told by 64-bit hashes that are sent to all tasks


def _hash_of(key: str) -> Column:
    return F.when(F.col(key).isNotNull(), F.xxhash64(key))


def one_per_stored_key(stored: DataFrame, key: str, latest: list[str | Column]) -> DataFrame:
    """:func:`one_per_key` of rows that are read from files, so that reading them again is cheap.

    Only 64-bit hashes of the keys are shuffled to find those that occur twice; just their rows, and those without a key,
    are ranked. The others stay where they are. Where very many keys repeat, all rows are ranked. Runs one job.
    """
    spark, path = stored.sparkSession, scratch_dir(stored.sparkSession, "repeated")
    told = stored.select(_hash_of(key).alias("_h")).groupBy("_h").agg(F.count(F.lit(1)).alias("_n"))
    tidied(spark, lambda: told.where((F.col("_n") > 1) | F.col("_h").isNull()).select("_h").write.parquet(path))
    repeated = spark.read.schema("_h long").parquet(path)
    return _ranked_apart(stored, repeated, key, latest)


def _ranked_apart(rows: DataFrame, hashes: DataFrame, key: str, latest: list[str | Column]) -> DataFrame:
    """Rows whose key has none of the hashes as they are; those with one of them, and those without key, ranked."""
    n = hashes.count()
    if n == 0:
        return rows
    if n > REPEATS:
        return one_per_key(rows, key, latest)
    known = F.broadcast(hashes.where(F.col("_h").isNotNull()))  # at most REPEATS numbers
    hashed = lambda df: df.withColumn("_k", _hash_of(key))
    alone = hashed(rows.where(F.col(key).isNotNull())).join(known, F.col("_k") == F.col("_h"), "left_anti").drop("_k")
    met = hashed(rows).join(known, F.col("_k") == F.col("_h"), "left_semi").drop("_k")
    without = rows.where(F.col(key).isNull())
    return alone.unionByName(one_per_key(met.unionByName(without), key, latest))


# --- storage ----------------------------------------------------------------------------

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


class Folder:
    """A directory of the cluster's file system, through Hadoop's own client."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self._path = spark._jvm.org.apache.hadoop.fs.Path(path)
        self._files = self._path.getFileSystem(spark._jsc.hadoopConfiguration())

    def __truediv__(self, name: str) -> Folder:
        return Folder(self.spark, f"{self.path}/{name}")

    def exists(self) -> bool:
        return self._files.exists(self._path)

    def make(self) -> None:
        self._files.mkdirs(self._path)

    def delete(self) -> None:
        self._files.delete(self._path, True)

    def move_to(self, other: Folder) -> None:
        if not self._files.rename(self._path, other._path):
            raise OSError(f"cannot move {self.path} to {other.path}")

    def read_text(self) -> str:
        """The content of a small file."""
        stream = self._files.open(self._path)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write_text(self, text: str) -> None:
        stream = self._files.create(self._path, True)
        stream.write(bytearray(text.encode()))
        stream.close()

    def files(self) -> list[str]:
        if not self.exists():
            return []
        return [s.getPath().getName() for s in self._files.listStatus(self._path)
                if s.isFile() and not s.getPath().getName().startswith(("_", "."))]

    def subfolders(self) -> list[str]:
        if not self.exists():
            return []
        return [s.getPath().getName() for s in self._files.listStatus(self._path)
                if s.isDirectory() and not s.getPath().getName().startswith(("_", "."))]


def staged(rows: DataFrame, path: str) -> DataFrame:
    """The rows written once and read back, whatever stood there before."""
    tidied(rows.sparkSession, lambda: rows.write.mode("overwrite").parquet(path))
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def read_target(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored table, or None while it does not exist or has no file."""
    if not Folder(spark, path).exists():
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # a folder without a data file
            return None
        raise


def _folders_of(df: DataFrame, partition: str) -> set[str]:
    """Partition directories the rows belong to; at most one name per directory of the table."""
    found = df.select(F.col(partition).cast("string").alias("p")).distinct().collect()
    return {f"{partition}={NULL_PARTITION if r['p'] is None else r['p']}" for r in found}


def _in_folders(partition: str, folders: set[str]) -> Column:
    """Rows of the given partition directories; prunes the listing."""
    values = {unquote(f.split("=", 1)[1]) for f in folders}
    hit = F.col(partition).cast("string").isin(sorted(values - {NULL_PARTITION}))
    if NULL_PARTITION in values:
        hit = hit | F.col(partition).isNull()
    return F.coalesce(hit, F.lit(False))


def _finish(spark: SparkSession, path: str) -> None:
    """Put a complete staging in place, partition by partition. May be repeated after a crash:
    a partition is gone from the staging once it is in place."""
    target, staging = Folder(spark, path), Folder(spark, f"{path}_staging")
    if (staging / "whole").exists():
        target.delete()
        (staging / "whole").move_to(target)
    for name in (staging / "rows").subfolders():
        (target / name).delete()
        (staging / "rows" / name).move_to(target / name)
    for name in (staging / "emptied").subfolders():
        (target / name).delete()
    staging.delete()


def recover(spark: SparkSession, path: str) -> bool:
    """Finish an upsert that was interrupted after its staging was complete; drop one that was
    interrupted before. Returns whether there was something to finish."""
    staging = Folder(spark, f"{path}_staging")
    if not staging.exists():
        return False
    if (staging / "complete").exists():
        _finish(spark, path)
        return True
    staging.delete()
    return False


def replace_all(df: DataFrame, path: str, partition: str, key: str, latest: list[str]) -> None:
    """Write the whole table, reduced to one row per key, beside the old one, then put it in its place."""
    spark = df.sparkSession
    recover(spark, path)
    staging = Folder(spark, f"{path}_staging")
    rows = staged(df, f"{staging.path}/batch")
    tidied(spark, lambda: write_partitioned(one_per_stored_key(rows, key, latest), f"{staging.path}/whole", partition))
    (staging / "complete").make()
    _finish(spark, path)


def upsert(spark: SparkSession, path: str, batch: DataFrame, key: str, partition: str,
           latest: list[str], partition_fixed: bool = False,
           target: DataFrame | None = None) -> None:
    """Merge the batch into the stored table by key, rewriting only touched partitions.

    ``partition`` is the table's partition column (a date). Stored rows and the batch's are ranked
    together by :func:`one_per_key`: an older version that is delivered late does not replace a
    newer one, and batches give the same table in any order. A key may have moved to another
    partition since it was stored; its old partition is found by reading the target's key column.
    Where a key's partition cannot change, ``partition_fixed=True`` saves that read. A batch whose
    columns are not the table's is refused: rebuild the table with a full refresh.

    New content of the touched partitions is first written beside the table. Only a complete
    staging replaces partitions, and replacing can be repeated (see :func:`recover`). One writer
    per table at a time. ``target`` is the stored table where the caller has it open already.
    """
    if target is None:
        recover(spark, path)
        target = read_target(spark, path)
    if target is None:
        replace_all(batch, path, partition, key, latest)
        return
    if set(batch.columns) != set(target.columns):
        raise ValueError(f"columns of the batch and of {path} differ: {sorted(set(batch.columns) ^ set(target.columns))}")
    staging = Folder(spark, f"{path}_staging")
    # The batch is used several times below: written once, it is not computed again.
    rows = one_per_stored_key(staged(batch, f"{staging.path}/batch"), key, latest)
    rows = rows.select(*target.columns)
    touched = _folders_of(rows, partition)
    if not touched:
        staging.delete()
        return
    if not partition_fixed:
        moved = (target.where(~_in_folders(partition, touched)).select(key, partition)
                 .join(rows.select(key), key, "left_semi"))
        touched |= _folders_of(moved, partition)
    old = target.where(_in_folders(partition, touched))
    tidied(spark, lambda: write_partitioned(merged_latest(old, rows, key, latest), f"{staging.path}/rows", partition))
    for name in touched - set((staging / "rows").subfolders()):
        (staging / "emptied" / name).make()
    (staging / "complete").make()
    _finish(spark, path)


def merged_latest(old: DataFrame, rows: DataFrame, key: str, latest: list[str]) -> DataFrame:
    """Old rows whose key the batch lacks, untouched, the batch's whose key the old rows lack, and the winner of every
    key that both have. Each side has one row per key and can be read again cheaply.

    The keys that both have are found by joining 64-bit hashes; only their rows are ranked together. Where very many meet,
    all rows of both are. Runs one job.
    """
    rows = rows.select(*old.columns)
    path = scratch_dir(old.sparkSession, "met")
    hashes = lambda df: df.select(_hash_of(key).alias("_h")).where(F.col("_h").isNotNull())
    met = hashes(rows).join(hashes(old), "_h", "left_semi").distinct()
    without = rows.where(F.col(key).isNull()).limit(1).select(_hash_of(key).alias("_h"))
    tidied(old.sparkSession, lambda: met.unionByName(without).write.parquet(path))
    both = old.unionByName(rows)
    return _ranked_apart(both, old.sparkSession.read.schema("_h long").parquet(path), key, latest)


def incremental(spark: SparkSession, path: str, source: DataFrame, build, key: str, ts: str,
                partition: str, lateness: str | None = None, full_refresh: bool = False,
                partition_fixed: bool = False) -> None:
    """Bring a stored fact up to date.

    ``build`` turns source rows into fact rows. First run or ``full_refresh``: everything is
    built, reduced to one row per key and put in place whole. Later runs: only source rows beyond
    the high-water mark are built, then upserted by key, under the same rule for repeats.
    """
    recover(spark, path)
    target = None if full_refresh else read_target(spark, path)
    if target is None:
        replace_all(build(source), path, partition, key, [ts])
        return
    mark = high_water_mark(target, ts)
    delta = build(high_water_filter(source, ts, mark, lateness))
    upsert(spark, path, delta, key, partition, [ts], partition_fixed, target)


def differences(a: DataFrame, b: DataFrame, ignore: tuple[str, ...] = ()) -> DataFrame:
    """Rows that the two tables do not hold equally often, with the surplus of ``a`` over ``b``.

    Counts every distinct row with a sign in one aggregation; empty means equal as bags.
    """
    columns = [c for c in a.columns if c not in ignore]
    signed = (a.select(*columns).withColumn("_sign", F.lit(1))
              .unionByName(b.select(*columns).withColumn("_sign", F.lit(-1))))
    return (signed.groupBy(*columns).agg(F.sum("_sign").alias("surplus"))
            .where(F.col("surplus") != 0))
