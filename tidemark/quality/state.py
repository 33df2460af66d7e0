"""Verdicts on a whole table from states of its batches: a daily gate reads the new batch only.

A batch leaves one row of counters, and for rules on distinct values a digest and a count for each value
that it holds. A new batch is compared with the stored digests of its own values; a batch that comes again
replaces what it had brought. Counters add up, so the whole table is never read again.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators.incremental import Folder
from tidemark.quality.rules import GROUPED, RESULT_COLUMNS, Rule, _grouped_outcomes, _row_rule


class RuleState:
    """State of one suite below ``path``; another list of rules has a state of its own.

    One writer. ``add`` writes the values' counts first and the counters last; a run that dies between is
    repeated with its batch id, which then counts as one that comes again. An empty batch is a batch without
    rows, also in place of an earlier one with rows; without any batch ``results`` raises. A rule's column must
    be in every batch; ``columns_present`` looks for columns in any of them.
    """

    def __init__(self, spark: SparkSession, path: str, suite: str, rules: list[Rule]) -> None:
        self.spark, self.suite, self.rules = spark, suite, rules
        name = hashlib.sha256(repr(rules).encode()).hexdigest()[:16]
        self.values_path, self.counters_path = f"{path}/{suite}-{name}/values", f"{path}/{suite}-{name}/counters"
        numbered = list(enumerate(rules, start=1))
        self.by_row = [(i, r) for i, r in numbered if r.kind not in GROUPED]
        self.grouped: dict[str, list[tuple[int, Rule]]] = {}
        for i, rule in numbered:
            if rule.kind in GROUPED:
                self.grouped.setdefault(rule.column, []).append((i, rule))
        self.columns = list(self.grouped)

    # --- one batch ------------------------------------------------------------------------

    def _counted(self, df: DataFrame) -> DataFrame:
        """One row of counters. Means are kept as sums."""
        wanted = [F.count(F.lit(1)).alias("_rows")]
        for i, rule in self.by_row:
            if rule.kind == "mean_between":
                wanted += [F.coalesce(F.sum(F.col(rule.column).cast("double")), F.lit(0.0)).alias(f"_bad{i}"),
                           F.count(rule.column).alias(f"_seen{i}")]
            else:
                wanted += _row_rule(i, rule, set(df.columns))[0]
        present = F.array(*[F.lit(c) for c in df.columns]).alias("_columns")
        return df.agg(*wanted).withColumn("_columns", present)

    def _valued(self, df: DataFrame) -> DataFrame:
        """(place, digest, n) for each value of each column that rules on distinct values name."""
        parts = [df.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("v")).agg(F.count(F.lit(1)).alias("n"))
                 .select(F.lit(place).alias("place"), F.unhex(F.md5(F.col("v").cast("string"))).alias("digest"), "n")
                 for place, c in enumerate(self.columns)]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part)
        return whole

    def _totals(self, values: DataFrame) -> DataFrame:
        """What all stored values say, a row for each column."""
        sizes = values.groupBy("place", "digest").agg(F.sum("n").alias("n"))
        return sizes.groupBy("place").agg(
            F.sum("n").alias("rows"), F.count(F.lit(1)).alias("values"),
            F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("repeated"), F.max("n").alias("largest"))

    def _added(self, new: DataFrame, old: DataFrame) -> DataFrame:
        """What a batch adds to the totals; of the older values only those that it holds too are counted."""
        keys = ["place", "digest"]
        before = old.join(new.select(*keys), keys, "left_semi").groupBy(*keys).agg(F.sum("n").alias("o"))
        n, o = F.col("n"), F.coalesce("o", F.lit(0))
        repeated = F.when(o == 0, F.when(n > 1, n).otherwise(0)).when(o == 1, n + 1).otherwise(n)
        return new.join(before, keys, "left").groupBy("place").agg(
            F.sum("n").alias("rows"), F.sum(F.when(o == 0, 1).otherwise(0)).alias("values"),
            F.sum(repeated).alias("repeated"), F.max(n + o).alias("largest"))

    def add(self, df: DataFrame, batch_id: str) -> None:
        """Take in a batch, or take it in again in place of what it had brought."""
        write = lambda d, path: (d.withColumn("_batch_id", F.lit(batch_id)).write.mode("overwrite")
                                 .option("partitionOverwriteMode", "dynamic").partitionBy("_batch_id").parquet(path))
        counters = self._counted(df)
        told, again = [], False
        if self.columns:
            again = Folder(self.spark, f"{self.values_path}/_batch_id={batch_id}").exists()
            # A row without a value, so that an empty batch has a folder and replaces an earlier one.
            marker = self.spark.range(1).select(F.lit(-1).alias("place"), F.lit(b"").alias("digest"),
                                                F.lit(0).cast("bigint").alias("n"))
            write(self._valued(df).unionByName(marker), self.values_path)
            stored, mine = self._stored_values(), F.col("_batch_id") == batch_id
            told = self._rest(stored, batch_id) if again else self._added(stored.where(mine), stored.where(~mine))
            told = told.collect()  # a row for each column
        last = self._stored_counters().agg(F.max("_no")).first()[0] if self._any() else 0
        kinds = "array<struct<place:int,rows:bigint,values:bigint,repeated:bigint,largest:bigint>>"
        places = F.array(*[F.struct(*[F.lit(r[c]).alias(c) for c in ("place", "rows", "values", "repeated", "largest")])
                           for r in told]).cast(kinds)
        write(counters.select("*", places.alias("_places"), F.lit(again).alias("_whole"),
                              F.lit((last or 0) + 1).cast("bigint").alias("_no")), self.counters_path)

    def _rest(self, stored: DataFrame, batch_id: str) -> DataFrame:
        """What together with the counters of the other batches gives the totals of all stored values: those were told
        with the old rows of this batch. The largest group may have shrunk; only what is told from here on counts."""
        parts = self._totals(stored)
        if self._any():
            others = self._stored_counters().where(F.col("_batch_id") != batch_id).select(F.inline("_places"))
            less = [(-F.col(c)).alias(c) for c in ("rows", "values", "repeated")]
            parts = parts.unionByName(others.select("place", *less, F.lit(0).cast("bigint").alias("largest")))
        return parts.groupBy("place").agg(*[F.sum(c).alias(c) for c in ("rows", "values", "repeated")],
                                          F.max("largest").alias("largest"))

    # --- the whole table ------------------------------------------------------------------

    def _any(self) -> bool:
        return Folder(self.spark, self.counters_path).exists()

    def _stored_values(self) -> DataFrame:
        schema = "place int, digest binary, n bigint, _batch_id string"
        return self.spark.read.schema(schema).parquet(self.values_path).where("place >= 0")

    def _stored_counters(self) -> DataFrame:
        read = self.spark.read.option("mergeSchema", False).parquet(self.counters_path)
        return read.withColumn("_batch_id", F.col("_batch_id").cast("string"))

    def results(self) -> DataFrame:
        """One row a rule on all batches together, as ``rules.evaluate`` gives them for the whole table."""
        if not self._any():
            raise ValueError(f"{self.suite} has no batch yet")
        stored = self._stored_counters()
        present = {r.c for r in stored.select(F.explode("_columns").alias("c")).distinct().collect()}
        merged, outcomes = [F.coalesce(F.sum("_rows"), F.lit(0)).alias("_rows")], []
        for i, rule in self.by_row:
            wanted, outcome = _row_rule(i, rule, present)
            outcomes.append(outcome)
            if wanted:
                merged.append(self._merged_first(i, rule))
            if len(wanted) > 1:
                merged.append(F.sum(f"_seen{i}").alias(f"_seen{i}"))
        parts = [stored.agg(*merged).select(F.inline(F.array(*outcomes)))] if outcomes else []
        since = stored.where("_whole").agg(F.coalesce(F.max("_no"), F.lit(0))).first()[0]
        places = stored.select("_no", F.inline("_places"))
        for place, column in enumerate(self.columns):
            totals = places.where(F.col("place") == place).agg(
                *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("rows", "values", "repeated")],
                F.max(F.when((F.col("_no") >= since) & (F.col("largest") > 0), F.col("largest"))).alias("largest"))
            parts.append(totals.select(F.inline(F.array(*_grouped_outcomes(self.grouped[column])))))
        result = parts[0]
        for part in parts[1:]:
            result = result.unionByName(part)
        return result.withColumn("suite", F.lit(self.suite)).select(*RESULT_COLUMNS)

    def _merged_first(self, i: int, rule: Rule) -> Column:
        bad = F.col(f"_bad{i}")
        if rule.kind == "mean_between":
            return F.when(F.sum(f"_seen{i}") > 0, F.sum(bad) / F.sum(f"_seen{i}")).alias(f"_bad{i}")
        return (F.max(bad) if rule.kind == "fresh" else F.sum(bad)).alias(f"_bad{i}")
