"""A Merkle manifest of a table: trees built from the leaves up, proofs found by descent through content-addressed records."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.ranks import placed
from tidemark.llm.scratch import stored

#: The fields of a leaf, in their order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels of a tree that one record bundle holds: at most 2**LEVELS leaves a bundle, in one row of some 200 KB.
LEVELS = 10


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(fields: list[Column]) -> Column:
    """The lowercase hex sha256 over all fields: `-` for a null, else UTF-8 byte count, `:`, and the value."""
    shown = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-")) for s in shown]), 256)


def height_of(n: Column, fanout: int) -> Column:
    """How often n nodes are joined by runs of fanout until one is left."""
    level, width, high = F.lit(0), 1, 0
    while width < 1 << 62:
        level = F.when(n > F.lit(width), F.lit(high + 1)).otherwise(level)
        width, high = width * fanout, high + 1
    return level


@dataclass(frozen=True)
class Trees:
    """Trees of a group each: `tops` (tree, top, height) and, by round from the leaves up, bundles of records.

    A bundle (tree, block, top, records) holds the records (digest, children) of up to LEVELS levels below its top; its
    digit path is the block's place. A record says which digests, joined and hashed, make its own.
    """

    tops: DataFrame
    bundles: list[DataFrame]
    fanout: int


def grow(leaves: DataFrame, fanout: int = 2, levels: int = LEVELS, name: str = "tree") -> Trees:
    """Trees over leaves (tree long, place long, places long, digest string); place is gapless from 0 in each tree.

    Each round joins blocks of fanout**levels neighbours by up to `levels` levels, in one task a block, and stores the
    records. Rounds grow with the logarithm of the largest tree; the rows of each are a fanout**levels-th of the last.
    """
    width = fanout**levels
    schema = "tree long, block long, places long, top string, height int, records array<struct<digest: string, children: array<string>>>"

    def join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                nodes = [n["digest"] for n in row["nodes"]]
                left, high, records = row["places"], 0, []
                while left > 1 and high < levels:
                    runs = [nodes[i : i + fanout] for i in range(0, len(nodes), fanout)]
                    nodes = [digest(*run) for run in runs]
                    records += [{"digest": d, "children": run} for d, run in zip(nodes, runs, strict=True)]
                    left, high = -(-left // fanout), high + 1
                yield pa.RecordBatch.from_pylist([{
                    "tree": row["tree"], "block": row["block"], "places": left, "top": nodes[0], "height": high, "records": records}], _SCHEMA)

    nodes, bundles, tops = leaves.select("tree", "place", "places", "digest"), [], []
    most = nodes.agg(F.max("places")).first()[0] or 0
    while True:
        blocks = (nodes.groupBy("tree", "places", F.expr(f"place div {width}").alias("block"))
                  .agg(F.array_sort(F.collect_list(F.struct("place", "digest"))).alias("nodes")))
        made = stored(blocks.mapInArrow(join_up, schema), f"{name}-bundles")
        bundles.append(made)
        tops.append(made.where("places = 1").select("tree", "top", F.lit(len(bundles) - 1).alias("round")))
        most = -(-most // width)
        if most <= 1:
            break
        nodes = made.where("places > 1").select("tree", F.col("block").alias("place"), "places", F.col("top").alias("digest"))
    found = tops[0]
    for more in tops[1:]:
        found = found.unionByName(more)
    return Trees(found, bundles, fanout)


_SCHEMA = pa.schema([("tree", pa.int64()), ("block", pa.int64()), ("places", pa.int64()), ("top", pa.string()), ("height", pa.int32()),
                     ("records", pa.list_(pa.struct([("digest", pa.string()), ("children", pa.list_(pa.string()))])))])
_STEP = "array<struct<before: string, after: string>>"


def prove(trees: Trees, requests: DataFrame, above: DataFrame | None = None, levels: int = LEVELS) -> DataFrame:
    """requests (tree, place, request) with `path`: the siblings from the place's own level up to the top of its tree, and on.

    path is an array of (before, after), a level each: the joined digests of the run's other nodes on either side.
    `above` (tree, upper path) are steps that follow for all places of a tree. `request` is any column, handed through. A
    place that repeats is answered as often; one that the tree lacks is left out.

    The descent starts with one row a tree at its top. In each round the bundle whose top is the row's digest is looked up,
    and every wanted place below it is reached by its digits in base fanout: the record of a digest gives its children, the
    digit selects one, the others are a step. Rows stand for all requests that share a path so far, so the top of a tree is
    looked up once and not by each of its requests. Segments of the path come from the top down and are reversed.
    """
    fanout = trees.fanout
    width = fanout**levels
    last = len(trees.bundles) - 1

    def descend(batches: Iterator[pa.RecordBatch], out: pa.Schema) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                children = {r["digest"]: r["children"] for r in row["records"]}
                rows = []
                for want in row["wanted"]:
                    at, steps = row["top"], []
                    for level in range(row["height"] - 1, -1, -1):
                        run, digit = children[at], want["digit"] // fanout**level % fanout
                        if digit >= len(run):
                            break
                        steps.append({"before": "".join(run[:digit]), "after": "".join(run[digit + 1 :])})
                        at = run[digit]
                    else:
                        if want["digit"] < fanout ** row["height"]:
                            steps.reverse()
                            rows.append({"tree": row["tree"], "place": row["block"] * width + want["digit"], "top": at,
                                         "request": want["request"], "path": steps + row["path"]})
                yield pa.RecordBatch.from_pylist(rows, out)

    upper = above if above is not None else trees.tops.select("tree", F.array().cast(_STEP).alias("path"))
    begin = trees.tops.join(upper, "tree").select("tree", "round", F.lit(0).cast("long").alias("place"), "top", "path")
    kind = dict(requests.dtypes)["request"]
    state = None
    for turn in range(last, -1, -1):
        here = begin.where(F.col("round") == turn).drop("round")
        state = here if state is None else here.unionByName(state)
        part = F.expr(f"place div {width ** turn}")
        asked = requests.select("tree", F.expr(f"place div {width ** (turn + 1)}").alias("place"), F.expr(f"{width}").alias("__w"), part.alias("__p"), *(["request"] if turn == 0 else []))
        asked = asked.select("tree", "place", (F.col("__p") % F.col("__w")).alias("digit"), *(["request"] if turn == 0 else [F.lit(None).cast("int").alias("request")]))
        if turn:
            asked = asked.distinct()
        wanted = asked.groupBy("tree", "place").agg(F.collect_list(F.struct("digit", "request")).alias("wanted"))
        handed = kind if turn == 0 else "int"
        records = trees.bundles[turn].select("tree", F.col("block").alias("place"), "top", "height", "records")
        joined = (state.join(wanted, ["tree", "place"]).join(records, ["tree", "place", "top"])
                  .select("tree", F.col("place").alias("block"), "top", "path", "height", "records", "wanted"))
        ddl = f"tree long, place long, top string, request {handed}, path {_STEP}"
        state = joined.mapInArrow(_with_schema(descend, joined.sparkSession, ddl), ddl)
        if turn:
            state = stored(state.drop("request"), "descent")
    return state.withColumnRenamed("top", "digest")


def _with_schema(f, spark, ddl):
    """f with the Arrow schema of its output, found on the driver."""
    from pyspark.sql.pandas.types import to_arrow_schema

    out = to_arrow_schema(spark.createDataFrame([], ddl).schema)
    return lambda batches: f(batches, out)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of a path give."""
    return F.aggregate(path, leaf, lambda at, step: F.sha2(F.concat(step["before"], at, step["after"]), 256))


@dataclass(frozen=True)
class Manifest:
    """leaves (doc_id, lang, leaf, presented, tree, place), one tree for each lang, one tree over their tops."""

    leaves: DataFrame
    trees: Trees
    crown: Trees


def build(docs: DataFrame, presented: Column | None = None, fanout: int = 2, levels: int = LEVELS) -> Manifest:
    """The manifest of docs: leaves by lang in ascending order of doc_id (nulls first, equal ids by digest), subroots by lang.

    `presented` is the digest that a holder of the row shows; the leaf itself by default. Texts are read once and stay
    where they are; digests and ids move. A null text or id is a field like any other; an empty table has no trees.
    """
    leaf = leaf_digest([F.col(f) for f in FIELDS])
    hashed = docs.select("doc_id", "lang", leaf.alias("leaf"), (leaf if presented is None else presented).alias("presented"))
    rows = placed(stored(hashed, "leaves"), "lang", [F.col("doc_id").asc_nulls_first(), F.col("leaf")], "placed")
    langs = placed(rows.groupBy("lang").agg(F.first("places").alias("size")), None, [F.col("lang").asc_nulls_first()], "langs")
    langs = langs.select(F.col("lang").alias("__lang"), F.col("place").alias("tree"), F.col("places").alias("n_trees"))
    leaves = stored(rows.join(langs, F.col("lang").eqNullSafe(F.col("__lang"))).drop("__lang"), "leaf-table")
    trees = grow(leaves.select("tree", "place", "places", F.col("leaf").alias("digest")), fanout, levels)
    counted = langs.select("tree", "n_trees")
    crown = grow(trees.tops.join(counted, "tree").select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"),
                                                         F.col("n_trees").alias("places"), F.col("top").alias("digest")), fanout, levels, "crown")
    return Manifest(leaves.drop("n_trees", "places"), trees, crown)


def proofs(manifest: Manifest, requests: DataFrame | None = None, levels: int = LEVELS) -> DataFrame:
    """(doc_id, leaf, presented, subroot, root, path) for the leaves in requests, rows of manifest.leaves; for all by default.

    path is as in prove(), from the leaf's level over its subroot up to the root. One descent finds the subroots that are
    asked for in the tree over them, the next goes on from these subroots to the leaves.
    """
    asked = manifest.leaves if requests is None else requests
    root = manifest.crown.tops.first()  # one digest, or none of an empty table
    trees = asked.select("tree").distinct()
    crowned = prove(manifest.crown, trees.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), F.lit(None).cast("int").alias("request")), levels=levels)
    above = stored(crowned.select(F.col("place").alias("tree"), F.col("digest").alias("subroot"), "path"), "subroots")
    wanted = asked.select("tree", "place", F.struct("doc_id", "leaf", "presented").alias("request"))
    found = prove(manifest.trees, wanted, above.drop("subroot"), levels)
    return (found.join(above.select("tree", "subroot"), "tree")
            .select("request.doc_id", "request.leaf", "request.presented", "subroot", F.lit(root["top"] if root else None).cast("string").alias("root"), "path"))


def tampered(row_check: int = 7) -> Column:
    """The digest of a row with 1 added to n_chars where row_check divides the crc32 of the decimal doc_id, else its own."""
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % row_check == 0, F.lit(False)) & F.col("n_chars").isNotNull()
    n = F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    return leaf_digest([n if f == "n_chars" else F.col(f) for f in FIELDS])


def verified(docs: DataFrame) -> DataFrame:
    """For each row its leaf, subroot, root, the digest of its proof, and the root that the (partly tampered) row gives.

    Rows that are equal in all fields, or in their id alone, each have a leaf; rows without an id come first in their lang.
    """
    found = proofs(build(docs, tampered()))
    folded = fold(F.col("presented"), F.col("path"))
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["before"], s["after"])), "")
    return (found.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), folded.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))
