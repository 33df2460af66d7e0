"""Near duplicates by SetSketch registers: band, gather candidate groups, estimate jointly, verify on full sets."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.components import components
from tidemark.llm.scratch import stored
from tidemark.llm.words import Words, chunks, grams, hash_pieces, mix, within

_EMPTY = np.zeros(0, np.uint64)


@dataclass(frozen=True)
class Sketch:
    """The sketch's parameters. At a similarity of 0.85 two sets agree in a register with probability 0.86, in a band of 6
    with 0.41, in none of 32 bands with 5e-8; at 0.8 in none with 1e-5."""

    bands: int = 32
    rows: int = 6
    base: float = 1.2

    @property
    def size(self) -> int:
        return self.bands * self.rows


def shingle_sets(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after the other, and the size of each set.

    ASCII letters are lower-cased. A text of fewer words has its whole sequence as one shingle; none: an empty set.
    """
    words = Words(column, lower=True)
    hashes = words.hashes()
    keep = within(words.text, width)
    text, shingles = words.text[: len(keep)][keep], grams(hashes, width)[keep]
    short = np.flatnonzero((words.counts > 0) & (words.counts < width))
    if len(short):
        rest = np.array([hash_pieces(hashes[words.first[t] : words.first[t + 1]].view(np.uint8), np.array([8 * words.counts[t]]), 2)[0] for t in short], np.uint64)
        text, shingles = np.concatenate([text, short]), np.concatenate([shingles, rest])
    order = np.lexsort((shingles, text))
    text, shingles = text[order], shingles[order]
    fresh = np.ones(len(text), bool)
    fresh[1:] = (text[1:] != text[:-1]) | (shingles[1:] != shingles[:-1])
    return shingles[fresh], np.bincount(text[fresh], minlength=words.n_texts)


def registers(shingles: np.ndarray, sizes: np.ndarray, sketch: Sketch) -> np.ndarray:
    """SetSketch registers (texts x registers, uint8): floor(1 - log_base of the smallest exponential value), in 0 to 255.

    A register of a union is the larger of the two registers, so sketches merge. The rate of the exponential values is
    such that sets of one element already lie above 0. Empty sets have zeros.
    """
    out = np.zeros((len(sizes), sketch.size), np.uint8)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    rng = np.random.Generator(np.random.PCG64(77))
    factors = rng.integers(0, 1 << 63, sketch.size, np.uint64) * np.uint64(2) + np.uint64(1)
    salts = rng.integers(0, 1 << 63, sketch.size, np.uint64)
    starts = np.cumsum(sizes)[full] - sizes[full]
    for i in range(sketch.size):
        x = (shingles ^ salts[i]) * factors[i]
        x >>= np.uint64(32)
        low = np.minimum.reduceat(x.astype(np.uint32), starts)
        exponential = -np.log1p(-(low + 0.5) / 2.0**32)
        out[full, i] = np.clip(np.floor(1 + _OFFSET - np.log(exponential) / np.log(sketch.base)), 1, 255)
    return out


#: Shift of the registers: the smallest exponential value of one element is below base**30 with certainty.
_OFFSET = 30


def similarity(equal: np.ndarray, more: np.ndarray, less: np.ndarray, n1: np.ndarray, n2: np.ndarray, base: float) -> np.ndarray:
    """Maximum-likelihood similarity of pairs of sets of known sizes from how many registers are equal, larger, smaller.

    The log-likelihood is concave in the similarity; golden-section search over its whole range.
    """
    u, v = n1 / (n1 + n2), n2 / (n1 + n2)

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (base - 1) / base) / np.log(base)

    def likelihood(j: np.ndarray) -> np.ndarray:
        up, down = p(u - v * j), p(v - u * j)
        return more * np.log(up + 1e-12) + less * np.log(down + 1e-12) + equal * np.log(np.maximum(1 - up - down, 1e-12))

    low, high = np.zeros(len(u)), np.minimum(u, v) / np.maximum(u, v)
    g = (np.sqrt(5) - 1) / 2
    for _ in range(24):
        a, b = high - g * (high - low), low + g * (high - low)
        left = likelihood(a) > likelihood(b)
        high, low = np.where(left, b, high), np.where(left, low, a)
    return (low + high) / 2


def sketches(docs: DataFrame, width: int, sketch: Sketch) -> DataFrame:
    """(doc_id, n_shingles, set_hash, registers) of each row with a doc_id; a narrow map over the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                shingles, sizes = shingle_sets(part.column("text"), width)
                lanes = [hash_pieces(shingles.view(np.uint8), 8 * sizes, seed) for seed in (1, 2)]
                names = np.stack(lanes, axis=1).astype(">u8").tobytes()
                rows = registers(shingles, sizes, sketch).tobytes()
                m = sketch.size
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array(sizes, pa.int64()),
                    pa.array([names[i * 16 : i * 16 + 16] for i in range(len(sizes))], pa.binary()),
                    pa.array([rows[i * m : i * m + m] for i in range(len(sizes))], pa.binary()),
                ], ["doc_id", "n_shingles", "set_hash", "registers"])

    return (docs.filter(F.col("doc_id").isNotNull()).select("doc_id", "text")
            .mapInArrow(run, "doc_id long, n_shingles long, set_hash binary, registers binary"))


def band_keys(classes: DataFrame, sketch: Sketch) -> DataFrame:
    """(band key, node): one row for each band of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            regs = np.frombuffer(b"".join(batch.column("registers").to_pylist()), np.uint8)
            keys = hash_pieces(regs, np.full(n * sketch.bands, sketch.rows), 1).reshape(n, sketch.bands)
            keys = mix(keys ^ (np.arange(1, sketch.bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
            node = np.repeat(batch.column("node").to_numpy(), sketch.bands)
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(node)], ["key", "node"])

    return classes.mapInArrow(run, "key long, node long")


def _links(block: tuple[np.ndarray, ...], left: np.ndarray, right: np.ndarray, share: int, sketch: Sketch) -> tuple[list[int], list[int]]:
    """Links that join all of the texts left and right that are linked at all: for each text in `left` its verified partners
    in `right`, left out where both are joined already. share: least similarity in per cent."""
    ids, sizes, starts, regs, local, mark, root = block

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out_a, out_b = [], []
    # Five standard deviations below the threshold: a link is missed with a chance of 3e-7 at most.
    floor = share / 100 - 5 * np.sqrt(share / 100 * (1 - share / 100) / sketch.size)
    here = right
    for i in left:
        js = here[(sizes[here] * 100 >= share * sizes[i]) & (sizes[i] * 100 >= share * sizes[here])]
        js = js[js < i] if left is right else js
        if len(js):
            tops = root[js]
            while (root[tops] != tops).any():
                tops = root[tops]
            root[js] = tops
            js = js[tops != find(i)]
        if not len(js):
            continue
        equal = (regs[js] == regs[i]).sum(axis=1)
        few = equal >= sketch.size * (floor - 0.15)
        js, equal = js[few], equal[few]
        if not len(js):
            continue
        less = (regs[js] > regs[i]).sum(axis=1)
        near = similarity(equal, sketch.size - equal - less, less, np.full(len(js), float(sizes[i])), sizes[js].astype(float), sketch.base) >= floor
        js = js[near]
        if not len(js):
            continue
        own = local[starts[i] : starts[i] + sizes[i]]
        mark[own] = True
        flat = np.repeat(starts[js] - (np.cumsum(sizes[js]) - sizes[js]), sizes[js]) + np.arange(sizes[js].sum())
        both = np.add.reduceat(mark[local[flat]], np.cumsum(sizes[js]) - sizes[js], dtype=np.int64)
        mark[own] = False
        for j in js[100 * both >= share * (sizes[i] + sizes[js] - both)].tolist():
            a, b = find(i), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
                out_a.append(int(ids[i]))
                out_b.append(int(ids[j]))
    return out_a, out_b


def near_duplicates(docs: DataFrame, width: int = 5, share: int = 80, sketch: Sketch = Sketch(),
                    block_shingles: int = 1 << 19) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of docs with a doc_id.

    Two texts are linked if 100 * |intersection| >= share * |union| holds for their sets of `width`-word shingles;
    component_id is the smallest doc_id that links reach. Texts without words are linked with nothing; a null text is
    one. Rows without a doc_id are left out. Rows that repeat a doc_id count as one document per text; ties can't
    change components. Other columns of docs are ignored.

    1. Texts with equal sets form a class, represented by its smallest doc_id; only representatives go on.
    2. Representatives that agree in a band are tied to the smallest of them; components of these ties are candidate
       groups. Nothing pairs the members of a bucket.
    3. Candidate groups are verified in tasks of bounded size: a group with more than block_shingles shingles is cut
       into blocks, and every two of its blocks meet in one task. Registers estimate each pair by likelihood; pairs not
       clearly below the threshold, and not joined already, are compared on full sets.
    4. Components of the verified links, then back from representatives to all rows.
    """
    found = stored(sketches(docs, width, sketch), "sketches")
    sets = found.filter("n_shingles > 0")
    classes = sets.groupBy("set_hash").agg(F.min("doc_id").alias("node"))
    heads = sets.join(classes.select("node", F.col("set_hash").alias("h")), (F.col("doc_id") == F.col("node")) & (F.col("set_hash") == F.col("h")), "left_semi")
    heads = heads.select(F.col("doc_id").alias("node"), "registers")
    keys = stored(band_keys(heads, sketch), "bands")
    tied = keys.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high").select("key", "low")
    ties = keys.join(tied, "key").filter("node != low").select("node", "low")
    groups = stored(components(ties, "node", "low"), "groups")

    total = (groups.join(sets.select(F.col("doc_id").alias("node"), "n_shingles"), "node")
             .groupBy("component").agg(F.sum("n_shingles").alias("all")))
    total = stored(total, "totals")
    whole = total.filter(F.col("all") <= block_shingles).agg(F.sum("all")).first()[0] or 0
    n_blocks = F.ceil(F.col("all") / block_shingles).cast("int")
    # Small groups share tasks; a group of several blocks has keys of its own, below 0.
    blocks = total.select(F.col("component").alias("c"), n_blocks.alias("blocks"),
                          F.when(n_blocks == 1, F.pmod(F.xxhash64("component"), F.lit(1 + whole // block_shingles)))
                          .otherwise(-1 - F.pmod(F.xxhash64("component"), F.lit(1 << 62))).alias("bin"))
    members = (groups.join(blocks, F.col("component") == F.col("c"))
               .select("node", "component", "bin", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("own")))
    texts = docs.select("doc_id", "text").join(members, F.col("doc_id") == F.col("node"))
    meeting = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(F.least(x, "own").alias("one"), F.greatest(x, "own").alias("two")))
    met = texts.withColumn("at", F.explode(meeting)).select("bin", "component", "at.one", "at.two", "own", "doc_id", "text")

    def verify(group: pd.DataFrame) -> pd.DataFrame:
        ids, own, component = (group[c].to_numpy() for c in ("doc_id", "own", "component"))
        shingles, sizes = shingle_sets(pa.array(group["text"], pa.string()), width)
        _, local = np.unique(shingles, return_inverse=True)
        block = (ids, sizes, np.cumsum(sizes) - sizes, registers(shingles, sizes, sketch), local,
                 np.zeros(int(local.max(initial=-1)) + 1, bool), np.arange(len(ids)))
        one, two = group["one"].iloc[0], group["two"].iloc[0]
        out: tuple[list[int], list[int]] = ([], [])
        order = np.argsort(component, kind="stable")
        for members in np.split(order, np.flatnonzero(np.diff(component[order])) + 1):
            left, right = members[own[members] == one], members[own[members] == two]
            for side, found in zip(out, _links(block, left, left if one == two else right, share, sketch), strict=True):
                side.extend(found)
        return pd.DataFrame({"a": np.array(out[0], np.int64), "b": np.array(out[1], np.int64)})

    links = met.groupBy("bin", "one", "two").applyInPandas(verify, "a long, b long")
    linked = components(links, "a", "b").select(F.col("node").alias("linked_node"), "component")
    rep = sets.join(classes.select(F.col("set_hash").alias("h"), "node"), F.col("set_hash") == F.col("h"))
    resolved = (rep.join(linked, F.col("node") == F.col("linked_node"), "left")
                .select("doc_id", "n_shingles", F.coalesce("component", "node").alias("component_id")))
    alone = found.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return resolved.unionByName(alone).withColumn("kept", F.col("doc_id") == F.col("component_id"))


def keep_one(docs: DataFrame, width: int = 5, share: int = 80) -> DataFrame:
    """docs without the rows whose near-duplicate group has an earlier document; rows without a doc_id stay.

    Rows that repeat a doc_id with texts of one group all stay or all go.
    """
    going = near_duplicates(docs, width, share).filter(~F.col("kept")).select(F.col("doc_id").alias("going")).distinct()
    return docs.join(going, docs["doc_id"] == going["going"], "left_anti")
