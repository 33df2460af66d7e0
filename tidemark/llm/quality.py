"""Quality classifier: histogram gradient-boosted trees over statistics of a text, traversed as flat arrays."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from tidemark.llm.words import Words, chunks

#: At most so many labelled rows are learnt from: those with the smallest hash of their doc_id. It bounds what is
#: broadcast and what the driver sees (SAMPLE rows of FEATURES numbers).
SAMPLE = 20_000

_CLASSES = {
    "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)), "digit": b"0123456789", "space": b" ", "newline": b"\n",
    "stop": b".,;:?'\"()-", "shout": b"!", "bar": b"|", "sign": b"#$%&*+=@^~_", "angle": b"<>{}[]\\/`",
    "wide": bytes(range(128, 256)),
}
FEATURES = ["log_bytes", "log_words", *_CLASSES, "word_mean", "word_spread", "short", "distinct", "top_word", "ends_in_stop",
            "starts_upper", "all_upper", "ends_in_sign", "entropy"]


_STRETCH = 1 << 20


def features(column: pa.Array) -> np.ndarray:
    """A row of FEATURES for each text; null and empty texts have zeros throughout."""
    words = Words(column)
    n, data = words.n_texts, words.raw
    sizes = np.diff(words.offsets)
    if n == 1:  # a text of any length: counted stretch by stretch
        counts = sum((np.bincount(data[i : i + _STRETCH], minlength=256) for i in range(0, len(data), _STRETCH)), np.zeros(256)).reshape(1, 256)
    else:
        counts = np.bincount(np.repeat(np.arange(n), sizes) * 256 + data, minlength=n * 256).reshape(n, 256).astype(float)
    total, w = np.maximum(sizes, 1).astype(float), np.maximum(words.counts, 1).astype(float)
    out = [np.log1p(sizes), np.log1p(words.counts)]
    out += [counts[:, list(members)].sum(axis=1) / total for members in _CLASSES.values()]
    lengths = (words.ends - words.starts).astype(float)

    def share(flags: np.ndarray) -> np.ndarray:
        return np.bincount(words.text, weights=flags, minlength=n) / w

    mean = share(lengths)
    out += [mean, np.sqrt(np.maximum(share(lengths**2) - mean**2, 0)), share(lengths <= 2)]
    hashes = words.hashes()
    order = np.lexsort((hashes, words.text))
    h, t = hashes[order], words.text[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    first = np.flatnonzero(fresh)
    often = np.zeros(n)
    np.maximum.at(often, t[first], np.diff(np.append(first, len(h))))
    out += [np.bincount(t[first], minlength=n) / w, often / w]
    kind = np.zeros(256, np.int8)
    for i, name in enumerate(("stop", "upper", "sign", "shout"), 1):
        kind[list(_CLASSES[name])] = i
    start, end = kind[data[words.starts]], kind[data[words.ends - 1]]
    uppers = np.concatenate([np.zeros(1, np.int32), np.cumsum(kind[data] == 2, dtype=np.int32)])
    capital = (uppers[words.ends] - uppers[words.starts]) * 2 > lengths
    out += [share(end == 1), share(start == 2), share(capital), share(end >= 3)]
    p = counts / total[:, None]
    out.append(-(p * np.log(np.maximum(p, 1e-12))).sum(axis=1))
    return np.stack(out, axis=1)


@dataclass(frozen=True)
class Trees:
    """Complete trees of one depth in arrays: feature and cut of each inner node, value of each leaf."""

    bias: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1: all rows go down each tree at once, node 2i + 1 or 2i + 2 at every level."""
        total = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        depth = self.leaf.shape[1].bit_length() - 1
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - (2**depth - 1)]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15,
        l2: float = 1.0, least: float = 1.0) -> Trees:
    """Newton boosting of the logistic loss; splits are sought on histograms of at most `bins` quantile bins a feature.

    A leaf needs a second derivative of `least`: no more, or a rare label among few rows never gets a leaf of its own and
    its scores stay near the common one's. Ties in gain go to the lowest feature and cut. Without rows, or with one label only, the score is constant.
    """
    nodes = 2**depth - 1
    rate_of_1 = (y.sum() + 1) / (len(y) + 2)
    bias = float(np.log(rate_of_1 / (1 - rate_of_1)))
    feature, cut, leaf = (np.zeros((trees, nodes), np.int64), np.full((trees, nodes), np.inf), np.zeros((trees, nodes + 1)))
    if len(y) == 0 or y.min() == y.max():
        return Trees(bias, feature[:0], cut[:0], leaf[:0])
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for c in x.T]
    codes = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)], axis=1)
    n, d = x.shape
    score = np.full(n, bias)
    cells = np.arange(d) * bins
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            width, base = 2**level, 2**level - 1
            at = ((node - base)[:, None] * (d * bins) + cells + codes).ravel()
            shape = (width, d, bins)
            gs, hs = (np.bincount(at, weights=np.repeat(v, d), minlength=width * d * bins).reshape(shape).cumsum(axis=2) for v in (g, h))
            ga, ha = gs[:, :1, -1:], hs[:, :1, -1:]
            gain = gs**2 / (hs + l2) + (ga - gs) ** 2 / (ha - hs + l2) - ga**2 / (ha + l2)
            gain[(hs < least) | (ha - hs < least)] = -1
            gain = gain.reshape(width, -1)
            best = gain.argmax(axis=1)
            for k in range(width):
                f, b = divmod(int(best[k]), bins)
                if gain[k, best[k]] > 1e-9 and b < len(edges[f]):
                    feature[t, base + k], cut[t, base + k] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[t, node]] > cut[t, node])
        slot = node - nodes
        gs, hs = np.bincount(slot, weights=g, minlength=nodes + 1), np.bincount(slot, weights=h, minlength=nodes + 1)
        leaf[t] = -rate * gs / (hs + l2)
        score += leaf[t][slot]
    return Trees(bias, feature, cut, leaf)


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; -1 for a null id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(n)).cast("int"), F.lit(-1))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, **settings) -> Trees:
    """Trees from the labelled rows outside fold 0 of 5. Only the bounded sample's features reach the driver.

    A doc_id with several labels counts as 1 if any is 1, one with several texts has the smallest features; null labels and ids, and ids without a document, teach nothing.
    """
    rows = (labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), 5) != 0))
            .groupBy(F.col("doc_id").alias("labelled")).agg(F.max("quality").alias("quality"))
            .orderBy(F.xxhash64("labelled"), "labelled").limit(sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                x = features(part.column("text"))
                values = pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1)), x.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("quality"), values], ["doc_id", "quality", "x"])

    taught = (docs.select("doc_id", "text").join(F.broadcast(rows), F.col("doc_id") == F.col("labelled"))
              .select("doc_id", F.col("quality").cast("long").alias("quality"), "text")
              .mapInArrow(run, "doc_id long, quality long, x array<double>")
              .groupBy("doc_id", "quality").agg(F.min("x").alias("x")).toArrow().combine_chunks())
    if not taught.num_rows:
        return fit(np.zeros((0, len(FEATURES))), np.zeros(0), **settings)
    x = np.array(taught.column("x").to_pylist())
    order = np.lexsort((*x.T, taught.column("doc_id").to_numpy()))
    return fit(x[order], taught.column("quality").to_numpy()[order].astype(float), **settings)


def scored(docs: DataFrame, trees: Trees, out: str = "score") -> DataFrame:
    """docs with the score of each text, in a narrow map; null texts score as empty ones. A column named `out` is replaced."""
    kept = docs.drop(out)
    schema = T.StructType([*kept.schema.fields, T.StructField(out, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(trees.score(features(part.column("text"))))], [*part.schema.names, out])

    return kept.mapInArrow(run, schema)


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of docs; a null doc_id is not held out."""
    trees = train(docs, labels)
    return scored(docs.select("doc_id", "text"), trees).select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of docs whose score is at least the threshold."""
    columns, name = docs.columns, "score"
    while name in columns:
        name += "_"
    return scored(docs, train(docs, labels), name).filter(F.col(name) >= threshold).select(*columns)
