"""Language-model scores from the lattice of all segmentations of a word into pieces of an existing vocabulary."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.quality import fold
from tidemark.llm.scratch import stored
from tidemark.llm.words import Words, chunks, hash_pieces, mix

#: So many of the most frequent words are held by every task; all others are joined. Bounds what is broadcast.
HOT = 1 << 18
#: Fold of 7 that is held out.
HELD_OUT = 2

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_SLOTS = 21
#: What stands behind each word in a block: no byte.
_END = 256


class Pieces:
    """The vocabulary: bytes of each piece, a lookup by rolling hash, and first scores.

    A piece's word-begin mark is one space byte. Control and unknown pieces take no part; a byte piece matches its byte.
    The vocabulary's own scores are merge ranks (0, -1, -2 ...), not log-probabilities; a piece of score -r starts with
    the weight 1 / (r + 10), so that earlier pieces weigh more.
    """

    def __init__(self, model_file: str):
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        texts, scores = [b" "], [0.0]
        for i in range(model.get_piece_size()):
            if model.is_control(i) or model.is_unknown(i):
                continue
            piece = bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
            texts.append(piece)
            scores.append(-40_000.0 if model.is_byte(i) else model.get_score(i))
        seen: dict[bytes, int] = {}
        for text, score in zip(texts, scores, strict=True):
            seen[text] = max(seen.get(text, -1e9), score)
        self.texts = list(seen)
        weights = 1 / (10.0 - np.array(list(seen.values())))
        self.first = np.log(weights / weights.sum())
        self.longest = max(map(len, self.texts))
        keys = np.array([self._key(t) for t in self.texts], np.uint64)
        self.keys = keys
        self.tables = [np.full(1 << _SLOTS, -1, np.int32) for _ in range(2)]
        one, two = (keys >> np.uint64(64 - _SLOTS)).astype(np.int64), (keys & np.uint64((1 << _SLOTS) - 1)).astype(np.int64)
        for i in range(len(keys)):
            table, slot = (self.tables[0], one[i]) if self.tables[0][one[i]] < 0 else (self.tables[1], two[i])
            if table[slot] >= 0:
                raise ValueError("two pieces share both slots")
            table[slot] = i
        self._trie()

    def _trie(self) -> None:
        """steps: the node reached from node i by byte b at i * 257 + b, or -1; piece: of each node, or -1. The first `inner` nodes lead on."""
        nodes: dict[bytes, int] = {b"": 0}
        for text in self.texts:
            for i in range(1, len(text)):
                nodes.setdefault(text[:i], len(nodes))
        self.inner = len(nodes)
        for text in self.texts:
            nodes.setdefault(text, len(nodes))
        steps = np.full((self.inner, _END + 1), -1, np.int32)
        for text, node in nodes.items():
            if text:
                steps[nodes[text[:-1]], text[-1]] = node
        self.steps = steps.ravel()
        self.piece = np.full(len(nodes), -1, np.int32)
        self.piece[[nodes[text] for text in self.texts]] = np.arange(len(self.texts))

    @staticmethod
    def _key(text: bytes) -> int:
        h = np.zeros(1, np.uint64)
        for b in text:
            h = h * _MULTIPLIER + np.uint64(b + 1)
        return int(mix(h)[0])

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Index of the piece with each key, or -1."""
        at = self.tables[0][(keys >> np.uint64(64 - _SLOTS)).astype(np.int64)]
        at = np.where((at >= 0) & (self.keys[at] == keys), at, -1)
        miss = np.flatnonzero(at < 0)
        other = self.tables[1][(keys[miss] & np.uint64((1 << _SLOTS) - 1)).astype(np.int64)]
        at[miss] = np.where((other >= 0) & (self.keys[other] == keys[miss]), other, -1)
        return at


@lru_cache(maxsize=2)
def pieces(model_file: str) -> Pieces:
    return Pieces(model_file)


def _blocks(data: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places, text, offset) of consecutive words: a space, the word's bytes and _END for each; offset is the place in its word. No long words."""
    starts = np.cumsum(lengths) - lengths
    places = np.flatnonzero(lengths <= _LONG)
    cells = np.cumsum(lengths[places] + 2)
    first = 0
    while first < len(places):
        last = max(first + 1, int(np.searchsorted(cells, (cells[first - 1] if first else 0) + _CELLS, "right")))
        some = places[first:last]
        sizes = lengths[some] + 2
        ends = np.cumsum(sizes)
        offset = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)
        text = np.empty(len(offset), np.int64)
        text[ends - sizes], text[ends - 1] = ord(" "), _END
        inside = np.ones(len(offset), bool)
        inside[ends - sizes] = inside[ends - 1] = False
        text[inside] = data[np.repeat(starts[some] - 1, lengths[some]) + offset[inside]]
        yield some, text, offset
        first = last


def _lattice(vocabulary: Pieces, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, piece) of every piece found in the words of a block: the trie is walked from all their places at once."""
    at = np.flatnonzero(text != _END)
    node = np.zeros(len(at), np.int32)
    found = []
    for width in range(1, vocabulary.longest + 1):
        node = vocabulary.steps[node * (_END + 1) + text[at + width - 1]]
        some = np.flatnonzero(node >= 0)
        at, node = at[some], node[some]
        piece = vocabulary.piece[node]
        hit = np.flatnonzero(piece >= 0)
        found.append((at[hit], at[hit] + width, piece[hit]))
        some = np.flatnonzero(node < vocabulary.inner)
        at, node = at[some], node[some]
    start, end, piece = (np.concatenate(column) for column in zip(*found, strict=True))
    return start, end, piece


def _levels(offset: np.ndarray) -> tuple[np.ndarray, list[slice]]:
    """The arcs ordered by the offset of one of their ends, and the slice of each offset."""
    bounds = np.concatenate([[0], np.cumsum(np.bincount(offset))]).tolist()
    # Sixteen bits, which numpy sorts by digits, hold the offsets of all words up to _LONG.
    small = offset.astype(np.uint16) if len(bounds) <= 1 << 16 else offset
    return np.argsort(small, kind="stable"), [slice(*two) for two in pairwise(bounds)]


def _forward(arcs: tuple, weight: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """Log of the summed weight of all segmentations before each place; unreachable ones have -inf."""
    alpha = np.where(offset == 0, 0, -np.inf)
    order, levels = _levels(offset[arcs[0]])
    start, end, weight = arcs[0][order], arcs[1][order], weight[order]
    # Arcs that start at the same offset have different ends, so none is lost where several are put at once.
    for some in levels:
        alpha[end[some]] = np.logaddexp(alpha[end[some]], alpha[start[some]] + weight[some])
    return alpha


def _backward(arcs: tuple, weight: np.ndarray, text: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """_forward() from the end: of all segmentations from each place on."""
    beta = np.where(text == _END, 0, -np.inf)
    order, levels = _levels(offset[arcs[1]])
    start, end, weight = arcs[0][order], arcs[1][order], weight[order]
    for some in reversed(levels):
        beta[start[some]] = np.logaddexp(beta[start[some]], beta[end[some]] + weight[some])
    return beta


#: So many bytes of words are taken at once.
_CELLS = 1 << 15
#: Words above so many bytes are taken one at a time, all places of a stretch at once.
_LONG, _STRETCH = 512, 1 << 14


def _word(data: np.ndarray) -> np.ndarray:
    """A word with the space before it: bytes plus one, as the rolling hash takes them."""
    return np.concatenate([[ord(" ") + 1], data.astype(np.uint64) + np.uint64(1)]).astype(np.uint64)


def _arcs(vocabulary: Pieces, score: np.ndarray, word: np.ndarray, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """(found, weight) for each start in first..last and each width up to the longest piece: the piece or -1, its score or -inf."""
    span = last - first
    found = np.full((span, vocabulary.longest), -1, np.int32)
    h = np.zeros(span, np.uint64)
    for width in range(1, vocabulary.longest + 1):
        n = min(span, len(word) - first - width + 1)
        if n <= 0:
            break
        h = h[:n] * _MULTIPLIER + word[first + width - 1 : first + width - 1 + n]
        found[:n, width - 1] = vocabulary.find(mix(h.copy()))
    return found, np.where(found >= 0, score[found], -np.inf)


def _long_forward(vocabulary: Pieces, score: np.ndarray, word: np.ndarray) -> np.ndarray:
    """_forward() of one long word: time and memory grow with its length, the arcs of one stretch are held at a time."""
    n = len(word)
    alpha = np.full(n + 1 + vocabulary.longest, -np.inf)
    alpha[0] = 0
    for first in range(0, n, _STRETCH):
        _, weight = _arcs(vocabulary, score, word, first, min(n, first + _STRETCH))
        for at, row in enumerate(weight, first):
            if alpha[at] > -np.inf:
                ahead = alpha[at + 1 : at + 1 + vocabulary.longest]
                np.logaddexp(ahead, alpha[at] + row, out=ahead)
    return alpha[: n + 1]


def _long_expected(vocabulary: Pieces, score: np.ndarray, word: np.ndarray, total: np.ndarray) -> None:
    """Adds the expected pieces of one long word to total: the backward pass makes the arcs of each stretch anew."""
    n, alpha = len(word), _long_forward(vocabulary, score, word)
    if alpha[n] == -np.inf:
        return
    beta = np.full(n + 1 + vocabulary.longest, -np.inf)
    beta[n] = 0
    for first in reversed(range(0, n, _STRETCH)):
        found, weight = _arcs(vocabulary, score, word, first, min(n, first + _STRETCH))
        for at in range(first + len(weight) - 1, first - 1, -1):
            weight[at - first] += beta[at + 1 : at + 1 + vocabulary.longest]
            beta[at] = np.logaddexp.reduce(weight[at - first])
        share = np.exp(alpha[first : first + len(weight), None] + weight - alpha[n])
        ok = found >= 0
        total += np.bincount(found[ok], weights=share[ok], minlength=len(total))


def _long_words(data: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    ends = np.cumsum(lengths)
    for i in np.flatnonzero(lengths > _LONG).tolist():
        yield i, _word(data[ends[i] - lengths[i] : ends[i]])


def word_log_probability(vocabulary: Pieces, score: np.ndarray, data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Natural log of the marginal probability of each word: the forward recursion over all its segmentations."""
    out = np.zeros(len(lengths))
    for places, text, offset in _blocks(data, lengths):
        arcs = _lattice(vocabulary, text)
        out[places] = _forward(arcs, score[arcs[2]], offset)[text == _END]
    for i, word in _long_words(data, lengths):
        out[i] = _long_forward(vocabulary, score, word)[-1]
    return out


def expected(vocabulary: Pieces, score: np.ndarray, data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """How often each piece is expected in the words, over all segmentations by their weight (forward and backward)."""
    total = np.zeros(len(score))
    for places, text, offset in _blocks(data, lengths):
        arcs = start, end, piece = _lattice(vocabulary, text)
        weight = score[piece]
        alpha = _forward(arcs, weight, offset)
        whole = np.repeat(alpha[text == _END], lengths[places] + 2)
        with np.errstate(invalid="ignore"):
            share = np.exp(alpha[start] + weight + _backward(arcs, weight, text, offset)[end] - whole[start])
        total += np.bincount(piece, weights=np.nan_to_num(share), minlength=len(score))
    for _, word in _long_words(data, lengths):
        _long_expected(vocabulary, score, word, total)
    return total


@dataclass(frozen=True)
class Model:
    """What scoring needs besides counts: the pieces' log-probabilities and the numbers of the training rows.

    tokens, distinct, documents: training tokens with ends, distinct ones, training documents. discount: taken off the
    count of each known word; what is taken is the weight of the lattice.
    """

    model_file: str
    score: np.ndarray
    tokens: int
    distinct: int
    documents: int
    words: int
    types: int
    discount: float

    def log10(self, data: np.ndarray, lengths: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """log10 of each word's probability as a token: its discounted share of the training words, plus the lattice's part."""
        lattice = word_log_probability(pieces(self.model_file), self.score, data, lengths)
        known, spare = (np.maximum(counts - self.discount, 0) / self.words, self.discount * self.types / self.words) if self.words else (0 * counts, 1.0)
        with np.errstate(divide="ignore"):
            inside = np.logaddexp(np.log(known), np.log(spare) + lattice)
        return (inside + np.log((self.words + 1) / (self.words + self.documents + 2))) / np.log(10)

    def end(self) -> float:
        return float(np.log10((self.documents + 1) / (self.words + self.documents + 2)))

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1) / (self.tokens + self.distinct + 1))


def _flat(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int64)
    buffer = words.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]] if buffer is not None and len(buffer) else np.zeros(0, np.uint8)
    return data, np.diff(offsets)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word binary, n): how often each word, ASCII letters lower-cased, occurs in the whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                counted = Words(part.column("text"), lower=True).array().value_counts()
                yield pa.RecordBatch.from_arrays([counted.field(0).cast(pa.binary()), counted.field(1).cast(pa.int64())], ["word", "n"])

    return docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, model_file: str, rounds: int = 2, smoothing: float = 0.1) -> tuple[Model, DataFrame]:
    """The model, and the stored table of word counts it goes with.

    The pieces' scores start from the vocabulary's own and are fitted to the distinct words of the training rows by
    expectation maximisation. Each round is a job over all distinct words; it returns a number for each piece, so what
    reaches the driver is bounded by the vocabulary.
    """
    counts = stored(word_counts(docs), "word-counts")
    n = counts.agg(F.count("*").alias("types"), F.coalesce(F.sum("n"), F.lit(0)).alias("words"),
                   F.count(F.when(F.col("n") == 1, 1)).alias("once"), F.count(F.when(F.col("n") == 2, 1)).alias("twice")).first()
    documents = docs.count()
    vocabulary = pieces(model_file)
    score = vocabulary.first
    for _ in range(rounds):
        found = np.zeros(len(score))
        for row in _expected_counts(counts, model_file, score).toLocalIterator():
            found[row["piece"]] = row["n"]
        found += smoothing
        score = np.log(found / found.sum())
    discount = n["once"] / max(1, n["once"] + 2 * n["twice"]) if n["once"] else 0.5
    return Model(model_file, score, n["words"] + documents, n["types"] + (documents > 0), documents, n["words"], n["types"],
                 min(0.95, max(0.05, discount))), counts


def _expected_counts(counts: DataFrame, model_file: str, score: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, total = pieces(model_file), np.zeros(len(score))
        for batch in batches:
            total += expected(vocabulary, score, *_flat(batch.column("word").cast(pa.large_binary())))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], ["piece", "n"])

    return counts.select("word").mapInArrow(run, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n"))


def score_documents(docs: DataFrame, model_file: str, hot: int = HOT) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each document.

    Learns from the rows outside fold HELD_OUT of 7; a null doc_id is in no fold and so teaches. A null or empty text is
    its end alone. Rows that repeat a doc_id, or have none, are scored together as one document. A word may be of any length:
    time and memory grow with it.

    The `hot` most frequent words are scored where they are read. All others, one row for each document and word,
    are joined with the counts, so no word's count is needed on one machine together with all others.
    """
    kept = docs.select("doc_id", "text")
    held = fold(F.col("doc_id"), 7) == HELD_OUT
    model, counts = learn(kept.filter(~held), model_file)
    top = counts.orderBy(F.desc("n"), "word").limit(hot).toArrow().combine_chunks()
    names = top.column("word").combine_chunks().cast(pa.large_binary()) if top.num_rows else pa.array([], pa.large_binary())
    data, lengths = _flat(names)
    times = top.column("n").to_numpy().astype(float)
    table = np.stack([model.base(times), model.log10(data, lengths, times)]) if len(times) else np.zeros((2, 0))
    keys = hash_pieces(data, lengths)
    order = np.argsort(keys)
    keys, table = keys[order], table[:, order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                words = Words(part.column("text"), lower=True)
                coded = words.array().dictionary_encode()
                code = coded.indices.to_numpy().astype(np.int64)
                known = hash_pieces(*_flat(coded.dictionary))
                at = np.minimum(np.searchsorted(keys, known), max(0, len(keys) - 1))
                is_hot = keys[at] == known if len(keys) else np.zeros(len(known), bool)
                hot_word = is_hot[code]
                t, slot = words.text[hot_word], at[code[hot_word]]
                sums = [np.bincount(t, weights=row[slot], minlength=words.n_texts) for row in table] if len(keys) else [np.zeros(words.n_texts)] * 2
                n_hot = np.bincount(t, minlength=words.n_texts)
                cold, tf = np.unique(words.text[~hot_word] * (len(known) + 1) + code[~hot_word], return_counts=True)
                ids = part.column("doc_id")
                m = words.n_texts
                # A document's own row goes to its own key, that no word can have.
                own = pa.array([b"\x00" + i.to_bytes(8, "little") for i in range(m)], pa.binary())
                word = pa.concat_arrays([own, coded.dictionary.take(pa.array(cold % (len(known) + 1))).cast(pa.binary())])
                zero = np.zeros(len(cold))
                yield pa.RecordBatch.from_arrays([
                    pa.concat_arrays([ids, ids.take(pa.array(cold // (len(known) + 1)))]), word,
                    pa.array(np.concatenate([np.zeros(m, np.int64), tf])), pa.array(np.concatenate([words.counts + 1, zero.astype(np.int64)])),
                    pa.array(np.concatenate([n_hot + (model.documents > 0), zero.astype(np.int64)])),
                    pa.array(np.concatenate([sums[0] + model.base(np.array([float(model.documents)])), zero])),
                    pa.array(np.concatenate([sums[1] + model.end(), zero])),
                ], ["doc_id", "word", "tf", "n_tokens", "n_known", "base_score", "score"])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tf = batch.column("tf").to_numpy().astype(float)
            count = batch.column("n").fill_null(0).to_numpy().astype(float)
            is_word = tf > 0
            coded = batch.column("word").filter(pa.array(is_word)).cast(pa.large_binary()).dictionary_encode()
            code = coded.indices.to_numpy()
            times = np.zeros(len(coded.dictionary))
            times[code] = count[is_word]
            values = model.log10(*_flat(coded.dictionary), times) if len(times) else times
            base, score = np.zeros(len(tf)), np.zeros(len(tf))
            base[is_word], score[is_word] = tf[is_word] * model.base(count[is_word]), tf[is_word] * values[code]
            own = [batch.column(c).to_numpy() for c in ("n_tokens", "n_known", "base_score", "score")]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(own[0]), pa.array(own[1] + np.where(count > 0, tf, 0).astype(np.int64)),
                pa.array(own[2] + base), pa.array(own[3] + score)], ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    columns = "n_tokens long, n_known long, base_score double, score double"
    rows = kept.mapInArrow(run, f"doc_id long, word binary, tf long, {columns}")
    other = counts.select(F.col("word").alias("counted"), "n")
    joined = rows.join(other, F.col("word") == F.col("counted"), "left").drop("counted").mapInArrow(finish, f"doc_id long, {columns}")
    return (joined.groupBy("doc_id").agg(*[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")])
            .select("doc_id", (fold(F.col("doc_id"), 7) == HELD_OUT).alias("held_out"), "n_tokens", "n_known",
                    F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score"))
