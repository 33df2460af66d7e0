"""Benchmark decontamination by spaced-seed hashing, with overlaps that tolerate substitutions verified around hits."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.words import WHITE_AND_PUNCTUATION, Words, chunks, mix

#: Positions of a window that count in its hash, by mask; the others may hold any word. In a passage of 13
#: or more equal words, four fifths of its words, some window of some mask has its six words whole (tests hold this).
MASKS = ((0, 1, 2, 3, 4, 5), (0, 1, 3, 4, 6, 7), (0, 2, 3, 5, 6, 8), (0, 1, 2, 6, 7, 8), (0, 3, 4, 5, 7, 8))
#: Words in an overlap that counts, of a longer item; and the share of them, and of a shorter item, that must be equal.
LEAST, SHARE = 13, 0.8
#: Words of the longest item of which fewer than LEAST equal ones, or as many, are that share.
SHORT = 16
#: Shorter items are common phrases: documents are dropped for them only if they hold nothing else.
FEWEST = 5

_BITS = 25
_Q = 0xD6E8FEB86659FD93


def words_of(column: pa.Array) -> Words:
    """Words in lower case, cut at white space and ASCII punctuation, so that neither case nor marks hide an overlap."""
    return Words(column, lower=True, separators=WHITE_AND_PUNCTUATION)


def seed_hashes(hashes: np.ndarray, text: np.ndarray, mask: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(keys, places): the hash of each window of one text under a mask, and its first word."""
    n = len(hashes) - mask[-1]
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for k, offset in enumerate(mask):
        total = total * np.uint64(_Q) + hashes[offset : offset + n] * np.uint64(2 * k + 1)
    keys = mix(total + np.uint64(sum(1 << o for o in mask)))
    places = np.flatnonzero(text[:n] == text[mask[-1] :])
    return keys[places], places


def overlap(doc: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int]:
    """(first, length, equal) of the best overlap with the item laid at doc[shift:]: first is its first word in the item.

    Best: most points, 1 for an equal word and -2 for another, of all stretches that begin and end with an equal word; the
    first and longest of several.
    """
    low, high = max(0, -shift), min(len(item), len(doc) - shift)
    if high <= low:
        return 0, 0, 0
    same = doc[low + shift : high + shift] == item[low:high]
    points = np.concatenate([[0], np.cumsum(np.where(same, 1, -2))])
    floor = np.minimum.accumulate(points)
    gain = points[1:] - floor[:-1]
    stop = int(gain.argmax())
    start = int(np.flatnonzero(points[: stop + 1] == floor[stop])[0])
    while start <= stop and not same[start]:
        start += 1
    return low + start, stop + 1 - start, int(same[start : stop + 1].sum())


@lru_cache(maxsize=SHORT)
def gaps(n: int) -> tuple[tuple[int, ...], ...]:
    """Masks for items of n words, SHORT at most: all words but those that may differ, where no window of MASKS is whole then."""
    differ = n * (1 - Fraction(str(SHARE))) // 1
    rests = [[k for k in range(n) if k not in gone] for gone in combinations(range(n), differ)]
    return tuple(sorted({tuple(k - rest[0] for k in rest) for rest in rests
                         if not any({at + o for o in mask} <= set(rest) for mask in MASKS for at in range(n - mask[-1]))}))


def passage(doc: np.ndarray, item: np.ndarray, shift: int, enough: int, share: float = SHARE) -> tuple[int, int, int]:
    """(first, length, equal) of the best passage of the item laid at doc[shift:], all 0 if none counts.

    Of all stretches with at least `enough` equal words and at least `share` of their words equal: the one with the most
    equal words, of several the shortest, then the first. So a loosely edited neighbourhood hides no passage beside it.
    """
    low, high = max(0, -shift), min(len(item), len(doc) - shift)
    if high - low < enough:
        return 0, 0, 0
    same = doc[low + shift : high + shift] == item[low:high]
    before = np.concatenate([[0], np.cumsum(same)])  # equal words before each place
    if before[-1] < enough:
        return 0, 0, 0
    law = Fraction(str(share))
    # A stretch a..b has the share if spare[a] <= spare[b]. The furthest such a has the most equal words.
    spare = before * law.denominator - np.arange(len(before)) * law.numerator
    equal = before - before[np.searchsorted(-np.minimum.accumulate(spare), -spare)]
    most = int(equal.max())
    if most < enough:
        return 0, 0, 0
    places = np.flatnonzero(same)
    last = before[equal == most] - 1  # the last equal word of each, counted among the equal ones
    length = places[last] + 1 - places[last - most + 1]
    k = int(length.argmin())
    return low + int(places[last[k] - most + 1]), int(length[k]), most


def _keys(masks: dict[tuple[int, ...], list[int] | None], owner: str, bitmap: np.ndarray | None):
    """(key, owner, at) of all windows under all masks, or of those alone whose key the bitmap has.

    With each mask: the numbers of words of the texts that it is for, None for all texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                words = words_of(part.column("text"))
                hashes = words.hashes()
                for mask, sizes in masks.items():
                    keys, places = seed_hashes(hashes, words.text, mask)
                    if sizes is not None:
                        ok = np.isin(words.counts[words.text[places]], sizes)
                        keys, places = keys[ok], places[ok]
                    if bitmap is not None and len(keys):
                        bit = keys >> np.uint64(64 - _BITS)
                        ok = (bitmap[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)
                        keys, places = keys[ok], places[ok]
                    text = words.text[places]
                    yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), part.column(owner).take(pa.array(text)), pa.array(places - words.first[text], pa.int32())],
                                                     ["key", owner, "at"])

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, least: int = LEAST, share: float = SHARE, alone: int = 0) -> DataFrame:
    """(doc_id, item_id, doc_start, item_start, n_words, n_equal, similarity): the best overlap of each document with each item
    that it contains a passage of; documents without any have no row.

    A passage counts if it has at least `least` words of the item (or share of all of a shorter one) equal and in
    place, and at least `share` of its words are equal. Best: the most equal words, then the shortest. Null ids or texts and texts without words match nothing; rows
    that repeat an id give the best overlap of all. Other columns are ignored. Items of fewer than `alone` words count only
    where they are the whole text of a document.

    1. Windows of both sides are hashed under fixed masks that ignore some places; items of at most SHORT words have masks
       of their own where those could miss a passage (for LEAST and SHARE; looser parameters are not promised). Which keys the benchmark has is
       marked in a bitmap of 4 MB whatever its size; document windows outside are passed over where they are read.
    2. The rest is joined on the key, and each distinct lie of an item on a document is verified word by word.
    """
    items = benchmark.filter("item_id is not null and text is not null").select("item_id", "text").distinct()
    texts = docs.filter("doc_id is not null and text is not null").select("doc_id", "text")

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(words_of(batch.column("text")).counts, pa.int64())], ["n"])

    # Short items have more masks, by the numbers of words that the benchmark has.
    short = sorted(r["n"] for r in items.select("text").mapInArrow(sizes, "n long").filter(f"n between 1 and {SHORT}").distinct().collect())
    more = {mask: [n for n in short if mask in gaps(n)] for n in short for mask in gaps(n)}
    everywhere = dict.fromkeys(MASKS)
    kinds = dict(items.dtypes) | dict(texts.dtypes)
    seeds = items.mapInArrow(_keys(more | everywhere, "item_id", None), f"key long, item_id {kinds['item_id']}, at int").distinct()
    bit = F.shiftrightunsigned("key", 64 - _BITS)
    marked = seeds.groupBy(F.shiftright(bit, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(key, {64 - _BITS}) & 63 as int))")).alias("bits"))
    bitmap = np.zeros(1 << (_BITS - 6), np.uint64)
    found = marked.toArrow()
    bitmap[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)

    inside = {mask: of if max(of) < alone else None for mask, of in more.items()}
    hits = texts.mapInArrow(_keys(inside | everywhere, "doc_id", bitmap), f"key long, doc_id {kinds['doc_id']}, at int")
    lies = (hits.join(seeds.select(F.col("key").alias("k"), "item_id", F.col("at").alias("item_at")), F.col("key") == F.col("k"))
            .select("doc_id", "item_id", (F.col("at") - F.col("item_at")).alias("shift")).distinct()
            .groupBy("doc_id", "item_id").agg(F.collect_list("shift").alias("shifts")))
    named = items.select(F.col("item_id").alias("i"), F.col("text").alias("item_text"))
    tasks = (lies.join(named, F.col("item_id") == F.col("i"))
             .groupBy(F.col("doc_id").alias("d")).agg(F.collect_list(F.struct("item_id", "item_text", "shifts")).alias("items")))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                doc = words_of(pa.array([row["text"]])).hashes()
                for item in row["items"]:
                    other = words_of(pa.array([item["item_text"]])).hashes()
                    if len(other) < alone and len(doc) != len(other):
                        continue
                    enough = min(least, int(np.ceil(share * len(other))))
                    best = max(((equal, -length, first, shift) for shift in item["shifts"]
                                for first, length, equal in [passage(doc, other, shift, enough, share)] if equal), default=None)
                    if best:
                        equal, length, first, shift = best
                        out.append((row["doc_id"], item["item_id"], first + shift, first, -length, equal, equal / -length))
            columns = list(zip(*out, strict=True)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (batch.schema.field("doc_id").type, id_type(batch), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64()), strict=True)],
                                             ["doc_id", "item_id", "doc_start", "item_start", "n_words", "n_equal", "similarity"])

    def id_type(batch: pa.RecordBatch) -> pa.DataType:
        return batch.schema.field("items").type.value_type.field("item_id").type

    rows = texts.join(tasks, F.col("doc_id") == F.col("d")).select("doc_id", "text", "items").mapInArrow(
        verify, f"doc_id {kinds['doc_id']}, item_id {kinds['item_id']}, doc_start int, item_start int, n_words int, n_equal int, similarity double")
    best = F.max_by(F.struct("doc_start", "item_start", "n_words", "n_equal", "similarity"), F.struct("n_equal", F.negative("n_words"), F.negative("doc_start")))
    return rows.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.*")


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the documents that contain a passage of the benchmark; rows without a doc_id stay.

    Items of fewer than FEWEST words ('yes', 'the') stand in clean documents too: they drop a document only if they are all
    of its words. leaks() reports them wherever they stand.
    """
    found = leaks(docs, benchmark, alone=FEWEST).select(F.col("doc_id").alias("leaked")).distinct()
    return docs.join(found, docs["doc_id"] == found["leaked"], "left_anti")
