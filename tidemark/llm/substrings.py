"""Substring dedup by recompression: names of runs and pairs of words, shared names, verified repeats."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.scratch import stored_and_tidied
from tidemark.llm.words import Words, chunks, grams, mix, within

_K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


def recompress(symbols: np.ndarray, text: np.ndarray, lead: np.ndarray, end: np.ndarray, level: int) -> tuple[np.ndarray, ...]:
    """One round of naming: first maximal runs of a symbol, then pairs of a left and a right symbol beside each other.

    A name is a hash of what it stands for, so it is the same in all texts on all executors. A bit of the hash decides
    whether a symbol is left or right. lead, end: the words (from, to) that decide where a symbol begins and ends; in
    two texts with equal words there, the symbol is the same. Neighbours widen that span: a run ends only because its
    neighbours differ, a symbol stays single only because of what stands beside it. A span that reaches over the edge
    of a text is left wider than any text (-1, or a very large end).
    """
    n = len(symbols)
    fresh = np.ones(n, bool)
    fresh[1:] = (symbols[1:] != symbols[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(fresh)
    length = np.diff(np.append(at, n))
    name = np.where(length == 1, symbols[at], mix(symbols[at] * _K[0] + length.astype(np.uint64) * _K[1]))
    owner = text[at]
    last = at + length - 1
    lead, end = _beside(np.minimum.reduceat(lead, at), np.maximum.reduceat(end, at), owner, lead, end, at, last) if n else (lead, end)
    side = (mix(name + np.uint64(level) * _K[2]) >> np.uint64(63)).astype(bool)
    m = len(name)
    pairs = np.zeros(m, bool)
    pairs[:-1] = ~side[:-1] & side[1:] & (owner[:-1] == owner[1:])
    second = np.zeros(m, bool)
    second[1:] = pairs[:-1]
    # What isn't in a pair: a left symbol because of the symbol to its right, a right one because of that to its left.
    right_lead, right_end = np.append(lead[1:], -1), np.append(end[1:], _FAR)
    right_other = np.append(owner[1:] != owner[:-1], True)
    left_lead, left_other = np.insert(lead[:-1], 0, -1), np.insert(owner[1:] != owner[:-1], 0, True)
    left_end = np.insert(end[:-1], 0, _FAR)
    new_lead, new_end = lead.copy(), end.copy()
    alone_left, alone_right = ~side & ~pairs, side & ~second
    new_end[alone_left] = np.where(right_other, _FAR, np.maximum(end, right_end))[alone_left]
    new_lead[alone_left] = np.where(right_other, lead, np.minimum(lead, right_lead))[alone_left]
    new_lead[alone_right] = np.where(left_other, -1, np.minimum(lead, left_lead))[alone_right]
    new_end[alone_right] = np.where(left_other, end, np.maximum(end, left_end))[alone_right]
    new_end[pairs] = np.maximum(end, right_end)[pairs]
    new_lead[pairs] = np.minimum(lead, right_lead)[pairs]
    named = name.copy()
    named[pairs] = mix(name * _K[3] + np.append(name[1:], np.uint64(0)) * _K[0] + _K[1])[pairs]
    keep = ~second
    return named[keep], owner[keep], new_lead[keep], new_end[keep]


_FAR = np.int64(1 << 60)


def _beside(lead: np.ndarray, end: np.ndarray, owner: np.ndarray, all_lead: np.ndarray, all_end: np.ndarray,
            first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans of runs, widened by the symbols on either side; -1 and _FAR at the edges of a text."""
    edge = np.append(owner[1:] != owner[:-1], True)
    start = np.insert(edge[:-1], 0, True)
    previous, following = np.maximum(first - 1, 0), np.minimum(last + 1, len(all_end) - 1)
    before = np.where(start, -1, np.minimum(lead, all_lead[previous]))
    after = np.where(edge, _FAR, np.maximum(end, all_end[following]))
    before = np.where(edge, before, np.minimum(before, all_lead[following]))
    after = np.where(start, after, np.maximum(after, all_end[previous]))
    return before, after


def anchors(hashes: np.ndarray, text: np.ndarray, window: int, levels: int = 3) -> np.ndarray:
    """For each window of consecutive words of one text (by its first word, in order) one name that its words alone decide.

    It is a symbol of the highest level that has any with its whole span in the window and no wider than two thirds of
    it (wider ones fit few windows, so neighbouring windows would share few names), together with the words of that
    span; of several the smallest hash. So windows with equal words get equal names, wherever they stand. A window
    without such a symbol, as one inside a long run, is named by its words as a whole.
    """
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    best = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    spelled = _spelled(hashes)
    at = np.arange(len(hashes), dtype=np.int64)
    symbols, owner, lead, end = hashes, text, at, at + 1
    for level in range(1, levels + 1):
        symbols, owner, lead, end = recompress(symbols, owner, lead, end, level)
        width = end - lead
        fit = (lead >= 0) & (width <= (window * 2 // 3 if window >= 10 else window))
        where, size = lead[fit], width[fit]
        # The level in the top bits, the highest first, then the name.
        rank = (np.uint64(levels - level) << np.uint64(62)) | (mix(symbols[fit] ^ spelled(where, end[fit])) >> np.uint64(2))
        order = np.argsort(where, kind="stable")
        where, size, rank = where[order], size[order], rank[order]
        # Spans that start at one word: for each number of words before it that the window may begin, the smallest name.
        for back in range(window):
            ok = (size + back <= window) & (where >= back) & (where - back < n)
            if ok.any():
                spot, value = where[ok] - back, rank[ok]
                first = np.flatnonzero(np.diff(spot, prepend=-1))
                spot, value = spot[first], np.minimum.reduceat(value, first)
                best[spot] = np.minimum(best[spot], value)
    none = best == np.iinfo(np.uint64).max
    if none.any():
        best[none] = grams(hashes, window)[none] | (np.uint64(3) << np.uint64(62))
    return best[within(text, window)]


_Q = 0xD6E8FEB86659FD93


def _spelled(hashes: np.ndarray):
    """A function that gives a hash of the words from each of some places up to each of others (sums of a polynomial, its powers inverted)."""
    one = np.ones(1, np.uint64)
    power = np.concatenate([one, np.cumprod(np.full(len(hashes), _Q, np.uint64))])
    back = np.concatenate([one, np.cumprod(np.full(len(hashes), pow(_Q, -1, 1 << 64), np.uint64))])
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * power[:-1])])
    return lambda first, end: (total[end] - total[first]) * back[first] + (end - first).astype(np.uint64)


def _spans(flags: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of each stretch of set flags within one text."""
    start = flags.copy()
    start[1:] &= ~(flags[:-1] & (text[1:] == text[:-1]))
    stop = flags.copy()
    stop[:-1] &= ~(flags[1:] & (text[1:] == text[:-1]))
    return np.flatnonzero(start), np.flatnonzero(stop)


def _questions(keys: np.ndarray, doc: np.ndarray, wide: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(later, shared): which places have a key that an earlier document of the batch has, or that any other one has.

    If two documents of a batch share a key, only the earliest has to ask about it.
    """
    order = np.lexsort((doc, keys) if wide is None else (doc, wide, keys))
    k, d = keys[order], doc[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    if wide is not None:
        new[1:] |= wide[order][1:] != wide[order][:-1]
    group = np.cumsum(new) - 1
    later = d != d[new][group] if len(k) else np.zeros(0, bool)
    shared = (np.bincount(group, weights=later)[group] > 0) if len(k) else later
    out_later, out_shared = np.zeros(len(k), bool), np.zeros(len(k), bool)
    out_later[order], out_shared[order] = later, shared
    return out_later, out_shared


def _salt(doc: np.ndarray, place: np.ndarray) -> np.ndarray:
    return mix(doc.view(np.uint64) * _K[0] + place.astype(np.uint64) * _K[1])


def _packed(lo: np.ndarray, hi: np.ndarray, known: np.ndarray) -> np.ndarray:
    """A stretch and a flag in one number: the sign has the flag. lo = -1: no stretch at all."""
    value = ((lo + 1).astype(np.int64) << 31) | (hi + 1)
    return np.where(known, ~value, value)


def _whole(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The rows of a batch that have a doc_id."""
    ids = batch.column("doc_id")
    return batch.filter(ids.is_valid()) if ids.null_count else batch


def _anchor_rows(window: int):
    """(key, doc_id, span): stretches of windows of a document with one name; the flag: shared for sure."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(_whole(batch), "text"):
                words = Words(part.column("text"))
                ids = part.column("doc_id").to_numpy()
                names = anchors(words.hashes(), words.text, window)
                ok = np.flatnonzero(within(words.text, window))
                text = words.text[ok]
                place = ok - words.first[text]
                doc = ids[text]
                _, shared = _questions(names, doc)
                # Known stretches: not asked about, and spread by a key of their own.
                a, b = _spans(shared, text)
                # Others: neighbouring windows with one name make one row.
                asks = ~shared
                start, stop = asks.copy(), asks.copy()
                same = asks[:-1] & asks[1:] & (names[1:] == names[:-1]) & (text[1:] == text[:-1])
                start[1:] &= ~same
                stop[:-1] &= ~same
                first, last = np.flatnonzero(start), np.flatnonzero(stop)
                # The earliest document of a name shared in this batch must still tell other batches of it.
                heads = np.flatnonzero(shared)
                _, pick = np.unique(names[heads], return_index=True)
                tell = heads[pick]
                none = np.full(len(tell), -1)
                key = np.concatenate([_salt(doc[a], place[a]), names[first], names[tell]]) >> np.uint64(8)  # 56 bits suffice for candidates
                who = np.concatenate([doc[a], doc[first], doc[tell]])
                span = np.concatenate([_packed(place[a], place[b], True), _packed(place[first], place[last], False), _packed(none, none, False)])
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(who), pa.array(span)], ["key", "doc_id", "span"])

    return run


def _window_rows(window: int):
    """(key, key2, doc_id, span, more): candidate windows; the flag: an earlier document of the batch has the same words.

    A window that a document repeats is one row, its other places in more, so a key has a row a batch at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch.filter(batch.column("spans").is_valid()), "text", 6 << 20):
                words = Words(part.column("text"))
                ids = part.column("doc_id").to_numpy()
                asked = _marked(part.column("spans"), words.first[:-1], len(words))
                ok = np.flatnonzero(asked[: max(0, len(words) - window + 1)] & within(words.text, window))
                text = words.text[ok]
                place = ok - words.first[text]
                doc = ids[text]
                one, two = grams(words.hashes(1), window)[ok], grams(words.hashes(2), window)[ok]
                later, _ = _questions(one, doc, two)
                flags = np.zeros(len(words), bool)
                flags[ok[later]] = True
                a, b = _spans(flags, words.text)
                rest = ~later
                lo, hi = a - words.first[words.text[a]], b - words.first[words.text[b]]
                salt = _salt(ids[words.text[a]], lo)
                order = np.lexsort((place[rest], two[rest], one[rest]))
                k1, k2 = one[rest][order], two[rest][order]
                first = np.flatnonzero(np.concatenate([np.ones(min(1, len(k1)), bool), (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])]))
                places = _packed(place[rest][order], place[rest][order], False)
                key, key2 = np.concatenate([salt, k1[first]]), np.concatenate([salt, k2[first]])
                who = np.concatenate([ids[words.text[a]], doc[rest][order][first]])
                span = np.concatenate([_packed(lo, hi, True), places[first]])
                again = np.diff(np.append(first, len(k1))) - 1
                others = np.ones(len(k1), bool)
                others[first] = False
                ends = np.concatenate([np.zeros(len(a) + 1, np.int64), np.cumsum(again)]).astype(np.int32)
                none = pa.array(np.concatenate([np.ones(len(a), bool), again == 0]))
                more = pa.ListArray.from_arrays(pa.array(ends), pa.array(places[others]), mask=none)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array((key2 >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                                                  pa.array(who), pa.array(span), more], ["key", "key2", "doc_id", "span", "more"])

    return run


def _marked(spans: pa.Array, first: np.ndarray, n: int) -> np.ndarray:
    """Flags of the words (of all texts in a row) at which the texts' packed stretches lie; what lies beyond a text is cut off."""
    change = np.zeros(n + 1, np.int64)
    filled = spans.fill_null([]) if spans.null_count else spans
    counts = filled.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = filled.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(flat):
        flat = np.where(flat < 0, ~flat, flat)
        base, limit = np.repeat(first, counts), np.repeat(np.append(first[1:], n), counts)
        np.add.at(change, np.minimum(base + (flat >> 31) - 1, limit), 1)
        np.add.at(change, np.minimum(base + (flat & (1 << 31) - 1), limit), -1)
    return np.cumsum(change)[:n] > 0


def repeats(texts: DataFrame, window: int) -> DataFrame:
    """(doc_id, spans): for each document the packed stretches of windows whose words also start in a document with a smaller doc_id.

    texts has doc_id and text alone. Rows without a doc_id take no part. Rows of one doc_id aren't repeats of each other; if
    their texts differ, only the text with the smallest hash takes part (see mixed_ids).

    1. Recompression names each window by a symbol (see anchors); names in two documents make candidates.
    2. Candidate windows are compared as wholes, by 96 bits of their words; the smallest doc_id owns one.
    Within a batch only one row asks for a name or window, so that a passage in a third of all documents
    gives a row a batch at most. Windows and joins are Spark's; hot keys are no longer hot when they are shuffled.
    """
    named = texts.mapInArrow(_anchor_rows(window), "key long, doc_id long, span long")
    key = Window.partitionBy("key")
    shared = (named.withColumn("low", F.min("doc_id").over(key)).withColumn("high", F.max("doc_id").over(key))
              .filter(f"(span < 0 or low < high) and span != {_NONE}"))
    spans = F.collect_list("span").alias("spans")
    # Stored: the shuffle of the names, the largest but one, is gone before that of the windows begins.
    candidates = stored_and_tidied(shared.groupBy(F.col("doc_id").alias("cand_id")).agg(spans), "candidates")
    mixed = mixed_ids(texts)
    # A left join, as in with_spans(), so that both read one shuffle of the texts; others are passed over in the tasks.
    asked = (texts.join(candidates, F.col("doc_id") == F.col("cand_id"), "left").join(mixed, F.col("doc_id") == F.col("mixed_id"), "left")
             .select("doc_id", "text", F.when(_takes_part("keep"), F.col("spans")).alias("spans")))
    same = asked.mapInArrow(_window_rows(window), "key long, key2 int, doc_id long, span long, more array<long>")
    owner = Window.partitionBy("key", "key2")
    again = same.withColumn("low", F.min("doc_id").over(owner)).filter("span < 0 or low < doc_id")
    places = F.when(F.col("more").isNull(), F.array("span")).otherwise(F.concat(F.array("span"), "more"))
    return again.groupBy("doc_id").agg(F.flatten(F.collect_list(places)).alias("spans"))


#: What _packed() makes of no stretch.
_NONE = 0


def _covered(part: pa.RecordBatch, window: int, spans: str) -> tuple[Words, np.ndarray]:
    words = Words(part.column("text"))
    starts = _marked(part.column(spans), words.first[:-1], len(words))
    at = np.flatnonzero(starts)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, np.minimum(at + window, len(words)), -1)
    return words, np.cumsum(change)[:-1] > 0


def mixed_ids(texts: DataFrame) -> DataFrame:
    """(mixed_id, keep): the doc_ids that stand at different texts, and the hash of the one text that counts for each."""
    print_ = F.xxhash64("text")
    return (texts.filter("doc_id is not null").groupBy(F.col("doc_id").alias("mixed_id"))
            .agg(F.min(print_).alias("keep"), F.max(print_).alias("last")).filter("keep < last").drop("last"))


def _takes_part(keep: str):
    return F.col(keep).isNull() | (F.xxhash64("text") == F.col(keep))


def with_spans(docs: DataFrame, window: int) -> tuple[DataFrame, str]:
    """docs with one more column, and its name: the spans that repeats() finds in each document, null where it finds none."""
    texts = docs.select("doc_id", "text")
    tail = "_"
    while any(f"{c}{tail}" in docs.columns for c in ("of", "spans", "mixed", "keep")):
        tail += "_"
    of, spans, mixed, keep = (f"{c}{tail}" for c in ("of", "spans", "mixed", "keep"))
    found = repeats(texts, window).select(F.col("doc_id").alias(of), F.col("spans").alias(spans))
    marks = mixed_ids(texts).select(F.col("mixed_id").alias(mixed), F.col("keep").alias(keep))
    joined = docs.join(found, F.col("doc_id") == F.col(of), "left").join(marks, F.col("doc_id") == F.col(mixed), "left")
    return joined.withColumn(spans, F.when(_takes_part(keep), F.col(spans))).select(*docs.columns, spans), spans


def removal_digests(docs: DataFrame, window: int = 13) -> DataFrame:
    """For each document the number of its words, of those that repeats cover, and the sha256 of the words kept.

    A null text has no words, nor has an empty one; a row without a doc_id loses nothing. Rows that repeat a doc_id with one
    text have one result each, the same; of rows that repeat it with different texts, those with one of them (the
    smallest hash) take part, the others lose nothing and own nothing.
    """
    marked, spans = with_spans(docs.select("doc_id", "text"), window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                words, gone = _covered(part, window, spans)
                data = words.raw.tobytes()
                starts, ends = words.starts.tolist(), words.ends.tolist()
                digests, removed = [], []
                for i in range(words.n_texts):
                    first, last = int(words.first[i]), int(words.first[i + 1])
                    kept = (np.flatnonzero(~gone[first:last]) + first).tolist()
                    removed.append(last - first - len(kept))
                    digests.append(hashlib.sha256(b" ".join([data[starts[w] : ends[w]] for w in kept])).hexdigest())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(words.counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
                                                 ["doc_id", "n_words", "n_removed", "kept_sha256"])

    return marked.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def cut(docs: DataFrame, window: int) -> DataFrame:
    """docs with the words that repeats cover taken out of text, each with the separators after it, and n_chars to match.

    Texts without such words stay as they are, character by character. A document that is all repeat keeps an empty text.
    Nulls and rows that lack or repeat a doc_id are as in removal_digests(); other columns may have any name.
    """
    from pyspark.sql import types as T

    names = docs.columns
    marked, spans = with_spans(docs, window)
    schema = T.StructType(list(docs.schema.fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                words, gone = _covered(part, window, spans)
                texts = part.column("text").to_pylist()
                data = words.raw.tobytes()
                for i in np.flatnonzero(np.bincount(words.text[gone], minlength=words.n_texts)):
                    first, last = int(words.first[i]), int(words.first[i + 1])
                    begin, stop = int(words.offsets[i]), int(words.offsets[i + 1])
                    # A word goes with what follows it, up to the next word.
                    limits = [begin, *words.starts[first + 1 : last].tolist(), stop]
                    texts[i] = b"".join([data[limits[w] : limits[w + 1]] for w in (np.flatnonzero(~gone[first:last])).tolist()]).decode()
                columns = {n: part.column(n) for n in names}
                columns["text"] = pa.array(texts, pa.string())
                if "n_chars" in columns:
                    columns["n_chars"] = pa.array([None if t is None else len(t) for t in texts], part.column("n_chars").type)
                yield pa.RecordBatch.from_arrays(list(columns.values()), names)

    return marked.mapInArrow(run, schema)
