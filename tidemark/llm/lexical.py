"""Ranked lexical search: blocks of impact-sorted posting lists, read in turn until the score intervals decide (NRA)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.scratch import stored
from tidemark.llm.words import Words, chunks

#: What ends a term: the ASCII characters that are neither letters nor digits.
SEPARATORS = bytes(c for c in range(128) if not chr(c).isalnum())
#: Bytes of text in a block (a longer text is a block of its own), and items that one task ranks at once.
BLOCK_BYTES, ITEMS = 6 << 20, 256
#: Entries that the first read of a list takes; each later read takes twice as many as the last.
FIRST_READ = 128
_BITS = 25


def terms_of(column: pa.Array) -> Words:
    return Words(column, lower=True, separators=SEPARATORS)


def _bit(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - _BITS)).astype(np.int64)


def query_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, bit), each once; rows that share an item_id are one item with the terms of all its texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                words = terms_of(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("item_id").take(pa.array(words.text)), words.array().cast(pa.string()),
                                                  pa.array(_bit(words.hashes()))], ["item_id", "term", "bit"])

    return items.select("item_id", "text").mapInArrow(run, f"item_id {dict(items.dtypes)['item_id']}, term string, bit long").distinct()


def bitmap_of(terms: DataFrame) -> np.ndarray:
    """Which hash prefixes the terms have: 4 MB whatever their number."""
    marked = terms.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")).toArrow()
    bitmap = np.zeros(1 << (_BITS - 6), np.uint64)
    bitmap[marked.column("word").to_numpy()] = marked.column("bits").to_numpy().view(np.uint64)
    return bitmap


def postings(docs: DataFrame, bitmap: np.ndarray | None = None) -> DataFrame:
    """An inverted index of docs in blocks: (block, term, places, counts, doc_ids, df).

    A block holds consecutive rows of a partition. Its row without a term lists its documents (doc_ids) and their numbers of
    terms (counts); each other row lists the places of a term's documents in the block and how often it occurs there. A
    bitmap leaves out terms that no query has. A narrow map: texts aren't moved, and no list is longer than its block.
    """
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in chunks(batch, "text", BLOCK_BYTES):
                words, n = terms_of(part.column("text")), part.num_rows
                raw, text = words.array(), words.text
                if bitmap is not None and len(text):
                    bit = _bit(words.hashes())
                    some = np.flatnonzero(bitmap[bit >> 6] >> (bit & 63).astype(np.uint64) & np.uint64(1))
                    raw, text = raw.take(pa.array(some)), text[some]
                coded = raw.dictionary_encode()
                pairs, tf = np.unique(coded.indices.to_numpy().astype(np.int64) * n + text, return_counts=True)
                term, place = np.divmod(pairs, max(n, 1))
                stops = np.concatenate([[0], np.searchsorted(term, np.arange(len(coded.dictionary)), "right")]).astype(np.int32)
                head = np.concatenate([[0, 0], stops[1:]]).astype(np.int32)  # the first row's lists, empty places
                counts = np.concatenate([words.counts, tf]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(stops), block)), pa.concat_arrays([pa.nulls(1, pa.string()), coded.dictionary.cast(pa.string())]),
                    pa.ListArray.from_arrays(pa.array(head), pa.array(place.astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], stops + n]).astype(np.int32)), pa.array(counts)),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.full(len(stops), n)]).astype(np.int32)), part.column("doc_id")),
                    pa.array(np.concatenate([[0], np.diff(stops)]).astype(np.int64))],
                    ["block", "term", "places", "counts", "doc_ids", "df"])
                block += 1

    return docs.select("doc_id", "text").mapInArrow(run, f"block long, term string, places array<int>, counts array<long>, doc_ids array<{kind}>, df long")


def weight(n: Column, df: Column) -> Column:
    """floor(1000 ln((2N + 2) / (2 df + 1))), in doubles."""
    return F.floor(F.lit(1000.0) * F.log((2 * n + 2).cast("double") / (2 * df + 1).cast("double"))).cast("long")


def impacts(tf: np.ndarray, n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """What an occurrence count is worth in documents of n terms, in 64-bit integers."""
    m = 50 + 50 * n * docs // max(total, 1)
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def best(lists: list[tuple[np.ndarray, np.ndarray]], n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, scores) of all documents that may stand among the k best, ties of the last one included, with their exact scores.

    Each list has places and gains, the highest gain first. Lists are read from the front only, a stretch of each in turn. A
    document's score lies between the sum of the gains seen and that sum plus the next gain of each list it was not seen in.
    Reading ends when every document whose upper end reaches the k-th lower end has both ends equal: membership, ties and
    scores are then certain. A list is left alone once all such documents were seen in it.
    """
    low, seen = np.zeros(n, np.int64), np.zeros((len(lists), n), bool)
    at, step = [0] * len(lists), FIRST_READ
    head = np.array([int(gain[0]) if len(gain) else 0 for _, gain in lists], np.int64)
    unread = np.full(n, head.sum(), np.int64)
    open_ = unread > 0
    while True:
        for i in np.flatnonzero(head > 0).tolist():
            if seen[i][open_].all():
                continue
            place, gain = lists[i]
            some = place[at[i] : at[i] + step]
            low[some] += gain[at[i] : at[i] + step]
            seen[i, some] = True
            at[i] += step
            head[i] = gain[at[i]] if at[i] < len(gain) else 0
        left = np.flatnonzero(head > 0)
        unread = head.sum() - head[left] @ seen[left]
        floor = max(1, int(np.partition(low, n - k)[n - k]) if n >= k else 1)
        open_ = (unread > 0) & (low + unread >= floor)
        if not open_.any():
            sure = np.flatnonzero(low >= floor)
            return sure, low[sure]
        step *= 2


def rank(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of the highest score above 0 for each item, equal ones by doc_id.

    Null or empty texts have no terms: such documents are no one's answer and such items have no rows. Rows of docs that repeat a
    doc_id rank one by one, a null doc_id before all others of its score; rows of items that repeat an item_id are one item.

    The documents lie in blocks (postings()); each block ranks the items in groups of about ITEMS by best(), and what a
    block returns are its k best. The last step keeps the k best of all blocks, first within each task. Numbers
    that go through the driver: of documents, of their terms, of items, and the bitmap of bitmap_of().
    """
    kind, key = dict(docs.dtypes)["doc_id"], dict(items.dtypes)["item_id"]
    asked = stored(query_terms(items), "query-terms")
    index = stored(postings(docs, bitmap_of(asked)), "postings")
    heads = index.where("term is null")
    n_docs, n_terms = heads.agg(F.sum(F.size(F.filter("counts", lambda c: c > 0))), F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, c: a + c))).first()
    n_docs, n_terms = n_docs or 0, n_terms or 0
    groups = -(-asked.select("item_id").distinct().count() // ITEMS) or 1
    lists = index.where("term is not null").join(asked.select("term").distinct(), "term", "left_semi")
    df = lists.groupBy("term").agg(F.sum("df").alias("df"))
    group = F.pmod(F.xxhash64("item_id"), F.lit(groups)).cast("int").alias("part")
    wanted = (asked.join(df, "term").groupBy("term", group).agg(F.first("df").alias("total"), F.collect_list(F.struct("item_id")).alias("items"))
              .select("term", "part", "items", weight(F.lit(n_docs), F.col("total")).alias("w")).where("w > 0"))
    hits = index.drop("df", "doc_ids").join(wanted, "term").select("part", "block", "w", "items", "places", "counts", F.lit(None).cast(f"array<{kind}>").alias("doc_ids"))
    tops = heads.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"), "block", F.lit(None).cast("long").alias("w"),
                        F.lit(None).cast(f"array<struct<item_id:{key}>>").alias("items"), "places", "counts", "doc_ids")

    def search(table: pa.Table) -> pa.Table:
        heading = table.filter(pc.is_null(table.column("w")))
        n = heading.column("counts").combine_chunks().flatten().to_numpy().astype(np.int64)
        ids = heading.column("doc_ids").combine_chunks().flatten()
        ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
        order = pc.array_sort_indices(ids).to_numpy().astype(np.int64)  # nulls last
        order = np.concatenate([order[len(order) - ids.null_count :], order[: len(order) - ids.null_count]])
        turn = np.empty(len(order), np.int64)
        turn[order] = np.arange(len(order))
        rows = table.filter(pc.is_valid(table.column("w"))).combine_chunks()
        of: dict = {}
        for w, named, places, counts in zip(rows.column("w").to_pylist(), rows.column("items").to_pylist(), rows.column("places"), rows.column("counts"), strict=True):
            place = places.values.to_numpy()
            gain = w * impacts(counts.values.to_numpy(), n[place], n_docs, n_terms)
            down = np.argsort(-gain, kind="stable")
            ready = (place[down], gain[down])
            for item in named:  # structs, as a list drops bare nulls
                of.setdefault(item["item_id"], []).append(ready)
        out = []
        for item, read in of.items():
            place, score = best(read, len(n), k)
            first = np.lexsort((turn[place], -score))[:k]
            out += [(item, int(place[i]), int(score[i])) for i in first]
        found = pa.array([p for _, p, _ in out], pa.int64())
        return pa.table([pa.array([i for i, _, _ in out], table.schema.field("items").type.value_type.field("item_id").type), ids.take(found), pa.array([s for _, _, s in out], pa.int64())],
                        ["item_id", "doc_id", "score"])

    ranked = hits.unionByName(tops).groupBy("part", "block").applyInArrow(search, f"item_id {key}, doc_id {kind}, score long")
    place = F.row_number().over(Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first()))
    return ranked.withColumn("rank", place).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
