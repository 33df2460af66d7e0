"""Token files: ids ranked by frequency, in a byte-aligned code of one to four bytes with separate control bytes."""

from __future__ import annotations

import json
import os
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.scratch import discard
from tidemark.llm.words import binary, chunks, hash_pieces
from tidemark.session import scratch_dir

#: Pre-tokens of which a worker remembers the ids, in some 40 bytes each; the memory starts anew beyond.
REMEMBERED = 1_000_000
#: Bytes of text that a worker encodes at once; a longer text is cut where no pre-token lies across.
CHUNK_BYTES = 512 << 10
# For each control byte: how long each of its four codes is.
_LENGTHS = np.array([[(c >> 2 * i & 3) + 1 for i in range(4)] for c in range(256)], np.int64)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data): two control bits a value, its length less one, four to a byte from the lowest bits; little-endian codes."""
    v = values.astype(np.uint32)
    length = 1 + (v > 0xFF).astype(np.int64) + (v > 0xFFFF) + (v > 0xFFFFFF)
    padded = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    padded[: len(v)] = length - 1
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1).astype(np.uint8)
    cells = v.view(np.uint8).reshape(-1, 4)
    return control.tobytes(), cells[np.arange(4) < length[:, None]].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n values of pack(): lengths by looking up each control byte in a table, then all codes of a length at once."""
    c = np.frombuffer(control, np.uint8)
    lengths = _LENGTHS[c].ravel()[:n]
    raw = np.frombuffer(data, np.uint8)
    starts = np.cumsum(lengths) - lengths
    out = np.zeros(n, np.uint32)
    for i in range(int(lengths.max(initial=0))):
        some = lengths > i
        out[some] |= raw[starts[some] + i].astype(np.uint32) << np.uint32(8 * i)
    return out


# Kinds of characters: everything else, letters, numbers, the space, other white space.
_OTHER, _LETTER, _NUMBER, _SPACE, _WHITE = range(5)


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """The kind of each code point, by the properties of the regex library."""
    table = np.full(0x110000, _OTHER, np.uint8)
    every = "".join(map(chr, range(0xD800))) + "".join(map(chr, range(0xE000, 0x110000)))
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_WHITE, r"\s+")):
        for found in regex.finditer(pattern, every):
            first, last = ord(found[0][0]), ord(found[0][-1])
            if last - first + 1 == len(found[0]):
                table[first : last + 1] = kind
            else:  # a stretch across the surrogates
                table[[ord(c) for c in found[0]]] = kind
    table[ord(" ")] = _SPACE
    return table


def pre_tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(data, lengths, counts): the UTF-8 bytes of all texts, the length in bytes of each pre-token, their number in each text.

    The splits of the byte-level pattern ('s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+),
    for all texts at once: runs of one kind; the last of several white spaces before a word stands apart, and a space
    there joins the word; an apostrophe that starts a run takes its ending along.
    """
    raw = binary(texts)
    offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    buffer = raw.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]] if buffer is not None and len(buffer) else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    head = (data & 0xC0) != 0x80
    at = np.flatnonzero(head)  # where each character's bytes start
    char = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    n = len(char)
    if not n:
        return data, np.zeros(0, np.int64), np.zeros(len(raw), np.int64)
    new = np.zeros(n + 1, bool)  # first character of a text, and the end
    new[np.searchsorted(at, offsets[:-1][np.diff(offsets) > 0])] = True
    new[n] = True
    kind = _kinds()[char]
    run = np.where(kind == _WHITE, np.uint8(_SPACE), kind)
    start = new[:-1].copy()
    start[1:] |= run[1:] != run[:-1]
    last = np.flatnonzero((run[:-1] == _SPACE) & (run[1:] != _SPACE) & ~new[1:-1])
    start[last] = True
    start[last[kind[last] == _SPACE] + 1] = False
    mark = np.flatnonzero((char == ord("'")) & start)
    mark = mark[mark + 1 < n]
    mark = mark[~new[mark + 1]]
    one = char[mark + 1]
    two = np.where((mark + 2 < n) & ~new[np.minimum(mark + 2, n)], char[np.minimum(mark + 2, n - 1)], 0)
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
    for taken, size in ((mark[short], 2), (mark[long], 3)):
        start[taken + 1] = False
        after = taken + size
        after = after[after < n]
        start[after[(kind[after] == _LETTER)]] = True
    begin = at[start]
    return data, np.diff(np.append(begin, len(data))), np.diff(np.searchsorted(begin, offsets))


# A space after one of these letters or digits starts a pre-token, and the one before it ends there.
_CUT = regex.compile("(?<=[A-Za-z0-9]) ")


def parts_of(text: str, limit: int) -> list[str]:
    """text in parts of about limit characters, cut only between pre-tokens; a longer part where there is no such place."""
    parts, begin = [], 0
    while len(text) - begin > limit:
        found = _CUT.search(text, begin + limit)
        if not found:
            break
        parts.append(text[begin : found.start()])
        begin = found.start()
    return [*parts, text[begin:]]


class Encoder:
    """The tokenizers library behind a memory of pre-tokens: each new one is encoded by the library once for each worker.

    Byte-level BPE merges within a pre-token alone, so a text's ids are those of its pre-tokens one after the other.
    The memory is arrays: sorted 64-bit hashes, 32 bits of a second hash that tell other pre-tokens apart, and where
    their ids lie. Where the second hash differs, pre-tokens are encoded without the memory.
    The file's added tokens are found in texts first, as by the library; what lies between them is a text of its own.
    Refused with a ValueError: files whose added tokens want whole words or take white space along, and files with a
    normalizer, a space put before texts, or another way to cut pre-tokens than the byte-level pattern.
    """

    def __init__(self, tokenizer_file: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(tokenizer_file)
        self.model = library.model
        held = json.loads(library.to_str())
        cut = held["pre_tokenizer"] or {}
        if held["normalizer"] or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
            raise ValueError(f"{tokenizer_file}: only byte-level pre-tokens without normalizer and without a space before texts")
        added = library.get_added_tokens_decoder()
        if any(t.single_word or t.lstrip or t.rstrip for t in added.values()):
            raise ValueError(f"{tokenizer_file}: added tokens with single_word, lstrip or rstrip")
        self.added = {t.content: i for i, t in added.items()}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")")
        # The model's letters for bytes: printable ones stand for themselves, the others follow from 256 on.
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in set(plain)]
        self.letters = {**{b: b for b in plain}, **{b: 256 + i for i, b in enumerate(rest)}}
        self._forget()

    def _forget(self) -> None:
        self.keys, self.check = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        self.where, self.size = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.ids = array("i")

    def _ids(self, piece: bytes) -> list[int]:
        return [t.id for t in self.model.tokenize(piece.decode("latin-1").translate(self.letters))]

    def _learn(self, keys: np.ndarray, check: np.ndarray, pieces: Iterator[bytes]) -> None:
        where, size = np.zeros(len(keys), np.int32), np.zeros(len(keys), np.int32)
        for i, piece in enumerate(pieces):
            found = self._ids(piece)
            where[i], size[i] = len(self.ids), len(found)
            self.ids.extend(found)
        slot = np.searchsorted(self.keys, keys)
        self.keys, self.check = np.insert(self.keys, slot, keys), np.insert(self.check, slot, check)
        self.where, self.size = np.insert(self.where, slot, where), np.insert(self.size, slot, size)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        slot = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        return np.where(self.keys[slot] == keys, slot, -1) if len(self.keys) else np.full(len(keys), -1)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each has."""
        longest = pc.max(pc.binary_length(texts.cast(pa.large_binary()))).as_py() or 0
        if longest <= CHUNK_BYTES and not any(pc.any(pc.match_substring(texts, t)).as_py() for t in self.added):
            return self._between(texts)
        # What lies between added tokens, in parts, and the added tokens themselves.
        plain, runs, marks, owner = [], [], [], []
        for i, text in enumerate(texts.to_pylist()):
            for k, part in enumerate(self.cut.split(text or "")):
                owner.append(i)
                marks.append(self.added[part] if k % 2 else -1)
                runs.append(0 if k % 2 else len(found := parts_of(part, CHUNK_BYTES)))
                plain += [] if k % 2 else found
        flats, sizes = [], []
        first = 0
        while first < len(plain):
            last, total = first, 0
            while last < len(plain) and (last == first or total + len(plain[last]) <= CHUNK_BYTES):
                total += len(plain[last])
                last += 1
            flat, counts = self._between(pa.array(plain[first:last], pa.large_string()))
            flats.append(flat)
            sizes.append(counts)
            first = last
        flat = np.concatenate(flats) if flats else np.zeros(0, np.int32)
        ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]) if sizes else np.zeros(1, np.int64)
        stops = ends[np.cumsum(runs)]  # ids before the end of each stretch of text
        marks, owner = np.array(marks), np.array(owner)
        special = marks >= 0
        flat = np.insert(flat, stops[special], marks[special])
        lengths = np.diff(np.concatenate([[0], stops])) + special
        return flat, np.bincount(owner, weights=lengths, minlength=len(texts)).astype(np.int64)

    def _between(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """encode() for texts without added tokens."""
        data, lengths, counts = pre_tokens(texts)
        if not len(lengths):
            return np.zeros(0, np.int32), counts
        one, two = hash_pieces(data, lengths, 1), (hash_pieces(data, lengths, 2) >> np.uint64(32)).astype(np.uint32)
        keys, first, code = np.unique(one, return_index=True, return_inverse=True)
        place = self._place(keys)
        missing = np.flatnonzero(place < 0)
        if len(self.keys) + len(missing) > REMEMBERED:
            self._forget()
            missing = np.arange(len(keys))
        ends = np.cumsum(lengths)
        at = first[missing]
        if len(missing):
            raw = data.tobytes()
            self._learn(keys[missing], two[at], (raw[b:e] for b, e in zip((ends[at] - lengths[at]).tolist(), ends[at].tolist(), strict=True)))
            place = self._place(keys)
        slot = place[code]
        if (self.check[slot] != two).any():  # two pre-tokens with one hash
            found = [self._ids(bytes(data[e - n : e])) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
            size, flat = np.array([len(f) for f in found]), np.array([i for f in found for i in f], np.int32)
            stop = np.cumsum(size)
        else:
            size = self.size[slot].astype(np.int64)
            stop = np.cumsum(size)
            flat = np.frombuffer(self.ids, np.int32)[np.repeat(self.where[slot] - (stop - size), size) + np.arange(stop[-1])]
        per_text = np.diff(np.concatenate([[0], stop])[np.concatenate([[0], np.cumsum(counts)])])
        return flat, per_text


@lru_cache(maxsize=2)
def encoder(tokenizer_file: str) -> Encoder:
    return Encoder(tokenizer_file)


def encode_in_order(docs: DataFrame, tokenizer_file: str, end_id: int, path: str) -> None:
    """Writes blocks of encoded documents (part, ahead, doc_ids, counts, ids) to path, in ascending order of doc_id.

    Rows are dealt out by ranges of doc_id (nulls first) and sorted in their range; part is the range's number and ahead
    the number of ids before the block in it. A null text is an empty one; each document ends with end_id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part_of, coder, ahead = TaskContext.get().partitionId(), encoder(tokenizer_file), 0
        for batch in batches:
            for part in chunks(batch, "text", CHUNK_BYTES):
                flat, counts = coder.encode(part.column("text"))
                flat = np.insert(flat, np.cumsum(counts), end_id).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array([part_of], pa.int32()), pa.array([ahead], pa.int64()), _one(part.column("doc_id")), _one(pa.array(counts + 1)), _one(pa.array(flat))],
                    ["part", "ahead", "doc_ids", "counts", "ids"])
                ahead += len(flat)

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (docs.select("doc_id", "text").repartitionByRange(n, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
     .mapInArrow(run, "part int, ahead long, doc_ids array<long>, counts array<long>, ids array<int>").write.parquet(path))


def _one(values: pa.Array) -> pa.Array:
    """A list column of one row that holds all values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def ranking(encoded: DataFrame, n_ids: int) -> np.ndarray:
    """The ids of the vocabulary, the most frequent first, of equal ones the smallest; bounded by the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_ids, np.int64)
        for batch in batches:
            total += np.bincount(batch.column("ids").flatten().to_numpy(), minlength=n_ids)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], ["id", "n"])

    counts = np.zeros(n_ids, np.int64)
    for row in encoded.select("ids").mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[row["id"]] = row["n"]
    return np.argsort(-counts, kind="stable").astype(np.int32)


def write(docs: DataFrame, path: str, tokenizer_file: str, end_id: int = 2, n_ids: int = 1 << 16) -> None:
    """Writes docs as token files below path: `ranks` (the ids by rank) and `blocks`.

    A block is a row (part, first, doc_ids, counts, control, data): ids of whole documents in ascending order of
    doc_id, as ranks in the code of pack(); first is the number of ids before it in all files. Blocks lie in Parquet so
    that Spark's committer writes them: a lost executor leaves no half file, and any store that Spark can reach will do.
    """
    spark = docs.sparkSession
    plain = scratch_dir(spark, "encoded")
    encode_in_order(docs, tokenizer_file, end_id, plain)
    encoded = spark.read.parquet(plain)
    order = ranking(encoded, n_ids)
    rank = np.empty(n_ids, np.int64)
    rank[order] = np.arange(n_ids)
    sizes = encoded.select("part", F.aggregate("counts", F.lit(0).cast("long"), lambda n, x: n + x).alias("n"))
    before, at = {}, 0
    # One number for each range of doc_ids, as many as there are partitions.
    for row in sizes.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect():
        before[row["part"]] = at
        at += row["n"]
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                part, ids = row.column("part")[0].as_py(), row.column("ids").flatten().to_numpy()
                control, data = pack(rank[ids])
                yield pa.RecordBatch.from_arrays([
                    row.column("part"), pa.array([before[part] + row.column("ahead")[0].as_py()], pa.int64()),
                    row.column("doc_ids"), row.column("counts"), pa.array([control], pa.binary()), pa.array([data], pa.binary())],
                    ["part", "first", "doc_ids", "counts", "control", "data"])

    encoded.select("part", "ahead", "doc_ids", "counts", "ids").mapInArrow(
        run, "part int, first long, doc_ids array<long>, counts array<long>, control binary, data binary").write.parquet(f"{path}/blocks")
    spark.createDataFrame([(order.tolist(),)], "ids array<int>").write.parquet(f"{path}/ranks")
    discard(spark, plain)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from token files: the checksum is over the document's ids as little-endian 32-bit integers.

    A row for each document written, in no order; rows that repeat a doc_id or lack one each have their own place.
    """
    order = np.array(spark.read.parquet(f"{path}/ranks").first()["ids"], np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                counts = row.column("counts").flatten().to_numpy()
                ids = order[unpack(row.column("control")[0].as_py(), row.column("data")[0].as_py(), int(counts.sum()))]
                ends = np.cumsum(counts)
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * (e - c) : 4 * e]) for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([row.column("doc_ids").flatten(), pa.array(ends - counts + row.column("first")[0].as_py()), pa.array(counts), pa.array(crc, pa.int64())],
                                                 ["doc_id", "start", "n_tokens", "ids_crc32"])

    return spark.read.parquet(f"{path}/blocks").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
