"""SentencePiece BPE without its merge loop: longest matches by Aho-Corasick, backtracking over pairs that re-merge to themselves."""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.words import binary, chunks

_META = "▁"
#: Bytes of units and ids that a worker remembers, and pairs of neighbours whose verdict it remembers; both start anew beyond.
REMEMBERED_BYTES, REMEMBERED_PAIRS = 80 << 20, 1 << 19


class PieceBPE:
    """Encoder and decoder for a SentencePiece model of the type BPE with byte fallback and the identity normalizer.

    The library merges the adjacent symbols whose joint text is the piece of the highest score, of equal ones the leftmost,
    until no two neighbours make a piece; a character left over that is no piece becomes its UTF-8 bytes. A sequence of
    tokens is that result exactly if each token is the result for its own text and each two neighbours are the result for
    their joint text: the first merge across a border would also be the first in the two tokens alone. So the encoder looks
    for the one such sequence instead of merging. Other kinds of models are refused with a ValueError.
    """

    def __init__(self, model_file: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(model_file, "rb") as raw:
            model.ParseFromString(raw.read())
        rule, trained, kind = model.normalizer_spec, model.trainer_spec, model_pb2_kinds(sentencepiece_model_pb2)
        kinds = {p.type for p in model.pieces}
        if (trained.model_type != trained.BPE or not trained.byte_fallback or trained.treat_whitespace_as_suffix
                or rule.precompiled_charsmap or rule.remove_extra_whitespaces or not rule.escape_whitespaces or not rule.add_dummy_prefix
                or kinds - {kind["NORMAL"], kind["UNKNOWN"], kind["CONTROL"], kind["BYTE"]}):
            raise ValueError(f"{model_file}: only BPE with byte fallback, identity normalizer, dummy prefix and no user-defined or unused pieces")
        self.score = {p.piece: p.score for p in model.pieces if p.type == kind["NORMAL"]}
        self.id_of = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kind["NORMAL"]}
        self.byte_ids = [0] * 256
        self.is_byte = np.array([p.type == kind["BYTE"] for p in model.pieces])
        shown = []
        for i, p in enumerate(model.pieces):
            if p.type == kind["BYTE"]:
                self.byte_ids[int(p.piece[3:5], 16)] = i
                shown.append(bytes([int(p.piece[3:5], 16)]))
            elif p.type == kind["NORMAL"]:
                shown.append(p.piece.replace(_META, " ").encode())
            else:
                shown.append(trained.unk_surface.encode() if p.type == kind["UNKNOWN"] else b"")
        self.shown = pa.array(shown, pa.large_binary())
        self.starts_bare = np.array([p.type == kind["NORMAL"] and p.piece.startswith(_META) for p in model.pieces])
        self.is_control = np.array([p.type == kind["CONTROL"] for p in model.pieces])
        self.decimal = pa.array([f"{i}," for i in range(len(shown))], pa.large_binary())
        # Pieces that merging can reach, found from the right: for each place of a text the longest that starts there.
        self.tokens = {p for p in self.score if len(p) == 1 or self.merge(p) == [p]}
        self.longest = ahocorasick.Automaton()
        for p in self.tokens:
            self.longest.add_word(p[::-1], p)
        self.longest.make_automaton()
        # The next shorter token that starts like a token; a single character always is one.
        self.shorter = {p: next((p[:n] for n in range(len(p) - 1, 0, -1) if n == 1 or p[:n] in self.tokens), None) for p in self.tokens}
        # Where no piece may lie across, a text can be cut: before white space after something else, and around line feeds.
        inner = {pair for p in self.score for pair in zip(p, p[1:], strict=False)}
        self.cut_spaces = not any(b == _META and a != _META for a, b in inner)
        self.cut_lines = not any("\n" in pair for pair in inner)
        self.pairs: dict[tuple[str, str], bool] = {}
        self._forget()

    def _forget(self) -> None:
        self.slot: dict[bytes, int] = {}
        self.begin, self.size, self.known = array("q"), array("q"), array("i")
        self.held = 0

    def merge(self, text: str) -> list[str]:
        """The library's merges on a short text."""
        parts, score = list(text), self.score.get
        while len(parts) > 1:
            best, at = None, -1
            for i, joint in enumerate(map("".join, zip(parts, parts[1:], strict=False))):
                if (s := score(joint)) is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _fit(self, left: str, right: str) -> bool:
        """Do the two tokens stay as they are when their joint text is merged anew?"""
        if len(self.pairs) >= REMEMBERED_PAIRS:
            self.pairs.clear()
        known = self.pairs[left, right] = self.merge(left + right) == [left, right]
        return known

    def split(self, text: str) -> list[str]:
        """The tokens of a text in which spaces are already written as U+2581.

        The longest token at each place is tried first, then shorter ones. If none fits the token before, the place is marked
        in a bitfield as failed and the token before gives way; a failed place is never entered again, since the tokens up to
        a place do not depend on what follows. So each place is left backwards at most once.
        """
        n = len(text)
        if text in self.tokens or n < 2:
            return [text] if n else []
        longest = list(text)
        for end, token in reversed(list(self.longest.iter(text[::-1]))):  # of one end the longest comes first
            longest[n - 1 - end] = token
        known, shorter = self.pairs.get, self.shorter.get
        failed, out, before, at = bytearray(n // 8 + 1), [], None, 0
        token = longest[0]
        while at < n:
            end = at + len(token)
            if not failed[end >> 3] >> (end & 7) & 1:
                fits = before is None or known((before, token))
                if fits or fits is None and self._fit(before, token):
                    out.append(token)
                    before, at = token, end
                    if at < n:
                        token = longest[at]
                    continue
            token = shorter(token)
            while token is None:
                failed[at >> 3] |= 1 << (at & 7)
                last = out.pop()
                before = out[-1] if out else None
                at -= len(last)
                token = shorter(last)
        return out

    def _ids(self, tokens: list[str]) -> list[int]:
        ids = list(map(self.id_of.get, tokens))
        if None in ids:
            return [i for t, i in zip(tokens, ids, strict=True) for i in ([i] if i is not None else map(self.byte_ids.__getitem__, t.encode()))]
        return ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each has; texts is a column of strings, null as empty.

        Texts are cut into units where no piece can lie across, words with their spaces as a rule. Each distinct unit
        is encoded once for each worker, as long as the memory of units lasts.
        """
        raw = binary(pc.replace_substring(texts.cast(pa.large_string()), _META, " "))
        offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1] if len(raw) else np.zeros(1, np.int64)
        if offsets[-1] == offsets[0]:
            return np.zeros(0, np.int32), np.zeros(len(raw), np.int64)
        data = np.frombuffer(raw.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        full = np.diff(offsets) > 0
        data = np.insert(data, offsets[:-1][full], 0x20)
        offsets = offsets + np.concatenate([[0], np.cumsum(full)])
        start = np.zeros(len(data), bool)
        start[offsets[:-1][full]] = True
        if self.cut_spaces:
            space = data == 0x20
            start[1:] |= space[1:] & ~space[:-1]
        if self.cut_lines:
            line = data == 0x0A
            start |= line
            start[1:] |= line[:-1]
        begin = np.flatnonzero(start)
        ends = np.append(begin, len(data)).astype(np.int64)
        units = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(ends), pa.py_buffer(data)]).dictionary_encode()
        distinct = units.dictionary.to_pylist()
        if self.held > REMEMBERED_BYTES:
            self._forget()
        self._learn([u for u in distinct if u not in self.slot])
        slots = np.array([self.slot[u] for u in distinct], np.int64)[units.indices.to_numpy()]
        size, where = np.frombuffer(self.size, np.int64)[slots], np.frombuffer(self.begin, np.int64)[slots]
        stop = np.cumsum(size)
        flat = np.frombuffer(self.known, np.int32)[np.repeat(where - (stop - size), size) + np.arange(stop[-1])]
        counts = np.diff(np.concatenate([[0], stop])[np.searchsorted(begin, offsets)])
        return flat, counts

    def _learn(self, units: list[bytes]) -> None:
        slot, begin, size, known = self.slot, self.begin, self.size, self.known
        for unit in units:
            ids = self._ids(self.split(unit.decode().replace(" ", _META)))
            slot[unit] = len(begin)
            begin.append(len(known))
            size.append(len(ids))
            known.extend(ids)
            self.held += len(unit) + 4 * len(ids) + 150

    def decode(self, flat: np.ndarray, counts: np.ndarray) -> list[str]:
        """The texts of ids that stand one after the other, counts of them for each text, as the library's decode(ids).

        Pieces stand for their texts with spaces, byte pieces for their bytes, of which those that are no UTF-8 become U+FFFD
        each; control pieces for nothing. The space that the encoder put before a text is taken away.
        """
        parts = self.shown.take(pa.array(flat))
        stops = np.frombuffer(parts.buffers()[1], np.int64)[: len(flat) + 1] if len(flat) else np.zeros(1, np.int64)
        data = memoryview(parts.buffers()[2] or b"")
        inner = np.concatenate([[0], np.cumsum(self.is_control[flat])])
        ends = np.cumsum(counts)
        out = []
        for first, last in zip((ends - counts).tolist(), ends.tolist(), strict=True):
            begin = first
            while begin < last and self.is_control[flat[begin]]:
                begin += 1
            try:
                if inner[last] > inner[begin]:
                    raise UnicodeError("a control piece ends a run of bytes")
                shown = str(data[stops[begin] : stops[last]], "utf-8")
            except UnicodeError:
                shown = "".join(self._repair(flat[begin:last], [p.as_py() for p in parts[begin:last]]))
            out.append(shown[1:] if begin < last and self.starts_bare[flat[begin]] else shown)
        return out

    def _repair(self, ids: np.ndarray, parts: list[bytes]) -> Iterator[str]:
        """Texts of parts, of which runs of byte pieces need not be UTF-8: each byte that belongs to no character is a U+FFFD."""
        at = 0
        while at < len(parts):
            if not self.is_byte[ids[at]]:
                yield parts[at].decode()
                at += 1
                continue
            end = at
            while end < len(parts) and self.is_byte[ids[end]]:
                end += 1
            rest = b"".join(parts[at:end])
            at = end
            while rest:
                for n in range(1, 5):
                    try:
                        yield rest[:n].decode()
                        break
                    except UnicodeDecodeError:
                        pass
                else:
                    yield "�"
                    n = 1
                rest = rest[n:]


def model_pb2_kinds(module) -> dict[str, int]:
    """Names and numbers of the kinds of pieces."""
    return dict(module.ModelProto.SentencePiece.Type.items())


@lru_cache(maxsize=2)
def coder(model_file: str) -> PieceBPE:
    """One encoder for each worker process and model file."""
    return PieceBPE(model_file)


def encode(docs: DataFrame, model_file: str, text: str = "text") -> DataFrame:
    """docs with the column ids (array<int>): the tokens of each whole text, without begin and end.

    A null or empty text has no tokens; other columns, null ids and repeated rows are kept as they are. A narrow map:
    nothing is shuffled. The model file must lie at the same place on all executors, as an installed package does. A column
    ids that docs has is replaced. A text is one value, so it must fit into a worker (some 40 bytes for each of its bytes).
    """
    kept = docs.drop("ids")
    schema = T.StructType([*kept.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = coder(model_file)
        for batch in batches:
            for part in chunks(batch, text):
                flat, counts = pieces.encode(part.column(text))
                stops = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.ListArray.from_arrays(pa.array(stops), pa.array(flat))], [*part.schema.names, "ids"])

    return kept.mapInArrow(run, schema)


def decode(docs: DataFrame, model_file: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """docs with the text of its column ids (array<int>) in the column out; null ids are an empty text. A narrow map."""
    kept = docs.drop(out)
    schema = T.StructType([*kept.schema.fields, T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = coder(model_file)
        for batch in batches:
            lists = batch.column(ids)
            counts = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            texts = pieces.decode(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32), counts)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, out])

    return kept.mapInArrow(run, schema)


def encode_digests(docs: DataFrame, model_file: str) -> DataFrame:
    """For each row of docs the number of its tokens, the sha256 of the ids, and that of the text decoded from the ids.

    Encoding, decoding and digests are one narrow map over doc_id and text, so that ids needn't leave the worker. Null and
    empty texts have no tokens and the digests of nothing; rows that repeat a doc_id or lack one each have a row of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = coder(model_file)
        for batch in batches:
            for part in chunks(batch, "text"):
                flat, counts = pieces.encode(part.column("text"))
                digits = pieces.decimal.take(pa.array(flat))
                stops = np.frombuffer(digits.buffers()[1], np.int64)[: len(flat) + 1] if len(flat) else np.zeros(1, np.int64)
                data, ends = memoryview(digits.buffers()[2] or b""), np.cumsum(counts)
                spans = zip(stops[ends - counts].tolist(), stops[ends].tolist(), strict=True)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array(counts, pa.int64()),
                    pa.array([hashlib.sha256(data[b : max(b, e - 1)]).hexdigest() for b, e in spans], pa.string()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in pieces.decode(flat, counts)], pa.string()),
                ], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
