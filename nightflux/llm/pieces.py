"""SentencePiece encoding and decoding: an Aho-Corasick automaton drives one Viterbi pass."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightflux.llm.bpe import PrefixMerges
from nightflux.llm.common import Remember, batches, small_batches

MARK = "▁"
CHUNK = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
#: What an unknown character scores below the worst piece of a unigram model (fixed value).
UNKNOWN = 10.0
#: Pairs of pieces that a worker remembers from task to task, in each of two generations.
PAIRS = 150_000


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol-buffer message; fixed-width values come as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            n = varint() if key & 7 == 2 else 8 if key & 7 == 1 else 4
            yield key >> 3, data[at : at + n]
            at += n


class UnigramPieces:
    """Best-scoring segmentation of a string under independent piece scores."""

    def __init__(self, scores: dict[str, tuple[int, float]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, (number, score) in scores.items():
            self.automaton.add_word(piece, (len(piece), number, score))
        self.automaton.make_automaton()
        self.unknown = min((s for _, s in scores.values()), default=0.0) - UNKNOWN

    def segments(self, text: str) -> list[tuple[int, int]]:
        """(length, id) of each piece; id -1 for an unknown character.  Of equal scores, that of the longer last piece stays."""
        n = len(text)
        best = [0.0] + [None] * n
        back: list[tuple[int, int]] = [(0, 0)] * (n + 1)
        reached = 0

        def close(upto: int) -> None:
            nonlocal reached
            while reached < upto:
                reached += 1
                if best[reached] is None:
                    best[reached], back[reached] = best[reached - 1] + self.unknown, (1, -1)

        for end, (size, number, score) in self.automaton.iter(text):
            close(end)
            end += 1
            start = best[end - size]
            if best[end] is None or start + score > best[end]:
                best[end], back[end] = start + score, (size, number)
        close(n)
        out = []
        while n:
            out.append(back[n])
            n -= back[n][0]
        return out[::-1]


class MergedPieces(PrefixMerges):
    """Segmentation by merging: a path's score is whether it is what the merges give, and exactly one path has it."""

    def __init__(self, scores: dict[str, tuple[int, float]]):
        get = scores.get
        super().__init__({p: i for p, (i, _) in scores.items()}, lambda a, b: -hit[1] if (hit := get(a + b)) else None, PAIRS)

    def segments(self, text: str) -> list[tuple[int, int]]:
        last = self.prefixes(text)[1]
        out, n = [], len(text)
        while n:
            token = last[n]
            out.append((len(token), self.number[token]) if token else (1, -1))
            n -= out[-1][0]
        return out[::-1]


class Pieces:
    """Encoder and decoder for a model file; ids are those of the library."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            data = f.read()
        trainer = next((v for k, v in fields(data) if k == 2), b"")
        merged = next((v for k, v in fields(trainer) if k == 3), 1) == 2
        self.model = sp = sentencepiece.SentencePieceProcessor(model_proto=data)
        size = sp.get_piece_size()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(size)]
        scores = {sp.id_to_piece(i): (i, sp.get_score(i)) for i in range(size) if not special[i] and not sp.is_unused(i)}
        if any(MARK in p.lstrip(MARK) for p in scores):
            raise ValueError("pieces that reach over a word start are not supported")
        if sp.normalize("Ab  c ") != f"{MARK}Ab{MARK}{MARK}c{MARK}":
            raise ValueError("the model's normaliser is not supported: identity with a leading blank is")
        self.kind = (MergedPieces if merged else UnigramPieces)(scores)
        self.bytes = {b: sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)} if any(map(sp.is_byte, range(size))) else None
        self.unknown = sp.unk_id()
        self.raw = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i) else p.encode() for i in range(size) for p in [sp.id_to_piece(i)]]
        self.unit = Remember(self._ids, 250_000)

    def _ids(self, chunk: str) -> bytes:
        out, at = [], 0
        for size, number in self.kind.segments(chunk):
            if number >= 0:
                out.append(number)
            elif self.bytes:
                out += [self.bytes[b] for b in chunk[at : at + size].encode()]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
            at += size
        return np.array(out, np.int32).tobytes()

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        unit = self.unit
        if text[0] == " " or text[-1] == " " or "  " in text or MARK in text:
            chunks = CHUNK.findall(MARK + text.replace(" ", MARK))
        else:  # no piece reaches over a single blank
            chunks = [MARK + part for part in text.split(" ")]
        return np.frombuffer(b"".join([unit[c] for c in chunks]), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        raw = self.raw
        text = b"".join([raw[i] for i in ids.tolist()]).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


_models: dict[str, Pieces] = {}


def model(path: str) -> Pieces:
    if path not in _models:
        _models[path] = Pieces(path)
    return _models[path]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``ids`` and ``n_pieces`` of each whole text; a null or empty text has no ids."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for batch in batches(stream):
            found = [own.encode(x) for x in batch.column("text").to_pylist()]
            ends = np.zeros(len(found) + 1, np.int32)
            np.cumsum([len(x) for x in found], out=ends[1:])
            flat = pa.array(np.concatenate(found) if found else np.zeros(0, np.int32), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), flat), pa.array(np.diff(ends).astype(np.int64))], ["doc_id", "ids", "n_pieces"])
        own.unit.forget()

    small_batches(docs.sparkSession)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, ids array<int>, n_pieces long")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Adds ``text`` to rows with ``ids``: blanks for word marks, byte pieces joined to characters; null ids give null.

    Decoding undoes encoding but for the mark U+2581 itself, which comes back as a blank.
    """
    names = encoded.columns

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for batch in batches(stream):
            ids = batch.column("ids")
            flat, ends, there = ids.values.to_numpy(), ids.offsets.to_numpy(), ids.is_valid().to_pylist()
            texts = [own.decode(flat[ends[k] : ends[k + 1]]) if ok else None for k, ok in enumerate(there)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(texts, pa.string())], [*names, "text"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(run, f"{schema}, text string")
