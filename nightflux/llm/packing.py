"""Token ids in binary files: Simple-8b words in blocks with offsets.

A file holds documents in ascending order of id.  Little-endian throughout:

* header: magic ``NFS8``, u32 version, u64 documents, u64 ids, u64 words, u64 blocks, u32 ids a block
* words: u64 each; the four high bits select how many ids the other 60 bits hold (``COUNTS``), first id lowest.  Selector 15 is
  an escape: the next word holds one id of up to 64 bits as it is.  No word spans two blocks.
* block offsets: u64, first word of each block, so that any block can be decoded alone
* document table: i64 id, u8 whether the id is there, u64 ids of the document
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from nightflux.llm.common import batches
from nightflux.llm.files import Target, opened
from nightflux.session import cut

HEADER = "<4sIQQQQI"
MAGIC, VERSION, BLOCK = b"NFS8", 1, 4096
#: Blocks coded at once: bounds the memory that a file takes beside its words.
TOGETHER = 64
#: Ids and bits of each selector (fixed values of the coding; 0 and 1 are runs of zeros).
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)
ESCAPE = 15
#: One id of 31 bits or more has no selector of its own here: it is escaped.
PACKED = np.arange(ESCAPE)
TABLE = np.dtype([("id", "<i8"), ("known", "u1"), ("n", "<u8")])


def widths(ids: np.ndarray) -> np.ndarray:
    """Bits of each id; 0 for 0.  A double holds 32 bits exactly, so its exponent is the width."""
    high = ids >> np.uint64(32)
    if high.any():
        return np.where(high > 0, 32 + widths(high), widths(ids & np.uint64(0xFFFFFFFF)))
    return np.frexp(ids.astype(np.float64))[1]


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words and the first word of each block, of any number of unsigned 64-bit ids."""
    words, offsets, done = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], 0
    for k in range(0, len(ids), TOGETHER * BLOCK):
        part, first = _encoded(ids[k : k + TOGETHER * BLOCK])
        words.append(part)
        offsets.append(first + np.uint64(done))
        done += len(part)
    return np.concatenate(words), np.concatenate(offsets)


def _encoded(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ids = np.ascontiguousarray(ids, np.uint64)
    n, blocks = len(ids), -(-len(ids) // BLOCK)
    width = np.zeros(blocks * BLOCK, np.int8)
    width[:n] = widths(ids)
    size = np.full(blocks, BLOCK)
    size[-1] = n - BLOCK * (blocks - 1)
    # selector of a word that starts at a place: the densest whose ids all fit; a block's end is padded with zeros
    choice = np.full(blocks * BLOCK, ESCAPE, np.int8)
    here = np.arange(blocks * BLOCK, dtype=np.int32)
    ends = np.repeat(here[::BLOCK] + np.int32(BLOCK), BLOCK)
    for s in PACKED[::-1]:
        fits = width <= BITS[s]
        wide = np.append(np.flatnonzero(~fits), blocks * BLOCK).astype(np.int32)
        runs = np.diff(wide, prepend=-1)
        if runs.max() > COUNTS[s]:
            ahead = np.repeat(wide, runs)[: blocks * BLOCK]
            choice[((ahead - here) >= COUNTS[s]) | ((ahead >= ends) & fits)] = s
    choice = choice.reshape(blocks, BLOCK)
    step = np.where(choice == ESCAPE, 1, COUNTS[choice])
    # all blocks walk at once
    starts, owners, at, rows = [], [], np.zeros(blocks, np.int64), np.arange(blocks)
    while len(rows):
        starts.append(at[rows])
        owners.append(rows)
        at[rows] += step[rows, at[rows]]
        rows = rows[at[rows] < size[rows]]
    start, owner = np.concatenate(starts), np.concatenate(owners)
    order = np.lexsort((start, owner))
    start, owner = start[order], owner[order]
    picked = choice[owner, start].astype(np.int64)
    spans = 1 + (picked == ESCAPE)
    first = np.concatenate(([0], np.cumsum(spans)))
    words = np.zeros(first[-1], np.uint64)
    padded = np.concatenate((ids, np.zeros(int(COUNTS.max()), np.uint64)))
    flat = owner * BLOCK + start
    limit = owner * BLOCK + size[owner]
    for s in np.unique(picked):
        rows = np.flatnonzero(picked == s)
        words[first[rows]] = np.uint64(s) << np.uint64(60)
        if s == ESCAPE:
            words[first[rows] + 1] = ids[flat[rows]]
        elif BITS[s]:
            place, bits = flat[rows], np.uint64(BITS[s])
            word = padded[place]
            for k in range(1, COUNTS[s]):
                word |= padded[place + k] << (np.uint64(k) * bits)
            over = np.flatnonzero(place + COUNTS[s] > limit[rows])  # a block's last word: only its own ids
            own = (limit[rows[over]] - place[over]).astype(np.uint64)
            word[over] &= (np.uint64(1) << (own * bits)) - np.uint64(1)
            words[first[rows]] |= word
    offsets = first[np.searchsorted(owner, np.arange(blocks))].astype(np.uint64)
    return words, offsets


def decode(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The n ids back."""
    return np.concatenate([np.zeros(0, np.uint64), *_parts(words, offsets, n)])


def _parts(words: np.ndarray, offsets: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """The n ids in order, a few blocks at a time."""
    ends = np.append(offsets, np.uint64(len(words))).astype(np.int64)
    for k in range(0, len(offsets), TOGETHER):
        upto = min(len(offsets), k + TOGETHER)
        yield _decoded(words[ends[k] : ends[upto]], offsets[k:upto] - offsets[k], min(n, upto * BLOCK) - k * BLOCK)


def _decoded(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """All words of a selector at once."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    # an escape's second word is data; escapes can follow each other, so the words are told apart by alternation inside runs
    data = np.zeros(len(words), bool)
    at = np.flatnonzero(selector == ESCAPE)
    k = 0
    while k < len(at):
        if not data[at[k]] and at[k] + 1 < len(words):
            data[at[k] + 1] = True
        k += 1
    head = np.flatnonzero(~data)
    picked = selector[head]
    block = np.searchsorted(offsets, head.astype(np.uint64), side="right") - 1
    count = np.where(picked == ESCAPE, 1, COUNTS[picked])
    # ids before each word: inside its block, after whole blocks
    upto = np.cumsum(count) - count
    start = upto - upto[np.searchsorted(block, np.arange(len(offsets)))][block] + block * BLOCK
    out = np.zeros(len(offsets) * BLOCK + int(COUNTS.max()), np.uint64)
    ends = np.minimum((block + 1) * BLOCK, n)
    for s in np.unique(picked):
        rows = np.flatnonzero(picked == s)
        if s == ESCAPE:
            out[start[rows]] = words[head[rows] + 1]
        elif BITS[s]:
            mask = np.uint64((1 << int(BITS[s])) - 1)
            for k in range(COUNTS[s]):
                place = start[rows] + k
                ok = place < ends[rows]
                out[place[ok]] = (words[head[rows[ok]]] >> np.uint64(k * BITS[s])) & mask
    return out[:n]


def _written(folder: str, ids_of: Callable[[], Callable], docs_a_file: int):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held, lengths, keys, parts, size = ids_of(), [], [], [], [], 0

        def flush() -> None:
            ids = np.concatenate(held) if held else np.zeros(0, np.uint32)
            words, offsets = encode(ids)
            table = np.zeros(len(keys), TABLE)
            table["known"] = [k is not None for k in keys]
            table["id"] = [k or 0 for k in keys]
            table["n"] = lengths
            with Target(folder, "ids") as f:
                f.write(struct.pack(HEADER, MAGIC, VERSION, len(keys), len(ids), len(words), len(offsets), BLOCK))
                for part in (words, offsets, table):
                    f.write(part.tobytes())
            known = [k for k in keys if k is not None]
            parts.append((f.name, len(keys), len(ids), min(known, default=None), len(known) < len(keys)))
            held.clear(), lengths.clear(), keys.clear()

        for batch in batches(stream, 1024):
            for key, ids in zip(batch.column("doc_id").to_pylist(), own(batch.column("text").to_pylist()), strict=True):
                held.append(ids)
                lengths.append(len(ids))
                keys.append(key)
                size += len(ids)
                if len(keys) >= docs_a_file or size >= 8_000_000:
                    flush()
                    size = 0
        if keys:
            flush()
        columns = list(zip(*parts, strict=True)) or [[], [], [], [], []]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(parts)), pa.int32()), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["place", "file", "docs", "ids", "low", "unknown"])

    return run


def write(docs: DataFrame, folder: str, ids_of: Callable[[], Callable], docs_a_file: int = 20_000) -> DataFrame:
    """Writes the ids of every text in ascending order of doc_id and returns the manifest.

    ``ids_of()`` gives, inside a task, a function from a list of texts to a list of id arrays.  A range
    partitioning by doc_id (null ids last) orders the files; the manifest has ``file``, ``docs``, ``ids``
    and ``start``, the ids in all files before.  A file holds at most ``docs_a_file`` documents, so no task holds its whole partition.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = [F.col("doc_id").asc_nulls_last()]
    ranged = docs.repartitionByRange(*order, F.xxhash64("text")).sortWithinPartitions(*order, F.xxhash64("text"))
    schema = "place int, file string, docs long, ids long, low long, unknown boolean"
    made = ranged.mapInArrow(_written(folder, ids_of, docs_a_file), schema).withColumn("task", F.spark_partition_id())
    made = cut(made)
    before = W.orderBy("task", "place").rowsBetween(W.unboundedPreceding, -1)  # a row a file
    return made.select("file", "docs", "ids", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("start"))


def _documents(folder: str, name: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of a file's document table, bounds of their ids and the ids, as far as a few blocks complete them."""
    with opened(folder, name) as f:
        magic, version, docs, n, words, blocks, block = struct.unpack(HEADER, f.read(struct.calcsize(HEADER)))
        if (magic, version, block) != (MAGIC, VERSION, BLOCK):
            raise ValueError(f"{name} is no id file of this version")
        code = np.frombuffer(f.read(8 * words), np.uint64)
        offsets = np.frombuffer(f.read(8 * blocks), np.uint64)
        table = np.frombuffer(f.read(TABLE.itemsize * docs), TABLE)
    bounds = np.concatenate(([0], np.cumsum(table["n"].astype(np.int64))))
    held, row, decoded = [np.zeros(0, np.uint64)], 0, 0
    for part in _parts(code, offsets, n):
        held.append(part)
        decoded += len(part)
        upto = int(np.searchsorted(bounds, decoded, side="right")) - 1
        if upto > row:
            ids, size = np.concatenate(held), bounds[upto] - bounds[row]
            yield table[row:upto], bounds[row : upto + 1], ids[:size]
            held, row = [ids[size:]], upto
    if row < docs:  # only documents without ids are left
        yield table[row:], bounds[row:], held[0][:0]


def _read(folder: str, columns: Callable[[np.ndarray, np.ndarray], dict]):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True):
                for table, bounds, ids in _documents(folder, name):
                    key = pa.array(table["id"], mask=table["known"] == 0)
                    yield pa.RecordBatch.from_pydict({"doc_id": key, "start": pa.array(bounds[:-1] + start)} | columns(bounds - bounds[0], ids))

    return run


def _whole(bounds: np.ndarray, ids: np.ndarray) -> dict:
    return {"ids": pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int64)))}


def _sums(bounds: np.ndarray, ids: np.ndarray) -> dict:
    data, ends = memoryview(ids.astype("<u4")).cast("B"), bounds.tolist()
    found = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
    return {"n_tokens": pa.array(np.diff(bounds)), "ids_crc32": pa.array(found, pa.int64())}


def _files(manifest: DataFrame) -> DataFrame:
    return manifest.select("file", "start").repartition(max(1, manifest.count()), "file")  # a task a file


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """``doc_id``, ``start`` and ``ids`` of every document in the files of a manifest."""
    return _files(manifest).mapInArrow(_read(folder, _whole), "doc_id long, start long, ids array<long>")


def checksums(manifest: DataFrame, folder: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` of every document, from the ids read back where they are decoded.

    ``ids_crc32`` is the crc32 of the ids as little-endian unsigned 32-bit integers.
    """
    return _files(manifest).mapInArrow(_read(folder, _sums), "doc_id long, start long, n_tokens long, ids_crc32 long")
