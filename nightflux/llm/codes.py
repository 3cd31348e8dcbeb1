"""Integer product codes of vectors: nearest entries by early elimination in Walsh-Hadamard order."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightflux.llm.kdtree import usable
from nightflux.session import cut

#: Coefficients after which entries are eliminated, and rows of a part that are compared with a codebook at once.
STEP, ROWS = 4, 1024
LONG = 1 << 63


def integers(values: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x) of finite doubles: 64-bit integers, or Python's own where one is too large for them."""
    values = values.astype(np.float64)
    if np.abs(values).max(initial=0) * abs(scale) < 2**62:
        return np.floor(values * scale).astype(np.int64)
    exact = [math.floor(y if math.isfinite(y := x * scale) else Fraction(x) * Fraction(scale)) for x in values.ravel().tolist()]
    return np.array(exact, object).reshape(values.shape)


def sequency(size: int) -> np.ndarray:
    """Order of the rows of the Hadamard matrix of a power of two by their number of sign changes."""
    k = np.arange(size)
    signs = np.array([[(int(a) & int(b)).bit_count() & 1 for b in k] for a in k]).reshape(size, size)
    return np.argsort((signs[:, 1:] != signs[:, :-1]).sum(1), kind="stable")


def walsh(points: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of the rows in sequency order, zero-padded to a power of two; integers stay integers."""
    size = 1 << max(0, points.shape[1] - 1).bit_length()
    out = np.zeros((len(points), size), points.dtype)
    out[:, : points.shape[1]] = points
    half = 1
    while half < size:
        pairs = out.reshape(len(points), -1, 2, half)
        out = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), 2).reshape(len(points), size)
        half *= 2
    return out[:, sequency(size)]


class Codebook:
    """Entries of one part and the search for the nearest."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.turned = walsh(entries)
        self.size = self.turned.shape[1]
        self.largest = int(np.abs(entries).max(initial=0))

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of each row's nearest entry; ties go to the lower number."""
        largest = max(self.largest, int(np.abs(points).max(initial=0)))
        kind = np.int64 if 4 * self.size**3 * largest**2 < LONG else object
        turned, own = walsh(points.astype(kind)), self.turned.astype(kind)
        numbers, distances = np.zeros(len(points), np.int64), np.zeros(len(points), kind)
        for at in range(0, len(points), ROWS):
            numbers[at : at + ROWS], distances[at : at + ROWS] = self._search(turned[at : at + ROWS], own)
        return numbers, distances // self.size

    @staticmethod
    def _search(turned: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sums = np.zeros((len(turned), len(own)), turned.dtype)
        for k in range(min(STEP, turned.shape[1])):
            gap = turned[:, k, None] - own[None, :, k]
            sums += gap * gap
        # the whole distance to the entry that leads so far is a bound for all others
        lead = sums.argmin(1)
        gap = turned[:, STEP:] - own[lead, STEP:]
        bound = sums[np.arange(len(turned)), lead] + (gap * gap).sum(1)
        row, entry = np.nonzero(sums <= bound[:, None])
        left = sums[row, entry]
        for k in range(STEP, turned.shape[1], STEP):
            gap = turned[row, k : k + STEP] - own[entry, k : k + STEP]
            left = left + (gap * gap).sum(1)
            keep = (left <= bound[row]).astype(bool)
            row, entry, left = row[keep], entry[keep], left[keep]
        starts = np.searchsorted(row, np.arange(len(turned)))
        least = np.minimum.reduceat(left, starts)
        wins = np.flatnonzero((left == least[row]).astype(bool))
        first = wins[np.searchsorted(row[wins], np.arange(len(turned)))]  # entries ascend within a row
        return entry[first], left[first]


@dataclass
class Codebooks:
    """A codebook for each part of vectors of ``size`` components; the last part is zero-padded if parts do not divide them."""

    size: int
    scale: float
    books: list[np.ndarray]

    @property
    def width(self) -> int:
        return -(-self.size // len(self.books))

    def points(self, column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the books' length, and their integers by part."""
        rows = np.flatnonzero(pc.fill_null(pc.equal(pc.list_value_length(column), self.size), False).to_numpy(zero_copy_only=False))
        flat = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
        whole = integers(flat.reshape(len(rows), self.size), self.scale)
        padded = np.zeros((len(rows), len(self.books) * self.width), whole.dtype)
        padded[:, : self.size] = whole
        return rows, padded.reshape(len(rows), len(self.books), self.width)

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(x) for book in self.books for x in book.ravel().tolist()).encode()).hexdigest()


def _sums(books: Codebooks):
    """Count and sums of the members of each entry: a row for each part and entry of a task."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [Codebook(b) for b in books.books]
        counts = np.zeros((len(search), len(books.books[0])), np.int64)
        totals = np.zeros((*counts.shape, books.width), object)
        for batch in stream:
            _, points = books.points(batch.column(0))
            for part, book in enumerate(search):
                own = points[:, part]
                numbers, _ = book.nearest(own)
                counts[part] += np.bincount(numbers, minlength=counts.shape[1])
                order = np.argsort(numbers, kind="stable")
                used, starts = np.unique(numbers[order], return_index=True)
                if len(used):
                    small = own.dtype != object and int(np.abs(own).max(initial=0)) * len(own) < LONG
                    totals[part, used] += np.add.reduceat(own[order] if small else own[order].astype(object), starts, axis=0).astype(object)
        part, entry = np.nonzero(counts)
        text = [",".join(map(str, totals[p, e])) for p, e in zip(part, entry, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry]), pa.array(text, pa.string())], ["part", "entry", "n", "sums"])

    return run


def _means(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Componentwise floor of sum over count.  A task has all rows of its entries, one from each task before, and sums of any size."""
    counts: dict[tuple[int, int], int] = {}
    sums: dict[tuple[int, int], list[int]] = {}
    for batch in stream:
        for r in batch.to_pylist():
            key, own = (r["part"], r["entry"]), [int(x) for x in r["sums"].split(",")]
            counts[key] = counts.get(key, 0) + r["n"]
            sums[key] = [a + b for a, b in zip(sums[key], own, strict=True)] if key in sums else own
    yield pa.RecordBatch.from_pylist(
        [{"part": p, "entry": e, "mean": ",".join(str(s // n) for s in sums[p, e])} for (p, e), n in counts.items()],
        pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("mean", pa.string())]))


def fit(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: float = 1024.0) -> Codebooks | None:
    """Codebooks of the parts of ``embedding``: seeds are the vectors of the smallest ``vec_id`` (nulls last, then by vector).

    Each round assigns all parts and replaces every used entry by the floor of its members' mean.  Only vectors that
    are there, not empty, without null or non-finite components, and as long as that of the smallest vec_id count.
    None if there are none.  The driver gets ``entries`` seeds and the books, whose size does not grow with the rows.
    """
    kept = vectors.select(F.col("vec_id").alias("i"), F.col("embedding").alias("v")).where(usable(F.col("v")))
    order = [F.asc_nulls_last("i"), F.asc("v")]
    first = kept.orderBy(*order).limit(1).collect()
    if not first:
        return None
    size = len(first[0]["v"])
    alike = kept.where(F.size("v") == size)
    seeds = np.array([r["v"] for r in alike.orderBy(*order).limit(entries).collect()], np.float64)
    books = Codebooks(size, scale, [np.zeros((0, 0))] * parts)
    whole = books.points(pa.array(seeds.tolist(), pa.list_(pa.float64())))[1]
    books.books = [whole[:, p] for p in range(parts)]
    for _ in range(rounds):
        sums = alike.select("v").mapInArrow(_sums(books), "part int, entry int, n long, sums string")
        means = sums.repartition("part", "entry").mapInArrow(_means, "part int, entry int, mean string").collect()
        new = [b.astype(object) for b in books.books]
        for r in means:
            new[r["part"]][r["entry"]] = [int(x) for x in r["mean"].split(",")]
        small = max((int(np.abs(b).max(initial=0)) for b in new), default=0) < 2**62
        books.books = [b.astype(np.int64) if small else b for b in new]
    return books


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """``vec_id``, ``label``, ``code`` (two hex digits a part) and ``error`` (squared distances summed over the parts).

    Vectors of another length than the books' have neither code nor error; an error beyond a long is null.
    """
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [Codebook(b) for b in books.books]
        for batch in stream:
            rows, points = books.points(batch.column(2))
            found = [book.nearest(points[:, p]) for p, book in enumerate(search)]
            code, error = [None] * batch.num_rows, [None] * batch.num_rows
            numbers = np.stack([n for n, _ in found], 1).astype(np.uint8)
            total = sum(d.astype(object) for _, d in found)
            for k, row in enumerate(rows.tolist()):
                code[row] = numbers[k].tobytes().hex()
                error[row] = int(total[k]) if total[k] < LONG else None
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(code, pa.string()), pa.array(error, pa.int64())], ["vec_id", "label", "code", "error"])

    label = F.col("label") if "label" in vectors.columns else F.lit(None).cast("int")
    kept = vectors.select(F.col("vec_id"), label.alias("label"), F.col("embedding").alias("v")).where(usable(F.col("v")))
    kinds = [f.dataType.simpleString() for f in kept.schema.fields[:2]]
    return kept.mapInArrow(run, f"vec_id {kinds[0]}, label {kinds[1]}, code string, error long")


def decode(codes: DataFrame, books: Codebooks) -> DataFrame:
    """``vec_id`` and ``embedding``: the entries that ``code`` names, over the scale; null without a code."""
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            out = []
            for code in batch.column(1).to_pylist():
                whole = None if code is None else np.concatenate([b[i] for b, i in zip(books.books, bytes.fromhex(code), strict=True)])[: books.size]
                out.append(None if whole is None else [float(x) / books.scale for x in whole.tolist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.float64()))], ["vec_id", "embedding"])

    kind = codes.schema["vec_id"].dataType.simpleString()
    return codes.select("vec_id", "code").mapInArrow(run, f"vec_id {kind}, embedding array<double>")


def compress(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: float = 1024.0) -> DataFrame:
    """Codes of all vectors with the error of each and of all of its label: ``vec_id``, ``label``, ``code``, ``error``,

    ``label_error``, ``codebooks_sha256``.  Takes ``vec_id``, ``embedding`` and perhaps ``label``; other columns do not matter.
    Rows whose vector is null, empty or holds null or non-finite components are left out; repeated rows and rows without an id
    count as they stand; null labels are one label; sums beyond a long are null.  ``entries`` is at most 256.

    A distance is found as the sum of squared differences of Walsh-Hadamard coefficients (the padded length times the
    distance), in sequency order; entries behind the leader's whole distance are eliminated every few coefficients.
    All of it is integer arithmetic, in Python's own integers where 64 bits do not hold it.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    books = fit(vectors, parts, entries, rounds, scale)
    if books is None:
        books = Codebooks(0, scale, [np.zeros((1, 0), np.int64)] * parts)
        vectors = vectors.limit(0)
    coded = cut(encode(vectors, books))
    sums = coded.groupBy(F.col("label").alias("of")).agg(F.expr("try_cast(sum(cast(error as decimal(20, 0))) as bigint)").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).select("vec_id", "label", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))
