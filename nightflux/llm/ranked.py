"""Ranked lexical search: impact vectors in buckets of falling length, pruned by Cauchy-Schwarz and coordinate bounds."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from nightflux.llm.common import SPACED, batches, lists
from nightflux.session import cut

#: A block of items holds about so many terms and items, which bounds what goes along with every task.
TERMS, ITEMS = 1 << 19, 4096
#: Rows and entries of a bucket, and the share of the longest vectors that is searched first, in rows.
BUCKET, ENTRIES, FIRST = 4096, 1 << 21, 16384
#: Heaviest coordinates of an item that bound its scores in a bucket.
FOCUS = 8
NO_ID = np.iinfo(np.int64).max


def terms(data: bytes | None) -> list[bytes]:
    """Runs of digits, letters (A to Z made small) and all that is not ASCII."""
    return (data or b"").translate(SPACED).split()


def _terms_of(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct terms of each item and how often it holds them."""
    for batch in batches(stream):
        found, counts = [], []
        for data in batch.column(1).cast(pa.binary()).to_pylist():
            own: dict[bytes, int] = {}
            for t in terms(data):
                own[t] = own.get(t, 0) + 1
            found.append([t.decode() for t in own])
            counts.append(list(own.values()))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string())), pa.array(counts, pa.list_(pa.int64()))], ["item_id", "terms", "counts"])


def _vectors(numbers: dict[bytes, int]):
    """Number of terms of each document, and the numbers and frequencies of those that the items hold."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = numbers.get
        for batch in batches(stream):
            sizes, ids, counts = [], [], []
            for data in batch.column(1).cast(pa.binary()).to_pylist():
                words = terms(data)
                own = np.fromiter((x for x in map(get, words) if x is not None), np.int32)
                number, count = np.unique(own, return_counts=True)
                sizes.append(len(words))
                ids.append(number)
                counts.append(count)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), lists(ids, pa.int32()), lists(counts, pa.int64())], ["doc_id", "n", "ids", "tf"])

    return run


class Items:
    """Items as weighted term vectors: ``term``, ``weight`` (term weight times repeats) of each, heaviest first."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]]):
        self.vectors = []
        for number, weight in vectors:
            order = np.argsort(-weight, kind="stable")
            self.vectors.append((number[order], weight[order].astype(np.int64)))
        squares = [weight.astype(np.float64) ** 2 for _, weight in self.vectors]
        self.length = np.array([math.sqrt(s.sum()) for s in squares])
        #: Length of what the heaviest coordinates leave.
        self.rest = np.array([math.sqrt(s[FOCUS:].sum()) for s in squares])


class Bucket:
    """Impact vectors by column: rows and impacts of each term."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, starts: np.ndarray, term: np.ndarray, impact: np.ndarray):
        self.ids, self.lengths, self.longest = ids, lengths, float(lengths.max())
        row = np.repeat(np.arange(len(ids)), np.diff(starts))
        order = np.argsort(term, kind="stable")
        self.row, self.impact = row[order], impact[order]
        self.terms, first = np.unique(term[order], return_index=True)
        self.ends = np.append(first, len(order))

    def columns(self, number: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Place in ``number``, rows and impacts of each of its terms that the bucket holds."""
        at = np.searchsorted(self.terms, number)
        held = np.flatnonzero((at < len(self.terms)) & (self.terms[np.minimum(at, len(self.terms) - 1)] == number)) if len(self.terms) else []
        for k in held:
            a, b = self.ends[at[k]], self.ends[at[k] + 1]
            yield int(k), self.row[a:b], self.impact[a:b]

    def scores(self, items: Items, q: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows that can reach ``least`` and their exact scores, none of them below it."""
        number, weight = items.vectors[q]
        slack = 1 + 1e-9
        if items.length[q] * self.longest * slack < least:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        total, known = np.zeros(len(self.ids), np.int64), np.zeros(len(self.ids))
        for k, row, impact in self.columns(number[:FOCUS]):
            total[row] += weight[k] * impact
            known[row] += impact.astype(np.float64) ** 2
        # what the other coordinates can add: the lengths that both sides have left
        left = np.sqrt(np.maximum(self.lengths**2 * slack - known, 0))
        able = total + items.rest[q] * left * slack + 1e-6 >= least
        if not able.any():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        for k, row, impact in self.columns(number[FOCUS:]):
            total[row] += weight[FOCUS + k] * impact
        rows = np.flatnonzero(able & (total >= least))
        return rows, total[rows]


def _buckets(stream: Iterator[pa.RecordBatch]) -> Iterator[Bucket]:
    """Buckets of neighbouring rows; they keep what they need, so memory is bounded by a bucket and its longest text."""
    held: list[tuple] = []
    rows = entries = 0

    def made() -> Bucket:
        ids, lengths, counts, term, impact = (np.concatenate(x) for x in zip(*held, strict=True))
        return Bucket(ids, lengths, np.concatenate(([0], np.cumsum(counts))), term, impact)

    for whole in stream:
        for batch in (whole.slice(a, 512) for a in range(0, whole.num_rows, 512)):
            ids = batch.column(0).fill_null(NO_ID).to_numpy()
            term, impact = (batch.column(k).flatten().to_numpy() for k in (2, 3))
            counts = batch.column(2).value_lengths().to_numpy()
            held.append((ids, np.sqrt(batch.column(1).to_numpy().astype(np.float64)), counts, term, impact))
            rows, entries = rows + len(ids), entries + len(term)
            if rows >= BUCKET or entries >= ENTRIES:
                yield made()
                held, rows, entries = [], 0, 0
    if held:
        yield made()


def _searched(items: Items, least: list[int], k: int):
    """The k best of the task's rows for each item, as far as they reach ``least``; the k-th score so far goes on to the next bucket."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kth = list(least)
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(kth)
        for bucket in _buckets(stream):
            for q in np.flatnonzero(items.length * bucket.longest * (1 + 1e-9) >= np.array(kth)).tolist():
                rows, score = bucket.scores(items, q, kth[q])
                if not len(rows):
                    continue
                ids, score = np.concatenate((best[q][0], bucket.ids[rows])), np.concatenate((best[q][1], score))
                order = np.lexsort((ids, -score))[:k]
                best[q] = ids[order], score[order]
                if len(order) == k:
                    kth[q] = max(kth[q], int(score[order[-1]]))
        item = np.repeat(np.arange(len(best)), [len(x) for x, _ in best])
        ids, score = (np.concatenate([b[j] for b in best]) if best else np.zeros(0, np.int64) for j in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(ids, mask=ids == NO_ID), pa.array(score)], ["item", "doc_id", "score"])

    return run


def _block(spark, docs: DataFrame, block: list, k: int) -> DataFrame:
    """Best documents of one block of items: ``item`` (place in the block), ``doc_id``, ``score``."""
    numbers: dict[bytes, int] = {}
    for r in block:
        for t in r["terms"]:
            numbers.setdefault(t.encode(), len(numbers))
    vectors = cut(docs.mapInArrow(_vectors(numbers), "doc_id long, n long, ids array<int>, tf array<long>"))
    size = vectors.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = size["docs"], size["terms"] or 0
    df = np.zeros(len(numbers), np.int64)
    for r in vectors.select(F.explode("ids").alias("id")).groupBy("id").count().collect():  # at most a row a term of the block
        df[r["id"]] = r["count"]
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    items = Items([(np.array([numbers[t.encode()] for t in r["terms"]], np.int64), np.array([weight[numbers[t.encode()]] * c for t, c in zip(r["terms"], r["counts"], strict=True)], np.int64)) for r in block])
    m = F.expr(f"75 + (25 * n * {n_docs}L) div {max(n_terms, 1)}L")
    held = vectors.where(F.size("ids") > 0).withColumn("m", m)
    held = held.select("doc_id", "ids", F.expr("transform(tf, t -> (1000000000L * t) div (1000L * t + 12L * m))").alias("impact"))
    held = held.withColumn("square", F.expr("aggregate(impact, 0L, (a, x) -> a + x * x)"))
    # equal lengths (copies) are dealt by id, so that no group of them is one task's
    longest = cut(held.select("doc_id", "square", "ids", "impact").repartitionByRange(F.desc("square"), F.asc("doc_id")).sortWithinPartitions(F.desc("square"), F.asc("doc_id")))
    share = min(1.0, FIRST / max(n_docs, 1))
    edge = longest.agg(F.expr(f"percentile_approx(square, {1 - share}D, 1000)")).first()[0] or 0
    kind = "item int, doc_id long, score long"
    rank = F.row_number().over(W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))

    def best(rows: DataFrame) -> DataFrame:
        return rows.withColumn("rank", rank).where(F.col("rank") <= k)

    least = [1] * len(block)
    first = cut(best(longest.where(F.col("square") >= edge).mapInArrow(_searched(items, least, k), kind)))
    for r in first.where(F.col("rank") == k).collect():  # a row an item of the block
        least[r["item"]] = r["score"]
    rest = longest.where(F.col("square") < edge).mapInArrow(_searched(items, least, k), kind)
    return best(first.drop("rank").unionByName(rest))


def search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """The k best documents of each item: ``item_id``, ``rank`` from 1, ``doc_id``, ``score``.

    Takes ``doc_id`` and ``text`` of the documents, ``item_id`` and ``text`` of the items; other columns do not matter.
    Terms are runs of digits, letters (capitals made small) and all that is not ASCII, in whole texts; null and empty texts have
    none and are not counted.  A document's score is the sum, over the item's terms with repeats, of the term's weight
    floor(1000 ln((2N + 2) / (2 df + 1))) times its impact (10^9 tf) div (1000 tf + 12 m), m being 75 + (25 n N) div L.
    Scores are above 0; ties go to the smaller doc_id, nulls last.  Every row of the documents counts, repeated ones too;
    of rows that repeat an item_id that with the smallest text is asked.

    Documents become vectors of impacts over the terms of a block of items, ordered by length over all tasks and cut into
    buckets.  The longest are searched first; the k-th scores found there go along to all others.  A bucket whose longest vector
    cannot reach it (Cauchy-Schwarz) is left out; inside, the heaviest coordinates with the lengths left over bound each row;
    the rows that remain get their exact score in 64-bit integers.

    Items are asked in blocks of about TERMS terms and ITEMS items, the only thing that goes to the driver and to every task; each
    block reads the documents once.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    kind = items.schema["item_id"].dataType.simpleString()
    asked = items.select("item_id", "text").groupBy("item_id").agg(F.min("text").alias("text"))
    asked = cut(asked.mapInArrow(_terms_of, f"item_id {kind}, terms array<string>, counts array<long>").where(F.size("terms") > 0))
    size = asked.agg(F.count("*").alias("items"), F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("terms")).first()
    blocks = max(-(-size["terms"] // TERMS), -(-size["items"] // ITEMS))
    found = [spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")]
    for number in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == number).collect()
        if not block:
            continue
        rows = cut(_block(spark, docs, block, k))
        names = spark.createDataFrame([(j, r["item_id"]) for j, r in enumerate(block)], f"item int, item_id {kind}")
        found.append(rows.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    whole = found[0]
    for part in found[1:]:
        whole = whole.unionByName(part)
    return whole
