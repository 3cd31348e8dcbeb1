"""Exact top-k by inner product: a KD-tree per shard, searched best box first with a propagated k-th score."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from nightflux.session import cut

SHARD, LEAF, QUERIES = 8192, 256, 256
#: Integers from here on are no longs; scores are cut off there, components beyond take no part.
LONG = 1 << 63


def usable(vector: Column) -> Column:
    """Neither null nor empty, and every component is there and finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & ~bad, F.lit(False))


def scaled(vector: Column, scale: float) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def longs(scores: np.ndarray) -> np.ndarray:
    """Exact integers as longs, cut off at the ends of a long."""
    if scores.dtype == object:
        scores = np.array([max(-LONG, min(LONG - 1, int(x))) for x in scores.tolist()], np.int64)
    return scores.astype(np.int64)


def exact(largest: int, size: int):
    """A type in which sums of ``size`` products up to ``largest`` are exact: doubles multiply fastest, Python's integers always hold."""
    return np.float64 if largest * size < 2**52 else np.int64 if largest * size < LONG else object


class Tree:
    """Median splits along the widest side; each node has its tight box and its smallest id.  Node k has the children 2k + 1 and 2k + 2."""

    def __init__(self, ids: np.ndarray, points: np.ndarray):
        depth = max(0, int(np.ceil(np.log2(max(1, len(ids)) / LEAF))))
        order = np.arange(len(ids))
        spans, boxes = [(0, len(ids))], []
        for k in range(2 ** (depth + 1) - 1):
            a, b = spans[k]
            own = points[order[a:b]]
            low, high = (own.min(0), own.max(0)) if b > a else (np.zeros(points.shape[1], points.dtype),) * 2
            boxes.append((low, high))
            if k < 2**depth - 1:
                middle = (a + b) // 2
                if b - a > 1:
                    side = int((high.astype(np.float64) - low.astype(np.float64)).argmax())
                    order[a:b] = order[a:b][np.argpartition(own[:, side], middle - a)]
                spans += [(a, middle), (middle, b)]
        self.ids, self.points = ids[order], points[order]
        self.spans, self.inner = spans, 2**depth - 1
        self.low, self.high = np.array([x[0] for x in boxes]), np.array([x[1] for x in boxes])
        self.least = [int(self.ids[a:b].min()) if b > a else 1 << 62 for a, b in spans]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The most that a point of each box can score, by query and node."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T

    def search(self, queries: np.ndarray, own: list[int], k: int, known: list[tuple[int, int] | None]) -> Iterator[tuple[int, list[int], list[int]]]:
        """For each query number the ids and scores, best first, that can be among its k best.

        ``known`` has the score and id of a k-th best found elsewhere: boxes and points behind it are left out.
        """
        reach = self.bounds(queries)
        for q in range(len(queries)):
            kth = known[q]
            best_ids, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
            heap = [(-int(reach[q, 0]), 0)]
            while heap:
                bound, node = heapq.heappop(heap)
                if kth and (-bound < kth[0] or (-bound == kth[0] and self.least[node] > kth[1])):
                    if -bound < kth[0]:
                        break
                    continue
                if node < self.inner:
                    for child in (2 * node + 1, 2 * node + 2):
                        if self.spans[child][0] < self.spans[child][1]:
                            heapq.heappush(heap, (-int(reach[q, child]), child))
                    continue
                a, b = self.spans[node]
                score, ids = longs(self.points[a:b] @ queries[q]), self.ids[a:b]
                keep = ids != own[q]
                if kth:
                    keep &= score >= kth[0]
                if not keep.any():
                    continue
                best_ids, best = np.concatenate((best_ids, ids[keep])), np.concatenate((best, score[keep]))
                first = np.lexsort((best_ids, -best))[:k]
                best_ids, best = best_ids[first], best[first]
                if len(best) == k:
                    found = (int(best[-1]), int(best_ids[-1]))
                    if kth is None or (-found[0], found[1]) < (-kth[0], kth[1]):
                        kth = found
            if len(best):
                yield q, best_ids.tolist(), best.tolist()


def _packed(rows: int):
    """Blocks of up to ``rows`` vectors of one length: ids and components as bytes."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        place = 0

        def block(size: int) -> pa.RecordBatch:
            nonlocal place
            part, held[size] = held[size][:rows], held[size][rows:]
            place += 1
            ids, points = np.array([x[0] for x in part], np.int64), np.array([x[1] for x in part], np.int64)
            return pa.RecordBatch.from_arrays([
                pa.array([place - 1], pa.int32()), pa.array([size], pa.int32()), pa.array([ids.tobytes()], pa.binary()), pa.array([points.tobytes()], pa.binary())],
                ["place", "size", "ids", "points"])

        for batch in stream:
            for number, point in zip(batch.column("vec_id").to_pylist(), batch.column("point").to_pylist(), strict=True):
                held.setdefault(len(point), []).append((number, point))
                if len(held[len(point)]) >= rows:
                    yield block(len(point))
        for size in list(held):
            if held[size]:
                yield block(size)

    return run


def _numbered(vectors: DataFrame, rows: int) -> DataFrame:
    """Packed blocks with a number from 0 for each length; a row is a block, so numbering is small work."""
    blocks = cut(vectors.select("vec_id", "point").mapInArrow(_packed(rows), "place int, size int, ids binary, points binary").withColumn("task", F.spark_partition_id()))
    order = blocks.select("task", "place", "size").withColumn("number", F.row_number().over(W.partitionBy("size").orderBy("task", "place")) - 1)
    return cut(blocks.join(order.select("task", "place", "number"), ["task", "place"]).select("number", "size", "ids", "points"))


def _unpacked(ids: bytes, points: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, np.int64), np.frombuffer(points, np.int64).reshape(-1, size)


def _largest(points: np.ndarray) -> int:
    return max(int(points.max(initial=0)), -int(points.min(initial=0)))


def _searched(k: int):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, built = None, None
        for batch in stream:
            for row in batch.to_pylist():
                if built != (row["size"], row["shard"]):
                    tree, built = Tree(*_unpacked(row["ids"], row["points"], row["size"])), (row["size"], row["shard"])
                    whole, most = (tree.points, tree.low, tree.high), _largest(tree.points)
                own, queries = _unpacked(row["q_ids"], row["q_points"], row["size"])
                kind = exact(max(1, most) * max(1, _largest(queries)), row["size"])
                queries = queries.astype(kind)
                if tree.points.dtype != kind:
                    tree.points, tree.low, tree.high = (x.astype(kind) for x in whole)
                known = [None if i not in row["kth"] else row["kth"][i] for i in range(len(own))] if row["kth"] else [None] * len(own)
                found = list(tree.search(queries, own.tolist(), k, known))
                yield pa.RecordBatch.from_arrays([
                    pa.array([int(own[q]) for q, ids, _ in found for _ in ids], pa.int64()), pa.array([i for _, ids, _ in found for i in ids], pa.int64()),
                    pa.array([s for *_, scores in found for s in scores], pa.int64())], ["query_id", "vec_id", "score"])

    return run


def _kth(row_ids: bytes, found: list | None) -> dict[int, tuple[int, int]]:
    place = {int(x): i for i, x in enumerate(np.frombuffer(row_ids, np.int64))}
    return {place[f["query_id"]]: (f["score"], f["vec_id"]) for f in found or []}


def _joined(k: int):
    search = _searched(k)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in stream:
                for row in batch.to_pylist():
                    row["kth"] = _kth(row["q_ids"], row.get("kth"))
                    yield _Rows([row])

        yield from search(rows())

    return run


class _Rows:
    def __init__(self, rows: list[dict]):
        self.rows = rows

    def to_pylist(self) -> list[dict]:
        return self.rows


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, scale: float = 64.0) -> DataFrame:
    """The k best inner products of each query with all vectors: ``query_id``, ``rank`` from 1, ``vec_id``, ``score``.

    Both inputs have ``vec_id`` and ``embedding``; components become floor(scale * x).  Ties go to
    the smaller vec_id.  Rows with the query's own id are not its candidates.  Vectors that are null, empty,
    without id, or hold null or non-finite components (or ones that are no longs after scaling) take no part; scores of large
    components are exact, cut off at the ends of a long; vectors of unlike length never meet.  Repeated queries count once (of one id with several vectors the smallest is taken).

    Vectors are packed into shards of SHARD rows as they are scanned, queries into blocks of QUERIES.  First each
    block searches one shard; its k-th scores then go along to all other shards, where whole boxes stay unseen.
    """
    def points(df: DataFrame) -> DataFrame:
        df = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v")).where(F.col("vec_id").isNotNull() & usable(F.col("v")))
        df = df.where(F.forall("v", lambda x: F.abs(x.cast("double") * scale) < float(LONG)))
        return df.select("vec_id", scaled(F.col("v"), scale).alias("point"))

    shards = _numbered(points(vectors), SHARD).withColumnRenamed("number", "shard")
    asked = points(queries).groupBy("vec_id").agg(F.min("point").alias("point"))
    blocks = _numbered(asked, QUERIES).select(F.col("number").alias("block"), "size", F.col("ids").alias("q_ids"), F.col("points").alias("q_points"))
    count = shards.groupBy("size").agg(F.count("*").alias("shards"))
    blocks = cut(blocks.join(count, "size").withColumn("home", (F.col("block") % F.col("shards")).cast("int")))
    kind = "query_id long, vec_id long, score long"
    order = [F.desc("score"), F.asc("vec_id")]
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(*order))

    def met(pairs: DataFrame) -> DataFrame:
        # rows of one shard come together, so that its tree is built once a task
        return pairs.join(shards, ["size", "shard"]).sortWithinPartitions("size", "shard", "block").mapInArrow(_joined(k), kind)

    first = cut(met(blocks.select("block", "size", "q_ids", "q_points", F.col("home").alias("shard"))))
    kth = first.withColumn("rank", rank).where(F.col("rank") == k).select("query_id", "score", "vec_id")
    owner = asked.select(F.col("vec_id").alias("query_id"))
    owner = blocks.select("block", "size", "q_ids").mapInArrow(_owners, "query_id long, block int, size int")
    kth = cut(kth.join(owner, "query_id").groupBy("size", "block").agg(F.collect_list(F.struct("query_id", "score", "vec_id")).alias("kth")))  # at most QUERIES a block
    rest = blocks.join(kth, ["size", "block"], "left").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards").cast("int") - 1))).where("shard <> home")
    found = met(rest.select("block", "size", "q_ids", "q_points", "shard", "kth"))
    return first.unionByName(found).withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _owners(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        for row in batch.to_pylist():
            ids = np.frombuffer(row["q_ids"], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array([row["block"]] * len(ids), pa.int32()), pa.array([row["size"]] * len(ids), pa.int32())], ["query_id", "block", "size"])
