"""Near duplicates of vectors by a pivot-permutation index."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightflux.llm.graph import components
from nightflux.llm.kdtree import usable
from nightflux.session import cut

#: Nearest pivots that describe a vector, and how many of them two vectors must share.
PREFIX, SHARED = 12, 2
#: Pivots: PER_ROOT times the root of the number of vectors, within these bounds.
PER_ROOT, FEWEST, MOST = 4, 32, 16384
#: Rows of one part of an inverted list; larger lists are met part by part.
PART = 1024
#: Cosines tried for the balls about dense pivots, and list entries that a vector may have on average before the next is tried.
BALLS, ENTRIES = (0.8, 0.7, 0.6, 0.5), 24
#: A vector that is in no ball has this home.
NOWHERE = np.iinfo(np.int32).max


def dense(pivots: np.ndarray, within: float) -> np.ndarray:
    """Numbers of the centres of balls that hold more than one pivot: no centre is in the ball of another."""
    free, centres = np.ones(len(pivots), bool), []
    for k in range(len(pivots)):
        if free[k]:
            ball = (pivots @ pivots[k] >= within) & free
            free &= ~ball
            if ball.sum() > 1:
                centres.append(k)
    return np.array(centres, np.int64)


def homes(x: np.ndarray, centres: np.ndarray, within: float, least: float) -> tuple[np.ndarray, np.ndarray]:
    """The home of each vector, the nearest centre if its ball holds it, and which vectors each centre must list.

    If ``y`` and a member of the ball are no further apart than ``least`` says, the triangle inequality of angles
    bounds the way from ``y`` to the centre.  A pair with two homes is met at the smaller one.
    """
    if not len(centres):
        return np.full(len(x), NOWHERE, np.int64), np.zeros((len(x), 0), bool)
    near = x @ centres.T
    best = near.argmax(1)
    home = np.where(near[np.arange(len(x)), best] >= within, best, NOWHERE)
    reach = math.cos(min(math.pi, math.acos(within) + math.acos(max(-1.0, min(1.0, least))))) - 1e-9
    return home, (near >= reach) & (np.arange(len(centres)) <= home[:, None])


def balls(pivots: np.ndarray, least: float) -> tuple[np.ndarray, float]:
    """Centres and cosine of the balls: the first of BALLS with few list entries a vector, judged by the pivots."""
    tried = []
    for within in BALLS:
        centres = pivots[dense(pivots, within)]
        entries = homes(pivots, centres, within, least)[1].sum() / max(1, len(pivots))
        if entries <= ENTRIES:
            return centres, within
        tried.append((entries, -within, centres))
    _, within, centres = min(tried, key=lambda t: t[:2])
    return centres, -within


def _described(pivots: np.ndarray, centres: np.ndarray, within: float, least: float, names: list[str]):
    """Adds the home, the centres that list a vector and, without a home, the ordered numbers of the nearest pivots."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            if batch.num_rows:
                x = np.array(batch.column("unit").to_pylist(), np.float64)
                near = np.argsort(-(x @ pivots.T), axis=1, kind="stable")[:, :PREFIX].astype(np.int32)
                home, listed = homes(x, centres, within, least)
                out = home == NOWHERE
                lists = [pa.array(np.nonzero(listed)[1].astype(np.int32)), pa.array(near[out].ravel())]
                ends = [np.concatenate(([0], np.cumsum(n))).astype(np.int32) for n in (listed.sum(1), out * near.shape[1])]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in names), pa.array(home.astype(np.int32)), *(pa.ListArray.from_arrays(pa.array(e), v) for e, v in zip(ends, lists, strict=True))],
                    [*names, "home", "balls", "near"])

    return run


def _met(least: float, percent_rows: int = 256):
    """Links of one meeting of list parts: how many vectors each node is linked with, and a star for each component."""

    def run(table: pa.Table) -> pa.Table:
        pivot, i, j = (table.column(c)[0].as_py() for c in ("pivot", "i", "j"))
        node = table.column("node").to_numpy()
        order = np.argsort(node)
        node = node[order]
        copies, part = table.column("copies").to_numpy()[order], table.column("part").to_numpy()[order]
        x = np.array(table.column("unit").to_pylist(), np.float64)[order]
        near = np.array(table.column("near").to_pylist(), np.int32)[order]
        n = len(node)
        links, label = np.zeros(n, np.int64), np.arange(n)
        pairs = []
        for start in range(0, n, percent_rows):
            rows = slice(start, min(n, start + percent_rows))
            close = x[rows] @ x[start:].T >= least
            a, b = np.nonzero(close)
            a, b = a + start, b + start
            ok = (a < b) & ((part[a] != part[b]) if i != j else True)
            a, b = a[ok], b[ok]
            for k in range(0, len(a), 200_000):
                p, q = a[k : k + 200_000], b[k : k + 200_000]
                same = near[p][:, :, None] == near[q][:, None, :]
                enough = same.sum((1, 2)) >= SHARED
                # a pair is met in the list of each pivot that it shares; it counts in that of the smallest
                lowest = np.where(same.any(2), near[p], np.iinfo(np.int32).max).min(1) == pivot
                keep = enough & lowest
                pairs.append((p[keep], q[keep]))
        a, b = (np.concatenate([x[k] for x in pairs]) if pairs else np.zeros(0, np.int64) for k in (0, 1))
        np.add.at(links, a, copies[b])
        np.add.at(links, b, copies[a])
        while len(a):
            before = label.copy()
            np.minimum.at(label, a, label[b])
            np.minimum.at(label, b, label[a])
            label = label[label]
            if (before == label).all():
                break
        seen = np.flatnonzero(links)
        return pa.table({"node": node[seen], "links": links[seen], "hub": node[label[seen]]})

    return run


def _met_ball(least: float, some_rows: int = 256):
    """Links of a part of a ball's members with a part of its list: for each node how many vectors, and a star for each component.

    A member listed too counts at its own turn; a listed vector of another home or none counts here.
    """

    def run(table: pa.Table) -> pa.Table:
        centre = table.column("pivot")[0].as_py()
        node, copies, home, member = (table.column(c).to_numpy() for c in ("node", "copies", "home", "member"))
        x = np.array(table.column("unit").to_pylist(), np.float64)
        a, b = np.flatnonzero(member), np.flatnonzero(~member)
        links, label = np.zeros(len(node), np.int64), np.arange(len(node))
        other = b[home[b] != centre]
        blocks = []
        for start in range(0, len(a), some_rows):
            rows = a[start : start + some_rows]
            close = (x[rows] @ x[b].T >= least) & (node[rows][:, None] != node[b])
            links[rows] = close @ copies[b]
            links[other] += copies[rows] @ close[:, home[b] != centre]
            blocks.append((rows, np.packbits(close, axis=1)))
        # both copies of a member are one node of the graph
        order = np.argsort(node, kind="stable")
        first = order[np.searchsorted(node[order], node)]
        changed = len(a) > 0
        while changed:
            before = label.copy()
            for rows, bits in blocks:
                close = np.unpackbits(bits, axis=1, count=len(b)).astype(bool)
                low = np.minimum(label[rows], np.where(close, label[b], len(node)).min(1, initial=len(node)))
                label[rows] = low
                label[b] = np.minimum(label[b], np.where(close, low[:, None], len(node)).min(0, initial=len(node)))
            np.minimum.at(label, first, label)
            label = label[first]
            changed = (before != label).any()
        linked = np.zeros(len(node), bool)
        for rows, bits in blocks:
            close = np.unpackbits(bits, axis=1, count=len(b)).astype(bool)
            linked[rows] |= close.any(1)
            linked[b] |= close.any(0)
        seen = np.flatnonzero(linked)
        return pa.table({"node": node[seen], "links": links[seen], "hub": node[label[seen]]})

    return run


def near_vectors(vectors: DataFrame, least: float = 0.9) -> DataFrame:
    """Links between vectors of cosine ``least`` or more, and their components.

    ``vectors`` has ``vec_id`` and ``embedding``.  Returns a row for each: ``vec_id``, ``n_links`` (other vectors
    linked directly), ``component_id`` (smallest vec_id reachable, itself included), ``kept``.
    Vectors that are null, zero or hold null or non-finite components link with nothing.

    Equal vectors form one node, which links its copies.  The index: pivots are the vectors with the smallest hash, 4
    times the root of their number (32 to 16384, so at most a bounded table is sent to the tasks).  Pivots are drawn
    evenly, so a crowded group holds many: a pivot with others in a ball about it becomes a centre, and each member of its
    ball (the nearest one) meets every vector that can link with it by the triangle inequality of angles; those links are exact.
    A vector in no ball is described by its 12 nearest pivots in order and stands in the inverted list of each.  Two such vectors
    are candidates if they share 2 pivots or more.  All candidates are verified by cosine in double precision.
    A list longer than PART is dealt into parts, and each pair of parts is met, so no list is too long.  A pair counts once, in
    the list of the smallest shared pivot.  Vectors of unlike length never link.  A null vec_id never names a component.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    size = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    good = usable(F.col("v")) & F.coalesce((size > 0) & (size < float("inf")), F.lit(False))
    rows = rows.withColumn("node", F.when(good, F.xxhash64("v")))
    nodes = rows.where("node is not null").groupBy("node").agg(F.min("vec_id").alias("low"), F.count("*").alias("copies"), F.min_by("v", "v").alias("v"))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    nodes = cut(nodes.select("node", "low", "copies", F.size("v").alias("size"), F.transform("v", lambda x: x / length).alias("unit")))
    met = [_links(nodes.where(F.col("size") == r["size"]), r["n"], least) for r in nodes.groupBy("size").agg(F.count("*").alias("n")).collect()]
    if met:
        found = met[0]
        for more in met[1:]:
            found = found.union(more)
        found = cut(found)
        links = found.groupBy("node").agg(F.sum("links").alias("links"))
        label = components(found.select(F.col("node").alias("a"), F.col("hub").alias("b")))
        state = nodes.select("node", "low", "copies").join(links, "node", "left").join(label, "node", "left")
        state = cut(state.withColumn("component", F.coalesce("component", "node")))
        least_id = state.groupBy("component").agg(F.min("low").alias("component_id"))
        state = cut(state.join(least_id, "component").select("node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    else:
        state = nodes.select("node", F.col("low").alias("component_id"), F.col("copies").alias("n_links"))
    out = rows.select("vec_id", "node").join(state, "node", "left")
    whole = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), whole.alias("component_id"), F.col("vec_id").eqNullSafe(whole).alias("kept"))


def _links(nodes: DataFrame, n: int, least: float) -> DataFrame:
    """``node``, ``links`` and ``hub`` of each meeting, for vectors of one length."""
    pivots = min(MOST, max(FEWEST, math.ceil(PER_ROOT * math.sqrt(n))))
    chosen = nodes.orderBy(F.xxhash64("node"), "node").limit(pivots).select("unit").collect()
    table = np.array([r.unit for r in chosen])
    centres, within = balls(table, least)
    kind = "node long, copies long, unit array<double>"
    rows = nodes.select("node", "copies", "unit").mapInArrow(
        _described(table, centres, within, least, ["node", "copies", "unit"]), f"{kind}, home int, balls array<int>, near array<int>")
    rows = cut(rows)
    return _balls_met(rows, least).union(_lists_met(rows.where(F.col("home") == int(NOWHERE)), least)) if len(centres) else _lists_met(rows, least)


def _balls_met(rows: DataFrame, least: float) -> DataFrame:
    members = rows.where(F.col("home") != int(NOWHERE)).withColumn("pivot", F.col("home"))
    listed = rows.withColumn("pivot", F.explode("balls"))
    size = F.ceil(F.count("*") / PART).cast("int")
    parts = cut(listed.groupBy("pivot").agg(size.alias("n_j")).join(members.groupBy("pivot").agg(size.alias("n_i")), "pivot"))
    part = lambda n: F.pmod(F.xxhash64("node", F.lit(7)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    names = ["pivot", "i", "j", "member", "node", "copies", "home", "unit"]
    members = members.join(parts, "pivot").withColumn("i", part("n_i")).withColumn("j", every("n_j")).withColumn("member", F.lit(True))
    listed = listed.join(parts, "pivot").withColumn("j", part("n_j")).withColumn("i", every("n_i")).withColumn("member", F.lit(False))
    return members.select(names).union(listed.select(names)).groupBy("pivot", "i", "j").applyInArrow(_met_ball(least), "node long, links long, hub long")


def _lists_met(rows: DataFrame, least: float) -> DataFrame:
    listed = rows.select("node", F.explode("near").alias("pivot"))
    parts = cut(listed.groupBy("pivot").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts")))
    lists = rows.withColumn("pivot", F.explode("near")).join(parts, "pivot")
    part = F.pmod(F.xxhash64("node", F.lit(7)), F.col("parts")).cast("int")
    lists = lists.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    lists = lists.select("pivot", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "node", "copies", "unit", "near")
    return lists.groupBy("pivot", "i", "j").applyInArrow(_met(least), "node long, links long, hub long")
