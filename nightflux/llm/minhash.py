"""Near duplicates by one-permutation hashing with star-shaped candidate edges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightflux.llm.common import Remember, batches, lists, mix64, small_batches
from nightflux.llm.graph import components
from nightflux.session import cut

BINS, ROWS = 128, 5
BANDS = BINS // ROWS
#: Twice as many donor bins as there are bins, for each bin in an order of its own.
DONORS = (mix64(np.arange(BINS * 2 * BINS, dtype=np.uint64) + np.uint64(1)) % np.uint64(BINS)).astype(np.int64).reshape(BINS, 2 * BINS)
EDGES = np.arange(1, BINS, dtype=np.uint64) << np.uint64(57)
BASE = np.uint64(0x9E3779B97F4A7C15)


class Shingler:
    """Sorted distinct 64-bit hashes of a text's word shingles."""

    def __init__(self, width: int):
        self.width = width
        self.hash = Remember(xxhash.xxh3_64_intdigest, 100_000)  # soon found again

    def __call__(self, text: str | None) -> np.ndarray:
        words = text.encode().lower().split() if text else []  # bytes: only A-Z, only ASCII white space
        if not words:
            return np.zeros(0, np.uint64)
        h = np.fromiter(map(self.hash.__getitem__, words), np.uint64, len(words))
        n = max(1, len(h) - self.width + 1)
        out = np.zeros(n, np.uint64)
        with np.errstate(over="ignore"):
            for k in range(min(self.width, len(h))):
                out = out * BASE + h[k : k + n]
        if len(h) < self.width:
            out += np.uint64(len(h))
        return np.unique(mix64(out))


def signature(hashes: np.ndarray) -> np.ndarray:
    """One minimum a bin of a single permutation; an empty bin takes that of the first filled bin of its own donor order."""
    first = np.concatenate(([0], np.searchsorted(hashes, EDGES)))
    filled = np.diff(np.append(first, len(hashes))) > 0
    value = np.zeros(BINS, np.uint64)
    value[filled] = hashes[first[filled]]
    for b in np.flatnonzero(~filled):
        donors = DONORS[b]
        ok = filled[donors]
        value[b] = value[donors[ok.argmax()] if ok.any() else int(np.flatnonzero(filled)[0])]
    return value


def band_keys(value: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of the signature."""
    out = np.arange(BANDS, dtype=np.uint64) * BASE
    with np.errstate(over="ignore"):
        for column in value[: BANDS * ROWS].reshape(BANDS, ROWS).T:
            out = mix64(out + column)
    return out


def _marks(width: int):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(width)
        for batch in batches(stream):
            sets = [shingle(x) for x in batch.column("text").to_pylist()]
            signs = [signature(x) if len(x) else np.zeros(0, np.uint64) for x in sets]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"),
                pa.array([len(x) for x in sets], pa.int64()),
                pa.array(np.array([xxhash.xxh3_64_intdigest(x.tobytes()) for x in sets], np.uint64).view(np.int64)),
                lists([band_keys(x).view(np.int64) if len(x) else x.view(np.int64) for x in signs], pa.int64()),
                lists([(x & np.uint64(0xFFFF)).astype(np.int16) for x in signs], pa.int16()),
            ], ["doc_id", "n_shingles", "node", "keys", "signs"])

    return run


#: Bits of the filter of documents whose sets are wanted: 16 MB, whatever the input's size.
BITS, PROBES = 27, 3


def _places(number: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(number, F.lit(k)), F.lit(1 << BITS)) for k in range(PROBES)]


def bits_of(numbers: DataFrame) -> np.ndarray:
    """A Bloom filter of the first column: words of 64 bits, at most 2^BITS bits in all.  Beyond a few hundred million numbers it lets most pass."""
    at = numbers.select(F.explode(F.array(*_places(F.col(numbers.columns[0])))).alias("at"))
    bit = F.expr("shiftleft(1L, cast(at & 63 as int))")
    found = at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    words = np.zeros(1 << (BITS - 6), np.int64)
    words[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return words


def _sets(width: int, bits: np.ndarray):
    """Sets of the documents that the filter lets pass, by the places that Spark has found for their ids."""
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(width)
        for whole in batches(stream):
            places = [whole.column(k + 1).to_numpy() for k in range(PROBES)]
            passed = np.logical_and.reduce([(bits[p >> 6] >> (p & 63)) & 1 for p in places]).astype(bool)
            batch = whole.filter(pa.array(passed))
            sets = [shingle(x) for x in batch.column("text").to_pylist()]
            nodes = np.array([xxhash.xxh3_64_intdigest(x.tobytes()) for x in sets], np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(nodes.view(np.int64)), lists([x.view(np.int64) for x in sets], pa.int64())], ["node", "hashes"])

    return run


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, slack: float = 0.15) -> DataFrame:
    """Components of documents whose shingle sets have a Jaccard similarity of ``percent`` / 100 or more.

    ``docs`` needs ``doc_id`` and ``text``.  Returns one row per row of ``docs``: ``doc_id``,
    ``n_shingles`` (size of the set), ``component_id`` (smallest doc_id reachable by links) and
    ``kept`` (doc_id = component_id).  Texts that are null or have no word have an empty set and link with nothing.

    Equal sets form one node.  Each set gets a one-permutation signature with optimal
    densification and a key per band.  Within a bucket the candidate edges form stars: the first turn joins every
    node to one centre, the same in all buckets of a group, the second to a centre of the bucket's own, so edges are bound by
    rows.  What is left of buckets that still hold more than one component is dealt into parts of bounded size; two parts
    meet inside one task, which hands on the links of a star for each component that it joins, never its pairs.  So no pair of
    different components that shares a bucket stays unseen.  Pairs whose signatures agree in
    less than ``percent`` / 100 - ``slack`` of the bins (over four deviations below) are not looked at; the others are
    confirmed on the full sets.

    Empty input gives an empty result.  A null doc_id takes part but never names a component; a component
    without any id has a null ``component_id`` and its rows count as kept.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marks = cut(docs.mapInArrow(_marks(width), "doc_id long, n_shingles long, node long, keys array<long>, signs array<short>"))
    classes = cut(marks.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("low")))
    exploded = marks.select("node", F.explode("keys").alias("key"))
    shared = cut(exploded.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b").select("key"))
    members = cut(exploded.join(shared, "key", "left_semi").distinct().select("key", "node", F.col("node").alias("component")))
    label = _linked(docs, marks, classes, members, width, percent, slack)
    named = cut(classes.join(label, "node", "left").withColumn("component", F.coalesce("component", "node")))
    least = cut(named.groupBy("component").agg(F.min("low").alias("component_id")))
    named = cut(named.join(least, "component").select("node", "component_id"))
    out = marks.select("doc_id", "n_shingles", "node").join(named, "node", "left")
    whole = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", whole.alias("component_id"), F.col("doc_id").eqNullSafe(whole).alias("kept"))


def _linked(docs: DataFrame, marks: DataFrame, classes: DataFrame, members: DataFrame, width: int, percent: int, slack: float) -> DataFrame:
    """Component of every member: star turns until no bucket has an unseen pair of two components."""
    nodes = cut(members.select("node").distinct())
    wanted = cut(classes.join(nodes, "node"))
    one = marks.alias("m").join(wanted.alias("w"), (F.col("m.node") == F.col("w.node")) & F.col("m.doc_id").eqNullSafe(F.col("w.low")))
    signs = cut(one.select("m.node", "n_shingles", "signs").dropDuplicates(["node"]))
    # texts stay where they are: only the sets of documents that a small filter lets pass are dealt out, and matched exactly
    marked = docs.select("text", *[p.alias(f"p{k}") for k, p in enumerate(_places(F.col("doc_id")))])
    sets = marked.mapInArrow(_sets(width, bits_of(wanted.select("low"))), "node long, hashes array<long>").join(nodes, "node", "left_semi")
    sets = cut(sets.dropDuplicates(["node"]))
    label = nodes.withColumn("component", F.col("node"))
    for order in (F.xxhash64("node"), F.xxhash64("key", "node")):
        members = _unsettled(members, F.min(F.struct(order.alias("o"), "node"))["node"].alias("hub"))
        centre = members.where("node = hub").select("key", F.col("component").alias("own"))
        pairs = members.join(centre, "key").where("component <> own")
        pairs = cut(pairs.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct())
        label = _joined(label, _confirmed(pairs, signs, sets, percent, slack))
        members = cut(members.select("key", "node").join(label, "node").select("key", "node", "component"))
    return _joined(label, _met(members, signs, sets, percent, slack))


def _unsettled(members: DataFrame, *aggs) -> DataFrame:
    """Members of the buckets with more than one component; of buckets with the same members one stays."""
    both = [F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"f{k}") for k in (0, 1)]
    state = members.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("size"), *both, *aggs).where("x < y")
    own = [c for c in state.columns if c not in ("key", "x", "y", "size", "f0", "f1")]
    state = cut(state.groupBy("size", "f0", "f1").agg(F.min(F.struct("key", *own)).alias("s")).select("s.key", "size", *[f"s.{c}" for c in own]))
    return cut(members.join(state, "key"))


def _joined(label: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after the components that links connect have become one."""
    left, right = (label.select(F.col("node").alias(c), F.col("component").alias(f"c{c}")) for c in "ab")
    joined = components(cut(links).join(left, "a").join(right, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    joined = cut(joined.select(F.col("node").alias("component"), F.col("component").alias("root")))
    return cut(label.join(joined, "component", "left").select("node", F.coalesce("root", "component").alias("component")))


#: Members and shingles of a part; two parts meet in a task.
PART, PART_SHINGLES = 512, 1 << 22


def _met(members: DataFrame, signs: DataFrame, sets: DataFrame, percent: int, slack: float) -> DataFrame:
    """Links (``a``, ``b``) that join the components of every bucket as far as any of its pairs does.

    A bucket's largest component and its other members are dealt into parts apart: members of the largest meet the others
    only, so a bucket of one huge component and a few strangers costs rows in proportion.  A cell is two parts, or a small bucket as a whole.
    """
    members = _unsettled(members).select("key", "size", "node", "component")
    sized = members.join(signs.select("node", "n_shingles"), "node")
    by = sized.groupBy("key", "component").agg(F.count("*").alias("c"), F.max("n_shingles").alias("long"))
    state = by.groupBy("key").agg(F.max(F.struct("c", "component")).alias("top"), F.max("long").alias("long"))
    rows = F.greatest(F.lit(1), F.least(F.lit(PART), F.floor(PART_SHINGLES / F.col("long"))))
    state = cut(state.select("key", F.col("top.c").alias("most"), F.col("top.component").alias("major"), rows.alias("rows")))
    dealt = members.join(state, "key").withColumn("lead", F.col("component") == F.col("major"))
    dealt = dealt.withColumns({"leads": F.ceil(F.col("most") / F.col("rows")), "others": F.ceil((F.col("size") - F.col("most")) / F.col("rows")), "small": F.col("size") <= F.col("rows")})
    place = F.xxhash64("key", "node")
    dealt = dealt.withColumn("part", F.when(F.col("lead"), F.pmod(place, F.col("leads"))).otherwise(F.pmod(place, F.col("others"))))
    cells = F.expr("""CASE WHEN small THEN array(struct(0L AS x, 0L AS y))
        WHEN lead THEN transform(sequence(0L, others - 1), j -> struct(-1 - part AS x, j AS y))
        ELSE concat(transform(sequence(0L, others - 1), j -> struct(least(part, j) AS x, greatest(part, j) AS y)),
                    transform(sequence(0L, leads - 1), p -> struct(-1 - p AS x, part AS y))) END""")
    dealt = dealt.select("key", "node", "component", F.when(F.col("small"), 0).when(F.col("lead"), -1 - F.col("part")).otherwise(F.col("part")).alias("part"), F.explode(cells).alias("cell"))
    dealt = dealt.select("key", "cell.x", "cell.y", "part", "node", "component")
    whole = dealt.join(signs.select("node", "signs"), "node").join(sets, "node")
    least = int(BINS * (percent / 100 - slack))

    def meet(group: pa.Table) -> pa.Table:
        return _cell(group.combine_chunks(), least, percent)

    return whole.groupBy("key", "x", "y").applyInArrow(meet, "a long, b long")


def _cell(group: pa.Table, least: int, percent: int) -> pa.Table:
    """A link for each two components of a cell that a pair of its members joins."""
    node, root, part = (group.column(c).to_numpy().copy() for c in ("node", "component", "part"))
    x, y = group.column("x")[0].as_py(), group.column("y")[0].as_py()
    hashes = group.column("hashes").combine_chunks()
    sizes = hashes.value_lengths().to_numpy().astype(np.int64)
    signs = group.column("signs").combine_chunks().flatten().to_numpy().reshape(len(node), BINS)
    distinct, place = np.unique(hashes.flatten().to_numpy(), return_inverse=True)
    ends = np.cumsum(sizes)
    mark = np.zeros(len(distinct), bool)
    numbers = np.arange(len(node))
    found = []
    for i in numbers[part == x] if x != y else numbers:
        able = (part == y) if x != y else numbers > i
        able &= (root != root[i]) & (100 * np.minimum(sizes, sizes[i]) >= percent * np.maximum(sizes, sizes[i]))
        able = np.flatnonzero(able)
        able = able[(signs[able] == signs[i]).sum(1) >= least]
        if not len(able):
            continue
        own = place[ends[i] - sizes[i] : ends[i]]
        mark[own] = True
        starts = np.cumsum(sizes[able]) - sizes[able]
        at = np.repeat(ends[able] - sizes[able] - starts, sizes[able]) + np.arange(sizes[able].sum())
        both = np.add.reduceat(mark[place[at]].astype(np.int64), starts)
        mark[own] = False
        for j in able[100 * both >= percent * (sizes[able] + sizes[i] - both)]:
            if root[j] != root[i]:
                found.append((node[i], node[j]))
                root[root == root[j]] = root[i]
    return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})


def _confirmed(pairs: DataFrame, signs: DataFrame, sets: DataFrame, percent: int, slack: float) -> DataFrame:
    """The pairs whose full sets are similar enough; the signatures leave out the hopeless ones first."""
    for c in "ab":
        pairs = pairs.join(signs.select(F.col("node").alias(c), F.col("signs").alias(f"s{c}"), F.col("n_shingles").alias(f"n{c}")), c)
    agree = F.size(F.filter(F.arrays_zip("sa", "sb"), lambda x: x["sa"] == x["sb"]))
    fits = (agree >= int(BINS * (percent / 100 - slack))) & (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
    pairs = pairs.where(fits).select("a", "b")
    for c in "ab":
        pairs = pairs.join(sets.select(F.col("node").alias(c), F.col("hashes").alias(f"h{c}")), c)
    both = F.size(F.array_intersect("ha", "hb"))
    return pairs.where(both * 100 >= (F.size("ha") + F.size("hb") - both) * percent).select("a", "b")
