"""Ordered operators that never sort a whole series in one task.

Two ways of splitting an order are used:

* time buckets: a series is cut at multiples of a width; windows run inside
  (keys, bucket) and what crosses a border is carried by a summary of one row per
  bucket;
* range splits: rows are range-partitioned by any order, so equal-sized pieces of a
  hot group land in different tasks; positions inside a piece plus the sizes of the
  pieces before it give exact row numbers.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import as_col, cut

BUCKET = "__bucket"
BUCKET_ROWS = 1_000_000
SMOOTH_ROWS = 20_000


def with_bucket(df: DataFrame, t: str, width: float) -> DataFrame:
    return df.withColumn(BUCKET, F.floor(F.col(t) / F.lit(float(width))))


def fitted_width(df: DataFrame, keys: Sequence[str], t: str, width: float, floor: float = 0.0) -> float:
    """A bucket width at which no (series, bucket) holds more than a task's worth of rows.

    Starts from ``width`` and narrows it while the fullest bucket is too full: one
    counting aggregation and one number to the driver each time.  It ends when no bucket is
    too full, or when narrowing no longer thins the fullest one (equal times cannot be told
    apart) or the ``floor`` is reached.
    """
    last, stuck = None, 0
    while True:
        counts = df.groupBy(*keys, F.floor(F.col(t) / F.lit(float(width))).alias(BUCKET)).count()
        top = counts.agg(F.max("count")).first()[0] or 0
        narrower = max(width / (2.0 * math.ceil(top / BUCKET_ROWS)), floor)
        if top <= BUCKET_ROWS or narrower >= width or (last is not None and stuck >= 3):
            return width
        stuck = stuck + 1 if last == top else 0
        last, width = top, narrower


def carried(buckets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per bucket, the last sample of earlier buckets and the first of later ones.

    ``buckets`` has one row per (keys, bucket) with structs ``__first`` and ``__last``.
    """
    series = Window.partitionBy(*keys)
    before = series.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    # backwards: a frame that ends at the last row is read anew for every row
    after = series.orderBy(F.desc(BUCKET)).rowsBetween(Window.unboundedPreceding, -1)
    return buckets.select(
        *keys, BUCKET,
        F.last("__last", ignorenulls=True).over(before).alias("__prev_far"),
        F.last("__first", ignorenulls=True).over(after).alias("__next_far"),
    )


def neighbours(
    samples: DataFrame,
    queries: DataFrame,
    keys: Sequence[str],
    t: str,
    payload: Sequence[str],
    width: float,
) -> DataFrame:
    """Put the sample at or before and the sample after beside every query row.

    Adds structs ``prev`` and ``next`` of (t, *payload), NULL where there is none.
    Sample times are distinct within a series (see ``first_per_time``).
    """
    keys = list(keys)
    s = samples.select(
        *keys, F.col(t).alias("__t"), F.lit(0).alias("__tag"),
        F.struct(F.col(t).alias("t"), *payload).alias("__s"),
    )
    q = queries.select(*keys, F.col(t).alias("__t"), F.lit(1).alias("__tag"), F.struct(*queries.columns).alias("__q"))
    u = s.unionByName(q, allowMissingColumns=True)
    u = with_bucket(u, "__t", fitted_width(u.select(*keys, "__t"), keys, "__t", width))
    is_sample = F.col("__tag") == 0
    borders = u.groupBy(*keys, BUCKET).agg(
        F.min_by("__s", F.when(is_sample, F.col("__t"))).alias("__first"),
        F.max_by("__s", F.when(is_sample, F.col("__t"))).alias("__last"),
    )
    far = carried(borders, keys)
    bucket = Window.partitionBy(*keys, BUCKET)
    forth, back = bucket.orderBy("__t", "__tag"), bucket.orderBy(F.desc("__t"), F.desc("__tag"))
    # both frames only grow from row to row, so a bucket is read once in each direction
    near = u.select(
        *keys, BUCKET, "__tag", "__q",
        F.last("__s", ignorenulls=True).over(forth.rowsBetween(Window.unboundedPreceding, 0)).alias("__p"),
        F.last("__s", ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, 0)).alias("__n"),
    ).where(F.col("__tag") == 1)
    joined = near.join(far, [*keys, BUCKET], "left")
    return joined.select(
        "__q.*",
        F.coalesce("__p", "__prev_far").alias("prev"),
        F.coalesce("__n", "__next_far").alias("next"),
    )


def linked(samples: DataFrame, keys: Sequence[str], t: str, payload: Sequence[str], width: float) -> DataFrame:
    """Each sample with the samples strictly before and after it as ``before``/``after``."""
    keys = list(keys)
    width = fitted_width(samples.select(*keys, t), keys, t, width)
    b = with_bucket(samples.withColumn("__s", F.struct(F.col(t).alias("t"), *payload)), t, width)
    borders = b.groupBy(*keys, BUCKET).agg(
        F.min_by("__s", t).alias("__first"), F.max_by("__s", t).alias("__last")
    )
    far = carried(borders, keys)
    w = Window.partitionBy(*keys, BUCKET).orderBy(t)
    near = b.withColumn("__p", F.lag("__s").over(w)).withColumn("__n", F.lead("__s").over(w))
    joined = near.join(far, [*keys, BUCKET], "left")
    return joined.select(
        *samples.columns,
        F.coalesce("__p", "__prev_far").alias("before"),
        F.coalesce("__n", "__next_far").alias("after"),
    )


def first_per_time(df: DataFrame, keys: Sequence[str], t: str, order: Sequence[str | Column]) -> DataFrame:
    """Drop repeated times, keeping the first by ``order``."""
    w = Window.partitionBy(*keys, t).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def rolling_std(
    df: DataFrame, keys: Sequence[str], t: str, y: str, out: str, half_width: float, width: float | None = None
) -> DataFrame:
    """Population deviation of all samples within +-half_width of each sample.

    Rows near a bucket border are also sent to the neighbour bucket as helpers, so
    every frame is complete inside one bucket.
    """
    keys = list(keys)
    width = float(width or max(50 * half_width, 1.0))
    if width < half_width:
        raise ValueError("a bucket must be at least half a window wide")
    width = fitted_width(df.select(*keys, t), keys, t, width, floor=half_width * 1.01)
    own = F.floor(F.col(t) / width)
    spread = df.withColumn(
        "__b",
        F.explode(
            F.array_compact(
                F.array(
                    own,
                    F.when(F.floor((F.col(t) - half_width * 1.001) / width) < own, own - 1),
                    F.when(F.floor((F.col(t) + half_width * 1.001) / width) > own, own + 1),
                )
            )
        ),
    ).withColumn("__own", F.col("__b") == own)
    by = ", ".join(f"`{k}`" for k in [*keys, "__b"])
    frame = (
        f"stddev_pop(`{y}`) OVER (PARTITION BY {by} ORDER BY `{t}` "
        f"RANGE BETWEEN {half_width!r}D PRECEDING AND {half_width!r}D FOLLOWING)"
    )
    return spread.withColumn(out, F.expr(frame)).where("__own").drop("__b", "__own")


def range_split(df: DataFrame, order: Sequence[str | Column], pieces: int | None = None) -> DataFrame:
    """Range-partition by ``order`` and number the pieces (``__piece``) and the rows
    inside them (``__at``, from 0).  Written to a checkpoint so that both stay put."""
    ranged = df.repartitionByRange(pieces, *order) if pieces else df.repartitionByRange(*order)
    ranged = ranged.sortWithinPartitions(*order)
    # the high bits of the generated id are the partition, the low 33 bits the row in it
    numbered = ranged.withColumn("__id", F.monotonically_increasing_id())
    return cut(
        numbered.withColumn("__piece", F.shiftright("__id", 33))
        .withColumn("__at", F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("__id")
    )


def numbered(df: DataFrame, order: Sequence[str | Column], out: str = "pos", pieces: int | None = None) -> DataFrame:
    """Exact global row position from 0 in ``order`` (W13, S04), without one big sort task."""
    split = range_split(df, order, pieces)
    sizes = split.groupBy("__piece").agg(F.count("*").alias("__n"))
    # one row per piece: a few thousand at most
    w = Window.orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__piece", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__start"))
    return (
        split.join(F.broadcast(starts), "__piece")
        .withColumn(out, F.col("__start") + F.col("__at"))
        .drop("__piece", "__at", "__start")
    )


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    sums: dict[str, Column | str],
    number: str | None = None,
    pieces: int | None = None,
) -> DataFrame:
    """Running sums (current row included) and row numbers from 1 per group.

    Pieces of the order carry their totals forward, so a group may be far larger
    than a task.
    """
    keys = list(keys)
    temp = {f"__x{i}": (k, as_col(v)) for i, (k, v) in enumerate(sums.items())}
    base = df.select("*", *[v.alias(x) for x, (_, v) in temp.items()])
    split = range_split(base, [*keys, *order], pieces)
    aggs = [F.count("*").alias("__cnt"), F.min("__at").alias("__at0")]
    aggs += [F.sum(x).alias(f"{x}_t") for x in temp]
    totals = split.groupBy(*keys, "__piece").agg(*aggs)
    w = Window.partitionBy(*keys).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *keys, "__piece", "__at0",
        F.coalesce(F.sum("__cnt").over(w), F.lit(0)).alias("__before"),
        *[F.coalesce(F.sum(f"{x}_t").over(w), F.lit(0)).alias(f"{x}_b") for x in temp],
    )
    inner = Window.partitionBy(*keys, "__piece").orderBy("__at").rowsBetween(Window.unboundedPreceding, 0)
    local = split.withColumns({f"{x}_r": F.sum(x).over(inner) for x in temp}) if temp else split
    joined = local.join(starts, [*keys, "__piece"])
    cols = [F.col(c) for c in df.columns]
    cols += [(F.col(f"{x}_r") + F.col(f"{x}_b")).alias(k) for x, (k, _) in temp.items()]
    if number:
        cols.append((F.col("__at") - F.col("__at0") + F.col("__before") + 1).alias(number))
    return joined.select(*cols)


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int, rank: str = "rank") -> DataFrame:
    """First ``n`` rows per group in ``order``; every task keeps at most ``n`` per group
    before the shuffle (window group limit)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def gaussian_smooth(
    df: DataFrame, keys: Sequence[str], order: str, y: str, out: str, sigma: float = 5.0, truncate: float = 4.0
) -> DataFrame:
    """Gaussian smoothing over sample positions, edges reflected.

    Positions are cut into buckets; rows near a border, and the mirror images beyond
    both ends of a series, are added as helpers, so each bucket is one plain window.
    """
    keys = list(keys)
    radius = int(truncate * sigma + 0.5)
    raw = [math.exp(-0.5 * (k / sigma) ** 2) for k in range(-radius, radius + 1)]
    rows = running(df, keys, [order], {}, number="__i")
    sizes = df.groupBy(*keys).agg(F.count("*").alias("__n"))
    rows = attach_sizes(rows.withColumn("__i", F.col("__i") - 1), keys, sizes)
    # where a sample shows up: its own place and its images at ... -1-i, 2n-1-i, i+2n ...
    turns = F.ceil(F.lit(radius) / (2 * F.col("__n"))).cast("int")
    images = F.flatten(F.transform(
        F.sequence(-turns, turns),
        lambda m: F.array(F.col("__i") + 2 * F.col("__n") * m, 2 * F.col("__n") * (m + 1) - 1 - F.col("__i"), 2 * F.col("__n") * m - 1 - F.col("__i")),
    ))
    reached = F.filter(F.array_distinct(images), lambda p: (p >= -radius) & (p < F.col("__n") + radius))
    placed = rows.withColumn("__p", F.explode(reached))
    own = F.floor(F.col("__p") / SMOOTH_ROWS)
    spread = placed.withColumn("__b", F.explode(F.array_distinct(F.array(
        own, F.floor((F.col("__p") - radius) / SMOOTH_ROWS), F.floor((F.col("__p") + radius) / SMOOTH_ROWS)
    )))).withColumn("__own", (F.col("__p") == F.col("__i")) & (F.col("__b") == own))
    w = Window.partitionBy(*keys, "__b").orderBy("__p")
    total = F.lit(0.0)
    for k in range(-radius, radius + 1):
        total = total + raw[k + radius] / sum(raw) * F.lag(y, k).over(w)
    return spread.withColumn(out, total).where("__own").select(*df.columns, out)


def attach_sizes(rows: DataFrame, keys: Sequence[str], sizes: DataFrame) -> DataFrame:
    return rows.join(sizes, list(keys)) if keys else rows.crossJoin(F.broadcast(sizes))


def segments(df: DataFrame, keys: Sequence[str], t: str, gap: float, out: str, width: float | None = None) -> DataFrame:
    """Night segments: a new one starts at the first time more than ``gap`` after the
    start of the current one (W03).

    The next start after each time is one as-of lookup; the starts reached from the
    first time of a series are found by doubling the jump, so the number of joins
    grows with the logarithm of the number of segments.
    """
    keys = list(keys)
    width = float(width or 2 * gap)
    times = cut(df.select(*keys, F.col(t).alias("__t")).distinct())
    probes = times.select(*keys, F.col("__t").alias("__from"), (F.col("__t") + gap).alias("__t"))
    # first sample strictly after t + gap
    jump = neighbours(times.withColumn("__one", F.lit(1)), probes, keys, "__t", ["__one"], width)
    jump = jump.select(*keys, F.col("__from").alias("__t"), F.col("next.t").alias("__to")).where("__to IS NOT NULL")
    jump = cut(jump)
    starts = times.groupBy(*keys).agg(F.min("__t").alias("__t"))
    while True:
        reached = starts.join(jump, [*keys, "__t"]).select(*keys, F.col("__to").alias("__t"))
        grown = cut(starts.unionByName(reached).distinct())
        hop = jump.select(*keys, F.col("__t").alias("__to"), F.col("__to").alias("__to2"))
        jump = cut(jump.join(hop, [*keys, "__to"]).select(*keys, "__t", F.col("__to2").alias("__to")))
        starts = grown
        if jump.isEmpty():
            break
    order = running(starts, keys, ["__t"], {}, number="__seg").withColumn("__seg", F.col("__seg") - 1)
    named = neighbours(
        order.select(*keys, F.col("__t").alias(t), "__seg"), df, keys, t, ["__seg"], max(width, 1.0)
    )
    return named.select(*df.columns, F.col("prev.__seg").alias(out))
