"""Group statistics that stand a group holding a large share of all rows.

Means, sums and deviations use partial aggregation.  An exact median would bring
every distinct value of a group into one task; here a mergeable sketch first
brackets the middle ranks of each group, then one more aggregation counts what
lies below the bracket and keeps only the few values inside it.  Rows are never
moved by key: only sketches, counts and in-bracket values are shuffled, and the
brackets are joined back to the rows (a broadcast if they are small, else a
sort-merge join whose hot partitions adaptive execution splits).

Both passes must see the same values, but a sum of doubles taken a second time may
meet its rows in another order and differ in its last digit.  So rows are stored
before the first pass; ``stored=True`` says that they come from stored tables by
row-wise expressions and joins alone, and are read from there twice.

Very many groups of few rows would pay for a sketch each.  A caller that has measured its groups
(``fits``) says ``whole=True``: the rows are moved once and each group is read in one piece, in one pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import as_col, cut

SKETCH_ACCURACY = 100_000
BRACKET = 2.5 / SKETCH_ACCURACY
#: Rows of the fullest group up to which groups are read whole.
GROUP_ROWS = 100_000


def fits(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether every group is small enough to be read whole: one counting aggregation and one number to the driver."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return (counts.agg(F.max("n")).first()[0] or 0) <= GROUP_ROWS


def known(keys: Sequence[str]) -> Column:
    """True where no key is NULL; as in a join, other rows belong to no group."""
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).isNotNull()
    return out


def attach(df: DataFrame, keys: Sequence[str], stats: DataFrame, few: bool = False) -> DataFrame:
    """Put one-row-per-group statistics beside the rows of each group.

    ``few`` groups (runs, nodes of a grid) are broadcast: a join that is followed by an aggregation
    by the same keys would otherwise read all rows of a group in one task.
    """
    if not keys:
        return df.crossJoin(F.broadcast(stats))  # one row
    if few:
        return df.join(F.broadcast(stats), list(keys), "left")
    return df.join(stats, list(keys), "left")


def aggregate(df: DataFrame, keys: Sequence[str], *aggs: Column) -> DataFrame:
    return df.groupBy(*keys).agg(*aggs)


def medians(
    df: DataFrame,
    keys: Sequence[str],
    values: dict[str, Column | str],
    *extra: Column,
    bounded: bool = False,
    stored: bool = False,
    whole: bool = False,
) -> DataFrame:
    """Exact medians (mean of the two middle values) per group, NULLs skipped.

    ``values`` maps output names to expressions; ``extra`` aggregates ride along in
    the first pass.  ``bounded=True`` is for groups whose size has a fixed limit
    (a 50-frame chunk, a 3x3 cell): those use the built-in exact median directly; ``whole=True`` is for groups
    that ``fits`` has measured.  All ways are exact, and a bracket that missed a middle rank on either side raises.
    """
    keys = list(keys)
    if whole:
        # over a window the values of one group at a time are held; an aggregation would hold those of many
        own = Window.partitionBy(*keys)
        rows = df.where(known(keys)) if keys else df
        rows = rows.select("*", *[F.median(as_col(v).cast("double")).over(own).alias(f"__q_m_{k}") for k, v in values.items()])
        return rows.groupBy(*keys).agg(*[F.first(f"__q_m_{k}").alias(k) for k in values], *extra)
    if bounded:
        return df.groupBy(*keys).agg(*[F.median(as_col(v)).alias(k) for k, v in values.items()], *extra)
    rows = df.select("*", *[as_col(v).cast("double").alias(f"__q_v_{k}") for k, v in values.items()])
    if not stored:
        rows = cut(rows if extra else rows.select(*keys, *[f"__q_v_{k}" for k in values]))
    first = []
    for k in values:
        first.append(F.count(f"__q_v_{k}").alias(f"__q_n_{k}"))
        first.append(
            F.percentile_approx(f"__q_v_{k}", [0.5 - BRACKET, 0.5 + BRACKET], SKETCH_ACCURACY).alias(f"__q_b_{k}")
        )
    brackets = rows.groupBy(*keys).agg(*first, *extra)
    extra_names = [c for c in brackets.columns if c not in keys and not c.startswith("__q_")]
    narrow = rows.select(*keys, *[f"__q_v_{k}" for k in values])
    both = narrow.join(brackets, keys) if keys else narrow.crossJoin(F.broadcast(brackets))
    second = []
    for k in values:
        v, lo, hi = F.col(f"__q_v_{k}"), F.col(f"__q_b_{k}")[0], F.col(f"__q_b_{k}")[1]
        second += [
            F.count_if(v < lo).alias(f"__q_below_{k}"),
            F.count_if(v == lo).alias(f"__q_at_{k}"),
            F.count_if((v == hi) & (hi > lo)).alias(f"__q_top_{k}"),
            F.sort_array(F.collect_list(F.when((v > lo) & (v < hi), v))).alias(f"__q_in_{k}"),
            F.first(f"__q_n_{k}").alias(f"__q_n_{k}"),
            F.first(f"__q_b_{k}").alias(f"__q_b_{k}"),
        ]
    picked = both.groupBy(*keys).agg(*second, *[F.first(c).alias(c) for c in extra_names])

    def kth(k: str, rank: Column) -> Column:
        below, at, inside = F.col(f"__q_below_{k}"), F.col(f"__q_at_{k}"), F.col(f"__q_in_{k}")
        at_rank = rank - below
        return (
            F.when(at_rank < 0, F.raise_error(F.lit("median bracket missed its rank")).cast("double"))
            .when(at_rank < at, F.col(f"__q_b_{k}")[0])
            .when(at_rank - at < F.size(inside), F.get(inside, (at_rank - at).cast("int")))
            .when(at_rank - at - F.size(inside) < F.col(f"__q_top_{k}"), F.col(f"__q_b_{k}")[1])
            .otherwise(F.raise_error(F.lit("median bracket missed its rank")).cast("double"))
        )

    out = []
    for k in values:
        n = F.col(f"__q_n_{k}")
        lower, upper = kth(k, F.floor((n - 1) / 2)), kth(k, F.floor(n / 2))
        out.append(F.when(n > 0, (lower + upper) / 2).alias(k))
    return picked.select(*keys, *out, *extra_names)


def normalise(
    df: DataFrame, keys: Sequence[str], value: str, out: str, floor: float | None = 0.001, stored: bool = False, whole: bool = False
) -> DataFrame:
    """Divide a series by its median; values at or below ``floor`` stay out of the
    median only (A13).  ``floor=None`` is the plain variant."""
    source = F.col(value) if floor is None else F.when(F.col(value) > floor, F.col(value))
    if whole:
        med = F.when(known(keys), F.median(source.cast("double")).over(Window.partitionBy(*keys)))
        rows = df.select(*keys, *[c for c in df.columns if c not in keys], med.alias("__median"))
        return rows.withColumn(out, F.when(F.col("__median") != 0, F.col(value) / F.col("__median"))).drop("__median")
    df = df if stored else cut(df)
    med = medians(df, keys, {"__median": source}, stored=True)
    divided = F.when(F.col("__median") != 0, F.col(value) / F.col("__median"))
    return attach(df, keys, med).withColumn(out, divided).drop("__median")


def clip_bounds(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    sigma: float = 3.0,
    max_rounds: int | None = 5,
    lower: bool = True,
    stored: bool = False,
    whole: bool = False,
) -> DataFrame:
    """Iterative sigma clip as one interval per group.

    Clipping around a median keeps exactly the values between two limits, and later
    rounds only narrow them, so the state is (lo, hi) per group and the rows are
    never rewritten.  Values on a limit are kept.  A group that a round leaves as it was has settled: later
    rounds read the others alone.  ``max_rounds=None`` runs until no
    group changes; one boolean per round reaches the driver.  ``lower=False`` clips
    the high side only.  Returns keys, lo, hi.
    """
    keys = list(keys)
    narrow = df.select(*keys, F.col(value).cast("double").alias("__y")).where(F.col("__y").isNotNull())
    narrow = narrow if stored else cut(narrow)
    state, settled, done = None, [], 0
    while max_rounds is None or done < max_rounds:
        live = narrow
        if state is not None:
            settled.append(state.where("NOT changed"))
            state = state.where("changed")
            limits = state.select(*keys, "lo", "hi")
            live = narrow.join(limits, keys) if keys else narrow.crossJoin(F.broadcast(limits))
            live = live.where(F.col("__y").between(F.col("lo"), F.col("hi"))).drop("lo", "hi")
        stats = medians(
            live, keys, {"__m": "__y"},
            F.stddev_pop("__y").alias("__s"), F.min("__y").alias("__min"), F.max("__y").alias("__max"), stored=True, whole=whole,
        )
        low, high = F.col("__m") - sigma * F.col("__s"), F.col("__m") + sigma * F.col("__s")
        if not lower:
            low = F.col("__min")
        # limits never leave the span of the kept values, so a limit inside it means a change
        state = cut(stats.select(
            *keys, F.greatest(low, F.col("__min")).alias("lo"), F.least(high, F.col("__max")).alias("hi"),
            ((low > F.col("__min")) | (high < F.col("__max"))).alias("changed"),
        ))
        done += 1
        if state.where("changed").isEmpty():
            break
    for part in settled:
        state = state.unionByName(part)
    return state.drop("changed")


def sigma_clip(df: DataFrame, keys: Sequence[str], value: str, out: str, stored: bool = False, **how) -> DataFrame:
    """``out`` is the value where the clip keeps it, else NULL."""
    df = df if stored else cut(df)
    bounds = clip_bounds(df, keys, value, stored=True, **how)
    kept = F.when(F.col(value).between(F.col("lo"), F.col("hi")), F.col(value))
    return attach(df, keys, bounds).withColumn(out, kept).drop("lo", "hi")


def clipped_medians(df: DataFrame, keys: Sequence[str], value: str, out: str = "median", stored: bool = False, **how) -> DataFrame:
    """Median, mean, population deviation and count of the clipped values per group."""
    clipped = sigma_clip(df.select(*keys, value), keys, value, "__c", stored, **how)
    return medians(
        clipped, keys, {out: "__c"},
        F.avg("__c").alias("mean"), F.stddev_pop("__c").alias("std"), F.count("__c").alias("kept"), stored=True,
    )


# Small groups with a fixed size limit: the whole clip in one pass over an array

def array_median(sorted_values: Column) -> Column:
    """Median of an ascending array without NULLs; NULL when empty."""
    n = F.size(sorted_values)
    lower, upper = F.floor((n - 1) / 2).cast("int"), F.floor(n / 2).cast("int")
    return F.when(n > 0, (F.get(sorted_values, lower) + F.get(sorted_values, upper)) / 2)


def _spread(values: Column, centre: Column) -> Column:
    """Population deviation of a short array, summed about ``centre``."""
    n = F.size(values)
    start = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("q"))
    return F.aggregate(
        values, start,
        lambda a, v: F.struct((a["s"] + v - centre).alias("s"), (a["q"] + (v - centre) * (v - centre)).alias("q")),
        lambda a: F.sqrt(F.greatest(F.lit(0.0), a["q"] / n - (a["s"] / n) * (a["s"] / n))),
    )


def array_clip(sorted_values: Column, sigma: float, max_rounds: int | None = None) -> Column:
    """Iterative sigma clip of one short ascending array (A03 for stacks of <= 50).

    The state is the kept values and how many there were before; equal counts mean
    the clip has settled and later steps pass the state on unchanged.
    """
    rounds = F.size(sorted_values) if max_rounds is None else F.lit(max_rounds)

    def one(state, _):
        kept = state["a"]
        centre = F.array(array_median(kept))
        limits = F.transform(centre, lambda m: F.struct(m.alias("m"), (sigma * _spread(kept, m)).alias("w")))
        clipped = F.transform(limits, lambda p: F.filter(kept, lambda v: F.abs(v - p["m"]) <= p["w"]))
        return F.when(F.size(kept) == state["before"], state).otherwise(
            F.struct(F.get(clipped, F.lit(0)).alias("a"), F.size(kept).alias("before"))
        )

    start = F.struct(sorted_values.alias("a"), F.lit(-1).alias("before"))
    steps = F.when(rounds > 0, F.sequence(F.lit(1), rounds)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, start, one, lambda s: s["a"])
