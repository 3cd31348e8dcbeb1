"""Samples inside intervals that share no key with them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .ordered import neighbours, running

#: Standardised values and their squares; their sums hold 10^26.
EXACT = "decimal(28,12)"


def within_intervals(samples: DataFrame, intervals: DataFrame, keys: Sequence[str], t: str, lo: str, hi: str, width: float) -> DataFrame:
    """Each sample beside every interval that holds it, ends included.

    An interval is listed in each time bucket that it touches, a sample in its own; they meet by
    equality on the bucket and the ``keys`` both sides have, perhaps none.  Choose ``width`` near the usual length of an interval.
    """
    keys = list(keys)
    spread = F.explode(F.sequence(F.floor(F.col(lo) / width), F.floor(F.col(hi) / width)))
    listed = intervals.where(F.col(lo) <= F.col(hi)).withColumn("__b", spread)
    return samples.withColumn("__b", F.floor(F.col(t) / width)).join(listed, [*keys, "__b"]).where(F.col(t).between(F.col(lo), F.col(hi))).drop("__b")


def interval_moments(
    intervals: DataFrame, samples: DataFrame, own: Sequence[str], keys: Sequence[str], t: str, lo: str, hi: str, values: Sequence[str], width: float = 1.0
) -> DataFrame:
    """Number, mean and population deviation of the samples inside each interval: ``own``, ``n``, ``<v>_mean``, ``<v>_std``.

    ``own`` names an interval, ``keys`` are those of its columns that the samples have too, perhaps none.  No sample
    meets an interval: running counts, sums and squares are looked up at both ends and subtracted, so the
    work does not grow with the overlap.  Sums are of standardised values as decimals: differences of long running
    sums are exact.  Missing values take no part in their moments; an interval without samples has n = 0 and NULL moments.
    """
    own, keys = list(own), list(keys)
    whole = samples.agg(*[x for v in values for x in (F.avg(v).alias(f"m_{v}"), F.stddev_pop(v).alias(f"s_{v}"))]).first()
    centre = {v: float(whole[f"m_{v}"] or 0.0) for v in values}
    scale = {v: float(whole[f"s_{v}"] or 1.0) for v in values}
    sums = {"__n": F.lit(1)}
    for v in values:
        z = (F.col(v) - F.lit(centre[v])) / F.lit(scale[v])
        sums |= {f"__c_{v}": F.col(v).isNotNull().cast("int"), f"__s_{v}": F.coalesce(z, F.lit(0.0)).cast(EXACT), f"__q_{v}": F.coalesce(z * z, F.lit(0.0)).cast(EXACT)}
    at_once = samples.groupBy(*keys, t).agg(*[F.sum(x).alias(k) for k, x in sums.items()])
    total = cut(running(at_once, keys, [t], {f"{k}_to": k for k in sums}))
    ends = F.explode(F.array(F.struct(F.lit(0).alias("end"), F.col(lo).alias("at")), F.struct(F.lit(1).alias("end"), F.col(hi).alias("at"))))
    probes = cut(intervals.where(F.col(lo) <= F.col(hi)).select(*dict.fromkeys([*own, *keys]), ends.alias("__e")).select("*", F.col("__e.end").alias("__end"), F.col("__e.at").alias(t)).drop("__e"))
    near = neighbours(total, probes, keys, t, [c for k in sums for c in (k, f"{k}_to")], width)
    # up to the upper end, less what lies before the lower one
    part = {
        k: F.when(F.col("__end") == 1, F.coalesce(F.col(f"prev.{k}_to"), F.lit(0)))
        .otherwise(-F.coalesce(F.col(f"prev.{k}_to") - F.when(F.col("prev.t") == F.col(t), F.col(f"prev.{k}")).otherwise(F.lit(0)), F.lit(0)))
        for k in sums
    }
    both = near.groupBy(*own).agg(*[F.sum(x).alias(k) for k, x in part.items()])
    out = [F.col("__n").cast("long").alias("n")]
    for v in values:
        n, s, q = (F.col(f"__{k}_{v}").cast("double") for k in "csq")
        out += [
            F.when(n > 0, F.lit(centre[v]) + F.lit(scale[v]) * s / n).alias(f"{v}_mean"),
            F.when(n > 1, F.lit(scale[v]) * F.sqrt(F.greatest(F.lit(0.0), q / n - (s / n) * (s / n)))).when(n == 1, F.lit(0.0)).alias(f"{v}_std"),
        ]
    return both.select(*own, *out)
