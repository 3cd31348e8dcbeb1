"""Time alignment of two series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import linked, neighbours


def nearest(samples: DataFrame, queries: DataFrame, keys: Sequence[str], t: str, y: str, out: str, width: float = 1.0) -> DataFrame:
    """Value and time of the nearest sample; ties go to the earlier one."""
    n = neighbours(samples, queries, keys, t, [y], width)
    earlier = F.col(t) - F.col("prev.t")
    later = F.col("next.t") - F.col(t)
    pick = F.when(earlier.isNull(), F.col("next")).when(later.isNull() | (earlier <= later), F.col("prev")).otherwise(F.col("next"))
    return n.select(*queries.columns, pick.getField("t").alias(f"{out}_{t}"), pick.getField(y).alias(out))


def _line(t, t0, y0, t1, y1):
    return y0 + (y1 - y0) * (t - t0) / (t1 - t0)


def interpolate(
    samples: DataFrame, queries: DataFrame, keys: Sequence[str], t: str, y: str, out: str, width: float = 1.0
) -> DataFrame:
    """Linear interpolation, extended past both ends along the end segments.

    Of samples at one time the smallest value counts, so the end segments have a length.  A series
    of one time gives its sample only at that time.
    """
    once = samples.groupBy(*keys, t).agg(F.min(y).alias(y))
    links = linked(once, keys, t, [y], width)
    n = neighbours(links, queries, keys, t, [y, "before", "after"], width)
    x = F.col(t)
    p, q = F.col("prev"), F.col("next")
    between = _line(x, p["t"], p[y], q["t"], q[y])
    beyond = _line(x, p["before"]["t"], p["before"][y], p["t"], p[y])
    ahead = _line(x, q["t"], q[y], q["after"]["t"], q["after"][y])
    value = (
        F.when(p["t"] == x, p[y])
        .when(p.isNotNull() & q.isNotNull(), between)
        .when(p.isNotNull(), beyond)
        .otherwise(ahead)
    )
    return n.select(*queries.columns, value.alias(out))


def interpolate_index(
    samples: DataFrame, queries: DataFrame, keys: Sequence[str], t: str, y: str, out: str, width: float = 1.0
) -> DataFrame:
    """Index-weighted linear fill: last value kept after the end, NULL before the start."""
    n = neighbours(samples, queries, keys, t, [y], width)
    x, p, q = F.col(t), F.col("prev"), F.col("next")
    value = (
        F.when(p["t"] == x, p[y])
        .when(p.isNotNull() & q.isNotNull(), _line(x, p["t"], p[y], q["t"], q[y]))
        .when(p.isNotNull(), p[y])
    )
    return n.select(*queries.columns, value.alias(out))
