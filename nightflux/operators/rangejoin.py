"""Sky and plane range joins by zone and bucket (J06, J08, J11-like, J17, J23).

Space is cut into cells as large as the search radius.  Only the reference side is
sent to its 3x3 cells, the join is an equality on the cell, and the distance test
follows.  Rows at one and the same position are matched once.  Where a cell is
crowded a smaller radius is tried first: whatever it finds is already the nearest,
so dense fields are settled in small cells and only the rest meets the large ones.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sky import separation_deg
from ..session import cut

POLE_CAP_DEG = 89.0


def _ra_step(zone: Column, radius: float) -> Column:
    """RA width of the buckets of a zone: at least radius / cos(dec) anywhere a match
    across its borders can lie; one bucket near the poles."""
    edge = F.greatest(F.abs(zone * radius), F.abs((zone + 1) * radius)) + radius
    return F.when(edge >= POLE_CAP_DEG, F.lit(360.0)).otherwise(radius * 1.01 / F.cos(F.radians(edge)))


def _buckets(step: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(360.0 / step)).cast("bigint")


def sky_cells(df: DataFrame, ra: str, dec: str, radius: float, neighbours: bool) -> DataFrame:
    """Add ``__zone`` and ``__cell``; with ``neighbours`` one row per touched cell."""
    zone = F.floor(F.col(dec) / radius)
    z = F.explode(F.array(zone - 1, zone, zone + 1)) if neighbours else zone
    out = df.withColumn("__zone", z)
    n = _buckets(_ra_step(F.col("__zone"), radius))
    cell = F.least(n - 1, F.floor(F.pmod(F.col(ra), F.lit(360.0)) / 360.0 * n))
    if neighbours:
        around = F.array_distinct(F.array(F.pmod(cell - 1, n), cell, F.pmod(cell + 1, n)))
        return out.withColumn("__cell", F.explode(around))
    return out.withColumn("__cell", cell)


def within(left: DataFrame, right: DataFrame, lpos: tuple[str, str], rpos: tuple[str, str], radius: float, sep: str = "sep_deg") -> DataFrame:
    """All pairs closer than ``radius`` degrees, with their separation in degrees.

    Column names of the two sides must differ.
    """
    l = sky_cells(left, *lpos, radius, neighbours=False)
    r = sky_cells(right, *rpos, radius, neighbours=True)
    distance = separation_deg(lpos[0], lpos[1], rpos[0], rpos[1])
    return (
        l.join(r, ["__zone", "__cell"])
        .withColumn(sep, distance)
        .where(F.col(sep) <= radius)
        .drop("__zone", "__cell")
    )


def nearest_within(
    left: DataFrame,
    right: DataFrame,
    lpos: tuple[str, str],
    rpos: tuple[str, str],
    tie: str,
    radius: float,
    fine: float | None = None,
    condition: Column | None = None,
) -> DataFrame:
    """Nearest reference row within ``radius`` degrees of every left position.

    Returns the distinct left positions that have a match, ``match`` (struct of the
    reference row) and ``sep_deg``; ties go to the smallest ``tie``.  ``condition`` is an
    extra test on the pair and may use left columns ``lpos`` and all right columns.
    """
    spots = left.select(*lpos).distinct()
    names = right.columns

    def level(todo: DataFrame, r: float) -> DataFrame:
        pairs = within(todo, right, lpos, rpos, r)
        if condition is not None:
            pairs = pairs.where(condition)
        key = F.struct(F.col("sep_deg"), F.col(tie))
        return pairs.groupBy(*lpos).agg(
            F.min_by(F.struct(*names), key).alias("match"), F.min("sep_deg").alias("sep_deg")
        )

    if fine is None or fine >= radius:
        return level(spots, radius)
    settled = level(spots, fine)
    rest = spots.join(settled, list(lpos), "left_anti")
    return settled.unionByName(level(rest, radius))


def distinct_positions(df: DataFrame, ra: str, dec: str, tie: str) -> DataFrame:
    """One row per exact position: the one with the smallest ``tie``."""
    rest = [c for c in df.columns if c not in (ra, dec)]
    return df.groupBy(ra, dec).agg(F.min_by(F.struct(*rest), tie).alias("__r")).select(ra, dec, "__r.*")


def nearest_any(
    left: DataFrame, right: DataFrame, lpos: tuple[str, str], rpos: tuple[str, str], tie: str, start: float, grow: float = 4.0
) -> DataFrame:
    """Nearest reference row at any distance: the radius grows until every position is
    settled; only unsettled positions meet the next, larger cells (J08)."""
    todo = cut(left.select(*lpos).distinct())
    found = None
    radius = start
    while True:
        last = radius >= 180.0 / grow
        hit = cut(nearest_within(todo, right, lpos, rpos, tie, min(radius, 180.0)))
        found = hit if found is None else found.unionByName(hit)
        todo = cut(todo.join(hit, list(lpos), "left_anti"))
        if radius >= 180.0 or todo.isEmpty():
            return found
        radius = 180.0 if last else radius * grow


# The plane (detector coordinates)

def plane_cells(df: DataFrame, x: str, y: str, radius: float, neighbours: bool) -> DataFrame:
    cx, cy = F.floor(F.col(x) / radius), F.floor(F.col(y) / radius)
    if not neighbours:
        return df.withColumn("__cx", cx).withColumn("__cy", cy)
    return df.withColumn("__cx", F.explode(F.sequence(cx - 1, cx + 1))).withColumn(
        "__cy", F.explode(F.sequence(cy - 1, cy + 1))
    )


def within_plane(
    left: DataFrame, right: DataFrame, keys: list[str], lpos: tuple[str, str], rpos: tuple[str, str], radius: float, dist: str = "dist"
) -> DataFrame:
    """Pairs of the same ``keys`` closer than ``radius`` in the plane."""
    l = plane_cells(left, *lpos, radius, neighbours=False)
    r = plane_cells(right, *rpos, radius, neighbours=True)
    d = F.hypot(F.col(lpos[0]) - F.col(rpos[0]), F.col(lpos[1]) - F.col(rpos[1]))
    return l.join(r, [*keys, "__cx", "__cy"]).withColumn(dist, d).where(F.col(dist) <= radius).drop("__cx", "__cy")


def footprint_start(area_deg2: float, rows: int) -> float:
    """Mean spacing of ``rows`` positions over an area: where the search starts."""
    return max(1e-4, math.sqrt(max(area_deg2, 1e-8) / max(rows, 1)))
