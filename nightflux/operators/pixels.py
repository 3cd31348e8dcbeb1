"""Forced photometry and point-spread-function statistics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.photometry import APERTURE_FACTORS
from ..functions.psf import moments_to_axes
from ..session import cut
from .grouped import attach, medians
from .rangejoin import within_plane

# Fixed value
SUBPIXELS = 5


def aperture_photometry(
    pixels: DataFrame, stars: DataFrame, keys: Sequence[str], star: str, rcore: float, annulus: tuple[float, float], field: Sequence[str] = ()
) -> DataFrame:
    """Sky-subtracted flux in 13 apertures at catalogue positions.

    ``pixels``(keys, y, x, adu); ``stars``(field, star, sx, sy): ``field`` names the keys that a
    frame shares with its stars, so that no star is measured on another field's frames.  A pixel counts by its
    centre.  Sky is the median of an annulus, whose pixels are bounded by its area.

    Pairs of a pixel and a star are never stored: they are sent to the task of their star and frame, which takes sums and
    sky in one aggregation, so that no task sorts more than its share of the shuffle.
    """
    reach = max(annulus[1], max(APERTURE_FACTORS) * rcore)
    near = within_plane(pixels, stars, list(field), ("x", "y"), ("sx", "sy"), reach).select(*keys, star, "adu", "dist")
    named = reduce(and_, [F.col(c).isNotNull() for c in (*keys, star)])  # without its keys a star has no sky
    ring = F.when(named & F.col("dist").between(*annulus), F.col("adu"))
    near = near.repartition(*keys, star)  # a partial aggregation would sort all pairs of a task before it
    rows = medians(
        near, [*keys, star], {"sky": ring},
        *[F.sum(F.when(F.col("dist") <= m * rcore, F.col("adu"))).alias(f"s{i + 1}") for i, m in enumerate(APERTURE_FACTORS)],
        *[F.count_if(F.col("dist") <= m * rcore).alias(f"n{i + 1}") for i, m in enumerate(APERTURE_FACTORS)],
        F.max(F.when(F.col("dist") <= APERTURE_FACTORS[-1] * rcore, F.col("adu"))).alias("peak"),
        bounded=True,
    )
    fluxes = [(F.coalesce(f"s{i}", F.lit(0.0)) - F.coalesce("sky", F.lit(0.0)) * F.col(f"n{i}")).alias(f"aper_flux_{i}") for i in range(1, 14)]
    return rows.select(*keys, star, "sky", "peak", *fluxes)


def long_photometry(wide: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per aperture."""
    names = [f"aper_flux_{i}" for i in range(1, 14)]
    long = wide.unpivot([*keys], names, "__n", "flux")
    return long.withColumn("ap", F.regexp_extract("__n", r"(\d+)$", 1).cast("int")).drop("__n")


def psf_statistics(
    pixels: DataFrame, stars: DataFrame, keys: Sequence[str], star: str, region: str, half: float, field: Sequence[str] = ()
) -> DataFrame:
    """FWHM along both axes and angle per frame and region.

    Cut-outs are scaled by their maximum, put on a grid of fifths of a pixel about the
    star and summed; widths come from second moments, not from a least-squares fit (a
    stated divergence).
    """
    reach = half * 1.4142135623730951
    near = within_plane(pixels, stars, list(field), ("x", "y"), ("sx", "sy"), reach).where(
        (F.abs(F.col("x") - F.col("sx")) <= half) & (F.abs(F.col("y") - F.col("sy")) <= half)
    )
    near = cut(near.select(*keys, star, region, "adu", (F.col("x") - F.col("sx")).alias("dx"), (F.col("y") - F.col("sy")).alias("dy")))
    top = near.groupBy(*keys, star).agg(F.max("adu").alias("__top"))
    scaled = attach(near, [*keys, star], top).where("__top > 0").select(
        *keys, region, F.round(F.col("dx") * SUBPIXELS).alias("bx"), F.round(F.col("dy") * SUBPIXELS).alias("by_"), (F.col("adu") / F.col("__top")).alias("v")
    )
    image = scaled.groupBy(*keys, region, "bx", "by_").agg(F.sum("v").alias("s"))
    x, y, s = F.col("bx") / SUBPIXELS, F.col("by_") / SUBPIXELS, F.col("s")
    m = image.groupBy(*keys, region).agg(
        F.sum(s).alias("w"), F.sum(s * x).alias("sx_"), F.sum(s * y).alias("sy_"),
        F.sum(s * x * x).alias("sxx"), F.sum(s * y * y).alias("syy"), F.sum(s * x * y).alias("sxy"),
    )
    mx, my = F.col("sx_") / F.col("w"), F.col("sy_") / F.col("w")
    m = m.withColumns({
        "mxx": F.col("sxx") / F.col("w") - mx * mx, "myy": F.col("syy") / F.col("w") - my * my, "mxy": F.col("sxy") / F.col("w") - mx * my,
    })
    a, b, t = moments_to_axes("mxx", "myy", "mxy")
    return m.select(*keys, region, a.alias("psf_a"), b.alias("psf_b"), t.alias("psf_t"))
