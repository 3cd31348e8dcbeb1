"""Per-star statistics, quality flags and time binning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.photometry import MEDIAN_ERROR_FACTOR
from ..functions.quality import LOW_FLUX_RATE, LOW_MEDIAN_FLUX, SATURATION_PEAK
from .grouped import attach, known, medians, sigma_clip
from .ordered import rolling_std


def star_statistics(lc: DataFrame, keys: Sequence[str], flux: str = "flux") -> DataFrame:
    """Mean and median flux of every star in a night."""
    return medians(lc.select(*keys, flux), keys, {"flux_median": flux}, F.avg(flux).alias("flux_mean"))


def quality_flags(
    lc: DataFrame, keys: Sequence[str], exposure: str, saturation: float = SATURATION_PEAK, stored: bool = False, whole: bool = False
) -> DataFrame:
    """saturated / lowflux per star.

    ``lc`` has flux with low values already NULL, peak and the frame's exposure.
    """
    rows = lc.select(*keys, "flux", "peak", exposure)
    clipped = sigma_clip(rows, keys, "flux", "__clipped", stored, sigma=7.0, max_rounds=5, whole=whole)
    stats = medians(
        clipped, keys,
        {"clipped_median": "__clipped", "rate": F.col("flux") / F.col(exposure)},
        F.max("peak").alias("max_peak"), F.count("flux").alias("n_flux"), F.count("*").alias("n_rows"), stored=True, whole=whole,
    )
    saturated = F.coalesce(F.col("max_peak") > saturation, F.lit(False))
    low = (
        (F.col("n_flux") == 0)
        | (F.col("clipped_median") < LOW_MEDIAN_FLUX)
        | (F.col("rate") < LOW_FLUX_RATE)
    )
    return stats.withColumn("saturated", saturated).withColumn(
        "lowflux", ~saturated & F.coalesce(low, F.lit(False))
    )


def initial_weights(lc: DataFrame, flags: DataFrame, keys: Sequence[str], stored: bool = False, whole: bool = False) -> DataFrame:
    """w1 = median flux, w2 = w3 = 1, weight 1; flagged stars get w1 = weight = 0."""
    med = medians(lc, keys, {"w1": "flux"}, stored=stored, whole=whole)
    out = med.join(flags.select(*keys, "saturated", "lowflux"), list(keys), "left")
    bad = F.coalesce(F.col("saturated") | F.col("lowflux"), F.lit(False))
    return (
        out.withColumn("w1", F.when(bad, 0.0).otherwise(F.coalesce("w1", F.lit(0.0))))
        .withColumn("w2", F.lit(1.0)).withColumn("w3", F.lit(1.0))
        .withColumn("weight", F.when(bad, 0.0).otherwise(1.0))
    )


def time_bin_number(df: DataFrame, keys: Sequence[str], t: str, width: float, out: str = "bin", whole: bool = False) -> DataFrame:
    """Bin k covers (t0 + (k-1) b, t0 + k b]; the first one also holds t0.  ``whole`` groups (``grouped.fits``) are read once."""
    k = F.greatest(F.lit(1), F.ceil((F.col(t) - F.col("__t0")) / F.lit(float(width)))).cast("bigint")
    if whole:
        first = F.when(known(keys), F.min(t).over(Window.partitionBy(*keys)))
        rows = df.select(*keys, *[c for c in df.columns if c not in keys], first.alias("__t0"))
        return rows.withColumn(out, k).drop("__t0")
    start = df.groupBy(*keys).agg(F.min(t).alias("__t0"))
    return attach(df, keys, start).withColumn(out, k).drop("__t0")


def time_bin(df: DataFrame, keys: Sequence[str], t: str, y: str, width: float, whole: bool = False) -> DataFrame:
    """Mean time, mean value and error of the mean's median per bin.

    ``width`` is in the unit of ``t`` (minutes / 1440 for Julian dates).  Missing
    values take no part; bins without any are absent.
    """
    rows = time_bin_number(df, keys, t, width, whole=whole).where(F.col(y).isNotNull())
    return rows.groupBy(*keys, "bin").agg(
        F.avg(t).alias("bin_t"), F.avg(y).alias("bin_y"),
        (F.lit(MEDIAN_ERROR_FACTOR) * F.stddev_pop(y) / F.sqrt(F.count(y))).alias("bin_err"),
        F.count(y).alias("n"),
    )


def time_bin_median(df: DataFrame, keys: Sequence[str], t: str, y: str, width: float) -> DataFrame:
    """Median flavour: first time, median value, all rows counted; bins with value 0 dropped."""
    rows = time_bin_number(df, keys, t, width)
    out = medians(rows, [*keys, "bin"], {"bin_y": y}, F.min(t).alias("bin_t"), F.count("*").alias("n"))
    return out.where(F.col("bin_y") != 0)


def scatter(df: DataFrame, keys: Sequence[str], t: str, y: str, width: float, whole: bool = False) -> DataFrame:
    """Scatter of the series and mean error of its bins."""
    spread = df.groupBy(*keys).agg(F.stddev_pop(y).alias("rms"))
    binned = time_bin(df, keys, t, y, width, whole).groupBy(*keys).agg(
        F.avg("bin_err").alias("mean_bin_err"), F.stddev_pop("bin_y").alias("bin_rms")
    )
    return attach(spread, keys, binned)


def bad_weather_mask(
    df: DataFrame, keys: Sequence[str], t: str, y: str, box: float = 0.02, threshold: float = 0.08, bucket: float | None = None
) -> DataFrame:
    """``scatter`` and ``bad`` where the scatter within +-box/2 exceeds the threshold, or
    the value itself is below 0.2 (W02)."""
    rolled = rolling_std(df, keys, t, y, "scatter", box / 2, bucket)
    return rolled.withColumn(
        "bad", F.coalesce((F.col("scatter") > threshold) | (F.col(y) < 0.2), F.lit(True))
    )
