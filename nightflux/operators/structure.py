"""Common structure in a field's light curves and its removal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.photometry import linear_model
from ..session import as_col, cut
from .grouped import attach, medians
from .ordered import gaussian_smooth, top_per_group

# Fixed values
MAG_BINS = (12.0, 18.0, 0.5)
FAINT_LIMIT_FOR_OUTLIERS, BRIGHT_OUTLIER = 15.0, -5.0
COEFFICIENT_RANGE = (-30.0, 10.0)
MAG_BELOW, MAG_ABOVE, MAG_TOP = 2.0, 1.0, 17.0
STRUCTURE_LIMIT = 0.0002
HEAVIEST, SIGMA_SAMPLES = 4, 5.0
LOW_BINS = (13.0, 0.3, 16)
BINNED_RANGE = (-15.0, 5.0)
EVALUATED = (11.0, 18.0, 999)


def line_fit(df: DataFrame, keys: Sequence[str], y: str, model: str) -> DataFrame:
    """Least squares of y - 1 on model - 1 per star, and R2 about 1."""
    u, v = F.col(y) - 1, F.col(model) - 1
    both = df.where(F.col(y).isNotNull() & F.col(model).isNotNull())
    s = both.groupBy(*keys).agg(
        F.regr_slope(u, v).alias("a1"), F.regr_intercept(u, v).alias("a0"),
        F.regr_syy(u, v).alias("__syy"), F.regr_sxy(u, v).alias("__sxy"), F.regr_sxx(u, v).alias("__sxx"),
        F.avg(u).alias("__u"), F.count(u).alias("n"),
    )
    residual = F.col("__syy") - F.col("__sxy") * F.col("__sxy") / F.col("__sxx")
    total = F.col("__syy") + F.col("n") * F.col("__u") * F.col("__u")
    return s.withColumn("r2", F.when(total > 0, 1 - residual / total)).drop("__syy", "__sxy", "__sxx", "__u")


def coefficient_bins(stars: DataFrame, keys: Sequence[str], mag: str, a: str, step: float = MAG_BINS[2]) -> DataFrame:
    """Median coefficient per magnitude bin, outliers kept out."""
    return medians(_placed(stars, mag, a, step), [*keys, "mag_bin"], {"a_median": a}, F.count("*").alias("n"))


def _placed(stars: DataFrame, mag: str, a: str, step: float) -> DataFrame:
    first, last, _ = MAG_BINS
    centre = first + F.round((F.col(mag) - first) / step) * step
    lo, hi = COEFFICIENT_RANGE
    odd = (F.col(mag) < FAINT_LIMIT_FOR_OUTLIERS) & (F.col(a) < BRIGHT_OUTLIER)
    near = F.abs(F.col(mag) - centre) < step / 2
    return stars.withColumn("mag_bin", F.round(centre, 6)).where(
        near & ~odd & (F.col(a) < hi) & (F.col(a) > lo) & (centre >= first) & (centre < last)
    )


def lowest_coefficients(stars: DataFrame, keys: Sequence[str], mag: str, a: str, tie: str, n: int = 5) -> DataFrame:
    """Median of the five smallest coefficients per magnitude bin (A30, second flavour).

    Bins lie between edges, open at both, and are named by their middle; no outlier is kept out.
    """
    first, step, bins = LOW_BINS
    k = F.floor((F.col(mag) - first) / step)
    placed = stars.withColumn("mag_bin", F.round(first + step / 2 + step * k, 6)).where((k >= 0) & (k < bins) & (F.col(mag) > first + step * k))
    low = top_per_group(placed, [*keys, "mag_bin"], [a, tie], n)
    return medians(low, [*keys, "mag_bin"], {"a_median": a}, bounded=True)  # at most n rows each


def weighted_line(df: DataFrame, keys: Sequence[str], x: str, y: str, weight: Column | str) -> DataFrame:
    """Straight line with weights on the residuals (their squares in the sums; A32); a single x gives the line of least norm."""
    w = as_col(weight) * as_col(weight)
    x, y = F.col(x), F.col(y)
    mean = df.groupBy(*keys).agg(F.sum(w).alias("__w"), (F.sum(w * x) / F.sum(w)).alias("__mx"), (F.sum(w * y) / F.sum(w)).alias("__my"))
    dx, dy = x - F.col("__mx"), y - F.col("__my")
    s = attach(df, keys, mean, few=True).groupBy(*keys).agg(
        F.try_divide(F.sum(w * dx * dy), F.sum(w * dx * dx)).alias("slope"), F.first("__mx").alias("__mx"), F.first("__my").alias("__my"),
        F.count("*").alias("n"),
    )
    s = s.withColumn("slope", F.coalesce("slope", F.try_divide(F.col("__my"), 2 * F.col("__mx"))))
    return s.withColumn("intercept", F.col("__my") - F.col("slope") * F.col("__mx")).drop("__mx", "__my")


def parabola(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Degree-two fit from power sums about the mean of x (A32): c0 + c1 (x-x0) + c2 (x-x0)^2."""
    mean = df.groupBy(*keys).agg(F.avg(x).alias("x0"))
    d = F.col(x) - F.col("x0")
    p = [F.sum(F.pow(d, F.lit(float(k)))).alias(f"s{k}") for k in range(5)]
    q = [F.sum(F.pow(d, F.lit(float(k))) * F.col(y)).alias(f"t{k}") for k in range(3)]
    s = attach(df, keys, mean, few=True).groupBy(*keys, "x0").agg(*p, *q)
    c = F.col

    def det(a, b, e):
        return (
            a[0] * (b[1] * e[2] - b[2] * e[1]) - a[1] * (b[0] * e[2] - b[2] * e[0]) + a[2] * (b[0] * e[1] - b[1] * e[0])
        )

    cols = [[c("s0"), c("s1"), c("s2")], [c("s1"), c("s2"), c("s3")], [c("s2"), c("s3"), c("s4")]]
    rhs = [c("t0"), c("t1"), c("t2")]
    whole = det(*cols)
    solved = [det(*[rhs if j == i else cols[j] for j in range(3)]) / whole for i in range(3)]
    return s.select(*keys, "x0", *[v.alias(f"c{i}") for i, v in enumerate(solved)])


def common_structure(diff: DataFrame, weights: DataFrame, run: Sequence[str], y: str = "diff") -> DataFrame:
    """Weighted mean of the heaviest stars' differential curves, smoothed."""
    top = top_per_group(weights, run, [F.col("weight").desc(), F.col("star_id")], HEAVIEST).select(*run, "star_id", "weight")
    rows = diff.join(top, [*run, "star_id"])
    s = cut(rows.groupBy(*run, "jd").agg((F.sum(F.col("weight") * F.col(y)) / F.sum(F.when(F.col(y).isNotNull(), F.col("weight")))).alias("structure")))
    return gaussian_smooth(s, run, "jd", "structure", "smooth", SIGMA_SAMPLES)


def correct_structure(
    target: DataFrame, diff: DataFrame, stars: DataFrame, smooth: DataFrame, run: Sequence[str], y: str = "diff"
) -> DataFrame:
    """Remove the common structure from the target.

    Every star is fitted with the structure, the bins of the coefficients (A30, target included) are
    fitted against magnitude near the target, and where the structure is large enough the target is
    divided by 1 + a0 + fit(mag) (model - 1).  Without a bin near the target it stays as it is.
    ``stars``(star_id, mag, saturated); ``target``(run, jd, diff, mag).
    """
    m = smooth.select(*run, "jd", "smooth")
    fits = line_fit(diff.join(m, [*run, "jd"]), [*run, "star_id"], y, "smooth")
    own = line_fit(target.join(m, [*run, "jd"]), run, y, "smooth").select(*run, F.col("a0").alias("__a0"), F.col("a1").alias("__a1"))
    tmag = target.groupBy(*run).agg(F.first("mag").alias("__tmag"))
    lo, hi = BINNED_RANGE
    others = fits.join(stars.select(*run, "star_id", "mag", "saturated"), [*run, "star_id"]).where(~F.col("saturated")).select(*run, "mag", "a1")
    points = others.unionByName(attach(tmag, run, own).select(*run, F.col("__tmag").alias("mag"), F.col("__a1").alias("a1")))
    near = attach(coefficient_bins(points, run, "mag", "a1"), run, tmag).where(
        (F.col("mag_bin") > F.col("__tmag") - MAG_BELOW) & (F.col("mag_bin") < F.least(F.col("__tmag") + MAG_ABOVE, F.lit(MAG_TOP)))
        & (F.col("a_median") > lo) & (F.col("a_median") < hi)
    )
    line = weighted_line(near, run, "mag_bin", "a_median", 1 / F.col("mag_bin"))
    size = smooth.groupBy(*run).agg(F.stddev_pop("smooth").alias("__size"))
    rows = attach(attach(attach(target.join(m, [*run, "jd"]), run, line), run, own), run, size)
    faint, bright, steps = EVALUATED[1], EVALUATED[0], EVALUATED[2] / (EVALUATED[1] - EVALUATED[0])
    at = bright + F.round((F.least(F.greatest(F.col("mag"), F.lit(bright)), F.lit(faint)) - bright) * steps) / steps
    scale = F.col("intercept") + F.col("slope") * at
    used = F.coalesce((F.col("__size") >= STRUCTURE_LIMIT) & F.col("slope").isNotNull(), F.lit(False))
    rows = rows.withColumn("used", used)
    out = rows.withColumn("corrected", F.when(F.col("used"), F.col(y) / linear_model("__a0", scale, "smooth")).otherwise(F.col(y)))
    return out.drop("slope", "intercept", "n", "__a0", "__a1", "__size")
