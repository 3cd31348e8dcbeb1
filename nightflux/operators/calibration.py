"""Calibration frames and per-pixel stacking.

Pixels are rows (set keys, frame, y, x, adu, exptime).  A pixel's stack holds one
value per frame of a list, so no pixel can outgrow the others; lists are cut into
chunks of 50 frames, and the clip of a chunk runs on one short array per pixel.
Per-frame figures, whose groups grow with the detector, use the interval clip.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .frames import chunked, first_frames
from .grouped import array_clip, array_median, attach, clipped_medians, medians

PIXEL = ["y", "x"]
#: Share of a clip limit within which the array clip decides.
EDGE = 1e-6


def overscan_levels(pixels: DataFrame, keys: Sequence[str], region: Column, max_rounds: int | None = None) -> DataFrame:
    """Clipped median of each frame's overscan region."""
    c = clipped_medians(pixels.where(region), [*keys, "frame"], "adu", "overscan", sigma=3.0, max_rounds=max_rounds)
    return c.select(*keys, "frame", "overscan")


def subtract_overscan(pixels: DataFrame, levels: DataFrame, keys: Sequence[str], region: Column) -> DataFrame:
    """Science area minus the frame's overscan level; no level means 0."""
    return attach(pixels.where(~region), [*keys, "frame"], levels).withColumn(
        "v", F.col("adu") - F.coalesce("overscan", F.lit(0.0))
    ).drop("overscan")


def stack_clipped(
    pixels: DataFrame, keys: Sequence[str], value: str, out: str, sigma: float = 3.0, max_rounds: int | None = None
) -> DataFrame:
    """Mean over chunks of 50 frames of the clipped median of every pixel.

    The array clip is interpreted and slow, so it runs only on stacks with a value beyond the first limits or, as sums
    may differ in their last digits, on them; a first round that keeps all values is the last one.
    """
    lists = chunked(pixels.select(*keys, "frame").distinct(), keys, ["frame"])
    rows = attach(pixels, [*keys, "frame"], lists)
    arrays = rows.groupBy(*keys, *PIXEL, "chunk").agg(
        F.sort_array(F.collect_list(value)).alias("a"), F.stddev_pop(value).alias("s")
    )  # <= 50 values
    centre, limit = F.col("m"), (1 - EDGE) * sigma * F.col("s")
    arrays = arrays.withColumn("m", array_median(F.col("a")))
    settled = (F.get("a", F.size("a") - 1) - centre <= limit) & (centre - F.get("a", F.lit(0)) <= limit)
    clipped = F.when(settled, centre).otherwise(array_median(array_clip(F.col("a"), sigma, max_rounds)))
    per_chunk = arrays.select(*keys, *PIXEL, clipped.alias("m"))
    return per_chunk.groupBy(*keys, *PIXEL).agg(F.avg("m").alias(out), F.count("m").alias("n_chunks"))


def master_bias(pixels: DataFrame, keys: Sequence[str], region: Column) -> DataFrame:
    """Master bias."""
    levels = cut(overscan_levels(pixels, keys, region))
    return stack_clipped(subtract_overscan(pixels, levels, keys, region), keys, "v", "bias")


def readout_noise(pixels: DataFrame, keys: Sequence[str], gain: float) -> DataFrame:
    """Deviation of the difference of the first two frames, in electrons."""
    two = first_frames(pixels.select(*keys, "frame").distinct(), keys, ["frame"], 2)
    rows = pixels.join(two, [*keys, "frame"])
    pair = rows.groupBy(*keys, *PIXEL).agg(
        F.max(F.when(F.col("rank") == 1, F.col("adu"))).alias("b0"),
        F.max(F.when(F.col("rank") == 2, F.col("adu"))).alias("b1"),
    )
    return pair.groupBy(*keys).agg((F.stddev_pop(F.col("b1") - F.col("b0")) * gain / math.sqrt(2.0)).alias("ron"))


def master_dark(pixels: DataFrame, keys: Sequence[str], region: Column, bias: DataFrame) -> DataFrame:
    """Dark signal per second."""
    levels = cut(overscan_levels(pixels, keys, region, max_rounds=5))
    v = attach(subtract_overscan(pixels, levels, keys, region), [*keys, *PIXEL], bias.select(*keys, *PIXEL, "bias"))
    per_second = v.withColumn("d", (F.col("v") - F.coalesce("bias", F.lit(0.0))) / F.col("exptime"))
    return stack_clipped(per_second, keys, "d", "dark", max_rounds=5)


def dark_current(dark: DataFrame, keys: Sequence[str], gain: float) -> DataFrame:
    """Median of the clipped master dark, in electrons per second."""
    c = clipped_medians(dark, keys, "dark", "m", sigma=3.0, max_rounds=5)
    return c.select(*keys, (F.col("m") * gain).alias("dark_current"))


def corrected(pixels: DataFrame, keys: Sequence[str], region: Column, bias: DataFrame, dark: DataFrame, levels: DataFrame) -> DataFrame:
    """data - overscan - bias - dark x exposure; a missing term is 0."""
    v = subtract_overscan(pixels, levels, keys, region)
    v = attach(v, [*keys, *PIXEL], bias.select(*keys, *PIXEL, "bias"))
    v = attach(v, [*keys, *PIXEL], dark.select(*keys, *PIXEL, "dark"))
    return v.withColumn(
        "c", F.col("v") - F.coalesce("bias", F.lit(0.0)) - F.coalesce("dark", F.lit(0.0)) * F.col("exptime")
    ).drop("v", "bias", "dark")


def flat_scales(frames: DataFrame, keys: Sequence[str], inner: Column | None = None) -> DataFrame:
    """Clipped mean and deviation of each corrected flat, and the median of its inner rows.

    ``frames`` is a stored table.
    """
    c = clipped_medians(frames, [*keys, "frame"], "c", "m", stored=True, sigma=3.0, max_rounds=None)
    core = frames if inner is None else frames.where(inner)
    level = medians(core, [*keys, "frame"], {"level": "c"}, stored=True)
    return attach(c.select(*keys, "frame", F.col("mean").alias("scale"), F.col("std").alias("scale_std")), [*keys, "frame"], level)


def master_flat(frames: DataFrame, scales: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Normalised flat with per-pixel deviation and variance (A10).

    A pixel's group has one value per flat of the list, so the built-in exact median
    is bounded by the list length.
    """
    f = attach(frames, [*keys, "frame"], scales.select(*keys, "frame", "scale")).withColumn("s", F.col("c") / F.col("scale"))
    px = f.groupBy(*keys, *PIXEL).agg(
        F.median("s").alias("__m"), F.stddev_pop("s").alias("std"), F.var_pop("s").alias("variance")
    )
    px = cut(px)
    mean = px.groupBy(*keys).agg(F.avg("__m").alias("__mean"))
    return attach(px, keys, mean).withColumn("flat", F.col("__m") / F.col("__mean")).drop("__m", "__mean")


def calibrate(frames: DataFrame, flat: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Corrected science pixels over the flat of their filter.

    Frames of a filter without a flat are left out; where the flat is 0 the value is NULL.
    """
    f = frames.join(flat.select(*keys, *PIXEL, "flat"), [*keys, *PIXEL])
    return f.withColumn("reduced", F.try_divide("c", "flat")).drop("flat", "c")


def stack_median(pixels: DataFrame, chosen: DataFrame, keys: Sequence[str], value: str = "adu") -> DataFrame:
    """Per-pixel median of the chosen frames (A11); at most a stack's frame limit each."""
    rows = pixels.join(chosen.select(*keys, "frame"), [*keys, "frame"])
    return rows.groupBy(*keys, *PIXEL).agg(F.median(value).alias("stack"), F.count(value).alias("n"))


def cloud_metric(pixels: DataFrame, keys: Sequence[str], value: str = "adu") -> DataFrame:
    """Mean over deviation of every frame."""
    return pixels.groupBy(*keys).agg(
        F.when(F.stddev_pop(value) > 0, F.avg(value) / F.stddev_pop(value)).alias("cloud")
    )


def local_background(pixels: DataFrame, keys: Sequence[str], value: str = "adu", tile: int = 32) -> DataFrame:
    """Pixel minus the clipped median of its 32x32 tile, then minus its row's median.

    A tile holds at most tile x tile pixels and a row one detector width.
    """
    t = pixels.withColumn("ty", F.floor(F.col("y") / tile)).withColumn("tx", F.floor(F.col("x") / tile))
    tiles = t.groupBy(*keys, "ty", "tx").agg(F.sort_array(F.collect_list(value)).alias("a"))
    levels = tiles.select(*keys, "ty", "tx", array_median(array_clip(F.col("a"), 3.0, 5)).alias("background"))
    flat = cut(attach(t, [*keys, "ty", "tx"], levels).withColumn("__r", F.col(value) - F.col("background")))
    rows = medians(flat, [*keys, "y"], {"row_level": "__r"}, bounded=True)
    return attach(flat, [*keys, "y"], rows).withColumn("residual", F.col("__r") - F.col("row_level")).drop("ty", "tx", "__r")
