"""Frame inventory and calibration selection of all nights."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import frames as FR
from ..session import cut


@dataclass
class Inventory:
    frames: DataFrame  # classified frames
    counts: DataFrame  # per night
    bias: DataFrame  # date, cal_date, n_cal
    dark: DataFrame
    flats: DataFrame  # date, filter, first_date, n_flats
    checks: DataFrame  # date, check, value


def inventory(frames: DataFrame) -> Inventory:
    """Classify, count, and choose calibration nights for every night with science frames."""
    classed = cut(FR.classify(frames))

    def per_night(kind: str, *keys: str) -> DataFrame:
        return cut(classed.where(F.col("class") == kind).groupBy("date", *keys).agg(F.count("*").alias("n")))

    nights = cut(classed.where("class = 'science'").select("date", "filter").distinct())
    dates = nights.select("date").distinct()
    bias = FR.look_back_single(dates, per_night("bias"), FR.MIN_BIAS)
    dark = FR.look_back_single(dates, per_night("dark"), FR.MIN_DARK)
    flats = FR.look_back_accumulate(nights, per_night("flat", "filter"))
    counts = FR.class_counts(classed, ["date"])
    wide = counts.select("date", F.col("n_science").alias("QC1"), F.col("n_bias").alias("QC2"), F.col("n_dark").alias("QC3"), F.col("n_flat").alias("QC4"))
    checks = wide.unpivot(["date"], ["QC1", "QC2", "QC3", "QC4"], "check", "value")
    return Inventory(classed, counts, bias, dark, flats, checks)
