"""Frame inventory and choice of calibration nights
(A01, A29, A47, J15, P01, P02, P12-P16, P19, P21, W05, W10, W11, W14, C03)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import as_col
from .ordered import neighbours, running, top_per_group

# Fixed values
CLASSES = ["science", "dithered", "dark", "bias", "flat"]
MIN_CALIBRATION_WIDTH, MIN_FLAT_WIDTH = 1000, 2000
WIDE_FILTER = "ZYJ"
LIGHT, DARK, BIAS, FLAT = "LIGHT", "DARK", "BIAS", "FLAT"
SUFFIX, SUFFIX_LENGTH = "_2", 13
MIN_BIAS, MIN_DARK, MIN_FLATS = 2, 1, 4
LOOK_BACK_DAYS, FLAT_LOOK_BACK_DAYS = 99, 3 * 365
MIN_SCIENCE = 4
CHUNK = 50
DUPLICATE_MARK = "dupe"


def frame_class() -> Column:
    """science, dithered, dark, bias, flat or NULL from imagetyp, dither, naxis1, filter."""
    kind = F.upper("imagetyp")
    wide = F.col("naxis1") > MIN_CALIBRATION_WIDTH
    flat_ok = (F.col("naxis1") > MIN_FLAT_WIDTH) | F.upper("filter").contains(WIDE_FILTER)
    dithered = F.coalesce(F.col("dither"), F.lit("DISABLED")) == "ENABLED"
    return (
        F.when(kind.contains(LIGHT), F.when(dithered, "dithered").otherwise("science"))
        .when(kind.contains(DARK) & wide, "dark")
        .when(kind.contains(BIAS) & wide, "bias")
        .when(kind.contains(FLAT) & flat_ok, "flat")
    )


def classify(frames: DataFrame) -> DataFrame:
    """Add ``class``; frames of no class are dropped."""
    return frames.withColumn("class", frame_class()).where(F.col("class").isNotNull())


def field_name(obj: Column | str = "object", field: Column | str | None = None) -> Column:
    """Object, else field; a ``_2`` in a 13-character name is removed."""
    name = as_col(obj) if field is None else F.coalesce(as_col(obj), as_col(field))
    doubled = name.contains(SUFFIX) & (F.length(name) == SUFFIX_LENGTH)
    return F.when(doubled, F.replace(name, F.lit(SUFFIX), F.lit(""))).otherwise(name)


def class_counts(classed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One column per class with its number of frames."""
    return classed.groupBy(*keys).agg(*[F.count_if(F.col("class") == c).alias(f"n_{c}") for c in CLASSES])


def busy_fields(classed: DataFrame, keys: Sequence[str], more_than: int = MIN_SCIENCE) -> DataFrame:
    """Groups with more than four science frames."""
    n = classed.where("class = 'science'").groupBy(*keys).agg(F.count("*").alias("n"))
    return n.where(F.col("n") > more_than)


def without_first(frames: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Drop the first frame of every group."""
    first = frames.groupBy(*keys).agg(F.min(order).alias("__first"))
    return frames.join(first, list(keys)).where(F.col(order) > F.col("__first")).drop("__first")


def has_wcs() -> Column:
    """Frames whose solution flag is absent or true."""
    return F.coalesce(F.col("wcscompl"), F.lit(True))


def with_solution_state(frames: DataFrame, solved: DataFrame, key: str) -> DataFrame:
    """wcscompl from presence in the list of solved frames."""
    mark = solved.select(key).distinct().withColumn("__s", F.lit(True))
    return frames.drop("wcscompl").join(mark, key, "left").withColumn("wcscompl", F.col("__s").isNotNull()).drop("__s")


def of_target(frames: DataFrame, target: str) -> DataFrame:
    """Drop light frames of other objects; frames with missing headers stay."""
    other = (F.lower("imagetyp") == "light frame") & (F.col("object") != target)
    return frames.where(~F.coalesce(other, F.lit(False)))


def with_flat(science: DataFrame, flats: DataFrame) -> DataFrame:
    """Science frames whose filter has a flat."""
    return science.join(flats.select("filter").distinct(), "filter", "left_semi")


def day_number(date: str = "date") -> Column:
    """Days since 1970 of YYYYMMDD text."""
    return F.unix_date(F.to_date(F.col(date), "yyyyMMdd"))


def look_back_single(nights: DataFrame, counts: DataFrame, minimum: int, days: int = LOOK_BACK_DAYS) -> DataFrame:
    """Calibration night for frames that come from one night (bias, dark; J15).

    Tonight if it has ``minimum`` frames, else the nearest earlier night that has, at
    most ``days`` back, else NULL.  ``nights``(date); ``counts``(date, n).
    """
    one = F.lit(1).alias("k")
    good = counts.where(F.col("n") >= minimum).select(one, day_number().cast("double").alias("t"), "date", "n")
    good = good.withColumnRenamed("date", "cal_date")
    asked = nights.select(one, day_number().cast("double").alias("t"), "date")
    found = neighbours(good, asked, ["k"], "t", ["cal_date", "n"], width=400.0)
    usable = (F.col("t") - F.col("prev.t")) <= days
    return found.select(
        "date", F.when(usable, F.col("prev.cal_date")).alias("cal_date"), F.when(usable, F.col("prev.n")).alias("n_cal")
    )


def look_back_accumulate(
    nights: DataFrame, counts: DataFrame, minimum: int = MIN_FLATS, days: int = FLAT_LOOK_BACK_DAYS
) -> DataFrame:
    """Flats per filter, earlier nights added until there are enough.

    With C the running count of flats per filter, the first night to use is the last
    one whose count before it is at most C(tonight) - minimum: an as-of lookup along
    the count axis.  ``nights``(date, filter); ``counts``(date, filter, n).
    Returns date, filter, first_date, n_flats (what the look-back window holds).
    """
    c = running(counts.select("filter", "date", "n", day_number().alias("day")), ["filter"], ["day"], {"upto": "n"})
    c = c.withColumn("before", (F.col("upto") - F.col("n")).cast("double"))
    asked = nights.select("filter", "date", day_number().cast("double").alias("t"))
    by_day = c.select("filter", F.col("day").cast("double").alias("t"), "upto")
    # running count tonight, and just before the window opens
    tonight = neighbours(by_day, asked, ["filter"], "t", ["upto"], width=400.0).select(
        "filter", "date", "t", F.coalesce(F.col("prev.upto"), F.lit(0)).alias("upto")
    )
    opening = tonight.withColumn("t0", F.col("t")).withColumn("t", F.col("t") - days - 1)
    windowed = neighbours(by_day, opening, ["filter"], "t", ["upto"], width=400.0).select(
        "filter", "date", "upto", F.col("t0").alias("day"), F.coalesce(F.col("prev.upto"), F.lit(0)).alias("floor")
    )
    # along the count axis
    starts = c.select("filter", F.col("before").alias("t"), F.col("date").alias("first_date"), "before", "day")
    need = windowed.withColumn("t", F.greatest(F.col("upto") - minimum, F.col("floor")).cast("double"))
    hit = neighbours(starts, need, ["filter"], "t", ["first_date", "before"], width=100_000.0)
    enough = F.col("upto") > F.col("floor")
    return hit.select(
        "date", "filter",
        F.when(enough, F.col("prev.first_date")).alias("first_date"),
        F.when(enough, (F.col("upto") - F.col("prev.before")).cast("bigint")).otherwise(F.lit(0)).alias("n_flats"),
    )


def chunked(frames: DataFrame, keys: Sequence[str], order: Sequence[str], size: int = CHUNK) -> DataFrame:
    """Add ``chunk``: consecutive groups of 50 frames of a list."""
    rows = running(frames, keys, order, {}, number="__i")
    return rows.withColumn("chunk", F.floor((F.col("__i") - 1) / size).cast("bigint")).drop("__i")


def mid_selection(frames: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, limit: int) -> DataFrame:
    """Frames to stack: all if fewer than ``limit``, else the first ``limit`` from the middle
    of the list on whose name has no 'dupe' (W11, O06)."""
    rows = running(frames, keys, order, {}, number="__i")
    sizes = frames.groupBy(*keys).agg(F.count("*").alias("__n"))
    rows = rows.join(sizes, list(keys))
    wanted = (F.col("__n") < limit) | (
        (F.col("__i") - 1 >= F.col("__n") / 2) & ~F.lower(F.col(name)).contains(DUPLICATE_MARK)
    )
    return top_per_group(rows.where(wanted), keys, ["__i"], limit).drop("__i", "__n", "rank")


def first_frames(frames: DataFrame, keys: Sequence[str], order: Sequence[str], n: int = 2) -> DataFrame:
    """The first ``n`` frames of each list."""
    return top_per_group(frames, keys, order, n)
