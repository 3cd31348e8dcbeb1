"""Flags, grades and site constants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import as_col

# Check, what it measures, worse direction, yellow limit, red limit
QC_RULES = [
    ("QC1", "science frames", "LT", 10, 1),
    ("QC2", "bias frames", "LT", 3, 1),
    ("QC3", "dark frames", "LT", 3, 1),
    ("QC4", "flat frames", "LT", 3, 1),
    ("QC5", "flat flux", "GT", 1000000, 1000000),
    ("QC6", "readout noise", "GT", 8, 100),
    ("QC7", "dark current", "GT", 1, 100),
    ("QC8", "overscan", "GT", 305, 1000),
    ("QC9", "solved frames", "LT", 10, 1),
    ("QC10", "catalogue sources", "LT", 50, 5),
    ("QC11", "matched percent", "LT", 30, 1),
    ("QC12", "psf", "LT", 0, 0),
    ("QC13", "fwhm", "GT", 8, 100),
    ("QC14", "background", "GT", 500, 2000),
]
QC_CELLS = {"g": "[x]", "y": "[-]", "r": "[o]"}
TASK_DONE, TASK_OPEN = "[x]", "[o]"

# Name part, gain e-/ADU, diameter cm, altitude m, longitude deg, latitude deg
SITES = [
    ("ARTEMIS", 1.1, 100.0, 2482.0, -16.5097, 28.3),
    ("SAINT-EX", 3.48, 100.0, 2800.0, -115.4637, 31.0439),
]
SITE_DEFAULT = ("", 1.0029, 100.0, 2390.0, -70.40498688, -24.62743941)
SITES_WITHOUT_PWV = ["ARTEMIS", "SAINT-EX"]

# Detector rows and columns
CAMERA_ROWS = {1280: "spirit"}
DEFAULT_CAMERA = "andor"
MOANA = "MOANA"
OVERSCAN = {"andor": {"last_rows": 15, "first_col": 4}}
TRIM = {"andor": (22, 2066, 2, 2048), "moana": (1, -1, 1, -1), "spirit": (0, 0, 0, 0)}

SATURATION_PEAK = 62000.0
LOW_MEDIAN_FLUX = 100.0
LOW_FLUX_RATE = 10.0
TEFF_LOW, TEFF_HIGH = 2000.0, 3200.0


def qc_rules(spark: SparkSession) -> DataFrame:
    """The QC rule table, one row per check; fixed size, safe to broadcast."""
    return spark.createDataFrame(QC_RULES, "check string, measures string, worse string, yellow int, red int")


def qc_grade(value, worse, yellow, red) -> Column:
    """g, y or r of a value against its rule; the value is cut to a whole number."""
    v = as_col(value).cast("bigint")
    low = as_col(worse) == "LT"

    def beyond(limit):
        limit = as_col(limit)
        return F.when(low, v < limit).otherwise(v > limit)

    return F.when(v.isNull(), F.lit(None)).when(beyond(red), "r").when(beyond(yellow), "y").otherwise("g")


def qc_cell(grade) -> Column:
    """Ledger cell of a grade; '---' where there is none."""
    out = F.lit("---")
    for name, cell in QC_CELLS.items():
        out = F.when(as_col(grade) == name, cell).otherwise(out)
    return out


def task_cell(task, done_through) -> Column:
    """Ledger cell of task number ``task`` once tasks up to ``done_through`` ran."""
    return F.when(as_col(task) <= as_col(done_through), TASK_DONE).otherwise(TASK_OPEN)


def flag_bit(mask) -> Column:
    """1 where the mask is true, else 0."""
    return F.coalesce(as_col(mask), F.lit(False)).cast("int")


def camera(telescope, naxis2) -> Column:
    """Camera family of a frame."""
    kind = F.lit(DEFAULT_CAMERA)
    for rows, name in CAMERA_ROWS.items():
        kind = F.when(as_col(naxis2) == rows, name).otherwise(kind)
    return F.when(F.upper(as_col(telescope)).contains(MOANA), "moana").otherwise(kind)


def in_overscan(cam, y, x, naxis2) -> Column:
    """Pixels of the overscan region."""
    hit = F.lit(False)
    for name, region in OVERSCAN.items():
        inside = (as_col(y) >= as_col(naxis2) - region["last_rows"]) & (as_col(x) >= region["first_col"])
        hit = F.when(as_col(cam) == name, inside).otherwise(hit)
    return hit


def in_trim(cam, y, x, naxis1, naxis2) -> Column:
    """Pixels kept after trimming; ends that are zero or negative count from the far edge."""
    hit = F.lit(True)
    for name, (y0, y1, x0, x1) in TRIM.items():
        top = F.lit(y1) if y1 > 0 else as_col(naxis2) + y1
        right = F.lit(x1) if x1 > 0 else as_col(naxis1) + x1
        inside = (as_col(y) >= y0) & (as_col(y) < top) & (as_col(x) >= x0) & (as_col(x) < right)
        hit = F.when(as_col(cam) == name, inside).otherwise(hit)
    return hit


def site_constant(telescope, which: str) -> Column:
    """gain, diameter, altitude, longitude or latitude by telescope name."""
    at = ["name", "gain", "diameter", "altitude", "longitude", "latitude"].index(which)
    out = F.lit(SITE_DEFAULT[at])
    for row in SITES:
        out = F.when(F.upper(as_col(telescope)).contains(row[0]), F.lit(row[at])).otherwise(out)
    return out


def pwv_guard(telescope, teff) -> Column:
    """Whether the water-vapour correction applies, and why not (F32)."""
    t = as_col(teff)
    no_site = F.lit(False)
    for name in SITES_WITHOUT_PWV:
        no_site = no_site | F.upper(as_col(telescope)).contains(name)
    return (
        F.when(no_site, "skip: site")
        .when(t.isNull() | F.isnan(t), "skip: no teff")
        .when(t < TEFF_LOW, "skip: teff too low")
        .when(t > TEFF_HIGH, "warn: teff high")
        .otherwise("ok")
    )


def chip_region(x, y, nx, ny) -> Column:
    """f_1..f_9 third-by-third region; points exactly on a third get none (P10)."""
    x, y, nx, ny = map(as_col, (x, y, nx, ny))

    def third(v, n):
        return F.when(v < n / 3, 0).when((v > n / 3) & (v < 2 * n / 3), 1).when(v > 2 * n / 3, 2)

    return F.concat(F.lit("f_"), (third(y, ny) * 3 + third(x, nx) + 1).cast("string"))


def away_from_edge(x, y, nx, ny, size) -> Column:
    """Positions at least two cut-out sizes from every edge (P10)."""
    x, y, m = as_col(x), as_col(y), 2 * as_col(size)
    return (x > m) & (x < as_col(nx) - m) & (y > m) & (y < as_col(ny) - m)


# Measure, centre, tolerance
HEALTH_LIMITS = {"overscan": (300.0, 2.0), "ron": (6.5, 1.5), "dark": (0.27, 0.1), "temp": (-60.0, 1.0)}
PA_TOLERANCE, ELLIPTICITY_LIMIT = 2.0, 0.5


def health_verdict(measure: str, value) -> Column:
    """'OK' or 'CHECK' of one health figure; NULL stays NULL."""
    v = as_col(value)
    if measure == "pa":
        good = F.least(F.abs(v), F.abs(v - 360.0)) <= PA_TOLERANCE
    elif measure == "ellipticity":
        good = v <= ELLIPTICITY_LIMIT
    else:
        centre, tolerance = HEALTH_LIMITS[measure]
        good = F.abs(v - centre) <= tolerance
    return F.when(good, "OK").when(~good, "CHECK")
