"""Night summary, health, log flags and ledgers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.photometry import ellipticity_or_null
from ..functions.quality import health_verdict, qc_cell, qc_grade, task_cell
from .grouped import medians

# Fixed values
WEATHER_TEXT = "WEATHER ALERT"
STATUS_TEXT = "TELESCOPE.STATUS.LIST"
STATUS_QUIET = 'TELESCOPE.STATUS.LIST="DRIVES|0::,SYSTEM|0::,AUXILIARY|0::,UNKNOWN|0::"'
PRESSURE_TEXT = "Working pressure suddenly lost"
DOME_TELESCOPE = "Callisto"
DOME_TEXT = "DRIVES|2:DOME[0]|2;DOME[1]|2:ERR_DeviceError|axis (0) unexpectedly changed to powered on state"
SHAKING_LIMIT = 1.2
UNKNOWN = "unknown"
DEFAULT_APERTURE = 6
FIRST_PWV_ARCHIVE_JD = 2458550.0


def night_summary(frames: DataFrame, keys: Sequence[str], t: str = "jd") -> DataFrame:
    """First and last time, frames, first filter, median ellipticity and the target's last
    position (A24).  Undefined ellipticities are skipped."""
    return medians(
        frames, keys, {"ellipticity": ellipticity_or_null("psf_a", "psf_b")},
        F.min(t).alias("jd_start"), F.max(t).alias("jd_end"), F.count("*").alias("n_frames"),
        F.min_by("filter", t).alias("first_filter"), F.max_by("x", t).alias("last_x"), F.max_by("y", t).alias("last_y"),
    )


def chronological(summary: DataFrame, night: Sequence[str]) -> DataFrame:
    """Order of the targets of a night (O07); a night has a few dozen targets."""
    return summary.withColumn("place", F.rank().over(Window.partitionBy(*night).orderBy("jd_start")))


def health(frames: DataFrame, night: Sequence[str], target: str, t: str = "jd") -> DataFrame:
    """Per-target medians averaged over the targets of a night, and the verdicts.

    Readout noise and dark current are those of the first frame that has both.
    """
    first = F.when(F.col("ron").isNotNull() & F.col("dark").isNotNull(), F.col(t))
    per_target = medians(
        frames, [*night, target], {"overscan": "overscan", "pa": "pa", "temp": "temp", "ellipticity": ellipticity_or_null("psf_a", "psf_b")},
        F.min_by("ron", first).alias("ron"), F.min_by("dark", first).alias("dark"),
    )
    table = per_target.groupBy(*night).agg(
        *[F.avg(c).alias(c) for c in ("overscan", "pa", "temp", "ron", "dark")], F.max("ellipticity").alias("ellipticity")
    )
    checks = ("overscan", "ron", "dark", "temp", "pa", "ellipticity")
    return table.withColumns({f"{c}_state": health_verdict(c, c) for c in checks})


def log_flags(
    lines: DataFrame, keys: Sequence[str], kind: str = "kind", text: str = "value", telescope: str = "telescope", nights: DataFrame | None = None
) -> DataFrame:
    """Weather and events flags of each night from log lines.

    'Y' where a telling line exists, 'N' where the log exists without one, 'unknown'
    where the log is missing.  With ``nights`` every one of them has a row, also one without any log.
    """
    v = F.col(text)
    harmless = v.contains(STATUS_QUIET) | v.contains(PRESSURE_TEXT) | (
        (F.col(telescope) == DOME_TELESCOPE) & v.contains(DOME_TEXT)
    )
    telling = {"weather": v.contains(WEATHER_TEXT), "events": v.contains(STATUS_TEXT) & ~harmless}

    def flag(name: str) -> Column:
        mine = F.col(kind) == name
        return (
            F.when(F.max(F.when(mine & telling[name], 1)).isNotNull(), "Y")
            .when(F.max(F.when(mine, 1)).isNotNull(), "N").otherwise(UNKNOWN)
        )

    flags = lines.groupBy(*keys).agg(*[flag(n).alias(f"{n}_flag") for n in telling])
    if nights is None:
        return flags
    whole = nights.select(*keys).distinct().join(flags, list(keys), "left")
    return whole.withColumns({f"{n}_flag": F.coalesce(f"{n}_flag", F.lit(UNKNOWN)) for n in telling})


def transfer_state(archived: Column, transferred: Column, downloaded: Column) -> Column:
    """No data, OK or KO from three counts."""
    same = (archived == transferred) & (transferred == downloaded)
    return F.when(same & (archived == 0), "No data").when(same, "OK").otherwise("KO")


def transfer_status(nights: DataFrame, transfers: DataFrame) -> DataFrame:
    """Transfer state of each night; no entry is 'unknown' (J24)."""
    state = transfers.select("night", transfer_state(F.col("archived"), F.col("transferred"), F.col("downloaded")).alias("transfer"))
    return nights.join(state, "night", "left").withColumn("transfer", F.coalesce("transfer", F.lit(UNKNOWN)))


def closure_flags(nights: DataFrame, closures: DataFrame) -> DataFrame:
    """Y where the dome closed between noon and the next noon.

    Julian days begin at noon, so a night is one whole day number: an equality join.
    """
    closed = closures.select(F.floor("jd").alias("__day")).distinct().withColumn("__c", F.lit("Y"))
    return nights.withColumn("__day", F.floor("jd_noon")).join(closed, "__day", "left").withColumn(
        "closure", F.coalesce("__c", F.lit("N"))
    ).drop("__day", "__c")


def shaking_flag(readings: DataFrame, keys: Sequence[str], t: str, tracking: str, nights: DataFrame | None = None) -> DataFrame:
    """Y where the night's last tracking value is above 1.2, ``unknown`` where it is missing.

    With ``nights`` every one of them has a row, also one without any reading."""
    last = readings.groupBy(*keys).agg(F.max_by(tracking, t).alias("last_tracking"))
    if nights is not None:
        last = nights.select(*keys).distinct().join(last, list(keys), "left")
    return last.withColumn("shaking", F.when(F.col("last_tracking") <= SHAKING_LIMIT, "N").when(F.col("last_tracking") > SHAKING_LIMIT, "Y").otherwise(UNKNOWN))


def within_runs(samples: DataFrame, summary: DataFrame, keys: Sequence[str], t: str) -> DataFrame:
    """Samples between the start and end of their key's run."""
    span = summary.select(*keys, "jd_start", "jd_end")
    return samples.join(span, list(keys)).where(F.col(t).between(F.col("jd_start"), F.col("jd_end"))).drop("jd_start", "jd_end")


def chosen_aperture(targets: DataFrame, with_pwv: DataFrame, plain: DataFrame, keys: Sequence[str], default: int = DEFAULT_APERTURE) -> DataFrame:
    """Best aperture: water-corrected choice, else the plain one, else the default (C11)."""
    p = with_pwv.select(*keys, F.col("best_ap").alias("__p"))
    q = plain.select(*keys, F.col("best_ap").alias("__q"))
    return targets.join(p, list(keys), "left").join(q, list(keys), "left").withColumn(
        "aperture", F.coalesce("__p", "__q", F.lit(default))
    ).withColumn("corrected", F.col("__p").isNotNull()).drop("__p", "__q")


def latest(facts: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Latest row per key: the view of an append-only ledger."""
    rest = [c for c in facts.columns if c not in keys]
    return facts.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__r")).select(*keys, "__r.*")


def qc_ledger(facts: DataFrame, rules: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Graded ledger, one row per key and check (C12, F23, K08).  ``facts``(keys, check, value)."""
    now = latest(facts, [*keys, "check"], order)
    graded = now.join(F.broadcast(rules), "check")  # 14 rules
    return graded.withColumn("grade", qc_grade("value", "worse", "yellow", "red")).withColumn(
        "cell", qc_cell("grade")
    ).select(*keys, "check", "value", "grade", "cell")


def ledger_table(ledger: DataFrame, keys: Sequence[str], checks: Sequence[str]) -> DataFrame:
    """The wide display, '---' where a check did not run."""
    return ledger.groupBy(*keys).pivot("check", list(checks)).agg(F.max("cell")).na.fill("---", list(checks))


def task_ledger(progress: DataFrame, keys: Sequence[str], tasks: int = 10) -> DataFrame:
    """Cells T1..Tk of the last task reached."""
    reached = progress.groupBy(*keys).agg(F.max("task").alias("__t"))
    return reached.select(*keys, *[task_cell(F.lit(j), "__t").alias(f"T{j}") for j in range(1, tasks + 1)])
