"""The tables behind a night's report (C11)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import report as R
from ..operators.overlap import interval_moments
from ..session import cut


@dataclass
class NightInputs:
    """What a report reads; ``night`` is the columns that name a night, ``target`` the target's."""

    frames: DataFrame  # night, target, jd, filter, psf_a, psf_b, x, y, overscan, pa, temp, ron, dark
    schedule: DataFrame  # night, target, planned (start)
    logs: DataFrame  # night, kind, value, telescope
    readings: DataFrame  # night, jd, tracking
    transfers: DataFrame  # night number ("night"), archived, transferred, downloaded
    closures: DataFrame  # jd
    guiding: DataFrame  # telescope, jd, ha, dec
    water: DataFrame  # jd, pwv
    best_pwv: DataFrame  # target, best_ap
    best: DataFrame  # target, best_ap


def night_report(i: NightInputs, night: list[str], target: str, first_water: float = R.FIRST_PWV_ARCHIVE_JD) -> DataFrame:
    """One row per target of a night, whether planned, observed or both.

    Summary and place in the night (A24, O07), health of the night (A25, A26), weather, event, closure, shaking and transfer
    states (P17, P18, J24), the aperture shown (water-corrected choice, plain choice, default), and the moments of the
    guiding offsets and water samples between the target's first and last frame, which share no key but the telescope
    with them, or none.  Water archives before ``first_water`` are not read.  ``night`` holds "night" (its noon's Julian day).
    """
    keys = [*night, target]
    summary = cut(R.chronological(R.night_summary(i.frames, keys), night))
    planned = i.schedule.groupBy(*keys).agg(F.min("planned").alias("planned"))
    rows = cut(summary.join(planned, keys, "full_outer").withColumn("n_frames", F.coalesce("n_frames", F.lit(0)).cast("long")))
    nights = cut(rows.select(*night).distinct())

    states = R.log_flags(i.logs, night, nights=nights).join(R.shaking_flag(i.readings, night, "jd", "tracking", nights=nights), night)
    by_day = R.closure_flags(nights.select("night").distinct().withColumn("jd_noon", F.col("night").cast("double")), i.closures)
    by_day = R.transfer_status(by_day, i.transfers).select("night", "closure", "transfer")
    health = R.health(i.frames, night, target).select(*night, *[f"{c}_state" for c in ("overscan", "ron", "dark", "temp", "pa", "ellipticity")])
    aperture = R.chosen_aperture(rows.select(target).distinct(), i.best_pwv, i.best, [target])

    runs = summary.select(*keys, "jd_start", "jd_end")
    shared = [c for c in keys if c in i.guiding.columns]
    guiding = interval_moments(runs, i.guiding, keys, shared, "jd", "jd_start", "jd_end", ["ha", "dec"]).withColumnRenamed("n", "n_guiding")
    water = interval_moments(runs.where(F.col("jd_start") >= first_water), i.water, keys, [], "jd", "jd_start", "jd_end", ["pwv"]).withColumnRenamed("n", "n_water")
    out = rows.join(states, night, "left").join(by_day, "night", "left").join(health, night, "left").join(aperture, target, "left")
    out = out.join(guiding, keys, "left").join(water, keys, "left")
    return out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_guiding", "n_water")})
