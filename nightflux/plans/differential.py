"""Differential photometry of targets, all runs in one plan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.photometry import aperture_radius, differential_error, instrumental_magnitude, noise_model, positive_flux
from ..functions.quality import flag_bit, pwv_guard
from ..functions.sky import separation
from ..operators import ensemble as E
from ..operators.grouped import attach, medians, normalise
from ..operators.lightcurve import bad_weather_mask, initial_weights, quality_flags, scatter
from ..operators.water import clean_series, ensemble_teff, water_correction
from ..session import cut
from ..sources.sinks import write_products


@dataclass
class Products:
    """The tables of one job, each keyed by the run columns."""

    lightcurve: DataFrame  # run, star_id, jd, flux, nflux, diff, error
    target: DataFrame  # run, star_id, jd, diff, error, bad
    weights: DataFrame  # run, star_id, w1, w2, w3, weight, rank
    ensemble: DataFrame  # run, jd, alc, nlc
    scores: DataFrame  # run, star_id, rms, mean_bin_err, bin_rms


@dataclass
class Settings:
    bin_width: float = 5.0 / 1440.0
    weather_box: float = E.WEATHER_BOX
    weather_limit: float = E.WEATHER_LIMIT
    bucket: float | None = None
    rounds: int = E.MAX_ROUNDS
    tolerance: float = E.CONVERGED
    saturation: float = 62000.0
    rcore: float = 4.0


def differential_photometry(
    lc: DataFrame, frames: DataFrame, stars: DataFrame, targets: DataFrame, run: Sequence[str], settings: Settings | None = None
) -> Products:
    """From condensed fluxes to differential light curves.

    ``lc``(run, ap, star_id, jd, flux, peak); ``frames``(jd, exptime, gain, airmass, sky,
    ron, height); ``stars``(star_id, ra, dec in radians); ``targets``(run, star_id).  Run columns that
    ``frames`` and ``stars`` hold too are part of their keys: runs whose times or star numbers coincide stay apart.
    """
    run, s = list(run), settings or Settings()
    night, field = [c for c in run if c in frames.columns], [c for c in run if c in stars.columns]
    env = frames.select(*night, "jd", "exptime", "gain", "airmass", "sky", "ron", "height")
    # surveys are very many short series: groups that fit a task are read in one piece
    small = E.sizes(lc, env, run, night)
    base = lc.withColumn("flux", positive_flux("flux")).join(env, [*night, "jd"])
    base = base if small.series else cut(base)
    base = cut(normalise(base, [*run, "star_id"], "flux", "nflux", stored=True, whole=small.series))

    flags = cut(quality_flags(base, [*run, "star_id"], "exptime", s.saturation, stored=True, whole=small.series))
    mags = medians(base, [*run, "star_id"], {"typical_flux": "flux", "__scale": F.col("gain") / F.col("exptime")}, stored=True, whole=small.series)
    mags = mags.select(*run, "star_id", "typical_flux", instrumental_magnitude("typical_flux", "__scale", F.lit(1.0)).alias("mag"))
    is_target = targets.select(*run, "star_id").withColumn("is_target", F.lit(True))
    weights = initial_weights(base, flags, [*run, "star_id"], stored=True, whole=small.series).join(mags, [*run, "star_id"], "left")
    weights = weights.join(is_target, [*run, "star_id"], "left").withColumn("is_target", F.coalesce("is_target", F.lit(False)))

    # distance of every star from the target of its run
    here = targets.select(*run, F.col("star_id").alias("__t"))
    here = here.join(stars.select(*field, F.col("star_id").alias("__t"), F.col("ra").alias("__ra"), F.col("dec").alias("__dec")), [*field, "__t"])
    weights = attach(weights.join(stars.select(*field, "star_id", "ra", "dec"), [*field, "star_id"]), run, here.select(*run, "__ra", "__dec"))
    weights = cut(weights.withColumn("sep", separation("ra", "dec", "__ra", "__dec")).drop("ra", "dec", "__ra", "__dec"))

    target_mag = weights.where("is_target").select(*run, F.col("mag").alias("target_mag"))
    comparisons = weights.where(~F.col("is_target"))
    usable = comparisons.where((F.col("w1") > 0))
    limits = cut(E.magnitude_cuts(usable, target_mag, run))
    sweep = E.magnitude_sweep(base, usable, limits, run, s.bin_width, s.weather_box, s.weather_limit, s.bucket, small)
    chosen = cut(E.best_cut(sweep, run).select(*run, "best_mag"))
    picked = attach(comparisons, run, chosen).withColumn(
        "w3", F.when(F.col("best_mag").isNull(), F.col("w3")).when(F.col("mag") <= F.col("best_mag"), 1.0).otherwise(0.0)
    ).drop("best_mag")

    own = [*run, "star_id", "jd", "nflux"]
    others = base.join(targets.select(*run, "star_id"), [*run, "star_id"], "left_anti").select(*own)
    others = cut(others)
    target_lc = cut(base.join(targets.select(*run, "star_id"), [*run, "star_id"]))
    clean = E.preclean(others, picked, run, stored=True, small=small).drop("masked", "good", "bad", "dropped")
    start = cut(E.total_weights(clean.withColumn("w1_start", F.col("w1")), run).drop("no_weight"))
    final = E.reweight(others, start, run, target_lc, s.rounds, s.tolerance, s.weather_box, s.weather_limit, s.bucket, stored=True, small=small)

    ensemble = E.ensemble_curve(others, final, run, small)
    curves = E.differential(base.select(*run, "star_id", "jd", "flux", "nflux"), ensemble, run, small=small)
    comparison = E.comparison_series(base.select(*run, "star_id", "jd", "flux"), final, run).select(*run, "jd", "comp", "comp_flux")
    marked = cut(bad_weather_mask(ensemble.select(*run, "jd", "nlc"), run, "jd", "nlc", s.weather_box, s.weather_limit, s.bucket))
    ensemble = ensemble.join(marked.select(*run, "jd", "bad"), [*run, "jd"], "left")
    # the noise model takes the brightness of a whole series: medians over all of its frames
    typical = cut(weights.select(*run, "star_id", "typical_flux"))
    comp = cut(medians(cut(comparison), run, {"__comp": "comp_flux"}, stored=True, whole=small.runs))
    mean_ron = frames.groupBy(*night).agg(F.avg("ron").alias("__ron"))

    def noise(flux: str):
        mag = instrumental_magnitude(flux, "gain", "exptime")
        return noise_model(mag, "exptime", "airmass", "sky", "gain", "__ron", "__r", "height")

    ap = [] if "ap" in run else ["ap"]
    own = curves.join(base.select(*run, "star_id", "jd", *ap), [*run, "star_id", "jd"]) if ap else curves
    # what belongs to a star, its run and its night goes to the rows in one join
    typical = attach(attach(typical, run, comp), night, mean_ron)
    own = own.join(typical, [*run, "star_id"]).join(env, [*night, "jd"])
    own = own.withColumn("__r", aperture_radius("ap", F.lit(s.rcore)))
    own = own.withColumn("error", differential_error("diff", noise("typical_flux"), noise("__comp")))
    curves = cut(own.select(*run, "star_id", "jd", "flux", "nflux", "diff", "error"))
    target = curves.join(targets.select(*run, "star_id"), [*run, "star_id"]).join(marked.select(*run, "jd", "bad"), [*run, "jd"], "left")
    target = cut(target.select(*run, "star_id", "jd", "diff", "error", "bad"))
    ranked = E.weight_order(final.unionByName(weights.where("is_target").withColumn("weight", F.lit(0.0)), allowMissingColumns=True), run, F.col("is_target"))
    scores = cut(scatter(curves, [*run, "star_id"], "jd", "diff", s.bin_width, small.series))
    return Products(curves, target, cut(ranked), ensemble, scores)


def finish(
    p: Products, frames: DataFrame, stars: DataFrame, pwv: DataFrame, grid: DataFrame, run: Sequence[str], path: str,
    bin_width: float = Settings.bin_width,
) -> dict[str, DataFrame]:
    """The end of C01: water correction (C06, F32), best apertures (A20, K07), all tables written under ``path`` and read back.

    ``path`` belongs to one job: its tables have a folder for each aperture, with the runs sorted inside the files.

    ``frames`` has telescope beside the plan's columns, ``stars`` has teff, ``pwv``(jd, pwv and perhaps run columns; of
    equal times the driest counts), ``grid``(pwv_mm, airmass_x, teff_k, response).

    ``lightcurve`` has differences and errors of all stars, ``corrected`` every target row (its guard says why a value is
    NULL), ``catalogue`` the stars of each run with their output rank, the target first, ``weights`` the parts of each weight,
    ``images`` the frames of each run, ``ensemble`` the artificial curve, ``flags`` the bits of each time, ``water`` the water
    series at the times of the targets.  Where "ap" is one of the run columns, ``best`` has the best aperture of each
    target over the others, from plain and from corrected curves.
    """
    run = list(run)
    own = [*run, "star_id"]
    night, field = [c for c in run if c in frames.columns], [c for c in run if c in stars.columns]
    warm = stars.select(*field, "star_id", F.col("teff").cast("double").alias("teff"))
    ensemble = cut(ensemble_teff(p.weights.join(warm, [*field, "star_id"], "left"), run))
    t = p.target.join(frames.select(*night, "jd", "airmass", "telescope"), [*night, "jd"], "left").join(warm, [*field, "star_id"], "left")
    t = cut(attach(t, run, ensemble).withColumn("guard", pwv_guard("telescope", "teff")))
    taken = t.where(~F.col("guard").startswith("skip"))
    shared = [c for c in run if c in pwv.columns]
    series = clean_series(pwv.select(*shared, "jd", "pwv"), shared, "jd", ["pwv"])
    fixed = cut(water_correction(taken, series, grid, own, "jd", "diff", "airmass", "teff", "ensemble_teff"))
    corrected = t.join(fixed.select(*own, "jd", "pwv", "water_ratio", "corrected"), [*own, "jd"], "left")
    corrected = cut(corrected)
    listed = p.weights.select(*own, "rank", "is_target", "mag", "sep").join(stars, [*field, "star_id"], "left")
    dry = corrected.groupBy(*run, "jd").agg(F.max(F.col("corrected").isNull()).alias("dry"))
    flags = p.ensemble.select(*run, "jd", "bad").join(dry, [*run, "jd"], "left")
    flags = flags.select(*run, "jd", flag_bit("bad").alias("bad_weather"), flag_bit(F.coalesce("dry", F.lit(True))).alias("no_water"))
    images = p.ensemble.select(*run, "jd").join(frames, [*night, "jd"])
    tables = {
        "lightcurve": p.lightcurve, "target": p.target, "corrected": corrected, "catalogue": listed,
        "weights": p.weights.select(*own, "rank", "saturated", "lowflux", "w1", "w2", "w3", "weight"),
        "images": images, "ensemble": p.ensemble.select(*run, "jd", "alc", "nlc"), "flags": flags,
        "water": corrected.where("pwv IS NOT NULL").select(*run, "jd", "pwv").distinct(), "scores": p.scores,
    }
    # surveys have very many runs and few apertures: a folder for each run would cost more than its rows
    write_products(tables, path, run, [c for c in run if c == "ap"])
    if "ap" in run:
        rest = [c for c in run if c != "ap"]
        plain = E.best_aperture(p.scores.join(p.target.select(*own).distinct(), own, "left_semi"), [*rest, "star_id"])
        wet = E.best_aperture(scatter(corrected, own, "jd", "corrected", bin_width), [*rest, "star_id"])
        wet = wet.select(*rest, "star_id", F.col("best_ap").alias("best_ap_pwv"), F.col("score").alias("score_pwv"))
        best = plain.join(wet, [*rest, "star_id"], "left")
        write_products({"best": best}, path, rest or ["star_id"], [])
        tables["best"] = best
    return {name: p.target.sparkSession.read.schema(df.schema).parquet(f"{path}/{name}") for name, df in tables.items()}
