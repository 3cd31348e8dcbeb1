"""Ensemble differential photometry.

Everything is keyed by ``run`` columns (target, filter, night, aperture), so any
number of runs shares one plan.  A light curve table has the run columns, star_id,
jd, flux and nflux; a weight table has the run columns, star_id, w1, w2, w3, weight.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sky import distance_weight
from ..session import cut
from .grouped import attach, clip_bounds, fits, medians, normalise
from .lightcurve import bad_weather_mask, time_bin
from .ordered import running, top_per_group

# Fixed values
LOW_NFLUX = 0.2
DROP_SHARE = 0.2
DOMINANT_WEIGHT = 0.95
WEATHER_BOX, WEATHER_LIMIT = 0.02, 0.08
CONVERGED = 1e-5
MAX_ROUNDS = 31
CUTS, MAG_SPAN, MIN_STARS = 50, 3.0, 20
EXPONENTS, EXPONENT_RANGE = 20, (0.5, 3.0)


class Sizes(NamedTuple):
    """Which groups of a light-curve table are small enough to be read whole; where nothing was measured, none."""

    series: bool = False  # the times of a star
    times: bool = False  # the stars of a time
    runs: bool = False  # the distinct times of a run


def sizes(lc: DataFrame, frames: DataFrame, run: Sequence[str], night: Sequence[str]) -> Sizes:
    """Measure the groups of stored light curves; a run has at most the times of its night in ``frames``."""
    return Sizes(fits(lc, [*run, "star_id"]), fits(lc, [*run, "jd"]), fits(frames, night))


def _by_time(rows: DataFrame, run: Sequence[str], whole: bool) -> DataFrame:
    """Rows by time before they are summed: rows that lie by star give partial sums as many as themselves."""
    return rows.repartition(*run, "jd") if whole else rows


def _over(part: Column, whole: Column) -> Column:
    return F.when(whole != 0, part / whole).otherwise(part)


def total_weights(w: DataFrame, run: Sequence[str]) -> DataFrame:
    """w1, w2, w3 each divided by its sum, and their product divided by its sum.

    A sum of zero leaves its values unchanged; ``no_weight`` marks such runs.
    """
    sums = w.groupBy(*run).agg(
        *[F.sum(c).alias(f"__s{c}") for c in ("w1", "w2", "w3")],
        F.sum(F.col("w1") * F.col("w2") * F.col("w3")).alias("__sw"),
    )
    product = F.col("w1") * F.col("w2") * F.col("w3")
    return (
        attach(w, run, sums)
        .withColumn("weight", _over(product, F.col("__sw")))
        .withColumn("no_weight", F.col("__sw") == 0)
        .withColumns({c: _over(F.col(c), F.col(f"__s{c}")) for c in ("w1", "w2", "w3")})
        .drop("__sw1", "__sw2", "__sw3", "__sw")
    )


def ensemble_curve(lc: DataFrame, weights: DataFrame, run: Sequence[str], small: Sizes = Sizes()) -> DataFrame:
    """Artificial light curve: weighted sum over stars per time, and normalised.

    Times where every star is missing get 0.
    """
    joined = lc.select(*run, "star_id", "jd", "nflux").join(
        weights.select(*run, "star_id", "weight"), [*run, "star_id"]
    ).select(*run, "jd", (F.col("nflux") * F.col("weight")).alias("__w"))
    total = _by_time(joined, run, small.times).groupBy(*run, "jd").agg(F.coalesce(F.sum("__w"), F.lit(0.0)).alias("alc"))
    if small.runs:
        return cut(normalise(total, run, "alc", "nlc", whole=True))
    return cut(normalise(cut(total), run, "alc", "nlc", stored=True))  # one row per time: small


def differential(lc: DataFrame, ensemble: DataFrame, run: Sequence[str], out: str = "diff", small: Sizes = Sizes()) -> DataFrame:
    """Every star's nflux over the ensemble, normalised per star (A46).  Both are stored tables.

    The product is stored, except where series are read whole: one pass gives it, by star as the next joins want it.
    """
    e = ensemble.select(*run, "jd", F.col("nlc").alias("__e"))
    ratio = lc.join(e, [*run, "jd"]).withColumn("__d", F.when(F.col("__e") != 0, F.col("nflux") / F.col("__e")))
    if small.series:
        return normalise(ratio.drop("__e"), [*run, "star_id"], "__d", out, whole=True).drop("__d")
    # the product is stored anyway and several readers follow: write it once
    return cut(normalise(ratio.drop("__e"), [*run, "star_id"], "__d", out, stored=True).drop("__d"))


def preclean(
    lc: DataFrame, weights: DataFrame, run: Sequence[str], max_rounds: int | None = None, stored: bool = False, small: Sizes = Sizes()
) -> DataFrame:
    """Drop stars (w3 = 0) masked in more than a fifth of the good times.

    Masked: nflux missing, at or below 0.2, or outside a 3-sigma clip across the
    stars of the same time.  Times with every star masked count for no star.
    """
    y = F.when(F.col("nflux") > LOW_NFLUX, F.col("nflux"))
    rows = lc.select(*run, "star_id", "jd", y.alias("y"))
    rows = rows if stored else cut(rows)
    bounds = clip_bounds(rows, [*run, "jd"], "y", sigma=3.0, max_rounds=max_rounds, stored=True, whole=small.times)
    marked = rows.join(bounds.select(*run, "jd", "lo", "hi"), [*run, "jd"], "left").withColumn(
        "ok", F.coalesce(F.col("y").between(F.col("lo"), F.col("hi")), F.lit(False))
    )
    if small.times:
        # one row of each time stands for it, so stars and times are counted from one reading
        time = Window.partitionBy(*run, "jd")
        marked = marked.withColumn("any_ok", F.max("ok").over(time)).withColumn("lead", F.row_number().over(time.orderBy(*run, "jd")) == 1)
        per_star = cut(marked.groupBy(*run, "star_id").agg(
            F.count_if("ok").alias("used"), F.count_if(F.col("lead") & F.col("any_ok")).alias("good"), F.count_if(F.col("lead") & ~F.col("any_ok")).alias("bad")))
        per_run = per_star.groupBy(*run).agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
        per_star = per_star.drop("good", "bad")
    else:
        times = marked.groupBy(*run, "jd").agg(F.max("ok").alias("any_ok"))
        per_run = times.groupBy(*run).agg(F.count_if("any_ok").alias("good"), F.count_if(~F.col("any_ok")).alias("bad"))
        per_star = marked.groupBy(*run, "star_id").agg(F.count_if("ok").alias("used"))
    verdict = attach(per_star, run, per_run).select(
        *run, "star_id",
        (F.col("good") + F.col("bad") - F.col("used")).alias("masked"), "good", "bad",
        (F.col("good") - F.col("used") > DROP_SHARE * F.col("good")).alias("dropped"),
    )
    out = weights.join(verdict, [*run, "star_id"], "left")
    return out.withColumn("w3", F.when(F.coalesce("dropped", F.lit(False)), 0.0).otherwise(F.col("w3")))


def effective_stars(weights: DataFrame, run: Sequence[str], share: float = DOMINANT_WEIGHT) -> DataFrame:
    """How many stars hold 95 % of the weight, and whether a single one does."""
    summed = running(weights, run, [F.col("weight").desc(), F.col("star_id")], {"cum": "weight"}, number="rank")
    return summed.groupBy(*run).agg(
        F.min(F.when(F.col("cum") > share, F.col("rank"))).alias("n_stars"),
        (F.max("weight") > share).alias("dominated"),
    )


def weight_order(weights: DataFrame, run: Sequence[str], is_target: Column) -> DataFrame:
    """Output order of stars: target first, then by weight."""
    return running(
        weights.withColumn("__t", is_target.cast("int")), run,
        [F.col("__t").desc(), F.col("weight").desc(), F.col("star_id")], {}, number="rank",
    ).drop("__t")


def comparison_series(lc: DataFrame, weights: DataFrame, run: Sequence[str], stars: int = 10) -> DataFrame:
    """Per-frame median flux of the heaviest stars, normalised."""
    top = top_per_group(weights, run, [F.col("weight").desc(), F.col("star_id")], stars).select(*run, "star_id")
    rows = lc.join(top, [*run, "star_id"])
    per_frame = medians(rows, [*run, "jd"], {"comp_flux": "flux"}, bounded=True)  # at most ``stars`` rows each
    return normalise(per_frame, run, "comp_flux", "comp")


# --- sweeps -----------------------------------------------------------------

def magnitude_cuts(stars: DataFrame, target_mag: DataFrame, run: Sequence[str]) -> DataFrame:
    """First and last cut per run: the 20th brightest unsaturated star and target + 3."""
    ok = stars.where(~F.col("saturated") & F.col("mag").isNotNull())
    ranked = top_per_group(ok, run, ["mag", "star_id"], MIN_STARS)
    bright = ranked.groupBy(*run).agg(F.max("mag").alias("max_mag"))
    lim = attach(bright, run, target_mag.select(*run, (F.col("target_mag") + MAG_SPAN).alias("min_mag")))
    return lim.withColumn(
        "max_mag", F.when(F.col("max_mag") >= F.col("min_mag"), F.col("min_mag") - 1.0).otherwise(F.col("max_mag"))
    )


def magnitude_sweep(
    lc: DataFrame, stars: DataFrame, limits: DataFrame, run: Sequence[str], bin_width: float,
    box: float = WEATHER_BOX, threshold: float = WEATHER_LIMIT, bucket: float | None = None, small: Sizes = Sizes(),
) -> DataFrame:
    """Mean bin error of the ensemble for each of 50 magnitude cuts.

    Cuts are nested: every star is put once into the first cut it passes, and the 50
    ensembles are 50 sums of one aggregation.  A time with its 50 values is one stored row; the
    weather needs the first cut alone.  Where the times of a run are read whole, the rows per cut
    are made, moved and reduced in one step, and never written.
    """
    step = (F.col("min_mag") - F.col("max_mag")) / (CUTS - 1)
    placed = attach(stars.where(F.col("mag").isNotNull()), run, limits).withColumn(
        "cut0", F.greatest(F.lit(0), F.ceil((F.col("mag") - F.col("max_mag")) / step)).cast("int")
    ).where(F.col("cut0") < CUTS)
    weighted = placed.select(*run, "star_id", "cut0", (F.col("w1") * F.col("w2")).alias("w"))

    def nested(v: Column, name: str) -> list[Column]:
        return [F.coalesce(F.sum(F.when(F.col("cut0") <= k, v)), F.lit(0.0)).alias(f"{name}{k}") for k in range(CUTS)]

    joined = lc.select(*run, "star_id", "jd", "nflux").join(weighted, [*run, "star_id"])
    joined = joined.select(*run, "jd", "cut0", (F.col("nflux") * F.col("w")).alias("__w"))
    sums = _by_time(joined, run, small.times).groupBy(*run, "jd").agg(*nested(F.col("__w"), "s"))
    norms = weighted.groupBy(*run).agg(*nested(F.col("w"), "n"))
    alc = F.array(*[F.when(F.col(f"n{k}") > 0, F.col(f"s{k}") / F.col(f"n{k}")) for k in range(CUTS)])
    wide = cut(attach(sums, run, norms).select(*run, "jd", alc.alias("alc")))
    # the cuts without stars are the same at all times of a run: the first value is that of its first cut
    first = normalise(wide.select(*run, "jd", F.get(F.array_compact("alc"), F.lit(0)).alias("alc")).where("alc IS NOT NULL"), run, "alc", "nlc", stored=True, whole=small.runs)
    marked = cut(bad_weather_mask(cut(first.select(*run, "jd", "nlc")), run, "jd", "nlc", box, threshold, bucket).select(*run, "jd", "bad"))
    share = marked.groupBy(*run).agg((F.count_if("bad") < 0.8 * F.count("*")).alias("use_mask"))
    mask = attach(marked, run, share).select(*run, "jd", (F.col("bad") & F.col("use_mask")).alias("masked"))
    curves = wide.join(mask, [*run, "jd"], "left").select(*run, "jd", "masked", F.posexplode("alc").alias("cut", "alc")).where("alc IS NOT NULL")
    curves = normalise(curves, [*run, "cut"], "alc", "nlc", stored=False, whole=small.runs)
    curves = curves if small.runs else cut(curves)  # 50 values per time at most; read several times below
    kept = curves.where("masked IS NOT NULL").withColumn("y", F.when(~F.col("masked"), F.col("nlc")))
    errors = time_bin(kept, [*run, "cut"], "jd", "y", bin_width, small.runs).groupBy(*run, "cut").agg(
        F.avg("bin_err").alias("mean_err"), F.stddev_pop("bin_y").alias("bin_std")
    )
    mag = F.col("max_mag") + F.col("cut") * step
    return attach(errors, run, limits).withColumn("cut_mag", mag).drop("max_mag", "min_mag")


def best_cut(sweep: DataFrame, run: Sequence[str]) -> DataFrame:
    """The cut with the smallest mean bin error; ties go to the brighter one."""
    key = F.struct(F.round("mean_err", 12), "cut")
    usable = F.when(F.col("mean_err").isNotNull(), key)
    return sweep.groupBy(*run).agg(
        F.min_by("cut", usable).alias("best_cut"), F.min_by("cut_mag", usable).alias("best_mag"),
        F.min("mean_err").alias("best_err"),
    )


def distance_sweep(lc: DataFrame, weights: DataFrame, target: DataFrame, run: Sequence[str], small: Sizes = Sizes()) -> DataFrame:
    """Scatter of the target's differential curve for each of 20 distance exponents.

    The 20 ensembles are 20 sums of one aggregation, not 20 copies of the rows.
    ``weights`` has ``sep``; ``target`` is the target's run, jd, nflux.
    """
    lo, hi = EXPONENT_RANGE
    values = [lo + i * (hi - lo) / (EXPONENTS - 1) for i in range(EXPONENTS)]
    far = weights.groupBy(*run).agg(F.max("sep").alias("__far"))
    w = attach(weights, run, far).select(
        *run, "star_id", (F.col("w1") * F.col("w3")).alias("w"), "sep", "__far"
    )
    each = [F.col("w") * distance_weight(F.lit(a), "sep", "__far") for a in values]
    norm = w.groupBy(*run).agg(*[F.sum(e).alias(f"n{i}") for i, e in enumerate(each)])
    # one weight and one distance travel with a row, the 20 weights are made where it is summed
    rows = lc.select(*run, "star_id", "jd", "nflux").join(w, [*run, "star_id"]).select(*run, "jd", "nflux", "w", "sep", "__far")
    sums = _by_time(rows, run, small.times).groupBy(*run, "jd").agg(
        *[F.coalesce(F.sum(F.col("nflux") * e), F.lit(0.0)).alias(f"s{i}") for i, e in enumerate(each)]
    )
    alc = F.array(*[F.when(F.col(f"n{i}") != 0, F.col(f"s{i}") / F.col(f"n{i}")) for i in range(EXPONENTS)])
    wide = attach(sums, run, norm).select(*run, "jd", alc.alias("__alc"))
    if small.runs:
        # the target's values go with their time through the one move by step
        at = target.groupBy(*run, "jd").agg(F.collect_list(F.struct(F.col("nflux").alias("__t"))).alias("__at"))
        wide = wide.join(at, [*run, "jd"], "left").select(*run, "jd", "__at", F.posexplode("__alc").alias("step", "alc"))
        curves = normalise(wide, [*run, "step"], "alc", "nlc", whole=True)
        ratio = curves.select(*run, "step", "nlc", F.explode("__at").alias("__at")).withColumn("__t", F.col("__at.__t"))
    else:
        wide = wide.select(*run, "jd", F.posexplode("__alc").alias("step", "alc"))
        curves = cut(normalise(cut(wide), [*run, "step"], "alc", "nlc", stored=True))  # 20 values per time
        ratio = target.select(*run, "jd", F.col("nflux").alias("__t")).join(curves, [*run, "jd"])
    ratio = ratio.withColumn("d", F.when(F.col("nlc") != 0, F.col("__t") / F.col("nlc")))
    diff = normalise(ratio, [*run, "step"], "d", "diff", whole=small.runs)
    a = F.lit(lo) + F.col("step") * F.lit((hi - lo) / (EXPONENTS - 1))
    return diff.groupBy(*run, "step").agg(F.stddev_pop("diff").alias("scatter")).withColumn("a", a)


def best_exponent(sweep: DataFrame, run: Sequence[str]) -> DataFrame:
    key = F.when(F.col("scatter").isNotNull(), F.struct(F.round("scatter", 12), "step"))
    return sweep.groupBy(*run).agg(F.min_by("a", key).alias("best_a"), F.min("scatter").alias("best_scatter"))


# --- iterative re-weighting ---------------------------------------------------

def _reset_dominated(w: DataFrame, run: Sequence[str]) -> DataFrame:
    """Where one star holds more than 95 % of a run's weight: start over without it."""
    top = w.groupBy(*run).agg(
        F.max("weight").alias("__top"),
        F.max_by("star_id", F.struct("weight", -F.col("star_id"))).alias("__who"),
    )
    over = F.col("__top") > DOMINANT_WEIGHT
    reset = (
        attach(w, run, top)
        .withColumn("w1", F.when(over, F.col("w1_start")).otherwise(F.col("w1")))
        .withColumn("w2", F.when(over, 1.0).otherwise(F.col("w2")))
        .withColumn(
            "w3", F.when(over, F.when(F.col("star_id") == F.col("__who"), 0.0).otherwise(1.0)).otherwise(F.col("w3"))
        )
        .withColumn("__over", over)
    )
    fresh = total_weights(reset.withColumn("__old", F.col("weight")), run)
    return fresh.withColumn("weight", F.when(F.col("__over"), F.col("weight")).otherwise(F.col("__old"))).drop(
        "__top", "__who", "__over", "__old", "no_weight"
    )


def reweight_once(
    lc: DataFrame, w: DataFrame, run: Sequence[str], box: float, threshold: float, bucket: float | None = None, small: Sizes = Sizes()
) -> DataFrame:
    """One round: ensemble, weather mask, scatter of every star, new weights."""
    alc = ensemble_curve(lc, w, run, small)
    marked = cut(bad_weather_mask(alc.select(*run, "jd", "nlc"), run, "jd", "nlc", box, threshold, bucket))
    share = marked.groupBy(*run).agg((F.count_if("bad") < 0.5 * F.count("*")).alias("__use"))
    # one row per time
    e = attach(marked, run, share).select(
        *run, "jd", F.col("nlc").alias("__e"), (F.col("bad") & F.col("__use")).alias("__m")
    )
    e = e if small.series else cut(e)
    rows = lc.select(*run, "star_id", "jd", "nflux").join(e, [*run, "jd"]).withColumn(
        "__d", F.when(F.col("__e") != 0, F.col("nflux") / F.col("__e"))
    )
    s = medians(
        rows, [*run, "star_id"], {"__med": F.when(F.col("__d") > 0.001, F.col("__d"))},
        F.stddev_pop(F.when(~F.col("__m"), F.col("__d"))).alias("__sd"), stored=True, whole=small.series,
    )
    sigma = F.col("__sd") / F.col("__med")
    fresh = F.when(F.col("w1") == 0, 0.0).otherwise(F.coalesce(F.when(sigma > 0, 1 / (sigma * sigma)), F.lit(0.0)))
    joined = w.join(s, [*run, "star_id"], "left").withColumn("before", F.col("weight"))
    return cut(total_weights(cut(joined.withColumn("w1", fresh).drop("__med", "__sd")), run).drop("no_weight"))


def reweight(
    lc: DataFrame,
    weights: DataFrame,
    run: Sequence[str],
    target: DataFrame | None = None,
    rounds: int = MAX_ROUNDS,
    tolerance: float = CONVERGED,
    box: float = WEATHER_BOX,
    threshold: float = WEATHER_LIMIT,
    bucket: float | None = None,
    stored: bool = False,
    small: Sizes = Sizes(),
) -> DataFrame:
    """Iterate until the mean weight change is below the tolerance.

    The state is the weight table alone.  Thousands of runs iterate together: a run that has converged leaves the
    state, and once half of the stored runs have left, the light curves of the others are written anew, so all
    rounds together read a few times the first one's rows.  One count reaches the driver per round.
    With a ``target`` curve and ``sep`` in the weights, round two first chooses the
    distance exponent.
    """
    run = list(run)

    def runs(df: DataFrame) -> int:
        return df.select(*run).distinct().count() if run else int(not df.isEmpty())

    lc = lc.select(*run, "star_id", "jd", "nflux")
    lc, live = (lc, weights) if stored else (cut(lc), cut(weights))
    settled, stored = [], runs(live)
    for i in range(1, rounds + 1):
        base = live
        if i == 2 and target is not None:
            best = cut(best_exponent(distance_sweep(lc, live, target, run, small), run))  # one row per run
            far = live.groupBy(*run).agg(F.max("sep").alias("__far"))
            swept = attach(attach(base, run, best), run, far).withColumn("w2", distance_weight("best_a", "sep", "__far"))
            base = total_weights(swept, run).drop("best_a", "best_scatter", "__far", "no_weight")
        nxt = reweight_once(lc, cut(_reset_dominated(base, run)), run, box, threshold, bucket, small)
        change = nxt.groupBy(*run).agg(F.avg(F.abs(F.col("weight") - F.col("before"))).alias("change"))
        done = F.coalesce(F.col("change") < tolerance, F.lit(False))
        nxt = cut(attach(nxt.drop("change", "done", "rounds", "before"), run, change).withColumn("done", done).withColumn("rounds", F.lit(i)))
        settled.append(nxt.where("done"))
        live = nxt.where("NOT done")
        left = runs(live)
        if not left:
            break
        if 2 * left <= stored:
            # joins on the weights leave settled runs out; from here on they are not read either
            lc, stored = cut(lc.join(live.select(*run).distinct(), run, "left_semi")), left
    for part in settled:
        live = live.unionByName(part, allowMissingColumns=True)
    return live


def best_aperture(scores: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Aperture with the smallest mean bin error x bin scatter; ties to the lower one."""
    score = F.col("mean_bin_err") * F.col("bin_rms")
    key = F.when(score.isNotNull(), F.struct(F.round(score, 12), "ap"))
    return scores.groupBy(*keys).agg(F.min_by("ap", key).alias("best_ap"), F.min(score).alias("score"))
