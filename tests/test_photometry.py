"""Ensemble photometry: edges, properties and planted signals."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from nightflux.functions import photometry as P
from nightflux.operators import ensemble as E
from nightflux.operators import lightcurve as L
from nightflux.plans.differential import Settings, differential_photometry, finish


def value(spark, col):
    return spark.range(1).select(col).first()[0]


def test_binning_edges(spark):
    df = spark.createDataFrame([("a", 0.0, 1.0), ("a", 1.0, 3.0), ("a", 1.5, 5.0), ("a", 9.0, 7.0), ("a", 9.2, None)], "k string, t double, y double")
    got = {r["bin"]: r for r in L.time_bin(df, ["k"], "t", "y", 1.0).collect()}
    assert sorted(got) == [1, 2, 9]  # a sample on t0 + b belongs to the earlier bin; no empty bins
    assert got[1]["bin_y"] == 2.0 and got[1]["bin_err"] == pytest.approx(1.253 * 1.0 / math.sqrt(2))
    assert got[2]["bin_err"] == 0.0 and got[9]["n"] == 1


def test_all_missing_frame_is_zero_in_the_ensemble(spark):
    lc = spark.createDataFrame([(1, 0.0, 1.0), (2, 0.0, 1.0), (1, 1.0, None), (2, 1.0, None)], "star_id int, jd double, nflux double")
    w = spark.createDataFrame([(1, 0.5), (2, 0.5)], "star_id int, weight double")
    got = {r["jd"]: (r["alc"], r["nlc"]) for r in E.ensemble_curve(lc, w, []).collect()}
    assert got == {0.0: (1.0, 1.0), 1.0: (0.0, 0.0)}


def test_weights_sum_to_one_and_zero_weights_are_flagged(spark):
    w = spark.createDataFrame([("r", 1, 2.0, 1.0, 1.0), ("r", 2, 3.0, 4.0, 1.0), ("z", 1, 0.0, 1.0, 1.0)], "run string, star_id int, w1 double, w2 double, w3 double")
    got = E.total_weights(w, ["run"]).collect()
    assert sum(r["weight"] for r in got if r["run"] == "r") == pytest.approx(1.0)
    assert [(r["weight"], r["no_weight"]) for r in got if r["run"] == "z"] == [(0.0, True)]


def test_saturation_limit(spark):
    rows = [(s, float(t), 5000.0, p, 1.0) for s, p in ((1, 62000.0), (2, 62001.0)) for t in range(5)] + [(3, float(t), 50.0, 10.0, 1.0) for t in range(5)]
    lc = spark.createDataFrame(rows, "star_id int, jd double, flux double, peak double, exp double")
    got = {r["star_id"]: (r["saturated"], r["lowflux"]) for r in L.quality_flags(lc, ["star_id"], "exp").collect()}
    assert got == {1: (False, False), 2: (True, False), 3: (False, True)}


def test_ellipticity_edges(spark):
    df = spark.createDataFrame([(2.0, 1.0), (1.0, 2.0), (0.0, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(P.ellipticity("a", "b")).collect()] == [pytest.approx(math.sqrt(0.75)), 0.0, 0.0]
    assert [r[0] for r in df.select(P.ellipticity_or_null("a", "b")).collect()][1:] == [None, None]


def test_aperture_radii(spark):
    assert value(spark, P.aperture_radius(F.lit(6), F.lit(4.0))) == pytest.approx(11.3137085)
    assert value(spark, P.aperture_radius(F.lit(14), F.lit(4.0))) is None


def test_best_aperture_tie_goes_to_the_lower(spark):
    df = spark.createDataFrame([("t", 5, 1.0, 2.0), ("t", 4, 2.0, 1.0), ("t", 6, None, 1.0)], "target string, ap int, mean_bin_err double, bin_rms double")
    assert E.best_aperture(df, ["target"]).first()["best_ap"] == 4


def field(spark, variable=None, depth=0.05):
    """40 stars x 60 times in two runs; star 0 has a transit, one star may vary."""
    rng = np.random.default_rng(8)
    rows, sky = [], 1 + 0.1 * np.sin(np.arange(60) / 7.0)
    for ap in (3, 4):
        for s in range(40):
            level = 20000.0 / (1 + s % 7)
            for t in range(60):
                f = level * sky[t] * (1 + 0.002 * rng.normal())
                if s == 0 and 25 <= t < 35:
                    f *= 1 - depth
                if s == variable:
                    f *= 1 + 0.5 * math.sin(t)
                rows.append((ap, s, 2459000.0 + t * 0.01, float(f), 3000.0))
    lc = spark.createDataFrame(rows, "ap int, star_id int, jd double, flux double, peak double")
    frames = lc.select("jd").distinct().select("jd", *[F.lit(v).alias(n) for n, v in (("exptime", 10.0), ("gain", 1.1), ("airmass", 1.2), ("sky", 100.0), ("ron", 6.0), ("height", 2390.0))])
    stars = spark.createDataFrame([(s, 0.001 * s, 0.0005 * s) for s in range(40)], "star_id int, ra double, dec double")
    return lc, frames, stars, lc.where("star_id = 0").select("ap", "star_id").distinct()


def test_planted_transit_survives_and_variable_star_loses_weight(spark):
    lc, frames, stars, targets = field(spark, variable=5)
    p = differential_photometry(lc, frames, stars, targets, ["ap"], Settings(bin_width=0.05, rounds=4, weather_limit=0.3))
    got = p.target.toPandas()
    for ap in (3, 4):
        one = got[got.ap == ap].sort_values("jd").reset_index()
        assert len(one) == 60 and one["diff"][25:35].mean() == pytest.approx(0.95, abs=0.01)
        assert one["diff"].drop(range(25, 35)).std() < 0.01 and (one["error"] > 0).all()
    w = p.weights.toPandas()
    for ap in (3, 4):
        one = w[w.ap == ap]
        assert one.weight.sum() == pytest.approx(1.0) and one[one["rank"] == 1].star_id.item() == 0
        assert one[one.star_id == 5].weight.item() < 0.2 * one[one.star_id == 12].weight.item() + 1e-6


def test_finish_corrects_water_and_chooses_an_aperture(spark, tmp_path):
    lc, frames, stars, targets = field(spark, depth=0.0)
    water = 1 + 4 * (F.col("jd") - 2459000.0)
    # the target (3000 K) loses 1 % a mm of water, the others (5000 K) nothing; aperture 4 is noisier
    loss = F.when(F.col("star_id") == 0, 1 - 0.01 * water).otherwise(1.0) * F.when(F.col("ap") == 4, 1 + 0.02 * F.sin(F.col("jd") * 1e5)).otherwise(1.0)
    loss = F.when((F.col("star_id") == 0) | (F.col("ap") == 3), loss).otherwise(1.0)
    lc = lc.withColumn("flux", F.col("flux") * loss)
    frames = frames.withColumn("telescope", F.lit("Io"))
    stars = stars.withColumn("teff", F.when(F.col("star_id") == 0, 3000.0).otherwise(5000.0))
    pwv = lc.select("jd").distinct().withColumn("pwv", water)
    grid = spark.createDataFrame([(float(w), a, t, 1 - 0.01 * w if t == 3000.0 else 1.0) for w in range(9) for a in (1.0, 2.0) for t in (3000.0, 5000.0)], "pwv_mm double, airmass_x double, teff_k double, response double")
    p = differential_photometry(lc, frames.drop("telescope"), stars, targets, ["ap"], Settings(bin_width=0.05, rounds=4, weather_limit=0.3))
    out = finish(p, frames, stars, pwv, grid, ["ap"], f"file://{tmp_path}/products")
    got = out["corrected"].toPandas()
    one = got[got.ap == 3].sort_values("jd")
    assert len(got) == 120 and set(got.guard) == {"ok"}
    assert abs(np.polyfit(one.jd - 2459000, one["diff"], 1)[0]) > 0.03 and abs(np.polyfit(one.jd - 2459000, one.corrected, 1)[0]) < 0.006
    assert [(r.star_id, r.best_ap, r.best_ap_pwv) for r in out["best"].collect()] == [(0, 3, 3)]
    assert out["lightcurve"].where("error > 0 AND diff > 0").count() == 2 * 40 * 60 and out["weights"].count() == 80
    assert out["catalogue"].where("rank = 1").select("star_id", "is_target").distinct().collect() == [(0, True)]
    assert out["images"].count() == out["ensemble"].count() == out["flags"].where("no_water = 0").count() == out["water"].count() == 120


def test_runs_leave_the_iteration_and_keep_their_weights(spark):
    rng = np.random.default_rng(4)
    rows = []
    for run, noise in (("a", 0.001), ("b", 0.02), ("c", 0.05)):
        for s in range(8):
            rows += [(run, s, float(t), float(1 + noise * (1 + s) * rng.normal())) for t in range(40)]
    lc = spark.createDataFrame(rows, "run string, star_id int, jd double, nflux double")
    w = lc.select("run", "star_id").distinct().withColumns({c: F.lit(1.0) for c in ("w1", "w2", "w3", "w1_start")})
    w = E.total_weights(w, ["run"]).drop("no_weight")
    how = dict(rounds=12, tolerance=0.004, box=4.0, threshold=0.5, bucket=20.0)
    whole = {(r.run, r.star_id): (r.weight, r.rounds) for r in E.reweight(lc, w, ["run"], **how).collect()}
    for run in "b":
        alone = E.reweight(lc.where(F.col("run") == run), w.where(F.col("run") == run), ["run"], **how).collect()
        assert len(alone) == 8 and all(whole[run, r.star_id] == (pytest.approx(r.weight), r.rounds) for r in alone)
    assert len({n for _, n in whole.values()}) > 1  # they leave in different rounds


def test_water_series_without_keys_serves_every_run(spark):
    from nightflux.operators.water import water_at

    pwv = spark.createDataFrame([(t / 10, 1.0 + t) for t in range(100)], "jd double, pwv double")
    target = spark.createDataFrame([("a", 2.05 + k / 10) for k in range(5)] + [("b", 9.5 + k / 10) for k in range(8)] + [("c", 50.0)], "run string, jd double")
    got = {(r.run, round(r.jd, 2)): r.pwv for r in water_at(target, pwv, ["run"], "jd").collect()}
    keyed = pwv.crossJoin(target.select("run").distinct())
    assert got == {(r.run, round(r.jd, 2)): r.pwv for r in water_at(target, keyed, ["run"], "jd").collect()}
    assert got["a", 2.05] == pytest.approx(21.5) and got["b", 9.9] == pytest.approx(100.0) and got["b", 10.0] is None and got["c", 50.0] is None


def test_a_run_without_comparison_stars_has_no_values(spark):
    lc, frames, stars, targets = field(spark)
    lc = lc.withColumn("peak", F.when((F.col("ap") == 4) & (F.col("star_id") > 0), 90000.0).otherwise(F.col("peak")))
    p = differential_photometry(lc, frames, stars, targets, ["ap"], Settings(bin_width=0.05, rounds=3, weather_limit=0.3))
    got = {r.ap: (r.n, r.d) for r in p.target.groupBy("ap").agg(F.count("*").alias("n"), F.count("diff").alias("d")).collect()}
    assert got == {3: (60, 60), 4: (60, 0)}


def test_ensemble_is_scale_invariant(spark):
    lc, *_ = field(spark)
    n = lc.where("ap = 3").withColumn("nflux", F.col("flux") / 1000)
    w = n.select("star_id").distinct().withColumn("weight", F.lit(1 / 40))
    a = {r["jd"]: r["nlc"] for r in E.ensemble_curve(n, w, []).collect()}
    b = {r["jd"]: r["nlc"] for r in E.ensemble_curve(n, w.withColumn("weight", F.col("weight") * 10), []).collect()}
    assert all(a[k] == pytest.approx(b[k]) for k in a)


def test_cloud_is_flagged(spark):
    df = spark.createDataFrame([("a", i * 0.001, 1.0 if i < 50 or i % 2 else 0.6) for i in range(100)], "k string, t double, y double")
    got = {r["t"]: r["bad"] for r in L.bad_weather_mask(df, ["k"], "t", "y").collect()}
    assert not got[0.01] and got[0.08]
