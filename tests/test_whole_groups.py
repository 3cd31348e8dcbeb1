"""Groups that fit a task are read in one piece; all ways give the same values."""

import math

import numpy as np
from pyspark.sql import functions as F
from test_photometry import field

from nightflux.operators import ensemble as E
from nightflux.operators import grouped as G
from nightflux.operators.lightcurve import scatter, time_bin_number
from nightflux.operators.water import ensemble_teff
from nightflux.plans.differential import Settings, differential_photometry


def odd_rows(spark, n=900):
    """Groups of several sizes, one without values, NULL values, NULL keys, repeated rows."""
    rng = np.random.default_rng(11)
    rows = [(int(k) if k < 7 else None, float(t), float(v) if v > -0.8 else None) for k, t, v in zip(rng.integers(0, 8, n), rng.integers(0, 60, n), rng.normal(1, 1, n))]
    rows += [(9, 1.0, None), (9, 2.0, None), (10, 3.0, 5.0), (0, 1.0, 400.0), (0, 1.0, 400.0)]
    return spark.createDataFrame(rows, "k int, t double, v double")


def table(df):
    got = [tuple(None if x is None else round(x, 9) if isinstance(x, float) else x for x in r) for r in df.select(*sorted(df.columns)).collect()]
    return sorted(got, key=repr)


def test_whole_groups_have_the_same_statistics(spark):
    df = odd_rows(spark)
    extra = F.stddev_pop("v").alias("s"), F.count("*").alias("n")
    for keys in (["k"], []):
        assert table(G.medians(df, keys, {"m": "v", "u": F.col("v") * 2}, *extra, whole=True)) == table(G.medians(df, keys, {"m": "v", "u": F.col("v") * 2}, *extra))
    assert table(G.normalise(df, ["k"], "v", "n", whole=True)) == table(G.normalise(df, ["k"], "v", "n"))
    assert table(G.sigma_clip(df, ["k"], "v", "c", sigma=1.8, max_rounds=None, whole=True)) == table(G.sigma_clip(df, ["k"], "v", "c", sigma=1.8, max_rounds=None))
    assert table(time_bin_number(df, ["k"], "t", 7.0, whole=True)) == table(time_bin_number(df, ["k"], "t", 7.0))
    assert table(scatter(df, ["k"], "t", "v", 7.0, whole=True)) == table(scatter(df, ["k"], "t", "v", 7.0))


def test_whole_groups_are_moved_once(spark):
    df = odd_rows(spark)
    plan = G.normalise(df, ["k"], "v", "n", whole=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_fullest_group_decides(spark, monkeypatch):
    df = odd_rows(spark)
    most = max(r["count"] for r in df.groupBy("k").count().collect())
    monkeypatch.setattr(G, "GROUP_ROWS", most)
    assert G.fits(df, ["k"]) and not G.fits(df, [])
    monkeypatch.setattr(G, "GROUP_ROWS", most - 1)
    assert not G.fits(df, ["k"])


def test_a_settled_group_is_not_clipped_again(spark, monkeypatch):
    # group 0 settles at once, group 1 loses one value a round
    rows = [(0, float(i % 5)) for i in range(40)] + [(1, float(i % 5)) for i in range(200)] + [(1, v) for v in (30.0, 300.0, 3000.0)]
    kept, states = G.cut, []
    monkeypatch.setattr(G, "cut", lambda df: states.append(kept(df)) or states[-1])
    got = {r["k"]: (r["lo"], r["hi"]) for r in G.clip_bounds(spark.createDataFrame(rows, "k int, v double"), ["k"], "v", sigma=3.0, max_rounds=None).collect()}
    assert got == {0: (0.0, 4.0), 1: (0.0, 4.0)}
    rounds = [s.count() for s in states if "changed" in s.columns]
    assert len(rounds) > 2 and rounds[0] == 2 and set(rounds[1:]) == {1}


def curves(spark, times=30):
    rng = np.random.default_rng(3)
    rows = [(r, s, float(t), float(1 + 0.01 * s * rng.normal()) if (s + t) % 17 else None) for r in ("a", "b") for s in range(30) for t in range(times)]
    rows += [("a", s, None, 1.0) for s in range(30)] + [("a", 3, 4.0, 1.01), (None, 4, 2.0, 1.0), ("b", None, 2.0, 1.0)]
    lc = spark.createDataFrame(rows, "run string, star_id int, jd double, nflux double")
    stars = spark.createDataFrame([(r, s, 12 + s / 10, 100.0 / (1 + s), 1.0, 1.0, 0.001 * (1 + s), False, False) for r in ("a", "b") for s in range(30)],
                                  "run string, star_id int, mag double, w1 double, w2 double, w3 double, sep double, saturated boolean, lowflux boolean")
    return lc, stars


ALL = E.Sizes(True, True, True)


def test_magnitude_sweep_stores_a_row_for_each_time(spark, monkeypatch):
    lc, stars = curves(spark)
    target = stars.where("star_id = 2").select("run", F.col("mag").alias("target_mag"))
    limits = E.magnitude_cuts(stars, target, ["run"])
    kept, stored = E.cut, []
    monkeypatch.setattr(E, "cut", lambda df: stored.append(kept(df)) or stored[-1])
    once = table(E.magnitude_sweep(lc, stars, limits, ["run"], 5.0, 4.0, 0.5, small=ALL))
    assert len(once) == 100 and stored and max(s.count() for s in stored) <= 61
    assert once == table(E.magnitude_sweep(lc, stars, limits, ["run"], 5.0, 4.0, 0.5))


def test_distance_sweep_and_preclean_are_the_same_in_one_piece(spark):
    lc, stars = curves(spark)
    target = lc.where("star_id = 2").select("run", "jd", "nflux")
    assert table(E.distance_sweep(lc, stars, target, ["run"], ALL)) == table(E.distance_sweep(lc, stars, target, ["run"]))
    assert table(E.preclean(lc, stars, ["run"], stored=True, small=ALL)) == table(E.preclean(lc, stars, ["run"]))
    assert table(E.ensemble_curve(lc, stars.withColumn("weight", F.col("w1")), ["run"], ALL)) == table(E.ensemble_curve(lc, stars.withColumn("weight", F.col("w1")), ["run"]))


def test_the_whole_job_is_the_same_in_one_piece(spark, monkeypatch):
    lc, frames, stars, targets = field(spark, variable=5)
    how = Settings(bin_width=0.05, rounds=2, weather_limit=0.3)
    asked, known = [], E.fits
    monkeypatch.setattr(E, "fits", lambda df, keys: asked.append(list(keys)) or known(df, keys))
    one = differential_photometry(lc, frames, stars, targets, ["ap"], how)
    assert asked == [["ap", "star_id"], ["ap", "jd"], []]
    monkeypatch.setattr(E, "fits", lambda df, keys: False)
    other = differential_photometry(lc, frames, stars, targets, ["ap"], how)
    for name, keys in (("target", ["ap", "jd"]), ("weights", ["ap", "star_id"]), ("scores", ["ap", "star_id"]), ("ensemble", ["ap", "jd"]), ("lightcurve", ["ap", "star_id", "jd"])):
        a, b = (getattr(p, name).orderBy(*keys).collect() for p in (one, other))
        assert len(a) == len(b)
        for x, y in zip(a, b):
            assert all(u == v or math.isclose(u, v, rel_tol=1e-8) for u, v in zip(x, [y[c] for c in x.__fields__]))


def test_rounding_keeps_the_ensemble_between_its_stars(spark):
    rng = np.random.default_rng(5)
    rows = [(r, 5000.0, float(w)) for r in range(200) for w in rng.random(30)] + [(200, 4000.0, -1.0), (200, 5000.0, 2.0)]
    got = {r["run"]: r["ensemble_teff"] for r in ensemble_teff(spark.createDataFrame(rows, "run int, teff double, weight double"), ["run"]).collect()}
    assert got.pop(200) == 6000.0 and set(got.values()) == {5000.0}
