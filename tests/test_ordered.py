"""Bucketed windows, running sums, as-of alignment and segmentation against plain loops."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from nightflux.operators import asof as A
from nightflux.operators import ordered as O
from nightflux.operators import water as W


def series(spark, t, y=None, key="s"):
    y = t if y is None else y
    return spark.createDataFrame([(key, float(a), float(b)) for a, b in zip(t, y)], "k string, t double, y double")


def test_running_sums_and_numbers_across_pieces(spark):
    df = spark.range(1000).select((F.col("id") % 3 == 0).cast("int").alias("k"), F.col("id").alias("o"), F.lit(2.0).alias("v"))
    got = O.running(df, ["k"], ["o"], {"cum": "v"}, number="n", pieces=7).collect()
    for k in (0, 1):
        part = sorted((r for r in got if r["k"] == k), key=lambda r: r["o"])
        assert [r["n"] for r in part] == list(range(1, len(part) + 1))
        assert [r["cum"] for r in part] == [2.0 * (i + 1) for i in range(len(part))]


def test_global_numbers(spark):
    df = spark.range(500).select((F.col("id") * 37 % 500).alias("o"))
    assert sorted((r["o"], r["pos"]) for r in O.numbered(df, ["o"], pieces=6).collect()) == [(i, i) for i in range(500)]


@pytest.mark.parametrize("width", [0.3, 1.0, 50.0])
def test_interpolation_matches_numpy_for_any_bucket(spark, width):
    rng = np.random.default_rng(5)
    t = np.sort(rng.uniform(0, 20, 60))
    y = np.sin(t)
    q = np.concatenate([rng.uniform(-1, 21, 80), t[:5]])
    got = {r["t"]: r["v"] for r in A.interpolate(series(spark, t, y), series(spark, q).select("k", "t"), ["k"], "t", "y", "v", width).collect()}
    inside = np.interp(q, t, y)
    for a, b in zip(q, inside):
        if a < t[0]:
            b = y[0] + (y[1] - y[0]) * (a - t[0]) / (t[1] - t[0])
        elif a > t[-1]:
            b = y[-2] + (y[-1] - y[-2]) * (a - t[-2]) / (t[-1] - t[-2])
        assert got[float(a)] == pytest.approx(b)


def test_index_interpolation_ends(spark):
    got = {r["t"]: r["v"] for r in A.interpolate_index(series(spark, [1, 2], [10, 20]), series(spark, [0, 1.5, 3]).select("k", "t"), ["k"], "t", "y", "v").collect()}
    assert got == {0.0: None, 1.5: 15.0, 3.0: 20.0}


def test_nearest_tie_goes_to_the_earlier(spark):
    got = A.nearest(series(spark, [1, 3], [10, 30]), series(spark, [2.0, 2.1, 0.0, 9.0]).select("k", "t"), ["k"], "t", "y", "v").collect()
    assert {r["t"]: r["v"] for r in got} == {2.0: 10.0, 2.1: 30.0, 0.0: 10.0, 9.0: 30.0}


def test_no_window_reads_a_bucket_to_its_end_for_every_row(spark):
    s = series(spark, range(20))
    found = A.interpolate(s, s.select("k", "t"), ["k"], "t", "y", "v")
    plan = found._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "unboundedpreceding" in plan and "unboundedfollowing" not in plan


def test_interpolation_past_repeated_ends(spark):
    s = series(spark, [1, 1, 2, 2, 2, 4, 4], [10, 10, 20, 20, 20, 30, 30])
    got = A.interpolate(s, series(spark, [0, 1, 3, 4, 6]).select("k", "t"), ["k"], "t", "y", "v").collect()
    assert {r["t"]: r["v"] for r in got} == {0.0: 0.0, 1.0: 10.0, 3.0: 25.0, 4.0: 30.0, 6.0: 40.0}


@pytest.mark.parametrize("width", [0.5, 3.0, 100.0])
def test_rolling_deviation_for_any_bucket(spark, width):
    rng = np.random.default_rng(6)
    t, y = np.sort(rng.uniform(0, 30, 200)), rng.normal(size=200)
    got = {r["t"]: r["s"] for r in O.rolling_std(series(spark, t, y), ["k"], "t", "y", "s", 0.5, width).collect()}
    assert len(got) == 200
    for a in t:
        assert got[float(a)] == pytest.approx(y[np.abs(t - a) <= 0.5].std(), abs=1e-9)


def test_night_segments(spark):
    got = O.segments(series(spark, [0, 0.3, 0.6, 0.9, 1.2]), ["k"], "t", 0.5, "seg").orderBy("t").collect()
    assert [r["seg"] for r in got] == [0, 0, 1, 1, 2]


def test_long_segments_match_the_loop(spark):
    rng = np.random.default_rng(7)
    t = np.sort(rng.uniform(0, 15, 120))
    want, anchor, n = [], t[0], 0
    for a in t:
        if a - anchor > 0.5:
            anchor, n = a, n + 1
        want.append(n)
    got = O.segments(series(spark, t), ["k"], "t", 0.5, "seg").orderBy("t").collect()
    assert [r["seg"] for r in got] == want


def test_smoothing_keeps_a_constant_and_reflects(spark):
    got = O.gaussian_smooth(series(spark, range(7), [2.0] * 7), ["k"], "t", "y", "s").collect()
    assert all(r["s"] == pytest.approx(2.0) for r in got) and len(got) == 7


@pytest.mark.parametrize("n", [1, 3, 19, 45, 130])
def test_smoothing_matches_the_loop_over_buckets(spark, monkeypatch, n):
    monkeypatch.setattr(O, "SMOOTH_ROWS", 25)
    y = np.random.default_rng(n).normal(size=n)
    got = [r["s"] for r in O.gaussian_smooth(series(spark, range(n), y), ["k"], "t", "y", "s").orderBy("t").collect()]
    k = np.exp(-0.5 * (np.arange(-20, 21) / 5.0) ** 2)
    padded = np.pad(y, 20, mode="symmetric")
    assert got == pytest.approx(list(np.convolve(padded, k / k.sum(), mode="valid")))


def test_peaks_and_their_neighbours_go(spark):
    got = W.remove_peaks(series(spark, range(7), [1, 1, 1, 9, 1, 1, 1]), ["k"], "t", "y", prominence=3.0).collect()
    assert sorted(r["t"] for r in got) == [0.0, 1.0, 5.0, 6.0]


def test_first_per_time(spark):
    df = spark.createDataFrame([("a", 1.0, 2), ("a", 1.0, 1), ("a", 2.0, 5)], "k string, t double, o int")
    assert sorted(r["o"] for r in O.first_per_time(df, ["k"], "t", ["o"]).collect()) == [1, 5]


def test_crowded_buckets_are_narrowed_without_changing_results(spark, monkeypatch):
    rng = np.random.default_rng(9)
    t, y = np.sort(rng.uniform(0, 5, 150)), rng.normal(size=150)
    probes = series(spark, rng.uniform(0, 5, 60)).select("k", "t")
    wide = A.interpolate(series(spark, t, y), probes, ["k"], "t", "y", "v", 10.0).orderBy("t").collect()
    monkeypatch.setattr(O, "BUCKET_ROWS", 8)
    assert O.fitted_width(series(spark, t), ["k"], "t", 10.0) < 1.0
    assert O.fitted_width(series(spark, [1.0] * 20), ["k"], "t", 10.0) > 0  # copies cannot be told apart by time
    narrow = A.interpolate(series(spark, t, y), probes, ["k"], "t", "y", "v", 10.0).orderBy("t").collect()
    rolled = {r["t"]: r["s"] for r in O.rolling_std(series(spark, t, y), ["k"], "t", "y", "s", 0.25, 10.0).collect()}
    assert [r["v"] for r in narrow] == pytest.approx([r["v"] for r in wide])
    assert len(rolled) == 150 and all(rolled[float(a)] == pytest.approx(y[np.abs(t - a) <= 0.25].std(), abs=1e-9) for a in t)
