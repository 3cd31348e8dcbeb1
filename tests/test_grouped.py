"""Skew-safe group statistics against numpy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from nightflux.operators import grouped as G


def rows(spark, groups):
    return spark.createDataFrame([(k, float(v) if v is not None else None) for k, vs in groups.items() for v in vs], "k string, v double")


def test_median_matches_numpy_with_hot_group_and_ties(spark):
    rng = np.random.default_rng(1)
    groups = {"hot": rng.normal(size=20001), "even": rng.normal(size=10), "ties": [3.0] * 50 + [4.0] * 50, "one": [7.0], "two": [1.0, 2.0],
              "heavy": np.repeat([1.0, 2.0, 9.0], [500, 2, 499])}
    got = {r["k"]: r["m"] for r in G.medians(rows(spark, groups), ["k"], {"m": "v"}).collect()}
    for k, v in groups.items():
        assert got[k] == pytest.approx(float(np.median(v)), abs=0), k


def test_median_skips_null_and_keeps_empty_groups(spark):
    got = {r["k"]: r["m"] for r in G.medians(rows(spark, {"a": [1, 2, None, 10, 3, 4], "n": [None, None]}), ["k"], {"m": "v"}).collect()}
    assert got == {"a": 3.0, "n": None}


def test_medians_of_values_that_differ_from_reading_to_reading(spark):
    # as sums of doubles on a cluster do, whose rows arrive in any order
    draw = F.udf(lambda v: v + random.random() * 1e-3, "double").asNondeterministic()
    df = spark.range(4000).select((F.col("id") % 4).alias("k"), draw("id").alias("v"), F.lit(1).alias("w"))
    assert G.medians(df, ["k"], {"m": "v"}).where("m > 0").count() == 4
    assert G.medians(df, ["k"], {"m": "v"}, F.count("w").alias("n")).where("m > 0 AND n = 1000").count() == 4
    middle = G.normalise(df, ["k"], "v", "n", floor=None).groupBy("k").agg(F.median("n").alias("m")).collect()
    assert [r["m"] for r in middle] == pytest.approx([1.0] * 4, abs=1e-12)
    assert G.sigma_clip(df, ["k"], "v", "c").where("c IS NULL").count() == 0


def test_several_medians_and_extra_aggregates_without_keys(spark):
    df = spark.range(101).select(F.col("id").cast("double").alias("v"))
    r = G.medians(df, [], {"a": "v", "b": F.col("v") * 2}, F.count("*").alias("n")).first()
    assert (r["a"], r["b"], r["n"]) == (50.0, 100.0, 101)


def test_normalise_ignores_low_values_in_the_median_only(spark):
    got = G.normalise(rows(spark, {"a": [0.0, -1.0, 2.0, 4.0, None]}), ["k"], "v", "n").collect()
    assert sorted((r["v"], r["n"]) for r in got if r["v"] is not None) == [(-1.0, -1 / 3), (0.0, 0.0), (2.0, 2 / 3), (4.0, 4 / 3)]
    assert [r["n"] for r in got if r["v"] is None] == [None]


def clip_by_hand(values, k, rounds=None):
    a = np.array(values, float)
    while rounds is None or rounds > 0:
        keep = np.abs(a - np.median(a)) <= k * a.std()
        if keep.all():
            break
        a = a[keep]
        rounds = None if rounds is None else rounds - 1
    return sorted(a)


@pytest.mark.parametrize("limit", [None, 1, 5])
def test_interval_clip_equals_the_loop(spark, limit):
    rng = np.random.default_rng(2)
    groups = {"a": np.concatenate([rng.normal(size=300), [50, 60, -70, 8]]), "b": np.concatenate([rng.exponential(size=200), [30.0]]), "c": [5.0] * 9}
    got = G.sigma_clip(rows(spark, groups), ["k"], "v", "c", sigma=3.0, max_rounds=limit).where("c IS NOT NULL").collect()
    for k, v in groups.items():
        assert sorted(r["c"] for r in got if r["k"] == k) == pytest.approx(clip_by_hand(v, 3.0, limit)), k


def test_constant_data_is_never_clipped(spark):
    assert G.sigma_clip(rows(spark, {"a": [2.0] * 5}), ["k"], "v", "c").where("c IS NULL").count() == 0


@pytest.mark.parametrize("limit", [None, 1, 5])
def test_array_clip_equals_the_loop(spark, limit):
    rng = np.random.default_rng(3)
    vs = [float(x) for x in np.concatenate([rng.normal(size=40), [9, -12, 30, 5.5]])]
    df = spark.createDataFrame([(vs,), ([1.0],), ([2.0, 2.0],)], "a array<double>")
    got = [r[0] for r in df.select(G.array_clip(F.sort_array("a"), 3.0, limit)).collect()]
    assert got[0] == pytest.approx(clip_by_hand(vs, 3.0, limit)) and got[1:] == [[1.0], [2.0, 2.0]]


def test_clip_is_monotone(spark):
    rng = np.random.default_rng(4)
    df = rows(spark, {"a": np.concatenate([rng.normal(size=200), rng.normal(scale=20, size=20)])})
    kept = [G.sigma_clip(df, ["k"], "v", "c", sigma=3.0, max_rounds=n).where("c IS NOT NULL").count() for n in (1, 2, 5, None)]
    assert kept == sorted(kept, reverse=True)
