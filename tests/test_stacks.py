"""Stacks against a plain clip."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from nightflux.operators import calibration as C


def clipped_median(values, sigma=3.0):
    kept = sorted(values)
    while kept:
        m, s = statistics.median(kept), statistics.pstdev(kept)
        inside = [v for v in kept if abs(v - m) <= sigma * s]
        if len(inside) == len(kept):
            return m
        kept = inside
    return None


def test_stacks_with_and_without_outliers(spark):
    rng = random.Random(8)
    stacks = {
        0: [10.0] * 9, 1: [10.0] * 20 + [90.0], 2: [float(k) for k in range(30)], 3: [1.0, 2.0, 3.0, 4.0, 500.0], 4: [None] * 4,
        # the last value lies on the limit: 9 zeros and 1 give a deviation of 0.3, beyond it after the first round of 5
        5: [0.0] * 9 + [1.0], 6: [rng.gauss(0, 1) for _ in range(48)] + [30.0, -200.0], 7: [0.0] * 40 + [1.0] * 4 + [300.0],
    }
    rows = [("R", f, 0, x, v) for x, vs in stacks.items() for f, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "filter string, frame int, y int, x int, v double")
    got = {r.x: r.m for r in C.stack_clipped(df, ["filter"], "v", "m").collect()}
    for x, vs in stacks.items():
        want = clipped_median([v for v in vs if v is not None])
        assert got[x] == (None if want is None else pytest.approx(want)), x


def test_stacks_without_outliers_do_not_reach_the_array_clip(spark, monkeypatch):
    monkeypatch.setattr(C, "array_clip", lambda a, *_: F.transform(a, lambda v: F.raise_error(F.lit("clipped")).cast("double")))
    df = spark.createDataFrame([("R", f, 0, 0, float(f % 5)) for f in range(40)], "filter string, frame int, y int, x int, v double")
    assert [r.m for r in C.stack_clipped(df, ["filter"], "v", "m").collect()] == [2.0]
