"""Forced photometry without stored pairs."""

import math
import random
import statistics

import pytest

from nightflux.operators import pixels as PX


def test_apertures_store_no_pairs(spark, monkeypatch):
    monkeypatch.setattr(PX, "cut", lambda df: pytest.fail("pairs were stored"))
    rng = random.Random(2)
    px = [(f, y, x, rng.uniform(1, 9)) for f in (0, 1, None) for y in range(14) for x in range(14)]
    stars = [(1, 6.2, 6.9), (2, 0.0, 13.0), (3, 400.0, 400.0)]
    p = spark.createDataFrame(px, "frame int, y int, x int, adu double")
    s = spark.createDataFrame(stars, "star_id int, sx double, sy double")
    got = {(r.frame, r.star_id): r for r in PX.aperture_photometry(p, s, ["frame"], "star_id", 0.4, (4.0, 6.0)).collect()}
    assert set(got) == {(f, k) for f in (0, 1, None) for k in (1, 2)}
    for (f, k), r in got.items():
        sx, sy = stars[k - 1][1:]
        near = [(math.hypot(x - sx, y - sy), v) for g, y, x, v in px if g == f]
        sky = statistics.median(v for d, v in near if 4 <= d <= 6)
        inside = [v for d, v in near if d <= PX.APERTURE_FACTORS[-1] * 0.4]
        if f is None:  # frames without a name have no sky to take off
            assert r.sky is None and r.aper_flux_13 == pytest.approx(sum(inside))
            continue
        assert r.sky == pytest.approx(sky) and r.aper_flux_13 == pytest.approx(sum(inside) - sky * len(inside)) and r.peak == max(inside)
