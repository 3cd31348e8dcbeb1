"""Crossmatch, look-back, names, appends and look-up edges."""

import math

import pytest
from pyspark.sql import functions as F

from nightflux.functions import naming as N
from nightflux.functions import sky as S
from nightflux.operators import append as AP
from nightflux.operators import catalogue as C
from nightflux.operators import frames as FR
from nightflux.operators import rangejoin as R
from nightflux.operators import water as W


def refs(spark, rows):
    return spark.createDataFrame([(i, float(a), float(d), None, None, None) for i, a, d in rows], "ref_id int, ref_ra double, ref_dec double, ref_pmra double, ref_pmdec double, ref_teff double")


def stars(spark, rows):
    return spark.createDataFrame([(i, float(a), float(d)) for i, a, d in rows], "id int, ra double, dec double")


def test_cone_match_limit(spark):
    lim = math.degrees(1e-5)
    got = C.crossmatch(stars(spark, [(1, 10, 0), (2, 50, 0)]), refs(spark, [(7, 10, lim * 0.999), (8, 50, lim * 1.001)]), S.EPOCH_J2016, S.EPOCH_J2016)
    assert {r["id"]: r["match"] and r["match"]["ref_id"] for r in got.collect()} == {1: 7, 2: None}


def test_match_across_zero_ra_and_near_the_pole(spark):
    s = stars(spark, [(1, 359.9999, 5.0), (2, 10.0, 89.9999), (3, 0.0001, -5.0)])
    r = refs(spark, [(7, 0.0001, 5.0), (8, 190.0, 89.9999), (9, 359.9999, -5.0)])
    got = R.nearest_within(s, r, ("ra", "dec"), ("ref_ra", "ref_dec"), "ref_id", 0.001).collect()
    assert sorted(g["match"]["ref_id"] for g in got) == [7, 8, 9]


def test_crowded_cells_and_copies_give_the_true_nearest(spark):
    import random

    random.seed(3)
    s = [(i, 100 + random.random(), 20 + random.random()) for i in range(60)] + [(100 + i, 100.5, 20.5) for i in range(40)]
    r = [(i, 100 + random.random(), 20 + random.random()) for i in range(200)]
    got = {g["ra"]: (g["match"]["ref_id"], g["sep_deg"]) for g in R.nearest_within(stars(spark, s), refs(spark, r), ("ra", "dec"), ("ref_ra", "ref_dec"), "ref_id", 2.0, fine=0.05).collect()}

    def sep(a, b):
        d1, d2 = math.radians(a[2]), math.radians(b[2])
        h = math.sin((d2 - d1) / 2) ** 2 + math.cos(d1) * math.cos(d2) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
        return math.degrees(2 * math.asin(math.sqrt(h)))

    assert len(got) == 61
    for a in s:
        assert got[a[1]][1] == pytest.approx(min(sep(a, b) for b in r))


def test_nearest_at_any_distance(spark):
    got = R.nearest_any(stars(spark, [(1, 10, 0), (2, 200, -40)]), refs(spark, [(5, 12, 0), (6, 11, 30)]), ("ra", "dec"), ("ref_ra", "ref_dec"), "ref_id", 0.01)
    assert {g["ra"]: g["match"]["ref_id"] for g in got.collect()}.keys() == {10.0, 200.0}


def test_target_match_takes_the_brightest(spark):
    df = spark.createDataFrame([("f", 9, 1, 5.0), ("f", 9, 2, 8.0), ("f", 4, 3, 1.0)], "field string, gaia int, pos int, flux double")
    got = C.target_match(df, spark.createDataFrame([(9,)], "gaia int"), ["field"], "gaia", "flux", "pos").collect()
    assert [(r["pos"], r["n_rows"], r["outcome"]) for r in got] == [(2, 2, "one")]


def nights(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_bias_look_back_takes_the_night_with_enough(spark):
    counts = nights(spark, [("20240110", 1), ("20240109", 1), ("20240105", 3), ("20230101", 9)], "date string, n long")
    ask = nights(spark, [("20240110",), ("20230420",), ("20230105",)], "date string")
    got = {r["date"]: r["cal_date"] for r in FR.look_back_single(ask, counts, 2).collect()}
    assert got == {"20240110": "20240105", "20230420": None, "20230105": "20230101"}


def test_flats_accumulate(spark):
    counts = nights(spark, [("20240110", "I", 2), ("20240109", "I", 1), ("20240107", "I", 5), ("20240101", "I", 50)], "date string, filter string, n long")
    got = FR.look_back_accumulate(nights(spark, [("20240110", "I"), ("20240110", "z")], "date string, filter string"), counts).collect()
    assert {r["filter"]: (r["first_date"], r["n_flats"]) for r in got} == {"I": ("20240107", 8), "z": (None, 0)}


def test_field_names(spark):
    df = spark.createDataFrame([("SP0501-1234_2",), ("SP0501-1234",), ("SP0501_2",)], "object string")
    assert [r[0] for r in df.select(FR.field_name()).collect()] == ["SP0501-1234", "SP0501-1234", "SP0501_2"]


def test_name_repair(spark):
    df = spark.createDataFrame([("SPC0501-1234BIS", "SP0501-1235"), ("SP0501+1234", "SP0501-1234"), ("junk", "SP0102+0304")], "n string, e string")
    assert [r[0] for r in df.select(N.repaired_name("n", "e")).collect()] == ["SP0501-1234", "SP0501-1234", "SP0102+0304"]


def test_append_is_idempotent(spark):
    old = spark.createDataFrame([(1.0, "a"), (2.0, "b")], "jd double, v string")
    new = spark.createDataFrame([(2.0, "x"), (3.0, "c")], "jd double, v string")
    once = AP.merged(old, new, ["jd"])
    assert sorted(map(tuple, AP.merged(once, new, ["jd"]).collect())) == sorted(map(tuple, once.collect())) == [(1.0, "a"), (2.0, "b"), (3.0, "c")]
    assert AP.append_action(once, new, ["jd"]).first()["action"] == "none"
    assert AP.append_action(old, new, ["jd"]).first()["action"] == "append"
    assert AP.append_action(old, new.where("jd = 3"), ["jd"]).first()["action"] == "add"
    assert AP.append_action(once, new, ["jd"], replace=True).first()["action"] == "replace"


def test_grid_lookup_on_nodes_edges_and_outside(spark):
    nodes = [(p, a, t, p + 10 * a + 100 * t) for p in (1.0, 2.0, 5.0) for a in (1.0, 3.0) for t in (10.0, 20.0, 25.0, 40.0)]
    grid = spark.createDataFrame(nodes, "pwv_mm double, airmass_x double, teff_k double, response double")
    asks = [(1.0, 1.0, 10.0), (5.0, 3.0, 40.0), (3.5, 2.0, 22.0), (0.9, 1.0, 10.0), (2.0, 1.0, 41.0)]
    df = spark.createDataFrame(asks, "p double, a double, t double")
    got = {(r["p"], r["a"], r["t"]): r["v"] for r in W.grid_lookup(df, grid, {"pwv_mm": "p", "airmass_x": "a", "teff_k": "t"}, "v").collect()}
    for p, a, t in asks[:3]:  # a linear response is reproduced exactly
        assert got[(p, a, t)] == pytest.approx(p + 10 * a + 100 * t)
    assert got[asks[3]] is None and got[asks[4]] is None


def test_blended_pairs(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.9, 0.0), (3, 5.0, 5.0), (4, 5.0, 5.0), (5, 9.0, 9.0), (6, 9.0, 10.0)], "id int, x double, y double")
    assert sorted(r["id"] for r in C.blended(df, [], "id", "x", "y", 1.0).collect()) == [1, 2, 3, 4]


def test_frame_class_needs_the_full_detector(spark):
    df = spark.createDataFrame([("Bias", None, 500, "I"), ("bias frame", None, 2048, "I"), ("FLAT", None, 500, "zYJ"), ("Light", "ENABLED", 1, "I"), ("Light", None, 1, "I"), ("Focus", None, 9999, "I")],
                               "imagetyp string, dither string, naxis1 int, filter string")
    assert [r[0] for r in df.select(FR.frame_class()).collect()] == [None, "bias", "flat", "dithered", "science", None]


def test_timezone_does_not_move_julian_dates(spark):
    from nightflux.functions.timescale import julian_date

    before = spark.conf.get("spark.sql.session.timeZone")
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-31 02:30:00' AS ts")
    try:
        values = []
        for zone in ("UTC", "America/New_York", "Europe/Paris"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            values.append(df.select(julian_date("ts")).first()[0])
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert len(set(values)) == 1 and values[0] == pytest.approx(2460400.604166667)
