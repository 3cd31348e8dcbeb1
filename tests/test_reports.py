"""Interval joins, running moments and the record ledger on small tables."""

import math
import random

import pytest
from pyspark.sql import functions as F

from nightflux.operators import report as R
from nightflux.operators.overlap import interval_moments, within_intervals
from nightflux.sources.ledger import Ledger


def test_samples_in_intervals_without_a_key(spark):
    rng = random.Random(3)
    samples = [(k, rng.choice("ab"), round(rng.uniform(0, 20), 1), None if k % 9 == 0 else rng.gauss(1e6, 2.0)) for k in range(400)]
    runs = [(k, rng.choice("ab"), a := round(rng.uniform(-2, 20), 1), a + rng.choice([0.0, 0.5, 3.0, -1.0])) for k in range(60)] + [(99, "a", 50.0, 60.0)]
    s = spark.createDataFrame(samples, "id long, tel string, t double, v double")
    i = spark.createDataFrame(runs, "run long, tel string, lo double, hi double")
    for keys in ([], ["tel"]):
        inside = {r: [x for x in samples if lo <= x[2] <= hi and (not keys or x[1] == tel)] for r, tel, lo, hi in runs}
        side = i if keys else i.withColumnRenamed("tel", "other")
        got = within_intervals(s, side, keys, "t", "lo", "hi", 0.7).select("run", "id").collect()
        assert sorted((x.run, x.id) for x in got) == sorted((r, x[0]) for r, xs in inside.items() for x in xs)
        found = {x.run: x for x in interval_moments(side, s, ["run"], keys, "t", "lo", "hi", ["v"]).collect()}
        for r, _, lo, hi in runs:
            if hi < lo:
                assert r not in found
                continue
            v = [x[3] for x in inside[r] if x[3] is not None]
            assert found[r].n == len(inside[r])
            mean = sum(v) / len(v) if v else None
            assert found[r].v_mean == (pytest.approx(mean, abs=1e-6) if v else None)
            assert found[r].v_std == (pytest.approx(math.sqrt(sum((x - mean) ** 2 for x in v) / len(v)), abs=1e-5) if v else None)


def test_moments_without_samples(spark):
    i = spark.createDataFrame([(1, 0.0, 1.0)], "run long, lo double, hi double")
    none = spark.createDataFrame([], "t double, v double")
    assert [tuple(x) for x in interval_moments(i, none, ["run"], [], "t", "lo", "hi", ["v"]).collect()] == [(1, 0, None, None)]


def test_nights_without_logs_are_unknown(spark):
    nights = spark.createDataFrame([(1,), (2,), (3,)], "night int")
    lines = spark.createDataFrame([(1, "weather", "fine", "Io"), (2, "events", "x TELESCOPE.STATUS.LIST y", "Io"), (9, "weather", "", "Io")], "night int, kind string, value string, telescope string")
    got = {x.night: (x.weather_flag, x.events_flag) for x in R.log_flags(lines, ["night"], nights=nights).collect()}
    assert got == {1: ("N", "unknown"), 2: ("unknown", "Y"), 3: ("unknown", "unknown")}
    readings = spark.createDataFrame([(1, 0.5, 1.3), (2, 0.1, 2.0), (2, 0.2, 1.2)], "night int, jd double, v double")
    assert {x.night: x.shaking for x in R.shaking_flag(readings, ["night"], "jd", "v", nights=nights).collect()} == {1: "Y", 2: "N", 3: "unknown"}


def test_ledger_of_records(spark, tmp_path):
    ledger = Ledger(spark, f"file://{tmp_path}/ledger", ["k"], ["run"])
    assert ledger.current() is None and ledger.depth() == 0
    ledger.compact()
    rows = lambda *r: spark.createDataFrame(list(r), "k long, run int, cell string")
    ledger.append(rows(*[(k, 1, "new") for k in range(1000)]))
    ledger.append(rows((3, 2, "again"), (5, 0, "late"), (None, 1, "no key")))
    assert ledger.depth() == 2
    ledger.compact()
    assert ledger.depth() == 0
    ledger.append(rows((3, 3, "third"), (2000, 1, "added")))
    got = {r.k: (r.run, r.cell) for r in ledger.current().collect()}
    assert len(got) == 1002 and got[3] == (3, "third") and got[5] == (1, "new") and got[None] == (1, "no key") and got[2000] == (1, "added")
    assert [tuple(r) for r in ledger.current("k = 3").collect()] == [(3, 3, "third")]
    # files that no manifest names, and history before the snapshot, are not read
    rows((3, 9, "lost")).write.parquet(f"file://{tmp_path}/ledger/log/lost")
    plan = ledger.current().inputFiles()
    assert not any("lost" in f for f in plan) and sum("/log/" in f for f in plan) < 9
    assert {r.k: r.cell for r in ledger.current().collect()}[3] == "third"
    with pytest.raises(Exception, match="exist"):
        ledger._commit(1, None, [], "struct<k:bigint>")
    assert ledger.current().where(F.col("k").isNull()).count() == 1


def test_products_of_many_runs_share_files(spark, tmp_path):
    import glob

    from nightflux.sources.sinks import write_products

    rows = spark.range(2400).selectExpr("int(id % 300) AS field", "int(id % 3 + 3) AS ap", "id AS jd", "id / 7.0D AS diff")
    write_products({"lightcurve": rows, "again": rows}, str(tmp_path), ["field", "ap"], ["ap"])
    for name in ("lightcurve", "again"):
        assert len(glob.glob(f"{tmp_path}/{name}/ap=*")) == 3 and len(glob.glob(f"{tmp_path}/{name}/**/*.parquet", recursive=True)) <= 24
        back = spark.read.schema(rows.schema).parquet(f"{tmp_path}/{name}")
        assert back.exceptAll(rows.select(back.columns)).isEmpty() and back.count() == 2400
