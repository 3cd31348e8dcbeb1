"""Joins that must not grow faster than their tables."""

from pyspark.sql import functions as F

from nightflux.operators import registry as R
from nightflux.operators import structure as ST
from nightflux.operators import water as W


def test_a_name_registered_many_times_counts_once_and_finds_any_length(spark):
    names = ["NEW BUILDING 1", "OLD SHED", "AB", "X", "BUILDING"]
    targets = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, id long")
    rows = [("BUILDING", None, p) for p in range(500, 3500)] + [("LDI", None, 4000), ("SHE", 77, 2), ("AB", None, 3), (None, 3, 9), ("W B", None, 100)]
    registry = spark.createDataFrame(rows, "reg_name string, reg_id long, pos long")
    found = R.registered(targets, registry)
    got = {r["name"]: (r["already_run"], r["run_name"]) for r in found.collect()}
    assert got == {"NEW BUILDING 1": (True, "W B"), "OLD SHED": (True, "SHE"), "AB": (True, "AB"), "X": (True, "X"), "BUILDING": (True, "BUILDING")}
    # the table of names that substrings meet holds each once
    stored = [f for f in found.inputFiles() if "/cut-" in f]
    assert stored and spark.read.parquet(*stored).count() == 5


def test_integral_does_not_shuffle_its_samples(spark):
    samples = spark.range(300).select((F.col("id") % 3).alias("k"), F.floor(F.col("id") / 3).alias("i"), F.lit(1.0).alias("v"))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = W.spectral_integral(samples, ["k"], "i", 0.5, "v", "s")
        assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()
        assert [round(r["s"], 9) for r in out.collect()] == [49.5] * 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_fits_of_few_runs_do_not_move_their_rows(spark):
    rows = spark.range(3000).select((F.col("id") % 3).alias("run"), (1 + F.col("id") % 7).cast("double").alias("x")).withColumn("y", 2 * F.col("x") + 5)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for fit in (ST.weighted_line(rows, ["run"], "x", "y", F.lit(1.0)), ST.parabola(rows, ["run"], "x", "y")):
            assert "SortMergeJoin" not in fit._jdf.queryExecution().executedPlan().toString()
        assert [(round(r["slope"], 9), round(r["intercept"], 9)) for r in ST.weighted_line(rows, ["run"], "x", "y", F.lit(1.0)).collect()] == [(2.0, 5.0)] * 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
