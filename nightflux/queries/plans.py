"""Whole jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import bindings as B
from ..functions import naming as N
from ..plans.calibrate import calibrate
from ..plans.identity import identify
from ..plans.inventory import inventory
from ..session import cut
from .frames_calibration import FC, FLAT
from .lightcurves import clip_sql
from .registry import query, r, with_


@query("c03_inventory_checks", "A01", FC + """, c AS (SELECT date, count_if(class = 'science') AS QC1, count_if(class = 'bias') AS QC2, count_if(class = 'dark') AS QC3, count_if(class = 'flat') AS QC4
  FROM classed WHERE class IS NOT NULL GROUP BY date)
SELECT date, 'QC1' AS "check", QC1::BIGINT AS value FROM c UNION ALL SELECT date, 'QC2', QC2::BIGINT FROM c UNION ALL SELECT date, 'QC3', QC3::BIGINT FROM c UNION ALL SELECT date, 'QC4', QC4::BIGINT FROM c""")
def _(spark, sf):
    return inventory(B.frames(spark, sf)).checks


@query("c04_calibrate_all", "C04 A04 A05 A07 A08 A09 A10 J16", FLAT + ", " + clip_sql("dark", "filter", "dark", 3.0, 5, "z") + """,
dc AS (SELECT filter, median(c) * 1.1::DOUBLE AS dark_current FROM z5 GROUP BY filter),
rf AS (SELECT filter, frame, row_number() OVER (PARTITION BY filter ORDER BY frame) AS rk FROM (SELECT DISTINCT filter, frame FROM pix)),
rd AS (SELECT filter, cell, max(CASE WHEN rk = 1 THEN adu END) AS b0, max(CASE WHEN rk = 2 THEN adu END) AS b1 FROM pix JOIN rf USING (filter, frame) WHERE rk <= 2 GROUP BY ALL),
rn AS (SELECT filter, stddev_pop(b1 - b0) * 1.1::DOUBLE / sqrt(2.0) AS ron FROM rd GROUP BY filter)
SELECT filter, frame, y, x, round((c - 40) / nullif(flat, 0), 4) AS reduced, round(ron, 6) AS ron, round(dark_current, 5) AS dark_current
FROM corr JOIN flat USING (filter, y, x) JOIN rn USING (filter) JOIN dc USING (filter)""")
def _(spark, sf):
    p = cut(B.pix(spark, sf))
    region = F.col("x") >= 46
    bright = p.withColumn("adu", F.when(region, F.col("adu")).otherwise(F.col("adu") + 40))  # a pedestal outside the overscan
    out = calibrate(p, p, bright, p, ["filter"], region, 1.1)
    rows = out.science.join(out.ron, "filter").join(out.dark_current, "filter")
    return rows.select("filter", "frame", "y", "x", r("reduced", 4).alias("reduced"), r("ron").alias("ron"), r("dark_current", 5).alias("dark_current"))


@query("c14_target_identity", "C14 F01 J02 J19 J20", with_(B.SKY_SQL) + """, h AS (SELECT id, dec, ra / 15.0 AS h, abs(dec) AS ad FROM sky),
e AS (SELECT id, 'SP' || lpad(floor(h)::BIGINT::VARCHAR, 2, '0') || lpad(floor((h - floor(h)) * 60)::BIGINT::VARCHAR, 2, '0')
  || CASE WHEN floor(ad) * CASE WHEN dec < 0 THEN -1 ELSE 1 END > 0 THEN '+' ELSE '-' END || lpad(floor(ad)::BIGINT::VARCHAR, 2, '0') || lpad(floor((ad - floor(ad)) * 60)::BIGINT::VARCHAR, 2, '0') AS name FROM h),
n AS (SELECT name, min(id) AS id, count(*) AS n_stars FROM e GROUP BY name)
SELECT name, CASE WHEN id % 3 <> 0 THEN id::VARCHAR END AS id, id % 5 = 0 AS already_run, name AS run_name, n_stars FROM n""")
def _(spark, sf):
    s = B.sky(spark, sf)
    named = s.withColumn("name", N.position_name("ra", "dec")).groupBy("name").agg(
        F.min("id").alias("id"), F.min_by("ra", "id").alias("ra"), F.min_by("dec", "id").alias("dec"), F.count("*").alias("n_stars"))
    named = cut(named)
    ids = named.where("id % 3 <> 0").select("name", "id")
    registry = named.where("id % 5 = 0").select(F.col("name").alias("reg_name"), F.col("id").cast("string").alias("reg_id"), F.col("id").alias("pos"))
    # headers carry a long prefix and a tail; the canonical name takes both off again
    headers = named.select(F.concat(F.lit("SPC"), F.substring("name", 3, 20), F.lit("BIS")).alias("name"), "ra", "dec")
    out = identify(headers, named.select("name"), [ids], registry)
    return out.join(named.select("name", "n_stars"), "name").select("name", "id", "already_run", "run_name", "n_stars")
