"""Pixel-level photometry queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import bindings as B
from ..functions import psf as PS
from ..functions.photometry import APERTURE_FACTORS
from ..operators import pixels as PX
from .registry import query, r, with_

STARS = """sp AS (SELECT s_suppkey AS star_id, (s_suppkey * 0.37::DOUBLE) % 50.0 AS sx, (s_suppkey * 0.73::DOUBLE) % 40.0 AS sy, s_nationkey % 9 AS region FROM supplier)"""


def stars(spark, sf):
    k = F.col("s_suppkey")
    return B.table(spark, sf, "supplier").select(k.alias("star_id"), ((k * F.lit(0.37)) % 50.0).alias("sx"), ((k * F.lit(0.73)) % 40.0).alias("sy"), (F.col("s_nationkey") % 9).alias("region"))


@query("a41_aperture_photometry", "A41 D5", with_(B.PIX_SQL, STARS) + """
, nr AS (SELECT filter, frame, star_id, adu, sqrt(pow(x - sx, 2) + pow(y - sy, 2)) AS d FROM pix JOIN sp ON abs(x - sx) <= 6 AND abs(y - sy) <= 6 WHERE sqrt(pow(x - sx, 2) + pow(y - sy, 2)) <= 6),
g AS (SELECT filter, frame, star_id, median(CASE WHEN d BETWEEN 4 AND 6 THEN adu END) AS sky, """ + ", ".join(
    f"coalesce(sum(CASE WHEN d <= {m!r}::DOUBLE * 0.4 THEN adu END), 0) AS s{i}, count_if(d <= {m!r}::DOUBLE * 0.4) AS n{i}" for i, m in enumerate(APERTURE_FACTORS)) + """ FROM nr GROUP BY ALL)
SELECT filter, frame, star_id, round(sky, 5) AS sky, round(s4 - coalesce(sky, 0) * n4, 4) AS f5, round(s8 - coalesce(sky, 0) * n8, 4) AS f9, round(s12 - coalesce(sky, 0) * n12, 4) AS f13 FROM g""")
def _(spark, sf):
    a = PX.aperture_photometry(B.pix(spark, sf), stars(spark, sf).drop("region"), ["filter", "frame"], "star_id", 0.4, (4.0, 6.0))
    return a.select("filter", "frame", "star_id", r("sky", 5).alias("sky"), r("aper_flux_5", 4).alias("f5"), r("aper_flux_9", 4).alias("f9"), r("aper_flux_13", 4).alias("f13"))


@query("a40_psf_statistics", "A40 F36 P10", with_(B.PIX_SQL, STARS) + """
, nr AS (SELECT filter, frame, star_id, region, adu, x - sx AS dx, y - sy AS dy FROM pix JOIN sp ON abs(x - sx) <= 4 AND abs(y - sy) <= 4),
sc AS (SELECT filter, frame, region, round(dx * 5) / 5 AS x, round(dy * 5) / 5 AS y, adu / max(adu) OVER (PARTITION BY filter, frame, star_id) AS v FROM nr),
m AS (SELECT filter, frame, region, sum(v * x * x) / sum(v) - pow(sum(v * x) / sum(v), 2) AS xx, sum(v * y * y) / sum(v) - pow(sum(v * y) / sum(v), 2) AS yy,
  sum(v * x * y) / sum(v) - sum(v * x) / sum(v) * sum(v * y) / sum(v) AS xy FROM sc GROUP BY ALL)
SELECT filter, frame, region, round(2 * sqrt(2 * ln(2)) * sqrt((xx + yy) / 2 + sqrt(pow((xx - yy) / 2, 2) + xy * xy)), 4) AS psf_a,
  round(2 * sqrt(2 * ln(2)) * sqrt(greatest(0, (xx + yy) / 2 - sqrt(pow((xx - yy) / 2, 2) + xy * xy))), 4) AS psf_b FROM m WHERE xx + yy > 1""")
def _(spark, sf):
    p = PX.psf_statistics(B.pix(spark, sf), stars(spark, sf), ["filter", "frame"], "star_id", "region", 4.0)
    # a nearly empty region has no width to compare
    wide = p.where((F.col("psf_a") * F.col("psf_a") + F.col("psf_b") * F.col("psf_b")) / PS.FWHM_PER_SIGMA**2 > 1)
    return wide.select("filter", "frame", "region", r("psf_a", 4).alias("psf_a"), r("psf_b", 4).alias("psf_b"))


@query("f25_f36_gaussian", "F25 F36", """WITH b AS (SELECT l_orderkey, l_partkey, l_linenumber, l_discount * 30 AS th, 1 + l_tax * 10 AS sx, 1 + l_quantity / 25 AS sy, l_linenumber - 4.0::DOUBLE AS dx, l_quantity / 10 - 2.5 AS dy FROM lineitem),
q AS (SELECT *, pow(cos(th), 2) / (2 * sx * sx) + pow(sin(th), 2) / (2 * sy * sy) AS a, -sin(2 * th) / (4 * sx * sx) + sin(2 * th) / (4 * sy * sy) AS b, pow(sin(th), 2) / (2 * sx * sx) + pow(cos(th), 2) / (2 * sy * sy) AS c FROM b)
SELECT l_orderkey, l_partkey, l_linenumber, round(1000 * exp(-(a * dx * dx + 2 * b * dx * dy + c * dy * dy)), 5) AS value, round(2 * sqrt(2 * ln(2)) * sx, 6) AS fwhm FROM q""")
def _(spark, sf):
    li = B.table(spark, sf, "lineitem")
    g = PS.gaussian_2d(F.lit(1000.0), F.col("l_discount") * 30, 1 + F.col("l_tax") * 10, 1 + F.col("l_quantity") / 25, F.lit(0.0), F.lit(0.0), 4.0 - F.col("l_linenumber"), 2.5 - F.col("l_quantity") / 10)
    return li.select("l_orderkey", "l_partkey", "l_linenumber", r(g, 5).alias("value"), r(PS.fwhm(1 + F.col("l_tax") * 10)).alias("fwhm"))
