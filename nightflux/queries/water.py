"""Water vapour, spectra and common-structure queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import bindings as B
from ..functions import quality as QL
from ..operators import ensemble as E
from ..operators import structure as ST
from ..operators import surface as SU
from ..operators import water as W
from ..session import cut
from .lightcurves import DIFF, EQUAL, NORM, equal_weights, normalised
from .registry import query, r, with_

GRID_SQL = """grid AS (SELECT p.p_size::DOUBLE AS pwv_mm, l.l_linenumber::DOUBLE AS airmass_x, n.n_nationkey::DOUBLE AS teff_k,
  exp(-p.p_size * l.l_linenumber / (10.0::DOUBLE + n.n_nationkey)) AS response
  FROM (SELECT DISTINCT p_size FROM part) p, (SELECT DISTINCT l_linenumber FROM lineitem) l, nation n)"""


def grid(spark, sf):
    """Response lattice over distinct sizes, line numbers and nations (their counts are fixed)."""
    p = B.table(spark, sf, "part").select(F.col("p_size").cast("double").alias("pwv_mm")).distinct()
    l = B.table(spark, sf, "lineitem").select(F.col("l_linenumber").cast("double").alias("airmass_x")).distinct()
    n = B.table(spark, sf, "nation").select(F.col("n_nationkey").cast("double").alias("teff_k"))
    nodes = p.crossJoin(F.broadcast(l)).crossJoin(F.broadcast(n))  # 50 x 7 x 25 nodes
    return nodes.withColumn("response", F.exp(-F.col("pwv_mm") * F.col("airmass_x") / (10.0 + F.col("teff_k"))))


def tri_sql(p, a, t):
    """Trilinear value on the integer lattice as SQL."""
    def g(i, j, k):
        return f"exp(-{i} * {j} / (10.0::DOUBLE + {k}))"

    terms = []
    for i, wi in ((f"floor({p})", f"(1 - ({p} - floor({p})))"), (f"(floor({p}) + 1)", f"({p} - floor({p}))")):
        for j, wj in ((f"floor({a})", f"(1 - ({a} - floor({a})))"), (f"(floor({a}) + 1)", f"({a} - floor({a}))")):
            for k, wk in ((f"floor({t})", f"(1 - ({t} - floor({t})))"), (f"(floor({t}) + 1)", f"({t} - floor({t}))")):
                terms.append(f"{wi} * {wj} * {wk} * {g(i, j, k)}")
    inside = f"{p} BETWEEN 1 AND 50 AND {a} BETWEEN 1 AND 7 AND {t} BETWEEN 0 AND 24"
    return f"CASE WHEN {inside} THEN {' + '.join(terms)} END"


@query("j14_grid_lookup", "J14 S19 D12", f"""WITH q AS (SELECT l_orderkey, l_partkey, l_linenumber, l_quantity * 0.98::DOUBLE AS p, 1 + l_discount * 70 AS a, (l_suppkey % 25) + l_tax * 10 AS t FROM lineitem)
SELECT l_orderkey, l_partkey, l_linenumber, round({tri_sql('p', 'a', 't')}, 6) AS response FROM q""")
def _(spark, sf):
    li = B.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", (F.col("l_quantity") * 0.98).alias("p"),
                                               (1 + F.col("l_discount") * 70).alias("a"), (F.col("l_suppkey") % 25 + F.col("l_tax") * 10).alias("t"))
    out = W.grid_lookup(li, grid(spark, sf), {"pwv_mm": "p", "airmass_x": "a", "teff_k": "t"}, "found")
    return out.select("l_orderkey", "l_partkey", "l_linenumber", r("found").alias("response"))


def _places(spark, sf):
    return B.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", (F.col("l_quantity") * 0.98).alias("p"), (1 + F.col("l_discount") * 70).alias("a"),
        (F.col("l_suppkey") % 25 + F.col("l_tax") * 10).alias("t"))


DIMS = {"pwv_mm": "p", "airmass_x": "a", "teff_k": "t"}


@query("j14_cubic_planes", "J14", """WITH q AS (SELECT l_orderkey, l_partkey, l_linenumber, l_quantity * 0.98::DOUBLE AS p, 1 + l_discount * 70 AS a, (l_suppkey % 25) + l_tax * 10 AS t FROM lineitem),
m AS (SELECT *, 2 + 0.01::DOUBLE * p - 0.05::DOUBLE * a AS s, exp(-floor(t) / 20.0::DOUBLE) AS e0, exp(-(floor(t) + 1) / 20.0::DOUBLE) AS e1 FROM q)
SELECT l_orderkey, l_partkey, l_linenumber, round(CASE WHEN p BETWEEN 1 AND 50 AND a BETWEEN 1 AND 7 AND t BETWEEN 0 AND 24
  THEN s * (e0 + (t - floor(t)) * (e1 - e0)) END, 6) AS response FROM m""")
def _(spark, sf):
    flat = F.exp(-F.col("teff_k") / 20.0) * (2 + 0.01 * F.col("pwv_mm") - 0.05 * F.col("airmass_x"))
    out = SU.surface_lookup(_places(spark, sf), grid(spark, sf).withColumn("response", flat), DIMS, "found")
    return out.select("l_orderkey", "l_partkey", "l_linenumber", r("found").alias("response"))


# the gradients of a curved surface are a linear system, not SQL; tests hold them against direct minimisation
@query("j14_cubic_surface", "J14")
def _(spark, sf):
    out = SU.surface_lookup(_places(spark, sf), grid(spark, sf), DIMS, "found")
    return out.select("l_orderkey", "l_partkey", "l_linenumber", r("found").alias("response"))


@query("c06_water_correction", "C06 F22 J12 J14 A23", with_(B.SERIES_SQL) + f""", tg AS (SELECT series, event_id, t, y, 1 + (event_id % 20) / 10.0::DOUBLE AS am FROM series WHERE series <> 'view'),
pw AS (SELECT t, min(1 + y / 40) AS y FROM series WHERE series = 'view' GROUP BY t),
en AS (SELECT series, min(p.t) AS w0, max(p.t) AS w1 FROM (SELECT series, min(t) - 2.0::DOUBLE / 24 AS a, max(t) + 2.0::DOUBLE / 24 AS z FROM tg GROUP BY series) JOIN pw p ON p.t BETWEEN a AND z GROUP BY series),
pn AS (SELECT g.*, w0, w1, a.t AS t0, a.y AS y0, b.t AS t1, b.y AS y1 FROM tg g JOIN en USING (series) ASOF LEFT JOIN pw a ON g.t >= a.t ASOF LEFT JOIN pw b ON g.t < b.t),
ok AS (SELECT series, event_id, y, am, CASE WHEN t BETWEEN w0 AND w1 THEN CASE WHEN t = t0 THEN y0 ELSE y0 + (y1 - y0) * (t - t0) / (t1 - t0) END END AS p FROM pn),
lk AS (SELECT series, event_id, y, {tri_sql('p', 'am', '5.5::DOUBLE')} AS tw, {tri_sql('p', 'am', '12.25::DOUBLE')} AS ew FROM ok),
nm AS (SELECT series, event_id, y / median(CASE WHEN y > 0.001 THEN y END) OVER w AS ny, tw / median(CASE WHEN tw > 0.001 THEN tw END) OVER w AS tw,
  ew / median(CASE WHEN ew > 0.001 THEN ew END) OVER w AS ew FROM lk WINDOW w AS (PARTITION BY series))
SELECT series, event_id, round(ny / (tw / ew), 5) AS corrected FROM nm""")
def _(spark, sf):
    s = B.series(spark, sf)
    target = s.where("series <> 'view'").select("series", "event_id", "t", "y", (1 + (F.col("event_id") % 20) / 10.0).alias("airmass"), F.lit(5.5).alias("teff"), F.lit(12.25).alias("ens"))
    pwv = s.where("series = 'view'").groupBy("t").agg(F.min(1 + F.col("y") / 40).alias("pwv"))  # one archive for all series
    c = W.water_correction(cut(target), pwv, cut(grid(spark, sf)), ["series"], "t", "y", "airmass", "teff", "ens")
    return c.select("series", "event_id", r("corrected", 5).alias("corrected"))


@query("a43_flux_change", "A43", with_(GRID_SQL) + """
SELECT pwv_mm, airmass_x, teff_k, round(100 * (response / arg_min(response, pwv_mm) OVER (PARTITION BY airmass_x, teff_k) - 1), 5) + 0.0::DOUBLE AS delta_percent FROM grid""")
def _(spark, sf):
    return W.flux_change(grid(spark, sf)).select("pwv_mm", "airmass_x", "teff_k", r("delta_percent", 5).alias("delta_percent"))


SPEC = """rs AS (SELECT p_partkey AS li, p_retailprice / 2000 AS response FROM part),
st AS (SELECT p_partkey AS li, n_nationkey AS teff_k, 1 + sin(p_partkey * 0.01::DOUBLE * (n_nationkey + 1)) * 0.5::DOUBLE AS flux FROM part, nation),
am AS (SELECT p_partkey AS li, pw AS pwv_mm, ax AS airmass_x, exp(-pw * ax * (0.01::DOUBLE + (p_partkey % 10) / 100.0::DOUBLE)) AS transmission
  FROM part, (SELECT DISTINCT l_linenumber AS pw FROM lineitem), (SELECT r_regionkey + 1 AS ax FROM region))"""


@query("a33_c13_spectral_grid", "A33 C13 S24", with_(SPEC) + """
, s2 AS (SELECT li, teff_k, response * flux / max(flux) OVER (PARTITION BY teff_k) AS sr FROM st JOIN rs USING (li)),
v AS (SELECT pwv_mm, airmass_x, teff_k, li AS i, max(li) OVER () AS last, sr * transmission AS v FROM s2 JOIN am USING (li)),
e AS (SELECT *, CASE WHEN last % 2 = 0 THEN last ELSE last - 1 END AS se FROM v)
SELECT pwv_mm, airmass_x, teff_k, round(sum(0.001::DOUBLE * v * (CASE WHEN i <= se THEN CASE WHEN i = 0 OR i = se THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END / 3.0::DOUBLE ELSE 0 END
  + CASE WHEN last % 2 = 1 AND i >= last - 1 THEN 0.5 ELSE 0 END)), 6) AS response FROM e GROUP BY ALL""")
def _(spark, sf):
    part, nation = B.table(spark, sf, "part"), B.table(spark, sf, "nation")
    li = F.col("p_partkey")
    rs = part.select(li.alias("li"), (F.col("p_retailprice") / 2000).alias("response"))
    teffs = nation.select(F.col("n_nationkey").alias("teff_k"))
    st = part.crossJoin(F.broadcast(teffs)).select(li.alias("li"), "teff_k", (1 + F.sin(li * 0.01 * (F.col("teff_k") + 1)) * 0.5).alias("flux"))
    pws = B.table(spark, sf, "lineitem").select(F.col("l_linenumber").alias("pwv_mm")).distinct()
    axs = B.table(spark, sf, "region").select((F.col("r_regionkey") + 1).alias("airmass_x"))
    am = part.crossJoin(F.broadcast(pws)).crossJoin(F.broadcast(axs)).select(
        li.alias("li"), "pwv_mm", "airmass_x", F.exp(-F.col("pwv_mm") * F.col("airmass_x") * (0.01 + (li % 10) / 100.0)).alias("transmission"))
    g = W.build_grid(rs, am, st, 0.001)
    return g.select("pwv_mm", "airmass_x", "teff_k", r("response").alias("response"))


@query("a34_spectral_response", "A34 J13", """WITH g AS (SELECT p_partkey AS li, 0.5::DOUBLE + p_partkey * 0.0003::DOUBLE AS w FROM part),
e AS (SELECT 0.5::DOUBLE + s_suppkey * 0.006::DOUBLE AS w, 0.4::DOUBLE + s_acctbal / 20000 AS v FROM supplier),
f AS (SELECT 0.55::DOUBLE + c_custkey * 0.0004::DOUBLE AS w, c_acctbal / 10000 AS v FROM customer),
x AS (SELECT li, g.w, a.w AS w0, a.v AS v0, b.w AS w1, b.v AS v1, c.w AS w2, c.v AS v2, d.w AS w3, d.v AS v3 FROM g
  ASOF LEFT JOIN e a ON g.w >= a.w ASOF LEFT JOIN e b ON g.w < b.w ASOF LEFT JOIN f c ON g.w >= c.w ASOF LEFT JOIN f d ON g.w < d.w),
y AS (SELECT li, CASE WHEN w = w0 OR w1 IS NULL THEN v0 WHEN w0 IS NOT NULL THEN v0 + (v1 - v0) * (w - w0) / (w1 - w0) END
  * CASE WHEN w = w2 OR w3 IS NULL THEN v2 WHEN w2 IS NOT NULL THEN v2 + (v3 - v2) * (w - w2) / (w3 - w2) END AS p FROM x)
SELECT li, round(p, 5) AS response FROM y WHERE p > 0""")
def _(spark, sf):
    g = B.table(spark, sf, "part").select(F.col("p_partkey").alias("li"), (0.5 + F.col("p_partkey") * 0.0003).alias("wavelength"))
    e = B.table(spark, sf, "supplier").select((0.5 + F.col("s_suppkey") * 0.006).alias("wavelength"), (0.4 + F.col("s_acctbal") / 20000).alias("value"))
    f = B.table(spark, sf, "customer").select((0.55 + F.col("c_custkey") * 0.0004).alias("wavelength"), (F.col("c_acctbal") / 10000).alias("value"))
    s = W.spectral_response(e, f, g, width=0.05)
    return s.select("li", r("response", 5).alias("response"))


@query("f32_pwv_guard", "F32", """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'skip: site' WHEN o_orderkey % 7 = 0 THEN 'skip: no teff' WHEN o_totalprice / 100 < 2000 THEN 'skip: teff too low'
 WHEN o_totalprice / 100 > 3200 THEN 'warn: teff high' ELSE 'ok' END AS guard FROM orders""")
def _(spark, sf):
    o = B.table(spark, sf, "orders")
    tel = F.when(F.col("o_orderkey") % 5 == 0, "Artemis").otherwise("Io")
    teff = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice") / 100)
    return o.select("o_orderkey", QL.pwv_guard(tel, teff).alias("guard"))


# --- common structure ---------------------------------------------------------------

@query("a31_line_fit", "A31 F21", """WITH f AS (SELECT l_suppkey AS star_id, regr_slope(l_discount - 1, l_tax - 1) AS a1, regr_intercept(l_discount - 1, l_tax - 1) AS a0, count(*) AS n FROM lineitem GROUP BY 1),
s AS (SELECT l_suppkey AS star_id, sum(pow(l_discount - (1 + a0 + a1 * (l_tax - 1)), 2)) AS e, sum(pow(l_discount - 1, 2)) AS t FROM lineitem JOIN f ON star_id = l_suppkey GROUP BY 1)
SELECT star_id, round(a0, 6) AS a0, round(a1, 6) AS a1, round(1 - e / t, 6) AS r2, n FROM f JOIN s USING (star_id)""")
def _(spark, sf):
    li = B.table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("star_id"), "l_discount", "l_tax")
    f = ST.line_fit(li, ["star_id"], "l_discount", "l_tax")
    return f.select("star_id", r("a0").alias("a0"), r("a1").alias("a1"), r("r2").alias("r2"), "n")


COEF = """cf AS (SELECT l_returnflag AS run, l_orderkey * 8 + l_linenumber AS id, 12 + (l_extendedprice % 599) / 100 AS mag, (l_discount - 0.05::DOUBLE) * 150 + l_tax AS a, l_partkey FROM lineitem)"""


def coefficients(spark, sf):
    li = B.table(spark, sf, "lineitem")
    return li.select(F.col("l_returnflag").alias("run"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
                     (12 + (F.col("l_extendedprice") % 599) / 100).alias("mag"), ((F.col("l_discount") - 0.05) * 150 + F.col("l_tax")).alias("a"), "l_partkey")


def placed_sql(step):
    return f""", pl AS (SELECT *, round(12 + round((mag - 12) / {step}::DOUBLE) * {step}::DOUBLE, 6) AS mag_bin FROM cf
  WHERE abs(mag - (12 + round((mag - 12) / {step}::DOUBLE) * {step}::DOUBLE)) < {step}::DOUBLE / 2 AND NOT (mag < 15 AND a < -5) AND a < 10 AND a > -30
  AND 12 + round((mag - 12) / {step}::DOUBLE) * {step}::DOUBLE < 18)"""


@query("a30_coefficient_bins", "A30", with_(COEF) + placed_sql(0.5) + """
SELECT run, mag_bin, round(median(a), 6) AS a_median, count(*) AS n FROM pl GROUP BY ALL""")
def _(spark, sf):
    b = ST.coefficient_bins(coefficients(spark, sf), ["run"], "mag", "a")
    return b.select("run", "mag_bin", r("a_median").alias("a_median"), "n")


@query("a30_lowest_coefficients", "A30", with_(COEF) + """
, pl AS (SELECT *, round(13.15::DOUBLE + 0.3::DOUBLE * floor((mag - 13) / 0.3::DOUBLE), 6) AS mag_bin FROM cf
  WHERE floor((mag - 13) / 0.3::DOUBLE) BETWEEN 0 AND 15 AND mag > 13 + 0.3::DOUBLE * floor((mag - 13) / 0.3::DOUBLE)),
rk AS (SELECT *, row_number() OVER (PARTITION BY run, mag_bin ORDER BY a, l_partkey, id) AS rn FROM pl)
SELECT run, mag_bin, round(median(a), 6) AS a_median FROM rk WHERE rn <= 5 GROUP BY ALL""")
def _(spark, sf):
    b = ST.lowest_coefficients(coefficients(spark, sf), ["run"], "mag", "a", "l_partkey")
    return b.select("run", "mag_bin", r("a_median").alias("a_median"))


@query("a32_weighted_fits", "A32", with_(COEF) + """
, w AS (SELECT run, mag AS x, a AS y, 1 / (mag * mag) AS w FROM cf),
m AS (SELECT run, sum(w * x) / sum(w) AS mx, sum(w * y) / sum(w) AS my, avg(x) AS x0 FROM w GROUP BY run),
l AS (SELECT run, sum(w * (x - mx) * (y - my)) / sum(w * (x - mx) * (x - mx)) AS slope, any_value(mx) AS mx, any_value(my) AS my FROM w JOIN m USING (run) GROUP BY run),
p AS (SELECT run, count(*)::DOUBLE AS s0, sum(x - x0) AS s1, sum(pow(x - x0, 2)) AS s2, sum(pow(x - x0, 3)) AS s3, sum(pow(x - x0, 4)) AS s4,
  sum(y) AS t0, sum(y * (x - x0)) AS t1, sum(y * pow(x - x0, 2)) AS t2 FROM w JOIN m USING (run) GROUP BY run),
d AS (SELECT *, s0 * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s3 * s2) + s2 * (s1 * s3 - s2 * s2) AS de FROM p)
SELECT run, round(slope, 6) AS slope, round(my - slope * mx, 5) AS intercept,
  round((s0 * (s2 * t2 - t1 * s3) - s1 * (s1 * t2 - t1 * s2) + t0 * (s1 * s3 - s2 * s2)) / de, 6) AS c2 FROM l JOIN d USING (run)""")
def _(spark, sf):
    c = coefficients(spark, sf)
    line = ST.weighted_line(c, ["run"], "mag", "a", 1 / F.col("mag"))
    curve = ST.parabola(c, ["run"], "mag", "a")
    return line.join(curve, "run").select("run", r("slope").alias("slope"), r("intercept", 5).alias("intercept"), r("c2").alias("c2"))


@query("c08_common_structure", "C08 W06 A31 A32 F21", with_(B.LC_SQL, NORM, EQUAL, DIFF, """
sm AS (SELECT star_id, 12 + 6 * ((star_id + 3) % 10) / 10.0::DOUBLE AS mag, star_id % 9 = 0 AS saturated, 1.0::DOUBLE / (1 + star_id) AS weight FROM (SELECT DISTINCT star_id FROM lc)),
tp AS (SELECT star_id, weight FROM sm WHERE star_id <> 1 ORDER BY weight DESC, star_id LIMIT 4),
su AS (SELECT jd, sum(weight * diff) / sum(CASE WHEN diff IS NOT NULL THEN weight END) AS structure FROM diff JOIN tp USING (star_id) GROUP BY jd),
ix AS (SELECT jd, structure, row_number() OVER (ORDER BY jd) - 1 AS i, count(*) OVER () AS n FROM su),
kr AS (SELECT k, exp(-0.5::DOUBLE * (k / 5.0::DOUBLE) ** 2) AS w FROM range(-20, 21) t(k)),
kk AS (SELECT k, w / (SELECT sum(w) FROM kr) AS w FROM kr),
fo AS (SELECT jd, w, ((i + k) % (2 * n) + 2 * n) % (2 * n) AS f, n FROM ix, kk),
sh AS (SELECT fo.jd, sum(w * v.structure) AS smooth FROM fo JOIN ix v ON v.i = CASE WHEN f < fo.n THEN f ELSE 2 * fo.n - 1 - f END GROUP BY fo.jd),
ft AS (SELECT star_id, regr_slope(diff - 1, smooth - 1) AS a1, regr_intercept(diff - 1, smooth - 1) AS a0 FROM diff JOIN sh USING (jd) GROUP BY star_id),
tm AS (SELECT mag AS tmag FROM sm WHERE star_id = 1),
bi AS (SELECT mag, a1, 12 + round((mag - 12) / 0.5::DOUBLE) * 0.5::DOUBLE AS bin FROM ft JOIN sm USING (star_id)
  WHERE (star_id = 1 OR NOT saturated) AND NOT (mag < 15 AND a1 < -5) AND a1 < 10 AND a1 > -30),
bm AS (SELECT bin AS mag, median(a1) AS a1 FROM bi WHERE abs(mag - bin) < 0.25 AND bin >= 12 AND bin < 18 GROUP BY bin),
pt AS (SELECT mag, a1 FROM bm, tm WHERE mag > tmag - 2 AND mag < least(tmag + 1, 17) AND a1 > -15 AND a1 < 5),
mn AS (SELECT sum(mag / (mag * mag)) / sum(1 / (mag * mag)) AS mx, sum(a1 / (mag * mag)) / sum(1 / (mag * mag)) AS my FROM pt),
ln AS (SELECT sum((mag - mx) * (a1 - my) / (mag * mag)) / sum((mag - mx) * (mag - mx) / (mag * mag)) AS slope, any_value(mx) AS mx, any_value(my) AS my FROM pt, mn)""") + """
SELECT jd, round(smooth, 6) AS smooth, round(CASE WHEN (SELECT stddev_pop(smooth) FROM sh) >= 0.0002 AND slope IS NOT NULL THEN diff / (1 + (SELECT a0 FROM ft WHERE star_id = 1)
  + (my - slope * mx + slope * (11 + round((least(greatest(tmag, 11), 18) - 11) * (999 / 7.0::DOUBLE)) / (999 / 7.0::DOUBLE))) * (smooth - 1)) ELSE diff END, 5) AS corrected FROM diff JOIN sh USING (jd), ln, tm WHERE star_id = 1""")
def _(spark, sf):
    lc = normalised(spark, sf)
    d = E.differential(lc, E.ensemble_curve(lc, equal_weights(lc), []), [])
    k = F.col("star_id")
    stars = cut(lc.select("star_id").distinct().select("star_id", (12 + 6 * ((k + 3) % 10) / 10.0).alias("mag"), (k % 9 == 0).alias("saturated"), (1.0 / (1 + k)).alias("weight")))
    smooth = cut(ST.common_structure(d, stars.where("star_id <> 1"), []))
    target = d.where("star_id = 1").join(stars.select("star_id", "mag"), "star_id").select("jd", "diff", "mag")
    c = ST.correct_structure(target, d.where("star_id <> 1"), stars.where("star_id <> 1"), smooth, [])
    return c.select("jd", r("smooth").alias("smooth"), r("corrected", 5).alias("corrected"))
