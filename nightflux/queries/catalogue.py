"""Sky catalogue, target identity and append queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import bindings as B
from ..functions import naming as N
from ..functions import photometry as P
from ..functions import sky as S
from ..functions import quality as QL
from ..operators import append as AP
from ..operators import catalogue as C
from ..operators import registry as R
from ..session import cut
from .lightcurves import clip_sql
from .registry import query, r, with_

OBS = S.EPOCH_J2016 + 100.0
SK = with_(B.SKY_SQL)
SKR = with_(B.SKY_SQL, B.SKY_REF_SQL)


def gc(a, b, c, d):
    """Great-circle separation in degrees, SQL."""
    return (f"degrees(2 * asin(least(1.0, sqrt(pow(sin(radians({d} - ({b})) / 2), 2) + cos(radians({b})) * cos(radians({d}))"
            f" * pow(sin(radians({c} - ({a})) / 2), 2)))))")


@query("f11_f12_separation", "F11 F12", SK + f""", s AS (SELECT id, {gc('10.0::DOUBLE', '20.0::DOUBLE', 'ra', 'dec')} AS sep FROM sky)
SELECT id, round(sep, 6) AS sep, round(1 / (1 + pow(1.5 * sep / max(sep) OVER (), 2)), 6) AS w FROM s""")
def _(spark, sf):
    s = B.sky(spark, sf).select("id", S.separation_deg(F.lit(10.0), F.lit(20.0), "ra", "dec").alias("sep"))
    far = s.agg(F.max("sep").alias("far"))
    return s.crossJoin(F.broadcast(far)).select("id", r("sep").alias("sep"), r(S.distance_weight(F.lit(1.5), "sep", "far")).alias("w"))


@query("f13_f14_f15_proper_motion", "F13 F14 F15 C09 K11", SK + f""", m AS (SELECT *, 100.0::DOUBLE / 365.0 AS y365,
  1000.0 / parallax AS d, pmra / 1000.0 * (1000.0 / parallax) * 4.740::DOUBLE / 977780.0 AS vr, pmdec / 1000.0 * (1000.0 / parallax) * 4.740::DOUBLE / 977780.0 AS vd FROM sky)
, p AS (SELECT *, d * cos(radians(dec)) - 10.0 * vd * sin(radians(dec)) AS rad,
  d * sin(radians(dec)) + 10.0 * vd * cos(radians(dec)) AS z FROM m)
, q AS (SELECT *, rad * cos(radians(ra)) - 10.0 * vr * sin(radians(ra)) AS x, rad * sin(radians(ra)) + 10.0 * vr * cos(radians(ra)) AS yy FROM p)
SELECT id, round(coalesce(ra + pmra / 3.6e6 / cos(radians(dec)) * y365, ra), 8) AS ra1, round(coalesce(dec + pmdec / 3.6e6 * y365, dec), 8) AS dec1,
  round(coalesce(ra + pmra / 3.6e6 * y365, ra), 8) AS ra2,
  round(CASE WHEN degrees(atan2(yy, x)) < 0 THEN degrees(atan2(yy, x)) + 360 ELSE degrees(atan2(yy, x)) END, 6) AS ra3,
  round(degrees(atan(z / sqrt(x * x + yy * yy))), 6) AS dec3 FROM q""")
def _(spark, sf):
    s = B.sky(spark, sf)
    m = C.motion_corrected(s, F.lit(S.EPOCH_J2016), F.lit(OBS)).select("id", F.col("ra").alias("ra1"), F.col("dec").alias("dec1"))
    ra2, _ = S.propagate_plain("ra", "dec", "pmra", "pmdec", F.lit(100.0 / 365.0))
    ra3, dec3 = S.propagate_in_space("ra", "dec", "pmra", "pmdec", "parallax", F.lit(10.0))
    return s.join(m, "id").select("id", r("ra1", 8).alias("ra1"), r("dec1", 8).alias("dec1"), r(ra2, 8).alias("ra2"), r(ra3).alias("ra3"), r(dec3).alias("dec3"))


CROSS = SKR + f""", mv AS (SELECT *, coalesce(ref_ra + ref_pmra / 3.6e6 / cos(radians(ref_dec)) * (100.0 / 365.0::DOUBLE), ref_ra) AS nra,
  coalesce(ref_dec + ref_pmdec / 3.6e6 * (100.0 / 365.0::DOUBLE), ref_dec) AS ndec FROM sky_ref)
, pr AS (SELECT s.id, s.teff, s.field, m.ref_id, m.ref_teff, {gc('s.ra', 's.dec', 'nra', 'ndec')} AS sep FROM sky s JOIN mv m
  ON abs(s.dec - ref_dec) < 0.01 AND {gc('s.ra', 's.dec', 'ref_ra', 'ref_dec')} <= 0.0084)
, best AS (SELECT id, arg_min(ref_id, (sep, ref_id)) AS ref_id, arg_min(ref_teff, (sep, ref_id)) AS ref_teff, min(sep) AS sep FROM pr
  WHERE sep <= degrees(1e-5::DOUBLE) GROUP BY id)
"""


def crossed(spark, sf):
    return C.crossmatch(B.sky(spark, sf), B.sky_ref(spark, sf), OBS, S.EPOCH_J2016)


@query("j06_crossmatch", "J06 F14 C07 J04 J09", CROSS + """
SELECT s.id, b.ref_id, round(b.sep * 3600, 5) AS sep_arcsec FROM sky s LEFT JOIN best b USING (id)""")
def _(spark, sf):
    return crossed(spark, sf).select("id", F.col("match.ref_id").alias("ref_id"), r(F.col("sep_deg") * 3600, 5).alias("sep_arcsec"))


@query("a27_match_completeness", "A27 C07", CROSS + """
SELECT field, round(100.0::DOUBLE * count(b.ref_id) / count(*), 6) AS matched_percent, count(b.ref_teff) AS n_teff
FROM sky s LEFT JOIN best b USING (id) GROUP BY field""")
def _(spark, sf):
    return C.match_completeness(crossed(spark, sf), ["field"]).select("field", r("matched_percent").alias("matched_percent"), "n_teff")


NEAR = SKR + f""", pr AS (SELECT s.id, s.field, s.ra, s.dec, m.ref_id, m.ref_ra, m.ref_dec, {gc('s.ra', 's.dec', 'ref_ra', 'ref_dec')} AS sep FROM sky s, sky_ref m)
, nn AS (SELECT id, field, any_value(ra) AS ra, any_value(dec) AS dec, min(sep) AS sep, arg_min(ref_id, (sep, ref_id)) AS ref_id,
   arg_min(ref_ra, (sep, ref_id)) AS ref_ra, arg_min(ref_dec, (sep, ref_id)) AS ref_dec FROM pr GROUP BY id, field)"""


@query("j08_nearest_reference", "J08 W12", NEAR + ", " + clip_sql("nn", "field", "sep", 5.0, 8, "k", side="high") + """
SELECT id, ref_id, round(sep, 6) AS sep, round((ra - ref_ra) * cos(radians(dec)), 6) AS dra, round(dec - ref_dec, 6) AS ddec, c IS NOT NULL AS kept FROM k8""")
def _(spark, sf):
    n = C.nearest_reference(B.sky(spark, sf), B.sky_ref(spark, sf), ["field"])
    return n.select("id", F.col("match.ref_id").alias("ref_id"), r("sep_deg").alias("sep"), r("dra").alias("dra"), r("ddec").alias("ddec"),
                    F.col("clipped_sep").isNotNull().alias("kept"))


@query("a28_astrometric_rms", "A28 C10", NEAR + ", " + clip_sql("nn", "field", "sep", 5.0, 8, "k", side="high") + """
SELECT field, round(median(c) * 3600, 4) AS rms_arcsec, count(c) AS n_sources FROM k8 GROUP BY field""")
def _(spark, sf):
    n = cut(C.nearest_reference(B.sky(spark, sf), B.sky_ref(spark, sf), ["field"]))
    return C.astrometric_rms(n, ["field"]).select("field", r("rms_arcsec", 4).alias("rms_arcsec"), "n_sources")


@query("p11_footprint", "P11", SKR + """, bx AS (SELECT field, min(ra) AS a, max(ra) AS b, min(dec) AS c, max(dec) AS d FROM sky GROUP BY field)
SELECT field, count(*) AS n, sum(ref_id)::BIGINT AS ids FROM bx JOIN sky_ref ON ref_ra > a AND ref_ra < b AND ref_dec > c AND ref_dec < d GROUP BY field""")
def _(spark, sf):
    f = C.footprint_filter(B.sky(spark, sf), B.sky_ref(spark, sf), ["field"], cell=20.0)
    return f.groupBy("field").agg(F.count("*").alias("n"), F.sum("ref_id").alias("ids"))


XY = """xy AS (SELECT c_custkey AS id, c_nationkey AS field, (c_custkey * 97.13::DOUBLE) % 2048.0 AS x, (c_acctbal * 7.77::DOUBLE + 20000) % 2048.0 AS y FROM customer)"""


def xy(spark, sf):
    k = F.col("c_custkey")
    return B.table(spark, sf, "customer").select(k.alias("id"), F.col("c_nationkey").alias("field"),
                                                 ((k * F.lit(97.13)) % 2048.0).alias("x"), ((F.col("c_acctbal") * 7.77 + 20000) % 2048.0).alias("y"))


@query("j17_blended", "J17", with_(XY) + """
SELECT DISTINCT a.field, a.id FROM xy a JOIN xy b ON a.field = b.field AND a.id <> b.id AND sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) < 60""")
def _(spark, sf):
    return C.blended(xy(spark, sf), ["field"], "id", "x", "y", 60.0)


@query("o10_nearest_other", "O10", with_(XY) + """
, d AS (SELECT a.field, a.id, min(sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2))) AS nearest FROM xy a JOIN xy b ON a.field = b.field AND a.id <> b.id GROUP BY ALL)
SELECT field, id, round(x, 4) AS x, round(y, 4) AS y, round(nearest, 4) AS nearest FROM xy LEFT JOIN d USING (field, id)""")
def _(spark, sf):
    n = C.nearest_other(xy(spark, sf), ["field"], "x", "y", 20.0)
    return n.select("field", "id", r("x", 4).alias("x"), r("y", 4).alias("y"), r("nearest", 4).alias("nearest"))


@query("j23_plate_match", "J23", with_(XY) + """
, dt AS (SELECT s_nationkey AS field, (s_suppkey * 97.13::DOUBLE * 3) % 2048.0 AS dx, (s_acctbal * 7.77::DOUBLE + 20000) % 2048.0 AS dy FROM supplier)
SELECT field, count(DISTINCT id) AS n_matched FROM xy JOIN dt USING (field) WHERE sqrt(pow(x - dx, 2) + pow(y - dy, 2)) <= 80 GROUP BY field""")
def _(spark, sf):
    refs = xy(spark, sf).select("field", F.col("id").alias("ref_id"), F.col("x").alias("ref_x"), F.col("y").alias("ref_y"))
    det = B.table(spark, sf, "supplier").select(F.col("s_nationkey").alias("field"), ((F.col("s_suppkey") * F.lit(97.13) * 3) % 2048.0).alias("det_x"),
                                                ((F.col("s_acctbal") * 7.77 + 20000) % 2048.0).alias("det_y"))
    return C.plate_match(refs, det, ["field"], radius=80.0)


@query("o08_brightest", "O08", SK + """SELECT field, id, rank FROM (
  SELECT field, id, row_number() OVER (PARTITION BY field ORDER BY gmag, id)::INT AS rank FROM sky) WHERE rank <= 20""")
def _(spark, sf):
    return C.brightest(B.sky(spark, sf), ["field"], "gmag", "id").select("field", "id", "rank")


ZP = """zp AS (SELECT c_nationkey AS field, c_custkey AS id, 12 + (c_custkey % 100) / 11.0::DOUBLE AS izmag, 12 + (c_custkey % 90) / 11.5::DOUBLE AS gmag,
  (c_custkey % 13) / 12.0::DOUBLE AS g_rp, (c_custkey % 7) / 6.0::DOUBLE AS bp_rp, (c_custkey * 97.13::DOUBLE) % 2048.0 AS x, (c_custkey * 31.7::DOUBLE) % 2048.0 AS y FROM customer)"""


@query("a19_zero_point", "A19 P08", with_(ZP) + """
SELECT field, round(median((gmag - g_rp) - (izmag - 24.16::DOUBLE)), 6) AS zero_point, count(*) AS n FROM zp
WHERE izmag < 20 AND gmag <= 19 AND g_rp < 0.8::DOUBLE AND bp_rp > 0.25::DOUBLE AND x > 20 AND x < 1980 AND y > 20 AND y < 1980 GROUP BY field""")
def _(spark, sf):
    k = F.col("c_custkey")
    z = B.table(spark, sf, "customer").select(
        F.col("c_nationkey").alias("field"), k.alias("id"), (12 + (k % 100) / 11.0).alias("izmag"), (12 + (k % 90) / 11.5).alias("gmag"),
        ((k % 13) / 12.0).alias("g_rp"), ((k % 7) / 6.0).alias("bp_rp"), ((k * F.lit(97.13)) % 2048.0).alias("x"), ((k * F.lit(31.7)) % 2048.0).alias("y"))
    return C.zero_point(z, ["field"]).select("field", r("zero_point").alias("zero_point"), "n")


@query("p09_mid_brightness", "P09", """WITH h AS (SELECT l_suppkey AS field, l_orderkey, l_partkey, l_linenumber, l_extendedprice AS f,
  median(l_extendedprice) OVER (PARTITION BY l_suppkey) AS m FROM lineitem),
p AS (SELECT field, median(CASE WHEN f < m THEN f END) AS lo, median(CASE WHEN f > m THEN f END) AS hi FROM h GROUP BY field)
SELECT field, count(*) AS n, round(min(f), 2) AS faintest, round(max(f), 2) AS brightest FROM h JOIN p USING (field) WHERE f > lo AND f < hi GROUP BY field""")
def _(spark, sf):
    li = B.table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("field"), F.col("l_extendedprice").alias("f"))
    m = C.mid_brightness(li, ["field"], "f")
    return m.groupBy("field").agg(F.count("*").alias("n"), r(F.min("f"), 2).alias("faintest"), r(F.max("f"), 2).alias("brightest"))


@query("p10_chip_regions", "P10", with_(XY) + """
SELECT id, 'f_' || ((CASE WHEN y < 2048 / 3.0::DOUBLE THEN 0 WHEN y > 2048 / 3.0::DOUBLE AND y < 4096 / 3.0::DOUBLE THEN 1 WHEN y > 4096 / 3.0::DOUBLE THEN 2 END) * 3
  + (CASE WHEN x < 2048 / 3.0::DOUBLE THEN 0 WHEN x > 2048 / 3.0::DOUBLE AND x < 4096 / 3.0::DOUBLE THEN 1 WHEN x > 4096 / 3.0::DOUBLE THEN 2 END) + 1)::VARCHAR AS region,
  (x > 22 AND x < 2026 AND y > 22 AND y < 2026) AS inner_star FROM xy""")
def _(spark, sf):
    s = xy(spark, sf)
    n = F.lit(2048.0)
    return s.select("id", QL.chip_region("x", "y", n, n).alias("region"), QL.away_from_edge("x", "y", n, n, F.lit(11.0)).alias("inner_star"))


@query("p22_c15_motion_audit", "P22 C15", SK + """, hp AS (SELECT * FROM sky WHERE sqrt(pmra * pmra + pmdec * pmdec) > 50)
, c AS (SELECT id, ra + pmra / 3.6e6 / cos(radians(dec)) * (1000.0::DOUBLE / 365.0) AS cra, dec + pmdec / 3.6e6 * (1000.0::DOUBLE / 365.0) AS cdec FROM hp)
, o AS (SELECT id, sqrt(pow((cra - (ra + pmra / 3.6e6 * 2.7::DOUBLE / cos(radians(dec)))) * cos(radians(dec)), 2) + pow(cdec - (dec + pmdec / 3.6e6 * 2.7::DOUBLE), 2)) * 3.6e6 AS om,
  sqrt(pow((cra - ra) * cos(radians(dec)), 2) + pow(cdec - dec, 2)) * 3.6e6 AS ou FROM hp JOIN c USING (id))
SELECT id, round(om, 2) AS off_moved, round(ou, 2) AS off_unmoved, CASE WHEN om < ou THEN 'observation date' ELSE 'epoch' END AS verdict FROM o""")
def _(spark, sf):
    s = B.sky(spark, sf)
    moved = C.motion_corrected(s, F.lit(S.EPOCH_J2016), F.lit(S.EPOCH_J2016 + 1000.0))
    a = C.motion_audit(s, moved, "id", 2.7)
    return a.select("id", r("off_moved", 2).alias("off_moved"), r("off_unmoved", 2).alias("off_unmoved"), "verdict")


@query("s22_stars_to_move", "S22 J04 C09 F13", SKR + """, rf AS (SELECT s_nationkey AS field, 2457389.0::DOUBLE + min(s_suppkey) AS jd FROM supplier GROUP BY 1),
m AS (SELECT s.id, ra, dec, ref_pmra AS pmra, ref_pmdec AS pmdec, (2458389.0::DOUBLE - rf.jd) / 365.0 AS y FROM sky s LEFT JOIN sky_ref ON ref_id = s.id LEFT JOIN rf USING (field))
SELECT id, round(coalesce(ra + pmra / 3.6e6 / cos(radians(dec)) * y, ra), 7) AS ra, round(coalesce(dec + pmdec / 3.6e6 * y, dec), 7) AS dec FROM m""")
def _(spark, sf):
    match = B.sky_ref(spark, sf).select(F.col("ref_id").alias("id"), F.col("ref_pmra").alias("pmra"), F.col("ref_pmdec").alias("pmdec"))
    first = B.table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("field")).agg((2457389.0 + F.min("s_suppkey")).alias("jd"))
    s = C.stars_to_move(B.sky(spark, sf), match, first, ["field"], "id")
    moved = C.motion_corrected(s, "catalogue_jd", F.lit(2458389.0))
    return moved.select("id", r("ra", 7).alias("ra"), r("dec", 7).alias("dec"))


TRACK = with_(B.SERIES_SQL) + """, tr AS (SELECT series, event_id, t, (y * 0.0001::DOUBLE + 100) AS ra, (y * 0.00005::DOUBLE - 30) AS dec FROM series)"""


@query("w01_frame_shift", "W01 C10", TRACK + """
, l AS (SELECT *, lag(ra) OVER w AS pra, lag(dec) OVER w AS pdec, first_value(ra) OVER w AS fra, first_value(dec) OVER w AS fdec FROM tr WINDOW w AS (PARTITION BY series ORDER BY t))
, s AS (SELECT series, event_id, dec, coalesce((ra - pra) * 3600, 0) AS rm, coalesce((dec - pdec) * 3600, 0) AS dm, (ra - fra) * 3600 AS rs, (dec - fdec) * 3600 AS ds FROM l)
SELECT series, event_id, round(rm, 4) + 0.0 AS ra_move, round(dm, 4) + 0.0 AS dec_move, round(sqrt(pow(rm * cos(radians(dec)), 2) + pow(dm, 2)), 4) AS move,
  round(sqrt(pow(rs * cos(radians(dec)), 2) + pow(ds, 2)), 4) AS shift FROM s""")
def _(spark, sf):
    t = B.series(spark, sf).select("series", "event_id", "t", (F.col("y") * 0.0001 + 100).alias("ra"), (F.col("y") * 0.00005 - 30).alias("dec"))
    s = C.frame_shifts(t, ["series"], "t", "ra", "dec")
    return s.select("series", "event_id", r("ra_move", 4).alias("ra_move"), r("dec_move", 4).alias("dec_move"), r("move", 4).alias("move"), r("shift", 4).alias("shift"))


@query("j01_target_match", "J01 U01 O09", """WITH st AS (SELECT o_orderkey AS pos, o_custkey AS id, o_orderstatus AS field, o_totalprice AS flux FROM orders),
tg AS (SELECT c_custkey AS id FROM customer WHERE c_mktsegment = 'BUILDING'),
h AS (SELECT *, row_number() OVER (PARTITION BY field, id ORDER BY flux DESC, pos) AS rn, count(*) OVER (PARTITION BY field, id) AS n_rows FROM st SEMI JOIN tg USING (id))
SELECT field, id, pos, flux, n_rows, CASE WHEN count(*) OVER (PARTITION BY field) > 1 THEN 'many' ELSE 'one' END AS outcome FROM h WHERE rn = 1""")
def _(spark, sf):
    st = B.table(spark, sf, "orders").select(F.col("o_orderkey").alias("pos"), F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("field"), F.col("o_totalprice").alias("flux"))
    tg = B.table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("id"))
    return C.target_match(st, tg, ["field"], "id", "flux", "pos").select("field", "id", "pos", "flux", "n_rows", "outcome")


@query("j02_j03_identity", "J02 J03 F34 O09", """WITH nm AS (SELECT p_partkey AS key, CASE WHEN p_partkey % 3 = 0 THEN 'TOI-' || p_partkey || '.01_x' ELSE p_name END AS name FROM part),
a AS (SELECT l_partkey AS key, min(l_suppkey)::VARCHAR AS v FROM lineitem WHERE l_quantity > 49 GROUP BY 1),
b AS (SELECT l_partkey AS key, min(l_suppkey)::VARCHAR AS v FROM lineitem WHERE l_tax > 0.07 GROUP BY 1),
c AS (SELECT key, (key + 1000000)::VARCHAR AS v FROM nm WHERE regexp_matches(lower(name), 'toi-[0-9]+') AND key % 2 = 0)
SELECT nm.key, coalesce(a.v, b.v, c.v, nm.key::VARCHAR) AS gaia, (CASE WHEN a.v IS NOT NULL THEN 1 WHEN b.v IS NOT NULL THEN 2 WHEN c.v IS NOT NULL THEN 3 ELSE 0 END)::INT AS source
FROM nm LEFT JOIN a USING (key) LEFT JOIN b USING (key) LEFT JOIN c USING (key)""")
def _(spark, sf):
    part = B.table(spark, sf, "part").select(F.col("p_partkey").alias("key"), F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("TOI-"), F.col("p_partkey").cast("string"), F.lit(".01_x"))).otherwise(F.col("p_name")).alias("name"))
    li = B.table(spark, sf, "lineitem").withColumnRenamed("l_partkey", "key")
    a = li.where("l_quantity > 49").groupBy("key").agg(F.min("l_suppkey").alias("gaia"))
    b = li.where("l_tax > 0.07").groupBy("key").agg(F.min("l_suppkey").alias("gaia"))
    toi = part.withColumn("toi", N.toi_number("name")).where("toi IS NOT NULL AND toi % 2 = 0").select("key", (F.col("toi") + 1000000).alias("gaia"))
    return C.resolve_identity([a, b, toi], "key", "gaia", part.select("key"))


@query("j07_release_map", "J07", """SELECT c_custkey AS id, min(o_orderkey) AS other_id FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""")
def _(spark, sf):
    ids = B.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    m = B.table(spark, sf, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("other_id"))
    return C.first_map(ids, m, "id", "other_id")


@query("j04_j09_match_columns", "J04 J09 K09", SKR + """SELECT id, round(ra, 6) AS ra, ref_id, round(ref_gmag, 4) AS gmag FROM sky LEFT JOIN sky_ref ON ref_id = id""")
def _(spark, sf):
    m = B.sky_ref(spark, sf).select(F.col("ref_id").alias("id"), "ref_id", F.col("ref_gmag").alias("gmag"))
    out = C.replace_match_columns(B.sky(spark, sf), m, "id", drop=["pmra", "pmdec"])
    return out.select("id", r("ra").alias("ra"), "ref_id", r("gmag", 4).alias("gmag"))


@query("j05_source_counts", "J05", """SELECT o_orderkey AS frame_id, count(l_orderkey) AS nsources FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""")
def _(spark, sf):
    n = B.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("frame_id")).agg(F.count("*").alias("n"))
    f = B.table(spark, sf, "orders").select(F.col("o_orderkey").alias("frame_id"))
    return f.join(n, "frame_id", "left").select("frame_id", F.coalesce("n", F.lit(0)).alias("nsources"))


@query("j18_a23_ensemble_teff", "J18 A23", SK + """, w AS (SELECT field, teff, gmag / 100 AS weight FROM sky)
SELECT field, round(sum(weight * teff) / sum(weight), 4) AS ensemble_teff FROM w WHERE teff IS NOT NULL GROUP BY field""")
def _(spark, sf):
    from ..operators.water import ensemble_teff

    s = B.sky(spark, sf).withColumn("weight", F.col("gmag") / 100)
    return ensemble_teff(s, ["field"]).select("field", r("ensemble_teff", 4).alias("ensemble_teff"))


# --- names ---------------------------------------------------------------------

@query("f01_f28_position_names", "F01 F28", SK + """, h AS (SELECT id, dec, ra / 15.0 AS h, abs(dec) AS ad FROM sky),
e AS (SELECT id, 'SP' || lpad(floor(h)::BIGINT::VARCHAR, 2, '0') || lpad(floor((h - floor(h)) * 60)::BIGINT::VARCHAR, 2, '0')
  || CASE WHEN floor(ad) * CASE WHEN dec < 0 THEN -1 ELSE 1 END > 0 THEN '+' ELSE '-' END || lpad(floor(ad)::BIGINT::VARCHAR, 2, '0') || lpad(floor((ad - floor(ad)) * 60)::BIGINT::VARCHAR, 2, '0') AS expected FROM h),
n AS (SELECT id, expected, CASE id % 4 WHEN 0 THEN expected || '.01' WHEN 1 THEN 'SPC' || substr(expected, 3) || 'BIS' WHEN 2 THEN replace(expected, '-', '_') ELSE 'SP12' END AS name FROM e),
t AS (SELECT *, split_part(replace(replace(replace(split_part(name, 'BIS', 1), 'SPC', 'SP'), 'SPEC', 'SP'), '_', '-'), '.', 1) AS tidy FROM n)
SELECT id, expected, tidy, CASE WHEN regexp_full_match(tidy, '[^+-]{6}[+-][^+-]{4}') AND substr(tidy, 7, 1) = substr(expected, 7, 1) THEN tidy ELSE expected END AS name FROM t""")
def _(spark, sf):
    s = B.sky(spark, sf).withColumn("expected", N.position_name("ra", "dec"))
    e = F.col("expected")
    raw = (F.when(F.col("id") % 4 == 0, F.concat(e, F.lit(".01"))).when(F.col("id") % 4 == 1, F.concat(F.lit("SPC"), F.substring(e, 3, 100), F.lit("BIS")))
           .when(F.col("id") % 4 == 2, F.replace(e, F.lit("-"), F.lit("_"))).otherwise("SP12"))
    s = s.withColumn("raw", raw)
    return s.select("id", "expected", N.tidy_name("raw").alias("tidy"), N.repaired_name("raw", "expected").alias("name"))


@query("f02_f03_f33_file_names", "F02 F03 F33", """WITH f AS (SELECT o_orderkey, replace(o_orderpriority, ' ', '--') AS hy, 'T' || o_custkey || '_' || o_orderstatus || '_' || strftime(o_orderdate, '%Y%m%d') || '_' || (o_orderkey % 9) || '.fts' AS fn,
  CASE WHEN o_orderkey % 5 = 0 THEN 'N' WHEN o_orderkey % 7 = 0 THEN '-3' ELSE o_totalprice::VARCHAR END AS v, o_totalprice FROM orders)
SELECT o_orderkey, hy, replace(hy, '--', ' ') AS sp, 'proc' || replace(fn, '.fts', '.fits') AS proc, split_part(fn, '_', 1) AS target, split_part(fn, '_', 2) AS filter,
  split_part(fn, '_', 3) AS date, split_part(split_part(fn, '_', 4), '.', 1)::INT AS ap, CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 THEN round(o_totalprice, 2) END AS value FROM f""")
def _(spark, sf):
    o = B.table(spark, sf, "orders")
    k = F.col("o_orderkey")
    fn = F.concat(F.lit("/night/T"), F.col("o_custkey").cast("string"), F.lit("_"), F.col("o_orderstatus"), F.lit("_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_"), (k % 9).cast("string"), F.lit(".fts"))
    o = o.withColumn("fn", fn).withColumn("hy", N.hyphenated("o_orderpriority"))
    o = o.withColumn("v", F.when(k % 5 == 0, "N").when(k % 7 == 0, "-3").otherwise(F.col("o_totalprice").cast("string")))
    p = N.name_parts("fn")
    return o.select("o_orderkey", "hy", N.spaced("hy").alias("sp"), N.processed_file_name("fn").alias("proc"), p["target"].alias("target"), p["filter"].alias("filter"),
                    p["date"].alias("date"), p["ap"].alias("ap"), r(N.positive_or_null("v"), 2).alias("value"))


@query("f34_toi_numbers", "F34 F35", """SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_partkey END AS toi,
 lpad((p_size % 24)::VARCHAR, 2, '0') || ':' || lpad((p_partkey % 60)::VARCHAR, 2, '0') || ':' || lpad((p_size % 60)::VARCHAR, 2, '0') AS hms FROM part""")
def _(spark, sf):
    p = B.table(spark, sf, "part")
    name = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("TOI-"), F.col("p_partkey").cast("string"), F.lit(".01_x"))).otherwise(F.col("p_name"))
    return p.select("p_partkey", N.toi_number(name).alias("toi"), N.hms_label(F.col("p_size") % 24, F.col("p_partkey") % 60, F.col("p_size") % 60).alias("hms"))


@query("j20_existing_stack", "J20 C14", with_(B.FRAMES_SQL) + """, tg AS (SELECT DISTINCT object AS name FROM frames WHERE NOT contains(object, '_2')),
sp AS (SELECT name, substr(name, 3, 4) AS a, substr(name, 7, 1) AS s, substr(name, 8) AS d FROM tg),
cd AS (SELECT name, 'SP' || lpad((a::INT + i)::VARCHAR, 4, '0') || s || lpad((d::INT + j)::VARCHAR, 4, '0') AS candidate,
  (CASE WHEN j = 0 THEN 0 WHEN i = 0 THEN 1 ELSE 2 END) * 100 + (i + 2) * 5 + j + 2 AS o FROM sp, range(-2, 3) x(i), range(-2, 3) y(j) WHERE (i <> 0 OR j <> 0) AND a::INT + i >= 0 AND d::INT + j >= 0),
h AS (SELECT c.name, arg_max(candidate, o) AS stack_name, count(*) AS n_hits FROM cd c SEMI JOIN (SELECT name AS candidate FROM tg) USING (candidate) GROUP BY c.name)
SELECT tg.name, coalesce(stack_name, tg.name) AS stack_name, n_hits FROM tg LEFT JOIN h USING (name)""")
def _(spark, sf):
    names = B.frames(spark, sf).where(~F.col("object").contains("_2")).select(F.col("object").alias("name")).distinct()
    return R.existing_stack(names, names).select("name", "stack_name", "n_hits")


@query("j19_registered", "J19 S20", """WITH t AS (SELECT c_custkey AS id, upper('new ' || c_mktsegment || ' ' || c_name) AS name FROM customer),
g AS (SELECT upper(p_name) AS reg_name, p_partkey AS pos, CASE WHEN p_partkey % 4 = 0 THEN p_partkey END AS reg_id FROM part),
g2 AS (SELECT upper(c_mktsegment) AS reg_name, c_custkey + 100000 AS pos, NULL::BIGINT AS reg_id FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')),
r AS (SELECT * FROM g UNION ALL SELECT * FROM g2),
i AS (SELECT t.name, arg_min(reg_name, pos) AS inside FROM t JOIN (SELECT reg_name, min(pos) AS pos FROM r GROUP BY 1) r ON contains(t.name, r.reg_name) GROUP BY t.name)
SELECT t.id, t.name, (EXISTS (SELECT 1 FROM r WHERE r.reg_id = t.id OR r.reg_name = t.name)) OR inside IS NOT NULL AS already_run,
  CASE WHEN EXISTS (SELECT 1 FROM r WHERE r.reg_id = t.id OR r.reg_name = t.name) THEN t.name ELSE coalesce(inside, t.name) END AS run_name FROM t LEFT JOIN i USING (name)""")
def _(spark, sf):
    t = B.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.upper(F.concat(F.lit("new "), "c_mktsegment", F.lit(" "), "c_name")).alias("name"))
    g = B.table(spark, sf, "part").select(F.upper("p_name").alias("reg_name"), F.when(F.col("p_partkey") % 4 == 0, F.col("p_partkey")).alias("reg_id"), F.col("p_partkey").alias("pos"))
    g2 = B.table(spark, sf, "customer").where("c_mktsegment IN ('BUILDING', 'MACHINERY')").select(F.upper("c_mktsegment").alias("reg_name"), F.lit(None).cast("bigint").alias("reg_id"), (F.col("c_custkey") + 100000).alias("pos"))
    return R.registered(t, g.unionByName(g2))


@query("j22_build_registry", "J22 S23 U03 O11 K13", """WITH o AS (SELECT DISTINCT o_custkey AS id FROM orders WHERE o_orderstatus IN ('F', 'O')),
l AS (SELECT c_custkey AS id, upper(c_name) AS n FROM customer WHERE c_mktsegment <> 'BUILDING'),
s AS (SELECT l_partkey AS id, upper('st' || min(l_suppkey)) AS n FROM lineitem GROUP BY 1),
r AS (SELECT id, coalesce(l.n, s.n, 'unknown') AS name FROM o LEFT JOIN l USING (id) LEFT JOIN (SELECT id, n FROM s WHERE id % 2 = 0) s USING (id))
SELECT id, name, row_number() OVER (ORDER BY name, id) AS pos FROM r""")
def _(spark, sf):
    o = B.table(spark, sf, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("filter"))
    l = B.table(spark, sf, "customer").where("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    s = B.table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("id")).agg(F.concat(F.lit("st"), F.min("l_suppkey").cast("string")).alias("name"))
    reg = R.build_registry(o, l, s.where("id % 2 = 0"), ["F", "O"])
    return R.numbered_registry(reg).select("id", "name", F.col("pos").cast("bigint").alias("pos"))


# --- appends ---------------------------------------------------------------------

BATCH = """WITH old AS (SELECT event_id, event_type, value FROM events WHERE event_id % 3 <> 0), new AS (SELECT event_id, event_type, value * 2 AS value FROM events WHERE event_id % 2 = 0) """


def batches(spark, sf):
    e = B.table(spark, sf, "events").select("event_id", "event_type", "value")
    return e.where("event_id % 3 <> 0"), e.where("event_id % 2 = 0").withColumn("value", F.col("value") * 2)


@query("j10_append", "J10 U02 C05 K03", BATCH + """SELECT event_id, round(value, 4) AS value FROM old UNION ALL SELECT event_id, round(value, 4) FROM new ANTI JOIN old USING (event_id)""")
def _(spark, sf):
    old, new = batches(spark, sf)
    return AP.merged(old, new, ["event_id"]).select("event_id", r("value", 4).alias("value"))


@query("j10_replace", "J10 U05 C05 K03", BATCH + """SELECT event_id, round(value, 4) AS value FROM old ANTI JOIN new USING (event_id) UNION ALL SELECT event_id, round(value, 4) FROM new""")
def _(spark, sf):
    old, new = batches(spark, sf)
    return AP.merged(old, new, ["event_id"], replace=True).select("event_id", r("value", 4).alias("value"))


@query("a36_append_action", "A36", BATCH + """SELECT event_type, count(*) AS n_new, count(o.event_id) AS n_stored, CASE WHEN count(o.event_id) = count(*) THEN 'none' WHEN count(o.event_id) = 0 THEN 'add' ELSE 'append' END AS action
FROM new LEFT JOIN (SELECT event_id FROM old) o USING (event_id) GROUP BY event_type""")
def _(spark, sf):
    old, new = batches(spark, sf)
    return AP.append_action(old, new, ["event_id"], ["event_type"])


@query("u01_common_ids", "U01", BATCH + "SELECT event_id FROM old INTERSECT SELECT event_id FROM new")
def _(spark, sf):
    old, new = batches(spark, sf)
    return AP.common_ids(old, new, "event_id")


@query("u05_without", "U05", BATCH + "SELECT event_id FROM old EXCEPT SELECT event_id FROM new")
def _(spark, sf):
    old, new = batches(spark, sf)
    return AP.without(old, new, ["event_id"]).select("event_id")


# --- more column expressions over whole tables ------------------------------------

@query("f18_f19_f20_frame_geometry", "F18 F19 F20 F26 F29 F31", """WITH b AS (SELECT l_orderkey, l_partkey, l_linenumber, l_quantity AS q, l_discount * 100 - 5 AS a, l_tax * 100 AS c, l_extendedprice AS e FROM lineitem),
g AS (SELECT *, q / 10 AS cd11, a AS cd12, c AS cd21, -a - 1 AS cd22, 20 * q - 360 * CASE WHEN 20 * q >= 0 THEN floor(20 * q / 360) ELSE ceil(20 * q / 360) END - CASE WHEN a < c THEN 90 ELSE 0 END AS th FROM b),
h AS (SELECT *, CASE WHEN cd11 * cd22 - cd12 * cd21 >= 0 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS p, CASE WHEN th < 0 THEN th + 360 ELSE th END AS th2 FROM g)
SELECT l_orderkey, l_partkey, l_linenumber, round(CASE WHEN a <> 0 AND abs(c) <= abs(a) THEN sqrt(1 - pow(c / a, 2)) ELSE 0 END, 5) AS ell,
  round(CASE WHEN abs(p * cd11 + cd22) > 1e-9 THEN degrees(atan((p * cd21 - cd12) / (p * cd11 + cd22))) END, 5) + 0.0::DOUBLE AS pa,
  round(degrees(atan(0.0135::DOUBLE / (8000 + q))) * 3600, 6) AS scale, round(0.35::DOUBLE * q, 2) AS seeing, round(21.5::DOUBLE - 2.512::DOUBLE * log10(e), 5) AS mag,
  round(CASE WHEN th2 > 180 THEN th2 - 180 ELSE th2 END, 5) AS angle FROM h""")
def _(spark, sf):
    li = B.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", F.col("l_quantity").alias("q"), (F.col("l_discount") * 100 - 5).alias("a"),
                                               (F.col("l_tax") * 100).alias("c"), F.col("l_extendedprice").alias("e"))
    cd11, cd22 = F.col("q") / 10, -F.col("a") - 1
    parity = F.when(cd11 * cd22 - F.col("a") * F.col("c") >= 0, 1.0).otherwise(-1.0)
    flat = F.abs(parity * cd11 + cd22) <= 1e-9
    pa = F.when(~flat, S.position_angle(cd11, "a", "c", cd22))
    return li.select("l_orderkey", "l_partkey", "l_linenumber", r(P.ellipticity("a", "c"), 5).alias("ell"), r(pa, 5).alias("pa"),
                     r(S.plate_scale_deg(F.lit(0.0135), 8000 + F.col("q")) * 3600, 6).alias("scale"), r(P.seeing_arcsec("q"), 2).alias("seeing"),
                     r(P.catalogue_magnitude("e"), 5).alias("mag"), r(S.axis_angle_deg(20 * F.col("q"), "a", "c"), 5).alias("angle"))


@query("f27_pixel_to_sky", "F27 P20", with_(XY) + """, w AS (SELECT id, radians(-9.7e-5::DOUBLE * (x - 2 - 1024) + 1e-6::DOUBLE * (y - 22 - 1024)) AS xi, radians(1e-6::DOUBLE * (x - 2 - 1024) + 9.7e-5::DOUBLE * (y - 22 - 1024)) AS eta,
  radians((id * 0.37::DOUBLE) % 360) AS a0, radians((id * 0.11::DOUBLE) % 160 - 80) AS d0 FROM xy),
s AS (SELECT id, degrees(a0 + atan2(xi, cos(d0) - eta * sin(d0))) AS ra, degrees(atan((sin(d0) + eta * cos(d0)) / sqrt(xi * xi + pow(cos(d0) - eta * sin(d0), 2)))) AS dec FROM w)
SELECT id, round(ra - 360 * floor(ra / 360), 6) AS ra, round(dec, 6) AS dec FROM s""")
def _(spark, sf):
    s = xy(spark, sf).withColumn("cx", F.lit(1024.0) + 2).withColumn("cy", F.lit(1024.0) + 22)
    ra, dec = S.tan_to_sky("x", "y", "cx", "cy", (F.col("id") * F.lit(0.37)) % 360, (F.col("id") * F.lit(0.11)) % 160 - 80,
                           F.lit(-9.7e-5), F.lit(1e-6), F.lit(1e-6), F.lit(9.7e-5))
    return s.select("id", r(ra).alias("ra"), r(dec).alias("dec"))
