"""Frame inventory, calibration look-back, masters and stacks."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import bindings as B
from ..functions import naming as N
from ..functions import quality as QL
from ..operators import calibration as C
from ..operators import frames as FR
from ..session import cut
from .lightcurves import clip_sql
from .registry import query, r, with_

FC = with_(B.FRAMES_SQL, B.CLASS_SQL)


def classed(spark, sf):
    return FR.classify(B.frames(spark, sf))


@query("p01_classify_frames", "P01", FC + "SELECT frame_id, class FROM classed WHERE class IS NOT NULL")
def _(spark, sf):
    return classed(spark, sf).select("frame_id", "class")


@query("a01_class_counts", "A01 C03", FC + """
SELECT date, count_if(class = 'science')::BIGINT AS n_science, count_if(class = 'dithered')::BIGINT AS n_dithered,
  count_if(class = 'dark')::BIGINT AS n_dark, count_if(class = 'bias')::BIGINT AS n_bias, count_if(class = 'flat')::BIGINT AS n_flat
FROM classed WHERE class IS NOT NULL GROUP BY date""")
def _(spark, sf):
    return FR.class_counts(classed(spark, sf), ["date"])


@query("a01_field_filter_counts", "A01 K01", FC + """
SELECT field, filter, class, count(*) AS n FROM classed WHERE class IS NOT NULL GROUP BY ALL""")
def _(spark, sf):
    return classed(spark, sf).groupBy("field", "filter", "class").agg(F.count("*").alias("n"))


@query("a29_night_targets", "A29 P02 U03", FC + """
SELECT DISTINCT date, CASE WHEN contains(object, '_2') AND length(object) = 13 THEN replace(object, '_2', '') ELSE object END AS target
FROM classed WHERE class = 'science'""")
def _(spark, sf):
    c = classed(spark, sf).where("class = 'science'")
    return c.select("date", FR.field_name().alias("target")).distinct()


@query("p03_p05_instrument", "P03 P05", FC + """
SELECT frame_id, CASE WHEN contains(upper(telescop), 'MOANA') THEN 'moana' WHEN naxis2 = 1280 THEN 'spirit' ELSE 'andor' END AS camera,
  (CASE WHEN contains(upper(telescop), 'ARTEMIS') THEN 1.1 ELSE 1.0029 END)::DOUBLE AS gain,
  (CASE WHEN contains(upper(telescop), 'ARTEMIS') THEN 2482 ELSE 2390 END)::DOUBLE AS altitude FROM frames""")
def _(spark, sf):
    f = B.frames(spark, sf)
    return f.select("frame_id", QL.camera("telescop", "naxis2").alias("camera"),
                    QL.site_constant("telescop", "gain").alias("gain"), QL.site_constant("telescop", "altitude").alias("altitude"))


@query("p04_regions", "P04", with_(B.PIX_SQL) + """
SELECT filter, frame, count_if(y >= 2088 - 15 AND x >= 4)::BIGINT AS n_overscan,
  count_if(y >= 22 AND y < 2066 AND x >= 2 AND x < 2048)::BIGINT AS n_andor,
  count_if(y >= 1 AND y < 1279 AND x >= 1 AND x < 49)::BIGINT AS n_moana FROM pix GROUP BY ALL""")
def _(spark, sf):
    p = B.pix(spark, sf)
    return p.groupBy("filter", "frame").agg(
        F.count_if(QL.in_overscan(F.lit("andor"), "y", "x", F.lit(2088))).alias("n_overscan"),
        F.count_if(QL.in_trim(F.lit("andor"), "y", "x", F.lit(2048), F.lit(2088))).alias("n_andor"),
        F.count_if(QL.in_trim(F.lit("moana"), "y", "x", F.lit(50), F.lit(1280))).alias("n_moana"))


@query("p12_p13_solution_state", "P12 P13 A47", FC + """
SELECT frame_id, coalesce(wcscompl, true) AS usable, ctype1 IS NULL AS unsolved, o.o_orderkey IS NOT NULL AS wcscompl
FROM frames LEFT JOIN (SELECT DISTINCT l_orderkey AS o_orderkey FROM lineitem WHERE l_quantity > 48) o ON o.o_orderkey = frame_id""")
def _(spark, sf):
    f = B.frames(spark, sf).withColumn("usable", FR.has_wcs()).withColumn("unsolved", F.col("ctype1").isNull())
    solved = B.table(spark, sf, "lineitem").where("l_quantity > 48").select(F.col("l_orderkey").alias("frame_id"))
    return FR.with_solution_state(f, solved, "frame_id").select("frame_id", "usable", "unsolved", "wcscompl")


@query("p14_of_target", "P14", FC + """
SELECT frame_id FROM frames WHERE NOT coalesce(lower(imagetyp) = 'light frame' AND object <> 'SP0001-0003', false)""")
def _(spark, sf):
    return FR.of_target(B.frames(spark, sf), "SP0001-0003").select("frame_id")


@query("p15_busy_fields", "P15", FC + """
SELECT field, filter, count(*) AS n FROM classed WHERE class = 'science' GROUP BY ALL HAVING count(*) > 4""")
def _(spark, sf):
    return FR.busy_fields(classed(spark, sf), ["field", "filter"])


@query("p16_without_first", "P16 W14", FC + """
SELECT frame_id, date, filter FROM (SELECT *, row_number() OVER (PARTITION BY date, filter ORDER BY frame_id) AS rn FROM classed
  WHERE class = 'science') WHERE rn > 1""")
def _(spark, sf):
    c = classed(spark, sf).where("class = 'science'")
    return FR.without_first(c, ["date", "filter"], "frame_id").select("frame_id", "date", "filter")


@query("p21_with_flat", "P21", FC + """
SELECT s.date, s.filter, count(*) AS n FROM classed s WHERE class = 'science' AND EXISTS (
  SELECT 1 FROM classed f WHERE f.class = 'flat' AND f.filter = s.filter) GROUP BY ALL""")
def _(spark, sf):
    c = classed(spark, sf)
    return FR.with_flat(c.where("class = 'science'"), c.where("class = 'flat'")).groupBy("date", "filter").agg(F.count("*").alias("n"))


def _night_counts(c, kind, *keys):
    return c.where(F.col("class") == kind).groupBy("date", *keys).agg(F.count("*").alias("n"))


def _look_back_sql(kind: str, minimum: int) -> str:
    return FC + f""", nights AS (SELECT DISTINCT date FROM classed WHERE class = 'science'),
c AS (SELECT date, count(*) AS n FROM classed WHERE class = '{kind}' GROUP BY date HAVING count(*) >= {minimum}),
j AS (SELECT n.date, max(c.date) AS cal_date FROM nights n LEFT JOIN c ON c.date <= n.date
  AND date_diff('day', strptime(c.date, '%Y%m%d'), strptime(n.date, '%Y%m%d')) <= 99 GROUP BY n.date)
SELECT j.date, cal_date, c.n AS n_cal FROM j LEFT JOIN c ON c.date = cal_date"""


def _single(kind, minimum):
    def run(spark, sf):
        c = classed(spark, sf)
        nights = c.where("class = 'science'").select("date").distinct()
        return FR.look_back_single(nights, _night_counts(c, kind), minimum)

    return run


query("j15_bias_look_back", "J15", _look_back_sql("bias", 2))(_single("bias", 2))
query("j15_dark_look_back", "J15", _look_back_sql("dark", 1))(_single("dark", 1))


@query("j15_w05_flat_look_back", "J15 W05 U04", FC + """
, nights AS (SELECT DISTINCT date, filter, (strptime(date, '%Y%m%d')::DATE - DATE '1970-01-01') AS day FROM classed WHERE class = 'science'),
c AS (SELECT date, filter, (strptime(date, '%Y%m%d')::DATE - DATE '1970-01-01') AS day, count(*) AS n FROM classed WHERE class = 'flat' GROUP BY ALL),
j AS (SELECT n.date, n.filter, c.date AS cdate, c.n, sum(c.n) OVER (PARTITION BY n.date, n.filter ORDER BY c.day DESC ROWS UNBOUNDED PRECEDING) AS cum
  FROM nights n JOIN c ON c.filter = n.filter AND c.day <= n.day AND c.day >= n.day - 1095),
u AS (SELECT date, filter, min(cdate) AS first_date, sum(n)::BIGINT AS n_flats FROM j WHERE cum - n < 4 GROUP BY ALL)
SELECT date, filter, first_date, coalesce(n_flats, 0)::BIGINT AS n_flats FROM nights LEFT JOIN u USING (date, filter)""")
def _(spark, sf):
    c = classed(spark, sf)
    nights = c.where("class = 'science'").select("date", "filter").distinct()
    return FR.look_back_accumulate(nights, cut(_night_counts(c, "flat", "filter")))


@query("w10_chunks", "W10", FC + """
SELECT frame_id, filter, floor((row_number() OVER (PARTITION BY filter ORDER BY frame_id) - 1) / 50)::BIGINT AS chunk
FROM classed WHERE class = 'flat'""")
def _(spark, sf):
    c = classed(spark, sf).where("class = 'flat'").select("frame_id", "filter")
    return FR.chunked(c, ["filter"], ["frame_id"])


@query("w11_mid_selection", "W11 O06", FC + """
, i AS (SELECT *, row_number() OVER (PARTITION BY field, filter ORDER BY frame_id) AS i, count(*) OVER (PARTITION BY field, filter) AS n
  FROM classed WHERE class = 'science'),
k AS (SELECT *, row_number() OVER (PARTITION BY field, filter ORDER BY i) AS k FROM i WHERE n < 30 OR (i - 1 >= n / 2 AND NOT contains(lower(object), 'dupe')))
SELECT frame_id, field, filter FROM k WHERE k <= 30""")
def _(spark, sf):
    c = classed(spark, sf).where("class = 'science'")
    return FR.mid_selection(c, ["field", "filter"], ["frame_id"], "object", 30).select("frame_id", "field", "filter")


@query("w13_star_labels", "W13", """
SELECT c_custkey AS id, 'SP' || lpad((row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) - 1)::VARCHAR, 6, '0') AS label FROM customer""")
def _(spark, sf):
    from ..operators.ordered import numbered

    c = B.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), "c_acctbal")
    return numbered(c, [F.col("c_acctbal").desc(), F.col("id")]).select("id", N.star_label("pos").alias("label"))


# --- calibration --------------------------------------------------------------

OVER_X = 46
OV = with_(B.PIX_SQL, clip_sql(f"(SELECT * FROM pix WHERE x >= {OVER_X})", "filter, frame", "adu", 3.0, 8, "o"),
           "lev AS (SELECT filter, frame, median(c) AS overscan FROM o8 GROUP BY ALL)",
           f"sub AS (SELECT p.* , adu - coalesce(overscan, 0) AS v FROM pix p LEFT JOIN lev USING (filter, frame) WHERE x < {OVER_X})",
           "fl AS (SELECT filter, frame, (row_number() OVER (PARTITION BY filter ORDER BY frame) - 1) // 50 AS chunk FROM (SELECT DISTINCT filter, frame FROM sub))")
BIAS = OV + ", " + clip_sql("(SELECT * FROM sub JOIN fl USING (filter, frame))", "filter, y, x, chunk", "v", 3.0, 8, "b") + """,
bias AS (SELECT filter, y, x, avg(m) AS bias, count(m) AS n_chunks FROM (
  SELECT filter, y, x, chunk, median(c) AS m FROM b8 GROUP BY ALL) GROUP BY ALL)"""
DARK = BIAS + ", " + clip_sql("(SELECT s.*, chunk, (v - coalesce(bias, 0)) / exptime AS d FROM sub s JOIN fl USING (filter, frame) LEFT JOIN bias USING (filter, y, x))",
                              "filter, y, x, chunk", "d", 3.0, 5, "d") + """,
dark AS (SELECT filter, y, x, avg(m) AS dark FROM (SELECT filter, y, x, chunk, median(c) AS m FROM d5 GROUP BY ALL) GROUP BY ALL)"""
CORR = DARK + """, corr AS (SELECT s.filter, s.frame, s.y, s.x, exptime, v - coalesce(bias, 0) - coalesce(dark, 0) * exptime + 40 AS c
  FROM sub s LEFT JOIN bias USING (filter, y, x) LEFT JOIN dark USING (filter, y, x))"""
FLAT = CORR + ", " + clip_sql("(SELECT filter, frame, y, x, exptime, c AS cc FROM corr)", "filter, frame", "cc", 3.0, 8, "g") + """,
sc AS (SELECT filter, frame, avg(c) AS scale, stddev_pop(c) AS scale_std, median(CASE WHEN y BETWEEN 5 AND 30 THEN cc END) AS level FROM g8 GROUP BY ALL),
pf AS (SELECT filter, y, x, median(c / scale) AS m, stddev_pop(c / scale) AS std, var_pop(c / scale) AS variance FROM corr JOIN sc USING (filter, frame) GROUP BY ALL),
flat AS (SELECT filter, y, x, std, variance, m / avg(m) OVER (PARTITION BY filter) AS flat FROM pf)"""


def _pix(spark, sf):
    return cut(B.pix(spark, sf)), F.col("x") >= OVER_X


@query("a06_overscan", "A06 A03", OV + "SELECT filter, frame, round(overscan, 6) AS overscan FROM lev")
def _(spark, sf):
    p, region = _pix(spark, sf)
    return C.overscan_levels(p, ["filter"], region).select("filter", "frame", r("overscan").alias("overscan"))


@query("a04_master_bias", "A04 W10", BIAS + "SELECT filter, y, x, round(bias, 6) AS bias, n_chunks FROM bias")
def _(spark, sf):
    p, region = _pix(spark, sf)
    return C.master_bias(p, ["filter"], region).select("filter", "y", "x", r("bias").alias("bias"), "n_chunks")


@query("a05_readout_noise", "A05 W14", with_(B.PIX_SQL) + """
, f AS (SELECT filter, frame, row_number() OVER (PARTITION BY filter ORDER BY frame) AS rk FROM (SELECT DISTINCT filter, frame FROM pix)),
d AS (SELECT filter, cell, max(CASE WHEN rk = 1 THEN adu END) AS b0, max(CASE WHEN rk = 2 THEN adu END) AS b1
  FROM pix JOIN f USING (filter, frame) WHERE rk <= 2 GROUP BY ALL)
SELECT filter, round(stddev_pop(b1 - b0) * 1.1::DOUBLE / sqrt(2.0), 6) AS ron FROM d GROUP BY filter""")
def _(spark, sf):
    return C.readout_noise(B.pix(spark, sf), ["filter"], 1.1).select("filter", r("ron").alias("ron"))


@query("a07_master_dark", "A07", DARK + "SELECT filter, y, x, round(dark, 5) + 0.0::DOUBLE AS dark FROM dark")
def _(spark, sf):
    p, region = _pix(spark, sf)
    bias = cut(C.master_bias(p, ["filter"], region))
    return C.master_dark(p, ["filter"], region, bias).select("filter", "y", "x", r("dark", 5).alias("dark"))


@query("a08_dark_current", "A08", DARK + ", " + clip_sql("dark", "filter", "dark", 3.0, 5, "z") + """
SELECT filter, round(median(c) * 1.1::DOUBLE, 5) AS dark_current FROM z5 GROUP BY filter""")
def _(spark, sf):
    p, region = _pix(spark, sf)
    bias = cut(C.master_bias(p, ["filter"], region))
    dark = cut(C.master_dark(p, ["filter"], region, bias))
    return C.dark_current(dark, ["filter"], 1.1).select("filter", r("dark_current", 5).alias("dark_current"))


def _corrected(spark, sf):
    p, region = _pix(spark, sf)
    bias = cut(C.master_bias(p, ["filter"], region))
    dark = cut(C.master_dark(p, ["filter"], region, bias))
    levels = cut(C.overscan_levels(p, ["filter"], region))
    c = C.corrected(p, ["filter"], region, bias, dark, levels)
    return cut(c.withColumn("c", F.col("c") + 40))  # a pedestal so that the flats are bright


@query("a09_flat_scales", "A09", FLAT + """
SELECT filter, frame, round(scale, 5) AS scale, round(scale_std, 5) AS scale_std, round(level, 5) AS level FROM sc""")
def _(spark, sf):
    s = C.flat_scales(_corrected(spark, sf), ["filter"], F.col("y").between(5, 30))
    return s.select("filter", "frame", r("scale", 5).alias("scale"), r("scale_std", 5).alias("scale_std"), r("level", 5).alias("level"))


@query("a10_master_flat", "A10 C04", FLAT + """
SELECT filter, y, x, round(flat, 5) AS flat, round(std, 5) AS std, round(variance, 5) AS variance FROM flat""")
def _(spark, sf):
    c = _corrected(spark, sf)
    f = C.master_flat(c, cut(C.flat_scales(c, ["filter"])), ["filter"])
    return f.select("filter", "y", "x", r("flat", 5).alias("flat"), r("std", 5).alias("std"), r("variance", 5).alias("variance"))


@query("j16_calibrate", "J16 F37 C04 P16 P21", FLAT + """
SELECT filter, frame, y, x, round(c / nullif(flat, 0), 4) AS reduced
FROM (SELECT *, min(frame) OVER (PARTITION BY filter) AS f0 FROM corr) JOIN flat USING (filter, y, x) WHERE frame > f0 AND filter <> 'N'""")
def _(spark, sf):
    c = _corrected(spark, sf)
    flats = c.where("filter <> 'N'")  # one filter has no flat: its science frames are left out
    f = cut(C.master_flat(flats, cut(C.flat_scales(flats, ["filter"])), ["filter"]))
    science = FR.with_flat(FR.without_first(c, ["filter"], "frame"), flats)
    return C.calibrate(science, f, ["filter"]).select("filter", "frame", "y", "x", r("reduced", 4).alias("reduced"))


@query("a11_stack", "A11 W11", with_(B.PIX_SQL) + """
, fr AS (SELECT *, row_number() OVER (PARTITION BY filter ORDER BY frame) AS i, count(*) OVER (PARTITION BY filter) AS n
  FROM (SELECT DISTINCT filter, frame FROM pix)),
ch AS (SELECT filter, frame FROM (SELECT *, row_number() OVER (PARTITION BY filter ORDER BY i) AS k FROM fr WHERE n < 30 OR i - 1 >= n / 2) WHERE k <= 30)
SELECT filter, y, x, round(median(adu), 6) AS stack, count(*) AS n FROM pix JOIN ch USING (filter, frame) GROUP BY ALL""")
def _(spark, sf):
    p = B.pix(spark, sf)
    frames = p.select("filter", "frame").distinct().withColumn("name", F.col("frame").cast("string"))
    chosen = FR.mid_selection(frames, ["filter"], ["frame"], "name", 30)
    return C.stack_median(p, chosen, ["filter"]).select("filter", "y", "x", r("stack").alias("stack"), "n")


@query("a12_cloud_metric", "A12", with_(B.PIX_SQL) + """
SELECT filter, frame, round(CASE WHEN stddev_pop(adu) > 0 THEN avg(adu) / stddev_pop(adu) END, 6) AS cloud FROM pix GROUP BY ALL""")
def _(spark, sf):
    return C.cloud_metric(B.pix(spark, sf), ["filter", "frame"]).select("filter", "frame", r("cloud").alias("cloud"))


@query("a42_local_background", "A42", with_(B.PIX_SQL, clip_sql("(SELECT *, y // 32 AS ty, x // 32 AS tx FROM pix)", "filter, frame, ty, tx", "adu", 3.0, 5, "t")) + """
, l AS (SELECT filter, frame, y, x, adu - median(c) OVER (PARTITION BY filter, frame, ty, tx) AS res FROM t5)
SELECT filter, frame, y, x, round(res - median(res) OVER (PARTITION BY filter, frame, y), 5) + 0.0::DOUBLE AS residual FROM l""")
def _(spark, sf):
    b = C.local_background(B.pix(spark, sf), ["filter", "frame"])
    return b.select("filter", "frame", "y", "x", r("residual", 5).alias("residual"))
