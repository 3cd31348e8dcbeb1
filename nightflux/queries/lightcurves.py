"""Light-curve, ensemble and re-weighting queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import bindings as B
from ..functions import photometry as P
from ..operators import ensemble as E
from ..operators import lightcurve as L
from ..operators import grouped as G
from ..session import cut
from .registry import query, r, with_

BIN = 6.0
BOX = 6.0
LIMIT = 0.05
NORM = """norm AS (
  SELECT *, CASE WHEN m <> 0 THEN flux / m END AS nflux FROM (
    SELECT *, median(CASE WHEN flux > 0.001 THEN flux END) OVER (PARTITION BY star_id) AS m FROM lc))"""
EQUAL = """alc AS (
  SELECT jd, sum(nflux) / (SELECT count(DISTINCT star_id) FROM lc) AS alc FROM norm GROUP BY jd),
nalc AS (
  SELECT jd, alc / median(CASE WHEN alc > 0.001 THEN alc END) OVER () AS nlc FROM alc)"""
DIFF = """ratio AS (SELECT star_id, n.jd, nflux / nlc AS d FROM norm n JOIN nalc USING (jd)),
diff AS (SELECT star_id, jd, d / median(CASE WHEN d > 0.001 THEN d END) OVER (PARTITION BY star_id) AS diff FROM ratio)"""


def normalised(spark, sf):
    """Normalised light curves as a stored table, like the condensed output they stand for."""
    lc = cut(B.lc(spark, sf))
    return cut(G.normalise(lc, ["star_id"], "flux", "nflux", stored=True))


def equal_weights(lc):
    return E.total_weights(
        lc.select("star_id").distinct().withColumns({w: F.lit(1.0) for w in ("w1", "w2", "w3")}), []
    )


@query("diff_lightcurve_binned", "A13 A14 A15 A16 A46 C01", with_(B.LC_SQL, NORM, EQUAL, DIFF) + f"""
SELECT star_id, bin, round(avg(jd), 6) AS bin_t, round(avg(diff), 6) AS bin_y,
  round(1.253::DOUBLE * stddev_pop(diff) / sqrt(count(diff)), 6) AS bin_err, count(diff) AS n
FROM (SELECT star_id, jd, diff, greatest(1, ceil((jd - min(jd) OVER (PARTITION BY star_id)) / {BIN}))::BIGINT AS bin FROM diff)
WHERE diff IS NOT NULL GROUP BY star_id, bin""")
def _(spark, sf):
    lc = normalised(spark, sf)
    alc = E.ensemble_curve(lc, equal_weights(lc), [])
    d = E.differential(lc, alc, [])
    b = L.time_bin(d, ["star_id"], "jd", "diff", BIN)
    return b.select("star_id", "bin", r("bin_t").alias("bin_t"), r("bin_y").alias("bin_y"), r("bin_err").alias("bin_err"), "n")


@query("a02_star_statistics", "A02", with_(B.LC_SQL) + """
SELECT star_id, round(avg(flux), 3) AS flux_mean, round(median(flux), 3) AS flux_median FROM lc GROUP BY star_id""")
def _(spark, sf):
    s = L.star_statistics(B.lc(spark, sf), ["star_id"])
    return s.select("star_id", r("flux_mean", 3).alias("flux_mean"), r("flux_median", 3).alias("flux_median"))


@query("a13_normalise", "A13", with_(B.LC_SQL, NORM) + """
SELECT star_id, frame, round(nflux, 6) AS nflux FROM norm""")
def _(spark, sf):
    return normalised(spark, sf).select("star_id", "frame", r("nflux").alias("nflux"))


@query("a13_normalise_plain", "A13", with_(B.LC_SQL) + """
SELECT star_id, frame, round(flux / median(flux) OVER (PARTITION BY star_id), 6) AS nflux FROM lc""")
def _(spark, sf):
    n = G.normalise(B.lc(spark, sf), ["star_id"], "flux", "nflux", floor=None)
    return n.select("star_id", "frame", r("nflux").alias("nflux"))


@query("a14_ensemble_curve", "A14 A15 D9", with_(B.LC_SQL, NORM, EQUAL) + """
SELECT jd, round(alc, 6) AS alc, round(nlc, 6) AS nlc FROM nalc JOIN alc USING (jd)""")
def _(spark, sf):
    lc = normalised(spark, sf)
    a = E.ensemble_curve(lc, equal_weights(lc), [])
    return a.select("jd", r("alc").alias("alc"), r("nlc").alias("nlc"))


WEIGHTS = """w0 AS (
  SELECT star_id, median(flux) AS w1, 1 + 1.0::DOUBLE / (1 + star_id) AS w2, (star_id % 3)::DOUBLE AS w3
  FROM lc GROUP BY star_id),
wt AS (
  SELECT star_id, w1 / sum(w1) OVER () AS w1, w2 / sum(w2) OVER () AS w2, w3 / sum(w3) OVER () AS w3,
    w1 * w2 * w3 / sum(w1 * w2 * w3) OVER () AS weight FROM w0)"""


def some_weights(spark, sf):
    med = G.medians(B.lc(spark, sf), ["star_id"], {"w1": "flux"})
    w = med.withColumn("w2", 1 + 1.0 / (1 + F.col("star_id"))).withColumn("w3", (F.col("star_id") % 3).cast("double"))
    return E.total_weights(w, [])


@query("a15_total_weights", "A15", with_(B.LC_SQL, WEIGHTS) + """
SELECT star_id, round(w1, 9) AS w1, round(w2, 9) AS w2, round(w3, 9) AS w3, round(weight, 9) AS weight FROM wt""")
def _(spark, sf):
    w = some_weights(spark, sf)
    return w.select("star_id", *[r(c, 9).alias(c) for c in ("w1", "w2", "w3", "weight")])


@query("w04_effective_stars", "W04", with_(B.LC_SQL, WEIGHTS) + """
SELECT min(CASE WHEN cum > 0.95 THEN rank END) AS n_stars, max(weight) > 0.95 AS dominated FROM (
  SELECT weight, sum(weight) OVER w AS cum, row_number() OVER w AS rank FROM wt
  WINDOW w AS (ORDER BY weight DESC, star_id ROWS UNBOUNDED PRECEDING))""")
def _(spark, sf):
    return E.effective_stars(some_weights(spark, sf), []).select(F.col("n_stars").cast("bigint").alias("n_stars"), "dominated")


@query("w08_weight_order", "W08 O02", with_(B.LC_SQL, WEIGHTS) + """
SELECT star_id, row_number() OVER (ORDER BY (star_id = 1)::INT DESC, weight DESC, star_id) AS rank FROM wt""")
def _(spark, sf):
    w = E.weight_order(some_weights(spark, sf), [], F.col("star_id") == 1)
    return w.select("star_id", F.col("rank").cast("bigint").alias("rank"))


@query("o03_heaviest_five", "O03", with_(B.LC_SQL, WEIGHTS) + """
SELECT star_id, round(weight, 9) AS weight FROM wt ORDER BY weight DESC, star_id LIMIT 5""")
def _(spark, sf):
    w = some_weights(spark, sf).orderBy(F.col("weight").desc(), "star_id").limit(5)
    return w.select("star_id", r("weight", 9).alias("weight"))


@query("a39_comparison_series", "A39 O04", with_(B.LC_SQL, WEIGHTS, """
top AS (SELECT star_id FROM wt ORDER BY weight DESC, star_id LIMIT 10),
cf AS (SELECT jd, median(flux) AS comp_flux FROM lc SEMI JOIN top USING (star_id) GROUP BY jd)""") + """
SELECT jd, round(comp_flux / median(CASE WHEN comp_flux > 0.001 THEN comp_flux END) OVER (), 6) AS comp FROM cf""")
def _(spark, sf):
    c = E.comparison_series(B.lc(spark, sf), some_weights(spark, sf), [])
    return c.select("jd", r("comp").alias("comp"))


@query("a16_time_bin", "A16", with_(B.SERIES_SQL) + """
SELECT series, bin, round(avg(t), 5) AS bin_t, round(avg(y), 5) AS bin_y,
  round(1.253::DOUBLE * stddev_pop(y) / sqrt(count(y)), 5) AS bin_err, count(y) AS n
FROM (SELECT *, greatest(1, ceil((t - min(t) OVER (PARTITION BY series)) / (5.0::DOUBLE / 1440)))::BIGINT AS bin FROM series)
GROUP BY series, bin""")
def _(spark, sf):
    b = L.time_bin(B.series(spark, sf), ["series"], "t", "y", 5.0 / 1440)
    return b.select("series", "bin", r("bin_t", 5).alias("bin_t"), r("bin_y", 5).alias("bin_y"), r("bin_err", 5).alias("bin_err"), "n")


@query("a17_time_bin_median", "A17", with_(B.SERIES_SQL) + """
SELECT series, bin, round(min(t), 5) AS bin_t, round(median(y), 5) AS bin_y, count(*) AS n
FROM (SELECT *, greatest(1, ceil((t - min(t) OVER (PARTITION BY series)) / (20.0::DOUBLE / 1440)))::BIGINT AS bin FROM series)
GROUP BY series, bin HAVING median(y) <> 0""")
def _(spark, sf):
    b = L.time_bin_median(B.series(spark, sf), ["series"], "t", "y", 20.0 / 1440)
    return b.select("series", "bin", r("bin_t", 5).alias("bin_t"), r("bin_y", 5).alias("bin_y"), "n")


@query("a18_scatter", "A18", with_(B.LC_SQL, NORM, EQUAL, DIFF) + f"""
, b AS (SELECT star_id, bin, avg(diff) AS y, 1.253::DOUBLE * stddev_pop(diff) / sqrt(count(diff)) AS e FROM (
    SELECT star_id, diff, greatest(1, ceil((jd - min(jd) OVER (PARTITION BY star_id)) / {BIN}))::BIGINT AS bin FROM diff)
  GROUP BY star_id, bin)
SELECT star_id, round(s.rms, 6) AS rms, round(avg(e), 6) AS mean_bin_err, round(stddev_pop(y), 6) AS bin_rms
FROM b JOIN (SELECT star_id, stddev_pop(diff) AS rms FROM diff GROUP BY star_id) s USING (star_id) GROUP BY star_id, s.rms""")
def _(spark, sf):
    lc = normalised(spark, sf)
    d = E.differential(lc, E.ensemble_curve(lc, equal_weights(lc), []), [])
    s = L.scatter(d, ["star_id"], "jd", "diff", BIN)
    return s.select("star_id", r("rms").alias("rms"), r("mean_bin_err").alias("mean_bin_err"), r("bin_rms").alias("bin_rms"))


@query("a20_best_aperture", "A20 S05", with_(B.LC_AP_SQL, """
norm AS (SELECT *, flux / median(CASE WHEN flux > 0.001 THEN flux END) OVER (PARTITION BY ap, star_id) AS nflux FROM lc),
b AS (SELECT ap, star_id, bin, avg(nflux) AS y, 1.253::DOUBLE * stddev_pop(nflux) / sqrt(count(nflux)) AS e FROM (
    SELECT ap, star_id, nflux, greatest(1, ceil((jd - min(jd) OVER (PARTITION BY ap, star_id)) / 6.0))::BIGINT AS bin
    FROM norm WHERE ap BETWEEN 3 AND 7) GROUP BY ALL),
s AS (SELECT ap, star_id, avg(e) * stddev_pop(y) AS score FROM b GROUP BY ALL)""") + """
SELECT star_id, arg_min(ap, (round(score, 12), ap)) AS best_ap, round(min(score), 7) AS score FROM s GROUP BY star_id""")
def _(spark, sf):
    lc = B.lc(spark, sf, by_aperture=True).where(F.col("ap").between(3, 7))
    n = G.normalise(lc, ["ap", "star_id"], "flux", "nflux")
    s = L.scatter(n, ["ap", "star_id"], "jd", "nflux", 6.0)
    return E.best_aperture(s, ["star_id"]).select("star_id", "best_ap", r("score", 7).alias("score"))


FLAGS_CTE = """joined AS (
  SELECT star_id, jd, CASE WHEN flux > 0.1 THEN flux END AS flux, peak, exptime FROM lc JOIN env USING (frame, jd))"""


def clip_sql(src: str, keys: str, val: str, k: float, rounds: int, name: str, side: str = "both") -> str:
    """Unrolled clip: CTEs name0..nameN; the last one has column c (kept value or NULL)."""
    parts = [f"{name}0 AS (SELECT *, {val} AS c FROM {src})"]
    lo = "" if side == "high" else f"c < m - {k}::DOUBLE * s OR "
    over = f"PARTITION BY {keys}" if keys else ""
    for i in range(rounds):
        parts.append(
            f"{name}{i + 1} AS (SELECT * EXCLUDE (c, m, s), CASE WHEN NOT ({lo}c > m + {k}::DOUBLE * s) THEN c END AS c FROM ("
            f"SELECT *, median(c) OVER ({over}) AS m, stddev_pop(c) OVER ({over}) AS s FROM {name}{i}))"
        )
    return ",\n".join(parts)


@query("p07_quality_flags", "P06 P07", with_(B.LC_SQL, B.ENV_SQL, FLAGS_CTE, clip_sql("joined", "star_id", "flux", 7.0, 5, "k")) + """
, g AS (SELECT star_id, max(peak) AS mp, count(flux) AS nf, median(c) AS cm, median(flux / exptime) AS rate FROM k5 GROUP BY star_id)
SELECT star_id, mp > 75000 AS saturated, NOT (mp > 75000) AND (nf = 0 OR cm < 100 OR rate < 10) AS lowflux,
  round(cm, 3) AS clipped_median, round(rate, 4) AS rate FROM g""")
def _(spark, sf):
    lc = flagged_input(spark, sf)
    f = L.quality_flags(lc, ["star_id"], "exptime", saturation=75000.0, stored=True)
    return f.select("star_id", "saturated", "lowflux", r("clipped_median", 3).alias("clipped_median"), r("rate", 4).alias("rate"))


def flagged_input(spark, sf):
    lc = B.lc(spark, sf).join(B.env(spark, sf).drop("jd"), "frame")
    return cut(lc.withColumn("flux", P.positive_flux("flux")))


@query("a45_initial_weights", "A45", with_(B.LC_SQL, B.ENV_SQL, FLAGS_CTE, clip_sql("joined", "star_id", "flux", 7.0, 5, "k")) + """
, g AS (SELECT star_id, median(flux) AS w, max(peak) > 75000 AS sat,
    count(flux) = 0 OR median(c) < 100 OR median(flux / exptime) < 10 AS low FROM k5 GROUP BY star_id)
SELECT star_id, round(CASE WHEN sat OR low THEN 0 ELSE w END, 3) AS w1,
  (CASE WHEN sat OR low THEN 0 ELSE 1 END)::DOUBLE AS weight FROM g""")
def _(spark, sf):
    lc = flagged_input(spark, sf)
    f = L.quality_flags(lc, ["star_id"], "exptime", saturation=75000.0, stored=True)
    return L.initial_weights(lc, f, ["star_id"], stored=True).select("star_id", r("w1", 3).alias("w1"), "weight")


@query("a37_preclean", "A37", with_(B.LC_SQL, """
norm0 AS (SELECT *, flux / median(flux) OVER (PARTITION BY star_id) AS nflux FROM lc)""",
    clip_sql("norm0", "jd", "CASE WHEN nflux > 0.2 THEN nflux END", 3.0, 12, "k")) + """
, tm AS (SELECT jd, count(c) > 0 AS good FROM k12 GROUP BY jd),
gb AS (SELECT count_if(good) AS good, count_if(NOT good) AS bad FROM tm)
SELECT star_id, (good + bad - count(c))::BIGINT AS masked, (good - count(c)) > 0.2 * good AS dropped
FROM k12, gb GROUP BY star_id, good, bad""")
def _(spark, sf):
    lc = normalised(spark, sf)
    p = E.preclean(lc, equal_weights(lc), [])
    return p.select("star_id", F.col("masked").cast("bigint").alias("masked"), "dropped")


STARS_SQL = """stars AS (
  SELECT star_id, median(flux) AS w1, 24.16::DOUBLE - 2.5::DOUBLE * log10(median(flux) * 1.1::DOUBLE / 100.0::DOUBLE) AS mag,
    max(peak) > 75000 AS saturated FROM lc GROUP BY star_id),
tgt AS (SELECT mag + 3.0::DOUBLE AS min_mag FROM stars WHERE star_id = 1),
br AS (SELECT max(mag) AS mx FROM (SELECT mag FROM stars WHERE NOT saturated AND star_id <> 1 ORDER BY mag, star_id LIMIT 20)),
lim AS (SELECT min_mag, CASE WHEN mx >= min_mag THEN min_mag - 1 ELSE mx END AS max_mag FROM br, tgt)"""


def sweep_inputs(spark, sf):
    lc = normalised(spark, sf)
    stars = G.medians(lc, ["star_id"], {"w1": "flux"}, (F.max("peak") > 75000).alias("saturated"), stored=True)
    stars = stars.withColumn("mag", P.instrumental_magnitude("w1", 1.1, 100.0)).withColumn("w2", F.lit(1.0))
    stars = cut(stars)
    target = stars.where("star_id = 1").select(F.col("mag").alias("target_mag"))
    return lc, stars.where("star_id <> 1"), target


@query("o05_cut_limits", "O05 W09", with_(B.LC_SQL, STARS_SQL) + """
SELECT round(max_mag, 6) AS max_mag, round(min_mag, 6) AS min_mag FROM lim""")
def _(spark, sf):
    _, stars, target = sweep_inputs(spark, sf)
    return E.magnitude_cuts(stars, target, []).select(r("max_mag").alias("max_mag"), r("min_mag").alias("min_mag"))


@query("a21_magnitude_sweep", "A21 J21 W09 O09 C02b", with_(B.LC_SQL, NORM, STARS_SQL, f"""
cuts AS (SELECT i AS cut, max_mag + i * ((min_mag - max_mag) / 49) AS cut_mag FROM lim, range(50) t(i)),
a AS (SELECT cut, cut_mag, jd, sum(nflux * w1) / any_value(sw) AS alc FROM cuts
  JOIN stars ON mag <= cut_mag AND star_id <> 1 JOIN norm USING (star_id)
  JOIN (SELECT cut, sum(w1) AS sw FROM cuts JOIN stars ON mag <= cut_mag AND star_id <> 1 GROUP BY cut) USING (cut)
  GROUP BY cut, cut_mag, jd),
na AS (SELECT cut, cut_mag, jd, alc / median(CASE WHEN alc > 0.001 THEN alc END) OVER (PARTITION BY cut) AS nlc FROM a),
f AS (SELECT jd, stddev_pop(nlc) OVER (ORDER BY jd RANGE BETWEEN 3.0 PRECEDING AND 3.0 FOLLOWING) > {LIMIT} OR nlc < 0.2 AS bad
  FROM na WHERE cut = (SELECT min(cut) FROM na)),
u AS (SELECT count_if(bad) < 0.8 * count(*) AS um FROM f),
bn AS (SELECT cut, cut_mag, avg(y) AS yb, 1.253::DOUBLE * stddev_pop(y) / sqrt(count(y)) AS be FROM (
  SELECT cut, cut_mag, CASE WHEN NOT (bad AND um) THEN nlc END AS y,
    greatest(1, ceil((jd - min(jd) OVER (PARTITION BY cut)) / {BIN}))::BIGINT AS bin FROM na JOIN f USING (jd), u)
  WHERE y IS NOT NULL GROUP BY cut, cut_mag, bin)""") + """
SELECT cut::INT AS cut, round(cut_mag, 6) AS cut_mag, round(avg(be), 7) AS mean_err, round(stddev_pop(yb), 7) AS bin_std
FROM bn GROUP BY cut, cut_mag""")
def _(spark, sf):
    lc, stars, target = sweep_inputs(spark, sf)
    limits = cut(E.magnitude_cuts(stars, target, []))
    s = E.magnitude_sweep(lc, stars, limits, [], BIN, BOX, LIMIT, 50.0)
    return s.select("cut", r("cut_mag").alias("cut_mag"), r("mean_err", 7).alias("mean_err"), r("bin_std", 7).alias("bin_std"))


SEP_SQL = """sp AS (SELECT star_id, abs(sin(star_id * 0.7::DOUBLE)) + 0.01::DOUBLE AS sep FROM stars)"""


def separations(stars):
    return stars.withColumn("sep", F.abs(F.sin(F.col("star_id") * 0.7)) + 0.01)


@query("a22_distance_sweep", "A22 J21 F12", with_(B.LC_SQL, NORM, STARS_SQL, SEP_SQL, """
e AS (SELECT i AS step, 0.5::DOUBLE + i * (2.5::DOUBLE / 19) AS a FROM range(20) t(i)),
wd AS (SELECT step, a, star_id, w1 / (1 + pow(a * sep / max(sep) OVER (), 2)) AS w FROM stars JOIN sp USING (star_id), e WHERE star_id <> 1),
al AS (SELECT step, a, jd, sum(nflux * w) / any_value(sw) AS alc FROM wd JOIN norm USING (star_id)
  JOIN (SELECT step, sum(w) AS sw FROM wd GROUP BY step) USING (step) GROUP BY step, a, jd),
nl AS (SELECT *, alc / median(CASE WHEN alc > 0.001 THEN alc END) OVER (PARTITION BY step) AS nlc FROM al),
d AS (SELECT step, a, nflux / nlc AS d FROM nl JOIN norm n ON n.jd = nl.jd AND n.star_id = 1),
dd AS (SELECT step, a, d / median(CASE WHEN d > 0.001 THEN d END) OVER (PARTITION BY step) AS diff FROM d)""") + """
SELECT step::INT AS step, round(a, 6) AS a, round(stddev_pop(diff), 8) AS scatter FROM dd GROUP BY step, a""")
def _(spark, sf):
    lc, stars, _ = sweep_inputs(spark, sf)
    w = separations(stars).withColumn("w3", F.lit(1.0))
    s = E.distance_sweep(lc, w, lc.where("star_id = 1"), [])
    return s.select("step", r("a").alias("a"), r("scatter", 8).alias("scatter"))


def _round_sql(i: int) -> str:
    """One re-weighting round from weight table v{i-1} to v{i}."""
    return f"""al{i} AS (SELECT jd, sum(nflux * weight) AS alc FROM norm JOIN v{i-1} USING (star_id) GROUP BY jd),
nl{i} AS (SELECT jd, alc / median(CASE WHEN alc > 0.001 THEN alc END) OVER () AS nlc FROM al{i}),
fl{i} AS (SELECT jd, nlc, stddev_pop(nlc) OVER (ORDER BY jd RANGE BETWEEN 3.0 PRECEDING AND 3.0 FOLLOWING) > {LIMIT} OR nlc < 0.2 AS bad FROM nl{i}),
us{i} AS (SELECT count_if(bad) < 0.5 * count(*) AS um FROM fl{i}),
sg{i} AS (SELECT star_id, stddev_pop(CASE WHEN NOT (bad AND um) THEN nflux / nlc END)
    / median(CASE WHEN nflux / nlc > 0.001 THEN nflux / nlc END) AS sg FROM norm JOIN fl{i} USING (jd), us{i} GROUP BY star_id),
v{i} AS (SELECT star_id, w / sum(w) OVER () AS weight, p AS before FROM (
    SELECT v.star_id, CASE WHEN v.weight = 0 THEN 0 WHEN sg > 0 THEN 1 / (sg * sg) ELSE 0 END AS w, v.weight AS p
    FROM v{i-1} v JOIN sg{i} USING (star_id)))"""


@query("c02_reweight_three_rounds", "C02 A38 W04", with_(B.LC_SQL, NORM, STARS_SQL, """
v0 AS (SELECT star_id, w1 / sum(w1) OVER () AS weight FROM stars WHERE star_id <> 1)""",
    _round_sql(1), _round_sql(2), _round_sql(3)) + """
SELECT star_id, round(weight, 7) AS weight, round(avg(abs(weight - before)) OVER (), 8) AS change FROM v3""")
def _(spark, sf):
    lc, stars, _ = sweep_inputs(spark, sf)
    w = E.total_weights(stars.withColumn("w3", F.lit(1.0)).withColumn("w1_start", F.col("w1")), [])
    s = E.reweight(lc, w.drop("no_weight"), [], rounds=3, tolerance=0.0, box=BOX, threshold=LIMIT, bucket=50.0)
    return s.select("star_id", r("weight", 7).alias("weight"), r("change", 8).alias("change"))


@query("f08_f09_noise_model", "F07 F08 F09 D8", with_(B.LC_SQL, B.ENV_SQL, """
m AS (SELECT star_id, frame, exptime, airmass, sky, gain, height, 24.16::DOUBLE - 2.5::DOUBLE * log10(
    median(flux) OVER (PARTITION BY star_id) * gain / exptime) AS mag, avg(ron) OVER () AS ron,
    2 * sqrt(2)::DOUBLE * 4.0::DOUBLE AS rad FROM lc JOIN (SELECT * EXCLUDE (ron), (SELECT avg(ron) FROM env) AS ron FROM env) USING (frame)),
s AS (SELECT *, pow(10, (24.16::DOUBLE - mag) / 2.5::DOUBLE) * exptime AS sig, pi() * rad * rad AS np,
    1.27::DOUBLE * sqrt(1e-5::DOUBLE) * pow(airmass, 1.75::DOUBLE) * exp(-height / 8000.0::DOUBLE) / sqrt(exptime) AS sc FROM m)""") + """
SELECT star_id, frame, round(mag, 6) AS mag,
  round(sqrt(sig + np * ron * ron + sc * sc * sig * sig + np * sky * gain + np * 0.02::DOUBLE * exptime) / sig, 7) AS noise,
  round(sqrt(sig + np * ron * ron + sc * sc * sig * sig + np * sky * gain + np * 0.02::DOUBLE * exptime) / sig
    / sqrt(5 * 60 / (exptime + 10.5::DOUBLE)), 7) AS noise_bin FROM s""")
def _(spark, sf):
    env = B.env(spark, sf)
    ron = env.agg(F.avg("ron").alias("ron"))
    e = G.attach(env.drop("ron", "jd"), [], ron)
    lc = cut(B.lc(spark, sf))
    rows = G.attach(lc, ["star_id"], G.medians(lc, ["star_id"], {"med": "flux"}, stored=True)).join(e, "frame")
    mag = P.instrumental_magnitude("med", "gain", "exptime")
    rows = rows.withColumn("mag", mag).withColumn("radius", P.aperture_radius(F.lit(6), F.lit(4.0)))
    noise = P.noise_model("mag", "exptime", "airmass", "sky", "gain", "ron", "radius", "height")
    rows = rows.withColumn("noise", noise)
    return rows.select("star_id", "frame", r("mag").alias("mag"), r("noise", 7).alias("noise"),
                       r(P.binned_noise("noise", "exptime", 5.0), 7).alias("noise_bin"))


@query("f07_aperture_radius", "F07 S25", """
SELECT l_orderkey, l_partkey, l_linenumber AS ap, round((CASE l_linenumber WHEN 1 THEN 0.5 WHEN 2 THEN 1 / sqrt(2) WHEN 3 THEN 1
  WHEN 4 THEN sqrt(2) WHEN 5 THEN 2 WHEN 6 THEN 2 * sqrt(2) WHEN 7 THEN 4 END)::DOUBLE * l_quantity, 6) AS radius FROM lineitem""")
def _(spark, sf):
    li = B.table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_partkey", F.col("l_linenumber").alias("ap"), r(P.aperture_radius("l_linenumber", "l_quantity")).alias("radius"))


@query("w02_rolling_mask", "W02", with_(B.SERIES_SQL) + """
, n AS (SELECT series, event_id, t, y / median(CASE WHEN y > 0.001 THEN y END) OVER (PARTITION BY series) AS y FROM series)
, q AS (SELECT series, event_id, y, stddev_pop(y) OVER (PARTITION BY series ORDER BY t
    RANGE BETWEEN 0.01::DOUBLE PRECEDING AND 0.01::DOUBLE FOLLOWING) AS s FROM n)
SELECT series, event_id, round(s, 5) AS scatter, (s > 0.08 OR y < 0.2) AS bad FROM q""")
def _(spark, sf):
    n = G.normalise(B.series(spark, sf), ["series"], "y", "ny", stored=True)
    m = L.bad_weather_mask(n, ["series"], "t", "ny")
    return m.select("series", "event_id", r("scatter", 5).alias("scatter"), "bad")


@query("a44_value_counts", "A44", "SELECT l_linenumber AS ap, count(*) AS n FROM lineitem GROUP BY 1")
def _(spark, sf):
    return B.table(spark, sf, "lineitem").groupBy(F.col("l_linenumber").alias("ap")).agg(F.count("*").alias("n"))


@query("f10_differential_error", "F10 F30", """
SELECT l_orderkey, l_partkey, l_linenumber, round((1 + l_discount) * sqrt(l_tax * l_tax + l_discount * l_discount), 7) AS err,
  (l_tax > 0.04::DOUBLE)::INT AS flag FROM lineitem""")
def _(spark, sf):
    from ..functions.quality import flag_bit

    li = B.table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_partkey", "l_linenumber",
                     r(P.differential_error(1 + F.col("l_discount"), "l_tax", "l_discount"), 7).alias("err"),
                     flag_bit(F.col("l_tax") > 0.04).alias("flag"))


