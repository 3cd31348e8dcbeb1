"""The whole differential photometry job over a survey, with its SQL twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import bindings as B
from ..plans.differential import Settings, differential_photometry, finish
from ..session import cut, scratch_path
from .lightcurves import clip_sql
from .registry import query, r, with_
from .water import grid, tri_sql

RUN, RUN_SQL = ["field", "ap"], "field, ap"
BIN, BOX, LIMIT, ROUNDS = 1.1, 0.9, 0.08, 3
#: Temperature of the lattice's first node and its step.
COLD, STEP = 2000.0, 200.0


def survey_products(spark, sf, tables=None):
    v = {k: df if k == "lc" else cut(df) for k, df in B.survey(spark, sf, cut).items()}
    s = Settings(bin_width=BIN, weather_box=BOX, weather_limit=LIMIT, rounds=ROUNDS, tolerance=0.0)
    p = differential_photometry(v["lc"], v["frames"].drop("telescope"), v["stars"].drop("teff"), v["targets"], RUN, s)
    lattice = grid(spark, sf).withColumn("teff_k", COLD + STEP * F.col("teff_k"))
    return finish(p, v["frames"], v["stars"], v["pwv"], cut(lattice), RUN, scratch_path(spark, "products"), BIN)


def norm_sql(src: str, keys: str, value: str, out: str) -> str:
    return f"(SELECT *, {value} / median(CASE WHEN {value} > 0.001 THEN {value} END) OVER (PARTITION BY {keys}) AS {out} FROM {src})"


def weather_sql(src: str) -> str:
    half = BOX / 2
    return f"""(SELECT *, stddev_pop(nlc) OVER (PARTITION BY {RUN_SQL} ORDER BY jd RANGE BETWEEN {half} PRECEDING AND {half} FOLLOWING) > {LIMIT} OR nlc < 0.2 AS bad FROM {src})"""


def bin_sql(keys: str, src: str, y: str) -> str:
    return f"""(SELECT {keys}, bin, avg({y}) AS yb, 1.253::DOUBLE * stddev_pop({y}) / sqrt(count({y})) AS be FROM (
    SELECT *, greatest(1, ceil((jd - min(jd) OVER (PARTITION BY {keys})) / {BIN}::DOUBLE))::BIGINT AS bin FROM {src}) WHERE {y} IS NOT NULL GROUP BY {keys}, bin)"""


def total_sql(src: str) -> str:
    """Weights over their sums; a sum of zero leaves them."""
    over = f"OVER (PARTITION BY {RUN_SQL})"
    part = ", ".join(f"CASE WHEN sum({w}) {over} <> 0 THEN {w} / sum({w}) {over} ELSE {w} END AS {w}" for w in ("w1", "w2", "w3"))
    return f"""(SELECT * EXCLUDE (w1, w2, w3), {part}, CASE WHEN sum(w1 * w2 * w3) {over} <> 0 THEN w1 * w2 * w3 / sum(w1 * w2 * w3) {over} ELSE w1 * w2 * w3 END AS weight FROM {src})"""


def round_sql(i: int) -> str:
    top = f"max(weight) OVER (PARTITION BY {RUN_SQL}) AS top, first_value(star_id) OVER (PARTITION BY {RUN_SQL} ORDER BY weight DESC, star_id) AS who"
    fresh = "CASE WHEN top > 0.95 THEN w1_start ELSE w1 END AS w1, CASE WHEN top > 0.95 THEN 1 ELSE w2 END AS w2, CASE WHEN top > 0.95 THEN (star_id <> who)::INT::DOUBLE ELSE w3 END AS w3"
    return f"""z{i} AS MATERIALIZED (SELECT * EXCLUDE (top, who) FROM {total_sql(f'(SELECT * EXCLUDE (weight) REPLACE ({fresh}) FROM (SELECT *, {top} FROM u{i}))')}),
al{i} AS MATERIALIZED (SELECT {RUN_SQL}, jd, sum(nflux * weight) AS alc FROM others JOIN z{i} USING ({RUN_SQL}, star_id) GROUP BY ALL),
fl{i} AS MATERIALIZED (SELECT * FROM {weather_sql(norm_sql(f'al{i}', RUN_SQL, 'alc', 'nlc'))}),
us{i} AS (SELECT {RUN_SQL}, count_if(bad) < 0.5 * count(*) AS um FROM fl{i} GROUP BY ALL),
sg{i} AS (SELECT {RUN_SQL}, star_id, stddev_pop(CASE WHEN NOT (bad AND um) THEN nflux / nlc END) / median(CASE WHEN nflux / nlc > 0.001 THEN nflux / nlc END) AS sg
  FROM others JOIN fl{i} USING ({RUN_SQL}, jd) JOIN us{i} USING ({RUN_SQL}) GROUP BY ALL),
v{i} AS MATERIALIZED (SELECT * FROM {total_sql(f'(SELECT u.* EXCLUDE (weight) REPLACE (CASE WHEN w1 = 0 THEN 0 WHEN sg > 0 THEN 1 / (sg * sg) ELSE 0 END AS w1) FROM z{i} u JOIN sg{i} USING ({RUN_SQL}, star_id))')})"""





def noise_sql(flux: str) -> str:
    sig = f"(pow(10, (2.5::DOUBLE * log10({flux} * gain / exptime)) / 2.5::DOUBLE) * exptime)"
    sc = "(1.27::DOUBLE * sqrt(1e-5::DOUBLE) * pow(airmass, 1.75::DOUBLE) * exp(-height / 8000.0::DOUBLE) / sqrt(exptime))"
    return f"(sqrt({sig} + np * ron * ron + np * sky * gain + np * 0.02::DOUBLE * exptime + pow({sc} * {sig}, 2)) / {sig})"


AT = f"((teff - {COLD}) / {STEP})"
ENS = f"((et - {COLD}) / {STEP})"

#: Everything up to the corrected target series ``done`` and the best apertures ``best``, ``bestw``.
JOB = ",\n".join([
    B.SURVEY_SQL,
    f"base AS MATERIALIZED (SELECT * FROM {norm_sql('lc JOIN env USING (field, jd)', 'field, ap, star_id', 'flux', 'nflux')})",
    clip_sql("base", "field, ap, star_id", "flux", 7.0, 5, "k"),
    f"""st0 AS MATERIALIZED (SELECT {RUN_SQL}, star_id, median(flux) AS mf, max(peak) > 62000 AS sat,
  24.16::DOUBLE - 2.5::DOUBLE * log10(median(flux) * median(gain / exptime)) AS mag, count(flux) = 0 OR median(c) < 100 OR median(flux / exptime) < 10 AS low FROM k5 GROUP BY ALL)""",
    f"""st AS MATERIALIZED (SELECT s.*, sat AS saturated, NOT sat AND low AS lowflux, CASE WHEN sat OR low THEN 0 ELSE mf END AS w1, 1.0::DOUBLE AS w2, 1.0::DOUBLE AS w3,
  2 * asin(least(1.0, sqrt(pow(sin((z.dec - y.dec) / 2), 2) + cos(y.dec) * cos(z.dec) * pow(sin((z.ra - y.ra) / 2), 2)))) AS sep
  FROM st0 s JOIN sky y USING (field, star_id) JOIN sky z ON z.field = s.field AND z.star_id = 0)""",
    f"""tgt AS (SELECT {RUN_SQL}, mag + 3.0::DOUBLE AS min_mag FROM st WHERE star_id = 0)""",
    f"""br AS (SELECT {RUN_SQL}, max(mag) AS mx FROM (SELECT *, row_number() OVER (PARTITION BY {RUN_SQL} ORDER BY mag, star_id) AS rn FROM st WHERE star_id <> 0 AND w1 > 0 AND NOT saturated) WHERE rn <= 20 GROUP BY ALL)""",
    f"""lim AS (SELECT {RUN_SQL}, min_mag, CASE WHEN mx >= min_mag THEN min_mag - 1 ELSE mx END AS max_mag FROM br JOIN tgt USING ({RUN_SQL}))""",
    f"""placed AS MATERIALIZED (SELECT {RUN_SQL}, star_id, w1 AS w, cut, max_mag + cut * ((min_mag - max_mag) / 49) AS cut_mag FROM st JOIN lim USING ({RUN_SQL}), range(50) t(cut)
  WHERE star_id <> 0 AND w1 > 0 AND greatest(0, ceil((mag - max_mag) / ((min_mag - max_mag) / 49))) <= cut)""",
    f"""sw AS (SELECT {RUN_SQL}, cut, sum(w) AS sw FROM placed GROUP BY ALL)""",
    f"""ca AS (SELECT {RUN_SQL}, cut, cut_mag, jd, sum(nflux * w) / any_value(sw) AS alc FROM placed JOIN base USING ({RUN_SQL}, star_id) JOIN sw USING ({RUN_SQL}, cut) GROUP BY ALL)""",
    f"""cc AS MATERIALIZED (SELECT * FROM {norm_sql('ca', f'{RUN_SQL}, cut', 'alc', 'nlc')})""",
    f"""cf AS (SELECT {RUN_SQL}, jd, bad FROM {weather_sql(f'(SELECT * FROM cc QUALIFY cut = min(cut) OVER (PARTITION BY {RUN_SQL}))')})""",
    f"""cm AS (SELECT *, bad AND count_if(bad) OVER (PARTITION BY {RUN_SQL}) < 0.8 * count(*) OVER (PARTITION BY {RUN_SQL}) AS masked FROM cf)""",
    f"""ce AS (SELECT {RUN_SQL}, cut, cut_mag, avg(be) AS me FROM {bin_sql(f'{RUN_SQL}, cut, cut_mag', f'(SELECT cc.*, CASE WHEN NOT masked THEN nlc END AS y FROM cc JOIN cm USING ({RUN_SQL}, jd))', 'y')} GROUP BY ALL)""",
    f"""chosen AS (SELECT {RUN_SQL}, arg_min(cut_mag, (round(me, 12), cut)) AS best_mag FROM ce WHERE me IS NOT NULL GROUP BY ALL)""",
    f"""others AS MATERIALIZED (SELECT * FROM base WHERE star_id <> 0)""",
    f"""low AS (SELECT {RUN_SQL}, star_id, jd, CASE WHEN nflux > 0.2 THEN nflux END AS y FROM others)""",
    clip_sql("low", f"{RUN_SQL}, jd", "y", 3.0, 12, "q"),
    f"""gt AS (SELECT {RUN_SQL}, count_if(ok) AS good FROM (SELECT {RUN_SQL}, jd, count(c) > 0 AS ok FROM q12 GROUP BY ALL) GROUP BY ALL)""",
    f"""gone AS (SELECT {RUN_SQL}, star_id, good - count(c) > 0.2 * good AS dropped FROM q12 JOIN gt USING ({RUN_SQL}) GROUP BY {RUN_SQL}, star_id, good)""",
    f"""u1 AS MATERIALIZED (SELECT * FROM {total_sql(f"(SELECT st.* REPLACE (CASE WHEN dropped THEN 0 WHEN best_mag IS NULL OR mag <= best_mag THEN 1.0 ELSE 0.0 END::DOUBLE AS w3), w1 AS w1_start FROM st JOIN gone USING ({RUN_SQL}, star_id) LEFT JOIN chosen USING ({RUN_SQL}) WHERE star_id <> 0)")})""",
    round_sql(1),
    f"""dw AS (SELECT {RUN_SQL}, star_id, step, 0.5::DOUBLE + step * (2.5::DOUBLE / 19) AS a, w1 * w3 / (1 + pow((0.5::DOUBLE + step * (2.5::DOUBLE / 19)) * sep / max(sep) OVER (PARTITION BY {RUN_SQL}), 2)) AS w FROM v1, range(20) t(step))""",
    f"""dn AS (SELECT {RUN_SQL}, step, sum(w) AS n FROM dw GROUP BY ALL)""",
    f"""da AS (SELECT {RUN_SQL}, step, a, jd, sum(nflux * w) / any_value(n) AS alc FROM dw JOIN others USING ({RUN_SQL}, star_id) JOIN dn USING ({RUN_SQL}, step) GROUP BY ALL)""",
    f"""dd AS (SELECT {RUN_SQL}, step, a, b.nflux / e.nlc AS d FROM {norm_sql('da', f'{RUN_SQL}, step', 'alc', 'nlc')} e JOIN (SELECT * FROM base WHERE star_id = 0) b USING ({RUN_SQL}, jd))""",
    f"""ds AS (SELECT {RUN_SQL}, step, a, stddev_pop(diff) AS s FROM {norm_sql('dd', f'{RUN_SQL}, step', 'd', 'diff')} GROUP BY ALL)""",
    f"""far AS (SELECT {RUN_SQL}, arg_min(a, (round(s, 12), step)) AS best_a FROM ds WHERE s IS NOT NULL GROUP BY ALL)""",
    f"""u2 AS MATERIALIZED (SELECT * FROM {total_sql(f"(SELECT v.* EXCLUDE (weight) REPLACE (1 / (1 + pow(best_a * sep / max(sep) OVER (PARTITION BY {RUN_SQL}), 2)) AS w2) FROM v1 v JOIN far USING ({RUN_SQL}))")})""",
    round_sql(2),
    "u3 AS (SELECT * FROM v2)",
    round_sql(3),
    f"""alc AS MATERIALIZED (SELECT * FROM {weather_sql(norm_sql(f'(SELECT {RUN_SQL}, jd, sum(nflux * weight) AS alc FROM others JOIN v3 USING ({RUN_SQL}, star_id) GROUP BY ALL)', RUN_SQL, 'alc', 'nlc'))})""",
    f"""dc AS (SELECT b.*, nflux / nlc AS d, bad FROM base b JOIN alc USING ({RUN_SQL}, jd))""",
    f"""curves AS MATERIALIZED (SELECT * FROM {norm_sql('dc', 'field, ap, star_id', 'd', 'diff')})""",
    f"""top AS (SELECT {RUN_SQL}, star_id FROM v3 QUALIFY row_number() OVER (PARTITION BY {RUN_SQL} ORDER BY weight DESC, star_id) <= 10)""",
    f"""comp AS (SELECT {RUN_SQL}, median(f) AS cf FROM (SELECT {RUN_SQL}, jd, median(flux) AS f FROM base SEMI JOIN top USING ({RUN_SQL}, star_id) GROUP BY ALL) GROUP BY ALL)""",
    f"""errs AS MATERIALIZED (SELECT * EXCLUDE (ron), diff * sqrt(pow({noise_sql('mf')}, 2) + pow({noise_sql('cf')}, 2)) AS error FROM (
  SELECT c.* EXCLUDE (ron), mf, cf, n.ron, pi() * pow(CASE ap WHEN 4 THEN sqrt(2) WHEN 5 THEN 2 WHEN 6 THEN 2 * sqrt(2) END * 4.0::DOUBLE, 2) AS np
  FROM curves c JOIN st USING ({RUN_SQL}, star_id) JOIN comp USING ({RUN_SQL}) JOIN (SELECT field, avg(ron) AS ron FROM env GROUP BY field) n USING (field)))""",
    f"""et AS (SELECT {RUN_SQL}, sum(weight * teff) / sum(weight) AS et FROM v3 JOIN sky USING (field, star_id) WHERE teff IS NOT NULL GROUP BY ALL)""",
    f"""tg AS (SELECT {RUN_SQL}, jd, diff, error, bad, airmass, teff, et, CASE WHEN telescope = 'Artemis' THEN 'skip: site' WHEN teff IS NULL THEN 'skip: no teff'
  WHEN teff < 2000 THEN 'skip: teff too low' WHEN teff > 3200 THEN 'warn: teff high' ELSE 'ok' END AS guard FROM errs JOIN sky USING (field, star_id) JOIN et USING ({RUN_SQL}) WHERE star_id = 0)""",
    f"""ends AS (SELECT {RUN_SQL}, min(t) AS w0, max(t) AS w1 FROM (SELECT {RUN_SQL}, min(jd) - 2.0::DOUBLE / 24 AS a, max(jd) + 2.0::DOUBLE / 24 AS z FROM tg WHERE guard NOT LIKE 'skip%' GROUP BY ALL) JOIN wet ON t BETWEEN a AND z GROUP BY ALL)""",
    f"""wp AS (SELECT g.*, CASE WHEN jd BETWEEN w0 AND w1 THEN CASE WHEN p.t = jd THEN p.y ELSE p.y + (q.y - p.y) * (jd - p.t) / (q.t - p.t) END END AS pw
  FROM tg g LEFT JOIN ends USING ({RUN_SQL}) ASOF LEFT JOIN wet p ON g.jd >= p.t ASOF LEFT JOIN wet q ON g.jd < q.t)""",
    f"""lk AS (SELECT *, CASE WHEN pw IS NOT NULL THEN {tri_sql('pw', 'airmass', AT)} END AS tw, CASE WHEN pw IS NOT NULL THEN {tri_sql('pw', 'airmass', ENS)} END AS ew FROM wp)""",
    f"""nm AS (SELECT *, CASE WHEN guard NOT LIKE 'skip%' THEN diff / median(CASE WHEN diff > 0.001 THEN diff END) OVER w END AS ny,
  tw / median(CASE WHEN tw > 0.001 THEN tw END) OVER w / (ew / median(CASE WHEN ew > 0.001 THEN ew END) OVER w) AS ratio FROM lk WINDOW w AS (PARTITION BY {RUN_SQL}))""",
    f"""done AS MATERIALIZED (SELECT {RUN_SQL}, jd, diff, error, bad, guard, pw, ratio, CASE WHEN ratio <> 0 THEN ny / ratio END AS corrected FROM nm)""",
    f"""best AS (SELECT field, arg_min(ap, (round(s, 12), ap)) AS best_ap, min(s) AS score FROM (SELECT {RUN_SQL}, avg(be) * stddev_pop(yb) AS s FROM {bin_sql(RUN_SQL, 'done', 'diff')} GROUP BY ALL) GROUP BY field)""",
    f"""bestw AS (SELECT field, arg_min(ap, (round(s, 12), ap)) AS best_ap_pwv, min(s) AS score_pwv FROM (SELECT {RUN_SQL}, avg(be) * stddev_pop(yb) AS s FROM {bin_sql(RUN_SQL, 'done', 'corrected')} GROUP BY ALL) GROUP BY field)""",
])


@query("c01_differential_photometry", "C01 C02 C02b C06 A20 A21 A22 A23 A37 A39 A45 F09 F10 F22 F32 J18 K04 K07 W02 W04 W08", with_(JOB) + """
SELECT field, ap, jd, round(diff, 6) + 0.0 AS diff, round(error, 7) + 0.0 AS error, bad, guard, round(pw, 5) AS pwv, round(ratio, 5) AS water_ratio, round(corrected, 5) AS corrected,
  best_ap, best_ap_pwv FROM done JOIN best USING (field) LEFT JOIN bestw USING (field)""")
def _(spark, sf):
    out = survey_products(spark, sf)
    rows = out["corrected"].join(out["best"].select("field", "best_ap", "best_ap_pwv"), "field")
    return rows.select("field", "ap", "jd", r("diff").alias("diff"), r("error", 7).alias("error"), "bad", "guard", r("pwv", 5).alias("pwv"),
                       r("water_ratio", 5).alias("water_ratio"), r("corrected", 5).alias("corrected"), "best_ap", "best_ap_pwv")
