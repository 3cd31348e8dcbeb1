"""Night report, log flag and ledger queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import bindings as B
from ..functions.quality import QC_RULES, qc_rules
from ..operators import report as R
from ..operators.overlap import within_intervals
from ..plans.night_report import NightInputs, night_report
from ..session import cut, scratch_path
from ..sources.ledger import Ledger
from .registry import query, r, with_

NF = """nf AS (SELECT o_orderkey AS id, strftime(o_orderdate, '%Y%m') AS night, o_custkey % 20 AS target, o_orderkey::DOUBLE AS jd, o_orderstatus AS filter,
  (o_orderkey % 10)::DOUBLE AS psf_a, (o_orderkey % 7)::DOUBLE AS psf_b, o_totalprice AS x, o_totalprice / 2 AS y, 297 + (o_orderkey % 7) AS overscan, (o_orderkey % 5) - 2.0::DOUBLE AS pa,
  -60 + (o_orderkey % 3) * 0.5::DOUBLE AS temp, CASE WHEN o_orderkey % 4 <> 0 THEN 6 + (o_orderkey % 10) * 0.3::DOUBLE END AS ron, CASE WHEN o_orderkey % 3 <> 0 THEN 0.2 + (o_orderkey % 10) * 0.02::DOUBLE END AS dark FROM orders)"""
ELL = "CASE WHEN psf_a <> 0 AND abs(psf_b) <= abs(psf_a) THEN sqrt(1 - pow(psf_b / psf_a, 2)) END"


def night_frames(spark, sf):
    k = F.col("o_orderkey")
    return B.table(spark, sf, "orders").select(
        k.alias("id"), F.date_format("o_orderdate", "yyyyMM").alias("night"), (F.col("o_custkey") % 20).alias("target"), k.cast("double").alias("jd"),
        F.col("o_orderstatus").alias("filter"), (k % 10).cast("double").alias("psf_a"), (k % 7).cast("double").alias("psf_b"),
        F.col("o_totalprice").alias("x"), (F.col("o_totalprice") / 2).alias("y"), (297 + k % 7).cast("double").alias("overscan"),
        (k % 5 - 2.0).alias("pa"), (-60 + (k % 3) * 0.5).alias("temp"), F.when(k % 4 != 0, 6 + (k % 10) * 0.3).alias("ron"),
        F.when(k % 3 != 0, 0.2 + (k % 10) * 0.02).alias("dark"))


@query("a24_night_summary", "A24 O07", with_(NF) + f""", s AS (SELECT night, target, min(jd) AS jd_start, max(jd) AS jd_end, count(*) AS n_frames, arg_min(filter, jd) AS first_filter,
  round(median({ELL}), 6) AS ellipticity, arg_max(x, jd) AS last_x FROM nf GROUP BY ALL)
SELECT night, target, jd_start, jd_end, n_frames, first_filter, ellipticity, round(last_x, 2) AS last_x, rank() OVER (PARTITION BY night ORDER BY jd_start)::INT AS place FROM s""")
def _(spark, sf):
    s = R.chronological(R.night_summary(night_frames(spark, sf), ["night", "target"]), ["night"])
    return s.select("night", "target", "jd_start", "jd_end", "n_frames", "first_filter", r("ellipticity").alias("ellipticity"), r("last_x", 2).alias("last_x"), "place")


@query("a25_a26_health", "A25 A26 W14", with_(NF) + f""", p AS (SELECT night, target, median(overscan) AS o, median(pa) AS pa, median(temp) AS t, median({ELL}) AS e,
  arg_min(ron, jd) FILTER (WHERE ron IS NOT NULL AND dark IS NOT NULL) AS ron, arg_min(dark, jd) FILTER (WHERE ron IS NOT NULL AND dark IS NOT NULL) AS dark FROM nf GROUP BY ALL),
n AS (SELECT night, avg(o) AS o, avg(pa) AS pa, avg(t) AS t, avg(ron) AS ron, avg(dark) AS dark, max(e) AS e FROM p GROUP BY night)
SELECT night, round(o, 5) AS overscan, round(ron, 5) AS ron, round(dark, 5) AS dark, round(e, 5) AS ellipticity,
  CASE WHEN abs(o - 300) <= 2 THEN 'OK' ELSE 'CHECK' END AS overscan_state, CASE WHEN abs(ron - 6.5) <= 1.5 THEN 'OK' WHEN ron IS NOT NULL THEN 'CHECK' END AS ron_state,
  CASE WHEN abs(t + 60) <= 1 THEN 'OK' ELSE 'CHECK' END AS temp_state, CASE WHEN least(abs(pa), abs(pa - 360)) <= 2 THEN 'OK' ELSE 'CHECK' END AS pa_state,
  CASE WHEN e <= 0.5 THEN 'OK' WHEN e > 0.5 THEN 'CHECK' END AS ellipticity_state FROM n""")
def _(spark, sf):
    h = R.health(night_frames(spark, sf), ["night"], "target")
    return h.select("night", r("overscan", 5).alias("overscan"), r("ron", 5).alias("ron"), r("dark", 5).alias("dark"), r("ellipticity", 5).alias("ellipticity"),
                    "overscan_state", "ron_state", "temp_state", "pa_state", "ellipticity_state")


# every line of every document is a log line; the mark is planted by its length
LINES = """ln AS (SELECT source AS night, CASE WHEN doc_id % 2 = 0 THEN 'weather' ELSE 'events' END AS kind, CASE WHEN doc_id % 3 = 0 THEN 'Callisto' ELSE 'Io' END AS telescope, unnest(string_split(text, chr(10))) AS value FROM documents),
mk AS (SELECT night, kind, telescope, CASE WHEN length(value) % 97 = 5 THEN value || ' WEATHER ALERT' WHEN length(value) % 89 = 3 THEN value || ' TELESCOPE.STATUS.LIST="DRIVES|0::,SYSTEM|0::,AUXILIARY|0::,UNKNOWN|0::"'
  WHEN length(value) % 83 = 4 THEN value || ' TELESCOPE.STATUS.LIST DRIVES|1' ELSE value END AS value FROM ln)"""


def log_lines(spark, sf):
    d = B.table(spark, sf, "documents")
    ln = d.select(F.col("source").alias("night"), F.when(F.col("doc_id") % 2 == 0, "weather").otherwise("events").alias("kind"),
                  F.when(F.col("doc_id") % 3 == 0, "Callisto").otherwise("Io").alias("telescope"), F.explode(F.split("text", "\n")).alias("value"))
    n = F.length("value")
    return ln.withColumn("value", F.when(n % 97 == 5, F.concat("value", F.lit(" " + R.WEATHER_TEXT))).when(n % 89 == 3, F.concat("value", F.lit(" " + R.STATUS_QUIET)))
                         .when(n % 83 == 4, F.concat("value", F.lit(" TELESCOPE.STATUS.LIST DRIVES|1"))).otherwise(F.col("value")))


@query("p18_log_flags", "P18 S16", with_(LINES) + """
SELECT night, telescope, CASE WHEN count_if(kind = 'weather' AND contains(value, 'WEATHER ALERT')) > 0 THEN 'Y' WHEN count_if(kind = 'weather') > 0 THEN 'N' ELSE 'unknown' END AS weather_flag,
  CASE WHEN count_if(kind = 'events' AND contains(value, 'TELESCOPE.STATUS.LIST') AND NOT contains(value, 'DRIVES|0::,SYSTEM|0::')) > 0 THEN 'Y' WHEN count_if(kind = 'events') > 0 THEN 'N' ELSE 'unknown' END AS events_flag
FROM mk GROUP BY ALL""")
def _(spark, sf):
    return R.log_flags(log_lines(spark, sf), ["night", "telescope"])


@query("j24_p17_night_states", "J24 P17 P18", with_(B.SERIES_SQL) + """, nt AS (SELECT DISTINCT floor(t)::BIGINT AS night FROM series),
tr AS (SELECT floor(t)::BIGINT AS night, count_if(series = 'view') AS a, count_if(series = 'view') + count_if(series = 'click' AND y > 300) AS b, count_if(series = 'view') AS c FROM series WHERE floor(t)::BIGINT % 5 <> 0 GROUP BY 1),
cl AS (SELECT DISTINCT floor(t)::BIGINT AS night FROM series WHERE y > 250),
sh AS (SELECT floor(t)::BIGINT AS night, arg_max(y, t) AS last_tracking FROM series GROUP BY 1)
SELECT nt.night, CASE WHEN a IS NULL THEN 'unknown' WHEN a = b AND b = c AND a = 0 THEN 'No data' WHEN a = b AND b = c THEN 'OK' ELSE 'KO' END AS transfer,
  CASE WHEN cl.night IS NULL THEN 'N' ELSE 'Y' END AS closure, CASE WHEN last_tracking <= 1.2 THEN 'N' ELSE 'Y' END AS shaking
FROM nt LEFT JOIN tr USING (night) LEFT JOIN cl ON cl.night = nt.night JOIN sh ON sh.night = nt.night""")
def _(spark, sf):
    s = B.series(spark, sf).withColumn("night", F.floor("t"))
    nights = s.select("night", F.col("night").cast("double").alias("jd_noon")).distinct()
    view = F.count_if(F.col("series") == "view")
    tr = s.where("night % 5 <> 0").groupBy("night").agg(view.alias("archived"), (view + F.count_if((F.col("series") == "click") & (F.col("y") > 300))).alias("transferred"), view.alias("downloaded"))
    out = R.closure_flags(R.transfer_status(nights, tr), s.where("y > 250").select(F.col("t").alias("jd")))
    sh = R.shaking_flag(s, ["night"], "t", "y")
    return out.join(sh, "night").select("night", "transfer", "closure", "shaking")


@query("p17_within_runs", "P17", with_(B.SERIES_SQL) + """, v AS (SELECT event_id % 100 AS k, min(t) AS a, min(t) + 0.3::DOUBLE AS b FROM series GROUP BY 1)
SELECT k, event_id, series FROM series JOIN v ON t BETWEEN a AND b""")
def _(spark, sf):
    s = B.series(spark, sf)
    runs = s.groupBy((F.col("event_id") % 100).alias("k")).agg(F.min("t").alias("jd_start"), (F.min("t") + 0.3).alias("jd_end"))
    return within_intervals(s, runs, [], "t", "jd_start", "jd_end", 0.3).select("k", "event_id", "series")


@query("p17_within_own_runs", "P17", with_(B.SERIES_SQL) + """, v AS (SELECT series, event_id % 10 AS k, min(t) AS a, max(t) AS b FROM series WHERE event_id % 2 = 0 GROUP BY ALL)
SELECT s.series, event_id FROM series s JOIN v ON s.series = v.series AND event_id % 10 = k AND t BETWEEN a AND b""")
def _(spark, sf):
    s = B.series(spark, sf).withColumn("k", F.col("event_id") % 10)
    runs = s.where("event_id % 2 = 0").groupBy("series", "k").agg(F.min("t").alias("jd_start"), F.max("t").alias("jd_end"))
    return R.within_runs(s, runs, ["series", "k"], "t").select("series", "event_id")


@query("c11_chosen_aperture", "", """WITH p AS (SELECT l_suppkey AS target, min(l_linenumber) AS ap FROM lineitem WHERE l_quantity > 49 AND l_suppkey % 3 = 0 GROUP BY 1),
q AS (SELECT l_suppkey AS target, max(l_linenumber) AS ap FROM lineitem WHERE l_suppkey % 2 = 0 GROUP BY 1)
SELECT s_suppkey AS target, coalesce(p.ap, q.ap, 6) AS aperture, p.ap IS NOT NULL AS corrected FROM supplier LEFT JOIN p ON p.target = s_suppkey LEFT JOIN q ON q.target = s_suppkey""")
def _(spark, sf):
    li = B.table(spark, sf, "lineitem").withColumnRenamed("l_suppkey", "target")
    p = li.where("l_quantity > 49 AND target % 3 = 0").groupBy("target").agg(F.min("l_linenumber").alias("best_ap"))
    q = li.where("target % 2 = 0").groupBy("target").agg(F.max("l_linenumber").alias("best_ap"))
    return R.chosen_aperture(B.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("target")), p, q, ["target"])


NOON = 2460310
TELESCOPES = ["Io", "Callisto", "Artemis"]


def telescope(key):
    return F.when(key % 3 == 0, TELESCOPES[0]).when(key % 3 == 1, TELESCOPES[1]).otherwise(TELESCOPES[2])


def telescope_sql(key):
    return f"CASE {key} % 3 WHEN 0 THEN 'Io' WHEN 1 THEN 'Callisto' ELSE 'Artemis' END"


NIGHT = with_(NF, LINES, B.SERIES_SQL, f"""fr AS (SELECT * REPLACE ({NOON} + id % 30 + 0.3::DOUBLE + target * 0.02::DOUBLE + (id // 30 % 19) / 1000.0::DOUBLE + id * 1e-8::DOUBLE AS jd, {NOON} + id % 30 AS night), {telescope_sql('id')} AS telescope FROM nf),
sc AS (SELECT {NOON} + c_custkey % 35 AS night, {telescope_sql('c_custkey')} AS telescope, c_custkey % 25 AS target, min({NOON} + c_custkey % 35 + c_acctbal / 30000) AS planned FROM customer GROUP BY ALL),
lg AS (SELECT {NOON} + doc_id % 33 AS night, {telescope_sql('doc_id')} AS telescope, CASE WHEN doc_id % 2 = 0 THEN 'weather' ELSE 'events' END AS kind, unnest(string_split(text, chr(10))) AS value FROM documents),
lm AS (SELECT night, telescope, kind, CASE WHEN length(value) % 97 = 5 THEN value || ' WEATHER ALERT' WHEN length(value) % 83 = 4 THEN value || ' TELESCOPE.STATUS.LIST DRIVES|1' ELSE value END AS value FROM lg),
lf AS (SELECT night, telescope, CASE WHEN count_if(kind = 'weather' AND contains(value, 'WEATHER ALERT')) > 0 THEN 'Y' WHEN count_if(kind = 'weather') > 0 THEN 'N' ELSE 'unknown' END AS weather_flag,
  CASE WHEN count_if(kind = 'events' AND contains(value, 'TELESCOPE.STATUS.LIST')) > 0 THEN 'Y' WHEN count_if(kind = 'events') > 0 THEN 'N' ELSE 'unknown' END AS events_flag FROM lm GROUP BY ALL),
ev AS (SELECT *, floor(t)::BIGINT AS night, {telescope_sql('event_id')} AS telescope FROM series),
sh AS (SELECT night, telescope, CASE WHEN arg_max(y, t) / 60 <= 1.2 THEN 'N' ELSE 'Y' END AS shaking FROM ev WHERE event_id % 7 = 0 GROUP BY ALL),
tr AS (SELECT night, CASE WHEN a = b AND a = 0 THEN 'No data' WHEN a = b THEN 'OK' ELSE 'KO' END AS transfer FROM (
  SELECT night, count(*) AS a, count_if(y < 200) AS b FROM ev WHERE night % 5 <> 0 GROUP BY night)),
cl AS (SELECT DISTINCT night FROM ev WHERE y > 150),
su AS (SELECT *, rank() OVER (PARTITION BY night, telescope ORDER BY jd_start)::INT AS place FROM (SELECT night, telescope, target, min(jd) AS jd_start, max(jd) AS jd_end, count(*) AS n_frames,
  arg_min(filter, jd) AS first_filter, median({ELL}) AS ellipticity FROM fr GROUP BY ALL)),
hp AS (SELECT night, telescope, target, median(overscan) AS o, median(pa) AS pa, median(temp) AS t, median({ELL}) AS e,
  arg_min(ron, jd) FILTER (WHERE ron IS NOT NULL AND dark IS NOT NULL) AS ron FROM fr GROUP BY ALL),
he AS (SELECT night, telescope, CASE WHEN abs(avg(o) - 300) <= 2 THEN 'OK' ELSE 'CHECK' END AS overscan_state, CASE WHEN abs(avg(ron) - 6.5) <= 1.5 THEN 'OK' WHEN avg(ron) IS NOT NULL THEN 'CHECK' END AS ron_state,
  CASE WHEN abs(avg(t) + 60) <= 1 THEN 'OK' ELSE 'CHECK' END AS temp_state, CASE WHEN max(e) <= 0.5 THEN 'OK' WHEN max(e) > 0.5 THEN 'CHECK' END AS ellipticity_state FROM hp GROUP BY ALL),
p AS (SELECT l_suppkey % 25 AS target, min(l_linenumber) AS ap FROM lineitem WHERE l_quantity > 49 AND l_suppkey % 3 = 0 GROUP BY 1),
q AS (SELECT l_suppkey % 25 AS target, max(l_linenumber) AS ap FROM lineitem WHERE l_suppkey % 25 % 2 = 0 GROUP BY 1),
gd AS (SELECT su.night, telescope, target, count(*) AS n_guiding, avg(y / 49.3::DOUBLE - 1) AS ha, stddev_pop(y / 49.3::DOUBLE - 1) AS has FROM su JOIN ev USING (telescope) WHERE series = 'click' AND t BETWEEN jd_start AND jd_end GROUP BY su.night, telescope, target),
wv AS (SELECT su.night, su.telescope, target, count(*) AS n_water, avg(1 + y / 19.7::DOUBLE) AS pwv, stddev_pop(1 + y / 19.7::DOUBLE) AS pws FROM su JOIN ev ON t BETWEEN jd_start AND jd_end WHERE series <> 'click' GROUP BY ALL),
ro AS (SELECT night, telescope, target, planned, jd_start, jd_end, coalesce(n_frames, 0) AS n_frames, first_filter, ellipticity, place FROM su FULL JOIN sc USING (night, telescope, target))""")


@query("c11_night_report", "C11 P17 P18 J24 A24 A25 A26 S14 O07", NIGHT + """
SELECT ro.night, telescope, target, round(planned, 6) AS planned, round(jd_start, 6) AS jd_start, round(jd_end, 6) AS jd_end, n_frames, first_filter, round(ellipticity, 6) AS ellipticity, place,
  coalesce(weather_flag, 'unknown') AS weather_flag, coalesce(events_flag, 'unknown') AS events_flag, coalesce(shaking, 'unknown') AS shaking, coalesce(transfer, 'unknown') AS transfer,
  CASE WHEN cl.night IS NULL THEN 'N' ELSE 'Y' END AS closure, overscan_state, ron_state, temp_state, ellipticity_state, coalesce(p.ap, q.ap, 6) AS aperture, p.ap IS NOT NULL AS corrected,
  coalesce(n_guiding, 0) AS n_guiding, round(ha, 6) + 0.0 AS ha_mean, round(has, 6) AS ha_std, coalesce(n_water, 0) AS n_water, round(pwv, 6) AS pwv_mean, round(pws, 6) AS pwv_std
FROM ro LEFT JOIN lf USING (night, telescope) LEFT JOIN sh USING (night, telescope) LEFT JOIN tr USING (night) LEFT JOIN cl ON cl.night = ro.night LEFT JOIN he USING (night, telescope)
  LEFT JOIN p USING (target) LEFT JOIN q USING (target) LEFT JOIN gd USING (night, telescope, target) LEFT JOIN wv USING (night, telescope, target)""")
def _(spark, sf):
    k, c, d = F.col("id"), F.col("c_custkey"), F.col("doc_id")
    day = F.lit(NOON) + k % 30
    frames = night_frames(spark, sf).withColumns({"jd": day + 0.3 + F.col("target") * 0.02 + F.floor(k / 30) % 19 / 1000.0 + k * 1e-8, "night": day, "telescope": telescope(k)})
    planned = B.table(spark, sf, "customer").select((NOON + c % 35).alias("night"), telescope(c).alias("telescope"), (c % 25).alias("target"), (NOON + c % 35 + F.col("c_acctbal") / 30000).alias("planned"))
    lines = B.table(spark, sf, "documents").select((NOON + d % 33).alias("night"), telescope(d).alias("telescope"), F.when(d % 2 == 0, "weather").otherwise("events").alias("kind"), F.explode(F.split("text", "\n")).alias("value"))
    n = F.length("value")
    lines = lines.withColumn("value", F.when(n % 97 == 5, F.concat("value", F.lit(" " + R.WEATHER_TEXT))).when(n % 83 == 4, F.concat("value", F.lit(" TELESCOPE.STATUS.LIST DRIVES|1"))).otherwise(F.col("value")))
    ev = B.series(spark, sf).withColumns({"night": F.floor("t"), "telescope": telescope(F.col("event_id"))}).withColumnRenamed("t", "jd")
    li = B.table(spark, sf, "lineitem").withColumn("target", F.col("l_suppkey") % 25)
    i = NightInputs(
        cut(frames), planned, lines, ev.where("event_id % 7 = 0").select("night", "telescope", "jd", (F.col("y") / 60).alias("tracking")),
        ev.where("night % 5 <> 0").groupBy("night").agg(F.count("*").alias("archived"), F.count_if(F.col("y") < 200).alias("transferred"), F.count_if(F.col("y") < 200).alias("downloaded")),
        ev.where("y > 150").select("jd"), cut(ev.where("series = 'click'").select("telescope", "jd", (F.col("y") / 49.3 - 1).alias("ha"), F.sin("event_id").alias("dec"))),
        cut(ev.where("series <> 'click'").select("jd", (1 + F.col("y") / 19.7).alias("pwv"))),
        li.where("l_quantity > 49 AND l_suppkey % 3 = 0").groupBy("target").agg(F.min("l_linenumber").alias("best_ap")),
        li.where("target % 2 = 0").groupBy("target").agg(F.max("l_linenumber").alias("best_ap")))
    out = night_report(i, ["night", "telescope"], "target")
    return out.select("night", "telescope", "target", r("planned").alias("planned"), r("jd_start").alias("jd_start"), r("jd_end").alias("jd_end"), "n_frames", "first_filter", r("ellipticity").alias("ellipticity"), "place",
                      "weather_flag", "events_flag", "shaking", "transfer", "closure", "overscan_state", "ron_state", "temp_state", "ellipticity_state", "aperture", "corrected",
                      "n_guiding", r("ha_mean").alias("ha_mean"), r("ha_std").alias("ha_std"), "n_water", r("pwv_mean").alias("pwv_mean"), r("pwv_std").alias("pwv_std"))


RULES_SQL = "ru(\"check\", worse, yellow, red) AS (VALUES " + ", ".join(f"('{c}', '{w}', {y}, {d})" for c, _, w, y, d in QC_RULES) + ")"
FACTS = """fa AS (SELECT o_custkey % 100 AS night, o_orderstatus AS target, 'QC' || (o_orderkey % 14 + 1) AS "check", o_orderkey AS run, CASE WHEN o_orderkey % 14 = 4 THEN o_totalprice * 10 ELSE o_totalprice / 10000 END AS value FROM orders)"""


def facts(spark, sf):
    k = F.col("o_orderkey")
    return B.table(spark, sf, "orders").select((F.col("o_custkey") % 100).alias("night"), F.col("o_orderstatus").alias("target"), F.concat(F.lit("QC"), (k % 14 + 1).cast("string")).alias("check"),
                                               k.alias("run"), F.when(k % 14 == 4, F.col("o_totalprice") * 10).otherwise(F.col("o_totalprice") / 10000).alias("value"))


@query("c12_qc_ledger", "C12 F23", with_(FACTS, RULES_SQL) + """, l AS (SELECT night, target, "check", arg_max(value, run) AS value FROM fa GROUP BY ALL),
g AS (SELECT l.*, CASE WHEN worse = 'LT' AND trunc(value) < red OR worse = 'GT' AND trunc(value) > red THEN 'r' WHEN worse = 'LT' AND trunc(value) < yellow OR worse = 'GT' AND trunc(value) > yellow THEN 'y' ELSE 'g' END AS grade FROM l JOIN ru USING ("check"))
SELECT night, target, "check", round(value, 6) AS value, grade, CASE grade WHEN 'g' THEN '[x]' WHEN 'y' THEN '[-]' ELSE '[o]' END AS cell FROM g""")
def _(spark, sf):
    q = R.qc_ledger(facts(spark, sf), qc_rules(spark), ["night", "target"], ["run"])
    return q.select("night", "target", "check", r("value", 6).alias("value"), "grade", "cell")


@query("c12_ledger_table", "C12 D14", with_(FACTS, RULES_SQL) + """, l AS (SELECT night, target, "check", arg_max(value, run) AS value FROM fa GROUP BY ALL),
g AS (SELECT night, target, "check" AS c, CASE WHEN worse = 'LT' AND trunc(value) < red OR worse = 'GT' AND trunc(value) > red THEN '[o]' WHEN worse = 'LT' AND trunc(value) < yellow OR worse = 'GT' AND trunc(value) > yellow THEN '[-]' ELSE '[x]' END AS cell FROM l JOIN ru USING ("check"))
SELECT night, target, """ + ", ".join(f"coalesce(max(CASE WHEN c = 'QC{i}' THEN cell END), '---') AS QC{i}" for i in range(1, 15)) + " FROM g GROUP BY ALL")
def _(spark, sf):
    q = R.qc_ledger(facts(spark, sf), qc_rules(spark), ["night", "target"], ["run"])
    return R.ledger_table(q, ["night", "target"], [c for c, *_ in QC_RULES])


@query("f24_task_ledger", "F24 C12", "SELECT o_custkey AS night, " + ", ".join(f"CASE WHEN {i} <= max(o_orderkey % 11) THEN '[x]' ELSE '[o]' END AS T{i}" for i in range(1, 11)) + " FROM orders GROUP BY 1")
def _(spark, sf):
    p = B.table(spark, sf, "orders").select(F.col("o_custkey").alias("night"), (F.col("o_orderkey") % 11).alias("task"))
    return R.task_ledger(p, ["night"])


@query("k08_ledger_upserts", "K08 C12", with_(FACTS) + """SELECT night, target, "check", max(run) AS run, round(arg_max(value, run), 6) AS value FROM fa GROUP BY ALL""")
def _(spark, sf):
    ledger = Ledger(spark, scratch_path(spark, "ledger"), ["night", "target", "check"], ["run"])
    for part in range(3):  # three nights of writing, compacted after the second
        ledger.append(facts(spark, sf).where(F.col("run") % 3 == part))
        if part == 1:
            ledger.compact()
    return ledger.current().select("night", "target", "check", "run", r("value").alias("value"))


@query("k07_best_aperture_record", "K07 A20", """SELECT l_suppkey AS target, l_returnflag AS filter, arg_min(l_linenumber, (s, l_linenumber)) AS ap, round(min(s), 6) AS score FROM (
  SELECT l_suppkey, l_returnflag, l_linenumber, round(avg(l_tax) * (1 + avg(l_discount)), 9) AS s FROM lineitem GROUP BY ALL) GROUP BY ALL""")
def _(spark, sf):
    score = F.round(F.avg("l_tax") * (1 + F.avg("l_discount")), 9)
    tried = cut(B.table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("target"), F.col("l_returnflag").alias("filter"), F.col("l_linenumber").alias("ap")).agg(score.alias("score")))
    # an aperture replaces the record where its score is smaller; of equal scores the lower aperture stays
    ledger = Ledger(spark, scratch_path(spark, "best"), ["target", "filter"], ["less", "lower"])
    for part in (0, 1):  # two runs of the pipeline over different apertures
        ledger.append(tried.where(F.col("ap") % 2 == part).withColumns({"less": -F.col("score"), "lower": -F.col("ap")}))
    ledger.compact()
    return ledger.current().select("target", "filter", "ap", r("score").alias("score"))
