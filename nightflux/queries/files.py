"""Readers and writers: text and tables made from the given tables, written to the
shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import bindings as B
from ..operators import append as AP
from ..operators import ensemble as E
from ..operators import frames as FR
from ..operators import lightcurve as L
from ..session import cut, scratch_path
from ..sources import headers as H
from ..sources import sinks as K
from ..sources import tables as S
from ..streaming.append import append_stream, night_stream
from .registry import query, r, with_

ISO = "yyyy-MM-dd'T'HH:mm:ss"


def written_text(spark, df, name):
    path = scratch_path(spark, name)
    df.write.text(path)
    return path


def written_csv(spark, df, name, **options):
    path = scratch_path(spark, name)
    df.write.options(**options).csv(path)
    return path


@query("s01_list_frames", "S01", "SELECT DISTINCT 'event_type=' || event_type AS folder FROM events")
def _(spark, sf):
    path = scratch_path(spark, "frames")
    B.table(spark, sf, "events").select("event_type", F.col("props").alias("value")).write.partitionBy("event_type").text(path)
    return H.list_frames(spark, path, "txt").select(F.element_at(F.split("path", "/"), -2).alias("folder")).distinct()


@query("s02_data_extension", "S02", """WITH f AS (SELECT o_custkey AS night, 'IMG' || lpad(o_orderkey::VARCHAR, 9, '0') || '.' || CASE o_orderkey % 6 WHEN 0 THEN 'log' WHEN 1 THEN 'txt' WHEN 2 THEN 'gz' WHEN 3 THEN 'fits' WHEN 4 THEN 'fts' ELSE 'Z' END AS path FROM orders)
SELECT night, arg_max(split_part(path, '.', 2), path) AS ext FROM f WHERE split_part(path, '.', 2) IN ('fits', 'fts') GROUP BY night""")
def _(spark, sf):
    k = F.col("o_orderkey")
    kinds = F.array(*[F.lit(x) for x in ("log", "txt", "gz", "fits", "fts", "Z")])
    f = B.table(spark, sf, "orders").select(F.col("o_custkey").alias("night"), F.concat(F.lit("/data/IMG"), F.lpad(k.cast("string"), 9, "0"), F.lit("."), F.get(kinds, (k % 6).cast("int"))).alias("path"))
    return H.data_extension(f, ["night"])


def _card(key, value):
    return F.rpad(F.concat(F.rpad(F.lit(key), 8, " "), F.lit("= "), value), 80, " ")


def header_files(spark, sf):
    """Image headers as bytes, one per order: a fifth packed in an extension, some cut short."""
    o = B.frames(spark, sf).join(B.table(spark, sf, "orders").select(F.col("o_orderkey").alias("frame_id"), "o_totalprice"), "frame_id")
    k = F.col("frame_id")
    quoted = lambda c: F.concat(F.lit("'"), c, F.lit("'"))
    cards = F.concat(
        _card("SIMPLE", F.lit("                   T / standard")), F.rpad(F.lit("COMMENT made from a table"), 80, " "),
        _card("IMAGETYP", quoted(F.col("imagetyp"))), _card("NAXIS1", F.col("naxis1").cast("string")), _card("FILTER", quoted(F.rpad("filter", 8, " "))),
        _card("OBJECT", quoted(F.col("object"))), _card("JD-OBS", F.concat((k + 2450000).cast("string"), F.lit(".5 / start"))),
        F.when(k % 3 != 0, _card("EXPTIME", F.concat((k % 50).cast("string"), F.lit(".25")))).otherwise(F.lit("")),
        F.when(k % 13 != 0, F.rpad(F.lit("END"), 80, " ")).otherwise(F.lit("")))
    primary = F.rpad(F.concat(_card("SIMPLE", F.lit("T")), F.rpad(F.lit("END"), 80, " ")), 2880, " ")
    text = F.when(k % 5 == 0, F.concat(primary, cards)).otherwise(cards)
    name = F.concat(F.lit("/night/F"), k.cast("string"), F.when(k % 5 == 0, F.lit(".fits.fz")).otherwise(F.lit(".fits")))
    return o.select(name.alias("path"), F.encode(F.rpad(text, 5760, " "), "ISO-8859-1").alias("content"))


@query("s03_header_ingest", "S03 P19 D1", with_(B.FRAMES_SQL) + """SELECT '/night/F' || frame_id || CASE WHEN frame_id % 5 = 0 THEN '.fits.fz' ELSE '.fits' END AS path, CASE WHEN frame_id % 13 <> 0 THEN imagetyp END AS imagetyp,
 CASE WHEN frame_id % 13 <> 0 THEN filter END AS filter, CASE WHEN frame_id % 13 <> 0 THEN object END AS object, CASE WHEN frame_id % 13 <> 0 THEN naxis1 END AS naxis1,
 CASE WHEN frame_id % 13 <> 0 THEN frame_id + 2450000.5::DOUBLE END AS jd, CASE WHEN frame_id % 13 <> 0 THEN CASE WHEN frame_id % 3 <> 0 THEN frame_id % 50 + 0.25::DOUBLE ELSE 0 END END AS exptime, frame_id % 13 = 0 AS rejected FROM frames""")
def _(spark, sf):
    p = H.parse_headers(header_files(spark, sf))
    bad = F.col("header").isNull()
    ok = lambda c: F.when(~bad, c)
    return p.select("path", H.text("IMAGETYP").alias("imagetyp"), H.text("FILTER").alias("filter"), H.text("OBJECT").alias("object"), ok(H.number("NAXIS1")).cast("int").alias("naxis1"),
                    H.number("JD-OBS", None).alias("jd"), ok(H.number("EXPTIME")).alias("exptime"), bad.alias("rejected"))


@query("s04_path_lists", "S04 D2", """WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents),
p AS (SELECT doc_id, unnest(range(len(a)))::INT AS pos, unnest(a) AS value FROM l)
SELECT doc_id, pos, length(trim(value)) AS n FROM p WHERE trim(value) <> ''""")
def _(spark, sf):
    files = B.table(spark, sf, "documents").select(F.col("doc_id").alias("file"), "text")
    return S.path_list(files).select(F.col("file").alias("doc_id"), "pos", F.length("path").cast("bigint").alias("n"))


@query("s05_condensed_aperture", "S05 K02", with_(B.LC_AP_SQL) + "SELECT star_id, frame, round(flux, 3) AS flux, 6.328::DOUBLE AS ron, 0.3::DOUBLE AS dark FROM lc WHERE ap = 3")
def _(spark, sf):
    path = scratch_path(spark, "condensed")
    K.write_partitioned(B.lc(spark, sf, by_aperture=True), path, ["ap"])
    return S.condensed(spark, path, 3).select("star_id", "frame", r("flux", 3).alias("flux"), "ron", "dark")


@query("s05_flux_cube", "S05 D6", with_(B.LC_SQL) + """, f AS (SELECT DISTINCT frame FROM lc), s AS (SELECT DISTINCT star_id FROM lc),
g AS (SELECT star_id, frame, flux FROM s CROSS JOIN f LEFT JOIN lc USING (star_id, frame))
SELECT star_id AS star_key, (row_number() OVER (PARTITION BY star_id ORDER BY frame) - 1)::INT AS frame_no, round(flux, 3) AS flux FROM g""")
def _(spark, sf):
    lc = cut(B.lc(spark, sf))
    frames = lc.select("frame").distinct()
    full = lc.select("star_id").distinct().crossJoin(F.broadcast(frames)).join(lc.select("star_id", "frame", "flux"), ["star_id", "frame"], "left")  # frames: months of the survey
    one = full.groupBy("star_id").agg(F.array(F.transform(F.sort_array(F.collect_list(F.struct("frame", "flux"))), lambda s: s["flux"])).alias("flux"))
    return S.flux_cube(one, ["star_id"]).select(F.col("star_id").alias("star_key"), "frame_no", r("flux", 3).alias("flux"))


@query("s06_target_list", "S06 D13", """SELECT upper('sp' || c_custkey) AS name, (c_custkey * 1000003 + 4000000000000000000)::VARCHAR AS gaia_id, (2000 + c_custkey % 3000)::DOUBLE AS teff FROM customer WHERE c_custkey % 10 <> 0""")
def _(spark, sf):
    k = F.col("c_custkey")
    t = B.table(spark, sf, "customer").select(F.concat(F.lit("sp"), k.cast("string")).alias("Sp_ID,"), (k * 1000003 + 4000000000000000000).cast("string").alias("Gaia_ID,"),
                                              F.when(k % 10 != 0, (2000 + k % 3000).cast("string")).otherwise("K").alias("T_eff,"))
    return S.target_list(spark, written_csv(spark, t, "targets", sep=" ", header=True), skip_first=True)


@query("s07_teff_table", "S07 J03", """SELECT c_custkey::VARCHAR AS id, (2000 + c_custkey % 999)::DOUBLE AS teff, (c_custkey % 7)::DOUBLE AS alt FROM customer WHERE c_custkey % 6 <> 0""")
def _(spark, sf):
    k = F.col("c_custkey")
    cols = [F.lit("x").alias(f"f{i}") for i in range(57)]
    cols[2], cols[55] = k.cast("string").alias("f2"), (k % 7).cast("string").alias("f55")
    cols[56] = F.when(k % 6 != 0, (2000 + k % 999).cast("string")).otherwise("Teff").alias("f56")
    return S.teff_table(spark, written_csv(spark, B.table(spark, sf, "customer").select(*cols), "teff"))


@query("s08_toi_table", "S08 F34", "SELECT p_partkey AS toi, (p_partkey + 1000)::VARCHAR AS gaia_id, round(p_retailprice) AS teff FROM part")
def _(spark, sf):
    t = B.table(spark, sf, "part").select(F.col("p_partkey").alias("TOI"), F.concat((F.col("p_partkey") + 1000).cast("string"), F.lit(".0")).alias("GAIA"), F.col("p_retailprice").alias("Teff"))
    return S.toi_table(spark, written_csv(spark, t, "toi", header=True))


@query("s09_pwv_archive", "S09 D11", """SELECT epoch(date_trunc('second', ts))::BIGINT AS seconds, value AS pwv FROM events WHERE event_id % 9 <> 0 AND event_id % 10 <> 0""")
def _(spark, sf):
    e = B.table(spark, sf, "events")
    k = F.col("event_id")
    t = e.select(F.when(k % 9 != 0, F.concat(F.lit(" "), F.date_format("ts", ISO))).otherwise("--").alias(S.PWV_TIME), F.when(k % 10 != 0, F.concat(F.lit(" "), F.col("value").cast("string"), F.lit(" "))).otherwise("n/a").alias(S.PWV_VALUE),
                 F.lit("  ").alias("IR temperature [Celsius]"))
    return S.pwv_archive(spark, written_csv(spark, t, "pwv", sep="\t", header=True)).select(F.round((F.col("jd") - 2440587.5) * 86400).cast("bigint").alias("seconds"), "pwv")


@query("s10_pwv_layouts", "S10 U02 K06", "SELECT layout, event_id::DOUBLE AS jd, value AS pwv FROM events, (VALUES ('five'), ('two'), ('second'), ('named')) t(layout)")
def _(spark, sf):
    e = B.table(spark, sf, "events").select(F.col("event_id").cast("string").alias("a"), F.col("value").cast("string").alias("b"))
    s = F.lit(",")
    shapes = {"five": F.concat("a", s, F.lit("1,2,3,"), "b"), "two": F.concat("a", F.lit(" "), "b"), "second": F.concat(F.lit("x,"), "a", F.lit(",1,2,3,4,5,"), "b")}
    out = None
    for layout, line in shapes.items():
        part = S.pwv_series(spark, written_text(spark, e.select(line.alias("value")), layout), layout).withColumn("layout", F.lit(layout))
        out = part if out is None else out.unionByName(part)
    named = written_csv(spark, e.select(F.col("a").alias("JD"), F.col("b").alias(S.PWV_VALUE)), "named", header=True)
    return out.unionByName(S.pwv_series(spark, named, "named").withColumn("layout", F.lit("named")))


@query("s11_s12_weights_and_curve", "S11 S12", """SELECT 'w' AS kind, s_suppkey::DOUBLE AS a, s_acctbal AS b FROM supplier
UNION ALL SELECT 'lc', event_id::DOUBLE, CASE WHEN event_id % 4 <> 0 THEN value END FROM events WHERE event_id % 7 <> 0""")
def _(spark, sf):
    w = B.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("ID"), F.col("s_acctbal").alias("total weight"))
    got = S.star_weights(spark, written_csv(spark, w, "weights", header=True)).select(F.lit("w").alias("kind"), F.col("star_id").cast("double").alias("a"), F.col("weight").alias("b"))
    k = F.col("event_id")
    e = B.table(spark, sf, "events").select(F.when(k % 7 != 0, k.cast("string")).otherwise("bad"), F.when(k % 4 != 0, F.col("value").cast("string")).when(k % 8 == 0, "NaN").otherwise("-"))
    c = S.light_curve(spark, written_csv(spark, e, "curve"))
    return got.unionByName(c.select(F.lit("lc").alias("kind"), F.col("jd").alias("a"), F.col("flux").alias("b")))


@query("s13_plan_ids", "S13", """SELECT doc_id AS file, CASE WHEN doc_id % 3 = 0 THEN '1234567890' || lpad(doc_id::VARCHAR, 9, '0') END AS gaia_id FROM documents""")
def _(spark, sf):
    k = F.col("doc_id")
    line = F.when(k % 3 == 0, F.concat(F.lit("; 1234567890"), F.lpad(k.cast("string"), 9, "0"), F.lit(" note"))).when(k % 3 == 1, "; short").otherwise("no id")
    files = B.table(spark, sf, "documents").select(k.alias("file"), F.concat(F.lit("a\nb\nc\n"), line, F.lit("\n"), F.col("text")).alias("text"))
    return S.plan_id(files)


@query("s14_schedule", "S14 F35", """SELECT c_name AS target, 'UT ' || (c_custkey % 24) AS start, (c_custkey % 600)::DOUBLE AS minutes, (c_custkey % 24)::DOUBLE AS ra_h, (c_custkey % 90)::DOUBLE AS dec_d, c_mktsegment AS configuration FROM customer""")
def _(spark, sf):
    k = F.col("c_custkey")
    t = B.table(spark, sf, "customer").select("c_name", F.concat(F.lit("UT "), (k % 24).cast("string")).alias("s"), F.lit("UT x").alias("e"), (k % 600).alias("m"), (k % 24).alias("rh"), F.lit(1).alias("rm"), F.lit(2).alias("rs"),
                                              (k % 90).alias("dd"), F.lit(3).alias("dm"), F.lit(4).alias("ds"), "c_mktsegment")
    return S.schedule(spark, written_csv(spark, t, "schedule", sep=" ", header=True)).select("target", "start", "minutes", "ra_h", "dec_d", "configuration")


@query("s15_guiding", "S15", """WITH p AS (SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS i, unnest(string_split(text, chr(10))) AS v FROM documents)
SELECT doc_id AS file, i::DOUBLE AS jd, length(v)::DOUBLE AS ra_offset, (doc_id % 10)::DOUBLE AS dec_offset FROM p WHERE length(v) % 5 <> 0""")
def _(spark, sf):
    d = B.table(spark, sf, "documents")
    k = F.col("doc_id")
    lines = F.transform(F.split("text", "\n"), lambda v, i: F.concat_ws(",", F.when(F.length(v) % 5 != 0, i.cast("string")).otherwise("bad"), F.lit("b"), F.lit("c"), F.lit("d"), F.length(v).cast("string"), (k % 10).cast("string")))
    return S.guiding(d.select(k.alias("file"), F.concat(F.lit("7,0,0,0,1,1\n8,0,0,0,1,1\n9,0,0,0,1,1\n"), F.array_join(lines, "\n")).alias("text")))


@query("s17_ruled_tables", "S17", """SELECT c_custkey::VARCHAR AS "Night", c_mktsegment AS "Target", 'T' || c_nationkey AS "Telescope" FROM customer""")
def _(spark, sf):
    rows = B.table(spark, sf, "customer").select(F.concat(F.lit("| "), F.col("c_custkey").cast("string"), F.lit(" | "), F.rpad("c_mktsegment", 20, " "), F.lit(" | T"), F.col("c_nationkey").cast("string"), F.lit(" |")).alias("value"))
    heads = B.table(spark, sf, "region").select(F.explode(F.array(F.lit("| Night | Target | Telescope |"), F.lit("| -------- | ---- | ---- |"))).alias("value"))
    path = written_text(spark, heads.unionByName(rows), "ruled")
    return S.ruled_table(spark.read.text(path), ["Night", "Target", "Telescope"])


@query("s18_tiles", "S18", with_(B.SKY_SQL) + """SELECT id, 't' || lpad((floor(ra / 10) * 100 + floor((dec + 60) / 10))::INT::VARCHAR, 5, '0') AS tile FROM sky""")
def _(spark, sf):
    s = B.sky(spark, sf)
    boxes = s.select(F.floor(F.col("ra") / 10).alias("i"), F.floor((F.col("dec") + 60) / 10).alias("j")).distinct()
    t = boxes.select(F.concat(F.lit("t"), F.lpad((F.col("i") * 100 + F.col("j")).cast("string"), 5, "0")), F.col("i") * 10, F.col("i") * 10 + 10, F.col("j") * 10 - 60, F.col("j") * 10 - 50)
    index = S.tile_index(spark, written_csv(spark, t, "tiles", sep=" "))
    return S.tiles_for(s.select("id", "ra", "dec"), index).select("id", "tile")


@query("s20_k13_registry", "S20 K13 O11", "SELECT p_name || '-' || p_partkey AS reg_name, p_partkey::VARCHAR AS reg_id FROM part")
def _(spark, sf):
    p = B.table(spark, sf, "part").select(F.concat("p_name", F.lit("-"), F.col("p_partkey").cast("string")).alias("Sp_ID"), F.col("p_partkey").cast("string").alias("Gaia_ID"))
    spacer = B.table(spark, sf, "region").select(F.lit("----").alias("Sp_ID"), F.lit("------").alias("Gaia_ID"))
    reg = S.run_registry(spark, written_csv(spark, p.unionByName(spacer), "registry", sep=" ", header=True))
    path = scratch_path(spark, "registry-sorted")
    K.write_sorted(reg, path, ["reg_name"])
    return spark.read.parquet(path)


@query("s21_wcs_json", "S21", "SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN l_linenumber <> 3 THEN l_tax END AS cd11, CASE WHEN l_linenumber <> 3 THEN l_quantity END AS crval1 FROM lineitem")
def _(spark, sf):
    li = B.table(spark, sf, "lineitem")
    js = F.concat(F.lit('{"wcs": {'), F.when(F.col("l_linenumber") != 3, F.concat(F.lit('"CD1_1": '), F.col("l_tax").cast("string"), F.lit(", "))).otherwise(F.lit("")), F.lit('"CRVAL1": '), F.col("l_quantity").cast("string"), F.lit(', "CTYPE1": "RA---TAN"}}'))
    w = S.wcs_solution(li.select(F.struct("l_orderkey", "l_partkey", "l_linenumber").alias("file"), js.alias("text")))
    return w.select("file.*", F.col("wcs.CD1_1").alias("cd11"), F.col("wcs.CRVAL1").alias("crval1"))


@query("s24_spectra", "S24", """SELECT p_partkey AS wavelength, pw AS pwv_mm, am AS airmass_x, round(p_retailprice * pw + am, 4) AS transmission FROM part, (VALUES (0.5::DOUBLE), (10.0::DOUBLE)) a(pw), (VALUES (1.0::DOUBLE), (1.5::DOUBLE)) b(am)""")
def _(spark, sf):
    p = B.table(spark, sf, "part")
    wide = p.select(F.col("p_partkey").alias("wavelength"), *[(F.col("p_retailprice") * pw + am).alias(f"{pw}_{am}") for pw in (0.5, 10.0) for am in (1.0, 1.5)])
    return S.spectra(wide).select("wavelength", "pwv_mm", "airmass_x", r("transmission", 4).alias("transmission"))


@query("s25_aperture_sizes", "S25 F07", """SELECT l_orderkey, l_partkey, l_linenumber AS ap, round(4 * CASE l_linenumber WHEN 1 THEN 0.5 WHEN 2 THEN 1 / sqrt(2) WHEN 3 THEN 1 WHEN 4 THEN sqrt(2) WHEN 5 THEN 2 WHEN 6 THEN 2 * sqrt(2) WHEN 7 THEN 4 END::DOUBLE, 6) AS radius FROM lineitem""")
def _(spark, sf):
    li = B.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", F.col("l_linenumber").alias("ap"))
    return li.join(F.broadcast(S.aperture_sizes(spark, 4.0)), "ap").select("l_orderkey", "l_partkey", "ap", r("radius").alias("radius"))  # 13 rows


# --- writers ------------------------------------------------------------------------

@query("k01_frame_lists", "K01 C03 D2", with_(B.FRAMES_SQL, B.CLASS_SQL) + "SELECT class, field, filter, count(*) AS n FROM classed WHERE class IS NOT NULL GROUP BY ALL")
def _(spark, sf):
    c = FR.classify(B.frames(spark, sf)).withColumn("path", F.concat(F.lit("F"), F.col("frame_id").cast("string")))
    path = scratch_path(spark, "lists")
    K.write_frame_lists(c, path)
    return spark.read.parquet(path).groupBy("class", "field", "filter").agg(F.count("path").alias("n"))


@query("c05_condense_night", "C05 K02 K03 A02 D10", """WITH a AS (SELECT event_type AS target, strftime(ts, '%Y%m%d') AS date, event_id, value FROM events),
s AS (SELECT * FROM a WHERE event_id % 3 <> 0 UNION ALL SELECT * FROM a WHERE event_id % 3 = 0 AND event_id % 2 = 0)
SELECT target, date::INT AS date, count(*) AS n, round(avg(value), 5) AS flux_mean, round(median(value), 5) AS flux_median FROM s GROUP BY ALL""")
def _(spark, sf):
    rows = B.table(spark, sf, "events").select(F.col("event_type").alias("target"), F.lit("f").alias("filter"), F.date_format("ts", "yyyyMMdd").alias("date"), "event_id", "value")
    path = scratch_path(spark, "night")
    K.write_night(rows.where("event_id % 3 <> 0"), path)
    # the second load overlaps the first; only its new rows are added
    K.append_new(rows.where("event_id % 2 = 0"), path, ["event_id"], ["target", "filter", "date"])
    stats = L.star_statistics(spark.read.parquet(path), ["target", "date"], "value").join(
        spark.read.parquet(path).groupBy("target", "date").agg(F.count("*").alias("n")), ["target", "date"])
    return stats.select("target", "date", "n", r("flux_mean", 5).alias("flux_mean"), r("flux_median", 5).alias("flux_median"))


@query("k02_overwrite_one_night", "K02", """SELECT strftime(ts, '%Y%m%d')::INT AS date, count(*) AS n, round(sum(CASE WHEN strftime(ts, '%Y%m%d') = '20240105' THEN -value ELSE value END), 3) AS total FROM events GROUP BY 1""")
def _(spark, sf):
    rows = B.table(spark, sf, "events").select(F.lit("t").alias("target"), F.lit("f").alias("filter"), F.date_format("ts", "yyyyMMdd").alias("date"), "event_id", "value")
    path = scratch_path(spark, "nights")
    K.write_night(rows, path)
    K.write_night(rows.where("date = '20240105'").withColumn("value", -F.col("value")), path)
    return spark.read.parquet(path).groupBy("date").agg(F.count("*").alias("n"), r(F.sum("value"), 3).alias("total"))


@query("k04_products", "W08 D10", with_(B.LC_SQL) + """, w AS (SELECT star_id, median(flux) AS weight FROM lc GROUP BY star_id)
SELECT star_id, row_number() OVER (ORDER BY (star_id = 1)::INT DESC, weight DESC, star_id) AS rank, n_points FROM w JOIN (SELECT star_id, count(*) AS n_points FROM lc GROUP BY star_id) USING (star_id)""")
def _(spark, sf):
    lc = cut(B.lc(spark, sf).withColumn("run_id", F.lit("t1_I_all_6")))
    w = L.star_statistics(lc, ["run_id", "star_id"]).withColumnRenamed("flux_median", "weight")
    ranked = E.weight_order(w, ["run_id"], F.col("star_id") == 1)
    path = scratch_path(spark, "products")
    K.write_products({"lightcurve": lc.select("run_id", "star_id", "jd", "flux"), "weights": ranked.select("run_id", "star_id", "weight", "rank")}, path, ["run_id"])
    n = spark.read.parquet(f"{path}/lightcurve").groupBy("star_id").agg(F.count("*").alias("n_points"))
    return spark.read.parquet(f"{path}/weights").join(n, "star_id").select("star_id", F.col("rank").cast("bigint").alias("rank"), "n_points")


@query("k05_flat_text", "K05", with_(B.LC_SQL) + "SELECT star_id, frame - 2450000.0::DOUBLE AS jd, round(flux, 2) AS flux FROM lc")
def _(spark, sf):
    lc = B.lc(spark, sf)
    full = lc.select("star_id", "jd", "flux", *[F.lit(0.0).alias(c) for c in K.FLAT_COLUMNS if c not in ("jd", "flux")])
    path = scratch_path(spark, "flat")
    K.write_flat_text(full, path, ["star_id"])
    back = spark.read.csv(path, header=True)
    return back.select(F.col("star_id").cast("bigint").alias("star_id"), F.col("jd").cast("double").alias("jd"), r(F.col("flux").cast("double"), 2).alias("flux"))


@query("k10_curve_arrays", "K10 D7", with_(B.LC_SQL) + "SELECT star_id, count(*) AS n, min(jd) AS first_jd, max(jd) AS last_jd, round(max(flux), 2) AS top FROM lc GROUP BY star_id")
def _(spark, sf):
    path = scratch_path(spark, "curves")
    K.write_curves(B.lc(spark, sf).select("star_id", "jd", "flux"), path, ["star_id"])
    return spark.read.parquet(path).groupBy("star_id").agg(
        F.count("*").alias("n"), F.min("jd").alias("first_jd"), F.max("jd").alias("last_jd"), r(F.max("flux"), 2).alias("top"))


@query("k06_k12_series_and_masters", "K06 K12", """SELECT 'original' AS kind, event_type AS target, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY event_type
UNION ALL SELECT 'processed', event_type, count(*), round(sum(value), 2) FROM events WHERE value < 100 GROUP BY event_type
UNION ALL SELECT 'bias', 'all', count(*), round(sum(p_retailprice), 2) FROM part UNION ALL SELECT 'dark', 'all', count(*), round(sum(p_size), 2) FROM part""")
def _(spark, sf):
    e = B.table(spark, sf, "events").select(F.col("event_type").alias("target"), F.col("event_id").cast("double").alias("jd"), F.col("value").alias("pwv"))
    p = B.table(spark, sf, "part").select(F.lit("I").alias("filter"), F.floor(F.col("p_partkey") / 50).alias("y"), (F.col("p_partkey") % 50).alias("x"), F.col("p_retailprice").alias("bias"), F.col("p_size").cast("double").alias("dark"))
    a, b = scratch_path(spark, "pwv"), scratch_path(spark, "masters")
    K.write_pwv({"original": e, "processed": e.where("pwv < 100")}, a, ["target"])
    K.write_masters({"bias": p, "dark": p}, b)
    one = spark.read.parquet(a).groupBy("kind", "target").agg(F.count("*").alias("n"), r(F.sum("pwv"), 2).alias("total"))
    return one.unionByName(spark.read.parquet(b).groupBy("kind", F.lit("all").alias("target")).agg(F.count("*").alias("n"), r(F.sum("value"), 2).alias("total")))


@query("c05_stream_append", "C05 J10", """SELECT event_id, round(value, 4) AS value FROM events WHERE event_id % 3 <> 0 UNION ALL SELECT event_id, round(value * 2, 4) FROM events WHERE event_id % 2 = 0 AND event_id % 3 = 0""")
def _(spark, sf):
    e = B.table(spark, sf, "events").select("event_id", "value")
    stored, incoming = e.where("event_id % 3 <> 0"), e.where("event_id % 2 = 0").withColumn("value", F.col("value") * 2)
    src, out = scratch_path(spark, "incoming"), scratch_path(spark, "stored")
    incoming.write.parquet(src)
    incoming.write.mode("append").parquet(src)  # the same night delivered twice
    stored.write.parquet(out)
    stream = night_stream(spark, src, incoming.schema)
    added = scratch_path(spark, "added")
    append_stream(stream, spark.read.parquet(out), ["event_id"], added, scratch_path(spark, "stream-state")).awaitTermination()
    return AP.merged(spark.read.parquet(out), spark.read.parquet(added), ["event_id"]).select("event_id", r("value", 4).alias("value"))
