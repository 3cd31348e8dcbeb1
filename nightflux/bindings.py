"""Photometry-shaped views of the given tables, in Spark and in SQL.

Each view exists twice: as a DataFrame function and as the SQL text the oracle
queries start from.  Nothing is filtered or cut: every view covers its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.timescale import julian_date


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _frame_no(col: str = "l_shipdate"):
    return (F.year(col) * 12 + F.month(col)).cast("int")


FRAME_SQL = "(year(l_shipdate) * 12 + month(l_shipdate))::INT"


def lc(spark: SparkSession, sf: str, by_aperture: bool = False) -> DataFrame:
    """Star x frame fluxes: star = supplier, frame = month, aperture = line number."""
    keys = ["ap", "star_id", "frame"] if by_aperture else ["star_id", "frame"]
    rows = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("star_id"), _frame_no().alias("frame"), F.col("l_linenumber").alias("ap"),
        F.col("l_extendedprice").alias("e"),
    )
    return (
        rows.groupBy(*keys)
        .agg(F.sum("e").alias("flux"), (F.avg("e") * 0.75).alias("peak"))
        .withColumn("jd", F.col("frame").cast("double"))
    )


LC_SQL = f"""lc AS (
  SELECT l_suppkey AS star_id, {FRAME_SQL} AS frame, {FRAME_SQL}::DOUBLE AS jd,
         sum(l_extendedprice) AS flux, avg(l_extendedprice) * 0.75::DOUBLE AS peak
  FROM lineitem GROUP BY ALL)"""

LC_AP_SQL = f"""lc AS (
  SELECT l_linenumber AS ap, l_suppkey AS star_id, {FRAME_SQL} AS frame, {FRAME_SQL}::DOUBLE AS jd,
         sum(l_extendedprice) AS flux, avg(l_extendedprice) * 0.75::DOUBLE AS peak
  FROM lineitem GROUP BY ALL)"""


def env(spark: SparkSession, sf: str) -> DataFrame:
    """One row per frame: exposure, sky, gain, airmass, readout noise, height."""
    return (
        table(spark, sf, "lineitem")
        .groupBy(_frame_no().alias("frame"))
        .agg(
            (F.sum("l_quantity") / F.lit(1000.0)).alias("exptime"),
            (F.avg("l_tax") * 1000.0).alias("sky"),
            (1 + F.avg("l_discount") * 10).alias("airmass"),
            (F.avg("l_quantity") / 10 + 4).alias("ron"),
        )
        .withColumn("gain", F.lit(1.1))
        .withColumn("height", F.lit(2390.0))
        .withColumn("jd", F.col("frame").cast("double"))
    )


ENV_SQL = f"""env AS (
  SELECT {FRAME_SQL} AS frame, {FRAME_SQL}::DOUBLE AS jd, sum(l_quantity) / 1000.0::DOUBLE AS exptime,
         avg(l_tax) * 1000.0::DOUBLE AS sky, 1 + avg(l_discount) * 10 AS airmass,
         avg(l_quantity) / 10 + 4 AS ron, 1.1::DOUBLE AS gain, 2390.0::DOUBLE AS height
  FROM lineitem GROUP BY ALL)"""


def pix(spark: SparkSession, sf: str) -> DataFrame:
    """Pixels: cell = part (y, x), frame = month, filter = return flag, adu = mean quantity."""
    return (
        table(spark, sf, "lineitem")
        .groupBy(
            F.col("l_returnflag").alias("filter"), _frame_no().alias("frame"), F.col("l_partkey").alias("cell")
        )
        .agg(F.avg("l_quantity").alias("adu"), (1 + F.avg("l_tax")).alias("exptime"))
        .withColumn("y", F.floor(F.col("cell") / 50).cast("int"))
        .withColumn("x", (F.col("cell") % 50).cast("int"))
    )


PIX_SQL = f"""pix AS (
  SELECT l_returnflag AS filter, {FRAME_SQL} AS frame, l_partkey AS cell, avg(l_quantity) AS adu,
         1 + avg(l_tax) AS exptime, (l_partkey // 50)::INT AS y, (l_partkey % 50)::INT AS x
  FROM lineitem GROUP BY ALL)"""

# Header values a frame of each priority would carry
PRIORITY_TYPES = {"1-URGENT": "Light Frame", "2-HIGH": "Bias Frame", "3-MEDIUM": "Dark Frame",
                  "4-NOT SPECIFIED": "Flat Field", "5-LOW": "Light Frame"}


def frames(spark: SparkSession, sf: str) -> DataFrame:
    """Frame headers from orders: one row per frame."""
    kind = F.lit(None).cast("string")
    for priority, name in PRIORITY_TYPES.items():
        kind = F.when(F.col("o_orderpriority") == priority, name).otherwise(kind)
    key = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        key.alias("frame_id"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("date"),
        kind.alias("imagetyp"),
        F.when(F.col("o_orderpriority") == "5-LOW", "ENABLED").alias("dither"),
        F.when(key % 11 == 0, 500).otherwise(2048).cast("int").alias("naxis1"),
        F.when(key % 7 == 0, 1280).otherwise(2088).cast("int").alias("naxis2"),
        F.col("o_orderstatus").alias("filter"),
        F.concat(F.lit("SP"), F.lpad((F.col("o_custkey") % 9000).cast("string"), 4, "0"),
                 F.when(F.col("o_custkey") % 2 == 0, "+").otherwise("-"),
                 F.lpad((key % 90).cast("string"), 4, "0"),
                 F.when(key % 13 == 0, "_2").otherwise("")).alias("object"),
        F.when(key % 5 == 0, "Moana").when(key % 3 == 0, "Artemis").otherwise("Io").alias("telescop"),
        F.when(key % 4 == 0, False).when(key % 4 == 1, True).alias("wcscompl"),
        F.when(key % 6 != 0, "RA---TAN").alias("ctype1"),
        (F.col("o_totalprice") / 1000.0).alias("exptime"),
        (F.col("o_custkey") % 50).alias("field"),
    )


FRAMES_SQL = """frames AS (
  SELECT o_orderkey AS frame_id, strftime(o_orderdate, '%Y%m%d') AS date,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Light Frame' WHEN '2-HIGH' THEN 'Bias Frame'
      WHEN '3-MEDIUM' THEN 'Dark Frame' WHEN '4-NOT SPECIFIED' THEN 'Flat Field'
      WHEN '5-LOW' THEN 'Light Frame' END AS imagetyp,
    CASE WHEN o_orderpriority = '5-LOW' THEN 'ENABLED' END AS dither,
    (CASE WHEN o_orderkey % 11 = 0 THEN 500 ELSE 2048 END)::INT AS naxis1,
    (CASE WHEN o_orderkey % 7 = 0 THEN 1280 ELSE 2088 END)::INT AS naxis2,
    o_orderstatus AS filter,
    'SP' || lpad((o_custkey % 9000)::VARCHAR, 4, '0') || CASE WHEN o_custkey % 2 = 0 THEN '+' ELSE '-' END
      || lpad((o_orderkey % 90)::VARCHAR, 4, '0') || CASE WHEN o_orderkey % 13 = 0 THEN '_2' ELSE '' END AS object,
    CASE WHEN o_orderkey % 5 = 0 THEN 'Moana' WHEN o_orderkey % 3 = 0 THEN 'Artemis' ELSE 'Io' END AS telescop,
    CASE WHEN o_orderkey % 4 = 0 THEN false WHEN o_orderkey % 4 = 1 THEN true END AS wcscompl,
    CASE WHEN o_orderkey % 6 <> 0 THEN 'RA---TAN' END AS ctype1,
    o_totalprice / 1000.0::DOUBLE AS exptime, o_custkey % 50 AS field
  FROM orders)"""

CLASS_SQL = """classed AS (
  SELECT *, CASE
    WHEN contains(upper(imagetyp), 'LIGHT') AND coalesce(dither, 'DISABLED') = 'ENABLED' THEN 'dithered'
    WHEN contains(upper(imagetyp), 'LIGHT') THEN 'science'
    WHEN contains(upper(imagetyp), 'DARK') AND naxis1 > 1000 THEN 'dark'
    WHEN contains(upper(imagetyp), 'BIAS') AND naxis1 > 1000 THEN 'bias'
    WHEN contains(upper(imagetyp), 'FLAT') AND (naxis1 > 2000 OR contains(upper(filter), 'ZYJ')) THEN 'flat'
    END AS class FROM frames)"""


def sky(spark: SparkSession, sf: str) -> DataFrame:
    """Stars from customers: position in degrees, proper motion in mas/yr, magnitudes."""
    k, b = F.col("c_custkey"), F.col("c_acctbal")
    return table(spark, sf, "customer").select(
        k.alias("id"),
        ((k * F.lit(137.50776405)) % 360.0).alias("ra"),
        ((k * F.lit(61.8)) % 120.0 - 60.0).alias("dec"),
        F.when(k % 17 != 0, b / 10).alias("pmra"),
        F.when(k % 17 != 0, b / -20).alias("pmdec"),
        (b / 100 + 20).alias("parallax"),
        (12 + (k % 100) / 12.5).alias("gmag"),
        F.when(k % 9 != 0, 2400 + (k % 40) * 100).cast("double").alias("teff"),
        F.col("c_nationkey").alias("field"),
    )


SKY_SQL = """sky AS (
  SELECT c_custkey AS id, (c_custkey * 137.50776405::DOUBLE) % 360.0::DOUBLE AS ra,
    (c_custkey * 61.8::DOUBLE) % 120.0::DOUBLE - 60.0::DOUBLE AS dec,
    CASE WHEN c_custkey % 17 <> 0 THEN c_acctbal / 10 END AS pmra,
    CASE WHEN c_custkey % 17 <> 0 THEN c_acctbal / -20 END AS pmdec,
    c_acctbal / 100 + 20 AS parallax, 12 + (c_custkey % 100) / 12.5::DOUBLE AS gmag,
    (CASE WHEN c_custkey % 9 <> 0 THEN 2400 + (c_custkey % 40) * 100 END)::DOUBLE AS teff,
    c_nationkey AS field
  FROM customer)"""


def sky_ref(spark: SparkSession, sf: str) -> DataFrame:
    """The reference catalogue: ``sky`` moved a little, every seventh star missing."""
    k = F.col("id")
    return (
        sky(spark, sf)
        .where(k % 7 != 3)
        .select(
            k.alias("ref_id"),
            (F.col("ra") + F.when(k % 2 == 0, 0.001).otherwise(-0.001) * F.when(k % 5 == 0, 0.3).otherwise(1.0)).alias("ref_ra"),
            (F.col("dec") + F.when(k % 3 == 0, 0.0004).otherwise(-0.0002)).alias("ref_dec"),
            F.col("pmra").alias("ref_pmra"), F.col("pmdec").alias("ref_pmdec"), F.col("gmag").alias("ref_gmag"),
            F.col("teff").alias("ref_teff"),
        )
    )


SKY_REF_SQL = """sky_ref AS (
  SELECT id AS ref_id,
    ra + CASE WHEN id % 2 = 0 THEN 0.001::DOUBLE ELSE -0.001::DOUBLE END
       * CASE WHEN id % 5 = 0 THEN 0.3::DOUBLE ELSE 1.0::DOUBLE END AS ref_ra,
    dec + CASE WHEN id % 3 = 0 THEN 0.0004::DOUBLE ELSE -0.0002::DOUBLE END AS ref_dec,
    pmra AS ref_pmra, pmdec AS ref_pmdec, gmag AS ref_gmag, teff AS ref_teff
  FROM sky WHERE id % 7 <> 3)"""


def series(spark: SparkSession, sf: str) -> DataFrame:
    """Irregular series from events: key = event type, t = Julian date, y = value."""
    return table(spark, sf, "events").select(
        F.col("event_type").alias("series"), "event_id", julian_date("ts").alias("t"), F.col("value").alias("y"),
    )


SERIES_SQL = """series AS (
  SELECT event_type AS series, event_id, epoch_us(ts) / 86400e6::DOUBLE + 2440587.5::DOUBLE AS t, value AS y
  FROM events)"""


#: Apertures of the survey with how much the two parts of the noise weigh in each.
SURVEY_APERTURES = [(4, 0.2, 0.1), (5, 0.05, 0.02), (6, 0.4, 0.1)]
SURVEY_STARS, SURVEY_START = 24, 2460311.0


def survey(spark: SparkSession, sf: str, store: Callable[[DataFrame], DataFrame] = lambda df: df) -> dict[str, DataFrame]:
    """A survey of steady stars: ten suppliers are a field, parts its 24 stars (star 0 the target), pairs of months its frames.

    Fluxes scatter by the cell's mean tax and discount, one frame in 29 is cloudy, star 23 is saturated; the
    runs of a field start on a day of their own.  Every event is a sample of the water archive, which no run owns.
    ``store`` may write the light curves before the targets are read from them.
    """
    li = table(spark, sf, "lineitem").select(
        F.floor(F.col("l_suppkey") / 10).cast("int").alias("field"), (F.col("l_partkey") % SURVEY_STARS).cast("int").alias("star_id"),
        F.floor(((F.year("l_shipdate") - 1995) * 12 + F.month("l_shipdate")) / 2).cast("int").alias("m"), "l_tax", "l_discount", "l_quantity")
    jd = F.lit(SURVEY_START) + F.col("field") % 20 + F.col("m") * F.lit(0.2)
    cells = li.groupBy("field", "star_id", "m").agg(F.avg("l_tax").alias("a"), F.avg("l_discount").alias("b"), F.avg("l_quantity").alias("q"))
    aps = F.explode(F.array(*[F.struct(F.lit(n).alias("ap"), F.lit(k).alias("k"), F.lit(c).alias("c")) for n, k, c in SURVEY_APERTURES]))
    air = (1 + 0.1 * F.sin(F.col("m") / 7.0)) * F.when(F.col("m") % 29 == 0, 0.5).otherwise(1.0)
    lc = store(cells.withColumn("x", aps).select(
        "field", "x.ap", "star_id", jd.alias("jd"),
        (F.lit(20000.0) / (1 + F.col("star_id") % 7) * air * (1 + F.col("x.k") * (F.col("a") - 0.04) + F.col("x.c") * (F.col("b") - 0.05))).alias("flux"),
        F.when(F.col("star_id") == SURVEY_STARS - 1, 80000.0).otherwise(F.col("q") * 100).alias("peak")))
    frames = li.groupBy("field", "m").agg(
        (1 + F.avg("l_discount") * 10).alias("airmass"), (50 + F.avg("l_tax") * 1000).alias("sky"), (F.avg("l_quantity") / 10 + 4).alias("ron"))
    frames = frames.select(
        "field", jd.alias("jd"), (10.0 + F.col("m") % 3).alias("exptime"), F.lit(1.1).alias("gain"), "airmass", "sky", "ron", F.lit(2390.0).alias("height"),
        F.when(F.col("field") % 4 == 3, "Artemis").otherwise("Io").alias("telescope"))
    s, f = F.col("star_id"), F.col("field") % 6
    stars = li.select("field", "star_id").distinct().select(
        "field", "star_id", (F.sin(s) / 100).alias("ra"), (F.cos(s) / 100 + F.col("field") * 0.001).alias("dec"),
        F.when(s == 0, F.when(f == 2, 1900.0).when(f == 3, None).when(f == 4, 3400.0).when(f == 5, 2500.0).otherwise(3000.0)).when(s % 5 != 4, 3600.0 + 100 * s).alias("teff"))
    targets = lc.where("star_id = 0").select("field", "ap", "star_id").distinct()
    pwv = table(spark, sf, "events").select(julian_date("ts").alias("jd"), (1 + F.col("value") / 20).alias("pwv"))
    return {"lc": lc, "frames": frames, "stars": stars, "targets": targets, "pwv": pwv}


_SURVEY_KEYS = "(l_suppkey // 10)::INT AS field, (((year(l_shipdate) - 1995) * 12 + month(l_shipdate)) // 2)::INT AS m"
_SURVEY_JD = f"{SURVEY_START}::DOUBLE + field % 20 + m * 0.2::DOUBLE AS jd"
SURVEY_SQL = f"""cells AS (SELECT {_SURVEY_KEYS}, (l_partkey % {SURVEY_STARS})::INT AS star_id, avg(l_tax) AS a, avg(l_discount) AS b, avg(l_quantity) AS q FROM lineitem GROUP BY ALL),
lc AS (SELECT field, ap, star_id, {_SURVEY_JD}, 20000.0::DOUBLE / (1 + star_id % 7) * ((1 + 0.1::DOUBLE * sin(m / 7.0::DOUBLE)) * CASE WHEN m % 29 = 0 THEN 0.5::DOUBLE ELSE 1 END)
    * (1 + k * (a - 0.04::DOUBLE) + c * (b - 0.05::DOUBLE)) AS flux, CASE WHEN star_id = {SURVEY_STARS - 1} THEN 80000.0::DOUBLE ELSE q * 100 END AS peak
  FROM cells, (VALUES {", ".join(f"({n}, {k}::DOUBLE, {c}::DOUBLE)" for n, k, c in SURVEY_APERTURES)}) t(ap, k, c)),
env AS (SELECT field, {_SURVEY_JD}, 10.0::DOUBLE + m % 3 AS exptime, 1.1::DOUBLE AS gain, airmass, sky, ron, 2390.0::DOUBLE AS height,
    CASE WHEN field % 4 = 3 THEN 'Artemis' ELSE 'Io' END AS telescope FROM (
  SELECT {_SURVEY_KEYS}, 1 + avg(l_discount) * 10 AS airmass, 50 + avg(l_tax) * 1000 AS sky, avg(l_quantity) / 10 + 4 AS ron FROM lineitem GROUP BY ALL)),
sky AS (SELECT field, star_id, sin(star_id) / 100 AS ra, cos(star_id) / 100 + field * 0.001::DOUBLE AS dec,
    CASE WHEN star_id = 0 THEN CASE field % 6 WHEN 2 THEN 1900 WHEN 3 THEN NULL WHEN 4 THEN 3400 WHEN 5 THEN 2500 ELSE 3000 END
      WHEN star_id % 5 <> 4 THEN 3600 + 100 * star_id END::DOUBLE AS teff FROM (SELECT DISTINCT field, star_id FROM cells)),
wet AS (SELECT epoch_us(ts) / 86400e6::DOUBLE + 2440587.5::DOUBLE AS t, min(1 + value / 20) AS y FROM events GROUP BY 1)"""
