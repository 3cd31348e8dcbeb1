"""Readers of lists, catalogues, series, logs and report tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values
TEFF_COLUMNS = {"id": "_c2", "teff": "_c56", "alt": "_c55"}
PWV_TIME, PWV_VALUE = "Date time", "Precipitable Water Vapour [mm]"
PLAN_LINE, MIN_ID_LENGTH = 3, 16
GUIDING_SKIP = 3
DEFAULTS = {"ron": 6.328, "dark": 0.3}
WCS_KEYS = ["CD1_1", "CD1_2", "CD2_1", "CD2_2", "CRPIX1", "CRPIX2", "CRVAL1", "CRVAL2", "CTYPE1", "CTYPE2", "PV2_1", "PV2_3", "PV2_5", "EQUINOX"]


def whole_files(spark: SparkSession, path) -> DataFrame:
    """(file, text), one row per file."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))


def file_lines(files: DataFrame) -> DataFrame:
    """(file, line_no from 0, value) of whole files."""
    return files.select("file", F.posexplode(F.split("text", "\r?\n")).alias("line_no", "value"))


def path_list(files: DataFrame) -> DataFrame:
    """Paths of list files in order (S04); blank lines are skipped."""
    lines = file_lines(files).withColumn("path", F.trim("value"))
    return lines.where("path <> ''").select("file", F.col("line_no").alias("pos"), "path")


def _plain_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().rstrip(",") for c in df.columns])


def target_list(spark: SparkSession, path, skip_first: bool = False) -> DataFrame:
    """Space-delimited target list: ids as text, names upper-cased.

    Column names may end with a comma.  ``skip_first`` drops a row that only holds units
    (no number as temperature)."""
    raw = _plain_names(spark.read.csv(path, sep=" ", header=True, ignoreLeadingWhiteSpace=True))
    out = raw.select(F.upper(F.trim("Sp_ID")).alias("name"), F.trim("Gaia_ID").alias("gaia_id"), F.col("T_eff").try_cast("double").alias("teff"))
    return out.where("teff IS NOT NULL") if skip_first else out


def teff_table(spark: SparkSession, path) -> DataFrame:
    """Positional CSV of temperatures (S07); header and bad rows drop out."""
    raw = spark.read.csv(path, header=False)
    c = TEFF_COLUMNS
    out = raw.select(F.trim(c["id"]).alias("id"), F.col(c["teff"]).try_cast("double").alias("teff"), F.col(c["alt"]).try_cast("double").alias("alt"))
    return out.where("teff IS NOT NULL")


def toi_table(spark: SparkSession, path) -> DataFrame:
    """TOI number to catalogue id and temperature."""
    raw = spark.read.csv(path, header=True)
    return raw.select(F.col("TOI").try_cast("double").cast("bigint").alias("toi"), F.col("GAIA").try_cast("decimal(20,0)").cast("string").alias("gaia_id"),
                      F.round(F.col("Teff").try_cast("double")).alias("teff"))


def iso_to_jd(value: Column) -> Column:
    """Julian date of ``yyyy-MM-ddTHH:mm:ss`` text; NULL when malformed.  Zone free."""
    t = F.try_to_timestamp(F.concat(value, F.lit("Z")), F.lit("yyyy-MM-dd'T'HH:mm:ssX"))
    return F.unix_micros(t) / F.lit(86400e6) + F.lit(2440587.5)


def pwv_archive(spark: SparkSession, path) -> DataFrame:
    """Archive TSV: rows whose time and value are both valid."""
    raw = spark.read.csv(path, sep="\t", header=True)
    out = raw.select(iso_to_jd(F.trim(F.col(f"`{PWV_TIME}`"))).alias("jd"), F.trim(F.col(f"`{PWV_VALUE}`")).try_cast("double").alias("pwv"))
    return out.where("jd IS NOT NULL AND pwv IS NOT NULL AND NOT isnan(pwv)")


def pwv_series(spark: SparkSession, path, layout: str) -> DataFrame:
    """Water vapour files in one of four layouts (S10); bad rows drop out.

    ``five`` fields 0 and 4; ``two`` two numbers; ``named`` JD and the archive's column
    or else columns 2 and 8; ``second`` fields 1 and 7.  Title lines are no numbers.
    """
    if layout == "named":
        raw = spark.read.csv(path, header=True)
        names = [c.strip() for c in raw.columns]
        raw = raw.toDF(*names)
        value = next((c for c in names if c.upper() == PWV_VALUE.upper()), None)
        a, b = ("JD", value) if "JD" in names and value else (names[2], names[8])
        out = raw.select(F.col(f"`{a}`").alias("a"), F.col(f"`{b}`").alias("b"))
    else:
        first, second = {"five": (0, 4), "two": (0, 1), "second": (1, 7)}[layout]
        parts = F.split(F.trim("value"), r"[,\s]+")
        out = spark.read.text(path).select(F.get(parts, F.lit(first)).alias("a"), F.get(parts, F.lit(second)).alias("b"))
    out = out.select(F.col("a").try_cast("double").alias("jd"), F.col("b").try_cast("double").alias("pwv"))
    return out.where("jd IS NOT NULL AND pwv IS NOT NULL")


def star_weights(spark: SparkSession, path) -> DataFrame:
    """Weights per star."""
    raw = _plain_names(spark.read.csv(path, header=True))
    return raw.select(F.trim("ID").alias("star_id"), F.col("`total weight`").try_cast("double").alias("weight"))


def light_curve(spark: SparkSession, path) -> DataFrame:
    """Two-column light curve: a bad time drops the row, a bad flux is missing."""
    raw = spark.read.csv(path, header=False)
    out = raw.select(F.col("_c0").try_cast("double").alias("jd"), F.col("_c1").try_cast("double").alias("flux"))
    return out.where("jd IS NOT NULL").withColumn("flux", F.when(~F.isnan("flux"), F.col("flux")))


def plan_id(files: DataFrame) -> DataFrame:
    """Catalogue id of observing plans: second token of the fourth line when that starts
    with ';' and the token is longer than 16 characters (S13)."""
    line = F.get(F.split("text", "\r?\n"), F.lit(PLAN_LINE))
    token = F.get(F.split(F.trim(line), r"\s+"), F.lit(1))
    return files.select("file", F.when(line.startswith(";") & (F.length(token) > MIN_ID_LENGTH), token).alias("gaia_id"))


SCHEDULE_COLUMNS = ["target", "start", "end", "minutes", "ra_h", "ra_m", "ra_s", "dec_d", "dec_m", "dec_s", "configuration"]


def schedule(spark: SparkSession, path) -> DataFrame:
    """Night schedule of eleven columns."""
    raw = spark.read.csv(path, sep=" ", header=True, quote='"')
    out = raw.toDF(*SCHEDULE_COLUMNS)
    return out.withColumns({c: F.col(c).try_cast("double") for c in SCHEDULE_COLUMNS[3:10]})


def guiding(files: DataFrame) -> DataFrame:
    """Guiding offsets: three title lines, then fields 0, 4, 5."""
    parts = F.split("value", ",")
    rows = file_lines(files).where(F.col("line_no") >= GUIDING_SKIP)
    out = rows.select("file", *[F.get(parts, F.lit(i)).try_cast("double").alias(n) for i, n in ((0, "jd"), (4, "ra_offset"), (5, "dec_offset"))])
    return out.where("jd IS NOT NULL")


def ruled_table(lines: DataFrame, names: list[str]) -> DataFrame:
    """Cells of pipe-ruled fixed-width tables; rules and title rows drop out."""
    cells = F.transform(F.split("value", r"\|"), lambda c: F.trim(c))
    rows = lines.where(F.trim("value").startswith("|")).withColumn("__c", cells)
    first = F.get("__c", F.lit(1))
    # the second row of such a table only holds widths
    rows = rows.where((first != names[0]) & ~first.rlike("^-+$"))
    others = [c for c in lines.columns if c != "value"]
    return rows.select(*others, *[F.get("__c", F.lit(i + 1)).alias(n) for i, n in enumerate(names)])


def tile_index(spark: SparkSession, path) -> DataFrame:
    """Reference catalogue tiles and their limits."""
    raw = spark.read.csv(path, sep=" ", header=False).select("_c0", "_c1", "_c2", "_c3", "_c4").toDF("tile", "ra_min", "ra_max", "dec_min", "dec_max")
    return raw.withColumns({c: F.col(c).try_cast("double") for c in ("ra_min", "ra_max", "dec_min", "dec_max")})


def tiles_for(positions: DataFrame, index: DataFrame) -> DataFrame:
    """Each position with the first tile (by name) that holds it, NULL outside all.

    Tiles are whole-degree boxes, joined on the degree they cover; repeated positions keep their rows."""
    def span(a, b):
        return F.explode(F.sequence(F.floor(a).cast("int"), F.floor(b).cast("int")))

    cells = index.withColumn("__i", span("ra_min", "ra_max")).withColumn("__j", span("dec_min", "dec_max"))
    p = positions.select("ra", "dec").distinct().withColumn("__i", F.floor("ra").cast("int")).withColumn("__j", F.floor("dec").cast("int"))
    hit = p.join(cells, ["__i", "__j"]).where("ra >= ra_min AND ra < ra_max AND dec >= dec_min AND dec < dec_max")
    return positions.join(hit.groupBy("ra", "dec").agg(F.min("tile").alias("tile")), ["ra", "dec"], "left").select(*positions.columns, "tile")


def run_registry(spark: SparkSession, path) -> DataFrame:
    """Two-column registry (S20); the spacer row has no id."""
    raw = _plain_names(spark.read.csv(path, sep=" ", header=True))
    return raw.toDF("reg_name", "reg_id").where("reg_id IS NOT NULL AND NOT reg_id RLIKE '^-+$'")


def wcs_solution(files: DataFrame) -> DataFrame:
    """Stored linear solution from JSON: ``wcs`` object; NULL without CD1_1."""
    numeric = {k: T.StringType() if k.startswith("CTYPE") else T.DoubleType() for k in WCS_KEYS}
    schema = T.StructType([T.StructField("wcs", T.StructType([T.StructField(k, t) for k, t in numeric.items()]))])
    w = F.from_json("text", schema)["wcs"]
    return files.select("file", F.when(w["CD1_1"].isNotNull(), w).alias("wcs"))


def spectra(wide: DataFrame, index: str = "wavelength") -> DataFrame:
    """Columns ``<pwv>_<airmass>`` to rows (wavelength, pwv_mm, airmass_x, transmission)."""
    names = [c for c in wide.columns if "_" in c and c.replace("_", "").replace(".", "").isdigit()]
    long = wide.unpivot([index], [F.col(f"`{c}`") for c in names], "__n", "transmission")
    return long.select(index, F.split_part("__n", F.lit("_"), F.lit(1)).cast("double").alias("pwv_mm"),
                       F.split_part("__n", F.lit("_"), F.lit(2)).cast("double").alias("airmass_x"), "transmission")


def aperture_sizes(spark: SparkSession, rcore: float) -> DataFrame:
    """Aperture radii as a dimension table."""
    from ..functions.photometry import APERTURE_FACTORS

    return spark.createDataFrame([(i + 1, f * rcore) for i, f in enumerate(APERTURE_FACTORS)], "ap int, radius double")


def condensed(spark: SparkSession, path: str, ap: int | None = None) -> DataFrame:
    """Condensed light curves of one aperture with column defaults (S05); ``ap`` prunes partitions."""
    df = spark.read.parquet(path)
    if ap is not None:
        df = df.where(F.col("ap") == ap)
    for name, default in DEFAULTS.items():
        df = df.withColumn(name, F.coalesce(F.col(name), F.lit(default)) if name in df.columns else F.lit(default))
    for name in ("gaia_id", "teff"):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast("string" if name == "gaia_id" else "double"))
    return df


def flux_cube(cubes: DataFrame, keys: list[str], cube: str = "flux") -> DataFrame:
    """Legacy star x frame matrices (array of arrays) to rows."""
    stars = cubes.select(*keys, F.posexplode(cube).alias("star_no", "__row"))
    return stars.select(*keys, "star_no", F.posexplode("__row").alias("frame_no", cube))
