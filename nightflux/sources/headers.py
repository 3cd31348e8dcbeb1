"""Frame headers from image files.

An image header is a run of 80-character cards padded to 2880-byte blocks.  It is
parsed with string and array expressions, so no Python worker is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values
CARD, BLOCK = 80, 2880
END_CARD = "END" + " " * 77
SIDE_EXTENSIONS = ["log", "Z", "txt", "gz"]


def list_frames(spark: SparkSession, directory: str, ext: str) -> DataFrame:
    """Paths of ``dir/*.ext`` and ``dir/*/*.ext`` (S01); the content is never read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{ext}").option("recursiveFileLookup", "true").load(directory)
    below = F.element_at(F.split(F.col("path"), F.lit(directory.rstrip("/").replace(".", "\\.") + "/")), -1)
    return files.select("path").where(F.size(F.split(below, "/")) <= 2)


def extension(path: Column | str) -> Column:
    return F.regexp_extract(path, r"\.([^./]+)$", 1)


def data_extension(files: DataFrame, keys: list[str], path: str = "path") -> DataFrame:
    """Extension of the last file that is no side file."""
    e = files.withColumn("__e", extension(path)).where(~F.col("__e").isin(SIDE_EXTENSIONS) & (F.col("__e") != ""))
    return e.groupBy(*keys).agg(F.max_by("__e", path).alias("ext"))


def _cards(text: Column) -> Column:
    n = F.floor(F.length(text) / CARD).cast("int")
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(text, i * CARD + 1, F.lit(CARD)))


def _end(text: Column) -> Column:
    """Characters up to and including the END card; 0 without one.

    The first END followed by blanks is nearly always the card; only where it is not
    on a card border are all cards looked at.
    """
    at = F.instr(text, F.lit(END_CARD))
    by_cards = F.array_position(F.transform(_cards(text), lambda c: F.rtrim(c)), "END") * CARD
    return F.when(at == 0, 0).when((at - 1) % CARD == 0, at + CARD - 1).otherwise(by_cards).cast("int")


def _value(card: Column) -> Column:
    body = F.substring(card, 11, 70)
    quoted = F.rtrim(F.regexp_extract(body, r"^\s*'([^']*)'", 1))
    plain = F.trim(F.split_part(body, F.lit("/"), F.lit(1)))
    return F.when(F.trim(body).startswith("'"), quoted).otherwise(plain)


def parse_headers(files: DataFrame) -> DataFrame:
    """(path, content) to (path, header MAP); NULL where the file is unreadable.

    Files named ``.fz`` carry the frame in their first extension.  One-element arrays
    carry intermediate results so that each is computed once.
    """
    packed = F.col("path").endswith(".fz")
    text = F.array(F.decode("content", "ISO-8859-1"))
    first = F.transform(text, lambda t: F.struct(t.alias("t"), _end(t).alias("e")))
    start = lambda e: (F.ceil(e / BLOCK) * BLOCK + 1).cast("int")
    main = F.transform(
        first, lambda p: F.when(packed & (p["e"] > 0), F.substring(p["t"], start(p["e"]), F.length(p["t"]))).otherwise(p["t"])
    )
    ended = F.transform(main, lambda t: F.struct(t.alias("t"), _end(t).alias("e")))
    cards = F.transform(ended, lambda p: F.when(p["e"] > CARD, _cards(F.substring(p["t"], F.lit(1), p["e"] - CARD))))
    valued = F.transform(cards, lambda cs: F.filter(cs, lambda c: F.substring(c, 9, 2) == "= "))
    entries = F.transform(
        valued, lambda cs: F.transform(cs, lambda c: F.struct(F.trim(F.substring(c, 1, 8)).alias("key"), _value(c).alias("value")))
    )
    return files.select("path", F.map_from_entries(F.get(entries, F.lit(0))).alias("header"))


def split_rejects(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good headers and the reject table of unreadable files."""
    return parsed.where("header IS NOT NULL"), parsed.where("header IS NULL").select("path")


def number(key: str, default: float | None = 0.0) -> Column:
    """Numeric keyword; optional keywords default to 0."""
    v = F.try_element_at("header", F.lit(key)).try_cast("double")
    return v if default is None else F.coalesce(v, F.lit(default))


def text(key: str) -> Column:
    return F.try_element_at("header", F.lit(key))


def flag(key: str) -> Column:
    """T / F keyword; absent is NULL."""
    v = text(key)
    return F.when(v == "T", True).when(v == "F", False)


def read_frames(spark: SparkSession, directory: str, ext: str) -> tuple[DataFrame, DataFrame]:
    """Frame table and reject table of a directory."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{ext}").load([directory, f"{directory}/*"])
    good, bad = split_rejects(parse_headers(files.select("path", "content")))
    frames = good.select(
        "path", text("IMAGETYP").alias("imagetyp"), text("DITHER").alias("dither"), text("FILTER").alias("filter"),
        text("OBJECT").alias("object"), text("FIELD").alias("field"), text("TELESCOP").alias("telescop"), text("CTYPE1").alias("ctype1"),
        number("NAXIS1").cast("int").alias("naxis1"), number("NAXIS2").cast("int").alias("naxis2"),
        number("EXPTIME").alias("exptime"), number("JD-OBS", None).alias("jd"), flag("WCSCOMPL").alias("wcscompl"),
    )
    return frames, bad
