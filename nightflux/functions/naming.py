"""Target and file names (F01, F02, F03, F33, F34, F35, W13's label)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..session import as_col
from .sky import sexagesimal_parts

# Fixed values
NAME_PREFIX = "SP"
LONG_PREFIXES = "SPC|SPEC"
NAME_TAIL = "BIS"
MISSING_WORDS = ["N", "", "nan", "NaN", "unknown"]


def pad2(value: Column) -> Column:
    return F.lpad(value.cast("string"), 2, "0")


def position_name(ra_deg, dec_deg) -> Column:
    """SPhhmm+ddmm from a position in degrees."""
    h, m, _ = sexagesimal_parts(as_col(ra_deg) / 15.0)
    d, dm, _ = sexagesimal_parts(as_col(dec_deg))
    # only a whole degree above zero counts as north
    sign = F.when(d > 0, "+").otherwise("-")
    return F.concat(F.lit(NAME_PREFIX), pad2(h), pad2(m), sign, pad2(F.abs(d)), pad2(dm))


def position_name_from_text(ra_text, dec_text) -> Column:
    """SPhhmm+ddmm from 'hh mm ss' and '+dd mm ss' text."""
    ra = F.replace(as_col(ra_text), F.lit(" "), F.lit(""))
    dec = F.replace(as_col(dec_text), F.lit(" "), F.lit(""))
    return F.concat(F.lit(NAME_PREFIX), F.substring(ra, 1, 4), F.substring(dec, 1, 5))


def tidy_name(name) -> Column:
    """Header name without tail, long prefix, underscores and extension."""
    n = F.split_part(as_col(name), F.lit(NAME_TAIL), F.lit(1))
    n = F.regexp_replace(n, LONG_PREFIXES, NAME_PREFIX)
    n = F.translate(n, "_", "-")
    return F.split_part(n, F.lit("."), F.lit(1))


def repaired_name(name, expected) -> Column:
    """The tidy header name where it already has 6+4 characters and the right sign,
    else the name expected from the position (F01)."""
    tidy, expected = tidy_name(name), as_col(expected)
    well_formed = tidy.rlike(r"^[^+-]{6}[+-][^+-]{4}$")
    same_sign = F.substring(tidy, 7, 1) == F.substring(expected, 7, 1)
    return F.when(well_formed & same_sign, tidy).otherwise(expected)


def hyphenated(name) -> Column:
    """Spaces as double hyphens, quotes removed."""
    bare = F.regexp_replace(as_col(name), "[\"']", "")
    return F.replace(bare, F.lit(" "), F.lit("--"))


def spaced(name) -> Column:
    """Double hyphens back to spaces."""
    return F.replace(as_col(name), F.lit("--"), F.lit(" "))


def processed_file_name(path) -> Column:
    """File name of the reduced frame: ``proc`` prefix, ``.fits`` extension."""
    base = F.element_at(F.split(as_col(path), "/"), -1)
    return F.concat(F.lit("proc"), F.regexp_replace(base, r"\.fts$", ".fits"))


def name_parts(file_name) -> dict[str, Column]:
    """target, filter, date and aperture of ``target_filter_date[_extra]_ap``."""
    stem = F.regexp_replace(F.element_at(F.split(as_col(file_name), "/"), -1), r"\.[A-Za-z]+$", "")
    parts = F.split(stem, "_")
    return {
        "target": parts.getItem(0),
        "filter": F.try_element_at(parts, F.lit(2)),
        "date": F.try_element_at(parts, F.lit(3)),
        "ap": F.element_at(parts, -1).try_cast("int"),
    }


def known_or_null(text) -> Column:
    """NULL for the words that stand for missing."""
    return F.when(~F.trim(as_col(text)).isin(MISSING_WORDS), F.trim(as_col(text)))


def positive_or_null(text) -> Column:
    """A number above zero, else NULL."""
    value = known_or_null(text).try_cast("double")
    return F.when((value > 0) & ~F.isnan(value), value)


def toi_number(name) -> Column:
    """Catalogue number of names like ``toi-123.01_x``; NULL for others."""
    hit = F.regexp_extract(F.lower(as_col(name)), r"toi-(\d+)", 1)
    return F.when(hit != "", hit.cast("bigint"))


def hms_label(h, m, s) -> Column:
    """hh:mm:ss with zero padding."""
    return F.concat_ws(":", *[pad2(as_col(c).cast("bigint")) for c in (h, m, s)])


def star_label(index) -> Column:
    """SP000000-style id of a zero-based row position."""
    return F.concat(F.lit(NAME_PREFIX), F.lpad(as_col(index).cast("string"), 6, "0"))
