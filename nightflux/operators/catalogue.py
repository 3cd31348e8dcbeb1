"""Star catalogues: crossmatch, target match, selections and checks
(A19, A27, A28, J01-J09, J17, J23, K09, O08, O10, P08, P09, P11, P22, W01, C07, C09, C10, C15)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sky import propagate, separation_deg
from ..session import as_col, cut
from .grouped import attach, clip_bounds, medians
from .ordered import linked, top_per_group
from .rangejoin import distinct_positions, footprint_start, nearest_any, nearest_within, within_plane

# Fixed values
CONE_DEG = 0.0084
MATCH_LIMIT_DEG = math.degrees(1e-5)
ZERO_POINT_LIMITS = {"izmag": 20.0, "gmag": 19.0, "g_rp": 0.8, "bp_rp": 0.25, "edge": (20.0, 1980.0)}
ZERO_POINT_OFFSET = 24.16
HIGH_MOTION_MAS = 50.0
PLATE_MATCH_PIXELS = 10.0
REFERENCE_STARS = 20


def crossmatch(stars: DataFrame, refs: DataFrame, obs_jd: float, epoch_jd: float, fine: float | None = None) -> DataFrame:
    """Each star with its nearest reference row, moved to the observation date.

    ``stars``(id, ra, dec, ...); ``refs``(ref_id, ref_ra, ref_dec, ref_pmra, ref_pmdec, ...).
    Candidates lie in the search cone by their catalogue position; the nearest by the
    moved position wins and must be within 1e-5 rad.  One join replaces one lookup per
    star; a reference row may serve several stars.
    """
    ra, dec = propagate("ref_ra", "ref_dec", "ref_pmra", "ref_pmdec", F.lit(epoch_jd), F.lit(obs_jd))
    moved = distinct_positions(refs.withColumn("now_ra", ra).withColumn("now_dec", dec), "now_ra", "now_dec", "ref_id")
    in_cone = separation_deg("ra", "dec", "ref_ra", "ref_dec") <= CONE_DEG
    best = nearest_within(stars, moved, ("ra", "dec"), ("now_ra", "now_dec"), "ref_id", MATCH_LIMIT_DEG, fine, in_cone)
    return stars.join(best, ["ra", "dec"], "left")


def match_completeness(matched: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Share of stars with a match in percent, and how many have a temperature."""
    return matched.groupBy(*keys).agg(
        (100.0 * F.count("match") / F.count("*")).alias("matched_percent"), F.count("match.ref_teff").alias("n_teff")
    )


def replace_match_columns(catalogue: DataFrame, match: DataFrame, key: str, drop: Sequence[str] = ("pm_ra", "pm_dec")) -> DataFrame:
    """Catalogue with its match columns replaced or added, the rest kept."""
    new = [c for c in match.columns if c != key]
    kept = catalogue.drop(*new, *drop)
    return kept.join(match, key, "left")


def first_map(ids: DataFrame, mapping: DataFrame, key: str, value: str) -> DataFrame:
    """Cross-release id: the first hit (smallest value) or NULL."""
    return ids.join(mapping.groupBy(key).agg(F.min(value).alias(value)), key, "left")


def target_match(stars: DataFrame, targets: DataFrame, field: Sequence[str], key: str, flux: str, pos: str) -> DataFrame:
    """Listed targets found in each field; of several rows with one id the brightest.

    Adds ``n_rows`` and, per field, ``outcome``: none is absent, 'one' or 'many'.
    """
    hits = stars.join(targets.select(key).distinct(), key)
    names = stars.columns
    best = hits.groupBy(*field, key).agg(
        F.max_by(F.struct(*names), F.struct(F.col(flux), -F.col(pos))).alias("__b"), F.count("*").alias("n_rows")
    ).select(*field, F.col(key), *[F.col(f"__b.{c}").alias(c) for c in names if c != key and c not in field], "n_rows")
    many = best.groupBy(*field).agg(F.when(F.count("*") > 1, "many").otherwise("one").alias("outcome"))
    return attach(best, field, many)


def resolve_identity(sources: Sequence[DataFrame], key: str, value: str, names: DataFrame) -> DataFrame:
    """Identity by precedence of sources; names without any keep their name.

    ``sources`` in order of precedence, each (key, value).  Adds ``source`` (1-based, 0 for none).
    """
    union = None
    for i, s in enumerate(sources):
        part = s.where(F.col(value).isNotNull()).select(key, F.col(value).cast("string").alias(value), F.lit(i + 1).alias("source"))
        union = part if union is None else union.unionByName(part)
    best = union.groupBy(key).agg(F.min(F.struct("source", value)).alias("__b")).select(key, "__b.*")
    return names.join(best, key, "left").withColumn("source", F.coalesce("source", F.lit(0))).withColumn(
        value, F.coalesce(value, F.col(key).cast("string"))
    )


def nearest_reference(stars: DataFrame, refs: DataFrame, field: Sequence[str]) -> DataFrame:
    """Nearest reference row of every star at any distance, with signed offsets.

    Separations more than five deviations above the median of their field are
    clipped until stable and come out as NULL ``sep_deg``.
    """
    box = refs.agg(F.count("*").alias("n"), (F.max("ref_dec") - F.min("ref_dec")).alias("h"), (F.max("ref_ra") - F.min("ref_ra")).alias("w")).first()
    start = footprint_start(max(box["h"] or 0, 1e-3) * max(box["w"] or 0, 1e-3), box["n"])
    found = nearest_any(stars, refs, ("ra", "dec"), ("ref_ra", "ref_dec"), "ref_id", start)
    rows = cut(stars.join(found, ["ra", "dec"]))
    rows = rows.withColumn("dra", (F.col("ra") - F.col("match.ref_ra")) * F.cos(F.radians("dec"))).withColumn(
        "ddec", F.col("dec") - F.col("match.ref_dec")
    )
    bounds = clip_bounds(rows, field, "sep_deg", sigma=5.0, max_rounds=None, lower=False, stored=True)
    keep = F.col("sep_deg").between(F.col("lo"), F.col("hi"))
    return attach(rows, field, bounds).withColumn("clipped_sep", F.when(keep, F.col("sep_deg"))).drop("lo", "hi")


def astrometric_rms(matched: DataFrame, field: Sequence[str]) -> DataFrame:
    """Median separation in arc seconds and number of sources per frame."""
    return medians(
        matched, field, {"rms_arcsec": F.col("clipped_sep") * 3600.0}, F.count("clipped_sep").alias("n_sources")
    )


def footprint_filter(stars: DataFrame, refs: DataFrame, field: Sequence[str], cell: float = 1.0) -> DataFrame:
    """Reference rows strictly inside the extent of each field's stars."""
    box = stars.groupBy(*field).agg(
        F.min("ra").alias("ra0"), F.max("ra").alias("ra1"), F.min("dec").alias("dec0"), F.max("dec").alias("dec1")
    )

    def span(a, b):
        return F.explode(F.sequence(F.floor(F.col(a) / cell), F.floor(F.col(b) / cell)))

    cells = box.withColumn("__i", span("ra0", "ra1")).withColumn("__j", span("dec0", "dec1"))
    r = refs.withColumn("__i", F.floor(F.col("ref_ra") / cell)).withColumn("__j", F.floor(F.col("ref_dec") / cell))
    inside = (
        (F.col("ref_ra") > F.col("ra0")) & (F.col("ref_ra") < F.col("ra1"))
        & (F.col("ref_dec") > F.col("dec0")) & (F.col("ref_dec") < F.col("dec1"))
    )
    return r.join(cells, ["__i", "__j"]).where(inside).drop("__i", "__j", "ra0", "ra1", "dec0", "dec1")


def blended(stars: DataFrame, keys: Sequence[str], key: str, x: str, y: str, radius: float) -> DataFrame:
    """Stars with another star closer than ``radius``.

    Cells have the radius as their diagonal: two stars in one cell are blended without
    a look at pairs.  Only stars alone in their cell meet the 5x5 cells around.
    """
    keys, size = list(keys), radius / math.sqrt(2.0)
    s = stars.select(*keys, key, x, y, F.floor(F.col(x) / size).alias("__cx"), F.floor(F.col(y) / size).alias("__cy"))
    counts = s.groupBy(*keys, "__cx", "__cy").agg(F.count("*").alias("__n"))
    s = s.join(counts, [*keys, "__cx", "__cy"])
    crowded = s.where("__n > 1").select(*keys, key)
    alone = s.where("__n = 1").select(*keys, F.col(key).alias("__k"), F.col(x).alias("__x"), F.col(y).alias("__y"), F.col("__cx").alias("__ax"), F.col("__cy").alias("__ay"))
    reach = alone.withColumn("__cx", F.explode(F.sequence(F.col("__ax") - 2, F.col("__ax") + 2))).withColumn(
        "__cy", F.explode(F.sequence(F.col("__ay") - 2, F.col("__ay") + 2))
    )
    near = reach.join(s, [*keys, "__cx", "__cy"]).where(
        (F.col("__k") != F.col(key)) & (F.hypot(F.col("__x") - F.col(x), F.col("__y") - F.col(y)) < radius)
    )
    return crowded.unionByName(near.select(*keys, F.col("__k").alias(key))).distinct()


def nearest_other(stars: DataFrame, keys: Sequence[str], x: str, y: str, radius: float) -> DataFrame:
    """Distance of every star to the nearest other star of its group as column ``nearest``.

    Repeated positions have 0; a star alone in its group or without a finite position has NULL.
    Crowded places are settled within ``radius``; it doubles for stars still without a neighbour until all have one.
    """
    keys = list(keys)
    spots = stars.where((F.col(x) - F.col(x) == 0) & (F.col(y) - F.col(y) == 0))
    spots = cut(spots.groupBy(*keys, x, y).agg(F.count("*").alias("__n")))
    out = spots.where("__n > 1").select(*keys, x, y, F.lit(0.0).alias("nearest"))
    size = spots.groupBy(*keys).agg(F.count("*").alias("__size"))
    todo = cut(attach(spots.where("__n = 1"), keys, size).where("__size > 1").drop("__n", "__size"))
    others = spots.select(*keys, F.col(x).alias("__ox"), F.col(y).alias("__oy"))
    while not todo.isEmpty():
        pairs = within_plane(todo, others, keys, (x, y), ("__ox", "__oy"), radius).where(F.col("dist") > 0)
        hit = cut(pairs.groupBy(*keys, x, y).agg(F.min("dist").alias("nearest")))
        out = out.unionByName(hit)
        todo = cut(todo.join(hit, [*keys, x, y], "left_anti"))
        radius = 2 * radius
    return stars.join(out, [*keys, x, y], "left")


def plate_match(refs: DataFrame, detections: DataFrame, keys: Sequence[str], radius: float = PLATE_MATCH_PIXELS) -> DataFrame:
    """How many reference positions have a detection within ten pixels."""
    hits = within_plane(refs, detections, list(keys), ("ref_x", "ref_y"), ("det_x", "det_y"), radius)
    return hits.select(*keys, "ref_id").distinct().groupBy(*keys).agg(F.count("*").alias("n_matched"))


def brightest(refs: DataFrame, keys: Sequence[str], mag: str, tie: str, n: int = REFERENCE_STARS) -> DataFrame:
    """The brightest reference stars of each field."""
    return top_per_group(refs.where(F.col(mag).isNotNull()), keys, [mag, tie], n)


def zero_point_mask() -> Column:
    """Stars fit for the zero point."""
    lim = ZERO_POINT_LIMITS
    lo, hi = lim["edge"]

    def inside(c):
        return (F.col(c) > lo) & (F.col(c) < hi)

    return (
        F.col("izmag").isNotNull() & ~F.isnan("izmag") & (F.col("izmag") < lim["izmag"]) & (F.col("gmag") <= lim["gmag"])
        & (F.col("g_rp") < lim["g_rp"]) & (F.col("bp_rp") > lim["bp_rp"]) & inside("x") & inside("y")
    )


def zero_point(stars: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Median of catalogue minus instrumental magnitude."""
    offset = (F.col("gmag") - F.col("g_rp")) - (F.col("izmag") - ZERO_POINT_OFFSET)
    return medians(stars.where(zero_point_mask()), keys, {"zero_point": offset}, F.count("*").alias("n"))


def mid_brightness(stars: DataFrame, keys: Sequence[str], flux: str) -> DataFrame:
    """Stars between the medians of the fainter and of the brighter half."""
    stars = cut(stars)
    half = attach(stars, keys, cut(medians(stars, keys, {"__m": flux}, stored=True)))
    f, m = F.col(flux), F.col("__m")
    parts = medians(half, keys, {"__lo": F.when(f < m, f), "__hi": F.when(f > m, f)}, stored=True)
    return attach(half, keys, parts).where((f > F.col("__lo")) & (f < F.col("__hi"))).drop("__m", "__lo", "__hi")


def high_motion(stars: DataFrame, tie: str) -> DataFrame:
    """Stars moving more than 50 mas/yr; where there is none, the first five with a motion."""
    moving = stars.where(F.col("pmra").isNotNull() & F.col("pmdec").isNotNull())
    fast = moving.where(F.hypot("pmra", "pmdec") > HIGH_MOTION_MAS)
    n = fast.agg(F.count("*").alias("__n"))
    few = moving.orderBy(tie).limit(5).crossJoin(F.broadcast(n)).where("__n = 0").drop("__n")  # n: one row
    return fast.unionByName(few)


def frame_shifts(frames: DataFrame, keys: Sequence[str], t: str, ra: str, dec: str, width: float = 1.0) -> DataFrame:
    """Shift in arc seconds from the previous and from the first frame."""
    links = linked(frames, keys, t, [ra, dec], width)
    first = frames.groupBy(*keys).agg(F.min_by(F.struct(ra, dec), t).alias("__f"))
    rows = attach(links, keys, first)

    def arc(a, b):
        return (F.col(a) - b) * 3600.0

    def total(d_ra, d_dec):
        return F.sqrt(F.pow(d_ra * F.cos(F.radians(dec)), F.lit(2.0)) + F.pow(d_dec, F.lit(2.0)))

    p, f = F.col("before"), F.col("__f")
    dra, ddec = F.coalesce(arc(ra, p[ra]), F.lit(0.0)), F.coalesce(arc(dec, p[dec]), F.lit(0.0))
    fra, fdec = arc(ra, f[ra]), arc(dec, f[dec])
    return rows.withColumns({
        "ra_move": dra, "dec_move": ddec, "move": total(dra, ddec),
        "ra_shift": fra, "dec_shift": fdec, "shift": total(fra, fdec),
    }).drop("before", "after", "__f")


def stars_to_move(catalogue: DataFrame, match: DataFrame, reference: DataFrame, field: Sequence[str], key: str) -> DataFrame:
    """Catalogue with its match's proper motion and the date its positions refer to.

    ``reference``(field, jd) is the reference frame of each field.
    """
    with_motion = catalogue.drop("pmra", "pmdec").join(match.select(key, "pmra", "pmdec"), key, "left")
    return attach(with_motion, field, reference.select(*field, F.col("jd").alias("catalogue_jd")))


def motion_corrected(stars: DataFrame, from_jd, to_jd) -> DataFrame:
    """Catalogue with positions moved to a date."""
    ra, dec = propagate("ra", "dec", "pmra", "pmdec", as_col(from_jd), as_col(to_jd))
    return stars.withColumns({"ra": ra, "dec": dec})


def motion_audit(original: DataFrame, corrected: DataFrame, key: str, years: float) -> DataFrame:
    """Was the observation date used? Compare corrected positions with the moved and the
    unmoved prediction, in mas (C15)."""
    c = corrected.select(key, F.col("ra").alias("__cra"), F.col("dec").alias("__cdec"))
    rows = high_motion(original, key).join(c, key)
    moved_ra = F.col("ra") + F.col("pmra") / 3.6e6 * years / F.cos(F.radians("dec"))
    moved_dec = F.col("dec") + F.col("pmdec") / 3.6e6 * years

    def off(a, b):
        return F.hypot((F.col("__cra") - a) * F.cos(F.radians("dec")), F.col("__cdec") - b) * 3.6e6

    return rows.withColumn("off_moved", off(moved_ra, moved_dec)).withColumn(
        "off_unmoved", off(F.col("ra"), F.col("dec"))
    ).withColumn("verdict", F.when(F.col("off_moved") < F.col("off_unmoved"), "observation date").otherwise("epoch")).drop("__cra", "__cdec")
