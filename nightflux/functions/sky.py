"""Positions on the sky."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..session import as_col

# Fixed values
YEAR_DAYS = 365.0
MAS_PER_DEGREE = 3.6e6
KM_S_PER_AU_YR = 4.740
KM_S_TO_PC_YR = 977780.0
EPOCH_J2016 = 2457389.0
EPOCH_J2015_5 = 2457206.375


def separation(ra1, dec1, ra2, dec2) -> Column:
    """Great-circle separation of two positions in radians, in and out."""
    ra1, dec1, ra2, dec2 = map(as_col, (ra1, dec1, ra2, dec2))
    h = F.pow(F.sin((dec2 - dec1) / 2), F.lit(2.0)) + F.cos(dec1) * F.cos(dec2) * F.pow(
        F.sin((ra2 - ra1) / 2), F.lit(2.0)
    )
    return 2 * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def separation_deg(ra1, dec1, ra2, dec2) -> Column:
    """Great-circle separation, degrees in and out."""
    return F.degrees(separation(*[F.radians(as_col(c)) for c in (ra1, dec1, ra2, dec2)]))


def distance_weight(a: Column | str, sep: Column | str, max_sep: Column | str) -> Column:
    """1 / (1 + (a sep / max sep)^2)."""
    x = as_col(a) * as_col(sep) / as_col(max_sep)
    return 1 / (1 + x * x)


def propagate(ra, dec, pmra, pmdec, from_jd, to_jd) -> tuple[Column, Column]:
    """Position in degrees after proper motion in mas/yr, pmra holding cos(dec).

    Years have 365 days.  A missing proper motion leaves the position unchanged.
    """
    ra, dec, pmra, pmdec = map(as_col, (ra, dec, pmra, pmdec))
    years = (as_col(to_jd) - as_col(from_jd)) / YEAR_DAYS
    new_ra = ra + pmra / MAS_PER_DEGREE / F.cos(F.radians(dec)) * years
    new_dec = dec + pmdec / MAS_PER_DEGREE * years
    return F.coalesce(new_ra, ra), F.coalesce(new_dec, dec)


def propagate_plain(ra, dec, pmra, pmdec, years) -> tuple[Column, Column]:
    """Variant whose pmra is taken as an angle in ra itself, years given."""
    ra, dec = as_col(ra), as_col(dec)
    years = as_col(years)
    return (
        F.coalesce(ra + as_col(pmra) / MAS_PER_DEGREE * years, ra),
        F.coalesce(dec + as_col(pmdec) / MAS_PER_DEGREE * years, dec),
    )


def propagate_in_space(ra, dec, pmra, pmdec, parallax, years) -> tuple[Column, Column]:
    """Proper motion along a straight line in space; parallax in mas."""
    ra, dec = F.radians(as_col(ra)), F.radians(as_col(dec))
    distance = 1000.0 / as_col(parallax)
    v_ra = as_col(pmra) / 1000.0 * distance * KM_S_PER_AU_YR / KM_S_TO_PC_YR
    v_dec = as_col(pmdec) / 1000.0 * distance * KM_S_PER_AU_YR / KM_S_TO_PC_YR
    t = as_col(years)
    # position plus t times the transverse velocity, in the local east/north frame
    radial = distance * F.cos(dec) - t * v_dec * F.sin(dec)
    x = radial * F.cos(ra) - t * v_ra * F.sin(ra)
    y = radial * F.sin(ra) + t * v_ra * F.cos(ra)
    z = distance * F.sin(dec) + t * v_dec * F.cos(dec)
    new_ra = F.degrees(F.atan2(y, x))
    return (
        F.when(new_ra < 0, new_ra + 360.0).otherwise(new_ra),
        F.degrees(F.atan(z / F.hypot(x, y))),
    )


def position_angle(cd11, cd12, cd21, cd22) -> Column:
    """Rotation of a frame in degrees from its linear terms."""
    cd11, cd12, cd21, cd22 = map(as_col, (cd11, cd12, cd21, cd22))
    parity = F.when(cd11 * cd22 - cd12 * cd21 >= 0, 1.0).otherwise(-1.0)
    return F.degrees(F.atan((parity * cd21 - cd12) / (parity * cd11 + cd22)))


def plate_scale_deg(pixel_mm, focal_mm) -> Column:
    """Angle of one pixel in degrees."""
    return F.degrees(F.atan(as_col(pixel_mm) / as_col(focal_mm)))


def field_of_view_deg(scale_deg, nx, ny, dec_deg) -> tuple[Column, Column]:
    """Field in ra and dec, the ra side widened by 1/cos(dec)."""
    s = as_col(scale_deg)
    return s * as_col(nx) / F.cos(F.radians(as_col(dec_deg))), s * as_col(ny)


def tan_to_sky(x, y, crpix1, crpix2, crval1, crval2, cd11, cd12, cd21, cd22) -> tuple[Column, Column]:
    """Gnomonic pixel-to-sky in degrees, no distortion terms."""
    x, y, crpix1, crpix2, crval1, crval2, cd11, cd12, cd21, cd22 = map(
        as_col, (x, y, crpix1, crpix2, crval1, crval2, cd11, cd12, cd21, cd22)
    )
    dx, dy = x - crpix1, y - crpix2
    xi = F.radians(cd11 * dx + cd12 * dy)
    eta = F.radians(cd21 * dx + cd22 * dy)
    d0 = F.radians(crval2)
    down = F.cos(d0) - eta * F.sin(d0)
    ra = F.degrees(F.radians(crval1) + F.atan2(xi, down))
    dec = F.degrees(F.atan((F.sin(d0) + eta * F.cos(d0)) / F.hypot(xi, down)))
    return ra - 360.0 * F.floor(ra / 360.0), dec


def sexagesimal_parts(value) -> tuple[Column, Column, Column]:
    """Signed whole units, whole minutes and seconds of a decimal angle."""
    v = as_col(value)
    a = F.abs(v)
    minutes = (a - F.floor(a)) * 60
    unit = F.floor(a) * F.when(v < 0, -1).otherwise(1)
    return unit.cast("bigint"), F.floor(minutes).cast("bigint"), (minutes - F.floor(minutes)) * 60


def sexagesimal_to_degrees(text, hours: bool = False) -> Column:
    """Degrees of 'uu mm ss.s' or 'uu:mm:ss.s' text; hours scale by 15."""
    parts = F.split(F.trim(as_col(text)), "[ :]+")
    size = (
        F.abs(parts.getItem(0).cast("double"))
        + parts.getItem(1).cast("double") / 60
        + parts.getItem(2).cast("double") / 3600
    )
    sign = F.when(F.trim(as_col(text)).startswith("-"), -1.0).otherwise(1.0)
    return sign * size * (15.0 if hours else 1.0)


def axis_angle_deg(theta_deg, x, y) -> Column:
    """Ellipse angle folded to one half turn, axes swapped when x < y."""
    theta = as_col(theta_deg)
    turned = theta - 360.0 * F.when(theta >= 0, F.floor(theta / 360.0)).otherwise(F.ceil(theta / 360.0))
    turned = turned - F.when(as_col(x) < as_col(y), 90.0).otherwise(0.0)
    turned = F.when(turned < 0, turned + 360.0).otherwise(turned)
    return F.when(turned > 180.0, turned - 180.0).otherwise(turned)
