"""Julian dates, exposure mid-times and date spellings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..session import as_col

# Fixed values
UNIX_EPOCH_JD = 2440587.5
SECONDS_PER_DAY = 86400.0
AU_LIGHT_SECONDS = 499.00478383615643
ASTRONOMICAL_UNIT_M = 149597870700.0
SPEED_OF_LIGHT_M_S = 299792458.0
TT_MINUS_TAI_SECONDS = 32.184
# TAI-UTC in seconds from the given Julian date on
LEAP_SECONDS = [
    (2441317.5, 10), (2441499.5, 11), (2441683.5, 12), (2442048.5, 13), (2442413.5, 14),
    (2442778.5, 15), (2443144.5, 16), (2443509.5, 17), (2443874.5, 18), (2444239.5, 19),
    (2444786.5, 20), (2445151.5, 21), (2445516.5, 22), (2446247.5, 23), (2447161.5, 24),
    (2447892.5, 25), (2448257.5, 26), (2448804.5, 27), (2449169.5, 28), (2449534.5, 29),
    (2450083.5, 30), (2450630.5, 31), (2451179.5, 32), (2453736.5, 33), (2454832.5, 34),
    (2456109.5, 35), (2457204.5, 36), (2457754.5, 37),
]


def unix_micros(ts: str) -> Column:
    """Microseconds since 1970 of a zone-free timestamp column, whatever the session zone.

    Built from the calendar fields: going through a zoned timestamp would shift times
    around daylight-saving changes.
    """
    t = f"CAST(`{ts}` AS TIMESTAMP_NTZ)"
    return F.expr(
        f"datediff(CAST({t} AS DATE), DATE'1970-01-01') * 86400000000L + hour({t}) * 3600000000L"
        f" + minute({t}) * 60000000L + CAST(extract(SECOND FROM {t}) * 1000000 AS BIGINT)"
    )


def julian_date(ts: str) -> Column:
    """Julian date (double) of a timestamp column."""
    return unix_micros(ts) / F.lit(86400e6) + F.lit(UNIX_EPOCH_JD)


def timestamp_of(jd: Column | str) -> Column:
    """Zone-free timestamp of a Julian date, for display only."""
    micros = F.round((as_col(jd) - UNIX_EPOCH_JD) * 86400e6).cast("bigint")
    return F.timestamp_micros(micros)


def mid_exposure(jd: Column | str, exposure: Column | str) -> Column:
    """Middle of an exposure that starts at ``jd`` and lasts ``exposure`` seconds."""
    return as_col(jd) + as_col(exposure) / SECONDS_PER_DAY / 2.0


def compact_date(day: Column | str) -> Column:
    """YYYYMMDD text of a date."""
    return F.date_format(as_col(day), "yyyyMMdd")


def iso_date(compact: Column | str) -> Column:
    """YYYY-MM-DD text of a YYYYMMDD text."""
    return F.date_format(F.to_date(as_col(compact), "yyyyMMdd"), "yyyy-MM-dd")


def days_before(compact: Column | str, days: int) -> Column:
    """The YYYYMMDD text ``days`` earlier."""
    return F.date_format(F.date_sub(F.to_date(as_col(compact), "yyyyMMdd"), days), "yyyyMMdd")


def heliocentric_correction(ra: Column | str, dec: Column | str, sun_ra: Column | str, sun_dec: Column | str) -> Column:
    """Days to add to a Julian date to refer it to the Sun's centre; degrees in (F16)."""
    a, d, sa, sd = (F.radians(as_col(c)) for c in (ra, dec, sun_ra, sun_dec))
    along = F.sin(d) * F.sin(sd) + F.cos(d) * F.cos(sd) * F.cos(a - sa)
    return -(ASTRONOMICAL_UNIT_M / SPEED_OF_LIGHT_M_S) * along / SECONDS_PER_DAY


def sun_position(jd: Column | str) -> tuple[Column, Column, Column]:
    """Low-precision apparent place of the Sun: (ra deg, dec deg, distance AU).

    The Astronomical Almanac's short formula, good to about 0.01 degree.
    """
    n = as_col(jd) - 2451545.0
    mean_longitude = 280.460 + 0.9856474 * n
    g = F.radians(357.528 + 0.9856003 * n)
    ecl = F.radians(mean_longitude + 1.915 * F.sin(g) + 0.020 * F.sin(2 * g))
    eps = F.radians(23.439 - 0.0000004 * n)
    ra = F.degrees(F.atan2(F.cos(eps) * F.sin(ecl), F.cos(ecl)))
    ra = ra - 360.0 * F.floor(ra / 360.0)
    dec = F.degrees(F.asin(F.sin(eps) * F.sin(ecl)))
    dist = 1.00014 - 0.01671 * F.cos(g) - 0.00014 * F.cos(2 * g)
    return ra, dec, dist


def tai_minus_utc(jd: Column | str) -> Column:
    """Leap seconds in force at a UTC Julian date; NULL before 1972."""
    steps = F.lit(None).cast("double")
    for start, seconds in LEAP_SECONDS:
        steps = F.when(as_col(jd) >= start, F.lit(float(seconds))).otherwise(steps)
    return steps


def tdb_offset_seconds(jd: Column | str, ra: Column | str, dec: Column | str) -> Column:
    """Seconds from UTC at the observer to TDB at the Sun's centre.

    Low-precision: the Sun stands in for the barycentre (up to about 4.5 s) and the
    observer for the Earth's centre (21 ms); parity with an ephemeris is not claimed.
    """
    sun_ra, sun_dec, dist = sun_position(jd)
    n = as_col(jd) - 2451545.0
    g = F.radians(357.53 + 0.98560028 * n)
    tdb_minus_tt = 0.001658 * F.sin(g) + 0.000014 * F.sin(2 * g)
    a, d, sa, sd = F.radians(as_col(ra)), F.radians(as_col(dec)), F.radians(sun_ra), F.radians(sun_dec)
    along = F.sin(d) * F.sin(sd) + F.cos(d) * F.cos(sd) * F.cos(a - sa)
    return tai_minus_utc(jd) + TT_MINUS_TAI_SECONDS + tdb_minus_tt - AU_LIGHT_SECONDS * dist * along


def barycentric_tdb_approx(jd: Column | str, ra: Column | str, dec: Column | str) -> Column:
    """Julian date (TDB) with the light travel time removed, low precision."""
    return as_col(jd) + tdb_offset_seconds(jd, ra, dec) / SECONDS_PER_DAY
