"""Point-spread-function expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..session import as_col

# Fixed value
FWHM_PER_SIGMA = 2.0 * math.sqrt(2.0 * math.log(2.0))


def _quadratic(theta: Column, sx: Column, sy: Column) -> tuple[Column, Column, Column]:
    p, q = 1 / (2 * sx * sx), 1 / (2 * sy * sy)
    c2, s2 = F.pow(F.cos(theta), F.lit(2.0)), F.pow(F.sin(theta), F.lit(2.0))
    return c2 * p + s2 * q, F.sin(2 * theta) * (q - p) / 2, s2 * p + c2 * q


def gaussian_2d(amplitude, theta, sx, sy, x0, y0, x, y) -> Column:
    """Value of a rotated elliptical Gaussian."""
    a, b, c = _quadratic(as_col(theta), as_col(sx), as_col(sy))
    dx, dy = as_col(x0) - as_col(x), as_col(y0) - as_col(y)
    return as_col(amplitude) * F.exp(-(a * dx * dx + 2 * b * dx * dy + c * dy * dy))


def fwhm(sigma) -> Column:
    """Full width at half maximum of a Gaussian."""
    return FWHM_PER_SIGMA * as_col(sigma)


def moments_to_axes(mxx, myy, mxy) -> tuple[Column, Column, Column]:
    """Long FWHM, short FWHM and angle (degrees) of second moments."""
    mxx, myy, mxy = map(as_col, (mxx, myy, mxy))
    mean = (mxx + myy) / 2
    spread = F.sqrt(F.pow((mxx - myy) / 2, F.lit(2.0)) + mxy * mxy)
    angle = F.degrees(F.atan2(2 * mxy, mxx - myy)) / 2
    return fwhm(F.sqrt(mean + spread)), fwhm(F.sqrt(F.greatest(F.lit(0.0), mean - spread))), angle
