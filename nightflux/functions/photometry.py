"""Fluxes, magnitudes, apertures and the noise model."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..session import as_col

# Fixed values
ZERO_POINT_MAG = 24.16
APERTURE_FACTORS = [0.5, 1 / math.sqrt(2), 1.0, math.sqrt(2), 2.0, 2 * math.sqrt(2), 4.0, 5.0, 6.0, 7.0, 8.0, 10.0, 12.0]
SKY_MAG_ZERO, SKY_MAG_SLOPE = 21.5, 2.512
PIXEL_SCALE_ARCSEC = 0.35
FLUX_FLOOR = 0.1
MEDIAN_FLOOR = 0.001
DARK_ELECTRONS_PER_SECOND = 0.02
READ_OVERHEAD_SECONDS = 10.5
SCINTILLATION_FACTOR = 1.27
SCALE_HEIGHT_M = 8000.0
MEDIAN_ERROR_FACTOR = 1.253


def positive_flux(flux: Column | str) -> Column:
    """Flux, or NULL where it is at or below the floor."""
    return F.when(as_col(flux) > FLUX_FLOOR, as_col(flux))


def aperture_radius(ap: Column | str, rcore: Column | str) -> Column:
    """Radius in pixels of aperture 1..13; NULL outside."""
    factors = F.array(*[F.lit(float(m)) for m in APERTURE_FACTORS])
    return F.try_element_at(factors, as_col(ap).cast("int")) * as_col(rcore)


def instrumental_magnitude(median_flux: Column | str, gain: Column | str, exposure: Column | str) -> Column:
    """24.16 - 2.5 log10(flux * gain / exposure)."""
    return ZERO_POINT_MAG - 2.5 * F.log10(as_col(median_flux) * as_col(gain) / as_col(exposure))


def catalogue_magnitude(flux: Column | str) -> Column:
    """21.5 - 2.512 log10(flux)."""
    return SKY_MAG_ZERO - SKY_MAG_SLOPE * F.log10(as_col(flux))


def scintillation(airmass: Column, exposure: Column, height: Column, diameter_cm: float = 100.0) -> Column:
    """Relative scintillation noise of one exposure."""
    k = SCINTILLATION_FACTOR * math.sqrt(1e-5) * (diameter_cm / 100.0) ** (-2.0 / 3.0)
    return k * F.pow(airmass, F.lit(1.75)) * F.exp(-height / SCALE_HEIGHT_M) / F.sqrt(exposure)


def noise_model(mag, exposure, airmass, sky, gain, ron, radius, height, diameter_cm: float = 100.0) -> Column:
    """Expected relative noise of one measurement.

    Photon noise of source and sky, readout, dark current and scintillation, added
    in quadrature and divided by the expected signal.
    """
    mag, exposure, airmass, sky, gain, ron, radius, height = map(
        as_col, (mag, exposure, airmass, sky, gain, ron, radius, height)
    )
    signal = F.pow(F.lit(10.0), (ZERO_POINT_MAG - mag) / 2.5) * exposure
    npix = math.pi * radius * radius
    per_pixel = ron * ron + sky * gain + DARK_ELECTRONS_PER_SECOND * exposure
    twinkle = scintillation(airmass, exposure, height, diameter_cm) * signal
    return F.sqrt(signal + npix * per_pixel + twinkle * twinkle) / signal


def binned_noise(noise: Column | str, exposure: Column | str, minutes: float) -> Column:
    """Noise of the mean over a bin of ``minutes``, read overhead included."""
    return as_col(noise) / F.sqrt(F.lit(minutes * 60.0) / (as_col(exposure) + READ_OVERHEAD_SECONDS))


def differential_error(nlc: Column | str, sigma_target: Column | str, sigma_comparison: Column | str) -> Column:
    """Error of a differential flux."""
    s, c = as_col(sigma_target), as_col(sigma_comparison)
    return as_col(nlc) * F.sqrt(s * s + c * c)


def ellipticity(a: Column | str, b: Column | str) -> Column:
    """sqrt(1 - (b/a)^2); 0 where undefined."""
    a, b = as_col(a), as_col(b)
    ok = (a != 0) & (F.abs(b) <= F.abs(a))
    return F.when(ok, F.sqrt(1 - F.pow(b / a, F.lit(2.0)))).otherwise(F.lit(0.0))


def ellipticity_or_null(a: Column | str, b: Column | str) -> Column:
    """The report's variant: NULL where undefined."""
    a, b = as_col(a), as_col(b)
    return F.when((a != 0) & (F.abs(b) <= F.abs(a)), F.sqrt(1 - F.pow(b / a, F.lit(2.0))))


def linear_model(a0: Column | str, a1: Column | str, model: Column | str) -> Column:
    """1 + a0 + a1 (model - 1)."""
    return 1 + as_col(a0) + as_col(a1) * (as_col(model) - 1)


def seeing_arcsec(fwhm_pixels: Column | str) -> Column:
    """Seeing in arc seconds, two decimals."""
    return F.round(PIXEL_SCALE_ARCSEC * as_col(fwhm_pixels), 2)
