"""From raw pixels to reduced science pixels."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from ..operators import calibration as C
from ..session import cut


@dataclass
class Reduced:
    bias: DataFrame
    dark: DataFrame
    flat: DataFrame
    science: DataFrame
    ron: DataFrame
    dark_current: DataFrame


def calibrate(
    bias: DataFrame, dark: DataFrame, flat: DataFrame, science: DataFrame, keys: Sequence[str], region: Column, gain: float, inner: Column | None = None
) -> Reduced:
    """Masters from their frames, then science frames corrected and flat-fielded.

    Pixel tables have keys, frame, y, x, adu and exptime; ``region`` marks overscan
    pixels.  Every master is written once and joined by pixel.
    """
    keys = list(keys)
    b = cut(C.master_bias(bias, keys, region))
    d = cut(C.master_dark(dark, keys, region, b))

    def correct(pixels: DataFrame, rounds: int | None) -> DataFrame:
        levels = cut(C.overscan_levels(pixels, keys, region, rounds))
        return cut(C.corrected(pixels, keys, region, b, d, levels))

    flats = correct(flat, 5)
    f = cut(C.master_flat(flats, cut(C.flat_scales(flats, keys, inner)), keys))
    return Reduced(b, d, f, C.calibrate(correct(science, None), f, keys), C.readout_noise(bias, keys, gain), C.dark_current(d, keys, gain))
