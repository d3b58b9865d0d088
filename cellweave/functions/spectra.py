"""Spectra: continuum removal and band depth as column functions; matched filters stand in operators/moments.py."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def band_mean(values: Column, bands: Sequence[int]) -> Column:
    picked = F.transform(F.array(*map(F.lit, bands)), lambda b: F.element_at(values, b + 1).cast("double"))
    return F.aggregate(picked, F.lit(0.0), lambda a, x: a + x) / len(bands)


def continuum(values: Column, wavelengths: Sequence[float], left: Sequence[int], right: Sequence[int], bands: Sequence[int]) -> Column:
    """The line between the means of two shoulders, at the named bands."""
    x0, x1 = float(np.mean([wavelengths[b] for b in left])), float(np.mean([wavelengths[b] for b in right]))
    y0, y1 = band_mean(values, left), band_mean(values, right)
    return F.transform(F.array(*[F.lit(float(wavelengths[b])) for b in bands]), lambda w: y0 + (y1 - y0) * (w - x0) / (x1 - x0))


def continuum_removed(values: Column, wavelengths: Sequence[float], left: Sequence[int], right: Sequence[int], bands: Sequence[int]) -> Column:
    """The named bands divided by the continuum; NULL where that isn't above 0."""
    own = F.transform(F.array(*map(F.lit, bands)), lambda b: F.element_at(values, b + 1).cast("double"))
    return F.zip_with(own, continuum(values, wavelengths, left, right, bands), lambda v, c: F.when(c > 0, v / c))


def band_depth(values: Column, wavelengths: Sequence[float], left: Sequence[int], right: Sequence[int], centre: Sequence[int]) -> Column:
    """1 less the mean of the centre after continuum removal; NULL if the continuum isn't above 0 there."""
    removed = continuum_removed(values, wavelengths, left, right, centre)
    mean = F.aggregate(removed, F.lit(0.0), lambda a, x: a + x) / len(centre)
    return 1 - mean
