"""Scorers: one column that ranks a look; NULL takes a look out of the race."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellweave.functions.columns import clip


def nearest_nadir(view_zenith: Column) -> Column:
    return -view_zenith


def clean_nadir(view_zenith: Column, slope: Column, snow: Column, limit: float = 30.0, penalty: float = 1.0) -> Column:
    """Nearest nadir, less a penalty on steep slopes; nothing on snow."""
    return F.when(~F.coalesce(snow, F.lit(False)), -view_zenith / 90 - F.when(slope > limit, penalty).otherwise(0.0))


def strongest_band(depth: Column) -> Column:
    return depth


def _floored(score: Column, share: Column, floor: float, below: float | None) -> Column:
    return F.when(share >= floor, score) if below is None else F.when(share >= floor, score).otherwise(score * below)


def bare_earth(soil: Column, solar_zenith: Column, sun_weight: float = 0.25, floor: float = 0.3, max_solar: float = 70.0, below: float | None = None) -> Column:
    """Share of bare soil and height of the sun."""
    share = clip(soil, 0.0, 1.0)
    score = share + sun_weight * F.cos(F.radians(solar_zenith))
    return F.when(solar_zenith <= max_solar, _floored(score, share, floor, below))


def bare_earth_nadir(soil: Column, solar_zenith: Column, view_zenith: Column, sun_weight: float = 0.2, nadir_weight: float = 0.3, floor: float = 0.3, max_solar: float = 70.0, max_view: float = 30.0, below: float | None = None) -> Column:
    """Bare earth and nearness to nadir; weights sum to 1 at most."""
    if sun_weight + nadir_weight > 1:
        raise ValueError("sun and nadir weights sum to more than 1")
    share = clip(soil, 0.0, 1.0)
    score = share + sun_weight * F.cos(F.radians(solar_zenith)) + nadir_weight * (1 - F.least(F.abs(view_zenith) / 15, F.lit(1.0)))
    return F.when((solar_zenith <= max_solar) & (F.abs(view_zenith) <= max_view), _floored(score, share, floor, below))


def low_vegetation_nadir(green: Column, solar_zenith: Column, view_zenith: Column, sun_weight: float = 0.2, nadir_weight: float = 0.3, max_green: float = 0.6, max_solar: float = 70.0, max_view: float = 30.0, below: float | None = None) -> Column:
    """The same with 1 less the share of green vegetation for soil."""
    return bare_earth_nadir(1 - clip(green, 0.0, 1.0), solar_zenith, view_zenith, sun_weight, nadir_weight, 1 - max_green, max_solar, max_view, below)
