"""Scalar column builders."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NODATA_CLASS = 65535
# FIXED: the palette of classes without a colour of their own.
GOLDEN, PALETTE_SATURATION, PALETTE_VALUE = 0.618033988749895, 0.65, 0.90


def nan_to_null(c: Column) -> Column:
    """NaN sorts above everything in Spark, so it becomes NULL at the door."""
    return F.when(~F.isnan(c), c)


def clip(c: Column, lo: float, hi: float) -> Column:
    return F.least(F.greatest(c, F.lit(lo)), F.lit(hi))


def mean_of_present(*cols: Column) -> Column:
    """The mean of those that aren't NULL."""
    n = sum((F.when(c.isNotNull(), 1).otherwise(0) for c in cols), F.lit(0))
    total = sum((F.coalesce(c, F.lit(0.0)) for c in cols), F.lit(0.0))
    return F.when(n > 0, total / n)


def airmass(solar_zenith: Column, view_zenith: Column) -> Column:
    """1/cos + 1/cos of the two angles in degrees; NULL near the horizon."""
    sun, view = F.cos(F.radians(solar_zenith)), F.cos(F.radians(view_zenith))
    return F.when((sun > 1e-3) & (view > 1e-3), 1 / sun + 1 / view)


def bands_subset(values: Column, bands: Sequence[int]) -> Column:
    """The named 0-based bands of an array column."""
    return F.transform(F.array(*map(F.lit, bands)), lambda b: F.element_at(values, b + 1))


def boxes_touch(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Closed overlap of (west, south, east, north): shared edges count."""
    return (a[0] <= b[2]) & (a[2] >= b[0]) & (a[1] <= b[3]) & (a[3] >= b[1])


def boxes_overlap(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Open overlap: shared edges don't count."""
    return (a[0] < b[2]) & (a[2] > b[0]) & (a[1] < b[3]) & (a[3] > b[1])


def first_cell(lo: Column, origin: float, step: float) -> Column:
    """The first lattice cell whose centre isn't before lo."""
    return F.ceil((lo - origin) / step - 0.5 - 1e-9)


def piecewise(c: Column, stops: Sequence[tuple[float, float]]) -> Column:
    """Linear between stops (at, value), flat outside; NULL stays NULL."""
    out = F.when(c.isNull(), None).when(c <= stops[0][0], F.lit(float(stops[0][1])))
    for (x0, y0), (x1, y1) in zip(stops, stops[1:], strict=False):
        out = out.when(c <= x1, y0 + (c - x0) / (x1 - x0) * (y1 - y0))
    return out.otherwise(F.lit(float(stops[-1][1])))


def id_color(class_id: Column) -> Column:
    """[r, g, b] of a class id alone: hues a golden part of the wheel apart, at fixed saturation and value."""
    hue = F.pmod(class_id * GOLDEN, F.lit(1.0)) * 6
    v, s = PALETTE_VALUE, PALETTE_SATURATION

    def channel(n: int) -> Column:
        k = F.pmod(hue + n, F.lit(6.0))
        return F.rint(255 * (v - v * s * F.greatest(F.lit(0.0), F.least(k, 4 - k, F.lit(1.0))))).cast("int")

    return F.array(channel(5), channel(3), channel(1))


def mercator_tile(z: Column, x: Column, y: Column) -> dict[str, Column]:
    """Longitude and latitude bounds of a spherical web mercator tile."""
    n = F.pow(F.lit(2.0), z)

    def lat(t: Column) -> Column:
        return F.degrees(F.atan(F.sinh(math.pi * (1 - 2 * t / n))))

    return {"west": x / n * 360 - 180, "south": lat(y + 1), "east": (x + 1) / n * 360 - 180, "north": lat(y)}
