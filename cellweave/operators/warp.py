"""Warps between lattices of one reference system, across tile edges, and joins of roles whose cells differ in size.

warp() is a stencil by halo exchange: the target lattice is cut into tiles, each
source cell goes once to each tile whose stencils reach it (nearly always one),
and a tile is then two matrix products over its window: values and weights.

to_lattice() goes by integers alone. Two lattices whose cell sizes stand as a
to b share a refinement in which a role's cell is a units wide and the target's
b units; what covers what is counted in units, so no coordinates are compared.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import ceil, floor

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _bilinear(t: np.ndarray) -> np.ndarray:
    return np.maximum(0, 1 - np.abs(t))


def _cubic(t: np.ndarray) -> np.ndarray:
    """The cubic of parameter -1/2: it passes through the cells and keeps straight lines straight."""
    t = np.abs(t)
    return np.where(t < 1, (1.5 * t - 2.5) * t * t + 1, np.where(t < 2, ((-0.5 * t + 2.5) * t - 4) * t + 2, 0))


#: A kernel of the distance between centres, in source cells, and how far it reaches.
KERNELS = {"bilinear": (_bilinear, 1), "cubic": (_cubic, 2)}
#: A target cell whose weights sum to less has no value.
LEAST_WEIGHT = 1e-6


def _weights(first: int, n: int, low: int, width: int, scale: float, offset: float, kernel: str) -> np.ndarray:
    """Of targets first to first + n by source cells low to low + width; a target wider than a source cell widens the kernel."""
    shape, _ = KERNELS[kernel]
    at = (first + np.arange(n) + 0.5) * scale + offset
    return shape((at[:, None] - (low + np.arange(width) + 0.5)[None, :]) / max(1.0, scale))


def warp(source: DataFrame, value: str, shape: tuple[int, int], scale: tuple[float, float], offset: tuple[float, float] = (0.0, 0.0), kernel: str = "cubic", tile: int = 256, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, row, col, value double) of the target cells that have a value.

    source: (keys, row, col, value). The centre of target cell (r, c) lies at ((r + 1/2) scale + offset) in source cells, an axis
    each. Missing and not finite source cells drop out and the others share their weight. The result doesn't depend on the tile.
    """
    if kernel not in KERNELS:
        raise ValueError(f"kernel must be one of {', '.join(KERNELS)}, not {kernel}")
    if min(scale) <= 0 or tile < 1:
        raise ValueError("scale and tile must be above 0")
    reach = [KERNELS[kernel][1] * max(1.0, s) for s in scale]

    def tiles(axis: str, k: int) -> Column:
        """The tiles with a target whose centre is nearer than reach to the source cell's centre."""
        low = F.ceil((F.col(axis) + 0.5 - reach[k] - offset[k]) / scale[k] - 0.5)
        high = F.floor((F.col(axis) + 0.5 + reach[k] - offset[k]) / scale[k] - 0.5)
        low, high = F.greatest(low, F.lit(0)), F.least(high, F.lit(shape[k] - 1))
        return F.when(low <= high, F.sequence(F.floor(low / tile), F.floor(high / tile))).otherwise(F.array().cast("array<bigint>"))

    v = F.col(f"`{value}`").cast("double")
    cells = source.where(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    sent = cells.select(*keys, "row", "col", v.alias("__v"), F.explode(tiles("row", 0)).alias("__ty")).withColumn("__tx", F.explode(tiles("col", 1)))

    def stencil(part: pa.Table) -> pa.Table:
        rows, cols = (part[c].to_numpy().astype(np.int64) for c in ("row", "col"))
        first = [part[c][0].as_py() * tile for c in ("__ty", "__tx")]
        n = [min(tile, shape[k] - first[k]) for k in range(2)]
        low = [floor((first[k] + 0.5) * scale[k] + offset[k] - reach[k]) for k in range(2)]
        width = [ceil((n[k] - 1) * scale[k] + 2 * reach[k]) + 2 for k in range(2)]
        y, x = rows - low[0], cols - low[1]
        inside = (y >= 0) & (y < width[0]) & (x >= 0) & (x < width[1])
        held, there = np.zeros(width), np.zeros(width)
        held[y[inside], x[inside]] = part["__v"].to_numpy()[inside]
        there[y[inside], x[inside]] = 1
        wy, wx = (_weights(first[k], n[k], low[k], width[k], scale[k], offset[k], kernel) for k in range(2))
        total, weight = wy @ held @ wx.T, wy @ there @ wx.T
        r, c = np.nonzero(weight > LEAST_WEIGHT)
        same = [pa.chunked_array([part[k].slice(0, 1).combine_chunks().take(pa.array(np.zeros(len(r), np.int64)))]) for k in keys]
        return pa.Table.from_arrays([*same, pa.array(r + first[0]), pa.array(c + first[1]), pa.array(total[r, c] / weight[r, c])], names=[*keys, "row", "col", value])

    kinds = dict(source.dtypes)
    named = "".join(f"`{k}` {kinds[k]}, " for k in keys)
    return sent.groupBy(*keys, "__ty", "__tx").applyInArrow(stencil, f"{named}row bigint, col bigint, `{value}` double")


def _covered(axis: str, a: int, b: int) -> Column:
    """The target cells (at, units) that a role's cell covers along an axis."""
    low, high = F.col(axis) * a, (F.col(axis) + 1) * a
    at = F.sequence(F.floor(low / b), F.floor((high - 1) / b))
    return F.transform(at, lambda k: F.struct(k.cast("bigint").alias("at"), (F.least(high, (k + 1) * b) - F.greatest(low, k * b)).cast("bigint").alias("units")))


def to_lattice(role: DataFrame, a: int, b: int, means: Sequence[str] = (), kinds: Sequence[str] = (), keys: Sequence[str] = ("granule",), valid: str = "valid", tasks: int | None = None) -> DataFrame:
    """(keys, row, col, bands, units, valid) of the cells of a lattice of which b units make a cell, from a role of which a units do.

    Means are weighted by the units that each valid cell covers; kinds are the class that covers most units, the least of equals.
    A target cell is valid if valid cells cover all its b x b units: one hole invalidates it. tasks: how many share the cells, by
    place; Spark's own number if not given. The bands come from one pass, so nothing is joined, and nothing sent to all tasks by a
    guess of its size from before cells were multiplied.
    """
    if a < 1 or b < 1:
        raise ValueError("cells are a positive number of units wide")
    at = [*keys, "row", "col"]
    sure = F.coalesce(F.col(valid), F.lit(False))
    for c in means:
        sure = sure & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    for c in kinds:
        sure = sure & F.col(c).isNotNull()
    deal = (tasks,) if tasks else ()
    own = role.where(sure).select(*at, *means, *kinds).repartition(*deal, *at)
    own = own.select(*keys, *means, *kinds, F.explode(_covered("row", a, b)).alias("__y"), F.col("col"))
    own = own.select(*keys, *means, *kinds, "__y", F.explode(_covered("col", a, b)).alias("__x"))
    own = own.select(*keys, *means, *kinds, F.col("__y.at").alias("row"), F.col("__x.at").alias("col"), (F.col("__y.units") * F.col("__x.units")).alias("__u"))
    own = own.repartition(*deal, *at)
    sums = [F.sum(F.col(c).cast("double") * F.col("__u")).alias(f"__s{k}") for k, c in enumerate(means)]
    own = own.groupBy(*at, *kinds).agg(F.sum("__u").alias("__u"), *sums)
    for k, c in enumerate(kinds):
        own = own.withColumn(f"__n{k}", F.col("__u") if len(kinds) == 1 else F.sum("__u").over(Window.partitionBy(*at, c)))
    found = [(F.sum(f"__s{k}") / F.sum("__u")).alias(c) for k, c in enumerate(means)]
    found += [F.max_by(F.col(c), F.struct(f"__n{k}", (-F.col(c)).alias("k"))).alias(c) for k, c in enumerate(kinds)]
    return own.groupBy(*at).agg(F.sum("__u").alias("units"), *found).withColumn("valid", F.col("units") == b * b)


def join_roles(cells: DataFrame, roles: Mapping[str, DataFrame], keys: Sequence[str] = ("granule",), tasks: int | None = None) -> DataFrame:
    """cells (keys, row, col, valid) with the bands of each role, named role_band, and valid only where all roles are. roles: of to_lattice().

    All sides are dealt by place to as many tasks and merged in order: no side is sent whole to all tasks.
    """
    at = [*keys, "row", "col"]
    deal = (tasks,) if tasks else ()
    out, sure = cells.repartition(*deal, *at), F.coalesce(F.col("valid"), F.lit(False))
    for name, role in roles.items():
        bands = [c for c in role.columns if c not in (*at, "units", "valid")]
        if taken := [c for c in (f"{name}_{b}" for b in bands) if c in out.columns]:
            raise ValueError(f"there is a column {taken[0]} already")
        role = role.select(*at, *[F.col(b).alias(f"{name}_{b}") for b in bands], F.col("valid").alias(f"__{name}")).repartition(*deal, *at)
        out = out.join(role.hint("merge"), at, "left")
        sure = sure & F.coalesce(F.col(f"__{name}"), F.lit(False))
    return out.withColumn("valid", sure).drop(*[f"__{name}" for name in roles])
