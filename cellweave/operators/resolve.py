"""Resolving looks: masks, gathering, and the look that wins a cell's epoch."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.functions.columns import nan_to_null

Mask = Callable[[DataFrame], Column]


def edge_trim(column: str, width: int, columns: int) -> Mask:
    """Detector columns less than `columns` from either edge are out; width is the detector's, not the data's."""
    if columns < 5:
        raise ValueError("trim 5 columns at least")
    return lambda df: F.col(column).between(columns, width - columns - 1)


def at_least(column: str, least: float) -> Mask:
    """NULL and NaN are out."""
    return lambda df: F.coalesce(nan_to_null(F.col(column).cast("double")) >= least, F.lit(False))


def flags_clear(flags: str, names: Sequence[str], wanted: Sequence[str], distance: str | None = None, buffer: int = 0) -> Mask:
    """None of the wanted flags, found by name in an array, is above 0; within buffer cells of a flagged one is out too (-1: far)."""
    missing = set(wanted) - set(names)
    if missing:
        raise ValueError(f"no such flags: {sorted(missing)}")
    at = [list(names).index(w) for w in wanted]

    def mask(df: DataFrame) -> Column:
        clear = F.forall(F.transform(F.array(*map(F.lit, at)), lambda k: F.element_at(F.col(flags), k + 1)), lambda x: ~F.coalesce(x > 0, F.lit(False)))
        return clear & ~F.col(distance).between(0, buffer) if distance else clear

    return mask


def not_landcover(column: str, codes: dict[str, int], excluded: Sequence[str], nodata: int = 0, keep_nodata: bool = True) -> Mask:
    """Classes are excluded by name."""
    out = [codes[x] for x in excluded]
    return lambda df: F.when(F.col(column).isNull() | (F.col(column) == nodata), F.lit(keep_nodata)).otherwise(~F.col(column).isin(*out))


def apply_masks(looks: DataFrame, masks: Sequence[Mask], valid: str = "valid") -> DataFrame:
    """valid is narrowed by every mask; masked rows stay, as observed."""
    ok = F.col(valid)
    for m in masks:
        ok = ok & F.coalesce(m(looks), F.lit(False))
    return looks.withColumn(valid, ok)


def gather(lookup: DataFrame, pixels: DataFrame, bands: Sequence[str], keys: Sequence[str] = ("granule", "s_row", "s_col")) -> DataFrame:
    """Lattice cells with the sensor pixels that the lookup names; a look with any missing band, or NaN in one (or in any element of one), isn't valid."""
    out = lookup.join(pixels, list(keys), "left")
    kinds, whole = dict(out.dtypes), F.lit(True)
    for b in bands:
        whole = whole & _whole(F.col(b), kinds[b])
    return out.withColumn("valid", whole)


def _whole(value: Column, kind: str) -> Column:
    if kind in ("array<float>", "array<double>"):
        return value.isNotNull() & ~F.coalesce(F.exists(value, lambda x: x.isNull() | F.isnan(x)), F.lit(False))
    return value.isNotNull() & ~F.isnan(value) if kind in ("float", "double") else value.isNotNull()


def invalidate_unmapped(looks: DataFrame, classes: Sequence[str], unmapped: int = -1, valid: str = "valid") -> DataFrame:
    """A look with a class that the class table doesn't have isn't valid: nothing says what was seen."""
    known = F.lit(True)
    for c in classes:
        known = known & F.coalesce(F.col(c) != unmapped, F.lit(True))
    return looks.withColumn(valid, F.col(valid) & known)


def _best(looks: DataFrame, order: Sequence[str], keep: Sequence[str], score: str, valid: str) -> tuple[Column, Column, Column]:
    """(may win, the row, its rank): the highest score, of equals the first by order."""
    ok = F.col(valid) & nan_to_null(F.col(score).cast("double")).isNotNull()
    kinds = dict(looks.dtypes)
    place = [(-F.unix_micros(F.col(c).cast("timestamp")) if kinds[c].startswith(("timestamp", "date")) else -F.col(c)).alias(f"__{k}") for k, c in enumerate(order)]
    return ok, F.struct(*order, score, *keep), F.struct(F.col(score).alias("__s"), *place)


def winners(looks: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Sequence[str], score: str = "score", valid: str = "valid") -> DataFrame:
    """(keys, order, score, keep) of the best look by score, the first in `order` of equals, as one aggregation.

    Partial maxima are combined before the shuffle, so a cell costs one row a task however many looks it has.
    """
    ok, row, rank = _best(looks, order, keep, score, valid)
    return looks.where(ok).groupBy(*keys).agg(F.max_by(row, rank).alias("__w")).select(*keys, "__w.*")


def winners_by_window(looks: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Sequence[str], score: str = "score", valid: str = "valid") -> DataFrame:
    """The same by ranking the whole stack of looks."""
    ok = _best(looks, order, keep, score, valid)[0]
    w = Window.partitionBy(*keys).orderBy(F.col(score).desc(), *[F.col(c).asc() for c in order])
    return looks.where(ok).withColumn("__place", F.row_number().over(w)).where("__place = 1").select(*keys, *order, score, *keep)


def snapshots(looks: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Sequence[str], score: str = "score", valid: str = "valid") -> DataFrame:
    """Winners, with a row for cells and epochs that were observed but have no valid look."""
    ok, row, rank = _best(looks, order, keep, score, valid)
    one = looks.groupBy(*keys).agg(F.max_by(row, F.when(ok, rank)).alias("__w"))
    return one.select(*keys, "__w.*", F.col("__w").isNotNull().alias("valid"), F.lit(True).alias("observed"))
