"""The lattice: which granules meet which tiles, and which pixel is nearest a cell."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.functions.columns import boxes_overlap, boxes_touch

BOX = ("west", "south", "east", "north")


def _bins(lo: Column, hi: Column, size: float) -> Column:
    return F.explode(F.sequence(F.floor(lo / size).cast("bigint"), F.floor(hi / size).cast("bigint")))


def box_join(left: DataFrame, right: DataFrame, size: float, touching: bool = True) -> DataFrame:
    """Rows of left (box) and right (box, named r_west ...) whose boxes meet.

    Both sides are put into square bins of the given size and joined on the bin; a pair that shares several bins is kept in the
    one that holds the lower left corner of what they share, so nothing has to be made distinct. The bin should be about as large
    as the larger kind of box: then a box falls into four bins at most.
    """
    a = left.withColumn("__x", _bins(F.col("west"), F.col("east"), size)).withColumn("__y", _bins(F.col("south"), F.col("north"), size))
    b = right.withColumn("__bx", _bins(F.col("r_west"), F.col("r_east"), size)).withColumn("__by", _bins(F.col("r_south"), F.col("r_north"), size))
    l_box, r_box = [F.col(c) for c in BOX], [F.col(f"r_{c}") for c in BOX]
    meet = boxes_touch(l_box, r_box) if touching else boxes_overlap(l_box, r_box)
    corner = (F.floor(F.greatest("west", "r_west") / size) == F.col("__x")) & (F.floor(F.greatest("south", "r_south") / size) == F.col("__y"))
    return a.join(b, (F.col("__x") == F.col("__bx")) & (F.col("__y") == F.col("__by")) & meet & corner).drop("__x", "__y", "__bx", "__by")


def box_join_plain(left: DataFrame, right: DataFrame, touching: bool = True) -> DataFrame:
    """The same without bins, for a right side of a few rows."""
    l_box, r_box = [F.col(c) for c in BOX], [F.col(f"r_{c}") for c in BOX]
    return left.join(right, boxes_touch(l_box, r_box) if touching else boxes_overlap(l_box, r_box))


def box_semi_join(left: DataFrame, right: DataFrame, size: float, key: Sequence[str], touching: bool = False) -> DataFrame:
    """Rows of left whose box meets any box of right."""
    met = box_join(left, right, size, touching).select(*key).distinct()
    return left.join(met, list(key), "left_semi")


def nearest_pixels(cells: DataFrame, pixels: DataFrame, size: float, max_distance: float, max_rings: int = 64) -> DataFrame:
    """(granule, row, col, s_row, s_col, d2, far): the nearest pixel of each cell centre inside its granule's pixel box.

    cells: (granule, row, col, x, y); pixels: (granule, s_row, s_col, px, py). Of equals the first (s_row, s_col).
    Pixels are put into bins of the given size. A ring of r bins around a cell's bin settles cells whose best pixel is no
    further than r * size; the others are taken through twice as many rings, until none is left: beyond max_distance a cell keeps
    its nearest pixel, marked far. Each round joins on the bin, so no cell meets all pixels.
    """
    inside = pixels.groupBy("granule").agg(F.min("px").alias("x0"), F.max("px").alias("x1"), F.min("py").alias("y0"), F.max("py").alias("y1"))
    todo = cells.join(inside, "granule").where(F.col("x").between(F.col("x0"), F.col("x1")) & F.col("y").between(F.col("y0"), F.col("y1")))
    binned = pixels.withColumn("bx", F.floor(F.col("px") / size)).withColumn("by", F.floor(F.col("py") / size))
    done, rings = None, 1
    while True:
        around = todo.withColumn("cx", F.floor(F.col("x") / size)).withColumn("cy", F.floor(F.col("y") / size))
        for axis, at, lo, hi in (("bx", "cx", "x0", "x1"), ("by", "cy", "y0", "y1")):  # no bins beyond the pixels' box
            first, last = F.greatest(F.col(at) - rings, F.floor(F.col(lo) / size)), F.least(F.col(at) + rings, F.floor(F.col(hi) / size))
            around = around.withColumn(axis, F.explode(F.sequence(first, last)))
        met = around.join(binned, ["granule", "bx", "by"])
        d2 = (F.col("x") - F.col("px")) ** 2 + (F.col("y") - F.col("py")) ** 2
        best = met.groupBy("granule", "row", "col", "x", "y").agg(F.min(F.struct(d2.alias("d2"), "s_row", "s_col")).alias("b"))
        best = best.persist()  # the next round and the result both read it; lost parts are made anew
        settled = best.where(F.col("b.d2") <= (rings * size) ** 2).select("granule", "row", "col", "b.s_row", "b.s_col", "b.d2")
        done = settled if done is None else done.unionByName(settled)
        todo = todo.join(settled.select("granule", "row", "col"), ["granule", "row", "col"], "left_anti")
        rings *= 2
        if todo.isEmpty():
            break
        if rings > max_rings:
            raise ValueError("bins are too small for these pixels")
    return done.withColumn("far", F.col("d2") > max_distance * max_distance)


def clean_contiguous(hits: DataFrame, keys: Sequence[str] = ("granule",), at_least: int = 3) -> DataFrame:
    """Hits without the cells whose 3 by 3 neighbourhood holds at_least far cells, itself included."""
    near = hits.where("far").select(*keys, F.explode(F.sequence(F.col("row") - 1, F.col("row") + 1)).alias("row"), "col")
    near = near.select(*keys, "row", F.explode(F.sequence(F.col("col") - 1, F.col("col") + 1)).alias("col"))
    bad = near.groupBy(*keys, "row", "col").agg(F.count("*").alias("n")).where(F.col("n") >= at_least)
    return hits.join(bad, [*keys, "row", "col"], "left_anti")


def adopt(lookup: DataFrame, d_row: int, d_col: int, rows: int, cols: int) -> DataFrame:
    """A product's own lookup, moved onto the lattice by whole cells; hits need both indices, cells outside the tile go."""
    hits = lookup.where((F.col("s_row") != 0) & (F.col("s_col") != 0))
    moved = hits.withColumn("row", F.col("row") + d_row).withColumn("col", F.col("col") + d_col)
    return moved.where(F.col("row").between(0, rows - 1) & F.col("col").between(0, cols - 1))


def whole_offset(own: float, other: float, step: float) -> int:
    """Cells between two origins; an error unless they are whole, to a millionth of a cell."""
    k = (other - own) / step
    if abs(k - round(k)) > 1e-6:
        raise ValueError("the lattices aren't a whole number of cells apart")
    return round(k)


def halo(cells: DataFrame, tile: int, pad: int) -> DataFrame:
    """Cells with (tx, ty) of each tile that needs them: their own, and neighbours within pad cells."""
    def tiles(c: str) -> Column:
        return F.sequence(F.floor((F.col(c) - pad) / tile), F.floor((F.col(c) + pad) / tile))

    return cells.withColumn("tx", F.explode(tiles("col"))).withColumn("ty", F.explode(tiles("row")))
