"""Quantile sketches by tile: what a stretch over any set of tiles needs, without their cells.

A sketch (KLL) of K has a rank error of some 2.45 / K^0.94 with 99 % certainty, for one quantile and however many are merged:
0.05 % for the default. Up to K values or so a sketch holds them all.

Defined results
  missing value    isn't counted; a tile of missing values only has an empty sketch
  no value at all  0 to 1
  equal values     one wide
  empty table      no sketches; over no keys one stretch, 0 to 1
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.functions.columns import nan_to_null

#: Its size in memory is some 3 x 8 bytes each at most.
SKETCH_K = 8192


def tile_sketches(cells: DataFrame, value: str, keys: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    """(keys, sketch, n): made in the tasks and merged, so a hot tile is one sketch a task. Write it as a table beside the tiles."""
    x = nan_to_null(F.col(value).cast("double"))
    return cells.select(*keys, x.alias("__x")).groupBy(*keys).agg(F.kll_sketch_agg_double("__x", k).alias("sketch"), F.count("__x").alias("n"))


def merged(sketches: DataFrame, keys: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """(keys, sketch, n) of all tiles of each key."""
    held = sketches.where("n > 0")
    return held.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", k).alias("sketch"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def sketched_stretch(sketches: DataFrame, low: float = 0.02, high: float = 0.98, keys: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """(keys, n, lo, hi) to show values between: values whose ranks are those shares within the sketch's error. One row a key, or one in all."""
    of = lambda share, other: F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(share))).otherwise(other)
    ends = merged(sketches, keys, k).select(*keys, "n", of(low, 0.0).alias("lo"), of(high, 1.0).alias("hi"))
    return ends.withColumn("hi", F.when(F.col("hi") > F.col("lo"), F.col("hi")).otherwise(F.col("lo") + 1))
