"""Work lists: which granule brings how much to which tile, what a run will cost, and tasks of about equal cost.

Defined results
  null in a box or weight  no work
  box without area         all of its weight in each tile that it meets
  repeated granules        each is work of its own
  empty index              no rows; an estimate of zeros
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Tiles of a side of a region: light tiles are grouped within one, so that no window holds more than its square.
REGION = 16


def work_list(granules: DataFrame, tile_size: float, origin: tuple[float, float] = (-180.0, -90.0), weight=1_000_000) -> DataFrame:
    """granules (west, south, east, north, ...) once a tile that they overlap, with tx, ty and cost: their weight by the share of their box.

    The tiles of a box follow from its corners, so nothing is joined or shuffled.
    """
    w = weight if hasattr(weight, "cast") else F.lit(weight)
    x0, y0 = (F.lit(float(o)) for o in origin)

    def bins(lo, hi, o):
        first, last = F.floor((F.col(lo) - o) / tile_size), F.ceil((F.col(hi) - o) / tile_size) - 1
        return F.explode(F.sequence(first.cast("bigint"), F.greatest(first, last).cast("bigint")))

    whole = granules.where((F.col("west") <= F.col("east")) & (F.col("south") <= F.col("north")) & w.isNotNull())
    at = whole.withColumn("tx", bins("west", "east", x0)).withColumn("ty", bins("south", "north", y0))

    def shared(lo, hi, k, o):
        return F.least(F.col(hi), (F.col(k) + 1) * tile_size + o) - F.greatest(F.col(lo), F.col(k) * tile_size + o)

    area = (F.col("east") - F.col("west")) * (F.col("north") - F.col("south"))
    share = F.when(area > 0, shared("west", "east", "tx", x0) * shared("south", "north", "ty", y0) / area).otherwise(1.0)
    return at.withColumn("cost", F.round(share * w).cast("bigint"))


def tile_costs(work: DataFrame) -> DataFrame:
    """(tx, ty, granules, cost, longest): combined in the tasks before the shuffle, so a hot tile is one row a task."""
    return work.groupBy("tx", "ty").agg(F.count("*").alias("granules"), F.sum("cost").alias("cost"), F.max("cost").alias("longest"))


def estimate(costs: DataFrame, cells: int, bytes_a_cell: int) -> DataFrame:
    """One row of tile_costs: tiles, items, their cost, the heaviest tile, the longest item, and bytes of the highest stack of a tile's granules."""
    zero = lambda c: F.coalesce(c, F.lit(0))
    peak = (zero(F.max("granules")) * cells * bytes_a_cell).alias("peak_bytes")
    return costs.agg(F.count("*").alias("tiles"), *[zero(f).cast("bigint").alias(n) for f, n in ((F.sum("granules"), "items"), (F.sum("cost"), "cost"), (F.max("cost"), "heaviest"), (F.max("longest"), "longest"))], peak)


def lay_out(costs: DataFrame, most: int) -> DataFrame:
    """tile_costs with parts, region and bundle: tiles above most are split into parts, others of a region bundled in order.

    A bundle begins in each multiple of most that the running cost of its region reaches, so it costs less than twice most.
    """
    parts = F.greatest(F.ceil(F.col("cost") / most), F.lit(1)).cast("bigint")
    region = F.struct(F.floor(F.col("tx") / REGION).alias("x"), F.floor(F.col("ty") / REGION).alias("y"))
    light = F.when(F.col("cost") <= most, F.col("cost")).otherwise(0)
    order = Window.partitionBy("region").orderBy("ty", "tx").rowsBetween(Window.unboundedPreceding, -1)
    placed = costs.withColumn("parts", parts).withColumn("region", region)
    bundle = F.when(F.col("cost") <= most, F.floor(F.coalesce(F.sum(light).over(order), F.lit(0)) / most))
    return placed.withColumn("bundle", bundle)


def deal(work: DataFrame, laid: DataFrame, granule: str) -> DataFrame:
    """work with the task (a hash) of each item: that of its tile's bundle, or of one part of a tile that was split.

    Repartition by task and each task has about the same cost; parts of a tile are merged by its reducer, as partial results always are.
    """
    part = F.pmod(F.xxhash64(F.col(granule)), F.col("parts"))
    task = F.when(F.col("bundle").isNotNull(), F.xxhash64(F.lit("bundle"), "region", "bundle")).otherwise(F.xxhash64(F.lit("part"), "tx", "ty", part))
    return work.join(laid.select("tx", "ty", "parts", "region", "bundle"), ["tx", "ty"]).withColumn("task", task).drop("parts", "region", "bundle")
