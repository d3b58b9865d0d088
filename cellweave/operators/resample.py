"""Rasters as rows: resampling to a coarser or shifted lattice, and compositing sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def nearest(cells: DataFrame, source: DataFrame, scale: float, value: str) -> DataFrame:
    """Each cell (row, col) with the source cell under its centre; the source's cells are scale times as large."""
    at = source.select(F.col("row").alias("__r"), F.col("col").alias("__c"), value)
    under = (F.floor((F.col("row") + 0.5) / scale) == F.col("__r")) & (F.floor((F.col("col") + 0.5) / scale) == F.col("__c"))
    return cells.join(at, under, "left").drop("__r", "__c")


def average(source: DataFrame, factor: int, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Mean of factor by factor source cells; missing ones don't count."""
    return source.groupBy(*keys, F.floor(F.col("row") / factor).alias("row"), F.floor(F.col("col") / factor).alias("col")).agg(F.avg(value).alias(value))


def mode(source: DataFrame, factor: int, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Most frequent value of factor by factor source cells, the least of equals."""
    by = [*keys, "row", "col"]
    coarse = source.where(F.col(value).isNotNull()).select(*keys, F.floor(F.col("row") / factor).alias("row"), F.floor(F.col("col") / factor).alias("col"), value)
    n = coarse.groupBy(*by, value).agg(F.count("*").alias("__n"))
    return n.groupBy(*by).agg(F.max_by(F.col(value), F.struct("__n", (-F.col(value)).alias("v"))).alias(value))


def bilinear(cells: DataFrame, source: DataFrame, x: str, y: str, value: str) -> DataFrame:
    """Value at (x, y) in source cell units between the four centres around it; missing corners drop out and the others share their weight."""
    at = cells.withColumn("__x0", F.floor(F.col(x) - 0.5)).withColumn("__y0", F.floor(F.col(y) - 0.5))
    own = [c for c in cells.columns]
    corners = at.withColumn("__dx", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("__dy", F.explode(F.array(F.lit(0), F.lit(1))))
    fx, fy = F.col(x) - 0.5 - F.col("__x0"), F.col(y) - 0.5 - F.col("__y0")
    w = F.when(F.col("__dx") == 1, fx).otherwise(1 - fx) * F.when(F.col("__dy") == 1, fy).otherwise(1 - fy)
    src = source.select(F.col("row").alias("__r"), F.col("col").alias("__c"), F.col(value).alias("__v"))
    met = corners.withColumn("__w", w).join(src, (F.col("__y0") + F.col("__dy") == F.col("__r")) & (F.col("__x0") + F.col("__dx") == F.col("__c")), "left")
    use = F.when(F.col("__v").isNotNull(), F.col("__w"))
    return met.groupBy(*own).agg((F.sum(use * F.col("__v")) / F.when(F.sum(use) > 0, F.sum(use))).alias(value))


def composite(sources: Sequence[DataFrame], value: str, keys: Sequence[str] = ("row", "col")) -> DataFrame:
    """Later sources cover earlier ones where they have data."""
    rows = None
    for k, s in enumerate(sources):
        one = s.where(F.col(value).isNotNull()).select(*keys, value, F.lit(k).alias("__k"))
        rows = one if rows is None else rows.unionByName(one)
    return rows.groupBy(*keys).agg(F.max_by(F.col(value), F.col("__k")).alias(value))


def as_of(left: DataFrame, right: DataFrame, keys: Sequence[str], time: str, right_time: str, value: str, max_age_seconds: int | None = None) -> DataFrame:
    """left with the latest value of right at or before its time, by one union and one window: no row meets another row of its key.

    Keys with very many rows are the window's limit; give them a coarser period as one more key.
    """
    kind = dict(right.dtypes)[value]
    a = left.select(*left.columns, F.col(time).alias("__t"), F.lit(1).alias("__side"), F.lit(None).cast(f"struct<t:timestamp,v:{kind}>").alias("__r"))
    b = right.select(*[(F.col(c) if c in keys else F.lit(None).cast(t)).alias(c) for c, t in left.dtypes], F.col(right_time).alias("__t"), F.lit(0).alias("__side"), F.struct(F.col(right_time).cast("timestamp").alias("t"), F.col(value).alias("v")).alias("__r"))
    w = Window.partitionBy(*keys).orderBy("__t", "__side").rowsBetween(Window.unboundedPreceding, 0)
    out = a.unionByName(b).withColumn("__last", F.last("__r", ignorenulls=True).over(w)).where("__side = 1")
    fresh = F.lit(True) if max_age_seconds is None else F.col("__t").cast("timestamp").cast("double") - F.col("__last.t").cast("double") <= max_age_seconds
    return out.withColumn(value, F.when(fresh, F.col("__last.v"))).select(*left.columns, value)


def as_of_by_buckets(left: DataFrame, right: DataFrame, keys: Sequence[str], time: str, right_time: str, value: str, bucket_seconds: int, direction: str = "previous", max_age_seconds: float | None = None) -> DataFrame:
    """left with a value of right by time, for keys of any number of rows: previous (at or before), next (at or after) or nearest (of equals the earlier).

    Rows are put into buckets of time, so a hot key is as many groups as it has buckets. Within a bucket one window finds the
    neighbours on both sides; what lies before or after it is carried over by a second window, over one row a key and bucket.
    max_age bounds both directions. Of values at one time the greatest stands. Rows of left without a time or key get no value.
    """
    if direction not in ("previous", "next", "nearest"):
        raise ValueError(f"no direction {direction}")
    kinds = dict(right.dtypes)
    found = f"struct<t:timestamp,v:{kinds[value]}>"
    left_keys = [F.col(k) for k in keys]

    def bucket(t: Column) -> Column:
        return F.floor(t.cast("timestamp").cast("double") / bucket_seconds).cast("bigint")

    a = left.select(F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("__row"), *left_keys, F.col(time).cast("timestamp").alias("__t"), F.lit(None).cast(found).alias("__r"))
    known = right.dropna(subset=[*keys, right_time, value])
    one = known.groupBy(*keys, F.col(right_time).cast("timestamp").alias("__t")).agg(F.max(value).alias("__v"))
    row_kind = a.schema["__row"].dataType
    b = one.select(F.lit(None).cast(row_kind).alias("__row"), *left_keys, "__t", F.struct(F.col("__t").alias("t"), F.col("__v").alias("v")).cast(found).alias("__r"))
    both = a.unionByName(b).withColumn("__b", bucket(F.col("__t")))
    group = [*keys, "__b"]
    near = Window.partitionBy(*group).orderBy("__t")
    both = both.withColumn("__before", F.last("__r", ignorenulls=True).over(near.rangeBetween(Window.unboundedPreceding, 0)))
    both = both.withColumn("__after", F.last("__r", ignorenulls=True).over(Window.partitionBy(*group).orderBy(F.col("__t").desc()).rangeBetween(Window.unboundedPreceding, 0)))
    ends = a.select(*keys, bucket(F.col("__t")).alias("__b"), "__r").unionByName(b.select(*keys, bucket(F.col("__t")).alias("__b"), "__r"))
    ends = ends.groupBy(*group).agg(F.max("__r").alias("__last"), F.min("__r").alias("__first"))
    order = Window.partitionBy(*keys).orderBy("__b")
    ends = ends.select(
        *group,
        F.last("__last", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("__earlier"),
        F.first("__first", ignorenulls=True).over(order.rowsBetween(1, Window.unboundedFollowing)).alias("__later"),
    )
    out = both.where(F.col("__row").isNotNull()).join(ends, group, "left")
    earlier, later = F.coalesce("__before", "__earlier"), F.coalesce("__after", "__later")

    def age(r: Column) -> Column:
        return F.abs(F.col("__t").cast("double") - r["t"].cast("double"))

    if max_age_seconds is not None:
        earlier, later = (F.when(age(r) <= max_age_seconds, r) for r in (earlier, later))
    nearest = F.when(later.isNull() | (age(earlier) <= age(later)), earlier).otherwise(later)
    picked = {"previous": earlier, "next": later, "nearest": nearest}[direction]
    return out.select("__row.*", F.when(F.col("__t").isNotNull(), picked["v"]).alias(value))


def overview(cells: DataFrame, level: int, value: str, categorical: bool) -> DataFrame:
    """A level of an overview: classes keep the cell at the middle of each block, numbers their mean."""
    f = 1 << level
    if not categorical:
        return average(cells, f, value)
    middle = (F.pmod(F.col("row"), F.lit(f)) == f // 2) & (F.pmod(F.col("col"), F.lit(f)) == f // 2)
    return cells.where(middle).select(F.floor(F.col("row") / f).alias("row"), F.floor(F.col("col") / f).alias("col"), value)
