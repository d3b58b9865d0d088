"""The granule catalogue: selection, filters with a report, upserts and scope."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.functions.columns import boxes_touch

BOX = ("west", "south", "east", "north")
ROW_KEY = ("collection", "collection_version", "granule_id")


def query_index(index: DataFrame, box: tuple[float, float, float, float] | None = None, start=None, end=None, collections: Sequence[str] | None = None, time: str = "acquired") -> DataFrame:
    """Closed overlap of boxes, start <= t < end; comparisons of plain columns, so they reach the scan."""
    if box:
        index = index.where(boxes_touch([F.col(c) for c in BOX], [F.lit(float(x)) for x in box]))
    if start is not None:
        index = index.where(F.col(time) >= F.lit(start))
    if end is not None:
        index = index.where(F.col(time) < F.lit(end))
    return index.where(F.col("collection").isin(*collections)) if collections else index


@dataclass(frozen=True)
class Filter:
    """keep is the predicate, missing says where it can't be told; on_missing: keep, reject or fail."""

    name: str
    keep: Column
    missing: Column
    on_missing: str = "fail"

    def decided(self) -> Column:
        return F.when(self.missing, F.lit(self.on_missing == "keep")).otherwise(self.keep)


def max_cloud(limit: float, on_missing: str = "fail", column: str = "cloud_fraction") -> Filter:
    return Filter(f"cloud <= {limit:g}", F.col(column) <= limit, F.col(column).isNull(), on_missing)


def max_attribute(name: str, limit: float, on_missing: str = "fail", attributes: str = "attributes") -> Filter:
    x = F.try_element_at(F.col(attributes), F.lit(name)).try_cast("double")
    return Filter(f"{name} <= {limit:g}", x <= limit, x.isNull(), on_missing)


def month_in(months: Sequence[int], time: str = "acquired") -> Filter:
    return Filter(f"month in {sorted(months)}", F.month(time).isin(*months), F.col(time).isNull(), "reject")


def column_in(column: str, values: Sequence[str], on_missing: str = "fail") -> Filter:
    """NULL and the empty string are missing."""
    c = F.trim(column)
    return Filter(f"{column} in {sorted(values)}", c.isin(*values), c.isNull() | (c == ""), on_missing)


def apply_filters(index: DataFrame, filters: Sequence[Filter]) -> DataFrame:
    """Rows that pass all; a filter that fails on missing values is checked first, in one pass."""
    strict = [f for f in filters if f.on_missing == "fail"]
    if strict:
        bad = index.agg(*[F.count_if(f.missing).alias(str(k)) for k, f in enumerate(strict)]).first()
        told = [f"{f.name}: {n} rows can't be told" for f, n in zip(strict, bad, strict=True) if n]
        if told:
            raise ValueError("; ".join(told))
    for f in filters:
        index = index.where(f.decided())
    return index


def filter_report(index: DataFrame, filters: Sequence[Filter]) -> DataFrame:
    """(step, name, reached, removed): what each filter removed of what reached it, in one aggregation."""
    aggs, so_far = [], F.lit(True)
    for k, f in enumerate(filters):
        own = F.coalesce(f.decided(), F.lit(False))
        aggs += [F.count_if(so_far).alias(f"r{k}"), F.count_if(so_far & ~own).alias(f"x{k}")]
        so_far = so_far & own
    rows = [F.struct(F.lit(k + 1).alias("step"), F.lit(f.name).alias("name"), F.col(f"r{k}").alias("reached"), F.col(f"x{k}").alias("removed")) for k, f in enumerate(filters)]
    return index.agg(*aggs).select(F.inline(F.array(*rows)))


def pin_versions(index: DataFrame, pins: dict[str, str], collection: str = "collection", version: str = "collection_version") -> DataFrame:
    """Pinned collections keep one version. Several versions of one that isn't pinned are an error."""
    loose = index.where(~F.col(collection).isin(*pins)) if pins else index
    several = [r[0] for r in loose.groupBy(collection).agg(F.countDistinct(version).alias("n")).where("n > 1").select(collection).collect()]
    if several:
        raise ValueError(f"pin a version of {sorted(several)}")
    wanted = F.lit(None).cast("string")
    for c, v in pins.items():
        wanted = F.when(F.col(collection) == c, F.lit(v)).otherwise(wanted)
    return index.where(wanted.isNull() | (F.col(version) == wanted))


def granule_view(index: DataFrame, scalars: Sequence[str], maps: Sequence[str], granule: str = "granule_id", collection: str = "collection") -> DataFrame:
    """One row a granule: the first present scalar in order of collections; maps joined, the first collection's entries win."""
    aggs = [F.min_by(F.col(c), F.when(F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != ""), F.col(collection))).alias(c) for c in scalars]
    for m in maps:
        listed = F.sort_array(F.collect_list(F.struct(F.col(collection).alias("c"), F.map_entries(m).alias("e"))))  # one row a collection
        entries = F.flatten(F.transform(listed, lambda x: x["e"]))
        first = F.aggregate(entries, F.slice(entries, 1, 0), lambda acc, e: F.when(F.exists(acc, lambda a: a["key"] == e["key"]), acc).otherwise(F.concat(acc, F.array(e))))
        aggs.append(F.map_from_entries(first).alias(m))
    return index.groupBy(granule).agg(*aggs)


def upsert(index: DataFrame, delta: DataFrame, key: Sequence[str] = ROW_KEY) -> DataFrame:
    """Rows of delta replace those of the same key."""
    return index.join(delta, list(key), "left_anti").unionByName(delta)


def scope_covers(index: DataFrame, wanted: DataFrame, time: str = "acquired") -> DataFrame:
    """(collection, covered) of each wanted scope (collection, box, start, end): whether the index reaches beyond it on all sides."""
    own = index.groupBy("collection").agg(F.min("west").alias("w"), F.min("south").alias("s"), F.max("east").alias("e"), F.max("north").alias("n"), F.min(time).alias("t0"), F.max(time).alias("t1"))
    inside = (F.col("w") <= F.col("west")) & (F.col("s") <= F.col("south")) & (F.col("e") >= F.col("east")) & (F.col("n") >= F.col("north")) & (F.col("t0") <= F.col("start")) & (F.col("t1") >= F.col("end"))
    return wanted.join(own, "collection", "left").select("collection", F.coalesce(inside, F.lit(False)).alias("covered"))


def has_roles(index: DataFrame, assets: str, roles: Sequence[str]) -> DataFrame:
    """Granules whose assets have every role."""
    for r in roles:
        index = index.where(F.map_contains_key(F.col(assets), r))
    return index


def vintages(index: DataFrame, columns: Sequence[str], granule: str = "granule_id") -> DataFrame:
    """(group, n): granules by identity columns; one with any missing value is a group of its own."""
    whole = F.lit(True)
    for c in columns:
        whole = whole & F.col(c).isNotNull() & (F.col(c) != "")
    group = F.when(whole, F.concat_ws("/", *columns)).otherwise(F.concat(F.lit("only:"), F.col(granule).cast("string")))
    return index.groupBy(group.alias("group")).agg(F.count("*").alias("n"))
