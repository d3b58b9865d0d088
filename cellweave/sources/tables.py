"""The driver tables as looks, catalogue, class tables, rasters and spectra."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOOK_ORDER = ("acquired", "oid", "line")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of a table that one task takes where rows are dealt by their keys.
ROWS_A_TASK = 65_536


def tasks(spark: SparkSession, sf_dir: str, name: str, times: float = 1) -> int:
    """Tasks for the rows of a table, each making `times` rows: as many more as there are more rows, so that a task's share keeps its size."""
    return max(1, ceil(table(spark, sf_dir, name).count() * times / ROWS_A_TASK))


def looks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a look: the part is the cell, the ship date the acquisition, the quantity the score, missing where the discount is high."""
    t = table(spark, sf_dir, "lineitem")
    cls = F.when(F.col("l_tax") == 0, 0).when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2).otherwise(3)
    score = F.when(F.col("l_discount") <= 0.08, F.col("l_quantity"))
    return t.select(
        F.col("l_partkey").alias("cell"),
        F.col("l_orderkey").alias("oid"),
        F.col("l_linenumber").alias("line"),
        F.col("l_shipdate").cast("timestamp").alias("acquired"),
        F.year("l_shipdate").alias("epoch"),
        cls.alias("cls"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(2).alias("cls2"),
        score.alias("score"),
        score.isNotNull().alias("valid"),
        F.col("l_extendedprice").alias("value"),
        F.col("l_discount").alias("unc"),
        (F.col("l_quantity") / 50).alias("soil"),
        (F.col("l_discount") * 400).alias("vz"),
        (F.col("l_tax") * 900).alias("sz"),
    )


def dealt_looks(spark: SparkSession, sf_dir: str, *keys: str) -> DataFrame:
    """looks(), dealt by keys to tasks that get no larger with the table: windows over these keys and more sort what a task has."""
    return looks(spark, sf_dir).repartition(tasks(spark, sf_dir, "lineitem"), *keys)


LOOKS_SQL = """looks AS (
  SELECT l_partkey AS cell, l_orderkey AS oid, l_linenumber AS line, l_shipdate AS acquired, year(l_shipdate)::INT AS epoch,
    CASE WHEN l_tax = 0 THEN 0 WHEN l_returnflag = 'A' THEN 1 WHEN l_returnflag = 'N' THEN 2 ELSE 3 END AS cls,
    CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS cls2,
    CASE WHEN l_discount <= 0.08 THEN l_quantity END AS score, l_discount <= 0.08 AS valid,
    l_extendedprice AS value, l_discount AS unc, l_quantity / 50 AS soil, l_discount * 400 AS vz, l_tax * 900 AS sz
  FROM lineitem)"""


def index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a granule: orders, with a box of two degrees made from their keys and a cloud share that some lack."""
    t = table(spark, sf_dir, "orders")
    west, south = (F.col("o_custkey") % 356 - 178).cast("double"), (F.col("o_orderkey") % 176 - 88).cast("double")
    return t.select(
        F.col("o_orderkey").alias("granule_id"),
        F.col("o_orderstatus").alias("collection"),
        F.col("o_orderpriority").alias("collection_version"),
        F.col("o_orderdate").cast("timestamp").alias("acquired"),
        west.alias("west"), south.alias("south"), (west + 2).alias("east"), (south + 2).alias("north"),
        F.when(F.col("o_orderpriority") != "5-LOW", (F.col("o_orderkey") % 100) / 100).alias("cloud_fraction"),
        F.col("o_custkey").alias("site"),
        F.col("o_totalprice").alias("price"),
    )


INDEX_SQL = """idx AS (
  SELECT o_orderkey AS granule_id, o_orderstatus AS collection, o_orderpriority AS collection_version, o_orderdate AS acquired,
    (o_custkey % 356 - 178)::DOUBLE AS west, (o_orderkey % 176 - 88)::DOUBLE AS south, (o_custkey % 356 - 176)::DOUBLE AS east, (o_orderkey % 176 - 86)::DOUBLE AS north,
    CASE WHEN o_orderpriority <> '5-LOW' THEN (o_orderkey % 100) / 100.0::DOUBLE END AS cloud_fraction, o_custkey AS site, o_totalprice AS price
  FROM orders)"""


def raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a cell of a lattice 64 wide: parts by key."""
    t = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    return t.select(F.floor(key / 64).alias("row"), (key % 64).alias("col"), F.col("p_size").alias("cls"), F.col("p_retailprice").alias("value"))


RASTER_SQL = "raster AS (SELECT p_partkey // 64 AS row, p_partkey % 64 AS col, p_size AS cls, p_retailprice AS value FROM part)"


def read_catalogue_json(spark: SparkSession, path: str) -> DataFrame:
    """Public UMM-G granule records (one JSON document a file) as rows of the index."""
    raw = spark.read.option("multiLine", True).json(path)
    item = F.col("umm") if "umm" in raw.columns else F.struct(*raw.columns)
    g = raw.select(item.alias("g"))
    box = F.element_at(F.col("g.SpatialExtent.HorizontalSpatialDomain.Geometry.BoundingRectangles"), 1)
    return g.select(
        F.col("g.GranuleUR").alias("granule_id"),
        F.concat_ws(".", "g.CollectionReference.ShortName", "g.CollectionReference.Version").alias("collection"),
        F.to_timestamp("g.TemporalExtent.RangeDateTime.BeginningDateTime").alias("acquired"),
        box["WestBoundingCoordinate"].alias("west"), box["SouthBoundingCoordinate"].alias("south"),
        box["EastBoundingCoordinate"].alias("east"), box["NorthBoundingCoordinate"].alias("north"),
        (F.col("g.CloudCover") / 100).alias("cloud_fraction"),
        F.map_from_entries(F.transform("g.AdditionalAttributes", lambda a: F.struct(a["Name"], F.concat_ws(",", a["Values"])))).alias("attributes"),
        F.map_from_entries(F.transform("g.RelatedUrls", lambda u: F.struct(F.element_at(F.split(u["URL"], "/"), -1), u["URL"]))).alias("assets"),
    )


def write_index(rows: DataFrame, path: str) -> None:
    """The index in its order, so that row groups can be skipped by collection and granule."""
    rows.repartitionByRange("collection", "granule_id").sortWithinPartitions("collection", "granule_id").write.mode("overwrite").parquet(path)
