"""Queries of catalogue records, made of orders as JSON documents, beside SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cellweave.sources.granules import granules
from cellweave.sources.tables import index

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
_ASSETS = {"radiance": "R_*.nc", "mask": "M_*.nc"}


def query(sql: str):
    def add(run):
        QUERIES[run.__name__], ORACLE_SQL[run.__name__] = run, sql
        return run

    return add


def records(spark, d) -> DataFrame:
    """A record an order: polygons for even sites, rectangles for odd ones; every seventh has no primary file, every eleventh is cut off."""
    key = F.col("granule_id").cast("string")
    point = lambda x, y: F.struct(F.col(x).alias("Longitude"), F.col(y).alias("Latitude"))
    polygon = F.array(F.struct(F.struct(F.array(point("west", "south"), point("east", "south"), point("east", "north")).alias("Points")).alias("Boundary")))
    rect = F.array(F.struct(*[F.col(s).alias(f"{s.title()}BoundingCoordinate") for s in ("west", "south", "east", "north")]))
    even = F.col("site") % 2 == 0
    shape = F.struct(F.struct(F.struct(F.when(even, polygon).alias("GPolygons"), F.when(~even, rect).alias("BoundingRectangles")).alias("Geometry")).alias("HorizontalSpatialDomain"))
    link = lambda name, kind: F.struct(F.concat(F.lit("https://a.example/x/"), name).alias("URL"), F.lit(kind).alias("Type"))
    main, mask = (F.concat(F.lit(f"{c}_"), key, F.lit(".nc")) for c in "RM")
    main_kind = F.when(F.col("granule_id") % 7 == 0, "GET RELATED VISUALIZATION").otherwise("GET DATA")
    links = F.array(F.struct(F.concat(F.lit("https://a.example/x/"), main).alias("URL"), main_kind.alias("Type")), link(mask, "GET DATA"), link(main, "GET DATA VIA DIRECT ACCESS"))
    info = F.array(F.struct(main.alias("Name"), F.col("site").cast("bigint").alias("SizeInBytes"), F.struct(F.upper(F.md5(key)).alias("Value"), F.lit("SHA-512").alias("Algorithm")).alias("Checksum")))
    umm = F.struct(
        F.concat(F.lit("G"), key).alias("GranuleUR"),
        (F.col("cloud_fraction") * 100).alias("CloudCover"),
        F.struct(F.col("collection").alias("ShortName"), F.lit("001").alias("Version")).alias("CollectionReference"),
        F.struct(F.struct(F.date_format("acquired", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("BeginningDateTime")).alias("RangeDateTime")).alias("TemporalExtent"),
        shape.alias("SpatialExtent"), links.alias("RelatedUrls"), F.struct(info.alias("ArchiveAndDistributionInformation")).alias("DataGranule"),
        F.array(F.struct(F.lit("ORBIT").alias("Name"), F.array(key, F.lit("x")).alias("Values"))).alias("AdditionalAttributes"),
    )
    doc = F.to_json(F.struct(umm.alias("umm")))
    return index(spark, d).select(F.when(F.col("granule_id") % 11 == 0, F.substring(doc, 1, 9)).otherwise(doc).alias("record"))


_WHOLE = "o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0"


@query(f"SELECT count(*) AS records, count(*) FILTER (o_orderkey % 11 = 0) AS broken, count(*) FILTER (o_orderkey % 11 <> 0 AND o_orderkey % 7 = 0) AS skipped, count(*) FILTER ({_WHOLE}) AS kept FROM orders")
def catalogue_counts(spark, d):
    counted = Observation()
    kept = granules(records(spark, d), "record", _ASSETS, counted=counted).agg(F.count("granule_id")).first()[0]
    return spark.createDataFrame([(*[counted.get[k] for k in ("records", "broken", "skipped")], kept)], "records bigint, broken bigint, skipped bigint, kept bigint")
