"""Catalogue records (public UMM-G JSON) as rows of the index, in one pass and without a shuffle.

The schema is declared, so nothing is read to infer it. Links and checksums of a record meet by file name inside its row.

Defined results
  no primary file    the record is left out, and counted by the observation
  not JSON, or null  the same, counted as broken
  no cloud cover     null, never 0
  no footprint       an error that names the record
  no start time      an error that names the record
  two files of one record for one asset  an error that names the record
  link without GET DATA                  its file is unreachable and left out
  repeated records   each is a row
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cellweave.sources.readers import footprint

# FIXED: kinds of links in the public format.
LINK, DIRECT_LINK = "GET DATA", "GET DATA VIA DIRECT ACCESS"
UMM = """struct<GranuleUR:string, CloudCover:double,
CollectionReference:struct<ShortName:string,Version:string>,
TemporalExtent:struct<RangeDateTime:struct<BeginningDateTime:string,EndingDateTime:string>>,
SpatialExtent:struct<HorizontalSpatialDomain:struct<Geometry:struct<
  GPolygons:array<struct<Boundary:struct<Points:array<struct<Longitude:double,Latitude:double>>>>>,
  BoundingRectangles:array<struct<WestBoundingCoordinate:double,SouthBoundingCoordinate:double,EastBoundingCoordinate:double,NorthBoundingCoordinate:double>>>>>,
RelatedUrls:array<struct<URL:string,Type:string>>,
DataGranule:struct<DayNightFlag:string,ArchiveAndDistributionInformation:array<struct<Name:string,SizeInBytes:bigint,Checksum:struct<Value:string,Algorithm:string>>>>,
AdditionalAttributes:array<struct<Name:string,Values:array<string>>>>"""


def _pattern(glob: str) -> str:
    """A glob of * and ? as a regular expression; what * matches first is group 1."""
    said = "".join("(.*)" if c == "*" else "." if c == "?" else "\\" + c if not c.isalnum() and c != "_" else c for c in glob)
    return f"^{said}$"


def files_of(g: Column) -> Column:
    """[{name, url, direct, checksum, size}] of a record: links joined with what is said of their files, one entry a reachable file, by name."""
    links = F.coalesce(g["RelatedUrls"], F.array().cast("array<struct<URL:string,Type:string>>"))
    named = F.transform(F.filter(links, lambda u: u["URL"].isNotNull() & u["Type"].isin(LINK, DIRECT_LINK)), lambda u: F.struct(F.regexp_extract(u["URL"], "([^/]*)/*$", 1).alias("name"), u["Type"].alias("kind"), u["URL"].alias("url")))
    names = F.array_sort(F.array_distinct(F.transform(F.filter(named, lambda u: u["kind"] == LINK), lambda u: u["name"])))
    told = F.coalesce(g["DataGranule"]["ArchiveAndDistributionInformation"], F.array().cast("array<struct<Name:string,SizeInBytes:bigint,Checksum:struct<Value:string,Algorithm:string>>>"))

    def last(found: Column) -> Column:
        return F.try_element_at(found, F.lit(-1))

    def one(name: Column) -> Column:
        own = F.filter(named, lambda u: u["name"] == name)
        url = last(F.filter(own, lambda u: u["kind"] == LINK))["url"]
        direct = last(F.filter(own, lambda u: u["kind"] == DIRECT_LINK))["url"]
        said = F.filter(told, lambda t: t["Name"] == name)
        checked = last(F.filter(said, lambda t: F.length(t["Checksum"]["Value"]) > 0))["Checksum"]
        checksum = F.concat(F.replace(F.lower(F.coalesce(checked["Algorithm"], F.lit(""))), F.lit("-"), F.lit("")), F.lit(":"), F.lower(checked["Value"]))
        size = last(F.filter(said, lambda t: t["SizeInBytes"].isNotNull()))["SizeInBytes"]
        return F.struct(name.alias("name"), url.alias("url"), direct.alias("direct"), checksum.alias("checksum"), size.alias("size"))

    return F.transform(names, one)


def _box(g: Column, indexed: Column) -> Column:
    """The bounds of the first polygon of three points or more, else of the first rectangle, else an error."""
    shape = g["SpatialExtent"]["HorizontalSpatialDomain"]["Geometry"]
    points = F.try_element_at(shape["GPolygons"], F.lit(1))["Boundary"]["Points"]
    rect = F.try_element_at(shape["BoundingRectangles"], F.lit(1))
    sides = {s: rect[f"{s.title()}BoundingCoordinate"].alias(s) for s in ("west", "south", "east", "north")}
    kind = "struct<west:double,south:double,east:double,north:double>"
    polygon = F.struct(*[c.alias(s) for s, c in footprint(points).items()]).cast(kind)
    missing = F.raise_error(F.concat(F.coalesce(g["GranuleUR"], F.lit("a record")), F.lit(": no polygon and no rectangle")))
    return F.when(F.size(points) >= 3, polygon).when(rect.isNotNull(), F.struct(*sides.values()).cast(kind)).when(indexed, missing.cast(kind))


def granules(records: DataFrame, document: str, assets: Mapping[str, str], start: str | None = None, end: str | None = None, box: tuple[float, float, float, float] | None = None, counted: Observation | None = None) -> DataFrame:
    """Rows of the index from records, a JSON text each in a column. assets: name -> glob of file names; the first is the primary one.

    start <= acquired < end and the box are applied to what was read, as a catalogue also answers with what only overlaps.
    counted gets records, broken and skipped. The granule's id is what the first * of the primary glob matched, else the file's name.
    """
    said = F.from_json(document, f"struct<umm:{UMM}>")["umm"]
    bare = F.from_json(document, UMM)
    g = F.col("__g")
    read = records.select(F.coalesce(said, bare).alias("__g"))
    read = read.withColumn("__files", F.when(g["GranuleUR"].isNotNull() | g["RelatedUrls"].isNotNull(), files_of(g)))

    def matched(asset: str, glob: str) -> Column:
        hits = F.filter("__files", lambda f: f["name"].rlike(_pattern(glob)))
        many = F.raise_error(F.concat(F.coalesce(g["GranuleUR"], F.lit("a record")), F.lit(f": several files for {asset}")))
        kind = "struct<name:string,url:string,direct:string,checksum:string,size:bigint>"
        return F.when(F.size(hits) > 1, many.cast(kind)).otherwise(F.try_element_at(hits, F.lit(1))).alias(f"__{asset}")

    primary, glob = next(iter(assets.items()))
    read = read.select("*", *[matched(a, p) for a, p in assets.items()])
    if counted is not None:
        broken, none = F.col("__files").isNull(), F.col(f"__{primary}").isNull()
        read = read.observe(counted, F.count("*").alias("records"), F.count_if(broken).alias("broken"), F.count_if(~broken & none).alias("skipped"))
    whole = read.where(F.col(f"__{primary}").isNotNull())
    name = F.col(f"__{primary}.name")
    indexed = F.col(f"__{primary}").isNotNull()  # errors ask for it, as Spark may try a window before it leaves out the rest
    times = g["TemporalExtent"]["RangeDateTime"]
    untimed = F.raise_error(F.concat(F.coalesce(g["GranuleUR"], name), F.lit(": no start time"))).cast("timestamp")
    found = [F.struct(F.lit(a).alias("asset"), *[F.col(f"__{a}.{c}").alias(c) for c in ("url", "direct", "checksum", "size")]) for a in assets]
    named = F.filter(F.coalesce(g["AdditionalAttributes"], F.array().cast("array<struct<Name:string,Values:array<string>>>")), lambda a: (F.length(a["Name"]) > 0) & a["Values"].isNotNull())
    version = F.coalesce(g["CollectionReference"]["Version"], F.lit(""))
    out = whole.select(
        (F.regexp_extract(name, _pattern(glob), 1) if "*" in glob else name).alias("granule_id"),
        g["GranuleUR"].alias("granule_ur"),
        g["CollectionReference"]["ShortName"].alias("collection"),
        version.alias("collection_version"),
        F.when(version.rlike("^[0-9]+$"), F.concat(F.lit("V"), version)).otherwise(version).alias("product_version"),
        F.coalesce(F.try_to_timestamp(times["BeginningDateTime"]), F.when(indexed, untimed)).alias("acquired"),
        F.to_timestamp(F.coalesce(times["EndingDateTime"], times["BeginningDateTime"])).alias("ended"),
        _box(g, indexed).alias("__box"),
        (g["CloudCover"] / 100).alias("cloud_fraction"),
        g["DataGranule"]["DayNightFlag"].alias("day_night"),
        F.filter(F.array(*found), lambda f: f["url"].isNotNull()).alias("assets"),
        F.transform(named, lambda a: F.struct(a["Name"].alias("name"), F.concat_ws(",", a["Values"]).alias("value"))).alias("attributes"),
    ).select("*", "__box.*").drop("__box")
    if start is not None:
        out = out.where(F.col("acquired") >= F.lit(start).cast("timestamp"))
    if end is not None:
        out = out.where(F.col("acquired") < F.lit(end).cast("timestamp"))
    if box is not None:
        w, s, e, n = box
        out = out.where((F.col("west") <= e) & (F.col("east") >= w) & (F.col("south") <= n) & (F.col("north") >= s))
    return out


def read_pages(spark: SparkSession, path: str, collections: list[str] | None = None) -> DataFrame:
    """(record, collection) of pages, folders collection=<name> of files with a record a line: only folders that were asked for are read."""
    pages = spark.read.schema("value string, collection string").option("recursiveFileLookup", "false").text(path)
    if collections is not None:
        pages = pages.where(F.col("collection").isin(*collections))
    return pages.select(F.col("value").alias("record"), "collection")
