"""Where results go: snapshots and products by tile, mosaics, and the documents beside them."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.operators.publish import MOST_GRANULES, extent
from cellweave.sources.readers import version_counts

TILE = ("tx", "ty")
#: FIXED: pixels of a side of a map tile.
TILE_PIXELS = 256


def write_tiles(rows: DataFrame, path: str, time: str, order: Sequence[str] = ("row", "col")) -> None:
    """Parquet by tile and time; tiles and times that rows bring are replaced, others stay.

    A task writes whole tiles, whose size the lattice bounds. time: epoch_start of snapshots, period of products.
    """
    by = (*TILE, time)
    rows.repartition(*by).sortWithinPartitions(*by, *order).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def read_tiles(spark: SparkSession, path: str, time: str, tiles: Sequence[tuple[int, int]] | None = None, times: Sequence | None = None) -> DataFrame:
    """Tiles and times that were asked for: only their folders are read. A time that nobody wrote has no rows."""
    rows = spark.read.parquet(path)
    if tiles is not None:
        wanted = F.lit(False)
        for x, y in tiles:
            wanted = wanted | ((F.col("tx") == x) & (F.col("ty") == y))
        rows = rows.where(wanted)
    return rows.where(F.col(time).isin(*times)) if times is not None else rows


def mosaic_plan(products: DataFrame, period: str = "period", asset: str = "asset") -> DataFrame:
    """(period, asset, tiles, box): what each mosaic is made of; products has a row a tile, with its box."""
    return products.groupBy(period, asset).agg(F.countDistinct(*TILE).alias("tiles"), F.min("west").alias("west"), F.min("south").alias("south"), F.max("east").alias("east"), F.max("north").alias("north"))


def mosaic(cells: DataFrame, zoom: int, values: Sequence[str], categorical: bool, keys: Sequence[str] = (), order: Sequence[str] = ("row", "col"), lon: str = "lon", lat: str = "lat") -> DataFrame:
    """(keys, px, py, values) on the pixels of spherical mercator at a zoom: the cell nearest to the pixel's centre of classes, the mean of others.

    One aggregation, partial before its shuffle. Cells beyond the square's latitudes have no pixel.
    """
    side = TILE_PIXELS << zoom
    x = (F.col(lon) + 180) / 360 * side
    y = (0.5 - F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)) / (2 * math.pi)) * side
    at = cells.withColumn("__x", x).withColumn("__y", y).where(F.col("__x").between(0, side) & F.col("__y").between(0, side))
    px, py = (F.least(F.floor(c), F.lit(side - 1)).alias(n) for c, n in (("__x", "px"), ("__y", "py")))
    away = F.round(F.pow(F.col("__x") - F.floor("__x") - 0.5, F.lit(2)) + F.pow(F.col("__y") - F.floor("__y") - 0.5, F.lit(2)), 9)
    by = [*keys, px, py]
    if not categorical:
        return at.groupBy(*by).agg(*[F.avg(v).alias(v) for v in values])
    near = F.min_by(F.struct(*values), F.struct(away, *order)).alias("__v")
    return at.groupBy(*by).agg(near).select(*keys, "px", "py", "__v.*")


def sample(cells: DataFrame, lon: float, lat: float, origin: tuple[float, float], resolution: tuple[float, float]) -> DataFrame:
    """The cell at a point: an equality on row and column, which reaches the scan."""
    col, row = math.floor((lon - origin[0]) / resolution[0]), math.floor((lat - origin[1]) / resolution[1])
    return cells.where((F.col("row") == row) & (F.col("col") == col))


def granules_document(numbered: DataFrame) -> dict:
    """The granules of a band by number, of rows with granule_no, granule_id and acquired; 65,534 at most, so they can be listed."""
    rows = numbered.where("granule_no > 0").groupBy("granule_no").agg(F.min("granule_id").alias("granule_id"), F.min("acquired").alias("acquired"))
    found = rows.orderBy("granule_no").limit(MOST_GRANULES + 1).collect()
    if len(found) > MOST_GRANULES:
        raise ValueError(f"a band holds {MOST_GRANULES} granules")
    return {"granules": [{"number": r.granule_no, "id": r.granule_id, "acquired": str(r.acquired)} for r in found]}


def collection_document(collection_id: str, description: str, items: DataFrame, license: str = "various") -> dict:
    """A collection in the public STAC layout, its extent that of its items (id, west, south, east, north, start, end); no items are an error."""
    e = extent(items).first()
    if e.west is None:
        raise ValueError(f"{collection_id}: no items")
    links = [{"rel": "item", "href": f"./{r[0]}.json"} for r in items.select("id").distinct().orderBy("id").toLocalIterator()]  # its size is the document's
    temporal = {"interval": [[str(e.start), str(e.end)]]}
    return {"type": "Collection", "stac_version": "1.0.0", "id": collection_id, "description": description, "license": license, "extent": {"spatial": {"bbox": [[e.west, e.south, e.east, e.north]]}, "temporal": temporal}, "links": links}


def provenance_document(run_id: str, key: str, index: DataFrame, frozen: str, plugins: dict[str, str]) -> dict:
    """What a product was made of: description, input by version, the frozen index's fingerprint, plug-ins and versions."""
    inputs = [r.asDict() for r in version_counts(index).orderBy("collection", "collection_version").collect()]  # a row a collection and version
    return {"run_id": run_id, "manifest_key": key, "index": frozen, "inputs": inputs, "plugins": dict(sorted(plugins.items())), "spark": index.sparkSession.version}
