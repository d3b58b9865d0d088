"""Queries of pyramids, pictures and sketched stretches on the raster of parts, beside SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave.operators import pyramid, sketches
from cellweave.sources.tables import RASTER_SQL, raster

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
_LEVELS, _TILE, _ERROR = 4, 32, 0.001
#: Parts of some sizes are holes.
_HOLES = "cls % 9 <> 4"


def query(sql: str):
    def add(run):
        QUERIES[run.__name__], ORACLE_SQL[run.__name__] = run, sql
        return run

    return add


@query(f"WITH {RASTER_SQL} SELECT k::INT AS level, row // (1 << k::INT) AS row, col // (1 << k::INT) AS col, round(avg(value), 5) AS value, count(*) AS n FROM raster, range(1, {_LEVELS + 1}) l(k) WHERE {_HOLES} GROUP BY ALL")
def pyramid_means(spark, d):
    out = pyramid.mean_pyramid(raster(spark, d).where(_HOLES), _LEVELS, "value")
    return out.withColumn("value", F.round("value", 5))


@query(f"WITH {RASTER_SQL} SELECT k::INT AS level, row // (1 << k::INT) AS row, col // (1 << k::INT) AS col, cls FROM raster, range(1, {_LEVELS + 1}) l(k) WHERE row % (1 << k::INT) = 1 << (k::INT - 1) AND col % (1 << k::INT) = 1 << (k::INT - 1)")
def pyramid_classes(spark, d):
    return pyramid.class_pyramid(raster(spark, d), _LEVELS, "cls")


@query(f"WITH {RASTER_SQL} SELECT row, col, (cls * 5 % 256)::INT AS r, (row % 256)::INT AS g, (col * 7 % 256)::INT AS b, 255 AS a FROM raster WHERE {_HOLES}")
def picture_pixels(spark, d):
    """What PNG tiles say when they are read again."""
    colored = raster(spark, d).where(_HOLES).select("row", "col", (F.col("cls") * 5 % 256).alias("r"), (F.col("row") % 256).alias("g"), (F.col("col") * 7 % 256).alias("b"), F.lit(255).alias("a"))
    return pyramid.read_pixels(pyramid.render_tiles(colored, _TILE)).where("a > 0")


@query(f"WITH {RASTER_SQL} SELECT row // {_TILE} AS ty, col // {_TILE} AS tx, count(*) AS pixels FROM raster WHERE {_HOLES} GROUP BY ALL")
def picture_tiles(spark, d):
    colored = raster(spark, d).where(_HOLES).select("row", "col", *[F.lit(200).alias(c) for c in "rgba"])
    pixels = pyramid.read_pixels(pyramid.render_tiles(colored, _TILE)).where("a > 0")
    return pixels.groupBy(F.floor(F.col("row") / _TILE).alias("ty"), F.floor(F.col("col") / _TILE).alias("tx")).agg(F.count("*").alias("pixels"))


@query(f"WITH {RASTER_SQL} SELECT cls % 4 AS kind, count(*) AS n, true AS lo_near, true AS hi_near FROM raster GROUP BY 1")
def stretch_sketched(spark, d):
    """Whether ends made of the sketches of tiles have their ranks, within the error that is stated."""
    cells = raster(spark, d).select((F.col("cls") % 4).alias("kind"), F.floor(F.col("row") / 16).alias("ty"), F.floor(F.col("col") / 16).alias("tx"), "value")
    ends = sketches.sketched_stretch(sketches.tile_sketches(cells, "value", ["kind", "ty", "tx"]), keys=["kind"])
    x = F.col("value")

    def near(end: str, share: float):
        below, upto = (F.sum(c.cast("bigint")) / F.first("n") for c in (x < F.col(end), x <= F.col(end)))
        return ((below <= share + _ERROR) & (upto >= share - _ERROR)).alias(f"{end}_near")

    return cells.join(ends, "kind").groupBy("kind").agg(F.first("n").alias("n"), near("lo", 0.02), near("hi", 0.98))
