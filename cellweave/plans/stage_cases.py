"""Queries of scans, plug-ins, mosaics and the documents' tables, beside SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave.operators import publish, resolve, sinks
from cellweave.plans import plugins
from cellweave.sources import readers
from cellweave.sources.tables import INDEX_SQL, LOOK_ORDER, LOOKS_SQL, RASTER_SQL, index, looks, raster

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str):
    def put(f):
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql
        return f

    return put


@query("SELECT * FROM (VALUES ('rder', 'o'), ('pa', 'p')) t(granule_id, collection)")
def scan_glob_ids(spark, d):
    """The wildcards say the granule; whatever else lies in the folder isn't met."""
    found = readers.scan(spark, {("o", "main"): f"{d}/o*s.parquet", ("p", "main"): f"{d}/*rt.parquet"})
    return found.select("granule_id", "collection")


@query(f"WITH {INDEX_SQL} SELECT collection, collection_version, count(*) AS granules FROM idx GROUP BY 1, 2")
def version_counts(spark, d):
    return readers.version_counts(index(spark, d))


@query("""SELECT o_orderkey AS granule_id, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders""")
def name_stamps(spark, d):
    """A third of the names has month 13: no time."""
    stamp = F.when(F.col("granule_id") % 3 == 0, "20201301T000000").otherwise(F.concat(F.date_format("acquired", "yyyyMMdd"), F.lit("T101112")))
    rows = index(spark, d).select("granule_id", F.concat(F.lit("L2_"), stamp, F.lit("_v1.nc")).alias("name"))
    return rows.select("granule_id", F.date_format(readers.stamp_of(F.col("name")), "yyyy-MM-dd").alias("day"))


class _Steep:
    """Wins by score over view zenith; what it emits is the zenith."""

    requires, outputs = ("score", "vz"), ("tilt",)

    def score(self, rows):
        return F.col("score") - F.col("vz") / 10

    def emit(self, rows):
        return {"tilt": F.col("vz") / 10}


class _Range:
    """The width of the values, and how many there are."""

    outputs, requires = (("width", "double"), ("n", "bigint")), ("value",)

    def reduce(self, snaps, keys):
        return snaps.groupBy(*keys).agg((F.max("value") - F.min("value")).cast("double").alias("width"), F.count("value").alias("n"))


class _Grey:
    def paint(self, cells):
        level = F.least(F.floor(F.col("value") / 10), F.lit(255)).cast("int")
        return {c: level for c in "rgb"} | {"a": F.lit(255)}


@query(f"""WITH {LOOKS_SQL} SELECT cell, epoch, oid, line, round(score - vz / 10, 7) AS score, round(vz / 10, 7) AS tilt FROM looks WHERE score IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY cell, epoch ORDER BY round(score - vz / 10, 9) DESC, acquired, oid, line) = 1""")
def plugin_scorer(spark, d):
    scored = plugins.apply_scorer(looks(spark, d), plugins.resolve("scorer", f"{__name__}:_Steep")).withColumn("score", F.round("score", 9))
    out = resolve.winners(scored, ["cell", "epoch"], LOOK_ORDER, ["scorer_tilt"])
    return out.select("cell", "epoch", "oid", "line", F.round("score", 7).alias("score"), F.round("scorer_tilt", 7).alias("tilt"))


@query(f"WITH {LOOKS_SQL} SELECT cell, round(max(value) - min(value), 4)::DOUBLE AS width, count(value) AS n FROM looks GROUP BY cell")
def plugin_reducer(spark, d):
    return plugins.apply_reducer(looks(spark, d), ["cell"], plugins.resolve("reducer", f"{__name__}:_Range")).withColumn("width", F.round("width", 4))


@query(f"WITH {RASTER_SQL} SELECT row, col, least(floor(value / 10), 255)::INT AS r, least(floor(value / 10), 255)::INT AS g, least(floor(value / 10), 255)::INT AS b, 255 AS a FROM raster")
def plugin_mapper(spark, d):
    return plugins.apply_mapper(raster(spark, d), plugins.resolve("mapper", f"{__name__}:_Grey")).select("row", "col", *"rgba")


_AT = "(-10.003 + col * 0.07) AS lon, (40.001 - row * 0.05) AS lat"
_PIXEL = "(lon + 180) / 360 * 2048 AS x, (0.5 - ln(tan(pi() / 4 + radians(lat) / 2)) / (2 * pi())) * 2048 AS y"


def _placed(spark, d):
    return raster(spark, d).withColumns({"lon": -10.003 + F.col("col") * 0.07, "lat": 40.001 - F.col("row") * 0.05})


@query(f"""WITH {RASTER_SQL}, placed AS (SELECT *, {_AT} FROM raster), p AS (SELECT *, {_PIXEL} FROM placed WHERE lat BETWEEN -85 AND 85)
SELECT floor(x)::BIGINT AS px, floor(y)::BIGINT AS py, round(avg(value), 6)::DOUBLE AS value FROM p GROUP BY 1, 2""")
def mosaic_mean(spark, d):
    cells = _placed(spark, d).where("lat BETWEEN -85 AND 85")
    return sinks.mosaic(cells, 3, ["value"], False).select("px", "py", F.round("value", 6).alias("value"))


@query(f"""WITH {RASTER_SQL}, placed AS (SELECT *, {_AT} FROM raster), p AS (SELECT *, {_PIXEL} FROM placed WHERE lat BETWEEN -85 AND 85)
SELECT floor(x)::BIGINT AS px, floor(y)::BIGINT AS py, cls FROM p
QUALIFY row_number() OVER (PARTITION BY floor(x), floor(y) ORDER BY round((x - floor(x) - 0.5) ** 2 + (y - floor(y) - 0.5) ** 2, 9), row, col) = 1""")
def mosaic_nearest(spark, d):
    cells = _placed(spark, d).where("lat BETWEEN -85 AND 85")
    return sinks.mosaic(cells, 3, ["cls"], True)


@query(f"WITH {RASTER_SQL} SELECT cls % 4 AS period, 'classes' AS asset, count(DISTINCT row // 8 * 8 + col // 8) AS tiles, min(col)::DOUBLE AS west, min(row)::DOUBLE AS south, max(col) + 1.0::DOUBLE AS east, max(row) + 1.0::DOUBLE AS north FROM raster GROUP BY 1")
def mosaic_plan(spark, d):
    row, col = F.col("row").cast("double"), F.col("col").cast("double")
    t = raster(spark, d).select((F.col("cls") % 4).alias("period"), F.lit("classes").alias("asset"), F.floor(F.col("col") / 8).alias("tx"), F.floor(F.col("row") / 8).alias("ty"), col.alias("west"), row.alias("south"), (col + 1).alias("east"), (row + 1).alias("north"))
    return sinks.mosaic_plan(t)


@query(f"WITH {RASTER_SQL} SELECT row, col, cls FROM raster WHERE row = 2 AND col = 7")
def point_sample(spark, d):
    return sinks.sample(raster(spark, d), -9.925, 39.79, (-10.0, 40.0), (0.01, -0.1)).select("row", "col", "cls")


@query(f"WITH {RASTER_SQL} SELECT min(col)::DOUBLE AS west, min(row)::DOUBLE AS south, max(col)::DOUBLE AS east, max(row)::DOUBLE AS north, min(cls) AS start, max(cls) AS \"end\" FROM raster")
def items_extent(spark, d):
    row, col = F.col("row").cast("double"), F.col("col").cast("double")
    return publish.extent(raster(spark, d).select(col.alias("west"), row.alias("south"), col.alias("east"), row.alias("north"), F.col("cls").alias("start"), F.col("cls").alias("end")))
