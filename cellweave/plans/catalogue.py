"""The query catalogue: each operator applied to the driver tables, beside the same in DuckDB SQL."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellweave.functions import columns as C
from cellweave.functions import scorers, spectra, timeline
from cellweave.operators import catalog, classes, lattice, moments, publish, rank, reduce, resample, resolve, worklist
from cellweave.plans import gated_cases, lattice_cases, picture_cases, record_cases, stage_cases
from cellweave.sources.tables import INDEX_SQL, LOOK_ORDER, LOOKS_SQL, RASTER_SQL, dealt_looks, index, looks, raster, table, tasks

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}

KEYS = ("cell", "epoch")
KEEP = ("cls", "cls2", "value", "unc", "soil", "vz", "sz")
SNAPS_SQL = f"""{LOOKS_SQL},
won AS (SELECT * FROM looks WHERE valid QUALIFY row_number() OVER (PARTITION BY cell, epoch ORDER BY score DESC, acquired, oid, line) = 1),
snaps AS (SELECT k.cell, k.epoch, w.* EXCLUDE (cell, epoch, valid), coalesce(w.valid, false) AS valid, true AS observed
  FROM (SELECT DISTINCT cell, epoch FROM looks) k LEFT JOIN won w ON k.cell = w.cell AND k.epoch = w.epoch)"""
LOOKS, SNAPS, INDEX, RASTER = (f"WITH {x} " for x in (LOOKS_SQL, SNAPS_SQL, INDEX_SQL, RASTER_SQL))


def query(sql: str | None = None, name: str | None = None):
    def add(f):
        key = name or f.__name__
        QUERIES[key] = f
        if sql:
            ORACLE_SQL[key] = sql
        return f

    return add


def snaps(spark, d, keep=KEEP) -> DataFrame:
    return resolve.snapshots(looks(spark, d), KEYS, LOOK_ORDER, keep)


def day(c: str):
    return F.date_format(c, "yyyy-MM-dd").alias("day")


# --- scans, filters, catalogue -------------------------------------------------------------------------------------------------


@query(LOOKS + "SELECT cell, oid, line, strftime(acquired, '%Y-%m-%d') AS day, cls, score FROM looks")
def scan_looks(spark, d):
    return looks(spark, d).select("cell", "oid", "line", day("acquired"), "cls", "score")


@query(INDEX + "SELECT granule_id, west, south FROM idx WHERE west <= 60 AND east >= -120 AND south <= 60 AND north >= -60 AND acquired >= TIMESTAMP '1996-01-01' AND acquired < TIMESTAMP '1998-01-01' AND collection IN ('F', 'O')")
def filter_index_bbox_time(spark, d):
    return catalog.query_index(index(spark, d), (-120, -60, 60, 60), datetime(1996, 1, 1), datetime(1998, 1, 1), ["F", "O"]).select("granule_id", "west", "south")


@query(INDEX + "SELECT granule_id FROM idx WHERE cloud_fraction IS NULL OR cloud_fraction <= 0.5")
def filter_on_missing_keep(spark, d):
    return catalog.apply_filters(index(spark, d), [catalog.max_cloud(0.5, "keep")]).select("granule_id")


@query(INDEX + "SELECT granule_id FROM idx WHERE cloud_fraction <= 0.5")
def filter_on_missing_reject(spark, d):
    return catalog.apply_filters(index(spark, d), [catalog.max_cloud(0.5, "reject")]).select("granule_id")


@query(INDEX + "SELECT granule_id FROM idx WHERE month(acquired) IN (6, 7, 8)")
def month_in(spark, d):
    return catalog.apply_filters(index(spark, d), [catalog.month_in([6, 7, 8])]).select("granule_id")


@query(INDEX + "SELECT granule_id FROM idx WHERE trim(collection_version) IN ('1-URGENT', '2-HIGH')")
def column_in(spark, d):
    return catalog.apply_filters(index(spark, d), [catalog.column_in("collection_version", ["1-URGENT", "2-HIGH"])]).select("granule_id")


@query(INDEX + """, s AS (SELECT coalesce(cloud_fraction <= 0.5, false) AS a, month(acquired) IN (6, 7, 8) AS b, collection IN ('F', 'O') AS c FROM idx)
SELECT 1 AS step, count(*) AS reached, count(*) FILTER (NOT a) AS removed FROM s UNION ALL SELECT 2, count(*) FILTER (a), count(*) FILTER (a AND NOT b) FROM s
UNION ALL SELECT 3, count(*) FILTER (a AND b), count(*) FILTER (a AND b AND NOT c) FROM s""")
def filter_chain_report(spark, d):
    chain = [catalog.max_cloud(0.5, "reject"), catalog.month_in([6, 7, 8]), catalog.column_in("collection", ["F", "O"])]
    return catalog.filter_report(index(spark, d), chain).select("step", "reached", "removed")


@query(INDEX + """, one AS (SELECT site, collection, min(granule_id) AS g, max(CASE WHEN collection = 'F' THEN '' ELSE collection_version END) AS version FROM idx GROUP BY ALL)
SELECT site, arg_min(CASE WHEN version <> '' THEN version END, CASE WHEN version <> '' THEN collection END) AS version, string_agg(collection || '=' || g, ',' ORDER BY collection) AS assets FROM one GROUP BY site""")
def granule_level_view(spark, d):
    one = index(spark, d).groupBy("site", "collection").agg(F.min("granule_id").alias("g"), F.max(F.when(F.col("collection") == "F", "").otherwise(F.col("collection_version"))).alias("version"))
    one = one.withColumn("assets", F.create_map("collection", F.col("g").cast("string")))
    view = catalog.granule_view(one, ["version"], ["assets"], granule="site")
    return view.select("site", "version", F.array_join(F.array_sort(F.transform(F.map_entries("assets"), lambda e: F.concat_ws("=", e["key"], e["value"]))), ",").alias("assets"))


@query(INDEX + "SELECT granule_id, collection_version FROM idx WHERE collection_version = CASE collection WHEN 'F' THEN '1-URGENT' WHEN 'O' THEN '2-HIGH' ELSE '3-MEDIUM' END")
def version_pin(spark, d):
    return catalog.pin_versions(index(spark, d), {"F": "1-URGENT", "O": "2-HIGH", "P": "3-MEDIUM"}).select("granule_id", "collection_version")


@query(INDEX + "SELECT granule_id, price FROM idx WHERE collection <> 'P' AND collection_version <> '1-URGENT' UNION ALL SELECT granule_id, price + 1 FROM idx WHERE collection_version = '1-URGENT'")
def upsert_merge(spark, d):
    rows = index(spark, d).select(*catalog.ROW_KEY, "price")
    delta = rows.where("collection_version = '1-URGENT'").withColumn("price", F.col("price") + 1)
    return catalog.upsert(rows.where("collection <> 'P'"), delta).select("granule_id", "price")


@query(INDEX + """, own AS (SELECT collection, min(west) AS w, max(east) AS e, min(acquired) AS t0, max(acquired) AS t1 FROM idx GROUP BY 1)
SELECT collection, w <= -170 AND e >= 170 AND t0 <= TIMESTAMP '1997-01-01' AND t1 >= TIMESTAMP '1998-01-01' AS covered FROM own""")
def scope_containment(spark, d):
    idx = index(spark, d)
    wanted = idx.select("collection").distinct().select("collection", F.lit(-170.0).alias("west"), F.lit(-80.0).alias("south"), F.lit(170.0).alias("east"), F.lit(80.0).alias("north"), F.lit(datetime(1997, 1, 1)).alias("start"), F.lit(datetime(1998, 1, 1)).alias("end"))
    return catalog.scope_covers(idx, wanted)


@query(INDEX + """SELECT CASE WHEN collection <> '' AND collection_version <> '' AND collection <> 'P' THEN collection || '/' || collection_version ELSE 'only:' || granule_id END AS "group", count(*) AS n FROM idx GROUP BY 1""")
def vintage_groups(spark, d):
    return catalog.vintages(index(spark, d).withColumn("collection", F.when(F.col("collection") != "P", F.col("collection"))), ["collection", "collection_version"])


@query("SELECT c_custkey, n_regionkey + 1 AS class_id FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_nationkey <> 0 UNION ALL SELECT c_custkey, 0 FROM customer WHERE c_nationkey = 0")
def remap_lumping(spark, d):
    nations = table(spark, d, "nation").select("n_nationkey", "n_regionkey").collect()  # 25 rows: a class table
    lumps = [classes.ProductClass(r + 1, f"region {r}", tuple(n for n, x in nations if x == r and n != 0)) for r in sorted({r for _, r in nations})]
    t = classes.resolve(spark, [n for n, _ in nations], lumps)
    return classes.remap(table(spark, d, "customer"), t, "c_nationkey").select("c_custkey", "class_id")


@query("SELECT CASE WHEN c_nationkey = 0 THEN 0 WHEN c_nationkey <= 10 THEN c_nationkey ELSE -1 END AS class_id, count(*) AS n FROM customer GROUP BY 1")
def remap_unmapped_default(spark, d):
    t = classes.resolve(spark, range(11), [classes.ProductClass(k, str(k), (str(k),)) for k in range(1, 11)])
    return classes.remap(table(spark, d, "customer"), t, "c_nationkey").groupBy("class_id").agg(F.count("*").alias("n"))


@query("SELECT row_number() OVER (ORDER BY n_nationkey)::INT AS class_id, n_nationkey, CASE WHEN count(*) OVER (PARTITION BY r) > 1 THEN r || '#' || n_nationkey ELSE r END AS name FROM (SELECT n_nationkey, CASE WHEN n_nationkey < 3 THEN n_name ELSE r_name END AS r FROM nation JOIN region ON n_regionkey = r_regionkey)")
def identity_enum(spark, d):
    t = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return classes.identity(t.select("n_nationkey", F.when(F.col("n_nationkey") < 3, F.col("n_name")).otherwise(F.col("r_name")).alias("name")), "n_nationkey", "name")


# --- masks, joins, lattice -----------------------------------------------------------------------------------------------------


@query(LOOKS + "SELECT cell, oid, line, score FROM looks WHERE valid AND soil >= 0.3 AND vz <= 30")
def mask_conjunction(spark, d):
    rows = looks(spark, d).withColumn("low", -F.col("vz"))
    return resolve.apply_masks(rows, [resolve.at_least("soil", 0.3), resolve.at_least("low", -30)]).where("valid").select("cell", "oid", "line", "score")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_suppkey % 50 BETWEEN 7 AND 42")
def mask_edge_trim(spark, d):
    t = table(spark, d, "lineitem").withColumn("valid", F.lit(True)).withColumn("s_col", F.col("l_suppkey") % 50)
    return resolve.apply_masks(t, [resolve.edge_trim("s_col", 50, 7)]).where("valid").select("l_orderkey", "l_linenumber")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE NOT (l_tax > 0.04) AND NOT (l_discount > 0.05) AND NOT (l_suppkey % 9 - 1 BETWEEN 0 AND 2)")
def mask_flags_array(spark, d):
    t = table(spark, d, "lineitem").withColumn("valid", F.lit(True)).withColumn("away", F.col("l_suppkey") % 9 - 1)
    t = t.withColumn("flags", F.array(F.col("l_tax") - 0.04, F.col("l_quantity"), F.col("l_discount") - 0.05))
    t = t.withColumn("flags", F.array(F.when(F.col("l_tax") > 0.04, 1).otherwise(0), F.lit(1), F.when(F.col("l_discount") > 0.05, 1).otherwise(0)))
    return resolve.apply_masks(t, [resolve.flags_clear("flags", ["cloud", "water", "haze"], ["cloud", "haze"], "away", 2)]).where("valid").select("l_orderkey", "l_linenumber")


_TILES_SQL = "tiles AS (SELECT x * 12 + y AS tile, (x * 30 - 180)::DOUBLE AS w, (y * 15 - 90)::DOUBLE AS s, (x * 30 - 150)::DOUBLE AS e, (y * 15 - 75)::DOUBLE AS n FROM range(12) a(x), range(12) b(y))"


def _tiles(spark) -> DataFrame:
    x, y = F.floor(F.col("id") / 12), F.col("id") % 12
    r = spark.range(144).select(F.col("id").alias("tile"), (x * 30 - 180).cast("double").alias("r_west"), (y * 15 - 90).cast("double").alias("r_south"))
    return r.withColumn("r_east", F.col("r_west") + 30).withColumn("r_north", F.col("r_south") + 15)


_CANDIDATES = f"WITH {INDEX_SQL}, {_TILES_SQL} SELECT tile, year(acquired)::INT AS epoch, count(*) AS n FROM idx JOIN tiles ON west <= e AND east >= w AND south <= n AND north >= s GROUP BY ALL"


@query(_CANDIDATES)
def range_join_candidates(spark, d):
    met = lattice.box_join_plain(index(spark, d), _tiles(spark))
    return met.groupBy("tile", F.year("acquired").alias("epoch")).agg(F.count("*").alias("n"))


@query(_CANDIDATES)
def range_join_binned(spark, d):
    met = lattice.box_join(index(spark, d), _tiles(spark), 30.0)
    return met.groupBy("tile", F.year("acquired").alias("epoch")).agg(F.count("*").alias("n"))


_PIXELS_SQL = """pixels AS (SELECT s_suppkey % 3 AS granule, s_suppkey // 16 AS s_row, s_suppkey % 16 AS s_col, (s_suppkey * 37 % 211) / 211.0::DOUBLE * 20 AS px, (s_suppkey * 53 % 197) / 197.0::DOUBLE * 20 AS py FROM supplier),
cells AS (SELECT g AS granule, r AS row, c AS col, c + 0.5::DOUBLE AS x, r + 0.5::DOUBLE AS y FROM range(3) a(g), range(20) b(r), range(20) e(c)),
box AS (SELECT granule, min(px) AS x0, max(px) AS x1, min(py) AS y0, max(py) AS y1 FROM pixels GROUP BY 1),
near AS (SELECT c.granule, c.row, c.col, p.s_row, p.s_col, (x - px) * (x - px) + (y - py) * (y - py) AS d2 FROM cells c JOIN box b ON c.granule = b.granule AND x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1 JOIN pixels p ON p.granule = c.granule),
hits AS (SELECT *, d2 > 2.25 AS far FROM near QUALIFY row_number() OVER (PARTITION BY granule, row, col ORDER BY d2, s_row, s_col) = 1)"""


def _hits(spark, d) -> DataFrame:
    k = F.col("s_suppkey")
    pixels = table(spark, d, "supplier").select((k % 3).alias("granule"), F.floor(k / 16).alias("s_row"), (k % 16).alias("s_col"), ((k * 37 % 211) / 211 * 20).alias("px"), ((k * 53 % 197) / 197 * 20).alias("py"))
    i = F.col("id")
    cells = spark.range(1200).select(F.floor(i / 400).alias("granule"), F.floor(i % 400 / 20).alias("row"), (i % 20).alias("col"), (i % 20 + 0.5).cast("double").alias("x"), (F.floor(i % 400 / 20) + 0.5).cast("double").alias("y"))
    return lattice.nearest_pixels(cells, pixels, 3.0, 1.5)


@query(f"WITH {_PIXELS_SQL} SELECT granule, row, col, s_row, s_col, far FROM hits")
def knn_regrid(spark, d):
    return _hits(spark, d).drop("d2")


@query(f"""WITH {_PIXELS_SQL}, bad AS (SELECT granule, row + i AS row, col + j AS col FROM hits, range(-1, 2) a(i), range(-1, 2) b(j) WHERE far GROUP BY 1, 2, 3 HAVING count(*) >= 3)
SELECT granule, row, col, s_row, s_col, far FROM hits ANTI JOIN bad USING (granule, row, col)""")
def stencil_clean(spark, d):
    return lattice.clean_contiguous(_hits(spark, d)).drop("d2")


@query("SELECT p_partkey, p_partkey // 64 - 3 AS row, p_partkey % 64 + 5 AS col FROM part WHERE p_size % 4 <> 0 AND p_size % 5 <> 0 AND p_partkey // 64 - 3 BETWEEN 0 AND 19 AND p_partkey % 64 + 5 BETWEEN 0 AND 59")
def adopt_offset(spark, d):
    k = F.col("p_partkey")
    own = table(spark, d, "part").select("p_partkey", F.floor(k / 64).alias("row"), (k % 64).alias("col"), (F.col("p_size") % 4).alias("s_row"), (F.col("p_size") % 5).alias("s_col"))
    return lattice.adopt(own, -lattice.whole_offset(0.0, 3.0, 1.0), 5, 20, 60).select("p_partkey", "row", "col")


@query("""SELECT o_orderkey AS cell, l_linenumber AS s_col, CASE WHEN l_quantity > 45 THEN NULL ELSE l_quantity END AS depth, coalesce(l_quantity <= 45, false) AS valid
FROM (SELECT o_orderkey, 1 + o_orderkey % 3 AS s FROM orders) LEFT JOIN (SELECT l_orderkey, l_linenumber, max(l_quantity) AS l_quantity FROM lineitem GROUP BY 1, 2) ON l_orderkey = o_orderkey AND l_linenumber = s""")
def gather_equi(spark, d):
    pixels = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("granule"), F.col("l_linenumber").alias("s_col")).agg(F.max("l_quantity").alias("q"))
    pixels = pixels.select("granule", "s_col", F.col("s_col").alias("found"), F.when(F.col("q") <= 45, F.col("q")).alias("depth"))
    lookup = table(spark, d, "orders").select(F.col("o_orderkey").alias("granule"), (1 + F.col("o_orderkey") % 3).cast("int").alias("s_col"))
    return resolve.gather(lookup, pixels, ["depth"], ("granule", "s_col")).select(F.col("granule").alias("cell"), F.col("found").alias("s_col"), "depth", "valid")


@query(f"WITH {INDEX_SQL}, {_TILES_SQL} SELECT granule_id FROM idx WHERE EXISTS (SELECT 1 FROM tiles WHERE w BETWEEN -60 AND 59 AND s >= 0 AND west < e AND east > w AND south < n AND north > s)")
def semi_join_tile(spark, d):
    return lattice.box_semi_join(index(spark, d), _tiles(spark).where("r_west BETWEEN -60 AND 59 AND r_south >= 0"), 30.0, ["granule_id"]).select("granule_id")


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def anti_join_missing_role(spark, d):
    have = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.map_from_entries(F.collect_set(F.struct("l_returnflag", F.lit("x")))).alias("assets"))
    rows = table(spark, d, "orders").select("o_orderkey").join(have, "o_orderkey", "left").withColumn("assets", F.coalesce("assets", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))))
    return rows.join(catalog.has_roles(rows, "assets", ["R"]).select("o_orderkey"), "o_orderkey", "left_anti").select("o_orderkey")


@query("SELECT l_partkey AS cell, count(*) AS n, max(p_size) AS aux FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 10) ON l_partkey = p_partkey GROUP BY 1")
def aux_lookup(spark, d):
    aux = table(spark, d, "part").where("p_size > 10").select(F.col("p_partkey").alias("cell"), F.col("p_size").alias("aux"))
    return looks(spark, d).select("cell").join(aux, "cell", "left").groupBy("cell").agg(F.count("*").alias("n"), F.max("aux").alias("aux"))


@query(RASTER + ", fine AS (SELECT r AS row, c AS col FROM range(60) a(r), range(60) b(c)) SELECT f.row, f.col, s.cls FROM fine f LEFT JOIN raster s ON s.row = floor((f.row + 0.5) / 3) AND s.col = floor((f.col + 0.5) / 3)")
def resample_nearest(spark, d):
    fine = spark.range(3600).select(F.floor(F.col("id") / 60).alias("row"), (F.col("id") % 60).alias("col"))
    return resample.nearest(fine, raster(spark, d), 3, "cls")


@query(RASTER + "SELECT row // 4 AS row, col // 4 AS col, round(avg(CASE WHEN cls <= 45 THEN value END), 7) AS value FROM raster GROUP BY 1, 2")
def resample_average(spark, d):
    src = raster(spark, d).withColumn("value", F.when(F.col("cls") <= 45, F.col("value")))
    return resample.average(src, 4, "value").select("row", "col", F.round("value", 7).alias("value"))


@query(RASTER + "SELECT row, col, cls FROM (SELECT row // 4 AS row, col // 4 AS col, cls % 6 AS cls, count(*) AS n FROM raster GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY row, col ORDER BY n DESC, cls) = 1")
def resample_mode(spark, d):
    return resample.mode(raster(spark, d).withColumn("cls", F.col("cls") % 6), 4, "cls")


@query(RASTER + "SELECT row, col, CASE WHEN cls % 3 = 0 THEN value + 2 WHEN cls % 2 = 0 THEN value + 1 ELSE value END AS value FROM raster")
def composite_later_wins(spark, d):
    r = raster(spark, d)
    parts = [r, r.withColumn("value", F.when(F.col("cls") % 2 == 0, F.col("value") + 1)), r.withColumn("value", F.when(F.col("cls") % 3 == 0, F.col("value") + 2))]
    return resample.composite(parts, "value")


@query("""WITH e AS (SELECT user_id, ts, event_id, event_type, value FROM events), c AS (SELECT user_id, ts, max(value) AS value FROM e WHERE event_type = 'click' GROUP BY 1, 2)
SELECT e.event_id, c.value AS last_click FROM e ASOF LEFT JOIN c ON e.user_id = c.user_id AND e.ts >= c.ts WHERE e.event_type <> 'click'""")
def asof_previous(spark, d):
    e = table(spark, d, "events")
    clicks = e.where("event_type = 'click'").groupBy("user_id", "ts").agg(F.max("value").alias("last_click"))
    return resample.as_of(e.where("event_type <> 'click'").select("user_id", "ts", "event_id"), clicks, ["user_id"], "ts", "ts", "last_click").select("event_id", "last_click")


def _asof(name: str, direction: str, age: float | None) -> None:
    """Users' purchases and their clicks, in buckets of six hours."""
    def fresh(c: str) -> str:
        return c if age is None else f"CASE WHEN abs(epoch(e.ts) - epoch({c}.ts)) <= {age} THEN {c} END"

    sql = f"""WITH c AS (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'click' AND value IS NOT NULL GROUP BY 1, 2), e AS (SELECT user_id, ts, event_id FROM events WHERE event_type <> 'click'),
p AS (SELECT e.event_id, e.ts, {fresh("c")} AS r FROM e ASOF LEFT JOIN c ON e.user_id = c.user_id AND e.ts >= c.ts), n AS (SELECT e.event_id, {fresh("c")} AS r FROM e ASOF LEFT JOIN c ON e.user_id = c.user_id AND e.ts <= c.ts),
x AS (SELECT p.event_id, p.ts, CASE WHEN p.r.ts IS NOT NULL THEN p.r END AS a, CASE WHEN n.r.ts IS NOT NULL THEN n.r END AS b FROM p JOIN n USING (event_id))
SELECT event_id, {dict(previous="a.value", next="b.value", nearest="CASE WHEN b IS NULL OR epoch(ts) - epoch(a.ts) <= epoch(b.ts) - epoch(ts) THEN a.value ELSE b.value END")[direction]} AS click FROM x"""

    def run(spark, d):
        e = table(spark, d, "events")
        clicks = e.where("event_type = 'click'").select("user_id", F.col("ts").alias("at"), F.col("value").alias("click"))
        other = e.where("event_type <> 'click'").select("user_id", "ts", "event_id")
        return resample.as_of_by_buckets(other, clicks, ["user_id"], "ts", "at", "click", 21_600, direction, age).select("event_id", "click")

    query(sql, name)(run)


_asof("asof_bucketed", "previous", None)
_asof("asof_next", "next", None)
_asof("asof_nearest", "nearest", None)
_asof("asof_nearest_max_age", "nearest", 43_200)


# --- argmax, epochs, deliveries ------------------------------------------------------------------------------------------------

_ARGMAX = SNAPS + "SELECT cell, epoch, oid, line, strftime(acquired, '%Y-%m-%d') AS day, score, cls FROM won"


@query(_ARGMAX)
def argmax_streaming(spark, d):
    return resolve.winners(looks(spark, d), KEYS, LOOK_ORDER, ["cls"]).select("cell", "epoch", "oid", "line", day("acquired"), "score", "cls")


@query(_ARGMAX)
def argmax_stack(spark, d):
    return resolve.winners_by_window(looks(spark, d), KEYS, LOOK_ORDER, ["cls"]).select("cell", "epoch", "oid", "line", day("acquired"), "score", "cls")


@query(_ARGMAX)
def argmax_nan_excluded(spark, d):
    rows = looks(spark, d).withColumn("score", F.coalesce("score", F.lit(float("nan")))).withColumn("valid", F.lit(True))
    return resolve.winners(rows, KEYS, LOOK_ORDER, ["cls"]).select("cell", "epoch", "oid", "line", day("acquired"), "score", "cls")


def _delivered(align: str, before: int, after: int, window: str, every: int = 3, months: int = 24, name: str = ""):
    sql = f"""WITH m AS (SELECT k, DATE '1996-01-01' + (k * INTERVAL 1 MONTH) AS s FROM range({months}) t(k)), p AS (SELECT k FROM m WHERE k % {every} = 0),
n AS (SELECT date_trunc('month', l_shipdate)::DATE AS s, count(*) AS n FROM lineitem GROUP BY 1)
SELECT strftime(DATE '1996-01-01' + (p.k * INTERVAL 1 MONTH), '%Y-%m-%d') AS period, count(*) AS epochs, coalesce(sum(n.n), 0)::BIGINT AS looks FROM p JOIN m ON m.k >= p.k - {before} AND m.k < p.k + {every} + {after} LEFT JOIN n ON n.s = m.s GROUP BY 1"""

    def run(spark, d):
        end = datetime(1996 + months // 12, months % 12 + 1, 1)
        out = timeline.deliveries(datetime(1996, 1, 1), end, timeline.Duration.parse("P1M"), timeline.Duration.parse(f"P{every}M"), timeline.Duration.parse(window), align)
        bridge = spark.createDataFrame([(f"{p.start:%Y-%m-%d}", f"{e.start:%Y-%m}") for p in out for e in p.epochs], "period string, month string")
        n = looks(spark, d).groupBy(F.date_format("acquired", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"))
        return bridge.join(n, "month", "left").groupBy("period").agg(F.count("*").alias("epochs"), F.coalesce(F.sum("n"), F.lit(0)).alias("looks"))

    query(sql, name or f"delivery_{align}")(run)


for _a, _b, _c, _w in (("exact", 0, 0, "P3M"), ("trailing", 3, 0, "P6M"), ("leading", 0, 3, "P6M"), ("center", 1, 1, "P5M")):
    _delivered(_a, _b, _c, _w)
_delivered("center", 1, 2, "P6M", name="delivery_center_odd")
_delivered("center", 6, 6, "P13M", every=1, name="delivery_center_rolling")
_delivered("exact", 0, 0, "P3M", months=14, name="delivery_ragged_end")


# --- missing numbers ------------------------------------------------------------------------------------------------------------

_NAN_SQL = "n AS (SELECT *, CASE WHEN oid % 3 = 0 THEN NULL ELSE value END AS v, CASE WHEN oid % 5 = 0 THEN NULL ELSE soil END AS so FROM snaps)"


def _with_nan(rows: DataFrame) -> DataFrame:
    nan = F.lit(float("nan"))
    return rows.withColumn("v", F.when(F.col("oid") % 3 == 0, nan).otherwise(F.col("value"))).withColumn("so", F.when(F.col("oid") % 5 == 0, nan).otherwise(F.col("soil")))


@query(f"{SNAPS}, {_NAN_SQL} SELECT cell, round(max(v) FILTER (valid), 4) AS most, round(avg(v) FILTER (valid), 4) AS mean, round(median(v) FILTER (valid), 4) AS middle, round(stddev_pop(v) FILTER (valid), 4) AS spread, count(*) FILTER (valid) AS n FROM n GROUP BY cell")
def nan_values_reduced(spark, d):
    s = _with_nan(snaps(spark, d))
    parts = [reduce.continuous(s, ["cell"], "v", m).select("cell", F.round("value", 4).alias(c), *(["n"] if m == "max" else [])) for m, c in (("max", "most"), ("mean", "mean"), ("median", "middle"))]
    spread = reduce.continuous(s, ["cell"], "v", "mean", spread="std").select("cell", F.round("spread", 4).alias("spread"))
    return parts[0].join(parts[1], "cell").join(parts[2], "cell").join(spread, "cell")


@query(f"{SNAPS}, {_NAN_SQL} SELECT cell, epoch FROM n WHERE valid AND so >= 0.3")
def nan_fails_masks(spark, d):
    return resolve.apply_masks(_with_nan(snaps(spark, d)), [resolve.at_least("so", 0.3)]).where("valid").select("cell", "epoch")


@query(LOOKS + "SELECT cell, oid, line FROM looks WHERE valid AND cls <> 2")
def unmapped_class_invalidates(spark, d):
    rows = looks(spark, d).withColumn("kind", F.when(F.col("cls") == 2, classes.UNMAPPED).otherwise(F.col("cls")))
    return resolve.invalidate_unmapped(rows, ["kind"]).where("valid").select("cell", "oid", "line")


# --- reduction -----------------------------------------------------------------------------------------------------------------


def _vote_sql(tie="nodata", weight="count", ignore=(), min_count=1, min_weight=None, waiver=None, col="cls") -> str:
    prefer = {"earliest": "first ASC,", "latest": "last DESC,", "highest_score": "top DESC,"}.get(tie, "")
    shared = "count(*) FILTER (tally = t1) > 1" if tie == "nodata" else "false"
    shared2 = "count(*) FILTER (place > 1 AND tally = t2) > 1" if tie == "nodata" else "false"
    out_of = "p.n_epochs" if weight == "count" else "p.total"
    ignored = f"AND {col} NOT IN ({', '.join(map(str, ignore))})" if ignore else ""
    waived = f"AND NOT top1 >= {waiver}" if waiver is not None else ""
    light = f"OR t1 < {min_weight}" if min_weight is not None else ""
    return f"""{SNAPS},
p AS (SELECT cell, count(*) FILTER (valid) AS n_epochs, sum(score) FILTER (valid) AS total FROM snaps GROUP BY 1),
c AS (SELECT cell, {col} AS cls, count(*) AS cnt, {"count(*)::DOUBLE" if weight == "count" else "sum(score)"} AS tally, max(score) AS top, min(epoch) AS first, max(epoch) AS last FROM snaps WHERE valid {ignored} GROUP BY 1, 2),
o AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY tally DESC, {prefer} cls) AS place FROM c),
x AS (SELECT *, max(tally) FILTER (place = 1) OVER (PARTITION BY cell) AS t1, max(tally) FILTER (place = 2) OVER (PARTITION BY cell) AS t2 FROM o),
g AS (SELECT cell, max(t1) AS t1, max(cls) FILTER (place = 1) AS c1, max(cls) FILTER (place = 2) AS c2, max(cnt) FILTER (place = 1) AS n1, max(top) FILTER (place = 1) AS top1, {shared} AS shared, {shared2} AS shared2 FROM x GROUP BY 1),
w AS (SELECT *, NOT (shared OR (n1 < {min_count} {waived}) {light}) AS wins FROM g)
SELECT p.cell, CASE WHEN wins THEN c1 ELSE 65535 END AS winner, CASE WHEN wins AND c2 IS NOT NULL AND NOT shared2 THEN c2 ELSE 65535 END AS runner_up,
  CASE WHEN p.n_epochs = 0 THEN NULL WHEN t1 IS NULL OR {out_of} = 0 THEN 0.0 ELSE round(t1 / {out_of}, 6) END AS agreement, p.n_epochs
FROM p LEFT JOIN w USING (cell)"""


def _vote(name: str, **params):
    def run(spark, d):
        out = reduce.vote(snaps(spark, d), ["cell"], **params)
        return out.withColumn("agreement", F.round("agreement", 6))

    p = dict(params)
    if "min_count_unless_score" in p:
        p["waiver"] = p.pop("min_count_unless_score")
    query(_vote_sql(**p), name)(run)


_vote("vote_count_lowest_id", tie="lowest_id")
_vote("vote_earliest", tie="earliest")
_vote("vote_latest", tie="latest")
_vote("vote_highest_score", tie="highest_score", ignore=(0,))
_vote("vote_nodata", tie="nodata")
_vote("vote_min_count", tie="highest_score", ignore=(0,), min_count=4)
_vote("vote_min_count_waiver", tie="highest_score", ignore=(0,), min_count=4, min_count_unless_score=49.0)
_vote("vote_weight_score", tie="earliest", weight="score")
_vote("vote_min_weight", tie="earliest", weight="score", min_weight=120.0)
_vote("vote_ignore_none", tie="nodata", ignore=(0,))
_vote("vote_runner_up", tie="nodata", ignore=(0,), min_count=2)
_vote("vote_agreement", tie="latest", weight="score", ignore=(0,))


@query(SNAPS + "SELECT cell, arg_max(cls, {'s': score, 'e': -epoch}) FILTER (valid) AS best FROM snaps GROUP BY cell")
def best_cat(spark, d):
    return reduce.best(snaps(spark, d), ["cell"], "cls")


@query(SNAPS + "SELECT cell, first(value ORDER BY score DESC, epoch) FILTER (valid) AS best FROM snaps GROUP BY cell")
def best_cont(spark, d):
    return reduce.best(snaps(spark, d), ["cell"], "value")


def _stat(name: str, sql: str, n: str = "count(*) FILTER (valid)", extra: str = "", **params):
    def run(spark, d):
        out = reduce.continuous(snaps(spark, d), ["cell"], "value", **params)
        return out.select("cell", F.round("value", 4).alias("value"), "n", *([F.round("spread", 4).alias("spread")] if "spread" in params else []))

    query(f"{SNAPS} SELECT cell, round({sql}, 4) AS value, {n} AS n{extra} FROM snaps GROUP BY cell", name)(run)


_stat("reduce_median", "median(value) FILTER (valid)", method="median")
_stat("reduce_mean", "avg(value) FILTER (valid)", method="mean")
_stat("reduce_min", "min(value) FILTER (valid)", method="min")
_stat("reduce_max", "max(value) FILTER (valid)", method="max")
_stat("reduce_percentile", "quantile_cont(value, 0.25) FILTER (valid)", method="percentile", p=25)
_stat("reduce_inverse_variance", "sum(value / (unc * unc)) FILTER (valid AND unc > 0) / sum(1 / (unc * unc)) FILTER (valid AND unc > 0)", "count(*) FILTER (valid AND unc > 0)", method="inverse_variance", uncertainty="unc")
_stat("spread_std", "avg(value) FILTER (valid)", extra=", round(stddev_pop(value) FILTER (valid), 4) AS spread", method="mean", spread="std")
_stat("spread_iqr", "median(value) FILTER (valid)", extra=", round(quantile_cont(value, 0.75) FILTER (valid) - quantile_cont(value, 0.25) FILTER (valid), 4) AS spread", method="median", spread="iqr")


@query(SNAPS + ", w AS (SELECT *, score - min(score) OVER (PARTITION BY cell) + 1e-6 AS w FROM snaps WHERE valid) SELECT k.cell, round(sum(w * value) / sum(w), 4) AS value, count(w.cell) AS n FROM (SELECT DISTINCT cell FROM snaps) k LEFT JOIN w USING (cell) GROUP BY 1")
def reduce_score_weighted(spark, d):
    out = reduce.continuous(snaps(spark, d), ["cell"], "value", "score_weighted")
    return out.select("cell", F.round("value", 4).alias("value"), "n")


@query(f"WITH v AS ({_vote_sql(tie='highest_score', ignore=(0,))}), {SNAPS_SQL} SELECT s.cell, round(avg(value) FILTER (valid AND cls = winner), 4) AS value, count(*) FILTER (valid AND cls = winner) AS n FROM snaps s JOIN v USING (cell) GROUP BY 1")
def conditional_on(spark, d):
    s = snaps(spark, d)
    won = reduce.vote(s, ["cell"], tie="highest_score", ignore=(0,))
    return reduce.continuous(reduce.concordant(s, won, ["cell"]), ["cell"], "value", "mean").select("cell", F.round("value", 4).alias("value"), "n")


@query(SNAPS + "SELECT cell, count(*) FILTER (valid) AS n_epochs, count(*) AS n_observed FROM snaps GROUP BY cell")
def n_epochs_n_observed(spark, d):
    return reduce.epoch_counts(snaps(spark, d), ["cell"])


@query(f"WITH v AS ({_vote_sql(tie='highest_score', ignore=(0,))}) SELECT k::INT AS class_id, (SELECT count(*) FROM v WHERE winner = k) AS n_cells FROM range(6) t(k)")
def class_counts(spark, d):
    won = reduce.vote(snaps(spark, d), ["cell"], tie="highest_score", ignore=(0,))
    return reduce.class_counts(won, spark.range(6).select(F.col("id").cast("int").alias("class_id")), "winner")


def _score(name: str, column, sql: str):
    def run(spark, d):
        return looks(spark, d).select("cell", "oid", "line", F.round(column(), 6).alias("s"))

    query(f"{LOOKS} SELECT cell, oid, line, round({sql}, 6) AS s FROM looks", name)(run)


_cos, _nadir = "cos(radians(sz))", "(1 - least(abs(vz) / 15, 1))"
_score("score_view_zenith", lambda: scorers.nearest_nadir(F.col("vz")), "-vz")
_score("score_clean_nadir", lambda: scorers.clean_nadir(F.col("vz"), F.col("sz"), F.col("cls") == 3), "CASE WHEN cls <> 3 THEN -vz / 90 - CASE WHEN sz > 30 THEN 1.0 ELSE 0.0 END END")
_score("score_band_depth", lambda: scorers.strongest_band(F.col("soil")), "soil")
_score("score_bare_earth", lambda: scorers.bare_earth(F.col("soil"), F.col("sz")), f"CASE WHEN sz <= 70 AND soil >= 0.3 THEN soil + 0.25 * {_cos} END")
_score("score_bare_earth_nadir", lambda: scorers.bare_earth_nadir(F.col("soil"), F.col("sz"), F.col("vz"), below=0.5), f"CASE WHEN sz <= 70 AND vz <= 30 THEN (soil + 0.2 * {_cos} + 0.3 * {_nadir}) * CASE WHEN soil >= 0.3 THEN 1 ELSE 0.5 END END")
_score("score_low_vegetation", lambda: scorers.low_vegetation_nadir(F.col("soil"), F.col("sz"), F.col("vz")), f"CASE WHEN sz <= 70 AND vz <= 30 AND 1 - soil >= 1 - 0.6::DOUBLE THEN 1 - soil + 0.2 * {_cos} + 0.3 * {_nadir} END")


# --- ranks and composite reducers ----------------------------------------------------------------------------------------------

_AVG = "(rank() OVER (PARTITION BY cell, epoch ORDER BY {c}) - 1 + (count(*) OVER (PARTITION BY cell, epoch, {c}) - 1) / 2)"


@query(LOOKS + f"SELECT cell, epoch, oid, line, round(CASE WHEN count(*) OVER (PARTITION BY cell, epoch) = 1 THEN 0 ELSE {_AVG.format(c='vz')} / (count(*) OVER (PARTITION BY cell, epoch) - 1) END, 6) AS penalty FROM looks")
def rank_penalty(spark, d):
    return rank.rank_penalty(dealt_looks(spark, d, *KEYS), KEYS, "vz").select("cell", "epoch", "oid", "line", F.round("penalty", 6).alias("penalty"))


@query(LOOKS + f"SELECT cell, epoch, oid, line, 2.0 * (count(*) OVER (PARTITION BY cell, epoch) - 1) - {_AVG.format(c='vz')} - {_AVG.format(c='sz')} AS borda FROM looks")
def borda(spark, d):
    return rank.borda(dealt_looks(spark, d, *KEYS), KEYS, ["vz", "sz"]).select("cell", "epoch", "oid", "line", "borda")


@query(LOOKS + """, n AS (SELECT *, row_number() OVER (PARTITION BY cell, epoch ORDER BY acquired, oid, line, value) AS look FROM looks),
p AS (SELECT a.cell, a.epoch, a.look, CASE WHEN b.look IS NULL THEN 0.0 WHEN sign(b.vz - a.vz) + sign(b.sz - a.sz) + sign(b.unc - a.unc) > 0 THEN 1.0 WHEN sign(b.vz - a.vz) + sign(b.sz - a.sz) + sign(b.unc - a.unc) = 0 THEN 0.5 ELSE 0.0 END AS w
  FROM n a LEFT JOIN n b ON a.cell = b.cell AND a.epoch = b.epoch AND a.look <> b.look)
SELECT cell, epoch, look, sum(w) AS copeland FROM p GROUP BY 1, 2, 3""")
def copeland(spark, d):
    n = dealt_looks(spark, d, *KEYS).withColumn("look", F.row_number().over(Window.partitionBy(*KEYS).orderBy(*LOOK_ORDER, "value")))
    return rank.copeland(n, KEYS, "look", ["vz", "sz", "unc"])


@query(LOOKS + "SELECT cell, epoch, oid, line, dense_rank() OVER (PARTITION BY cell, epoch ORDER BY soil DESC, vz) AS lexical_rank FROM looks")
def lexical_rank(spark, d):
    return rank.lexical_rank(dealt_looks(spark, d, *KEYS), KEYS, [F.col("soil").desc(), F.col("vz").asc()]).select("cell", "epoch", "oid", "line", "lexical_rank")


QUERIES |= gated_cases.QUERIES | stage_cases.QUERIES | lattice_cases.QUERIES | picture_cases.QUERIES | record_cases.QUERIES
ORACLE_SQL |= gated_cases.ORACLE_SQL | stage_cases.ORACLE_SQL | lattice_cases.ORACLE_SQL | picture_cases.ORACLE_SQL | record_cases.ORACLE_SQL


@query(f"WITH a AS ({_vote_sql(tie='highest_score', ignore=(0,), min_count=3)}), b AS ({_vote_sql(tie='highest_score', ignore=(0,), min_count=3, col='cls2')}) SELECT cell, CASE WHEN a.winner <> 65535 THEN a.winner WHEN b.winner <> 65535 THEN b.winner ELSE 65535 END AS winner, CASE WHEN a.winner <> 65535 THEN 2 WHEN b.winner <> 65535 THEN 1 ELSE 0 END AS source, round(CASE WHEN a.winner <> 65535 THEN a.agreement WHEN b.winner <> 65535 THEN b.agreement END, 6) AS agreement FROM a JOIN b USING (cell)")
def joint_vote(spark, d):
    return reduce.joint_vote(snaps(spark, d), ["cell"], "cls", "cls2", min_count=3).withColumn("agreement", F.round("agreement", 6))


_FRACTIONS = [(1, "clay", 0.7), (1, "iron", 0.3), (2, "iron", 1.0), (3, "clay", 0.2), (3, "carbonate", 0.8)]


@query(SNAPS + f", f(class_id, output, fraction) AS (VALUES {', '.join(f'({a}, {b!r}, {c}::DOUBLE)' for a, b, c in _FRACTIONS)}), e AS (SELECT cell, epoch, output, sum(soil * fraction) AS x FROM snaps JOIN f ON cls = class_id WHERE valid GROUP BY 1, 2, 3) SELECT cell, output, round(median(x), 4) AS abundance, count(*) AS n FROM e GROUP BY 1, 2 HAVING count(*) >= 2")
def abundance(spark, d):
    f = spark.createDataFrame(_FRACTIONS, "class_id int, output string, fraction double")
    return reduce.abundance(snaps(spark, d, ("cls", "soil")), f, ["cell"], "soil", min_epochs=2, tasks=tasks(spark, d, "lineitem")).withColumn("abundance", F.round("abundance", 4))


@query(SNAPS + """, v AS (SELECT cell, count(*) FILTER (valid) AS nv FROM snaps GROUP BY 1),
c AS (SELECT cell, cls, count(*) AS n, sum(score) AS total, max(score) AS top, sum(score * soil) / sum(score) AS depth, first(epoch ORDER BY score DESC, epoch) AS e FROM snaps WHERE valid AND cls <> 0 GROUP BY 1, 2),
w AS (SELECT v.cell, nv, c.* EXCLUDE (cell), n >= least(2, greatest(nv, 1)) AS can FROM v LEFT JOIN c ON v.cell = c.cell QUALIFY row_number() OVER (PARTITION BY v.cell ORDER BY coalesce(n >= least(2, greatest(nv, 1)), false) DESC, round(total + 1e-7 * top, 9) DESC NULLS LAST, cls) = 1)
SELECT cell, CASE WHEN coalesce(can, false) THEN cls WHEN nv > 0 THEN 0 ELSE 65535 END AS winner, round(CASE WHEN can THEN depth END, 7) AS depth, CASE WHEN can THEN e END AS acquired, CASE WHEN coalesce(can, false) THEN n ELSE 0 END AS n_agree FROM w""")
def confirmed_vote(spark, d):
    out = reduce.confirmed_vote(snaps(spark, d), ["cell"], "soil", acquired="epoch")
    return out.withColumn("depth", F.round("depth", 7))


# --- spectra -------------------------------------------------------------------------------------------------------------------

_WAVES = [400.0 + 10 * k for k in range(64)]
_LEFT, _RIGHT, _CENTRE = [10, 11, 12], [30, 31, 32], [20, 21, 22]
_SPEC = """WITH s AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE + 2) AS v FROM embeddings), m AS (SELECT *, (v[11] + v[12] + v[13]) / 3 AS a, (v[31] + v[32] + v[33]) / 3 AS b FROM s),
r AS (SELECT vec_id, list_transform([20, 21, 22], lambda k: CASE WHEN a + (b - a) * (400 + 10 * k - 510) / 200 > 0 THEN v[k + 1] / (a + (b - a) * (400 + 10 * k - 510) / 200) END) AS q FROM m) """


def _spectra(spark, d) -> DataFrame:
    return table(spark, d, "embeddings").withColumn("v", F.transform("embedding", lambda x: x.cast("double") + 2))


@query(_SPEC + "SELECT vec_id, round(q[1], 5) AS q0, round(q[2], 5) AS q1, round(q[3], 5) AS q2 FROM r")
def continuum_removed(spark, d):
    q = spectra.continuum_removed(F.col("v"), _WAVES, _LEFT, _RIGHT, _CENTRE)
    return _spectra(spark, d).withColumn("q", q).select("vec_id", *[F.round(F.col("q")[k], 5).alias(f"q{k}") for k in range(3)])


@query(_SPEC + "SELECT vec_id, round(1 - (q[1] + q[2] + q[3]) / 3, 5) AS depth FROM r")
def band_depth(spark, d):
    return _spectra(spark, d).select("vec_id", F.round(spectra.band_depth(F.col("v"), _WAVES, _LEFT, _RIGHT, _CENTRE), 5).alias("depth"))


def _cube(spark, d, bands: int) -> DataFrame:
    k = F.col("vec_id")
    return table(spark, d, "embeddings").select((k % 2).alias("granule"), F.floor(k / 40).alias("row"), (k % 40).alias("col"), F.floor(k / 40).alias("s_row"), (k % 40).alias("s_col"), F.slice("embedding", 1, bands).alias("reflectance"))


_TARGET = [0.4, -0.3]
#: Two bands, so that the filter has a closed form; tests/test_moments.py holds more bands against NumPy.
_CUBE_SQL = "cube AS (SELECT vec_id % 2 AS granule, vec_id // 40 AS r, vec_id % 40 AS c, embedding[1]::DOUBLE AS x1, embedding[2]::DOUBLE AS x2, embedding[:6]::DOUBLE[] AS v FROM embeddings)"


def _solved_sql(rows: str, keys: str) -> str:
    return f"""SELECT {keys}, n, m1, m2, v1 / (s1 * v1 + s2 * v2) AS w1, v2 / (s1 * v1 + s2 * v2) AS w2 FROM (
  SELECT *, (d * s1 - b * s2) / (a * d - b * b) AS v1, (a * s2 - b * s1) / (a * d - b * b) AS v2 FROM (
    SELECT * EXCLUDE (a, d), a + (a + d) / 2 * 1e-9 AS a, d + (a + d) / 2 * 1e-9 AS d, 0.4 - m1 AS s1, -0.3 - m2 AS s2 FROM (
      SELECT {keys}, count(*) AS n, avg(x1) AS m1, avg(x2) AS m2, var_samp(x1) AS a, var_samp(x2) AS d, 0.95 * covar_samp(x1, x2) AS b FROM {rows} GROUP BY ALL) WHERE n >= 20))"""


_NEAR_SQL = f"""WITH {_CUBE_SQL}, near AS (SELECT *, (1 - abs(r - kr * 10) / 10.0::DOUBLE) * (1 - abs(c - kc * 10) / 10.0::DOUBLE) AS t FROM (SELECT *, r // 10 + i AS kr, c // 10 + j AS kc FROM cube, range(2) y(i), range(2) z(j)) WHERE abs(r - kr * 10) < 10 AND abs(c - kc * 10) < 10),
f AS ({_solved_sql("near", "granule, kr, kc")})"""
_BLEND_SQL = "SELECT n.granule, r AS row, c AS col, round(sum(t * (w1 * (x1 - m1) + w2 * (x2 - m2))) / sum(t) FILTER (g.n IS NOT NULL), 6) AS mf, round(sum(t * g.n) / sum(t) FILTER (g.n IS NOT NULL), 6) AS bg_n FROM near n LEFT JOIN {f} g ON n.granule = g.granule AND n.kr = g.kr AND n.kc = g.kc GROUP BY n.granule, r, c"


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in ("mf", "bg_n")})


@query(_NEAR_SQL + " " + _BLEND_SQL.format(f="f"))
def mf_window(spark, d):
    return _rounded(moments.window_filter(_cube(spark, d, 2), _TARGET, 10))


@query(f"""{_NEAR_SQL}, y AS (SELECT near.*, w1 * (x1 - m1) + w2 * (x2 - m2) AS y FROM near JOIN f USING (granule, kr, kc)),
kept AS (SELECT * FROM y QUALIFY y <= quantile_cont(y, 0.9) OVER (PARTITION BY granule, kr, kc)), again AS ({_solved_sql("kept", "granule, kr, kc")}),
best AS (SELECT granule, kr, kc, coalesce(a.n, f.n) AS n, coalesce(a.m1, f.m1) AS m1, coalesce(a.m2, f.m2) AS m2, coalesce(a.w1, f.w1) AS w1, coalesce(a.w2, f.w2) AS w2 FROM f LEFT JOIN again a USING (granule, kr, kc))
""" + _BLEND_SQL.format(f="best"))
def mf_window_trimmed(spark, d):
    return _rounded(moments.window_filter(_cube(spark, d, 2), _TARGET, 10, trim=0.1))


@query(f"""WITH {_CUBE_SQL}, k AS (SELECT granule, c, count(*) AS n FROM cube GROUP BY 1, 2),
near AS (SELECT a.granule, a.c AS c, b.c AS o, abs(a.c - b.c) AS far, sum(b.n) OVER (PARTITION BY a.granule, a.c ORDER BY abs(a.c - b.c)) AS upto FROM k a JOIN k b ON a.granule = b.granule AND abs(a.c - b.c) <= 64),
reach AS (SELECT granule, c, min(far) AS most FROM near WHERE upto >= 20 GROUP BY 1, 2), pool AS (SELECT n.granule, n.c, x1, x2 FROM near n JOIN reach USING (granule, c) JOIN cube x ON x.granule = n.granule AND x.c = n.o WHERE far <= most),
f AS ({_solved_sql("pool", "granule, c")})
SELECT cube.granule, r AS s_row, cube.c AS s_col, round(w1 * (x1 - m1) + w2 * (x2 - m2), 6) AS mf, round(n, 6)::DOUBLE AS bg_n FROM cube LEFT JOIN f ON cube.granule = f.granule AND cube.c = f.c""")
def mf_column(spark, d):
    return _rounded(moments.column_filter(_cube(spark, d, 2), _TARGET))


@query(f"""WITH {_CUBE_SQL}, s AS (SELECT granule, b, sqrt(var_pop(v[b] - (v[b - 1] + v[b + 1]) / 2) / 1.5) AS s FROM cube, range(2, 6) t(b) GROUP BY 1, 2),
e AS (SELECT granule, b, s FROM s UNION ALL SELECT granule, CASE b WHEN 2 THEN 1 ELSE 6 END, s FROM s WHERE b IN (2, 5))
SELECT granule, b AS band, round(greatest(s, median(s) OVER (PARTITION BY granule) * 1e-3, 1e-12), 8) AS sigma FROM e""")
def noise_sigma(spark, d):
    found = moments.noise(moments.moments(_cube(spark, d, 6), ["granule"], "reflectance"), ["granule"])
    return found.select("granule", F.posexplode("sigma").alias("band", "sigma")).select("granule", (F.col("band") + 1).alias("band"), F.round("sigma", 8).alias("sigma"))


# --- publishing ----------------------------------------------------------------------------------------------------------------


@query(RASTER + "SELECT r.r AS row, c.c AS col, coalesce(cls, 65535) AS cls, value FROM range(40) r(r) CROSS JOIN range(64) c(c) LEFT JOIN raster ON row = r.r AND col = c.c")
def tile_stitch(spark, d):
    r = raster(spark, d)
    blocks = r.where("row < 10").unionByName(r.where("row >= 10 AND row < 40"))
    tile = spark.range(2560).select(F.floor(F.col("id") / 64).alias("row"), (F.col("id") % 64).alias("col"))
    return publish.filled(publish.stitch(blocks), tile, ["cls"])


@query(RASTER + "SELECT row // 4 AS row, col // 4 AS col, cls FROM raster WHERE row % 4 = 2 AND col % 4 = 2")
def overview_nearest(spark, d):
    return resample.overview(raster(spark, d), 2, "cls", True)


@query(RASTER + "SELECT row // 4 AS row, col // 4 AS col, round(avg(value), 7) AS value FROM raster GROUP BY 1, 2")
def overview_average(spark, d):
    return resample.overview(raster(spark, d), 2, "value", False).withColumn("value", F.round("value", 7))


_COLORS = {1: (200, 10, 20), 2: (30, 220, 40), 7: (1, 2, 3)}


@query(RASTER + "SELECT row, col, CASE cls WHEN 1 THEN 200 WHEN 2 THEN 30 WHEN 7 THEN 1 ELSE 0 END AS r, CASE cls WHEN 1 THEN 10 WHEN 2 THEN 220 WHEN 7 THEN 2 ELSE 0 END AS g, CASE cls WHEN 1 THEN 20 WHEN 2 THEN 40 WHEN 7 THEN 3 ELSE 0 END AS b, CASE WHEN cls IN (1, 2, 7) THEN 255 ELSE 0 END AS a FROM raster")
def colour_map_categorical(spark, d):
    return publish.categorical_colors(raster(spark, d), "cls", _COLORS, "transparent").drop("cls", "value")


@query("""SELECT k::INT AS cls, round_even(255 * CASE i WHEN 0 THEN v WHEN 1 THEN q WHEN 2 THEN p WHEN 3 THEN p WHEN 4 THEN t ELSE v END, 0)::INT AS r, round_even(255 * CASE i WHEN 0 THEN t WHEN 1 THEN v WHEN 2 THEN v WHEN 3 THEN q ELSE p END, 0)::INT AS g, round_even(255 * CASE i WHEN 0 THEN p WHEN 1 THEN p WHEN 2 THEN t WHEN 3 THEN v WHEN 4 THEN v ELSE q END, 0)::INT AS b
FROM (SELECT k, floor(h * 6)::INT AS i, 0.9::DOUBLE AS v, 0.9::DOUBLE * 0.35::DOUBLE AS p, 0.9::DOUBLE * (1 - 0.65::DOUBLE * (h * 6 - floor(h * 6))) AS q, 0.9::DOUBLE * (1 - 0.65::DOUBLE * (1 - h * 6 + floor(h * 6))) AS t FROM (SELECT k, k * 0.618033988749895::DOUBLE - floor(k * 0.618033988749895::DOUBLE) AS h FROM (SELECT DISTINCT p_partkey % 400 + 1 AS k FROM part)))""")
def colour_palette(spark, d):
    return table(spark, d, "part").select((F.col("p_partkey") % 400 + 1).cast("int").alias("cls")).distinct().select("cls", *[C.id_color(F.col("cls"))[k].alias(c) for k, c in enumerate("rgb")])


@query(RASTER + ", s AS (SELECT row, col, (value - 900) / 200.0::DOUBLE AS t, value BETWEEN 900 - 0.0011 AND 1100 + 0.0011 AS shown FROM raster) SELECT row, col, CASE WHEN shown THEN round_even(255 * least(greatest(t, 0), 1), 0)::INT ELSE 0 END AS r, CASE WHEN shown THEN round_even(255 - 255 * least(greatest(t, 0), 1), 0)::INT ELSE 0 END AS g, CASE WHEN shown THEN 10 ELSE 0 END AS b, CASE WHEN shown THEN 255 ELSE 0 END AS a FROM s")
def ramp_continuous(spark, d):
    return publish.continuous_colors(raster(spark, d), "value", (900, 1100), ((0.0, 0, 255, 10), (1.0, 255, 0, 10)), clip=False).drop("cls", "value")


@query(RASTER + "SELECT row, col, CASE WHEN cls > 40 THEN 0 ELSE round_even(20 + 200 * least(greatest((value - 900) / 200.0::DOUBLE, 0), 1), 0)::INT END AS a FROM raster")
def alpha_from(spark, d):
    value = F.when(F.col("cls") <= 40, F.col("value"))
    return raster(spark, d).select("row", "col", publish.alpha_from(value, (900, 1100), (20, 220)).alias("a"))


@query(SNAPS + ", b AS (SELECT cell, first(oid ORDER BY score DESC, epoch) AS oid, first(acquired ORDER BY score DESC, epoch) AS acquired FROM snaps WHERE valid GROUP BY 1), g AS (SELECT acquired, min(oid) AS granule_id FROM looks GROUP BY 1), m AS (SELECT cell, granule_id FROM b JOIN g USING (acquired)) SELECT cell, granule_id, dense_rank() OVER (ORDER BY granule_id)::INT AS granule_no FROM m")
def granule_band(spark, d):
    s = snaps(spark, d).where("valid")
    cells = s.groupBy("cell").agg(F.max_by("acquired", F.struct("score", (-F.col("epoch")).alias("e"))).alias("acquired"))
    granules = looks(spark, d).select(F.col("oid").alias("granule_id"), "acquired")
    return publish.granule_band(cells, granules).select("cell", "granule_id", "granule_no")


@query(RASTER + "SELECT round(quantile_cont(value, 0.02), 4) AS lo, round(quantile_cont(value, 0.98), 4) AS hi FROM raster")
def stretch_p2_p98(spark, d):
    return publish.stretch(raster(spark, d), "value").select(F.round("lo", 4).alias("lo"), F.round("hi", 4).alias("hi"))


@query("SELECT x, y, x / 16.0::DOUBLE * 360 - 180 AS west, round(degrees(atan(sinh(pi() * (1 - 2 * (y + 1) / 16.0::DOUBLE)))), 6) AS south, round(degrees(atan(sinh(pi() * (1 - 2 * y / 16.0::DOUBLE)))), 6) AS north FROM (SELECT DISTINCT c_custkey % 16 AS x, c_custkey // 16 % 16 AS y FROM customer)")
def tile_bounds_mercator(spark, d):
    tiles = table(spark, d, "customer").select((F.col("c_custkey") % 16).alias("x"), F.floor(F.col("c_custkey") / 16 % 16).alias("y")).distinct()
    b = C.mercator_tile(F.lit(4), F.col("x"), F.col("y"))
    return tiles.select("x", "y", b["west"].alias("west"), F.round(b["south"], 6).alias("south"), F.round(b["north"], 6).alias("north"))


# --- work lists ----------------------------------------------------------------------------------------------------------------

_WORK_SQL = f"""WITH {INDEX_SQL}, g AS (SELECT *, unnest(generate_series(floor((west + 180) / 5)::BIGINT, (ceil((east + 180) / 5) - 1)::BIGINT)) AS tx FROM idx),
h AS (SELECT *, unnest(generate_series(floor((south + 90) / 5)::BIGINT, (ceil((north + 90) / 5) - 1)::BIGINT)) AS ty FROM g),
work AS (SELECT granule_id, tx, ty, round((least(east, tx * 5 - 175) - greatest(west, tx * 5 - 180)) * (least(north, ty * 5 - 85) - greatest(south, ty * 5 - 90)) / 4 * 1000)::BIGINT AS cost FROM h),
costs AS (SELECT tx, ty, count(*) AS granules, sum(cost)::BIGINT AS cost, max(cost) AS longest FROM work GROUP BY 1, 2)"""


def _work(spark, d) -> DataFrame:
    return worklist.work_list(index(spark, d).select("granule_id", "west", "south", "east", "north"), 5, weight=1000)


@query(_WORK_SQL + " SELECT granule_id, tx, ty, cost FROM work")
def work_list(spark, d):
    return _work(spark, d).select("granule_id", "tx", "ty", "cost")


@query(_WORK_SQL + " SELECT count(*) AS tiles, sum(granules)::BIGINT AS items, sum(cost)::BIGINT AS cost, max(cost) AS heaviest, max(longest) AS longest, max(granules) * 250000 * 6 AS peak_bytes FROM costs")
def work_estimate(spark, d):
    return worklist.estimate(worklist.tile_costs(_work(spark, d)), 250_000, 6)


@query(_WORK_SQL + """ SELECT tx, ty, granules, cost, greatest(ceil(cost / 4000), 1)::BIGINT AS parts,
CASE WHEN cost <= 4000 THEN floor(coalesce(sum(CASE WHEN cost <= 4000 THEN cost ELSE 0 END) OVER (PARTITION BY tx // 16, ty // 16 ORDER BY ty, tx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / 4000)::BIGINT END AS bundle FROM costs""")
def work_layout(spark, d):
    """Heavy tiles split, light ones bundled."""
    return worklist.lay_out(worklist.tile_costs(_work(spark, d)), 4000).select("tx", "ty", "granules", "cost", "parts", "bundle")


# --- streaming extensions ------------------------------------------------------------------------------------------------------


def _stream(spark, d) -> DataFrame:
    path = f"{d}/events.parquet"
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).parquet(path if path.startswith("dir:") else f"{d}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))


@query("SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n, round(sum(value), 3) AS total FROM events GROUP BY 1, 2")
def stream_tumbling(spark, d):
    from cellweave.streaming import windows

    out = windows.drain(windows.tumbling(_stream(spark, d), "ts", "1 day", "60 days", ["event_type"], "value"), "stream_tumbling", "complete")
    return out.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "event_type", "n", F.round("total", 3).alias("total"))


@query("SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, user_id, max(value) AS value, arg_min(event_id, {'v': -value, 'e': event_id}) AS event_id FROM events WHERE value IS NOT NULL GROUP BY 1, 2")
def stream_running_argmax(spark, d):
    from cellweave.streaming import windows

    out = windows.drain(windows.running_best(_stream(spark, d), "ts", "1 day", "60 days", ["user_id"], ["event_id"], "value"), "stream_running_argmax", "complete")
    return out.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "user_id", "value", "event_id")


# An event arrives as many hours after its time as its value says; a batch is four days of arrivals, the delay 36 hours.
_ARRIVALS_SQL = """a AS (SELECT *, date_trunc('day', ts) AS day, date_diff('day', DATE '2020-01-01', (ts + to_microseconds((value * 3600000000)::BIGINT))::DATE) // 4 AS arrived FROM events WHERE ts IS NOT NULL AND value IS NOT NULL),
b AS (SELECT arrived, epoch_ms(max(ts)) - 129600000 AS m FROM a GROUP BY 1),
w AS (SELECT arrived, max(m) OVER (ORDER BY arrived ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mark FROM b),
t AS (SELECT a.*, coalesce(epoch_ms(day + INTERVAL 1 DAY) <= mark, false) AS late, epoch_ms(day + INTERVAL 1 DAY) < (SELECT max(m) FROM b) AS ended FROM a JOIN w USING (arrived))"""
_USER, _EVENT = ["user_id"], ["event_id"]


def _late_run(spark, d) -> DataFrame:
    from cellweave.streaming import late

    events = table(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_id", "value").where("ts IS NOT NULL AND value IS NOT NULL")
    at = F.timestamp_micros(F.unix_micros("ts") + F.round(F.col("value") * 3_600_000_000).cast("bigint"))
    root = late.scratch(spark, "late")
    stream = late.replay(events.withColumn("arrived", F.floor(F.datediff(at, F.lit("2020-01-01").cast("date")) / 4).cast("int")), "arrived", f"{root}/arrivals", 8)
    n = tasks(spark, d, "events", 1 / 4)  # a task has a few thousand of a batch's rows
    return late.run(late.best_or_late(stream, "ts", 1, "36 hours", _USER, _EVENT, "value", salts=2, parts=2 * n), f"{root}/out", f"{root}/checkpoint", n)


def _micros_day(c: str):
    return F.date_format(F.timestamp_micros(c), "yyyy-MM-dd").alias("day")


@query(f"WITH {_ARRIVALS_SQL} SELECT strftime(day, '%Y-%m-%d') AS day, count(*) FILTER (NOT late) AS kept, count(*) FILTER (late) AS late, count(DISTINCT user_id) FILTER (NOT late) AS expired FROM t WHERE late OR ended GROUP BY 1")
def stream_late_counts(spark, d):
    """Looks kept, looks that came late, and states that timers closed, by day."""
    out = _late_run(spark, d)
    final = F.col("kind") == "final"
    counts = [F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).alias(k) for k, c in (("kept", final), ("late", ~final))]
    return out.groupBy(_micros_day("epoch_us")).agg(*counts, F.countDistinct(F.when(final, F.col("user_id"))).alias("expired"))


@query(f"WITH {_ARRIVALS_SQL} SELECT strftime(day, '%Y-%m-%d') AS day, user_id, max(value) AS value, arg_min(event_id, {{'v': -value, 'e': event_id}}) AS event_id, count(*) AS n FROM t WHERE late OR ended GROUP BY 1, 2")
def stream_late_upsert(spark, d):
    """The best look of each user and ended day after late looks were merged into the delivered ones."""
    from cellweave.streaming import late

    out = _late_run(spark, d)
    merged = late.with_late(late.closed(out, _USER, _EVENT), out.where("kind = 'late'"), _USER, _EVENT)
    return merged.select(_micros_day("epoch_us"), "user_id", F.col("score").alias("value"), "event_id", "n")


@query(f"""WITH {LOOKS_SQL}, a AS (SELECT *, CASE WHEN epoch < 1998 THEN '1996-01-01' ELSE '1998-01-01' END AS period FROM looks WHERE acquired >= TIMESTAMP '1996-01-01' AND acquired < TIMESTAMP '2000-01-01'),
w AS (SELECT * FROM a WHERE valid QUALIFY row_number() OVER (PARTITION BY cell, epoch ORDER BY score DESC, acquired, oid, line) = 1),
o AS (SELECT cell, period, count(DISTINCT epoch) AS n_observed FROM a GROUP BY 1, 2)
SELECT o.cell, o.period, first(w.cls ORDER BY w.score DESC, w.epoch) FILTER (w.cell IS NOT NULL) AS kind, round(avg(w.value), 7) AS price, count(w.cell) AS price_n, count(w.cell) AS n_epochs, max(n_observed) AS n_observed
FROM o LEFT JOIN w USING (cell, period) GROUP BY 1, 2""")
def deliver_run(spark, d):
    from cellweave.plans.manifest import Manifest, deliver

    doc = {
        "run_id": "two-years",
        "box": (-10, -10, 10, 10),
        "time": {"start": datetime(1996, 1, 1), "end": datetime(2000, 1, 1), "epoch": "P1Y", "deliver_every": "P2Y"},
        "layers": [{"name": "kind", "kind": "categorical", "source": "cls", "aggregate": "best"}, {"name": "price", "kind": "continuous", "source": "value", "aggregate": "mean"}],
    }
    out = deliver(Manifest.from_document(doc), looks(spark, d))
    return out.withColumn("period", F.date_format("period", "yyyy-MM-dd")).withColumn("price", F.round("price", 7))
