"""Timelines, classes, catalogue, lattice, resampling, spectra, publishing, run descriptions and streams."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cellweave.functions import columns
from cellweave.functions.timeline import Duration, deliveries, epochs
from cellweave.operators import catalog, classes, gated, lattice, publish, rank, resample, resolve
from cellweave.plans import gated_cases
from cellweave.plans.manifest import Budget, Grid, Manifest, ManifestError, deliver, identity, key_difference, reuse_or_write
from cellweave.sources import tables

SF = "/root/testdata/sf0.001"


def test_durations_dont_compound():
    start, month = datetime(2026, 1, 31), Duration.parse("P1M")
    assert [month.after(start, k).day for k in range(4)] == [31, 28, 31, 30]
    assert Duration.parse("P1Y2M1W3D") == Duration(14, 10)
    for bad in ("P", "1M", "PT1H", "P0D"):
        with pytest.raises(ValueError):
            Duration.parse(bad)


def test_epochs_and_deliveries():
    month = Duration.parse("P1M")
    es = epochs(datetime(2026, 1, 10), datetime(2026, 6, 1), month, "calendar")
    assert [e.start.month for e in es] == [2, 3, 4, 5] and datetime(2026, 3, 1) in es[1] and datetime(2026, 4, 1) not in es[1]
    assert len(epochs(datetime(2026, 1, 10), datetime(2026, 6, 1), month, "calendar", partial=True)) == 5
    year = (datetime(2026, 1, 1), datetime(2027, 1, 1))
    for align, window, want in (("exact", None, [(1, 3), (4, 6), (7, 9), (10, 12)]), ("trailing", "P6M", [(1, 3), (1, 6), (4, 9), (7, 12)]), ("leading", "P6M", [(1, 6), (4, 9), (7, 12), (10, 12)]), ("center", "P5M", [(1, 4), (3, 7), (6, 10), (9, 12)])):
        got = deliveries(*year, month, Duration.parse("P3M"), Duration.parse(window) if window else None, align)
        assert [(p.epochs[0].start.month, p.epochs[-1].start.month) for p in got] == want
    assert [len(p.epochs) for p in deliveries(*year, month, month, Duration.parse("P2M"), "center")] == [2] * 11 + [1]
    rolling = deliveries(datetime(2022, 1, 1), datetime(2024, 1, 1), month, month, Duration.parse("P13M"), "center")
    assert [len(p.epochs) for p in rolling] == [7, 8, 9, 10, 11, 12] + [13] * 12 + [12, 11, 10, 9, 8, 7]
    week, p2 = Duration.parse("P7D"), Duration.parse("P2M")
    assert [len(p.epochs) for p in deliveries(datetime(2026, 1, 1), datetime(2026, 3, 1), week, month)] == [4, 3]
    assert [len(p.epochs) for p in deliveries(datetime(2022, 1, 1), datetime(2024, 3, 1), p2, Duration.parse("P13M"))] == [6, 6]
    for bad in ((p2, month, Duration.parse("P13M"), "center"), (week, month, month, "trailing"), (month, Duration.parse("P1Y"), month, "trailing"), (month, month, Duration.parse("P13M"), "exact")):
        with pytest.raises(ValueError):
            deliveries(*year, *bad)
    with pytest.raises(ValueError):
        epochs(datetime(2026, 1, 1), datetime(2026, 1, 1), month)
    assert Duration.parse("P1Y") == Duration.parse("P12M") and Duration.parse("P1M").parts_of(Duration.parse("P30D")) is None


def test_class_tables(spark):
    two = [classes.ProductClass(1, "a", (7,)), classes.ProductClass(2, "b", ("5", 6))]
    t = classes.resolve(spark, [0, 5, 6, 7, 9], two, rest=3)
    assert {r.raw: r.class_id for r in t.collect()} == {0: 0, 5: 2, 6: 2, 7: 1, 9: 3}
    for bad in ([classes.ProductClass(1, "a", (8,))], [classes.ProductClass(1, "a", (5,)), classes.ProductClass(2, "b", (5,))], two, [classes.ProductClass(0, "a", (5,))]):
        with pytest.raises(ValueError):
            classes.resolve(spark, [0, 5, 6, 7, 9], bad)
    assert classes.fingerprint([(1, "a"), (2, "b")]) == classes.fingerprint([(2, "b"), (1, "a")]) != classes.fingerprint([(1, "a")])
    rows = spark.createDataFrame([(0,), (5,), (8,), (None,)], "raw_class int")
    assert [r.class_id for r in classes.remap(rows, t, "raw_class").orderBy("raw_class").collect()] == [-1, 0, 2, -1]


def test_catalogue_rules(spark):
    idx = spark.createDataFrame([("g1", "a", "1", 0.2, {"x": "1"}), ("g1", "b", "", None, {"x": "2", "y": "3"}), ("g2", "b", "2", None, {})], "granule_id string, collection string, collection_version string, cloud_fraction double, attributes map<string,string>")
    with pytest.raises(ValueError, match="2 rows"):
        catalog.apply_filters(idx, [catalog.max_cloud(0.5)])
    assert catalog.apply_filters(idx, [catalog.max_attribute("x", 1.5, "reject")]).count() == 1
    view = {r.granule_id: r for r in catalog.granule_view(idx, ["collection_version", "cloud_fraction"], ["attributes"]).collect()}
    assert view["g1"].attributes == {"x": "1", "y": "3"} and view["g1"].collection_version == "1" and view["g2"].cloud_fraction is None
    with pytest.raises(ValueError, match="pin"):
        catalog.pin_versions(idx, {})
    assert catalog.pin_versions(idx, {"b": "2"}).count() == 2
    assert catalog.has_roles(idx, "attributes", ["x", "y"]).count() == 1
    assert {r.group: r.n for r in catalog.vintages(idx, ["collection_version"]).collect()} == {"1": 1, "2": 1, "only:g1": 1}


def test_catalogue_json_and_index_round_trip(spark, tmp_path):
    doc = {"GranuleUR": "G1", "CollectionReference": {"ShortName": "C", "Version": "001"}, "TemporalExtent": {"RangeDateTime": {"BeginningDateTime": "2026-06-05T10:00:00Z", "EndingDateTime": "2026-06-05T10:00:12Z"}}, "SpatialExtent": {"HorizontalSpatialDomain": {"Geometry": {"BoundingRectangles": [{"WestBoundingCoordinate": -1.5, "SouthBoundingCoordinate": 2.0, "EastBoundingCoordinate": 0.5, "NorthBoundingCoordinate": 3.0}]}}}, "CloudCover": 25, "AdditionalAttributes": [{"Name": "SOLAR_ZENITH", "Values": ["31.5"]}], "RelatedUrls": [{"URL": "https://example.com/a/G1.nc"}]}
    (tmp_path / "g.json").write_text(json.dumps({"meta": {"a": 1}, "umm": doc}))
    rows = tables.read_catalogue_json(spark, str(tmp_path / "g.json"))
    r = rows.first()
    assert (r.granule_id, r.collection, r.west, r.cloud_fraction, r.attributes, r.assets) == ("G1", "C.001", -1.5, 0.25, {"SOLAR_ZENITH": "31.5"}, {"G1.nc": "https://example.com/a/G1.nc"})
    tables.write_index(rows, str(tmp_path / "index"))
    assert spark.read.parquet(str(tmp_path / "index")).count() == 1


def test_boxes_that_share_an_edge(spark):
    left = spark.createDataFrame([("touch", 0.0, 0.0, 10.0, 1.0), ("in", 10.5, 0.5, 30.0, 0.6), ("out", 40.1, 0.0, 41.0, 1.0)], "k string, west double, south double, east double, north double")
    right = spark.createDataFrame([(10.0, 0.0, 40.0, 1.0)], "r_west double, r_south double, r_east double, r_north double")
    for size in (1.0, 7.0, 100.0):
        assert sorted(r.k for r in lattice.box_join(left, right, size).collect()) == ["in", "touch"]
        assert [r.k for r in lattice.box_join(left, right, size, touching=False).collect()] == ["in"]
    assert lattice.box_join_plain(left, right).count() == 2
    assert not lattice.box_join(left, right, 7.0)._jdf.queryExecution().executedPlan().toString().count("NestedLoop")


def test_regrid_anchors(spark):
    """Pixels on every other cell of 10 by 10: each cell of their box has its nearest pixel, however far."""
    pixels = spark.createDataFrame([("g", i, j, 2 * j + 1.5, 2 * i + 1.5) for i in range(4) for j in range(4)], "granule string, s_row int, s_col int, px double, py double")
    cells = spark.createDataFrame([("g", r, c, c + 0.5, r + 0.5) for r in range(10) for c in range(10)], "granule string, row int, col int, x double, y double")
    got = {(r.row, r.col): r for r in lattice.nearest_pixels(cells, pixels, 1.0, 1.2).collect()}
    assert len(got) == 49 and (got[1, 1].s_row, got[3, 5].s_col) == (0, 2) and not got[1, 2].far and got[2, 2].far
    assert (got[2, 2].s_row, got[2, 2].s_col) == (0, 0)
    cleaned = {(r.row, r.col) for r in lattice.clean_contiguous(lattice.nearest_pixels(cells, pixels, 1.0, 1.2)).collect()}
    assert set(got) - cleaned == {(r, c) for r, c in got if sum(got[a, b].far for a in range(r - 1, r + 2) for b in range(c - 1, c + 2) if (a, b) in got) >= 3}
    sparse = pixels.where("s_row in (0, 3) and s_col in (0, 3)")
    assert lattice.nearest_pixels(cells, sparse, 0.5, 1.2).count() == 49
    with pytest.raises(ValueError):
        lattice.whole_offset(0.0, 0.5, 1.0)
    assert lattice.halo(spark.createDataFrame([(9, 0)], "row int, col int"), 10, 1).count() == 4


def test_masks(spark):
    df = spark.createDataFrame([(3, [0, 1], 5), (20, [1, 0], 7), (20, [0, 0], 0)], "s_col int, flags array<int>, cover int").withColumn("valid", F.lit(True))

    def left(*masks):
        return resolve.apply_masks(df, masks).where("valid").count()

    assert left(resolve.edge_trim("s_col", 40, 5)) == 2 and left(resolve.flags_clear("flags", ["cloud", "water"], ["cloud"])) == 2
    assert left(resolve.not_landcover("cover", {"snow": 7}, ["snow"])) == 2 and left(resolve.not_landcover("cover", {"snow": 7}, ["snow"], keep_nodata=False)) == 1
    for bad in (lambda: resolve.edge_trim("s_col", 40, 4), lambda: resolve.flags_clear("flags", ["a"], ["b"])):
        with pytest.raises(ValueError):
            bad()


def test_ranks(spark):
    df = spark.createDataFrame([(0, k, p) for k, p in enumerate([0.1, 0.2, 0.2, 0.5])] + [(1, 0, 3.0)], "cell int, look int, p double")
    assert [r.penalty for r in rank.rank_penalty(df, ["cell"], "p").orderBy("cell", "look").collect()] == [0.0, 0.5, 0.5, 1.0, 0.0]
    assert [r.borda for r in rank.borda(df, ["cell"], ["p"]).orderBy("cell", "look").collect()] == [3.0, 1.5, 1.5, 0.0, 0.0]
    assert [r.copeland for r in rank.copeland(df, ["cell"], "look", ["p"]).orderBy("cell", "look").collect()] == [3.0, 1.5, 1.5, 0.0, 0.0]


def test_gates_are_checked(spark):
    for bad in ({"weights": {"det": 1.0}}, {"weights": {"vza": -1}}, {"weights": {m: 0 for m in gated.METRICS}}, {"bounds": {"sza": (70, 0)}}, {"gate": "medium"}, {"key": "pairs"}, {"tie_break": "random"}, {"normalize": "per_tile"}, {"ignore": {"g3": []}}, {"min_count": 0}, {"aliases": {"fit": ["mineral_fit"]}}, {"layers": ("a", "a")}, {"g2_mask_classes": [150]}, {"combine": "borda", "gate": "soft"}, {"vote_power": 0}):
        with pytest.raises(ValueError):
            gated.ModeGate(**bad)
    g = gated.ModeGate()
    assert sum(g.shares().values()) == pytest.approx(1) and {"cloud_prob", "frcov"} <= set(g.columns())
    assert gated.ModeGate(weights=gated_cases.only(vza=1.0), aliases={"vza": ["tilt"]}).columns() == ["tilt"]
    rows = spark.createDataFrame([(0, 0, 1, 1, 5.0)], "cell int, look int, mineral_1 int, mineral_2 int, view_zenith double").withColumn("valid", F.lit(True))
    with pytest.raises(ValueError, match="Sagebrush"):
        gated.gated_scores(rows, ["cell"], ["look"], gated.ModeGate(g2_mask_classes=["Sagebrush"]))
    kept = gated.gated_scores(rows.withColumn("score", F.lit(9.0)).withColumn("extra", F.lit("x")), ["cell"], ["look"], gated.ModeGate(weights=gated_cases.only(vza=1.0)))
    assert kept.first().extra == "x" and kept.columns.count("score") == 1


def test_resampling(spark):
    src = spark.createDataFrame([(r, c, float(10 * r + c)) for r in range(4) for c in range(4)], "row int, col int, v double")
    at = spark.createDataFrame([(1.5, 1.5), (2.0, 1.5), (0.5, 0.5), (0.1, 0.5), (9.0, 9.0)], "x double, y double")
    got = {(r.x, r.y): r.v for r in resample.bilinear(at, src, "x", "y", "v").collect()}
    assert got == {(1.5, 1.5): 11.0, (2.0, 1.5): 11.5, (0.5, 0.5): 0.0, (0.1, 0.5): 0.0, (9.0, 9.0): None}
    left = spark.createDataFrame([(1, datetime(2026, 1, 1, 0, 0, 30)), (1, datetime(2026, 1, 2))], "k int, t timestamp")
    right = spark.createDataFrame([(1, datetime(2026, 1, 1), 5.0)], "k int, u timestamp, v double")
    assert [r.v for r in resample.as_of(left, right, ["k"], "t", "u", "v", 60).orderBy("t").collect()] == [5.0, None]


def test_publishing(spark):
    cells = spark.createDataFrame([(0, 0, 1, 5.0), (0, 1, 0, None), (0, 2, 9, 50.0)], "row int, col int, cls int, v double")
    with pytest.raises(Exception, match="same cell"):
        publish.stitch(cells.unionByName(cells)).collect()
    with pytest.raises(Exception, match="class 9"):
        publish.categorical_colors(cells, "cls", {1: (1, 2, 3)}, "fail").collect()
    assert publish.categorical_colors(cells, "cls", {}, "grey").orderBy("col").collect()[2][4:] == (128, 128, 128, 255)
    got = publish.categorical_colors(cells, "cls", {1: (1, 2, 3)}).orderBy("col").collect()
    assert [tuple(r)[4:] for r in got[:2]] == [(1, 2, 3, 255), (0, 0, 0, 0)] and got[2].a == 255
    shown = publish.continuous_colors(cells, "v", (0, 10), clip=False).orderBy("col").collect()
    assert [r.a for r in shown] == [255, 0, 0]
    assert publish.stretch(cells.limit(0), "v").first()[:] == (0.0, 1.0) and publish.stretch(cells.limit(1), "v").first()[:] == (5.0, 6.0)
    assert publish.legend([(2, "b"), (1, "a")], {1: (255, 0, 16)}) == {"type": "classes", "entries": [{"id": 1, "name": "a", "color": "#ff0010"}]}
    item = publish.item_document("x", (0, 1, 2, 3), "2026-01-01", "2026-02-01", {"b": "b.parquet", "a": "a.parquet"})
    assert list(item["assets"]) == ["a", "b"] and item["geometry"]["coordinates"][0][2] == [2, 3]
    x = spark.range(1).select(columns.piecewise(F.lit(5.0), [(0, 0), (10, 100)]).alias("p"), columns.airmass(F.lit(60.0), F.lit(90.0)).alias("m"), columns.mean_of_present(F.lit(None).cast("double"), F.lit(4.0)).alias("n"), columns.first_cell(F.lit(0.5), 0.0, 1.0).alias("c")).first()
    assert (x.p, x.m, x.n, x.c) == (50.0, None, 4.0, 0)


DOC = {"run_id": "r", "box": [0, 0, 2, 1], "time": {"start": datetime(1996, 1, 1), "end": datetime(1998, 1, 1), "epoch": "P1Y"}, "layers": [{"name": "kind", "kind": "categorical", "source": "cls", "aggregate": "vote", "params": {"tie": "earliest"}}]}


def test_run_descriptions():
    m = Manifest.from_document(DOC)
    assert m.grid.tiles(m.box) == [(180, -90), (181, -90)] and m.key == Manifest.from_document(dict(reversed(DOC.items()))).key
    with pytest.raises(ManifestError) as e:
        Manifest.from_document(DOC | {"grids": 1, "time": DOC["time"] | {"epok": 2}})
    assert len(e.value.problems) == 2
    with pytest.raises(ManifestError) as e:
        Manifest.from_document(DOC | {"run_id": "a/b", "layers": [{"name": "score", "kind": "continuous", "source": "acquired", "aggregate": "mean"}], "grid": {"crs": "EPSG:32611"}})
    assert len(e.value.problems) == 4
    assert Grid(block_size=64).id == Grid().id != Grid(tile_size=2.0).id
    with pytest.raises(ManifestError):
        Budget(max_tiles=1).gate(2, 1)
    assert Budget(max_tiles=1, on_exceed="warn").gate(2, 1)
    assert identity({"a": 1, "b": 2}) == identity({"b": 2, "a": 1})
    assert key_difference({"a": {"x": 1}, "b": 2}, {"a": {"x": 3}, "b": 2}) == ["a.x: 1 -> 3"]


def test_a_run_and_its_reuse(spark, tmp_path):
    m, made = Manifest.from_document(DOC), []

    def build():
        made.append(1)
        return deliver(m, tables.looks(spark, SF))

    a = reuse_or_write(spark, str(tmp_path), "product", {"m": m.key}, build)
    b = reuse_or_write(spark, str(tmp_path), "product", {"m": m.key}, build)
    assert len(made) == 1 and a.count() == b.count() > 0 and {"kind", "kind_agreement", "n_observed"} <= set(a.columns)


def test_the_driver_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0 and set(entry.oracle_sql()) <= set(entry.queries())


def test_ranks_sort_once_a_ballot(spark):
    """Looks dealt by their keys beforehand aren't dealt again, and each ballot takes one sort."""
    df = spark.range(60).selectExpr("id % 5 AS cell", "id AS look", "CAST(id * 7 % 11 AS double) AS p", "CAST(id % 4 AS double) AS q").repartition(3, "cell")
    for out, sorts in ((rank.rank_penalty(df, ["cell"], "p"), 1), (rank.borda(df, ["cell"], ["p", "q"]), 2)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Sort [") == sorts and plan.count("Exchange hashpartitioning") == 1


def test_abundance_deals_a_cell_once(spark):
    from cellweave.operators import reduce

    snaps = spark.range(40).selectExpr("id % 4 AS cell", "id DIV 4 AS epoch", "CAST(id % 2 + 1 AS int) AS cls", "1.0D AS soil", "true AS valid")
    f = spark.createDataFrame([(1, "a", 0.5), (2, "a", 1.0)], "class_id int, output string, fraction double")
    out = reduce.abundance(snaps, f, ["cell"], "soil", tasks=3)
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sorted((r.cell, r.abundance, r.n) for r in out.collect()) == [(0, 0.5, 10), (1, 1.0, 10), (2, 0.5, 10), (3, 1.0, 10)]
