"""Readers, sinks, plug-ins and the command line: written, read back, and refused where they should be."""

from __future__ import annotations

import json
import subprocess
import sys
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cellweave import cli
from cellweave.operators import sinks
from cellweave.plans import plugins
from cellweave.sources import readers


def test_scan_lists_assets_and_refuses_doubles(spark, tmp_path):
    for name in ("L2_a.nc", "L2_b.nc", "M_a.nc", "other.txt"):
        (tmp_path / name).write_bytes(b"x" * 5)
    found = readers.scan(spark, {("c", "main"): f"{tmp_path}/L2_*.nc", ("c", "mask"): f"{tmp_path}/M_*.nc"})
    rows = {r.granule_id: (sorted(r.assets), r.bytes) for r in found.collect()}
    assert rows == {"a": (["main", "mask"], 10), "b": (["main"], 5)}
    later = readers.scan(spark, {("c", "main"): f"{tmp_path}/L2_*.nc"}, datetime(2999, 1, 1))
    assert later.count() == 0
    with pytest.raises(ValueError):
        readers.affixes("/data/fixed.nc")
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "L2_a.nc").write_bytes(b"x")
    with pytest.raises(Exception, match="DUPLICATED_MAP_KEY"):
        readers.scan(spark, {("c", "main"): f"{tmp_path}/{{,d/}}L2_*.nc"}).collect()


def test_readers(spark, tmp_path):
    path = f"{tmp_path}/pixels"
    spark.createDataFrame([("g", 0, 0, -9999.0, 1), ("g", 0, 1, float("nan"), 2), ("g", 1, 0, 3.0, None)], "granule string, s_row int, s_col int, depth double, cls int").write.parquet(path)
    rows = readers.LongRows(("depth", "cls"), {"depth": -9999.0}).read(spark, path, ["depth", "cls"])
    assert sorted(map(tuple, rows.collect())) == [("g", 0, 0, None, 1), ("g", 0, 1, None, 2), ("g", 1, 0, 3.0, None)]
    with pytest.raises(KeyError):
        readers.LongRows(("depth",)).read(spark, path, ["cls"])
    (tmp_path / "classes.csv").write_text("name,id,group\nHematite,45,1\nGoethite,47,1\n")
    table = readers.class_table(spark, f"{tmp_path}/classes.csv", "id", ["name"])
    assert table.columns == ["id", "name"] and sorted(map(tuple, table.collect())) == [(45, "Hematite"), (47, "Goethite")]
    with pytest.raises(KeyError):
        readers.class_table(spark, f"{tmp_path}/classes.csv", "id", ["absent"])
    with pytest.raises(ValueError):
        readers.class_table(spark, f"{tmp_path}/classes.csv", "group")


def test_band_aliases():
    bands = [{"wavelength": 440.1}, {"wavelength": 550.0}, {"wavelength": 551.0}, {"name": "x"}]
    assert readers.band_of(bands, index=2) == 2
    assert readers.band_of(bands, attribute="wavelength", value=440, tolerance=0.5) == 0
    assert readers.band_of(bands, attribute="name", value="x") == 3
    for wrong in ({"attribute": "wavelength", "value": 550.5, "tolerance": 1.0}, {"attribute": "wavelength", "value": 700}, {"index": 4}):
        with pytest.raises(ValueError):
            readers.band_of(bands, **wrong)


def test_frozen_index_is_told_by_its_rows(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", None), ("b", None)], "g string, n int")
    key = readers.freeze(rows, f"{tmp_path}/frozen")
    assert key == readers.fingerprint(rows.repartition(3).select("n", "g"))
    assert key != readers.fingerprint(rows.distinct()) and key != readers.fingerprint(rows.fillna(0))
    assert readers.fingerprint(rows.limit(0)) == "0-0000000000000000"


def test_tiles_are_replaced_one_by_one(spark, tmp_path):
    path, kind = f"{tmp_path}/snaps", "tx int, ty int, epoch_start timestamp, row int, col int, v int"
    jan, feb = datetime(2020, 1, 1), datetime(2020, 2, 1)
    sinks.write_tiles(spark.createDataFrame([(0, 0, jan, 0, 0, 1), (0, 0, feb, 0, 0, 2), (1, 0, jan, 0, 0, 3)], kind), path, "epoch_start")
    sinks.write_tiles(spark.createDataFrame([(0, 0, feb, 0, 0, 9)], kind), path, "epoch_start")
    assert sorted(r.v for r in sinks.read_tiles(spark, path, "epoch_start").collect()) == [1, 3, 9]
    some = sinks.read_tiles(spark, path, "epoch_start", [(0, 0)], [feb, datetime(2020, 3, 1)])
    assert [r.v for r in some.collect()] == [9]
    assert len(some.inputFiles()) >= 1 and "PartitionFilters: [" in some._jdf.queryExecution().toString()


def test_documents(spark):
    numbered = spark.createDataFrame([(1, "a", "2020"), (1, "a", "2020"), (2, "b", "2021"), (0, None, None)], "granule_no int, granule_id string, acquired string")
    assert sinks.granules_document(numbered) == {"granules": [{"number": 1, "id": "a", "acquired": "2020"}, {"number": 2, "id": "b", "acquired": "2021"}]}
    kind = "id string, west double, south double, east double, north double, start string, end string"
    items = spark.createDataFrame([("i2", 1.0, 0.0, 2.0, 1.0, "2020", "2021"), ("i1", 0.0, -1.0, 1.0, 0.0, "2019", "2020")], kind)
    doc = sinks.collection_document("c", "what", items)
    assert doc["extent"] == {"spatial": {"bbox": [[0.0, -1.0, 2.0, 1.0]]}, "temporal": {"interval": [["2019", "2021"]]}}
    assert [x["href"] for x in doc["links"]] == ["./i1.json", "./i2.json"]
    with pytest.raises(ValueError):
        sinks.collection_document("c", "what", items.limit(0))
    index = spark.createDataFrame([("c", "1"), ("c", "1"), ("c", "2")], "collection string, collection_version string")
    doc = sinks.provenance_document("r", "k", index, "f", {"b": "1", "a": "2"})
    assert [x["granules"] for x in doc["inputs"]] == [2, 1] and list(doc["plugins"]) == ["a", "b"]


class Twice:
    outputs, requires = (("x", "double"), ("x", "double")), ()

    def reduce(self, snaps, keys):
        return snaps.groupBy(*keys).agg(F.avg("value").alias("x"))


class Wide(Twice):
    outputs, halo = (("score", "double"),), 1


class Mean(Twice):
    outputs, requires = (("x", "double"),), ("value",)


class Wrong(Mean):
    outputs = (("x", "int"),)


class Sensor:
    space, requires, aux = "sensor", (), ("dem",)

    def valid(self, looks):
        return F.lit(True)


class Bare:
    requires, outputs = (), ("a",)

    def score(self, looks):
        return F.col("value")


class Other(Bare):
    def emit(self, looks):
        return {"b": F.lit(1)}


def test_plugins_are_checked(spark):
    assert len(plugins.problems("reducer", Twice())) == 1 and len(plugins.problems("reducer", Wide())) == 2
    assert plugins.problems("reducer", Mean()) == [] and plugins.problems("scorer", Mean()) and plugins.problems("mask", Sensor()) and plugins.problems("scorer", Bare())
    assert isinstance(plugins.resolve("reducer", f"{__name__}:Mean"), Mean)
    for ref in ("absent", f"{__name__}:Twice"):
        with pytest.raises(ValueError):
            plugins.resolve("reducer", ref)
    rows = spark.createDataFrame([(1, 2.0), (1, 4.0)], "cell int, value double")
    assert [tuple(r) for r in plugins.apply_reducer(rows, ["cell"], Mean()).collect()] == [(1, 3.0)]
    for wrong in (Wrong(), Mean()):
        with pytest.raises(ValueError):
            plugins.apply_reducer(rows if isinstance(wrong, Wrong) else rows.drop("value"), ["cell"], wrong)
    with pytest.raises(ValueError):
        plugins.apply_scorer(rows, Other())
    plugins.register("reducer", "own mean", Mean)
    assert isinstance(plugins.resolve("reducer", "own mean"), Mean)
    with pytest.raises(ValueError):
        plugins.register("reducer", "own mean", Twice)


def test_importing_the_queries_registers_nothing():
    said = subprocess.run([sys.executable, "-c", "from cellweave.plans import catalogue, plugins; print(plugins.registered())"], capture_output=True, text=True, check=True)
    assert said.stdout.strip() == "[]"


def test_command_line(spark, tmp_path):
    doc = {
        "run_id": "r", "grid": {"origin": [0.0, 1.0], "resolution": [0.5, -0.5]}, "box": [0, 0, 1, 1],
        "time": {"start": "2020-01-01", "end": "2020-03-15", "epoch": "P1M"},
        "layers": [{"name": "v", "kind": "continuous", "source": "value", "aggregate": "mean"}],
    }
    (tmp_path / "m.json").write_text(json.dumps(doc))
    (tmp_path / "n.json").write_text(json.dumps(doc | {"run_id": "s"}))
    t = [datetime(2020, 1, 5), datetime(2020, 2, 5), datetime(2021, 1, 1)]
    spark.createDataFrame([(f"g{k}", "c", "1", x, 0.0, 0.0, 1.0, 1.0) for k, x in enumerate(t)], "granule_id string, collection string, collection_version string, acquired timestamp, west double, south double, east double, north double").write.parquet(f"{tmp_path}/index")
    looks = [(0, 0, f"g{k}", k, t[k], 1.0 + k, 10.0 * k, True) for k in (0, 1)]
    spark.createDataFrame(looks, "row int, col int, granule_id string, n int, acquired timestamp, score double, value double, valid boolean").write.parquet(f"{tmp_path}/looks")
    m = f"{tmp_path}/m.json"
    planned = cli.main(["plan", m, f"{tmp_path}/index"], spark)
    assert (planned["granules"], planned["tiles"], planned["epochs"], planned["over_budget"]) == (2, 1, 2, []) and len(planned["partial_epochs"]) == 1
    args = ["run", m, f"{tmp_path}/looks", f"{tmp_path}/out", "--order", "acquired,n", "--reducer", f"{__name__}:Mean"]
    done = cli.main(args, spark)
    assert done["rows"] == 2 and "x" in done["columns"] and cli.main(args, spark) == done
    (path,) = (tmp_path / "out" / "products").iterdir()
    got = cli.main(["sample", m, str(path), "--lon", "0.1", "--lat", "0.9"], spark)["values"]
    assert [(v["v"], v["x"]) for v in got] == [(0.0, 0.0), (10.0, 10.0)]
    assert cli.main(["diff", m, f"{tmp_path}/n.json"]) == {"different": ["run_id: 'r' -> 's'"]}
    assert cli.main(["plugins"])["plugins"] is not None
