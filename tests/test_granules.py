"""Catalogue records as rows of the index."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import Observation

from cellweave.sources import granules as g

ASSETS = {"data": "A_*.nc", "mask": "M?_*.nc"}
RECT = {"BoundingRectangles": [{"WestBoundingCoordinate": 1, "SouthBoundingCoordinate": 2, "EastBoundingCoordinate": 3, "NorthBoundingCoordinate": 4}]}


def document(**other) -> dict:
    url = lambda name, kind="GET DATA": {"URL": f"https://a.example/p/{name}", "Type": kind}
    return {
        "GranuleUR": "one",
        "CollectionReference": {"ShortName": "C", "Version": "002"},
        "TemporalExtent": {"RangeDateTime": {"BeginningDateTime": "2026-06-05T01:02:03Z"}},
        "SpatialExtent": {"HorizontalSpatialDomain": {"Geometry": RECT}},
        "RelatedUrls": [url("A_7.nc"), url("A_7.nc", "GET DATA VIA DIRECT ACCESS"), url("M1_7.nc", "GET DATA VIA DIRECT ACCESS"), url("A_7.png")],
        "DataGranule": {"DayNightFlag": "Day", "ArchiveAndDistributionInformation": [{"Name": "A_7.nc", "SizeInBytes": 9, "Checksum": {"Value": "ABC", "Algorithm": "SHA-512"}}, {"Name": "other", "SizeInBytes": 1}]},
        **other,
    }


def rows(spark, *docs, **named):
    df = spark.createDataFrame([(d if d is None or isinstance(d, str) else json.dumps(d),) for d in docs], "record string")
    return g.granules(df, "record", ASSETS, **named)


def test_a_record(spark):
    r = rows(spark, {"umm": document(CloudCover=25)}).first()
    assert (r.granule_id, r.granule_ur, r.collection, r.collection_version, r.product_version, r.cloud_fraction, r.day_night) == ("7", "one", "C", "002", "V002", 0.25, "Day")
    assert (r.west, r.south, r.east, r.north) == (1, 2, 3, 4) and r.acquired == r.ended and r.attributes == []
    assert [tuple(a) for a in r.assets] == [("data", "https://a.example/p/A_7.nc", "https://a.example/p/A_7.nc", "sha512:abc", 9)]  # the mask has no GET DATA link


def test_polygons_come_first_and_bare_documents_do(spark):
    points = [{"Longitude": x, "Latitude": y} for x, y in ((5, 6), (9, 6), (7, -1))]
    shape = lambda p: {"HorizontalSpatialDomain": {"Geometry": {"GPolygons": [{"Boundary": {"Points": p}}], **RECT}}}
    got = [(r.west, r.south, r.east, r.north) for r in rows(spark, document(SpatialExtent=shape(points)), document(SpatialExtent=shape(points[:2]))).collect()]
    assert sorted(got) == [(1, 2, 3, 4), (5, -1, 9, 6)]


def test_what_is_left_out_is_counted(spark):
    counted = Observation()
    got = rows(spark, document(), document(RelatedUrls=[]), document(RelatedUrls=None), "{", None, "", document(), counted=counted).collect()
    assert len(got) == 2 and counted.get == {"records": 7, "broken": 3, "skipped": 2}
    assert all(r.cloud_fraction is None for r in got)


@pytest.mark.parametrize(("other", "said"), [
    ({"SpatialExtent": None}, "one: no polygon and no rectangle"),
    ({"TemporalExtent": None}, "one: no start time"),
    ({"RelatedUrls": [{"URL": f"https://a.example/A_{k}.nc", "Type": "GET DATA"} for k in (1, 2)]}, "one: several files for data"),
])
def test_records_that_cannot_be_indexed_are_named(spark, other, said):
    with pytest.raises(Exception, match=said):
        rows(spark, document(**other)).collect()


def test_window_and_box_are_applied_again(spark):
    for named, n in (({"start": "2026-06-05 01:02:03"}, 1), ({"end": "2026-06-05 01:02:03"}, 0), ({"box": (3.0, 4.0, 9.0, 9.0)}, 1), ({"box": (3.5, 0.0, 9.0, 9.0)}, 0)):
        assert rows(spark, document(), **named).count() == n


def test_only_folders_of_the_collections_are_read(spark, tmp_path):
    for name in ("C", "D"):
        (tmp_path / f"collection={name}").mkdir()
        (tmp_path / f"collection={name}" / "page-1.json").write_text(json.dumps(document()) + "\n" + json.dumps(document()) + "\n")
    pages = g.read_pages(spark, str(tmp_path), ["C"])
    assert g.granules(pages, "record", ASSETS).count() == 2 and g.read_pages(spark, str(tmp_path)).count() == 4
    plan = pages._jdf.queryExecution().executedPlan().toString()
    assert "collection" in plan.split("PartitionFilters: [")[1].split("]")[0]
