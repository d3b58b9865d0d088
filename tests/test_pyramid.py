"""Pyramids against direct means and middles, pictures against their pixels, sketches against exact ranks."""

from __future__ import annotations

import struct

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cellweave.operators import pyramid, resample, sketches

CELLS = "row int, col int, value double, cls int, level string"


def cells(spark):
    rng = np.random.default_rng(2)
    rows = [(r, c, float(rng.normal()), int(rng.integers(9)), "mine") for r in range(-9, 21) for c in range(-5, 30) if rng.random() < 0.7]
    rows += [(3, 3, None, None, None), (4, 4, float("nan"), 2, None), (None, 1, 1.0, 1, None), (1, None, 1.0, 1, None), rows[0]]
    return spark.createDataFrame(rows, CELLS)


def test_each_mean_is_that_of_all_cells_below(spark):
    df = cells(spark).cache()
    got = {(r.level, r.row, r.col): (r.value, r.n) for r in pyramid.mean_pyramid(df, 4, "value").collect()}
    want: dict = {}
    for r in df.collect():
        if None not in (r.row, r.col, r.value) and r.value == r.value:
            for k in range(1, 5):
                want.setdefault((k, r.row >> k, r.col >> k), []).append(r.value)
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k][1] == len(v) and abs(got[k][0] - np.mean(v)) < 1e-12
    assert pyramid.mean_pyramid(df.limit(0), 3, "value").collect() == []


def test_keys_stay_apart_and_two_shuffles_do(spark):
    df = cells(spark).select(F.explode(F.array(F.lit("a"), F.lit("b"))).alias("band"), "row", "col", F.when(F.col("band") == "a", F.col("value")).otherwise(1.0).alias("value"))
    out = pyramid.mean_pyramid(df, 3, "value", ["band"])
    assert {r.value for r in out.where("band = 'b'").collect()} == {1.0}
    plan = pyramid.mean_pyramid(df, 2, "value", ["band"]).where("level = 2")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") + plan.count("Exchange REPARTITION") <= 2


def test_classes_are_the_middles_of_their_blocks(spark):
    df = cells(spark).drop("level").dropna(subset=["row", "col"])
    out = pyramid.class_pyramid(df, 3, "cls")
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    for level in (1, 2, 3):
        want = sorted((r.row, r.col, r.cls or -1) for r in resample.overview(df, level, "cls", True).collect())
        assert sorted((r.row, r.col, r.cls or -1) for r in out.where(F.col("level") == level).collect()) == want and want


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 9), st.integers(1, 9), st.randoms(use_true_random=False))
def test_a_picture_is_read_as_it_was(height, width, rng):
    image = np.array([rng.choice([0, 1, 7, 255]) for _ in range(height * width * 4)], np.uint8).reshape(height, width, 4)
    data = pyramid.encode_png(image)
    assert (pyramid.decode_png(data) == image).all() and struct.unpack(">II", data[16:24]) == (width, height)


def test_pictures_that_arent_ours_are_errors():
    data = pyramid.encode_png(np.full((4, 4, 4), 9, np.uint8))
    for bad in (b"GIF89a" + data[6:], data[:45] + bytes([data[45] ^ 1]) + data[46:], data[:25] + b"\2" + data[26:]):
        with pytest.raises(ValueError):
            pyramid.decode_png(bad)


def test_smooth_pictures_are_small():
    ramp = np.indices((256, 256)).sum(axis=0).astype(np.uint8)
    image = np.stack([ramp, ramp, ramp, np.full_like(ramp, 255)], axis=2)
    assert len(pyramid.encode_png(image)) < 4096


def test_tiles_hold_their_cells_and_nothing_else(spark):
    rows = [("m", -1, 5, 1, 2, 3, 255), ("m", 0, 0, 9, 9, 9, 255), ("m", 0, 0, 9, 10, 0, 255), ("m", 8, 8, None, 4, 4, 200), ("m", None, 1, 1, 1, 1, 1), ("n", 0, 0, 255, 255, 255, 255)]
    df = spark.createDataFrame(rows, "band string, row int, col int, r int, g int, b int, a int")
    tiles = pyramid.render_tiles(df, 8, ["band"]).cache()
    assert sorted((r.band, r.ty, r.tx) for r in tiles.collect()) == [("m", -1, 0), ("m", 0, 0), ("m", 1, 1), ("n", 0, 0)]
    got = {tuple(r) for r in pyramid.read_pixels(tiles, ["band"]).where("a > 0").collect()}
    assert got == {("m", -1, 5, 1, 2, 3, 255), ("m", 0, 0, 9, 10, 0, 255), ("m", 8, 8, 0, 4, 4, 200), ("n", 0, 0, 255, 255, 255, 255)}
    assert pyramid.read_pixels(tiles, ["band"]).count() == 4 * 64
    assert pyramid.render_tiles(df.limit(0), 8, ["band"]).collect() == []


def test_a_second_stretch_reads_the_sketches_of_the_first(spark, tmp_path):
    n = 200_000
    df = spark.range(n).select((F.col("id") % 16).alias("tile"), (F.hash("id") % 100_003).cast("double").alias("v"))
    sketches.tile_sketches(df, "v", ["tile"]).write.parquet(str(tmp_path / "sketches"))
    kept = spark.read.parquet(str(tmp_path / "sketches"))
    assert kept.count() == 16 and kept.agg(F.max(F.length("sketch"))).first()[0] < 400_000
    for tiles in (range(16), range(3)):
        own = df.where(F.col("tile").isin(*tiles))
        r = sketches.sketched_stretch(kept.where(F.col("tile").isin(*tiles))).first()
        total = own.count()
        assert r.n == total
        for end, share in ((r.lo, 0.02), (r.hi, 0.98)):
            assert own.where(F.col("v") < end).count() / total - 0.001 <= share <= own.where(F.col("v") <= end).count() / total + 0.001


def test_stretches_of_little(spark):
    few = spark.createDataFrame([("a", 5.0), ("b", None), ("b", float("nan")), ("c", 1.0), ("c", 3.0)], "tile string, v double")
    kept = sketches.tile_sketches(few, "v", ["tile"])
    assert {r.tile: r.n for r in kept.collect()} == {"a": 1, "b": 0, "c": 2}
    ends = lambda df: tuple(sketches.sketched_stretch(df).first())
    assert ends(kept.where("tile = 'a'")) == (1, 5.0, 6.0) and ends(kept.where("tile = 'b'")) == (0, 0.0, 1.0)
    assert ends(kept.where("tile = 'c'")) == (2, 1.0, 3.0) and ends(kept.limit(0)) == (0, 0.0, 1.0)
