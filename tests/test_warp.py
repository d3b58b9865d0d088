"""Warps against direct sums, whatever the tile; roles against counts of units."""

from __future__ import annotations

import numpy as np
import pytest

from cellweave.operators import warp

SHARE = {
    "bilinear": lambda t: max(0.0, 1 - abs(t)),
    "cubic": lambda t: 1.5 * abs(t) ** 3 - 2.5 * t * t + 1 if abs(t) < 1 else -0.5 * abs(t) ** 3 + 2.5 * t * t - 4 * abs(t) + 2 if abs(t) < 2 else 0.0,
}


def plain(x, shape, scale, offset, kernel):
    out = {}
    for r in range(shape[0]):
        for c in range(shape[1]):
            y, z = (r + 0.5) * scale[0] + offset[0], (c + 0.5) * scale[1] + offset[1]
            total = weight = 0.0
            for (i, j), v in x.items():
                w = SHARE[kernel]((y - i - 0.5) / max(1, scale[0])) * SHARE[kernel]((z - j - 0.5) / max(1, scale[1]))
                total, weight = total + w * v, weight + w
            if weight > 1e-6:
                out[r, c] = total / weight
    return out


def cells(seed=1, rows=9, cols=11):
    rng = np.random.default_rng(seed)
    return {(r, c): float(rng.normal()) for r in range(rows) for c in range(cols) if (r * 7 + c * 3) % 6}


@pytest.mark.parametrize("kernel", ["bilinear", "cubic"])
@pytest.mark.parametrize(("scale", "offset"), [((0.4, 0.7), (0.3, -1.2)), ((1.0, 1.0), (0.0, 0.5)), ((2.3, 1.6), (-0.4, 0.1))])
def test_tiles_dont_matter(spark, kernel, scale, offset):
    x, shape = cells(), (17, 19)
    rows = [(r, c, v) for (r, c), v in x.items()] + [(0, 0, None), (1, 1, float("nan"))]
    rows = [r for r in rows if r[2] is None or r[2] != r[2] or (r[0], r[1]) not in ((0, 0), (1, 1))]
    x.pop((0, 0), None), x.pop((1, 1), None)
    df = spark.createDataFrame(rows, "row int, col int, v double").repartition(3)
    want = plain(x, shape, scale, offset, kernel)
    for tile in (3, 8, 64):
        got = {(r.row, r.col): r.v for r in warp.warp(df, "v", shape, scale, offset, kernel, tile).collect()}
        assert got.keys() == want.keys()
        assert all(got[k] == pytest.approx(want[k], rel=1e-7, abs=1e-7) for k in want)


def test_a_plane_stays_a_plane_and_keys_stay_apart(spark):
    df = spark.createDataFrame([(k, r, c, float(k + 2 * r - c)) for k in (0, 1) for r in range(12) for c in range(12)], "k int, row int, col int, v double")
    got = warp.warp(df, "v", (20, 20), (0.5, 0.5), (0.25, 0.75), "cubic", 7, ["k"]).collect()
    inner = [r for r in got if 4 <= r.row < 16 and 4 <= r.col < 16]
    assert len(inner) == 2 * 144
    for r in inner:
        assert r.v == pytest.approx(r.k + 2 * ((r.row + 0.5) / 2 + 0.25 - 0.5) - ((r.col + 0.5) / 2 + 0.75 - 0.5))


def test_a_source_cell_moves_to_few_tiles(spark):
    df = spark.range(64 * 64).selectExpr("id DIV 64 AS row", "id % 64 AS col", "1.0D AS v")
    out = warp.warp(df, "v", (128, 128), (0.5, 0.5), kernel="cubic", tile=64)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    assert out.count() == 128 * 128


def test_wrong_input(spark):
    df = spark.createDataFrame([(0, 0, 1.0)], "row int, col int, v double")
    for bad in ({"kernel": "nearest"}, {"scale": (0.0, 1.0)}, {"tile": 0}):
        with pytest.raises(ValueError):
            warp.warp(df, "v", (2, 2), **({"scale": (1.0, 1.0)} | bad))
    assert warp.warp(df.where("false"), "v", (2, 2), (1.0, 1.0)).count() == 0
    with pytest.raises(ValueError):
        warp.to_lattice(df, 0, 1)


def roles(spark, holes=()):
    rows = [("g", r, c, float(r * 10 + c), (r + c) % 3, (r, c) not in holes) for r in range(6) for c in range(6)]
    return spark.createDataFrame(rows, "granule string, row int, col int, v double, k int, valid boolean")


@pytest.mark.parametrize(("a", "b"), [(1, 3), (3, 1), (3, 2), (2, 3), (4, 4)])
def test_units_are_counted(spark, a, b):
    holes = {(2, 2), (5, 0)}
    got = {(r.row, r.col): r for r in warp.to_lattice(roles(spark, holes), a, b, ["v"], ["k"]).collect()}
    units: dict = {}
    for r in range(6):
        for c in range(6):
            if (r, c) not in holes:
                for i in range(a):
                    for j in range(a):
                        units.setdefault(((r * a + i) // b, (c * a + j) // b), []).append((r * 10 + c, (r + c) % 3))
    assert got.keys() == units.keys()
    for at, own in units.items():
        kinds = [k for _, k in own]
        assert got[at].v == pytest.approx(np.mean([v for v, _ in own])) and got[at].units == len(own)
        assert got[at].valid == (len(own) == b * b) and got[at].k == min(set(kinds), key=lambda k: (-kinds.count(k), k))


def test_one_hole_in_a_role_invalidates(spark):
    base = roles(spark).selectExpr("granule", "row", "col", "valid").where("NOT (row = 0 AND col = 5)")
    fine = warp.to_lattice(spark.createDataFrame([("g", r, c, 1.0, (r, c) != (7, 7)) for r in range(18) for c in range(18)], "granule string, row int, col int, v double, valid boolean"), 1, 3, ["v"])
    coarse = warp.to_lattice(roles(spark, {(0, 0)}).where("row < 3 AND col < 3"), 2, 1, ["v"])
    out = {(r.row, r.col): r for r in warp.join_roles(base, {"fine": fine, "coarse": coarse}).collect()}
    assert len(out) == 35
    bad = {(2, 2)} | {(r, c) for r in (0, 1) for c in (0, 1)}
    assert {k for k, r in out.items() if not r.valid} == bad
    assert out[5, 5].coarse_v == 22.0 and out[2, 2].fine_v == 1.0
    with pytest.raises(ValueError, match="fine_v"):
        warp.join_roles(base.withColumnRenamed("valid", "fine_v").withColumnRenamed("fine_v", "valid").selectExpr("*", "1 AS fine_v"), {"fine": fine})


def test_bands_come_from_one_pass(spark):
    """Nothing is joined: a table of cells, guessed small from before they were multiplied, went to all tasks through the driver."""
    role = spark.range(400).selectExpr("concat('g', id DIV 400) AS granule", "id DIV 20 AS row", "id % 20 AS col", "CAST(id AS double) AS v", "id % 3 AS k", "id % 4 AS k2", "true AS valid")
    for kinds in (["k"], ["k", "k2"]):
        out = warp.to_lattice(role, 3, 2, ["v"], kinds, tasks=7)
        assert "Join" not in out._jdf.queryExecution().executedPlan().toString() and out.rdd.getNumPartitions() == 7
    got = {(r.row, r.col): (r.k, r.k2) for r in out.collect()}
    alone = [{(r.row, r.col): r[k] for r in warp.to_lattice(role, 3, 2, [], [k]).collect()} for k in ("k", "k2")]
    assert len(got) == 900 and got == {p: (alone[0][p], alone[1][p]) for p in alone[0]}


def test_roles_are_merged_in_order(spark):
    cells = spark.range(40).selectExpr("concat('g', id DIV 40) AS granule", "id DIV 8 AS row", "id % 8 AS col", "CAST(id AS double) AS v", "true AS valid")
    out = warp.join_roles(cells.drop("v"), {"a": warp.to_lattice(cells, 1, 1, ["v"], tasks=3), "b": warp.to_lattice(cells, 2, 1, ["v"], tasks=3)}, tasks=3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2 and "BroadcastHashJoin" not in plan
    assert sorted((r.row, r.col, r.a_v, r.b_v, r.valid) for r in out.collect()) == sorted((k // 8, k % 8, float(k), float(k // 16 * 8 + k % 8 // 2), True) for k in range(40))
