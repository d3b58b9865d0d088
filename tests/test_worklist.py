"""Work lists, estimates and tasks of about equal cost."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

from cellweave.operators import worklist

SCHEMA = "granule_id bigint, west double, south double, east double, north double, cost2 string"


def made(spark, rows):
    return spark.createDataFrame([(*r, "") for r in rows], SCHEMA)


def test_a_granule_shares_its_weight_by_area(spark):
    rows = [(1, -1.0, -1.0, 3.0, 1.0), (2, 0.0, 0.0, 10.0, 10.0), (3, 5.0, 5.0, 5.0, 5.0), (4, None, 0.0, 1.0, 1.0), (5, 3.0, 3.0, 1.0, 4.0)]
    got = defaultdict(dict)
    for r in worklist.work_list(made(spark, rows), 10, (0.0, 0.0), 800).collect():
        got[r.granule_id][r.tx, r.ty] = r.cost
    assert got == {1: {(-1, -1): 100, (-1, 0): 100, (0, -1): 300, (0, 0): 300}, 2: {(0, 0): 800}, 3: {(0, 0): 800}}


def test_hot_tiles_are_split_and_light_ones_bundled(spark):
    rng = random.Random(3)
    rows = [(k, 2.0, 2.0, 4.0, 4.0) for k in range(400)]  # a third of all in one tile
    rows += [(400 + k, x, y, x + 2, y + 2) for k in range(800) for x, y in [(rng.uniform(0, 300), rng.uniform(0, 160))]]
    work = worklist.work_list(made(spark, rows), 10, (0.0, 0.0), 100)
    costs = worklist.tile_costs(work)
    most = 1000
    laid = worklist.lay_out(costs, most)
    dealt = worklist.deal(work, laid, "granule_id").collect()
    assert Counter((r.granule_id, r.tx, r.ty) for r in dealt) == Counter((r.granule_id, r.tx, r.ty) for r in work.collect())
    tasks, tiles = Counter(), defaultdict(set)
    for r in dealt:
        tasks[r.task] += r.cost
        tiles[r.tx, r.ty].add(r.task)
    assert len(tiles[0, 0]) >= 30 and max(tasks.values()) <= 2.5 * most
    assert all(len(tiles[r.tx, r.ty]) == 1 for r in laid.where("parts = 1").collect()) and len(tasks) < len(tiles)


def test_an_estimate(spark):
    rows = [(1, 0.0, 0.0, 10.0, 10.0), (2, 0.0, 0.0, 10.0, 10.0), (3, 12.0, 0.0, 14.0, 2.0), (3, 12.0, 0.0, 14.0, 2.0), (3, 12.0, 0.0, 14.0, 2.0)]
    of = lambda r: worklist.estimate(worklist.tile_costs(worklist.work_list(made(spark, r), 10, (0.0, 0.0), 7)), 100, 2).first().asDict()
    assert of(rows) == {"tiles": 2, "items": 5, "cost": 35, "heaviest": 21, "longest": 7, "peak_bytes": 600}
    assert of([]) == dict.fromkeys(of(rows), 0)
