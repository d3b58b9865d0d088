"""Votes and statistics on hand-computed columns of epochs."""

from __future__ import annotations

import math

import pytest

from cellweave.operators import reduce

ND = 65535
SCHEMA = "cell int, epoch int, cls int, valid boolean, observed boolean, score double, value double, u double, acquired double"


def column(spark, cells):
    """cells: {cell: [(cls, valid, score[, value[, u]])]} in order of epochs."""
    rows = [(c, k, e[0], e[1], True, e[2], *(tuple(map(float_or_none, e[3:])) + (None, None))[:2], float(k)) for c, es in cells.items() for k, e in enumerate(es)]
    return spark.createDataFrame(rows, SCHEMA)


def float_or_none(x):
    return None if x is None else float(x)


def votes(spark, cells, **params):
    return {r.cell: (r.winner, r.runner_up, None if r.agreement is None else round(r.agreement, 6), r.n_epochs) for r in reduce.vote(column(spark, cells), ["cell"], **params).collect()}


def epochs(*cls, scores=None, invalid=()):
    return [(c, k not in invalid, scores[k] if scores else 1.0) for k, c in enumerate(cls)]


def test_decision_order(spark):
    cells = {0: epochs(1, 1, 1, 1), 1: epochs(1, 2, 1, 3, invalid=(3,)), 2: epochs(1, 0, 1, 0), 3: epochs(0, 0, 0, 0)}
    got = votes(spark, cells, ignore=(0,))
    assert got == {0: (1, ND, 1.0, 4), 1: (1, 2, round(2 / 3, 6), 3), 2: (1, ND, 0.5, 4), 3: (ND, ND, 0.0, 4)}


def test_min_count_and_none(spark):
    cells = {0: epochs(1, 1, 2, 0)}
    assert votes(spark, cells, min_count=3, ignore=(0,))[0] == (ND, ND, 0.5, 4)
    assert votes(spark, cells, min_count=2, ignore=(0,))[0][:2] == (1, 2)
    assert votes(spark, {0: epochs(0, 0, 1)})[0][:2] == (0, 1)


@pytest.mark.parametrize(("tie", "want"), [("earliest", (2, 1)), ("latest", (1, 2)), ("highest_score", (1, 2)), ("lowest_id", (1, 2)), ("nodata", (ND, ND))])
def test_ties(spark, tie, want):
    assert votes(spark, {0: epochs(2, 1, 2, 1, scores=[0.1, 0.9, 0.2, 0.5])}, tie=tie)[0][:2] == want


def test_a_shared_second_place_is_nobodys(spark):
    cells = {0: epochs(1, 1, 2, 3)}
    assert votes(spark, cells)[0][:2] == (1, ND)
    assert votes(spark, cells, tie="earliest")[0][:2] == (1, 2)


def test_nodata_is_never_tallied(spark):
    assert votes(spark, {0: epochs(ND, ND, 2)})[0] == (2, ND, round(1 / 3, 6), 3)


def test_no_valid_epoch(spark):
    assert votes(spark, {0: epochs(1, 2, invalid=(0, 1))})[0] == (ND, ND, None, 0)


def test_waiver_and_weights(spark):
    cells = {0: epochs(1, 2, 2, scores=[9.0, 1.0, 1.0])}
    assert votes(spark, cells, weight="score")[0][:3] == (1, 2, round(9 / 11, 6))
    assert votes(spark, cells, weight="score", min_weight=10)[0][0] == ND
    assert votes(spark, cells, weight="score", min_count=2, min_count_unless_score=9.0)[0][0] == 1
    assert votes(spark, cells, weight="score", min_count=2)[0][0] == ND
    with pytest.raises(Exception, match="scores of 0 or more"):
        votes(spark, {0: epochs(1, scores=[-1.0])}, weight="score")


def test_best(spark):
    df = column(spark, {0: [(1, True, 0.5, 1), (2, False, 9.0, 5), (3, True, 0.7, 3)], 1: [(1, True, 5.0, 7), (2, True, 5.0, None)]})
    assert {r.cell: r.best for r in reduce.best(df, ["cell"], "cls").collect()} == {0: 3, 1: 1}
    assert {r.cell: r.best for r in reduce.best(df, ["cell"], "value").collect()} == {0: 3.0, 1: 7.0}


def stat(spark, values, method, us=None, scores=None, **params):
    cells = {0: [(1, v != "x", scores[k] if scores else 1.0, None if v in ("x", None) else v, us[k] if us else None) for k, v in enumerate(values)]}
    return reduce.continuous(column(spark, cells), ["cell"], "value", method, uncertainty="u", **params).first()


def test_statistics(spark):
    for method, want in (("median", 2), ("mean", 7 / 3), ("min", 1), ("max", 4)):
        r = stat(spark, [1, 2, "x", 4], method)
        assert math.isclose(r.value, want) and r.n == 3
    assert stat(spark, [1, 2, "x", 4], "percentile", p=100).value == 4
    assert stat(spark, [1, None, 4], "mean").n == 3
    r = stat(spark, [10, 20, 30], "score_weighted", scores=[-60.0, -30.0, -10.0])
    w = [1e-6, 30 + 1e-6, 50 + 1e-6]
    assert math.isclose(r.value, sum(a * b for a, b in zip(w, (10, 20, 30), strict=True)) / sum(w))
    r = stat(spark, [1, 3, 100, 100], "inverse_variance", us=[1, 2, 0, None])
    assert math.isclose(r.value, (1 + 3 * 0.25) / 1.25) and r.n == 2
    assert math.isclose(stat(spark, [1, 2, 3, 4], "mean", spread="std").spread, math.sqrt(1.25))
    assert math.isclose(stat(spark, [1, 2, 3, 4], "median", spread="iqr").spread, 1.5)


def test_conditional_on_the_winner(spark):
    df = column(spark, {0: [(1, True, 1.0, 0.1), (2, True, 1.0, 0.9), (1, True, 1.0, 0.3)], 1: [(0, True, 1.0, 0.5)] * 3})
    won = reduce.vote(df, ["cell"], ignore=(0,))
    got = {r.cell: (r.value, r.n) for r in reduce.continuous(reduce.concordant(df, won, ["cell"]), ["cell"], "value", "mean").collect()}
    assert math.isclose(got[0][0], 0.2) and got[0][1] == 2 and got[1] == (None, 0)


def test_confirmed_vote(spark):
    df = column(spark, {0: [(1, True, 9.0, 0.5), (2, True, 2.0, 0.1), (2, True, 2.0, 0.3)], 1: [(1, True, 9.0, 0.5)], 2: [(0, True, 1.0, 0.0)], 3: [(1, False, 1.0, 0.0)], 4: [(1, True, 9.0, 0.5), (0, True, 1.0, 0.0)]})
    got = {r.cell: (r.winner, r.n_agree) for r in reduce.confirmed_vote(df, ["cell"], "value").collect()}
    assert got == {0: (2, 2), 1: (1, 1), 2: (0, 0), 3: (ND, 0), 4: (0, 0)}


def test_class_counts(spark):
    cells = spark.createDataFrame([(0, 1), (1, 1), (2, ND)], "cell int, winner int")
    names = spark.createDataFrame([(1, "a"), (2, "b")], "class_id int, name string")
    one = reduce.class_counts(cells, names, "winner")
    assert {r.class_id: r.n_cells for r in one.collect()} == {1: 2, 2: 0}
    parts = spark.createDataFrame([("t", 1, 2), ("t", 1, 3), ("t", 2, None)], "tile string, class_id int, n_cells bigint")
    assert {r.class_id: r.n_cells for r in reduce.merge_class_counts(parts, ["tile", "class_id"]).collect()} == {1: 5, 2: None}
