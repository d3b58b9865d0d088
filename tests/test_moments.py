"""Matched filters and noise from merged moments, against direct linear algebra over all spectra."""

from __future__ import annotations

import numpy as np
import pytest

from cellweave.operators import moments

BANDS = 6
TARGET = np.array([1.0, -0.5, 0.2, 0.7, 0.1, -0.3])


def direct(x, shrink, k):
    """(mean, w) of a filter over raw spectra."""
    mean = x.mean(axis=0)
    cov = np.cov(x, rowvar=False)
    cov = cov - shrink * (cov - np.diag(np.diag(cov)))
    s = TARGET - mean
    if k is None:
        v = np.linalg.inv(cov + np.eye(BANDS) * (np.trace(cov) / BANDS * 1e-9 + 1e-20)) @ s
    else:
        second = x[:, 1:-1] - (x[:, :-2] + x[:, 2:]) / 2
        sigma = np.sqrt(second.var(axis=0) / 1.5)
        sigma = np.r_[sigma[0], sigma, sigma[-1]]
        u, d, _ = np.linalg.svd(cov / sigma[:, None] / sigma[None, :])
        v = sum(u[:, i] * (u[:, i] @ (s / sigma)) / d[i] for i in range(k)) / sigma
    return mean, v / (s @ v)


def cube(rows, cols, seed=4, far=0.0):
    return np.random.default_rng(seed).normal(size=(rows, cols, BANDS)).cumsum(axis=2) + far


def frame(spark, x, names=("row", "col"), without=()):
    cells = [("g", r, c, None if (r, c) in without else x[r, c].tolist()) for r in range(x.shape[0]) for c in range(x.shape[1])]
    return spark.createDataFrame(cells, f"granule string, {names[0]} int, {names[1]} int, reflectance array<double>").repartition(5)


@pytest.mark.parametrize(("k", "trim", "far"), [(None, 0.0, 0.0), (None, 0.0, 1e6), (3, 0.0, 0.0), (None, 0.2, 0.0), (3, 0.2, 0.0)])
def test_windows_like_direct_filters(spark, k, trim, far):
    x, stride, min_n, shrink = cube(11, 13, far=far), 4, 12, 0.1
    without = {(0, 0), (5, 5), (10, 12)}
    found = moments.window_filter(frame(spark, x, without=without), TARGET, stride, min_n, shrink=shrink, k=k, trim=trim).collect()
    stats = {}
    for kr in range(4):
        for kc in range(5):
            own = [x[r, c] for r in range(11) for c in range(13) if abs(r - kr * stride) < stride and abs(c - kc * stride) < stride and (r, c) not in without]
            if len(own) >= min_n:
                own = np.array(own)
                mean, w = direct(own, shrink, k)
                if trim:
                    y = (own - mean) @ w
                    kept = own[y <= np.quantile(y, 1 - trim)]
                    if len(kept) >= min_n:
                        own, (mean, w) = kept, direct(kept, shrink, k)
                stats[kr, kc] = (mean, w, len(own))
    assert len(found) == 11 * 13 - len(without)
    for r in found:
        tents = {w: (1 - abs(r.row - w[0] * stride) / stride) * (1 - abs(r.col - w[1] * stride) / stride) for w in stats if abs(r.row - w[0] * stride) < stride and abs(r.col - w[1] * stride) < stride}
        if not tents:
            assert r.mf is None and r.bg_n is None
            continue
        want = sum(t * ((x[r.row, r.col] - stats[w][0]) @ stats[w][1]) for w, t in tents.items()) / sum(tents.values())
        assert r.mf == pytest.approx(want, rel=1e-5 if far else 1e-9, abs=1e-4 if far else 1e-9)
        assert r.bg_n == pytest.approx(sum(t * stats[w][2] for w, t in tents.items()) / sum(tents.values()))
    assert any(r.mf is not None for r in found)


@pytest.mark.parametrize("trim", [0.0, 0.25])
def test_columns_like_direct_filters(spark, trim):
    x, min_n, shrink = cube(9, 12, seed=7), 16, 0.05
    without = {(r, c) for r in range(9) for c in (3, 4, 7) if r > 1} | {(r, 9) for r in range(9)}
    rows = frame(spark, x, ("s_row", "s_col"), without)
    got = {(r.s_row, r.s_col): (r.mf, r.bg_n) for r in moments.column_filter(rows, TARGET, min_n, 2, trim, shrink=shrink).collect()}

    def fitted(own):
        out = {}
        for c in {c for _, c in own0}:
            for radius in range(3):
                pool = [x[r, k] for r, k in own if abs(k - c) <= radius]
                if len(pool) >= min_n:
                    out[c] = (*direct(np.array(pool), shrink, None), len(pool))
                    break
        return out

    own0 = [(r, c) for r in range(9) for c in range(12) if (r, c) not in without]
    found = fitted(own0)
    if trim:
        y = {(r, c): (x[r, c] - found[c][0]) @ found[c][1] for r, c in own0 if c in found}
        most = {c: np.quantile([v for (_, k), v in y.items() if k == c], 1 - trim) for c in found}
        found |= fitted([(r, c) for r, c in own0 if c not in found or y[r, c] <= most[c]])
    assert set(got) == set(own0)
    for (r, c), (mf, n) in got.items():
        if c in found:
            assert mf == pytest.approx((x[r, c] - found[c][0]) @ found[c][1], abs=1e-9) and n == found[c][2]
        else:
            assert mf is None and n is None


def test_moments_merge_and_send_no_spectra(spark, monkeypatch):
    x = cube(30, 20, seed=1, far=1e5)
    rows = frame(spark, x).selectExpr("*", "col % 3 AS part")
    for held in (1, 1 << 26):
        monkeypatch.setattr(moments, "HELD", held)
        found = moments.moments(rows, ["granule", "part"], "reflectance").collect()
        assert sorted(r.part for r in found) == [0, 1, 2]
        for r in found:
            own = x[:, r.part :: 3].reshape(-1, BANDS)
            assert r.n == len(own)
            np.testing.assert_allclose(np.frombuffer(r["mean"]), own.mean(axis=0), rtol=1e-12)
            np.testing.assert_allclose(np.frombuffer(r.m2).reshape(BANDS, BANDS), np.cov(own, rowvar=False) * (len(own) - 1), rtol=1e-7)
    plan = moments.moments(rows, ["granule"], "reflectance")._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning(granule") :].split("\n")[1]
    assert "MapInArrow" in below or "Project" in below  # matrices are made before the shuffle


def test_noise_has_a_floor_and_needs_three_bands():
    x = cube(1, 200)[0]
    second = x[:, 1:-1] - (x[:, :-2] + x[:, 2:]) / 2
    n, _, m2 = moments.moment(x)
    sigma = moments.noise_sigma(m2, n)
    np.testing.assert_allclose(sigma[1:-1], np.sqrt(second.var(axis=0) / 1.5))
    assert sigma[0] == sigma[1] and sigma[-1] == sigma[-2]
    assert (moments.noise_sigma(np.zeros((4, 4)), 5.0) == 1e-12).all()
    with pytest.raises(ValueError):
        moments.noise_sigma(np.zeros((2, 2)), 5.0)


def test_empty_null_and_short_input(spark):
    rows = spark.createDataFrame([("g", 0, 0, None), ("g", 0, 1, [1.0, None]), ("g", 0, 2, [float("nan"), 1.0]), ("g", 1, 1, [1.0, 2.0]), (None, 1, 1, [1.0, 2.0])], "granule string, row int, col int, reflectance array<double>")
    found = moments.window_filter(rows, [1.0, 0.0], 4).collect()
    assert sorted((r.granule or "", r.mf) for r in found) == [("", None), ("g", None)]
    assert moments.window_filter(rows.where("false"), [1.0, 0.0], 4).count() == 0
    assert moments.column_filter(rows.selectExpr("granule", "row AS s_row", "col AS s_col", "reflectance").where("granule IS NOT NULL"), [1.0, 0.0]).count() == 1
