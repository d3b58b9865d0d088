"""The gated selection on small cells with known answers: gates, votes, ties, thin groups, combined ranks, ten metrics."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from cellweave.operators.gated import ModeGate, gated_scores, select_gated
from cellweave.plans.gated_cases import only

HEM, GOE, JAR, KAO, VEG, ALU = 45, 47, 60, 119, 150, 200
CLASSES = {"none": 0, "Hematite": HEM, "Goethite": GOE, "Jarosite": JAR, "Kaolinite": KAO, "Dry vegetation": VEG, "Alunite": ALU}


def _cells(spark, cells):
    """A cell's looks as (class, class, view zenith[, solar zenith, path length, valid])."""
    rest = (0.0, 402404.0, True)
    full = [(cell, look, *x, *rest[len(x) - 3 :]) for cell, group in enumerate(cells) for look, x in enumerate(group)]
    kind = "cell int, look int, mineral_1 int, mineral_2 int, view_zenith double, solar_zenith double, path_length double, valid boolean"
    return spark.createDataFrame([(c, k, a, b, float(v), float(s), float(p), ok) for c, k, a, b, v, s, p, ok in full], kind)


def _path(share: float) -> float:
    return 402404.0 + share * (452394.0 - 402404.0)


CASES: dict[str, tuple] = {}


def _case(name: str, cells, expected, outputs=("mode_count", "n_voters"), weights=None, **gate):
    """expected: a row of cell, look and outputs for each cell that has a winner."""
    CASES[name] = (cells, expected, outputs, ModeGate(weights=weights or only(vza=1.0), classes=(CLASSES, CLASSES), **gate))


_MODES = ("mode_1", "mode_2", "mode_count", "n_voters")
# The hard gate keeps the best look out, the partial looks are outvoted, equal looks go to the first, nothing detected means no gate, invalid looks don't count.
_case(
    "gate_hard",
    [
        [(HEM, KAO, 20), (GOE, KAO, 1), (HEM, KAO, 12), (GOE, KAO, 25), (HEM, KAO, 8)],
        [(HEM, 0, 1), (HEM, 0, 2), (HEM, 0, 3), (HEM, KAO, 20)],
        [(HEM, KAO, 7), (HEM, KAO, 7), (HEM, KAO, 7)],
        [(0, 0, 9), (0, 0, 3), (0, 0, 6)],
        [(0, 0, 9), (0, 0, 3), (HEM, 0, 6)],
        [(GOE, KAO, 1, 0, 402404, False), (GOE, KAO, 1, 0, 402404, False), (GOE, KAO, 1, 0, 402404, False), (HEM, KAO, 20)],
        [(GOE, KAO, 1, 0, 402404, False)],
    ],
    [(0, 4, 3, 3.0, 5, 5, 0.6, 2, 0.266667), (1, 3, 1, 1.0, 4, 4, 0.25, 3, 0.666667), (2, 0, 3, 3.0, 3, 3, 1.0, 0, 0.233333), (3, 1, 0, 0.0, 0, 3, 0.0, 0, 0.1), (4, 2, 1, 0.01, 1, 3, 0.333333, 0, 0.2), (5, 3, 1, 1.0, 1, 1, 1.0, 0, 0.666667)],
    ("mode_count", "mode_votes", "n_voters", "n_valid", "agreement", "runner_up_count", "selection_penalty"),
)
_case("gate_soft", [[(HEM, KAO, 20), (GOE, KAO, 1), (HEM, KAO, 12)]], [(0, 2, -0.4)], ("score",), gate="soft")
_case("gate_soft_small_penalty", [[(HEM, KAO, 20), (GOE, KAO, 1), (HEM, KAO, 12)]], [(0, 1, -0.133333)], ("score",), gate="soft", soft_penalty=0.1)
_case("gate_partial_votes_whole", [[(HEM, 0, 1), (HEM, 0, 2), (HEM, 0, 3), (HEM, KAO, 20)]], [(0, 0, 3, 4)], partial_vote_weight=1.0)

_TIED = [[(HEM, KAO, 10), (GOE, ALU, 5)]]
_case("tie_weighted", [*_TIED, [(HEM, KAO, 10), (GOE, 0, 9), (GOE, 0, 9)], [(HEM, KAO, 10), (GOE, 0, 5), (GOE, 0, 5)]], [(0, 1, 1, 2), (1, 0, 1, 3), (2, 1, 2, 3)], partial_vote_weight=0.5)
_case("tie_earliest", _TIED, [(0, 0, 1, 2)], tie_break="earliest")
_case("tie_latest", _TIED, [(0, 1, 1, 2)], tie_break="latest")
_case("tie_nodata", [*_TIED, [(HEM, KAO, 10)]], [(1, 0, 1, 1)], tie_break="nodata")

_case("gate_min_count", [[(HEM, KAO, 3), (HEM, KAO, 4), (GOE, KAO, 1)], [(HEM, KAO, 3), (GOE, KAO, 1)]], [(0, 0, 2, 3)], min_count=2)
_VEGETATED = [[(HEM, VEG, 1), (HEM, VEG, 2), (HEM, VEG, 3), (GOE, KAO, 9), (GOE, KAO, 8)], [(0, VEG, 2), (0, 0, 20)], [(0, VEG, 2), (HEM, 0, 20)], [(0, VEG, 2), (HEM, VEG, 20)]]
_case("gate_ignored_classes", _VEGETATED, [(0, 4, 2, 2, 0.4), (1, 1, 0, 0, 0.0), (2, 1, 1, 1, 0.5)], ("mode_count", "n_voters", "agreement"), ignore={"g2": ["Dry vegetation"]})
_case("gate_ignored_soft", [[(0, VEG, 2), (0, 0, 20)], [(0, VEG, 2)]], [(0, 1, -0.666667), (1, 0, -10.066667)], ("score",), gate="soft", ignore={"g2": ["Dry vegetation"]})
_MASKED = [[(HEM, VEG, 1), (HEM, VEG, 2), (HEM, VEG, 3), (HEM, KAO, 9), (HEM, KAO, 8)]]
_case("gate_masked_classes", _MASKED, [(0, 4, 2, 5)], g2_mask_classes=["Dry vegetation"])
_case("gate_masked_classes_whole", _MASKED, [(0, 0, 3, 5)], g2_mask_classes=["Dry vegetation"], partial_vote_weight=1.0)

_case("gate_score_votes", [[(HEM, KAO, 27), (HEM, KAO, 27), (HEM, KAO, 27), (GOE, ALU, 0), (GOE, ALU, 3)], [(HEM, KAO, 12), (HEM, KAO, 12), (HEM, KAO, 12), (GOE, ALU, 6), (GOE, ALU, 6)]], [(0, 3, 2, 1.9), (1, 0, 3, 1.8)], ("mode_count", "mode_votes"), vote_weight="score")
_case("gate_score_votes_sharpened", [[(HEM, KAO, 12), (HEM, KAO, 12), (HEM, KAO, 12), (GOE, ALU, 6), (GOE, ALU, 6)]], [(0, 3, 2, 0.8192)], ("mode_count", "mode_votes"), vote_weight="score", vote_power=4)
_case("gate_rank_normalised", [[(HEM, KAO, 50), (HEM, KAO, 40), (HEM, KAO, 45)]], [(0, 1, 0.0)], ("selection_penalty",), normalize="rank")

_THIN = [(0, KAO, 5 + k) for k in range(10)]
_case(
    "independent_hard",
    [
        [(HEM, ALU, 1), (HEM, KAO, 9), (GOE, KAO, 2), (HEM, KAO, 7)],
        [*_THIN, (HEM, KAO, 20)],
        [*_THIN, (HEM, KAO, 1)],
    ],
    [(0, 3, 2, HEM, KAO), (1, 10, 1, HEM, KAO), (2, 10, 1, HEM, KAO)],
    ("mode_count", "mode_1", "mode_2"),
    key="independent",
)
_case("independent_thin_group", [[*_THIN, (HEM, KAO, 20)], [*_THIN, (HEM, KAO, 1)], [(HEM, KAO, 1), (GOE, ALU, 2), (0, 0, 3)]], [(0, 0, 11, None, KAO), (1, 10, 11, None, KAO)], ("mode_count", "mode_1", "mode_2"), key="independent", min_count=3)
_case("independent_tie_nodata", [[(HEM, KAO, 2), (GOE, KAO, 1)]], [(0, 1, None, KAO)], ("mode_1", "mode_2"), key="independent", tie_break="nodata")
_case("independent_soft", [[(0, 0, 9), (HEM, KAO, 1), (0, 0, 3), (0, 0, 6)], [(HEM, ALU, 1), (HEM, 0, 2), (HEM, 0, 3), (GOE, KAO, 4), (GOE, KAO, 5)]], [(0, 1, HEM, KAO, 1, 1), (1, 0, HEM, KAO, 0, 5)], _MODES, key="independent", gate="soft")
_case("independent_nondetects_vote", [[(0, 0, 9), (HEM, KAO, 1), (0, 0, 3), (0, 0, 6)]], [(0, 2, 0, 0, 3, 4)], _MODES, key="independent", gate="soft", nondetect="vote")
_case("independent_unconfirmed_is_none", [[(HEM, KAO, 1), (0, 0, 9), (0, 0, 4)], [(HEM, KAO, 1), (HEM, 0, 9), (0, 0, 4)]], [(0, 2, 0, 0, 2, 1), (1, 1, HEM, 0, 1, 2)], _MODES, key="independent", min_count=2, below_min_count="none")
_case("independent_ignored", [[(HEM, VEG, 1), (HEM, VEG, 2), (HEM, KAO, 9)], [(HEM, VEG, 1), (HEM, VEG, 2), (HEM, VEG, 3), (GOE, KAO, 9), (GOE, KAO, 8)]], [(0, 2, HEM, KAO, 1, 3)], _MODES, key="independent", ignore={"g2": ["Dry vegetation"]})

_THREE = only(vza=1.0, sza=1.0, path_length=1.0)
_XYZ = [(HEM, KAO, 1, 10, _path(0.9)), (HEM, KAO, 2, 11, _path(0.1)), (HEM, KAO, 3, 12, _path(0.2))]
_CROWD = [*_XYZ, (GOE, ALU, 29, 69, _path(0.3)), (JAR, ALU, 29.5, 69.5, _path(0.4))]
_two = [[(HEM, KAO, 1, 10, _path(0.9)), (GOE, ALU, 2, 11, _path(0.1))]]
_case("combine_weighted", [_XYZ], [(0, 1, 0.107937)], ("selection_penalty",), weights=_THREE)
_case("combine_borda", [_XYZ, _CROWD], [(0, 1, 0.0), (1, 1, 0.0)], ("score",), weights=_THREE, combine="borda")
_case("combine_copeland", [_XYZ, _CROWD], [(0, 0, 0.0, 0.358730), (1, 0, 0.0, 0.358730)], ("score", "selection_penalty"), weights=_THREE, combine="copeland")
_case("combine_hybrid", [_XYZ, _CROWD], [(0, 0, 0.0), (1, 0, 0.0)], ("score",), weights=_THREE, combine="hybrid")
_case("combine_copeland_tie_weighted", _two, [(0, 1, GOE, ALU, 1, 2)], _MODES, weights=_THREE, combine="copeland")
_case("tie_combine", _two, [(0, 0, HEM, KAO, 1, 2)], _MODES, weights=_THREE, combine="copeland", tie_break="combine")
_case("tie_combine_independent", _two, [(0, 0, HEM, KAO, 1, 2)], _MODES, weights=_THREE, combine="hybrid", tie_break="combine", key="independent")

_TEN = (HEM, 0, 0.015, 0.0, 0.25, 0.0, 0.1, 0.3, 0.2, 0.25, 0.7, 35.0, 6.0, 427399.0)
_TEN_COLUMNS = "mineral_1 mineral_2 mineral_unc mineral_2_unc mineral_fit mineral_2_fit mineral_depth mineral_2_depth cloud_prob cloud_fraction frcov solar_zenith view_zenith path_length".split()


@pytest.mark.parametrize("name", CASES)
def test_known_answers(spark, name):
    cells, expected, outputs, spec = CASES[name]
    out = select_gated(_cells(spark, cells), ["cell"], ["look"], spec).select("cell", "look", *[F.col(c).cast("double").alias(c) for c in outputs])
    got = sorted((r.cell, r.look, *(None if r[c] is None else round(r[c], 6) for c in outputs)) for r in out.collect())
    assert got == sorted(expected)


def test_ten_metrics(spark):
    """All ten, a look that lacks every one, and one whose second group detects nothing."""
    whole = (0, 0, *_TEN)
    empty = (1, 0, HEM, KAO, *[None] * 12)
    nan = (2, 0, HEM, KAO, *[float("nan")] * 12)
    low = (3, 0, 0, 0, 0.0, 0.0, 0.0, 0.0, 0.1, 0.3, 0.0, None, 1.0, 89.99, 90.0, 402404.0)
    df = spark.createDataFrame([whole, empty, nan, low], "cell int, look int, mineral_1 int, mineral_2 int, " + ", ".join(f"{c} double" for c in _TEN_COLUMNS[2:])).withColumn("valid", F.lit(True))
    got = {r.cell: r.selection_penalty for r in gated_scores(df, ["cell"], ["look"], ModeGate()).collect()}
    air = 1 / math.cos(math.radians(35)) + 1 / math.cos(math.radians(6)) - 2
    want = {0: (0.015 / 0.03 + (1 - 0.25 / 0.5) + (1 - 0.2 / 0.5) + 0.2 + 0.25 + 0.3 + 35 / 70 + 6 / 30 + 0.5 + air / 2) / 10, 1: 1.0, 2: 1.0, 3: (1 + 1 + 0.6 + 0 + 1 + 0 + 1 + 1 + 0 + 1) / 10}
    assert got == pytest.approx(want, abs=1e-6)
