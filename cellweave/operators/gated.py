"""The look that best shows what a cell's looks agree on: a vote on class pairs, a gate, and ranked metrics.

All looks of a cell's epoch vote on the pair of their two classes (or on each class alone); looks that
don't hold the winning pair are kept out or put behind; of the others the one of least penalty wins.
Everything is windows over the same keys, so looks are shuffled once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.functions.columns import airmass, clip, mean_of_present, nan_to_null
from cellweave.operators.rank import average_rank, copeland_points

# FIXED: metric -> (weight, lowest, highest, which end is better, columns).
METRICS: dict[str, tuple[float, float, float, str, tuple[str, ...]]] = {
    "bd_unc": (0.2, 0.0, 0.03, "low", ("mineral_unc", "mineral_2_unc")),
    "fit": (0.2, 0.0, 0.5, "high", ("mineral_fit", "mineral_2_fit")),
    "banddepth": (0.2, 0.0, 0.5, "high", ("mineral_depth", "mineral_2_depth")),
    "cloud_prob": (0.2, 0.0, 1.0, "low", ("cloud_prob",)),
    "scene_cloudiness": (0.2, 0.0, 1.0, "low", ("cloud_fraction",)),
    "bare": (0.2, 0.0, 1.0, "high", ("frcov",)),
    "sza": (0.2, 0.0, 70.0, "low", ("solar_zenith",)),
    "vza": (0.2, 0.0, 30.0, "low", ("view_zenith",)),
    "path_length": (0.2, 402404.0, 452394.0, "low", ("path_length",)),
    "airmass": (0.2, 2.0, 4.0, "low", ("solar_zenith", "view_zenith")),
}
CHOICES = {
    "key": ("joint", "independent"),
    "gate": ("hard", "soft"),
    "tie_break": ("weighted", "combine", "earliest", "latest", "nodata"),
    "combine": ("weighted", "borda", "copeland", "hybrid"),
    "normalize": ("fixed", "rank"),
    "vote_weight": ("count", "score"),
    "nondetect": ("abstain", "vote"),
    "below_min_count": ("nodata", "none"),
}
OUTPUTS = ("mode_count", "mode_votes", "n_voters", "n_valid", "agreement", "runner_up_count", "selection_penalty", "mode_1", "mode_2")
#: Votes this close are equal.
CLOSE = 1e-7


@dataclass(frozen=True)
class ModeGate:
    """What to vote on, whom to let through, and how to rank them.

    key                 joint: pairs are voted on; independent: each group by itself, and only looks with both answers pass
    ignore              by group: classes that don't vote; a look with one never matches
    g2_mask_classes     classes that count as none in group 2
    partial_vote_weight what the vote of a look counts that detects in one group only (joint)
    vote_weight         score: a vote counts (1 - penalty) ** vote_power
    nondetect           vote: looks that detect nothing vote for none
    tie_break           weighted: the pair of the tied look with the least penalty (a partial look's has partial_tie_penalty added);
                        combine: of the tied look that the combination ranks first; nodata: nobody wins
    below_min_count     none: a mode of too few looks becomes none; nodata: the cell (or the group) has no answer
    normalize           rank: a metric's rank among the cell's looks in place of its place within bounds
    combine             borda, copeland, hybrid: looks that pass are ranked by ballots, one a metric; penalty breaks ties
    Classes are named; class names come from `classes`, one mapping of name to id a group.
    """

    layers: tuple[str, str] = ("mineral_1", "mineral_2")
    key: str = "joint"
    ignore: Mapping[str, Sequence[str]] = field(default_factory=dict)
    g2_mask_classes: Sequence[str] = ()
    min_count: int = 1
    tie_break: str = "weighted"
    gate: str = "hard"
    soft_penalty: float = 10.0
    partial_vote_weight: float = 0.01
    partial_tie_penalty: float = 0.05
    vote_weight: str = "count"
    vote_power: float = 1.0
    nondetect: str = "abstain"
    below_min_count: str = "nodata"
    normalize: str = "fixed"
    combine: str = "weighted"
    weights: Mapping[str, float] = field(default_factory=dict)
    bounds: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    aliases: Mapping[str, Sequence[str]] = field(default_factory=dict)
    classes: tuple[Mapping[str, int], Mapping[str, int]] = ({}, {})

    def __post_init__(self):
        problems = [f"{k} is one of {c}: {getattr(self, k)!r}" for k, c in CHOICES.items() if getattr(self, k) not in c]
        if len(self.layers) != 2 or self.layers[0] == self.layers[1]:
            problems.append("layers are two different ones")
        if self.combine != "weighted" and self.gate != "hard":
            problems.append("a combination ranks only looks that pass, so it needs the hard gate")
        if set(self.ignore) - {"g1", "g2"}:
            problems.append("ignore is by g1 and g2")
        named = [*self.ignore.values(), self.g2_mask_classes]
        if any(isinstance(x, str) or not all(isinstance(n, str) for n in x) for x in named):
            problems.append("classes are lists of NAMES")
        if self.min_count < 1 or self.vote_power <= 0 or self.soft_penalty < 0 or self.partial_tie_penalty < 0 or not 0 <= self.partial_vote_weight <= 1:
            problems.append("min_count is 1 or more, vote_power above 0, penalties not negative, partial_vote_weight within 0..1")
        unknown = {*self.weights, *self.bounds, *self.aliases} - set(METRICS)
        if unknown:
            problems.append(f"unknown metrics {sorted(unknown)}")
        if any(w < 0 for w in self.weights.values()) or (not unknown and not any(self.weights.get(m, x[0]) for m, x in METRICS.items())):
            problems.append("weights aren't negative, and one is above 0")
        if any(not lo < hi for lo, hi in self.bounds.values()):
            problems.append("bounds are lowest, highest")
        if any(m in METRICS and (isinstance(a, str) or len(a) != len(METRICS[m][4])) for m, a in self.aliases.items()):
            problems.append("aliases name as many columns as the metric reads")
        if problems:
            raise ValueError("; ".join(problems))

    def shares(self) -> dict[str, float]:
        """The metrics that count, with weights that sum to 1."""
        w = {m: self.weights.get(m, x[0]) for m, x in METRICS.items()}
        total = sum(w.values())
        return {m: x / total for m, x in w.items() if x > 0}

    def columns(self) -> list[str]:
        """What the metrics read; a look that lacks one isn't valid, so these are required."""
        return list(dict.fromkeys(c for m in self.shares() if m != "scene_cloudiness" for c in self._read(m)))

    def _read(self, metric: str) -> Sequence[str]:
        return self.aliases.get(metric, METRICS[metric][4])

    def ids(self, group: int, names: Sequence[str]) -> list[int]:
        missing = [n for n in names if n not in self.classes[group]]
        if missing:
            raise ValueError(f"{self.layers[group]} has no classes {missing}")
        return [self.classes[group][n] for n in names]

    def raw(self, metric: str, g1: Column, g2: Column) -> Column:
        """A look's value, NULL where it is missing."""
        cols = [nan_to_null(F.col(c).cast("double")) for c in self._read(metric)]
        if metric in ("bd_unc", "fit"):  # the product writes 0, not fill, where a group detects nothing
            cols = [F.when(g > 0, c) for g, c in zip((g1, g2), cols, strict=True)]
        if metric in ("bd_unc", "fit", "banddepth"):
            mean = mean_of_present(*cols)
            return F.when(mean.isNotNull(), clip(mean, 0.0, 1.0))
        if metric in ("cloud_prob", "bare"):
            return F.when(cols[0].isNotNull(), clip(cols[0], 0.0, 1.0))
        if metric == "vza":
            return F.when(cols[0].isNotNull(), clip(cols[0], 0.0, 90.0))
        if metric == "airmass":
            return airmass(*[F.when(c.isNotNull(), clip(c, 0.0, 90.0)) for c in cols])
        return cols[0]


def _marked(c: Column, ids: Sequence[int]) -> Column:
    return c.isin(*ids) if ids else F.lit(False)


def gated_scores(looks: DataFrame, keys: Sequence[str], order: Sequence[str], gate: ModeGate, valid: str = "valid") -> DataFrame:
    """looks with score (NULL: may not win) and OUTPUTS; order: columns that place a cell's looks, the first first."""
    all_looks, lay1, lay2 = Window.partitionBy(*keys), *gate.layers

    def over(c: Column) -> Column:
        return c.over(all_looks)

    ok = F.coalesce(F.col(valid), F.lit(False))
    seen = [F.when(ok, F.greatest(F.coalesce(F.col(c), F.lit(0)), F.lit(0))).otherwise(0).cast("bigint") for c in (lay1, lay2)]
    rows = looks.withColumns({"__ok": ok, "__g1": seen[0], "__g2": seen[1]})
    rows = rows.withColumn("__g2", F.when(_marked(F.col("__g2"), gate.ids(1, gate.g2_mask_classes)), 0).otherwise(F.col("__g2")))
    ids = [gate.ids(k, [n for n in gate.ignore.get(g, ()) if n != "none"]) for k, g in enumerate(("g1", "g2"))]
    rows = rows.withColumns({f"__out{k + 1}": _marked(F.col(f"__g{k + 1}"), ids[k]) for k in range(2)})
    g1, g2, ok, out = F.col("__g1"), F.col("__g2"), F.col("__ok"), F.col("__out1") | F.col("__out2")
    rows = rows.withColumns({"__place": F.row_number().over(all_looks.orderBy(*order)), "n_valid": over(F.count_if(ok))})

    shares, ballots = gate.shares(), []
    for m in shares:
        lo, hi = gate.bounds.get(m, METRICS[m][1:3])
        low = METRICS[m][3] == "low"
        value = f"__raw_{m}"
        rows = rows.withColumn(value, F.when(ok, gate.raw(m, g1, g2)))
        if gate.normalize == "rank":
            n = over(F.count(value))
            by = F.col(value) if low else -F.col(value)
            penalty = F.when(F.col(value).isNull(), 1.0).when(n <= 1, 0.0).otherwise(average_rank(by, keys) / F.greatest(n - 1, F.lit(1)))
        else:
            share = clip((F.col(value) - lo) / (hi - lo), 0.0, 1.0)
            penalty = F.when(F.col(value).isNull(), 1.0).otherwise(share if low else 1 - share)
        rows = rows.withColumn(f"__p_{m}", penalty).drop(value)
        ballots.append(f"__p_{m}")
    rows = rows.withColumn("selection_penalty", F.round(sum((F.lit(w) * F.col(f"__p_{m}") for m, w in shares.items()), F.lit(0.0)), 9))
    p = F.col("selection_penalty")

    def ranked(rows: DataFrame, candidate: str, fallback: str, name: str) -> DataFrame:
        """Adds name: a candidate's place under the combination, 0 the best; NULL for others."""
        by = []
        if gate.combine in ("borda", "hybrid"):
            n = over(F.count_if(F.col(candidate)))
            points = sum((n - 1 - average_rank(F.when(F.col(candidate), F.col(b)), keys) for b in ballots), F.lit(0.0))
            rows = rows.withColumn(f"{name}_b", F.when(F.col(candidate), points))
            by.append(F.col(f"{name}_b").desc_nulls_last())
        if gate.combine in ("copeland", "hybrid"):
            rows = rows.withColumn(f"{name}_c", F.when(F.col(candidate), copeland_points(keys, "__place", ballots, F.col(candidate))))
            by.append(F.col(f"{name}_c").desc_nulls_last())
        own = Window.partitionBy(*keys).orderBy(F.col(candidate).desc(), *by, F.col(fallback).asc())
        return rows.withColumn(name, F.when(F.col(candidate), F.dense_rank().over(own) - 1)).drop(f"{name}_b", f"{name}_c")

    def mode(rows: DataFrame, tag: str, code: Column, weight: Column, voters: Column, tie_score: Column) -> DataFrame:
        """Adds tag_mode, tag_has, tag_drop, tag_votes, tag_count and tag_runner."""
        code_of = Window.partitionBy(*keys, f"{tag}_code")
        rows = rows.withColumns({f"{tag}_voter": voters, f"{tag}_code": F.when(voters, code), f"{tag}_weight": F.when(voters, weight), f"{tag}_tie": F.round(tie_score, 9)})
        voter, own = F.col(f"{tag}_voter"), F.col(f"{tag}_code")
        rows = rows.withColumns({f"{tag}_v": F.when(voter, F.sum(f"{tag}_weight").over(code_of)), f"{tag}_n": F.when(voter, F.count("*").over(code_of))})
        rows = rows.withColumn(f"{tag}_top", voter & (F.col(f"{tag}_v") >= over(F.max(f"{tag}_v")) - CLOSE))
        top = F.col(f"{tag}_top")
        if gate.tie_break == "combine":
            rows = ranked(rows, f"{tag}_top", f"{tag}_tie", f"{tag}_rank")
        first = {"latest": [-F.col("__place")], "weighted": [F.col(f"{tag}_tie")], "combine": [F.col(f"{tag}_rank")]}.get(gate.tie_break, [])
        pick = F.struct(*[c.alias(f"f{k}") for k, c in enumerate([*first, F.col("__place")])], own.alias("code"), F.col(f"{tag}_v").alias("votes"), F.col(f"{tag}_n").alias("n"))
        rows = rows.withColumn(f"{tag}_won", over(F.min(F.when(top, pick))))
        won = F.col(f"{tag}_won")
        has, n = won.isNotNull(), F.coalesce(won["n"], F.lit(0))
        short = has & (n < gate.min_count)
        found, votes = won["code"], F.coalesce(won["votes"], F.lit(0.0))
        drop = short
        if gate.below_min_count == "none":
            none = F.coalesce(over(F.max(F.when(own == 0, F.col(f"{tag}_n")))), F.lit(0))
            found, votes, n, drop = F.when(short, 0).otherwise(found), F.when(short, 0.0).otherwise(votes), F.when(short, none).otherwise(n), F.lit(False)
        if gate.tie_break == "nodata":
            drop = drop | (has & (over(F.min(F.when(top, own))) != over(F.max(F.when(top, own)))))
        rows = rows.withColumns({f"{tag}_mode": found, f"{tag}_has": has, f"{tag}_drop": drop, f"{tag}_votes": votes, f"{tag}_count": n})
        return rows.withColumn(f"{tag}_runner", F.coalesce(over(F.max(F.when(own != F.col(f"{tag}_mode"), F.col(f"{tag}_n")))), F.lit(0)))

    quality = F.pow(1 - p, F.lit(gate.vote_power)) if gate.vote_weight == "score" else F.lit(1.0)
    none_votes = F.lit(gate.nondetect == "vote")
    if gate.key == "joint":
        partial = (g1 > 0) != (g2 > 0)
        weight = F.when(partial, gate.partial_vote_weight).otherwise(1.0) * quality
        tie = p + F.when(partial, gate.partial_tie_penalty).otherwise(0.0)
        rows = mode(rows, "__j", F.shiftleft(g1, 32).bitwiseOR(g2), weight, ok & ((g1 > 0) | (g2 > 0) | none_votes) & ~out, tie)
        code, has, drop = F.shiftleft(g1, 32).bitwiseOR(g2), F.col("__j_has"), F.col("__j_drop")
        match = (F.coalesce(code == F.col("__j_mode"), F.lit(False)) | ~has) & ~out
        answers = [(F.shiftright("__j_mode", 32), has, drop), (F.col("__j_mode").bitwiseAND(F.lit(0xFFFFFFFF)), has, drop)]
        rows = rows.withColumns({"__match": match, "n_voters": over(F.count_if(F.col("__j_voter"))), "mode_count": F.col("__j_count"), "mode_votes": F.col("__j_votes"), "runner_up_count": F.col("__j_runner")})
    else:
        for k, g in ((1, g1), (2, g2)):
            rows = mode(rows, f"__i{k}", g, quality, ok & ((g > 0) | none_votes) & ~F.col(f"__out{k}"), p)
        own = [(F.coalesce(g == F.col(f"__i{k}_mode"), F.lit(False)) | ~F.col(f"__i{k}_has") | F.col(f"__i{k}_drop")) for k, g in ((1, g1), (2, g2))]
        has, drop = F.col("__i1_has") | F.col("__i2_has"), F.col("__i1_drop") & F.col("__i2_drop")
        answers = [(F.col(f"__i{k}_mode"), F.col(f"__i{k}_has"), F.col(f"__i{k}_drop")) for k in (1, 2)]
        rows = rows.withColumn("__match", own[0] & own[1] & ~out)
        both = F.when(has, over(F.count_if(ok & F.col("__match")))).otherwise(0)
        rows = rows.withColumns({"n_voters": over(F.count_if(F.col("__i1_voter") | F.col("__i2_voter"))), "mode_count": both, "runner_up_count": F.lit(None).cast("bigint")})
        rows = rows.withColumn("mode_votes", F.col("mode_count").cast("double"))
    rows = rows.withColumn("__may", ok & ~drop)
    match = F.col("__match")
    if gate.combine != "weighted":
        rows = ranked(rows.withColumn("__in", F.col("__may") & match), "__in", "selection_penalty", "__rank")
        score = -F.col("__rank").cast("double")
    else:
        score = F.when(match, -p)
        if gate.gate == "soft":
            score = F.coalesce(score, -(p + gate.soft_penalty))
    told = {f"mode_{k}": F.when((F.col("n_valid") > 0) & ~drop_g, F.when(has_g, code).otherwise(0)) for k, (code, has_g, drop_g) in enumerate(answers, 1)}
    rows = rows.withColumns({"score": F.when(F.col("__may"), score), "agreement": F.when(F.col("n_valid") > 0, F.col("mode_count") / F.col("n_valid")), **told})
    return rows.select(*[F.col(f"`{c}`") for c in looks.columns if c not in ("score", *OUTPUTS)], "score", *OUTPUTS)


def select_gated(looks: DataFrame, keys: Sequence[str], order: Sequence[str], gate: ModeGate, keep: Sequence[str] = (), valid: str = "valid") -> DataFrame:
    """(keys, order, score, keep, OUTPUTS) of the look that wins each cell's epoch; no row where none may."""
    from cellweave.operators.resolve import winners

    return winners(gated_scores(looks, keys, order, gate, valid), keys, order, [*keep, *OUTPUTS], valid=valid)
