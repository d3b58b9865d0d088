"""Temporal reduction: what the epochs of a cell agree on.

Input is one row a cell and epoch (a snapshot): whether it was observed, is
valid, its class or value, and the score it won with. Every operator is one
or two aggregations by cell; ties are settled by total orders, never by
arrival, so partitioning can't change a result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.functions.columns import NODATA_CLASS, nan_to_null

TIES = ("earliest", "latest", "highest_score", "lowest_id", "nodata")


def vote(
    snaps: DataFrame,
    keys: Sequence[str],
    cls: str = "cls",
    epoch: str = "epoch",
    valid: str = "valid",
    score: str = "score",
    ignore: Sequence[int] = (),
    weight: str = "count",
    tie: str = "nodata",
    min_count: int = 1,
    min_weight: float | None = None,
    min_count_unless_score: float | None = None,
) -> DataFrame:
    """(keys, winner, runner_up, agreement, n_epochs).

    Classes are tallied over valid epochs by count or by score; ignored ones and no-data are left out but stay in the denominator.
    Ties of the tally are settled by `tie`, then by the lowest id; under `nodata` a shared first (or second) place is nobody's.
    A winner below min_count is suppressed unless its best score reaches min_count_unless_score, one below min_weight always;
    agreement is told either way, the runner-up only beside a winner.
    """
    if tie not in TIES or weight not in ("count", "score"):
        raise ValueError(f"unknown tie or weight: {tie}, {weight}")
    is_valid, mark = F.col(valid), nan_to_null(F.col(score).cast("double"))
    counted = F.when(is_valid & ~F.col(cls).isin(NODATA_CLASS, *ignore), F.col(cls))
    # One row a cell and class (NULL: nothing to tally), with what the cell's totals need, then one row a cell.
    by_class = snaps.groupBy(*keys, counted.alias("__cls")).agg(
        F.count_if(is_valid).alias("__cnt"),
        F.sum(F.when(is_valid, mark)).alias("__sum"),
        F.min(F.when(is_valid, F.coalesce(mark, F.lit(-1.0)))).alias("__low"),
        F.max(F.when(is_valid, mark)).alias("__top"),
        F.min(epoch).alias("__first"),
        F.max(epoch).alias("__last"),
    )
    last = -F.unix_micros("__last") if dict(snaps.dtypes)[epoch].startswith("timestamp") else -F.col("__last")
    prefer = {"earliest": F.col("__first"), "latest": last, "highest_score": F.coalesce(-F.col("__top"), F.lit(float("inf")))}.get(tie, F.lit(0))
    by_class = by_class.withColumn("__tally", F.col("__cnt").cast("double") if weight == "count" else F.col("__sum"))
    entry = F.struct((-F.col("__tally")).alias("__o1"), prefer.alias("__o2"), "__cls", "__tally", "__cnt", "__top")
    per = by_class.groupBy(*keys).agg(
        F.sum("__cnt").alias("n_epochs"),
        F.sum("__sum").alias("__all"),
        F.min("__low").alias("__low"),
        F.array_sort(F.collect_list(F.when(F.col("__cls").isNotNull(), entry))).alias("__tallies"),
    )
    if weight == "score":
        per = per.withColumn("__all", F.when(F.col("__low") < 0, F.raise_error(F.lit("a vote weighted by score needs scores of 0 or more"))).otherwise(F.col("__all")))
    out = per.select(*keys, "n_epochs", "__all", *[F.get("__tallies", F.lit(k)).alias(f"__{k + 1}") for k in range(3)])
    first, second, third = (F.col(f"__{k}") for k in (1, 2, 3))
    shared = F.coalesce(first["__tally"] == second["__tally"], F.lit(False)) if tie == "nodata" else F.lit(False)
    shared_second = F.coalesce(second["__tally"] == third["__tally"], F.lit(False)) if tie == "nodata" else F.lit(False)
    waived = F.coalesce(first["__top"] >= min_count_unless_score, F.lit(False)) if min_count_unless_score is not None else F.lit(False)
    short = (first["__cnt"] < min_count) & ~waived
    light = first["__tally"] < min_weight if min_weight is not None else F.lit(False)
    wins = first.isNotNull() & ~shared & ~short & ~light
    out_of = F.col("n_epochs").cast("double") if weight == "count" else F.col("__all")
    return out.select(
        *keys,
        F.when(wins, first["__cls"]).otherwise(NODATA_CLASS).cast("int").alias("winner"),
        F.when(wins & second.isNotNull() & ~shared_second, second["__cls"]).otherwise(NODATA_CLASS).cast("int").alias("runner_up"),
        F.when(F.col("n_epochs") == 0, None).when(first.isNull() | (out_of == 0), F.lit(0.0)).otherwise(first["__tally"] / out_of).alias("agreement"),
        "n_epochs",
    )


def best(snaps: DataFrame, keys: Sequence[str], value: str, epoch: str = "epoch", valid: str = "valid", score: str = "score") -> DataFrame:
    """(keys, best): the value of the valid epoch with the highest score, the first of equals; a NULL there is delivered."""
    ok = F.col(valid) & nan_to_null(F.col(score).cast("double")).isNotNull()
    row = F.struct(F.col(score).alias("s"), (-F.col(epoch)).alias("e"))
    return snaps.groupBy(*keys).agg(F.max_by(F.col(value), F.when(ok, row)).alias("best"))


def statistic(value: Column, selected: Column, method: str, p: float | None = None) -> Column:
    x = nan_to_null(F.when(selected, value).cast("double"))
    if method == "percentile":
        return F.percentile(x, p / 100)
    return {"median": F.median, "mean": F.avg, "min": F.min, "max": F.max, "std": F.stddev_pop}[method](x)


def continuous(snaps: DataFrame, keys: Sequence[str], value: str, method: str, valid: str = "valid", score: str = "score", uncertainty: str | None = None, p: float | None = None, spread: str | None = None) -> DataFrame:
    """(keys, value, n[, spread]) over valid epochs; NULL and NaN values count in n but not in the statistic.

    score_weighted     weights are scores above the least selected one, plus 1e-6
    inverse_variance   weights are 1/u^2; epochs without a value or a positive u are left out of n too
    """
    on, x = F.col(valid), nan_to_null(F.col(value).cast("double"))
    n = F.count_if(on)
    if method == "score_weighted":
        mark = nan_to_null(F.col(score).cast("double"))
        low = F.min(F.when(on, mark)).over(Window.partitionBy(*keys))
        snaps = snaps.withColumn("__w", F.when(on & x.isNotNull(), mark - low + 1e-6))
        found = F.sum(F.col("__w") * x) / F.sum("__w")
    elif method == "inverse_variance":
        u = nan_to_null(F.col(uncertainty).cast("double"))
        use = on & x.isNotNull() & (u > 0)
        w = F.when(use, 1 / (u * u))
        found, n = F.sum(w * x) / F.sum(w), F.count_if(use)
    else:
        found = statistic(x, on, method, p)
    out = [found.alias("value"), n.alias("n")]
    if spread == "std":
        out.append(statistic(x, on, "std").alias("spread"))
    elif spread == "iqr":
        out.append((statistic(x, on, "percentile", 75) - statistic(x, on, "percentile", 25)).alias("spread"))
    return snaps.groupBy(*keys).agg(*out)


def concordant(snaps: DataFrame, winners: DataFrame, keys: Sequence[str], cls: str = "cls", valid: str = "valid") -> DataFrame:
    """Snapshots whose valid rows are narrowed to those that have the delivered class."""
    won = winners.select(*keys, F.col("winner").alias("__won"))
    out = snaps.join(won, list(keys))
    return out.withColumn(valid, F.col(valid) & (F.col(cls) == F.col("__won"))).drop("__won")


def epoch_counts(snaps: DataFrame, keys: Sequence[str], valid: str = "valid", observed: str = "observed") -> DataFrame:
    """(keys, n_epochs, n_observed): valid epochs, and those that any look reached."""
    return snaps.groupBy(*keys).agg(F.count_if(F.col(valid)).alias("n_epochs"), F.count_if(F.col(observed)).alias("n_observed"))


def class_counts(cells: DataFrame, classes: DataFrame, cls: str, class_id: str = "class_id") -> DataFrame:
    """Each class with the number of its cells, 0 if none; no-data isn't counted."""
    n = cells.where(F.col(cls) != NODATA_CLASS).groupBy(F.col(cls).alias(class_id)).agg(F.count("*").alias("__n"))
    return classes.join(n, class_id, "left").withColumn("n_cells", F.coalesce("__n", F.lit(0))).drop("__n")


def merge_class_counts(parts: DataFrame, keys: Sequence[str], n: str = "n_cells") -> DataFrame:
    """Counts of tiles summed; a class that no tile counted stays NULL."""
    return parts.groupBy(*keys).agg(F.sum(n).alias(n))


def joint_vote(snaps: DataFrame, keys: Sequence[str], prefer: str, fallback: str, **params) -> DataFrame:
    """(keys, winner, source, agreement): the vote of one layer, else of the other; source 2 preferred, 1 fallback, 0 none."""
    params = {"min_count": 2, "ignore": (0,), "tie": "highest_score"} | params
    a = vote(snaps, keys, cls=prefer, **params).select(*keys, F.col("winner").alias("__a"), F.col("agreement").alias("__ga"))
    b = vote(snaps, keys, cls=fallback, **params).select(*keys, F.col("winner").alias("__b"), F.col("agreement").alias("__gb"))
    has_a, has_b = F.col("__a") != NODATA_CLASS, F.col("__b") != NODATA_CLASS
    return a.join(b, list(keys)).select(
        *keys,
        F.when(has_a, F.col("__a")).when(has_b, F.col("__b")).otherwise(NODATA_CLASS).alias("winner"),
        F.when(has_a, 2).when(has_b, 1).otherwise(0).alias("source"),
        F.when(has_a, F.col("__ga")).when(has_b, F.col("__gb")).alias("agreement"),
    )


def abundance(snaps: DataFrame, fractions: DataFrame, keys: Sequence[str], depth: str, cls: str = "cls", epoch: str = "epoch", valid: str = "valid", method: str = "median", min_epochs: int = 1, tasks: int | None = None) -> DataFrame:
    """(keys, output, abundance, n): depth times the class's fraction of each output, by epoch, then over epochs where it is above 0.

    fractions: (class_id, output, fraction), a table of the classes' definition, one row a class and output. A cell's snapshots
    are dealt once, to as many tasks, and both groupings find them there.
    """
    dealt = snaps.where(F.col(valid)).repartition(*((tasks,) if tasks else ()), *keys)
    parts = dealt.join(F.broadcast(fractions), F.col(cls) == F.col("class_id"))
    each = parts.where(F.col("fraction") > 0).groupBy(*keys, epoch, "output").agg(F.sum(F.col(depth) * F.col("fraction")).alias("x"))
    how = {"median": F.median, "mean": F.avg, "max": F.max, "sum": F.sum}[method]
    return each.groupBy(*keys, "output").agg(how("x").alias("abundance"), F.count("*").alias("n")).where(F.col("n") >= min_epochs)


def confirmed_vote(snaps: DataFrame, keys: Sequence[str], depth: str, cls: str = "cls", acquired: str = "acquired", valid: str = "valid", score: str = "score", fit: str | None = None, min_count: int = 2, weight_by: str = "score_fit") -> DataFrame:
    """(keys, winner, depth, acquired, n_agree): classes with enough epochs outrank the others; 0 if a cell was seen but nothing confirmed.

    Weights are score times fit (score_fit), the score or 1 (count), at least 0. A class is a candidate with min_count epochs, or all of fewer valid ones.
    Depth is the weighted mean of the agreeing epochs, acquired that of the heaviest.
    """
    on = F.col(valid) & ~F.col(cls).isin(0, NODATA_CLASS)
    marks = [nan_to_null(F.col(c).cast("double")) for c in (score, fit) if c]
    weight = F.lit(1.0) if weight_by == "count" else F.greatest(F.lit(0.0), marks[0] if weight_by == "score" or not fit else marks[0] * marks[1])
    per = snaps.groupBy(*keys).agg(F.count_if(F.col(valid)).alias("__valid"))
    by_class = snaps.where(on).withColumn("__w", weight).groupBy(*keys, F.col(cls).alias("__cls")).agg(
        F.count("*").alias("n_agree"),
        F.sum("__w").alias("__total"),
        F.max("__w").alias("__top"),
        F.when(F.sum("__w") > 0, F.sum(F.col("__w") * F.col(depth)) / F.sum("__w")).otherwise(F.avg(depth)).alias("depth"),
        F.max_by(F.col(acquired), F.struct("__w", (-F.col(acquired)).alias("a"))).alias("acquired"),
    )
    rows = per.join(by_class, list(keys), "left")
    can = F.col("n_agree") >= F.least(F.lit(min_count), F.greatest(F.col("__valid"), F.lit(1)))
    rank = F.struct(can.alias("c"), (F.col("__total") + 1e-7 * F.col("__top")).alias("t"), (-F.col("__cls")).alias("k"))
    won = rows.groupBy(*keys, "__valid").agg(F.max_by(F.struct("__cls", "depth", "acquired", "n_agree", can.alias("can")), rank).alias("__won"))
    confirmed = F.coalesce(F.col("__won.can"), F.lit(False))
    return won.select(
        *keys,
        F.when(confirmed, F.col("__won.__cls")).when(F.col("__valid") > 0, 0).otherwise(NODATA_CLASS).cast("int").alias("winner"),
        F.when(confirmed, F.col("__won.depth")).alias("depth"),
        F.when(confirmed, F.col("__won.acquired")).alias("acquired"),
        F.when(confirmed, F.col("__won.n_agree")).otherwise(0).alias("n_agree"),
    )
