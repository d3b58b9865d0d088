"""Ranking looks of one cell and epoch against each other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _by(order: Column, keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(order.asc_nulls_last())


def _all(order: Column, keys: Sequence[str]):
    """All looks of the keys, as a frame of the window that ranks them: one sort does for both."""
    return _by(order, keys).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def average_rank(order: Column, keys: Sequence[str]) -> Column:
    """0-based rank in ascending order; equals share the mean of their places: the first's is rank, the last's the count up to it."""
    w = _by(order, keys)
    return (F.rank().over(w) + F.count("*").over(w)) / 2 - 1


def rank_penalty(looks: DataFrame, keys: Sequence[str], value: str, lower_is_better: bool = True) -> DataFrame:
    """Adds penalty: 0 for the best, 1 for the last or for no value, 0 for a lone look. Looks dealt by keys stay where they are, sorted once."""
    c = F.col(value) if lower_is_better else -F.col(value)
    n = F.count(F.col(value)).over(_all(c, keys))
    share = average_rank(c, keys) / F.greatest(n - 1, F.lit(1))
    return looks.withColumn("penalty", F.when(F.col(value).isNull(), 1.0).when(n <= 1, 0.0).otherwise(share))


def borda(looks: DataFrame, keys: Sequence[str], ballots: Sequence[str]) -> DataFrame:
    """Adds borda: over ballots (lower is better), the number of looks less 1 less the average rank. Looks are sorted once a ballot."""
    points = sum((F.count("*").over(_all(F.col(b), keys)) - 1 - average_rank(F.col(b), keys) for b in ballots), F.lit(0.0))
    return looks.withColumn("borda", points)


def copeland_points(keys: Sequence[str], look: str, ballots: Sequence[str], candidate: Column | None = None) -> Column:
    """Pairwise contests of a cell's candidates won by most ballots (lower is better), an even split counts half.

    A row meets the others as one array of its cell and epoch: the contests are counted in place, no pair becomes a row.
    """
    entry = F.struct(F.col(look).alias("look"), F.array(*[F.col(b).cast("double") for b in ballots]).alias("at"))
    others = F.collect_list(entry if candidate is None else F.when(candidate, entry)).over(Window.partitionBy(*keys))
    own = F.array(*[F.col(b).cast("double") for b in ballots])

    def contest(total: Column, other: Column) -> Column:
        ahead = F.aggregate(F.zip_with(own, other["at"], lambda x, y: F.when(x < y, 1).when(x > y, -1).otherwise(0)), F.lit(0), lambda s, x: s + x)
        return total + F.when(other["look"] == F.col(look), 0.0).when(ahead > 0, 1.0).when(ahead == 0, 0.5).otherwise(0.0)

    return F.aggregate(others, F.lit(0.0), contest)


def copeland(looks: DataFrame, keys: Sequence[str], look: str, ballots: Sequence[str]) -> DataFrame:
    """(keys, look, copeland)."""
    return looks.select(*keys, look, *ballots).withColumn("copeland", copeland_points(keys, look, ballots)).select(*keys, look, "copeland")


def lexical_rank(looks: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Adds lexical_rank, 1 for the best; equals share it."""
    return looks.withColumn("lexical_rank", F.dense_rank().over(Window.partitionBy(*keys).orderBy(*order)))

