"""Hooks that a user's own code fills: columns and tables, never rows, so that Spark plans them with the rest.

A plug-in is found by the name it is registered under, or as module:Class. What it declares is checked before a run, and what it
delivers when it is applied.
"""

from __future__ import annotations

import importlib
from collections.abc import Sequence
from typing import Protocol, runtime_checkable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

INDEX_COLUMNS = ("granule_id", "collection", "acquired", "west", "south", "east", "north")
RESERVED = ("score", "valid", "observed")


@runtime_checkable
class GranuleFilter(Protocol):
    """Which rows of the index stay, before any pixel is read."""

    def keep(self, index: DataFrame) -> Column: ...

    def describe(self) -> str: ...


@runtime_checkable
class PixelMask(Protocol):
    """Which looks may win; space: sensor or map. requires: the columns it reads; aux: those of the lattice, for map masks only."""

    space: str
    requires: tuple[str, ...]

    def valid(self, looks: DataFrame) -> Column: ...


@runtime_checkable
class Scorer(Protocol):
    """A look's score, higher wins, NULL or NaN may not win. Optional: outputs, names of what emit(looks) gives beside it; halo."""

    requires: tuple[str, ...]

    def score(self, looks: DataFrame) -> Column: ...


@runtime_checkable
class Reducer(Protocol):
    """Delivered columns of a cell and period; outputs: (name, type) of each. requires: what it reads of the snapshots."""

    outputs: tuple[tuple[str, str], ...]
    requires: tuple[str, ...]

    def reduce(self, snaps: DataFrame, keys: Sequence[str]) -> DataFrame: ...


@runtime_checkable
class OutputMapper(Protocol):
    """A picture of a product: r, g, b and a."""

    def paint(self, cells: DataFrame) -> dict[str, Column]: ...


@runtime_checkable
class GranuleReader(Protocol):
    """Pixels of a file as long rows."""

    variables: tuple[str, ...]

    def read(self, spark: SparkSession, path: str, variables: Sequence[str]) -> DataFrame: ...


@runtime_checkable
class GranuleSource(Protocol):
    """Rows of the index."""

    def search(self, spark: SparkSession, box: tuple | None, start, end) -> DataFrame: ...


HOOKS = {"filter": GranuleFilter, "mask": PixelMask, "scorer": Scorer, "reducer": Reducer, "mapper": OutputMapper, "reader": GranuleReader, "source": GranuleSource}
_registered: dict[tuple[str, str], type] = {}


def register(hook: str, name: str, cls: type | None = None):
    """Also a decorator. A name stands for one class."""
    if hook not in HOOKS:
        raise ValueError(f"no hook {hook}")

    def put(c: type) -> type:
        if _registered.setdefault((hook, name), c) is not c:
            raise ValueError(f"{hook} {name} is registered already")
        return c

    return put if cls is None else put(cls)


def registered() -> list[tuple[str, str, str]]:
    return sorted((h, n, f"{c.__module__}:{c.__qualname__}") for (h, n), c in _registered.items())


def resolve(hook: str, ref: str, **params):
    """The plug-in that a reference names, made with its parameters and checked."""
    cls = _registered.get((hook, ref))
    if cls is None:
        module, _, name = ref.partition(":")
        if not name:
            raise ValueError(f"no {hook} is registered as {ref}")
        cls = getattr(importlib.import_module(module), name)
    plugin = cls(**params)
    if found := problems(hook, plugin):
        raise ValueError("; ".join(found))
    return plugin


def problems(hook: str, plugin, block_size: int = 512) -> list[str]:
    """What is wrong with a plug-in before it runs."""
    who = f"{hook} {type(plugin).__name__}"
    if not isinstance(plugin, HOOKS[hook]):
        return [f"{who} lacks what the hook asks for"]
    out = []
    outputs = [x if isinstance(x, str) else x[0] for x in getattr(plugin, "outputs", ())]
    out += [f"{who}: output {n} is declared twice" for n in sorted({n for n in outputs if outputs.count(n) > 1})]
    out += [f"{who}: output {n} is a reserved name" for n in outputs if n in RESERVED]
    halo = getattr(plugin, "halo", 0)
    if hook == "reducer" and not outputs:
        out.append(f"{who} declares no output")
    if hook == "reducer" and halo:
        out.append(f"{who}: a reducer sees one cell, its halo is 0")
    if hook == "reducer" and getattr(plugin, "aux", ()):
        out.append(f"{who}: reducers read no auxiliary layers")
    if hook == "scorer" and halo * 2 >= block_size:
        out.append(f"{who}: a halo of {halo} leaves nothing of a block of {block_size}")
    if hook == "scorer" and outputs and not hasattr(plugin, "emit"):
        out.append(f"{who} declares outputs, but has no emit")
    if hook == "mask" and plugin.space not in ("sensor", "map"):
        out.append(f"{who}: unknown space {plugin.space}")
    if hook == "mask" and plugin.space == "sensor" and getattr(plugin, "aux", ()):
        out.append(f"{who}: auxiliary layers lie on the map, a sensor mask can't read them")
    return out


def _needs(plugin, df: DataFrame) -> None:
    missing = [c for c in (*plugin.requires, *getattr(plugin, "aux", ())) if c not in df.columns]
    if missing:
        raise ValueError(f"{type(plugin).__name__} reads {missing}, which isn't there")


def _same(plugin, declared: Sequence, delivered: Sequence) -> None:
    if set(declared) != set(delivered):
        raise ValueError(f"{type(plugin).__name__} declares {sorted(declared)} and delivers {sorted(delivered)}")


def apply_filter(index: DataFrame, plugin: GranuleFilter) -> DataFrame:
    """What can't be told goes."""
    return index.where(F.coalesce(plugin.keep(index), F.lit(False)))


def apply_mask(looks: DataFrame, plugin: PixelMask, valid: str = "valid") -> DataFrame:
    _needs(plugin, looks)
    return looks.withColumn(valid, F.col(valid) & F.coalesce(plugin.valid(looks), F.lit(False)))


def apply_scorer(looks: DataFrame, plugin: Scorer) -> DataFrame:
    """score, and scorer_<output> of what it emits; a look without a score has NULL in them too."""
    _needs(plugin, looks)
    out = looks.withColumn("score", plugin.score(looks))
    declared = getattr(plugin, "outputs", ())
    if declared:
        given = plugin.emit(looks)
        _same(plugin, declared, given)
        known = F.col("score").isNotNull() & ~F.isnan(F.col("score").cast("double"))
        out = out.withColumns({f"scorer_{n}": F.when(known, c) for n, c in given.items()})
    return out


def apply_reducer(snaps: DataFrame, keys: Sequence[str], plugin: Reducer) -> DataFrame:
    """keys and the declared outputs in their order and types."""
    _needs(plugin, snaps)
    out = plugin.reduce(snaps, keys)
    kinds = dict(out.dtypes)
    _same(plugin, [f"{n} {t}" for n, t in plugin.outputs] + list(keys), [f"{n} {t}" for n, t in kinds.items() if n not in keys] + [k for k in keys if k in kinds])
    return out.select(*keys, *[n for n, _ in plugin.outputs])


def apply_mapper(cells: DataFrame, plugin: OutputMapper) -> DataFrame:
    given = plugin.paint(cells)
    _same(plugin, "rgba", given)
    return cells.withColumns(given)


def search(spark: SparkSession, plugin: GranuleSource, box: tuple | None = None, start=None, end=None) -> DataFrame:
    """Rows of the index from a source; the start and the end of the time hold whatever the source does."""
    out = plugin.search(spark, box, start, end)
    if missing := [c for c in INDEX_COLUMNS if c not in out.columns]:
        raise ValueError(f"{type(plugin).__name__} delivers no {missing}")
    if start is not None:
        out = out.where(F.col("acquired") >= F.lit(start))
    return out.where(F.col("acquired") < F.lit(end)) if end is not None else out
