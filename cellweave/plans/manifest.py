"""A run description: what a user declares, its checks, its identity and its budget."""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field, fields
from datetime import datetime

from pyspark.sql import DataFrame

from cellweave.functions.timeline import Duration, Span, deliveries, epochs
from cellweave.operators import reduce, resolve
from cellweave.plans import plugins

AGGREGATES = ("vote", "best", "median", "mean", "min", "max", "percentile", "score_weighted", "inverse_variance", "none")


class ManifestError(ValueError):
    """All problems of a description at once."""

    def __init__(self, problems: Sequence[str]):
        self.problems = list(problems)
        super().__init__("; ".join(problems))


@dataclass(frozen=True)
class Grid:
    resolution: tuple[float, float] = (0.001, -0.001)
    origin: tuple[float, float] = (-180.0, 90.0)
    tile_size: float = 1.0
    crs: str = "EPSG:4326"
    block_size: int = 512

    def problems(self) -> list[str]:
        out = []
        if self.crs != "EPSG:4326":
            out.append(f"{self.crs}: only EPSG:4326 is supported")
        if not (self.resolution[0] > 0 > self.resolution[1]):
            out.append("resolution needs a positive x and a negative y")
        elif self.resolution[0] > 1:
            out.append("a cell of more than a degree")
        return out

    @property
    def id(self) -> str:
        """Of the lattice; the block size doesn't change results, so it isn't part."""
        return identity({k: v for k, v in asdict(self).items() if k != "block_size"})

    def tiles(self, box: tuple[float, float, float, float]) -> list[tuple[int, int]]:
        """Tiles that own a cell of the box, south to north, west to east."""
        x0, y0 = math.floor((box[0] - self.origin[0]) / self.tile_size), math.floor((box[1] - self.origin[1]) / self.tile_size)
        x1, y1 = math.ceil((box[2] - self.origin[0]) / self.tile_size), math.ceil((box[3] - self.origin[1]) / self.tile_size)
        return [(x, y) for y in range(y0, max(y1, y0 + 1)) for x in range(x0, max(x1, x0 + 1))]


@dataclass(frozen=True)
class Time:
    start: datetime
    end: datetime
    epoch: str = "P1M"
    deliver_every: str = ""
    deliver_window: str = ""
    deliver_align: str = "exact"
    align: str = "start"

    def epochs(self, partial: bool = False):
        return epochs(self.start, self.end, Duration.parse(self.epoch), self.align, partial)

    def partial_epochs(self):
        """Those that the time cuts short: no product reads them, a plan tells them."""
        whole = set(self.epochs())
        return [e for e in self.epochs(partial=True) if e not in whole]

    def deliveries(self):
        every = Duration.parse(self.deliver_every or self.epoch)
        window = Duration.parse(self.deliver_window) if self.deliver_window else None
        return deliveries(self.start, self.end, Duration.parse(self.epoch), every, window, self.deliver_align, self.align)

    def problems(self) -> list[str]:
        if self.start >= self.end:
            return ["time ends before it starts"]
        try:
            return [] if self.deliveries() else ["no whole epoch lies in the time"]
        except ValueError as e:
            return [str(e)]


@dataclass(frozen=True)
class Layer:
    name: str
    kind: str
    source: str
    aggregate: str
    params: dict = field(default_factory=dict)

    def problems(self) -> list[str]:
        out = []
        if self.name in ("score", "valid", "observed"):
            out.append(f"layer {self.name}: a reserved name")
        if self.kind not in ("categorical", "continuous"):
            out.append(f"layer {self.name}: unknown kind {self.kind}")
        allowed = ("vote", "best", "none") if self.kind == "categorical" else tuple(a for a in AGGREGATES if a != "vote")
        if self.aggregate not in allowed:
            out.append(f"layer {self.name}: {self.aggregate} isn't for {self.kind} layers")
        if self.source == "acquired" and self.aggregate not in ("best", "min", "max", "none"):
            out.append(f"layer {self.name}: times are delivered as best, min or max")
        return out


@dataclass(frozen=True)
class Budget:
    max_tiles: int = 10**6
    max_granules: int = 10**7
    on_exceed: str = "fail"

    def gate(self, tiles: int, granules: int) -> list[str]:
        """What is exceeded; only warn goes on in spite of it."""
        over = [f"{n} {what} of {most}" for what, n, most in (("tiles", tiles, self.max_tiles), ("granules", granules, self.max_granules)) if n > most]
        if over and self.on_exceed != "warn":
            raise ManifestError([f"over budget: {x}" for x in over])
        return over


@dataclass(frozen=True)
class Manifest:
    run_id: str
    grid: Grid
    box: tuple[float, float, float, float]
    time: Time
    layers: tuple[Layer, ...]
    budget: Budget = field(default_factory=Budget)

    @classmethod
    def from_document(cls, doc: dict) -> Manifest:
        """Unknown keys are problems, and all problems are told at once."""
        parts, problems = {"grid": Grid, "time": Time, "budget": Budget}, []

        def build(kind, body, where):
            unknown = set(body) - {f.name for f in fields(kind)}
            problems.extend(f"{where}: unknown key {k}" for k in sorted(unknown))
            try:
                return kind(**{k: v for k, v in body.items() if k not in unknown})
            except TypeError as e:
                problems.append(f"{where}: {e}")

        given = {k: build(kind, doc.get(k, {}), k) for k, kind in parts.items()}
        layers = tuple(build(Layer, x, f"layer {k}") for k, x in enumerate(doc.get("layers", [])))
        problems += [f"unknown key {k}" for k in sorted(set(doc) - {"run_id", "box", "layers", *parts})]
        if problems:
            raise ManifestError(problems)
        m = cls(doc.get("run_id", ""), given["grid"], tuple(doc.get("box", ())), given["time"], layers, given["budget"])
        if problems := m.problems():
            raise ManifestError(problems)
        return m

    def problems(self) -> list[str]:
        out = self.grid.problems() + self.time.problems() + [p for x in self.layers for p in x.problems()]
        if not self.run_id or "/" in self.run_id:
            out.append("run_id is a label without a slash")
        if len(self.box) != 4 or not (self.box[0] < self.box[2] and self.box[1] < self.box[3]):
            out.append("box is west, south, east, north")
        names = [x.name for x in self.layers]
        out += [f"layer {n} is declared twice" for n in sorted({n for n in names if names.count(n) > 1})]
        return out + ([] if names else ["no layers"])

    @property
    def key(self) -> str:
        return identity(asdict(self))


def identity(x) -> str:
    """16 hex digits of a canonical document: the same whatever the order of keys."""
    return hashlib.sha256(json.dumps(x, sort_keys=True, default=str, separators=(",", ":")).encode()).hexdigest()[:16]


def stage_path(root: str, stage: str, inputs: dict) -> str:
    """A stage's artefact is named by the hash of all that goes into it; a path that is there is that result."""
    return f"{root.rstrip('/')}/{stage}/key={identity(inputs)}"


def reuse_or_write(spark, root: str, stage: str, inputs: dict, build: Callable[[], DataFrame]) -> DataFrame:
    """Read the artefact, or build and write it. Parquet's commit marker is written last, so a half-written one isn't read."""
    path = stage_path(root, stage, inputs)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def key_difference(a: dict, b: dict, at: str = "") -> list[str]:
    """Why two artefacts have different names."""
    out = []
    for k in sorted({*a, *b}):
        x, y = a.get(k), b.get(k)
        if isinstance(x, dict) and isinstance(y, dict):
            out += key_difference(x, y, f"{at}{k}.")
        elif x != y:
            out.append(f"{at}{k}: {x!r} -> {y!r}")
    return out


def at_epochs(looks: DataFrame, spans: Sequence[Span], when: str, out: str = "epoch_start") -> DataFrame:
    """The looks that lie in an epoch, with its start: an equi-join by day with a row for each day of each epoch, so its size is that of the time."""
    from pyspark.sql import functions as F

    span = looks.sparkSession.createDataFrame([(s.start, s.end) for s in spans], "e0 timestamp, e1 timestamp")
    us, a_day = F.unix_micros, 86_400_000_000
    days = span.select("e0", "e1", F.explode(F.sequence(F.floor(us("e0") / a_day), F.floor((us("e1") - 1) / a_day))).alias("__day"))
    t = F.col(when).cast("timestamp")
    met = looks.withColumn("__day", F.floor(us(t) / a_day)).join(F.broadcast(days), "__day").where((t >= F.col("e0")) & (t < F.col("e1")))
    return met.withColumn(out, F.col("e0")).drop("__day", "e0", "e1")


def deliver(manifest: Manifest, looks: DataFrame, keys: Sequence[str] = ("cell",), order: Sequence[str] = ("acquired", "oid", "line"), reducers: Sequence = ()) -> DataFrame:
    """The products: looks to epoch winners to delivered layers, one row a cell and delivery period.

    Epochs and periods come from the manifest as a small bridge table; winners are found once and shared by all periods.
    reducers: plug-ins for what the declared vocabulary can't say; they read the winners of a period's epochs.
    """
    from pyspark.sql import functions as F

    spark = looks.sparkSession
    bridge = [(p.start, e.start, k) for p in manifest.time.deliveries() for k, e in enumerate(p.epochs)]
    sources = sorted({x.source for x in manifest.layers}.union(*[r.requires for r in reducers]) - {*keys, *order, "score", "epoch_start"})
    at = at_epochs(looks, manifest.time.epochs(), "acquired")
    snaps = resolve.snapshots(at, [*keys, "epoch_start"], order, sources)
    periods = spark.createDataFrame(bridge, "period timestamp, epoch_start timestamp, epoch int")
    rows = snaps.join(F.broadcast(periods), "epoch_start")  # one row a period and epoch of the manifest
    by, out = [*keys, "period"], None
    for x in manifest.layers:
        if x.aggregate == "none":
            continue
        if x.aggregate == "vote":
            one = reduce.vote(rows, by, cls=x.source, **x.params).select(*by, F.col("winner").alias(x.name), F.col("agreement").alias(f"{x.name}_agreement"), F.col("runner_up").alias(f"{x.name}_runner_up"))
        elif x.aggregate == "best":
            one = reduce.best(rows, by, x.source).withColumnRenamed("best", x.name)
        else:
            one = reduce.continuous(rows, by, x.source, x.aggregate, **x.params).withColumnRenamed("value", x.name).withColumnRenamed("n", f"{x.name}_n")
            if "spread" in one.columns:
                one = one.withColumnRenamed("spread", f"{x.name}_spread")
        out = one if out is None else out.join(one, by)
    for r in reducers:
        one = plugins.apply_reducer(rows, by, r)
        out = one if out is None else out.join(one, by)
    counts = reduce.epoch_counts(rows, by)
    return counts if out is None else out.join(counts, by)
