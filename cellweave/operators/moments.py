"""Mergeable moments of spectra: count, mean and co-moment matrix of each key.

A task keeps one matrix a key, adds each of its spectra to it once and sends
the matrix, not the spectra. Matrices of one key are merged in the order of a
sort, one at a time, so no task holds more than one of them and no group holds
raw spectra. Means and co-moments are merged, not sums of squares, so spectra
far from zero lose no digits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bytes of matrices that a task holds before it sends what it has.
HELD = 64 << 20

Moment = tuple[float, np.ndarray, np.ndarray]


def merged(a: Moment, b: Moment) -> Moment:
    """Of two parts, that of the whole."""
    n = a[0] + b[0]
    d = b[1] - a[1]
    return n, a[1] + d * (b[0] / n), a[2] + b[2] + np.outer(d, d) * (a[0] * b[0] / n)


def moment(x: np.ndarray) -> Moment:
    mean = x.mean(axis=0)
    c = x - mean
    return float(len(x)), mean, c.T @ c


def finite(spectrum: str) -> Column:
    """Whether a spectrum is there and all its numbers are finite."""
    big = float("inf")
    return F.coalesce(F.forall(F.col(spectrum), lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < big)), F.lit(False))


def _rows(held: dict, schema: pa.Schema) -> pa.RecordBatch:
    keys = list(zip(*held, strict=True)) if held else [[] for _ in schema.names[:-3]]
    arrays = [pa.array(k, schema.field(i).type) for i, k in enumerate(keys)]
    values = list(held.values())
    arrays += [pa.array([v[0] for v in values], pa.float64()), pa.array([v[1].tobytes() for v in values], pa.binary()), pa.array([v[2].tobytes() for v in values], pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _schema(batch: pa.RecordBatch, keys: int) -> pa.Schema:
    return pa.schema([*[batch.schema.field(i) for i in range(keys)], ("n", pa.float64()), ("mean", pa.binary()), ("m2", pa.binary())])


def _summed(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    held: dict = {}
    schema = None
    for batch in batches:
        if not batch.num_rows:
            continue
        schema = _schema(batch, keys)
        x = batch.column(keys).flatten().to_numpy().astype(float).reshape(batch.num_rows, -1)
        named = pd.MultiIndex.from_arrays([batch.column(i).to_pandas() for i in range(keys)])
        code, names = named.factorize()
        order = np.argsort(code, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(code[order])) + 1):
            key = tuple(batch.column(i)[int(part[0])].as_py() for i in range(keys))
            own = moment(x[part])
            held[key] = merged(held[key], own) if key in held else own
        if len(held) * 8 * x.shape[1] ** 2 > HELD:
            yield _rows(held, schema)
            held = {}
    if held:
        yield _rows(held, schema)


def _met(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    last, held, schema = None, None, None
    for batch in batches:
        schema = _schema(batch, keys)
        for i in range(batch.num_rows):
            key = tuple(batch.column(k)[i].as_py() for k in range(keys))
            mean = np.frombuffer(batch.column(keys + 1)[i].as_py())
            own = (batch.column(keys)[i].as_py(), mean, np.frombuffer(batch.column(keys + 2)[i].as_py()).reshape(len(mean), -1))
            if held is not None and key == last:
                held = merged(held, own)
            else:
                if held is not None:
                    yield _rows({last: held}, schema)
                last, held = key, own
    if held is not None:
        yield _rows({last: held}, schema)


def _kinds(df: DataFrame, keys: Sequence[str]) -> str:
    kinds = dict(df.dtypes)
    return ", ".join(f"`{k}` {kinds[k]}" for k in keys)


def merge(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, n, mean, m2), a row a key, of rows of parts."""
    dealt = parts.select(*keys, "n", "mean", "m2").repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(partial(_met, keys=len(keys)), f"{_kinds(parts, keys)}, n double, mean binary, m2 binary")


def moments(pixels: DataFrame, keys: Sequence[str], spectrum: str) -> DataFrame:
    """(keys, n, mean, m2) of the spectra of each key; those with a missing number don't count."""
    sent = pixels.where(finite(spectrum)).select(*keys, F.col(spectrum).cast("array<double>"))
    return merge(sent.mapInArrow(partial(_summed, keys=len(keys)), f"{_kinds(pixels, keys)}, n double, mean binary, m2 binary"), keys)


def noise_sigma(m2: np.ndarray, n: float) -> np.ndarray:
    """Noise of each band from the variance of spectral second differences, 1.5 times the noise's where the signal is smooth. They are linear, so their variance comes from the moments.

    Edge bands take their neighbour's; none is below a thousandth of the median.
    """
    bands = len(m2)
    if bands < 3:
        raise ValueError("second differences need three bands")
    d = np.zeros((bands - 2, bands))
    at = np.arange(bands - 2)
    d[at, at], d[at, at + 1], d[at, at + 2] = -0.5, 1.0, -0.5
    own = np.sqrt(np.maximum(np.einsum("ij,jk,ik->i", d, m2 / n, d), 0) / 1.5)
    own = np.concatenate([own[:1], own, own[-1:]])
    return np.maximum(own, max(float(np.median(own)) * 1e-3, 1e-12))


def matched(own: Moment, target: np.ndarray, shrink: float, k: int | None) -> np.ndarray | None:
    """w of a matched filter w . (x - mean): the covariance held towards its diagonal; with k, only the k noise-whitened components of most signal. None of a target that can't be told from the mean."""
    n, mean, m2 = own
    bands = len(mean)
    cov = m2 / max(n - 1, 1)
    cov = (1 - shrink) * cov + shrink * np.diag(np.diag(cov))
    s = target - mean
    if k is None or k >= bands:
        try:
            v = np.linalg.solve(cov + np.eye(bands) * (np.trace(cov) / bands * 1e-9 + 1e-20), s)
        except np.linalg.LinAlgError:
            return None
    else:
        sigma = noise_sigma(m2, n)
        size, axes = np.linalg.eigh(cov / np.outer(sigma, sigma))
        size, axes = np.maximum(size[-k:], 1e-12), axes[:, -k:]
        v = (axes @ ((axes.T @ (s / sigma)) / size)) / sigma
    total = float(s @ v)
    return v / total if np.isfinite(total) and total > 0 else None


def _solved(batches: Iterator[pa.RecordBatch], keys: int, target: np.ndarray, shrink: float, k: int | None, min_n: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, ws, bs = [], [], []
        for i in range(batch.num_rows):
            n, mean = batch.column(keys)[i].as_py(), np.frombuffer(batch.column(keys + 1)[i].as_py())
            if n < min_n:
                continue
            w = matched((n, mean, np.frombuffer(batch.column(keys + 2)[i].as_py()).reshape(len(mean), -1)), target, shrink, k)
            if w is not None:
                rows.append(i)
                ws.append(w)
                bs.append(float(mean @ w))
        yield pa.RecordBatch.from_arrays([*batch.take(pa.array(rows, pa.int64())).columns[: keys + 1], pa.array(ws, pa.list_(pa.float64())), pa.array(bs, pa.float64())], names=[*batch.schema.names[: keys + 1], "w", "b"])


def filters(of: DataFrame, keys: Sequence[str], target: Sequence[float], shrink: float = 0.05, k: int | None = None, min_n: int = 20) -> DataFrame:
    """(keys, n, w, b): the matched filter w . x - b of each key with min_n spectra. of: moments."""
    kinds = _kinds(of, keys)
    return of.select(*keys, "n", "mean", "m2").mapInArrow(partial(_solved, keys=len(keys), target=np.asarray(target, float), shrink=shrink, k=k, min_n=min_n), f"{kinds}, n double, w array<double>, b double")


def noise(of: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, n, sigma array<double>) of moments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = len(keys)
            sigmas = [noise_sigma(np.frombuffer(m.as_py()).reshape(len(np.frombuffer(mean.as_py())), -1), n.as_py()) for n, mean, m in zip(*batch.columns[at:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: at + 1], pa.array(sigmas, pa.list_(pa.float64()))], names=[*batch.schema.names[: at + 1], "sigma"])

    return of.select(*keys, "n", "mean", "m2").mapInArrow(run, f"{_kinds(of, keys)}, n double, sigma array<double>")


def dot(x: Column, w: Column) -> Column:
    return F.aggregate(F.zip_with(x, w, lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, v: s + v)


def _axis(at: str, stride: int) -> tuple[Column, Column]:
    """A pixel's lattice block, and whether it lies on the line where the block begins, which the window before doesn't reach."""
    return F.floor(F.col(at) / stride).cast("bigint"), F.pmod(F.col(at), F.lit(stride)) == 0


def _windows(k: Column, line: Column) -> Column:
    """The windows of one axis that reach a block: its own multiple of the stride, and the next one but from the line."""
    return F.when(line, F.array(k)).otherwise(F.array(k, k + 1))


def window_filter(
    pixels: DataFrame, target: Sequence[float], stride: int, min_n: int = 20, keys: Sequence[str] = ("granule",), spectrum: str = "reflectance",
    shrink: float = 0.05, k: int | None = None, trim: float = 0.0,
) -> DataFrame:
    """(keys, row, col, mf, bg_n): matched filter with the background of lattice windows, blended.

    A window stands at each multiple of the stride and reaches less than a stride to each side, anchored to the lattice, not to a
    block of work. A pixel's filters (four, or fewer on the lines) are weighted by tents that sum to 1; windows of fewer than
    min_n spectra drop out and the others share their weight; where none is left mf is null. With trim, a window is estimated
    again without that share of its spectra that scored highest, unless under min_n stay.

    Each spectrum is counted once, in its block (lines apart); blocks' moments, not spectra, go to the windows that need them.
    Then spectra meet the four filters of their block in one join and are scored by column functions.
    """
    at = pixels.where(finite(spectrum))
    for axis, name in (("row", "r"), ("col", "c")):
        block, line = _axis(axis, stride)
        at = at.withColumn(f"__b{name}", block).withColumn(f"__l{name}", line)
    cells = moments(at, [*keys, "__br", "__lr", "__bc", "__lc"], spectrum)
    window = [*keys, "__wr", "__wc"]
    parts = cells.withColumn("__wr", F.explode(_windows(F.col("__br"), F.col("__lr")))).withColumn("__wc", F.explode(_windows(F.col("__bc"), F.col("__lc"))))
    found = filters(merge(parts, window), window, target, shrink, k, min_n)

    def with_filters(given: DataFrame, *more: str) -> DataFrame:
        own = given.withColumn("__br", F.explode(F.array(F.col("__wr") - 1, F.col("__wr")))).withColumn("__bc", F.explode(F.array(F.col("__wc") - 1, F.col("__wc"))))
        own = own.groupBy(*keys, "__br", "__bc").agg(F.collect_list(F.struct("__wr", "__wc", "n", "w", "b", *more)).alias("__f"))  # four at most
        return at.join(own, [*keys, "__br", "__bc"], "left")

    def tent(f: Column) -> Column:
        w = F.lit(1.0)
        for axis, name in (("row", "r"), ("col", "c")):
            w = w * F.greatest(F.lit(0.0), 1 - F.abs(F.col(axis) - f[f"__w{name}"] * stride) / stride)
        return w

    def score(f: Column) -> Column:
        return dot(F.col(spectrum), f["w"]) - f["b"]

    if trim > 0:
        own = with_filters(found).withColumn("__near", F.filter("__f", lambda f: tent(f) > 0)).where(F.size("__near") > 0)
        scored = own.select(*keys, spectrum, F.explode(F.transform("__near", lambda f: F.struct(f["__wr"].alias("__wr"), f["__wc"].alias("__wc"), score(f).alias("__y")))).alias("__s")).select(*keys, spectrum, "__s.*")
        limit = scored.groupBy(*window).agg(F.percentile("__y", F.lit(1 - trim)).alias("__limit"))  # as many values as a window has pixels
        kept = scored.join(limit, window).where(F.col("__y") <= F.col("__limit"))
        again = filters(moments(kept, window, spectrum), window, target, shrink, k, min_n)
        old, new = found.alias("o"), again.select(*window, F.struct("n", "w", "b").alias("__new")).alias("g")
        found = old.join(new, window, "left").select(*window, *[F.coalesce(f"__new.{c}", c).alias(c) for c in ("n", "w", "b")])
    out = with_filters(found)
    near = F.filter(F.transform("__f", lambda f: F.struct(tent(f).alias("t"), score(f).alias("y"), f["n"].alias("n"))), lambda p: p["t"] > 0)
    total = F.aggregate("__p", F.lit(0.0), lambda s, p: s + p["t"])
    out = out.withColumn("__p", F.coalesce(near, F.array().cast("array<struct<t:double,y:double,n:double>>"))).withColumn("__t", total)

    def blended(c: str) -> Column:
        return F.when(F.col("__t") > 0, F.aggregate("__p", F.lit(0.0), lambda s, p: s + p["t"] * p[c]) / F.col("__t"))

    return out.select(*keys, "row", "col", blended("y").alias("mf"), blended("n").alias("bg_n"))


def _pooled(of: DataFrame, keys: Sequence[str], present: DataFrame, min_n: int, max_radius: int) -> DataFrame:
    """Moments of each present column with as many neighbours to each side as it takes to reach min_n spectra. of: moments by column.

    The radius comes from counts alone; matrices then go to the columns that need them.
    """
    n = of.select(*keys, F.col("s_col").alias("__of"), "n")
    at = [*keys, "s_col"]
    offers = present.select(*at, F.explode(F.sequence(F.col("s_col") - max_radius, F.col("s_col") + max_radius)).alias("__of"))
    near = offers.join(n, [*keys, "__of"]).withColumn("__r", F.abs(F.col("s_col") - F.col("__of")))
    upto = F.sum("n").over(Window.partitionBy(*at).orderBy("__r").rangeBetween(Window.unboundedPreceding, 0))
    near = near.withColumn("__n", upto)
    radius = near.where(F.col("__n") >= min_n).groupBy(*at).agg(F.min("__r").alias("__most"))
    near = near.join(radius, at).where(F.col("__r") <= F.col("__most")).select(*at, "__of")
    sent = near.join(of.withColumnRenamed("s_col", "__of"), [*keys, "__of"])
    return merge(sent, at)


def column_filter(
    pixels: DataFrame, target: Sequence[float], min_n: int = 20, max_radius: int = 64, trim: float = 0.0, keys: Sequence[str] = ("granule",), spectrum: str = "reflectance", shrink: float = 0.05,
) -> DataFrame:
    """(keys, s_row, s_col, mf, bg_n): matched filter with the background of the detector column and, if that is short, its neighbours.

    The smallest radius that reaches min_n spectra holds, up to max_radius; beyond it mf is null. With trim, each column's share of
    spectra that scored highest is left out and the columns are pooled again; a column that then has too few keeps its first filter.
    No spectrum goes to a neighbour: each is counted in its own column, and columns' moments are pooled.
    """
    at = [*keys, "s_col"]
    own = pixels.where(finite(spectrum) & F.col("s_col").isNotNull())
    by_column = moments(own, at, spectrum)
    present = by_column.select(*at)
    found = filters(_pooled(by_column, keys, present, min_n, max_radius), at, target, shrink, None, min_n)

    def scored(given: DataFrame) -> DataFrame:
        out = own.join(given, at, "left")
        return out.withColumn("mf", dot(F.col(spectrum), F.col("w")) - F.col("b")).withColumn("bg_n", F.col("n")).drop("n", "w", "b")

    if trim > 0:
        first = scored(found)
        limit = first.groupBy(*at).agg(F.percentile("mf", F.lit(1 - trim)).alias("__limit"))  # as many values as a column has lines
        kept = first.join(limit, at).where(F.col("__limit").isNull() | (F.col("mf") <= F.col("__limit")))
        again = filters(_pooled(moments(kept, at, spectrum), keys, present, min_n, max_radius), at, target, shrink, None, min_n)
        again = again.select(*at, F.struct("n", "w", "b").alias("__new"))
        found = found.join(again, at, "full").select(*at, *[F.coalesce(f"__new.{c}", c).alias(c) for c in ("n", "w", "b")])
    return scored(found).select(*keys, "s_row", "s_col", "mf", "bg_n")
