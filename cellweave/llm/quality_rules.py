"""Quality rules: compression bands.

The zstandard ratio (compressed bytes by bytes) of the whole text and of each
of its fixed chunks is held against a band whose limits depend on the length:
short texts compress little, so what is normal for 100 bytes is incompressible
for 10,000. A text below a band is repetitive, above it incompressible.
The bands are measured: trusted text (label 1, base rules passed) gives the
outermost ratios of a language near each length, with a margin
(measure_bands). Where too few rows are trusted those of all languages hold,
and where these are too few, or without labels, constants do.

    whole text   rejected if its ratio is out of the band of its length
    chunks       CHUNK bytes each; rejected if more than MAX_BAD of the chunks
                 (a share) are out of the band of a chunk. A last chunk of
                 under CHUNK / 2 bytes has no band: the whole text covers it

Base metrics (words, symbols, repeated lines, repeated three-word windows) are
reported beside it; a text that fails them is not kept whatever its ratios.
Words, lines and windows are told by 64-bit hashes in sorted arrays, and what
looks equal is compared, so a text costs some six times its bytes in memory.

Each text is read and compressed once. What is measured is a narrow row, which
is joined with the labels by id and judged by built-in functions.

Defined results
  null text      an empty text: no words, not kept
  null id        reported like any other, without a label
  null language  the band of all languages; the same for a language that wasn't measured
  labels of one id that contradict each other: the least one holds
  repeated rows  each is reported
  empty table    no rows
  other columns  ignored, whatever their names
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import lean, materialize

LEVEL = 3
CHUNK = 4096
#: Lengths in bytes at which the limits of a whole text are given; between them they follow the logarithm of the length. Shorter texts have no band.
KNOTS = (200, 350, 500, 700, 1_000, 1_400, 2_000, 3_000, 5_000, 10_000, 20_000, 40_000, 100_000)
ALL = ""
#: Without enough labels. By language: least and greatest ratio at each of KNOTS. Other languages use ALL, which holds all languages measured.
BANDS = {
    ALL: ((0.594, 0.527, 0.495, 0.494, 0.474, 0.461, 0.447, 0.443, 0.425, 0.407, 0.391, 0.382, 0.379), (0.738, 0.761, 0.730, 0.678, 0.629, 0.594, 0.563, 0.545, 0.515, 0.483, 0.456, 0.438, 0.423)),
    "en": ((0.596, 0.526, 0.496, 0.497, 0.473, 0.464, 0.458, 0.447, 0.432, 0.424, 0.410, 0.403, 0.403), (0.720, 0.750, 0.720, 0.663, 0.620, 0.595, 0.564, 0.540, 0.516, 0.478, 0.453, 0.445, 0.441)),
    "fr": ((0.545, 0.545, 0.512, 0.520, 0.495, 0.471, 0.468, 0.446, 0.434, 0.417, 0.402, 0.390, 0.390), (0.762, 0.762, 0.729, 0.665, 0.622, 0.591, 0.554, 0.530, 0.504, 0.463, 0.445, 0.438, 0.438)),
    "de": ((0.626, 0.626, 0.594, 0.554, 0.505, 0.487, 0.468, 0.446, 0.433, 0.413, 0.397, 0.385, 0.385), (0.758, 0.758, 0.726, 0.672, 0.622, 0.584, 0.564, 0.542, 0.506, 0.479, 0.444, 0.436, 0.436)),
    "es": ((0.569, 0.569, 0.549, 0.512, 0.496, 0.468, 0.447, 0.441, 0.424, 0.406, 0.392, 0.382, 0.382), (0.758, 0.758, 0.738, 0.671, 0.629, 0.570, 0.541, 0.526, 0.502, 0.463, 0.437, 0.430, 0.430)),
}
#: Of chunks of CHUNK bytes, or at least half of that.
CHUNK_BAND = (0.430, 0.537)
MAX_BAD = 0.5
#: Of trusted ratios this share may lie beyond either limit, a band is this much wider, and needs so many trusted rows near a length.
TRIM, MARGIN, LEAST = 0.0005, 0.01, 300

MIN_WORDS = 50
SYMBOLS = b"#*$%&|<>"
_SPACE = np.isin(np.arange(256), np.frombuffer(b" \t\n\v\f\r", np.uint8))
_BEGINS = ~_SPACE & ~((np.arange(256) & 0xC0) == 0x80)  # the first byte of a character of a word
_SYMBOL = np.isin(np.arange(256), np.frombuffer(SYMBOLS, np.uint8))
#: Bytes, words or lines that are Python objects, or wide arrays, at once.
AT_ONCE = 1 << 17

Bands = dict[str, tuple[tuple[float, ...], tuple[float, ...]]]


def band(n: int, lang: str | None = None, bands: Bands = BANDS) -> tuple[float, float]:
    if n < KNOTS[0]:
        return 0.0, 9.0
    low, high = bands.get(lang or ALL, bands[ALL])
    if n >= KNOTS[-1]:
        return low[-1], high[-1]
    k = bisect_right(KNOTS, n) - 1
    part = math.log(n / KNOTS[k]) / math.log(KNOTS[k + 1] / KNOTS[k])
    return low[k] + part * (low[k + 1] - low[k]), high[k] + part * (high[k + 1] - high[k])


def _blocks(n: int) -> Iterator[slice]:
    return (slice(at, at + AT_ONCE) for at in range(0, n, AT_ONCE))


def _runs(raw: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of bytes that aren't apart start and end."""
    edges, last = [], True
    for part in _blocks(len(raw)):
        outside = apart[raw[part]]
        edges.append((np.flatnonzero(np.diff(outside, prepend=last)) + part.start).astype(np.int32))
        last = outside[-1]
    found = np.concatenate([*edges, np.array([] if last else [len(raw)], np.int32)])
    return found[::2], found[1::2]


def _hashes(text: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts), np.uint64)
    for part in _blocks(len(starts)):
        out[part] = [xxhash.xxh64_intdigest(text[a:b]) for a, b in zip(starts[part].tolist(), ends[part].tolist(), strict=True)]
    return out


def _repeats(keys: np.ndarray, text: bytes, starts: np.ndarray, ends: np.ndarray, by_words: bool) -> tuple[np.ndarray, np.ndarray]:
    """(first, again): items equal to an earlier one, and the first of their kind. keys tell candidates, which are compared; by_words: whatever stands between the words."""
    order = np.argsort(keys, kind="stable").astype(np.int32)
    ordered = keys[order]
    heads = np.concatenate((np.zeros(min(1, len(keys)), np.int32), np.flatnonzero(ordered[1:] != ordered[:-1]).astype(np.int32) + 1))
    del ordered
    sizes = np.diff(heads, append=np.int32(len(keys)))
    first, again = np.repeat(order[heads], sizes), order
    more = first != again
    first, again = first[more], again[more]
    told = np.empty(len(first), bool)
    for part in _blocks(len(first)):
        a, b = first[part], again[part]
        spans = zip(starts[a].tolist(), ends[a].tolist(), starts[b].tolist(), ends[b].tolist(), strict=True)
        told[part] = [text[p:q] == text[x:y] or (by_words and text[p:q].split() == text[x:y].split()) for p, q, x, y in spans]
    if told.all():
        return first, again
    mixed = np.unique(first[~told])  # kinds that share a hash: told apart by what they say
    odd = np.isin(first, mixed)
    seen, pairs = {}, []
    for k in np.sort(np.concatenate((mixed, again[odd]))).tolist():
        said = text[starts[k] : ends[k]]
        head = seen.setdefault(tuple(said.split()) if by_words else said, k)
        if head != k:
            pairs.append((head, k))
    more = np.array(pairs, np.int32).reshape(-1, 2)
    return np.concatenate((first[~odd], more[:, 0])), np.concatenate((again[~odd], more[:, 1]))


def base_metrics(text: bytes) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, repeated lines with a word, words in three-word windows found twice or more."""
    raw = np.frombuffer(text, np.uint8)
    if not len(raw):
        return 0, 0, 0, 0, 0
    chars = sum(int(np.count_nonzero(_BEGINS[raw[part]])) for part in _blocks(len(raw)))
    symbols = sum(int(np.count_nonzero(_SYMBOL[raw[part]])) for part in _blocks(len(raw)))
    starts, ends = _runs(raw, _SPACE)
    n = len(starts)
    line_starts, line_ends = _runs(raw, np.arange(256) == 10)
    worded = np.searchsorted(starts, line_starts) < np.searchsorted(starts, line_ends)
    line_starts, line_ends = line_starts[worded], line_ends[worded]
    dup = len(_repeats(_hashes(text, line_starts, line_ends), text, line_starts, line_ends, False)[1]) if len(line_starts) > 1 else 0
    if n < 4:
        return n, chars, symbols, dup, 0
    hashes, turn = _hashes(text, starts, ends), np.uint64(0x9E3779B97F4A7C15)
    windows = (hashes[:-2] * turn + hashes[1:-1]) * turn + hashes[2:]
    del hashes
    covered = np.zeros(n, bool)
    for k in _repeats(windows, text, starts[:-2], ends[2:], True):
        for at in range(3):
            covered[k + at] = True
    return n, chars, symbols, dup, int(covered.sum())


def ratios(text: bytes, whole: zstandard.ZstdCompressor) -> tuple[float, list[float]]:
    """Of the whole text and of its chunks."""

    def of(part: bytes) -> float:
        return len(whole.compress(part)) / len(part) if part else 0.0

    if len(text) <= CHUNK:
        return of(text), []
    return of(text), [of(text[at : at + CHUNK]) for at in range(0, len(text) - CHUNK // 2 + 1, CHUNK)]


def verdict(text: bytes, whole: float, chunked: list[float], lang: str | None = None, bands: Bands = BANDS, chunk_band: tuple[float, float] = CHUNK_BAND) -> bool:
    """The rule in plain form, as judge() has it in columns."""
    low, high = band(len(text), lang, bands)
    bad = sum(not chunk_band[0] <= r <= chunk_band[1] for r in chunked)
    return low <= whole <= high and bad <= MAX_BAD * len(chunked)


MEASURED = {"n_bytes": pa.int64(), "n_words": pa.int64(), "word_chars": pa.int64(), "n_symbols": pa.int64(), "n_dup_lines": pa.int64(), "n_repeat_words": pa.int64(), "base_failed": pa.bool_(), "ratio": pa.float64(), "chunks": pa.list_(pa.float64())}
KINDS = "n_bytes bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, ratio double, chunks array<double>"


@lean
def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    compressor = zstandard.ZstdCompressor(level=LEVEL)
    for batch in batches:
        out = []
        for value in batch.column(2):
            text = value.as_py() or b""
            metrics = base_metrics(text)
            failed = metrics[0] < MIN_WORDS or 100 * metrics[4] > 50 * metrics[0]
            out.append((len(text), *metrics, failed, *ratios(text, compressor)))
        columns = list(zip(*out, strict=True)) or [()] * len(MEASURED)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(v, k) for v, k in zip(columns, MEASURED.values(), strict=True)]], names=["__id", "__lang", *MEASURED])


def measured(docs: DataFrame, id_col: str, text_col: str, lang_col: str | None = None) -> DataFrame:
    """(__id, __lang, metrics, ratios) of each row, in one pass without a shuffle."""
    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(id_col).alias("__id"), (F.col(lang_col) if lang_col else F.lit(None)).cast("string").alias("__lang"), F.col(text_col).cast("binary").alias("__text"))
    return narrow.mapInArrow(_measured, f"__id {kind}, __lang string, {KINDS}")


def _knot(n):
    """How many of KNOTS aren't above n."""
    return sum((n >= k).cast("int") for k in KNOTS)


def measure_bands(rows: DataFrame, labels: DataFrame, id_col: str, label_col: str) -> tuple[Bands, tuple[float, float]]:
    """Bands by language, and the band of chunks, of rows (measured) whose label is 1 and which pass the base rules.

    A row counts at both lengths beside its own, so a band holds what it was measured on. Quantile sketches of a language and
    length are made in the tasks and merged; what comes to the driver is a row for each of them, of which LEAST rows are trusted.
    """
    sure = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("__labelled")).agg(F.min(label_col).alias("__good")).where("__good = 1")
    trusted = rows.where("NOT base_failed").join(sure, F.col("__id") == F.col("__labelled"), "left_semi")
    k, ends = _knot(F.col("n_bytes")), F.array(F.lit(TRIM), F.lit(1 - TRIM))
    near = trusted.select("__lang", "ratio", F.explode(F.array(k, k + 1)).alias("k")).where(F.col("k").between(1, len(KNOTS)) & (k > 0))
    near = near.select("k", "ratio", F.explode(F.array_distinct(F.array(F.coalesce("__lang", F.lit(ALL)), F.lit(ALL)))).alias("lang"))
    found = near.groupBy("lang", "k").agg(F.count("*").alias("n"), F.percentile_approx("ratio", ends, 100_000).alias("ends")).where(F.col("n") >= LEAST).collect()
    at = {(r.lang, r.k - 1): (r.ends[0] - MARGIN, r.ends[1] + MARGIN) for r in found}

    def limits(lang: str) -> tuple[tuple[float, ...], tuple[float, ...]]:
        plain = BANDS.get(lang, BANDS[ALL])
        pairs = [at.get((lang, k)) or at.get((ALL, k)) or (plain[0][k], plain[1][k]) for k in range(len(KNOTS))]
        return tuple(p[0] for p in pairs), tuple(p[1] for p in pairs)

    bands = {lang: limits(lang) for lang in {ALL, *BANDS, *(lang for lang, _ in at)}}
    c = trusted.select(F.explode("chunks").alias("c")).agg(F.count("*").alias("n"), F.percentile_approx("c", ends, 100_000).alias("ends")).first()
    return bands, ((c.ends[0] - MARGIN, c.ends[1] + MARGIN) if c.n >= LEAST else CHUNK_BAND)


def judge(rows: DataFrame, bands: Bands = BANDS, chunk_band: tuple[float, float] = CHUNK_BAND) -> DataFrame:
    """rows (measured) with kept. The bands are a row a language, of which each has LEAST trusted rows."""
    table = rows.sparkSession.createDataFrame([(lang, list(low), list(high)) for lang, (low, high) in bands.items() if lang != ALL], "__of string, __low array<double>, __high array<double>")
    met = rows.join(F.broadcast(table), F.col("__lang") == F.col("__of"), "left")
    n, k = F.col("n_bytes"), _knot(F.col("n_bytes"))
    knots = F.array(*[F.lit(float(x)) for x in KNOTS])
    part = F.log(n / F.element_at(knots, k)) / F.log(F.element_at(knots, k + 1) / F.element_at(knots, k))

    def limit(own: str, side: int):
        v = F.coalesce(F.col(own), F.array(*[F.lit(float(x)) for x in bands[ALL][side]]))
        return F.when(k == len(KNOTS), v[len(KNOTS) - 1]).otherwise(F.element_at(v, k) + part * (F.element_at(v, k + 1) - F.element_at(v, k)))

    inside = F.when(k == 0, True).otherwise(F.col("ratio").between(limit("__low", 0), limit("__high", 1)))
    bad = F.size(F.filter("chunks", lambda c: ~c.between(*chunk_band)))
    kept = ~F.col("base_failed") & inside & (bad <= MAX_BAD * F.size("chunks"))
    return met.withColumn("kept", kept).drop("__of", "__low", "__high")


def measure(docs: DataFrame, id_col: str, text_col: str, lang_col: str | None = None, labels: DataFrame | None = None, label_col: str = "label") -> DataFrame:
    """(id, metrics, kept, ratios) of each row. Without lang_col the band of all languages holds; labels: (id_col, label_col), to measure the bands by."""
    rows = measured(docs, id_col, text_col, lang_col)
    if labels is None:
        out = judge(rows)
    else:
        rows = materialize(rows, "measured")
        out = judge(rows, *measure_bands(rows, labels, id_col, label_col))
    chunks = [F.coalesce(f("chunks"), F.col("ratio")).alias(name) for f, name in ((F.array_min, "least_chunk"), (F.array_max, "most_chunk"))]
    return out.select(F.col("__id").alias(id_col), *list(MEASURED)[1:7], "kept", "ratio", *chunks)


def op7_compression_bands(spark, sf_dir: str) -> DataFrame:
    """All documents; bands by their labels."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return measure(docs, "doc_id", "text", "lang", labels, "quality")
