"""Vector codes by product quantisation, trained by delta-maintained Lloyd rounds.

Vectors become integers and are cut into PARTS equal parts; each part position
has a codebook of ENTRIES at most. All arithmetic is in integers, so no order
of summing changes a result.

1. The state is a written table of the vectors with the assignment of each part
   before and after the round.
2. A round reads the state, assigns each part to its nearest entry (an Arrow
   batch at a time) and writes the state anew.
3. Parts whose assignment changed, and only they, add their components to the
   running sums of the new entry and take them off those of the old one. These
   plus and minus contributions are combined in each task before the shuffle,
   so it carries a row an entry and task at most; the sums that come to the
   driver are PARTS x ENTRIES rows. In the first round every part is new.
4. Entries move to floor(sum / count) of the running sums; an entry without
   parts stays.

The codebooks, PARTS x ENTRIES vectors, are all that is sent to tasks.

Defined results
  null vector, null or non-finite component  the row is dropped
  component so large that squared distances don't fit in 64 bits, in a vector of the kept width  dropped like one that isn't finite
  length         not a positive multiple of PARTS: dropped. Vectors of another length than the one of the smallest id: dropped
  null id        kept, after all other ids where the first entries are chosen
  repeated rows  each is coded; equal ids are ordered by their components where the first entries are chosen
  few vectors    fewer than ENTRIES vectors: as many entries
  null labels    one label of their own
  empty table    no rows
  other columns  ignored, whatever their names
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import discard, materialize, table

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
_FIELDS = "code array<int>, was array<int>, error bigint"


def integers(vectors: DataFrame, id_col: str, vec_col: str, label_col: str, parts: int = PARTS, scale: int = SCALE) -> DataFrame:
    """(id, label, v array<bigint>) of the vectors that can be coded."""
    vec, width = F.col(f"`{vec_col}`"), F.size(F.col(f"`{vec_col}`"))
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) * scale < float(1 << 40)))  # so that the floor fits in a long; the exact bound needs the width
    own = vectors.where(vec.isNotNull() & (width > 0) & (width % parts == 0)).where(fine)
    own = own.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"), F.transform(vec, lambda x: F.floor(x.cast("double") * scale)).alias("v"))
    first = own.orderBy(F.col("id").asc_nulls_last(), "v").select(F.size("v").alias("n")).limit(1).collect()
    if not first:
        return own
    n = first[0]["n"]
    most = isqrt((1 << 61) // n)  # n squares of differences of twice as much stay below 2 ** 63
    return own.where((F.size("v") == n) & F.forall("v", lambda x: F.abs(x) <= most))


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each row, ties to the lower index, and its squared distance. Sums may pass 64 bits on the way and come back."""
    far = (x * x).sum(axis=1)[:, None] - 2 * (x @ book.T) + (book * book).sum(axis=1)[None, :]
    best = far.argmin(axis=1)
    return best, far[np.arange(len(x)), best]


def _lists(flat: np.ndarray, n: int) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * flat.shape[1] + 1, flat.shape[1], dtype=np.int32)), pa.array(flat.ravel().astype(np.int32)))


def _assigned(batches: Iterator[pa.RecordBatch], books: np.ndarray) -> Iterator[pa.RecordBatch]:
    parts, _, width = books.shape
    for batch in batches:
        if not batch.num_rows:
            continue
        x = batch.column(2).flatten().to_numpy().reshape(batch.num_rows, parts, width)
        code, error = np.empty((len(x), parts), np.int64), np.zeros(len(x), np.int64)
        for p in range(parts):
            code[:, p], far = nearest(x[:, p], books[p])
            error += far
        was = batch.column(3)
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], _lists(code, len(x)), was, pa.array(error)], names=["id", "label", "v", "code", "was", "error"])


def assign(state: DataFrame, books: np.ndarray) -> DataFrame:
    """The state with each part's nearest entry in code, the one before in was, and the squared distances summed over parts in error."""
    kinds = {f.name: f.dataType.simpleString() for f in state.schema.fields}
    sent = state.select("id", "label", "v", F.col("code").alias("was"))
    return sent.mapInArrow(partial(_assigned, books=books), f"id {kinds['id']}, label {kinds['label']}, v array<bigint>, {_FIELDS}")


def contributions(state: DataFrame, width: int) -> DataFrame:
    """(part, entry, n, sums) of what parts whose assignment changed bring to their new entry and take from their old one."""
    moved = state.select("v", F.posexplode(F.arrays_zip(F.col("code").alias("new"), F.coalesce("was", F.transform("code", lambda _: F.lit(None).cast("int"))).alias("old"))).alias("part", "c"))
    moved = moved.where(~F.col("c.new").eqNullSafe(F.col("c.old"))).withColumn("x", F.slice("v", F.col("part") * width + 1, F.lit(width)))
    signs = F.explode(F.array(F.struct(F.col("c.new").alias("entry"), F.lit(1).alias("sign")), F.struct(F.col("c.old").alias("entry"), F.lit(-1).alias("sign")))).alias("s")
    each = moved.select("part", "x", signs).where("s.entry IS NOT NULL")
    sums = [F.sum(F.col("x")[k] * F.col("s.sign")).alias(f"x{k}") for k in range(width)]
    return each.groupBy("part", F.col("s.entry").alias("entry")).agg(F.sum("s.sign").alias("n"), *sums).select("part", "entry", "n", F.array(*[f"x{k}" for k in range(width)]).alias("sums"))


def train(own: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[np.ndarray, DataFrame]:
    """The codebooks (part, entry, position), and the written state of the last assignment. own: integers()."""
    first = own.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    width = len(first[0]["v"]) // parts if first else 1
    books = np.array([r["v"] for r in first], np.int64).reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    state = own.withColumn("code", F.lit(None).cast("array<int>"))
    if not first:
        return books, state.withColumn("was", F.lit(None).cast("array<int>")).withColumn("error", F.lit(None).cast("bigint"))
    sums, counts = np.zeros_like(books), np.zeros(books.shape[:2], np.int64)
    written = None
    for _ in range(rounds):
        before, written = written, materialize(assign(state, books), "lloyd")
        discard(before)
        state = written
        for r in contributions(written, width).collect():  # at most parts x entries rows
            counts[r["part"], r["entry"]] += r["n"]
            sums[r["part"], r["entry"]] += np.array(r["sums"], np.int64)
        used = counts > 0
        books[used] = sums[used] // counts[used][:, None]
    last = materialize(assign(state, books), "lloyd")
    discard(written)
    return books, last


def quantise(vectors: DataFrame, id_col: str, vec_col: str, label_col: str, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[np.ndarray, DataFrame]:
    """The codebooks, and (id, label, code array<int>, error, label_error) of each vector that can be coded; label_error sums error over equal labels."""
    books, state = train(integers(vectors, id_col, vec_col, label_col, parts, scale), parts, entries, rounds)
    own = state.select("id", "label", "code", "error")
    by_label = materialize(own.groupBy("label").agg(F.sum("error").alias("label_error")), "labels")  # so that Spark can split a hot label in the join
    by_label = by_label.withColumnRenamed("label", "__label")
    out = own.join(by_label, F.col("label").eqNullSafe(F.col("__label")))
    return books, out.select(F.col("id").alias(id_col), F.col("label").alias(label_col), "code", "error", "label_error")


def op13_delta_lloyd(spark, sf_dir: str) -> DataFrame:
    """All embeddings: 16 parts, 64 entries, 2 rounds."""
    books, coded = quantise(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
    said = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    code = F.lower(F.concat_ws("", F.transform("code", lambda c: F.lpad(F.hex(c.cast("bigint")), 2, "0"))))
    return coded.select("vec_id", code.alias("code"), "error", "label_error", F.lit(said).alias("codebooks_sha256"))


def _sql_round(k: int) -> str:
    """Assignments to codebook k, and codebook k + 1."""
    return f"""
a{k} AS MATERIALIZED (
  SELECT id, part, min(r).e AS entry, min(r).d AS far FROM (
    SELECT id, part, {{'d': list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'e': entry}} AS r FROM p JOIN c{k} USING (part))
  GROUP BY id, part),
c{k + 1} AS MATERIALIZED (
  SELECT part, entry, coalesce(m, c) AS c FROM c{k} LEFT JOIN (
    SELECT part, entry, list(floor(s / n)::BIGINT ORDER BY spot) AS m FROM (
      SELECT part, entry, spot, sum(x[spot])::DOUBLE AS s, count(*)::DOUBLE AS n FROM p JOIN a{k} USING (id, part), unnest(range(1, len(x) + 1)) AS u(spot) GROUP BY part, entry, spot)
    GROUP BY part, entry) USING (part, entry))"""


ORACLE = f"""
WITH k AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS id, vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT id, part, v[part * len(v) // {PARTS} + 1 : (part + 1) * len(v) // {PARTS}] AS x FROM k, unnest(range({PARTS})) AS u(part)),
c0 AS MATERIALIZED (SELECT part, id - 1 AS entry, x AS c FROM p WHERE id <= {ENTRIES}),
{",".join(_sql_round(k) for k in range(ROUNDS + 1))},
said AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS h FROM c{ROUNDS}),
coded AS (SELECT id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(far)::BIGINT AS error FROM a{ROUNDS} GROUP BY id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256 FROM k JOIN coded USING (id), said
"""
