"""Packing documents into sequences: best-fit packing after Martello-Toth reduction, and packed binary output.

Both packers work on lengths alone. There are at most as many lengths as a
sequence has places, so a histogram of lengths is bounded whatever the corpus,
and bins that hold the same lengths are kept as one group with a count.

best_fit_pack()   over the whole corpus. Pieces are counted by length, the
                  histogram is reduced and packed, and each piece finds its
                  place by its rank among the pieces of its length. Ranks come
                  from counts by length and hash bucket, so a length that a
                  third of all pieces have is dealt over all buckets. Tokens
                  never move.
packed_output()   inside each partition, in shards of SHARD_TOKENS: no
                  shuffle. Rows of ids, with cumulative segment lengths and
                  positions that begin anew with each segment.

Defined results
  null text      an empty text: one piece of one id, the end id
  null id        packed like any other
  repeated rows  each is packed
  empty table    no rows
  other columns  ignored, whatever their names
"""

from __future__ import annotations

import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellweave.llm.common import lean, materialize, scratch_dir, session_of
from cellweave.llm.tokens import END, cuts, default_path, encoded

CAPACITY = 2048
#: Pieces that a bucket should have on average, when ranks are made.
BUCKET_ROWS = 20_000
SHARD_TOKENS = 4_000_000


@dataclass
class Bins:
    """count bins that each hold content, (length, times) in the order of their places; free places are left."""

    count: int
    content: tuple[tuple[int, int], ...]
    free: int


class SegmentTree:
    """Over capacities 0..n: which have open bins; first(k) is the least open one of k or more."""

    def __init__(self, n: int):
        self.leaves = 1 << n.bit_length()
        self.open = [0] * (2 * self.leaves)

    def add(self, k: int, by: int) -> None:
        k += self.leaves
        while k:
            self.open[k] += by
            k >>= 1

    def first(self, k: int) -> int | None:
        node = k + self.leaves
        if self.open[node]:
            return k
        while node > 1:  # up until there is something open to the right, then down to the leftmost of it
            if node % 2 == 0 and self.open[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.open[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None


def reduce_instance(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Bins], dict[int, int]]:
    """Bins fixed by dominance, and the counts that are left.

    For the longest length L, a set of L and others is fixed for good if it dominates every other set with L in it:
      nothing fits beside L                                    {L}
      something fills the rest exactly                         {L, C - L}
      only one more fits, and l is the longest that does       {L, l}
      two more fit at most, and no two exceed l together       {L, l}
    """
    left = {k: n for k, n in counts.items() if n > 0}
    fixed: list[Bins] = []

    def fix(n: int, *lengths: int) -> None:
        content = [(lengths[0], 2)] if len(lengths) == 2 and lengths[0] == lengths[1] else [(k, 1) for k in lengths]
        fixed.append(Bins(n, tuple(content), capacity - sum(lengths)))
        for k in lengths:
            left[k] -= n
        for k in {*lengths}:
            if not left[k]:
                del left[k]

    changed = True
    while changed:
        changed = False
        for big in sorted(left, reverse=True):
            while left.get(big):
                ordered = sorted(left)
                smallest = [k for k in ordered[:3] for _ in range(min(3, left[k] - (k == big)))][:3]
                room = capacity - big
                if not smallest or smallest[0] > room:
                    fix(left[big], big)
                    changed = True
                    continue
                partner = next((k for k in reversed(ordered) if k <= room and left[k] - (k == big) > 0), None)
                if partner == room or len(smallest) < 2 or smallest[0] + smallest[1] > room:
                    fix(left[big] // 2 if partner == big else min(left[big], left[partner]), big, partner)
                    changed = True
                    continue
                if len(smallest) < 3 or sum(smallest) > room:
                    held = [k for k in ordered for _ in range(min(2, left[k] - (k == big)))]
                    lo, hi, best = 0, len(held) - 1, 0
                    while lo < hi:
                        if held[lo] + held[hi] > room:
                            hi -= 1
                        else:
                            best = max(best, held[lo] + held[hi])
                            lo += 1
                    if best <= partner:  # nothing that was looked at changes while four of either are left
                        fix(max(1, (left[big] - 3) // 2 if partner == big else min(left[big], left[partner]) - 3), big, partner)
                        changed = True
                        continue
                break
    return fixed, left


def best_fit_decreasing(counts: dict[int, int], capacity: int = CAPACITY) -> list[Bins]:
    """Longest first, each into the fullest bin that has room, found by a segment tree over capacities."""
    tree, open_at = SegmentTree(capacity), defaultdict(list)

    def keep(b: Bins) -> None:
        open_at[b.free].append(b)
        tree.add(b.free, 1)

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n > 0:
            free = tree.first(length)
            if free is None:
                each = min(capacity // length, n)
                made = n // each
                keep(Bins(made, ((length, each),), capacity - each * length))
                n -= made * each
                continue
            bins = open_at[free].pop()
            tree.add(free, -1)
            each = min(free // length, n)
            made = min(bins.count, n // each)
            keep(Bins(made, (*bins.content, (length, each)), free - each * length))
            n -= made * each
            if made < bins.count:
                keep(Bins(bins.count - made, bins.content, free))
    return [b for group in open_at.values() for b in group]


def places(groups: list[Bins]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, lo, hi, times, sequence, offset): a piece of the length with rank r in lo..hi-1 goes into sequence + (r-lo) // times at offset + (r-lo) % times * length."""
    used, sequence, out = defaultdict(int), 0, []
    for b in groups:
        offset = 0
        for length, times in b.content:
            lo = used[length]
            used[length] += b.count * times
            out.append((length, lo, used[length], times, sequence, offset))
            offset += length * times
        sequence += b.count
    return out


def cut_pieces(docs: DataFrame, id_col: str, text_col: str, path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(__id, piece, start, length, ids_crc32) of each piece of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for k, ids in enumerate(encoded(batch.column(1), path, end)):
                for p, (s, n) in enumerate(cuts(len(ids) // 4, capacity)):
                    row.append(k)
                    piece.append(p)
                    start.append(s)
                    length.append(n)
                    crc.append(zlib.crc32(ids[4 * s : 4 * (s + n)]))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], names=["__id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    return narrow.mapInArrow(lean(run), f"__id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def best_fit_pack(docs: DataFrame, id_col: str, text_col: str, path: str | None = None, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) of each piece."""
    pieces = materialize(cut_pieces(docs, id_col, text_col, path or default_path(), capacity, end), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    fixed, left = reduce_instance(counts, capacity)
    found = places(fixed + best_fit_decreasing(left, capacity))
    buckets = max(16, sum(counts.values()) // BUCKET_ROWS)
    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64("__id", "piece", "start", "ids_crc32"), F.lit(buckets)))
    per = pieces.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("length", "bucket").orderBy("__id", "piece", "start", "ids_crc32")
    ranked = pieces.withColumn("own", F.row_number().over(own) - 1).join(per, ["length", "bucket"]).withColumn("rank", F.col("before") + F.col("own"))
    slots = session_of(docs).createDataFrame(found, "p_length bigint, lo bigint, hi bigint, times bigint, sequence bigint, p_offset bigint")
    # Rows of slots: lengths in a bin times groups of bins, both bounded by the capacity, so it may be broadcast at any size of the corpus.
    at = ranked.join(F.broadcast(slots), (F.col("length") == F.col("p_length")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    nth = F.col("rank") - F.col("lo")
    sequence = (F.col("sequence") + F.floor(nth / F.col("times"))).cast("bigint").alias("sequence_id")
    offset = (F.col("p_offset") + nth % F.col("times") * F.col("length")).cast("bigint").alias("offset")
    return at.select(F.col("__id").alias(id_col), "piece", "start", "length", "ids_crc32", sequence, offset)


def _pack_shard(ids: list[bytes], owners: list, capacity: int) -> Iterator[tuple[list[int], list[int], list[int], list[bytes]]]:
    """(document, piece, start, ids of each segment) of each sequence of a shard, by best-fit decreasing."""
    by_length = defaultdict(list)
    for doc, tokens in enumerate(ids):
        for p, (s, n) in enumerate(cuts(len(tokens) // 4, capacity)):
            by_length[n].append((doc, p, s))
    groups = best_fit_decreasing({n: len(x) for n, x in by_length.items()}, capacity)
    for b in groups:
        for _ in range(b.count):
            docs, pieces, starts, parts = [], [], [], []
            for length, times in b.content:
                for _ in range(times):
                    doc, p, s = by_length[length].pop()
                    docs.append(owners[doc])
                    pieces.append(p)
                    starts.append(s)
                    parts.append(ids[doc][4 * s : 4 * (s + length)])
            yield docs, pieces, starts, parts


def packed_output(docs: DataFrame, id_col: str, text_col: str, path: str | None = None, capacity: int = CAPACITY, end: int = END, wide: bool = False) -> DataFrame:
    """One row a sequence: sequence_id, n_tokens, doc_ids, pieces, starts, cu_seqlens, input_ids, position_ids.

    input_ids is a row of the id matrix, capacity little-endian ids of 16 bits (32 if wide), END behind the last segment;
    position_ids has as many 16-bit positions, 0 at the first id of each segment and behind the last one.
    A process holds one shard of SHARD_TOKENS ids and the document that crosses it.
    """
    path = path or default_path()
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, owners, size = (TaskContext.get().partitionId() << 32), [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number
            rows = defaultdict(list)
            for who, pieces, starts, parts in _pack_shard(held, owners, capacity):
                lengths = [len(p) // 4 for p in parts]
                n = sum(lengths)
                ids = np.full(capacity, end, "<u4")
                ids[:n] = np.frombuffer(b"".join(parts), "<u4")
                if not wide and int(ids.max()) >= 1 << 16:
                    raise ValueError("ids of 16 bits can't hold this vocabulary; ask for wide ones")
                at = np.zeros(capacity, "<u2")
                at[:n] = np.concatenate([np.arange(k, dtype="<u2") for k in lengths])
                for name, value in (("sequence_id", number), ("n_tokens", n), ("doc_ids", who), ("pieces", pieces), ("starts", starts), ("cu_seqlens", [0, *np.cumsum(lengths).tolist()]), ("input_ids", ids.astype("<u4" if wide else "<u2").tobytes()), ("position_ids", at.tobytes())):
                    rows[name].append(value)
                number += 1
                if len(rows["n_tokens"]) == 2000:
                    yield batch_of(rows)
                    rows.clear()
            if rows:
                yield batch_of(rows)

        def batch_of(rows: dict) -> pa.RecordBatch:
            kinds = {"sequence_id": pa.int64(), "n_tokens": pa.int32(), "doc_ids": pa.list_(id_kind), "pieces": pa.list_(pa.int32()), "starts": pa.list_(pa.int64()), "cu_seqlens": pa.list_(pa.int32()), "input_ids": pa.binary(), "position_ids": pa.binary()}
            return pa.RecordBatch.from_arrays([pa.array(rows[k], t) for k, t in kinds.items()], names=list(kinds))

        id_kind = pa.int64()
        for batch in batches:
            id_kind = batch.column(0).type
            for owner, ids in zip(batch.column(0).to_pylist(), encoded(batch.column(1), path, end), strict=True):
                held.append(ids)
                owners.append(owner)
                size += len(ids) // 4
                if size >= SHARD_TOKENS:
                    yield from flush()
                    held, owners, size = [], [], 0
        if held:
            yield from flush()

    narrow = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    return narrow.mapInArrow(lean(run), f"sequence_id bigint, n_tokens int, doc_ids array<{kind}>, pieces array<int>, starts array<bigint>, cu_seqlens array<int>, input_ids binary, position_ids binary")


def write_packed(packed: DataFrame, path: str) -> DataFrame:
    """The id matrices as Parquet files of fixed-length rows, with their segment lengths and positions; returned as they are read back."""
    packed.write.mode("error").parquet(path)
    return packed.sparkSession.read.schema(packed.schema).parquet(path)


def op5_packed_ids(spark, sf_dir: str) -> DataFrame:
    """All documents, written and read back; of the two matrices a digest of each row."""
    packed = packed_output(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text")
    packed = write_packed(packed, f"{scratch_dir(spark)}/packed-{uuid.uuid4().hex}")
    return packed.select("sequence_id", "n_tokens", "doc_ids", "pieces", "starts", "cu_seqlens", F.crc32("input_ids").alias("input_crc32"), F.crc32("position_ids").alias("position_crc32"))


def op10_best_fit(spark, sf_dir: str) -> DataFrame:
    """All documents, 2,048 ids a sequence."""
    return best_fit_pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text")
