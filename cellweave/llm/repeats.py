"""Repeated byte strings by a depth-limited radix sort of suffixes.

All suffixes are ordered through their first `length` bytes only: suffixes that
are equal so far are exactly the repeated windows. The sort goes by most
significant digits, a pass a digit. A digit may be any function of the window's
own bytes, since equal windows then have equal digits, and only the groups
matter. These digits keep suffixes together that stand together:

1. The window's anchor: of its ANCHOR-byte strings the one whose first bytes
   have the least hash, the first of several. A run of some 14 suffixes shares
   one, so it moves once.
2. The run: the bytes that all suffixes of the run cover, the same for copies.
3. The whole window, 96 bits of hash over all its bytes.

A suffix goes to the next pass only while its group isn't settled: groups of
one document drop out after pass 1; after pass 2 all but the run's first
document know a smaller one that has all their windows, and a run that is the
only one around its anchor has no others to meet. Pass 3 gets what is left.

The digits of a pass are sorted in shards, told by their leading bits. A shard
gets a row from each block of documents: its different digits, once, with the
least and the greatest document, packed in order. So a passage that a third of
all documents hold is one entry a block. What came of them goes back to
the blocks that asked, as far as another block changed it. Blocks of texts are
written once to the shared folder, in buckets, so no pass shuffles a text.

Defined results
  null text      an empty text: nothing removed
  null id        above every id, and not smaller than another null
  repeated rows  rows of one id are one document: their common strings stay, in all of them
  short text     fewer bytes than `length`: nothing removed
  very long text a block of its own, read in slabs
  empty table    no rows
  other columns  ignored, whatever their names
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import lean, materialize, scratch_dir, session_of, table

LENGTH, ANCHOR = 50, 24
#: Bits of an anchor's digit: it only tells which suffixes go on. Those of runs and windows, which decide, have 96.
ANCHOR_BITS = 48
#: Bytes of the texts in a block, window starts that are looked at in one go, and different digits in a shard, about.
BLOCK_BYTES, SLAB, SHARD_KEYS = 8 << 20, 1 << 18, 1 << 20
_U = np.uint64
_ODD = [_U(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)]
#: Bytes of a piece of a text in SQL.
PIECE = 500
NO_ID = np.iinfo(np.int64).max
_ASKED = "kind int, shard int, block bigint, keys binary, low binary, high binary"
_TOLD = "kind int, shard int, block bigint, spot binary, low binary, high binary"


def pack(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x).tobytes())


def unpack(b: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), dtype)


def words(data: np.ndarray) -> np.ndarray:
    """The eight bytes at each place but the last seven, as one number."""
    if len(data) < 8:
        return np.empty(0, np.uint64)
    w = data.astype(np.uint64)
    for k in (1, 2, 4):
        w = w[:-k] | (w[k:] << _U(8 * k))
    return w


def _fold(state: np.ndarray, word: np.ndarray, lane: int) -> np.ndarray:
    word = word * _ODD[lane]
    word ^= word >> _U(29)
    state = (state ^ word) * _ODD[lane + 1]
    state ^= state >> _U(31)
    return state


def digest(w: np.ndarray, at: np.ndarray, length: int, lane: int) -> np.ndarray:
    """64 bits of hash of the length bytes at each of some places; w: words()."""
    state = np.full(len(at), length * 2 + lane + 1, np.uint64)
    for k in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]:
        state = _fold(state, w[at + k], lane)
    return _fold(state, state >> _U(33), lane)


def runs(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, slab: int = SLAB) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, anchor) of each run: windows of a text, one after the other, with the same anchor."""
    first, count, anchor = [], [], []
    width, low_bits = length - ANCHOR + 1, _U((1 << 20) - 1)
    ends = offsets[1:]
    for a in range(0, len(data) - length + 1, slab):
        b = min(a + slab, len(data) - length + 1)
        w = words(data[a : b + length - 1])
        key = _fold(_fold(np.full(len(w) - 8, 7, np.uint64), w[:-8], 0), w[8:], 0)[: len(w) + 8 - ANCHOR]
        key = (key & ~low_bits) | np.arange(len(key), dtype=np.uint64)
        done = 1
        while done < width:
            step = min(done, width - done)
            key = np.minimum(key[: len(key) - step], key[step:])
            done += step
        own = (key[: b - a] & low_bits).astype(np.int64)
        lo, hi = np.searchsorted(ends, a, side="right"), np.searchsorted(ends, b, side="left")
        for end in ends[lo : hi + 1]:  # windows that would cross the end of a text
            own[max(0, end - length + 1 - a) : max(0, end - a)] = -1
        new = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        n = np.diff(np.concatenate((new, [len(own)])))
        good = own[new] >= 0
        first.append(new[good] + a)
        count.append(n[good])
        anchor.append(own[new][good] + a)
    if not first:
        return (np.empty(0, np.int64),) * 3
    return np.concatenate(first), np.concatenate(count), np.concatenate(anchor)


def _block(part: int, number: int, ids: list, texts: list[bytes], length: int) -> pa.RecordBatch:
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    first, count, anchor = runs(data, offsets, length)
    known = np.array([NO_ID if i is None else i for i in ids], np.int64)
    none = np.array([i is None for i in ids], bool)
    row = [(part << 32) + number, len(first), *map(pack, (known, none, np.diff(offsets), data, np.diff(first, prepend=0).astype(np.int32), count.astype(np.uint8), (anchor - first).astype(np.uint8)))]
    return pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=["block", "n", "ids", "none", "sizes", "data", "first", "count", "anchor"])


@lean
def _blocks(batches: Iterator[pa.RecordBatch], length: int, block_bytes: int) -> Iterator[pa.RecordBatch]:
    part, number, size, ids, texts = TaskContext.get().partitionId(), 0, 0, [], []
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            text = text.as_py()
            if ids and size + len(text) > block_bytes:
                yield _block(part, number, ids, texts, length)
                number, size, ids, texts = number + 1, 0, [], []
            ids.append(doc)
            texts.append(text)
            size += len(text)
    if ids:
        yield _block(part, number, ids, texts, length)


class Block:
    """A block of texts, with what the passes so far told of it. One pass after the other: asks(k) for the digits of pass k, take(k, ...) for the answers."""

    def __init__(self, row: dict, length: int):
        self.number, self.length = row["block"], length
        self.ids, self.none = unpack(row["ids"], np.int64), unpack(row["none"], bool)
        self.data = unpack(row["data"], np.uint8)
        self.offsets = np.concatenate(([0], np.cumsum(unpack(row["sizes"], np.int64)))).astype(np.int64)
        self.first = np.cumsum(unpack(row["first"], np.int32), dtype=np.int64)
        self.count, anchor = unpack(row["count"], np.uint8).astype(np.int64), unpack(row["anchor"], np.uint8)
        self.doc = self.ids[np.searchsorted(self.offsets, self.first, side="right") - 1]
        self.words = words(self.data)
        self.anchor = (digest(self.words, self.first + anchor, ANCHOR, 0) >> _U(64 - ANCHOR_BITS))[:, None]

    def _asked(self, keys: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The different keys in order, the least low and the greatest high of each, and for each row of keys its place among them."""
        order = np.lexsort(keys.T[::-1])
        sorted_keys = keys[order]
        new = np.concatenate(([True], (sorted_keys[1:] != sorted_keys[:-1]).any(axis=1))) if len(keys) else np.empty(0, bool)
        at = np.flatnonzero(new)
        place = np.empty(len(keys), np.int64)
        place[order] = np.cumsum(new) - 1
        if not len(at):
            return keys, low, high, place
        return sorted_keys[at], np.minimum.reduceat(low[order], at), np.maximum.reduceat(high[order], at), place

    @staticmethod
    def _hashed(*parts: np.ndarray) -> np.ndarray:
        return np.stack([parts[0], parts[1] & _U(0xFFFFFFFF)], axis=1)

    def asks(self, kind: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(keys, low, high, shard, place). Kind 1: anchors, and whether several documents here have them. 2: live anchors and their runs. 3: live runs and their least document. 4: windows of unsettled runs and their least document."""
        if kind == 1:
            keys, low, high, place = self._asked(self.anchor, self.doc, self.doc)
            low, high = np.full(len(keys), 2 * self.number), 2 * self.number + (low != high)
        elif kind == 2:
            said = self.run[:, 0].view(np.int64)
            keys, low, high, place = self._asked(self.anchor[self.live], said, said)
        else:
            keys, low, _, place = self._asked(self.run, *[self.doc[self.live]] * 2) if kind == 3 else self._asked(self._windows(), self.window_doc, self.window_doc)
            high = low
        shard = (keys[:, 0] >> _U((ANCHOR_BITS if kind < 3 else 64) - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
        if kind > 2:  # random keys, so the order is the documents'
            order = np.lexsort((low, shard))
            back = np.empty_like(order)
            back[order] = np.arange(len(order))
            keys, low, high, shard, place = keys[order], low[order], high[order], shard[order], back[place]
        return keys, low, high, shard, place

    def _windows(self) -> np.ndarray:
        return self._hashed(*[digest(self.words, self.window, self.length, k) for k in (0, 2)])

    def take(self, kind: int, low: np.ndarray, high: np.ndarray, place: np.ndarray) -> None:
        """What pass `kind` found: the least low and the greatest high of each of the keys that were asked."""
        low, high = low[place], high[place]
        if kind == 1:
            self.live = np.flatnonzero(low != high)
            a, b = self.first[self.live], self.first[self.live] + self.count[self.live] - 1
            ends = [(digest(self.words, a, self.length, k), digest(self.words, b, self.length, k)) for k in (0, 2)]
            self.run = self._hashed(*[_fold(_fold(x, y, k), self.count[self.live].astype(np.uint64), k) for k, (x, y) in zip((0, 2), ends, strict=True)])
        elif kind == 2:
            self.contested = low != high
        elif kind == 3:
            doc = self.doc[self.live]
            self.gone = self.live[low < doc]
            left = self.live[(low == doc) & self.contested]
            n = self.count[left]
            self.window = np.repeat(self.first[left] - np.cumsum(n) + n, n) + np.arange(n.sum())
            self.window_doc = np.repeat(self.doc[left], n)
        else:
            self.gone_windows = self.window[low < self.window_doc]

    def removed(self) -> np.ndarray:
        """For each byte, whether it is in a window that goes."""
        steps = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(steps, self.first[self.gone], 1)
        np.add.at(steps, self.first[self.gone] + self.count[self.gone] + self.length - 1, -1)
        np.add.at(steps, self.gone_windows, 1)
        np.add.at(steps, self.gone_windows + self.length, -1)
        return np.cumsum(steps)[:-1] > 0


def _sent(block: Block, kind: int, bits: int) -> Iterator[list]:
    keys, low, high, shard, _ = block.asks(kind, bits)
    at = np.searchsorted(shard, np.arange((1 << bits) + 1))
    for s in np.flatnonzero(at[1:] > at[:-1]):
        own = slice(at[s], at[s + 1])
        if kind < 3:
            said = pack(np.diff(keys[own, 0], prepend=_U(0))), pack(low[own]), pack(high[own] - low[own])
        else:
            said = keys[own, 0].tobytes() + keys[own, 1].astype(np.uint32).tobytes(), pack(np.diff(low[own], prepend=0)), b""
        yield [kind, int(s), block.number, *said]


def _heard(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys (a row a lane), low and high of what _sent sent."""
    if row["kind"] < 3:
        keys, low = np.cumsum(unpack(row["keys"], np.uint64), dtype=np.uint64)[None], unpack(row["low"], np.int64)
        return keys, low, low + unpack(row["high"], np.int64)
    low = np.cumsum(unpack(row["low"], np.int64))
    n = len(low)
    return np.stack([np.frombuffer(row["keys"][: 8 * n], np.uint64), np.frombuffer(row["keys"][8 * n :], np.uint32).astype(np.uint64)]), low, low


def _rows(rows: list[list], names: str) -> pa.RecordBatch:
    fields = [f.split() for f in names.split(", ")]
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[t]) for k, (_, t) in enumerate(fields)], names=[n for n, _ in fields])


@lean
def _told(asked: pa.Table) -> pa.Table:
    """A shard of a pass: all its digits are ordered, equal ones meet, and each block learns what others changed."""
    kind, rows = asked["kind"][0].as_py(), asked.to_pylist()
    heard = [_heard(r) for r in rows]
    size = [len(x[1]) for x in heard]
    keys, low, high = (np.concatenate(x, axis=-1) for x in zip(*heard, strict=True))
    del heard
    order = np.lexsort(keys[::-1])
    ordered = keys[:, order]
    new = np.concatenate(([True], (ordered[:, 1:] != ordered[:, :-1]).any(axis=0)))
    at, group = np.flatnonzero(new), np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    least, most = np.minimum.reduceat(low[order], at)[group], np.maximum.reduceat(high[order], at)[group]
    if kind > 2:
        most = least
    changed = (least != low) | (most != high)
    out, begin = [], 0
    for r, n in zip(rows, size, strict=True):
        spot = np.flatnonzero(changed[begin : begin + n])
        if len(spot):
            a, b = least[begin + spot], most[begin + spot]
            out.append([kind, r["shard"], r["block"], pack(spot.astype(np.int32)), pack(a), pack(b - a)])
        begin += n
    return pa.Table.from_batches([_rows(out, _TOLD)])


def _known(row: dict, told: list[dict], bits: dict[int, int], passes: int, length: int) -> Block:
    """The block after so many kinds of answers."""
    block = Block(row, length)
    for kind in range(1, passes + 1):
        _, low, high, shard, place = block.asks(kind, bits[kind])
        low, high = low.copy(), high.copy()
        for t in told:
            if t["kind"] == kind:
                spot = np.searchsorted(shard, t["shard"]) + unpack(t["spot"], np.int32)
                low[spot] = unpack(t["low"], np.int64)
                high[spot] = low[spot] + unpack(t["high"], np.int64)
        block.take(kind, low, high, place)
    return block


@lean
def _asking(batches: Iterator[pa.RecordBatch], bits: int, length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            yield _rows(list(_sent(Block(row, length), 1, bits)), _ASKED)


@lean
def _asking_more(own: pa.Table, told: pa.Table, kinds: tuple[int, ...], bits: dict[int, int], passes: int, length: int) -> pa.Table:
    rows = []
    for row in own.to_pylist():
        block = _known(row, told.to_pylist(), bits, passes, length)
        for kind in kinds:
            rows += _sent(block, kind, bits[kind])
    return pa.Table.from_batches([_rows(rows, _ASKED)])


@lean
def _finished(own: pa.Table, told: pa.Table, bits: dict[int, int], length: int) -> pa.Table:
    (row,) = own.to_pylist()
    block = _known(row, told.to_pylist(), bits, 4, length)
    gone = block.removed()
    starts, ends, counts, kept = [], [], [], []
    for low, high in zip(block.offsets[:-1], block.offsets[1:], strict=True):
        own_gone = gone[low:high]
        edges = np.flatnonzero(np.diff(own_gone, prepend=False, append=False))
        starts.append(edges[::2])
        ends.append(edges[1::2])
        counts.append(len(edges) // 2)
        kept.append(block.data[low:high][~own_gone].tobytes())
    spans = pa.StructArray.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in (starts, ends)], names=["start", "end"])
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), spans)
    ids = pa.array(block.ids, mask=block.none)
    return pa.table({"__id": ids, "n_bytes": np.diff(block.offsets), "spans": lists, "kept": pa.array(kept, pa.binary())})


def blocks_of(docs: DataFrame, id_col: str, text_col: str, length: int, block_bytes: int) -> DataFrame:
    """The texts in blocks, written once in buckets by block: passes meet them where they lie."""
    spark = session_of(docs)
    if docs.schema[id_col].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise ValueError("ids must be integers: they say which document comes first")
    sent = docs.select(F.col(f"`{id_col}`").cast("bigint"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary"))
    made = sent.mapInArrow(partial(_blocks, length=length, block_bytes=block_bytes), "block bigint, n bigint, ids binary, none binary, sizes binary, data binary, first binary, count binary, anchor binary")
    name, buckets = f"repeats_{uuid.uuid4().hex}", min(100_000, int(spark.conf.get("spark.sql.shuffle.partitions")))
    made.write.bucketBy(buckets, "block").option("path", f"{scratch_dir(spark)}/{name}").saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # only its name goes; the files stay until the scratch goes
    return out


def remove_repeats(docs: DataFrame, id_col: str, text_col: str, length: int = LENGTH, block_bytes: int = BLOCK_BYTES, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """(id, n_bytes, spans array<struct<start, end>>, kept binary) of each row: its bytes without those in a string of length bytes that also starts in a document with a smaller id."""
    if not 24 <= length <= 200:
        raise ValueError(f"length must be from 24 to 200 bytes, not {length}")
    blocks = blocks_of(docs, id_col, text_col, length, block_bytes)
    n = blocks.agg(F.sum("n")).first()[0] or 0
    of = {k: max(0, (k_n // shard_keys).bit_length()) for k, k_n in ((1, n), (2, n // 2), (3, n // 2), (4, 2 * n))}

    def asking(kinds: tuple[int, ...], passes: int):
        return lambda own, known: _asking_more(own, known, kinds, of, passes, length)

    told: DataFrame | None = None
    for kinds, passes in (((1,), 0), ((2, 3), 1), ((4,), 3)):
        if told is None:
            asked = blocks.mapInArrow(partial(_asking, bits=of[1], length=length), _ASKED)
        else:
            asked = blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(asking(kinds, passes), _ASKED)
        found = materialize(asked.groupBy("kind", "shard").applyInArrow(lambda shard: _told(shard), _TOLD), "told")
        told = found if told is None else told.unionByName(found)

    def last(own: pa.Table, known: pa.Table) -> pa.Table:
        return _finished(own, known, of, length)

    out = blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(last, "__id bigint, n_bytes bigint, spans array<struct<start: bigint, end: bigint>>, kept binary")
    return out.select(F.col("__id").cast(docs.schema[id_col].dataType).alias(id_col), "n_bytes", "spans", "kept")


def op12_radix_repeats(spark, sf_dir: str) -> DataFrame:
    """All documents, strings of 50 bytes."""
    found = remove_repeats(table(spark, sf_dir, "documents"), "doc_id", "text")
    gone = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


#: Windows as hex text, so that DuckDB cuts bytes; texts go through pieces, since a place deep in a long text is found by walking to it.
ORACLE = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS row, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT row, doc_id, {PIECE} * i AS base, substr(h, {2 * PIECE} * i + 1, {2 * (PIECE + LENGTH - 1)}) AS h FROM d, unnest(range(length(h) // {2 * PIECE} + 1)) AS u(i)),
w AS (SELECT row, doc_id, base + i AS s, substr(h, 2 * i + 1, {2 * LENGTH}) AS x FROM p, unnest(range(least({PIECE}, length(h) // 2 - {LENGTH - 1}))) AS u(i)),
m AS (SELECT row, doc_id, s, min(doc_id) OVER (PARTITION BY x) AS first FROM w),
g AS (SELECT row, s, sum(new) OVER (PARTITION BY row ORDER BY s) AS run FROM (
  SELECT row, s, CASE WHEN s - lag(s) OVER (PARTITION BY row ORDER BY s) <= {LENGTH} THEN 0 ELSE 1 END AS new FROM m WHERE first < doc_id OR (doc_id IS NULL AND first IS NOT NULL))),
r AS (SELECT row, run, min(s) AS a, max(s) + {LENGTH} AS b FROM g GROUP BY row, run),
e AS (SELECT row, a, b, lag(b, 1, 0) OVER (PARTITION BY row ORDER BY a) AS before FROM r),
k AS (SELECT row, sum(b - a)::BIGINT AS n, count(*) AS spans, max(b) AS last, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept FROM e JOIN d USING (row) GROUP BY row)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN k USING (row)
"""
