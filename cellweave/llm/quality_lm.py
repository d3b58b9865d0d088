"""Quality classifier: an interpolated modified Kneser-Ney model of character n-grams, trained on trusted text.

Counting   Trusted documents (label 1) of the training folds give all n-grams
           of ORDER characters, counted a batch at a time and summed by
           n-gram. Orders below ORDER use the number of different characters
           that precede an n-gram. Contexts at the start of a text are padded.
Model      Three discounts an order from the counts of counts; the
           probability of every seen n-gram and the back-off weight of every
           seen context come from joins between the orders, sharded by n-gram.
Scoring    Perplexity of each whole document, by joins with the sharded
           model, the same way at every size. Documents are taken in blocks
           of about BLOCK_BYTES; a block asks each shard once for each of its
           different n-grams, the shard answers with their probabilities, and
           the answers meet the block's documents, which are shuffled once,
           compressed. A shard is told by the last two characters and holds
           the whole back-off chain of its n-grams; requests of MANY_BLOCKS
           blocks at a time meet a copy of it, so neither a frequent n-gram
           nor the number of documents makes a group grow.
Verdict    Trusted documents of the held-out fold give each language's
           quantile of perplexity; a document beyond it is rejected. Short
           texts vary more: SMOOTHING characters at the language's mean are
           added to each text for this comparison.

Characters are exact: an n-gram is its code points. Only two stand for others:
U+10FFFF, which no text may hold, is the padding, and it and NUL are read as
U+10FFFE. A character that no trusted text has is one more of the alphabet.

Blocks are cut by rows, twice, so rows must come in the same order both times:
rows of files do; what a shuffle brings is written to the shared folder first.
A block that differs is an error, not a wrong figure.

Defined results
  null text       an empty text: null perplexity, rejected
  null language   a language of its own, "unknown"
  rare languages  with under MIN_CALIBRATION held-out trusted documents use the limit of all languages
  no trusted text every document with text is kept (perplexity of a uniform model, no limit)
  null id, label  such label rows are ignored; documents with a null id are scored
  repeated rows   each is reported; contradictory labels of one id: the least one holds
  empty table     no rows
  other columns   ignored by score(), kept by keep_good()
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cellweave.llm.common import discard, fresh, give_back, key_filter, lean, materialize, with_filter

ORDER = 5
PAD, NUL = 0x10FFFF, 0x10FFFE
#: Characters that are looked at at once.
AT_ONCE = 300_000
BLOCK_BYTES = 6_000_000
#: Shards of the model; the contexts of a character are in each of SPREAD parts that its successors are dealt over.
SHARDS, SPREAD = 128, 8
#: Partitions of documents, of a few blocks each, whose requests meet the same copy of a shard.
MANY_BLOCKS = 128
#: Folds by hash of the id; the last one calibrates, the others train.
FOLDS = 5
QUANTILE, SMOOTHING, MIN_CALIBRATION = 0.995, 200, 50
#: Perplexities are counted in bins of this width of their logarithm.
BIN = 0.001
#: Up to so many different characters, n-grams are packed into 64 bits as they are; of more, hashes are compared, and verified.
PACKED = 1 << 12
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def symbols(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where((points == 0) | (points == PAD), np.uint32(NUL), points)


def windows(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(characters, first place, text) of the n-grams of ORDER, about AT_ONCE at a time; one for each character, preceded by padding at the start."""
    held, owners, size = [], [], 0
    pad = np.full(ORDER - 1, PAD, np.uint32)

    def made() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        flat, who = np.concatenate(held), np.concatenate(owners)[ORDER - 1 :]
        at = np.flatnonzero(who >= 0)
        return flat, at, who[at]

    for k, text in enumerate(texts):
        before = pad
        for at in range(0, len(text), AT_ONCE):
            part = symbols(text[at : at + AT_ONCE])
            held += [before, part]
            owners += [np.full(ORDER - 1, -1, np.int32), np.full(len(part), k, np.int32)]
            size += len(part)
            before = np.concatenate([before, part])[-(ORDER - 1) :]
            if size >= AT_ONCE:
                yield made()
                held, owners, size = [], [], 0
    if size:
        yield made()


class Codes:
    """64-bit numbers of n-grams: equal for equal n-grams of these texts only."""

    def __init__(self, texts: list[str]):
        used = np.zeros(PAD + 1, bool)
        used[PAD] = True
        for text in texts:
            for at in range(0, len(text), AT_ONCE):
                used[symbols(text[at : at + AT_ONCE])] = True
        self.alphabet = np.flatnonzero(used).astype(np.uint32)
        self.dense = np.cumsum(used, dtype=np.uint32)
        self.exact = len(self.alphabet) < PACKED
        for self.radix in (PACKED,) if self.exact else MULTIPLIERS:
            if self._packed(texts) if self.exact else self._found(texts):
                return
        raise RuntimeError("hashes of different n-grams agree under every multiplier")

    def _packed(self, texts: list[str]) -> bool:
        """Find keys, grams (their characters, a row each) and counts: the key says the characters."""
        keys, counts = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for flat, at, _ in windows(texts):
            key, n = np.unique(self.of(flat, at), return_counts=True)
            keys.append(key)
            counts.append(n)
        every = np.concatenate(keys)
        order = np.argsort(every)
        every = every[order]
        first = np.flatnonzero(np.append(True, every[1:] != every[:-1])[: len(every)])
        self.keys = every[first]
        self.counts = np.add.reduceat(np.concatenate(counts)[order], first) if len(first) else np.empty(0, np.int64)
        bits = PACKED.bit_length() - 1
        places = [(self.keys >> np.uint64(bits * (ORDER - 1 - k))) & np.uint64(PACKED - 1) for k in range(ORDER)]
        self.grams = self.alphabet[np.stack(places, axis=1).astype(np.int64) - 1]
        return True

    def of(self, flat: np.ndarray, at: np.ndarray) -> np.ndarray:
        dense = self.dense[flat].astype(np.uint64)
        code = np.zeros(max(0, len(flat) - ORDER + 1), np.uint64)
        for k in range(ORDER):
            code = code * np.uint64(self.radix) + dense[k : k + len(code)]
        return code[at]

    def _found(self, texts: list[str]) -> bool:
        """The same by hashes; False if one stands for two n-grams."""
        keys, grams, counts = [np.empty(0, np.uint64)], [np.empty((0, ORDER), np.uint32)], [np.empty(0, np.int64)]
        for flat, at, _ in windows(texts):
            code = self.of(flat, at)
            key, first, n = np.unique(code, return_index=True, return_counts=True)
            gram = flat[at[first][:, None] + np.arange(ORDER)]
            if (flat[at[:, None] + np.arange(ORDER)] != gram[np.searchsorted(key, code)]).any():
                return False
            keys.append(key)
            grams.append(gram)
            counts.append(n)
        every, all_grams = np.concatenate(keys), np.concatenate(grams)
        self.keys, first, place = np.unique(every, return_index=True, return_inverse=True)
        self.grams = all_grams[first]
        self.counts = np.bincount(place, np.concatenate(counts), len(self.keys)).astype(np.int64)
        return bool((self.grams[place] == all_grams).all())


def texts_of(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def blocks_of(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.Table]:
    """Rows in order, about BLOCK_BYTES of column `at` a table, wherever the batches end."""
    held, size = [], 0
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 16)
        start, base = 0, 0
        while (i := int(np.searchsorted(ends - base + size, BLOCK_BYTES))) < len(ends):
            held.append(batch.slice(start, i + 1 - start))
            block, held = pa.Table.from_batches(held), []
            yield block
            del block
            size, start, base = 0, i + 1, int(ends[i])
        if start < len(ends):
            held.append(batch.slice(start))
            size += int(ends[-1]) - base
    if held:
        yield pa.Table.from_batches(held)


def block_id(texts: list[str], number: int) -> int:
    """Of a block by its place and its texts, as a signed number: another order of rows gives other ones."""
    crc = 0
    for t in texts:
        crc = zlib.crc32(t.encode("utf-8", "surrogatepass"), zlib.crc32(len(t).to_bytes(8, "little"), crc))
    place = TaskContext.get().partitionId() << 12 | number & 0xFFF
    return ((place << 32 | crc) * 0x9E3779B97F4A7C15 + (1 << 63)) % (1 << 64) - (1 << 63)


def shard(before: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Of a last character and the one before it."""
    mixed = (before.astype(np.uint64) * np.uint64(SPREAD) + last % np.uint32(SPREAD)) * np.uint64(MULTIPLIERS[0])
    return (mixed >> np.uint64(40)).astype(np.int64) % SHARDS


@lean
def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks_of(batches, 0):
        found = Codes(texts_of(block.column(0)))
        strings = np.ascontiguousarray(found.grams).view(f"<U{ORDER}").ravel()
        for at in range(0, len(strings), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(strings[at : at + 50_000].tolist(), pa.string()), pa.array(found.counts[at : at + 50_000])], names=["g", "a"])
        del found, strings
        give_back()


def train(texts: DataFrame, text_col: str) -> DataFrame:
    """(k, g, v): for each seen n-gram of k characters the logarithm of its probability, and with -k, for each seen context of k - 1, that of its back-off weight."""
    counted = texts.select(F.col(text_col).cast("string").alias("t")).mapInArrow(_count_batches, "g string, a bigint")
    level = materialize(counted.groupBy("g").agg(F.sum("a").alias("a")), "grams")
    levels = {ORDER: level}
    for k in range(ORDER - 1, 0, -1):
        level = materialize(level.groupBy(F.substring("g", 2, k).alias("g")).agg(F.count("*").alias("a")), "grams")
        levels[k] = level
    alphabet = levels[1].count() + 1
    below, model, belows = None, None, []
    for k in range(1, ORDER + 1):
        level = levels[k]
        n = [r or 0 for r in level.agg(*[F.count_if(F.col("a") == i) for i in (1, 2, 3, 4)]).first()]
        d = [0.5, 1.0, 1.5]
        if all(n):
            y = n[0] / (n[0] + 2 * n[1])
            d = [min(max(i + 1 - (i + 2) * y * n[i + 1] / n[i], 0.05), i + 0.95) for i in range(3)]
        cut = F.when(F.col("a") == 1, d[0]).when(F.col("a") == 2, d[1]).otherwise(d[2])
        level = level.withColumn("h", F.substring("g", 1, k - 1))
        per = level.groupBy("h").agg(F.sum("a").alias("total"), F.sum(cut).alias("cuts"))
        per = per.select("h", "total", (F.col("cuts") / F.col("total")).alias("back"))
        joined = level.join(per, "h").withColumn("own", (F.col("a") - cut) / F.col("total"))
        if k == 1:
            p = F.col("own") + F.col("back") / alphabet
        else:
            joined = joined.join(below.select(F.col("g").alias("s"), F.col("p").alias("lower")), F.substring("g", 2, k - 1) == F.col("s"))
            p = F.col("own") + F.col("back") * F.col("lower")
        below = materialize(joined.select("g", p.alias("p")), "level")
        belows.append(below)
        both = below.select(F.lit(k).alias("k"), "g", F.log("p").alias("v")).unionByName(per.select(F.lit(-k).alias("k"), F.col("h").alias("g"), F.log("back").alias("v")))
        model = both if model is None else model.unionByName(both)
    model = materialize(model.withColumn("v", F.col("v").cast("float")), "model")
    discard(*levels.values(), *belows)
    return model


@lean
def _dealt(batches: Iterator[pa.RecordBatch], copies: int) -> Iterator[pa.RecordBatch]:
    """The model's rows (k, g, v) with the shards that need them: key is copy * SHARDS + shard, g its code points."""
    for batch in batches:
        k = batch.column(0).to_numpy()
        points = np.array(batch.column(1).to_pylist(), f"<U{ORDER}").view("<u4").reshape(-1, ORDER)
        row, key = [], []
        for kind in np.unique(k):
            at = np.flatnonzero(k == kind)
            if abs(kind) == 1:
                to = np.broadcast_to(np.arange(SHARDS), (len(at), SHARDS))
            elif kind > 0:
                to = shard(points[at, kind - 2], points[at, kind - 1])[:, None]
            else:
                to = np.stack([shard(points[at, -kind - 2], np.full(len(at), b, np.uint32)) for b in range(SPREAD)], axis=1)
                to = np.where(np.triu(to[:, :, None] == to[:, None, :], 1).any(axis=1), -1, to)  # a shard once
            who = np.repeat(at, to.shape[1])
            to = to.ravel()
            row.append(who[to >= 0])
            key.append(to[to >= 0])
        row, key = np.concatenate(row), np.concatenate(key)
        names = [points[i].tobytes()[: 4 * (abs(n) - (n < 0))] for i, n in enumerate(k.tolist())]
        bare = pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.binary()), batch.column(2)], names=["k", "g", "v"])
        for copy in range(copies):
            for at in range(0, len(row), 50_000):
                part = bare.take(pa.array(row[at : at + 50_000]))
                yield pa.RecordBatch.from_arrays([pa.array(key[at : at + 50_000] + copy * SHARDS), *part.columns], names=["key", "k", "g", "v"])


@lean
def _asked(batches: Iterator[pa.RecordBatch], copies: int) -> Iterator[pa.RecordBatch]:
    """A row (key, block, shard, n, grams) for each block and shard: its different n-grams, compressed by place."""
    press = zstandard.ZstdCompressor(level=3)
    copy = TaskContext.get().partitionId() // MANY_BLOCKS % copies

    def rows(block: pa.Table, number: int) -> pa.RecordBatch:
        texts = texts_of(block.column(0))
        name, grams = block_id(texts, number), Codes(texts).grams
        to = shard(grams[:, ORDER - 2], grams[:, ORDER - 1])
        order = np.argsort(to, kind="stable")
        found, first = np.unique(to[order], return_index=True)
        parts = np.split(order, first[1:]) if len(order) else []
        packed = [press.compress(np.ascontiguousarray(grams[p].T).tobytes()) for p in parts]
        return pa.RecordBatch.from_arrays([pa.array(found + copy * SHARDS, pa.int64()), pa.array([name] * len(found), pa.int64()), pa.array(found.astype(np.int32)), pa.array([len(p) for p in parts], pa.int32()), pa.array(packed, pa.binary())], names=["key", "block", "shard", "n", "grams"])

    number, blocks = 0, blocks_of(batches, 0)
    while (block := next(blocks, None)) is not None:
        made = rows(block, number)
        del block  # before the next one is brought together
        give_back()
        yield made
        number += 1


def _fixed(points: np.ndarray) -> pa.Array:
    rows, width = points.shape
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * width), rows, [None, pa.py_buffer(np.ascontiguousarray(points))])


@lean
def _answered(asked: pa.Table, model: pa.Table, alphabet: int) -> pa.Table:
    """(block, shard, logp) for each row of requests: of the last character of each n-gram, the longest seen first."""
    schema = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("logp", pa.binary())])
    if not len(asked):
        return schema.empty_table()
    sizes = asked["n"].to_numpy()
    open_ = zstandard.ZstdDecompressor()
    grams = np.concatenate([np.frombuffer(open_.decompress(b), np.uint32).reshape(ORDER, -1).T for b in asked["grams"].to_pylist()])
    out, left = np.zeros(len(grams), np.float64), np.arange(len(grams))
    kinds = model["k"].to_numpy()

    def look_up(kind: int, points: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(kinds == kind)
        if not len(at):
            return np.full(len(points), np.nan)
        values = model["v"].to_numpy()[at]
        if not points.shape[1]:
            return np.full(len(points), values[0])
        own = model["g"].take(pa.array(at)).combine_chunks().cast(pa.binary(4 * points.shape[1]))
        place = pc.fill_null(pc.index_in(_fixed(points), value_set=own), -1).to_numpy(zero_copy_only=False)
        return np.where(place >= 0, values[place], np.nan)

    for k in range(ORDER, 0, -1):
        p = look_up(k, grams[left, ORDER - k :])
        seen = ~np.isnan(p)
        out[left[seen]] += p[seen]
        left = left[~seen]
        if not len(left):
            break
        back = look_up(-k, grams[left, ORDER - k : ORDER - 1])
        out[left] += np.where(np.isnan(back), 0.0, back)
    out[left] -= np.log(alphabet)
    press = zstandard.ZstdCompressor(level=1)
    parts = np.split(out.astype(np.float32), np.cumsum(sizes)[:-1])
    return pa.table([asked["block"], asked["shard"], pa.array([press.compress(x.tobytes()) for x in parts], pa.binary())], schema=schema)


@lean
def _packed_blocks(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    """A row (block, rows) for each block: all columns, compressed."""

    def row(block: pa.Table, number: int) -> pa.RecordBatch:
        name, sink = block_id(texts_of(block.column(at)), number), pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, block.schema) as out:  # compressed as one, so that columns that say the same cost once
            out.write_table(block.combine_chunks())
        packed = zstandard.ZstdCompressor(level=3).compress(sink.getvalue())
        return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([packed], pa.binary())], names=["block", "rows"])

    number, blocks = 0, blocks_of(batches, at)
    while (block := next(blocks, None)) is not None:
        made = row(block, number)
        del block
        give_back()
        yield made
        number += 1


@lean
def _summed(packed: pa.Table, answers: pa.Table, at: int, schema: pa.Schema) -> pa.Table:
    """The rows of a block with nll and the number of characters of each."""
    done, open_ = [], zstandard.ZstdDecompressor()
    by_shard = dict(zip(answers["shard"].to_pylist(), answers["logp"].to_pylist(), strict=True))
    for one in packed["rows"]:
        block = pa.ipc.open_stream(open_.decompress(one.as_py())).read_all()
        texts = texts_of(block.column(at))
        codes = Codes(texts)
        order = np.argsort(shard(codes.grams[:, ORDER - 2], codes.grams[:, ORDER - 1]), kind="stable")
        said = [np.frombuffer(open_.decompress(by_shard[s]), np.float32) for s in sorted(by_shard)]
        said = np.concatenate(said) if said else np.empty(0, np.float32)
        if len(said) != len(order):
            raise RuntimeError("the rows of a block came in another order than before; write them to a table first")
        logp = np.empty(len(order), np.float64)
        logp[order] = said
        nll, n, places = np.zeros(len(texts)), np.zeros(len(texts), np.int64), pd.Index(codes.keys)
        for flat, where, who in windows(texts):
            nll -= np.bincount(who, logp[places.get_indexer(codes.of(flat, where))], len(texts))
            n += np.bincount(who, minlength=len(texts))
        done.append(pa.Table.from_arrays([*block.columns, pa.chunked_array([nll]), pa.chunked_array([n])], schema=schema))
    return pa.concat_tables(done) if done else schema.empty_table()


def score_rows(docs: DataFrame, model: DataFrame, text_col: str, nll: str, n: str) -> DataFrame:
    """docs with two more columns: minus the logarithm of the probability of the text, and its number of characters."""
    if re.search("(?<!Broadcast)Exchange", docs._jdf.queryExecution().executedPlan().toString()):
        docs = materialize(docs, "scored")
    at, copies = docs.columns.index(text_col), 1 + docs.rdd.getNumPartitions() // MANY_BLOCKS
    alphabet = model.where("k = 1").count() + 1
    schema = T.StructType([*docs.schema.fields, T.StructField(nll, T.DoubleType()), T.StructField(n, T.LongType())])

    arrow = to_arrow_schema(schema)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _dealt(batches, copies)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _asked(batches, copies)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _packed_blocks(batches, at)

    def answer(asked: pa.Table, own: pa.Table) -> pa.Table:
        return _answered(asked, own, alphabet)

    def total(packed: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(packed):
            raise RuntimeError("the rows of a block came in another order than before; write them to a table first")
        return _summed(packed, answers, at, arrow)

    shards = model.mapInArrow(deal, "key bigint, k int, g binary, v float")
    asked = docs.select(F.col(f"`{text_col}`").cast("string")).mapInArrow(ask, "key bigint, block bigint, shard int, n int, grams binary")
    answers = asked.groupBy("key").cogroup(shards.groupBy("key")).applyInArrow(answer, "block bigint, shard int, logp binary")
    packed = docs.mapInArrow(pack, "block bigint, rows binary")
    return packed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(total, schema)


def limits(scored: DataFrame) -> DataFrame:
    """(lang, held, mean, limit) of held-out trusted documents (__lang, __nll, __n); lang null: of all languages: sums and a histogram by language, whatever their number."""
    both = scored.where("__n > 0").select(F.explode(F.array(F.col("__lang"), F.lit(None))).alias("lang"), F.col("__nll").alias("nll"), F.col("__n").alias("n"))
    means = both.groupBy(F.col("lang").alias("m_lang")).agg((F.sum("nll") / F.sum("n")).alias("mean"), F.count("*").alias("held"))
    binned = both.join(means, F.col("lang").eqNullSafe(F.col("m_lang"))).select("lang", "mean", "held", F.ceil(smoothed(F.col("nll"), F.col("n"), F.col("mean")) / BIN).alias("bin"))
    counts = binned.groupBy("lang", "mean", "held", "bin").agg(F.count("*").alias("c"))
    upto = F.sum("c").over(Window.partitionBy("lang").orderBy("bin"))
    found = counts.withColumn("upto", upto).where(F.col("upto") >= QUANTILE * F.col("held"))
    return found.groupBy("lang").agg(F.first("mean").alias("mean"), F.first("held").alias("held"), (F.min("bin") * BIN).alias("limit"))


def smoothed(nll: Column, n: Column, mean: Column) -> Column:
    return (nll + SMOOTHING * mean) / (n + SMOOTHING)


def likely(rows: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """The rows whose id is in ids, and few others: a filter of fixed size, whatever the number of ids, so that a join moves few texts."""
    (may,) = fresh(rows, "may")
    hashed = F.xxhash64(F.col(id_col).cast("string"))
    found = materialize(key_filter(ids.select(hashed.alias("h")), "h"), "filter")
    return with_filter(rows, found, hashed, may).where(F.col(may)).drop(may)


class Judge:
    """The model and the limits that trusted documents set. What Spark broadcasts of the trusted ids it decides by their size."""

    def __init__(self, docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, lang_col: str, label_col: str):
        known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("labelled")).agg(F.min(label_col).alias("good"))
        trusted = materialize(known.where("good = 1").select("labelled"), "trusted")
        rows = docs.select(F.col(f"`{id_col}`").alias("id"), self.language(lang_col).alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))
        rows = likely(rows, trusted.select(F.col("labelled").alias("id")), "id").join(trusted, F.col("id") == F.col("labelled"), "left_semi")
        fold = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(FOLDS))
        self.model = train(rows.where(fold < FOLDS - 1), "text")
        held = score_rows(rows.where(fold == FOLDS - 1).select("lang", "text"), self.model, "text", "nll", "n")
        self.limits = materialize(limits(held.select(F.col("lang").alias("__lang"), F.col("nll").alias("__nll"), F.col("n").alias("__n"))), "limits")

    @staticmethod
    def language(lang_col: str) -> Column:
        return F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("unknown"))

    def judged(self, docs: DataFrame, text_col: str, lang: Column) -> tuple[DataFrame, Column, Column, Column, Column]:
        """docs with columns more, and columns of them: nll, characters, limit (of the logarithm), rejected. Limits are one row a language, and one for all."""
        nll, n, own, mean_of, limit_of = fresh(docs, "nll", "n", "own", "mean", "limit")
        mean, limit = next(((r["mean"], r["limit"]) for r in self.limits.where("lang IS NULL").collect()), (None, None))
        per = self.limits.where(F.col("lang").isNotNull() & (F.col("held") >= MIN_CALIBRATION)).select(F.col("lang").alias(own), F.col("mean").alias(mean_of), F.col("limit").alias(limit_of))
        out = score_rows(docs, self.model, text_col, nll, n).join(per, lang == F.col(own), "left")
        least = F.coalesce(limit_of, F.lit(limit).cast("double"))
        beyond = F.coalesce(smoothed(F.col(nll), F.col(n), F.coalesce(mean_of, F.lit(mean).cast("double"))) > least, F.lit(False))
        return out, F.col(nll), F.col(n), least, beyond | (F.col(n) == 0)


def score(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, lang_col: str, label_col: str) -> DataFrame:
    """(id, lang, n_symbols, perplexity, limit, rejected) of each row. labels: (id_col, label_col)."""
    judge = Judge(docs, labels, id_col, text_col, lang_col, label_col)
    rows = docs.select(F.col(f"`{id_col}`").alias("__id"), judge.language(lang_col).alias("__lang"), F.col(f"`{text_col}`").cast("string").alias("__text"))
    out, nll, n, limit, rejected = judge.judged(rows, "__text", F.col("__lang"))
    return out.select(
        F.col("__id").alias(id_col),
        F.col("__lang").alias("lang"),
        n.alias("n_symbols"),
        F.when(n > 0, F.exp(nll / n)).alias("perplexity"),
        F.exp(limit).alias("limit"),
        rejected.alias("rejected"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, lang_col: str, label_col: str) -> DataFrame:
    """The rows of docs that aren't rejected, with all their columns."""
    judge = Judge(docs, labels, id_col, text_col, lang_col, label_col)
    out, _, _, _, rejected = judge.judged(docs, text_col, judge.language(lang_col))
    return out.where(~rejected).select(*[F.col(f"`{c}`") for c in docs.columns])


def op6_kneser_ney(spark, sf_dir: str) -> DataFrame:
    """All documents; documents labelled as of good quality are the trusted text."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return score(docs, labels, "doc_id", "text", "lang", "quality")
