"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most 2r bits have a value between them that
differs from each in at most r bits. So every distinct fingerprint emits all
values within r bits of it, the variants; fingerprints that share a variant
are linked, and all links are found.

All variants of a fingerprint (2,081 for r = 2) are not shuffled one by one.
They are shuffled by their leading bits: a fingerprint goes once to each block
of leading bits that one of its variants has (37 of 256 blocks for 8 bits),
and the block expands the other bits itself, sorts the variants, and links
what collides. A variant that many fingerprints share gives a star, not all
pairs, and a block returns a spanning forest of its links, at most one link a
fingerprint, however large a group of near copies is. Links are joined to
components by rounds of large-star and small-star; copies with one
fingerprint take part once.

Fingerprints within a few bits of each other share a block whatever bits it
has. A block with too many variants is dealt to several tasks by a code of the
variant, its parities over fixed random sets of bits. The code of a variant
is the code of the fingerprint XOR that of the flipped bits, so each part makes
just its own variants, and all copies of one variant meet in one part. A part
sorts its variants in turns by more bits of the code, and folds the links of a
turn into its forest before the next.

Defined results
  null text      an empty text: no words, fingerprint zero, linked like any other
  few words      fewer words than a shingle: the whole sequence is the shingle
  null id        null ids count as larger than all others: a component of null ids only has a null component_id
  repeated rows  each is reported
  empty table    no rows
  other columns  ignored by near_duplicates(), kept by deduplicate()
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import discard, lean, materialize, row_key, rows_of

BITS = 64
SHINGLE, RADIUS, SEED = 4, 4, 42
#: Variants that a block sorts at once; more are done in turns, by their next bits.
SORTED_AT_ONCE = 4_000_000
#: Fingerprints a block should get at most, on average.
BLOCK_ROWS = 3_000
#: Variants of one task: a block of more is dealt by their code.
PART_VARIANTS = 32_000_000
#: Bits that the parities of a code are taken over.
CODE_SETS = np.array([xxhash.xxh64_intdigest(bytes([k]), SEED) for k in range(24)], np.uint64)


def shingle_hashes(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """XXH64 of each shingle of the text in UTF-8; A-Z count as a-z."""
    words = text.lower().split()  # of bytes: only A-Z change, only ASCII white space separates
    if not words:
        return np.empty(0, np.uint64)
    joined, n = b" ".join(words), max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    ends = ends[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts, ends, strict=True)), np.uint64, n)


def simhash(hashes: np.ndarray) -> int:
    """A bit is set if it is in over half the hashes."""
    n, votes = len(hashes), np.zeros(BITS, np.int64)
    if not n:
        return 0
    for at in range(0, n, 255):  # so many that a byte can count them
        votes += np.unpackbits(hashes[at : at + 255].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint8)
    return int(np.packbits(2 * votes > n, bitorder="little").view(np.uint64)[0])


@lean
def _fingerprint_batches(batches: Iterator[pa.RecordBatch], shingle: int, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [simhash(shingle_hashes(t.as_py() or b"", shingle, seed)) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(prints, np.uint64).view(np.int64)), batch.column(2)], names=["__id", "__print", "__key"])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(__id, __print, __key) of each row; __print has the fingerprint's 64 bits as a signed number, __key its row_key."""
    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("binary").alias("__text"), row_key(id_col, text_col).alias("__key"))
    return narrow.mapInArrow(partial(_fingerprint_batches, shingle=shingle, seed=seed), f"__id {kind}, __print bigint, __key string")


def flips(bits: int, most: int) -> np.ndarray:
    """All masks of at most so many of the lowest bits."""
    return np.array([sum(1 << b for b in c) for k in range(most + 1) for c in combinations(range(bits), k)], np.uint64)


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least member of each one's component among n, by links a-b."""
    label = np.arange(n)
    while len(a):
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], least)
        np.minimum.at(new, label[b], least)
        while True:
            deeper = new[new]
            if (deeper == new).all():
                break
            new = deeper
        if (new == label).all():
            break
        label = new
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return label


def codes(values: np.ndarray, bits: int) -> np.ndarray:
    """Parities over so many of CODE_SETS, one bit each: the code of x XOR y is the code of x XOR the code of y."""
    out = np.zeros(len(values), np.int64)
    for k in range(bits):
        out |= (np.bitwise_count(values & CODE_SETS[k]) & 1).astype(np.int64) << k
    return out


def _turn_variants(prints: np.ndarray, spent: np.ndarray, own: np.ndarray, masks: list, mask_codes: list, want: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The variants of a code and the places of their fingerprints. own: codes of prints; masks in the order of mask_codes, by bits that are spent."""
    keys, owners = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for k in range(len(masks)):
        at = np.flatnonzero(spent == k)
        at = at[np.argsort(own[at], kind="stable")]
        told = own[at]
        heads = np.append(np.flatnonzero(np.diff(told, prepend=-1)), len(at))
        for a, b in zip(heads[:-1], heads[1:], strict=True):
            code = want ^ int(told[a])
            lo, hi = np.searchsorted(mask_codes[k], (code, code + 1)) if width else (0, len(masks[k]))
            keys.append((prints[at[a:b]][:, None] ^ masks[k][lo:hi][None, :]).ravel())
            owners.append(np.repeat(at[a:b], hi - lo))
    return np.concatenate(keys), np.concatenate(owners)


def _linked(prints: np.ndarray, spent: np.ndarray, bits: int, radius: int, part: int = 0, part_bits: int = 0) -> np.ndarray:
    """The least member of each one's component, by shared variants whose code begins with part; prints share the leading bits of variants, spent: bits flipped there."""
    half, low = radius // 2, np.uint64((1 << bits) - 1)
    masks = [flips(bits, half - k) for k in range(half + 1)]
    total = sum(int((spent == k).sum()) * len(masks[k]) for k in range(half + 1)) >> part_bits
    width = min(len(CODE_SETS), part_bits + (total // SORTED_AT_ONCE).bit_length())
    mask_codes = [codes(m, width) for m in masks]
    orders = [np.argsort(c, kind="stable") for c in mask_codes]
    masks, mask_codes = ([x[o] for x, o in zip(xs, orders, strict=True)] for xs in (masks, mask_codes))
    own = codes(prints & low, width)
    label = np.arange(len(prints))
    for turn in range(1 << (width - part_bits)):
        key, who = _turn_variants(prints & low, spent, own, masks, mask_codes, part | turn << part_bits, width)
        order = np.argsort(key, kind="stable")
        key, who = key[order], who[order]
        same = np.flatnonzero(key[1:] == key[:-1]) + 1
        if not len(same):
            continue
        begins = np.maximum.accumulate(np.where(np.concatenate(([True], key[1:] != key[:-1])), np.arange(len(key)), 0))
        a, b = who[begins[same]], who[same]
        near = (np.bitwise_count(prints[a] ^ prints[b]) <= radius) & (label[a] != label[b])  # verified, though a shared variant allows nothing else
        tree = np.flatnonzero(label != np.arange(len(label)))
        label = forest(len(prints), np.concatenate((tree, a[near])), np.concatenate((label[tree], b[near])))
    return label


@lean
def _block_links(block: pa.Table, prefix_bits: int, radius: int) -> pa.Table:
    prints = np.unique(block["__print"].to_numpy().view(np.uint64))
    prefix, bits = int(block["__block"][0].as_py()), BITS - prefix_bits
    away = (prints >> np.uint64(bits)) ^ np.uint64(prefix) if prefix_bits else np.zeros(len(prints), np.uint64)
    label = _linked(prints, np.bitwise_count(away).astype(np.int64), bits, radius, block["__part"][0].as_py(), block["__dealt"][0].as_py())
    linked = np.flatnonzero(label != np.arange(len(prints)))
    return pa.table({"u": prints[linked].view(np.int64), "v": prints[label[linked]].view(np.int64)})


def links(prints: DataFrame, n: int, radius: int = RADIUS) -> DataFrame:
    """Links (u, v) that connect what is within radius bits; prints: n distinct (__print).

    An odd radius is refused: variants within half of it, rounded up, also bring together what is one bit too far, and a star around such a value could hide a link.
    """
    if radius < 0 or radius % 2:
        raise ValueError(f"radius must be even and not negative, not {radius}")
    half = radius // 2
    prefix_bits = 0
    while prefix_bits < BITS - 1 and n * len(flips(prefix_bits, half)) > BLOCK_ROWS << prefix_bits:
        prefix_bits += 1
    lead = F.shiftrightunsigned("__print", BITS - prefix_bits) if prefix_bits else F.lit(0).cast("bigint")
    masks = F.array(*[F.lit(int(m)) for m in flips(prefix_bits, half)])
    sent = prints.select("__print", F.explode(F.transform(masks, lambda m: lead.bitwiseXOR(m))).alias("__block"))
    made = F.element_at(F.array(*[F.lit(len(flips(BITS - prefix_bits, half - k))) for k in range(half + 1)]), F.bit_count(lead.bitwiseXOR(F.col("__block"))) + 1)
    sizes = sent.groupBy(F.col("__block").alias("__hot")).agg(F.sum(made).alias("__made")).where(F.col("__made") > PART_VARIANTS)
    dealt = F.least(F.lit(12), F.ceil(F.log2(F.col("__made") / PART_VARIANTS))).cast("int")
    sizes = sizes.select("__hot", F.greatest(dealt, F.lit(1)).alias("__dealt"))
    # blocks above the limit are few and their number is checked by Spark, which broadcasts small tables only
    met = sent.join(sizes, F.col("__block") == F.col("__hot"), "left").select("__print", "__block", F.coalesce("__dealt", F.lit(0)).alias("__dealt"))
    parts = F.explode(F.expr("sequence(0, shiftleft(1, __dealt) - 1)")).alias("__part")
    sent = met.select("__print", "__block", "__dealt", parts)

    def block(rows: pa.Table) -> pa.Table:
        return _block_links(rows, prefix_bits, radius)

    return sent.groupBy("__block", "__part").applyInArrow(block, "u bigint, v bigint")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all that edges (u, v) touch, by rounds of large-star and small-star until nothing changes.

    Each round moves the edges twice; least neighbours are combined before each shuffle and hubs meet their one row in joins that Spark can split.
    """
    edges = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select("u", F.col("m").alias("v")).unionByName(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        before, edges = edges, materialize(small.where("u <> v").distinct(), "edges")
        discard(before)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_duplicates(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(id, fingerprint, component_id, __key, __first) of each row; component_id is the smallest id that links reach, itself included. __first: of a component of null ids only, the least key."""
    own = materialize(fingerprints(docs, id_col, text_col, shingle), "prints")
    per = materialize(own.groupBy("__print").agg(F.min("__id").alias("__least"), F.min(F.when(F.col("__id").isNull(), F.col("__key"))).alias("__null")), "prints")
    found = components(links(per.select("__print"), per.count(), radius))
    linked = per.join(found, per["__print"] == found["node"]).select("__print", "__least", "__null", "root")
    roots = linked.groupBy("root").agg(F.min("__least").alias("__all"), F.min("__null").alias("__all_null"))
    linked = linked.join(roots, "root").select(F.col("__print").alias("__p"), "__all", "__all_null")
    per = per.join(linked, F.col("__print") == F.col("__p"), "left").select(F.col("__print").alias("__p"), F.coalesce("__all", "__least").alias("component_id"), F.coalesce("__all_null", "__null").alias("__first"))
    per = per.withColumn("__first", F.when(F.col("component_id").isNull(), F.col("__first")))
    per = materialize(per, "components")  # so that the join stands on two plain exchanges, and Spark can split a hot fingerprint
    out = own.join(per, F.col("__print") == F.col("__p"))
    return out.select(F.col("__id").alias(id_col), F.lower(F.lpad(F.hex("__print"), 16, "0")).alias("fingerprint"), "component_id", "__key", "__first")


def deduplicate(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of docs of which none of the same component has a smaller id, with all their columns; a repeated row once. Of null ids only, the row with the least key."""
    found = near_duplicates(docs, id_col, text_col, shingle, radius)
    smallest = F.when(F.col("component_id").isNull(), F.col("__key") == F.col("__first")).otherwise(F.col(id_col) == F.col("component_id"))
    return rows_of(docs, found.select(F.col("__key").alias("key"), F.coalesce(smallest, F.lit(False)).alias("stay")), id_col, text_col)


def op2_simhash_ball(spark, sf_dir: str) -> DataFrame:
    """All documents: 4-word shingles, 4 bits."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text").drop("__key", "__first")
