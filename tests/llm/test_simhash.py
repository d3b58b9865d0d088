"""SimHash near-dedup against brute force over all pairs."""

from __future__ import annotations

import re
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F
import xxhash

from cellweave.llm import simhash

SCHEMA = "doc_id bigint, text string, __print string, component_id string"


def brute_print(text: str | None) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    prints = [(i, brute_print(t)) for i, t, *_ in rows]
    group = {i: i for i, _ in prints}
    for a, pa in prints:
        for b, pb in prints:
            if (pa ^ pb).bit_count() <= 4 and group[a] != group[b]:
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = {k: new if g == old else g for k, g in group.items()}
    return {(i, f"{p:016x}", group[i]) for i, p in prints}


def check(spark, rows):
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)
    assert {tuple(r)[:3] for r in simhash.near_duplicates(df, "doc_id", "text").collect()} == brute(rows)


def test_texts_of_the_small_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    check(spark, rows)


def test_null_empty_short_and_odd_texts(spark):
    check(spark, [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two three"), (7, "İx Äb c d e f g"), (8, "a b c d a b c d a b c d"), (9, "word " * 3000)])


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA), "doc_id", "text").collect() == []


def test_repeated_rows_and_null_ids(spark):
    df = spark.createDataFrame([(None, "a b c d e", "", ""), (3, "a b c d e", "", ""), (3, "a b c d e", "", ""), (None, "zz yy xx ww vv uu", "", "")], SCHEMA)
    got = sorted((r.doc_id or 0, r.component_id or 0) for r in simhash.near_duplicates(df, "doc_id", "text").collect())
    assert got == [(0, 0), (0, 3), (3, 3), (3, 3)]
    assert simhash.deduplicate(df, "doc_id", "text").count() == 2


def test_links_find_every_pair_and_only_those(spark, monkeypatch):
    """Random fingerprints with dense clusters and chains, over several blocks and in several turns of the sort."""
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**64, 60, dtype=np.uint64)
    prints = [int(b) for b in base]
    for b in base[:20]:
        for k in range(12):
            flip = rng.choice(64, size=int(rng.integers(1, 7)), replace=False)
            prints.append(int(b) ^ sum(1 << int(f) for f in flip))
    prints = np.unique(np.array(prints, np.uint64))
    pairs = [(i, j) for i in range(len(prints)) for j in range(i) if (int(prints[i]) ^ int(prints[j])).bit_count() <= 4]
    want = simhash.forest(len(prints), *(np.array(x, np.int64) for x in zip(*pairs, strict=True)))
    monkeypatch.setattr(simhash, "BLOCK_ROWS", 8)
    df = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "__print bigint")
    found = simhash.components(simhash.links(df, len(prints))).collect()
    group = {int(p): int(p) for p in prints.view(np.int64)} | {r.node: r.root for r in found}
    sets = {}
    for p, w in zip(prints.view(np.int64).tolist(), want.tolist(), strict=True):
        sets.setdefault(w, set()).add(group[p])
    assert all(len(s) == 1 for s in sets.values()) and len(set().union(*sets.values())) == len(sets)


def whole(prints: np.ndarray, radius: int) -> np.ndarray:
    """Components by all pairs."""
    pairs = [(i, j) for i in range(len(prints)) for j in range(i) if (int(prints[i]) ^ int(prints[j])).bit_count() <= radius]
    return simhash.forest(len(prints), *(np.array([p[k] for p in pairs], np.int64) for k in (0, 1)))


@pytest.mark.parametrize("radius", [0, 2, 4])
def test_turns_of_the_sort_agree(monkeypatch, radius):
    rng = np.random.default_rng(1)
    close = rng.integers(0, 2**64, 260, dtype=np.uint64) & np.uint64(0xFFF)
    prints = np.unique(np.concatenate((close, rng.integers(0, 2**64, 40, dtype=np.uint64))))
    spent, want = np.zeros(len(prints), np.int64), whole(prints, radius)
    assert (simhash._linked(prints, spent, 64, radius) == want).all()
    monkeypatch.setattr(simhash, "SORTED_AT_ONCE", 20_000)
    assert (simhash._linked(prints, spent, 64, radius) == want).all()


def test_parts_of_a_block_make_each_variant_once():
    prints = np.unique(np.random.default_rng(2).integers(0, 2**64, 50, dtype=np.uint64))
    masks, spent = simhash.flips(64, 2), np.zeros(50, np.int64)
    want = sorted((int(p ^ m), k) for k, p in enumerate(prints) for m in masks)
    told = simhash.codes(masks, 5)
    order = np.argsort(told, kind="stable")
    got = []
    for code in range(32):
        key, who = simhash._turn_variants(prints, spent, simhash.codes(prints, 5), [masks[order]], [told[order]], code, 5)
        assert (simhash.codes(key, 5) == code).all() and len(key) < len(want) / 8
        got += zip(key.tolist(), who.tolist(), strict=True)
    assert sorted(got) == want


def test_a_hot_block_is_dealt_to_several_tasks(spark, monkeypatch):
    """500 prints near one value and 60 elsewhere: the same components, from several groups of the hot block."""
    rng = np.random.default_rng(3)
    centre = 0x0123456789ABCDEF
    near = [centre ^ sum(1 << int(f) for f in rng.choice(64, size=4, replace=False)) for _ in range(500)]
    prints = np.unique(np.array(near + [int(x) for x in rng.integers(0, 2**64, 60, dtype=np.uint64)], np.uint64))
    want = whole(prints, 4)
    monkeypatch.setattr(simhash, "PART_VARIANTS", 60_000)
    monkeypatch.setattr(simhash, "BLOCK_ROWS", 200)
    df = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "__print bigint")
    found = simhash.links(df, len(prints))
    tree = found.collect()
    at = {p: k for k, p in enumerate(prints.view(np.int64).tolist())}
    got = simhash.forest(len(prints), *(np.array([at[r[k]] for r in tree], np.int64) for k in (0, 1)))
    assert (got == want).all() and len(set(want.tolist())) > 2
    assert len(tree) > len(prints) - len(set(want.tolist()))  # parts give a tree each


def test_memory_of_many_prints_near_one_value():
    """100,000 prints within 4 bits of one value, one part of the eight that the block is dealt to: under 1 GB."""
    code = """
import resource
import numpy as np
from cellweave.llm import simhash
rng = np.random.default_rng(1)
flip = np.uint64(1) << rng.integers(0, 64, (102_000, 4)).astype(np.uint64)
prints = np.unique(np.bitwise_xor.reduce(flip, axis=1))[:100_000]
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
label = simhash._linked(prints, np.zeros(len(prints), np.int64), 64, 4, 5, 3)
assert (label != np.arange(len(label))).mean() > 0.9
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    root = Path(simhash.__file__).resolve().parents[2]
    assert int(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=root).stdout) < 1000


def test_odd_radii_are_refused(spark):
    prints = spark.createDataFrame([(0,), (7,)], "__print bigint")
    with pytest.raises(ValueError):
        simhash.links(prints, 2, 3)


def test_one_row_of_near_copies_without_ids_stays(spark):
    pairs = ((" ".join(words), " ".join([*words[:-1], "other"])) for words in ([f"word{i}" for i in range(n)] for n in range(100, 400)))
    near = next(p for p in pairs if 1 <= (brute_print(p[0]) ^ brute_print(p[1])).bit_count() <= 4)
    rows = [(None, near[0]), (None, near[1]), (None, near[0].upper()), (None, "zz yy xx ww vv uu"), (5, "a b c d e"), (None, "a b c d e")]
    df = spark.createDataFrame([(i, t, "", "") for i, t in rows], SCHEMA)
    got = [(r.doc_id, r.text) for r in simhash.deduplicate(df, "doc_id", "text").collect()]
    assert len(got) == 3 and (5, "a b c d e") in got and (None, "zz yy xx ww vv uu") in got


def test_columns_of_any_name_are_kept(spark):
    names = ["__row", "__stay", "__key", "__print", "__id", "__first", "component_id", "key"]
    df = spark.createDataFrame([(1, "a b c d e"), (2, "a b c d e"), (2, "a b c d e"), (3, "quite other words stand here")], "doc_id bigint, text string")
    for c in names:
        df = df.withColumn(c, F.lit("mine"))
    got = simhash.deduplicate(df, "doc_id", "text")
    assert got.columns == df.columns and sorted(r.doc_id for r in got.collect()) == [1, 3]
    assert {tuple(r)[2:] for r in got.collect()} == {("mine",) * len(names)}
