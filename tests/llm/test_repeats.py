"""Repeated windows against a table of all windows."""

from __future__ import annotations

import random

import pytest

from cellweave.llm import repeats

L = repeats.LENGTH


def plain(rows, length=L):
    big = 1 << 62
    first: dict[bytes, int] = {}
    for i, t in rows:
        b, key = (t or "").encode(), big if i is None else i
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            first[w] = min(first.get(w, key), key)
    out = []
    for i, t in rows:
        b, key = (t or "").encode(), big if i is None else i
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < key:
                gone[p : p + length] = b"\1" * length
        edges = [k for k in range(len(b) + 1) if (k < len(b) and gone[k]) != (k > 0 and bool(gone[k - 1]))]
        out.append((i, len(b), tuple(zip(edges[::2], edges[1::2], strict=True)), bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return sorted(out, key=str)


def found(spark, rows, schema="doc_id bigint, text string, block string", **more):
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], schema).repartition(3)
    got = repeats.remove_repeats(docs, "doc_id", "text", **more).collect()
    return sorted(((r["doc_id"], r["n_bytes"], tuple((s["start"], s["end"]) for s in r["spans"]), bytes(r["kept"])) for r in got), key=str)


def texts(seed: int, n: int) -> list[tuple[int, str]]:
    rng = random.Random(seed)
    words = ["ab", "äö", "lorem", "ipsum", "日本", "x", "dolor", "sit"] + [f"w{k}" for k in range(300)]
    passage = " ".join(rng.choice(words) for _ in range(40))
    rows = []
    for i in range(n):
        t = " ".join(rng.choice(words) for _ in range(rng.randrange(1, 120)))
        if i % 3 == 0:
            at = rng.randrange(len(t) + 1)
            t = t[:at] + passage[rng.randrange(9) :] + t[at:]
        if i % 7 == 1 and rows:
            t = rng.choice(rows)[1]
        if i % 5 == 2 and rows:  # a near copy
            t = rows[rng.randrange(len(rows))][1]
            at = rng.randrange(len(t) + 1)
            t = t[:at] + "!" + t[at:]
        rows.append((i, t))
    return rows


@pytest.mark.parametrize("block_bytes", [1, 2_000, 1 << 20])
def test_removes_what_a_table_of_windows_removes(spark, block_bytes):
    rows = texts(1, 60)
    assert found(spark, rows, block_bytes=block_bytes, shard_keys=500) == plain(rows)


def test_periods_ties_and_edges(spark):
    rows = [(1, "a" * 200), (2, "b" + "a" * 49), (3, "b" + "a" * 50), (4, "ab" * 100), (5, "ba" * 60), (6, "z" * 49), (7, "z" * 50), (8, "z" * 50), (9, "zz"), (10, ""), (11, None)]
    assert found(spark, rows) == plain(rows)


def test_null_and_repeated_ids(spark):
    one = "the same passage of more than fifty bytes, that several rows hold: " * 2
    rows = [(None, one), (None, "x" + one), (5, one), (5, "y" + one), (4, None), (9, one[:80])]
    assert found(spark, rows) == plain(rows)
    assert found(spark, [(None, one), (None, one)]) == plain([(None, one), (None, one)])


def test_a_long_text_goes_through_slabs(spark, monkeypatch):
    rng = random.Random(3)
    long = "".join(rng.choice("abcdefghij ") for _ in range(600_000))
    rows = [(1, long[300_000:300_500]), (2, long), (3, long[:262_300]), (4, "q" * 300_000)]
    got = {r[0]: r for r in found(spark, rows)}
    assert got[1][2] == () and got[2][2] == ((300_000, 300_500),)
    assert got[3][2] == ((0, 262_300),) and got[4][2] == ()


def test_other_lengths_and_wrong_input(spark):
    rows = texts(2, 30)
    assert found(spark, rows, length=24) == plain(rows, 24)
    assert found(spark, rows, length=61) == plain(rows, 61)
    with pytest.raises(ValueError):
        repeats.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), "doc_id", "text", length=10)
    with pytest.raises(ValueError):
        repeats.remove_repeats(spark.createDataFrame([("a", "b")], "doc_id string, text string"), "doc_id", "text")


def test_empty_table(spark):
    assert found(spark, []) == []
