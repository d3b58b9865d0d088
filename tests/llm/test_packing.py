"""Packing: exact round trips, places without gaps, and counts of sequences against plain best-fit."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cellweave.llm import packing, tokens

SCHEMA = "doc_id bigint, text string, length string, __id string"
ROWS = [(1, None), (2, ""), (3, "short"), (None, "no id"), (5, "a word, " * 6000), (6, "x " * 2047), (3, "short"), (7, "two  spaces \n and \t \n tabs<|endoftext|>"), (8, "ünï ço 日本 語　ｘ 🙂 " * 3)]


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(tokens.default_path())
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 0]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet="ab.'s \n\t\r  é1", max_size=40), max_size=4))
def test_parts_give_the_ids_of_the_whole(texts):
    t = tokens.encoder(tokens.default_path())
    for text, ids in zip(texts, t.batch(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == [*t.tokenizer.encode(text, add_special_tokens=False).ids, 0]


def test_kept_parts_may_go(monkeypatch, plain):
    monkeypatch.setattr(tokens, "KEPT_PARTS", 3)
    e = tokens.Encoder(tokens.default_path())
    for texts in (["a b c d e f", "g h i"], ["a b z", "q c d e"], ["a b"]):
        assert [np.frombuffer(x, "<u4").tolist() for x in e.batch(texts)] == [plain(t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.integers(1, 20), st.integers(1, 5), max_size=12))
def test_bins_hold_all_and_fit(counts):
    fixed, left = packing.reduce_instance(counts, 20)
    groups = fixed + packing.best_fit_decreasing(left, 20)
    got = Counter()
    for b in groups:
        assert b.count > 0 and sum(k * n for k, n in b.content) + b.free == 20 and b.free >= 0
        for k, n in b.content:
            got[k] += n * b.count
    assert got == Counter(counts)
    bins: list[int] = []
    for k in sorted(Counter(counts).elements(), reverse=True):  # plain best-fit decreasing, one by one
        at = min((i for i, f in enumerate(bins) if f >= k), key=lambda i: bins[i], default=None)
        if at is None:
            bins.append(20 - k)
        else:
            bins[at] -= k
    assert sum(b.count for b in packing.best_fit_decreasing(counts, 20)) == len(bins)
    assert sum(b.count for b in groups) >= -(-sum(k * n for k, n in counts.items()) // 20)


def _least_bins(items: tuple[int, ...], capacity: int) -> int:
    best = len(items)

    def go(i: int, bins: list[int]) -> None:
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(items):
            best = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + items[i] <= capacity:
                bins[k] += items[i]
                go(i + 1, bins)
                bins[k] -= items[i]
        bins.append(items[i])
        go(i + 1, bins)
        bins.pop()

    go(0, [])
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=8))
def test_fixed_sets_cost_no_bin(items):
    fixed, left = packing.reduce_instance(Counter(items), 12)
    rest = sorted(Counter(left).elements(), reverse=True)
    assert sum(b.count for b in fixed) + _least_bins(tuple(rest), 12) == _least_bins(tuple(sorted(items, reverse=True)), 12)


def check_pack(rows, got, plain, capacity=2048):
    want = Counter()
    for i, t in rows:
        ids = plain(t)
        k = -(-len(ids) // capacity)
        head = len(ids) - capacity * (k - 1)
        at = [(0, head), *((head + capacity * j, capacity) for j in range(k - 1))]
        for p, (s, n) in enumerate(at):
            want[i, p, s, n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    at = defaultdict(list)
    for r in got:
        at[r.sequence_id].append((r.offset, r.length))
    for spans in at.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= capacity
    return len(at)


def test_best_fit_pack(spark, plain):
    df = spark.createDataFrame([(i, t, "", "") for i, t in ROWS], SCHEMA)
    check_pack(ROWS, packing.best_fit_pack(df, "doc_id", "text").collect(), plain)
    assert packing.best_fit_pack(spark.createDataFrame([], SCHEMA), "doc_id", "text").collect() == []


def test_best_fit_pack_of_a_table(spark, plain, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET_ROWS", 5)
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    n = check_pack(rows, packing.op10_best_fit(spark, "/root/testdata/sf0.001").collect(), plain)
    assert n <= -(-sum(len(plain(t)) for _, t in rows) // 2048) + 2


def test_packed_output_round_trip(spark, plain, monkeypatch):
    df = spark.createDataFrame([(i, t, "", "") for i, t in ROWS], SCHEMA).coalesce(1)
    back = defaultdict(list)
    got = packing.packed_output(df, "doc_id", "text").collect()
    for r in got:
        ids, at = np.frombuffer(r.input_ids, "<u2"), np.frombuffer(r.position_ids, "<u2")
        assert len(ids) == len(at) == 2048 and r.cu_seqlens[-1] == r.n_tokens <= 2048 and not ids[r.n_tokens :].any() and not at[r.n_tokens :].any()
        for d, p, s, a, b in zip(r.doc_ids, r.pieces, r.starts, r.cu_seqlens, r.cu_seqlens[1:], strict=False):
            assert at[a:b].tolist() == list(range(b - a))
            back[d].append((p, s, ids[a:b].tolist()))
    for i, t in {(i, t) for i, t in ROWS}:
        copies = sum(r == (i, t) for r in ROWS)
        joined = [x for p, s, x in sorted(back[i])]
        assert [x for part in joined[::copies] for x in part] == plain(t)
    assert len({r.sequence_id for r in got}) == len(got)
    assert packing.packed_output(spark.createDataFrame([], SCHEMA), "doc_id", "text").collect() == []
