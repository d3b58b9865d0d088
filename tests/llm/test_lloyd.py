"""Codebooks and codes against plain Lloyd rounds over all vectors."""

from __future__ import annotations

import random

import numpy as np

from cellweave.llm import lloyd
from cellweave.llm.common import materialize


def plain(rows, parts=16, entries=64, rounds=2):
    kept = [(i, v, label) for i, v, label in rows if v and len(v) % parts == 0 and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0], [int(np.floor(256 * x)) for x in r[1]]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    x = np.array([[int(np.floor(256 * float(c))) for c in v] for _, v, _ in kept], dtype=object).reshape(len(kept), parts, -1)
    books = [[list(x[e, p]) for e in range(min(entries, len(x)))] for p in range(parts)]

    def assigned():
        codes, error = [], []
        for row in x:
            far = [[sum((a - b) ** 2 for a, b in zip(row[p], c, strict=True)) for c in books[p]] for p in range(parts)]
            codes.append([min(range(len(f)), key=lambda e, f=f: (f[e], e)) for f in far])
            error.append(sum(min(f) for f in far))
        return codes, error

    for _ in range(rounds):
        codes, _ = assigned()
        for p in range(parts):
            for e in range(len(books[p])):
                own = [x[k, p] for k in range(len(x)) if codes[k][p] == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    codes, error = assigned()
    by_label: dict = {}
    for (_, _, label), far in zip(kept, error, strict=True):
        by_label[label] = by_label.get(label, 0) + far
    return books, sorted(((i, tuple(c), e, by_label[label]) for (i, _, label), c, e in zip(kept, codes, error, strict=True)), key=str)


def found(spark, rows, entries=64, kind="float", **more):
    vectors = spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>, label int").repartition(3)
    books, out = lloyd.quantise(vectors, "vec_id", "embedding", "label", entries=entries, **more)
    return books.tolist(), sorted(((r["vec_id"], tuple(r["code"]), r["error"], r["label_error"]) for r in out.collect()), key=str)


def vectors(seed, n, width=32):
    rng = random.Random(seed)
    return [(k, [float(np.float32(rng.gauss(k % 5 / 10, 0.2))) for _ in range(width)], rng.choice([None, 1, 2])) for k in range(n)]


def test_codes_like_plain_rounds(spark):
    rows = vectors(1, 150)
    assert found(spark, rows, entries=8) == plain(rows, entries=8)


def test_nulls_widths_ties_and_few_vectors(spark):
    rows = vectors(2, 20)
    odd = [(30, None, 1), (31, [None] * 32, 1), (32, [float("nan")] * 32, 1), (33, [float("inf")] + [0.0] * 31, 1), (34, [], 1), (35, [0.1] * 31, 1), (36, [0.1] * 16, 1), (None, rows[0][1], None), (3, rows[3][1], 2)]
    got = found(spark, [*rows, *odd])
    assert got == plain([*rows, *odd])
    assert len(got[1]) == 22
    same = [(k, [0.5] * 16, None) for k in range(9)]
    assert found(spark, same, entries=4) == plain(same, entries=4)
    one = [(7, [-0.001] * 16, 3)]
    assert found(spark, one) == plain(one)


def test_large_components(spark):
    rows = [(k, [float(k) * 3e4] * 16, 1) for k in range(5)] + [(9, [1e300] * 16, 1)]
    assert found(spark, rows, entries=2, kind="double") == plain(rows[:5], entries=2)


def test_empty_table(spark):
    assert found(spark, [])[1] == [] and found(spark, [(1, None, 2)])[1] == []


def test_a_round_moves_only_what_changed(spark):
    own = lloyd.integers(spark.createDataFrame(vectors(3, 120), "id bigint, v array<float>, label int"), "id", "v", "label")
    books, state = lloyd.train(own, entries=8, rounds=2)
    again = materialize(lloyd.assign(state, books), "again")
    assert lloyd.contributions(again, 2).count() == 0  # assigned to the same codebooks: nothing is sent
    first = materialize(lloyd.assign(own.selectExpr("*", "CAST(NULL AS array<int>) AS code"), books), "first")
    sent = lloyd.contributions(first, 2).collect()
    assert sum(r["n"] for r in sent) == 120 * 16
