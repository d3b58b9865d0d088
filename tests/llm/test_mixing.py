"""Mixing: targets by iteration, nearness of what is taken, nested budgets, reruns."""

from __future__ import annotations

import math
from collections import defaultdict

from cellweave.llm import mixing as m
from tests.oracle import differences

SCHEMA = "doc_id bigint, text string, source string, size string, hash string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, "", "") for i, t, s in rows], SCHEMA)


def targets(sizes):
    """By the rule: share by weight, hold at three times, share the excess among the others until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: m.WEIGHTS[k % 3] for k, s in enumerate(names)}
    left, open_, out = sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if weight[s] * level > 3 * sizes[s]]
        if not over:
            return out | {s: weight[s] * level for s in open_}
        for s in over:
            out[s] = 3 * sizes[s]
            left -= out[s]
            open_.remove(s)
    return out


def check(rows, got):
    sizes, taken, size = defaultdict(int), defaultdict(int), {}
    source = {i: s for i, _, s in rows}
    for i, t, s in rows:
        size[i] = len((t or "").split())
        sizes[s] += size[i]
    want = targets(sizes)
    for r in got:
        s = source[r.doc_id]
        assert r.size == size[r.doc_id] and r.source_size == sizes[s] and math.isclose(r.target, want[s], rel_tol=1e-9, abs_tol=1e-5)
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(size[i] for i in source if source[i] == s) / 2 + 1e-6


ROWS = [(k, "w " * (k % 13), f"s{k % 7}") for k in range(400)] + [(1000 + k, "two words", None) for k in range(5)] + [(2000, "only one", "tiny"), (2001, None, "empty"), (2002, "w " * 5000, "big"), (2003, "w", "big")]


def test_targets_and_what_is_taken(spark):
    got = m.mix(frame(spark, ROWS), "doc_id", "text", "source").collect()
    assert len(got) == len(ROWS)
    check(ROWS, got)
    again = m.mix(frame(spark, ROWS[::-1]).repartition(5), "doc_id", "text", "source").collect()
    assert {r.doc_id: r.taken for r in got} == {r.doc_id: r.taken for r in again}


def test_apply_repeats_rows(spark):
    df = frame(spark, ROWS)
    times = {r.doc_id: r.times for r in m.mix(df, "doc_id", "text", "source").collect()}
    seen = defaultdict(int)
    for r in m.apply_mix(df, "doc_id", "text", "source").collect():
        seen[r.doc_id] += 1
    assert {k: n for k, n in times.items() if n} == dict(seen)


def test_larger_budgets_take_all_that_smaller_ones_take(spark):
    sized = spark.createDataFrame([("a", k % 9 + 1) for k in range(300)], "source string, size bigint").withColumn("hash", m.hash60(m.F.monotonically_increasing_id()))
    cut = [m.thresholds(sized, spark.createDataFrame([("a", rest)], "source string, rest double")).first().threshold for rest in (1.0, 100.0, 700.0, 1400.0)]
    assert cut == sorted(cut)


def test_odd_rows(spark):
    rows = [(None, "a b", "x"), (None, "a b", "x"), (3, "c d e", "x"), (3, "c d e", "x"), (4, None, None)]
    got = m.mix(frame(spark, rows), "doc_id", "text", "source").collect()
    assert len(got) == 5 and len({r.taken for r in got if r.doc_id == 3}) == 1
    assert m.mix(frame(spark, []), "doc_id", "text", "source").collect() == []
    assert [r.taken for r in m.mix(frame(spark, [(1, None, "x"), (2, "", "y")]), "doc_id", "text", "source").collect()] == [0, 0]


def test_the_query_matches_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    got, want, more, less = differences(m.op4_source_mix(spark, sf), m.ORACLE, sf)
    assert (got, more, less) == (want, [], [])
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source").collect()]
    check(rows, m.op4_source_mix(spark, sf).collect())


def test_columns_of_any_name_are_kept(spark):
    df = frame(spark, ROWS[:40])
    for c in ("__id", "__times", "__source", "__copy", "__threshold", "p_source", "times", "threshold"):
        df = df.withColumn(c, m.F.lit("mine"))
    for most in (m.SENT_SOURCES, 0):  # both ways of reaching a source's plan
        m.SENT_SOURCES, before = most, m.SENT_SOURCES
        got = m.apply_mix(df, "doc_id", "text", "source")
        m.SENT_SOURCES = before
        assert got.columns == df.columns and {tuple(r)[5:] for r in got.collect()} == {("mine",) * 8}
        assert sum(r.times for r in m.mix(df, "doc_id", "text", "source").collect()) == got.count()
