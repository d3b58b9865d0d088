"""Chunk recipes: lossless cuts, verified identifiers, and groups as by the whole text."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cellweave.llm import exact_dedup as e
from tests.oracle import differences

SCHEMA = "doc_id bigint, text string, recipe string, keep_id string"
LONG = "A sentence of some words. Another one, longer; no end\n" * 4000
ROWS = [(1, None), (2, ""), (3, "a"), (4, "a"), (5, LONG), (6, LONG), (7, LONG[:-1]), (8, "x" * 10_000), (9, "x" * 10_001), (None, "a"), (10, "日本🙂" * 3000), (4, "a"), (None, "null id"), (11, "A"), (12, "a ")]


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(i, t, "", "") for i, t in rows], SCHEMA)


def expected():
    groups = {}
    for i, t in ROWS:
        groups.setdefault(t or "", []).append(i)
    return sorted((i or 0, t or "", max((x for x in groups[t or ""] if x), default=0), len(groups[t or ""])) for i, t in ROWS)


def test_chunks_join_to_the_text(spark):
    for text, parts, joined in frame(spark).select("text", e.chunks(F.coalesce("text", F.lit(""))).alias("c")).select("text", F.transform("c", F.length), F.concat_ws("", "c")).collect():
        assert joined == (text or "") and all(n <= e.MAX_CHUNK + 1 for n in parts)


def test_an_insertion_changes_few_chunks(spark):
    prose = "".join(f"Sentence {k} says {k * k} in words. " for k in range(8000))
    a, b = spark.createDataFrame([(prose,), ("Some words before. " + prose,)], "t string").select(e.chunks(F.col("t")).alias("c")).collect()
    assert len(set(b.c) - set(a.c)) <= 0.1 * len(set(b.c))


def test_groups(spark):
    got = e.mark_duplicates(frame(spark), "doc_id", "text").collect()
    import hashlib

    sha = {hashlib.sha256(t.encode()).hexdigest(): t for _, t in ((i, t or "") for i, t in ROWS)}
    assert sorted((r.doc_id or 0, sha[r.text_sha256], r.keep_id or 0, r.group_size) for r in got) == expected()
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)
    left = e.deduplicate(frame(spark), "doc_id", "text").collect()
    assert sorted(t or "" for _, t, *_ in left) == sorted({t or "" for _, t in ROWS})
    assert e.mark_duplicates(frame(spark, []), "doc_id", "text").collect() == []


def test_identifiers_that_collide_are_made_anew(spark):
    def weak(chunk, salt):
        return e.pair_hash(chunk, salt) if salt else F.array(F.length(chunk).cast("bigint"), F.lit(0).cast("bigint"))

    got = e.mark_duplicates(frame(spark), "doc_id", "text", weak).collect()
    assert sorted((r.doc_id or 0, r.group_size) for r in got) == sorted((i, n) for i, _, _, n in expected())
    with pytest.raises(RuntimeError):
        e.mark_duplicates(frame(spark), "doc_id", "text", lambda c, s: F.array(F.lit(1).cast("bigint"), F.lit(1).cast("bigint")))


def test_the_query_matches_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    got, want, more, less = differences(e.op9_chunk_recipes(spark, sf), e.ORACLE, sf)
    assert (got, more, less) == (want, [], [])


def test_columns_of_any_name_are_kept(spark):
    names = ["__row", "__stay", "__doubt", "__bucket", "__bits", "__spot", "__ROW_", "key", "stay", "id", "recipe", "kept", "a.b"]
    df = spark.createDataFrame([(1, "x y"), (2, "x y"), (2, "x y"), (3, None), (4, "z")], "doc_id bigint, text string")
    for c in names:
        df = df.withColumn(c, F.lit("mine"))
    got = e.deduplicate(df, "doc_id", "text")
    assert got.columns == df.columns and sorted(r.doc_id for r in got.collect()) == [2, 3, 4]
    assert {tuple(r)[2:] for r in got.collect()} == {("mine",) * len(names)}
