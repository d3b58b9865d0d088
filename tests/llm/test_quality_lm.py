"""The Kneser-Ney model against its definition, both ways of scoring, and held-out accuracy."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cellweave.llm import quality_lm as q

TEXTS = ["the cat sat on the mat", "the dog sat on the log", "a cat and a dog", "日本 the mat\n\ttabs", "the the the", ""]
SCHEMA = "doc_id bigint, text string, lang string, n bigint, limit string, perplexity string"


def brute(texts):
    """P(c | context) by the textbook: raw counts at the highest order, continuation counts below, three discounts an order."""
    pad = (q.PAD,) * (q.ORDER - 1)
    seqs = [pad + tuple(q.symbols(t).tolist()) for t in texts]
    raw = Counter(s[i : i + q.ORDER] for s in seqs for i in range(len(s) - q.ORDER + 1))
    counts = {q.ORDER: raw}
    for k in range(q.ORDER - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    cuts, per, alphabet = {}, {}, len(counts[1]) + 1
    for k, c in counts.items():
        n = [sum(v == i for v in c.values()) for i in (1, 2, 3, 4)]
        d = [0.5, 1.0, 1.5]
        if all(n):
            y = n[0] / (n[0] + 2 * n[1])
            d = [min(max(i + 1 - (i + 2) * y * n[i + 1] / n[i], 0.05), i + 0.95) for i in range(3)]
        cuts[k] = d
        per[k] = defaultdict(list)
        for g, v in c.items():
            per[k][g[:-1]].append(v)

    def p(g):
        k = len(g)
        if not k:
            return 1 / alphabet
        seen = per[k].get(g[:-1])
        if not seen:
            return p(g[1:])
        total, back = sum(seen), sum(cuts[k][min(v, 3) - 1] for v in seen)
        a = counts[k].get(g, 0)
        return (a - (cuts[k][min(a, 3) - 1] if a else 0)) / total + back / total * p(g[1:])

    return p, pad


def perplexity(p, pad, text):
    s = pad + tuple(q.symbols(text).tolist())
    logs = [math.log(p(s[i : i + q.ORDER])) for i in range(len(s) - q.ORDER + 1)]
    return -sum(logs), len(logs)


@pytest.fixture(scope="module")
def model(spark):
    return q.train(spark.createDataFrame([(t,) for t in [*TEXTS, None]], "t string"), "t")


@pytest.mark.parametrize("packed", [1 << 12, 4])
def test_scoring_follows_the_definition(spark, model, monkeypatch, packed):
    """Blocks of a few texts, several copies of the model, characters packed and hashed."""
    p, pad = brute(TEXTS)
    new = [*TEXTS[:3], "a new cat", "ZZ 🙂 日", None, "the mat" * 50, "a new cat", "\0\U0010ffff the"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(new)], "id bigint, text string, extra string").repartition(3)
    monkeypatch.setattr(q, "BLOCK_BYTES", 30)
    monkeypatch.setattr(q, "MANY_BLOCKS", 2)
    monkeypatch.setattr(q, "PACKED", packed)
    got = {r["id"]: (r["nll"], r["n"], r["extra"]) for r in q.score_rows(docs, model, "text", "nll", "n").collect()}
    assert len(got) == len(new)
    for i, t in enumerate(new):
        nll, n = perplexity(p, pad, t or "")
        assert got[i][1:] == (n, "x") and abs(got[i][0] - nll) < 1e-4 * max(1, nll), t


def test_probabilities_sum_to_one():
    p, pad = brute(TEXTS)
    seen = {c for t in TEXTS for c in q.symbols(t).tolist()}
    for context in ("the ", "at\n", "qqqq"):
        g = tuple(q.symbols(context).tolist())
        assert abs(sum(p((*g, c)) for c in seen) + p((*g, ord("Q"))) - 1) < 1e-9


def test_characters_are_told_apart(spark):
    """日 and 旧 lie 2,046 code points and more apart in places where a folded alphabet made them one."""
    a, b = "日", chr(ord("日") + 2046)
    model = q.train(spark.createDataFrame([(a * 40,), ("the cat",)], "t string"), "t")
    docs = spark.createDataFrame([(0, a * 9), (1, b * 9)], "id int, text string")
    got = {r.id: r.nll for r in q.score_rows(docs, model, "text", "nll", "n").collect()}
    assert got[1] > 2 * got[0]


def test_codes_of_many_characters():
    """More characters than can be packed: hashes, verified; equal n-grams only have equal codes."""
    rng = np.random.default_rng(2)
    texts = ["".join(map(chr, rng.integers(0x4E00, 0x9FFF, 6000))), "一二" * 50, "", "abc"]
    codes = q.Codes(texts)
    assert not codes.exact and (np.diff(codes.keys.astype(object)) > 0).all()
    want = Counter()
    for t in texts:
        s = [q.PAD] * (q.ORDER - 1) + q.symbols(t).tolist()
        want.update(tuple(s[i : i + q.ORDER]) for i in range(len(t)))
    assert Counter({tuple(g): n for g, n in zip(codes.grams.tolist(), codes.counts.tolist())}) == want


def test_long_texts_are_cut_without_a_seam(monkeypatch):
    def read(texts):
        return [(tuple(flat[i : i + q.ORDER]), k) for flat, at, who in q.windows(texts) for i, k in zip(at.tolist(), who.tolist())]

    whole = read(["abcdefgh" * 9, "", "xyz"])
    monkeypatch.setattr(q, "AT_ONCE", 7)
    assert read(["abcdefgh" * 9, "", "xyz"]) == whole and len(whole) == 75


def test_blocks_dont_depend_on_batches(monkeypatch):
    monkeypatch.setattr(q, "BLOCK_BYTES", 100)
    texts = pa.table({"t": ["x" * (k * 7 % 60) for k in range(50)] + [None, "y" * 500]})
    cuts = [[len(b) for b in q.blocks_of(iter(texts.to_batches(max_chunksize=n)), 0)] for n in (1, 3, 52)]
    assert cuts[0] == cuts[1] == cuts[2] and len(cuts[0]) > 5 and sum(cuts[0]) == 52


def test_every_kind_of_row(spark):
    rows = [(1, None, "en", 1, "", ""), (2, "", None, 1, "", ""), (None, "the cat", "en", 1, "", ""), (3, "word " * 30_000, "fr", 1, "", ""), (3, "word " * 30_000, "fr", 1, "", "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    for labels in ([], [(3, 1), (None, 1), (1, None), (3, 1)]):
        args = spark.createDataFrame(labels, "doc_id bigint, quality int"), "doc_id", "text", "lang", "quality"
        got = q.score(docs, *args).collect()
        assert len(got) == 5 and {r.doc_id for r in got if r.rejected} == {1, 2}
        clash = docs
        for c in ("__id", "__lang", "__text", "__nll", "__n", "__mean", "__own", "__limit", "__labelled", "block", "rows", "lang"):
            clash = clash.withColumn(c, F.lit("mine")) if c != "lang" else clash
        kept = q.keep_good(clash, *args)
        assert kept.columns == clash.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 3, 3]
        assert {r["__lang"] + r["__nll"] + r["block"] for r in kept.collect()} == {"mineminemine"}
    assert q.score(docs.limit(0), spark.createDataFrame([], "doc_id bigint, quality int"), "doc_id", "text", "lang", "quality").collect() == []


def test_good_documents_stay_and_junk_goes(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = {r.doc_id: r.rejected for r in q.op6_kneser_ney(spark, sf).collect()}
    assert len(got) == 1000
    good, bad = [got[d] for d, y in labels.items() if y == 1], [got[d] for d, y in labels.items() if y == 0]
    assert sum(good) <= 0.01 * len(good) and sum(bad) >= 0.7 * len(bad)


def test_the_limit_is_the_quantile_and_no_more(spark):
    rows = [("en", 1.5 * 1000 + k, 1000) for k in range(400)]
    mean = sum(r[1] for r in rows) / sum(r[2] for r in rows)
    want = sorted((nll + q.SMOOTHING * mean) / (n + q.SMOOTHING) for _, nll, n in rows)[math.ceil(q.QUANTILE * len(rows)) - 1]
    for r in q.limits(spark.createDataFrame(rows, "__lang string, __nll double, __n bigint")).collect():
        assert r.held == 400 and want <= r.limit <= want + 1.01 * q.BIN


def test_junk_goes_where_languages_have_their_own_limits(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = {r.doc_id: r.rejected for r in q.op6_kneser_ney(spark, sf).collect()}
    good, bad = [got[d] for d, y in labels.items() if y == 1], [got[d] for d, y in labels.items() if y == 0]
    assert sum(good) <= 0.01 * len(good) and sum(bad) >= 0.94 * len(bad)
