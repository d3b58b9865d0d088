"""Compression bands against a plain version of the same rules."""

from __future__ import annotations

import random
import re
import subprocess
import sys
from pathlib import Path

import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from cellweave.llm import quality_rules as q

SCHEMA = "doc_id bigint, text string, kept string, __id string"


def plain(text: str) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines, seen, dup = text.split("\n"), set(), 0
    for x in lines:
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab #|\n\té\x0b　", max_size=80))
def test_base_metrics(text):
    assert q.base_metrics(text.encode()) == plain(text)


def test_bands():
    rng = random.Random(3)
    z = zstandard.ZstdCompressor(level=q.LEVEL)
    prose = " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(900)).encode()
    noise = bytes(rng.randrange(33, 127) for _ in range(9000))
    for text, good in ((prose, True), (b"again and again " * 600, False), (noise, False), (prose[:5000] + b"spam " * 9000, False)):
        assert q.verdict(text, *q.ratios(text, z)) == good


def test_every_kind_of_row(spark):
    long = "word and other words, " * 40_000
    rows = [(1, None), (2, ""), (3, "few words"), (4, long), (None, "x"), (3, "few words")]
    got = q.measure(spark.createDataFrame([(i, t, "", "") for i, t in rows], SCHEMA), "doc_id", "text").collect()
    assert len(got) == 6 and not any(r.kept for r in got)
    assert {r.n_words for r in got if r.doc_id in (1, 2)} == {0} and next(r for r in got if r.doc_id == 4).n_words == 160_000
    assert q.measure(spark.createDataFrame([], SCHEMA), "doc_id", "text").collect() == []


def test_clean_documents_stay(spark):
    got = {r.doc_id: r for r in q.op7_compression_bands(spark, "/root/testdata/sf0.001").collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert got.keys() == texts.keys()
    for k, t in texts.items():
        assert tuple(got[k])[1:6] == plain(t)
    good = {r.doc_id for r in spark.read.parquet("/root/testdata/sf0.001/labels.parquet").where("quality = 1").collect()}
    assert all(got[k].kept for k in good if not got[k].base_failed)


def test_bands_reject_documents_that_pass_the_base_rules(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = {0: [], 1: []}
    for r in q.op7_compression_bands(spark, sf).collect():
        if r.doc_id in labels and not r.base_failed:
            got[labels[r.doc_id]].append(r.kept)
    assert sum(not k for k in got[0]) >= 0.5 * len(got[0]) > 0 and sum(got[1]) >= 0.99 * len(got[1]) > 0


def test_a_band_depends_on_length_and_language():
    assert q.band(100) == (0.0, 9.0) and q.band(10**9) == q.band(q.KNOTS[-1]) and q.band(5000, "xx") == q.band(5000)
    assert q.band(1000, "de")[0] > q.band(3000, "de")[0] > q.band(20_000, "de")[0] and q.band(1000, "de") != q.band(1000, "es")


def test_hashes_that_collide_change_nothing(monkeypatch):
    rng = random.Random(8)
    texts = ["".join(rng.choice(["a ", "b ", "ab\t", "c\n", " \n", "d#  ", "é\n"]) for _ in range(rng.randint(0, 90))) for _ in range(200)]
    monkeypatch.setattr(q.xxhash, "xxh64_intdigest", lambda x, *_: len(x) % 2)
    assert all(q.base_metrics(t.encode()) == plain(t) for t in texts)


def test_texts_longer_than_a_block(monkeypatch):
    monkeypatch.setattr(q, "AT_ONCE", 7)
    rng = random.Random(9)
    for _ in range(200):
        t = "".join(rng.choice(["a ", "b ", "ab\t", "c\n", " \n", "d#  ", "é\n"]) for _ in range(rng.randint(0, 60)))
        assert q.base_metrics(t.encode()) == plain(t)


def test_a_long_text_takes_a_bounded_share_of_memory():
    """50 MB of short words and lines, in a process of its own: under 500 MB beside what an interpreter takes anyway."""
    code = """
import resource
from cellweave.llm import quality_rules as q
text = b" ".join(b"w%x" % (k * 2654435761 % 2**24) for k in range(2**14))
text = (text + b"\\n") * (50_000_000 // len(text))
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
n = q.base_metrics(text)
assert n[3] > 300 and n[4] == n[0] > 5_000_000, n
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    root = Path(q.__file__).resolve().parents[2]
    assert int(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=root).stdout) < 500


def _documents(spark, rng):
    """Labelled prose of one language at many lengths, and rows to judge, some with clashing names of columns."""
    rows = []
    for k in range(900):
        words = " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(60, 1500)))
        rows.append((k, words, "xx" if k % 2 else None, ""))
    rows += [(1000, "some words of no sense " * 900, "xx", ""), (None, rows[0][1], "xx", ""), (1001, None, None, "")]
    labels = [(k, 1) for k in range(600)] + [(5, 0), (None, 1), (1000, None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, __id string"), spark.createDataFrame(labels, "doc_id bigint, label int")


def test_bands_are_measured_and_columns_judge_like_the_plain_rule(spark, monkeypatch):
    monkeypatch.setattr(q, "LEAST", 30)
    docs, labels = _documents(spark, random.Random(4))
    rows = q.measured(docs, "doc_id", "text", "lang").cache()
    bands, chunk_band = q.measure_bands(rows, labels, "doc_id", "label")
    assert "xx" in bands and bands["xx"] != q.BANDS[q.ALL] and chunk_band != q.CHUNK_BAND
    texts = {(r.doc_id, r.lang): (r.text or "").encode() for r in docs.collect()}
    judged = q.judge(rows, bands, chunk_band).collect()
    assert len(judged) == len(texts)
    for r in judged:
        text = texts[r["__id"], r["__lang"]]
        assert r.kept == (not r.base_failed and q.verdict(text, r.ratio, r.chunks, r["__lang"], bands, chunk_band))
    trusted = {k for k in range(600) if k != 5}
    assert all(r.kept for r in judged if r["__id"] in trusted and not r.base_failed)
    assert not next(r for r in judged if r["__id"] == 1000).kept
    rows.unpersist()


def test_too_few_labels_leave_the_constants(spark):
    docs, labels = _documents(spark, random.Random(4))
    rows = q.measured(docs.limit(40), "doc_id", "text", "lang")
    for few in (labels, labels.where("label = 7")):
        bands, chunk_band = q.measure_bands(rows, few, "doc_id", "label")
        assert bands == q.BANDS and (few is labels or chunk_band == q.CHUNK_BAND)
    got = q.measure(docs.limit(40), "doc_id", "text", "lang", labels, "label").collect()
    assert len(got) == 40 and [f for f in got[0].asDict()] == [f for f in q.measure(docs, "doc_id", "text").columns]
