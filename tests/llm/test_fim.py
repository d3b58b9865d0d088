"""Fill-in-the-middle against a plain version, and chunks against scans of whole texts."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest

from cellweave.llm import fim, queries
from tests.oracle import differences

SF = "/root/testdata/sf0.001"


def plain(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(text)
    p, q = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b, c = text[:p], text[p:q], text[q:]
    return (n, "spm", p, q - p, f"<S>{c}<P>{a}<M>{b}") if h4 % 100 < 20 else (n, "psm", p, q - p, f"<P>{a}<S>{c}<M>{b}")


TEXTS = [None, "", "a", "ä€😀z", "<P> in it", "two words", " \n\t", "x" * 5, "one\ntwo\n\nthree", "<", "P>S>M>", "日本語" * 400, "long äß " * 40_000]


@pytest.mark.parametrize("chunk", [1, 7, fim.CHUNK])
def test_every_text_is_cut_and_restored(spark, chunk):
    texts = TEXTS if chunk > 1 else TEXTS[:-2]
    rows = [(k, t, "n") for k, t in enumerate(texts * 6)] + [(None, "no id", None), (3, texts[3], "n")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n string")
    made = fim.fill_in_middle(docs, "doc_id", "text", chunk=chunk)
    got = made.withColumn("back", fim.restore(made["output"], made["form"])).collect()
    by_id = {}
    for k, t, _ in rows:
        by_id[k] = t or ""
    assert len(got) == len(rows)
    for r in got:
        assert (r["n"], r["form"], r["prefix_units"], r["middle_units"], r["output"]) == plain(r["doc_id"], by_id[r["doc_id"]])
        assert r["back"] == by_id[r["doc_id"]]
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("unit", ["char", "word", "line"])
@pytest.mark.parametrize("chunk", [1, 2, 3, 16, 1 << 16])
def test_chunks_count_and_locate_like_a_whole_scan(unit, chunk):
    texts = ["", "a b", " lead", "äö ü", "x\n\ny z\n", "", "end "]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts])))

    def begins(t):
        b = t.encode()
        test = {"char": lambda i: b[i] & 0xC0 != 0x80, "word": lambda i: b[i - 1 : i].isspace() and not b[i : i + 1].isspace(), "line": lambda i: b[i - 1] == 10}[unit]
        return [i for i in range(len(b)) if i == 0 or test(i)]

    most = max(len(begins(t)) for t in texts)
    n, places = fim.locate(data, offsets, lambda n: np.minimum(np.arange(most + 1)[None, :], n[:, None]), unit, chunk)
    for k, t in enumerate(texts):
        own = [*begins(t), len(t.encode())]
        assert n[k] == len(own) - 1
        assert [int(p - offsets[k]) for p in places[k][: len(own)]] == own


def test_other_units_and_sentinels(spark):
    docs = spark.createDataFrame([(k, "one two three\nfour five six\n" * (k + 1)) for k in range(40)], "doc_id bigint, text string")
    marks = ("[P]", "[S]", "[M]")
    for unit, n in (("word", 6), ("line", 2)):
        made = fim.fill_in_middle(docs, "doc_id", "text", unit, sentinels=marks)
        rows = made.withColumn("back", fim.restore(made["output"], made["form"], marks)).join(docs, "doc_id").collect()
        assert all(r["n"] == n * (r["doc_id"] + 1) and r["back"] == r["text"] for r in rows)
    for wrong in (("<P>", "<P>", "<M>"), ("", "<S>", "<M>"), ("aa", "<S>", "<M>")):
        with pytest.raises(ValueError):
            fim.fill_in_middle(docs, "doc_id", "text", sentinels=wrong)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, output string")
    assert fim.fill_in_middle(docs, "doc_id", "text").count() == 0


@pytest.mark.parametrize("name", ["op11_fill_in_middle", "op12_radix_repeats", "op13_delta_lloyd"])
def test_queries_match_their_sql(spark, name):
    got, want, more, less = differences(queries.QUERIES[name](spark, SF), queries.ORACLE_SQL[name], SF)
    assert (got, more, less) == (want, [], []) and want > 0
