"""The grammar against plain scanning of clauses, and held-out accuracy."""

from __future__ import annotations

import random

import numpy as np

from cellweave.llm import toxicity as t

SCHEMA = "doc_id bigint, text string, score string, __id string"
SYMBOLS = t.SYMBOLS


def plain(symbols: str) -> list[str]:
    """The event of each symbol, one rule after another over whole clauses, without any machine."""
    out, quoted = [], False
    clauses = symbols.replace(".", ". ").split(" ")
    for clause in clauses:
        said = list(clause)
        for k, s in enumerate(clause):  # insult: an abusive word, or a weak one within two words after another
            if s == "a" or (s == "w" and "w" in clause[max(0, k - 2) : k]):
                said[k] = "i"
        intent = -9
        for k, s in enumerate(clause):  # threat: a verb of harm within three words after an intention that no other verb took up
            if s == "v":
                said[k], intent = ("T" if k - intent <= 3 else "v"), -9
            elif s == "k":
                said[k], intent = "o", k
        no = -9
        for k, s in enumerate(said):
            if s in "iTvw":
                said[k], no = ("x" if k - no <= 3 else s), -9
            elif s == "n":
                said[k], no = "o", k
        told = False
        for k, s in enumerate(said):
            if s in "iTvw" and (told or quoted):
                said[k] = "p"
            elif s == "r":
                said[k], told = "o", True
            elif s == "q":
                quoted, told, said[k] = (told and not quoted), False, "o"
        target, waits = False, ""
        for k, s in enumerate(said):
            if s == "t":
                said[k] = {"": "o", "i": "d", "T": "D"}[waits]
                target, waits = True, ""
            elif target and s in "iTv":
                said[k] = {"i": "I", "T": "H", "v": "g"}[s]
            elif s in "iT":
                waits = "T" if "T" in (s, waits) else "i"
        out += said
    return out


def test_the_composed_machine():
    m, rng = t.grammar(), random.Random(7)
    for _ in range(6000):
        symbols = "".join(rng.choice(SYMBOLS) for _ in range(rng.randint(1, 14)))
        state, got = m.start, []
        for s in symbols:
            state, out, w = m.step(state, s)
            assert w == t.WORTH.get(out, 0.0)
            got.append(out)
        assert got == plain(symbols), symbols


def plain_score(text, lexicon, weights):
    """A document's score by the plain rules."""
    read = [t.lexical(x, lexicon, t.fixed_words()) for x in t._TOKEN.findall((text or "").lower())]
    tokens = t._TOKEN.findall((text or "").lower())
    events = plain("".join(s for s, _ in read))
    ends = [k for k, (s, _) in enumerate(read) if s == t.END] + [len(read)]
    patterns, alone, start = [], [], 0
    for end in ends:
        said = [(e, t.WORTH[e] * min(max(read[k][1], 1.0), 5.0), tokens[k]) for k, e in enumerate(events[start:end], start) if e in t.WORTH]
        start, total, kinds = end + 1, sum(w for _, w, _ in said), [e for e, _, _ in said]
        if total >= 1.0 and (any(e in "dIDHTg" for e in kinds) or kinds.count("i") + kinds.count("w") > 1):
            patterns.append((total, kinds))
        elif total >= 1.0 and "i" in kinds:
            alone.append((total, kinds, {x for e, _, x in said if e == "i"}))
    if len(set().union(*(x for _, _, x in alone))) > 1:
        patterns += [x[:2] for x in alone]
    x = t.summary(patterns, len(ends))
    return 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))


def test_scores_of_a_table_follow_the_plain_rules(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    lexicon, weights = t.fit(docs, labels, "doc_id", "text", "toxic")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    got = {r.doc_id: r.score for r in t.score(docs, lexicon, weights, "doc_id", "text").collect()}
    assert lexicon and set(got) == set(texts)
    assert max(abs(got[d] - plain_score(x, lexicon, weights)) for d, x in texts.items()) < 1e-9


def test_clauses_count_more_than_words():
    s, w = t.Scorer({}), t.DEFAULT

    def of(text):
        return 1 / (1 + np.exp(-(s.features(text) @ w)))

    direct, bare, negated, reported = of("You are an idiot."), of("An idiot."), of("You are not an idiot."), of("He said “you idiot” to me.")
    assert direct > bare == negated and direct > reported and direct > of("You are here. An idiot.")
    assert of("") < 0.1 and of("kill you") < of("I will kill you") and of("Nothing here.") < 0.1
    assert of("He said he will kill you") < of("He will kill you") > of("He will not kill you")


def test_words_by_themselves_match_nothing():
    w = t.DEFAULT
    nothing = t.Scorer({}).features("") @ w
    for lexicon, text in (({"zap": 2.95}, "A zap here."), ({"zap": 8.0}, "He said zap."), ({"zap": 8.0}, "not zap not zap"), ({"zap": 8.0}, "A zap here. The zap there. zap"), ({"zap": 8.0, "zip": 8.0}, "not zap here. He said zip.")):
        assert t.Scorer(lexicon).features(text) @ w == nothing, text
    two = {"zap": 8.0, "zip": 2.0}
    for text in ("you zap", "zap and zip", "A zap! You see"):
        assert (t.Scorer(two).features(text) @ w > nothing) == (text != "A zap! You see"), text
    tirade = t.Scorer({"zap": 8.0, "zop": 8.0})
    assert tirade.features("A zap here. The zop there.") @ w > nothing == tirade.features("A zap here. The rest there.") @ w
    assert (t.Scorer({"zap": 500.0}).features("you zap") == t.Scorer({"zap": t.MOST_STRENGTH}).features("you zap")).all()


def test_contradictory_labels(spark):
    docs = spark.createDataFrame([(k, f"word{k} you idiot") for k in range(12)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, y) for k in range(12) for y in (0, k % 2)], "doc_id bigint, toxic int")
    one = spark.createDataFrame([(k, k % 2) for k in range(12)], "doc_id bigint, toxic int")
    assert (t.fit(docs, labels, "doc_id", "text", "toxic")[1] == t.fit(docs, one, "doc_id", "text", "toxic")[1]).all()  # the greatest label holds


def test_every_kind_of_row(spark):
    rows = [(1, None), (2, ""), (None, "you idiot"), (3, "you idiot, " * 20_000), (3, "you idiot, " * 20_000)]
    docs = spark.createDataFrame([(i, x, "", "") for i, x in rows], SCHEMA)
    lexicon, weights = t.fit(docs, spark.createDataFrame([(1, 1), (None, 1), (2, None)], "doc_id bigint, toxic int"), "doc_id", "text", "toxic")
    got = t.score(docs, lexicon, weights, "doc_id", "text").collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert {r.score >= t.THRESHOLD for r in got if r.doc_id in (1, 2)} == {False}
    assert t.score(docs.limit(0), lexicon, weights, "doc_id", "text").collect() == []


def test_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [r for r in t.op8_clause_grammar(spark, sf).collect() if r.held_out and r.doc_id in labels]
    hit = sum(r.predicted and labels[r.doc_id] for r in got)
    assert hit >= 0.85 * sum(labels[r.doc_id] for r in got) and hit >= 0.75 * sum(r.predicted for r in got)
