"""Chat formatting: exact round trips, spans against rendering every prefix, and templates that rewrite history."""

from __future__ import annotations

import hashlib
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from cellweave.llm import chat
from tests.oracle import differences

TEXT = st.text(alphabet="ab<|\\n\n>im_startend 🙂A", max_size=30)
SCHEMA = "conv_id bigint, turn bigint, role string, text string, formatted string, __conv string"


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(TEXT, TEXT), max_size=6))
def test_round_trip(turns):
    out, spans, rewrites = chat.locate(turns)
    assert chat.read_back(out) == turns and rewrites == -1
    assert [chat.unescape(out[c:d]) for _, _, c, d in spans] == [t for _, t in turns]
    assert [s[0] for s in spans[1:]] == [s[1] for s in spans[:-1]] and (not spans or spans[-1][1] == len(out))


def test_history_rewritten_late_is_told():
    turns = [("user" if k % 2 else "assistant", f"text {k} <|im_end|>") for k in range(203)]

    def note_every_70(t):  # the note goes again with the next turn
        return chat.marked_turns(t) if len(t) % 70 else chat.marked_turns(t) + f"[{len(t)}]" * bool(t)

    out, spans, at = chat.locate(turns, note_every_70)
    assert at == 70 and out == note_every_70(turns) and spans[70] is None and spans[69] is None and spans[68] and spans[71]


def test_texts_are_placed_turn_by_turn():
    def numbered(t):
        return "".join(f"[{k + 1}] {r}: {x}\n" for k, (r, x) in enumerate(t))

    turns = [("user" if k % 2 else "assistant", f"text {k}") for k in range(120)]
    out, spans, at = chat.locate(turns, numbered)
    assert at == -1 and [out[c:d] for *_, c, d in spans] == [x for _, x in turns]

    def by_first(t):  # the first text says how later ones are set
        return "".join(f"{'>' * len(t[0][1])} {r}: {x}\n" for r, x in t)

    out, spans, at = chat.locate([("user", "abc"), *turns], by_first)
    assert at == -1 and [out[c:d] for *_, c, d in spans[1:]] == [x for _, x in turns]
    assert spans[0][2:] == (None, None)  # a text that shows twice has no one place

    def counted(t):
        return "".join(f"{r} ({len(x)}): {x}\n" for r, x in t)

    _, spans, at = chat.locate([("user", "a"), ("assistant", "longer")], counted)
    assert spans[0][2] is not None and spans[1][2] is None  # what surrounds the letter isn't what surrounds the text


def test_unplaced_turns_are_reported(spark):
    def counted(t):
        return "".join(f"{r} ({len(x)}): {x}\n" for r, x in t)

    df = spark.createDataFrame([(1, 0, "assistant", "long", "", ""), (1, 1, "assistant", "x", "", "")], SCHEMA)
    r = chat.format_chats(df, "conv_id", "turn", "role", "text", counted).first()
    assert r.unplaced == [0] and [s.text_start is None for s in r.spans] == [True, False]


def test_rewritten_history_is_told():
    def hides_old(turns):
        return "".join(f"<{r}>{t if k == len(turns) - 1 else t[:2]}</>" for k, (r, t) in enumerate(turns))

    out, spans, at = chat.locate([("user", "ab"), ("assistant", "long text"), ("user", "x")], hides_old)
    assert at == 2 and out == "<user>ab</><assistant>lo</><user>x</>"
    assert spans[0] == (0, 11, 6, 8) and spans[1] is None and spans[2] is None

    def trims(turns):
        return "".join(f"[{r}] {t.strip()}\n" for r, t in turns)

    out, spans, at = chat.locate([("user", " ab "), ("assistant", "c")], trims)
    assert at == -1 and [out[c:d] for *_, c, d in spans] == ["ab", "c"]


def expected(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    for conv, turns in convs.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        trained = "".join(t for _, r, t in turns if r == "assistant")
        yield conv, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(trained), hashlib.sha256(trained.encode()).hexdigest()


def check(got, rows):
    assert {(r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == set(expected(rows)) and len(got) == len({r[0] for r in rows})


def test_every_kind_of_row(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", ""), (1, 1, "assistant", "b"), (1, 1, "assistant", "b"), (None, 0, "assistant", "x"), (2, None, "user\n<|", "y\\"), (2, 0, None, "z")]
    rows += [(3, k, "assistant" if k % 2 else "user", f"t{k} " * 50) for k in range(1500)]
    df = spark.createDataFrame([(*r, "", "") for r in rows], SCHEMA)
    check(chat.digest(chat.format_chats(df, "conv_id", "turn", "role", "text"), "conv_id").collect(), rows)
    assert chat.digest(chat.format_chats(df.limit(0), "conv_id", "turn", "role", "text"), "conv_id").collect() == []


def test_the_table_and_the_planted_conversation(spark):
    sf = "/root/testdata/sf0.001"
    got, want, more, less = differences(chat.op3_prefix_rendering(spark, sf), chat.ORACLE, sf)
    assert (got, more, less) == (want, [], [])
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check(chat.op3_prefix_rendering(spark, sf).collect(), [*rows, (-1, 0, "user", chat.PLANTED), (-1, 1, "assistant", chat.PLANTED)])
