"""Toxicity by a weighted finite-state pattern grammar.

Tokens become symbols: abusive word, weak word, verb of harm, intention,
target, negation, report, quote, clause end, other. Six transducers are
composed into one machine:

    insult     an abusive word is an insult, and so is a weak word within two
               words after another weak one
    threat     a verb of harm within three words after an intention is a
               threat, one without it is mere harm
    negation   any of these within three words after a negation is negated
    report     after a word of reporting, or in the quotation that it opens,
               any of these is reported
    target     an insult or threat in a clause with a target is direct,
               whichever comes first
    weights    what each of these is worth

The machine reads each clause once; the weight of its path, with the strength
of each word on it (MOST_STRENGTH at most), is the clause's score. A clause
matches from MATCH on, and only by a pattern of two elements: an abusive word
or verb of harm with a target or an intention, or two abusive or weak words
that are neither negated nor reported. Clauses with one abusive word each
match together, as a tirade, if a text has TIRADE different such words. A word
by itself matches nothing, however strong or often repeated it is, and neither
do negated or reported ones. Only matched
clauses count: their scores, how many are direct, insults or threats, and
their share of all clauses give a document's probability by a logistic
function.

Words come from FIXED lists below and from labelled rows: words and word
stems that documents labelled toxic have far more often than others. The
logistic weights are fitted to features that a lexicon of the other half of
the rows made. Both use at most FIT_ROWS labelled rows, those of the smallest
id hashes; scoring covers every whole text and reads nothing but the text.

Defined results
  null text      an empty text: the score of no match
  null id        scored; never used for fitting
  null label     ignored; of several labels of an id the greatest holds
  no labels      fixed words and default weights
  repeated rows  each is reported
  empty table    no rows
  long texts     read whole by one task, in time and memory in proportion to the text
  other columns  ignored, whatever their names
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import materialize, session_of

FIT_ROWS = 20_000
THRESHOLD = 0.3
#: Rows with this remainder of crc32(id as text) by 4 are held out from fitting.
HELD_OUT = 2
STEMS = range(3, 9)
#: A term is learned from so many labelled toxic documents, or this share of them, so there are at most 1 / LEAST_SHARE times the terms of a document.
LEAST_DOCS, LEAST_SHARE, STRONG, WEAK = 3, 0.004, 3.0, 1.5
#: The score from which a clause matches.
MATCH = 1.0
#: A word counts for no more than this, so that no word outweighs a pattern.
MOST_STRENGTH = 5.0

# FIXED: words of the grammar, in English, German, French and Spanish.
INSULT_WORDS = "idiot moron stupid loser scum trash worthless pathetic disgusting imbecile"
THREATS_OF_HARM = "kill hurt beat shoot stab burn destroy töten umbringen verletzen tuer frapper blesser matar golpear herir"
INTENTIONS = "will gonna going shall i'll we'll want werde werden will wollen vais va allons veux voy va vamos quiero"
TARGETS = "you your yours yourself he she they them these those du dich dir dein ihr euch tu toi te vous tú ti usted vosotros"
NEGATIONS = "not no never nor isn't aren't wasn't don't doesn't nicht kein keine nie ne pas jamais nunca jamás"
REPORTS = "said says wrote writes called calls quoted quotes claimed reported sagte schrieb nannte dit écrit appelé dijo escribió llamó"

OTHER, ABUSE, WEAK_WORD, HARM, INTENT, TARGET, NEGATION, REPORT, QUOTE, END = "oawvktnrq."
#: What the machine reads.
SYMBOLS = OTHER + ABUSE + WEAK_WORD + HARM + INTENT + TARGET + NEGATION + REPORT + QUOTE + END
#: What insult and threat write; negation and report write NEGATED and REPORTED in their place, target the direct ones.
INSULT, THREAT, NEGATED, REPORTED = "iTxp"
DIRECT_INSULT, INSULT_THEN_TARGET, DIRECT_THREAT, THREAT_THEN_TARGET, HARM_TO_TARGET = "IdHDg"
#: The worth of each.
WORTH = {DIRECT_INSULT: 1.6, INSULT: 1.0, INSULT_THEN_TARGET: 0.6, DIRECT_THREAT: 2.0, THREAT: 1.2, THREAT_THEN_TARGET: 0.8, HARM_TO_TARGET: 0.4, HARM: 0.2, WEAK_WORD: 0.35, NEGATED: 0.1, REPORTED: 0.15}
DIRECT, INSULTS, THREATS = set("IdHD"), set("iId"), set("THD")
#: So many different abusive words, each alone in its clause, are a tirade.
TIRADE = 2
#: Events that are a pattern by themselves, and those of which it takes two.
PATTERNS, HALVES = set("IdHDTg"), set("iw")
DEFAULT = np.array([-4.0, 1.4, 0.8, 1.0, 0.4, 0.6, 0.5])

_TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[.!?;:\n]|[\"“”«»„]")
_ENDS, _QUOTES = set(".!?;:\n"), set("\"“”«»„")


class Transducer:
    """States and arcs (state, symbol) -> (state, output, weight); a missing arc keeps the state and passes the symbol."""

    def __init__(self, start, arcs: dict):
        self.start, self.arcs = start, arcs

    def step(self, state, symbol: str) -> tuple:
        return self.arcs.get((state, symbol), (state, symbol, 0.0))


def compose(a: Transducer, b: Transducer, symbols: str) -> Transducer:
    """b reads what a writes; weights add. Only states that symbols reach are made."""
    start, arcs = (a.start, b.start), {}
    todo, seen = [start], {start}
    while todo:
        state = todo.pop()
        for s in symbols:
            next_a, middle, wa = a.step(state[0], s)
            next_b, out, wb = b.step(state[1], middle)
            arcs[state, s] = ((next_a, next_b), out, wa + wb)
            if (next_a, next_b) not in seen:
                seen.add((next_a, next_b))
                todo.append((next_a, next_b))
    return Transducer(start, arcs)


def _passing(states: int, forget: str) -> dict:
    """Arcs of a transducer whose state counts words down to 0; the symbols of forget end it at once."""
    arcs = {(k, s): (max(0, k - 1), s, 0.0) for k in range(states) for s in SYMBOLS + INSULT + THREAT}
    return arcs | {(k, s): (0, s, 0.0) for k in range(states) for s in forget}


def insults() -> Transducer:
    arcs = _passing(3, END)
    for k in range(3):
        arcs[k, ABUSE] = (max(0, k - 1), INSULT, 0.0)
        arcs[k, WEAK_WORD] = (2, INSULT if k else WEAK_WORD, 0.0)
    return Transducer(0, arcs)


def threats() -> Transducer:
    arcs = _passing(4, END)
    for k in range(4):
        arcs[k, INTENT] = (3, OTHER, 0.0)
        arcs[k, HARM] = (0, THREAT if k else HARM, 0.0)
    return Transducer(0, arcs)


_MEANT = INSULT + THREAT + HARM + WEAK_WORD


def negations() -> Transducer:
    arcs = _passing(4, END)
    for k in range(4):
        arcs[k, NEGATION] = (3, OTHER, 0.0)
        for s in _MEANT:
            arcs[k, s] = (0, NEGATED if k else s, 0.0)
    return Transducer(0, arcs)


def reports() -> Transducer:
    """State 1 after a word of reporting, up to the clause's end; 2 in a quotation that followed it."""
    arcs = {(k, REPORT): (max(1, k), OTHER, 0.0) for k in range(3)}
    arcs |= {(0, QUOTE): (0, OTHER, 0.0), (1, QUOTE): (2, OTHER, 0.0), (2, QUOTE): (0, OTHER, 0.0), (1, END): (0, END, 0.0)}
    return Transducer(0, arcs | {(k, s): (k, REPORTED, 0.0) for k in (1, 2) for s in _MEANT})


def targets() -> Transducer:
    """State 1 with a target in the clause; 2 with an insult and 3 with a threat that wait for one."""
    arcs = {(0, TARGET): (1, OTHER, 0.0), (1, TARGET): (1, OTHER, 0.0), (2, TARGET): (1, INSULT_THEN_TARGET, 0.0), (3, TARGET): (1, THREAT_THEN_TARGET, 0.0)}
    for k in (0, 2, 3):
        arcs |= {(k, INSULT): (max(2, k), INSULT, 0.0), (k, THREAT): (3, THREAT, 0.0)}
    arcs |= {(1, INSULT): (1, DIRECT_INSULT, 0.0), (1, THREAT): (1, DIRECT_THREAT, 0.0), (1, HARM): (1, HARM_TO_TARGET, 0.0)}
    return Transducer(0, arcs | {(k, END): (0, END, 0.0) for k in range(4)})


def worths() -> Transducer:
    return Transducer(0, {(0, s): (0, s, w) for s, w in WORTH.items()})


def grammar() -> Transducer:
    machine = insults()
    for part in (threats(), negations(), reports(), targets(), worths()):
        machine = compose(machine, part, SYMBOLS)
    return machine


def lexical(token: str, lexicon: dict[str, float], fixed: dict[str, str]) -> tuple[str, float]:
    """(symbol, strength) of a token: the stronger of its learned terms, else its fixed list."""
    if token in _ENDS:
        return END, 0.0
    if token in _QUOTES:
        return QUOTE, 0.0
    best = max((lexicon.get(t, 0.0) for t in terms_of(token)), default=0.0)
    if best >= STRONG:
        return ABUSE, best
    if token in fixed:
        return fixed[token], STRONG if fixed[token] == ABUSE else 1.0
    return (WEAK_WORD, best) if best else (OTHER, 0.0)


def fixed_words() -> dict[str, str]:
    lists = ((INTENT, INTENTIONS), (HARM, THREATS_OF_HARM), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (ABUSE, INSULT_WORDS))
    return {w: s for s, words in lists for w in words.split()}


def matches(score: float, events: list[str]) -> bool:
    """Whether a clause's events are a pattern that weighs enough."""
    return score >= MATCH and (not PATTERNS.isdisjoint(events) or sum(e in HALVES for e in events) >= 2)


def summary(clauses: list[tuple[float, list[str]]], n_clauses: int) -> np.ndarray:
    """Features of a document from its matched clauses (score, events)."""
    scores = [x for x, _ in clauses]
    kinds = [sum(1 for _, events in clauses if not kind.isdisjoint(events)) for kind in (DIRECT, INSULTS, THREATS)]
    return np.array([1.0, math.log1p(sum(scores)), math.log1p(max(scores, default=0.0)), *map(math.log1p, kinds), len(clauses) / max(1, n_clauses)])


class Scorer:
    """features(text) by a lexicon of words and stems (ending in *) to strengths."""

    def __init__(self, lexicon: dict[str, float]):
        self.machine, self.lexicon, self.fixed, self.kept = grammar(), lexicon, fixed_words(), {}

    def features(self, text: str) -> np.ndarray:
        tokens = _TOKEN.findall(text.lower())
        kept = self.kept
        new = {t for t in tokens if t not in kept}
        if len(kept) + len(new) > 400_000:
            kept.clear()
            new = set(tokens)
        for t in new:
            kept[t] = lexical(t, self.lexicon, self.fixed)
        read = [kept[t] for t in tokens]
        clauses, ends = [], 1 + sum(s == END for s, _ in read)
        if any(s in "awv" for s, _ in read):
            arcs, state, score, events, words = self.machine.arcs, self.machine.start, 0.0, [], []
            lone: list[tuple[float, list[str]]] = []
            abuse: set[str] = set()
            for token, (s, strength) in zip([*tokens, "."], [*read, (END, 0.0)], strict=True):
                state, out, w = arcs[state, s]
                if w:
                    score += w * min(max(strength, 1.0), MOST_STRENGTH)
                    events.append(out)
                    words.append(token)
                elif s == END and events:
                    if matches(score, events):
                        clauses.append((score, events))
                    elif score >= MATCH and INSULT in events:
                        lone.append((score, events))
                        abuse.update(t for t, e in zip(words, events, strict=True) if e == INSULT)
                    score, events, words = 0.0, [], []
            if len(abuse) >= TIRADE:
                clauses += lone
        return summary(clauses, ends)


def terms_of(word: str) -> Iterator[str]:
    """The word and its stems."""
    yield word
    for k in STEMS:
        if k < len(word):
            yield word[:k] + "*"


def _all_terms(text: str) -> set[str]:
    return {t for w in set(_TOKEN.findall(text.lower())) if w not in _ENDS and w not in _QUOTES for t in terms_of(w)}


def _count_terms(rows: DataFrame, known: set[str] | None) -> DataFrame:
    """(term, fold, n): documents of rows (__text, __fold) that have the term; known: only these terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for text, fold in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = _all_terms(text or "")
                counts.update((t, fold) for t in (found if known is None else found & known))
            keys = list(counts)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), pa.array([counts[k] for k in keys], pa.int64())], names=["term", "fold", "n"])

    return rows.select("__text", "__fold").mapInArrow(run, "term string, fold int, n bigint").groupBy("term", "fold").agg(F.sum("n").alias("n"))


def lexicon_of(toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int) -> dict[str, float]:
    """Terms by how much more often documents labelled toxic have them: the logarithm of the ratio less 1.5 times its standard error."""
    least, out = max(LEAST_DOCS, LEAST_SHARE * n_toxic), {}
    for t, a in toxic.items():
        b = clean.get(t, 0)
        if a >= least:
            w = math.log((a + 0.5) / (n_toxic + 1)) - math.log((b + 0.5) / (n_clean + 1)) - 1.5 * math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
            if w >= WEAK:
                out[t] = w
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """By Newton's steps, held near zero by ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hold = np.full(len(w), ridge)
        hold[0] = 1e-3
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(hold), x.T @ (y - p) - hold * w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


def held_out(id_col):
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == HELD_OUT


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, fit_rows: int = FIT_ROWS) -> tuple[dict[str, float], np.ndarray]:
    """(lexicon, logistic weights) from labelled rows that aren't held out."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col)).groupBy(F.col(id_col).alias("__labelled")).agg(F.max(F.col(label_col).cast("int")).alias("__toxic"))
    chosen = known.orderBy(F.xxhash64(F.col("__labelled").cast("string")), "__labelled").limit(fit_rows)  # a parameter bounds it, so it may be broadcast
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
    rows = rows.join(F.broadcast(chosen), F.col("__id") == F.col("__labelled"))
    fold = F.pmod(F.xxhash64(F.col("__id").cast("string"), F.lit("half")), F.lit(2)).cast("int")
    rows = materialize(rows.select("__text", "__toxic", fold.alias("__fold")), "toxicity")
    sizes = {(r["__toxic"], r["__fold"]): r["n"] for r in rows.groupBy("__toxic", "__fold").agg(F.count("*").alias("n")).collect()}
    n = np.array([[sizes.get((y, f), 0) for f in (0, 1)] for y in (0, 1)])
    if not n.all():
        return {}, DEFAULT
    often = _count_terms(rows.where("__toxic = 1"), None)
    often = materialize(often, "toxicity")
    top = often.groupBy("term").agg(F.sum("n").alias("all")).where(F.col("all") >= max(LEAST_DOCS, LEAST_SHARE * n[1].sum() / 2))
    candidates = {r["term"] for r in top.select("term").collect()}
    toxic = [{}, {}]
    for r in often.join(F.broadcast(top.select("term")), "term", "left_semi").collect():
        toxic[r["fold"]][r["term"]] = r["n"]
    clean = [{}, {}]
    for r in _count_terms(rows.where("__toxic = 0"), candidates).collect():
        clean[r["fold"]][r["term"]] = r["n"]
    halves = [lexicon_of(toxic[f], clean[f], n[1][f], n[0][f]) for f in (0, 1)]
    both = lexicon_of(Counter(toxic[0]) + Counter(toxic[1]), Counter(clean[0]) + Counter(clean[1]), n[1].sum(), n[0].sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorers = [Scorer(halves[1]), Scorer(halves[0])]  # each half by the lexicon of the other
        for batch in batches:
            x = [scorers[f].features(t or "").tolist() for t, f in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column(1)], names=["x", "y"])

    made = rows.mapInArrow(run, "x array<double>, y int").toArrow()
    x, y = np.array(made["x"].to_pylist()), made["y"].to_numpy().astype(float)
    order = np.lexsort((y, *x.T))  # rows arrive in any order, sums shouldn't
    x, y = x[order], y[order]
    return both, fit_logistic(x, y)


def score(docs: DataFrame, lexicon: dict[str, float], weights: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """(id, score) of each row, in one pass without a shuffle."""
    kind = docs.schema[id_col].dataType.simpleString()
    sent = session_of(docs).sparkContext.broadcast((lexicon, weights))  # terms of fit_rows documents at most, each in LEAST_SHARE of those labelled toxic

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, w = sent.value
        scorer = Scorer(own)
        for batch in batches:
            x = np.array([scorer.features(t or "") for t in batch.column(1).to_pylist()]).reshape(-1, len(w))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(x @ w, -30, 30))))], names=["__id", "score"])

    return docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text")).mapInArrow(run, f"__id {kind}, score double").withColumnRenamed("__id", id_col)


def op8_clause_grammar(spark, sf_dir: str) -> DataFrame:
    """All documents; labels from rows that aren't held out."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    lexicon, weights = fit(docs, labels, "doc_id", "text", "toxic")
    scored = score(docs, lexicon, weights, "doc_id", "text")
    return scored.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
