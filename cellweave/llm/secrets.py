"""Secret scan by corpus-wide ownership frequency. DataFrame functions only.

Every whole text is searched for credential-shaped spans. The hash of each
candidate value is then counted over the whole corpus by distinct owners and
distinct repositories: a value that many owners carry is a copied example, a
value that one owner carries, in whatever number of its repositories, and that
looks random is a live-looking credential. Two cases lie between: a value that
different texts of two owners hold is copied, while one text that a few owners
hold alike may be a mirror of its owner's; it is copied once it has more than
MAX_OWNERS owners, or more than one and MAX_REPOS repositories.

The patterns use nothing but what both Java's matcher and RE2 read alike, and
no pattern repeats a group without bound or reads a run again from many places,
so the time grows with the text and the matcher's stack doesn't.

Base kinds (assign, access, hex) are always reported, whatever their class.
The further kinds of ADDED are candidates only: one is reported where its
value belongs to few owners and looks live.

Defined results
  null text      an empty text: no spans
  null owner     one owner of its own, "unknown"; the same for a null repository
  null id        kept; the row is reported like any other
  repeated rows  each is reported, with the same spans
  empty table    no rows
  other columns  ignored, whatever their names
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import materialize


def _either_case(word: str) -> str:
    """ASCII letters of word as two-letter classes: the same in every regex dialect, unlike a case flag."""
    return re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", word)


_KEYWORD = "(" + "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key")) + ")"
ASSIGN = _KEYWORD + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_MIN = 8
#: (kind, pattern, group that holds the value, least length of the value), in the order in which ties in start are listed.
BASE = (
    ("assign", ASSIGN, 2, ASSIGN_MIN),
    ("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
)
#: A whole private key with up to HEADERS header lines (the format has two); its value is the body, so that two keys are two values. Without its last line a key still counts.
HEADERS = 8
PEM = rf"-----BEGIN [A-Z ]*PRIVATE KEY-----((?:[\x20\x09-\x0D]*[A-Z][A-Za-z-]*:[^\x0A\x0D]*){{0,{HEADERS}}}[\x20\x09-\x0D\\nr]*[A-Za-z0-9+/]{{40,}}[A-Za-z0-9+/=\\\x20\x09-\x0D]*)(?:-----END [A-Z ]*PRIVATE KEY-----)?"
#: A token's first part has a bound, as each place where one might begin is tried.
JWT = r"eyJ[A-Za-z0-9_-]{8,900}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"
ADDED = (
    ("pem", PEM, 1, 40),
    ("jwt", JWT, 0, 1),
    ("vendor", r"(?:gh[pousr]_|sk_live_|xox[abprs]-|AIza)[A-Za-z0-9_-]{16,}", 0, 1),
    ("urlcred", r"://[^\x20\x09-\x0D:@/]+:[^\x20\x09-\x0D@/]+@", 0, 1),
    ("blob", r"[A-Za-z0-9+/]{40,}", 0, 40),
)
#: A value is a copied example if different texts of more than one owner hold it, if it has more than MAX_OWNERS owners, or more than one and more than MAX_REPOS repositories.
MAX_OWNERS, MAX_REPOS = 3, 4
#: A live-looking value has at least so many different characters, so many digits and so many letters.
LIVE_DISTINCT, LIVE_DIGITS, LIVE_LETTERS = 10, 3, 3
#: A private key is live by its form. Of urlcred the password is judged: people choose it, so it needs no digits, but so many different characters and no placeholder's form.
PASSWORD, PASSWORD_DISTINCT = r"://[^:]+:(.+)@", 5
PLACEHOLDER = r"^(?:[$<{\[%].*|.*(?:password|passwd|secret|example|changeme).*)$"


#: Spans are placed in runs of so many: appending to an array copies it.
RUN = 256


def _spans(text: Column, rank: int, kind: str, pattern: str, group: int, least: int) -> Column:
    """Spans of one kind, in code points: pieces between matches and the matches themselves alternate, so their lengths give the places."""
    pieces, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    span_type = "struct<start:int,rank:int,end:int,kind:string,value:string>"
    none = F.array().cast(f"array<{span_type}>")

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + F.length(pair["piece"])
        end = start + F.length(pair["match"])
        value = F.regexp_extract(pair["match"], pattern, group) if group else pair["match"]
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"), value.alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    def placed(pairs: Column) -> Column:
        def run(done: Column, k: Column) -> Column:
            begin = F.struct(F.coalesce(F.get(done, F.size(done) - 1)["at"], F.lit(0)).alias("at"), none.alias("out"))
            return F.concat(done, F.array(F.aggregate(F.slice(pairs, k * RUN + 1, F.lit(RUN)), begin, step)))

        runs = F.sequence(F.lit(0), ((F.size(pairs) - 1) / RUN).cast("int"))
        nothing = F.array().cast(f"array<struct<at:int,out:array<{span_type}>>>")
        return F.flatten(F.transform(F.aggregate(runs, nothing, run), lambda r: r["out"]))

    pairs = F.arrays_zip(F.slice(pieces, F.lit(1), F.size(found)).alias("piece"), found.alias("match"))
    spans = F.transform(F.array(pairs), placed)[0]  # so that the text is searched once
    return F.when(text.rlike(pattern), F.filter(spans, lambda s: F.length(s["value"]) >= least)).otherwise(none)


def _live_looking(kind: Column, value: Column) -> Column:
    chars = F.split(value, "")
    password = F.regexp_extract(value, PASSWORD, 1)
    chosen = (F.size(F.array_distinct(F.split(password, ""))) >= PASSWORD_DISTINCT) & ~F.lower(password).rlike(PLACEHOLDER)
    random = (
        (F.size(F.array_distinct(chars)) >= LIVE_DISTINCT)
        & (F.regexp_count(value, F.lit("[0-9]")) >= LIVE_DIGITS)
        & (F.regexp_count(value, F.lit("[A-Za-z]")) >= LIVE_LETTERS)
    )
    return F.when(kind == "pem", True).when(kind == "urlcred", chosen).otherwise(random)


def _joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat(s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))))


def scan_secrets(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repo_cols: tuple[str, ...], max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS) -> DataFrame:
    """One row for each row of docs: id, spans array<struct<start, rank, end, kind, value, n_owners, n_repos, class>> sorted by start, then kind.

    n_owners and n_repos count all rows that hold the value. class is "copied" (as said above), "live" (not copied, and looks
    live for its kind) or "weak" (not copied, and doesn't). Only candidate rows are shuffled, never texts, and they are combined
    before each shuffle: by (value, text), whose owner is the first by name of those that hold it, and by (value, repository).
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    owner = F.coalesce(F.col(owner_col).cast("string"), F.lit("unknown"))
    repo = F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("unknown")) for c in repo_cols])
    kinds = [*BASE, *ADDED]
    rows = docs.select(
        F.col(id_col).alias("__id"),
        owner.alias("__owner"),
        repo.alias("__repo"),
        F.xxhash64(text).alias("__key"),
        F.array_sort(F.concat(*[_spans(text, k, *spec) for k, spec in enumerate(kinds)])).alias("__spans"),
    )
    rows = materialize(rows, "secrets")  # narrow: candidates only, so that texts are searched once
    found = rows.where(F.size("__spans") > 0)
    spans = found.select("__id", "__key", "__owner", "__repo", F.explode("__spans").alias("s")).withColumn("__value", F.xxhash64("s.value"))
    texts = spans.groupBy("__value", "__key").agg(F.min("__owner").alias("o"))
    of_texts = texts.groupBy("__value", "o").agg(F.count("*").alias("n")).groupBy("__value").agg(F.count("*").alias("n_firsts"))
    owned = spans.groupBy("__value", "__owner", "__repo").agg(F.count("*").alias("n"))
    by_owner = owned.groupBy("__value", "__owner").agg(F.count("*").alias("repos"))
    counts = by_owner.groupBy("__value").agg(F.count("*").alias("n_owners"), F.sum("repos").alias("n_repos")).join(of_texts, "__value")
    counts = materialize(counts, "owners")  # so that the join stands on two plain exchanges, and Spark can split a hot value
    live = _live_looking(F.col("s.kind"), F.col("s.value"))
    known = spans.join(counts, "__value").select(
        "__id",
        "__key",
        F.struct(
            "s.start", "s.rank", "s.end", "s.kind", "s.value", "n_owners", "n_repos",
            F.when((F.col("n_firsts") > 1) | (F.col("n_owners") > max_owners) | ((F.col("n_owners") > 1) & (F.col("n_repos") > max_repos)), "copied").when(live, "live").otherwise("weak").alias("class"),
        ).alias("span"),
    )
    kept = known.where((F.col("span.rank") < len(BASE)) | (F.col("span.class") == "live"))
    by_doc = kept.groupBy("__id", "__key").agg(F.array_sort(F.collect_set("span")).alias("spans"))
    empty = F.array().cast(by_doc.schema["spans"].dataType)
    left, right = found.select("__id", "__key").alias("l"), by_doc.alias("r")
    with_spans = left.join(right, F.col("l.__id").eqNullSafe(F.col("r.__id")) & (F.col("l.__key") == F.col("r.__key")), "left").select(F.col("l.__id").alias("__id"), F.coalesce("r.spans", empty).alias("spans"))
    without = rows.where(F.size("__spans") == 0).select("__id", empty.alias("spans"))
    return with_spans.unionByName(without).withColumnRenamed("__id", id_col)


def digest(scanned: DataFrame, id_col: str) -> DataFrame:
    """The columns that the contract of the query names, with how many spans are live-looking and how many copied."""
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))

    def count(test) -> Column:
        return F.size(F.filter("spans", test)).cast("bigint")

    return scanned.select(
        F.col(id_col),
        count(lambda s: s["kind"] == "assign").alias("n_assign"),
        count(lambda s: s["kind"] == "access").alias("n_access"),
        count(lambda s: s["kind"] == "hex").alias("n_hex"),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
        count(lambda s: s["class"] == "live").alias("n_live"),
        count(lambda s: s["class"] == "copied").alias("n_copied"),
    )


def op1_secret_ownership(spark, sf_dir: str) -> DataFrame:
    """All documents. A source is an owner; a source's documents in one language are a repository of it (the table names no repositories)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digest(scan_secrets(docs, "doc_id", "text", "source", ("source", "lang")), "doc_id")


def _sql_spans(rank: int, kind: str, pattern: str, group: int, least: int) -> str:
    q = pattern.replace("'", "''")
    value = f"regexp_extract(m, '{q}', {group})" if group else "m"
    return f"""
    SELECT doc_id, source, lang, {rank} AS rank, '{kind}' AS kind, s AS start, s + length(m) AS "end", {value} AS value
    FROM (
      SELECT doc_id, source, lang, unnest(ms) AS m,
             unnest(list_transform(range(1, len(ms) + 1), lambda i: (list_sum(list_transform(ps[1:i], lambda p: length(p))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda m: length(m))), 0))::BIGINT)) AS s
      FROM (SELECT doc_id, source, lang, regexp_extract_all(t, '{q}') AS ms, string_split_regex(t, '{q}') AS ps FROM texts WHERE regexp_matches(t, '{q}'))
    ) WHERE length({value}) >= {least}"""


def _sql_live() -> str:
    def different(x: str) -> str:
        return f"len(list_distinct(string_split({x}, '')))"

    def chars(of: str) -> str:
        return f"length(regexp_replace(value, '[^{of}]', '', 'g'))"

    password = f"regexp_extract(value, '{PASSWORD}', 1)"
    chosen = f"{different(password)} >= {PASSWORD_DISTINCT} AND NOT regexp_matches(lower({password}), '{PLACEHOLDER}')"
    random = f"{different('value')} >= {LIVE_DISTINCT} AND {chars('0-9')} >= {LIVE_DIGITS} AND {chars('A-Za-z')} >= {LIVE_LETTERS}"
    return f"CASE kind WHEN 'pem' THEN true WHEN 'urlcred' THEN {chosen} ELSE {random} END"


ORACLE = f"""
WITH texts AS (SELECT doc_id, coalesce(source, 'unknown') AS source, coalesce(lang, 'unknown') AS lang, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(_sql_spans(k, *spec) for k, spec in enumerate([*BASE, *ADDED]))}),
firsts AS (
  SELECT value, count(DISTINCT o) AS n_firsts
  FROM (SELECT value, t, min(source) AS o FROM (SELECT DISTINCT doc_id, source, value FROM found) f JOIN (SELECT DISTINCT doc_id, t FROM texts) USING (doc_id) GROUP BY value, t)
  GROUP BY value),
counts AS (SELECT value, count(DISTINCT source) AS n_owners, count(DISTINCT {{'a': source, 'b': lang}}) AS n_repos FROM found GROUP BY value),
known AS (
  SELECT f.*, CASE WHEN n_firsts > 1 OR n_owners > {MAX_OWNERS} OR (n_owners > 1 AND n_repos > {MAX_REPOS}) THEN 'copied' WHEN {_sql_live()} THEN 'live' ELSE 'weak' END AS class
  FROM found f JOIN counts USING (value) JOIN firsts USING (value)),
kept AS (SELECT *, kind || ':' || start || ':' || "end" AS said FROM known WHERE rank < {len(BASE)} OR class = 'live'),
by_doc AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(said, ',' ORDER BY start, rank) FILTER (rank < {len(BASE)}) AS base, string_agg(said, ',' ORDER BY start, rank) AS spans,
    count(*) FILTER (class = 'live') AS n_live, count(*) FILTER (class = 'copied') AS n_copied
  FROM kept GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0)::BIGINT AS n_live, coalesce(n_copied, 0)::BIGINT AS n_copied
FROM documents d LEFT JOIN by_doc USING (doc_id)
"""
