"""Exact dedup by content-defined chunk recipes. DataFrame functions only.

1. Each text is cut where its own content says so: after MIN_CHUNK characters
   at the next white space with certain characters around it, at MAX_CHUNK at
   the latest. Such places are rarer than MIN_CHUNK is long, so that cuts fall
   in step again soon after an insertion.
2. A chunk's identifier is a pair of 64-bit hashes. Identifiers are verified:
   those found more than once are counted, and the contents of their chunks are
   grouped by identifier; the least and the greatest of each group must be
   equal. A filter of fixed size tells chunks whose identifier is there once:
   most of a corpus, which stays where it is. Contents are combined before the
   shuffle, so a chunk that a third of all rows hold moves once a task. If an
   identifier stands for two contents, all identifiers are made anew with
   another salt and verified again.
3. Texts are then equal exactly if their ordered lists of identifiers are;
   only those short lists are grouped and joined. Long texts never move.

Defined results
  null text      an empty text, equal to other empty texts
  null id        below every other id; a group of null ids has a null keep_id
  repeated rows  rows with the same id and text share one verdict; deduplicate() returns such a row once
  empty table    no rows
  other columns  ignored by mark_duplicates(), kept by deduplicate()
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import discard, key_filter, materialize, rows_of, with_filter

MIN_CHUNK, MAX_CHUNK = 256, 4096
SALTS = 8


def _one_in(n: int) -> str:
    """A character class of every n-th printable ASCII character."""
    return "[" + "".join(re.escape(chr(c)) for c in range(32, 127) if c % n == 0) + "]"


#: Between words: two characters of four-fold code before the white space and one of three-fold code after it; or after a full-width stop.
PLACE = rf"(?<={_one_in(4)}{_one_in(4)}\s)(?={_one_in(3)})|(?<=[。！？])"


def chunks(text: Column, least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> Column:
    """The text's chunks, in order; joined, they are the text."""
    cut = rf"(?s).{{{least},{most}}}?(?:{PLACE}|\z)|.{{1,{most}}}"
    return F.regexp_extract_all(text, F.lit(cut), F.lit(0))


def pair_hash(chunk: Column, salt: int) -> Column:
    return F.array(F.xxhash64(F.lit(2 * salt), chunk), F.xxhash64(chunk, F.lit(2 * salt + 1)))


def _colliding(docs: DataFrame, own: DataFrame, text: Column, hashed: Callable[[Column, int], Column], salt: int) -> bool:
    """True if an identifier stands for more than one chunk content. own: the recipes with this salt."""
    each = own.where(F.size("recipe") > 0).select(F.explode(F.transform(F.sequence(F.lit(0), (F.size("recipe") / 2 - 1).cast("int")), lambda k: F.struct(F.get("recipe", 2 * k).alias("h0"), F.get("recipe", 2 * k + 1).alias("h1")))).alias("h"))
    again = each.groupBy("h.h0", "h.h1").agg(F.count("*").alias("n")).where("n > 1")
    found = materialize(key_filter(again.withColumn("x", F.xxhash64("h0", "h1")), "x"), "filter")
    each = docs.select(F.explode(chunks(text)).alias("c")).select(hashed(F.col("c"), salt).alias("h"), "c").select(F.col("h")[0].alias("h0"), F.col("h")[1].alias("h1"), "c")
    each = with_filter(each, found, F.xxhash64("h0", "h1"), "again").where("again")
    seen = each.groupBy("h0", "h1").agg(F.min("c").alias("least"), F.max("c").alias("most"))
    differ = not seen.where(F.col("least") != F.col("most")).isEmpty()
    discard(found)
    return differ


def recipes(docs: DataFrame, id_col: str, text_col: str, hashed: Callable[[Column, int], Column] = pair_hash) -> DataFrame:
    """(id, recipe array<bigint>, text_sha256) of each row; equal recipes mean equal texts."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    for salt in range(SALTS):
        own = docs.select(
            F.col(f"`{id_col}`").alias("id"),
            F.flatten(F.transform(chunks(text), lambda c: hashed(c, salt))).alias("recipe"),
            F.sha2(text, 256).alias("text_sha256"),
        )
        own = materialize(own, "recipes")
        if not _colliding(docs, own, text, hashed, salt):
            return own
        discard(own)
    raise RuntimeError(f"chunk identifiers still stand for several contents after {SALTS} salts")


def mark_duplicates(docs: DataFrame, id_col: str, text_col: str, hashed: Callable[[Column, int], Column] = pair_hash) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) of each row; of equal texts the row with the largest id stays."""
    own = recipes(docs, id_col, text_col, hashed)
    groups = own.groupBy("recipe").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
    groups = materialize(groups, "groups")  # so that the join stands on two plain exchanges, and Spark can split a hot group
    out = own.join(groups, "recipe")
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def deduplicate(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of docs that stay, with all their columns; a repeated row once."""
    marked = mark_duplicates(docs, id_col, text_col)
    said = F.coalesce(F.concat(F.lit("="), F.col(f"`{id_col}`").cast("string")), F.lit("-"))
    return rows_of(docs, marked.select(F.sha2(F.concat_ws(":", "text_sha256", said), 256).alias("key"), F.col("kept").alias("stay")), id_col, text_col)


def op9_chunk_recipes(spark, sf_dir: str) -> DataFrame:
    """All documents, compared without any change of their texts."""
    return mark_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text")


ORACLE = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
g AS (SELECT x, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY x)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.x) AS text_sha256
FROM t JOIN g USING (x)
"""
