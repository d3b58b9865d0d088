"""Mixing sources to target weights by hash-threshold histograms. DataFrame functions only.

Each source has a target number of words. A target of k sources' sizes and a
rest is met by taking every document k times and some documents once more:
those whose hash lies below a threshold. The threshold is found without
sorting documents: words are summed by source and bucket of the hash's leading
bits, the bucket in which the running sum crosses the budget is refined by the
next bits, and only its documents are read again, until it holds one hash
value. Thresholds of growing budgets are nested: a larger budget takes all
that a smaller one takes.

Hashes come from the id alone, so reruns and other partitionings agree.

Defined results
  null text      size 0
  null source    a source of its own, after all others
  null id        hashed as an empty string; null ids stand or fall together
  repeated rows  rows with the same id stand or fall together
  empty table    no rows
  other columns  ignored by mix(), kept by apply_mix()
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.llm.common import WORD, fresh, materialize, word_count

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: No source is taken more often than this.
MAX_EPOCHS = 3
#: Bits of the hash, and how many of them each refinement looks at.
HASH_BITS, LEVEL_BITS = 60, 12


def hash60(id_col: Column) -> Column:
    """The leading 60 bits of the md5 of the id as text."""
    return F.conv(F.substring(F.md5(F.coalesce(id_col.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) from (source, size): weighted shares of all words, capped at max_epochs times a source's size.

    What a cap leaves over goes to the sources below theirs, by weight, until none is above: with sources in order of cap/weight
    those capped come first, and the level of the others follows from running sums. The windows run over one row a source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everyone, order = Window.partitionBy(F.lit(0)), Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("cap", F.lit(float(max_epochs)) * F.col("source_size"))
    by_cap = Window.partitionBy(F.lit(0)).orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    capped = F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    others = F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = (F.sum("source_size").over(everyone).cast("double") - capped) / others
    # The level at a row supposes that all rows before it are capped; the first row whose cap isn't below it sets the level of all from there on.
    per = per.withColumn("level", level).withColumn("fits", F.col("cap") >= F.col("level") * F.col("weight"))
    held = F.min(F.when(F.col("fits"), F.struct((F.col("cap") / F.col("weight")).alias("r"), F.col("source").isNull().alias("n"), F.col("source").alias("s"), F.col("level").alias("level")))).over(everyone)["level"]
    target = F.least(F.col("cap"), F.coalesce(held, F.lit(float("inf"))) * F.col("weight"))
    return per.select("source", "source_size", F.round(F.coalesce(target, F.lit(0.0)), 6).alias("target"))


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, threshold): a document is below it if its hash is less. sized: (source, size, hash); budgets: (source, rest), in words.

    Each level sums by source and bucket, at most 2**LEVEL_BITS rows a source, and keeps the bucket in which the sum reaches the rest.
    The last bucket holds one hash value; it is taken if that comes nearer to the budget.
    """
    at = budgets.select(F.col("source").alias("b_source"), F.col("rest").cast("double").alias("rest"), F.lit(0).cast("bigint").alias("prefix"))
    done = None
    for level in range(HASH_BITS // LEVEL_BITS):
        shift = HASH_BITS - LEVEL_BITS * (level + 1)
        inside = sized.join(at, _same(F.col("source"), F.col("b_source")) & (F.shiftright("hash", shift + LEVEL_BITS) == F.col("prefix")))
        sums = inside.groupBy("b_source", "rest", F.shiftright("hash", shift).alias("bucket")).agg(F.sum("size").alias("words"), F.min("hash").alias("lo"), F.max("hash").alias("hi"))
        run = Window.partitionBy("b_source").orderBy("bucket")
        sums = sums.withColumn("before", F.sum("words").over(run) - F.col("words"))
        # the first bucket with which the sum passes the rest; rests below the sum of all make sure that there is one
        crossing = sums.where((F.col("before") <= F.col("rest")) & (F.col("before") + F.col("words") > F.col("rest")))
        crossing = materialize(crossing, "mixing")
        single = F.col("lo") == F.col("hi")
        nearer = (F.col("before") + F.col("words") - F.col("rest")) < (F.col("rest") - F.col("before"))
        found = crossing.where(single).select(F.col("b_source").alias("source"), F.when(nearer, F.col("lo") + 1).otherwise(F.col("lo")).alias("threshold"))
        done = found if done is None else done.unionByName(found)
        open_ = crossing.where(~single)
        if open_.isEmpty():
            break
        at = open_.select("b_source", (F.col("rest") - F.col("before")).alias("rest"), F.col("bucket").alias("prefix"))
    return done


def mix_plan(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target, times, threshold), one row a source, from (source, size, hash)."""
    per = materialize(source_targets(sized, weights, max_epochs), "targets")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    budgets = per.withColumn("times", whole.cast("bigint")).withColumn("rest", F.col("target") - F.col("times") * F.col("source_size"))
    cut = thresholds(sized, budgets.where(F.col("rest") > 0).select("source", "rest")).withColumnRenamed("source", "c_source")
    plan = budgets.join(cut, _same(F.col("source"), F.col("c_source")), "left").select("source", "source_size", "target", "times", F.coalesce("threshold", F.lit(-1)).alias("threshold"))
    return materialize(plan, "plan")


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    size = word_count(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").alias("source"), size.alias("size"), hash60(F.col(f"`{id_col}`")).alias("hash"))


def mix(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(id, size, source_size, target, taken, times) of each row; taken counts words with repeats: size times the number of times the mix holds the row."""
    sized = materialize(_sized(docs, id_col, text_col, source_col), "sizes")
    plan = mix_plan(sized, weights, max_epochs).withColumnRenamed("source", "p_source")
    out = sized.join(plan, _same(F.col("source"), F.col("p_source")))
    times = F.col("times") + F.when(F.col("hash") < F.col("threshold"), 1).otherwise(0)
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", (F.col("size") * times).cast("bigint").alias("taken"), times.cast("int").alias("times"))


#: Plans of so many sources are sent to all tasks; with more of them rows meet their source's row by a shuffle.
SENT_SOURCES = 100_000


def apply_mix(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mix itself: each row of docs as often as it is taken, with all its columns. A row is decided by its own hash and its source's plan, so texts stay where they are."""
    source, at, times, copy = fresh(docs, "source", "threshold", "times", "copy")
    plan = mix_plan(materialize(_sized(docs, id_col, text_col, source_col), "sizes"), weights, max_epochs)
    plan = plan.select(F.col("source").alias(source), F.col("threshold").alias(at), F.col("times").alias(times))
    if plan.count() <= SENT_SOURCES:
        plan = F.broadcast(plan)
    out = docs.join(plan, _same(F.col(f"`{source_col}`"), F.col(source)))
    taken = F.col(times) + F.when(hash60(F.col(f"`{id_col}`")) < F.col(at), 1).otherwise(0)
    out = out.withColumn(times, taken.cast("int")).where(F.col(times) > 0)
    return out.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*[F.col(f"`{c}`") for c in docs.columns])


def op4_source_mix(spark, sf_dir: str) -> DataFrame:
    """All documents, mixed by source: 100% of all words, weights 5, 2, 1 repeating, at most 3 times a source."""
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text", "source").drop("times")


ORACLE = f"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS hash FROM documents),
per AS (
  SELECT *, {float(MAX_EPOCHS)}::DOUBLE * source_size AS cap, sum(source_size) OVER ()::DOUBLE AS total
  FROM (SELECT source, sum(size)::BIGINT AS source_size, ([{", ".join(map(str, WEIGHTS))}]::DOUBLE[])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1] AS weight FROM sized GROUP BY source)),
step AS (
  SELECT 0 AS k, (SELECT max(total) / sum(weight) FROM per) AS level
  UNION ALL
  SELECT k + 1, (SELECT (max(total) - coalesce(sum(cap) FILTER (cap < step.level * weight), 0)) / sum(weight) FILTER (cap >= step.level * weight) FROM per)
  FROM step WHERE k < 64),
targets AS (SELECT source, source_size, round(least(cap, (SELECT level FROM step WHERE k = 64) * weight), 6) AS target FROM per),
rests AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS times FROM targets),
running AS (
  SELECT doc_id, hash, s.size, r.source_size, r.target, r.times, r.target - r.times * r.source_size AS rest,
    sum(s.size) OVER (PARTITION BY s.source ORDER BY hash RANGE UNBOUNDED PRECEDING) AS upto,
    sum(s.size) OVER (PARTITION BY s.source, hash) AS own
  FROM sized s JOIN rests r ON s.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target,
  (size * (times + CASE WHEN rest > 0 AND (upto <= rest OR (upto - own <= rest AND upto - rest < rest - (upto - own))) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM running
"""
