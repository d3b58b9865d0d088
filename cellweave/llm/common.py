"""What the training-data operators share: table access, shared scratch space, words and packing ids."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import wraps
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of anything but space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"

_OWN_DIRS: dict[str, str] = {}
_SCRATCH: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def session_of(df: DataFrame) -> SparkSession:
    return df.sparkSession


def _remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def release(spark: SparkSession) -> None:
    """Remove all that materialize() wrote in this session; results that still read it can't be read any more. Runs at the session's end, too."""
    for path in [p for p in _SCRATCH if f"/cellweave-{spark.sparkContext.applicationId}" in p]:
        _remove(spark, path)
        _SCRATCH.discard(path)


def _release_at_exit(spark: SparkSession) -> None:
    with contextlib.suppress(Exception):  # a session that was stopped before has nothing left to do it with
        release(spark)


def scratch_dir(spark: SparkSession) -> str:
    """A folder of this session in the one that all executors share: spark.checkpoint.dir. Only a local[...] session without that setting gets a folder of its own."""
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIRS:
        shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
        if not shared:
            if not spark.sparkContext.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            own = tempfile.mkdtemp(prefix="cellweave-")
            atexit.register(shutil.rmtree, own, ignore_errors=True)
            shared = "file://" + own
        _OWN_DIRS[app] = f"{shared.rstrip('/')}/cellweave-{app}"
        _SCRATCH.add(_OWN_DIRS[app])
        atexit.register(_release_at_exit, spark)
    return _OWN_DIRS[app]


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Cut lineage: write df as Parquet to the shared folder and read it back. Survives lost executors; recomputes nothing."""
    spark = session_of(df)
    path = f"{scratch_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(*written: DataFrame | None) -> None:
    """Remove what materialize() wrote for these, once nothing reads it any more."""
    for df in written:
        if df is not None:
            _remove(session_of(df), df.scratch_path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of df has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        own = f"__{name}"
        while own.lower() in taken:
            own += "_"
        taken.add(own.lower())
        out.append(own)
    return out


def row_key(id_col: str, text_col: str) -> Column:
    """One key of a row by its id and text, never null: joins and groupings on it share one shuffle."""
    said = F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit("-"))
    return F.sha2(F.concat_ws(":", F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256), said), 256)


#: Bits of a filter of keys: 16 MB, in 4,096 rows, whatever the number of keys.
FILTER_BITS = 1 << 27


def key_filter(hashes: DataFrame, hash_col: str) -> DataFrame:
    """(bucket, bits) of a column of 64-bit hashes, to be sent to all tasks: it has FILTER_BITS bits at most."""
    spot = F.pmod(F.col(hash_col), F.lit(FILTER_BITS))
    return hashes.groupBy(F.bitmap_bucket_number(spot).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(spot)).alias("bits"))


def with_filter(rows: DataFrame, found: DataFrame, hashed: Column, name: str) -> DataFrame:
    """rows with a column `name`: whether the filter may have the hash. False is certain, true isn't."""
    bucket, bits, spot = fresh(rows, "bucket", "bits", "spot")
    sent = F.broadcast(found.select(F.col("bucket").alias(bucket), F.col("bits").alias(bits)))
    met = rows.withColumn(spot, F.pmod(hashed, F.lit(FILTER_BITS))).join(sent, F.bitmap_bucket_number(F.col(spot)) == F.col(bucket), "left")
    at = F.bitmap_bit_position(F.col(spot))
    byte = F.conv(F.hex(F.substring(F.col(bits), (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return met.withColumn(name, F.coalesce(byte.bitwiseAND(F.pow(F.lit(2), at % 8).cast("int")) > 0, F.lit(False))).drop(bucket, bits, spot)


def rows_of(docs: DataFrame, verdicts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of docs that stay, a repeated row once, with all their columns. verdicts: (key, stay) for each row, key its row_key.

    Only rows that go, or that are there more than once, are a question: a filter of fixed size tells the others, which stay
    where they are. The rest is shuffled and joined with the keys that stay.
    """
    verdicts = materialize(verdicts, "verdicts")
    doubtful = verdicts.groupBy(F.xxhash64("key").alias("h")).agg(F.count("*").alias("n"), F.bool_and("stay").alias("all")).where("n > 1 OR NOT all")
    own, doubt, stay = fresh(docs, "row", "doubt", "stay")
    marked = with_filter(docs.withColumn(own, row_key(id_col, text_col)), materialize(key_filter(doubtful, "h"), "filter"), F.xxhash64(F.col(own)), doubt)
    keys = verdicts.where("stay").select(F.col("key").alias(stay))
    rest = marked.where(F.col(doubt)).join(keys, F.col(own) == F.col(stay), "left_semi").dropDuplicates([own])
    names = [F.col(f"`{c}`") for c in docs.columns]
    return marked.where(~F.col(doubt)).select(*names).unionByName(rest.select(*names))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


#: Bytes of the Arrow batches that go to Python workers and back; a session that sets its own keeps it. Texts are long: at Spark's 64 MB, two tasks hold some 400 MB of batches beside the heap.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4194304b"


def reachable(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The query, with this package's folder on the path of the session's Python workers, whatever folder the driver runs in, and batches of BATCH_BYTES."""
    root = str(Path(__file__).resolve().parents[2])

    @wraps(query)
    def run(spark: SparkSession, *args) -> DataFrame:
        env = spark.sparkContext.environment
        if root not in env.get("PYTHONPATH", "").split(os.pathsep):
            env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))
        if spark.conf.get(BATCH_SETTING, "1b") == "1b":
            spark.conf.set(BATCH_SETTING, BATCH_BYTES)
        return query(spark, *args)

    return run


def give_back() -> None:
    """Return what this process has freed to the system: idle workers are kept, and so would be their memory."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # other C libraries do this by themselves
        ctypes.CDLL(None).malloc_trim(0)


def lean(work: Callable) -> Callable:
    """A function over Arrow batches, or over a group, that gives its memory back when it is done."""

    @wraps(work)
    def run(*args, **named):
        out = work(*args, **named)
        if not isinstance(out, Iterator):
            give_back()
            return out

        def batches():
            try:
                yield from out
            finally:
                give_back()

        return batches()

    return run
