"""The best look of each epoch from a stream in which looks come late.

State is the best look so far of a key, epoch and salt, and how many it stands
for. Keys of an epoch are dealt into parts; a part's bests are one value of the
state, folded with a batch's looks as a table, so a batch costs calls by parts
and not by keys. A timer at the epoch's end gives them out and clears them, so
state holds open epochs only. A look whose epoch had ended by the watermark isn't
dropped: it is given out as late, goes to a table of its own, and `with_late`
merges it into what was delivered, touching the epochs that it belongs to.

The watermark of a batch is the greatest time of all batches before it, less
the delay. The stateful step reads time as a number, which carries no
watermark, so that late looks reach it; Spark still keeps the watermark.

Defined results
  null time or score  no candidate, neither kept nor late
  equal scores        the least order columns win
  null keys           a key like any other, of every type without parts of its own
  hot keys            salts split a key's looks over tasks; `closed` joins them
  open epochs         stay in the state until the watermark passes their end
  restarts            a batch that is run again replaces its own folder
  empty stream        no rows
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import IntegerType, StructField, StructType

FINAL, LATE = "final", "late"


def scratch(spark: SparkSession, name: str) -> str:
    """A folder that driver and executors share: under spark.checkpoint.dir, or a temporary one where all is one machine."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base.rstrip('/')}/{name}-{spark.sparkContext.applicationId}-{spark._jvm.java.util.UUID.randomUUID().toString()}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("a cluster needs spark.checkpoint.dir")
    return tempfile.mkdtemp(prefix=f"{name}-")


def _result(rows: DataFrame, columns: Sequence[str]) -> StructType:
    return StructType([*StructType.fromDDL("kind string, epoch_us bigint, score double, n bigint").fields, *[StructField(c, rows.schema[c].dataType) for c in columns]])


def _to_bytes(rows: pd.DataFrame) -> bytes:
    table, sink = pa.Table.from_pandas(rows, preserve_index=False), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _from_bytes(held: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(held).read_all().to_pandas()


def fold(rows: pd.DataFrame, keys: Sequence[str], order: Sequence[str]) -> pd.DataFrame:
    """(keys, score, order, n) of each key's best row, with its rows' n summed."""
    rows = rows.sort_values(["score", *order], ascending=[False, *[True] * len(order)], kind="stable")
    total = rows.groupby(list(keys), sort=False, dropna=False)["n"].transform("sum") if len(keys) else rows["n"].sum()
    made = rows.assign(n=total)
    return made.drop_duplicates(list(keys)) if len(keys) else made.head(1)


def best_or_late(stream: DataFrame, time: str, epoch_days: int, delay: str, keys: Sequence[str], order: Sequence[str], score: str, salts: int = 1, parts: int = 16) -> DataFrame:
    """(kind, epoch_us, score, n, keys, order): final rows as epochs end, late looks as they come. Append mode.

    A batch's looks of one part come as Arrow batches and are folded one after another. parts should grow with the keys of an
    epoch: a part's bests are held in memory while it is folded.
    """
    width = epoch_days * 86_400_000_000
    rows = stream.where(F.col(time).isNotNull() & F.col(score).isNotNull()).withWatermark(time, delay)
    epoch = (F.floor(F.unix_micros(time) / width) * width).cast("bigint")
    salt = F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int")
    part = F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int") if keys else F.lit(0)
    kinds, nulls = dict(stream.dtypes), [f"null_{c}" for c in keys]
    # pandas has no integers that may be missing: a flag stands for the null, so that keys stay exact
    filled = [F.coalesce(F.col(c), F.lit("1970-01-01" if kinds[c].startswith(("date", "timestamp")) else "0").cast(kinds[c])).alias(c) for c in keys]
    flags = [F.col(c).isNull().alias(x) for c, x in zip(keys, nulls, strict=True)]
    narrow = rows.select(epoch.alias("epoch_us"), part.alias("part"), salt.alias("salt"), F.col(score).cast("double").alias("score"), *filled, *flags, *order)
    by, names = [*keys, *nulls], list(order)
    out = _result(narrow, [*by, *order])
    columns = [*by, "score", *names, "n"]

    class Best(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle, self.best = handle, handle.getValueState("best", "held binary")

        def _given(self, key, kind: str, found: pd.DataFrame) -> pd.DataFrame:
            return found.assign(kind=kind, epoch_us=int(key[0]))[out.fieldNames()]

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            end_ms = (int(key[0]) + width) // 1000
            if end_ms <= timerValues.getCurrentWatermarkInMs():
                for some in rows:
                    yield self._given(key, LATE, some.assign(n=1))
                return
            old = self.best.exists()
            held = _from_bytes(bytes(self.best.get()[0])) if old else None
            for some in rows:
                now = some.assign(n=1)[columns]
                held = fold(now if held is None else pd.concat([held, now], ignore_index=True), by, names)
            self.best.update((_to_bytes(held),))
            if not old:
                self.handle.registerTimer(end_ms)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            yield self._given(key, FINAL, _from_bytes(bytes(self.best.get()[0])))
            self.best.clear()

        def close(self) -> None:
            pass

    made = narrow.groupBy("epoch_us", "part", "salt").transformWithStateInPandas(Best(), out, "append", "EventTime")
    shown = [F.when(~F.col(x), F.col(c)).alias(c) for c, x in zip(keys, nulls, strict=True)]
    return made.select("kind", "epoch_us", "score", "n", *shown, *order)


#: State of timers and of many keys lies on disk, not in the executors' heap.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run(given: DataFrame, path: str, checkpoint: str, tasks: int | None = None) -> DataFrame:
    """All that has arrived, written by batch under path; returns (best_or_late's columns, batch).

    tasks: how many hold the state, Spark's shuffle partitions if not given. Each opens its store and a Python worker in every
    batch, so there should be no more than the looks need. A checkpoint keeps the number it began with.
    """
    conf = given.sparkSession.conf
    wanted = {"spark.sql.streaming.stateStore.providerClass": STORE} | ({"spark.sql.shuffle.partitions": str(tasks)} if tasks else {})

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    folder = given.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(given.sparkSession._jsc.hadoopConfiguration()).mkdirs(folder)  # there, even if nothing arrives
    before = {k: conf.get(k) for k in wanted}
    for k, v in wanted.items():
        conf.set(k, v)
    try:
        query = given.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        for k, v in before.items():
            conf.set(k, v)
    return given.sparkSession.read.schema(StructType([*given.schema.fields, StructField("batch", IntegerType())])).option("basePath", path).parquet(path)


def _best(rows: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    top = F.min_by(F.struct("score", *order), F.struct(-F.col("score"), *order)).alias("b")
    return rows.groupBy(*by).agg(top, F.sum("n").alias("n")).select(*by, "n", "b.*")


def closed(result: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """(epoch_us, keys, n, score, order): the delivered best of each key and epoch, its salts joined."""
    return _best(result.where(F.col("kind") == FINAL), ["epoch_us", *keys], order)


def with_late(delivered: DataFrame, late: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """What was delivered, with late looks merged in: only keys and epochs that late looks belong to are made anew and replaced."""
    by, columns = ["epoch_us", *keys], ["epoch_us", *keys, "n", "score", *order]
    touched = late.select(*[F.col(c).alias(f"__{c}") for c in by]).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by]
    met = delivered.select(columns).join(touched, same, "left_semi").unionByName(late.select(columns))
    return delivered.select(columns).join(touched, same, "left_anti").unionByName(_best(met, by, order).select(columns))


def replay(rows: DataFrame, arrived: str, path: str, tasks: int) -> DataFrame:
    """A stream that brings rows again in the order in which they arrived: one file, and so one batch, a value of arrived.

    Times of files are set in that order. Each arrival is written by one task, as it was one delivery.
    """
    spark = rows.sparkSession
    rows.repartition(tasks, arrived).write.mode("overwrite").partitionBy(arrived).parquet(path)
    jvm = spark._jvm.org.apache.hadoop.fs
    files = jvm.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    folders = {p.getPath().getName().split("=", 1)[1]: p.getPath() for p in files.listStatus(jvm.Path(path)) if "=" in p.getPath().getName()}
    for k, name in enumerate(sorted(folders, key=int)):
        for f in files.listStatus(folders[name]):
            files.setTimes(f.getPath(), 1_000_000_000_000 + 1000 * k, -1)
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 1).parquet(path)
