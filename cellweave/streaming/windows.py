"""Streaming forms of epochs and of the running best look. Extensions: batch results never depend on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.streaming.late import scratch


def tumbling(stream: DataFrame, time: str, length: str, late: str, keys: Sequence[str], value: str) -> DataFrame:
    """(window_start, keys, n, total) of fixed windows; rows later than `late` are dropped, which also bounds the state."""
    at = stream.withWatermark(time, late).groupBy(F.window(time, length).alias("w"), *keys)
    return at.agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("window_start"), *keys, "n", "total")


def sliding(stream: DataFrame, time: str, length: str, every: str, late: str, keys: Sequence[str], value: str) -> DataFrame:
    """The same of overlapping windows."""
    at = stream.withWatermark(time, late).groupBy(F.window(time, length, every).alias("w"), *keys)
    return at.agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("window_start"), *keys, "n", "total")


def running_best(stream: DataFrame, time: str, epoch: str, late: str, keys: Sequence[str], order: Sequence[str], score: str) -> DataFrame:
    """(window_start, keys, score, order) of the best look of each epoch so far: one row of state a key and epoch."""
    rank = F.struct(F.col(score).alias("s"), *[(-F.col(c)).alias(f"k{i}") for i, c in enumerate(order)])
    at = stream.where(F.col(score).isNotNull()).withWatermark(time, late).groupBy(F.window(time, epoch).alias("w"), *keys)
    return at.agg(F.max_by(F.struct(score, *order), rank).alias("b")).select(F.col("w.start").alias("window_start"), *keys, "b.*")


def drain(df: DataFrame, name: str, mode: str) -> DataFrame:
    """Run a stream over all that is there and return the result as a table: written by the tasks, no row passes the driver.

    In complete mode a batch holds the whole result, so two folders take turns and the last one written is read.
    """
    spark = df.sparkSession
    path, written = scratch(spark, name), {}

    def write(rows: DataFrame, batch: int) -> None:
        folder = f"{path}/{f'turn-{batch % 2}' if mode == 'complete' else f'batch-{batch}'}"
        rows.write.mode("overwrite").parquet(folder)
        written[batch] = folder

    query = df.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    if not written:
        return spark.createDataFrame([], df.schema)
    return spark.read.schema(df.schema).parquet(*([written[max(written)]] if mode == "complete" else written.values()))
