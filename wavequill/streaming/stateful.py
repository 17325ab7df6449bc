"""Streaming counterparts of the stateful operators. Event times must be timestamps with a zone."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def tumbling_mean(stream: DataFrame, ts: str, value: str, size: str, late: str, keys: tuple[str, ...] = ()) -> DataFrame:
    found = stream.withWatermark(ts, late).groupBy(F.window(ts, size), *keys).agg(F.avg(value).alias("mean"), F.count(F.lit(1)).alias("n"))
    return found.select(F.col("window.start").alias("start"), *keys, "mean", "n")


def sliding_mean(stream: DataFrame, ts: str, value: str, size: str, hop: str, late: str, keys: tuple[str, ...] = ()) -> DataFrame:
    found = stream.withWatermark(ts, late).groupBy(F.window(ts, size, hop), *keys).agg(F.avg(value).alias("mean"), F.count(F.lit(1)).alias("n"))
    return found.select(F.col("window.start").alias("start"), *keys, "mean", "n")


def quiet_sessions(stream: DataFrame, ts: str, gap: str, late: str, keys: tuple[str, ...]) -> DataFrame:
    """Runs of events that lie closer than `gap`."""
    found = stream.withWatermark(ts, late).groupBy(F.session_window(ts, gap), *keys).agg(F.count(F.lit(1)).alias("n"))
    return found.select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("stop"), *keys, "n")


def sidechain_stream(stream: DataFrame, key: str, order: str, level: str, threshold: float, reduction: float, attack: float, release: float) -> DataFrame:
    """The sidechain recurrence with its gain kept as state; each batch's samples are taken in order."""
    kinds = {f.name: f.dataType.simpleString() for f in stream.schema}

    def run(name: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(parts)).sort_values(order)  # one key's rows of one batch
        g = state.get[0] if state.exists else 1.0
        gains = []
        for on in rows[level].to_numpy() > threshold:
            g = attack * g + (1 - attack) * reduction if on else release * g + (1 - release)
            gains.append(g)
        state.update((g,))
        yield pd.DataFrame({key: name[0], order: rows[order], "gain": gains})

    return stream.groupBy(key).applyInPandasWithState(run, f"{key} {kinds[key]}, {order} {kinds[order]}, gain double", "gain double", "append", GroupStateTimeout.NoTimeout)


def resumable_jobs(spark: SparkSession, jobs: str, schema: str, key: str, done: str, work, checkpoint: str) -> StreamingQuery:
    """Works through JSON job files as they come. `work` turns a batch of jobs that aren't done into results with the same
    key, which are appended to the Parquet table in `done`. A batch that is repeated after a failure leaves out what is in
    the table, so every job is done once."""

    def run(batch: DataFrame, number: int) -> None:
        where = spark._jvm.org.apache.hadoop.fs.Path(done)
        todo = batch.dropDuplicates([key])
        if where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
            todo = todo.join(spark.read.parquet(done).select(key), key, "left_anti")
        work(todo).write.mode("append").parquet(done)

    return spark.readStream.schema(schema).json(jobs).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
