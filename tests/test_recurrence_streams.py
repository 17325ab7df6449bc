"""Streams with state give the rows of the batch operators, over several batches, restarts and disorder."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from wavequill.operators import envelopes
from wavequill.streaming import recurrences

SCHEMA = "user_id long, at timestamp, event_id long, x double"


@pytest.fixture(scope="module")
def stateful(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    recurrences.use_state_store(spark)
    yield spark
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


@pytest.fixture(scope="module")
def samples(stateful):
    """Twelve users' events in three files by time, each in disorder, and an end that moves the watermark on."""
    e = stateful.read.parquet(f"{SF}/events.parquet").filter("user_id <= 12").select("user_id", F.col("ts").cast("timestamp").alias("at"), "event_id", (F.col("value") / 500).alias("x"))
    rows = [tuple(r) for r in e.orderBy("at").collect()]
    random.Random(1).shuffle(rows)
    cut = sorted(r[1] for r in rows)
    third = [[r for r in rows if low <= r[1] < high] for low, high in zip([cut[0], cut[len(cut) // 3], cut[2 * len(cut) // 3]], [cut[len(cut) // 3], cut[2 * len(cut) // 3], cut[-1] + dt.timedelta(1)], strict=True)]
    return third, cut[-1]


def put(folder, number, rows):
    folder.mkdir(exist_ok=True)
    frame = pd.DataFrame(rows, columns=["user_id", "at", "event_id", "x"])
    frame["at"] = pd.to_datetime(frame["at"]).astype("datetime64[us]").dt.tz_localize("UTC")
    frame.to_parquet(folder / f"{number}.parquet")


def run(spark, make, folder, out, check):
    """One start of the query, which takes every file there is, a file a batch."""
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder))
    q = make(stream).writeStream.format("parquet").option("checkpointLocation", str(check)).option("path", str(out)).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(240)


def gains(df, **more):
    return recurrences.gain_stream(df, "user_id", "at", "event_id", "x", "1 hour", 0.5, 0.25, 0.9, 0.99, **more)


def test_gains_equal_the_batch(stateful, samples, tmp_path):
    thirds, end = samples
    for number, rows in enumerate(thirds[:2]):
        put(tmp_path / "in", number, rows)
    run(stateful, gains, tmp_path / "in", tmp_path / "out", tmp_path / "check")
    late = [(1, thirds[0][0][1] - dt.timedelta(days=1), -1, 0.9)]  # long after the watermark: dropped
    put(tmp_path / "in", 2, thirds[2] + late)
    put(tmp_path / "in", 3, [(-1, end + dt.timedelta(days=2), 0, 0.0)])
    put(tmp_path / "in", 4, [(-1, end + dt.timedelta(days=4), 1, 0.0)])
    run(stateful, gains, tmp_path / "in", tmp_path / "out", tmp_path / "check")  # a restart from the checkpoint
    got = {(r.user_id, r.event_id): r.x for r in stateful.read.parquet(str(tmp_path / "out")).filter("user_id >= 0").collect()}
    batch = stateful.createDataFrame([r for t in thirds for r in t], SCHEMA).withColumn("o", F.row_number().over(__import__("pyspark").sql.Window.partitionBy("user_id").orderBy("at", "event_id")))
    numbers = {(r.user_id, r.o): r.event_id for r in batch.collect()}
    want = {(r.user_id, numbers[(r.user_id, r.o)]): r.gain for r in envelopes.sidechain_blocks(batch, "user_id", "o", "x", 0.5, 0.25, 0.9, 0.99).collect()}
    assert got == pytest.approx(want, abs=1e-12) and len(got) == sum(map(len, thirds))


def test_keyframes_equal_the_batch(stateful, samples, tmp_path):
    thirds, end = samples
    for number, rows in enumerate(thirds):
        put(tmp_path / "in", number, [(*r[:3], r[3] * 30) for r in rows])
    put(tmp_path / "in", 8, [(-1, end + dt.timedelta(days=2), 0, 0.0)])
    put(tmp_path / "in", 9, [(-1, end + dt.timedelta(days=4), 1, 0.0)])
    run(stateful, lambda s: recurrences.keyframe_stream(s, "user_id", "at", "event_id", "x", "1 hour", 3.0), tmp_path / "in", tmp_path / "out", tmp_path / "check")
    got = sorted((r.user_id, r.at, round(r.x, 9)) for r in stateful.read.parquet(str(tmp_path / "out")).filter("user_id >= 0").collect())
    batch = stateful.createDataFrame([(*r[:3], r[3] * 30) for t in thirds for r in t], SCHEMA)
    assert got == sorted((r.user_id, r.at, round(r.x, 9)) for r in envelopes.keyframes(batch, ["user_id"], "at", "x", 3.0).collect())


def test_initial_state_and_forgotten_scenes(stateful, tmp_path):
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    put(tmp_path / "in", 0, [(1, day(0), 0, 0.9), (2, day(0), 0, 0.1)])
    put(tmp_path / "in", 1, [(1, day(9), 1, 0.9), (3, day(9), 0, 0.9)])
    put(tmp_path / "in", 2, [(-1, day(30), 0, 0.0)])
    put(tmp_path / "in", 3, [(-1, day(40), 1, 0.0)])
    initial = stateful.createDataFrame([(1, 0.5), (2, 0.25)], "user_id long, last double")
    run(stateful, lambda s: gains(s, idle_ms=5 * 86_400_000, initial=initial), tmp_path / "in", tmp_path / "out", tmp_path / "check")
    got = {(r.user_id, r.event_id): r.x for r in stateful.read.parquet(str(tmp_path / "out")).filter("user_id >= 0").collect()}
    assert got == pytest.approx({(1, 0): 0.9 * 0.5 + 0.025, (2, 0): 0.99 * 0.25 + 0.01, (1, 1): 0.9 + 0.025, (3, 0): 0.9 + 0.025})
