"""Streams give what batches give."""

import json

from pyspark.sql import functions as F

from tests.conftest import SF
from wavequill.streaming import stateful


def events(spark):
    return spark.read.parquet(f"{SF}/events.parquet").withColumn("at", F.col("ts").cast("timestamp"))


def stream(spark, tmp_path, name):
    events(spark).repartition(3).write.parquet(str(tmp_path / name))
    return spark.readStream.schema(events(spark).schema).parquet(str(tmp_path / name))


def finished(found, tmp_path, name, mode="append"):
    spark = found.sparkSession
    q = found.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / f"c-{name}")).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name)


def test_windows(spark, tmp_path):
    e, s = events(spark), stream(spark, tmp_path, "in")
    for name, size, hop in (("tumbling", "1 day", None), ("sliding", "3 days", "1 day")):
        make = (lambda df: stateful.tumbling_mean(df, "at", "value", "1 day", "0 seconds")) if hop is None else (lambda df: stateful.sliding_mean(df, "at", "value", "3 days", "1 day", "0 seconds"))
        got = {r.start: (r.n, r["mean"]) for r in finished(make(s), tmp_path, name).collect()}
        want = {r.start: (r.n, r["mean"]) for r in make(e).collect()}
        assert got and all(want[k][0] == v[0] and abs(want[k][1] - v[1]) < 1e-5 for k, v in got.items()) and len(want) - len(got) <= 4  # the last windows stay open


def test_sessions(spark, tmp_path):
    make = lambda df: stateful.quiet_sessions(df, "at", "6 hours", "0 seconds", ("event_type",))
    got = {(r.start, r.event_type): r.n for r in finished(make(stream(spark, tmp_path, "in")), tmp_path, "sessions").collect()}
    want = {(r.start, r.event_type): r.n for r in make(events(spark)).collect()}
    assert got and all(want[k] == v for k, v in got.items())


def test_jobs_are_done_once(spark, tmp_path):
    (tmp_path / "jobs").mkdir()
    put = lambda n, keys: (tmp_path / "jobs" / f"{n}.json").write_text("\n".join(json.dumps({"k": k}) for k in keys))
    work = lambda df: df.withColumn("result", F.col("k") * 10)
    run = lambda: stateful.resumable_jobs(spark, str(tmp_path / "jobs"), "k long", "k", str(tmp_path / "done"), work, str(tmp_path / "check")).awaitTermination()
    put("a", [1, 2, 2])
    run()
    put("b", [2, 3])
    run()
    run()
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "done")).collect())) == [(1, 10), (2, 20), (3, 30)]
