"""Nested bins against all pairs; statistics that the writing pass collects."""

import os
import random
import subprocess
import sys

from pyspark.sql import functions as F

from wavequill import storage
from wavequill.operators import timeline
from wavequill.sinks import observed

SPAN = "id long, k string, start long, stop long"


def test_nested_bins_find_every_pair_once(spark):
    rng = random.Random(4)
    make = lambda n: [(i, rng.choice("ab"), s := rng.randrange(-500, 20_000), s + rng.choice([1, 2, 7, 60, 64, 65, 1000, 15_000])) for i in range(n)]
    a, b = make(200), make(150)
    got = timeline.overlapping(spark.createDataFrame(a, SPAN), spark.createDataFrame(b, SPAN), ["k"], 8)
    want = sorted((x[0], y[0]) for x in a for y in b if x[1] == y[1] and x[2] < y[3] and y[2] < x[3])
    assert sorted((r.id, r.id2) for r in got.collect()) == want


def test_a_long_span_has_few_bins(spark):
    long = spark.createDataFrame([(1, "a", 12_345, 12_345 + 8_000_000)], SPAN)
    assert timeline.binned(long, 8).count() <= 3
    assert timeline.binned(long, 8, list(range(30))).count() <= 2 * 11
    assert timeline.overlapping(long.limit(0), long, ["k"], 8).count() == 0


def test_writing_counts_what_it_writes(spark, tmp_path):
    files = spark.range(100).select((F.col("id") % 10 != 3).alias("ok"), F.col("id").cast("double").alias("size_mb"))
    assert observed.upload_run(files, str(tmp_path / "a")) == {"uploaded": 90, "failed": 10, "size_mb": float(sum(i for i in range(100) if i % 10 != 3)), "success_rate": 0.9, "deletes": False}
    assert spark.read.parquet(str(tmp_path / "a")).count() == 100
    assert observed.upload_run(files.limit(0), str(tmp_path / "b")) == {"uploaded": 0, "failed": 0, "size_mb": 0.0, "success_rate": 0.0, "deletes": True}
    kinds = spark.range(8).select(F.when(F.col("id") < 5, "x").when(F.col("id") < 7, "y").alias("kind"))
    assert observed.class_shares(kinds, str(tmp_path / "c"), "kind", ["y", "x", "z"]) == [("x", 5, 500 / 7), ("y", 2, 200 / 7), ("z", 0, 0.0)]


RETRIED = """
import sys
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
from wavequill.sinks import observed
spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").getOrCreate()

def once(parts):
    for part in parts:
        yield part
    if TaskContext.get().partitionId() == 1 and TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("lost")

rows = spark.range(0, 100, 1, 4).select(F.lit(True).alias("ok"), F.lit(1.0).alias("size_mb")).mapInPandas(once, "ok boolean, size_mb double")
print("SEEN", observed.upload_run(rows, sys.argv[1]))
"""


def test_a_repeated_task_counts_once(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", RETRIED, str(tmp_path / "out")], cwd=root, env=os.environ | {"PYTHONPATH": root}, capture_output=True, text=True, timeout=240)
    assert "'uploaded': 100, 'failed': 0, 'size_mb': 100.0" in done.stdout and "lost" in done.stderr


def test_intermediate_tables_go_when_released(spark):
    df = storage.kept(spark.range(7).toDF("id"))
    folder = df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert df.count() == 7 and os.path.isdir(folder)
    assert storage.release(spark) >= 1 and not os.path.exists(folder) and storage.release(spark) == 0
