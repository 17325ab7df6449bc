"""The ranged source reads what it must, the committing writer shows all or nothing."""

import os
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from wavequill.sinks import committed
from wavequill.sources import documents
from wavequill.sources.sound import sound


def store(path, x, rate, channels=1):
    path.parent.mkdir(parents=True, exist_ok=True)
    with wave.open(str(path), "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(np.round(np.repeat(np.asarray(x)[:, None], channels, 1) * 32767).astype("<i2").tobytes())


def test_headers_cost_a_few_bytes(spark, tmp_path):
    for k in range(5):
        store(tmp_path / f"d{k % 2}/{k}.wav", np.zeros(100_000 * (k + 1)), 8000)
    (tmp_path / "odd.wav").write_bytes(b"RIFF")
    found = {r.path.rsplit("/", 1)[1]: r for r in sound(spark, str(tmp_path), content="headers").collect()}
    assert {k: r.seconds for k, r in found.items()} == {**{f"{k}.wav": 12.5 * (k + 1) for k in range(5)}, "odd.wav": None}
    assert max(r.bytes_read for r in found.values()) <= 64 and found["odd.wav"].error and found["0.wav"].error is None
    assert sound(spark, str(tmp_path / "none"), content="headers").count() == 0 == documents.wave_blocks(spark, str(tmp_path / "none")).count()


@pytest.mark.parametrize(("own", "rate"), [(8000, 8000), (8000, 12_000), (16_000, 8000)])
def test_slices_cost_their_own_bytes(spark, tmp_path, own, rate):
    x = 0.5 * np.sin(2 * np.pi * 300 * np.arange(own * 60) / own)
    store(tmp_path / "a.wav", x, own, 2)
    whole = {r.block_no: r for r in sound(spark, str(tmp_path), rate=rate, split_mb=0.1).collect()}
    assert len(whole) == 60 and sum(len(r.left) for r in whole.values()) == 60 * rate
    part = sorted(sound(spark, str(tmp_path), rate=rate, start=10.25, stop=12.5).collect(), key=lambda r: r.block_no)
    assert [(r.block_no, r.start_sample, len(r.left)) for r in part] == [(10, 10 * rate + rate // 4, rate * 3 // 4), (11, 11 * rate, rate), (12, 12 * rate, rate // 2)]
    for r in part:
        at = r.start_sample - r.block_no * rate
        assert np.allclose(r.left, whole[r.block_no].left[at : at + len(r.left)], atol=1e-6)
    assert sum(r.bytes_read for r in part) < 1.2 * 2.25 * own * 4 + 4 * 4 * 400


def test_long_files_are_read_by_several_tasks(spark, tmp_path):
    store(tmp_path / "a.wav", np.zeros(8000 * 100), 8000)
    df = sound(spark, str(tmp_path), rate=8000, split_mb=0.25)
    assert df.rdd.getNumPartitions() >= 6 and sorted(r.block_no for r in df.select("block_no").collect()) == list(range(100))


def test_filters_reach_the_source(spark, tmp_path):
    store(tmp_path / "a.wav", np.zeros(8000 * 30), 8000)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        df = sound(spark, str(tmp_path), rate=8000, pushdown="true").filter("start_sample >= 80000 AND start_sample < 104000")
        assert sorted(r.block_no for r in df.collect()) == [10, 11, 12]
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def names(root):
    return sorted(os.path.relpath(os.path.join(d, f), root) for d, _, fs in os.walk(root) for f in fs if not f.endswith(".crc"))


def test_all_or_nothing(spark, tmp_path):
    root = str(tmp_path / "out")
    rows = spark.range(20).select(F.format_string("s%d/plan.json", "id").alias("path"), F.format_string("{%d}", "id").alias("content")).repartition(4)
    committed.save_files(rows, root)
    assert names(root) == sorted(["_SUCCESS", *(f"s{k}/plan.json" for k in range(20))]) and (tmp_path / "out/s7/plan.json").read_text() == "{7}"
    bad = rows.withColumn("path", F.when(F.col("path") == "s13/plan.json", F.lit("../out")).otherwise(F.concat(F.lit("new/"), "path")))
    with pytest.raises(Exception, match="not a name"):
        committed.save_files(bad, root)
    assert not [n for n in names(root) if "new" in n or "staging" in n]
    with pytest.raises(Exception, match="two tasks"):
        committed.save_files(rows.unionByName(rows.withColumn("path", F.lit("s1/plan.json"))), root)
    assert not [n for n in names(root) if "staging" in n]
    committed.save_files(rows.limit(1), root, overwrite=True)
    assert len(names(root)) == 2


def test_a_repeated_task_leaves_one_file(tmp_path):
    """Two attempts of a task: only what the reported one wrote is moved."""
    import pyarrow as pa

    sink = committed.FileWriter({"path": str(tmp_path)}, False)
    batch = pa.RecordBatch.from_pydict({"path": ["a/x"], "content": [b"1"]})
    lost, told = sink.write(iter([batch])), sink.write(iter([pa.RecordBatch.from_pydict({"path": ["a/x"], "content": [b"2"]})]))
    assert names(tmp_path) and all(n.startswith("_staging") for n in names(tmp_path))
    sink.commit([told, None])
    assert names(tmp_path) == ["_SUCCESS", "a/x"] and (tmp_path / "a/x").read_bytes() == b"2" and lost.files != told.files


def test_waves_with_holes(spark, tmp_path):
    rows = [("m/a.wav", 0, [0.5] * 10, [-0.5] * 10), ("m/a.wav", 30, [0.25] * 5, [2.0] * 5), ("b.wav", 5, [0.1], [0.1])]
    committed.save_waves(spark.createDataFrame(rows, "path string, start long, left array<double>, right array<double>"), str(tmp_path), 100)
    with wave.open(str(tmp_path / "m/a.wav")) as w:
        x = np.frombuffer(w.readframes(w.getnframes()), "<i2").reshape(-1, 2)
        assert w.getframerate() == 100 and len(x) == 35 and x[0].tolist() == [16384, -16384] and not x[10:30].any() and x[30].tolist() == [8192, 32767]
    over = spark.createDataFrame([("c.wav", 0, [0.1] * 5, [0.1] * 5), ("c.wav", 3, [0.1], [0.1])], "path string, start long, left array<double>, right array<double>")
    with pytest.raises(Exception, match="overlap"):
        committed.save_waves(over, str(tmp_path), 100)
    assert names(tmp_path) == ["_SUCCESS", "b.wav", "m/a.wav"]
