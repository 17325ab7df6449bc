"""Every scene query against its own SQL on DuckDB."""

import glob
import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from wavequill.operators import envelopes
from wavequill.plans import file_queries, planning_queries, signal_queries, sound_queries, speech_queries  # noqa: F401 (they register themselves)
from wavequill.plans.queries import QUERIES, SQL
from wavequill.sources import documents
from wavequill.streaming import stateful


def rows(frame):
    frame = frame[sorted(frame.columns)]
    plain = lambda v: None if v is None or v != v else round(float(v), 5) if isinstance(v, (float, np.floating)) else int(v) if isinstance(v, (int, np.integer, np.bool_)) else v
    return sorted(repr([plain(v) for v in r]) for r in frame.astype(object).itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, duck, name):
    assert rows(QUERIES[name](spark, SF).toPandas()) == rows(duck.execute(SQL[name]).fetchdf())


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_affine_scan_matches_the_loop():
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 4096, 10_000):
        c, d, g, want = rng.random(n), rng.random(n), 1.0, []
        for a, b in zip(c, d):
            g = a * g + b
            want.append(g)
        assert np.allclose(envelopes.affine_scan(c, d, 1.0), want)


def test_block_scan_matches_the_fold(spark):
    e = spark.read.parquet(f"{SF}/events.parquet").select("user_id", "event_id", (F.col("value") / 500).alias("x"))
    fold = {r.user_id: r.last_gain for r in envelopes.sidechain(e, ["user_id"], ["event_id"], "x", 0.5, 0.25, 0.9, 0.99).collect()}
    whole = envelopes.sidechain_blocks(e, "user_id", "event_id", "x", 0.5, 0.25, 0.9, 0.99).toPandas()
    last = whole.sort_values("event_id").groupby("user_id")["gain"].last()
    assert len(last) == len(fold) and all(abs(last[k] - v) < 1e-12 for k, v in fold.items())


def test_stream_keeps_gain(spark, tmp_path):
    e = spark.read.parquet(f"{SF}/events.parquet").select("user_id", "event_id", (F.col("value") / 500).alias("x"))
    e.repartitionByRange(2, "event_id").sortWithinPartitions("event_id").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(e.schema).parquet(str(tmp_path / "in"))
    q = stateful.sidechain_stream(stream, "user_id", "event_id", "x", 0.5, 0.25, 0.9, 0.99).writeStream.format("memory").queryName("gains").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("gains").count() == e.count()


def test_envelope_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"sample_rate": 48000, "duration_sec": 1.5, "envelopes": {"music": {"description": "d", "keyframes": [{"time": 0.0, "gain": 1.0, "gain_db": 0.0}]}}}')
    (tmp_path / "b.json").write_text("not json")
    found = documents.keyframes_of(documents.json_documents(spark, str(tmp_path), documents.ENVELOPES)).collect()
    assert [(r.stem, r.time, r.gain) for r in found] == [("music", 0.0, 1.0)]
