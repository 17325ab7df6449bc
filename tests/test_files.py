"""Sources and sinks: round trips, missing and broken files."""

import json

import numpy as np
from pyspark.sql import functions as F

from wavequill.operators import planning, signals
from wavequill.sinks import files
from wavequill.sources import documents


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text if isinstance(text, str) else json.dumps(text))


def test_sound_round_trip(spark, tmp_path):
    r = np.random.default_rng(1)
    blocks = [(scene, stem, start, r.uniform(-1, 0.99, n).tolist(), r.uniform(-1, 0.99, n).tolist()) for scene in ("s1", "s2") for stem in ("speech", "sfx") for start, n in ((0, 1000), (1000, 1000), (2000, 77))]
    df = spark.createDataFrame(blocks, "scene_id string, stem string, start long, left array<double>, right array<double>")
    assert sorted(map(tuple, files.write_waves(df, str(tmp_path), 1000).collect())) == [(a, b, 2077) for a in ("s1", "s2") for b in ("sfx", "speech")]
    got = {(x.path.split("/")[-2], x.path.split("/")[-1][:-4], x.start_sample): x for x in documents.wave_blocks(spark, str(tmp_path), 1000).collect()}
    for scene, stem, start, left, right in blocks:
        row = got[(scene, stem, start)]
        assert np.abs(np.array(row.left) - left).max() <= 0.5001 / 32768 and np.abs(np.array(row.right) - right).max() <= 0.5001 / 32768
    found = documents.audio_files(spark, str(tmp_path))
    assert [x.file.split("/")[-1] for x in found.collect()] == ["sfx.wav", "speech.wav"] * 2 and documents.audio_files(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "bad.wav").write_bytes(b"RIFFnothing")
    seconds = {x.path.split("/")[-1]: x.seconds for x in documents.durations(spark, str(tmp_path)).collect()}
    assert seconds["sfx.wav"] == 2.077 and seconds["bad.wav"] is None
    assert {x.seconds for x in documents.durations(spark, str(tmp_path), "bad.wav", 0.0).collect()} == {0.0}


def test_silent_sfx_are_not_exported(spark):
    rows = [("a", "sfx", 0, [0.0], [0.0]), ("a", "speech", 0, [0.0], [0.0]), ("b", "sfx", 0, [0.0], [0.0]), ("b", "sfx", 1, [0.0], [0.5])]
    got = signals.sounding(spark.createDataFrame(rows, "scene_id string, stem string, start long, left array<double>, right array<double>"))
    assert sorted((r.scene_id, r.stem, r.start) for r in got.collect()) == [("a", "speech", 0), ("b", "sfx", 0), ("b", "sfx", 1)]


def test_scene_documents(spark, tmp_path):
    write(tmp_path / "s1/metadata.json", {"scene_type": "sparse", "critic_adjustments": {"speech": {"gain_db": 1}}, "scene_plan": {"gemini_context": {"music_tag": "epic"}}, "outputs": {"linear": {"additivity_error": 0.5}}})
    write(tmp_path / "s1/linear/mix.wav", "x")
    write(tmp_path / "s2/metadata.json", "{broken")
    write(tmp_path / "s3/other.json", {})
    got = {r.scene_name: r for r in documents.scene_documents(spark, str(tmp_path)).collect()}
    assert set(got) == {"s1", "s2"} and got["s1"].has_metadata and got["s1"].has_linear and got["s1"].stored_error == 0.5 and got["s1"].music_tag == "epic"
    assert not got["s2"].has_metadata and not got["s2"].has_linear
    assert documents.json_documents(spark, f"{tmp_path}/*/metadata.json", documents.METADATA).count() == 1
    assert documents.scene_documents(spark, str(tmp_path / "none")).count() == 0


def test_plans_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("s1", "d.wav", 1.5), ("s2", None, None)], "scene_name string, dialogue string, at double")
    job = F.struct(F.col("scene_name"), F.lit("sparse").alias("scene_type"))
    events = F.array(F.struct(F.lit("a.wav").alias("file_path"), F.col("at").alias("timestamp")))
    document = F.struct(job.alias("job"), F.struct("dialogue", events.alias("events")).alias("plan"), F.create_map(F.lit("music"), F.create_map(F.lit("gain_db"), F.lit("-3"))).alias("rough_settings"))
    assert files.write_documents(rows, str(tmp_path), "plan.json", document).count() == 2
    write(tmp_path / "s3/plan.json", {"plan": {}})
    write(tmp_path / "s4/plan.json", "[")
    got = {r.job.scene_name: r for r in documents.plan_documents(spark, str(tmp_path)).collect()}
    assert set(got) == {"s1", "s2"} and got["s1"].plan.events[0].timestamp == 1.5 and got["s2"].plan.dialogue is None and got["s1"].rough_settings["music"]["gain_db"] == "-3"


def test_corpus_index(spark, tmp_path):
    write(tmp_path / "i.json", {"entries": [{"split": "a", "dialogue_id": 1, "utterance_id": u, "file": f"{u}.wav", "speaker": "x"} for u in (3, 1, 2)] + [{"split": "b", "dialogue_id": 1, "utterance_id": 0, "file": "0.wav"}]})
    got = {(r.split, r.dialogue_id): r.utterances for r in documents.dialogue_groups(documents.json_documents(spark, str(tmp_path / "i.json"), documents.MELD), "/r").collect()}
    assert [u.file for u in got[("a", 1)]] == ["/r/1.wav", "/r/2.wav", "/r/3.wav"] and len(got) == 2
    assert documents.dialogue_groups(documents.json_documents(spark, str(tmp_path / "no.json"), documents.MELD), "/r").count() == 0


def test_indices_round_trip(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(1, "a.wav", [1.0, 2.0])], "id long, path string, vec array<float>")
    files.write_index(rows, str(tmp_path / "v"))
    assert documents.vector_index(spark, str(tmp_path / "v")).collect() == rows.collect() and documents.vector_index(spark, str(tmp_path / "w")).count() == 0
    tags = spark.createDataFrame([("b", ["2", "3"]), ("a", ["1"])], "tag string, items array<string>")
    files.write_tag_lookup(tags, str(tmp_path / "t"))
    assert sorted(spark.read.json(str(tmp_path / "t")).collect(), key=str) == sorted(tags.select("items", "tag").collect(), key=str)
    write(tmp_path / "l.json", {"a": ["1"], "b": ["2", "3"]})
    assert sorted(map(tuple, documents.tag_lookup(spark, str(tmp_path / "l.json")).collect())) == [("a", "1"), ("b", "2"), ("b", "3")]
    reports = spark.createDataFrame([("a", False), ("b", True)], "scene_name string, is_valid boolean")
    files.write_failures(reports, str(tmp_path / "f"))
    assert spark.read.json(str(tmp_path / "f")).count() == 1
    monkeypatch.setenv("WAVEQUILL_DATA", "/srv/d")
    assert documents.Places().data_root == "/srv/d" and documents.Places(data="/x").data_root == "/x"


def test_prompt_parts(spark):
    row = spark.range(1).select(planning.event_line(F.lit(2), F.lit(1.25), F.lit("door")).alias("a"), planning.event_line(F.lit(None).cast("int"), F.lit(None).cast("double"), F.lit(None).cast("string")).alias("b")).first()
    assert row.a in ('  - sfx_2 (1.2s): "door"', '  - sfx_2 (1.3s): "door"') and row.b == '  - sfx_0 (0.0s): "unknown sound"'
