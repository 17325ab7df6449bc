"""From files to files: a scene's stems are read, rendered, written and judged."""

import json

import numpy as np
from pyspark.sql import functions as F

from wavequill.operators import rendering, reports, signals
from wavequill.sinks import committed, files
from wavequill.sources.sound import sound

RATE = 4000


def test_render_and_judge_a_folder(spark, tmp_path):
    r, n = np.random.default_rng(3), 3 * RATE
    speech = 0.3 * r.uniform(-1, 1, n) * (np.arange(n) // 2000 % 2)
    wanted = {("a", "speech"): speech, ("a", "music"): 0.5 * r.uniform(-1, 1, n // 2), ("b", "speech"): speech * 0.5}
    rows = [(f"{scene}/{stem}.wav", i, x[i : i + RATE].tolist(), x[i : i + RATE].tolist()) for (scene, stem), x in wanted.items() for i in range(0, len(x), RATE)]
    committed.save_waves(spark.createDataFrame(rows, "path string, start long, left array<double>, right array<double>"), str(tmp_path / "in"), RATE)
    read = sound(spark, str(tmp_path / "in"), rate=RATE).withColumn("parts", F.split("path", "/"))
    stems = read.select(F.element_at("parts", -2).alias("scene_id"), F.regexp_extract(F.element_at("parts", -1), r"(\w+)", 1).alias("stem"), F.col("start_sample").alias("start"), *[F.col(s).cast("array<double>").alias(s) for s in signals.SIDES]).cache()
    none = spark.createDataFrame([], "scene_id string, idx int, start long, left array<double>, right array<double>")
    found, failures = rendering.render(stems, none, {}, {"music": {"gain_db": -3.0}}, {}, RATE, RATE)
    assert failures.count() == 0
    linear = found["linear"]
    real = lambda df: df.withColumns({s: F.transform(s, lambda x: x / 32768.0) for s in signals.SIDES})
    both = real(linear.stems).select("scene_id", F.concat(F.lit("linear/"), "stem").alias("stem"), "start", *signals.SIDES).unionByName(real(linear.mix).select("scene_id", F.lit("linear/mix").alias("stem"), "start", *signals.SIDES))
    out = str(tmp_path / "out")
    files.write_waves(both, out, RATE)
    scenes = spark.createDataFrame([("a",), ("b",)], "scene_name string")
    document = F.struct(F.lit("sparse").alias("scene_type"), F.struct(F.struct(F.lit(0.0).alias("additivity_error")).alias("linear")).alias("outputs"))
    files.write_documents(scenes, out, "metadata.json", document)
    assert json.loads((tmp_path / "out/a/metadata.json").read_text())["scene_type"] == "sparse"
    judged = {x.scene_name: x for x in reports.folder_reports(spark, out, RATE).collect()}
    assert set(judged) == {"a", "b"}
    for x in judged.values():  # the mix is the exact sum; b is speech alone, the other stems are silent
        assert x.additivity_error < 1e-9 and x.stored_error == 0 and x.scene_type == "sparse" and -40 < x.lufs < -10
    said = {k: sorted((e.check, e.reason) for e in x.errors) for k, x in judged.items()}
    assert said["a"] == [("corruption_ambience", "silent")] and said["b"] == [("corruption_ambience", "silent")]
    assert ("corruption_sfx", "long_silence") not in [(w.check, w.reason) for w in judged["a"].warnings]  # 12000 zeros are no second of 48000
