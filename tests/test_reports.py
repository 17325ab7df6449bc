"""Whole scene reports and their roll-up on made-up scenes, one a rule."""

import pytest

from wavequill.operators import levels

SCENES = ["good", "bare", "flat", "sum", "nosum", "stored", "quiet", "loud", "clip", "spread", "zeros", "dczeros", "nan", "silent", "allowed"]


@pytest.fixture(scope="module")
def reports(spark):
    scenes = spark.createDataFrame([(s, s != "bare", s != "flat", 0.5 if s == "stored" else 0.0, "balanced") for s in SCENES], "scene string, has_metadata boolean, has_linear boolean, stored_error double, scene_type string")
    stem = lambda s: (s, "music" if s == "allowed" else "speech", -90.0 if s in ("silent", "allowed") else -20.0, 0.02 if s == "dczeros" else float("nan") if s == "nan" else 0.0, s == "nan", 48_001 if s in ("zeros", "dczeros") else 48_000)
    stems = spark.createDataFrame([stem(s) for s in SCENES], "scene string, stem string, rms_db double, dc_offset double, has_bad boolean, longest long")
    sums = spark.createDataFrame([(s, 1e-3 if s == "sum" else 0.0) for s in SCENES if s != "nosum"], "scene string, error double")
    mixes = spark.createDataFrame([(s, {"quiet": -35.1, "loud": -9.9, "good": -35.0}.get(s, -20.0), 0.1 if s == "clip" else -1.0) for s in SCENES], "scene string, lufs double, true_peak_db double")
    durations = spark.createDataFrame([(s, s != "spread") for s in SCENES], "scene string, matches boolean")
    return levels.scene_reports(scenes, stems, sums, mixes, durations, ["scene"])


def test_every_rule(reports):
    got = {r.scene: r for r in reports.collect()}
    said = {s: [f"{e.check}:{e.reason}" for e in got[s].errors] for s in SCENES}
    want = {"bare": ["metadata:missing"], "flat": ["structure:missing"], "sum": ["additivity:sum_differs"], "nosum": ["additivity:sum_differs"], "quiet": ["loudness:too_quiet"], "loud": ["loudness:too_loud"], "clip": ["loudness:clipping"], "spread": ["duration:mismatch"], "dczeros": ["corruption_speech:dc_offset", "corruption_speech:long_silence"], "nan": ["corruption_speech:nan_or_inf"], "silent": ["corruption_speech:silent"]}
    assert said == {s: want.get(s, []) for s in SCENES} and all(got[s].is_valid == (s not in want) for s in SCENES)
    assert {s: [e.check for e in got[s].warnings] for s in SCENES if got[s].warnings} == {"stored": ["additivity_stored"], "zeros": ["corruption_speech"]}


def test_roll_up(reports):
    r = levels.report_roll_up(reports).first()
    assert (r.total, r.valid, r.invalid, r.with_warnings, r.pass_rate) == (15, 4, 11, 2, 4 / 15)
    assert r.error_counts == {"metadata": 1, "structure": 1, "additivity": 2, "loudness": 3, "duration": 1, "corruption_speech": 4}
    assert (r.lufs_min, r.lufs_max, r.peak_max, r.additivity_max) == (-35.1, -9.9, 0.1, 1e-3)
    empty = levels.report_roll_up(reports.limit(0)).first()
    assert (empty.total, empty.pass_rate, empty.error_counts, empty.lufs_mean) == (0, 0.0, {}, None)


def test_a_sample_that_is_no_number_ends_a_run_of_zeros(spark):
    nan = float("nan")
    rows = [("a", 0, [1.0, 0.0, 0.0], [0.0, 0.0, 0.0]), ("a", 3, [0.0, nan, 0.0], [0.0, 0.0, 0.0]), ("b", 0, [0.0, 0.0, 0.0], [0.0, nan, 0.0]), ("c", 0, [0.0, 0.0], [0.0, 0.0])]
    blocks = spark.createDataFrame(rows, "k string, start long, left array<double>, right array<double>")
    assert {r.k: r.longest for r in levels.longest_quiet(blocks, ["k"]).collect()} == {"a": 3, "b": 1, "c": 2}
