import random

from pyspark.sql import functions as F

from wavequill.operators import envelopes, timeline


def test_interpolation_in_cells(spark):
    """Cells of any width give what whole scenes give, also where cells have no points, and for scenes without a name."""
    r = random.Random(4)
    scenes = [None, "a", "b", "c"]
    frames = spark.createDataFrame([(s, float(r.randrange(400))) for s in scenes for _ in range(60)], "scene string, at double").distinct()
    spots = {s: r.sample(range(400), n) for s, n in zip(scenes, (7, 30, 1, 0), strict=True)}
    points = spark.createDataFrame([(s, float(x), r.random()) for s in scenes for x in spots[s]], "scene string, at double, v double")
    rows = lambda cell: sorted(map(tuple, envelopes.interpolated(frames, points, ["scene"], "at", "v", cell).collect()), key=repr)
    whole = rows(None)
    assert len(whole) == frames.count() and {v for s, _, v in whole if s == "c"} == {1.0}
    assert all(rows(cell) == whole for cell in (1.0, 13.0, 1000.0))


def test_normalised_times_of_scenes(spark):
    rows = [(None, 5.0, "x"), (None, 20.0, "x"), ("a", 4.0, "x"), ("a", None, "x"), ("b", None, "y")]
    got = timeline.normalised_times(spark.createDataFrame(rows, "scene string, t double, top string"), ["scene"], "t", F.lit(10.0))
    assert got.columns == ["scene", "t", "top", "at"]
    # 20 is beyond 10: all times of that scene shrink by 9 / 20
    assert sorted(((r.scene, r.t, r["at"]) for r in got.collect()), key=repr) == sorted([(None, 5.0, 2.25), (None, 20.0, 9.0), ("a", 4.0, 4.0), ("a", None, 0.0), ("b", None, None)], key=repr)
