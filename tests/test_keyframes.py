"""Keyframes reach the end of their scene."""

from wavequill.operators import envelopes


def test_last_sample_is_a_keyframe(spark):
    samples = spark.createDataFrame([(k, i / 100, i, g) for k, n, g in (("steady", 300, 0.5), ("mute", 300, 0.0), ("short", 2, 0.5), ("bare", 50, 1.0)) for i in range(n)], "scene string, at double, i long, gain double")
    points = spark.createDataFrame([("steady", 0.0, -6.0), ("mute", 0.0, -120.0), ("short", 0.0, -6.0)], "scene string, at double, db double")
    got = sorted((r.scene, r.at, round(r.db, 2)) for r in envelopes.with_ends(points, samples, ["scene"], "at", "gain", "db", ["i"]).collect())
    assert got == [("bare", 0.49, 0.0), ("mute", 0.0, -120.0), ("mute", 2.99, -120.0), ("short", 0.0, -6.0), ("steady", 0.0, -6.0), ("steady", 2.99, -6.02)]
