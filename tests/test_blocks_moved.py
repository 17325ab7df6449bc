"""Operators that move or sort whole signals no more often than they must, against plain code."""

import bisect
import random

import numpy as np
from pyspark.sql import functions as F

from wavequill import storage
from wavequill.operators import chains, loudness, signals


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_envelopes_sort_chunks_and_not_frames(spark):
    rng = random.Random(5)
    rate, hop, size = 8, 2, 40
    points = [(k, rng.choice(["music", "sfx", "speech"]), rng.choice([0.0, 0.25, 7.5, rng.uniform(-2, 60)]), rng.random()) for k in range(12) for _ in range(rng.randrange(9))]
    points = list({(k, s, t): (k, s, t, g) for k, s, t, g in points}.values())
    chunks = [(k, o, d) for k in range(14) for o, d in [(0, 30.0), (0, 30.0), (3, 12.5), (77, 40.0), (220, 30.0), (1000, 260.0)]]
    got = signals.envelope_chunks(spark.createDataFrame(chunks, "k long, offset int, duration_sec double"), spark.createDataFrame(points, "k long, stem string, time double, gain double"), ["k"], rate, hop, size)
    assert plan(got).count("Window [") == 1  # over keyframes alone
    want = []
    for k, o, d in chunks:
        own = sorted((t, g) for j, s, t, g in points if j == k and s == ("music" if any(j == k and s == "music" for j, s, *_ in points) else "sfx"))
        for f in range(size // hop):
            t, gain = (o // hop + f) * hop / rate, 1.0
            if own and o // hop + size // hop <= d * rate // hop:
                i = bisect.bisect_left(own, (t,))
                (t0, g0), (t1, g1) = own[max(i - 1, 0)], own[min(i, len(own) - 1)]
                gain = g0 if t1 == t0 else g0 + (g1 - g0) * (t - t0) / (t1 - t0)
            want.append((k, o, f, gain))
    rows = sorted((r.k, r.offset, r.frame, r.gain) for r in got.collect())
    want.sort()
    assert [r[:3] for r in rows] == [w[:3] for w in want] and np.allclose([r[3] for r in rows], [w[3] for w in want])


def test_trimming_is_one_pass(spark):
    made = {k: np.random.default_rng(k).standard_normal(n) for k, n in enumerate([5, 59, 60, 61, 200])}
    df = spark.createDataFrame([(k, i, x[i : i + 16].tolist(), (-x[i : i + 16]).tolist()) for k, x in made.items() for i in range(0, len(x), 16)], "k long, start long, left array<double>, right array<double>")
    got = signals.trimmed(df, ["k"], 0.375, 160)
    assert "Union" not in plan(got)
    for k, x in made.items():
        rows = sorted(got.filter(F.col("k") == k).collect(), key=lambda r: r.start)
        want = x if len(x) <= 60 else x[:60] * np.concatenate([np.ones(52), 1 - np.arange(8) / 7])
        assert np.allclose(np.concatenate([r.left for r in rows]), want) and np.allclose(np.concatenate([r.right for r in rows]), -want)


def test_loudness_is_fitted_without_writing_the_signal_again(spark):
    made = {k: np.random.default_rng(k).standard_normal(n) * loud for k, (n, loud) in enumerate([(3000, 0.1), (2500, 1e-4), (2048, 0.0), (700, 0.3)])}
    made[4] = np.concatenate([np.zeros(20_000), [0.9], np.full(2000, 1e-4)])
    df = spark.createDataFrame([(k, i, x[i : i + 64].tolist()) for k, x in made.items() for i in range(0, len(x), 64)], "k long, start long, left array<double>")
    storage.release(spark)
    got = chains.to_loudness(df, "k", 4000, 64, target=-5.0, values=("left",))
    kept = storage._KEPT[spark.sparkContext.applicationId]
    assert sum("left" in spark.read.parquet(p).columns for p in kept) == 1
    fit = {r.k: r for r in signals.loudness_fit(loudness.integrated_loudness(df, ["k"], 4000, 64, ("left",), floor=float("-inf")), "k", target=-5.0).collect()}
    assert {r.limits for r in fit.values()} == {True, False}
    for k, x in made.items():
        want = x * 10 ** (fit[k].gain_db / 20)
        rows = sorted(got.filter(F.col("k") == k).collect(), key=lambda r: r.start)
        assert np.allclose(np.concatenate([r.left for r in rows]), chains.limited(want, 4000, -2.0) if fit[k].limits else want)
        assert fit[k].true_peak_db == -100.0 if k == 2 else np.isclose(fit[k].true_peak_db, 20 * np.log10(loudness.oversampled_peak(x)))
