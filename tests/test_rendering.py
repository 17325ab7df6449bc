"""Rendering against a plain computation on whole arrays."""

import math

import numpy as np
import pytest

from wavequill import storage
from wavequill.operators import blocks, chains, rendering, signals

RATE, BLOCK = 200, 50
STEMS = "scene_id string, stem string, start long, left array<double>, right array<double>"
EVENTS = "scene_id string, idx int, start long, left array<double>, right array<double>"


def cut(x, start=0):
    return [(start + i, x[i : i + BLOCK].tolist(), (-x[i : i + BLOCK]).tolist()) for i in range(0, len(x), BLOCK)]


def duck(target, speech, threshold, reduction, attack, release):
    """The recurrence, a sample at a time."""
    g, out = 1.0, []
    for x, s in zip(target, speech, strict=False):
        on = abs(s) > 10 ** (threshold / 20)
        c = math.exp(-1000 / (RATE * (attack if on else release)))
        g = c * g + (1 - c) * (10 ** (reduction / 20) if on else 1.0)
        out.append(x * g)
    return np.array(out)


@pytest.fixture(scope="module")
def scene(spark):
    r = np.random.default_rng(3)
    speech = np.where(np.arange(430) // 60 % 2, 0.5, 0.001) * r.uniform(-1, 1, 430)
    music, ambience, bang, tick = 0.7 * r.uniform(-1, 1, 600), 0.3 * r.uniform(-1, 1, 120), r.uniform(-0.8, 0.8, 75), r.uniform(-0.5, 0.5, 130)
    stems = spark.createDataFrame([("a", s, *b) for s, x in (("speech", speech), ("music", music), ("ambience", ambience)) for b in cut(x)] + [("dumb", "music", *b) for b in cut(music[:60])], STEMS)
    events = spark.createDataFrame([("a", i, *b) for i, x, at in ((0, bang, 33), (1, tick, 390)) for b in cut(x, at)], EVENTS)
    return speech, music, ambience, [(33, bang), (390, tick)], stems, events


def whole(df, column="left"):
    return np.concatenate([np.array(r[column], float) for r in sorted(df.filter("scene_id = 'a'").collect(), key=lambda r: r.start)])


def test_versions(scene, spark):
    speech, music, ambience, sounds, stems, events = scene
    final = {"music": {"gain_db": -6.0}, "sfx": {"gain_db": 2.0}}
    own = {"sfx_0": {"gain_db": -3.0}}
    ducks = spark.createDataFrame([("a", True, None)], "scene_id string, duck_music boolean, duck_sfx boolean")
    found, failures = rendering.render(stems, events, {}, final, own, RATE, BLOCK, ducks=ducks)
    assert [tuple(r) for r in failures.collect()] == [("dumb", "no speech stem")]
    n, gain = len(speech), lambda db: 10 ** (db / 20)
    fill = lambda x: np.pad(x[:n], (0, max(0, n - len(x))))

    def sfx(parts):
        out = np.zeros(n)
        for at, x in parts:
            out[at : at + len(x)] += x[: n - at]
        return out

    rough_sfx, release_sfx = sfx(sounds), sfx([(sounds[0][0], sounds[0][1] * gain(-3)), sounds[1]]) * gain(2)
    for name, m, f in (("rough", fill(music), rough_sfx), ("release", fill(music) * gain(-6), release_sfx)):
        assert np.allclose(whole(found[name].stems.filter("stem = 'sfx'")), f) and np.allclose(whole(found[name].stems.filter("stem = 'music'")), m)
        mix = speech + duck(m, speech, -20, -12, 20, 225) + fill(ambience) + duck(f, speech, -25, -8, 10, 150)
        assert np.allclose(whole(found[name].mix), chains.mastered(mix, RATE)) and np.allclose(whole(found[name].mix, "right"), chains.mastered(-mix, RATE))
    under = sfx([(at, duck(x * g, np.pad(speech[at : at + len(x)], (0, max(0, at + len(x) - n))), -25, -8, 10, 150)) for (at, x), g in zip(sounds, (gain(-3), 1.0), strict=True)]) * gain(2)
    parts = {"speech": speech, "music": duck(fill(music) * gain(-6), speech, -20, -12, 20, 225), "ambience": fill(ambience), "sfx": under}
    peak = max(np.abs(sum(parts.values())).max(), *(np.abs(x).max() for x in parts.values()))
    g = gain(-1) / peak if peak > gain(-1) else 1.0
    q = {k: np.clip(np.rint(x * g * 32768), -32768, 32767) for k, x in parts.items()}
    for k, x in q.items():
        assert np.abs(whole(found["linear"].stems.filter(f"stem = '{k}'")) - x).max() <= 1  # halves may round either way
    total = sum(whole(found["linear"].stems.filter(f"stem = '{k}'")) for k in q)
    assert (whole(found["linear"].mix) == total).all() and np.abs(total).max() <= 32767


def test_plain_mix(scene):
    speech, music, ambience, sounds, stems, events = scene
    n = 600
    fill = lambda x: np.pad(x, (0, n - len(x)))
    mix = fill(speech) + fill(duck(music * 0.35, speech, -20, -12, 20, 225)) + fill(ambience * 0.25)
    for at, x in sounds:
        heard = speech[at : at + len(x)]
        mix[at : at + len(x)] += duck(x * 0.8, np.pad(heard, (0, len(x) - len(heard))), -25, -8, 5, 100)
    assert np.allclose(whole(rendering.plain_mix(stems, events, RATE, BLOCK)), chains.mastered(mix, RATE))


def test_long_scenes_are_scanned_in_parts(spark):
    """The gains over many blocks equal those of one scan, also where a block is empty of sound."""
    r = np.random.default_rng(9)
    speech = np.where(np.arange(5000) // 700 % 2, 0.9, 0.0) * r.uniform(-1, 1, 5000)
    df = spark.createDataFrame([("a", "speech", *b) for b in cut(speech)] + [("b", "speech", *b) for b in cut(speech[::-1])], STEMS).drop("stem")
    got = signals.ducking_gains(df.repartition(5), ["scene_id"], RATE)
    for name, x in (("a", speech), ("b", speech[::-1])):
        own = np.concatenate([np.array(row.gain) for row in sorted(got.filter(f"scene_id = '{name}'").collect(), key=lambda row: row.start)])
        assert np.allclose(own, duck(np.ones(5000), x, -20, -12, 20, 225), atol=1e-9)


def test_versions_of_short_blocks_share_wider_ones(spark):
    """Both versions are made together, out of rows of a thousand samples and not of 50; sounds may start before the scene, lie
    over the seams and end after it."""
    r = np.random.default_rng(5)
    speech = np.where(np.arange(2630) // 300 % 2, 0.6, 0.001) * r.uniform(-1, 1, 2630)
    music, sounds = 0.7 * r.uniform(-1, 1, 2700), [(at, r.uniform(-0.8, 0.8, n)) for at, n in ((-30, 70), (980, 130), (990, 1100), (990, 40), (2600, 90), (5000, 60))]
    stems = spark.createDataFrame([("a", s, *b) for s, x in (("speech", speech), ("music", music), ("other", music)) for b in cut(x)] + [("b", "speech", *b) for b in cut(speech[:120])], STEMS)
    events = spark.createDataFrame([("a", i, *b) for i, (at, x) in enumerate(sounds) for b in cut(x, at)], EVENTS)
    storage.release(spark)
    chain = {"reverb": {"room_size": 0.1, "damping": 0.4, "wet": 0.3}, "gain_db": 2.0}
    gains = spark.createDataFrame([("a", "music", -1.0), ("a", "sfx", None), ("b", "speech", 3.0)], "scene_id string, stem string, gain_db double")
    found, _ = rendering.render(stems, events, {}, {"sfx": chain}, {"sfx_1": {"gain_db": -3.0}}, RATE, BLOCK, gains=gains, versions=("rough", "release"))
    rows = [spark.read.parquet(p).count() for p in storage._KEPT[spark.sparkContext.applicationId]]
    assert max(rows[-3:]) == 2 * (3 + 1)  # the stems, their sums and those compressed: two versions, 1000 samples a row

    def sfx(gain):
        out = np.zeros(2630)
        for i, (at, x) in enumerate(sounds):
            low, high = max(at, 0), min(at + len(x), 2630)
            out[low : max(high, low)] += (x * (gain if i == 1 else 1.0))[low - at : max(high, low) - at]
        return out

    music = music[:2630] * 10 ** (-1 / 20)
    for name, f in (("rough", sfx(1.0)), ("release", chains.processed(sfx(10 ** (-3 / 20)), RATE, chain))):
        own = {k: found[name].stems.filter(f"stem = '{k}'") for k in ("speech", "music", "ambience", "sfx")}
        assert np.allclose(whole(own["sfx"]), f) and np.allclose(whole(own["music"], "right"), -music) and (whole(own["ambience"]) == np.zeros(2630)).all()
        assert found[name].stems.filter("stem = 'other'").isEmpty()
        mix = speech + duck(music, speech, -20, -12, 20, 225) + duck(f, speech, -25, -8, 10, 150)
        assert np.allclose(whole(found[name].mix), chains.mastered(mix, RATE)) and np.allclose(whole(found[name].mix, "right"), chains.mastered(-mix, RATE))
        other = found[name].mix.filter("scene_id = 'b'").orderBy("start").collect()
        assert [(x.start, len(x.left)) for x in other] == [(0, 50), (50, 50), (100, 20)]
        assert np.allclose(np.concatenate([x.left for x in other]), chains.mastered(speech[:120] * 10 ** (3 / 20), RATE))


def test_pieces_are_gathered_over_seams(spark):
    """Sums of pieces with any starts, as long as the first name's, also where a cell's pieces fill several batches."""
    r = np.random.default_rng(6)
    made = [(k, s, int(at), r.standard_normal(int(n)).tolist()) for k in range(5) for s in ("x", "y") for at, n in zip(r.integers(-20, 700, 90), r.integers(1, 150, 90), strict=True)]
    made += [(k, "z", at, [1.0] * min(40, 100 + 90 * k - at)) for k in range(5) for at in range(0, 100 + 90 * k, 40)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = blocks.gathered(spark.createDataFrame(made, "k long, s string, start long, v array<double>"), ["k"], "s", ("z", "y", "x", "none"), ("v",), 160).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for k in range(5):
        rows, n = sorted((x for x in got if x.k == k), key=lambda x: x.start), 100 + 90 * k
        assert [(x.start, len(x.z_v)) for x in rows] == [(at, min(160, n - at)) for at in range(0, n, 160)]
        for s in ("x", "y", "z", "none"):
            want = np.zeros(2000)
            for j, name, at, v in made:
                if (j, name) == (k, s):
                    want[max(at, 0) : max(at + len(v), 0)] += v[max(-at, 0) :]
            assert np.allclose(np.concatenate([x[f"{s}_v"] for x in rows]), want[:n])
