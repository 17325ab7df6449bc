"""Filters, dynamics and loudness by closed form and property."""

from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest

from wavequill.operators import blocks, chains, levels, loudness

RATE = 48_000


def tone(hz, db, seconds=1.0):
    return 10 ** (db / 20) * np.sin(2 * np.pi * hz * np.arange(int(RATE * seconds)) / RATE)


def power_db(x):
    return 20 * np.log10(np.abs(x[len(x) // 2 :]).max())


def test_biquad_matches_the_loop():
    rng = np.random.default_rng(3)
    for n in (0, 1, 5, 2048, 5000):
        x = rng.standard_normal(n)
        for b, a in (chains.high_pass(80, RATE), chains.high_shelf(3000, -4, RATE)):
            y = np.zeros(n)
            for i in range(n):
                y[i] = sum(b[k] * x[i - k] for k in range(3) if i >= k) - sum(a[k] * y[i - k] for k in (1, 2) if i >= k)
            assert np.allclose(chains.biquad(x, b, a), y)


def test_filters_pass_and_cut():
    assert power_db(chains.biquad(tone(1000, 0), *chains.high_pass(80, RATE))) == pytest.approx(0, abs=0.1)
    assert power_db(chains.biquad(tone(20, 0), *chains.high_pass(80, RATE))) < -20
    assert power_db(chains.biquad(tone(15000, 0), *chains.high_shelf(4000, -6, RATE))) == pytest.approx(-6, abs=0.3)


def test_compressor_reduces_only_above_the_threshold():
    quiet, loud = np.full(RATE, 10 ** (-30 / 20)), np.full(RATE, 10 ** (-10 / 20))
    assert np.allclose(chains.compressed(quiet, RATE), quiet)
    assert power_db(chains.compressed(loud, RATE)) == pytest.approx(-15, abs=0.01)


def test_limiter_holds_the_ceiling():
    rng = np.random.default_rng(5)
    for n in (0, 1, 100, 5000):
        x = rng.standard_normal(n)
        y = chains.limited(x, RATE, -2.0)
        assert len(y) == n and np.abs(y).max(initial=0) <= 10 ** (-2 / 20) + 1e-12
    calm = tone(440, -12)
    assert np.allclose(chains.limited(calm, RATE, -2.0), calm)


def test_reverb_is_linear_and_dies_away():
    x = np.zeros(4 * RATE)
    x[0] = 1.0
    y = chains.reverberated(x, RATE, 0.5, 0.5, 0.3)
    assert y[0] == pytest.approx(1, abs=0.05) and np.abs(y[1:RATE]).max() > 1e-4 > np.abs(y[-RATE // 2 :]).max()
    assert np.allclose(chains.reverberated(2 * x, RATE, 0.5, 0.5, 0.3), 2 * y)
    assert np.allclose(chains.reverberated(x, RATE, 0.5, 0.5, 0.0), x)


def test_true_peak_finds_peaks_between_samples():
    x = np.sin(np.pi / 2 * np.arange(4800) + np.pi / 4)  # samples at 0.707 only
    assert np.abs(x).max() < 0.71 and loudness.oversampled_peak(x) == pytest.approx(1, abs=0.08)


def in_blocks(spark, signals, size, sides=("left",)):
    rows = [(k, i, *[(x if s == "left" else -0.5 * x)[i : i + size].tolist() for s in sides]) for k, x in signals.items() for i in range(0, len(x), size)]
    return spark.createDataFrame(rows, "scene string, start long" + "".join(f", {s} array<double>" for s in sides)).repartition(5)


def whole(df, column="left"):
    return {k: np.concatenate([np.array(r[column], float) for r in sorted(rows, key=lambda r: r.start)]) for k, rows in ((k, list(g)) for k, g in groupby(sorted(df.collect(), key=lambda r: r.scene), key=lambda r: r.scene))}


def test_loudness_of_tones(spark):
    gap = np.concatenate([tone(997, -20, 2), np.zeros(4 * RATE)])  # the gate leaves silence out
    frame = in_blocks(spark, {"tone": tone(997, -20, 2), "quiet": np.zeros(RATE), "short": tone(997, -20, 0.1), "gap": gap}, 20_000).cache()
    found = {r.scene: r for r in loudness.integrated_loudness(frame, ["scene"], RATE, 20_000, ("left",)).collect()}
    assert found["tone"].lufs == pytest.approx(-23.01, abs=0.15) and found["gap"].lufs == pytest.approx(found["tone"].lufs, abs=0.5)
    assert found["quiet"].lufs == found["short"].lufs == -70 and found["quiet"].true_peak_db == -100
    assert found["tone"].true_peak_db == pytest.approx(-20, abs=0.3)


@pytest.fixture(scope="module")
def noises(spark):
    rng = np.random.default_rng(8)
    lengths = {"long": 1203, "even": 640, "one": 1, "block": 64, "short": 63}
    found = {k: rng.standard_normal(n) * 0.4 * (1 + np.arange(n) % 90 // 60) for k, n in lengths.items()}
    return found, in_blocks(spark, found, 64, ("left", "right")).cache()


CHAIN = {"low_cut_hz": 300.0, "high_shelf_db": -3.0, "high_shelf_hz": 1200.0, "compressor": {"threshold": -20.0, "ratio": 2.0, "attack": None}, "reverb": {"room_size": 0.02, "damping": 0.5, "wet": 0.3}, "gain_db": -2.0}


@pytest.mark.parametrize("settings", [{k: v} for k, v in CHAIN.items()] + [CHAIN, {}])
def test_blocks_equal_whole_signals(noises, settings):
    """Filters, compressor, reverb and the whole chain, over many blocks, to 1e-9."""
    found, df = noises
    got = chains.process_stems(df, ["scene"], 4000, 64, settings)
    for side, factor in (("left", 1.0), ("right", -0.5)):
        for k, x in whole(got, side).items():
            assert np.allclose(x, chains.processed(found[k] * factor, 4000, settings), atol=1e-9, rtol=0), (k, side)


def test_settings_by_key(noises):
    found, df = noises
    got = whole(chains.process_stems(df, ["scene"], 4000, 64, {"long": CHAIN, "even": {"gain_db": 6.0, "reverb": {"room_size": 0.0, "damping": 0.0, "wet": 1.0}}, "one": {"low_cut_hz": 90.0}}, "scene"))
    for k, x in got.items():
        own = {"long": CHAIN, "even": {"gain_db": 6.0, "reverb": {"room_size": 0.0, "damping": 0.0, "wet": 1.0}}, "one": {"low_cut_hz": 90.0}}.get(k, {})
        assert np.allclose(x, chains.processed(found[k], 4000, own), atol=1e-9, rtol=0), k


def test_mastering_and_limits_in_blocks(noises):
    """The limiter's window of 96 kHz (480 samples) reaches over several blocks of 64."""
    found, df = noises
    for rate in (4000, 96_000):
        for k, x in whole(chains.master(df, ["scene"], rate, 64)).items():
            assert np.allclose(x, chains.mastered(found[k], rate), atol=1e-9, rtol=0), (k, rate)


def test_reverb_equals_direct_convolution():
    x, h = np.random.default_rng(2).standard_normal(700), chains.response(4000, 0.1, 0.4, 0.3)
    assert np.allclose(chains.reverberated(x, 4000, 0.1, 0.4, 0.3), np.convolve(x, h)[:700])


def test_cost_of_convolution_is_blocks_times_parts(noises):
    found, df = noises
    h = np.random.default_rng(4).standard_normal(64 * 3)
    got = whole(blocks.convolved(df, ["scene"], h, 64, ("left",)))
    assert all(np.allclose(x, np.convolve(found[k], h)[: len(x)], atol=1e-9) for k, x in got.items()) and {k: len(x) for k, x in got.items()} == {k: len(x) for k, x in found.items()}


@pytest.mark.parametrize(("before", "after"), [(0, 0), (5, 3), (64, 64), (200, 130)])
def test_halos(noises, before, after):
    found, df = noises
    for r in blocks.with_halo(df, ["scene"], before, after, 64, ("left", "right")).collect():
        x, stop = found[r.scene], r.start + len(r.left)
        assert np.allclose(r.left_before, x[max(0, r.start - before) : r.start]) and np.allclose(r.left_after, x[stop : stop + after])
        assert np.allclose(r.right_before, -0.5 * x[max(0, r.start - before) : r.start])


def test_true_peaks_and_hops_in_blocks(noises):
    found, df = noises
    peaks = {r.scene: r.true_peak for r in loudness.true_peaks(df, ["scene"], 64, ("left",)).collect()}
    assert all(peaks[k] == pytest.approx(loudness.oversampled_peak(x), abs=1e-12) for k, x in found.items())
    hops = loudness.hop_powers(df, ["scene"], 4000, 50, ("left", "right"))
    powers = {k: {r.block: r.z for r in rows} for k, rows in ((k, list(g)) for k, g in groupby(sorted(loudness.window_powers(hops, ["scene"], 50, 4).collect(), key=lambda r: r.scene), key=lambda r: r.scene))}
    for k, x in found.items():
        y = loudness.k_weighted(x, 4000) ** 2 + loudness.k_weighted(-0.5 * x, 4000) ** 2
        assert powers.get(k, {}) == pytest.approx({w: y[50 * w : 50 * w + 200].mean() for w in range(0, (len(x) - 200) // 50 + 1)}, abs=1e-9)


def test_levels_and_runs_in_blocks(spark):
    rng = np.random.default_rng(6)
    found = {k: np.where(rng.random(n) < share, 0.0, rng.standard_normal(n)) for k, n, share in (("a", 900, 0.7), ("b", 640, 0.99), ("zero", 300, 1.1), ("loud", 100, -1), ("one", 1, 1.1))}
    found["odd"] = np.array([0.5, np.nan, np.inf, 0.0])
    df = in_blocks(spark, found, 64)
    long = spark.createDataFrame([(k, float(v)) for k, x in found.items() for v in x], "scene string, x double")
    key = lambda df: sorted(map(repr, df.selectExpr("scene", "n", *(f"round({c}, 9)" for c in ("rms_db", "peak_db", "crest_db", "dc_offset")), "has_bad", "is_loud").collect()))
    assert key(levels.block_levels(df, ["scene"], ("left",)).filter("scene <> 'odd'")) == key(levels.levels(long, ["scene"]).filter("scene <> 'odd'"))
    assert levels.block_levels(df, ["scene"], ("left",)).filter("scene = 'odd'").first().has_bad
    for k, longest in ((r.scene, r.longest) for r in levels.longest_quiet(df, ["scene"], ("left",)).collect()):
        assert longest == max(len(z) for z in "".join("0" if abs(v) < 1e-8 else "x" for v in found[k]).split("x"))


def test_order_statistics_take_no_array(spark):
    """Places of up to 3000 values, with ties and one bucket that holds most of them."""
    rng = np.random.default_rng(7)
    found = {"wide": rng.normal(-30, 9, 3000), "same": np.full(500, -20.0), "near": -20 + rng.random(1001) * 0.05, "two": np.array([-10.0, -30.0]), "one": np.array([-3.0])}
    df = spark.createDataFrame([(k, float(v)) for k, x in found.items() for v in x] + [("wide", None)], "scene string, db double")
    shares = {"low": 0.10, "mid": 0.5, "high": 0.95, "end": 1.0}
    for r in levels.order_statistics(df, ["scene"], "db", shares).collect():
        x = np.sort(found[r.scene])
        assert r.n == len(x) and [r[k] for k in shares] == [x[min(len(x) - 1, int(len(x) * s))] for s in shares.values()]
    plan = levels.loudness_range(df, ["scene"])._jdf.queryExecution().toString()
    assert "collect_list" not in plan


def test_no_blocks(spark):
    none = spark.createDataFrame([], "scene string, start long, left array<double>, right array<double>")
    frames = [chains.process_stems(none, ["scene"], 4000, 64, CHAIN), chains.master(none, ["scene"], 4000, 64), chains.to_loudness(none, "scene", 4000, 64), levels.longest_quiet(none, ["scene"]), loudness.integrated_loudness(none, ["scene"], 4000, 64)]
    assert [f.count() for f in frames] == [0] * 5


def test_convolution_moves_the_signal_twice_at_most(noises):
    """Responses of several spans' blocks and of one tap, by a column; rows are dealt to two spans at most."""
    found, df = noises
    rng = np.random.default_rng(6)
    rooms = {"long": rng.standard_normal(3000), "short": rng.standard_normal(1)}
    both = df.crossJoin(df.sparkSession.createDataFrame([(k,) for k in (*rooms, "none")], "room string"))
    got = blocks.convolved(both, ["scene", "room"], rooms, 64, ("left", "right"), "room")
    for room, h in rooms.items():
        for k, x in whole(got.filter(f"room = '{room}'")).items():
            assert len(x) == len(found[k]) and np.allclose(x, np.convolve(found[k], h)[: len(x)], atol=1e-9)
    assert got.filter("room = 'none'").count() == 0
    assert "collect_list" not in got._jdf.queryExecution().optimizedPlan().toString()  # no products gathered by block and lag


def test_parts_of_a_batch_are_bounded():
    batch = pa.RecordBatch.from_arrays([pa.array([np.zeros(n) for n in [4096] * 300 + [0, 1, blocks.PART * 2, 3]], pa.list_(pa.float64()))], names=["left"])
    cuts = list(blocks.parts(batch, ("left",)))
    assert pa.Table.from_batches(cuts).equals(pa.Table.from_batches([batch]))
    assert all(p.num_rows == 1 or pa.compute.sum(p.column("left").value_lengths()).as_py() <= blocks.PART for p in cuts)


@pytest.mark.parametrize("n", [1, 7, 16, 300])
def test_rows_of_a_matrix_are_signals_of_their_own(n):
    rng = np.random.default_rng(n)
    x = rng.standard_normal((5, n))
    filters = chains.Filters.of(chains.high_pass(80, 4000), chains.high_shelf(1200, -3, 4000))
    for own in (filters, chains.Compressor(4000), chains.Sidechain(0.5, 0.25, 0.9, 0.99)):
        state = rng.random((5, own.size))
        m, o = own.summary(x)
        assert np.allclose(own.run(x, state), [own.run(a, s) for a, s in zip(x, state, strict=True)])
        assert all(np.allclose(m[i], own.summary(x[i : i + 1])[0][0]) and np.allclose(o[i], own.summary(x[i : i + 1])[1][0]) for i in range(5))
        half = n // 2  # what is left after the first half is where the second goes on
        middle = np.einsum("rij,rj->ri", own.summary(x[:, :half])[0], state) + own.summary(x[:, :half])[1]
        assert np.allclose(own.run(x[:, half:], middle), own.run(x, state)[:, half:])
    wide = np.pad(x, ((0, 0), (2, 3)))
    assert np.allclose(chains.limited_part(wide, 2, 2 + n, 4, -6.0), [chains.limited_part(w, 2, 2 + n, 4, -6.0) for w in wide])
    assert np.allclose(loudness.peak_between(wide, 2, 2 + n), [loudness.peak_between(w, 2, 2 + n) for w in wide])
