"""Sound files of any rate and width give blocks at one rate."""

import wave

import numpy as np
import pytest

from wavequill.sources import documents


def store(path, x, rate, width):
    n = np.round(np.asarray(x) * (2 ** (8 * width - 1) - 1)).astype("<i8")
    raw = (n + 128).astype(np.uint8).tobytes() if width == 1 else n.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()
    with wave.open(str(path), "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(width)
        w.setframerate(rate)
        w.writeframes(raw)


def test_rates_and_widths(spark, tmp_path):
    tone = lambda rate: 0.5 * np.sin(2 * np.pi * 440 * np.arange(rate * 3 // 2) / rate)
    cases = [(48_000, 2), (44_100, 2), (44_100, 3), (96_000, 4), (16_000, 2), (8_000, 1)]
    for rate, width in cases:
        store(tmp_path / f"{rate}-{width}.wav", tone(rate), rate, width)
    (tmp_path / "broken.wav").write_bytes(b"RIFF no sound")
    rows = documents.wave_blocks(spark, str(tmp_path)).collect()
    by = {}
    for r in sorted(rows, key=lambda r: r.block_no or 0):
        by.setdefault(r.path.rsplit("/", 1)[1][:-4], []).append(r)
    assert len(by) == len(cases) + 1 and [tuple(r)[1:] for r in by["broken"]] == [(None,) * 4]
    for rate, width in cases:
        blocks = by[f"{rate}-{width}"]
        assert [(r.block_no, r.start_sample, len(r.left)) for r in blocks] == [(0, 0, 48_000), (1, 48_000, 24_000)] and blocks[0].left == blocks[0].right
        x = np.concatenate([r.left for r in blocks])
        assert np.abs(x - tone(48_000))[500:-500].max() < (0.01 if width == 1 else 1e-3)


def test_what_the_lower_rate_cannot_hold_is_cut():
    high = np.sin(2 * np.pi * 30_000 * np.arange(96_000) / 96_000)[:, None]
    assert np.abs(documents.resampled(high, 96_000, 48_000)[500:-500]).max() < 0.01
    assert documents.resampled(np.ones((44_101, 1)), 44_100, 48_000).shape == (48_002, 1)
    assert documents.resampled(np.ones((4_410, 1)), 44_100, 48_000)[100:-100] == pytest.approx(1, abs=1e-6)
