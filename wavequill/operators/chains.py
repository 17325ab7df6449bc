"""Processing chains of stems: filters, compressor, reverb, limiter and mastering, over signals in blocks.

Filters and compressor are recurrences of a few numbers, the limiter looks a few milliseconds around, the reverb is a
convolution with a room's impulse response; `blocks` runs each of them block by block, so no task holds a scene. The
functions on arrays say what one signal becomes. The designs are the public textbook ones. An empty signal stays empty.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavequill.operators import blocks as B
from wavequill.operators.envelopes import affine_scan
from wavequill.storage import kept

SIDES = ("left", "right")


def high_pass(hz: float, rate: float, q: float = 0.5**0.5) -> tuple[np.ndarray, np.ndarray]:
    w = 2 * math.pi * hz / rate
    c, alpha = math.cos(w), math.sin(w) / (2 * q)
    b, a = np.array([(1 + c) / 2, -(1 + c), (1 + c) / 2]), np.array([1 + alpha, -2 * c, 1 - alpha])
    return b / a[0], a / a[0]


def high_shelf(hz: float, db: float, rate: float, q: float = 0.5**0.5) -> tuple[np.ndarray, np.ndarray]:
    w, g = 2 * math.pi * hz / rate, 10 ** (db / 40)
    c, r = math.cos(w), 2 * math.sqrt(g) * math.sin(w) / (2 * q)
    b = np.array([g * ((g + 1) + (g - 1) * c + r), -2 * g * ((g - 1) + (g + 1) * c), g * ((g + 1) + (g - 1) * c - r)])
    a = np.array([(g + 1) - (g - 1) * c + r, 2 * ((g - 1) - (g + 1) * c), (g + 1) - (g - 1) * c - r])
    return b / a[0], a / a[0]


@lru_cache(maxsize=64)
def _answers(b: tuple[float, ...], a: tuple[float, ...], block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of `block` samples: the output to each input from rest, the state left by each input, the output to each state at the
    beginning, and what becomes of such a state."""
    step, enters = np.array([[-a[1], 1.0], [-a[2], 0.0]]), np.array([b[1] - a[1] * b[0], b[2] - a[2] * b[0]])
    powers = [np.eye(2)]
    for _ in range(block):
        powers.append(step @ powers[-1])
    rest = np.array([p[0] for p in powers[:block]])
    heard = np.concatenate([[b[0]], rest[:-1] @ enters])
    lag = np.arange(block)[:, None] - np.arange(block)
    return np.where(lag >= 0, heard[lag], 0.0), np.array([p @ enters for p in powers[block - 1 :: -1]]).T, rest, powers[block]


def filtered(x: np.ndarray, b: np.ndarray, a: np.ndarray, state: np.ndarray, block: int = 96) -> tuple[np.ndarray, np.ndarray]:
    """A second-order filter from a state on, and the state after it, for a signal or for every row of a matrix (with a row of
    states each): parts of the signals are one matrix product, then each adds the answer to the state it starts in."""
    n = x.shape[-1]
    if not x.size:
        return np.zeros(x.shape), state
    many = x.size // n
    block = min(block, n)
    outputs, left, rest, whole = _answers(tuple(b.tolist()), tuple(a.tolist()), block)
    rows = -(-n // block)
    u = np.zeros((many, rows * block))
    u[:, :n] = x.reshape(many, n)
    u = u.reshape(many * rows, block).T
    ends, begins = (left @ u).reshape(2, many, rows), np.empty((2, many, rows))
    begin = state.reshape(many, 2).T
    for k in range(rows):
        begins[:, :, k] = begin
        begin = whole @ begin + ends[:, :, k]
    y = (outputs @ u + rest @ begins.reshape(2, -1)).T.reshape(many, rows * block)[:, :n].reshape(x.shape)
    before = b[2] * x[..., -2] - a[2] * y[..., -2] if n > 1 else state[..., 1]
    return y, np.stack([b[1] * x[..., -1] - a[1] * y[..., -1] + before, b[2] * x[..., -1] - a[2] * y[..., -1]], axis=-1)


def biquad(x: np.ndarray, b: np.ndarray, a: np.ndarray) -> np.ndarray:
    """A second-order filter from rest."""
    return filtered(x, b, a, np.zeros(2))[0]


@dataclass(frozen=True)
class Filters:
    """Second-order filters one after another: a recurrence of two numbers each."""

    designs: tuple[tuple[tuple[float, ...], tuple[float, ...]], ...]

    @classmethod
    def of(cls, *designs: tuple[np.ndarray, np.ndarray]) -> Filters:
        return cls(tuple((tuple(b.tolist()), tuple(a.tolist())) for b, a in designs))

    @property
    def size(self) -> int:
        return 2 * len(self.designs)

    def first(self) -> np.ndarray:
        return np.zeros(self.size)

    def both(self, x: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ends = []
        for k, (b, a) in enumerate(self.designs):
            x, end = filtered(x, np.array(b), np.array(a), state[..., 2 * k : 2 * k + 2])
            ends.append(end)
        return x, np.concatenate([*ends, np.zeros((*x.shape[:-1], 0))], axis=-1)

    def summary(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.broadcast_to(_power(self, x.shape[-1]), (len(x), self.size, self.size)), self.both(x, np.zeros((len(x), self.size)))[1]

    def run(self, x: np.ndarray, state: np.ndarray) -> np.ndarray:
        return self.both(x, state)[0]


@lru_cache(maxsize=64)
def _power(filters: Filters, n: int) -> np.ndarray:
    """What n samples of silence make of each state."""
    step = np.array([filters.both(np.zeros(1), unit)[1] for unit in np.eye(filters.size)]).T.reshape(filters.size, filters.size)
    return np.linalg.matrix_power(step, n)


@dataclass(frozen=True)
class Compressor:
    """Levels above the threshold rise only by 1 / ratio; the reduction in decibels follows by attack above it and release
    below. A recurrence of one number, whose coefficients the samples decide."""

    rate: float
    threshold: float = -20.0
    ratio: float = 2.0
    attack: float = 10.0
    release: float = 100.0
    size = 1

    def first(self) -> np.ndarray:
        return np.zeros(1)

    def _terms(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        over = np.maximum(20 * np.log10(np.abs(x) + 1e-10) - self.threshold, 0.0)
        c = np.where(over > 0, math.exp(-1000 / (self.rate * self.attack)), math.exp(-1000 / (self.rate * self.release)))
        return c, (1 - c) * over * (1 - 1 / self.ratio)

    def summary(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        c, d = self._terms(x)
        return np.prod(c, axis=1)[:, None, None], affine_scan(c, d, 0.0)[:, -1:] if x.size else np.zeros((len(x), 1))

    def run(self, x: np.ndarray, state: np.ndarray) -> np.ndarray:
        return x * 10 ** (-affine_scan(*self._terms(x), state[..., 0]) / 20)


@dataclass(frozen=True)
class Sidechain:
    """Gains that fall to `reduction` by `attack` while the level is above the threshold, and rise to 1 by `release` else; both are
    coefficients of the last gain."""

    threshold: float
    reduction: float
    attack: float
    release: float
    size = 1

    def first(self) -> np.ndarray:
        return np.ones(1)

    def _terms(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        on = x > self.threshold
        c = np.where(on, self.attack, self.release)
        return c, (1 - c) * np.where(on, self.reduction, 1.0)

    def summary(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        c, d = self._terms(x)
        return np.prod(c, axis=1)[:, None, None], affine_scan(c, d, 0.0)[:, -1:] if x.size else np.zeros((len(x), 1))

    def run(self, x: np.ndarray, state: np.ndarray) -> np.ndarray:
        return affine_scan(*self._terms(x), state[..., 0])


@dataclass(frozen=True)
class Sidechains:
    """Several gains that follow one level: a number of the state each."""

    each: tuple[Sidechain, ...]

    @property
    def size(self) -> int:
        return len(self.each)

    def first(self) -> np.ndarray:
        return np.ones(self.size)

    def summary(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = [own.summary(x) for own in self.each]
        return np.concatenate([m[:, 0] for m, _ in found], axis=1)[:, :, None] * np.eye(self.size), np.concatenate([o for _, o in found], axis=1)

    def run(self, x: np.ndarray, state: np.ndarray) -> np.ndarray:
        """The gains of each, one matrix after another."""
        return np.stack([own.run(x, state[..., i : i + 1]) for i, own in enumerate(self.each)])


def compressed(x: np.ndarray, rate: float, threshold: float = -20.0, ratio: float = 2.0, attack: float = 10.0, release: float = 100.0) -> np.ndarray:
    own = Compressor(rate, threshold, ratio, attack, release)
    return own.run(x, own.first())


def look_ahead(rate: float, seconds: float = 0.005) -> int:
    """Samples of the limiter's window."""
    return max(1, round(rate * seconds))


def limited_part(x: np.ndarray, begin: int, end: int, size: int, ceiling_db: float) -> np.ndarray:
    """x[begin:end], of a signal or of every row of a matrix, with no sample above the ceiling: the least gain needed in a window,
    averaged over a window, never exceeds the own need. x holds size - 1 more samples on both sides, or fewer where the signal
    begins or ends."""
    ceiling, n = 10 ** (ceiling_db / 20), x.shape[-1]
    need = np.minimum(1.0, ceiling / np.maximum(np.abs(x), 1e-12))
    need = np.concatenate([np.ones((*x.shape[:-1], size - 1 - begin)), need, np.ones((*x.shape[:-1], size - 1 - (n - end)))], axis=-1)
    width = 1
    while width < size:  # least of the next `size` samples, doubling the width
        by = min(width, size - width)
        need = np.minimum(need[..., : need.shape[-1] - by], need[..., by:])
        width += by
    total = np.concatenate([np.zeros((*x.shape[:-1], 1)), np.cumsum(need, axis=-1)], axis=-1)
    gain = (total[..., size:] - total[..., :-size]) / size
    return np.clip(x[..., begin:end] * gain[..., : end - begin], -ceiling, ceiling)  # the clip only removes rounding


def limited(x: np.ndarray, rate: float, ceiling_db: float, seconds: float = 0.005) -> np.ndarray:
    return limited_part(x, 0, len(x), look_ahead(rate, seconds), ceiling_db)


def impulse(rate: float, room_size: float, damping: float) -> np.ndarray:
    """A room's response: noise that dies away by 60 dB in 0.2 to 2 seconds, more of it smoothed where damping is high, with an
    energy of 1. The noise is a fixed function of the sample's number, in whole numbers, so that every engine agrees on it."""
    n = max(2, int(rate * (0.2 + 1.8 * room_size)))
    i = np.arange(n + 2, dtype=np.int64)
    noise = (i * i * 104_729 + i * 7919) % 65_537 / 32_768 - 1
    h = 10 ** (-3 * np.arange(n) / n) * ((1 - damping) * noise[1:-1] + damping * (noise[:-2] + noise[1:-1] + noise[2:]) / 3)
    return h / np.sqrt(h @ h)


def response(rate: float, room_size: float, damping: float, wet: float) -> np.ndarray:
    """The dry signal and `wet` of the room, as one impulse response."""
    h = wet * impulse(rate, room_size, damping)
    h[0] += 1.0
    return h


def reverberated(x: np.ndarray, rate: float, room_size: float, damping: float, wet: float) -> np.ndarray:
    h = response(rate, room_size, damping, wet)
    size = 1 << (len(x) + len(h)).bit_length()
    return np.fft.irfft(np.fft.rfft(x, size) * np.fft.rfft(h, size), size)[: len(x)]


def _filters(settings: dict, rate: float) -> Filters | None:
    designs = []
    if settings.get("low_cut_hz"):
        designs.append(high_pass(settings["low_cut_hz"], rate))
    if settings.get("high_shelf_db"):
        designs.append(high_shelf(settings.get("high_shelf_hz") or 8000.0, settings["high_shelf_db"], rate))
    return Filters.of(*designs) if designs else None


def _compressor(settings: dict, rate: float) -> Compressor | None:
    own = settings.get("compressor")
    return None if own is None else Compressor(rate, **{k: v for k, v in own.items() if v is not None})


def processed(x: np.ndarray, rate: float, settings: dict) -> np.ndarray:
    """Equaliser, compressor, reverb and gain in this order; what the settings lack or hold as null is left out."""
    for own in (_filters(settings, rate), _compressor(settings, rate)):
        if own:
            x = own.run(x, own.first())
    if settings.get("reverb") is not None:
        x = reverberated(x, rate, **settings["reverb"])
    return x * 10 ** ((settings.get("gain_db") or 0.0) / 20)


#: level of the mix before mastering, the mastering compressor, and its ceiling
MASTER_GAIN, MASTER, MASTER_CEILING = -3.0, {"threshold": -12.0, "ratio": 3.0, "attack": 20.0, "release": 200.0}, -2.0


def mastered(x: np.ndarray, rate: float) -> np.ndarray:
    """3 dB down, a slow compressor, a limiter at -2 dB (loudness is fitted after it, from gated blocks)."""
    return limited(compressed(x * 10 ** (MASTER_GAIN / 20), rate, **MASTER), rate, MASTER_CEILING)


def gained(blocks: DataFrame, gain_db: Column, values: tuple[str, ...] = SIDES) -> DataFrame:
    """All samples times a gain in decibels, which may differ by row."""
    rows = blocks.withColumn("_gain", F.pow(F.lit(10.0), gain_db / 20))
    return rows.withColumns({v: F.transform(F.col(v).cast("array<double>"), lambda x: x * F.col("_gain")) for v in values}).drop("_gain")


def process_stems(blocks: DataFrame, keys: list[str], rate: float, block: int, settings: dict, by: str | None = None, values: tuple[str, ...] = SIDES) -> DataFrame:
    """Every stem through its chain of settings, those of the value of `by` (one of the keys) or one chain for all. Blocks
    keep their places; columns other than the keys, start and values are dropped."""
    each = settings if by else {"": settings}

    def chosen(make):
        found = {name: own for name, s in each.items() if (own := make(s or {}, rate))}
        return (found if by else found[""]) if found else None

    at = [*keys, "start"]
    rows = blocks.select(*keys, F.col("start").cast("long").alias("start"), *[F.col(v).cast("array<double>").alias(v) for v in values])
    for how in (chosen(_filters), chosen(_compressor)):
        if how:  # reads its blocks twice
            rows = B.scanned(kept(rows), keys, how, values, by)
    rooms = {name: response(rate, **s["reverb"]) for name, s in each.items() if s and s.get("reverb") is not None}
    if rooms:
        rows = kept(rows)
        wet = B.convolved(rows, keys, rooms if by else rooms[""], block, values, by)
        rows = wet.unionByName(rows.filter(~F.coalesce(F.col(by).isin(*rooms), F.lit(False)))) if by else wet
    levels = {name: s["gain_db"] for name, s in each.items() if s and s.get("gain_db")}
    if levels:
        rows = gained(rows, F.coalesce(*[F.when(F.col(by) == name, F.lit(float(db))) for name, db in levels.items()], F.lit(0.0)) if by else F.lit(float(levels[""])), values)
    return rows.select(*at, *values)


def limit(blocks: DataFrame, keys: list[str], rate: float, block: int, ceiling_db: float, values: tuple[str, ...] = SIDES) -> DataFrame:
    """Every signal under the ceiling, each channel on its own. Blocks are read twice."""
    size = look_ahead(rate)
    return B.windowed(blocks, keys, size - 1, size - 1, block, values, lambda x, begin, end: limited_part(x, begin, end, size, ceiling_db))


def before_ceiling(blocks: DataFrame, keys: list[str], rate: float, values: tuple[str, ...] = SIDES) -> DataFrame:
    """Every scene's mix through the mastering compressor, as a table. Blocks are read twice: let them be a table, or cheap to make."""
    rows = gained(blocks.select(*keys, F.col("start").cast("long").alias("start"), *values), F.lit(MASTER_GAIN), values)
    return kept(B.scanned(rows, keys, Compressor(rate, **MASTER), values))


def master(blocks: DataFrame, keys: list[str], rate: float, block: int, values: tuple[str, ...] = SIDES) -> DataFrame:
    """Every scene's mix through the mastering dynamics. Blocks are read twice: let them be a table, or cheap to make."""
    return limit(before_ceiling(blocks, keys, rate, values), keys, rate, block, MASTER_CEILING, values)


def to_loudness(blocks: DataFrame, key: str, rate: int, block: int, target: float = -27.0, ceiling: float = -2.0, spread: float = 1.0, values: tuple[str, ...] = SIDES) -> DataFrame:
    """Every scene at the target loudness, moved by a draw within `spread`; those whose true peak would pass the ceiling are
    limited. Silent scenes keep their level. The signal is written once, and moved once to be measured and once to be changed."""
    from wavequill.operators.loudness import integrated_loudness
    from wavequill.operators.signals import loudness_fit

    at, size = [key, "start"], look_ahead(rate)
    rows = kept(blocks.select(key, F.col("start").cast("long").alias("start"), *values))
    fit = loudness_fit(integrated_loudness(rows, [key], rate, block, values, floor=float("-inf")), key, target, ceiling, spread)
    asked = rows.select(*at).join(fit.select(key, F.pow(F.lit(10.0), F.col("gain_db") / 20).alias("_gain"), "limits"), key)  # a row a block

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in B.parts(whole, values)):
            gain, limits, arrays = batch.column("_gain").to_numpy(), batch.column("limits").to_numpy(zero_copy_only=False), []
            for v in values:
                x = B.Rows(batch.column(v))
                for rows, around, begin, end in B.around(batch, v):
                    loud = around * gain[rows][:, None]
                    x.put(rows, loud[:, begin:end])
                    if limits[rows].any():
                        x.put(rows[limits[rows]], limited_part(loud[limits[rows]], begin, end, size, ceiling))
                arrays.append(B.listed(x.flat, x.sizes))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in at), *arrays], names=[*at, *values])

    haloed = B.with_halo(rows, [key], size - 1, size - 1, block, values, asked)
    return haloed.mapInArrow(moved, B.kinds(rows, at) + "".join(f", `{v}` array<double>" for v in values))
