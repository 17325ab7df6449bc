"""Loudness of scenes after ITU-R BS.1770-4 and EBU Tech 3342, over signals in blocks: K-weighting as a recurrence over blocks,
sums of squares by hop, overlapping windows of hops, gates and ranges by aggregates.

No task holds a scene: after the K-weighting there is one number a hop (0.1 s). Silence and scenes shorter than a window
have `floor` as their loudness. Channels count alike. Samples must not be null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wavequill.operators import blocks as B
from wavequill.operators.chains import SIDES, Filters, high_pass, high_shelf
from wavequill.storage import kept

#: offset of the loudness scale, absolute gate and relative gate (fixed values of the recommendation)
OFFSET, ABSOLUTE, RELATIVE = -0.691, -70.0, -10.0


def weighting(rate: float) -> Filters:
    """The recommendation's two filters, designed for any rate above 3 kHz."""
    return Filters.of(high_shelf(1500.0, 4.0, rate, 0.5**0.5), high_pass(38.0, rate, 0.5))


def k_weighted(x: np.ndarray, rate: float) -> np.ndarray:
    own = weighting(rate)
    return own.run(x, own.first())


def _by_hop(batch: pa.RecordBatch, keys: list[str], step: int, own: Filters, values: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """keys, hop, power, n of a batch of blocks with states."""
    found = B.ran(batch, own, values)
    y, sizes = sum(x.flat**2 for x in found), found[0].sizes
    if not len(y):
        return
    rows = np.repeat(np.arange(len(sizes)), sizes)
    hops = (np.repeat(batch.column("start").to_numpy() - found[0].begins, sizes) + np.arange(len(y))) // step
    cuts = np.flatnonzero(np.concatenate([[True], (np.diff(rows) != 0) | (np.diff(hops) != 0)]))
    take = pa.array(rows[cuts], pa.int64())
    yield pa.RecordBatch.from_arrays([*(batch.column(k).take(take) for k in keys), pa.array(hops[cuts], pa.int64()), pa.array(np.add.reduceat(y, cuts), pa.float64()), pa.array(np.diff([*cuts, len(y)]), pa.int64())], names=[*keys, "hop", "power", "n"])


def hop_powers(blocks: DataFrame, keys: list[str], rate: float, step: int, values: tuple[str, ...] = SIDES) -> DataFrame:
    """keys, hop, power (the sum of squares after weighting, of all channels) and n, for every `step` samples. Blocks are read
    twice: let them be a table."""
    at, own = [*keys, "start"], weighting(rate)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in B.parts(whole, values)):
            yield from _by_hop(batch, keys, step, own, values)

    states = B.with_states(blocks.select(*at, *values), keys, own, values)
    parts = states.mapInArrow(work, (B.kinds(blocks, keys) + ", " if keys else "") + "hop long, power double, n long")
    return parts.groupBy(*keys, "hop").agg(F.sum("power").alias("power"), F.sum("n").alias("n"))


def window_powers(hops: DataFrame, keys: list[str], step: int, span: int, every: int = 1) -> DataFrame:
    """keys, block, z: the mean power of every whole window of `span` hops, one beginning at every `every`-th hop."""
    first = F.greatest(F.ceil((F.col("hop") - span + 1) / every), F.lit(0)).cast("long")
    last = F.floor(F.col("hop") / every).cast("long")
    each = hops.filter(first <= last).select(*keys, "power", "n", F.explode(F.sequence(first, last)).alias("block"))
    found = each.groupBy(*keys, "block").agg(F.sum("power").alias("power"), F.sum("n").alias("n"))
    return found.filter(F.col("n") == step * span).select(*keys, "block", (F.col("power") / F.col("n")).alias("z"))


def level(z: Column) -> Column:
    """The loudness of a mean power; null for silence."""
    return F.when(z > 0, OFFSET + 10 * F.log10(z))


def peak_between(x: np.ndarray, begin: int, end: int, times: int = 4, half: int = 12) -> np.ndarray:
    """The largest magnitude of x[begin:end] and of `times` - 1 points after each, by a windowed sinc; for a signal, or for every row
    of a matrix. x holds `half` more samples on both sides, or fewer where the signal begins or ends."""
    peak = np.abs(x[..., begin:end]).max(axis=-1, initial=0.0)
    if end == begin:
        return peak
    padded = np.concatenate([np.zeros((*x.shape[:-1], half - begin)), x, np.zeros((*x.shape[:-1], half - (x.shape[-1] - end)))], axis=-1)
    k = np.arange(-half, half + 1)
    for i in range(1, times):
        at = k - i / times
        taps = np.sinc(at) * np.cos(np.pi * at / (2 * half + 2)) ** 2
        between = sum(w * padded[..., j : j + end - begin] for j, w in enumerate(taps[::-1]))
        peak = np.maximum(peak, np.abs(between).max(axis=-1))
    return peak


def oversampled_peak(x: np.ndarray, times: int = 4, half: int = 12) -> float:
    return float(peak_between(x, 0, len(x), times, half))


def true_peaks(blocks: DataFrame, keys: list[str], block: int, values: tuple[str, ...] = SIDES, half: int = 12) -> DataFrame:
    """keys, true_peak: of every scene's channels. Blocks are read twice."""
    at = [*keys, "start"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in B.parts(whole, values)):
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), pa.array(_peaks(batch, values), pa.float64())], names=[*keys, "peak"])

    haloed = B.with_halo(blocks.select(*at, *values), keys, half, half, block, values)
    peaks = haloed.mapInArrow(work, (B.kinds(blocks, keys) + ", " if keys else "") + "peak double")
    return peaks.groupBy(*keys).agg(F.max("peak").alias("true_peak"))


def _peaks(batch: pa.RecordBatch, values: tuple[str, ...]) -> np.ndarray:
    """The true peak of every block of a batch with halo."""
    peak = np.zeros(batch.num_rows)
    for v in values:
        for rows, x, begin, end in B.around(batch, v):
            peak[rows] = np.maximum(peak[rows], peak_between(x, begin, end))
    return peak


def gated_loudness(blocks: DataFrame, keys: list[str], z: str = "z", floor: float = -70.0) -> DataFrame:
    """lufs: of the blocks above -70, those less than 10 below the mean power of the former. One shuffle does both passes."""
    on = F.col(z) >= 10 ** ((ABSOLUTE - OFFSET) / 10)
    first = F.avg(F.when(on, F.col(z))).over(Window.partitionBy(*keys))
    power = F.avg(F.when(F.col(z) > F.col("gate"), F.col(z)))
    found = blocks.select(*keys, z, F.when(on, first * 10 ** (RELATIVE / 10)).alias("gate")).groupBy(*keys).agg(power.alias("power"))
    return found.select(*keys, F.coalesce(OFFSET + 10 * F.log10("power"), F.lit(floor)).alias("lufs"))


def integrated_loudness(blocks: DataFrame, keys: list[str], rate: int, block: int, values: tuple[str, ...] = SIDES, seconds: float = 0.4, floor: float = -70.0, half: int = 12) -> DataFrame:
    """lufs and true_peak_db of every scene, from windows of `seconds` with three quarters of overlap. Blocks are read three times
    and moved once; a row a hop is kept."""
    step, own, at = max(1, round(rate * seconds / 4)), weighting(rate), [*keys, "start"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*keys, "hop", "power", "n", "peak"]
        for batch in (part for whole in batches for part in B.parts(whole, values)):
            peaks = pa.array(_peaks(batch, values), pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), pa.array(batch.column("start").to_numpy() // step, pa.int64()), pa.array(np.zeros(len(peaks))), pa.array(np.zeros(len(peaks), np.int64)), peaks], names=names)
            for found in _by_hop(batch, keys, step, own, values):
                yield pa.RecordBatch.from_arrays([*found.columns, pa.nulls(found.num_rows, pa.float64())], names=names)

    slim = blocks.select(*at, *values)
    both = B.with_halo(slim, keys, half, half, block, values, B.starts(slim, keys, own, values))
    parts = both.mapInArrow(work, (B.kinds(blocks, keys) + ", " if keys else "") + "hop long, power double, n long, peak double")
    hops = kept(parts.groupBy(*keys, "hop").agg(F.sum("power").alias("power"), F.sum("n").alias("n"), F.max("peak").alias("peak")))
    top = hops.groupBy(*keys).agg(F.max("peak").alias("true_peak"))
    peak = top.select(*keys, F.when(F.col("true_peak") < 1e-10, -100.0).otherwise(20 * F.log10("true_peak")).alias("true_peak_db"))
    windows = window_powers(hops.drop("peak"), keys, step, 4)
    return peak.join(gated_loudness(windows, keys, floor=floor), keys, "left").select(*keys, F.coalesce("lufs", F.lit(floor)).alias("lufs"), "true_peak_db")


def short_term(blocks: DataFrame, keys: list[str], rate: int, values: tuple[str, ...] = SIDES, seconds: float = 3.0, hop: float = 1.0) -> DataFrame:
    """keys, block, db: the loudness of every whole window of `seconds`, one beginning every `hop`."""
    step = max(1, round(rate * hop))
    return window_powers(hop_powers(blocks, keys, rate, step, values), keys, step, round(seconds / hop)).select(*keys, "block", level(F.col("z")).alias("db")).filter("db IS NOT NULL")
