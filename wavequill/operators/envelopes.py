"""Gain envelopes: the sidechain recurrence, sparse keyframes and their interpolation.

Scenes run in parallel. In SQL form a scene's samples are folded by a higher-order function, for control-rate signals
and tests; `sidechain_blocks` keeps audio-rate scenes in Arrow and scans them in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sidechain(samples: DataFrame, keys: list[str], order: list[str], level: str, threshold: float, reduction: float, attack: float, release: float) -> DataFrame:
    """g <- c g + (1 - c) t with (attack, reduction) while the level is above the threshold and (release, 1) else;
    g starts at 1. One row per key: the last gain and the least."""
    series = samples.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*order, F.col(level).alias("lvl")))).alias("s"))
    start = F.struct(F.lit(1.0).alias("g"), F.lit(1.0).alias("low"))

    def step(acc: Column, x: Column) -> Column:
        on = x["lvl"] > threshold
        g = F.when(on, attack * acc["g"] + (1 - attack) * reduction).otherwise(release * acc["g"] + (1 - release))
        return F.struct(g.alias("g"), F.least(acc["low"], g).alias("low"))

    return series.select(*keys, F.aggregate("s", start, step).alias("a")).select(*keys, F.col("a.g").alias("last_gain"), F.col("a.low").alias("least_gain"))


def block_size(n: int) -> int:
    """Samples of a block, so that steps within blocks and steps over blocks are about as many."""
    return max(1, math.isqrt(n))


def affine_scan(coefficient: np.ndarray, addend: np.ndarray, first: float | np.ndarray, block: int | None = None) -> np.ndarray:
    """All states of g <- c g + d, for a signal or for every row of a matrix (`first`: a number, or one a row): blocks advance side
    by side, one sample a step, then take their starts in turn."""
    shape, n = coefficient.shape, coefficient.shape[-1]
    many = coefficient.size // n if n else 0
    block = block or block_size(n)
    rows = -(-n // block) if n else 0
    c, d = np.ones((many, rows * block)), np.zeros((many, rows * block))
    c[:, :n], d[:, :n] = coefficient.reshape(many, n), addend.reshape(many, n)
    c, d = c.reshape(many * rows, block).T.copy(), d.reshape(many * rows, block).T.copy()
    for i in range(1, block if rows else 0):
        d[i] += c[i] * d[i - 1]
        c[i] *= c[i - 1]
    start, whole, added = np.empty((many, rows)), c[-1:].reshape(many, rows), d[-1:].reshape(many, rows)
    first = np.broadcast_to(np.asarray(first, float), (many,))
    for k in range(rows):
        start[:, k] = first
        first = whole[:, k] * first + added[:, k]
    return (c * start.ravel() + d).T.reshape(many, rows * block)[:, :n].reshape(shape)


def sidechain_blocks(samples: DataFrame, key: str, order: str, level: str, threshold: float, reduction: float, attack: float, release: float) -> DataFrame:
    """The whole envelope of every scene (key, order, gain), one scene a group."""

    def scan(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(order)
        on = rows[level].to_numpy() > threshold
        c = np.where(on, attack, release)
        return pd.DataFrame({key: rows[key], order: rows[order], "gain": affine_scan(c, (1 - c) * np.where(on, reduction, 1.0), 1.0)})

    kinds = {f.name: f.dataType.simpleString() for f in samples.schema}
    return samples.select(key, order, level).groupBy(key).applyInPandas(scan, f"{key} {kinds[key]}, {order} {kinds[order]}, gain double")


def in_order(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """All rows of a key in one partition, sorted (on disk where need be), for a scan that streams through them."""
    return df.repartition(*keys).sortWithinPartitions(*keys, *order)


def with_begins(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.RecordBatch, list[bool]]]:
    """Every batch of sorted rows, and which of its rows begin a key."""
    last = None
    for batch in batches:
        names = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True))
        yield batch, [n != before for n, before in zip(names, [last, *names], strict=False)]
        last = names[-1] if names else last


def keyframes(frames: DataFrame, keys: list[str], at: str, db: str, least: float = 0.5) -> DataFrame:
    """The frames whose level differs by `least` dB or more from the last frame that was kept (not from the last one). Each
    depends on all before it, so one pass streams through a scene's frames, some hundred a second at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = math.inf
        for batch, begins in with_begins(batches, keys):
            kept = []
            for i, (x, first) in enumerate(zip(batch.column(db).to_pylist(), begins, strict=True)):
                if first or abs(x - last) >= least:
                    kept.append(i)
                    last = x
            yield batch.take(pa.array(kept, pa.int64()))

    slim = frames.filter(F.col(db).isNotNull()).select(*keys, at, db)
    return in_order(slim, keys, [at]).mapInArrow(run, slim.schema)


def with_ends(points: DataFrame, samples: DataFrame, keys: list[str], at: str, gain: str, db: str, order: list[str], gap: float = 0.01) -> DataFrame:
    """The keyframes and the last sample of every scene whose last keyframe lies more than `gap` before it, or that has
    none. `at` is a time in one unit in both tables; `gain` of the sample is linear, `db` of the keyframes its level."""
    last = samples.groupBy(*keys).agg(F.max_by(F.struct(at, gain), F.struct(*dict.fromkeys([at, *order]))).alias("end"))
    ends = last.select(*keys, F.col("end")[at].alias(at), (20 * F.log10(F.greatest(F.col("end")[gain], F.lit(1e-6)))).alias(db))
    kept = points.groupBy(*keys).agg(F.max(at).alias("kept"))
    missing = ends.join(kept, keys, "left").filter(F.col("kept").isNull() | (F.col("kept") < F.col(at) - gap))
    return points.select(*keys, at, db).unionByName(missing.select(*keys, at, db))


def interpolated(frames: DataFrame, points: DataFrame, keys: list[str], at: str, value: str, cell: float | None = None) -> DataFrame:
    """`value` of the points at the times of the frames: linear between neighbours, flat beyond the ends, 1 without points.

    With `cell`, scenes are cut into cells of that much time, each worked out apart with the points next to it; what a
    task holds of a scene is a cell, and a row for every cell."""
    span = F.floor(F.col(at) / cell) if cell else F.lit(0).cast("long")
    both = frames.select(*keys, at, F.lit(None).cast("double").alias(value), F.lit(True).alias("asked")).unionByName(points.select(*keys, at, value, F.lit(False).alias("asked"))).withColumn("_cell", span)
    here = F.when(~F.col("asked"), F.struct(F.col(at).alias("t"), F.col(value).alias("v")))
    so_far = lambda *order: F.last(here, True).over(Window.partitionBy(*keys, "_cell").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    # the next point is the last one seen when time runs backward; both passes grow by a row at a time
    near = both.withColumn("b", so_far(at, "asked")).withColumn("a", so_far(F.desc(at), F.desc("asked")))
    if cell:
        own = both.groupBy(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_cell").alias("_c")).agg(F.max(here).alias("_last"), F.min(here).alias("_first"))
        beyond = lambda point, order: F.last(point, True).over(Window.partitionBy(*[f"_{k}" for k in keys]).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
        ends = own.withColumn("_before", beyond("_last", F.asc("_c"))).withColumn("_after", beyond("_first", F.desc("_c"))).drop("_last", "_first")
        same = F.col("_cell").eqNullSafe(F.col("_c"))
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
        near = near.join(ends, same).withColumn("b", F.coalesce("b", "_before")).withColumn("a", F.coalesce("a", "_after"))
    inside = F.when(F.col("a.t") == F.col("b.t"), F.col("b.v")).otherwise(F.col("b.v") + (F.col("a.v") - F.col("b.v")) * (F.col(at) - F.col("b.t")) / (F.col("a.t") - F.col("b.t")))
    return near.filter("asked").select(*keys, at, F.coalesce(F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), inside), "b.v", "a.v", F.lit(1.0)).alias(value))
