"""Validation of scenes from their signals: every input of the rules is measured on the stems' and the mix's blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavequill.operators import levels, loudness, signals
from wavequill.sources.documents import scene_documents, scene_of
from wavequill.sources.sound import sound
from wavequill.storage import kept


def signal_reports(scenes: DataFrame, stems: DataFrame, mixes: DataFrame, keys: list[str], rate: int, block: int, seconds: float = 0.4, **limits) -> DataFrame:
    """The report of every scene of `scenes` (keys, has_metadata, has_linear, stored_error, scene_type), as of `levels.scene_reports`.

    stems: blocks (keys, stem, start, left, right); mixes: blocks (keys, start, left, right). Levels, runs of zeros and lengths
    are those of each stem; the additivity error compares the mix with the sum of the stems; loudness (over windows of
    `seconds`) and true peak are the mix's. Both tables are read several times: let them be tables. limits: those of the rules.
    """
    stem = [*keys, "stem"]
    each = levels.block_levels(stems, stem).join(levels.longest_quiet(stems, stem), stem)
    sums = levels.block_additivity(signals.mixed(stems, keys), mixes, keys)
    loud = loudness.integrated_loudness(mixes, keys, rate, block, seconds=seconds)
    files = signals.lengths(stems, stem).select(*keys, "n").unionByName(signals.lengths(mixes, keys).select(*keys, "n"))
    return levels.scene_reports(scenes, each, sums, loud, levels.duration_spread(files, keys), keys, **limits)


def folder_reports(spark, root: str, rate: int = 48_000, **limits) -> DataFrame:
    """The reports of a dataset's folder: a row a scene with a metadata file, measured on the files of its `linear` folder, of which
    mix.wav is the mix and all others are stems. Resampled to `rate`."""
    files = sound(spark, root, rate=rate).filter("block_no IS NOT NULL")
    parts = files.select(scene_of(F.col("path"), 3).alias("scene_name"), F.element_at(F.split("path", "/"), -2).alias("folder"), F.regexp_extract("path", r"([^/]+)\.wav$", 1).alias("stem"), F.col("start_sample").alias("start"), *[F.col(s).cast("array<double>").alias(s) for s in signals.SIDES])
    linear = kept(parts.filter("folder = 'linear'").drop("folder"))
    return signal_reports(scene_documents(spark, root), linear.filter("stem <> 'mix'"), linear.filter("stem = 'mix'").drop("stem"), ["scene_name"], rate, rate, **limits)
