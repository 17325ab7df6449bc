"""Level and loudness aggregates and whole-scene rules over samples in long form (one row a sample)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wavequill.functions.scalars import level_to_db, quantize16
from wavequill.operators.envelopes import in_order, with_begins


def levels(samples: DataFrame, keys: list[str], value: str = "x") -> DataFrame:
    """n, rms_db, peak_db, crest_db, dc_offset, has_bad and is_loud per key, in one partial aggregation."""
    x = F.col(value)
    found = samples.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(x * x)).alias("rms"), F.max(F.abs(x)).alias("peak"), F.abs(F.avg(x)).alias("dc_offset"),
        F.bool_or(F.isnan(x) | (F.abs(x) == float("inf"))).alias("has_bad"), F.bool_or(x != 0).alias("is_loud"),
    )
    return found.select(*keys, "n", level_to_db(F.col("rms")).alias("rms_db"), level_to_db(F.col("peak")).alias("peak_db"), (level_to_db(F.col("peak")) - level_to_db(F.col("rms"))).alias("crest_db"), "dc_offset", "has_bad", "is_loud")


def block_levels(blocks: DataFrame, keys: list[str], values: tuple[str, ...] = ("left", "right")) -> DataFrame:
    """What `levels` says, of signals in blocks: each block is summed up where it lies (all channels together; n counts the
    samples of one), and only the sums are shuffled."""
    named = ["n", "total", "squares", "peak", "has_bad", "is_loud"]
    types = [pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.bool_(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                x = np.concatenate([batch.column(v)[i].values.to_numpy(zero_copy_only=False).astype(float) for v in values])
                rows.append((len(x) // len(values), x.sum(), (x * x).sum(), np.abs(x).max(initial=0.0), not np.isfinite(x).all(), bool((x != 0).any())))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(types))], names=[*keys, *named])

    kinds = {f.name: f.dataType.simpleString() for f in blocks.schema}
    parts = blocks.select(*keys, *values).mapInArrow(run, ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", n long, total double, squares double, peak double, has_bad boolean, is_loud boolean")
    m = F.col("n") * len(values)
    found = parts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("squares").alias("squares"), F.max("peak").alias("peak"), F.bool_or("has_bad").alias("has_bad"), F.bool_or("is_loud").alias("is_loud"))
    rms, peak = level_to_db(F.sqrt(F.col("squares") / m)), level_to_db(F.col("peak"))
    return found.select(*keys, "n", rms.alias("rms_db"), peak.alias("peak_db"), (peak - rms).alias("crest_db"), F.abs(F.col("total") / m).alias("dc_offset"), "has_bad", "is_loud")


def exact_mix(stems: DataFrame, at: list[str], value: str = "q") -> DataFrame:
    """Sums of quantised stems (integers: the order of addition doesn't matter) and whether all fit 16 bits."""
    return stems.groupBy(*at).agg(F.sum(F.col(value).cast("long")).alias("mix")).withColumn("fits", F.abs("mix") <= 32767)


def shared_gain(stems: DataFrame, scene: list[str], at: list[str], value: str = "x") -> DataFrame:
    """One gain per scene that keeps the mix and every stem below -1 dB full scale."""
    mix = stems.groupBy(*scene, *at).agg(F.abs(F.sum(value)).alias("mix"), F.max(F.abs(F.col(value))).alias("stem"))
    limit = 10 ** (-1 / 20)
    peak = mix.groupBy(*scene).agg(F.max(F.greatest("mix", "stem")).alias("peak"))
    return peak.withColumn("gain", F.when(F.col("peak") > limit, limit / F.col("peak")).otherwise(F.lit(1.0)))


def additivity(stems: DataFrame, mixes: DataFrame, scene: list[str], at: list[str]) -> DataFrame:
    """error: RMS difference of the mix and the sum of its stems; passes strictly below 1e-3. Missing mixes give infinity."""
    total = stems.groupBy(*scene, *at).agg(F.sum("x").alias("total"))
    both = total.join(mixes, [*scene, *at], "left")
    found = both.groupBy(*scene).agg(F.sqrt(F.avg(F.pow(F.col("mix") - F.col("total"), F.lit(2.0)))).alias("error"))
    return found.withColumn("error", F.coalesce("error", F.lit(float("inf")))).withColumn("passes", F.col("error") < 1e-3)


def block_additivity(sums: DataFrame, mixes: DataFrame, scene: list[str], values: tuple[str, ...] = ("left", "right")) -> DataFrame:
    """What `additivity` says, of signals in blocks: sums (of the stems) and mixes, at the same starts."""
    theirs = mixes.select(*scene, "start", *[F.col(v).alias(f"_{v}") for v in values])
    both = sums.join(theirs, [*scene, "start"], "left")
    squares = sum(F.aggregate(F.zip_with(v, f"_{v}", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x) for v in values)
    found = both.select(*scene, squares.alias("_e"), (F.size(values[0]) * len(values)).alias("_n")).groupBy(*scene).agg(F.sum("_e").alias("_e"), F.sum(F.when(F.col("_e").isNotNull(), F.col("_n"))).alias("_n"))
    error = F.coalesce(F.sqrt(F.col("_e") / F.col("_n")), F.lit(float("inf")))
    return found.select(*scene, error.alias("error"), (error < 1e-3).alias("passes"))


def linear_render(stems: DataFrame, scene: list[str], at: list[str]) -> DataFrame:
    """scene, at, mix, fits: the exact sum of all stems, quantised under the scene's shared gain."""
    gained = stems.join(shared_gain(stems, scene, at).select(*scene, "gain"), scene)
    return exact_mix(gained.withColumn("q", quantize16(F.col("x"), F.col("gain"))), [*scene, *at])


def stem_analysis(found: DataFrame, measured: DataFrame, keys: list[str], rate: int, ranges: DataFrame | None = None) -> DataFrame:
    """What a mixer is told of a stem, rounded: duration_sec, loudness_lufs, loudness_range_lu, true_peak_dbtp, rms_db and
    crest_factor_db, which is the true peak less the RMS. found: of `levels`; measured: lufs and true_peak_db; ranges: lra."""
    rows = found.select(*keys, "n", "rms_db").join(measured, keys)
    rows = rows.join(ranges.select(*keys, "lra"), keys, "left") if ranges is not None else rows.withColumn("lra", F.lit(None).cast("double"))
    one = lambda c: F.round(c, 1)
    return rows.select(*keys, F.round(F.col("n") / rate, 2).alias("duration_sec"), one("lufs").alias("loudness_lufs"), one(F.coalesce("lra", F.lit(0.0))).alias("loudness_range_lu"), one("true_peak_db").alias("true_peak_dbtp"), one("rms_db").alias("rms_db"), one(F.col("true_peak_db") - F.col("rms_db")).alias("crest_factor_db"))


def order_statistics(rows: DataFrame, keys: list[str], value: str, shares: dict[str, float], width: float = 0.1) -> DataFrame:
    """keys, n and, for each name, the value at the place floor(n * share) of the values in order (the last one at most), exactly and
    without gathering: values are counted by buckets of `width`, and only the buckets that hold a place are looked into.
    Nulls don't count."""
    each = rows.filter(F.col(value).isNotNull()).withColumn("_b", F.floor(F.col(value) / width))
    counts = each.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_c"))
    ordered, whole = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*keys)
    spread = counts.withColumn("_before", F.coalesce(F.sum("_c").over(ordered), F.lit(0))).withColumn("n", F.sum("_c").over(whole))  # as many rows as there are buckets
    places = F.array(*[F.struct(F.lit(name).alias("name"), F.least(F.floor(F.col("n") * F.lit(share)), F.col("n") - 1).alias("place")) for name, share in shares.items()])
    asked = spread.select(*keys, "_b", "_c", "_before", "n", F.explode(places).alias("p")).filter("p.place >= _before AND p.place < _before + _c")
    asked = asked.select(*keys, "_b", "n", F.col("p.name").alias("_name"), (F.col("p.place") - F.col("_before")).alias("_rank"))
    inside = each.join(asked.select(*keys, "_b").distinct(), [*keys, "_b"], "left_semi").groupBy(*keys, "_b", F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    upto = Window.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = inside.withColumn("_before", F.coalesce(F.sum("_c").over(upto), F.lit(0)))
    found = ranked.join(asked, [*keys, "_b"]).filter("_rank >= _before AND _rank < _before + _c")
    return found.groupBy(*keys).agg(F.first("n").alias("n"), *[F.max(F.when(F.col("_name") == name, F.col("_v"))).alias(name) for name in shares])


def loudness_range(blocks: DataFrame, keys: list[str], level: str = "db") -> DataFrame:
    """The span from the 10 % to the 95 % place (by index, not interpolated) of the block levels above -70; needs two."""
    found = order_statistics(blocks.filter(F.col(level) > -70), keys, level, {"low": 0.10, "high": 0.95})
    return found.select(*keys, F.when(F.col("n") >= 2, F.col("high") - F.col("low")).otherwise(F.lit(0.0)).alias("lra"))


def duration_spread(files: DataFrame, scene: list[str], n: str = "n", most: int = 10) -> DataFrame:
    found = files.groupBy(*scene).agg((F.max(n) - F.min(n)).alias("spread"), F.count(n).alias("files"))
    return found.withColumn("matches", (F.col("files") >= 2) & (F.col("spread") <= most))


def quiet_runs(blocks: DataFrame, keys: list[str], values: tuple[str, ...], floor: float = 1e-8) -> DataFrame:
    """keys, start and, of each block, n and the leading, trailing and longest run of samples that are below `floor` on all
    channels (what is no number is not): what runs across blocks can be put together from."""
    at = [*keys, "start"]
    named = ["n", "lead", "trail", "best"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                loud = ~np.all([np.abs(batch.column(v)[i].values.to_numpy(zero_copy_only=False).astype(float)) < floor for v in values], axis=0)
                places = np.flatnonzero(loud)
                gaps = np.diff([-1, *places, len(loud)]) - 1
                rows.append((len(loud), int(gaps[0]), int(gaps[-1]), int(gaps.max())))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in at), *(pa.array([r[k] for r in rows], pa.int64()) for k in range(4))], names=[*at, *named])

    kinds = {f.name: f.dataType.simpleString() for f in blocks.schema}
    return blocks.select(*at, *values).mapInArrow(run, ", ".join(f"`{k}` {kinds[k]}" for k in at) + "".join(f", {n} long" for n in named))


def longest_run(runs: DataFrame, keys: list[str]) -> DataFrame:
    """keys, longest: two neighbours (n, lead, trail, best) make one, and making is associative; a row a block is shuffled."""
    kinds = {f.name: f.dataType.simpleString() for f in runs.schema}

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = trail = 0
        held = None  # the key, as a batch of one row
        for batch, begins in with_begins(batches, keys):
            parts = []
            for i, fresh in enumerate(begins):
                n, lead, last, own = (batch.column(c)[i].as_py() for c in ("n", "lead", "trail", "best"))
                if fresh:
                    if held is not None:
                        parts.append((held, best))
                    held, best, trail = batch.slice(i, 1).select(keys), 0, 0
                best = max(best, own, trail + lead)
                trail = trail + n if last == n else last
            for key, longest in parts:
                yield pa.RecordBatch.from_arrays([*key.columns, pa.array([longest], pa.int64())], names=[*keys, "longest"])
        if held is not None:
            yield pa.RecordBatch.from_arrays([*held.columns, pa.array([best], pa.int64())], names=[*keys, "longest"])

    slim = runs.select(*keys, "start", "n", "lead", "trail", "best")
    return in_order(slim, keys, ["start"]).mapInArrow(merge, ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", longest long")


def longest_quiet(blocks: DataFrame, keys: list[str], values: tuple[str, ...] = ("left", "right"), floor: float = 1e-8) -> DataFrame:
    """The longest run of samples below `floor` on all channels. Blocks may have any lengths; `start` orders them."""
    return longest_run(quiet_runs(blocks, keys, values, floor), keys)


def validation(stems: DataFrame, scene: list[str], lufs: tuple[float, float] = (-35.0, -10.0), most_peak: float = 0.0, most_dc: float = 0.01) -> DataFrame:
    """The part of a report that stems' levels tell: the failed checks in order, and whether there are none.

    A quiet stem is an error unless it is music or sfx; every stem's RMS must lie in the range `lufs`. `scene_reports`
    applies all rules.
    """
    quiet = (F.col("rms_db") < -80) & ~F.col("stem").isin("music", "sfx")
    failed = F.array_compact(F.array(
        F.when(F.col("has_bad"), "nan_or_inf"), F.when(F.col("dc_offset") > most_dc, "dc_offset"), F.when(quiet, "silent"),
        F.when(F.col("peak_db") > most_peak, "peak"), F.when(~F.col("rms_db").between(*lufs), "loudness"),
    ))
    each = stems.withColumn("failed", failed)
    found = each.groupBy(*scene).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("failed")))).alias("errors"))  # five names at most
    return found.withColumn("is_valid", F.size("errors") == 0)


def roll_up(reports: DataFrame) -> DataFrame:
    """Totals and the pass rate (0 for no reports) over all scenes."""
    found = reports.agg(F.count(F.lit(1)).alias("total"), F.count_if("is_valid").alias("valid"))
    return found.withColumn("pass_rate", F.when(F.col("total") > 0, F.col("valid") / F.col("total")).otherwise(F.lit(0.0)))


def scene_reports(
    scenes: DataFrame, stems: DataFrame, sums: DataFrame, mixes: DataFrame, durations: DataFrame, scene: list[str],
    lufs: tuple[float, float] = (-35.0, -10.0), most_peak: float = 0.0, most_error: float = 1e-3, most_dc: float = 0.01, least_rms: float = -80.0, most_zeros: int = 48_000,
) -> DataFrame:
    """The whole report of every scene: errors and warnings (check, reason), is_valid, and the metrics they rest on.

    scenes: a row a scene with has_metadata, has_linear, stored_error and scene_type; stems: rms_db, dc_offset, has_bad and
    longest (run of zeros) per `stem`, as of `levels` and `longest_quiet`; sums: error, as of `additivity`; mixes: lufs and
    true_peak_db, as of `integrated_loudness`; durations: matches, as of `duration_spread`. A scene without metadata or
    linear files has this error alone. Long zeros are a warning, or an error where the stem fails for another reason.
    """
    say = lambda check, reason: F.struct((F.lit(check) if isinstance(check, str) else check).alias("check"), F.lit(reason).alias("reason"))
    listed = lambda *marks: F.array_compact(F.array(*marks))
    check = F.concat(F.lit("corruption_"), "stem")
    broken = listed(
        F.when(F.col("has_bad"), say(check, "nan_or_inf")), F.when((F.col("dc_offset") > most_dc) & ~F.isnan("dc_offset"), say(check, "dc_offset")),
        F.when((F.col("rms_db") < least_rms) & ~F.col("stem").isin("music", "sfx"), say(check, "silent")),
    )
    zeros = listed(F.when(F.col("longest") > most_zeros, say(check, "long_silence")))
    none = F.slice(zeros, 1, 0)
    each = stems.withColumn("broken", broken).withColumn("fails", F.size("broken") > 0)
    each = each.select(*scene, F.when(F.col("fails"), F.concat("broken", zeros)).otherwise(none).alias("e"), F.when(~F.col("fails"), zeros).otherwise(none).alias("w"))
    per = each.groupBy(*scene).agg(F.array_sort(F.flatten(F.collect_list("e"))).alias("stem_errors"), F.array_sort(F.flatten(F.collect_list("w"))).alias("stem_warnings"))  # a few a stem
    inputs = [per, sums.select(*scene, F.col("error").alias("additivity_error")), mixes.select(*scene, "lufs", "true_peak_db"), durations.select(*scene, F.col("matches").alias("durations_match"))]
    all_of = scenes.select(*scene, "has_metadata", "has_linear", "stored_error", "scene_type")
    for part in inputs:
        all_of = all_of.join(part, scene, "left")
    error = F.coalesce("additivity_error", F.lit(float("inf")))
    errors = listed(
        F.when(~(error < most_error) | F.isnan(error), say("additivity", "sum_differs")), F.when(F.col("lufs") < lufs[0], say("loudness", "too_quiet")),
        F.when((F.col("lufs") > lufs[1]) & ~F.isnan("lufs"), say("loudness", "too_loud")), F.when((F.col("true_peak_db") > most_peak) & ~F.isnan("true_peak_db"), say("loudness", "clipping")),
        F.when(~F.coalesce("durations_match", F.lit(False)), say("duration", "mismatch")),
    )
    warnings = listed(F.when((F.col("stored_error") > most_error) & ~F.isnan("stored_error"), say("additivity_stored", "high")))
    has_metadata, has_linear = F.coalesce("has_metadata", F.lit(False)), F.coalesce("has_linear", F.lit(False))
    ready = has_metadata & has_linear
    found = F.when(~has_metadata, F.array(say("metadata", "missing"))).when(~has_linear, F.array(say("structure", "missing"))).otherwise(F.concat(errors, F.coalesce("stem_errors", F.slice(errors, 1, 0))))
    warned = F.when(ready, F.concat(warnings, F.coalesce("stem_warnings", F.slice(warnings, 1, 0)))).otherwise(F.slice(warnings, 1, 0))
    only = lambda c: F.when(ready, c)
    return all_of.select(
        *scene, found.alias("errors"), warned.alias("warnings"), (F.size(found) == 0).alias("is_valid"), only(error).alias("additivity_error"), only(F.col("stored_error")).alias("stored_error"),
        only(F.col("lufs")).alias("lufs"), only(F.col("true_peak_db")).alias("true_peak_db"), only(F.col("scene_type")).alias("scene_type"),
    )


def report_roll_up(reports: DataFrame) -> DataFrame:
    """One row over whole reports: totals, pass rate, error counts by check and the metrics' means and ends (loudness
    and peaks of 0 and infinite additivity errors are left out, as are missing ones)."""
    nonzero = lambda c: F.when(F.col(c) != 0, F.col(c))
    added = F.when(F.col("additivity_error") < float("inf"), F.col("additivity_error"))
    totals = roll_up(reports).join(reports.agg(
        F.count_if(~F.col("is_valid")).alias("invalid"), F.count_if(F.col("is_valid") & (F.size("warnings") > 0)).alias("with_warnings"),
        F.avg(nonzero("lufs")).alias("lufs_mean"), F.min(nonzero("lufs")).alias("lufs_min"), F.max(nonzero("lufs")).alias("lufs_max"),
        F.avg(nonzero("true_peak_db")).alias("peak_mean"), F.max(nonzero("true_peak_db")).alias("peak_max"), F.avg(added).alias("additivity_mean"), F.max(added).alias("additivity_max"),
    ))
    counts = reports.select(F.explode("errors.check").alias("check")).groupBy("check").agg(F.count(F.lit(1)).alias("n"))
    return totals.join(counts.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("check", "n")))).alias("error_counts")))  # a name a check
