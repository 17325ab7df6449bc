"""Events on a timeline: normalisation, overlap, placement, windows and concatenation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def normalised_times(events: DataFrame, keys: list[str], ts: str, duration: Column) -> DataFrame:
    """Times beyond the scene scale all of its times down to nine tenths of it; all stay within the scene. A null time is
    0. Without a positive duration, and in scenes without any time, they stay as they are. Rows meet their scene's largest
    time in a join, so a scene of any size is split where joins are."""
    tops = events.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.max(ts).alias("_top"))  # counted before the shuffle
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    top = F.col("_top")
    scaled = F.when(top <= duration, F.col(ts)).otherwise(F.col(ts) * 0.9 * duration / top)
    inside = F.least(F.greatest(scaled, F.lit(0.0)), F.greatest(F.lit(0.0), duration - 0.05))
    timed = events.join(tops, same).withColumn("at", F.when((duration > 0) & top.isNotNull(), inside).otherwise(F.col(ts)))
    return timed.drop("_top", *[f"_{k}" for k in keys])


def _level(bucket: int) -> Column:
    """The least power of two of buckets that is as long as a span."""
    length = F.greatest((F.col("stop") - F.col("start")) / bucket, F.lit(1.0))
    return F.ceil(F.round(F.log2(length), 9)).cast("int")


def binned(spans: DataFrame, bucket: int, levels: list[int] | None = None, beyond: int = 0) -> DataFrame:
    """`spans` with level and bin: a span lies in two bins of its own level, whatever its length (levels None), or in two bins
    of each of `levels` that is at least its own and `beyond`."""
    own = _level(bucket)
    wanted = F.array(own) if levels is None else F.filter(F.array(*map(F.lit, levels)).cast("array<int>"), lambda k: k >= own + beyond)
    each = spans.withColumn("level", F.explode(wanted))
    width = bucket * F.pow(F.lit(2.0), F.col("level"))
    return each.withColumn("bin", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor(F.greatest("start", "stop") / width))))


def overlapping(left: DataFrame, right: DataFrame, keys: list[str], bucket: int) -> DataFrame:
    """Pairs of spans (start, stop) that overlap, by equi-joins over nested bins: each span is at home in two bins about as
    long as itself, and visits the homes of longer ones, two bins for each length (a power of two) that the other side has.
    A pair is reported in the bin where the later of the two begins, so once."""
    theirs = right.select(*keys, F.col("id").alias("id2"), "start", "stop")
    renamed = lambda df: df.withColumnsRenamed({"start": "start2", "stop": "stop2"})
    found = lambda df: sorted(r[0] for r in df.select(_level(bucket).alias("level")).distinct().collect() if r[0] is not None)  # noqa: E731 (some sixty at most)
    long_left, long_right = found(left), found(theirs)
    at = [*keys, "level", "bin"]
    visits = binned(left, bucket, long_right).join(renamed(binned(theirs, bucket)), at)
    visited = binned(left, bucket).join(renamed(binned(theirs, bucket, long_left, 1)), at)
    met = visits.unionByName(visited).filter((F.col("start") < F.col("stop2")) & (F.col("start2") < F.col("stop")))
    width = bucket * F.pow(F.lit(2.0), F.col("level"))
    return met.filter(F.col("bin") == F.floor(F.greatest("start", "start2") / width)).drop("level", "bin")


def placed(events: DataFrame, keys: list[str], length: int) -> DataFrame:
    """Sums of overlapping events (start, samples) per position; what reaches beyond `length` is cut."""
    each = events.select(*keys, "start", F.posexplode("samples").alias("i", "x")).withColumn("pos", F.col("start") + F.col("i"))
    return each.filter((F.col("pos") >= 0) & (F.col("pos") < length)).groupBy(*keys, "pos").agg(F.sum("x").alias("x"))


def chunks(scenes: DataFrame, total: str, size: int, hop: int) -> DataFrame:
    """The offsets of all full windows of every scene."""
    return scenes.filter(F.col(total) >= size).withColumn("offset", F.explode(F.sequence(F.lit(0).cast("long"), F.col(total).cast("long") - size, F.lit(hop).cast("long"))))


def until_long_enough(clips: DataFrame, keys: list[str], order: list[str], length: str, gap: float, target: float) -> DataFrame:
    """Clips in order with their offsets, as long as those before them (with gaps) stay below the target."""
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return clips.withColumn("offset", F.coalesce(F.sum(F.col(length) + gap).over(before), F.lit(0.0))).filter(F.col("offset") < target)


def interleaved(clips: DataFrame, keys: list[str], actor: str, order: list[str]) -> DataFrame:
    """Clips of two actors in turn (A, B, A, B, ...) until the one whose turn it is has none left."""
    turn = F.row_number().over(Window.partitionBy(*keys, actor).orderBy(*order))
    actors = F.dense_rank().over(Window.partitionBy(*keys).orderBy(actor))
    ranked = clips.withColumn("turn", turn).withColumn("who", actors).filter("who <= 2")
    sizes = ranked.groupBy(*keys).agg(F.count_if(F.col("who") == 1).alias("n1"), F.count_if(F.col("who") == 2).alias("n2")).filter("n1 > 0 and n2 > 0")
    kept = ranked.join(sizes, keys).filter((F.col("turn") <= F.col("n2") + F.when(F.col("who") == 1, 1).otherwise(0)) & (F.col("turn") <= F.col("n1")))
    return kept.withColumn("slot", 2 * (F.col("turn") - 1) + F.col("who")).drop("n1", "n2")
