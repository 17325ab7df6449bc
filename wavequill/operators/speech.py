"""Speech corpora: dialogues from utterances, picks by emotion, type and duration, all reproducible.

Where a choice is free, rows are taken in the order of a hash of their key (`drawn`), so reruns agree. Clips without a
duration are those whose file is missing; they are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wavequill.functions.scalars import style_of
from wavequill.operators.lookups import containing

#: names of emotions as the labelled corpora have them (fixed values)
SYNONYMS = {
    "ravdess": {"anger": "angry", "joy": "happy", "happiness": "happy", "sadness": "sad", "fear": "fearful", "surprise": "surprised"},
    "ased": {"anger": "angry", "joy": "happy", "happiness": "happy", "sadness": "sad", "fear": "fearful"},
}
#: styles whose names in a path stand for an emotion (fixed values)
STYLES = {
    "anger": ["angry", "frustrated"], "joy": ["happy", "laughing", "excited"], "sadness": ["sad", "sympathetic"], "fear": ["scared", "whisper"],
    "surprise": ["surprised", "confused"], "disgust": ["disgusted", "sarcastic"], "neutral": ["default", "neutral", "projected"],
}
#: corpora in the order in which they are asked
CASCADE = ("ravdess", "ased", "expresso")


def drawn(*keys: Column) -> Column:
    """A hash to order free choices by."""
    return F.md5(F.concat_ws("/", *[k.cast("string") for k in keys]).cast("binary"))


def synonym(emotion: Column, source: str) -> Column:
    """The corpus's name for an emotion; itself if it has no other."""
    known = SYNONYMS.get(source, {})
    return F.coalesce(*[F.when(emotion == k, F.lit(v)) for k, v in known.items()], emotion)


def styles_of(emotion: Column) -> Column:
    """What a path may say for an emotion; itself if nothing else stands for it."""
    return F.coalesce(*[F.when(emotion == k, F.array(*map(F.lit, v))) for k, v in STYLES.items()], F.array(emotion))


def typed_clips(entries: DataFrame, types: str) -> DataFrame:
    """A row per clip and type; clips without types have the type unknown."""
    return entries.withColumn("nv_type", F.explode(F.when(F.size(types) > 0, F.col(types)).otherwise(F.array(F.lit("unknown")))))


#: words of wanted emotions that paths are searched for one by one; more are looked up
MANY_WORDS = 200


def _pieces(text: Column, n: int) -> Column:
    """All parts of n characters."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(text) - n + 1, F.lit(1)))
    return F.transform(starts, lambda i: F.substr(text, i, F.lit(n)))


def by_emotion(wanted: DataFrame, clips: DataFrame, least: float, most: float) -> DataFrame:
    """emotion, source, clip, label for every wanted emotion, null where no corpus has any in the range of durations.

    clips: clip, source, emotion, path, duration. Labelled corpora match by their name of the emotion, the last one by
    styles that its paths contain; the first corpus of the cascade with a clip gives it.
    """
    lower = F.lower("emotion")
    asked = wanted.select("emotion").distinct()
    fits = clips.filter(F.col("duration").between(least, most)).select("clip", "source", F.col("emotion").alias("label"), "path")
    names = asked.select("emotion", F.explode(F.array(*[F.struct(F.lit(s).alias("source"), synonym(lower, s).alias("label")) for s in SYNONYMS])).alias("n")).select("emotion", "n.source", "n.label")
    labelled = names.join(fits.select("clip", "source", "label"), ["source", "label"]).select("emotion", "source", "clip", "label")
    words = asked.select("emotion", F.explode(styles_of(lower)).alias("label"))
    known = [r[0] for r in words.select("label").distinct().limit(MANY_WORDS + 1).collect()]
    if len(known) <= MANY_WORDS:  # the words a path says are asked for one by one
        pieces = F.filter(F.array(*map(F.lit, known)).cast("array<string>"), lambda w: F.contains(F.lower("path"), w))
    else:  # many words meet the paths' parts of their lengths by equality
        sizes = [r[0] for r in words.select(F.length("label").alias("n")).distinct().collect()]  # lengths of words
        pieces = F.array_distinct(F.flatten(F.array(*[_pieces(F.lower("path"), n) for n in sizes])))
    styled = fits.filter(F.col("source") == CASCADE[-1]).select("clip", F.explode(pieces).alias("label")).join(words, "label").select("emotion", F.lit(CASCADE[-1]).alias("source"), "clip", "label")
    place = F.array_position(F.array(*map(F.lit, CASCADE)), F.col("source"))
    best = labelled.unionByName(styled).groupBy("emotion").agg(F.min_by(F.struct("source", "clip", "label"), F.struct(place, drawn(F.col("clip"), F.col("emotion")), "label")).alias("b"))
    return asked.join(best, "emotion", "left").select("emotion", "b.source", "b.clip", "b.label")


def pick_in_range(clips: DataFrame, keys: list[str], clip: str, duration: str, least: float, most: float) -> DataFrame:
    """One clip per key of those whose duration lies in the range, by a draw; keys without any are left out."""
    fits = clips.filter(F.col(duration).between(least, most))
    return fits.groupBy(*keys).agg(F.min_by(F.struct(clip, duration), drawn(F.col(clip))).alias("p")).select(*keys, f"p.{clip}", f"p.{duration}")


def random_source(key: Column, available: Column) -> Column:
    """One of an array of available sources by a draw; null for an empty one."""
    u = F.conv(F.substring(drawn(key), 1, 8), 16, 10).cast("long")
    return F.when(F.size(available) > 0, F.element_at(available, (F.pmod(u, F.greatest(F.size(available), F.lit(1))) + 1).cast("int")))


def nonverbal_clips(wanted: DataFrame, clips: DataFrame, least: float, most: float, tries: int = 20) -> DataFrame:
    """request, clip: a clip for every request (request, nv_type, emotion; null: any), or null.

    clips: clip, nv_type, emotion, duration, a row per clip and type. Those of exactly the type are candidates, else those
    of types that contain it or lie in it, else none. Of those with the emotion (in any case), `tries` are drawn, and the
    first of them in the range of durations is taken.
    """
    types = clips.select(F.col("nv_type").alias("known")).distinct()
    named = wanted.filter(F.col("nv_type").isNotNull()).select("nv_type").distinct()
    met = containing(named, "nv_type", types, "known").withColumn("same", F.col("nv_type") == F.col("known"))
    exact = F.max("same").over(Window.partitionBy("nv_type"))
    usable = met.withColumn("exact", exact).filter(~F.col("exact") | F.col("same")).select("nv_type", "known")
    own = wanted.join(usable, "nv_type").unionByName(wanted.filter(F.col("nv_type").isNull()).join(types).select("nv_type", "request", "emotion", "known"))
    candidates = own.join(clips.select(F.col("nv_type").alias("known"), "clip", F.col("emotion").alias("felt"), "duration"), "known")
    candidates = candidates.filter(F.col("emotion").isNull() | (F.lower("emotion") == F.lower(F.coalesce("felt", F.lit("")))))
    order = Window.partitionBy("request").orderBy(drawn(F.col("request"), F.col("clip")), "known")
    tried = candidates.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= tries)
    found = tried.filter(F.col("duration").between(least, most)).groupBy("request").agg(F.min_by("clip", "place").alias("clip"))
    return wanted.select("request").join(found, "request", "left")


def dialogues(utterances: DataFrame, keys: list[str], order: list[str], duration: str, speaker: str, emotion: str, gap: float = 0.3, least: float = 10.0, most: float = 120.0) -> DataFrame:
    """keys, seconds, n, speakers (sorted), emotion (the most frequent, of equals the first): utterances in order with gaps
    until `most` is reached; shorter ones than `least` are left out."""
    before = Window.partitionBy(*keys).orderBy(*order)
    real = utterances.filter(F.col(duration).isNotNull())
    so_far = F.coalesce(F.sum(F.col(duration) + gap).over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    kept = real.withColumn("_place", F.row_number().over(before)).withColumn("_before", so_far).filter((F.col("_place") == 1) | (F.col("_before") - gap < most))
    counted = kept.groupBy(*keys, emotion).agg(F.count(F.lit(1)).alias("n"), F.sum(duration).alias("d"), F.min("_place").alias("first"), F.collect_set(speaker).alias("s"))
    found = counted.groupBy(*keys).agg(F.sum("d").alias("d"), F.sum("n").alias("n"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("s")))).alias("speakers"), F.max_by(emotion, F.struct("n", -F.col("first"))).alias(emotion))
    return found.withColumn("seconds", F.col("d") + gap * (F.col("n") - 1)).filter(F.col("seconds") >= least).select(*keys, "seconds", "n", "speakers", emotion)


def distinct_speakers(clips: DataFrame, keys: list[str], speaker: str, clip: str, duration: str, most: int = 4, gap: float = 0.15, least: float = 8.0) -> DataFrame:
    """keys, clips, speakers, seconds: at most `most` drawn clips; with more than twice as many to choose from, of
    different speakers. Results of under `least` seconds or two clips are left out."""
    rows = clips.filter(F.col(duration).isNotNull()).withColumn("_draw", drawn(F.col(clip)))
    many = F.count(F.lit(1)).over(Window.partitionBy(*keys)) > 2 * most
    own = F.row_number().over(Window.partitionBy(*keys, speaker).orderBy("_draw"))
    rows = rows.withColumn("_many", many).withColumn("_own", own).filter(~F.col("_many") | (F.col("_own") == 1))
    rows = rows.withColumn("_place", F.row_number().over(Window.partitionBy(*keys).orderBy("_draw"))).filter(F.col("_place") <= most)
    found = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(clip)).alias("clips"), F.array_sort(F.collect_set(speaker)).alias("speakers"), (F.sum(duration) + gap * (F.count(F.lit(1)) - 1)).alias("seconds"))
    return found.filter((F.col("seconds") >= least) & (F.size("clips") >= 2))


def groups_of_actors(clips: DataFrame, keys: list[str], actor: str, least: int = 2) -> DataFrame:
    """keys, actors: groups of at least so many different actors."""
    return clips.groupBy(*keys).agg(F.count_distinct(actor).alias("actors")).filter(F.col("actors") >= least)


def built_to(clips: DataFrame, keys: list[str], order: list[str], length: str, gap: float, target: float) -> DataFrame:
    """Clips in order, each followed by a gap, until the target is reached: offset, kept (what the cut at the target leaves)
    and `enough`, whether all clips reach it."""
    w = Window.partitionBy(*keys).orderBy(*order)
    total = F.sum(F.col(length) + gap).over(Window.partitionBy(*keys))
    rows = clips.withColumn("offset", F.coalesce(F.sum(F.col(length) + gap).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))).withColumn("enough", total >= target)
    kept = rows.filter(F.col("offset") < target)
    return kept.withColumn("kept", F.least(F.col(length).cast("double"), F.lit(target) - F.col("offset")))


def dialogue_rows(clips: DataFrame, source: str, clip: str = "clip", path: str = "path", duration: str = "duration") -> DataFrame:
    """Picked clips as dialogues: path, source, emotion, style, duration_sec, speakers, utterances. Corpora without labels take
    the style, the folder of a path, for the emotion."""
    kinds = dict(clips.dtypes)
    emotion = F.col("emotion") if "emotion" in kinds else style_of(F.col(path))
    style = style_of(F.col(path)) if "emotion" not in kinds else F.concat(F.lit(source + "_"), emotion)
    speakers = F.array(F.col("speaker")) if "speaker" in kinds else F.array(F.lit("speaker"))
    texts = F.array(F.col("text")) if "text" in kinds else F.array().cast("array<string>")
    return clips.select(F.col(clip).alias("clip"), F.col(path).alias("path"), F.lit(source).alias("source"), emotion.alias("emotion"), style.alias("style"), F.col(duration).alias("duration_sec"), speakers.alias("speakers"), texts.alias("utterances"))


def synonyms_table(spark: SparkSession) -> DataFrame:
    """source, emotion, label: the synonyms as a dimension."""
    return spark.createDataFrame([(s, k, v) for s, names in SYNONYMS.items() for k, v in names.items()], "source string, emotion string, label string")
