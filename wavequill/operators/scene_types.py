"""The scene types' dimension and what is looked up in it: stem offsets, presence, event counts, codes, guidance.

The table has six rows, so lookups broadcast it. Unknown and null types take the default type's row. Draws come from a
hash of the scene's key, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wavequill.functions.scalars import presence, unit_hash

#: scene types (fixed values): name, probabilities of speech, music and ambience, least and most sound events, gain
#: offsets of speech, music, ambience and sfx, whether music and sfx are ducked, focus
SCENE_TYPES = [
    ("dialogue_heavy", 1.0, 0.9, 0.95, 1, 5, 0.0, 0.0, -3.0, 0.0, True, True, "dialogue_clarity"),
    ("music_montage", 0.2, 1.0, 0.7, 0, 3, -6.0, 6.0, 0.0, -3.0, False, False, "music_emotion"),
    ("ambient", 0.3, 0.5, 1.0, 2, 8, -3.0, -3.0, 6.0, 3.0, True, False, "atmosphere"),
    ("action_sfx", 0.6, 0.8, 0.7, 5, 12, 3.0, 0.0, -6.0, 6.0, True, True, "action_intensity"),
    ("sparse", 0.5, 0.3, 0.4, 0, 2, 0.0, -3.0, -3.0, -3.0, True, True, "minimal"),
    ("balanced", 1.0, 1.0, 1.0, 2, 6, 0.0, 0.0, 0.0, 0.0, True, True, "balanced"),
]
NAMES = [row[0] for row in SCENE_TYPES]
DEFAULT_TYPE = "dialogue_heavy"
STEMS = ("speech", "music", "ambience", "sfx")
SCHEMA = "scene_type string, speech_prob double, music_prob double, ambience_prob double, sfx_min int, sfx_max int, speech_offset double, music_offset double, ambience_offset double, sfx_offset double, duck_music boolean, duck_sfx boolean, focus string"
#: what a planner is told for each focus
GUIDANCE = {
    "dialogue_clarity": "Keep every word intelligible; choose quiet music and sounds that leave the speech band free.",
    "music_emotion": "Let the music lead; few events, short or no speech.",
    "atmosphere": "Build the place from ambience; natural events, faint or no music.",
    "action_intensity": "Many events and driving music; speech stays on top.",
    "minimal": "Use as little as possible; silence is part of the scene.",
    "balanced": "Give all parts about equal weight.",
}


def scene_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SCENE_TYPES, SCHEMA)


def with_scene_type(rows: DataFrame, scene_type: str) -> DataFrame:
    """The columns of the type's row beside every row; `scene_type` becomes the name of the row taken."""
    name = F.when(F.col(scene_type).isin(NAMES), F.col(scene_type)).otherwise(DEFAULT_TYPE)
    return rows.withColumn("_type", name).drop(scene_type).withColumnRenamed("_type", scene_type).join(F.broadcast(scene_types(rows.sparkSession).withColumnRenamed("scene_type", scene_type)), scene_type)


def stem_offsets(scenes: DataFrame, keys: list[str]) -> DataFrame:
    """keys, stem, offset: four rows a scene of `with_scene_type`."""
    return scenes.select(*keys, F.explode(F.array(*[F.struct(F.lit(s).alias("stem"), F.col(f"{s}_offset").alias("offset")) for s in STEMS])).alias("s")).select(*keys, "s.stem", "s.offset")


def includes(key: Column, stem: str, probability: Column) -> Column:
    return unit_hash(key, stem) < probability


def event_count(key: Column, least: Column, most: Column) -> Column:
    return (least + F.floor(unit_hash(key, "events") * (most - least + 1))).cast("int")


def type_code(scene_type: Column) -> Column:
    """The place in NAMES; 0 for unknown and null ones."""
    return F.greatest(F.coalesce(F.array_position(F.array(*map(F.lit, NAMES)), scene_type), F.lit(0)).cast("int") - 1, F.lit(0))


def summary(scene_type: Column, speech: Column, music: Column, least: Column, most: Column) -> Column:
    """Such as `sparse [speech:likely, music:rare, sfx:0-2]`."""
    return F.concat(scene_type, F.lit(" [speech:"), presence(speech), F.lit(", music:"), presence(music), F.lit(", sfx:"), least, F.lit("-"), most, F.lit("]"))


def guidance(focus: Column) -> Column:
    """The text for a focus, empty for others."""
    found = F.coalesce(*[F.when(focus == k, F.lit(v)) for k, v in GUIDANCE.items()])
    return F.coalesce(found, F.lit(""))


def parsed_type(text: Column) -> tuple[Column, Column]:
    """The type that a text names (exactly) and, where it names none, an error that lists the valid ones."""
    known = F.coalesce(text.isin(NAMES), F.lit(False))
    return F.when(known, text), F.when(~known, F.concat(F.lit("unknown scene type "), F.coalesce(F.concat(F.lit("'"), text, F.lit("'")), F.lit("null")), F.lit("; valid: " + ", ".join(NAMES))))


def strict_type(text: Column) -> Column:
    """The type that a text names; a query over others fails with `parsed_type`'s error."""
    found, error = parsed_type(text)
    return F.when(error.isNull(), found).otherwise(F.raise_error(F.coalesce(error, F.lit(""))))
