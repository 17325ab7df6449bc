"""Small dimension tables and their lookups: reverb presets, reverb classes and music classes.

The tables have a fixed, small number of rows, so lookups broadcast them. Nulls have the results stated below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: reverb presets: name, room size, damping, wet (fixed values)
REVERBS = [
    ("dry", 0.1, 0.9, 0.1), ("small_room", 0.2, 0.7, 0.2), ("medium_room", 0.4, 0.5, 0.3), ("room", 0.4, 0.5, 0.3), ("large_room", 0.6, 0.4, 0.35),
    ("bathroom", 0.25, 0.8, 0.4), ("large_hall", 0.8, 0.3, 0.4), ("cathedral", 0.95, 0.2, 0.5), ("garage", 0.5, 0.6, 0.35), ("parking_garage", 0.7, 0.4, 0.45),
    ("warehouse", 0.75, 0.35, 0.4), ("sewer", 0.9, 0.1, 0.6), ("tunnel", 0.85, 0.15, 0.55), ("forest", 0.3, 0.8, 0.15), ("open_field", 0.15, 0.9, 0.1),
]
#: the preset of unknown names
DEFAULT_REVERB = "medium_room"
#: reverb classes by code, then the code of unknown names (fixed values)
REVERB_CLASSES = ["none", "room", "small_room", "medium_room", "large_hall", "bathroom", "plate", "spring"]
UNKNOWN_REVERB = 8
#: music classes by code from 1 in the order in which they are looked for; 0 is no music, 15 any other (fixed values)
MUSIC_CLASSES = ["cinematic", "tense", "ambient", "dramatic", "peaceful", "suspense", "emotional", "epic", "dark", "uplifting", "mysterious", "action", "romantic", "melancholic"]
OTHER_MUSIC = 15


def reverb_presets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(REVERBS, "preset string, room_size double, damping double, wet double")


def with_reverb(rows: DataFrame, preset: str, wet: str | None = None) -> DataFrame:
    """Adds room_size, damping and wet_amount; unknown and null presets are the default one. A non-null `wet` column
    overrides the preset's."""
    known = [name for name, *_ in REVERBS]
    name = F.when(F.col(preset).isin(known), F.col(preset)).otherwise(F.lit(DEFAULT_REVERB))
    dim = F.broadcast(reverb_presets(rows.sparkSession).withColumnRenamed("preset", "_preset").withColumnRenamed("wet", "_wet"))
    joined = rows.withColumn("_name", name).join(dim, F.col("_name") == F.col("_preset"))
    amount = F.coalesce(F.col(wet), F.col("_wet")) if wet else F.col("_wet")
    return joined.withColumn("wet_amount", amount).drop("_name", "_preset", "_wet")


def reverb_class(has_reverb: Column, kind: Column) -> Column:
    """The class code of a stem's reverb type: 0 without reverb settings, the unknown code for names (or a missing name)
    outside the classes."""
    place = F.array_position(F.array(*map(F.lit, REVERB_CLASSES)), F.lower(F.coalesce(kind, F.lit("")))).cast("int") - 1
    return F.when(~F.coalesce(has_reverb, F.lit(False)), 0).when(place >= 0, place).otherwise(UNKNOWN_REVERB)


def music_class(tag: Column) -> Column:
    """The code of a music tag: 0 for null and empty, else that of the first class that the tag names or contains."""
    text = F.trim(F.lower(tag))
    same = F.coalesce(*[F.when(text == name, i) for i, name in enumerate(MUSIC_CLASSES, 1)])
    held = F.coalesce(*[F.when(F.contains(text, F.lit(name)), i) for i, name in enumerate(MUSIC_CLASSES, 1)])
    return F.when(tag.isNull() | (tag == ""), 0).otherwise(F.coalesce(same, held, F.lit(OTHER_MUSIC)))
