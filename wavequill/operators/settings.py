"""Settings of stems and events as maps of text: merging, offsets, fallbacks and lookups by event.

A key that is present with a null value says "explicitly none" and differs from a missing key, which maps keep apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavequill.functions.scalars import unit_hash

KIND = "map<string,string>"


def merged(base: Column, delta: Column) -> Column:
    """`gain_db` of both adds up where the delta has it (what is missing or no number counts as 0); every other key of
    the delta overrides, also with null. A null map is empty."""
    empty = F.create_map().cast(KIND)
    base, delta = F.coalesce(base, empty), F.coalesce(delta, empty)
    number = lambda x: F.coalesce(x.try_cast("double"), F.lit(0.0))

    def both(k: Column, a: Column, b: Column) -> Column:
        return F.when((k == "gain_db") & F.map_contains_key(delta, k), (number(a) + number(b)).cast("string")).when(F.map_contains_key(delta, k), b).otherwise(a)

    return F.map_zip_with(base, delta, both)


def offset_gain(gain: Column, offset: Column) -> Column:
    """A missing gain counts as 0, but stays missing where there is no offset."""
    return F.when(F.coalesce(offset, F.lit(0.0)) == 0.0, gain).otherwise(F.coalesce(gain, F.lit(0.0)) + offset)


def stem_settings(settings: DataFrame, offsets: DataFrame, keys: list[str]) -> DataFrame:
    """keys, stem, gain_db: the settings' gains with the scene's offsets; stems without settings are those of `offsets`."""
    return offsets.join(settings, [*keys, "stem"], "left").select(*keys, "stem", offset_gain(F.col("gain_db"), F.col("offset")).alias("gain_db"))


def event_key(idx: Column) -> Column:
    return F.concat(F.lit("sfx_"), idx)


def event_setting(settings: Column, idx: Column) -> Column:
    """The map of the event in a map of maps; empty where there is none."""
    return F.coalesce(F.try_element_at(settings, event_key(idx)), F.create_map().cast(KIND))


def fallback_events(idx: Column) -> Column:
    """Neutral settings for an array of event numbers (null: 0)."""
    return F.map_from_entries(F.transform(F.array_distinct(F.transform(idx, lambda i: F.coalesce(i, F.lit(0)))), lambda i: F.struct(event_key(i), F.create_map(F.lit("gain_db"), F.lit("0.0")))))


def subtle_reverb(key: Column, dry: float = 0.15) -> Column:
    """A faint room as (type, wet_amount), by a draw from the key; null, which is dry, in a share of `dry`."""
    wet = F.round(0.01 + 0.02 * unit_hash(key, "wet"), 3)
    return F.when(unit_hash(key, "dry") >= dry, F.struct(F.lit("room").alias("type"), wet.alias("wet_amount")))
