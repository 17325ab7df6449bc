"""Rendering of scenes: stems and events become a rough, a linear and a release version.

Stems are blocks (scene_id, stem, start, left, right) on one grid of `block` samples, events are blocks (scene_id, idx,
start, left, right) whose starts are those on the scene's timeline. A scene is as long as its speech; scenes without
speech aren't rendered but listed as failures. Missing stems are silence.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavequill.functions.scalars import quantize16
from wavequill.operators import blocks as B
from wavequill.operators import chains, signals
from wavequill.operators.dimensions import REVERBS
from wavequill.operators.scene_types import STEMS
from wavequill.storage import kept

KEYS = ["scene_id"]
#: gains of the plain mix (fixed values), and the gain of other stems
PLAIN_GAINS, OTHER_GAIN = {"speech": 1.0, "music": 0.35, "ambience": 0.25, "sfx": 0.8}, 0.8
#: how the plain mix ducks events (fixed values)
PLAIN_EVENTS = {"threshold_db": -25.0, "reduction_db": -8.0, "attack_ms": 5.0, "release_ms": 100.0}


@dataclass(frozen=True)
class Rendered:
    """stems: the version's stems (samples, or 16-bit numbers `q` in the linear one); mix: its mix."""

    stems: DataFrame
    mix: DataFrame


def processed_stems(stems: DataFrame, settings: dict[str, dict], rate: int, block: int, gains: DataFrame | None = None) -> DataFrame:
    """Every stem through its chain of settings; `gains` (scene_id, stem, gain_db) are added to the chain's gain."""
    keys = [*KEYS, "stem"]
    found = chains.process_stems(stems, keys, rate, block, settings, "stem")
    if gains is None:
        return found
    more = gains.select(*keys, F.coalesce("gain_db", F.lit(0.0)).alias("gain_db"))
    return chains.gained(found.join(more, keys, "left"), F.coalesce("gain_db", F.lit(0.0))).drop("gain_db")


def event_effects(events: DataFrame, settings: dict[str, dict], rate: int, block: int) -> DataFrame:
    """Every event under its own gain and reverb, by the key sfx_<idx>; events without settings stay as they are."""
    rooms = {name: (size, damping, wet) for name, size, damping, wet in REVERBS}

    def chain(own: dict) -> dict:
        reverb = own.get("reverb")
        if not reverb:
            return {"gain_db": own.get("gain_db")}
        size, damping, wet = rooms.get(reverb.get("type", "medium_room"), rooms["medium_room"])
        return {"gain_db": own.get("gain_db"), "reverb": {"room_size": size, "damping": damping, "wet": reverb.get("wet_amount", wet)}}

    return chains.process_stems(events, [*KEYS, "idx"], rate, block, {int(k.removeprefix("sfx_")): chain(v) for k, v in settings.items() if v}, "idx")


def under_speech(events: DataFrame, speech: DataFrame, rate: int, block: int, **settings: float) -> DataFrame:
    """Every event ducked under the speech at its place; each starts with a gain of 1. Short blocks are gathered to longer ones,
    counted from the event's start."""
    spans = events.groupBy(*KEYS, "idx").agg(F.min("start").alias("onset"), F.max(F.col("start") + F.size("left")).alias("stop"))
    own = events.join(spans.select(*KEYS, "idx", "onset"), [*KEYS, "idx"])
    keys = [*KEYS, "idx", "onset"]
    heard = signals.sliced(speech.join(spans, KEYS), F.col("onset"), F.col("stop"))
    pieces = [p.select(*keys, F.lit(name).alias("part"), "start", *signals.SIDES) for name, p in (("event", own.withColumn("start", F.col("start") - F.col("onset"))), ("speech", heard))]
    cells = kept(B.gathered(pieces[0].unionByName(pieces[1]), keys, "part", ("event", "speech"), signals.SIDES, B.wide(block)))
    grid, detector = (cells.select(*keys, "start", *[F.col(f"{name}_{v}").alias(v) for v in signals.SIDES]) for name in ("event", "speech"))
    found = signals.ducked(grid, detector, keys, rate, **settings)
    return found.select(*KEYS, "idx", (F.col("start") + F.col("onset")).alias("start"), *signals.SIDES)


def sfx_stem(scenes: DataFrame, events: DataFrame, block: int) -> DataFrame:
    """The sum of all events on the timeline, cut at the scene's n samples, over silence."""
    there = signals.cut(events.join(scenes.select(*KEYS, "n"), KEYS), F.col("n")).select(*KEYS, "start", *signals.SIDES)
    return signals.placed(there.unionByName(signals.silence(scenes, KEYS, "n", block)), KEYS, block).withColumn("stem", F.lit("sfx"))


def _full(scenes: DataFrame, stems: DataFrame, block: int) -> DataFrame:
    """All stems but the sfx at the scene's length."""
    parts = [signals.to_length(scenes, stems.filter(F.col("stem") == s).drop("stem"), KEYS, "n", block).withColumn("stem", F.lit(s)) for s in STEMS[:3]]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def bus(cells: DataFrame, keys: list[str], rate: int, ducks: DataFrame | None = None) -> DataFrame:
    """keys, start, left and right: the sum of all stems of `cells` (a row holds all of them, at one length) with music and sfx
    ducked under the speech. `ducks`: as in `signals.mix_bus`. Cells are read twice: let them be a table."""
    at, names = [*keys, "start"], [*signals.BUS]
    coefficient = lambda ms: math.exp(-1000 / (rate * ms))
    own = chains.Sidechains(tuple(chains.Sidechain(10 ** (b["threshold_db"] / 20), 10 ** (b["reduction_db"] / 20), coefficient(b["attack_ms"]), coefficient(b["release_ms"])) for b in signals.BUS.values()))
    level = F.zip_with("speech_left", "speech_right", lambda a, b: (F.abs(a) + F.abs(b)) / 2)
    states = B.starts(cells.select(*at, level.alias("level")), keys, own, ("level",))
    if ducks is None:
        asked = cells.withColumns({f"_{s}": F.lit(True) for s in names})
    else:  # scenes without a row aren't ducked, flags of null are true
        flags = ducks.select(*KEYS, *[F.coalesce(F.col(f"duck_{s}"), F.lit(True)).alias(f"_{s}") for s in names])
        asked = cells.join(flags, KEYS, "left").withColumns({f"_{s}": F.coalesce(f"_{s}", F.lit(False)) for s in names})
    columns = tuple(f"{s}_{v}" for s in STEMS for v in signals.SIDES)

    def mixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in B.parts(whole, columns)):
            x = {c: B.Rows(batch.column(c)) for c in columns}
            heard, begins = x["speech_left"], np.array(batch.column("state").to_pylist())[:, 0]
            flat = (np.abs(heard.flat) + np.abs(x["speech_right"].flat)) / 2
            gains = {s: B.Rows(batch.column("speech_left")) for s in names}
            on = {s: batch.column(f"_{s}").to_numpy(zero_copy_only=False).astype(bool) for s in names}
            for rows in B.alike(heard.sizes):
                found = own.run(flat[heard.begins[rows][:, None] + np.arange(heard.sizes[rows[0]])], begins[rows])
                for s, g in zip(names, found, strict=True):
                    gains[s].put(rows, np.where(on[s][rows][:, None], g, 1.0))
            sums = [sum(x[f"{s}_{v}"].flat * gains[s].flat if s in gains else x[f"{s}_{v}"].flat for s in STEMS) for v in signals.SIDES]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in at), *(B.listed(y, heard.sizes) for y in sums)], names=[*at, *signals.SIDES])

    return asked.join(states, at).mapInArrow(mixed, B.kinds(cells, at) + "".join(f", `{v}` array<double>" for v in signals.SIDES))


def render(stems: DataFrame, events: DataFrame, rough: dict[str, dict], final: dict[str, dict], event_settings: dict[str, dict], rate: int, block: int, gains: DataFrame | None = None, ducks: DataFrame | None = None, versions: tuple[str, ...] = ("rough", "linear", "release")) -> tuple[dict[str, Rendered], DataFrame]:
    """The `versions` asked for, and the failures (scene_id, error).

    rough: the rough settings, clean stems, ducking on the mix bus; release: the same under the final settings with effects
    on every event; linear: the final settings with the ducking inside the stems, which sum up exactly to the mix.
    """
    scenes = signals.lengths(stems.filter("stem = 'speech'"), KEYS)
    failures = stems.select(*KEYS).distinct().join(scenes, KEYS, "left_anti").withColumn("error", F.lit("no speech stem"))
    found, effects = {}, event_effects(events, event_settings, rate, block)
    parts = []
    for name, settings, sounds in (("rough", rough, events), ("release", final, effects)):
        if name in versions:
            own = processed_stems(stems.filter(F.col("stem").isin(*STEMS[:3])), settings, rate, block, gains)
            only_gain = not any(v is not None for k, v in (settings.get("sfx") or {}).items() if k != "gain_db")
            # a gain is the same on every event as on their sum
            sfx = sounds.select(*KEYS, F.lit("sfx").alias("stem"), "start", *signals.SIDES) if only_gain else sfx_stem(scenes, sounds, block)
            parts += [p.withColumn("version", F.lit(name)) for p in (own, processed_stems(sfx, settings, rate, block, gains))]
    if parts:
        keys, size = [*KEYS, "version"], B.wide(block)
        cells = kept(B.gathered(reduce(DataFrame.unionByName, parts), keys, "stem", STEMS, signals.SIDES, size))
        loud = chains.before_ceiling(kept(bus(cells, keys, rate, ducks)), keys, rate)
        each = F.explode(F.array(*[F.struct(F.lit(s).alias("stem"), *[F.col(f"{s}_{v}").alias(v) for v in signals.SIDES]) for s in STEMS])).alias("s")
        whole = cells.select(*keys, "start", each).select(*keys, "start", "s.*")
        for name in (v for v in ("rough", "release") if v in versions):
            one = lambda df: df.filter(F.col("version") == name).drop("version")  # noqa: B023, E731
            mix = chains.limit(one(loud), KEYS, rate, size, chains.MASTER_CEILING)
            found[name] = Rendered(B.regridded(one(whole), [*KEYS, "stem"], block, signals.SIDES), B.regridded(mix, KEYS, block, signals.SIDES))
    if "linear" not in versions:
        return found, failures
    own = kept(_full(scenes, processed_stems(stems.filter("stem <> 'sfx'"), final, rate, block, gains), block))
    speech = own.filter("stem = 'speech'").drop("stem")
    on = (lambda stem: scenes.select(*KEYS)) if ducks is None else (lambda stem: ducks.filter(F.coalesce(F.col(f"duck_{stem}"), F.lit(True))).select(*KEYS))
    music = own.filter("stem = 'music'").drop("stem")
    music = signals.ducked(music.join(on("music"), KEYS, "left_semi"), speech, KEYS, rate, **signals.BUS["music"]).unionByName(music.join(on("music"), KEYS, "left_anti").select(*KEYS, "start", *signals.SIDES))
    under = under_speech(effects.join(on("sfx"), KEYS, "left_semi"), speech, rate, block, **signals.BUS["sfx"]).unionByName(effects.join(on("sfx"), KEYS, "left_anti").select(*KEYS, "idx", "start", *signals.SIDES))
    sfx = processed_stems(sfx_stem(scenes, under, block), final, rate, block, gains)
    whole = own.filter("stem <> 'music'").unionByName(music.withColumn("stem", F.lit("music"))).unionByName(sfx)
    found["linear"] = linear_version(kept(whole))
    return found, failures


def linear_version(stems: DataFrame) -> Rendered:
    """16-bit stems under one gain that keeps the mix and every stem below -1 dB full scale, and their exact sum. The stems are
    read several times: let them be a table."""
    sums = signals.mixed(stems, KEYS)
    top = lambda s: F.array_max(F.transform(s, F.abs))
    peaks = stems.select(*KEYS, *signals.SIDES).unionByName(sums.select(*KEYS, *signals.SIDES)).groupBy(*KEYS).agg(F.max(F.greatest(top("left"), top("right"))).alias("peak"))
    limit = 10 ** (-1 / 20)
    gain = peaks.select(*KEYS, F.when(F.col("peak") > limit, limit / F.col("peak")).otherwise(F.lit(1.0)).alias("gain"))
    q = stems.join(gain, KEYS)
    q = kept(q.select(*KEYS, "stem", "start", *[F.transform(s, lambda x: quantize16(x, F.col("gain"))).alias(s) for s in signals.SIDES]))
    whole = signals.mixed(q.drop("stem"), KEYS)  # sums of integers are exact in doubles
    return Rendered(q, whole.select(*KEYS, "start", *[F.col(s).cast("array<int>").alias(s) for s in signals.SIDES]))


def plain_mix(stems: DataFrame, events: DataFrame, rate: int, block: int, gains: dict[str, float] | None = None, ducks: bool = True) -> DataFrame:
    """The older mixer: fixed gains, music and events ducked under the speech, as long as the longest stem or event, through
    the mastering dynamics."""
    known = PLAIN_GAINS | (gains or {})
    gain = F.coalesce(*[F.when(F.col("stem") == k, F.lit(v)) for k, v in known.items()], F.lit(OTHER_GAIN))
    scale = lambda df, g: df.withColumn("_g", g).select(*[c for c in df.columns if c not in signals.SIDES], *[F.transform(s, lambda x: x * F.col("_g")).alias(s) for s in signals.SIDES])
    ends = stems.unionByName(events.withColumn("stem", F.lit("")).select(stems.columns))
    scenes = signals.lengths(ends, KEYS)
    speech, loud = stems.filter("stem = 'speech'").drop("stem"), scale(stems, gain)
    music = loud.filter("stem = 'music'").drop("stem")
    events = scale(events, F.lit(known["sfx"]))
    if ducks:
        music = signals.ducked(music, speech, KEYS, rate)
        events = under_speech(events, speech, rate, block, **PLAIN_EVENTS)
    size = B.wide(block)
    parts = [loud.filter("stem <> 'music'"), music, events, signals.silence(scenes, KEYS, "n", size)]
    whole = parts[0].select(*KEYS, "start", *signals.SIDES)
    for p in parts[1:]:
        whole = whole.unionByName(p.select(*KEYS, "start", *signals.SIDES))
    cells = B.gathered(whole.withColumn("part", F.lit("mix")), KEYS, "part", ("mix",), signals.SIDES, size)
    mix = kept(cells.select(*KEYS, "start", *[F.col(f"mix_{v}").alias(v) for v in signals.SIDES]))
    return B.regridded(chains.master(mix, KEYS, rate, size), KEYS, block, signals.SIDES)
