"""Planning and bookkeeping: events of a reply, asset paths, prompt lines, scene assembly, limits, reports, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wavequill.operators.dimensions import music_class, reverb_class
from wavequill.operators.scene_types import STEMS


def clean_events(events: DataFrame, sound: str = "sound", ts: str = "timestamp", match: str = "path") -> DataFrame:
    """Events that name a sound and have a match, their times rounded to hundredths (null: 0)."""
    kept = events.filter((F.coalesce(F.col(sound), F.lit("")) != "") & F.col(match).isNotNull())
    return kept.withColumn(ts, F.round(F.coalesce(F.col(ts), F.lit(0.0)), 2))


def resolved_paths(wanted: DataFrame, files: DataFrame, path: str, data_root: str) -> DataFrame:
    """Adds `file`: the existing file that a path means. Absolute paths must exist; others are tried below the folder that
    holds the data root if they begin with data/, then below the data root and that folder. `files` has a column
    `file` of what exists. Null and empty paths have none."""
    parent = data_root.rstrip("/").rsplit("/", 1)[0]
    bare = F.when(F.col(path).startswith("./"), F.substr(F.col(path), F.lit(3))).otherwise(F.col(path))
    below = lambda root: F.concat(F.lit(root.rstrip("/") + "/"), bare)
    tries = F.array_compact(F.array(F.when(bare.startswith("data/"), below(parent)), below(data_root), below(parent)))
    candidates = F.when(F.col(path).startswith("/"), F.array(path)).when(F.col(path) != "", tries)
    asked = wanted.select(path).filter(F.col(path).isNotNull()).distinct()
    each = asked.select(path, F.posexplode(candidates).alias("place", "file")).join(files.select("file").distinct(), "file")
    best = each.groupBy(path).agg(F.min_by("file", "place").alias("file"))
    return wanted.join(best, path, "left")


def measurement_line(name: Column, lufs: Column, lra: Column, peak: Column, rms: Column, crest: Column) -> Column:
    """One stem's measurements as a line of a prompt; what is missing reads N/A."""
    say = lambda c: F.when(c.isNull(), "N/A").otherwise(F.format_string("%.1f", c))
    return F.concat(F.lit("  - "), name, F.lit(": loudness="), say(lufs), F.lit(" LUFS, LRA="), say(lra), F.lit(" LU, peak="), say(peak), F.lit(" dBTP, RMS="), say(rms), F.lit(" dB, crest="), say(crest), F.lit(" dB"))


def event_line(idx: Column, ts: Column, description: Column) -> Column:
    return F.concat(F.lit("  - sfx_"), F.coalesce(idx, F.lit(0)), F.format_string(" (%.1fs): \"", F.coalesce(ts, F.lit(0.0))), F.coalesce(description, F.lit("unknown sound")), F.lit('"'))


def prompt_lines(lines: DataFrame, keys: list[str], order: list[str], line: str) -> DataFrame:
    """A scene's lines joined by line feeds, in order. A prompt's lines are few."""
    found = lines.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*order, F.col(line).alias("_line")))).alias("l"))
    return found.select(*keys, F.array_join(F.transform("l", lambda x: x["_line"]), "\n").alias("lines"))


def first_tags(tags: DataFrame, tag: str, most: int = 100) -> DataFrame:
    """One row: the first `most` distinct tags joined by commas."""
    first = tags.select(tag).filter(F.col(tag).isNotNull()).distinct().orderBy(tag).limit(most)
    return first.agg(F.array_join(F.array_sort(F.collect_list(tag)), ", ").alias("tags"))  # `most` at most


def assembled(scenes: DataFrame, envelopes: DataFrame, keys: list[str]) -> DataFrame:
    """A row a scene: scene_type, codes of each stem's reverb and of the music, ducked stems, and the duration, which only
    an envelope tells (0 without). scenes: scene_type, music_tag and `reverbs` (stem to type, null for no reverb, a
    missing stem for no settings); envelopes: stem, duration_sec."""
    ducked = envelopes.groupBy(*keys).agg(F.array_sort(F.collect_set("stem")).alias("ducked"), F.max("duration_sec").alias("duration_sec"))  # four stems at most
    codes = [reverb_class(F.map_contains_key("reverbs", F.lit(s)) & F.element_at("reverbs", F.lit(s)).isNotNull(), F.try_element_at("reverbs", F.lit(s))).alias(f"{s}_reverb") for s in STEMS]
    found = scenes.join(ducked, keys, "left").withColumn("reverbs", F.coalesce("reverbs", F.create_map().cast("map<string,string>")))
    return found.select(*keys, F.coalesce("scene_type", F.lit("unknown")).alias("scene_type"), *codes, music_class(F.col("music_tag")).alias("music_class"), F.coalesce("ducked", F.array().cast("array<string>")).alias("ducked"), F.coalesce("duration_sec", F.lit(0.0)).alias("duration_sec"))


def ducking_statistics(scenes: DataFrame) -> DataFrame:
    """One row over `assembled` scenes: how many there are, with any ducking and with that of music and sfx, and hours."""
    has = lambda s: F.count_if(F.array_contains("ducked", s))
    return scenes.agg(F.count(F.lit(1)).alias("scenes"), F.count_if(F.size("ducked") > 0).alias("with_ducking"), has("music").alias("music"), has("sfx").alias("sfx"), (F.coalesce(F.sum("duration_sec"), F.lit(0.0)) / 3600).alias("hours"))


def limited(plans: DataFrame, jobs: DataFrame, most: int, order: list[str]) -> DataFrame:
    """At most `most` rows: resumed plans first, then new jobs, each in order."""
    both = plans.withColumn("resumed", F.lit(True)).unionByName(jobs.withColumn("resumed", F.lit(False)))
    return both.orderBy(F.desc("resumed"), *order).limit(most)


def failed_head(reports: DataFrame, name: str, most: int = 10) -> DataFrame:
    """place, line: the first failed scenes by name and, if there are others, how many."""
    failed = reports.filter(~F.col("is_valid"))
    head = failed.orderBy(name).limit(most).select(F.row_number().over(Window.orderBy(name)).alias("place"), F.concat(F.lit("  - "), F.col(name).cast("string")).alias("line"))  # `most` rows
    rest = failed.agg((F.count(F.lit(1)) - most).alias("n")).filter("n > 0")
    return head.unionByName(rest.select(F.lit(most + 1).alias("place"), F.format_string("  ... and %d more", F.col("n")).alias("line")))


def by_count(counts: DataFrame, n: str, order: str) -> DataFrame:
    """Adds `place`: most frequent first, ties in their given order. `counts` has a row a class."""
    return counts.withColumn("place", F.row_number().over(Window.orderBy(F.desc(n), order)))


def upload_statistics(files: DataFrame, scene: list[str]) -> DataFrame:
    """uploaded, failed, size_mb and whether the local files may go: only if every one was uploaded."""
    found = files.groupBy(*scene).agg(F.count_if("ok").alias("uploaded"), F.count_if(~F.coalesce("ok", F.lit(False))).alias("failed"), F.coalesce(F.sum(F.when(F.col("ok"), F.col("size_mb"))), F.lit(0.0)).alias("size_mb"))
    return found.withColumn("deletes", (F.col("failed") == 0) & (F.col("uploaded") > 0))


def all_present(present: Column, required: tuple[str, ...]) -> Column:
    """Whether an array of names has all required ones."""
    return F.size(F.array_except(F.array(*map(F.lit, required)), F.coalesce(present, F.array().cast("array<string>")))) == 0


def failure_json(reports: DataFrame, scene: str) -> DataFrame:
    """A JSON document for every invalid scene; valid ones are left out."""
    return reports.filter(~F.col("is_valid")).select(scene, F.to_json(F.struct(scene, F.size("errors").alias("error_count"), "errors")).alias("json"))


def count_lines(counts: DataFrame, name: str, n: str) -> DataFrame:
    """Report lines of the classes that occur."""
    return counts.filter(F.col(n) > 0).select(F.format_string("  %s: %d", F.col(name), F.col(n)).alias("line"))
