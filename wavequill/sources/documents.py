"""Scene documents (JSON) with declared schemas, corpus indices and sound files, each a table of the files found.

Missing files and folders give empty tables, missing keys become null. Unreadable files are rows with an error where a
function says so, and are left out elsewhere.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wavequill.sources.sound import resampled_part, sound

ENVELOPES = "sample_rate int, duration_sec double, envelopes map<string,struct<description:string,keyframes:array<struct<time:double,gain:double,gain_db:double>>>>"
INDEX = "entries array<struct<file:string,emotion:string,actor:string,utterance_id:int,dialogue_id:int,nv_types:array<string>>>"


PLAN = (
    "job struct<dialogue_path:string,scene_name:string,scene_dir:string,style:string,scene_type:string,speech_source:string,emotion:string>, plan struct<dialogue:string,music:string,ambience:string,"
    "events:array<struct<file_path:string,timestamp:double,description:string>>,dialogue_duration_sec:double,scene_type:string>, rough_settings map<string,map<string,string>>, critic_settings map<string,map<string,string>>, sfx_event_settings map<string,map<string,string>>"
)
METADATA = "scene_type string, critic_adjustments map<string,map<string,string>>, scene_plan struct<gemini_context:struct<music_tag:string>>, outputs struct<linear:struct<additivity_error:double>>"
MELD = "entries array<struct<split:string,dialogue_id:int,utterance_id:int,file:string,speaker:string,utterance:string,emotion:string>>"


@dataclass(frozen=True)
class Places:
    """Where things lie; what isn't given comes from the environment (WAVEQUILL_DATA, WAVEQUILL_OUT), read when asked for."""

    data: str = ""
    out: str = ""

    @property
    def data_root(self) -> str:
        return self.data or os.environ.get("WAVEQUILL_DATA", "data")

    @property
    def out_root(self) -> str:
        return self.out or os.environ.get("WAVEQUILL_OUT", "out")


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or pattern names anything."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where)
    return found is not None and len(found) > 0


def json_documents(spark: SparkSession, path: str, schema: str, corrupt: bool = False) -> DataFrame:
    """One row per whole-file document, with its path. With `corrupt`, unreadable files stay as rows of nulls whose `error` is
    their text, null for all others."""
    kinds = schema + ", error string"
    if not _exists(spark, path):
        return spark.createDataFrame([], kinds + ", path string")
    text = spark.read.option("wholetext", True).text(path).select("value", F.col("_metadata.file_path").alias("path"))
    read = text.select(F.from_json("value", kinds, {"columnNameOfCorruptRecord": "error"}).alias("d"), "value", "path")
    read = read.select("d.*", "value", "path").withColumn("error", F.when(F.isnull("value") | F.col("error").isNotNull(), F.coalesce("error", F.lit("")))).drop("value")
    return read if corrupt else read.filter(F.col("error").isNull()).drop("error")


def scene_of(path: Column, up: int = 2) -> Column:
    """The folder `up` - 1 levels above a file: that of its scene."""
    return F.element_at(F.split(path, "/"), -up)


def scene_documents(spark: SparkSession, root: str) -> DataFrame:
    """A row a scene folder that has a metadata file: scene_name, has_metadata (false if it can't be read), has_linear, the
    metadata's columns. Folders without the file aren't scenes."""
    found = json_documents(spark, f"{root}/*/metadata.json", METADATA, corrupt=True).withColumn("scene_name", scene_of(F.col("path")))
    files = spark.read.format("binaryFile").load(f"{root}/*/linear/*") if _exists(spark, f"{root}/*/linear/*") else spark.createDataFrame([], "path string")
    linear = files.select(scene_of(F.col("path"), 3).alias("scene_name")).distinct().withColumn("has_linear", F.lit(True))
    return found.join(linear, "scene_name", "left").select("scene_name", F.col("error").isNull().alias("has_metadata"), F.coalesce("has_linear", F.lit(False)).alias("has_linear"), "scene_type", "critic_adjustments", F.col("scene_plan.gemini_context.music_tag").alias("music_tag"), F.col("outputs.linear.additivity_error").alias("stored_error"))


def plan_documents(spark: SparkSession, root: str) -> DataFrame:
    """Stored plans; those that can't be read or lack a job or a plan are left out."""
    return json_documents(spark, f"{root}/*/plan.json", PLAN).filter("job.scene_name IS NOT NULL AND plan IS NOT NULL")


def audio_files(spark: SparkSession, root: str, patterns: tuple[str, ...] = ("*.wav", "*.mp3")) -> DataFrame:
    """file: all sound files below a folder, each once, in order."""
    found = spark.createDataFrame([], "file string")
    if _exists(spark, root):
        for p in patterns:
            found = found.unionByName(spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", p).load(root).select(F.col("path").alias("file")))
    return found.distinct().orderBy("file")


def dialogue_groups(index: DataFrame, root: str) -> DataFrame:
    """split, dialogue_id, utterances: each dialogue's entries in the order of their numbers, with whole paths."""
    each = index.select(F.explode("entries").alias("e")).select("e.*").withColumn("file", F.concat_ws("/", F.lit(root), "file"))
    rest = [c for c in each.columns if c not in ("split", "dialogue_id", "utterance_id")]
    return each.groupBy("split", "dialogue_id").agg(F.array_sort(F.collect_list(F.struct("utterance_id", *rest))).alias("utterances"))  # one dialogue's


def vector_index(spark: SparkSession, path: str) -> DataFrame:
    """id, path, vec of a Parquet table of embeddings; empty where it is missing."""
    if not _exists(spark, path):
        return spark.createDataFrame([], "id long, path string, vec array<float>")
    return spark.read.parquet(path).select("id", "path", "vec")


def tag_lookup(spark: SparkSession, path: str) -> DataFrame:
    """tag, file rows of a JSON object of tags and their files."""
    found = spark.read.option("wholetext", True).text(path)
    return found.select(F.explode(F.from_json("value", "map<string,array<string>>")).alias("tag", "files")).select("tag", F.explode("files").alias("file"))


def keyframes_of(envelopes: DataFrame) -> DataFrame:
    """path, stem, time, gain rows of envelope documents."""
    return envelopes.select("path", F.explode("envelopes").alias("stem", "e")).select("path", "stem", F.explode("e.keyframes").alias("k")).select("path", "stem", "k.time", "k.gain", "k.gain_db")


def index_entries(index: DataFrame, root: str) -> DataFrame:
    """Entries of a corpus index with whole paths; entries without types get the type unknown."""
    each = index.select(F.explode("entries").alias("e")).select("e.*")
    return each.withColumn("file", F.concat_ws("/", F.lit(root), "file")).withColumn("nv_types", F.coalesce("nv_types", F.array(F.lit("unknown"))))


def durations(spark: SparkSession, root: str, pattern: str = "*.wav", missing: float | None = None) -> DataFrame:
    """path, seconds of all sound files below a folder, from their headers alone; `missing` where one can't be read."""
    found = sound(spark, root, content="headers", pattern=pattern)
    return found.select("path", F.when(F.col("frames") > 0, F.col("seconds")).otherwise(F.lit(missing).cast("double")).alias("seconds"))


def resampled(x: np.ndarray, old: int, new: int, half: int = 24) -> np.ndarray:
    """Columns of samples at another rate."""
    if old == new or not len(x):
        return x

    def read(a: int, b: int) -> np.ndarray:
        low, high = min(max(a, 0), len(x)), min(max(b, 0), len(x))
        return np.pad(x[low:high], ((max(0, low - a), max(0, b - high)), (0, 0)))

    return resampled_part(read, old, new, 0, -(-len(x) * new // old), half)


def wave_blocks(spark: SparkSession, path: str, rate: int = 48_000, start: float | None = None, stop: float | None = None) -> DataFrame:
    """path, block_no, start_sample, left, right: one row per second of sound at `rate`, of which only `start` to `stop` (seconds) is
    read; mono is doubled, channels after the second are dropped. A file that can't be read has one row of nulls."""
    return sound(spark, path, rate=rate, start=start, stop=stop).select("path", "block_no", "start_sample", "left", "right")
