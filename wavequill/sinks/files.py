"""Writers of sound files, scene documents and indices. What a job writes is seen all at once or, if it fails, not at all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavequill.sinks.committed import save_files, save_waves


def write_waves(blocks: DataFrame, root: str, rate: int = 48_000) -> DataFrame:
    """Writes root/scene_id/stem.wav of every stem's blocks (scene_id, stem, start, left, right) and returns scene_id, stem, n.
    One task streams a file; scenes and stems run in parallel. Samples are rounded half to even and clipped."""
    path = F.concat(F.col("scene_id").cast("string"), F.lit("/"), F.col("stem"), F.lit(".wav"))
    save_waves(blocks.withColumn("path", path), root, rate)
    return blocks.groupBy("scene_id", "stem").agg(F.max(F.col("start") + F.size("left")).alias("n"))


def write_documents(scenes: DataFrame, root: str, name: str, document: Column, key: str = "scene_name") -> DataFrame:
    """Writes root/<key>/<name>, a JSON document a scene, and returns key and bytes. Null fields are left out."""
    rows = scenes.select(F.col(key), F.to_json(document).alias("content"))
    save_files(rows.select(F.concat(F.col(key).cast("string"), F.lit(f"/{name}")).alias("path"), "content"), root)
    return rows.select(key, F.octet_length("content").cast("long").alias("bytes"))


def write_index(rows: DataFrame, path: str) -> None:
    """An index as a Parquet table."""
    rows.write.mode("overwrite").parquet(path)


def write_tag_lookup(index: DataFrame, path: str) -> None:
    """tag and items (sorted files) as lines of JSON, sorted by tag."""
    index.select("tag", "items").orderBy("tag").write.mode("overwrite").json(path)


def write_failures(reports: DataFrame, path: str) -> None:
    """The details of invalid scenes as lines of JSON."""
    reports.filter(~F.col("is_valid")).write.mode("overwrite").json(path)
