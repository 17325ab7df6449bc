"""Intermediate tables in the folder that all machines share (spark.checkpoint.dir)."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. A session on one machine, as in tests, gets a local one where none is set; on a
    cluster that is an error."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        where = "file://" + tempfile.mkdtemp(prefix="wavequill-signals-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


#: what this process has written, by application
_KEPT: dict[str, list[str]] = {}


def kept(df: DataFrame) -> DataFrame:
    """`df` written once and read back: what follows doesn't compute it again, also after an executor is lost."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/signals-{uuid.uuid4().hex}"
    _KEPT.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Deletes what `kept` has written for this application, once the results that rest on it are stored; how many tables."""
    paths = _KEPT.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return len(paths)
