"""Helpers shared by the corpus operators: shared storage, table access and seeded ranking without hot tasks."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all machines see (spark.checkpoint.dir). Where none is set, a session on one machine, as in tests, gets
    a local one; on a cluster that is an error, as other machines would not see it."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
        where = "file://" + tempfile.mkdtemp(prefix="wavequill-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def written(df: DataFrame, name: str, arrow_rows: int | None = None) -> DataFrame:
    """Write `df` as Parquet in the shared folder and read it back, which cuts its lineage and survives lost executors.

    arrow_rows: rows in each batch that Python functions get, where rows are long.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(ARROW_ROWS)
    try:
        if arrow_rows:
            spark.conf.set(ARROW_ROWS, str(arrow_rows))
        df.write.parquet(path)
    finally:
        spark.conf.set(ARROW_ROWS, before)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables in the shared folder by name; each is deleted once another one of its name is written, or when dropped."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def written(self, df: DataFrame, name: str, arrow_rows: int | None = None) -> DataFrame:
        found = written(df, name, arrow_rows)
        self.drop(name)
        self.paths[name] = found.inputFiles()[0].rsplit("/", 1)[0]
        return found

    def drop(self, *names: str) -> None:
        for path in (self.paths.pop(n) for n in names if n in self.paths):
            where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


def as_key(col: Column) -> Column:
    """A non-null text key: null and the empty text stay apart, so equi-joins need no null-safe comparison."""
    return F.coalesce(F.concat(F.lit("="), col.cast("string")), F.lit(""))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def bucket_bits(rows: int) -> int:
    """Bits of a seeded hash that cut a key of any share of `rows` into buckets of some hundreds to 20,000 rows."""
    target = min(20_000, max(500, rows / 2048))
    return max(0, math.ceil(math.log2(max(1, rows) / target)))


def hash_bucket(hashed: Column, bits: int) -> Column:
    """The top `bits` of a signed 64-bit hash, in the order of the hash."""
    return F.shiftright(hashed, 64 - bits) if bits else F.lit(0).cast("long")


def bucket_offsets(counts: DataFrame, keys: list[str], bucket: str, n: str) -> DataFrame:
    """To one row per (keys, bucket) add `before`, the rows of the same keys in earlier buckets, and `total`."""
    ordered = Window.partitionBy(*keys).orderBy(bucket) if keys else Window.orderBy(bucket)
    return counts.withColumn("before", F.coalesce(F.sum(n).over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("total", F.sum(n).over(ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
