"""Nearest vectors in blocks of queries."""

from pyspark.sql import functions as F

from tests.conftest import SF
from wavequill.operators import lookups


def test_blocks_of_queries_give_the_same(spark):
    v = spark.read.parquet(f"{SF}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    q = v.filter("id % 3 = 0")
    whole = sorted(map(tuple, lookups.nearest(q, v).collect()), key=str)
    assert len(whole) == q.count() and whole == sorted(map(tuple, lookups.nearest(q.union(q.limit(2)), v, block=20).collect()), key=str)


def test_more_queries_than_a_block(spark):
    q = spark.range(100_001).select("id", F.array(F.lit(1.0), (F.col("id") % 7).cast("double")).alias("vec"))
    index = spark.createDataFrame([(-1, [1.0, 0.0]), (-2, [1.0, 6.0])], "id long, vec array<double>")
    got = lookups.nearest(q, index)
    assert got.count() == 100_001 and got.filter("match_id IS NULL").count() == 0
