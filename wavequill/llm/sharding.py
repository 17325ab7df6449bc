"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded hash and ranked within their source; a row's fractional rank is its place in its
source scaled to (0, 1). Sorting all rows by it interleaves the sources in proportion, so equal cuts of that order
hold every source in the mixture's share. No source is gathered in one task: ranks are counted per bucket of the
hash and of the fractional rank, and offsets of the buckets turn local row numbers into global ones.

The hash is that of the text, so equal texts are neighbours in their source and have about the same fractional rank in
every source: a group of equal texts lies in one shard, or on both sides of a cut, unless it is a large part of some
source. A text with so many rows that its bucket would be a large task has buckets of its own, dealt by a hash of the
identifier; counts of hashes, combined before the shuffle, find those texts.

The law is `rows`: shard counts differ by one at most. Null texts weigh one byte and count as empty; null sources form a
source of their own; repeated rows get slots of their own. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wavequill.llm.common import as_key, bucket_bits, bucket_offsets, hash_bucket


def stratified_shards(docs: DataFrame, n_shards: int = 8, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", hot_groups: int = 1024, hot_rows: int = 2000) -> DataFrame:
    """id, size, text_crc32, law, shard, slot, grown_shard for every row.

    A text is hot with more than max(hot_rows, rows / hot_groups) rows, so at most hot_groups texts are.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    n = docs.count()
    bits = bucket_bits(n)
    parts = 1 << bits
    slim = docs.select(F.col(id_col).alias("id"), as_key(F.col(source_col)).alias("src"), (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(F.lit(seed), text).alias("h"))
    often = slim.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > max(hot_rows, n // hot_groups))
    hot = [r["h"] for r in often.select("h").collect()]  # hot_groups at most
    slim = slim.withColumn("g", F.xxhash64(F.lit(seed), F.col("id"))).withColumn("own", F.col("h").isin(hot) if hot else F.lit(False))
    cell = F.when(F.col("own"), F.struct(F.col("own"), F.col("h"), hash_bucket(F.col("g"), bits).alias("d"))).otherwise(F.struct(F.col("own"), F.lit(0).cast("long").alias("h"), F.lit(0).cast("long").alias("d")))
    slim = slim.withColumn("b", F.struct(hash_bucket(F.col("h"), bits).alias("b"), cell.alias("cell")))

    per = bucket_offsets(slim.groupBy("src", "b").agg(F.count(F.lit(1)).alias("n")), ["src"], "b", "n").drop("n")
    local = F.row_number().over(Window.partitionBy("src", "b").orderBy("h", "g", "id", "size", "text_crc32"))
    ranked = slim.join(per, ["src", "b"]).withColumn("rank", F.col("before") + local)
    ranked = ranked.select("id", "src", "size", "text_crc32", "h", "g", ((F.col("rank") - 0.5) / F.col("total")).alias("place")).withColumn("c", F.floor(F.col("place") * parts))

    cells = bucket_offsets(ranked.groupBy("c").agg(F.count(F.lit(1)).alias("n")), [], "c", "n").select("c", "before")
    inside = F.row_number().over(Window.partitionBy("c").orderBy("place", "src", "h", "g", "id", "size", "text_crc32"))
    at = ranked.join(cells, "c").withColumn("at", F.col("before") + inside - 1)

    q, r = divmod(n, n_shards)
    edge = r * (q + 1)
    early, late = F.floor(F.col("at") / (q + 1)), r + F.floor((F.col("at") - edge) / max(q, 1))
    shard = F.when(F.col("at") < edge, early).otherwise(late).cast("int")
    start = F.least(F.col("shard"), F.lit(r)) + F.col("shard").cast("long") * q
    return at.withColumn("shard", shard).select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("at") - start).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
