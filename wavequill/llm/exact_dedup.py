"""Exact deduplication by sorting content.

Sampled splitters range-partition the normalised bytes (by their head and, where heads agree, a hash, so that the
samples the driver sees are short), each partition is sorted externally, and the window operator compares every row
with its neighbour in full to find the runs of equal texts. Texts repeated so often
that one run would fill a task are found by counting hashes (eight bytes a text, combined before the shuffle);
they are salted, and their totals are pre-aggregated before any shuffle.

Null texts count as empty. Of repeated rows with one identifier exactly one is kept; a null identifier loses to
any other. Empty tables give empty results. Input columns never clash, as they travel inside a struct.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: bytes of a text that the splitters compare
HEAD = 32


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", normalise: Callable[[Column], Column] | None = None, hot_groups: int = 1024, hot_rows: int = 2000, salts: int = 64, carry: bool = False) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256 (and `row`, the whole input row, if `carry`).

    keep: the "smallest" or the "largest" identifier stays. hot_groups bounds how many texts are salted: a text is
    hot with more than max(hot_rows, rows / hot_groups) copies, so at most hot_groups texts can be.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    body = (normalise(text) if normalise else text).cast("binary")
    rows = docs.select(F.col(id_col).alias("id"), body.alias("body"), *([F.struct(*docs.columns).alias("row")] if carry else []))
    hashed = F.xxhash64("body")
    best = F.max if keep == "largest" else F.min
    least = max(hot_rows, docs.count() // hot_groups)
    hot = [r[0] for r in rows.groupBy(hashed.alias("h")).count().filter(F.col("count") > least).select("h").collect()]
    rows = rows.withColumn("head", F.substring("body", 1, HEAD)).withColumn("mark", hashed)
    if hot:
        rows = rows.withColumn("salt", F.when(hashed.isin(hot), F.pmod(F.xxhash64("id"), F.lit(salts))).otherwise(F.lit(0).cast("long")))
    place = ["head", "mark", "salt"] if hot else ["head", "mark"]
    order = F.col("id").desc_nulls_last() if keep == "largest" else F.col("id").asc_nulls_last()
    run = Window.partitionBy(*place, "body").orderBy(order)
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # the sort by content: range partitions of the bytes already gather what the window needs
    found = rows.repartitionByRange(*place).select(
        "id", *(["row"] if carry else []), F.sha2("body", 256).alias("text_sha256"), F.row_number().over(run).alias("place"), F.first("id").over(whole).alias("keep_id"), F.count(F.lit(1)).over(whole).alias("group_size")
    )
    kept = F.col("place") == 1
    if hot:
        totals = rows.filter(hashed.isin(hot)).groupBy("body").agg(best("id").alias("hot_keep"), F.count(F.lit(1)).alias("hot_size")).select(F.sha2("body", 256).alias("text_sha256"), "hot_keep", "hot_size", F.lit(True).alias("is_hot"))
        found = found.join(F.broadcast(totals), "text_sha256", "left")  # hot_groups rows at most
        kept = kept & (F.col("is_hot").isNull() | F.col("keep_id").eqNullSafe(F.col("hot_keep")))
        found = found.withColumn("kept", kept).withColumn("keep_id", F.when(F.col("is_hot"), F.col("hot_keep")).otherwise(F.col("keep_id"))).withColumn("group_size", F.coalesce("hot_size", "group_size"))
    else:
        found = found.withColumn("kept", kept)
    return found.select(F.col("id").alias(id_col), "keep_id", "group_size", "kept", "text_sha256", *(["row"] if carry else []))


def without_copies(docs: DataFrame, **options) -> DataFrame:
    """The input rows that stay, with all their columns."""
    return exact_dedup(docs, carry=True, **options).filter("kept").select("row.*")
