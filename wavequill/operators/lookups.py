"""Lookups and samples: nearest vectors, tags with fallbacks, work lists, priorities and weighted choices."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wavequill.functions.scalars import unit_hash


def _unit(vectors: pa.Array) -> np.ndarray:
    """Rows of unit length; rows of zeros stay zeros."""
    x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1) if len(vectors) else np.zeros((0, 1))
    norm = np.sqrt((x * x).sum(1, keepdims=True))
    return x / np.where(norm > 0, norm, 1.0)


def nearest(queries: DataFrame, index: DataFrame, most: float = 0.75, block: int = 20_000) -> DataFrame:
    """The index row (id, vec) of the least cosine distance for every query (id, vec), the first of equal ones; null beyond
    `most`. A vector of zeros is at distance 1 from all. Rows without a vector are left out; a query is no match of itself.

    Blocks of about `block` queries go to all tasks one after another, as a matrix that the driver holds for that time. A
    task multiplies it with its part of the index and keeps its best match per query, so the index is read once a block and
    one row per query and task is shuffled. Distances count as equal up to 12 decimals.
    """
    spark = index.sparkSession
    q = queries.filter(F.col("vec").isNotNull()).select("id", "vec").dropDuplicates(["id"])
    rows = index.filter(F.col("vec").isNotNull()).select("id", "vec")
    kind = index.select("id").schema[0].dataType.simpleString()
    blocks = max(1, math.ceil(q.count() / (0.9 * block)))  # hashed blocks differ a little in size
    best = None
    for i in range(blocks):
        part = q.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == i).toArrow()
        ids, matrix = part.column("id").combine_chunks(), _unit(part.column("vec").combine_chunks())
        shared = spark.sparkContext.broadcast((ids.to_numpy(zero_copy_only=False), matrix.T.copy()))

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            names, wanted = shared.value
            if not len(names):
                return
            least, found = np.full(len(names), np.inf), [None] * len(names)
            for batch in batches:
                for at in range(0, batch.num_rows, 500):
                    piece = batch.slice(at, 500)
                    own = piece.column("id").to_numpy(zero_copy_only=False)
                    distance = np.round(1 - _unit(piece.column("vec")) @ wanted, 12)
                    distance[own[:, None] == names[None, :]] = np.inf
                    low = distance.min(0)
                    for j in np.flatnonzero(low <= least):
                        first = own[distance[:, j] == low[j]].min() if low[j] < np.inf else None
                        if first is not None and (low[j] < least[j] or first < found[j]):
                            least[j], found[j] = low[j], first
            use = [j for j in range(len(names)) if found[j] is not None]
            yield pa.RecordBatch.from_arrays([pa.array(names[use]), pa.array(least[use]), pa.array([found[j] for j in use], pa.array(names).type)], names=["query_id", "distance", "id"])

        found = rows.mapInArrow(scan, f"query_id {kind}, distance double, id {kind}").groupBy("query_id").agg(F.min(F.struct("distance", "id")).alias("m"))
        best = found if best is None else best.unionByName(found)
    return best.select("query_id", F.when(F.col("m.distance") <= most, F.col("m.id")).alias("match_id"), F.round("m.distance", 6).alias("distance"))


def inverted_index(items: DataFrame, tags: Column, item: str) -> DataFrame:
    """tag -> sorted distinct items; tags are trimmed and lower-cased, empty ones dropped."""
    each = items.select(F.explode(tags).alias("tag"), item).select(F.lower(F.trim("tag")).alias("tag"), item).filter("tag <> ''")
    return each.groupBy("tag").agg(F.sort_array(F.collect_set(item)).alias("items"))


def _parts(df: DataFrame, text: str, sizes: list[int]) -> DataFrame:
    """Every row with each distinct part of its text that has one of the given lengths."""
    def of(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(text) - n + 1, F.lit(1)))
        return F.transform(starts, lambda i: F.substr(F.col(text), i, F.lit(n)))

    return df.withColumn("part", F.explode(F.array_distinct(F.flatten(F.array(*map(of, sizes))))))


def containing(left: DataFrame, a: str, right: DataFrame, b: str) -> DataFrame:
    """Pairs (a, b) of distinct texts of which one contains the other, by equality of parts: each side is cut into parts as
    long as the other side's texts. Empty texts and nulls meet nothing."""
    left, right = (df.select(c).filter(F.length(c) > 0).distinct() for df, c in ((left, a), (right, b)))
    sizes = lambda df, c: sorted(r[0] for r in df.select(F.length(c).alias("n")).distinct().collect())  # noqa: E731 (lengths of names)
    of_left, of_right = sizes(left, a), sizes(right, b)
    if not of_left or not of_right:
        return left.join(right, F.col(a) == F.col(b))
    inside = _parts(left, a, of_right).join(right, F.col("part") == F.col(b)).select(a, b)
    around = _parts(right, b, of_left).join(left, F.col("part") == F.col(a)).select(a, b)
    return inside.unionByName(around).distinct()


def tag_match(wanted: DataFrame, tags: DataFrame, default: str) -> DataFrame:
    """A known tag for every wanted one: the same, else the first that contains it or lies in it, else the default if
    known, else the first of all. Only what no tag equals is cut into parts as long as the others, so all joins are by
    equality, whatever the number of tags."""
    asked, known = wanted.select("wanted").distinct(), tags.select(F.col("tag").alias("known")).filter(F.col("tag").isNotNull()).distinct()
    exact = asked.join(known, F.col("wanted") == F.col("known")).select("wanted", F.lit(False).alias("far"), "known")
    rest = asked.filter(F.col("wanted").isNotNull()).join(exact.select("wanted"), "wanted", "left_anti")
    sizes = lambda df, c: sorted(r[0] for r in df.select(F.length(c).alias("n")).distinct().collect() if r[0])  # noqa: E731 (lengths of names)
    of_known, of_rest = sizes(known, "known"), sizes(rest, "wanted")
    near = exact
    if of_known and of_rest:
        inside = _parts(rest, "wanted", of_known).join(known, F.col("part") == F.col("known")).select("wanted", F.lit(True).alias("far"), "known")
        around = _parts(known, "known", of_rest).join(rest, F.col("part") == F.col("wanted")).select("wanted", F.lit(True).alias("far"), "known")
        near = exact.unionByName(inside).unionByName(around)
    best = near.groupBy("wanted").agg(F.min(F.struct("far", "known"))["known"].alias("match"))
    others = tags.agg(F.max(F.when(F.col("tag") == default, F.col("tag"))).alias("d"), F.min("tag").alias("first"))  # one row
    return asked.join(best, "wanted", "left").join(F.broadcast(others)).select("wanted", F.coalesce("match", "d", "first").alias("match"))


def work_list(jobs: DataFrame, done: DataFrame, planned: DataFrame, key: str) -> DataFrame:
    """Jobs that aren't done: `render` those with a plan, `plan` the others."""
    todo = jobs.join(done.select(key), key, "left_anti")
    return todo.join(planned.select(key).distinct().withColumn("has_plan", F.lit(True)), key, "left").withColumn("step", F.when(F.col("has_plan"), "render").otherwise("plan")).drop("has_plan")


def first_by_priority(rows: DataFrame, keys: list[str], priority: list[Column]) -> DataFrame:
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(*priority))).filter("place = 1").drop("place")


def weighted_choice(rows: DataFrame, key: str, options: list[tuple[str, float]], salt: str = "") -> DataFrame:
    """An option for every row by a reproducible draw in proportion to the weights."""
    total, low, pick = sum(w for _, w in options), 0.0, None
    u = unit_hash(F.col(key), salt)
    for name, w in options:
        low += w / total
        pick = F.when(u < round(low, 9), name) if pick is None else pick.when(u < round(low, 9), name)
    return rows.withColumn("choice", pick.otherwise(options[-1][0]))


def class_counts(rows: DataFrame, column: str, classes: list[str]) -> DataFrame:
    """Counts of all classes, also those without rows."""
    dim = rows.sparkSession.createDataFrame([(c, i) for i, c in enumerate(classes)], f"{column} string, ord int")
    return F.broadcast(dim).join(rows.groupBy(column).count(), column, "left").select(column, "ord", F.coalesce("count", F.lit(0)).alias("n"))


def dominant(rows: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """The most frequent value per key; of equally frequent ones the one seen first."""
    counted = rows.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    return counted.groupBy(*keys).agg(F.max_by(value, F.struct("n", -F.col("first"))).alias(value))
