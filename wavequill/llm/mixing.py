"""Mixing sources to target weights by fitting a token budget exactly.

Every source gets a target number of words. Whole passes over the source fill it as far as they fit; for what
remains, documents are counted by exact length, each length gives its proportional share, and a bounded-knapsack
dynamic programme picks how many more of each length meet the remaining budget. The documents of a length are
then chosen by a seeded order: those with the least hashes. Their cut-off is found in the one bucket of hashes it lies
in, so no length is a hot task, and rows are compared with it where they are, without a shuffle.

Null and empty texts have size 0 and are never needed. A null source is a source of its own, sorted last.
Repeated rows are documents of their own. Empty tables give empty results. The driver and the weighing hold one number
per source; sources may be very many, but a list of them must fit the driver.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wavequill.llm.common import Scratch, as_key, bucket_bits, bucket_offsets, hash_bucket, word_count

#: rows of a table of sources or lengths that is sent to all tasks at most
SENT = 200_000
#: words that the dynamic programme fits at most
CELLS = 1 << 22


def water_fill(sizes: list[int], weights: list[float], share: float, most: float) -> list[float]:
    """Targets in proportion to the weights that sum to share * sum(sizes); none is above most times its size."""
    caps = [float(most * s) for s in sizes]
    target, free, rest = [0.0] * len(sizes), set(range(len(sizes))), share * sum(sizes)
    while free:
        each = rest / sum(weights[i] for i in free)
        full = {i for i in free if weights[i] * each > caps[i]}
        if not full:
            for i in free:
                target[i] = weights[i] * each
            break
        for i in full:
            target[i] = caps[i]
        free -= full
        rest = max(0.0, rest - sum(caps[i] for i in full))
    return target


def fit_counts(sizes: np.ndarray, counts: np.ndarray, budget: int, room: int = 1 << 17) -> np.ndarray:
    """How many documents of each size to take (at most its count) so that their sizes come nearest below `budget`.

    Proportional shares come first, all but `room` words (or four of the longest documents); the dynamic programme
    fits these exactly. Its table has CELLS places at most; if more is left, as with very long documents, those that fit
    are taken first, longest first.
    """
    take = np.zeros(len(sizes), np.int64)
    use = np.flatnonzero(sizes > 0)
    if not len(use) or budget <= 0:
        return take
    l, c = sizes[use].astype(np.int64), counts[use].astype(np.int64)
    total = int((l * c).sum())
    if budget >= total:
        take[use] = c
        return take
    room = min(budget, max(room, min(CELLS, 4 * int(l.max()))))
    share = c * ((budget - room) / total)
    t = np.minimum(np.floor(share).astype(np.int64), c)
    rest = budget - int((l * t).sum())
    order = np.lexsort((l, -(share - t)))
    order = order[t[order] < c[order]]
    more = order[: np.searchsorted(np.cumsum(l[order]), rest - room, side="right")]
    t[more] += 1
    rest -= int(l[more].sum())
    for i in np.argsort(-l, kind="stable"):
        if rest <= CELLS:
            break
        k = min(int(c[i] - t[i]), rest // int(l[i]))
        t[i] += k
        rest -= k * int(l[i])
    rest = min(rest, CELLS)
    # bounded knapsack over `rest`: counts are split into powers of two, items are used once each
    reached, item = np.zeros(rest + 1, bool), np.full(rest + 1, -1, np.int64)
    reached[0], items = True, []
    for i in np.argsort(l, kind="stable"):
        left, k = min(int(c[i] - t[i]), rest // int(l[i])), 1
        while left > 0 and not reached[rest]:
            k = min(k, left)
            w = k * int(l[i])
            new = np.flatnonzero(reached[: rest + 1 - w] & ~reached[w:]) + w
            item[new] = len(items)
            reached[new] = True
            items.append((int(i), k, w))
            left, k = left - k, 2 * k
        if reached[rest]:
            break
    v = int(np.flatnonzero(reached)[-1])
    while v:
        i, k, w = items[item[v]]
        t[i] += k
        v -= w
    take[use] = t
    return take


def fit_mixture(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: int = 2, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry: bool = False) -> DataFrame:
    """id, size, source_size, target, taken (and copies) for every row; with `carry` also `row`, the whole input row.

    Sources are sorted by code point, null last, and weigh `weights`, repeating.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    row = docs.select(F.col(id_col).alias("id"), as_key(F.col(source_col)).alias("src"), word_count(F.col(text_col)).alias("size"), *([F.struct(*docs.columns).alias("row")] if carry else []))
    row = row.withColumn("h", F.xxhash64(F.lit(seed), F.col("id"), F.col("size")))
    slim = scratch.written(row.drop("row"), "mix-sizes")  # texts are read once for all that follows
    bits = bucket_bits(slim.count())
    slim = slim.withColumn("b", hash_bucket(F.col("h"), bits))
    cells = slim.groupBy("src", "size", "b").agg(F.count(F.lit(1)).alias("n"))
    lengths = cells.groupBy("src", "size").agg(F.sum("n").alias("n"))
    known = sorted(((r["src"], int(r["s"])) for r in lengths.groupBy("src").agg(F.sum(F.col("n") * F.col("size")).alias("s")).collect()), key=lambda x: (x[0] == "", x[0].encode()))
    targets = water_fill([s for _, s in known], [float(weights[i % len(weights)]) for i in range(len(known))], share, most)
    plan = {src: (s, t, min(most, int(t // s)) if s else 0) for (src, s), t in zip(known, targets, strict=True)}
    sources = spark.createDataFrame([(src, *v) for src, v in plan.items()], "src string, source_size long, target double, passes int")
    sources = F.broadcast(sources) if len(plan) <= SENT else sources

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf.iloc[0]
        budget = round(first["target"]) - int(first["passes"]) * int(first["source_size"])
        extra = fit_counts(pdf["size"].to_numpy(), pdf["n"].to_numpy(), budget if first["passes"] < most else 0)
        return pdf[["src", "source_size", "target", "passes", "size"]].assign(extra=extra)

    fitted = lengths.join(sources, "src").groupBy("src").applyInPandas(fit, "src string, source_size long, target double, passes int, size long, extra long")  # one row per distinct length
    fitted = scratch.written(fitted, "mix-fit")
    # the cut-off of every length: the hash of the last document taken, and how many of those with that hash are
    edge = bucket_offsets(cells, ["src", "size"], "b", "n").join(fitted.filter("extra > 0").select("src", "size", "extra"), ["src", "size"])
    edge = edge.filter((F.col("before") < F.col("extra")) & (F.col("extra") <= F.col("before") + F.col("n"))).withColumn("last", F.col("extra") - F.col("before")).select("src", "size", "b", "last")
    order = Window.partitionBy("src", "size", "b").orderBy("h")
    tied = F.count(F.lit(1)).over(Window.partitionBy("src", "size", "b", "h"))
    placed = slim.join(edge, ["src", "size", "b"]).withColumn("at", F.row_number().over(order)).withColumn("before", F.rank().over(order) - 1).withColumn("tied", tied)
    cut = placed.filter(F.col("at") == F.col("last")).select("src", "size", F.col("h").alias("cut"), (F.col("last") - F.col("before")).alias("part"), "tied")
    plans = scratch.written(fitted.join(cut, ["src", "size"], "left"), "mix-lengths")
    some_tied = plans.filter("part < tied").limit(1).count() > 0
    plans = F.broadcast(plans) if plans.count() <= SENT else plans

    out = (row if carry else slim).join(plans, ["src", "size"])
    at_cut, split = F.coalesce(F.col("h") == F.col("cut"), F.lit(False)), F.coalesce(F.col("part") < F.col("tied"), F.lit(False))
    taken = F.coalesce((F.col("h") < F.col("cut")) | at_cut, F.lit(False))
    if some_tied:  # repeated rows at a cut-off, some of which are taken
        whole = out.filter(~(at_cut & split)).withColumn("copies", F.col("passes") + taken.cast("int"))
        place = F.row_number().over(Window.partitionBy("src", "size", "h").orderBy("id"))
        out = whole.unionByName(out.filter(at_cut & split).withColumn("copies", F.col("passes") + (place <= F.col("part")).cast("int")))
    else:
        out = out.withColumn("copies", F.col("passes") + taken.cast("int"))
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "copies", *(["row"] if carry else []))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with all their columns."""
    return fit_mixture(docs, carry=True, **options).filter("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")
