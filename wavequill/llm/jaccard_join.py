"""N-gram Jaccard join with multiple global token orders.

Documents are sets of hashed word shingles; two link when their Jaccard similarity reaches a threshold. If they do,
then under any global order of tokens their prefixes (of n - ceil(t n) + 1 tokens) share a token. Candidates must
pass that test under several orders:

* order 1 ranks the tokens of a fixed low range of hashes by document frequency, counted over all documents, rarest
  first, and all other tokens by hash after them. Only tokens of that range and too short prefixes are ever shuffled,
  and tokens of one document fill most prefixes, so few postings are left to join;
* orders 2 and 3 rank by two other hashes; the prefixes of both are stored beside each set, and a candidate pair of
  order 1 must share a token under both before the whole sets are fetched for verification.

Documents with equal sets are one node, named by the row of their smallest identifier. Large groups of near copies are not expanded into pairs. Every token's list
of nodes has a pivot, the node that stands in most lists, and only pairs with pivots are verified at first; the links
found are contracted to components. For lists that still have several components, a centre C (the tokens that most of
some near members of the pivot have; any set would do) describes each member A by its delta, the symmetric difference
D(A) of A and C. The difference of A and B has |D(A)| + |D(B)| tokens less two for each one the deltas share. So if
A and B link, then either that sum alone is small enough, in which case both link to the member nearest to C by the
same measure, or the deltas share a token within prefixes, at positions that leave room for as many more as a link
needs, of which those that stand next in both deltas are counted at once. Members of one component need no
comparison. A list of members whose deltas share a token is paired if it is short; a crowded one gets a centre of its
own and is searched in the same way, so that pairs don't grow with the square of its size (after LEVELS such rounds,
it is paired in parts). So no link between components is lost, and the components are exact. (Shingles are told apart by 64-bit hashes, sets by 128-bit ones.)

Null, empty and blank texts have no shingles and link with nothing. Rows with a null identifier link with nothing
and have a null component. Repeated rows and copies share a component. Empty tables give empty results; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wavequill.llm.common import Scratch
from wavequill.llm.shingles import mix, shingle_sets

#: seeds of the orders after the first
ORDERS = (0x2545F4914F6CDD1D, 0x9E6C63D0876A9A47)
#: rows of text that are hashed at a time
ROWS = 1000
#: pairs of sets that are compared at a time
PAIRS = 250
#: identifiers that are sent to all tasks at most
SENT = 500_000
#: a key of a join is heavy with more rows than HOT_ROWS and than a HOT_KEYS-th of all, so at most HOT_KEYS are
HOT_ROWS, HOT_KEYS = 1000, 65_536
#: members of a list of deltas above which it gets a centre of its own, and how often that is done. A member of a new list
#: costs a fetch of its set and a delta, far more than a pair that is compared where the list is joined
CROWD, LEVELS = 256, 3
#: tokens of a delta that are compared where two deltas meet
NEXT = 8
#: parts in which rows without a key are dealt
KEYLESS = 4096


def prefix_size(n: np.ndarray | int, num: int, den: int):
    """Tokens of a set of n, of which a set as similar as num / den must share one."""
    return n - (n * num + den - 1) // den + 1


def low_range(num: int, den: int) -> int:
    """Upper end of the hashes that order 1 ranks by frequency: a prefix's share of the tokens and a tenth more, so
    that the many tokens of one document alone fill most prefixes."""
    return int(-(1 << 63) + min(0.999, 1.2 * (1 - num / den) + 0.09) * (1 << 64))


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays) if arrays else [], kind))


def _signature(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _heavy(counts: DataFrame, key: str, rows: int) -> DataFrame:
    """key, parts: the heavy keys of `counts` (key, count), of `rows` rows in all, and into how many parts each is cut."""
    most = max(HOT_ROWS, rows // HOT_KEYS)
    return counts.filter(F.col("count") > most).select(key, F.ceil(F.col("count") / most).cast("int").alias("parts"))


def _spread(left: DataFrame, right: DataFrame, heavy: DataFrame, key: str, by: str, how: str = "inner") -> DataFrame:
    """`left` joined with `right`, which has one row a key. Rows of heavy keys are dealt to their parts by a hash of
    `by`, and each part gets a copy of the right row, so no task holds a whole heavy key."""
    heavy = F.broadcast(heavy)  # HOT_KEYS rows at most
    parts = F.coalesce("parts", F.lit(1))
    dealt = F.pmod(F.xxhash64(by), F.when(F.col(key).isNull(), KEYLESS).otherwise(parts)).cast("int")
    left = left.join(heavy, key, "left").withColumn("part", dealt).drop("parts")
    right = right.join(heavy, key, "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    return left.join(right, [key, "part"], how).drop("part")


def shingled(docs: DataFrame, words: int, num: int, den: int, id_col: str, text_col: str) -> DataFrame:
    """id, row (a number of its own), n, sig (of the set), low (what order 1 needs: tokens of the low range, or the first
    of a prefix)."""
    top = low_range(num, den)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 36
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                n, sig, low = [], [], []
                for s in shingle_sets(batch.column("text").to_pylist(), words):
                    n.append(len(s))
                    sig.append(_signature(s) if len(s) else None)
                    low.append(s[: max(int(np.searchsorted(s, top)), prefix_size(len(s), num, den))] if len(s) else s)
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(np.arange(row, row + len(n))), pa.array(n, pa.int64()), pa.array(sig, pa.binary()), _lists(low, pa.int64())], names=["id", "row", "n", "sig", "low"])
                row += len(n)

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, row long, n long, sig binary, low array<long>")


def prefix_postings(nodes: DataFrame, scratch: Scratch, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """tok, node: the tokens of order 1's prefixes that more than one node has; and the heavy ones."""
    top = low_range(num, den)
    postings = nodes.select("node", F.explode("low").alias("tok"))
    shared = scratch.written(postings.groupBy("tok").count().filter("count > 1"), "shared")
    heavy = scratch.written(_heavy(shared, "tok", shared.agg(F.sum("count")).first()[0] or 0), "heavy")
    shared = shared.withColumnRenamed("count", "df")
    ranked = F.struct((F.col("tok") >= top).alias("late"), F.when(F.col("tok") >= top, 0).otherwise(F.col("df")).alias("df"), "tok")
    own = _spread(postings, shared, heavy, "tok", "node").groupBy("node").agg(F.array_sort(F.collect_list(ranked)).alias("toks"))  # one document's
    counts = nodes.select("node", "n", F.size(F.filter("low", lambda t: t < top)).alias("ranged"))
    alone = F.col("ranged") - F.size(F.filter("toks", lambda t: ~t["late"]))  # tokens of one node come first
    room = F.col("n") - F.floor((F.col("n") * num + den - 1) / den) + 1 - alone
    kept = own.join(counts, "node").withColumn("room", room.cast("int")).filter("room > 0")
    lists = scratch.written(kept.select("node", F.explode(F.slice("toks", F.lit(1), F.col("room"))).alias("t")).select("t.tok", "node"), "postings")
    scratch.drop("shared")
    return lists, heavy


def _prefix(s: np.ndarray, seed: int, num: int, den: int) -> np.ndarray:
    """The prefix of a set under the order that a seed gives, as sorted 32-bit numbers: equal tokens have equal ones."""
    order = mix(s.view(np.uint64) ^ np.uint64(seed))
    p = min(len(s), int(prefix_size(len(s), num, den)))
    return np.unique((np.partition(order, p - 1)[:p] >> np.uint64(32)).astype(np.uint32).view(np.int32))


def whole_sets(texts: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """sig, n, toks (the whole set) and a prefix for each order after the first, of every row of `text`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toks = [s for s in shingle_sets(batch.column("text").to_pylist(), words) if len(s)]
            prefixes = [_lists([_prefix(s, seed, num, den) for s in toks], pa.int32()) for seed in ORDERS]
            yield pa.RecordBatch.from_arrays([pa.array(map(_signature, toks), pa.binary()), pa.array(map(len, toks), pa.int64()), _lists(toks, pa.int64()), *prefixes], names=["sig", "n", "toks", *(f"prefix{i}" for i in range(len(ORDERS)))])

    return texts.mapInArrow(run, "sig binary, n long, toks array<long>" + "".join(f", prefix{i} array<int>" for i in range(len(ORDERS))))


def _linked(pairs: DataFrame, sets: DataFrame, scratch: Scratch, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that pass the filters of all orders and link. Whole sets are fetched for those alone that pass."""
    names = [f"prefix{i}" for i in range(len(ORDERS))]

    def both(of: DataFrame, columns: list[str]) -> DataFrame:
        side = lambda k: sets.select(F.col("node").alias(k), *[F.col(c).alias(k + c) for c in columns])
        return of.join(side("a"), "a").join(side("b"), "b")

    def meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for c in names:
                x, y = batch.column("a" + c), batch.column("b" + c)
                for i in np.flatnonzero(keep):
                    keep[i] = len(np.intersect1d(x[int(i)].values.to_numpy(), y[int(i)].values.to_numpy(), assume_unique=True)) > 0
            yield pa.RecordBatch.from_arrays([batch.column(k).take(pa.array(np.flatnonzero(keep))) for k in ("a", "b")], names=["a", "b"])

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links, x, y = [], batch.column("atoks"), batch.column("btoks")
            for i in range(batch.num_rows):
                p, q = x[i].values.to_numpy(), y[i].values.to_numpy()
                common = len(np.intersect1d(p, q, assume_unique=True))
                if den * common >= num * (len(p) + len(q) - common):
                    links.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(k).take(pa.array(links, pa.int64())) for k in ("a", "b")], names=["a", "b"])

    sized = F.least("an", "bn") * den >= F.greatest("an", "bn") * num
    candidates = both(pairs, ["n", *names]).filter(sized).select("a", "b", *[k + c for c in names for k in "ab"]).mapInArrow(meeting, "a long, b long")
    candidates = scratch.written(candidates, "candidates", PAIRS)
    links = scratch.written(both(candidates, ["toks"]).select("a", "b", "atoks", "btoks").mapInArrow(verified, "a long, b long"), f"links{len(scratch.paths)}", PAIRS)
    scratch.drop("candidates")
    return links


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """node, comp (the smallest node that links reach) for the nodes of `links` (a, b): alternating stars, until every
    node that has a smaller one has it alone and no node has both a smaller and a larger one."""
    edges = scratch.written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        hubs = _heavy(both.groupBy("a").count(), "a", 2 * edges.count())
        large = _spread(both, least, hubs, "a", "b").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = scratch.written(large, "large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        pairs = _spread(large, least, _heavy(large.groupBy("a").count(), "a", large.count()), "a", "b")
        small = pairs.select("a", F.col("m").alias("b")).unionByName(pairs.select(F.col("b").alias("a"), F.col("m").alias("b"))).filter("a <> b").distinct()
        edges = scratch.written(small, "edges")
        ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("smaller")).unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("smaller")))
        open_ = ends.groupBy("node").agg(F.sum("smaller").alias("up"), F.count(F.lit(1)).alias("all")).filter("up > 1 or (up = 1 and all > 1)")
        if not open_.limit(1).count():
            scratch.drop("large")
            return scratch.written(edges.select(F.col("a").alias("node"), F.col("b").alias("comp")), "components")


def _lively(lists: DataFrame, heavy: DataFrame) -> DataFrame:
    """The lists with nodes of more than one component."""
    ends = lists.groupBy("tok").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low <> high")
    return _spread(lists, ends.select("tok"), heavy, "tok", "node", "left_semi")


def _pivoted(lists: DataFrame, heavy: DataFrame) -> DataFrame:
    """The lists with their pivots p."""
    degree = lists.groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
    chosen = lists.join(degree, "node").groupBy("tok").agg(F.max(F.struct("degree", -F.col("node"), "node"))["node"].alias("p"))
    return _spread(lists, chosen, heavy, "tok", "node")


def _centres(members: DataFrame, sets: DataFrame, voters: int = 32) -> DataFrame:
    """p, centre: the tokens that at least half of the nearer members have, asked of `voters` members at most; near
    means near to the pivot or, in a list without one, to the first voter.
    Which set it is changes how many pairs are verified, not which links are found."""
    order = Window.partitionBy("p").orderBy((F.col("a") != F.col("p")), F.xxhash64("a", "p"), "a")
    asked = members.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= voters)
    known = asked.join(sets.withColumnRenamed("node", "a"), "a").select("p", "place", "toks")

    def vote(key: tuple, rows: pa.Table) -> pa.Table:
        own = [np.array(x, np.int64) for x in rows["toks"].to_pylist()]
        first = own[rows["place"].to_pylist().index(1)]
        near = [x for x in own if 4 * len(np.intersect1d(x, first, assume_unique=True)) >= len(x) + len(first)]
        toks, count = np.unique(np.concatenate(near), return_counts=True)
        centre = first if len(near) < 3 else toks[2 * count >= len(near)]
        return pa.table({"p": [key[0].as_py()], "centre": pa.array([centre], pa.list_(pa.int64()))})

    return known.groupBy("p").applyInArrow(vote, "p long, centre array<long>")


def _following(flat: np.ndarray, at: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    """32 bits of each of the NEXT tokens after every place `at`, up to its end; null where two of them are the same."""
    short = (flat & 0xFFFFFFFF).astype(np.uint32).view(np.int32)
    count = np.minimum(NEXT, ends - at - 1)
    offsets = np.concatenate([[0], np.cumsum(count)])
    row = np.repeat(np.arange(len(at)), count)
    own = short[at[row] + 1 + np.arange(len(row)) - offsets[row]]
    order = np.lexsort((own, row))
    twice = (np.diff(row[order]) == 0) & (np.diff(own[order]) == 0)
    unclear = np.zeros(len(at), bool)
    unclear[row[order][1:][twice]] = True
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(own, pa.int32()), mask=pa.array(unclear))


def _deltas(members: DataFrame, sets: DataFrame, centres: DataFrame, heavy: DataFrame, num: int, den: int) -> DataFrame:
    """p, tok, a, n, size, pos, next: the prefix of every member's delta to its pivot's centre; the order has the tokens
    outside the centre first, then the centre's, each by hash. size is the whole delta's, pos counts from 1, next has
    the tokens that follow; an empty delta has one row without a token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right, toks, n, size = batch.column("toks"), batch.column("centre"), [], [], []
            for i in range(batch.num_rows):
                x, y = left[i].values.to_numpy(), right[i].values.to_numpy()
                new, gone = np.setdiff1d(x, y, assume_unique=True), np.setdiff1d(y, x, assume_unique=True)
                n.append(len(x))
                size.append(len(new) + len(gone))
                toks.append(np.concatenate([new, gone])[: len(x) * (den - num) // num + 1 + NEXT] if size[-1] else np.zeros(1, np.int64))
            n, size = np.array(n, np.int64), np.array(size, np.int64)
            held = np.array([len(t) for t in toks], np.int64)
            count = np.minimum(held, n * (den - num) // num + 1)
            row = np.repeat(np.arange(len(toks)), count)
            pos = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + 1
            flat, ends = np.concatenate(toks) if toks else np.zeros(0, np.int64), np.cumsum(held)
            at, sizes, take = (ends - held)[row] + pos - 1, size[row], pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column("p").take(take), pa.array(flat[at], pa.int64(), mask=sizes == 0), batch.column("a").take(take), pa.array(n[row]), pa.array(sizes), pa.array(pos, pa.int64()), _following(flat, at, ends[row])],
                names=["p", "tok", "a", "n", "size", "pos", "next"],
            )

    whole = _spread(members.join(sets.withColumnRenamed("node", "a"), "a"), centres, heavy, "p", "a")
    return whole.select("p", "a", "toks", "centre").mapInArrow(run, "p long, tok long, a long, n long, size long, pos long, next array<int>")


def _near_pairs(deltas: DataFrame, heavy: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of the member nearest to each centre and those whose deltas are small enough to link with it."""
    each = deltas.filter("pos = 1").withColumn("far", F.col("size") * (den + num) - F.col("n") * (den - num))
    nearest = each.groupBy("p").agg(F.min(F.struct("far", "a")).alias("q")).select("p", F.col("q.far").alias("near"), F.col("q.a").alias("q"))
    found = _spread(each, nearest, heavy, "p", "a").filter((F.col("far") + F.col("near") <= 0) & (F.col("a") != F.col("q")))
    return found.select(F.least("a", "q").alias("a"), F.greatest("a", "q").alias("b")).distinct()


def _delta_pairs(at: DataFrame, lists: DataFrame, heavy: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of different components that stand in one of `lists` (list, count), where a link allows it.

    Both have the list's token. Of the tokens after it, those that both have are among the next ones of both or lie
    beyond the next ones of either.
    """
    cuts = F.ceil(F.col("count") / HOT_ROWS).cast("int").alias("cuts")
    kept = _spread(at, lists.select("list", cuts), heavy, "list", "a")
    names = ("list", "a", "n", "size", "pos", "next", "comp")
    left = kept.select(*names, F.pmod(F.xxhash64("a"), F.col("cuts")).cast("int").alias("part"))
    right = kept.select(*[F.col(k).alias(k + "2") for k in names], F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("part2"))
    need = (F.col("size") + F.col("size2")) * (den + num) - (den - num) * (F.col("n") + F.col("n2"))
    rest = lambda k: F.col("size" + k) - F.col("pos" + k)
    fits = 2 * (den + num) * (1 + F.least(rest(""), rest("2"))) >= need
    shared = F.size(F.array_intersect("next", "next2")) + F.greatest(F.lit(0), rest("") - NEXT, rest("2") - NEXT)
    meet = F.coalesce(2 * (den + num) * (1 + shared) >= need, F.lit(True)) | F.col("next").isNull() | F.col("next2").isNull()
    sized = F.least("n", "n2") * den >= F.greatest("n", "n2") * num
    same = (F.col("list") == F.col("list2")) & (F.col("part") == F.col("part2"))
    joined = left.join(right, same & (F.col("a") < F.col("a2")) & (F.col("comp") != F.col("comp2")) & sized & fits & meet)
    return joined.select("a", F.col("a2").alias("b")).distinct()


def _second_pairs(members: DataFrame, comps: DataFrame, tokens: DataFrame, scratch: Scratch, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of `members` (p, a) of lists with several components, enough to join all that links within a list."""
    found = []
    for level in range(LEVELS + 1):
        crowded = _heavy(members.groupBy("p").count(), "p", members.count())
        deltas = scratch.written(_deltas(members, tokens, _centres(members, tokens), crowded, num, den), "deltas", PAIRS)
        at = deltas.filter("tok is not null").select(F.xxhash64("p", "tok").alias("list"), "a", "n", "size", "pos", "next")
        at = at.join(comps.withColumnRenamed("node", "a"), "a", "left").withColumn("comp", F.coalesce("comp", "a"))
        ends = at.groupBy("list").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count(F.lit(1)).alias("count"))
        lists = scratch.written(ends.filter("low <> high").select("list", "count"), "ends")
        heavy = _heavy(lists, "list", lists.agg(F.sum("count")).first()[0] or 0)
        short = lists.filter(F.col("count") <= CROWD) if level < LEVELS else lists
        pairs = _delta_pairs(at, short, heavy, num, den)
        found.append(scratch.written(pairs.unionByName(_near_pairs(deltas, crowded, num, den)), f"pairs{level}"))
        long = lists.filter(F.col("count") > CROWD)
        if level == LEVELS or not long.limit(1).count():
            break
        again = _spread(at, long.select("list"), heavy, "list", "a", "left_semi").select(F.col("list").alias("p"), "a").distinct()
        members = scratch.written(again, "members")
    scratch.drop("members", "deltas", "ends")
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs.distinct()


def link_components(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles and component_id (the smallest identifier that links reach) for every row."""
    scratch = Scratch(docs.sparkSession)
    rows = scratch.written(shingled(docs, words, num, den, id_col, text_col), "shingles", ROWS)
    sets_of = rows.filter("sig is not null and id is not null")
    first = F.min(F.struct("id", "row")).alias("first")
    reps = scratch.written(sets_of.groupBy("sig").agg(first, F.count(F.lit(1)).alias("copies")).select("sig", F.col("first.id").alias("id"), F.col("first.row").alias("node"), "copies"), "sets-of")
    copied = _heavy(reps.withColumnRenamed("copies", "count"), "sig", rows.count())
    repeats = _spread(sets_of.select("sig", "row"), reps.filter("copies > 1").select("sig", "node"), copied, "sig", "row").filter("row <> node").select("row")
    repeats = scratch.written(repeats, "repeats")
    nodes = sets_of.join(_sent(repeats), "row", "left_anti").select(F.col("row").alias("node"), "n", "low")
    lists, heavy = prefix_postings(nodes, scratch, num, den)
    slim = scratch.written(rows.select("id", "row", "n", "sig"), "rows")
    scratch.drop("shingles", "repeats")

    # whole sets of the nodes that stand in some list with others
    needed = _spread(lists, lists.groupBy("tok").count().filter("count > 1").select("tok"), heavy, "tok", "node", "left_semi").select("node").distinct()
    wanted = scratch.written(reps.join(needed, "node", "left_semi").select("sig", "id", "node"), "nodes")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(_sent(wanted.select("id").distinct()), "id", "left_semi").select("text")
    sets = whole_sets(texts, words, num, den).join(_sent(wanted.select("sig", "node")), "sig").drop("sig").dropDuplicates(["node"])
    sets = scratch.written(sets, "sets", ROWS)

    lists = scratch.written(_pivoted(_lively(lists.withColumn("comp", F.col("node")), heavy), heavy), "lists")
    near = lists.filter("node <> p").select(F.least("node", "p").alias("a"), F.greatest("node", "p").alias("b")).distinct()
    links = _linked(near, sets, scratch, num, den)
    comps = components(links, scratch)
    open_ = _lively(lists.filter("node <> p").drop("comp").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node")), heavy)
    members = open_.select("p", F.col("node").alias("a"))
    members = scratch.written(members.unionByName(members.select("p", F.col("p").alias("a"))).distinct(), "members")
    scratch.drop("postings", "lists", "nodes", "heavy")
    pairs = _second_pairs(members, comps, sets.select("node", "toks"), scratch, num, den)
    more = _linked(pairs, sets, scratch, num, den)
    scratch.drop("sets", *(n for n in list(scratch.paths) if n.startswith("pairs")))
    if more.limit(1).count():
        comps = components(comps.select(F.col("node").alias("a"), F.col("comp").alias("b")).unionByName(more), scratch)
    placed = reps.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    least = placed.groupBy("comp").agg(F.min("id").alias("component_id"), F.sum("copies").alias("members")).filter("members > 1")
    moved = placed.join(least, "comp").select("sig", "component_id")
    out = _spread(slim, moved, copied, "sig", "row", "left")
    out = scratch.written(out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id")), "linked")
    scratch.drop(*(n for n in list(scratch.paths) if n != "linked"))
    return out


def _sent(keys: DataFrame) -> DataFrame:
    """With at most SENT rows, to be sent to all tasks; else a join shuffles."""
    return F.broadcast(keys) if keys.count() <= SENT else keys


def one_of_each(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows that stand for their component (those whose identifier names it), with all their columns."""
    found = link_components(docs, id_col=id_col, **options).filter(F.col(id_col) != F.col("component_id")).select(id_col).distinct()
    return docs.join(found, id_col, "left_anti")
