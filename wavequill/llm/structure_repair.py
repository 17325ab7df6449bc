"""Conversation structure repair: the cheapest edits that make a conversation one of a system turn and pairs of user and
assistant turns, `(s?(ua)+)?` by the initials of its roles.

Every row may be kept, given the role user or assistant ("reroled") or deleted, and turns with an empty text may be
inserted. The rows that stay are chosen by a retained-subsequence programme: prefix sums of deletions price the rows between
two retained ones, the roles of both decide what is inserted there, and for each role that a retained row may end with a
running minimum holds the best of all rows so far. Equal costs are decided by the audits, the edits' initials in order.

Conversations are streamed in runs of bounded size (`turns`). One that lies in a run is done there. A longer one, of any
length, is cut: each run is worked out for every role it may follow on, these small tables are composed in order, and the
runs are then finished side by side. Only the digest of a long conversation's text is made in one pass, as SHA-256 is.

Null roles and texts count as one space, null turns come first; ties of turns are decided by a hash of role and text.
Repeated rows are duplicates. A row without role (an empty text) has no initial and can't be kept as it is. Empty tables
give empty results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wavequill.llm.common import Scratch
from wavequill.llm.turns import in_turns, runs
from wavequill.operators.envelopes import in_order, with_begins

#: white space of the rules
SPACE = " \t\n\x0b\x0c\r"
#: turns to insert between two retained roles ("" is the beginning), and after the last one
BETWEEN = {("", "s"): 0, ("", "u"): 0, ("", "a"): 1, ("s", "u"): 0, ("s", "a"): 1, ("u", "u"): 1, ("u", "a"): 0, ("a", "u"): 0, ("a", "a"): 1}
AFTER = {"": 0, "s": 2, "u": 1, "a": 0}
#: the role that follows on each
NEXT = {"": "u", "s": "u", "a": "u", "u": "a"}
NAMES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}


@dataclass(frozen=True)
class Costs:
    rerole: int = 3
    delete: int = 4
    insert: int = 3
    truncated: int = 3


def faults(rows: list[tuple], again: set[int] = frozenset()) -> tuple[list[tuple[str, bool, bool]], list[int]]:
    """For (turn, role, text) rows: initial, whether the row must go, whether it is truncated; and how many rows are blank,
    duplicate, truncated. again: places of rows that were seen before the first of `rows`."""
    seen, marks, counts = set(), [], [0, 0, 0]
    for i, (_, role, text) in enumerate(rows):
        bare = text.rstrip(SPACE)
        kind = 0 if not bare else 1 if (role, text) in seen or i in again else 2 if bare[-1] not in ".!?" else None
        seen.add((role, text))
        if kind is not None:
            counts[kind] += 1
        marks.append((role[:1], kind in (0, 1), kind == 2))
    return marks, counts


Best = dict[str, tuple[int, str]]


def advance(marks: list[tuple[str, bool, bool]], best: Best, costs: Costs = Costs()) -> Best:
    """The cheapest (cost, audit) for each role of the last retained row, after all rows; best: those before the first row.

    A minimum is held as (cost less the deletions up to its row, audit, its row): then the deletions up to any later row
    are one sum. Two minima of a role never have audits of which one begins the other, so the lesser stays the lesser."""
    minima, deleted = {role: (cost, audit, 0) for role, (cost, audit) in best.items()}, 0
    for j, (initial, must_go, truncated) in enumerate(marks):
        found = {}
        for role in () if must_go else ("s", "u", "a") if initial == "s" else ("u", "a"):
            ways = []
            for before, (cost, audit, at) in minima.items():
                n = BETWEEN.get((before, role))
                if n is not None:
                    ways.append((cost + deleted + n * costs.insert, audit + "D" * (j - at) + "I" * n))
            if ways:
                cost, audit = min(ways)
                kept = initial == role
                found[role] = cost + costs.truncated * truncated + (0 if kept else costs.rerole), audit + ("K" if kept else "R")
        deleted += costs.delete
        for role, (cost, audit) in found.items():
            old = minima.get(role)
            if old is None or (cost - deleted, audit) < (old[0], old[1] + "D" * (j + 1 - old[2])):
                minima[role] = cost - deleted, audit, j + 1
    return {role: (cost + deleted, audit + "D" * (len(marks) - at)) for role, (cost, audit, at) in minima.items()}


def cheapest(best: Best, costs: Costs = Costs()) -> tuple[int, str, str]:
    """Cost, audit and last retained role of the whole conversation."""
    return min((cost + AFTER[role] * costs.insert, audit + "I" * AFTER[role], role) for role, (cost, audit) in best.items())


def repaired(rows: list[tuple], audit: str, role: str = "") -> list[str]:
    """`role:text` of the turns that the edits leave, for rows that follow on `role`."""
    out, left = [], iter(rows)
    for edit in audit:
        name, text = ("", "") if edit == "I" else next(left)[1:3]
        if edit == "D":
            continue
        role = name[:1] if edit == "K" else NEXT[role]
        out.append(f"{name if edit == 'K' else NAMES[role]}:{text}")
    return out


def _outline(rows: list[tuple]) -> list:
    """What neighbouring runs are put together by: least and largest turn, distinct turns, first and last initial, illegal
    pairs, whether there is any row."""
    turns = [t for t, _, _ in rows if t is not None]
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
    return [turns[0] if turns else None, turns[-1] if turns else None, len(set(turns)), initials[0] if rows else None, initials[-1] if rows else None, illegal, bool(rows)]


def _joined(a: list, b: list) -> list:
    """The outline of two runs, of which b comes after a."""
    if not (a[6] and b[6]):
        return a if a[6] else b
    same = a[1] is not None and a[1] == b[0]
    first = [x for x in (a[0], b[0]) if x is not None]
    last = [x for x in (b[1], a[1]) if x is not None]
    return [first[0] if first else None, last[0] if last else None, a[2] + b[2] - same, a[3], b[4], a[5] + b[5] + ((a[4] + b[3]) not in LEGAL), True]


def _gaps(outline: list) -> int:
    return 0 if outline[0] is None else outline[1] - outline[0] + 1 - outline[2]


def _digest(parts: list[str]) -> str:
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()


_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_AT = "at struct<known:boolean,turn:long,tie:string,row:long>"
_ROWS = "rows array<struct<turn:long,role:string,text:string>>"
_OUTLINE = "struct<low:long,high:long,turns:long,first:string,last:string,illegal:long,any:boolean>"
_AT_NAMES, _OUTLINE_NAMES = ("known", "turn", "tie", "row"), ("low", "high", "turns", "first", "last", "illegal", "any")


_LONG, _TEXT, _TRUTH = pa.int64(), pa.string(), pa.bool_()
_AT_TYPE = pa.struct(list(zip(_AT_NAMES, (_TRUTH, _LONG, _TEXT, _LONG), strict=True)))
_ROWS_TYPE = pa.list_(pa.struct([("turn", _LONG), ("role", _TEXT), ("text", _TEXT)]))
_OUTLINE_TYPE = pa.struct(list(zip(_OUTLINE_NAMES, (_LONG, _LONG, _LONG, _TEXT, _TEXT, _LONG, _TRUTH), strict=True)))
_WAYS_TYPE = pa.list_(pa.struct([("before", _TEXT), ("after", _TEXT), ("cost", _LONG), ("audit", _TEXT)]))
_PATH_TYPE = pa.list_(pa.struct([("at", _AT_TYPE), ("before", _TEXT), ("edits", _TEXT)]))
_COUNTS = [("blank", _LONG), ("duplicate", _LONG), ("truncated", _LONG)]
_RESULT_TYPES = [("gaps", _LONG), *_COUNTS, ("illegal", _LONG), ("cost", _LONG), ("audit", _TEXT)]


def repair(conversations: DataFrame, costs: Costs = Costs(), present: str | None = None, most_rows: int = 1024, most_chars: int = 1 << 20) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation.

    present: a boolean column; rows where it is false only say that their conversation exists. A conversation without
    rows has zeros, an empty audit and the digest of nothing. most_rows, most_chars: where a run ends."""
    scratch = Scratch(conversations.sparkSession)
    kind = conversations.schema["conv_id"].dataType.simpleString()
    there = F.coalesce(F.col(present), F.lit(False)) if present else F.lit(True)
    given = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")], there.alias("there"))
    ids = conversations.select("conv_id").limit(0).toArrow().schema.field(0)
    whole = f"conv_id {kind}, {_RESULT}, repaired_sha256 string, {_AT}, {_ROWS}"
    schema = pa.schema([ids, *_RESULT_TYPES, ("repaired_sha256", _TEXT), ("at", _AT_TYPE), ("rows", _ROWS_TYPE)])

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for run in runs(batches, most_rows, most_chars, 5):
            rows = [r[:3] for r in run.rows if r[3]]
            if run.opens and run.closes:
                marks, (blank, duplicate, truncated) = faults(rows)
                outline = _outline(rows)
                cost, audit, _ = cheapest(advance(marks, {"": (0, "")}, costs), costs)
                out.append({"conv_id": run.conv_id, "gaps": _gaps(outline), "blank": blank, "duplicate": duplicate, "truncated": truncated, "illegal": outline[5], "cost": cost, "audit": audit, "repaired_sha256": _digest(repaired(rows, audit)), "at": None, "rows": None})
                held += 1
            else:
                out.append({"conv_id": run.conv_id, "at": dict(zip(_AT_NAMES, run.at, strict=True)), "rows": [dict(zip(("turn", "role", "text"), r, strict=True)) for r in rows]})
                held += len(rows) + 1
            if held >= 4096:
                yield pa.RecordBatch.from_pylist(out, schema)
                out, held = [], 0
        yield pa.RecordBatch.from_pylist(out, schema)

    first = scratch.written(in_turns(given, "there").mapInArrow(streamed, whole), "repair-runs", arrow_rows=4096)
    done = first.filter("at IS NULL").drop("at", "rows")
    return done.unionByName(_long(first.filter("at IS NOT NULL").select("conv_id", "at", "rows"), kind, ids, costs, scratch))


def _named(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"conv_id": "_id", "at": "_at"})


def _same_run() -> list[Column]:
    return [F.equal_null("conv_id", "_id"), F.col("at") == F.col("_at")]


def _long(cut: DataFrame, kind: str, ids: pa.Field, costs: Costs, scratch: Scratch) -> DataFrame:
    """The result of conversations that lie in several runs."""
    # texts seen in earlier runs: a row a run and distinct text is shuffled, never a text
    told = cut.select("conv_id", "at", F.posexplode("rows").alias("i", "r")).select("conv_id", "at", "i", F.md5(F.concat_ws("\n", F.length("r.role"), "r.role", "r.text").cast("binary")).alias("d"))
    once = told.groupBy("conv_id", "d", "at").agg(F.min("i").alias("i"))
    later = once.withColumn("n", F.row_number().over(Window.partitionBy("conv_id", "d").orderBy("at"))).filter("n > 1")
    again = later.groupBy("conv_id", "at").agg(F.collect_list("i").alias("again"))  # at most a run's rows
    rows = scratch.written(cut.join(_named(again), _same_run(), "left").select("conv_id", "at", "rows", "again"), "repair-cut")
    table = f"conv_id {kind}, {_AT}, blank long, duplicate long, truncated long, outline {_OUTLINE}, ways array<struct<before:string,after:string,cost:long,audit:string>>"
    table_schema = pa.schema([ids, ("at", _AT_TYPE), *_COUNTS, ("outline", _OUTLINE_TYPE), ("ways", _WAYS_TYPE)])

    def tabled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                own = [(r["turn"], r["role"], r["text"]) for r in row["rows"]]
                marks, (blank, duplicate, truncated) = faults(own, set(row["again"] or ()))
                ways = [{"before": b, "after": a, "cost": c, "audit": t} for b in AFTER for a, (c, t) in advance(marks, {b: (0, "")}, costs).items()]
                out.append({"conv_id": row["conv_id"], "at": row["at"], "blank": blank, "duplicate": duplicate, "truncated": truncated, "outline": dict(zip(_OUTLINE_NAMES, _outline(own), strict=True)), "ways": ways})
            yield pa.RecordBatch.from_pylist(out, table_schema)

    tables = scratch.written(rows.mapInArrow(tabled, table), "repair-tables", arrow_rows=64)
    total = f"conv_id {kind}, {_RESULT}, path array<struct<at:struct<known:boolean,turn:long,tie:string,row:long>,before:string,edits:string>>"
    total_schema = pa.schema([ids, *_RESULT_TYPES, ("path", _PATH_TYPE)])

    def composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row a run comes by; of its rows only one character each."""
        steps: list[dict] = []

        def ended() -> pa.RecordBatch:
            best, back, counts, outline, where = {"": (0, "")}, [], [0, 0, 0], [None] * 5 + [0, False], ()
            for s in steps:
                found: dict[str, tuple[int, str, str, str]] = {}
                for w in s["ways"]:
                    if w["before"] in best:
                        cost, audit = best[w["before"]]
                        way = cost + w["cost"], audit + w["audit"], w["before"], w["audit"]
                        found[w["after"]] = min(found.get(w["after"], way), way)
                best = {after: way[:2] for after, way in found.items()}
                back.append({after: way[2:] for after, way in found.items()})
                counts = [a + s[k] for a, k in zip(counts, ("blank", "duplicate", "truncated"), strict=True)]
                outline = _joined(outline, [s["outline"][k] for k in _OUTLINE_NAMES])
            cost, audit, where = cheapest(best, costs)
            path, rest = [], "I" * AFTER[where]
            for s, step in zip(reversed(steps), reversed(back), strict=True):
                before, edits = step[where]
                path.append({"at": s["at"], "before": before, "edits": edits + rest})
                where, rest = before, ""
            row = {"conv_id": steps[0]["conv_id"], "gaps": _gaps(outline), "blank": counts[0], "duplicate": counts[1], "truncated": counts[2], "illegal": outline[5], "cost": cost, "audit": audit, "path": path}
            return pa.RecordBatch.from_pylist([row], total_schema)

        for batch, begins in with_begins(batches, ["conv_id"]):
            for row, fresh in zip(batch.to_pylist(), begins, strict=True):
                if fresh and steps:
                    yield ended()
                    steps = []
                steps.append(row)
        if steps:
            yield ended()

    totals = scratch.written(in_order(tables, ["conv_id"], ["at"]).mapInArrow(composed, total), "repair-totals", arrow_rows=256)
    chosen = totals.select("conv_id", F.explode("path").alias("p")).select("conv_id", "p.*")
    both = rows.join(_named(chosen), _same_run()).select("conv_id", "at", "rows", "before", "edits")
    piece = f"conv_id {kind}, {_AT}, any boolean, piece string"
    piece_schema = pa.schema([ids, ("at", _AT_TYPE), ("any", _TRUTH), ("piece", _TEXT)])

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                own = repaired([(r["turn"], r["role"], r["text"]) for r in row["rows"]], row["edits"], row["before"])
                out.append({"conv_id": row["conv_id"], "at": row["at"], "any": bool(own), "piece": "\n".join(own)})
            yield pa.RecordBatch.from_pylist(out, piece_schema)

    summed = f"conv_id {kind}, repaired_sha256 string"
    summed_schema = pa.schema([ids, ("repaired_sha256", _TEXT)])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, begun = None, None, False
        for batch, begins in with_begins(batches, ["conv_id"]):
            out = []
            for k, some, text, fresh in zip(batch.column("conv_id").to_pylist(), batch.column("any").to_pylist(), batch.column("piece").to_pylist(), begins, strict=True):
                if fresh:
                    if digest:
                        out.append({"conv_id": key, "repaired_sha256": digest.hexdigest()})
                    key, digest, begun = k, hashlib.sha256(), False
                if some:
                    digest.update((("\n" if begun else "") + text).encode())
                    begun = True
            yield pa.RecordBatch.from_pylist(out, summed_schema)
        if digest:
            yield pa.RecordBatch.from_pylist([{"conv_id": key, "repaired_sha256": digest.hexdigest()}], summed_schema)

    sums = scratch.written(in_order(both.mapInArrow(finished, piece), ["conv_id"], ["at"]).mapInArrow(hashed, summed), "repair-sums", arrow_rows=16)
    return totals.drop("path").join(_named(sums), F.equal_null("conv_id", "_id")).drop("_id")


def damaged(conversations: DataFrame) -> DataFrame:
    """A fifth of all rows damaged in five ways, by a checksum of conversation and turn (nulls: one space): dropped (`present`
    is false then), emptied, without sentence ends, repeated, said by the user. For trials of the repair."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    way = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    text = F.when(way == 1, F.lit("")).when(way == 2, F.regexp_replace(spaced("text"), "[.!?]", "")).otherwise(spaced("text"))
    role = F.when(way == 4, F.lit("user")).otherwise(spaced("role"))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (way != 0).alias("present"), F.explode(F.when(way == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"))
    return rows.drop("copy")
