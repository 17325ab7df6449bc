"""Secret scans with an incremental blob ledger.

Every version of every document is addressed by the SHA-256 of its text. The ledger holds, per blob, which
rule versions have scanned it and what each of them found: every span names its rule version, so a ledger stays
right when rules are added, reordered or replaced. A scan keeps one copy of every distinct blob, drops the pairs of
blob and rule version that the ledger has, reads only what is left, adds that to the ledger, and joins the findings
of the wanted rule versions back to all paths (documents) that hold the blob. From one run to the next:

    new = update_ledger(docs, ledger, path=place)     # appends to the table in `place`
    found = findings(docs, spark.read.parquet(place))

Spans count code points, end exclusive. Null texts count as empty. Repeated rows and copies share a blob and get
the same findings. Empty tables give empty results; other input columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavequill.llm.common import written


def _either_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


@dataclass(frozen=True)
class Rule:
    """A versioned pattern. `hint` is a cheaper pattern that matches wherever `pattern` does; `least` and `group`
    bound the length of a match, failing ones are dropped after they have consumed their characters."""

    kind: str
    version: int
    pattern: str
    hint: str
    group: int = 0
    least: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"

    def spans(self, text: str) -> list[tuple[int, int]]:
        return [m.span() for m in re.finditer(self.pattern, text) if len(m[self.group]) >= self.least]


_NAMES = "(" + "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key")) + ")"
BASE = (
    Rule("assign", 1, _NAMES + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", _NAMES + r"""["']?\x20*[:=]""", group=2, least=6),
    Rule("access", 1, r"AKIA[A-Z0-9]+", r"AKIA[A-Z0-9]{16}", least=20),
    Rule("hex", 1, r"[0-9a-f]+", r"[0-9a-f]{24}", least=24),
)
MORE = (
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", r"gh[pousr]_"),
    Rule("jwt", 2, r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", r"eyJ[A-Za-z0-9_-]{8}"),
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", r"-----BEGIN "),
)
RULES = (*BASE, *MORE)
BASE_KINDS = tuple(r.kind for r in BASE)
LEDGER = "blob string, scanned array<string>, spans array<struct<start:long,rule:string,end:long>>"
#: bytes of findings that are sent to all tasks at most; above, the join shuffles, with every blob in SALTS parts
SENT, SALTS = 64 << 20, 16


def scan_new(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows for `blobs` (blob, text, done: names of rule versions to leave out, or null)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hint = "|".join(r.hint for r in rules)
        schema = pa.schema([("blob", pa.string()), ("scanned", pa.list_(pa.string())), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("rule", pa.string()), ("end", pa.int64())])))])
        for batch in batches:
            text, done = batch.column("text"), batch.column("done").to_pylist()
            likely = pc.match_substring_regex(text, hint).to_pylist()
            scanned, found = [], []
            for i, old in enumerate(done):
                todo = [r for r in rules if r.name not in (old or ())]
                scanned.append([r.name for r in todo])
                t = text[i].as_py() if likely[i] else ""
                found.append([{"start": s, "rule": r.name, "end": e} for r in todo for s, e in r.spans(t)] if t else [])
            yield pa.RecordBatch.from_arrays([batch.column("blob"), pa.array(scanned, schema.field(1).type), pa.array(found, schema.field(2).type)], schema=schema)

    return blobs.mapInArrow(scan, LEDGER)


def _blob(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def update_ledger(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, text_col: str = "text", path: str | None = None) -> DataFrame:
    """The new ledger rows, one per blob with unseen rule versions, appended to the Parquet table in `path` or, without
    one, written to the shared folder. `ledger` holds all earlier rows."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    blobs = docs.select(_blob(F.col(text_col)).alias("blob"), text.alias("text")).dropDuplicates(["blob"])
    names = [r.name for r in rules]
    if ledger is None:
        todo = blobs.withColumn("done", F.lit(None).cast("array<string>"))
    else:
        done = ledger.select("blob", F.explode("scanned").alias("name")).filter(F.col("name").isin(names)).groupBy("blob").agg(F.collect_set("name").alias("done"))  # a name a rule
        todo = blobs.join(done, "blob", "left").filter(F.col("done").isNull() | (F.size("done") < len(names)))
    fresh = written(scan_new(todo, rules), "secret-ledger")
    if path:
        fresh.write.mode("append").parquet(path)
    return fresh


def findings(docs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, a count per base kind, base_sha256 and all spans for every row, by what the ledger says of its blob under
    exactly these rule versions."""
    known = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.name), F.lit(i))])
    current = F.filter("spans", lambda s: s["rule"].isin([r.name for r in rules]))
    placed = F.transform(current, lambda s: F.struct(s["start"].alias("start"), F.element_at(known, s["rule"]).alias("place"), s["end"].alias("end")))
    hits = ledger.select("blob", placed.alias("spans")).filter(F.size("spans") > 0)
    hits = hits.groupBy("blob").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"))  # one blob's
    paths = docs.select(F.col(id_col).alias("id"), _blob(F.col(text_col)).alias("blob"))
    size = hits.agg(F.sum(100 + 20 * F.size("spans").cast("long"))).first()[0] or 0
    if size <= SENT:
        at = paths.join(F.broadcast(hits), "blob", "left")
    else:  # one blob may be the text of very many rows
        salted = hits.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        at = paths.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).join(salted, ["blob", "salt"], "left")
    at = at.withColumn("spans", F.coalesce("spans", F.array().cast("array<struct<start:long,place:int,end:long>>")))
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    base = [i for i, r in enumerate(rules) if r.kind in BASE_KINDS]

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["place"] + 1), s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        own = [i for i, r in enumerate(rules) if r.kind == kind]
        return F.size(F.filter("spans", lambda s: s["place"].isin(own))).cast("long").alias(f"n_{kind}")

    return at.select(F.col("id").alias(id_col), *map(count, BASE_KINDS), F.sha2(joined(F.filter("spans", lambda s: s["place"].isin(base))), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def scan_secrets(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """`update_ledger`, then the `findings` of all ledger rows, old and new."""
    fresh = update_ledger(docs, ledger, rules, text_col, path)
    return findings(docs, fresh if ledger is None else ledger.select(*fresh.columns).unionByName(fresh), rules, id_col, text_col)
