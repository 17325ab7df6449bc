"""URL filters by a cascade of Bloom filters.

Rules are keys of a host and a path prefix. Every URL of the corpus has a few candidate keys (its host's suffixes
with as many labels as some rule's host, each with its path cut to the length of some rule's path); the distinct
candidate keys are the complete key universe. For each list a cascade is built over it: level 1 encodes the listed
keys, level 2 the unlisted keys that pass level 1, level 3 the listed keys that pass level 2, and so on until no
false positive is left. A key's membership is then exact: the first level that rejects it decides, by its parity.
URLs are judged by bit tests against the levels, without a join.

A level's words reach the driver and every task. They number as the listed keys, not as the corpus: the first
level's false-positive rate is chosen so that as many unlisted keys pass as are listed. The list of hosts may be a
DataFrame of any length: its keys stay in Spark, the driver sees how many labels they have and the levels' words.

Null URLs and those without `://` have empty host and path, fit no rule and get the default verdict. Rows repeat
in the result as in the input; other columns are ignored, so none can clash. Empty tables give empty results.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavequill.llm.common import written

#: (action, host, path)
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
#: names of sites that are blocked, with their subdomains, where no rule fits, and what they stand under. The list was set
#: by what the names say (gambling, advertisements, spam, pills, adult sites); a real run passes its own table
LISTED_NAMES, LISTED_UNDER = ("casino-bonus", "casino-win", "free-bets", "ads-track", "spam-farm", "cheap-pills", "adult-x"), ("example.com", "example.org", "example.net")
LISTED_HOSTS = tuple(f"{name}.{under}" for name in LISTED_NAMES for under in LISTED_UNDER)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def candidate_keys(host: Column, path: Column, shapes: set[tuple[int, int]]) -> Column:
    """The keys a URL could share with keys of these shapes (labels of the host, characters of the path), longest host
    and longest path first."""
    labels = F.split(host, r"\.")
    out = []
    for n in sorted({k for k, _ in shapes}, reverse=True):
        suffix = F.when(F.size(labels) >= n, F.substring_index(host, ".", -n))
        for length in sorted({size for k, size in shapes if k == n}, reverse=True):
            out.append(F.when(F.length(path) >= length, F.concat(suffix, F.substring(path, 1, length))))
    return F.array_distinct(F.array_compact(F.array(*out)))


def _position(key: Column, level: int, i: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(level), F.lit(i)), F.lit(bits))


class Level:
    """One Bloom filter: the bits of the encoded keys as 64-bit words."""

    def __init__(self, keys: DataFrame, number: int, bits: int, hashes: int):
        self.number, self.bits, self.hashes = number, bits, hashes
        at = keys.select(F.explode(F.array(*[_position(F.col("key"), number, i, bits) for i in range(hashes)])).alias("at"))
        words = at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("at", F.lit(64)).cast("int"))).alias("set"))
        table = [0] * ((bits + 63) // 64)
        for r in words.collect():  # as many as the filter's words
            table[r["word"]] = r["set"]
        self.words = F.split(F.lit(",".join(map(str, table))), ",").cast("array<bigint>")  # folded to one constant

    def passes(self, key: Column) -> Column:
        test = F.lit(True)
        for i in range(self.hashes):
            at = _position(key, self.number, i, self.bits)
            word = F.element_at(self.words, (F.shiftright(at, 6) + 1).cast("int"))
            test = test & (F.call_function("getbit", word, F.pmod(at, F.lit(64)).cast("int")) == 1)
        return test


class Cascade:
    """Exact membership in `listed` for every key of `universe`, two DataFrames with a column `key`."""

    def __init__(self, listed: DataFrame, universe: DataFrame, most_levels: int = 60):
        self.levels: list[Level] = []
        encoded, other = listed, universe.join(listed, "key", "left_anti")
        r, s = encoded.count(), other.count()
        rate = min(0.5, r * math.sqrt(0.5) / max(1, s))
        while r:
            if len(self.levels) == most_levels:
                raise ValueError("the cascade does not end; is a listed key repeated in another spelling?")
            hashes = max(1, math.ceil(math.log2(1 / rate)))
            level = Level(encoded, len(self.levels) + 1, max(64, math.ceil(1.4427 * r * hashes)), hashes)
            self.levels.append(level)
            encoded, other = other.filter(level.passes(F.col("key"))), encoded
            r, rate = encoded.count(), 0.5

    def holds(self, key: Column) -> Column:
        answer = F.lit(len(self.levels) % 2 == 1)
        for i in range(len(self.levels), 0, -1):
            answer = F.when(~self.levels[i - 1].passes(key), F.lit(i % 2 == 0)).otherwise(answer)
        return answer


def filter_urls(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, listed_hosts: tuple[str, ...] | DataFrame = LISTED_HOSTS, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """id, host, path, rule, verdict for every row; the longest fitting rule decides, else the list of hosts (names, or
    a DataFrame with a column `host`, whose nulls and empty names are left out)."""
    spark = pages.sparkSession

    def frame(names: list[str]) -> DataFrame:
        listed = [F.lit(x) for x in sorted(set(names))]
        return spark.range(1).select(F.explode(F.array(*listed).cast("array<string>")).alias("key"))

    shapes = {(h.count(".") + 1, len(p)) for _, h, p in rules}
    if isinstance(listed_hosts, DataFrame):
        hosts = written(listed_hosts.select(F.translate("host", UPPER, LOWER).alias("key")).filter("key <> ''").distinct(), "url-hosts")
        shapes |= {(r["n"], 0) for r in hosts.select(F.size(F.split("key", r"\.")).alias("n")).distinct().collect()}  # one number a depth
    else:
        hosts = frame(list(listed_hosts))
        shapes |= {(h.count(".") + 1, 0) for h in listed_hosts}
    urls = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    urls = urls.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), shapes))
    universe = written(urls.select(F.explode("keys").alias("key")).distinct(), "url-keys")
    allow, block = (Cascade(frame([h + p for a, h, p in rules if a == action]), universe) for action in ("allow", "block"))
    listed = Cascade(hosts, universe)
    # of the fitting keys the longest wins, of equally long ones the more specific host, which comes first
    fits = F.transform(F.filter("keys", lambda k: allow.holds(k) | block.holds(k)), lambda k, i: F.struct(F.length(k).alias("length"), (-i).alias("place"), k.alias("key")))
    judged = urls.select("id", "host", "path", F.array_max(fits)["key"].alias("rule"), F.exists("keys", lambda k: listed.holds(k)).alias("is_listed"))
    verdict = F.when(F.col("rule").isNotNull(), F.when(block.holds(F.col("rule")), "block").otherwise("allow")).when(F.col("is_listed"), "block").otherwise("allow")
    return judged.select(F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"))
