"""Language identification with interpolated Kneser-Ney character language models.

One model per language, of order 4 over lower-cased letters (and the marks on them) of any script, with one space
between words. A language's n-grams and contexts of all orders lie in sorted arrays of 64-bit hashes of their code
points, beside their discounted probabilities and back-off weights. A text gets the language of the lowest
cross-entropy per character. Its score is the posterior of the languages at a tempered likelihood; a text is rejected
if its cross-entropy lies above a bound for texts of its length, calibrated on labelled rows that the models weren't
fitted on, or if it has no letter.

Training reads a bounded sample of the labelled rows (`per_lang` documents a language, drawn by a seeded hash of the
identifier and the text), of which every fifth calibrates. Of a language of fewer than FEW documents all are fitted, and
its bound comes from two halves, each scored by a model of the other; a language that has no bound of its own shares the
highest of the others'. Every whole text is then predicted. Null texts and texts without letters
are `und` with score 0. With no labelled row at all, everything is `und`. Ties go to the language first in code-point
order. Rows repeat as in the input. Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDER = 4
UND = "und"
LETTER, MARK = 1, 2
#: lengths in characters from which a bound of its own holds
LENGTHS = (1, 16, 64, 256, 1024)
#: documents of a language from which a part is left out of the fit
FEW = 50
#: the parts of the sample: two halves of languages of few documents; of others those that are fitted and those that calibrate
HALF, OTHER_HALF, FITTED, CALIBRATES = range(4)
#: odd numbers that tell the places of an n-gram's symbols apart
STEPS = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))
#: bytes of the scores that a worker remembers
MEMORY = 32 << 20
#: symbols that are scored or counted at once
PART = 1 << 17


def _mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashes(grams: np.ndarray) -> np.ndarray:
    """The hash of each row of code points, which is made from the last to the first."""
    h = np.zeros(len(grams), np.uint64)
    for n in range(1, grams.shape[1] + 1):
        h = _mix(h + (grams[:, -n].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n << 40))
    return h


@functools.cache
def _kinds() -> np.ndarray:
    """Of every code point: LETTER, MARK or 0."""
    kind = {"L": LETTER, "M": MARK}
    return np.fromiter((kind.get(unicodedata.category(chr(i))[0], 0) for i in range(0x110000)), np.uint8, 0x110000)


def symbols(text: str) -> np.ndarray:
    """The code points of a text: three spaces, the words with a space between them, a space; none without a letter."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _kinds()[c]
    if not (kind == LETTER).any():
        return np.zeros(0, np.uint32)
    inside = kind > 0
    keep = inside | np.append(False, inside[:-1])  # one break after each word
    c = np.where(inside, c, np.uint32(32))[keep]
    return np.concatenate([np.full(ORDER - 1, 32, np.uint32), c, np.full(int(c[-1] != 32), 32, np.uint32)])


def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], missing)


@dataclass
class KneserNey:
    """One language's model; `size` symbols share what the unigrams leave over."""

    size: int
    keys: np.ndarray
    probability: np.ndarray
    contexts: np.ndarray
    backoff: np.ndarray

    @staticmethod
    def fit(grams: np.ndarray, counts: np.ndarray, size: int) -> KneserNey:
        """grams: distinct n-grams of ORDER code points, a row each; counts: how often they occur."""
        keys, probability, contexts, backoff = [], [], [], []
        for n in range(ORDER, 0, -1):
            key, ctx = hashes(grams), hashes(grams[:, :-1])
            ones, twos = int((counts == 1).sum()), int((counts == 2).sum())
            discount = min(0.9, max(0.1, ones / max(1, ones + 2 * twos)))
            names, inverse = np.unique(ctx, return_inverse=True)
            total = np.bincount(inverse, weights=counts)
            keys.append(key)
            probability.append((counts - discount) / total[inverse])
            contexts.append(names + np.uint64(n))
            backoff.append(discount * np.bincount(inverse) / total)
            if n > 1:  # continuation counts: in how many ways the shorter n-grams are preceded
                _, first, counts = np.unique(hashes(grams[:, 1:]), return_index=True, return_counts=True)
                grams = grams[first, 1:]
        k, c = np.concatenate(keys), np.concatenate(contexts)
        i, j = np.argsort(k), np.argsort(c)
        return KneserNey(size, k[i], np.concatenate(probability)[i], c[j], np.concatenate(backoff)[j])

    def log_p(self, grams: list[np.ndarray], contexts: list[np.ndarray]) -> np.ndarray:
        """Log-probabilities of symbols, from the hashes of the n-grams that end with them and of those n-grams' contexts,
        for n from 1 to ORDER."""
        p = np.full(len(grams[0]), 1 / self.size)
        for n in range(1, ORDER + 1):
            weight = _find(self.contexts, self.backoff, contexts[n - 1] + np.uint64(n), 1.0)
            p = _find(self.keys, self.probability, grams[n - 1], 0.0) + weight * p
        return np.log(p)


@dataclass
class LanguageModels:
    langs: list[str]
    models: list[KneserNey]
    bounds: dict[str, list[float]] = field(default_factory=dict)  # cross-entropy above which a text is rejected, per length
    temper: float = 0.25

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def _scores(self, flat: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Log-probabilities under every language of the symbols at `ends`; those of frequent n-grams are remembered in a
        table of fixed size."""
        if "_known" not in self.__dict__:
            slots = 1 << int(np.log2(MEMORY / (8 + 4 * len(self.langs))))
            self._known, self._rows = np.zeros(slots, np.uint64), np.zeros((slots, len(self.langs)), np.float32)
        c = flat.astype(np.uint64)
        key = _mix(sum((c[ends - k] * step for k, step in enumerate(STEPS)), np.uint64(1)))
        slot = (key & np.uint64(len(self._known) - 1)).astype(np.int64)
        missed = np.flatnonzero(self._known[slot] != key)
        out = self._rows[slot]
        if len(missed):
            new, first, back = np.unique(key[missed], return_index=True, return_inverse=True)
            grams = flat[ends[missed[first]][:, None] + np.arange(1 - ORDER, 1)]
            own, contexts = ([hashes(grams[:, -n : ORDER - cut]) for n in range(1, ORDER + 1)] for cut in (0, 1))
            found = np.column_stack([m.log_p(own, contexts) for m in self.models])
            out[missed] = found[back]
            place = (new & np.uint64(len(self._known) - 1)).astype(np.int64)
            place, last = np.unique(place, return_index=True)
            self._known[place], self._rows[place] = new[last], found[last]
        return out

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy in nats a character of every text under every language, NaN for texts without letters; and the
        numbers of characters."""
        out, size = np.full((len(texts), len(self.langs)), np.nan), np.zeros(len(texts), np.int64)
        part: list[tuple[int, np.ndarray]] = []

        def flush() -> None:
            if part:
                n = np.array([len(s) - ORDER + 1 for _, s in part])
                flat = np.concatenate([s for _, s in part])
                inside = np.ones(len(flat), bool)
                begin = np.cumsum(n + ORDER - 1) - (n + ORDER - 1)
                inside[(begin[:, None] + np.arange(ORDER - 1)).ravel()] = False
                sums = np.add.reduceat(self._scores(flat, np.flatnonzero(inside)).astype(np.float64), np.cumsum(n) - n, axis=0)
                which = [i for i, _ in part]
                out[which], size[which] = -sums / n[:, None], n
                part.clear()

        held = 0
        for i, t in enumerate(texts):
            if t and len(s := symbols(t)):
                part.append((i, s))
                held += len(s)
                if held > PART:
                    flush()
                    held = 0
        flush()
        return out, size


def train(docs: DataFrame, per_lang: int = 2000, seed: int = 42, quantile: float = 0.999, slack: float = 0.25, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModels | None:
    """Models of the languages in `docs`, from about `per_lang` documents of each; None if there are none.

    A fifth of the sample is left out of the fit and calibrates (of few documents, halves do): a text is rejected if its
    cross-entropy lies `slack` nats above the `quantile` of those of its language and length, or more than that for short
    texts.
    """
    learn = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter("text is not null and lang is not null")
    sizes = {r["lang"]: r["count"] for r in learn.groupBy("lang").count().collect()}  # a row a language
    if not sizes:
        return None
    rate = F.coalesce(*[F.when(F.col("lang") == k, F.lit(min(1.0, per_lang / n))) for k, n in sizes.items()])
    drawn = F.pmod(F.xxhash64(F.lit(seed), "id", "text"), F.lit(1 << 30))
    other = F.xxhash64(F.lit(seed + 1), "id", "text")
    few = sorted(k for k, n in sizes.items() if n < FEW)
    part = F.when(F.col("lang").isin(few), F.pmod(other, F.lit(2)) + HALF).when(F.pmod(other, F.lit(5)) == 0, CALIBRATES).otherwise(FITTED)
    sample = learn.filter(drawn < rate * (1 << 30)).select("lang", "text", part.cast("int").alias("part"))

    def grams_of(lang: str, part: int, parts: list[np.ndarray]) -> pa.RecordBatch:
        grams = np.concatenate([np.lib.stride_tricks.sliding_window_view(s, ORDER) for s in parts if len(s)] or [np.zeros((0, ORDER), np.uint32)])
        _, first, n = np.unique(hashes(grams), return_index=True, return_counts=True)
        text = grams[first].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array([part] * len(n), pa.int32()), pa.array([text[k : k + ORDER] for k in range(0, len(text), ORDER)], pa.string()), pa.array(n, pa.int64())], names=["lang", "part", "gram", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own: dict[tuple[str, int], list[np.ndarray]] = {}
            held: dict[tuple[str, int], int] = {}
            for lang, text, part in zip(*(batch.column(k).to_pylist() for k in ("lang", "text", "part")), strict=True):
                own.setdefault((lang, part), []).append(symbols(text))
                held[lang, part] = held.get((lang, part), 0) + len(own[lang, part][-1])
                if held[lang, part] > PART:
                    yield grams_of(lang, part, own.pop((lang, part)))
                    held[lang, part] = 0
            for (lang, part), parts in own.items():
                yield grams_of(lang, part, parts)

    counted = sample.mapInArrow(count, "lang string, part int, gram string, n long").groupBy("lang", "part", "gram").agg(F.sum("n").alias("n")).toPandas()  # bounded by the sample
    if counted.empty:
        return None
    size = len(np.unique(np.frombuffer("".join(counted["gram"]).encode("utf-32-le", "surrogatepass"), np.uint32))) + 1  # and one for all others

    def fit(own: pd.DataFrame) -> KneserNey:
        own = own.groupby("gram", as_index=False)["n"].sum().sort_values("gram")
        grams = np.frombuffer("".join(own["gram"]).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, ORDER)
        return KneserNey.fit(grams, own["n"].to_numpy(), size)

    found, halves = LanguageModels([], []), {HALF: {}, OTHER_HALF: {}}
    for lang, own in sorted(counted.groupby("lang"), key=lambda x: x[0].encode()):
        fitted = own[own["part"] != CALIBRATES]
        found.langs.append(lang)
        found.models.append(fit(fitted if len(fitted) else own))
        for half, models in halves.items():
            if (own["part"] == half).any() and (own["part"] == HALF + OTHER_HALF - half).any():
                models[lang] = fit(own[own["part"] == half])
    known = _scored(sample.filter(F.col("part") == CALIBRATES), found, ["lang"])
    for half, models in halves.items():
        if models:  # each half is scored beside all other languages by what the other half gives
            apart = LanguageModels(found.langs, [models.get(k, m) for k, m in zip(found.langs, found.models, strict=True)])
            rest = sample.filter((F.col("part") == HALF + OTHER_HALF - half) & F.col("lang").isin(sorted(models)))
            known = known.unionByName(_scored(rest, apart, ["lang"]))
    known = known.filter("lang = best").withColumn("bin", length_bin(F.col("n")))
    rows = known.groupBy("lang", "bin").agg(F.percentile("entropy", quantile).alias("q")).collect()  # a few a language
    for lang in found.langs:
        own = {r["bin"]: r["q"] for r in rows if r["lang"] == lang}
        if own:  # shorter texts vary more: their bound is none lower than that of longer ones
            most = [max(q for b, q in own.items() if b >= min(i, max(own))) for i in range(len(LENGTHS))]
            found.bounds[lang] = [q + slack * (1 + 8 / n**0.5) for q, n in zip(most, LENGTHS, strict=True)]
    if found.bounds:
        highest = [max(x) for x in zip(*found.bounds.values(), strict=True)]
        found.bounds = {k: found.bounds.get(k, highest) for k in found.langs}
    return found


def length_bin(n: Column) -> Column:
    """Which of LENGTHS a text of n characters reaches."""
    return sum(((n >= k).cast("int") for k in LENGTHS[1:]), F.lit(0))


def _scored(docs: DataFrame, models: LanguageModels, keep: list[str], inside: str | None = None) -> DataFrame:
    """`keep` and best, entropy, n (characters), score for the column text, or for that field (`inside`) of the column row."""
    shared = docs.sparkSession.sparkContext.broadcast(models)  # bounded by the training sample

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = np.array([*m.langs, UND], object)
        for batch in batches:
            texts = batch.column("row").field(inside) if inside else batch.column("text")
            h, n = m.entropies(texts.to_pylist())
            bad = n == 0
            h[bad] = 0.0
            best = np.argmin(h, axis=1)
            entropy = h[np.arange(len(h)), best]
            score = np.where(bad, 0.0, 1 / np.exp(-n[:, None] * m.temper * (h - entropy[:, None])).sum(axis=1))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), pa.array(names[np.where(bad, len(m.langs), best)], pa.string()), pa.array(entropy, pa.float64(), mask=bad), pa.array(n, pa.int64()), pa.array(score, pa.float64())], names=[*keep, "best", "entropy", "n", "score"])

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    return docs.select(*keep, *([] if inside else ["text"])).mapInArrow(predict, ", ".join(f"`{k}` {kinds[k]}" for k in keep) + ", best string, entropy double, n long, score double")


def identify(docs: DataFrame, models: LanguageModels | None, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """id, lang_pred, score, rejected for every row; with `carry` also `row`, the whole input row."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *([F.struct(*docs.columns).alias("row")] if carry else []))
    keep = ["id", *(["row"] if carry else [])]
    if models is None:
        out = rows.select(*keep, F.lit(UND).alias("best"), F.lit(None).cast("double").alias("entropy"), F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("score"))
    else:
        out = _scored(rows, models, keep, text_col if carry and dict(docs.dtypes).get(text_col) == "string" else None)
    limits = F.lit(float("inf"))
    if models and models.bounds:
        per_length = F.coalesce(*[F.when(F.col("best") == k, F.array(*map(F.lit, v))) for k, v in models.bounds.items()])
        limits = F.coalesce(F.element_at(per_length, length_bin(F.col("n")) + 1), limits)
    rejected = (F.col("best") == UND) | (F.col("entropy") > limits)
    return out.select(F.col("id").alias(id_col), F.col("best").alias("lang_pred"), "score", F.coalesce(rejected, F.lit(True)).alias("rejected"), *(["row"] if carry else []))
