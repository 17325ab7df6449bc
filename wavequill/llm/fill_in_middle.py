"""Fill-in-middle transformation: texts cut at two places between units and put in another order behind markers.

An Arrow-batched pandas UDF works on every whole text: the regex library walks through its units once and keeps only their
end offsets, in a compact array of 8 bytes a unit; two lookups in it give the cuts, hashlib gives the seeds and digests.
Nothing is shuffled or gathered, and a row depends on nothing but itself, so lost executors just run their rows again.

Prefix, middle and suffix may be empty. Texts that are empty, hold a marker or aren't drawn by `rate` stay plain, so every
output restores exactly. Null texts count as empty; null identifiers are seeded like an empty one. Repeated rows give
repeated results, equal texts of different identifiers are cut apart. Empty tables give empty results, columns other than
the identifier and the text are ignored (ask for them in `keep`).
"""

from __future__ import annotations

import hashlib
from array import array
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: units that a text may be cut into: lines with their ends, and words with the white space after them
LINES, WORDS = r"[^\n]*\n|[^\n]+", r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*|[\x20\x09-\x0D]+"
PLAIN, PSM, SPM = "plain", "psm", "spm"


@dataclass(frozen=True)
class Cut:
    """How texts are transformed: `rate` of 100 texts, `spm` of 100 of those with the suffix first.

    Units must cover the whole text. A marker begins with a character that no marker holds at another place, and none
    begins another marker; then a marker can't arise where a text and a marker meet.
    """

    seed: int = 7
    unit: str = LINES
    rate: int = 100
    spm: int = 50
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self) -> None:
        marks = self.markers
        if not all(marks) or any(m[0] in o[1:] for m in marks for o in marks) or any(o.startswith(m) for i, m in enumerate(marks) for j, o in enumerate(marks) if i != j):
            raise ValueError(f"markers that texts can't be told from: {marks}")

    @property
    def markers(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


@lru_cache
def _compiled(unit: str) -> regex.Pattern:
    return regex.compile(unit)


def _ends(text: str, unit: str) -> array:
    """The end offset of every unit, in code points."""
    return array("q", (m.end() for m in _compiled(unit).finditer(text)))


def _seeds(seed: int, key: str) -> list[int]:
    """Four numbers of 32 bits that only the seed and the identifier decide."""
    digest = hashlib.sha256(f"{seed}:{key}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12)]


def transformed(key: str, text: str, how: Cut) -> tuple[int, str, int | None, int | None, str]:
    """Units, form, code points of prefix and middle (None where plain) and the output of one text."""
    ends = _ends(text, how.unit)
    h1, h2, h3, h4 = _seeds(how.seed, key)
    if not text or h3 % 100 >= how.rate or any(m in text for m in how.markers):
        return len(ends), PLAIN, None, None, text
    low, high = sorted((h1 % (len(ends) + 1), h2 % (len(ends) + 1)))
    a, b = (ends[k - 1] if k else 0 for k in (low, high))
    prefix, middle, suffix = how.prefix + text[:a], how.middle + text[a:b], how.suffix + text[b:]
    form, output = (SPM, suffix + prefix + middle) if h4 % 100 < how.spm else (PSM, prefix + suffix + middle)
    return len(ends), form, a, b - a, output


def restored(output: str, form: str, how: Cut) -> str:
    """The text that an output of this form was made from."""
    if form == PLAIN:
        return output
    first, second = (how.prefix, how.suffix) if form == PSM else (how.suffix, how.prefix)
    if not output.startswith(first):
        raise ValueError(f"an output of the form {form} begins with {first}")
    one, _, rest = output[len(first) :].partition(second)
    two, _, middle = rest.partition(how.middle)
    return one + middle + two if form == PSM else two + middle + one


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def fill_in_middle(docs: DataFrame, how: Cut = Cut(), keep: tuple[str, ...] = ("doc_id",), key: str = "doc_id", text: str = "text", outputs: bool = True) -> DataFrame:
    """`keep`, n (units), form, prefix_chars, middle_chars, output, output_sha256 and restored_sha256 (of the text that is
    rebuilt from output and form). Without `outputs` the output stays in the task that made it, and only digests leave it."""

    kind = "n long, form string, prefix_chars long, middle_chars long, output string, output_sha256 string, restored_sha256 string"
    names = [part.split()[0] for part in kind.split(", ")]

    @F.pandas_udf(kind)
    def work(keys: pd.Series, texts: pd.Series) -> pd.DataFrame:
        rows = []
        for k, t in zip(keys, texts, strict=True):
            n, form, prefix, middle, output = transformed(k, t, how)
            rows.append((n, form, prefix, middle, output if outputs else None, _sha256(output), _sha256(restored(output, form, how))))
        found = pd.DataFrame(rows, columns=names)
        return found.astype({"n": "int64", "prefix_chars": "Int64", "middle_chars": "Int64", **dict.fromkeys(("form", "output", "output_sha256", "restored_sha256"), object)})

    found = docs.select(*keep, work(_text(key), _text(text)).alias("_found"))
    return found.select(*keep, *[F.col("_found")[c].alias(c) for c in names if outputs or c != "output"])


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def restore(rows: DataFrame, how: Cut = Cut(), output: str = "output", form: str = "form") -> DataFrame:
    """`rows` with the column `restored`, the texts that their outputs were made from; null outputs give null."""

    @F.pandas_udf("string")
    def work(outputs: pd.Series, forms: pd.Series) -> pd.Series:
        return pd.Series([None if o is None else restored(o, f, how) for o, f in zip(outputs, forms, strict=True)], dtype=object)

    return rows.withColumn("restored", work(output, form))
