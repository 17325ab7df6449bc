"""Scalar functions on levels, labels and replies. All are column expressions and stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def db_to_linear(db: Column) -> Column:
    return F.pow(F.lit(10.0), db / 20)


def linear_to_db(x: Column) -> Column:
    """With a small addend, so that 0 gives -200 dB."""
    return 20 * F.log10(x + 1e-10)


def gain_to_db(gain: Column) -> Column:
    """With gains below 1e-6 raised to it."""
    return 20 * F.log10(F.greatest(gain, F.lit(1e-6)))


def level_to_db(x: Column) -> Column:
    """With a floor of -100 dB for anything below 1e-10."""
    return F.when(x < 1e-10, F.lit(-100.0)).otherwise(20 * F.log10(x))


def smoothing(ms: Column | float, rate: int = 48_000) -> Column:
    """The one-pole coefficient of a time constant; 0 (no smoothing) for 0 ms and less."""
    samples = F.lit(rate) * (F.lit(ms) if not isinstance(ms, Column) else ms) / 1000
    return F.when(samples > 0, F.exp(F.lit(-1.0) / samples)).when(samples.isNotNull(), F.lit(0.0))


def gain_reduction(before: Column, after: Column) -> Column:
    """after / before within [0, 1]; 1 where there was no signal."""
    return F.when(before > 1e-10, F.least(F.greatest(after / (before + 1e-10), F.lit(0.0)), F.lit(1.0))).otherwise(F.lit(1.0))


def quantize16(x: Column, gain: Column | float = 1.0) -> Column:
    """16-bit samples, rounded half to even and clipped."""
    g = gain if isinstance(gain, Column) else F.lit(float(gain))
    return F.least(F.greatest(F.rint(x * g * 32768), F.lit(-32768.0)), F.lit(32767.0)).cast("int")


def mono_level(left: Column, right: Column) -> Column:
    return (F.abs(left) + F.abs(right)) / 2


def voice_activity(gain: Column, threshold: float = 0.7) -> Column:
    """1 where a gain is ducked below the threshold."""
    return (gain < threshold).cast("float")


def presence(share: Column) -> Column:
    return F.when(share >= 0.9, "always").when(share >= 0.5, "likely").when(share > 0, "rare").otherwise("never")


def not_null_text(text: Column) -> Column:
    """Null for the word null in any case."""
    return F.when(F.lower(text) != "null", text)


def style_of(path: Column) -> Column:
    """The folder that holds the file, for paths of more than two parts."""
    parts = F.split(path, "/")
    return F.when(F.size(parts) > 2, F.element_at(parts, -2)).otherwise("default")


def scene_name(prefix: Column, emotion: Column, key: Column) -> Column:
    """Reproducible, unlike a random identifier."""
    return F.concat_ws("_", prefix, emotion, F.substring(F.md5(key.cast("string").cast("binary")), 1, 8))


def token_total(total: Column, prompt: Column, reply: Column) -> Column:
    return F.coalesce(total, prompt + reply)


def agents_total(first: Column, second: Column) -> Column:
    """Null only if both are."""
    return F.when(first.isNotNull() | second.isNotNull(), F.coalesce(first, F.lit(0)) + F.coalesce(second, F.lit(0)))


def trimmed(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def json_of_reply(text: Column) -> Column:
    """The JSON in a reply: of a fenced one the lines after the opening fence, without the closing one; what then begins
    with a brace or a bracket stays as it is, else the part from the first to the last brace, if there is one. Null
    counts as empty."""
    whole = trimmed(F.coalesce(text, F.lit("")))
    inside = F.regexp_replace(F.regexp_extract(whole, r"(?s)^[^\n]*\n(.*)$", 1), r"\s*```\s*$", "")
    bare = trimmed(F.when(whole.startswith("```"), inside).otherwise(whole))
    braced = F.regexp_extract(bare, r"(?s)(\{.*\})", 1)
    return F.when(bare.startswith("{") | bare.startswith("[") | (braced == ""), bare).otherwise(braced)


def is_json_object(text: Column) -> Column:
    """Whether a text is a JSON object; false for other JSON, for what is no JSON and for null."""
    alone = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))  # which no text after the object survives
    return F.coalesce(F.schema_of_variant(alone).startswith("ARRAY<OBJECT") & F.try_variant_get(alone, "$[1]", "variant").isNull(), F.lit(False))


def unit_hash(key: Column, salt: str = "") -> Column:
    """A reproducible number in [0, 1) in steps of 1/1000000."""
    digits = F.substring(F.md5(F.concat(F.lit(salt), key.cast("string")).cast("binary")), 1, 8)
    return F.pmod(F.conv(digits, 16, 10).cast("long"), F.lit(1_000_000)) / 1_000_000


def split_of(key: Column) -> Column:
    """train, val or test in shares of 80, 10 and 10 percent."""
    u = unit_hash(key)
    return F.when(u < 0.8, "train").when(u < 0.9, "val").otherwise("test")
