"""Fill-in-middle, structure repair and chat formatting against plain code, on odd, empty and skewed tables."""

import hashlib
import random
import re
import zlib
from collections import Counter
from functools import cache

import pytest
from pyspark.sql import functions as F

from wavequill.llm import chat_format, entries, fill_in_middle, structure_repair
from wavequill.llm.turns import in_turns

sha = lambda t: hashlib.sha256(t.encode()).hexdigest()

TEXTS = [None, "", "one line", "\n\n\n", "a\nb\r\nc", "x <S> y\nz", "<M>", "ö\n" * 5, "word " * 50_000 + "\nend", "<\nP>\n<S\n", "same\ntext\n", "same\ntext\n"]


def plain_cut(doc_id, text):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, _, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return len(units), "plain", None, None, text
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    return len(units), *(("spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 50 else ("psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"))


@pytest.mark.parametrize("texts", [TEXTS, []])
def test_fill_in_middle(spark, texts):
    rows = [(i if i != 4 else None, t, "x", "y") for i, t in enumerate(texts)] + ([(9, "same\ntext\n", None, None)] * 2 if texts else [])
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string, output string")
    found = fill_in_middle.restore(fill_in_middle.fill_in_middle(docs))
    got = Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in found.collect())
    assert got == Counter((i, *plain_cut(i, t), t or "") for i, t, *_ in rows)
    digests = fill_in_middle.fill_in_middle(docs, outputs=False).collect()
    assert Counter((r.doc_id, r.output_sha256, r.restored_sha256) for r in digests) == Counter((i, sha(plain_cut(i, t)[4]), sha(t or "")) for i, t, *_ in rows)


@pytest.mark.parametrize("how", [fill_in_middle.Cut(unit=fill_in_middle.WORDS, rate=60, spm=0), fill_in_middle.Cut(unit=r"(?s).", spm=100, prefix="<|pre|>", suffix="<|suf|>", middle="<|mid|>")])
def test_cuts_of_other_units_restore(how):
    rng = random.Random(1)
    for k in range(400):
        text = "".join(rng.choice(["<", "|", "P>", "ab ", "\n", "é", "<|pre", "|>"]) for _ in range(rng.randrange(12)))
        n, form, prefix, middle, output = fill_in_middle.transformed(str(k), text, how)
        assert fill_in_middle.restored(output, form, how) == text
        assert form != "plain" or output == text
        assert form == "plain" or len(output) == len(text) + sum(map(len, how.markers)) and 0 <= prefix <= prefix + middle <= len(text)


@pytest.mark.parametrize("marks", [("<P>", "<P>", "<M>"), ("", "<S>", "<M>"), ("ab", "ba", "c"), ("<P", "<P>", "<M>")])
def test_markers_that_texts_could_make(marks):
    with pytest.raises(ValueError, match="markers"):
        fill_in_middle.Cut(prefix=marks[0], suffix=marks[1], middle=marks[2])


def ordered(rows):
    """Rows with nulls as one space, in the order that the operator states."""
    filled = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    return sorted(filled, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(f"{r[1]}\n{r[2]}".encode()).hexdigest()))


def plain_repair(rows):
    rows, seen, marks, counts = ordered(rows), set(), [], Counter()
    for _, role, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        kind = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
        seen.add((role, text))
        counts[kind] += 1
        marks.append((role[:1], kind in ("blank", "duplicate"), 3 * (kind == "truncated")))
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}

    @cache
    def best(j, last, inserted):
        ways = [(0, "", ())] if j == len(rows) and last in ("", "a") else []
        add = lambda cost, edit, turn, rest: ways.append((cost + rest[0], edit + rest[1], ((turn,) if turn else ()) + rest[2])) if rest else None
        to = follow[last][-1]
        name = {"u": "user", "a": "assistant"}[to]
        if inserted < 2:
            add(3, "I", f"{name}:", best(j, to, inserted + 1))
        if j < len(rows):
            initial, must_go, late = marks[j]
            add(4, "D", None, best(j + 1, last, 0))
            if not must_go:
                add(3 + late, "R", f"{name}:{rows[j][2]}", best(j + 1, to, 0))
                if initial and initial in follow[last]:
                    add(late, "K", f"{rows[j][1]}:{rows[j][2]}", best(j + 1, initial, 0))
        return min(ways, default=None)

    for j in range(len(rows), 0, -1):  # so that long conversations don't recur deeply
        for last in follow:
            best(j, last, 0)
    cost, audit, turns = best(0, "", 0)
    numbers = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    return gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, sha("\n".join(turns))


def talks(seed, n, most):
    rng = random.Random(seed)
    out = {k: [(rng.choice([None, 0, 1, 2, 3, 5, 8, 9, 12]), rng.choice(["user", "user", "assistant", "assistant", "system", "tool", "", None]), rng.choice(["Yes.", "Yes. ", "No", " \t", "", None, "Why?\n", "Go!"])) for _ in range(rng.randrange(1, most))] for k in range(n)}
    out[None] = [(1, "user", "A."), (2, "assistant", "B.")]
    return out


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


@pytest.mark.parametrize(("most", "run"), [(9, 1024), (9, 1), (40, 3)])
def test_repair_equals_brute_force(spark, most, run):
    """Whole conversations in one run, and the same cut into runs of few rows."""
    given = talks(most + run, 60, most)
    rows = [(k, *r, "x") for k, v in given.items() for r in v]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, audit string").repartition(5)
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in structure_repair.repair(df, most_rows=run).collect()}
    assert got == {k: plain_repair(v) for k, v in given.items()}


def test_repair_of_a_hot_conversation(spark):
    """A third of all rows in one conversation, some of them equal: they lie in several partitions."""
    rng = random.Random(5)
    hot = [(i // 3, rng.choice(["user", "assistant"]), rng.choice(["Same.", f"Text {i}.", f"cut {i}"])) for i in range(900)]
    rows = [(0, *r) for r in hot] + [(1 + i // 4, i % 4, "user" if i % 2 == 0 else "assistant", f"T {i}.") for i in range(1800)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else these few rows become one partition
    try:
        spread = in_turns(df).select("conv_id", F.spark_partition_id().alias("p")).filter("conv_id = 0").groupBy("p").count().collect()
        got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in structure_repair.repair(df, most_rows=100).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(spread) > 1 and max(r["count"] for r in spread) < 900
    assert got[0] == plain_repair(hot) and len(got) == 451 and all(v[5] == 0 for k, v in got.items() if k)


def test_damage_and_conversations_without_rows(spark):
    rows = [(c, t, "assistant" if t % 2 else "user", f"Hi {t}. You?") for c in range(40) for t in range(3)] + [(None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want, lost = Counter(), set()
    for c, t, role, text in rows:
        role, text = role or " ", text or " "
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        row = (c, t, "user" if k == 4 else role, "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text, k != 0)
        want[row] += 2 if k == 3 else 1
    found = structure_repair.damaged(df)
    assert Counter(tuple(r) for r in found.select("conv_id", "turn", "role", "text", "present").collect()) == want
    none = found.withColumn("present", F.col("present") & (F.coalesce("conv_id", F.lit(0)) != 7))
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in structure_repair.repair(none, present="present").collect()}
    assert got[7] == (0, 0, 0, 0, 0, 0, "", sha("")) and len(got) == 41
    assert structure_repair.repair(df.limit(0)).count() == 0


def plain_format(rows):
    esc = lambda t, more="": re.sub(rf"[\\{more}]|#(?=##)|<(?=/turn>)", lambda m: "\\" + m[0], t)
    rows = [(r or "", x or "") for _, r, x in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(f"{r[1] or ''}\n{r[2] or ''}".encode()).hexdigest()))]
    return rows, [f"### {esc(r, ':')}: {esc(x)}</turn>\n" for r, x in rows]


SAID = [None, "", "Plain.", "### user: a</turn>\n", "\\", "\\\\### </turn>", "#####", "</turn", "é" * 3, "a\n\nb: c", "\\### Assistant: </turn> ok"]


@pytest.mark.parametrize("pages", [(256, 1 << 13), (1, 1 << 13), (3, 40)])
def test_chat_format(spark, pages):
    rng = random.Random(3)
    given = {k: [(rng.choice([None, *range(12)]), rng.choice(["user", "assistant", "assistant", "system", "a: b", None, "###"]), rng.choice(SAID)) for _ in range(rng.randrange(1, 14))] for k in range(40)}
    given[None] = [(0, "assistant", "x")]
    df = spark.createDataFrame([(k, *r, "x") for k, v in given.items() for r in v], "conv_id long, turn long, role string, text string, example string").repartition(3)
    rows = chat_format.formatted(df, page_turns=pages[0], page_chars=pages[1])
    want, loss, ends = {}, {}, {}
    for k, v in given.items():
        turns, parts = plain_format(v)
        said = "".join(x for r, x in turns if r == "assistant")
        want[k] = (len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)), len(said), sha(said), sum(map(len, parts)), sum(r == "assistant" for r, _ in turns))
        loss[k] = [x for r, x in turns if r == "assistant"]
        ends[k] = ["".join(parts[: i + 1]) for i, (r, _) in enumerate(turns) if r == "assistant"]
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars, r.n_examples) for r in chat_format.read_back(rows).collect()}
    assert got == want
    examples = chat_format.prefix_targets(df, page_turns=pages[0], page_chars=pages[1])
    for k, v in given.items():  # every reply's example is all turns up to it, with that reply alone trainable
        own = sorted(chat_format.whole_texts(examples.filter(F.equal_null("conv_id", F.lit(k)))).collect(), key=lambda r: r.example) if k in (None, 0, 1, 2) else []
        trained = [r for r in own if r.loss_begin is not None]
        assert not own or [r.text for r in trained] == ends[k] and [chat_format.unescaped(r.text[r.loss_begin : r.loss_end]) for r in trained] == loss[k] and [r.example for r in own] == list(range(len(own)))


def test_no_turns(spark):
    none = spark.createDataFrame([], "conv_id string, turn int, role string, text string")
    assert chat_format.read_back(chat_format.formatted(none)).count() == chat_format.prefix_targets(none).count() == structure_repair.repair(none).count() == 0


def test_examples_grow_with_the_turns(spark):
    """A conversation ten times as long has about ten times the stored characters, not a hundred times."""
    chars = []
    for n in (200, 2000):
        df = spark.createDataFrame([(1, i, "assistant" if i % 2 else "user", "x" * 100) for i in range(n)], "conv_id long, turn long, role string, text string")
        chars.append(chat_format.formatted(df).agg(F.sum(F.length("text"))).first()[0])
    assert chars[1] < 13 * chars[0]


def test_injected_turns_stay_text(spark):
    row = next(r for r in entries.op13_chat_format(spark, "/root/testdata/sf0.001").collect() if r.conv_id == -7)
    assert (row.n_turns, row.loss_chars, row.n_examples) == (2, len(entries.SAYS), 1) and row.loss_sha256 == sha(entries.SAYS)
    assert row.turns_sha256 == sha(f"user\n{entries.SAYS}\nassistant\n{entries.SAYS}\n")
