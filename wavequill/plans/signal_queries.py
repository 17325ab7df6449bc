"""Queries of block signals, each with independent DuckDB SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from wavequill.functions import scalars as S
from wavequill.operators import levels, signals
from wavequill.plans.queries import _E, _HASH, _events, query
from wavequill.storage import kept

#: samples of a block of the signals below
BLOCK = 16
_P = f"{_E}, p AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY s, event_id) - 1 AS pos, x FROM e), n AS (SELECT user_id, count(*) AS n FROM p GROUP BY user_id)"
_FADE = lambda top, fade: f"CASE WHEN pos >= {top - fade} THEN 1 - (pos - {top - fade}) / {max(fade - 1, 1)}.0::DOUBLE ELSE 1 END"


def _samples(t):
    """Every user's events as one signal: pos counts them."""
    w = Window.partitionBy("user_id").orderBy("s", "event_id")
    return _events(t).select("user_id", (F.row_number().over(w) - 1).cast("long").alias("pos"), "x")


def _blocks(rows, left="x", right=None, keys=("user_id",)):
    right = F.col(left) * -0.5 if right is None else right
    each = rows.withColumn("start", F.floor(F.col("pos") / BLOCK) * BLOCK).groupBy(*keys, "start").agg(F.array_sort(F.collect_list(F.struct("pos", F.col(left).alias("l"), right.alias("r")))).alias("v"))
    return each.select(*keys, F.col("start").cast("long").alias("start"), F.transform("v", lambda z: z["l"]).alias("left"), F.transform("v", lambda z: z["r"]).alias("right"))


def _long(blocks, keys=("user_id",), value="left", digits=6):
    return blocks.select(*keys, "start", F.posexplode(value).alias("i", "v")).select(*keys, (F.col("start") + F.col("i")).alias("pos"), F.round("v", digits).alias("x"))


@query(f"WITH {_P}, w AS (SELECT user_id, unnest(range(0, 60 + user_id % 20)) AS pos FROM (SELECT user_id FROM n UNION SELECT -1)) SELECT user_id, pos, round(coalesce(x, 0), 6) AS x FROM w LEFT JOIN p USING (user_id, pos)")
def p10_to_length(t):
    b = _blocks(_samples(t))
    users = b.select("user_id").distinct()
    scenes = users.unionByName(users.limit(1).select(F.lit(-1).cast("long").alias("user_id"))).withColumn("n", 60 + F.col("user_id") % 20)
    return _long(signals.to_length(scenes, b, ["user_id"], "n", BLOCK))


@query(f"WITH {_P} SELECT user_id, pos, round(CASE WHEN n > 60 THEN x * {_FADE(60, 8)} ELSE x END, 6) AS x FROM p JOIN n USING (user_id) WHERE pos < 60 OR n <= 60")
def p11_trimmed(t):
    return _long(signals.trimmed(kept(_blocks(_samples(t))), ["user_id"], 0.375, 160))


@query(f"""WITH {_P}, w AS (SELECT user_id, n, unnest(range(0, 68)) AS pos FROM n) SELECT w.user_id, w.pos, round(p.x * CASE WHEN n = 68 THEN 1 ELSE {_FADE(68, 15).replace("pos", "w.pos")} END, 6) AS x FROM w JOIN p ON p.user_id = w.user_id AND p.pos = w.pos % n""")
def p12_fitted(t):
    return _long(signals.fitted(_blocks(_samples(t)), ["user_id"], 68 / 30 + 1e-9, 30))


@query(f"WITH {_P} SELECT user_id, pos - 10 AS pos, round((x + x * -0.5) / 2, 6) AS x FROM p WHERE pos >= 10 AND pos < 45")
def s13_sliced_mono(t):
    part = signals.sliced(_blocks(_samples(t)), F.lit(10).cast("long"), F.lit(45).cast("long"))
    return _long(part.select("user_id", "start", signals.mono(F.col("left"), F.col("right")).alias("left")))


_DUCK = lambda name, src, thr, red, att, rel: (
    f"{name} AS (SELECT user_id, CAST(-1 AS BIGINT) AS pos, 1.0::DOUBLE AS g FROM n UNION ALL SELECT z.user_id, z.pos, CASE WHEN (abs(z.x) + abs(z.x * -0.5)) / 2 > pow(10, {thr} / 20.0) THEN exp(-1000 / ({att} * 100.0)) * g + (1 - exp(-1000 / ({att} * 100.0))) * pow(10, {red} / 20.0)"
    f" ELSE exp(-1000 / ({rel} * 100.0)) * g + 1 - exp(-1000 / ({rel} * 100.0)) END FROM {name} d JOIN {src} z ON z.user_id = d.user_id AND z.pos = d.pos + 1)"
)
_STEMS = "speech AS (SELECT user_id, pos, CASE WHEN pos % 7 < 4 THEN x * 0.3 ELSE x * 0.01 END AS x FROM p), music AS (SELECT user_id, pos, 1 - x AS x FROM p WHERE pos < 55)"


def _stems(t):
    p = _samples(t)
    speech = p.withColumn("x", F.when(F.col("pos") % 7 < 4, F.col("x") * 0.3).otherwise(F.col("x") * 0.01))
    return _blocks(speech), _blocks(p.filter("pos < 55").withColumn("x", 1 - F.col("x")))


@query(f"WITH RECURSIVE {_P}, {_STEMS}, {_DUCK('d', 'speech', -20, -12, 20, 225)} SELECT user_id, pos, round(m.x * g, 6) AS x FROM music m JOIN d USING (user_id, pos)")
def w2_ducked(t):
    speech, music = _stems(t)
    return _long(signals.ducked(music, speech, ["user_id"], 100))


@query(f"""WITH RECURSIVE {_P}, {_STEMS}, {_DUCK('d', 'speech', -20, -12, 20, 225)}, {_DUCK('f', 'speech', -25, -8, 10, 150)}
 SELECT s.user_id, s.pos, round(s.x + coalesce(m.x * CASE WHEN s.user_id % 3 = 0 THEN 1 ELSE d.g END, 0) + coalesce(m.x * 0.5 * f.g, 0) + 0.125, 6) AS x FROM speech s LEFT JOIN music m USING (user_id, pos) JOIN d USING (user_id, pos) JOIN f USING (user_id, pos)""")
def f8_mix_bus(t):
    speech, music = _stems(t)
    name = lambda b, s: b.withColumn("stem", F.lit(s))
    flat = lambda b, f: b.select("user_id", "start", *[F.transform(s, f).alias(s) for s in signals.SIDES])
    stems = name(speech, "speech").unionByName(name(music, "music")).unionByName(name(flat(music, lambda v: v * 0.5), "sfx")).unionByName(name(flat(speech, lambda v: F.lit(0.125)), "ambience"))
    ducks = speech.select("user_id").distinct().select("user_id", (F.col("user_id") % 3 != 0).alias("duck_music"), F.lit(None).cast("boolean").alias("duck_sfx"))
    return _long(signals.mix_bus(stems, ["user_id"], 100, ducks))


@query(f"""WITH {_E}, s AS (SELECT user_id, count(*) AS n FROM e GROUP BY user_id, event_type UNION ALL SELECT user_id, s // 86400 + 5 FROM e WHERE event_type = 'view') SELECT user_id, CAST(max(n) AS BIGINT) AS n FROM s GROUP BY user_id""")
def w8_timeline_length(t):
    e = _events(t)
    stems = e.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n")).select("user_id", "n")
    events = e.filter("event_type = 'view'").select("user_id", F.floor(F.col("s") / 86400).alias("start"), F.lit(5).alias("n"))
    return signals.timeline_length(stems, events, ["user_id"]).withColumn("n", F.col("n").cast("long"))


_KEYFRAMES = """k AS (SELECT user_id, CASE event_type WHEN 'purchase' THEN 'music' ELSE 'sfx' END AS stem, s / 86400.0 AS time, max(x) AS gain FROM e WHERE (event_type = 'purchase' AND user_id % 3 <> 0) OR (event_type = 'click' AND user_id % 5 <> 0) GROUP BY ALL),
 b AS (SELECT user_id, min(stem) AS stem FROM k GROUP BY 1), q AS (SELECT k.user_id, k.time, k.gain FROM k JOIN b USING (user_id, stem))"""


@query(f"""WITH {_E}, {_KEYFRAMES}, c AS (SELECT user_id, unnest(range(0, 221, 20)) AS "offset", 30.0 - user_id % 4 AS d FROM (SELECT DISTINCT user_id FROM e)), f AS (SELECT user_id, "offset", d, unnest(range(0, 20)) AS frame FROM c),
 a AS (SELECT *, ("offset" // 2 + frame) * 2 / 8.0 AS time, "offset" // 2 + 20 <= floor(d * 8 / 2) AS inside FROM f),
 m AS (SELECT a.*, (SELECT max(q.time) FROM q WHERE q.user_id = a.user_id AND q.time <= a.time) AS lo, (SELECT min(q.time) FROM q WHERE q.user_id = a.user_id AND q.time >= a.time) AS hi FROM a)
 SELECT m.user_id, "offset", frame, round(CASE WHEN NOT inside THEN 1.0 ELSE coalesce(CASE WHEN hi = lo THEN x.gain ELSE x.gain + (y.gain - x.gain) * (m.time - lo) / (hi - lo) END, x.gain, y.gain, 1.0) END, 6) AS gain FROM m LEFT JOIN q x ON x.user_id = m.user_id AND x.time = lo LEFT JOIN q y ON y.user_id = m.user_id AND y.time = hi""")
def w6_envelope_chunks(t):
    e = _events(t)
    used = ((F.col("event_type") == "purchase") & (F.col("user_id") % 3 != 0)) | ((F.col("event_type") == "click") & (F.col("user_id") % 5 != 0))
    points = e.filter(used).groupBy("user_id", F.when(F.col("event_type") == "purchase", "music").otherwise("sfx").alias("stem"), (F.col("s") / 86400.0).alias("time")).agg(F.max("x").alias("gain"))
    chunks = e.select("user_id").distinct().select("user_id", F.explode(F.sequence(F.lit(0), F.lit(220), F.lit(20))).alias("offset"), (30.0 - F.col("user_id") % 4).alias("duration_sec"))
    return signals.envelope_chunks(chunks, points, ["user_id"], 8, 2, 40).withColumn("gain", F.round("gain", 6))


_QUANTISED = "q AS (SELECT user_id, s // 86400 AS block, CAST(round_even(x * 32768 / 8, 0) AS BIGINT) AS q, x FROM e), m AS (SELECT user_id, block, sum(q) + CASE WHEN user_id % 4 = 0 THEN block % 3 ELSE 0 END AS mix, sum(x) + CASE WHEN user_id % 4 = 0 THEN 0.01 * (block % 3) ELSE 0 END AS fmix FROM q GROUP BY user_id, block)"


@query(f"WITH {_E}, {_QUANTISED}, t AS (SELECT user_id, block, sum(q) AS total FROM q GROUP BY ALL) SELECT user_id, CAST(max(abs(mix - total)) AS BIGINT) AS worst FROM m JOIN t USING (user_id, block) GROUP BY user_id")
def a25_lsb_error(t):
    q = _events(t).select("user_id", F.floor(F.col("s") / 86400).alias("block"), S.quantize16(F.col("x") / 8).alias("q"))
    mixes = q.groupBy("user_id", "block").agg(F.sum("q").alias("mix")).withColumn("mix", F.col("mix") + F.when(F.col("user_id") % 4 == 0, F.col("block") % 3).otherwise(0))
    return signals.lsb_error(q, mixes, ["user_id"], ["block"])


@query(f"""WITH {_E}, {_QUANTISED}, t AS (SELECT user_id, block, sum(x) AS total FROM q GROUP BY ALL), d AS (SELECT user_id, CASE WHEN user_id % 11 = 0 THEN NULL ELSE fmix END - total AS d FROM m JOIN t USING (user_id, block))
 SELECT user_id, round(coalesce(sqrt(avg(d * d)), 1e9), 6) AS error, coalesce(sqrt(avg(d * d)), 1e9) < 1e-3 AS passes FROM d GROUP BY user_id""")
def a13_additivity(t):
    x = _events(t).select("user_id", F.floor(F.col("s") / 86400).alias("block"), "x")
    mixes = x.groupBy("user_id", "block").agg(F.sum("x").alias("mix")).withColumn("mix", F.col("mix") + F.when(F.col("user_id") % 4 == 0, 0.01 * (F.col("block") % 3)).otherwise(0.0)).filter("user_id % 11 <> 0")
    found = levels.additivity(x, mixes, ["user_id"], ["block"])
    return found.select("user_id", F.round(F.least("error", F.lit(1e9)), 6).alias("error"), "passes")


@query(f"""WITH {_E}, l AS (SELECT user_id, CASE WHEN user_id % 7 <> 0 THEN 20 * log10(sqrt(avg(x * x))) - 10 END AS lufs, 20 * log10(max(abs(x))) AS tp FROM e GROUP BY user_id),
 f AS (SELECT *, CASE WHEN lufs IS NULL THEN 0 ELSE -27.0 + (2 * {_HASH("user_id", "loudness")} - 1) - lufs END AS gain FROM l) SELECT user_id, round(gain, 5) AS gain_db, lufs IS NOT NULL AND tp + gain > -8 AS limits FROM f""")
def f7_loudness_fit(t):
    found = levels.levels(_events(t), ["user_id"]).select("user_id", F.when(F.col("user_id") % 7 != 0, F.col("rms_db") - 10).alias("lufs"), F.col("peak_db").alias("true_peak_db"))
    return signals.loudness_fit(found, "user_id", ceiling=-8.0).select("user_id", F.round("gain_db", 5).alias("gain_db"), "limits")


@query(f"""WITH {_E}, l AS (SELECT user_id, 20 * log10(sqrt(avg(x * x))) * 8 AS lufs FROM e GROUP BY user_id) SELECT user_id, round(CASE WHEN lufs > -70 THEN pow(10, (-23 - lufs) / 20) ELSE 1 END, 4) AS gain FROM l""")
def w13_clip_gain(t):
    found = levels.levels(_events(t), ["user_id"]).withColumn("lufs", F.col("rms_db") * 8)
    return found.select("user_id", F.round(signals.clip_gain(F.col("lufs")), 4).alias("gain"))


@query(f"""WITH {_E}, c AS (SELECT user_id, event_type AS stem, s // 86400 AS pos, sum(x) AS x FROM e GROUP BY ALL), m AS (SELECT user_id, pos, abs(sum(x)) AS mix, max(abs(x)) AS stem FROM c GROUP BY ALL), g AS (SELECT user_id, CASE WHEN max(greatest(mix, stem)) > pow(10, -0.05) THEN pow(10, -0.05) / max(greatest(mix, stem)) ELSE 1 END AS gain FROM m GROUP BY user_id)
 SELECT user_id, pos, CAST(sum(CAST(least(greatest(round_even(x * gain * 32768, 0), -32768), 32767) AS BIGINT)) AS BIGINT) AS mix, abs(sum(CAST(least(greatest(round_even(x * gain * 32768, 0), -32768), 32767) AS BIGINT))) <= 32767 AS fits FROM c JOIN g USING (user_id) GROUP BY user_id, pos""")
def f10_linear_render(t):
    c = _events(t).groupBy("user_id", F.col("event_type").alias("stem"), F.floor(F.col("s") / 86400).alias("pos")).agg(F.sum("x").alias("x"))
    return levels.linear_render(c, ["user_id"], ["pos"])
