"""Queries of filters, dynamics, rooms, loudness and mastering over signals in blocks, each with SQL that works it out sample by
sample: recurrences as recursion, windows as frames, rooms as a join over lags. The SQL designs its filters by formula."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wavequill.operators import chains, levels, loudness, rendering, reports, signals
from wavequill.plans.queries import _E, _HASH, _events, query
from wavequill.plans.signal_queries import _DUCK, BLOCK, _blocks, _long, _samples
from wavequill.storage import kept

#: samples a second of the signals here, how many samples each event sounds, and samples of a block of these tones
RATE, TONE_SAMPLES, TONE_BLOCK = 4000, 32, 2048
ONE = ("left",)


def _tones(t) -> DataFrame:
    """A scene per user in blocks of one channel: every event sounds for a while, as loud as its value. A block's values are kept,
    their tones are made where they are read."""
    ranked = _events(t).select("user_id", "x", (F.row_number().over(Window.partitionBy("user_id").orderBy("s", "event_id")) - 1).alias("k"))
    each = ranked.groupBy("user_id", F.floor(F.col("k") * TONE_SAMPLES / TONE_BLOCK).alias("b")).agg(F.array_sort(F.collect_list(F.struct("k", "x"))).alias("v"))
    each = kept(each)
    tone = F.flatten(F.transform("v", lambda e: F.transform(F.sequence(F.lit(0), F.lit(TONE_SAMPLES - 1)), lambda i: e["x"] * F.sin(i * 0.7))))
    return each.select("user_id", (F.col("b") * TONE_BLOCK).cast("long").alias("start"), tone.alias("left"))


def _mono(t) -> DataFrame:
    """Every user's events as one signal in short blocks, turned about zero."""
    return _blocks(_samples(t).withColumn("x", F.col("x") - 0.5)).select("user_id", "start", "left")


_CONTROL = f"{_E}, p AS MATERIALIZED (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY s, event_id) - 1 AS pos, x - 0.5 AS x FROM e), n AS (SELECT user_id, count(*) AS n FROM p GROUP BY user_id)"
_TONES = f"{_E}, r AS (SELECT user_id, x, row_number() OVER (PARTITION BY user_id ORDER BY s, event_id) - 1 AS k FROM e), p AS MATERIALIZED (SELECT user_id, k * {TONE_SAMPLES} + i AS pos, x * sin(i * 0.7) AS x FROM r, range({TONE_SAMPLES}) i(i)), n AS (SELECT user_id, count(*) AS n FROM p GROUP BY user_id)"


def _design(name: str, hz: float, q: str, db: float | None = None) -> str:
    """Coefficients of a high-pass, or of a high shelf of `db`."""
    if db is None:
        b, a = ("(1 + c) / 2", "-(1 + c)", "(1 + c) / 2"), ("1 + al", "-2 * c", "1 - al")
    else:
        r = "2 * sqrt(g) * al"
        b = f"g * ((g + 1) + (g - 1) * c + {r})", "-2 * g * ((g - 1) + (g + 1) * c)", f"g * ((g + 1) + (g - 1) * c - {r})"
        a = f"(g + 1) - (g - 1) * c + {r}", "2 * ((g - 1) - (g + 1) * c)", f"(g + 1) - (g - 1) * c - {r}"
    terms = ", ".join([f"({x}) / ({a[0]}) AS b{i}" for i, x in enumerate(b)] + [f"({x}) / ({a[0]}) AS a{i}" for i, x in enumerate(a) if i])
    return f"{name} AS (SELECT {terms} FROM (SELECT cos(2 * pi() * {hz} / {RATE}) AS c, sin(2 * pi() * {hz} / {RATE}) / (2 * {q}) AS al, pow(10, {db or 0} / 40.0) AS g))"


def _filtered(name: str, source: str, design: str) -> str:
    y = "(f.b0 * z.x + d.s1)"
    return (
        f"{name}_r AS (SELECT user_id, CAST(-1 AS BIGINT) AS pos, 0::DOUBLE AS x, 0::DOUBLE AS s1, 0::DOUBLE AS s2 FROM n UNION ALL SELECT z.user_id, z.pos, {y}, f.b1 * z.x - f.a1 * {y} + d.s2, f.b2 * z.x - f.a2 * {y}"
        f" FROM {name}_r d JOIN {source} z ON z.user_id = d.user_id AND z.pos = d.pos + 1, {design} f), {name} AS MATERIALIZED (SELECT user_id, pos, x FROM {name}_r WHERE pos >= 0)"
    )


def _compressed(name: str, source: str, threshold: float, ratio: float, attack: float, release: float) -> str:
    over = f"greatest(20 * log10(abs(z.x) + 1e-10) - ({threshold}), 0)"
    c = f"CASE WHEN {over} > 0 THEN exp(-1000 / ({RATE} * {attack})) ELSE exp(-1000 / ({RATE} * {release})) END"
    return (
        f"{name}_r AS (SELECT user_id, CAST(-1 AS BIGINT) AS pos, 0::DOUBLE AS x, 0::DOUBLE AS r FROM n UNION ALL SELECT z.user_id, z.pos, z.x, {c} * d.r + (1 - {c}) * {over} * (1 - 1 / {ratio}::DOUBLE)"
        f" FROM {name}_r d JOIN {source} z ON z.user_id = d.user_id AND z.pos = d.pos + 1), {name} AS MATERIALIZED (SELECT user_id, pos, x * pow(10, -r / 20) AS x FROM {name}_r WHERE pos >= 0)"
    )


def _room(name: str, source: str, size: float, damping: float, wet: float) -> str:
    n = max(2, int(RATE * (0.2 + 1.8 * size)))
    noise = lambda i: f"({i} * {i} * 104729 + {i} * 7919) % 65537 / 32768.0 - 1"
    taps = f"pow(10, -3.0 * i / {n}) * ((1 - {damping}) * ({noise('(i + 1)')}) + {damping} * ({noise('i')} + {noise('(i + 1)')} + {noise('(i + 2)')}) / 3)"
    return (
        f"{name}_h AS (SELECT i, h * {wet} / sqrt(sum(h * h) OVER ()) + CASE WHEN i = 0 THEN 1 ELSE 0 END AS h FROM (SELECT i, {taps} AS h FROM range({n}) i(i))),"
        f" {name}_l AS (SELECT user_id, list(x ORDER BY pos) AS x FROM {source} GROUP BY user_id), {name}_t AS (SELECT list(h ORDER BY i) AS h FROM {name}_h),"
        f" {name} AS (SELECT z.user_id, z.pos, list_dot_product(t.h[1:z.pos + 1], list_reverse(l.x[greatest(z.pos + 1 - {n - 1}, 1):z.pos + 1])) AS x FROM {source} z JOIN {name}_l l USING (user_id), {name}_t t)"
    )


def _limited(name: str, source: str, ceiling: float) -> str:
    size = max(1, round(RATE * 0.005))
    frame = "PARTITION BY user_id ORDER BY pos ROWS BETWEEN"
    return (
        f"{name}_p AS (SELECT user_id, unnest(range({1 - size}, n)) AS pos FROM n), {name}_w AS (SELECT q.user_id, q.pos, z.x, coalesce(least(1, pow(10, {ceiling} / 20.0) / greatest(abs(z.x), 1e-12)), 1) AS need FROM {name}_p q LEFT JOIN {source} z USING (user_id, pos)),"
        f" {name}_m AS (SELECT user_id, pos, x, min(need) OVER ({frame} CURRENT ROW AND {size - 1} FOLLOWING) AS low FROM {name}_w), {name}_g AS (SELECT user_id, pos, x, avg(low) OVER ({frame} {size - 1} PRECEDING AND CURRENT ROW) AS g FROM {name}_m),"
        f" {name} AS MATERIALIZED (SELECT user_id, pos, least(greatest(x * g, -pow(10, {ceiling} / 20.0)), pow(10, {ceiling} / 20.0)) AS x FROM {name}_g WHERE pos >= 0)"
    )


def _peaks(name: str, source: str) -> str:
    """Between samples: a sinc of 25 points under a squared cosine, at quarters."""
    at = "(k - i / 4.0)"
    return (
        f"{name}_k AS (SELECT i, k, sin(pi() * {at}) / (pi() * {at}) * pow(cos(pi() * {at} / 26), 2) AS w FROM range(1, 4) i(i), range(-12, 13) k(k)), {name}_b AS (SELECT z.user_id, z.pos + k.k AS pos, k.i, sum(z.x * k.w) AS y FROM {source} z, {name}_k k GROUP BY ALL),"
        f" {name} AS (SELECT user_id, max(y) AS peak FROM (SELECT user_id, abs(x) AS y FROM {source} UNION ALL SELECT b.user_id, abs(b.y) FROM {name}_b b JOIN n USING (user_id) WHERE b.pos >= 0 AND b.pos < n) GROUP BY user_id)"
    )


def _weighted(name: str, source: str) -> str:
    return f"{_design(name + '_d1', 1500.0, 'sqrt(0.5)', 4.0)}, {_design(name + '_d2', 38.0, '0.5')}, {_filtered(name + '_s', source, name + '_d1')}, {_filtered(name, name + '_s', name + '_d2')}"


def _windows(name: str, source: str, step: int, span: int) -> str:
    return f"{name} AS (SELECT b.user_id, b.w, avg(y.x * y.x) AS z FROM (SELECT user_id, unnest(range(0, CAST(floor((n - {step * span}) / {step}) AS BIGINT) + 1)) AS w FROM n WHERE n >= {step * span}) b JOIN {source} y ON y.user_id = b.user_id AND y.pos >= b.w * {step} AND y.pos < (b.w + {span}) * {step} GROUP BY ALL)"


def _gated(name: str, windows: str, floor: str) -> str:
    lufs = "-0.691 + 10 * log10(z)"
    return (
        f"{name}_a AS (SELECT user_id, avg(z) / 10 AS gate FROM {windows} WHERE z > 0 AND {lufs} >= -70 GROUP BY user_id), {name}_b AS (SELECT user_id, -0.691 + 10 * log10(avg(z)) AS lufs FROM {windows} JOIN {name}_a USING (user_id) WHERE z > 0 AND {lufs} >= -70 AND z > gate GROUP BY user_id),"
        f" {name} AS (SELECT user_id, coalesce(lufs, {floor}) AS lufs FROM n LEFT JOIN {name}_b USING (user_id))"
    )


_LONG = "SELECT user_id, pos, round(x, 6) AS x FROM "
_LEVELS = "SELECT user_id, count(*) AS n, round(20 * log10(sqrt(avg(x * x))), 5) AS rms_db, round(20 * log10(max(abs(x))), 5) AS peak_db, round(abs(avg(x)), 8) AS dc_offset FROM {} GROUP BY user_id"


def _levels(found: DataFrame) -> DataFrame:
    each = levels.block_levels(found, ["user_id"], ONE)
    return each.select("user_id", "n", F.round("rms_db", 5).alias("rms_db"), F.round("peak_db", 5).alias("peak_db"), F.round("dc_offset", 8).alias("dc_offset"))


@query(f"WITH RECURSIVE {_CONTROL}, {_design('d1', 80.0, 'sqrt(0.5)')}, {_design('d2', 1200.0, 'sqrt(0.5)', -3.0)}, {_filtered('f', 'p', 'd1')}, {_filtered('g', 'f', 'd2')} {_LONG} g")
def f2_filters(t):
    return _long(chains.process_stems(_mono(t), ["user_id"], RATE, BLOCK, {"low_cut_hz": 80.0, "high_shelf_db": -3.0, "high_shelf_hz": 1200.0}, values=ONE))


@query(f"WITH RECURSIVE {_CONTROL}, {_compressed('c', 'p', -20.0, 2.0, 10.0, 100.0)} {_LONG} c")
def f3_compressor(t):
    return _long(chains.process_stems(_mono(t), ["user_id"], RATE, BLOCK, {"compressor": {"threshold": -20.0, "ratio": 2.0}}, values=ONE))


@query(f"WITH {_CONTROL}, {_room('c', 'p', 0.01, 0.4, 0.25)} {_LONG.replace(', 6', ', 8')} c")
def f4_reverb(t):
    found = chains.process_stems(_mono(t), ["user_id"], RATE, BLOCK, {"reverb": {"room_size": 0.01, "damping": 0.4, "wet": 0.25}}, values=ONE)
    return _long(found, digits=8)


@query(f"WITH {_CONTROL}, {_limited('c', 'p', -12.0)} {_LONG} c")
def f5_limiter(t):
    return _long(chains.limit(kept(_mono(t)), ["user_id"], RATE, BLOCK, -12.0, ONE))


@query(f"WITH {_CONTROL}, {_peaks('k', 'p')} SELECT user_id, round(peak, 6) AS true_peak FROM k")
def a6_true_peaks(t):
    return loudness.true_peaks(kept(_mono(t)), ["user_id"], BLOCK, ONE).select("user_id", F.round("true_peak", 6).alias("true_peak"))


@query(f"WITH RECURSIVE {_CONTROL}, {_weighted('y', 'p')}, {_windows('w', 'y', 8, 4)} SELECT user_id, w AS block, round(z, 8) AS z FROM w")
def a10_window_powers(t):
    hops = loudness.hop_powers(kept(_mono(t)), ["user_id"], RATE, 8, ONE)
    return loudness.window_powers(hops, ["user_id"], 8, 4).withColumn("z", F.round("z", 8))


@query(f"WITH RECURSIVE {_TONES}, {_weighted('y', 'p')}, {_windows('w', 'y', 400, 4)}, {_gated('l', 'w', '-70')}, {_peaks('k', 'p')} SELECT user_id, round(lufs, 5) AS lufs, round(20 * log10(peak), 5) AS true_peak_db FROM l JOIN k USING (user_id)")
def a6_loudness_and_true_peak(t):
    found = loudness.integrated_loudness(kept(_tones(t)), ["user_id"], RATE, TONE_BLOCK, ONE)
    return found.select("user_id", F.round("lufs", 5).alias("lufs"), F.round("true_peak_db", 5).alias("true_peak_db"))


@query(f"""WITH RECURSIVE {_TONES}, {_weighted('y', 'p')}, {_windows('w', 'y', 400, 4)}, {_gated('l', 'w', '-70')}, {_peaks('k', 'p')}, {_windows('v', 'y', 200, 3)}, o AS (SELECT user_id, list_sort(list(-0.691 + 10 * log10(z))) AS v FROM v WHERE z > 0 AND -0.691 + 10 * log10(z) > -70 GROUP BY user_id),
 m AS (SELECT user_id, count(*) AS n, 20 * log10(sqrt(avg(x * x))) AS rms FROM p GROUP BY user_id)
 SELECT user_id, round(m.n / {RATE}, 2) AS duration_sec, round(lufs, 1) AS loudness_lufs, round(CASE WHEN len(v) >= 2 THEN v[least(CAST(floor(len(v) * 0.95) AS BIGINT), len(v) - 1) + 1] - v[CAST(floor(len(v) * 0.10) AS BIGINT) + 1] ELSE 0 END, 1) AS loudness_range_lu,
  round(20 * log10(peak), 1) AS true_peak_dbtp, round(rms, 1) AS rms_db, round(20 * log10(peak) - rms, 1) AS crest_factor_db FROM m JOIN l USING (user_id) JOIN k USING (user_id) LEFT JOIN o USING (user_id)""")
def a12_stem_analysis(t):
    tones = kept(_tones(t))
    measured = loudness.integrated_loudness(tones, ["user_id"], RATE, TONE_BLOCK, ONE)
    # the tones last some seconds at most, so the windows of the range are shorter than 3 s here
    ranges = levels.loudness_range(loudness.short_term(tones, ["user_id"], RATE, ONE, seconds=0.15, hop=0.05), ["user_id"])
    return levels.stem_analysis(levels.block_levels(tones, ["user_id"], ONE), measured, ["user_id"], RATE, ranges)


_CHAIN = {"low_cut_hz": 80.0, "high_shelf_db": -3.0, "high_shelf_hz": 1200.0, "compressor": {"threshold": -20.0, "ratio": 2.0}, "reverb": {"room_size": 0.4, "damping": 0.5, "wet": 0.1}, "gain_db": -2.0}


@query(f"""WITH RECURSIVE {_TONES}, {_design('d1', 80.0, 'sqrt(0.5)')}, {_design('d2', 1200.0, 'sqrt(0.5)', -3.0)}, {_filtered('f', 'p', 'd1')}, {_filtered('g', 'f', 'd2')}, {_compressed('c', 'g', -20.0, 2.0, 10.0, 100.0)}, {_room('w', 'c', 0.4, 0.5, 0.1)},
 z AS (SELECT user_id, x * pow(10, -0.1) AS x FROM w) {_LEVELS.format('z')}""")
def f1_stem_chain(t):
    return _levels(chains.process_stems(_tones(t), ["user_id"], RATE, TONE_BLOCK, _CHAIN, values=ONE))


_MASTERED = f"h AS MATERIALIZED (SELECT user_id, pos, x * pow(10, -3 / 20.0) AS x FROM p), {_compressed('c', 'h', -12.0, 3.0, 20.0, 200.0)}, {_limited('m', 'c', -2.0)}"


@query(f"WITH RECURSIVE {_TONES}, {_MASTERED} {_LEVELS.format('m')}")
def f6_mastering(t):
    return _levels(chains.master(_tones(t), ["user_id"], RATE, TONE_BLOCK, ONE))


@query(f"""WITH RECURSIVE {_TONES}, {_MASTERED}, {_weighted('y', 'm')}, {_windows('w', 'y', 400, 4)}, {_gated('l', 'w', 'NULL')}, {_peaks('k', 'm')},
 t AS (SELECT user_id, CASE WHEN lufs IS NULL THEN 0 ELSE -27.0 + (2 * {_HASH("user_id", "loudness")} - 1) - lufs END AS gain, lufs IS NOT NULL AS loud, 20 * log10(peak) AS tp FROM l JOIN k USING (user_id)),
 v AS (SELECT user_id, pos, x * pow(10, gain / 20) AS x, loud AND tp + gain > -2 AS limits FROM m JOIN t USING (user_id)), {_limited('q', 'v', -2.0)},
 z AS (SELECT user_id, CASE WHEN v.limits THEN q.x ELSE v.x END AS x FROM v JOIN q USING (user_id, pos)) {_LEVELS.format('z')}""")
def f6_mastering_to_loudness(t):
    return _levels(chains.to_loudness(chains.master(_tones(t), ["user_id"], RATE, TONE_BLOCK, ONE), "user_id", RATE, TONE_BLOCK, values=ONE))


# ---------------------------------------------------------------- reports measured on signals

#: how events are dealt to stems
_STEM = "CASE event_type WHEN 'view' THEN 'speech' WHEN 'click' THEN 'music' WHEN 'purchase' THEN 'ambience' ELSE 'sfx' END"
_LIMITS = {"lufs": (-35.0, -14.0), "most_peak": -4.0, "most_dc": 0.01, "least_rms": -80.0, "most_zeros": 9}


def _scene_signals(t):
    """Stems and mixes of all users: an event is a sample of its stem and silence in the others. Some users' music is too loud, some
    have samples that are no numbers, some a shorter speech, some a mix that is not the sum."""
    k = F.col("user_id")
    named = F.when(F.col("event_type") == "view", "speech").when(F.col("event_type") == "click", "music").when(F.col("event_type") == "purchase", "ambience").otherwise("sfx")
    w = Window.partitionBy("user_id").orderBy("s", "event_id")
    rows = _events(t).select("user_id", (F.row_number().over(w) - 1).cast("long").alias("pos"), named.alias("own"), "x", F.count(F.lit(1)).over(Window.partitionBy("user_id")).alias("n"))
    each = rows.withColumn("stem", F.explode(F.array(*map(F.lit, ("speech", "music", "ambience", "sfx")))))
    turned = (F.col("x") - 0.5) * F.when(F.col("pos") % 2 == 0, 1.0).otherwise(-1.0) * F.when((k % 7 == 0) & (F.col("stem") == "music"), 1.6).when(k % 5 == 0, 0.01).otherwise(0.4)
    value = F.when(F.col("stem") != F.col("own"), 0.0).otherwise(turned)
    clean = each.select("user_id", "stem", "pos", "n", value.alias("x"))
    stems = clean.filter(~((k % 10 == 3) & (F.col("stem") == "speech") & (F.col("pos") >= F.col("n") - 11)))
    stems = stems.withColumn("x", F.when((k % 29 == 0) & (F.col("stem") == "sfx") & (F.col("pos") == 5), F.lit(float("nan"))).otherwise(F.col("x")))
    mixes = clean.groupBy("user_id", "pos").agg(F.sum("x").alias("x")).withColumn("x", F.col("x") + F.when(k % 12 == 5, 0.01).otherwise(0.0))
    return kept(_blocks(stems, keys=("user_id", "stem"))), kept(_blocks(mixes))


def _signal_reports(t):
    customers, orders = t("customer").select(F.col("c_custkey").alias("user_id"), F.lit(True).alias("has_metadata")), t("orders").groupBy(F.col("o_custkey").alias("user_id")).agg(F.lit(True).alias("has_linear"), (F.min("o_totalprice") / 1e8).alias("stored_error"))
    scenes = t("events").select("user_id").distinct().join(customers, "user_id", "left").join(orders, "user_id", "left").select("user_id", "has_metadata", "has_linear", "stored_error", F.lit("sparse").alias("scene_type"))
    stems, mixes = _scene_signals(t)
    return reports.signal_reports(scenes, stems, mixes, ["user_id"], RATE, BLOCK, seconds=0.008, **_LIMITS)


#: the mix is x on the left and -x / 2 on the right; both are weighed alike
_SIGNALS = f"""{_E}, r AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY s, event_id) - 1 AS pos, {_STEM} AS own, x, count(*) OVER (PARTITION BY user_id) AS n FROM e),
 c AS (SELECT user_id, stem, pos, n, CASE WHEN stem <> own THEN 0 ELSE (x - 0.5) * CASE WHEN pos % 2 = 0 THEN 1 ELSE -1 END * CASE WHEN user_id % 7 = 0 AND stem = 'music' THEN 1.6 WHEN user_id % 5 = 0 THEN 0.01 ELSE 0.4 END END AS x FROM r, (SELECT unnest(['speech', 'music', 'ambience', 'sfx']) AS stem)),
 s AS MATERIALIZED (SELECT user_id, stem, pos, CASE WHEN user_id % 29 = 0 AND stem = 'sfx' AND pos = 5 THEN 'nan'::DOUBLE ELSE x END AS x FROM c WHERE NOT (user_id % 10 = 3 AND stem = 'speech' AND pos >= n - 11)),
 p AS MATERIALIZED (SELECT user_id, pos, sum(x) + CASE WHEN user_id % 12 = 5 THEN 0.01 ELSE 0 END AS x FROM c GROUP BY user_id, pos), n AS (SELECT user_id, count(*) AS n FROM p GROUP BY user_id)"""


def _report_sql() -> str:
    lim = _LIMITS
    windows = _windows("w", "y", 8, 4).replace("avg(y.x * y.x)", "avg(y.x * y.x) * 1.25")
    return f"""{_SIGNALS}, {_weighted('y', 'p')}, {windows}, {_gated('l', 'w', '-70')}, {_peaks('k', 'p')},
 z AS (SELECT user_id, stem, max(run) AS longest FROM (SELECT user_id, stem, g, count(*) FILTER (quiet) AS run FROM (SELECT *, pos - row_number() OVER (PARTITION BY user_id, stem, quiet ORDER BY pos) AS g FROM (SELECT *, abs(x) < 1e-8 AS quiet FROM s)) WHERE quiet GROUP BY ALL) GROUP BY ALL),
 v AS (SELECT user_id, stem, bool_or(isnan(x)) AS bad, 20 * log10(sqrt(sum(x * x) * 1.25 / (2 * count(*)))) AS rms, abs(sum(x) * 0.5 / (2 * count(*))) AS dc, count(*) AS n FROM s GROUP BY ALL),
 m AS (SELECT v.user_id, v.stem, bad, NOT bad AND dc > {lim['most_dc']} AS dc, NOT bad AND (rms IS NULL OR rms < {lim['least_rms']}) AND v.stem NOT IN ('music', 'sfx') AS silent, coalesce(longest, 0) > {lim['most_zeros']} AS zeros FROM v LEFT JOIN z USING (user_id, stem)),
 u AS (SELECT p.user_id, sqrt(avg((p.x - t.x) * (p.x - t.x)) * 1.25 / 2) AS error FROM p JOIN (SELECT user_id, pos, sum(x) AS x FROM s GROUP BY ALL) t USING (user_id, pos) GROUP BY p.user_id),
 d AS (SELECT user_id, max(n) - min(n) <= 10 AS same FROM (SELECT user_id, n FROM v UNION ALL SELECT user_id, n FROM n) GROUP BY user_id),
 h AS (SELECT n.user_id, c.c_custkey IS NOT NULL AS meta, o.stored IS NOT NULL AS linear, o.stored FROM n LEFT JOIN customer c ON c.c_custkey = n.user_id LEFT JOIN (SELECT o_custkey, min(o_totalprice) / 1e8 AS stored FROM orders GROUP BY 1) o ON o.o_custkey = n.user_id),
 f AS (SELECT user_id, 'corruption_' || stem || ':' || unnest([CASE WHEN bad THEN 'nan_or_inf' END, CASE WHEN dc THEN 'dc_offset' END, CASE WHEN silent THEN 'silent' END, CASE WHEN zeros THEN 'long_silence' END]) AS say, bad OR dc OR silent AS fails FROM m
  UNION ALL SELECT user_id, CASE WHEN isnan(error) OR error >= 1e-3 THEN 'additivity:sum_differs' END, true FROM u UNION ALL SELECT user_id, CASE WHEN lufs < {lim['lufs'][0]} THEN 'loudness:too_quiet' WHEN lufs > {lim['lufs'][1]} THEN 'loudness:too_loud' END, true FROM l
  UNION ALL SELECT user_id, CASE WHEN peak > 0 AND 20 * log10(peak) > {lim['most_peak']} THEN 'loudness:clipping' END, true FROM k UNION ALL SELECT user_id, CASE WHEN NOT same THEN 'duration:mismatch' END, true FROM d
  UNION ALL SELECT user_id, CASE WHEN stored > 1e-3 THEN 'additivity_stored:high' END, false FROM h),
 g AS (SELECT h.user_id, CASE WHEN NOT meta THEN 'metadata:missing' WHEN NOT linear THEN 'structure:missing' ELSE coalesce((SELECT string_agg(say, ',' ORDER BY say) FROM f WHERE f.user_id = h.user_id AND fails AND say IS NOT NULL), '') END AS errors,
  CASE WHEN meta AND linear THEN coalesce((SELECT string_agg(say, ',' ORDER BY say) FROM f WHERE f.user_id = h.user_id AND NOT fails AND say IS NOT NULL), '') ELSE '' END AS warnings, CASE WHEN meta AND linear THEN lufs END AS lufs, CASE WHEN meta AND linear THEN 20 * log10(peak) END AS peak FROM h JOIN l USING (user_id) JOIN k USING (user_id))"""


@query(f"WITH RECURSIVE {_report_sql()} SELECT user_id, errors, warnings, errors = '' AS is_valid, round(lufs, 5) AS lufs, round(peak, 5) AS true_peak_db, CASE WHEN errors NOT IN ('metadata:missing', 'structure:missing') THEN 'sparse' END AS scene_type FROM g")
def v10_signal_reports(t):
    found = _signal_reports(t)
    text = lambda c: F.array_join(F.array_sort(F.transform(c, lambda x: F.concat_ws(":", x["check"], x["reason"]))), ",")
    return found.select("user_id", text("errors").alias("errors"), text("warnings").alias("warnings"), "is_valid", F.round("lufs", 5).alias("lufs"), F.round("true_peak_db", 5).alias("true_peak_db"), "scene_type")


@query(f"""WITH RECURSIVE {_report_sql()}, failed AS (SELECT split_part(unnest(string_split(errors, ',')), ':', 1) AS k FROM g WHERE errors <> ''), q AS (SELECT k, count(*) AS n FROM failed GROUP BY k)
 SELECT count(*) AS total, count(*) FILTER (errors = '') AS valid, round(count(*) FILTER (errors = '') / count(*), 6) AS pass_rate, count(*) FILTER (errors = '' AND warnings <> '') AS with_warnings, round(avg(lufs), 5) AS lufs_mean, round(max(peak), 5) AS peak_max, (SELECT string_agg(k || '=' || n, ',' ORDER BY k) FROM q) AS error_counts FROM g""")
def a15_signal_roll_up(t):
    found = levels.report_roll_up(_signal_reports(t))
    counts = F.array_join(F.transform(F.map_entries("error_counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return found.select("total", "valid", F.round("pass_rate", 6).alias("pass_rate"), "with_warnings", F.round("lufs_mean", 5).alias("lufs_mean"), F.round("peak_max", 5).alias("peak_max"), counts.alias("error_counts"))


# ---------------------------------------------------------------- rendered scenes

_ROUGH, _FINAL, _EVENTS = {"music": {"gain_db": -6.0}}, {"music": {"gain_db": -3.0}, "sfx": {"gain_db": 2.0}}, {"sfx_0": {"gain_db": -4.0}}


def _scene_parts(t):
    """Speech, music and ambience of all users, and three sounds each at their places."""
    p = kept(_blocks(_samples(t)).select(F.col("user_id").alias("scene_id"), "start", "left"))
    before = lambda pos: F.slice("left", F.lit(1), F.greatest(pos - F.col("start"), F.lit(0)).cast("int"))
    made = {
        "speech": F.transform("left", lambda x, i: x * F.when((F.col("start") + i) % 7 < 4, 0.3).otherwise(0.01)),
        "music": F.transform(before(55), lambda x: 1 - x),
        "ambience": F.transform(before(30), lambda x: x * 0.1),
    }
    stems = p.select("scene_id", F.explode(F.array(*[F.struct(F.lit(k).alias("stem"), v.alias("left")) for k, v in made.items()])).alias("s"), "start").select("scene_id", "s.stem", "start", "s.left")
    sounds = p.filter("start < 20").select("scene_id", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("idx"), "start", before(20).alias("left"))
    events = sounds.select("scene_id", "idx", (F.col("start") + 9 * F.col("idx") + 4).alias("start"), F.transform("left", lambda x: x * (F.col("idx") + 1) / 4).alias("left"))
    sides = lambda df: df.filter(F.size("left") > 0).withColumn("right", F.transform("left", lambda x: x * -0.5))
    return sides(stems), sides(events)


_PARTS = f"""{_E}, p AS MATERIALIZED (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY s, event_id) - 1 AS pos, x FROM e), n AS (SELECT user_id, count(*) AS n FROM p GROUP BY user_id),
 speech AS MATERIALIZED (SELECT user_id, pos, x * CASE WHEN pos % 7 < 4 THEN 0.3 ELSE 0.01 END AS x FROM p), music AS (SELECT user_id, pos, 1 - x AS x FROM p WHERE pos < 55), ambience AS (SELECT user_id, pos, x * 0.1 AS x FROM p WHERE pos < 30),
 sounds AS MATERIALIZED (SELECT user_id, idx, pos AS ofs, pos + 9 * idx + 4 AS pos, x * (idx + 1) / 4 AS x FROM p, range(3) i(idx) WHERE pos < 20)"""


def _ducked(name: str, settings: dict) -> str:
    return _DUCK(name, "speech", settings["threshold_db"], settings["reduction_db"], settings["attack_ms"], settings["release_ms"]).replace("* 100.0)", f"* {RATE / 1}) ")


_TRACK_SQL = lambda name, gain, event: f"""{name}_e AS (SELECT user_id, pos, sum(x * CASE WHEN idx = 0 THEN {event} ELSE 1 END) AS x FROM sounds JOIN n USING (user_id) WHERE pos < n GROUP BY ALL),
 {name}_b AS MATERIALIZED (SELECT s.user_id, s.pos, (s.x + coalesce(m.x * {gain[0]} * dm.g, 0) + coalesce(a.x, 0) + coalesce(e.x * {gain[1]} * ds.g, 0)) * pow(10, -3 / 20.0) AS x FROM speech s LEFT JOIN music m USING (user_id, pos) LEFT JOIN ambience a USING (user_id, pos) LEFT JOIN {name}_e e USING (user_id, pos) JOIN dm USING (user_id, pos) JOIN ds USING (user_id, pos)),
 {_compressed(name + '_c', name + '_b', -12.0, 3.0, 20.0, 200.0)}, {_limited(name, name + '_c', -2.0)}"""  # noqa: E731


@query(f"""WITH RECURSIVE {_PARTS}, {_ducked('dm', signals.BUS['music'])}, {_ducked('ds', signals.BUS['sfx'])}, {_TRACK_SQL('rough', ('pow(10, -6 / 20.0)', '1'), '1')}, {_TRACK_SQL('release', ('pow(10, -3 / 20.0)', 'pow(10, 2 / 20.0)'), 'pow(10, -4 / 20.0)')}
 SELECT 'rough' AS version, user_id, pos, round(x, 6) AS x FROM rough UNION ALL SELECT 'release', user_id, pos, round(x, 6) FROM release""")
def f11_rendered_scenes(t):
    stems, events = _scene_parts(t)
    found, _ = rendering.render(stems, events, _ROUGH, _FINAL, _EVENTS, RATE, BLOCK, versions=("rough", "release"))
    long = lambda name: _long(found[name].mix.withColumnRenamed("scene_id", "user_id")).select(F.lit(name).alias("version"), "user_id", "pos", "x")
    return long("rough").unionByName(long("release"))


_PLAIN_STEP = lambda ms: f"exp(-1000 / ({ms} * {RATE / 1}))"


@query(f"""WITH RECURSIVE {_PARTS}, {_ducked('dm', signals.BUS['music'])},
 heard AS MATERIALIZED (SELECT o.user_id, o.idx, o.ofs, o.pos, o.x, coalesce((abs(s.x) + abs(s.x * -0.5)) / 2, 0) > pow(10, -25 / 20.0) AS loud FROM sounds o LEFT JOIN speech s USING (user_id, pos)),
 g AS (SELECT DISTINCT user_id, idx, CAST(-1 AS BIGINT) AS ofs, 1.0::DOUBLE AS g FROM sounds UNION ALL SELECT h.user_id, h.idx, h.ofs, CASE WHEN h.loud THEN {_PLAIN_STEP(5)} * g.g + (1 - {_PLAIN_STEP(5)}) * pow(10, -8 / 20.0) ELSE {_PLAIN_STEP(100)} * g.g + 1 - {_PLAIN_STEP(100)} END FROM g JOIN heard h ON h.user_id = g.user_id AND h.idx = g.idx AND h.ofs = g.ofs + 1),
 parts AS (SELECT user_id, pos, x FROM speech UNION ALL SELECT user_id, pos, m.x * 0.35 * dm.g FROM music m JOIN dm USING (user_id, pos) UNION ALL SELECT user_id, pos, x * 0.25 FROM ambience UNION ALL SELECT h.user_id, h.pos, h.x * 0.8 * g.g FROM heard h JOIN g USING (user_id, idx, ofs)),
 b AS MATERIALIZED (SELECT user_id, pos, sum(x) * pow(10, -3 / 20.0) AS x FROM parts GROUP BY ALL), {_compressed('c', 'b', -12.0, 3.0, 20.0, 200.0)}, {_limited('r', 'c', -2.0).replace("FROM n)", "FROM (SELECT user_id, max(pos) + 1 AS n FROM b GROUP BY user_id))")} {_LONG} r""")
def f9_plain_mix(t):
    stems, events = _scene_parts(t)
    return _long(rendering.plain_mix(stems, events, RATE, BLOCK).withColumnRenamed("scene_id", "user_id"))
