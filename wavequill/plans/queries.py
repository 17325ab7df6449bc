"""The engine's queries over the driver's tables, each with independent DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wavequill.functions import scalars as S
from wavequill.operators import blocks, chains, dimensions, envelopes, levels, lookups, loudness, timeline
from wavequill.storage import kept

QUERIES: dict = {}
SQL: dict[str, str] = {}
#: shares of the scene types (fixed values)
SCENE_TYPES = [("dialogue_heavy", 0.20), ("music_montage", 0.25), ("ambient", 0.10), ("action_sfx", 0.10), ("sparse", 0.05), ("balanced", 0.30)]


def query(sql: str | None):
    """Registers a query; None where SQL can't express it, which is then tested by property."""

    def add(f):
        QUERIES[f.__name__] = lambda spark, d: f(lambda name: spark.read.parquet(f"{d}/{name}.parquet"))
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _events(t) -> DataFrame:
    """Events as samples: x in [0, 1], s seconds since the table's first day."""
    return t("events").select("event_id", "user_id", "event_type", "value", "props", (F.unix_timestamp(F.col("ts").cast("timestamp")) - 1704067200).alias("s"), (F.col("value") / 500).alias("x"))


_E = "e AS (SELECT event_id, user_id, event_type, value, props, CAST(floor(epoch(ts)) AS BIGINT) - 1704067200 AS s, value / 500 AS x FROM events)"
_HASH = lambda k, salt="": f"((('0x' || substr(md5('{salt}' || CAST({k} AS VARCHAR)), 1, 8))::BIGINT) % 1000000) / 1000000.0"


@query(f"""WITH {_E} SELECT event_id, round(pow(10, -x / 20), 6) AS linear, round(20 * log10(x + 1e-10), 6) AS db, round(20 * log10(greatest(x - 0.5, 1e-6)), 6) AS gain_db,
 round(CASE WHEN x < 1e-10 THEN -100 ELSE 20 * log10(x) END, 6) AS level_db, round(CASE WHEN value > 0 THEN exp(-1 / (48000 * value / 1000)) ELSE 0 END, 6) AS smooth,
 round(CASE WHEN x > 1e-10 THEN least(greatest((x - 0.3) / (x + 1e-10), 0), 1) ELSE 1 END, 6) AS ratio,
 CAST(least(greatest(round_even((x - 0.5) * 2.2 * 32768, 0), -32768), 32767) AS INTEGER) AS q, CAST(CASE WHEN x < 0.7 THEN 1 ELSE 0 END AS FLOAT) AS vad FROM e""")
def p_scalar_maths(t):
    x = F.col("x")
    r = lambda c: F.round(c, 6)
    return _events(t).select("event_id", r(S.db_to_linear(-x)).alias("linear"), r(S.linear_to_db(x)).alias("db"), r(S.gain_to_db(x - 0.5)).alias("gain_db"), r(S.level_to_db(x)).alias("level_db"), r(S.smoothing(F.col("value"))).alias("smooth"), r(S.gain_reduction(x, x - 0.3)).alias("ratio"), S.quantize16(x - 0.5, 2.2).alias("q"), S.voice_activity(x).alias("vad"))


@query("""SELECT conv_id, turn, regexp_extract(text, '^\\S+') AS head, CASE WHEN lower(role) <> 'system' THEN role END AS who,
 'scene_' || role || '_' || substr(md5(CAST(conv_id AS VARCHAR)), 1, 8) AS name, '{"turn": ' || turn || '}' AS json,
 CASE WHEN turn > 3 THEN 'long' WHEN turn % 3 = 0 THEN 'a' ELSE 'default' END AS style FROM conversations""")
def p_text_functions(t):
    reply = F.concat(F.lit("```json\n{\"turn\": "), F.col("turn"), F.lit("}\n```"))
    path = F.when(F.col("turn") > 3, "x/long/f.wav").when(F.col("turn") % 3 == 0, "r/a/f.wav").otherwise("f.wav")
    who = S.not_null_text(F.when(F.col("role") == "system", "NULL").otherwise(F.col("role")))
    return t("conversations").select("conv_id", "turn", F.regexp_extract("text", r"^\S+", 0).alias("head"), who.alias("who"), S.scene_name(F.lit("scene"), F.col("role"), F.col("conv_id")).alias("name"), S.json_of_reply(reply).alias("json"), S.style_of(path).alias("style"))


@query(f"""WITH {_E}, m AS (SELECT event_id, user_id, s, max(s) OVER (PARTITION BY user_id) AS top FROM e)
 SELECT event_id, round(least(greatest(CASE WHEN top <= 2000000 THEN s ELSE s * 0.9 * 2000000 / top END, 0), 2000000 - 0.05), 3) AS at FROM m""")
def p13_normalised_times(t):
    return timeline.normalised_times(_events(t).withColumn("s", F.col("s").cast("double")), ["user_id"], "s", F.lit(2_000_000.0)).select("event_id", F.round("at", 3).alias("at"))


@query("""WITH q AS (SELECT vec_id, embedding FROM embeddings WHERE vec_id % 20 = 0),
 d AS (SELECT q.vec_id AS query_id, e.vec_id AS id, 1 - list_cosine_similarity(q.embedding::DOUBLE[], e.embedding::DOUBLE[]) AS distance FROM q JOIN embeddings e ON q.vec_id <> e.vec_id),
 r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(distance, 12), id) AS k FROM d) SELECT query_id, CASE WHEN distance <= 0.75 THEN id END AS match_id, round(distance, 6) AS distance FROM r WHERE k = 1""")
def j1_nearest_vector(t):
    v = t("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    return lookups.nearest(v.filter("id % 20 = 0"), v)


@query("""WITH tags AS (SELECT DISTINCT lower(p_type) AS tag FROM part), w AS (SELECT DISTINCT lower(split_part(p_name, ' ', 1)) AS wanted FROM part UNION SELECT DISTINCT lower(p_type) FROM part UNION SELECT 'no such tag'),
 m AS (SELECT wanted, tag, row_number() OVER (PARTITION BY wanted ORDER BY wanted <> tag, tag) AS k FROM w JOIN tags ON contains(tag, wanted) OR contains(wanted, tag))
 SELECT w.wanted, coalesce(m.tag, (SELECT max(tag) FROM tags WHERE tag = 'cinematic'), (SELECT min(tag) FROM tags)) AS match FROM w LEFT JOIN m ON m.wanted = w.wanted AND k = 1""")
def j2_tag_match(t):
    p = t("part")
    wanted = p.select(F.lower(F.split("p_name", " ")[0]).alias("wanted")).union(p.select(F.lower("p_type"))).union(p.sparkSession.range(1).select(F.lit("no such tag"))).distinct()
    return lookups.tag_match(wanted, p.select(F.lower("p_type").alias("tag")).distinct(), "cinematic")


@query(f"""WITH {_E}, a AS (SELECT event_id AS id, user_id, s AS start, s + 3600 + event_id % 7200 AS stop FROM e WHERE event_type = 'view'), b AS (SELECT event_id AS id2, user_id, s AS start2, s + 1800 AS stop2 FROM e WHERE event_type = 'click')
 SELECT a.id, id2, greatest(start, start2) AS lo, least(stop, stop2) AS hi FROM a JOIN b ON a.user_id = b.user_id AND start < stop2 AND start2 < stop""")
def j6_overlaps(t):
    e = _events(t)
    a = e.filter("event_type = 'view'").select(F.col("event_id").alias("id"), "user_id", F.col("s").alias("start"), (F.col("s") + 3600 + F.col("event_id") % 7200).alias("stop"))
    b = e.filter("event_type = 'click'").select(F.col("event_id").alias("id"), "user_id", F.col("s").alias("start"), (F.col("s") + 1800).alias("stop"))
    return timeline.overlapping(a, b, ["user_id"], 7200).select("id", "id2", F.greatest("start", "start2").alias("lo"), F.least("stop", "stop2").alias("hi"))


@query(f"""WITH {_E}, a AS (SELECT event_id AS id, user_id, s AS start, s + CASE WHEN event_id % 5 = 0 THEN 2000000 WHEN event_id % 3 = 0 THEN 90000 ELSE event_id % 7000 END AS stop FROM e WHERE event_type = 'view'), b AS (SELECT event_id AS id2, user_id, s AS start2, s + CASE WHEN event_id % 7 = 0 THEN 1000000 ELSE 60 END AS stop2 FROM e WHERE event_type = 'click')
 SELECT a.id, id2, greatest(start, start2) AS lo, least(stop, stop2) AS hi FROM a JOIN b ON a.user_id = b.user_id AND start < stop2 AND start2 < stop""")
def j6_overlaps_of_any_length(t):
    e, k = _events(t), F.col("event_id")
    span = lambda kind, length: e.filter(F.col("event_type") == kind).select(k.alias("id"), "user_id", F.col("s").alias("start"), (F.col("s") + length).alias("stop"))
    a = span("view", F.when(k % 5 == 0, 2_000_000).when(k % 3 == 0, 90_000).otherwise(k % 7000))
    b = span("click", F.when(k % 7 == 0, 1_000_000).otherwise(60))
    return timeline.overlapping(a, b, ["user_id"], 60).select("id", "id2", F.greatest("start", "start2").alias("lo"), F.least("stop", "stop2").alias("hi"))


@query("""SELECT c_custkey, CASE WHEN EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c_custkey) THEN 'render' ELSE 'plan' END AS step FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def j7_work_list(t):
    o = t("orders").withColumnRenamed("o_custkey", "c_custkey")
    return lookups.work_list(t("customer").select("c_custkey"), o.filter("o_orderstatus = 'P'"), o, "c_custkey")


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY CASE event_type WHEN 'purchase' THEN 0 WHEN 'click' THEN 1 ELSE 2 END, event_id) AS k FROM events) SELECT user_id, event_id, event_type FROM r WHERE k = 1""")
def j8_source_cascade(t):
    order = F.when(F.col("event_type") == "purchase", 0).when(F.col("event_type") == "click", 1).otherwise(2)
    return lookups.first_by_priority(t("events").select("user_id", "event_id", "event_type"), ["user_id"], [order, F.col("event_id")])


@query(f"""WITH {_E}, p AS (SELECT user_id, s, max(x) AS x FROM e WHERE event_type = 'purchase' GROUP BY ALL), f AS (SELECT user_id, unnest(range(0, 2592000, 86400)) AS s FROM (SELECT DISTINCT user_id FROM e)),
 n AS (SELECT f.user_id, f.s, (SELECT max(p.s) FROM p WHERE p.user_id = f.user_id AND p.s <= f.s) AS b, (SELECT min(p.s) FROM p WHERE p.user_id = f.user_id AND p.s >= f.s) AS a FROM f)
 SELECT n.user_id, n.s, round(coalesce(CASE WHEN a = b THEN pb.x ELSE pb.x + (pa.x - pb.x) * (n.s - b) / (a - b) END, pb.x, pa.x, 1.0), 6) AS x FROM n LEFT JOIN p pb ON pb.user_id = n.user_id AND pb.s = b LEFT JOIN p pa ON pa.user_id = n.user_id AND pa.s = a""")
def j13_interpolated(t):
    e = _events(t)
    points = e.filter("event_type = 'purchase'").groupBy("user_id", "s").agg(F.max("x").alias("x"))
    frames = e.select("user_id").distinct().withColumn("s", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(2505600).cast("long"), F.lit(86400).cast("long"))))
    return envelopes.interpolated(frames, points, ["user_id"], "s", "x", 86_400.0).withColumn("x", F.round("x", 6))


@query(f"""WITH {_E}, q AS (SELECT user_id, s // 86400 AS block, CAST(round_even(x * 32768 / 8, 0) AS INTEGER) AS q FROM e) SELECT user_id, block, CAST(sum(q) AS BIGINT) AS mix, abs(sum(q)) <= 32767 AS fits FROM q GROUP BY ALL""")
def a2_exact_mix(t):
    return levels.exact_mix(_events(t).select("user_id", F.floor(F.col("s") / 86400).alias("block"), S.quantize16(F.col("x") / 8).alias("q")), ["user_id", "block"])


@query(f"""WITH {_E}, c AS (SELECT user_id, s // 86400 AS block, abs(sum(x)) AS mix, max(abs(x)) AS stem FROM e GROUP BY ALL), p AS (SELECT user_id, max(greatest(mix, stem)) AS peak FROM c GROUP BY ALL)
 SELECT user_id, round(peak, 6) AS peak, round(CASE WHEN peak > pow(10, -1 / 20.0) THEN pow(10, -1 / 20.0) / peak ELSE 1 END, 6) AS gain FROM p""")
def a3_shared_gain(t):
    found = levels.shared_gain(_events(t).select("user_id", F.floor(F.col("s") / 86400).alias("block"), "x"), ["user_id"], ["block"])
    return found.select("user_id", F.round("peak", 6).alias("peak"), F.round("gain", 6).alias("gain"))


_LEVELS = "l AS (SELECT user_id, event_type AS stem, count(*) AS n, 20 * log10(sqrt(avg(x * x))) AS rms_db, 20 * log10(max(abs(x))) AS peak_db, abs(avg(x)) AS dc_offset, false AS has_bad, bool_or(x <> 0) AS is_loud FROM e GROUP BY ALL)"


@query(f"WITH {_E}, {_LEVELS} SELECT user_id, stem, n, round(rms_db, 5) AS rms_db, round(peak_db, 5) AS peak_db, round(peak_db - rms_db, 5) AS crest_db, round(dc_offset, 10) AS dc_offset, has_bad, is_loud FROM l")
def a4_levels(t):
    found = levels.levels(_events(t).withColumnRenamed("event_type", "stem"), ["user_id", "stem"])
    return found.select("user_id", "stem", "n", *[F.round(c, 5).alias(c) for c in ("rms_db", "peak_db", "crest_db")], F.round("dc_offset", 10).alias("dc_offset"), "has_bad", "is_loud")


@query(f"""WITH {_E}, v AS (SELECT user_id, list_sort(list(20 * log10(x))) AS v FROM e WHERE 20 * log10(x) > -70 GROUP BY user_id)
 SELECT user_id, round(CASE WHEN len(v) >= 2 THEN v[CAST(floor(len(v) * 0.95) AS BIGINT) + 1] - v[CAST(floor(len(v) * 0.10) AS BIGINT) + 1] ELSE 0 END, 5) AS lra FROM v""")
def a11_loudness_range(t):
    return levels.loudness_range(_events(t).withColumn("db", S.level_to_db(F.col("x"))), ["user_id"]).withColumn("lra", F.round("lra", 5))


@query("""SELECT l_orderkey, CAST(max(l_quantity) - min(l_quantity) AS DOUBLE) AS spread, count(l_quantity) AS files, count(l_quantity) >= 2 AND max(l_quantity) - min(l_quantity) <= 10 AS matches FROM lineitem GROUP BY 1""")
def a14_duration_spread(t):
    return levels.duration_spread(t("lineitem"), ["l_orderkey"], "l_quantity")


@query(f"""WITH {_E}, {_LEVELS}, r AS (SELECT user_id, bool_or(dc_offset > 0.6 OR peak_db > -0.3 OR rms_db NOT BETWEEN -35 AND -4 OR (rms_db < -80 AND stem NOT IN ('music', 'sfx'))) AS bad,
 list_sort(list_distinct(flatten(list(list_filter([CASE WHEN dc_offset > 0.6 THEN 'dc_offset' END, CASE WHEN peak_db > -0.3 THEN 'peak' END, CASE WHEN rms_db NOT BETWEEN -35 AND -4 THEN 'loudness' END], lambda v: v IS NOT NULL))))) AS e FROM l GROUP BY user_id)
 SELECT user_id, array_to_string(e, ',') AS errors, NOT bad AS is_valid FROM r""")
def v10_validation(t):
    found = levels.validation(levels.levels(_events(t).withColumnRenamed("event_type", "stem"), ["user_id", "stem"]), ["user_id"], (-35, -4), -0.3, 0.6)
    return found.select("user_id", F.array_join("errors", ",").alias("errors"), "is_valid")


@query(f"""WITH {_E}, {_LEVELS}, r AS (SELECT user_id, bool_or(dc_offset > 0.6 OR peak_db > -0.3 OR rms_db NOT BETWEEN -35 AND -4) AS bad FROM l GROUP BY user_id)
 SELECT count(*) AS total, count(*) FILTER (NOT bad) AS valid, count(*) FILTER (NOT bad) / count(*) AS pass_rate FROM r""")
def a15_roll_up(t):
    return levels.roll_up(levels.validation(levels.levels(_events(t).withColumnRenamed("event_type", "stem"), ["user_id", "stem"]), ["user_id"], (-35, -4), -0.3, 0.6))


@query("""WITH c(event_type, ord) AS (VALUES ('view', 0), ('click', 1), ('purchase', 2), ('signup', 3), ('error', 4), ('none', 5)) SELECT c.event_type, ord, count(e.event_id) AS n FROM c LEFT JOIN events e ON e.event_type = c.event_type GROUP BY ALL""")
def a16_class_counts(t):
    return lookups.class_counts(t("events").select("event_type"), "event_type", ["view", "click", "purchase", "signup", "error", "none"])


@query("""SELECT tag, array_to_string(list_sort(list_distinct(list(p_brand))), ',') AS items FROM (SELECT lower(trim(unnest(string_split(p_type, ' ')))) AS tag, p_brand FROM part) WHERE tag <> '' GROUP BY tag""")
def a18_inverted_index(t):
    return lookups.inverted_index(t("part"), F.split("p_type", " "), "p_brand").withColumn("items", F.array_join("items", ","))


@query("""WITH c AS (SELECT user_id, event_type, count(*) AS n, min(event_id) AS f FROM events GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, f) AS k FROM c) SELECT user_id, event_type FROM r WHERE k = 1""")
def a19_dominant(t):
    return lookups.dominant(t("events"), ["user_id"], "event_type", "event_id")


@query("""SELECT lang, source, count(*) AS n FROM documents GROUP BY GROUPING SETS ((lang), (lang, source))""")
def a21_source_statistics(t):
    return t("documents").groupingSets([[F.col("lang")], [F.col("lang"), F.col("source")]], "lang", "source").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT event_type, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 4) AS percent FROM events GROUP BY event_type""")
def a22_percentages(t):
    counted = t("events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))  # a row per type
    return counted.withColumn("percent", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()), 4))


@query(f"""WITH RECURSIVE {_E}, o AS (SELECT user_id, x, row_number() OVER (PARTITION BY user_id ORDER BY s, event_id) AS k FROM e),
 g AS (SELECT user_id, 0::BIGINT AS k, 1.0::DOUBLE AS g, 1.0::DOUBLE AS low FROM (SELECT DISTINCT user_id FROM o) UNION ALL
 SELECT o.user_id, o.k, CASE WHEN x > 0.5 THEN 0.9 * g + 0.1 * 0.25 ELSE 0.99 * g + 0.01 END, least(low, CASE WHEN x > 0.5 THEN 0.9 * g + 0.1 * 0.25 ELSE 0.99 * g + 0.01 END) FROM g JOIN o ON o.user_id = g.user_id AND o.k = g.k + 1)
 SELECT user_id, round(arg_max(g, k), 6) AS last_gain, round(min(low), 6) AS least_gain FROM g GROUP BY user_id""")
def w1_sidechain(t):
    parts = _events(t).groupBy("user_id", F.floor(F.col("s") / 864_000).alias("start")).agg(F.array_sort(F.collect_list(F.struct("s", "event_id", "x"))).alias("v"))
    gains = blocks.scanned(kept(parts.select("user_id", "start", F.col("v.x").alias("x"))), ["user_id"], chains.Sidechain(0.5, 0.25, 0.9, 0.99), ("x",))
    found = gains.groupBy("user_id").agg(F.max_by(F.element_at("x", -1), "start").alias("last_gain"), F.least(F.lit(1.0), F.min(F.array_min("x"))).alias("least_gain"))
    return found.select("user_id", F.round("last_gain", 6).alias("last_gain"), F.round("least_gain", 6).alias("least_gain"))


@query(f"""WITH RECURSIVE {_E}, f AS (SELECT user_id, s // 86400 AS s, 20 * log10(avg(x) + 1e-10) AS db FROM e GROUP BY ALL), o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY s) AS k FROM f),
 r AS (SELECT user_id, k, s, db, db AS kept, true AS emit FROM o WHERE k = 1 UNION ALL SELECT o.user_id, o.k, o.s, o.db, CASE WHEN abs(o.db - r.kept) >= 3 THEN o.db ELSE r.kept END, abs(o.db - r.kept) >= 3 FROM r JOIN o ON o.user_id = r.user_id AND o.k = r.k + 1)
 SELECT user_id, s, round(db, 5) AS db FROM r WHERE emit""")
def w3_keyframes(t):
    frames = _events(t).groupBy("user_id", F.floor(F.col("s") / 86400).alias("s")).agg(S.linear_to_db(F.avg("x")).alias("db"))
    return envelopes.keyframes(frames, ["user_id"], "s", "db", 3.0).withColumn("db", F.round("db", 5))


@query(SQL["w3_keyframes"].replace("SELECT user_id, s, round(db, 5) AS db FROM r WHERE emit", """, p AS (SELECT user_id, s * 86400 AS s, db FROM r WHERE emit), z AS (SELECT user_id, s, x, row_number() OVER (PARTITION BY user_id ORDER BY s DESC, event_id DESC) AS k FROM e)
 SELECT user_id, s, round(db, 5) AS db FROM p UNION ALL SELECT user_id, s, round(20 * log10(greatest(x, 1e-6)), 5) FROM z WHERE k = 1 AND s - 0.01 > (SELECT max(p.s) FROM p WHERE p.user_id = z.user_id)"""))
def w3_keyframes_to_the_end(t):
    frames = _events(t).groupBy("user_id", F.floor(F.col("s") / 86400).alias("s")).agg(S.linear_to_db(F.avg("x")).alias("db"))
    points = envelopes.keyframes(frames, ["user_id"], "s", "db", 3.0).withColumn("s", F.col("s") * 86400)
    return envelopes.with_ends(points, _events(t), ["user_id"], "s", "x", "db", ["event_id"]).withColumn("db", F.round("db", 5))


@query(f"""WITH {_E}, o AS (SELECT user_id, x < 0.4 AS quiet, row_number() OVER (PARTITION BY user_id ORDER BY s, event_id) - row_number() OVER (PARTITION BY user_id, x < 0.4 ORDER BY s, event_id) AS run FROM e),
 c AS (SELECT user_id, quiet, run, count(*) AS n FROM o GROUP BY ALL) SELECT user_id, max(CASE WHEN quiet THEN n ELSE 0 END) AS longest FROM c GROUP BY user_id""")
def w4_longest_quiet(t):
    parts = _events(t).groupBy("user_id", F.floor(F.col("s") / 864_000).alias("start")).agg(F.array_sort(F.collect_list(F.struct("s", "event_id", "x"))).alias("v"))
    return levels.longest_quiet(parts.select("user_id", "start", F.col("v.x").alias("left")), ["user_id"], ("left",), 0.4)


@query("""SELECT o_orderkey, unnest(range(0, CAST(floor(o_totalprice) AS BIGINT) - 20000 + 1, 10000)) AS "offset" FROM orders WHERE floor(o_totalprice) >= 20000""")
def w5_chunks(t):
    return timeline.chunks(t("orders").select("o_orderkey", F.floor("o_totalprice").alias("total")), "total", 20_000, 10_000).select("o_orderkey", "offset")


@query(f"""WITH {_E}, p AS (SELECT user_id, s // 3600 + i AS pos, CAST(round(value * 100) AS BIGINT) AS x FROM e, (SELECT unnest([0, 1, 2]) AS i)) SELECT user_id, pos, CAST(sum(x) AS BIGINT) AS x FROM p WHERE pos < 700 GROUP BY ALL""")
def w7_placed(t):
    e = _events(t).select("user_id", F.floor(F.col("s") / 3600).alias("start"), F.array_repeat(F.round(F.col("value") * 100).cast("long"), 3).alias("samples"))
    return timeline.placed(e, ["user_id"], 700)


@query("""WITH c AS (SELECT o_custkey, o_orderkey, coalesce(sum(round(o_totalprice) + 4) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS "offset" FROM orders) SELECT o_custkey, o_orderkey, "offset" FROM c WHERE "offset" < 300000""")
def w9_until_long_enough(t):
    clips = t("orders").select("o_custkey", "o_orderkey", F.round("o_totalprice").alias("n"))
    return timeline.until_long_enough(clips, ["o_custkey"], ["o_orderkey"], "n", 4.0, 300_000.0).select("o_custkey", "o_orderkey", "offset")


@query("""WITH r AS (SELECT c_nationkey, c_mktsegment, c_custkey, row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_custkey) AS turn, dense_rank() OVER (PARTITION BY c_nationkey ORDER BY c_mktsegment) AS who FROM customer),
 n AS (SELECT c_nationkey, count(*) FILTER (who = 1) AS n1, count(*) FILTER (who = 2) AS n2 FROM r GROUP BY 1)
 SELECT r.c_nationkey, c_custkey, CAST(2 * (turn - 1) + who AS BIGINT) AS slot FROM r JOIN n USING (c_nationkey) WHERE who <= 2 AND n1 > 0 AND n2 > 0 AND turn <= n1 AND turn <= CASE WHEN who = 1 THEN n2 + 1 ELSE n2 END""")
def w11_interleaved(t):
    found = timeline.interleaved(t("customer").select("c_nationkey", "c_mktsegment", "c_custkey"), ["c_nationkey"], "c_mktsegment", ["c_custkey"])
    return found.select("c_nationkey", "c_custkey", F.col("slot").cast("long").alias("slot"))


@query(f"""WITH u AS (SELECT c_custkey, {_HASH('c_custkey', 'type')} AS u FROM customer) SELECT c_custkey, CASE WHEN u < 0.2 THEN 'dialogue_heavy' WHEN u < 0.45 THEN 'music_montage' WHEN u < 0.55 THEN 'ambient' WHEN u < 0.65 THEN 'action_sfx' WHEN u < 0.7 THEN 'sparse' ELSE 'balanced' END AS choice FROM u""")
def l7_weighted_choice(t):
    return lookups.weighted_choice(t("customer").select("c_custkey"), "c_custkey", SCENE_TYPES, "type")


@query(f"""WITH u AS (SELECT doc_id, {_HASH('doc_id')} AS u FROM documents) SELECT doc_id, CASE WHEN u < 0.8 THEN 'train' WHEN u < 0.9 THEN 'val' ELSE 'test' END AS split FROM u""")
def l11_split(t):
    return t("documents").select("doc_id", S.split_of(F.col("doc_id")).alias("split"))


@query("""SELECT u, count(*) AS n FROM (SELECT DISTINCT c_nationkey AS k, 'union' AS u FROM (SELECT c_nationkey FROM customer UNION SELECT s_nationkey FROM supplier) x(c_nationkey) UNION ALL
 SELECT c_nationkey, 'all' FROM customer UNION ALL SELECT s_nationkey, 'all' FROM supplier UNION ALL SELECT n_nationkey, 'minus' FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier)) GROUP BY u""")
def u_set_operations(t):
    c, s, n = t("customer").select(F.col("c_nationkey").alias("k")), t("supplier").select(F.col("s_nationkey").alias("k")), t("nation").select(F.col("n_nationkey").alias("k"))
    parts = c.unionByName(s).distinct().withColumn("u", F.lit("union")).unionByName(c.unionByName(s).withColumn("u", F.lit("all"))).unionByName(n.join(s, "k", "left_anti").withColumn("u", F.lit("minus")))
    return parts.groupBy("u").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {_E}, b AS (SELECT user_id, s // 43200 AS block, avg(x * x) * CASE WHEN s // 43200 % 3 = 0 THEN 1e-3 ELSE 1 END AS z FROM e GROUP BY user_id, s // 43200),
 l AS (SELECT user_id, z, -0.691 + 10 * log10(z) AS l FROM b), m AS (SELECT user_id, -0.691 + 10 * log10(avg(z)) - 10 AS gate FROM l WHERE l >= -70 GROUP BY user_id),
 k AS (SELECT user_id, -0.691 + 10 * log10(avg(z)) AS lufs FROM l JOIN m USING (user_id) WHERE l >= -70 AND l > gate GROUP BY user_id)
 SELECT user_id, round(coalesce(lufs, -70), 5) AS lufs FROM (SELECT DISTINCT user_id FROM e) LEFT JOIN k USING (user_id)""")
def a10_loudness_gate(t):
    block = F.floor(F.col("s") / 43200)
    z = F.avg(F.col("x") * F.col("x")) * F.when(F.col("block") % 3 == 0, 1e-3).otherwise(1.0)
    blocks = _events(t).withColumn("block", block).groupBy("user_id", "block").agg(z.alias("z"))
    return loudness.gated_loudness(blocks, ["user_id"]).withColumn("lufs", F.round("lufs", 5))


_REVERBS = ", ".join(f"('{n}', {r}::DOUBLE, {d}::DOUBLE, {w}::DOUBLE)" for n, r, d, w in dimensions.REVERBS)
_CLASSES = ", ".join(f"('{n}', {i})" for i, n in enumerate(dimensions.REVERB_CLASSES))
_MUSIC = ", ".join(f"('{n}', {i})" for i, n in enumerate(dimensions.MUSIC_CLASSES, 1))


@query(f"""WITH dim(preset, room_size, damping, wet) AS (VALUES {_REVERBS}),
 c AS (SELECT c_custkey, CASE c_nationkey % 5 WHEN 0 THEN 'cathedral' WHEN 1 THEN 'room' WHEN 2 THEN 'cellar' WHEN 3 THEN 'forest' END AS preset,
  CASE WHEN c_acctbal < 0 THEN 0.02::DOUBLE END AS amount FROM customer)
 SELECT c_custkey, d.room_size, d.damping, coalesce(amount, d.wet) AS wet_amount FROM c JOIN dim d ON d.preset = CASE WHEN c.preset IN (SELECT preset FROM dim) THEN c.preset ELSE 'medium_room' END""")
def j4_reverb_preset(t):
    k = F.col("c_nationkey") % 5
    preset = F.when(k == 0, "cathedral").when(k == 1, "room").when(k == 2, "cellar").when(k == 3, "forest")
    rows = t("customer").select("c_custkey", preset.alias("preset"), F.when(F.col("c_acctbal") < 0, F.lit(0.02)).alias("amount"))
    return dimensions.with_reverb(rows, "preset", "amount").select("c_custkey", "room_size", "damping", "wet_amount")


@query(f"""WITH dim(name, code) AS (VALUES {_CLASSES}), c AS (SELECT c_custkey, c_nationkey % 6 AS k, CASE c_nationkey % 6 WHEN 0 THEN 'Plate' WHEN 1 THEN 'cathedral' WHEN 2 THEN 'none' WHEN 3 THEN 'small_room' END AS kind FROM customer)
 SELECT c_custkey, CAST(CASE WHEN k = 5 THEN 0 ELSE coalesce(code, 8) END AS INTEGER) AS reverb_class FROM c LEFT JOIN dim ON name = lower(kind)""")
def j11_reverb_class(t):
    k = F.col("c_nationkey") % 6
    kind = F.when(k == 0, "Plate").when(k == 1, "cathedral").when(k == 2, "none").when(k == 3, "small_room")
    return t("customer").select("c_custkey", dimensions.reverb_class(k != 5, kind).alias("reverb_class"))


@query(f"""WITH dim(name, code) AS (VALUES {_MUSIC}), e AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'Dark' WHEN 1 THEN 'dark ambient ' || event_type WHEN 2 THEN 'inTENSE' WHEN 3 THEN '' WHEN 4 THEN 'null' END AS tag FROM events),
 m AS (SELECT event_id, min(code) AS code FROM e JOIN dim ON contains(lower(tag), name) GROUP BY event_id)
 SELECT event_id, CAST(CASE WHEN tag IS NULL OR tag = '' THEN 0 ELSE coalesce(d.code, m.code, 15) END AS INTEGER) AS music_class FROM e LEFT JOIN m USING (event_id) LEFT JOIN dim d ON d.name = lower(tag)""")
def j12_music_class(t):
    k = F.col("event_id") % 6
    tag = F.when(k == 0, "Dark").when(k == 1, F.concat(F.lit("dark ambient "), F.col("event_type"))).when(k == 2, "inTENSE").when(k == 3, "").when(k == 4, "null")
    return t("events").select("event_id", dimensions.music_class(tag).alias("music_class"))
