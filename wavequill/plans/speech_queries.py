"""Queries of speech corpora and samples, each with independent DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from wavequill.operators import speech
from wavequill.plans.queries import query

_WANTED = ["Anger", "joy", "happiness", "sadness", "fear", "surprise", "surprised", "disgust", "neutral", "calm", "angry", "bored", "fearful"]
_CLIPS = """c AS (SELECT o_orderkey AS clip, CASE o_orderkey % 3 WHEN 0 THEN 'ravdess' WHEN 1 THEN 'ased' ELSE 'expresso' END AS source, ['angry', 'happy', 'sad', 'fearful', 'calm'][o_orderkey // 3 % CASE WHEN o_orderkey % 3 = 1 THEN 4 ELSE 5 END + 1] AS emotion,
 'read/Ex_' || ['confused', 'DEFAULT', 'laughing', 'sad', 'whisper', 'disgusted', 'happy'][o_orderkey // 3 % 7 + 1] || '/f' || o_orderkey || '.wav' AS path, o_totalprice / 5000 AS duration FROM orders)"""


def _clips(t):
    k = F.col("o_orderkey")
    third = F.floor(k / 3)
    pick = lambda names, i: F.element_at(F.array(*map(F.lit, names)), (i + 1).cast("int"))
    felt = pick(["angry", "happy", "sad", "fearful", "calm"], third % F.when(k % 3 == 1, 4).otherwise(5))
    path = F.concat(F.lit("read/Ex_"), pick(["confused", "DEFAULT", "laughing", "sad", "whisper", "disgusted", "happy"], third % 7), F.lit("/f"), k, F.lit(".wav"))
    source = F.when(k % 3 == 0, "ravdess").when(k % 3 == 1, "ased").otherwise("expresso")
    return t("orders").select(k.alias("clip"), source.alias("source"), felt.alias("emotion"), path.alias("path"), (F.col("o_totalprice") / 5000).alias("duration"))


_MAPPED = lambda s: "CASE e " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in speech.SYNONYMS[s].items()) + " ELSE e END"
_STYLED = "CASE e " + " ".join(f"WHEN '{k}' THEN [{', '.join(repr(x) for x in v)}]" for k, v in speech.STYLES.items()) + " ELSE [e] END"


@query(f"""WITH {_CLIPS}, w AS (SELECT emotion, lower(emotion) AS e FROM (SELECT unnest([{', '.join(map(repr, _WANTED))}]) AS emotion)), r AS (SELECT * FROM c WHERE duration BETWEEN 40 AND 60),
 f AS (SELECT w.emotion, 1 AS p, source, clip, r.emotion AS label FROM w JOIN r ON source = 'ravdess' AND r.emotion = {_MAPPED('ravdess')} UNION ALL SELECT w.emotion, 2, source, clip, r.emotion FROM w JOIN r ON source = 'ased' AND r.emotion = {_MAPPED('ased')}
  UNION ALL SELECT s.emotion, 3, source, clip, s.style FROM (SELECT emotion, unnest({_STYLED}) AS style FROM w) s JOIN r ON source = 'expresso' AND contains(lower(path), s.style)),
 k AS (SELECT *, row_number() OVER (PARTITION BY emotion ORDER BY p, md5(clip || '/' || emotion), label) AS n FROM f)
 SELECT w.emotion, source, CAST(clip AS VARCHAR) AS clip, label FROM w LEFT JOIN k ON k.emotion = w.emotion AND n = 1""")
def j8_by_emotion(t):
    wanted = t("region").sparkSession.createDataFrame([(w,) for w in _WANTED], "emotion string")
    return speech.by_emotion(wanted, _clips(t), 40.0, 60.0).withColumn("clip", F.col("clip").cast("string"))


@query(f"""WITH {_CLIPS}, r AS (SELECT source, clip, duration, row_number() OVER (PARTITION BY source, emotion ORDER BY md5(CAST(clip AS VARCHAR))) AS n, emotion FROM c WHERE duration BETWEEN 20 AND 30) SELECT source, emotion, clip, round(duration, 6) AS duration FROM r WHERE n = 1""")
def l9_pick_in_range(t):
    return speech.pick_in_range(_clips(t), ["source", "emotion"], "clip", "duration", 20.0, 30.0).withColumn("duration", F.round("duration", 6))


@query("""WITH a AS (SELECT c_custkey, list_filter([CASE WHEN c_custkey % 2 = 0 THEN 'expresso' END, CASE WHEN c_custkey % 3 = 0 THEN 'ravdess' END, CASE WHEN c_custkey % 5 = 0 THEN 'ased' END], lambda x: x IS NOT NULL) AS s FROM customer)
 SELECT c_custkey, CASE WHEN len(s) > 0 THEN s[CAST(('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8))::BIGINT % len(s) + 1 AS INTEGER)] END AS source FROM a""")
def l12_random_source(t):
    k = F.col("c_custkey")
    available = F.array_compact(F.array(F.when(k % 2 == 0, "expresso"), F.when(k % 3 == 0, "ravdess"), F.when(k % 5 == 0, "ased")))
    return t("customer").select("c_custkey", speech.random_source(k, available).alias("source"))


@query(f"""WITH {_CLIPS}, r AS (SELECT *, row_number() OVER (PARTITION BY clip % 50 ORDER BY md5(CAST(clip AS VARCHAR))) AS n FROM c WHERE source = 'expresso' AND duration BETWEEN 15 AND 30)
 SELECT clip, path, 'expresso' AS source, string_split(path, '/')[2] AS emotion, string_split(path, '/')[2] AS style, round(duration, 6) AS duration_sec, 'speaker' AS speakers FROM r WHERE n = 1""")
def l13_dialogue_rows(t):
    c = _clips(t).filter("source = 'expresso'").select("clip", "path", "duration", (F.col("clip") % 50).alias("slot"))
    picked = speech.pick_in_range(c, ["slot"], "clip", "duration", 15.0, 30.0).select("clip")
    rows = speech.dialogue_rows(c.join(picked, "clip", "left_semi"), "expresso")
    return rows.select("clip", "path", "source", "emotion", "style", F.round("duration_sec", 6).alias("duration_sec"), F.array_join("speakers", ",").alias("speakers"))


_NONVERBAL = "n AS (SELECT p_partkey AS clip, unnest(CASE WHEN p_partkey % 10 = 0 THEN ['unknown'] ELSE [lower(p_type), split_part(p_name, ' ', 2)] END) AS nv_type, CASE p_partkey % 3 WHEN 0 THEN 'Happy' WHEN 1 THEN 'sad' END AS emotion, p_size / 5.0 AS duration FROM part)"


def _nonverbal(t):
    k = F.col("p_partkey")
    types = F.when(k % 10 != 0, F.array(F.lower("p_type"), F.split_part(F.col("p_name"), F.lit(" "), F.lit(2))))
    return speech.typed_clips(t("part").select(k.alias("clip"), types.alias("types"), F.when(k % 3 == 0, "Happy").when(k % 3 == 1, "sad").alias("emotion"), (F.col("p_size") / 5.0).alias("duration")), "types")


@query(f"WITH {_NONVERBAL} SELECT nv_type, count(*) AS n FROM n GROUP BY 1")
def s8_clips_by_type(t):
    return _nonverbal(t).groupBy("nv_type").agg(F.count(F.lit(1)).alias("n"))


_REQUESTS = [(1, "promo", None), (2, "prom", "HAPPY"), (3, None, "sad"), (4, "bolts and nuts", None), (5, "cough", None), (6, "large", "angry"), (7, None, None), (8, "unknown", "happy"), (9, "widget", "sad"), (10, "o", "sad")]
_VALUES = ", ".join(f"({i}, {'NULL' if a is None else repr(a)}, {'NULL' if b is None else repr(b)})" for i, a, b in _REQUESTS)


@query(f"""WITH {_NONVERBAL}, w(request, nv_type, emotion) AS (VALUES {_VALUES}), k AS (SELECT DISTINCT nv_type AS known FROM n),
 m AS (SELECT w.*, known, w.nv_type IS NULL OR w.nv_type IN (SELECT known FROM k) AS exact FROM w JOIN k ON w.nv_type IS NULL OR contains(known, w.nv_type) OR contains(w.nv_type, known)),
 u AS (SELECT * FROM m WHERE nv_type IS NULL OR NOT exact OR known = nv_type),
 c AS (SELECT u.request, u.known, n.clip, n.duration, row_number() OVER (PARTITION BY u.request ORDER BY md5(u.request || '/' || n.clip), u.known) AS place FROM u JOIN n ON n.nv_type = u.known AND (u.emotion IS NULL OR lower(u.emotion) = lower(coalesce(n.emotion, ''))))
 SELECT w.request, CAST((SELECT arg_min(clip, place) FROM c WHERE c.request = w.request AND place <= 20 AND duration BETWEEN 2 AND 6) AS VARCHAR) AS clip FROM w""")
def j10_nonverbal_clips(t):
    wanted = t("region").sparkSession.createDataFrame(_REQUESTS, "request int, nv_type string, emotion string")
    return speech.nonverbal_clips(wanted, _nonverbal(t), 2.0, 6.0).withColumn("clip", F.col("clip").cast("string"))


@query(f"""WITH {_NONVERBAL}, r AS (SELECT nv_type, clip, duration, row_number() OVER (PARTITION BY nv_type ORDER BY md5(CAST(clip AS VARCHAR))) AS n FROM n WHERE duration BETWEEN 4 AND 9) SELECT clip, 'nonverbal_' || nv_type AS style, round(duration, 6) AS duration FROM r WHERE n = 1""")
def l14_random_nonverbal(t):
    found = speech.pick_in_range(_nonverbal(t), ["nv_type"], "clip", "duration", 4.0, 9.0)
    return found.select("clip", F.concat(F.lit("nonverbal_"), "nv_type").alias("style"), F.round("duration", 6).alias("duration"))


@query("""WITH u AS (SELECT conv_id, turn, role, CASE turn % 3 WHEN 0 THEN 'joy' WHEN 1 THEN 'fear' ELSE 'neutral' END AS emotion, CASE WHEN (conv_id + turn) % 13 <> 0 THEN CAST(length(text) AS DOUBLE) / 4 END AS d FROM conversations),
 b AS (SELECT *, coalesce(sum(d + 0.25) OVER w, 0) AS before, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS place FROM u WHERE d IS NOT NULL WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
 k AS (SELECT * FROM b WHERE place = 1 OR before - 0.25 < 400), e AS (SELECT conv_id, emotion, count(*) AS n, min(place) AS f FROM k GROUP BY ALL), g AS (SELECT conv_id, emotion, row_number() OVER (PARTITION BY conv_id ORDER BY n DESC, f) AS r FROM e)
 SELECT k.conv_id, round(sum(d) + 0.25 * (count(*) - 1), 6) AS seconds, count(*) AS n, string_agg(DISTINCT role, ',' ORDER BY role) AS speakers, any_value(g.emotion) AS emotion FROM k JOIN g ON g.conv_id = k.conv_id AND r = 1 GROUP BY k.conv_id HAVING sum(d) + 0.25 * (count(*) - 1) >= 120""")
def w10_dialogues(t):
    k = F.col("turn") % 3
    seconds = F.when((F.col("conv_id") + F.col("turn")) % 13 != 0, F.length("text").cast("double") / 4)
    u = t("conversations").select("conv_id", "turn", "role", F.when(k == 0, "joy").when(k == 1, "fear").otherwise("neutral").alias("emotion"), seconds.alias("d"))
    found = speech.dialogues(u, ["conv_id"], ["turn"], "d", "role", "emotion", 0.25, 120.0, 400.0)
    return found.select("conv_id", F.round("seconds", 6).alias("seconds"), "n", F.array_join("speakers", ",").alias("speakers"), "emotion")


@query("""WITH c AS (SELECT o_custkey, o_orderkey, o_orderkey % 6 AS speaker, round(o_totalprice / 50000, 2) AS d, md5(CAST(o_orderkey AS VARCHAR)) AS h FROM orders WHERE o_orderkey % 19 <> 0),
 m AS (SELECT *, count(*) OVER (PARTITION BY o_custkey) > 8 AS many, row_number() OVER (PARTITION BY o_custkey, speaker ORDER BY h) AS own FROM c), p AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY h) AS place FROM m WHERE NOT many OR own = 1)
 SELECT o_custkey, string_agg(o_orderkey, ',' ORDER BY o_orderkey) AS clips, string_agg(DISTINCT speaker, ',' ORDER BY speaker) AS speakers, round(sum(d) + 0.15 * (count(*) - 1), 4) AS seconds FROM p WHERE place <= 4 GROUP BY 1 HAVING count(*) >= 2 AND round(sum(d) + 0.15 * (count(*) - 1), 4) >= 8""")
def w12_distinct_speakers(t):
    k = F.col("o_orderkey")
    c = t("orders").select("o_custkey", "o_orderkey", (k % 6).alias("speaker"), F.when(k % 19 != 0, F.round(F.col("o_totalprice") / 50000, 2)).alias("d"))
    found = speech.distinct_speakers(c, ["o_custkey"], "speaker", "o_orderkey", "d", least=8.0 - 1e-9)
    return found.select("o_custkey", F.array_join("clips", ",").alias("clips"), F.array_join("speakers", ",").alias("speakers"), F.round("seconds", 4).alias("seconds"))


@query("""SELECT c_nationkey, c_custkey % 4 AS part, count(DISTINCT c_mktsegment) AS actors FROM customer GROUP BY ALL HAVING count(DISTINCT c_mktsegment) >= 2""")
def a24_groups_of_actors(t):
    c = t("customer").withColumn("part", F.col("c_custkey") % 4)
    return speech.groups_of_actors(c, ["c_nationkey", "part"], "c_mktsegment")


@query("""WITH c AS (SELECT o_custkey, o_orderkey, round(o_totalprice) AS n, coalesce(sum(round(o_totalprice) + 4) OVER w, 0) AS "offset", sum(round(o_totalprice) + 4) OVER (PARTITION BY o_custkey) >= 700000 AS enough FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
 SELECT o_custkey, o_orderkey, "offset", least(n, 700000 - "offset") AS kept, enough FROM c WHERE "offset" < 700000""")
def w9_built_to_length(t):
    clips = t("orders").select("o_custkey", "o_orderkey", F.round("o_totalprice").alias("n"))
    return speech.built_to(clips, ["o_custkey"], ["o_orderkey"], "n", 4.0, 700_000.0).select("o_custkey", "o_orderkey", "offset", "kept", "enough")


@query("""SELECT conv_id, string_agg(turn || role, ',' ORDER BY turn) AS utterances FROM conversations GROUP BY conv_id""")
def s7_ordered_groups(t):
    grouped = t("conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("u"))  # one dialogue's
    return grouped.select("conv_id", F.array_join(F.transform("u", lambda x: F.concat(x["turn"], x["role"])), ",").alias("utterances"))
