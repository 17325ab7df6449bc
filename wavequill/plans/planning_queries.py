"""Queries of scene types, settings, planning and reports, each with independent DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from wavequill.functions import scalars as S
from wavequill.operators import levels, lookups, planning, scene_types, settings
from wavequill.plans.queries import _E, _HASH, _LEVELS, SCENE_TYPES, SQL, _events, query

_quoted = lambda v: ("true" if v else "false") if isinstance(v, bool) else f"'{v}'" if isinstance(v, str) else f"{v}::DOUBLE" if isinstance(v, float) else str(v)
_DIM = "dim(scene_type, speech_prob, music_prob, ambience_prob, sfx_min, sfx_max, speech_offset, music_offset, ambience_offset, sfx_offset, duck_music, duck_sfx, focus) AS (VALUES " + ", ".join("(" + ", ".join(map(_quoted, row)) + ")" for row in scene_types.SCENE_TYPES) + ")"
_TYPED = f"""{_DIM}, c AS (SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN 'opera' WHEN c_custkey % 13 = 0 THEN NULL ELSE choice END AS named FROM ({SQL["l7_weighted_choice"]})),
 typed AS (SELECT c.c_custkey, c.named, dim.* FROM c JOIN dim ON dim.scene_type = CASE WHEN c.named IN (SELECT scene_type FROM dim) THEN c.named ELSE 'dialogue_heavy' END)"""


def _named(t):
    """Customers as scenes with a drawn type, some of an unknown one and some without."""
    k = F.col("c_custkey")
    drawn = lookups.weighted_choice(t("customer").select("c_custkey"), "c_custkey", SCENE_TYPES, "type")
    return drawn.select("c_custkey", F.when(k % 11 == 0, "opera").when(k % 13 == 0, None).otherwise(F.col("choice")).alias("named"))


def _typed(t):
    return scene_types.with_scene_type(_named(t).withColumn("scene_type", F.col("named")), "scene_type")


@query(f"WITH {_TYPED} SELECT c_custkey, scene_type, sfx_min, sfx_max, duck_music, duck_sfx, focus FROM typed")
def j16_scene_type(t):
    return _typed(t).select("c_custkey", "scene_type", "sfx_min", "sfx_max", "duck_music", "duck_sfx", "focus")


@query(f"""WITH {_TYPED}, o AS (UNPIVOT (SELECT c_custkey, speech_offset AS speech, music_offset AS music, ambience_offset AS ambience, sfx_offset AS sfx FROM typed) ON speech, music, ambience, sfx INTO NAME stem VALUE "offset"),
 b AS (SELECT o.*, CASE WHEN stem IN ('music', 'sfx') THEN -9.0::DOUBLE WHEN stem = 'speech' THEN round(c_acctbal) / 1000 END AS gain_db FROM o JOIN customer USING (c_custkey))
 SELECT c_custkey, stem, round(CASE WHEN "offset" = 0 THEN gain_db ELSE coalesce(gain_db, 0) + "offset" END, 6) + 0.0 AS gain_db FROM b""")
def j5_stem_settings(t):
    base = t("customer").select("c_custkey", F.explode(F.create_map(F.lit("music"), F.lit(-9.0), F.lit("sfx"), F.lit(-9.0), F.lit("speech"), F.round("c_acctbal") / 1000)).alias("stem", "gain_db"))
    found = settings.stem_settings(base, scene_types.stem_offsets(_typed(t), ["c_custkey"]), ["c_custkey"])
    return found.withColumn("gain_db", F.round("gain_db", 6) + 0.0)


@query("""WITH b AS (SELECT event_id, event_type, CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 7 = 0 THEN 'quiet' ELSE '-9.0' END AS gain, event_id % 5 <> 0 AS has, value FROM events),
 d AS (SELECT *, event_type IN ('view', 'click', 'error') AS has_gain, CASE event_type WHEN 'view' THEN CAST(round(value, 2) AS VARCHAR) WHEN 'click' THEN 'loud' END AS delta FROM b)
 SELECT event_id, round(CASE WHEN has_gain THEN coalesce(TRY_CAST(gain AS DOUBLE), 0) + coalesce(TRY_CAST(delta AS DOUBLE), 0) ELSE TRY_CAST(gain AS DOUBLE) END, 6) AS gain_db,
 CASE WHEN event_type = 'purchase' THEN '120' WHEN has THEN '80' END AS low_cut_hz, CASE WHEN event_type = 'click' THEN NULL WHEN has THEN 'room' END AS reverb, has OR event_type = 'click' AS names_reverb FROM d""")
def p9_settings_merge(t):
    k, kind = F.col("event_id"), F.col("event_type")
    gain = F.when(k % 7 == 0, "quiet").otherwise("-9.0")
    base = F.when(k % 5 != 0, F.create_map(F.lit("gain_db"), gain, F.lit("low_cut_hz"), F.lit("80"), F.lit("reverb"), F.lit("room")))
    text = lambda c: c.cast("string")
    delta = (
        F.when(kind == "view", F.create_map(F.lit("gain_db"), text(F.round("value", 2)))).when(kind == "click", F.create_map(F.lit("gain_db"), F.lit("loud"), F.lit("reverb"), text(F.lit(None))))
        .when(kind == "purchase", F.create_map(F.lit("low_cut_hz"), F.lit("120"))).when(kind == "error", F.create_map(F.lit("gain_db"), text(F.lit(None))))
    )
    m = t("events").select("event_id", settings.merged(base, delta).alias("m"))
    return m.select("event_id", F.round(F.try_element_at("m", F.lit("gain_db")).try_cast("double"), 6).alias("gain_db"), F.try_element_at("m", F.lit("low_cut_hz")).alias("low_cut_hz"), F.try_element_at("m", F.lit("reverb")).alias("reverb"), F.map_contains_key("m", F.lit("reverb")).alias("names_reverb"))


@query("""WITH e AS (SELECT event_id, value, event_id % 4 AS idx FROM events) SELECT event_id, CASE WHEN idx < 3 THEN CAST(idx * 2 AS VARCHAR) END AS gain_db FROM e""")
def j3_event_settings(t):
    known = F.create_map(*[x for i in range(3) for x in (F.lit(f"sfx_{i}"), F.create_map(F.lit("gain_db"), F.lit(str(2 * i))))])
    return t("events").select("event_id", F.try_element_at(settings.event_setting(known, F.col("event_id") % 4), F.lit("gain_db")).alias("gain_db"))


@query("""SELECT conv_id, string_agg(DISTINCT 'sfx_' || turn || '=0.0', ',' ORDER BY 'sfx_' || turn || '=0.0') AS events FROM conversations GROUP BY conv_id""")
def p24_fallback_settings(t):
    each = t("conversations").groupBy("conv_id").agg(F.collect_list("turn").alias("idx"))
    entries = F.transform(F.map_entries(settings.fallback_events(F.col("idx"))), lambda e: F.concat(e["key"], F.lit("="), F.element_at(e["value"], F.lit("gain_db"))))
    return each.select("conv_id", F.array_join(F.array_sort(entries), ",").alias("events"))


@query(f"""SELECT c_custkey, CASE WHEN {_HASH("c_custkey", "dry")} >= 0.15 THEN round(0.01::DOUBLE + 0.02::DOUBLE * {_HASH("c_custkey", "wet")}, 3) END AS wet_amount FROM customer""")
def l10_subtle_reverb(t):
    return t("customer").select("c_custkey", settings.subtle_reverb(F.col("c_custkey"))["wet_amount"].alias("wet_amount"))


@query(f"""WITH {_TYPED} SELECT c_custkey, {_HASH("c_custkey", "music")} < music_prob AS music, {_HASH("c_custkey", "ambience")} < ambience_prob AS ambience, CAST(sfx_min + floor({_HASH("c_custkey", "events")} * (sfx_max - sfx_min + 1)) AS INTEGER) AS n_events FROM typed""")
def l8_stems_and_events(t):
    k = F.col("c_custkey")
    return _typed(t).select("c_custkey", scene_types.includes(k, "music", F.col("music_prob")).alias("music"), scene_types.includes(k, "ambience", F.col("ambience_prob")).alias("ambience"), scene_types.event_count(k, F.col("sfx_min"), F.col("sfx_max")).alias("n_events"))


_SHARE = lambda c: f"CASE WHEN {c} >= 0.9 THEN 'always' WHEN {c} >= 0.5 THEN 'likely' WHEN {c} > 0 THEN 'rare' ELSE 'never' END"


@query(f"""WITH {_TYPED}, u AS (SELECT scene_type, any_value(speech_prob) AS s, any_value(music_prob) AS m, any_value(sfx_min) AS lo, any_value(sfx_max) AS hi, count(*) AS scenes FROM typed GROUP BY scene_type)
 SELECT scene_type, scenes, scene_type || ' [speech:' || {_SHARE("s")} || ', music:' || {_SHARE("m")} || ', sfx:' || lo || '-' || hi || ']' AS line FROM u""")
def p21_type_summaries(t):
    used = _typed(t).groupBy("scene_type", "speech_prob", "music_prob", "sfx_min", "sfx_max").agg(F.count(F.lit(1)).alias("scenes"))
    return used.select("scene_type", "scenes", scene_types.summary(F.col("scene_type"), F.col("speech_prob"), F.col("music_prob"), F.col("sfx_min"), F.col("sfx_max")).alias("line"))


_GUIDANCE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in scene_types.GUIDANCE.items())


@query(f"""WITH {_TYPED} SELECT c_custkey, CASE CASE WHEN c_custkey % 17 = 0 THEN 'none' ELSE focus END {_GUIDANCE} ELSE '' END AS text FROM typed""")
def p26_guidance(t):
    focus = F.when(F.col("c_custkey") % 17 == 0, "none").otherwise(F.col("focus"))
    return _typed(t).select("c_custkey", scene_types.guidance(focus).alias("text"))


@query(f"""WITH {_TYPED} SELECT c_custkey, CASE WHEN named IN (SELECT scene_type FROM dim) THEN named END AS parsed,
 CASE WHEN named IS NULL THEN 'unknown scene type null; valid: {", ".join(scene_types.NAMES)}' WHEN named NOT IN (SELECT scene_type FROM dim) THEN 'unknown scene type ''' || named || '''; valid: {", ".join(scene_types.NAMES)}' END AS error FROM typed""")
def p28_parsed_type(t):
    parsed, error = scene_types.parsed_type(F.col("named"))
    return _named(t).select("c_custkey", parsed.alias("parsed"), error.alias("error"))


@query(f"""WITH {_TYPED} SELECT c_custkey, CAST(greatest(coalesce(list_position(['dialogue_heavy', 'music_montage', 'ambient', 'action_sfx', 'sparse', 'balanced'], named), 0) - 1, 0) AS INTEGER) AS code FROM typed""")
def j17_type_code(t):
    return _named(t).select("c_custkey", scene_types.type_code(F.col("named")).alias("code"))


_USAGE = "u AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"


@query(f"""WITH {_USAGE}, p AS (SELECT event_id, CASE WHEN k % 3 = 0 THEN k WHEN k % 3 = 1 THEN k + 2 * k END AS first, CASE WHEN k % 2 = 0 THEN 7 * k END AS second FROM u)
 SELECT event_id, CAST(first AS DOUBLE) AS first, CAST(CASE WHEN first IS NULL AND second IS NULL THEN NULL ELSE coalesce(first, 0) + coalesce(second, 0) END AS DOUBLE) AS total FROM p""")
def p19_token_totals(t):
    k = F.get_json_object("props", "$.k").cast("int")
    e = t("events").select("event_id", k.alias("k"))
    used = lambda c: F.when(F.col("k") % 3 == 1, c)
    first = S.token_total(F.when(F.col("k") % 3 == 0, F.col("k")), used(F.col("k")), used(2 * F.col("k")))
    total = S.agents_total(first, F.when(F.col("k") % 2 == 0, 7 * F.col("k")))
    return e.select("event_id", first.cast("double").alias("first"), total.cast("double").alias("total"))


@query(f"""WITH {_E} SELECT event_id, round((abs(x) + abs(x - 0.7)) / 2, 6) AS mono FROM e""")
def a27_mono_level(t):
    return _events(t).select("event_id", F.round(S.mono_level(F.col("x"), F.col("x") - 0.7), 6).alias("mono"))


#: replies in all forms that models give; {n} is the turn
_REPLIES = ['```json\n{"turn": {n}}\n```', '```\n[{"turn": {n}}]\n```', 'Sure: {"turn": {n}} as asked', '[{"turn": {n}}]', '{"turn": {n}} and more', "```no line feed", "no braces", '  {"a": {"b": {n}}}\n', "} {", '```json\n{"open": {n}']
_CLEAN = ['{"turn": {n}}', '[{"turn": {n}}]', '{"turn": {n}}', '[{"turn": {n}}]', '{"turn": {n}} and more', "", "no braces", '{"a": {"b": {n}}}', "} {", '{"open": {n}']
_case = lambda rows: "CASE " + " ".join(f"WHEN k = {i} THEN replace('{r}', '{{n}}', CAST(turn AS VARCHAR))" for i, r in enumerate(rows)) + " ELSE '' END"


@query(f"""WITH c AS (SELECT conv_id, turn, (conv_id + turn) % {len(_REPLIES) + 1} AS k FROM conversations)
 SELECT conv_id, turn, {_case(_CLEAN)} AS json, coalesce(k IN (0, 2, 7), false) AS is_object FROM c""")
def p22_replies(t):
    k = (F.col("conv_id") + F.col("turn")) % (len(_REPLIES) + 1)
    reply = F.coalesce(*[F.when(k == i, F.replace(F.lit(r), F.lit("{n}"), F.col("turn").cast("string"))) for i, r in enumerate(_REPLIES)])
    found = t("conversations").select("conv_id", "turn", S.json_of_reply(reply).alias("json"))
    return found.withColumn("is_object", S.is_json_object(F.col("json")))


@query("""SELECT event_id, sound, round(coalesce(tm, 0), 2) AS timestamp FROM (SELECT event_id, CASE WHEN event_id % 9 = 0 THEN '' WHEN event_id % 10 = 0 THEN NULL ELSE event_type END AS sound, CASE WHEN event_id % 8 <> 0 THEN value / 7 END AS tm, CASE WHEN event_type <> 'signup' THEN 1 END AS match FROM events)
 WHERE sound <> '' AND match IS NOT NULL""")
def p14_clean_events(t):
    k = F.col("event_id")
    e = t("events").select("event_id", F.when(k % 9 == 0, "").when(k % 10 == 0, None).otherwise(F.col("event_type")).alias("sound"), F.when(k % 8 != 0, F.col("value") / 7).alias("timestamp"), F.when(F.col("event_type") != "signup", "f.wav").alias("path"))
    return planning.clean_events(e).select("event_id", "sound", "timestamp")


@query("""WITH f AS (SELECT DISTINCT CASE p_partkey % 3 WHEN 0 THEN '/srv/data/' WHEN 1 THEN '/srv/' ELSE '/srv/data/data/' END || 'p' || p_partkey % 40 || '.wav' AS file FROM part),
 w AS (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN './' WHEN 1 THEN 'data/' WHEN 2 THEN './data/' WHEN 3 THEN '/srv/data/' WHEN 4 THEN '' END || 'p' || (p_partkey * 7) % 47 || '.wav' AS path FROM part),
 b AS (SELECT *, CASE WHEN starts_with(path, './') THEN substr(path, 3) ELSE path END AS bare FROM w),
 a AS (SELECT *, '/srv/' || bare AS up, '/srv/data/' || bare AS down FROM b)
 SELECT p_partkey, path, CASE WHEN starts_with(path, '/') THEN (SELECT file FROM f WHERE file = path) WHEN starts_with(bare, 'data/') AND up IN (SELECT file FROM f) THEN up WHEN down IN (SELECT file FROM f) THEN down WHEN up IN (SELECT file FROM f) THEN up END AS file FROM a""")
def p16_asset_paths(t):
    k, say = F.col("p_partkey"), lambda c: c.cast("string")
    files = t("part").select(F.concat(F.when(k % 3 == 0, "/srv/data/").when(k % 3 == 1, "/srv/").otherwise("/srv/data/data/"), F.lit("p"), say(k % 40), F.lit(".wav")).alias("file"))
    start = F.when(k % 6 == 0, "./").when(k % 6 == 1, "data/").when(k % 6 == 2, "./data/").when(k % 6 == 3, "/srv/data/").when(k % 6 == 4, "")
    wanted = t("part").select("p_partkey", F.concat(start, F.lit("p"), say((k * 7) % 47), F.lit(".wav")).alias("path"))
    return planning.resolved_paths(wanted, files, "path", "/srv/data").select("p_partkey", "path", "file")


@query(f"""WITH {_E}, {_LEVELS}, s AS (SELECT user_id, stem, '  - ' || stem || ': loudness=N/A LUFS, LRA=N/A LU, peak=' || printf('%.1f', peak_db) || ' dBTP, RMS=' || printf('%.1f', rms_db) || ' dB, crest=' || printf('%.1f', peak_db - rms_db) || ' dB' AS line FROM l)
 SELECT user_id, string_agg(line, chr(10) ORDER BY stem) AS lines FROM s GROUP BY user_id""")
def p25_prompt_lines(t):
    found = levels.levels(_events(t).withColumnRenamed("event_type", "stem"), ["user_id", "stem"])
    none = F.lit(None).cast("double")
    lines = found.select("user_id", "stem", planning.measurement_line(F.col("stem"), none, none, F.col("peak_db"), F.col("rms_db"), F.col("crest_db")).alias("line"))
    return planning.prompt_lines(lines, ["user_id"], ["stem"], "line")


@query("""SELECT array_to_string(list_sort(list(tag)), ', ') AS tags FROM (SELECT DISTINCT p_brand || ' ' || p_type AS tag FROM part ORDER BY tag LIMIT 100)""")
def l5_first_tags(t):
    return planning.first_tags(t("part").select(F.concat_ws(" ", "p_brand", "p_type").alias("tag")), "tag")


_SCENES = """s AS (SELECT c_custkey AS scene, CASE WHEN c_custkey % 9 <> 0 THEN c_mktsegment END AS kind, CASE c_custkey % 4 WHEN 0 THEN 'Dark ambient' WHEN 1 THEN 'epic' WHEN 2 THEN '' END AS tag, c_custkey % 5 AS k FROM customer),
 v AS (SELECT o_custkey AS scene, CASE WHEN o_orderkey % 2 = 0 THEN 'music' ELSE 'sfx' END AS stem, max(o_totalprice / 1000) AS d FROM orders GROUP BY ALL),
 g AS (SELECT scene, string_agg(stem, '+' ORDER BY stem) AS ducked, max(d) AS d FROM v GROUP BY scene),
 a AS (SELECT s.scene, coalesce(kind, 'unknown') AS scene_type, CASE k WHEN 0 THEN 0 WHEN 1 THEN 6 WHEN 2 THEN 8 WHEN 3 THEN 0 ELSE 1 END AS speech_reverb, 0 AS music_reverb,
  CASE s.scene % 4 WHEN 0 THEN 3 WHEN 1 THEN 8 WHEN 2 THEN 0 ELSE 0 END AS music_class, coalesce(ducked, '') AS ducked, coalesce(d, 0) AS duration_sec FROM s LEFT JOIN g USING (scene))"""


def _scenes(t):
    k = F.col("c_custkey")
    text = lambda v: F.lit(v).cast("string")
    kind = F.when(k % 5 == 0, text(None)).when(k % 5 == 1, "Plate").when(k % 5 == 2, "cave").when(k % 5 == 4, "ROOM")
    reverbs = F.when(k % 5 != 3, F.create_map(F.lit("speech"), kind))
    scenes = t("customer").select(k.alias("scene"), F.when(k % 9 != 0, F.col("c_mktsegment")).alias("scene_type"), F.when(k % 4 == 0, "Dark ambient").when(k % 4 == 1, "epic").when(k % 4 == 2, "").alias("music_tag"), reverbs.alias("reverbs"))
    envelopes = t("orders").select(F.col("o_custkey").alias("scene"), F.when(F.col("o_orderkey") % 2 == 0, "music").otherwise("sfx").alias("stem"), (F.col("o_totalprice") / 1000).alias("duration_sec"))
    return planning.assembled(scenes, envelopes, ["scene"])


@query(f"WITH {_SCENES} SELECT scene, scene_type, speech_reverb, music_reverb, music_class, ducked, round(duration_sec, 6) AS duration_sec FROM a")
def j15_assembled_scenes(t):
    return _scenes(t).select("scene", "scene_type", "speech_reverb", "music_reverb", "music_class", F.array_join("ducked", "+").alias("ducked"), F.round("duration_sec", 6).alias("duration_sec"))


@query(f"WITH {_SCENES} SELECT count(*) AS scenes, count(*) FILTER (ducked <> '') AS with_ducking, count(*) FILTER (contains(ducked, 'music')) AS music, count(*) FILTER (contains(ducked, 'sfx')) AS sfx, round(sum(duration_sec) / 3600, 4) AS hours FROM a")
def a17_ducking_statistics(t):
    return planning.ducking_statistics(_scenes(t)).withColumn("hours", F.round("hours", 4))


@query("""SELECT k, resumed FROM (SELECT o_orderkey AS k, o_orderstatus = 'P' AS resumed FROM orders ORDER BY resumed DESC, k LIMIT 50)""")
def l4_limited_jobs(t):
    o = t("orders").select(F.col("o_orderkey").alias("k"), "o_orderstatus")
    return planning.limited(o.filter("o_orderstatus = 'P'").select("k"), o.filter("o_orderstatus <> 'P'").select("k"), 50, ["k"])


@query("""SELECT event_type, n, CAST(row_number() OVER (ORDER BY n DESC, event_type) AS INTEGER) AS place FROM (SELECT event_type, count(*) AS n FROM events GROUP BY 1)""")
def l3_by_count(t):
    return planning.by_count(t("events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n")), "n", "event_type")


@query("""SELECT o_custkey, count(*) FILTER (ok) AS uploaded, count(*) FILTER (NOT ok) AS failed, coalesce(sum(mb) FILTER (ok), 0) AS size_mb, count(*) FILTER (NOT ok) = 0 AS deletes FROM (SELECT o_custkey, o_orderstatus <> 'P' AS ok, round(o_totalprice) AS mb FROM orders) GROUP BY 1""")
def a23_upload_statistics(t):
    files = t("orders").select("o_custkey", (F.col("o_orderstatus") != "P").alias("ok"), F.round("o_totalprice").alias("size_mb"))
    return planning.upload_statistics(files, ["o_custkey"])


@query("""SELECT user_id, count(DISTINCT event_type) FILTER (event_type IN ('view', 'click', 'purchase')) = 3 AS complete FROM events GROUP BY user_id""")
def u4_all_present(t):
    found = t("events").groupBy("user_id").agg(F.collect_set("event_type").alias("present"))
    return found.select("user_id", planning.all_present(F.col("present"), ("view", "click", "purchase")).alias("complete"))


@query("""SELECT event_type, '  ' || event_type || ': ' || n AS line FROM (SELECT event_type, count(e.event_id) AS n FROM (VALUES ('view'), ('click'), ('purchase'), ('signup'), ('error'), ('none')) c(event_type) LEFT JOIN events e USING (event_type) GROUP BY 1) WHERE n > 0""")
def k8_report_lines(t):
    counts = lookups.class_counts(t("events").select("event_type"), "event_type", ["view", "click", "purchase", "signup", "error", "none"])
    return planning.count_lines(counts, "event_type", "n").select(F.regexp_extract("line", r"(\w+):", 1).alias("event_type"), "line")


# ---------------------------------------------------------------- whole reports

#: limits of the reports below; the strict ones are tighter
_LIMITS = {"v10_scene_reports": (1e-3, 0.0, 0.01), "v9_strict_reports": (1e-4, -0.5, 0.01)}
_STEM = "CASE event_type WHEN 'view' THEN 'speech' WHEN 'click' THEN 'music' WHEN 'purchase' THEN 'ambience' ELSE 'sfx' END"


def _report_sql(error: float, peak: float, dc: float, rms: float = -80.0) -> str:
    """Scenes are users; what a scene's files would tell is derived from the user's number and its events."""
    return f"""{_E}, t AS (SELECT user_id, {_STEM} AS stem, x * CASE WHEN user_id % 6 = 0 THEN 1e-5 ELSE 1 END AS x, x AS whole FROM e),
 l AS (SELECT user_id, stem, 20 * log10(sqrt(avg(x * x))) AS rms, abs(avg(whole)) / 50 AS dc, user_id % 29 = 0 AS bad, count(*) * 3000 AS zeros FROM t GROUP BY user_id, stem),
 s AS (SELECT DISTINCT user_id, user_id % 31 <> 0 AS meta, user_id % 37 <> 0 AS linear, CASE WHEN user_id % 5 = 0 THEN 0.0002 WHEN user_id % 7 = 0 THEN 0.02 END AS stored, -8.0 - user_id % 30 AS lufs, (user_id % 9 - 7) / 4.0 AS peak, CASE WHEN user_id % 8 <> 0 THEN user_id % 12 / 10000.0 END AS error, user_id % 10 <> 3 AS durations FROM e),
 m AS (SELECT user_id, stem, unnest([CASE WHEN bad THEN 'nan_or_inf' END, CASE WHEN dc > {dc} THEN 'dc_offset' END, CASE WHEN rms < {rms} AND stem NOT IN ('music', 'sfx') THEN 'silent' END, CASE WHEN zeros > 48000 THEN 'long_silence' END]) AS reason,
  bad OR dc > {dc} OR (rms < {rms} AND stem NOT IN ('music', 'sfx')) AS fails FROM l),
 f AS (SELECT user_id, 'corruption_' || stem || ':' || reason AS say, fails FROM m WHERE reason IS NOT NULL UNION ALL
  SELECT user_id, unnest([CASE WHEN coalesce(error, 1e9) >= {error} THEN 'additivity:sum_differs' END, CASE WHEN lufs < -35 THEN 'loudness:too_quiet' WHEN lufs > -10 THEN 'loudness:too_loud' END, CASE WHEN peak > {peak} THEN 'loudness:clipping' END, CASE WHEN NOT durations THEN 'duration:mismatch' END]), true FROM s UNION ALL
  SELECT user_id, CASE WHEN stored > {error} THEN 'additivity_stored:high' END, false FROM s),
 g AS (SELECT s.user_id, CASE WHEN NOT meta THEN 'metadata:missing' WHEN NOT linear THEN 'structure:missing' ELSE coalesce((SELECT string_agg(say, ',' ORDER BY say) FROM f WHERE f.user_id = s.user_id AND fails AND say IS NOT NULL), '') END AS errors,
  CASE WHEN meta AND linear THEN coalesce((SELECT string_agg(say, ',' ORDER BY say) FROM f WHERE f.user_id = s.user_id AND NOT fails AND say IS NOT NULL), '') ELSE '' END AS warnings, CASE WHEN meta AND linear THEN lufs END AS lufs, CASE WHEN meta AND linear THEN peak END AS peak, CASE WHEN meta AND linear THEN error END AS error FROM s)"""


def _reports(t, error: float, peak: float, dc: float):
    e, k = _events(t), F.col("user_id")
    stem = F.when(F.col("event_type") == "view", "speech").when(F.col("event_type") == "click", "music").when(F.col("event_type") == "purchase", "ambience").otherwise("sfx")
    users = e.select("user_id").distinct()
    found = levels.levels(e.withColumn("stem", stem).withColumn("x", F.col("x") * F.when(k % 6 == 0, 1e-5).otherwise(1.0)), ["user_id", "stem"])
    stems = found.select("user_id", "stem", "rms_db", (F.col("dc_offset") / F.when(k % 6 == 0, 1e-5).otherwise(1.0) / 50).alias("dc_offset"), (k % 29 == 0).alias("has_bad"), (F.col("n") * 3000).alias("longest"))
    stored = F.when(k % 5 == 0, 0.0002).when(k % 7 == 0, 0.02)
    scenes = users.select("user_id", (k % 31 != 0).alias("has_metadata"), (k % 37 != 0).alias("has_linear"), stored.alias("stored_error"), F.lit("sparse").alias("scene_type"))
    sums = users.select("user_id", F.when(k % 8 != 0, k % 12 / 10000.0).alias("error"))
    mixes = users.select("user_id", (-8.0 - k % 30).alias("lufs"), ((k % 9 - 7) / 4.0).alias("true_peak_db"))
    durations = users.select("user_id", (k % 10 != 3).alias("matches"))
    return levels.scene_reports(scenes, stems, sums, mixes, durations, ["user_id"], most_peak=peak, most_error=error, most_dc=dc)


def _said(found):
    text = lambda c: F.array_join(F.array_sort(F.transform(c, lambda x: F.concat_ws(":", x["check"], x["reason"]))), ",")
    return found.select("user_id", text("errors").alias("errors"), text("warnings").alias("warnings"), "is_valid")


for _name, _limits in _LIMITS.items():

    def _report(t, limits=_limits):
        return _said(_reports(t, *limits))

    _report.__name__ = _name
    query(f"WITH {_report_sql(*_limits)} SELECT user_id, errors, warnings, errors = '' AS is_valid FROM g")(_report)


@query(f"""WITH {_report_sql(*_LIMITS["v10_scene_reports"])}, c AS (SELECT split_part(unnest(string_split(errors, ',')), ':', 1) AS k FROM g WHERE errors <> ''), n AS (SELECT k, count(*) AS n FROM c GROUP BY k)
 SELECT count(*) AS total, count(*) FILTER (errors = '') AS valid, round(count(*) FILTER (errors = '') / count(*), 6) AS pass_rate, count(*) FILTER (errors <> '') AS invalid, count(*) FILTER (errors = '' AND warnings <> '') AS with_warnings,
 round(avg(lufs) FILTER (lufs <> 0), 6) AS lufs_mean, min(lufs) FILTER (lufs <> 0) AS lufs_min, max(lufs) FILTER (lufs <> 0) AS lufs_max, round(avg(peak) FILTER (peak <> 0), 6) AS peak_mean, max(peak) FILTER (peak <> 0) AS peak_max,
 round(avg(error), 8) AS additivity_mean, max(error) AS additivity_max, (SELECT string_agg(k || '=' || n, ',' ORDER BY k) FROM n) AS error_counts FROM g""")
def a15_report_roll_up(t):
    found = levels.report_roll_up(_reports(t, *_LIMITS["v10_scene_reports"]))
    counts = F.array_join(F.transform(F.map_entries("error_counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    rounded = {"pass_rate": 6, "lufs_mean": 6, "peak_mean": 6, "additivity_mean": 8}
    return found.select(*[F.round(c, rounded[c]).alias(c) if c in rounded else F.col(c) for c in found.columns if c != "error_counts"], counts.alias("error_counts"))


@query(f"""WITH {_report_sql(*_LIMITS["v10_scene_reports"])}, bad AS (SELECT user_id FROM g WHERE errors <> ''), h AS (SELECT CAST(row_number() OVER (ORDER BY user_id) AS INTEGER) AS place, '  - ' || user_id AS line FROM bad)
 SELECT place, line FROM h WHERE place <= 10 UNION ALL SELECT 11, '  ... and ' || (count(*) - 10) || ' more' FROM bad HAVING count(*) > 10""")
def l6_failed_head(t):
    return planning.failed_head(_reports(t, *_LIMITS["v10_scene_reports"]), "user_id")


@query(f"""WITH {_report_sql(*_LIMITS["v10_scene_reports"])} SELECT user_id, len(string_split(errors, ',')) AS error_count FROM g WHERE errors <> ''""")
def k6_failure_json(t):
    found = planning.failure_json(_reports(t, *_LIMITS["v10_scene_reports"]), "user_id")
    return found.select(F.get_json_object("json", "$.user_id").cast("long").alias("user_id"), F.get_json_object("json", "$.error_count").cast("long").alias("error_count"))
