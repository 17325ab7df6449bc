"""Queries that write files from the tables into the shared folder, read them back through the sources and say what was read."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from wavequill.operators import lookups
from wavequill.plans.queries import _E, query
from wavequill.plans.signal_queries import _blocks, _samples
from wavequill.sinks import committed, files
from wavequill.sources import documents
from wavequill.sources.sound import sound
from wavequill.storage import shared_folder

RATE = 8000


def _folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _written_sound(t) -> str:
    """One file a user, a sample an event."""
    blocks = _blocks(_samples(t).withColumn("x", F.col("x") * 0.8 - 0.4))
    root = _folder(blocks.sparkSession, "sound")
    committed.save_waves(blocks.withColumn("path", F.concat(F.lit("u"), "user_id", F.lit("/events.wav"))), root, RATE)
    return root


_USER = lambda c: F.regexp_extract(c, r"/u(\d+)/", 1).cast("long")


@query(f"""WITH {_E}, q AS (SELECT user_id, least(greatest(round_even((x * 0.8 - 0.4) * 32768, 0), -32768), 32767) AS l, least(greatest(round_even((x * 0.8 - 0.4) * -0.5 * 32768, 0), -32768), 32767) AS r FROM e)
 SELECT user_id, count(*) AS n, CAST(sum(l) AS BIGINT) AS left_sum, CAST(max(l) AS BIGINT) AS left_max, CAST(sum(r) AS BIGINT) AS right_sum FROM q GROUP BY user_id""")
def k1_sound_files(t):
    found = sound(t("events").sparkSession, _written_sound(t), rate=RATE)
    whole = lambda s: F.transform(s, lambda v: F.round(v * 32768).cast("long"))
    added = lambda s: F.aggregate(whole(s), F.lit(0).cast("long"), lambda a, v: a + v)
    each = found.select(_USER("path").alias("user_id"), F.size("left").cast("long").alias("n"), added("left").alias("l"), F.array_max(whole("left")).alias("m"), added("right").alias("r"))
    return each.groupBy("user_id").agg(F.sum("n").alias("n"), F.sum("l").alias("left_sum"), F.max("m").alias("left_max"), F.sum("r").alias("right_sum"))


@query(f"WITH {_E} SELECT user_id, count(*) / {RATE} AS seconds FROM e GROUP BY user_id")
def s3_durations(t):
    return documents.durations(t("events").sparkSession, _written_sound(t)).select(_USER("path").alias("user_id"), "seconds")


@query(f"WITH {_E}, c AS (SELECT user_id, count(*) AS n FROM e GROUP BY user_id) SELECT user_id, n - 40 AS n FROM c WHERE n > 40")
def s13_sliced_files(t):
    """What lies behind the first 40 samples of every file, of which nothing else is read."""
    found = documents.wave_blocks(t("events").sparkSession, _written_sound(t), RATE, start=40 / RATE).filter("block_no IS NOT NULL")
    return found.groupBy(_USER("path").alias("user_id")).agg(F.sum(F.size("left")).cast("long").alias("n"))


def _suppliers(t):
    return t("supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("scene_name"), "s_suppkey", "s_nationkey", "s_acctbal")


@query("""SELECT 's' || s_suppkey AS scene_name, true AS has_metadata, s_suppkey % 3 = 0 AS has_linear, CASE WHEN s_nationkey % 2 = 0 THEN 'sparse' ELSE 'balanced' END AS scene_type, CASE WHEN s_suppkey % 4 <> 0 THEN 'tag ' || s_nationkey END AS music_tag, s_acctbal AS stored_error FROM supplier""")
def s10_scene_documents(t):
    scenes = _suppliers(t)
    root = _folder(scenes.sparkSession, "scenes")
    tag = F.when(F.col("s_suppkey") % 4 != 0, F.concat(F.lit("tag "), "s_nationkey"))
    document = F.struct(F.when(F.col("s_nationkey") % 2 == 0, "sparse").otherwise("balanced").alias("scene_type"), F.struct(F.struct(tag.alias("music_tag")).alias("gemini_context")).alias("scene_plan"), F.struct(F.struct(F.col("s_acctbal").alias("additivity_error")).alias("linear")).alias("outputs"))
    files.write_documents(scenes, root, "metadata.json", document)
    committed.save_files(scenes.filter("s_suppkey % 3 = 0").select(F.concat("scene_name", F.lit("/linear/mix.raw")).alias("path"), F.lit("x").alias("content")), root)
    found = documents.scene_documents(scenes.sparkSession, root)
    return found.select("scene_name", "has_metadata", "has_linear", "scene_type", "music_tag", "stored_error")


@query("""SELECT 's' || s_suppkey AS scene_name, CASE WHEN s_suppkey % 5 <> 0 THEN 'd' || s_nationkey || '.wav' END AS dialogue, CAST(s_suppkey % 4 AS INTEGER) AS n_events, CASE WHEN s_suppkey % 4 > 0 THEN 0.5::DOUBLE * (s_suppkey % 4 - 1) END AS last_time FROM supplier""")
def s12_plan_documents(t):
    scenes = _suppliers(t)
    root = _folder(scenes.sparkSession, "plans")
    events = F.transform(F.filter(F.sequence(F.lit(0), F.lit(2)), lambda i: i < F.col("s_suppkey") % 4), lambda i: F.struct(F.concat(F.lit("e"), i, F.lit(".wav")).alias("file_path"), (i * 0.5).alias("timestamp")))
    document = F.struct(F.struct("scene_name").alias("job"), F.struct(F.when(F.col("s_suppkey") % 5 != 0, F.concat(F.lit("d"), "s_nationkey", F.lit(".wav"))).alias("dialogue"), events.alias("events")).alias("plan"))
    files.write_documents(scenes, root, "plan.json", document)
    found = documents.plan_documents(scenes.sparkSession, root)
    return found.select("job.scene_name", "plan.dialogue", F.size("plan.events").alias("n_events"), F.array_max(F.transform("plan.events", lambda e: e["timestamp"])).alias("last_time"))


@query("""SELECT 's' || s_suppkey AS scene_name, stem, CAST(i AS DOUBLE) AS time, round(s_acctbal / (i + 1), 6) AS gain FROM supplier, (VALUES ('music', 0), ('music', 1), ('sfx', 0)) v(stem, i)""")
def s11_envelope_documents(t):
    scenes = _suppliers(t)
    root = _folder(scenes.sparkSession, "envelopes")
    frame = lambda i: F.struct(F.lit(float(i)).alias("time"), (F.col("s_acctbal") / (i + 1)).alias("gain"), F.lit(0.0).alias("gain_db"))
    curve = lambda *frames: F.struct(F.lit("").alias("description"), F.array(*frames).alias("keyframes"))
    document = F.struct(F.lit(48000).alias("sample_rate"), F.lit(1.0).alias("duration_sec"), F.struct(curve(frame(0), frame(1)).alias("music"), curve(frame(0)).alias("sfx")).alias("envelopes"))
    files.write_documents(scenes, root, "gain_envelope.json", document)
    found = documents.keyframes_of(documents.json_documents(scenes.sparkSession, f"{root}/*/gain_envelope.json", documents.ENVELOPES))
    return found.select(documents.scene_of(F.col("path")).alias("scene_name"), "stem", "time", F.round("gain", 6).alias("gain"))


@query("""SELECT c_nationkey AS dialogue_id, count(*) AS n, string_agg('/r/' || c_custkey || '.wav', ',' ORDER BY c_custkey) AS files FROM customer GROUP BY c_nationkey""")
def s6_corpus_indices(t):
    """An index file a segment, whose entries are put together to dialogues in the order of their numbers."""
    entry = F.struct(F.lit("train").alias("split"), F.col("c_nationkey").alias("dialogue_id"), F.col("c_custkey").cast("int").alias("utterance_id"), F.concat("c_custkey", F.lit(".wav")).alias("file"))
    rows = t("customer").groupBy("c_mktsegment").agg(F.collect_list(entry).alias("entries"))
    root = _folder(rows.sparkSession, "indices")
    committed.save_files(rows.select(F.concat("c_mktsegment", F.lit(".json")).alias("path"), F.to_json(F.struct("entries")).alias("content")), root)
    found = documents.dialogue_groups(documents.json_documents(rows.sparkSession, f"{root}/*.json", documents.MELD), "/r")
    return found.select("dialogue_id", F.size("utterances").cast("long").alias("n"), F.array_join(F.transform("utterances", lambda u: u["file"]), ",").alias("files"))


@query("""SELECT vec_id AS id, 'v/' || vec_id || '.wav' AS path, label, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 5) AS total FROM embeddings""")
def s9_vector_index(t):
    v = t("embeddings")
    root = _folder(v.sparkSession, "vectors")
    files.write_index(v.select(F.col("vec_id").alias("id"), F.concat(F.lit("v/"), "vec_id", F.lit(".wav")).alias("path"), F.col("embedding").alias("vec")), root)
    found = documents.vector_index(v.sparkSession, root).withColumn("total", F.round(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x), 5))
    return found.join(v.select(F.col("vec_id").alias("id"), "label"), "id").select("id", "path", "label", "total")


@query("""SELECT tag, count(DISTINCT p_brand) AS n, min(p_brand) AS first FROM (SELECT lower(trim(unnest(string_split(p_type, ' ')))) AS tag, p_brand FROM part) WHERE tag <> '' GROUP BY tag""")
def k7_tag_index(t):
    index = lookups.inverted_index(t("part"), F.split("p_type", " "), "p_brand")
    root = _folder(index.sparkSession, "tags")
    files.write_tag_lookup(index, root)
    found = index.sparkSession.read.schema("tag string, items array<string>").json(root)
    return found.select("tag", F.size("items").cast("long").alias("n"), F.col("items")[0].alias("first"))


@query("""SELECT 'u' || user_id || '/events.wav' AS file FROM events GROUP BY user_id""")
def s4_sound_files(t):
    found = documents.audio_files(t("events").sparkSession, _written_sound(t))
    return found.select(F.regexp_extract("file", r"u\d+/events\.wav$", 0).alias("file"))
