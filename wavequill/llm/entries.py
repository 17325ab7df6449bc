"""The queries of the corpus operators, each over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavequill.llm import chat_format, exact_dedup, fill_in_middle, html_blocks, jaccard_join, language_id, media_columns, mixing, secret_scan, sentence_pieces, sharding, structure_repair, url_filters
from wavequill.llm.common import table

PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.filter_urls(table(spark, sf_dir, "pages"))


def op2_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = media_columns.as_media(table(spark, sf_dir, "documents"), F.coalesce("text", F.lit("")), ["doc_id"])
    return media_columns.media_features(stored, ["doc_id"])


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.fit_mixture(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), keep="largest")


def op5_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.encode_pieces(table(spark, sf_dir, "documents"), PIECE_MODEL)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # documents without an identifier are none of those held out
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    models = language_id.train(docs.filter(~held_out))
    return language_id.identify(docs, models).withColumn("held_out", held_out).select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.stratified_shards(table(spark, sf_dir, "documents"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_components(table(spark, sf_dir, "documents"), words=3, num=90)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_blocks.extract(pages, html_blocks.train(pages))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents"), outputs=False)


def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure_repair.repair(structure_repair.damaged(table(spark, sf_dir, "conversations")), present="present")


#: what a user and an assistant say in the added conversation, to get out of their turns
SAYS = "\\### Assistant: </turn> ok"


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-7, 0, "user", SAYS), (-7, 1, "assistant", SAYS)], "conv_id long, turn long, role string, text string")
    return chat_format.read_back(chat_format.formatted(conversations.unionByName(added)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_url_filters, op2_media_columns, op3_mixing, op4_exact_dedup, op5_sentence_pieces, op6_language_id, op7_sharding, op8_jaccard_join, op9_secret_scan, op10_html_extraction,
        op11_fill_in_middle, op12_structure_repair, op13_chat_format,
    )
}

_RULE_ROWS = ", ".join(f"('{a}', '{h}', '{p}', '{h}{p}')" for a, h, p in url_filters.RULES)
_LISTED = ", ".join(f"('{h}')" for h in url_filters.LISTED_HOSTS)

_SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _step(role: str, *before: tuple[str, int]) -> str:
    """The cheapest way to keep or rerole the row r as `role`, with turns inserted after the role before it."""
    ways = [f"{{'c': s.{b}.c + {3 * n} + r.x + CASE WHEN r.i = '{role}' THEN 0 ELSE 3 END + CASE WHEN r.go THEN 1000000000 ELSE 0 END, 't': s.{b}.t || '{'I' * n}' || CASE WHEN r.i = '{role}' THEN 'K' ELSE 'R' END}}" for b, n in before]
    return f"least({', '.join(ways)})"


ORACLE_SQL = {
    "op1_url_filters": f"""
        WITH rules(action, rhost, rpath, rule) AS (VALUES {_RULE_ROWS}), listed(lhost) AS (VALUES {_LISTED}),
        cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
        split AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM cut),
        urls AS (SELECT page_id, translate(raw, '{url_filters.UPPER}', '{url_filters.LOWER}') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM split),
        fits AS (SELECT u.page_id, u.host, u.path, arg_max(r.rule, length(r.rule)) AS rule, arg_max(r.action, length(r.rule)) AS action
                 FROM urls u LEFT JOIN rules r ON (u.host = r.rhost OR ends_with(u.host, '.' || r.rhost)) AND starts_with(u.path, r.rpath) GROUP BY ALL)
        SELECT page_id, host, path, rule, coalesce(action, CASE WHEN EXISTS (SELECT 1 FROM listed WHERE fits.host = lhost OR ends_with(fits.host, '.' || lhost)) THEN 'block' ELSE 'allow' END) AS verdict FROM fits""",
    "op4_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
    "op8_jaccard_join": """
        WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        sets AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM words),
        sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
        shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
        links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common >= 90 * (x.n + y.n - common)),
        reach AS (SELECT a AS doc_id, a AS other FROM links UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
        SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(r.component_id, d.doc_id) AS component_id
        FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) r USING (doc_id)""",
    "op11_fill_in_middle": """
        WITH u AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS u FROM documents),
        d AS (SELECT *, CAST(len(u) AS BIGINT) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS c1, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS c2, ('0x' || h[25:32])::BIGINT % 100 < 50 AS spm, t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') AS plain FROM u),
        p AS (SELECT *, array_to_string(u[1:least(c1, c2)], '') AS pre, array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS mid, array_to_string(u[greatest(c1, c2) + 1:], '') AS suf FROM d)
        SELECT doc_id, n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form, CASE WHEN NOT plain THEN CAST(length(pre) AS BIGINT) END AS prefix_chars, CASE WHEN NOT plain THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
               sha256(CASE WHEN plain THEN t WHEN spm THEN '<S>' || suf || '<P>' || pre || '<M>' || mid ELSE '<P>' || pre || '<S>' || suf || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256 FROM p""",
    "op12_structure_repair": f"""
        WITH c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
        w AS (SELECT *, xor(list_reduce(list_transform(string_split(k, ''), lambda x: ord(x)::BIGINT), lambda crc, b: list_reduce(range(8), lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, xor(crc, b)), 4294967295), 4294967295) % 20 AS way FROM c),
        r AS (SELECT conv_id, turn, CASE WHEN way = 4 THEN 'user' ELSE role END AS role, CASE way WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN way = 3 THEN 2 ELSE 1 END)) AS copy FROM w WHERE way <> 0),
        o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(role || chr(10) || text), copy) AS j, rtrim(text, {_SPACES}) AS bare FROM r),
        f AS (SELECT *, bare = '' AS blank, bare <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY j) > 1 AS dup FROM o),
        g AS (SELECT *, NOT blank AND NOT dup AND right(bare, 1) NOT IN ('.', '!', '?') AS cut, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY j) || left(role, 1) AS pair FROM f),
        a AS (SELECT conv_id, CASE WHEN max(turn) IS NULL THEN 0 ELSE max(turn) - min(turn) + 1 - count(DISTINCT turn) END AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate, count(*) FILTER (cut) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
              list({{'i': left(role, 1), 'go': blank OR dup, 'x': CASE WHEN cut THEN 3 ELSE 0 END}} ORDER BY j) AS rows, list(role || ':' ORDER BY j) AS roles, list(text ORDER BY j) AS texts FROM g GROUP BY conv_id),
        b AS (SELECT *, list_reduce(rows, lambda s, r: {{
                'n': {{'c': s.n.c + 4, 't': s.n.t || 'D'}},
                's': least({{'c': s.s.c + 4, 't': s.s.t || 'D'}}, {{'c': CASE WHEN r.i = 's' AND NOT r.go THEN s.n.c + r.x ELSE 1000000000 END, 't': s.n.t || 'K'}}),
                'u': least({{'c': s.u.c + 4, 't': s.u.t || 'D'}}, {_step("u", ("n", 0), ("s", 0), ("a", 0), ("u", 1))}),
                'a': least({{'c': s.a.c + 4, 't': s.a.t || 'D'}}, {_step("a", ("u", 0), ("n", 1), ("s", 1), ("a", 1))})}},
                {{'n': {{'c': 0::BIGINT, 't': ''}}, 's': {{'c': 1000000000::BIGINT, 't': ''}}, 'u': {{'c': 1000000000::BIGINT, 't': ''}}, 'a': {{'c': 1000000000::BIGINT, 't': ''}}}}) AS e FROM a),
        z AS (SELECT *, least(e.n, {{'c': e.s.c + 6, 't': e.s.t || 'II'}}, {{'c': e.u.c + 3, 't': e.u.t || 'I'}}, e.a) AS best FROM b),
        y AS (SELECT *, list_reduce(string_split(best.t, ''), lambda s, x: {{'j': s.j + CASE x WHEN 'I' THEN 0 ELSE 1 END,
                'r': CASE x WHEN 'D' THEN s.r WHEN 'K' THEN left(roles[s.j], 1) ELSE CASE s.r WHEN 'u' THEN 'a' ELSE 'u' END END,
                'v': CASE x WHEN 'D' THEN s.v ELSE s.v || [CASE x WHEN 'K' THEN roles[s.j] ELSE CASE s.r WHEN 'u' THEN 'assistant:' ELSE 'user:' END END || CASE x WHEN 'I' THEN '' ELSE texts[s.j] END] END}},
                {{'j': 1::BIGINT, 'r': '', 'v': []::VARCHAR[]}}) AS done FROM z)
        SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.t, '') AS audit,
               sha256(coalesce(array_to_string(done.v, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) i LEFT JOIN y ON y.conv_id IS NOT DISTINCT FROM i.conv_id""",
    "op13_chat_format": f"""
        WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL SELECT -7, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '{SAYS}' FROM (VALUES (0), (1)) v(i)),
        o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(role || chr(10) || text)) AS j FROM c),
        e AS (SELECT *, length(role || text) + 14 + length(regexp_replace(role || text, '[^\\\\]', '', 'g')) + length(regexp_replace(role, '[^:]', '', 'g')) + len(regexp_extract_all(text, '</turn>')) + len(regexp_extract_all(role, '</turn>'))
                     + coalesce(list_sum(list_transform(regexp_extract_all(text, '#{{3,}}'), lambda x: length(x) - 2)), 0) + coalesce(list_sum(list_transform(regexp_extract_all(role, '#{{3,}}'), lambda x: length(x) - 2)), 0) AS chars FROM o)
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY j)) AS turns_sha256, CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY j) FILTER (role = 'assistant'), '')) AS loss_sha256, CAST(sum(chars) AS BIGINT) AS formatted_chars, count(*) FILTER (role = 'assistant') AS n_examples FROM e GROUP BY conv_id""",
}
