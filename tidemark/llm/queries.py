"""The registered queries of the operators in this folder, with SQL beside them where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    conversation_repair,
    decontamination,
    fingerprints,
    hamming_join,
    jaccard_join,
    language,
    mask_search,
    mixing,
    pii,
    quality,
    secrets,
    substrings,
    token_codes,
)
from tidemark.llm.common import crc_mod, table, written

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


@register("op1_quality")
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = written(quality.document_statistics(table(spark, sf_dir, "documents")), "quality-stats")
    model = quality.train(stats, quality.learnable(table(spark, sf_dir, "labels")))
    return quality.score_statistics(stats, model).select(
        "doc_id",
        F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= quality.ACCEPT).cast("int").alias("predicted"),
    )


@register("op2_secrets")
def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.digest(secrets.find_secrets(docs))


@register("op3_jaccard_join")
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP4_SQL = """
WITH d AS (SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') END AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS gram
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM d WHERE len(w) >= 13)),
low AS (SELECT gram, min(doc_id) AS first FROM win GROUP BY gram),
gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(i, i + 12)) AS k FROM win JOIN low USING (gram) WHERE doc_id > first),
cut AS (SELECT doc_id, list(k) AS ks FROM gone GROUP BY doc_id),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS k FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS kept FROM words ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(ks), 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id) LEFT JOIN kept USING (doc_id)"""


@register("op4_substrings", OP4_SQL)
def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@register("op5_language")
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False))
    model = language.train(docs.filter(crc_mod("doc_id", 4) != 2))
    return language.predict(docs, model).withColumn("held_out", held_out).select("doc_id", "held_out", "lang_pred", "score")


@register("op6_pii")
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.digest(pii.find_personal_data(docs))


@register("op7_token_codes")
def op7_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_codes.write_token_files(table(spark, sf_dir, "documents"), token_codes.token_folder(spark))
    return token_codes.read_digests(manifest)


# A word is a run of characters that are neither ASCII punctuation nor blanks, after lower-casing A-Z.
OP8_SQL = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS gram
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw USING (n, gram)),
words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS k FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""


@register("op8_decontamination", OP8_SQL)
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.sort_array(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


OP9_SQL = """
WITH RECURSIVE sized AS (
  SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) END AS size
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE (place - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS weight,
    2.0::DOUBLE * source_size AS bound FROM sources),
shares AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(bound) OVER (ORDER BY bound / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY bound / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
line AS (SELECT max(level) AS level FROM shares WHERE level * weight <= bound),
targets AS (
  SELECT source, source_size, CASE WHEN s.level * weight <= bound THEN least(l.level * weight, bound) ELSE bound END AS target
  FROM shares s, line l),
rated AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  (size * (floor(rate) + CASE WHEN ('0x' || substr(sha256('9:' || doc_id), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE
    < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM rated"""


@register("op9_mixing", OP9_SQL)
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


@register("op10_fingerprints")
def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fingerprints.digest(fingerprints.compare_with_edited(docs))


LOWERED = "translate(coalesce({x}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWERED.format(x="text")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS gram
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 2))) AS i FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)),
reach AS (SELECT doc_id, doc_id AS r FROM d UNION SELECT reach.doc_id, links.y FROM reach JOIN links ON links.x = reach.r),
least AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM least LEFT JOIN sizes USING (doc_id)"""


@register("op11_hamming_join", OP11_SQL)
def op11_hamming_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming_join.near_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


TERMS = f"regexp_extract_all({LOWERED.format(x='text')}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
OP12_SQL = f"""
WITH d AS (SELECT doc_id, {TERMS} AS w FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM d) GROUP BY ALL),
total AS (SELECT count(*) AS n, sum(len(w))::BIGINT AS l FROM d WHERE len(w) > 0),
asked AS (SELECT DISTINCT item_id, unnest({TERMS}) AS term FROM benchmark),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(n) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY term),
lengths AS (SELECT doc_id, 50 + (50 * len(w) * n) // l AS m FROM d, total),
scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM asked JOIN tf USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id) GROUP BY item_id, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 50"""


@register("op12_mask_search", OP12_SQL)
def op12_mask_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mask_search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# crc32 is taken byte by byte with its table; the repair is a recursion over rows with the best (cost, audit) of each
# state of (s?(ua)+)?: 0 nothing yet, 1 after s, 2 after u, 3 after a. ``t`` are the repaired lines.
OP13_SQL = """
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS tab),
given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT),
      lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 20 AS kind
  FROM conversations, crc),
hurt AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM given WHERE kind <> 0),
judged AS (
  SELECT *, substr(role, 1, 1) AS ini, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS rn,
    CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 1
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 THEN 2
      WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 3 ELSE 0 END AS fault
  FROM hurt),
pairs AS (SELECT *, lag(ini) OVER (PARTITION BY conv_id ORDER BY rn) AS before FROM judged),
counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
    count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
    count(*) FILTER (rn > 1 AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal
  FROM pairs GROUP BY conv_id),
made(q, q2, a, c, t) AS (VALUES (0, 0, '', 0, ''), (1, 1, '', 0, ''), (2, 2, '', 0, ''), (3, 3, '', 0, ''), (0, 2, 'I', 2, chr(10) || 'user:'),
  (1, 2, 'I', 2, chr(10) || 'user:'), (3, 2, 'I', 2, chr(10) || 'user:'), (2, 3, 'I', 2, chr(10) || 'assistant:'),
  (0, 3, 'II', 4, chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 3, 'II', 4, chr(10) || 'user:' || chr(10) || 'assistant:')),
edits AS (
  SELECT conv_id, rn, q, q AS q2, 'D' AS a, 3 AS c, '' AS t FROM judged, (VALUES (0), (1), (2), (3)) s(q)
  UNION ALL
  SELECT conv_id, rn, q, q2, 'R', 2 + CASE WHEN fault = 3 THEN 1 ELSE 0 END, chr(10) || name || ':' || text
  FROM judged, (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')) s(q, q2, name) WHERE fault IN (0, 3)
  UNION ALL
  SELECT conv_id, rn, q, q2, 'K', CASE WHEN fault = 3 THEN 1 ELSE 0 END, chr(10) || role || ':' || text
  FROM judged JOIN (VALUES (0, 1, 's'), (0, 2, 'u'), (1, 2, 'u'), (2, 3, 'a'), (3, 2, 'u'), (0, 0, ''), (1, 1, ''), (2, 2, ''), (3, 3, '')) s(q, q2, i) ON i = ini
  WHERE fault IN (0, 3)),
best AS (
  SELECT conv_id, 0::BIGINT AS rn, 0 AS q, {'c': 0, 'a': '', 't': ''} AS v FROM counted
  UNION ALL
  SELECT b.conv_id, e.rn, e.q2, min({'c': (b.v).c + m.c + e.c, 'a': (b.v).a || m.a || e.a, 't': (b.v).t || m.t || e.t})
  FROM best b JOIN made m ON m.q = b.q JOIN edits e ON e.conv_id = b.conv_id AND e.rn = b.rn + 1 AND e.q = m.q2 GROUP BY b.conv_id, e.rn, e.q2),
ended AS (
  SELECT b.conv_id, min({'c': (b.v).c + m.c, 'a': (b.v).a || m.a, 't': (b.v).t || m.t}) AS v
  FROM best b JOIN counted c ON c.conv_id = b.conv_id AND c.n = b.rn JOIN made m ON m.q = b.q AND m.q2 IN (0, 3) GROUP BY b.conv_id)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce((v).c, 0)::BIGINT AS cost, coalesce((v).a, '') AS audit,
  sha256(coalesce(substr((v).t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN counted USING (conv_id) LEFT JOIN ended USING (conv_id)"""


@register("op13_conversation_repair", OP13_SQL)
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(conversation_repair.damage(table(spark, sf_dir, "conversations")))
