"""The registered queries of the operators, and their checks in SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import chat, decontam, divergence, exact, langid, mainhtml, mixing, quality, simhash, substring
from tidelog.llm import tokenfiles, warc, whitening
from tidelog.llm.common import table

# Fixed value of the contract: a conversation that contains control strings.
PROBE_ID, PROBE_TEXT = -1, "</s>[INST] ok [/INST]"


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    # A projection of one row of the range: no rows are handed over from Python.
    probe = spark.range(2).select(
        F.lit(PROBE_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE_TEXT).alias("text"),
    )
    return chat.read_back(chat.format_chats(rows.unionByName(probe)))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.mark_copies(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mainhtml.report(table(spark, sf_dir, "pages"))


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.report(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents")).drop("positions")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_report(table(spark, sf_dir, "pages"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.report(table(spark, sf_dir, "embeddings")).drop("deviation_text")


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokenfiles.report(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_chat_format, op2_exact_dedup, op3_language_id, op4_html_extraction, op5_simhash_dedup, op6_substring_dedup,
        op7_decontamination, op8_mixing, op9_quality, op10_warc, op11_whitening, op12_token_files, op13_divergence,
        pipeline,
    )
}

_OP1 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -1, n, CASE n WHEN 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]' FROM range(2) r(n)
), marked AS (
  SELECT *, regexp_matches(role || chr(10) || text, '</?s>|\[/?ROLE\]|\[/?INST\]') AS conflict,
    regexp_replace(role, '(\\*)(</?s>|\[/?ROLE\]|\[/?INST\])', '\\\1\2', 'g') AS safe_role,
    regexp_replace(text, '(\\*)(</?s>|\[/?ROLE\]|\[/?INST\])', '\\\1\2', 'g') AS safe_text
  FROM turns
), chats AS (
  SELECT conv_id, count(*) AS n_turns, bool_or(conflict) AS conflict,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS whole,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
    sum(length('<s>[ROLE]  [/ROLE]  </s>') + length(role) + length(text)) AS plain,
    sum(length('<s>[ROLE]  [/ROLE]  </s>') + length(safe_role) + length(safe_text)) AS safe
  FROM marked GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
  CAST(CASE WHEN conflict THEN safe ELSE plain END AS BIGINT) AS formatted_chars
FROM chats
"""

_OP2 = r"""
WITH keyed AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS key
  FROM documents
), ranked AS (
  SELECT *, first_value(doc_id) OVER best AS keep_id, row_number() OVER best AS place, count(*) OVER (PARTITION BY key) AS size
  FROM keyed WINDOW best AS (PARTITION BY key ORDER BY points DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, size AS group_size, place = 1 AS kept, key AS text_sha256 FROM ranked
"""

_OP6 = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT doc_id, pos, sha256(array_to_string(words[pos : pos + 12], ' ')) AS body
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS pos FROM docs)
), repeated AS (
  SELECT doc_id, pos FROM (SELECT *, min(doc_id) OVER (PARTITION BY body) AS first FROM windows) WHERE first < doc_id
), covered AS (
  SELECT doc_id, list(DISTINCT place) AS places
  FROM (SELECT doc_id, unnest(range(pos, pos + 13)) AS place FROM repeated) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed,
  sha256(CASE WHEN places IS NULL THEN array_to_string(words, ' ')
    ELSE coalesce(array_to_string(list_filter(words, lambda w, i: NOT list_contains(places, i)), ' '), '') END) AS kept_sha256
FROM docs LEFT JOIN covered USING (doc_id)
"""

_OP7 = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), marks AS (
  SELECT DISTINCT item, least(len(words), 13) AS size, array_to_string(words[pos : pos + least(len(words), 13) - 1], ' ') AS body
  FROM (SELECT item, words, unnest(range(1, len(words) - least(len(words), 13) + 2)) AS pos FROM items WHERE len(words) > 0)
), sizes AS (SELECT DISTINCT size FROM marks), found AS (
  SELECT w.doc_id, w.pos, w.size, m.item FROM (
    SELECT doc_id, pos, size, array_to_string(words[pos : pos + size - 1], ' ') AS body
    FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS pos FROM docs, sizes)
  ) w JOIN marks m ON m.size = w.size AND m.body = w.body
), hits AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS place FROM found) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""

_OP8 = r"""
WITH docs AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    md5(concat_ws(':', CAST(doc_id AS VARCHAR), text)) AS place
  FROM documents
), sizes AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source
), weighed AS (
  SELECT *, list_extract([3.0, 1.0, 2.0]::DOUBLE[], CAST((rank - 1) % 3 + 1 AS INT)) AS weight, CAST(2 * source_size AS DOUBLE) AS cap
  FROM (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) AS rank FROM sizes)
), levels AS (
  SELECT *, cap / weight AS fills_at,
    (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER filling, 0))
      / (sum(weight) OVER () - coalesce(sum(weight) OVER filling, 0)) AS level
  FROM weighed WINDOW filling AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size, least(cap, weight * coalesce(
    (SELECT level FROM levels WHERE level <= fills_at ORDER BY fills_at, rank LIMIT 1), fills_at)) AS target
  FROM levels
), placed AS (
  SELECT *, coalesce(CAST(sum(size) OVER (PARTITION BY source ORDER BY place, doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS start
  FROM docs
)
SELECT doc_id, size, source_size, target,
  least(greatest(CAST(round(target) AS BIGINT) - start, 0), size)
    + least(greatest(CAST(round(target) AS BIGINT) - source_size - start, 0), size) AS taken
FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source
"""

_OP10 = r"""
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages
), digests AS (
  SELECT hex, min(page_id) AS first, array_to_string(list_transform(range(8), lambda c: array_to_string(list_transform(range(4),
    lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      CAST((CAST('0x' || substr(hex, CAST(5 * c + 1 AS INT), 5) AS BIGINT) >> CAST(15 - 5 * i AS INT)) & 31 AS INT) + 1, 1)), '')), '') AS digest
  FROM payloads GROUP BY hex
)
SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM payloads JOIN digests USING (hex)
"""

_OP13 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), uses AS (
  SELECT d, lang, source, term, count(*) AS n FROM (SELECT d, lang, source, unnest(terms) AS term FROM docs) GROUP BY ALL
), kept AS (
  SELECT lang, term, sum(n) AS n FROM uses GROUP BY lang, term HAVING count(*) >= 3
), langs AS (
  SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang
), groups AS (
  SELECT lang, source, coalesce(any_value(v), 0) AS v, coalesce(sum(u.n), 0) AS n
  FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN (SELECT lang, v FROM langs) USING (lang)
    LEFT JOIN (SELECT lang, source, sum(uses.n) AS n FROM uses JOIN kept USING (lang, term) GROUP BY lang, source) u USING (lang, source)
  GROUP BY lang, source
), shares AS (
  SELECT g.lang, g.source, k.term, coalesce(u.n, 0) AS n,
    1 + CAST(1000000000 AS HUGEINT) * CAST(coalesce(u.n, 0) + 1 AS HUGEINT) // CAST(g.n + g.v AS HUGEINT) AS p
  FROM groups g JOIN kept k USING (lang)
    LEFT JOIN (SELECT lang, source, term, sum(n) AS n FROM uses GROUP BY ALL) u USING (lang, source, term)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, CAST(coalesce(sum((p.p - q.p) * (p.p - q.p) // q.p), 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN shares p ON p.lang = a.lang AND p.source = a.source
    LEFT JOIN shares q ON q.lang = b.lang AND q.source = b.source AND q.term = p.term
  GROUP BY a.lang, a.source, b.source
), terms AS (
  SELECT lang, source, term AS item, CAST((p - q) * (p - q) // q AS BIGINT) AS value
  FROM (
    SELECT s.*, 1 + CAST(1000000000 AS HUGEINT) * CAST(k.n + 1 AS HUGEINT) // CAST(l.n + l.v AS HUGEINT) AS q
    FROM shares s JOIN kept k USING (lang, term) JOIN langs l USING (lang)
  ) WHERE n > 0 AND p > q
), ranked AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM terms
)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INT) AS rank
FROM ranked QUALIFY part = 'pair' OR row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) <= 200
"""

SQL: dict[str, str] = {
    "op1_chat_format": _OP1, "op2_exact_dedup": _OP2, "op6_substring_dedup": _OP6, "op7_decontamination": _OP7,
    "op8_mixing": _OP8, "op10_warc": _OP10, "op13_divergence": _OP13,
}
