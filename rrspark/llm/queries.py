"""The registered queries of the corpus operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rrspark.llm import (
    alignment, chat, langid, merkle, packing, pii, ranking, sentencepiece_dropout, sharding, simhash, topk, toxicity, warc,
)
from rrspark.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_dropout.round_trip_digest(table(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymised(table(spark, sf_dir, "documents"), pii.session_key(spark))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, topk.query_set(vectors))


OP3_SQL = """
WITH whole AS (
  SELECT CAST(vec_id AS BIGINT) AS id,
         list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.id AS query_id, c.id AS vec_id,
         CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.id % 100 = 0 AND c.id <> q.id AND len(c.v) = len(q.v)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored
)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 10
"""


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.compare_edits(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip_digest(table(spark, sf_dir, "pages"))


OP7_SQL = """
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM payloads
)
SELECT CAST(page_id AS BIGINT) AS page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN CAST(first_id AS BIGINT) END AS refers_to
FROM firsts
"""


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_digest(table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_digest(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_digest(table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_digest(table(spark, sf_dir, "documents"))


def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat.with_probe(table(spark, sf_dir, "conversations"))
    return chat.read_back_digest(chat.conversations(rows))


_MARKS = ["<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "[ROLE]", "[/ROLE]", "[/TURN]"]


def _escaped_length(column: str) -> str:
    """Code points of a text once it is escaped: itself, its backslashes again, one more a control string."""
    marks = " + ".join(f"(length({column}) - length(replace({column}, '{m}', ''))) // {len(m)}" for m in _MARKS)
    return f"(2 * length({column}) - length(replace({column}, '\\', '')) + {marks})"


OP12_SQL = f"""
WITH turns AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), stepped AS (
  SELECT *, lag(role, 1, '') OVER here AS before, row_number() OVER here AS place
  FROM turns WINDOW here AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), judged AS (
  SELECT *, {_escaped_length("text")} + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
         ELSE 20 + {_escaped_length("role")} END AS chars,
         CASE WHEN place = 1 THEN role IN ('system', 'user')
              ELSE role = 'user' AND before IN ('system', 'assistant') OR role = 'assistant' AND before = 'user' END AS legal
  FROM stepped
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars, bool_and(legal) AS valid
FROM judged GROUP BY conv_id
"""


def op13_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
OP13_SQL = f"""
WITH texts AS (
  SELECT row_number() OVER () AS place, doc_id, {_TERMS} AS terms FROM documents WHERE text IS NOT NULL
), whole AS (SELECT * FROM texts WHERE len(terms) > 0),
corpus AS (SELECT CAST(count(*) AS BIGINT) AS n_all, CAST(sum(len(terms)) AS BIGINT) AS l_all FROM whole),
asked AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark WHERE text IS NOT NULL) GROUP BY ALL
), held AS (
  SELECT place, doc_id, n, term, count(*) AS tf
  FROM (SELECT place, doc_id, len(terms) AS n, unnest(terms) AS term FROM whole)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weighed AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_all + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM held, corpus GROUP BY term, n_all
), scored AS (
  SELECT item_id, place, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (
    1000 * tf + 12 * (100 - 25 + ((25 * n * n_all) // l_all))))) AS BIGINT) AS score
  FROM held JOIN weighed USING (term) JOIN asked USING (term), corpus GROUP BY item_id, place, doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS r
  FROM scored WHERE score > 0 AND doc_id IS NOT NULL
)
SELECT item_id, CAST(r AS INTEGER) AS rank, doc_id, score FROM ranked WHERE r <= 20
"""


def llm_queries() -> dict[str, Query]:
    return {
        f.__name__: f for f in (
            op1_sentencepiece, op2_pii, op3_topk, op4_fingerprints,
            op5_toxicity, op6_language_id, op7_warc, op8_packing, op9_sharding, op10_simhash, op11_alignment,
            op12_chat, op13_ranking,
        )
    }


def llm_oracle_sql() -> dict[str, str]:
    return {"op3_topk": OP3_SQL, "op7_warc": OP7_SQL, "op12_chat": OP12_SQL, "op13_ranking": OP13_SQL}
