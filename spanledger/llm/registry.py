"""Queries over the operators, with SQL where DuckDB can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanledger.llm.bpe import bpe_round_trip
from spanledger.llm.common import table
from spanledger.llm.conversations import repair_damaged
from spanledger.llm.disclosure import private_digest
from spanledger.llm.hard_negatives import hard_negatives
from spanledger.llm.language_model import score_texts
from spanledger.llm.mixing import MixTarget, mix_sources
from spanledger.llm.quality import score_quality
from spanledger.llm.secret_scan import scan_secrets
from spanledger.llm.simhash import near_duplicates
from spanledger.llm.token_files import token_files
from spanledger.llm.top_k import top_k
from spanledger.llm.toxicity import score_toxicity
from spanledger.llm.vector_join import near_vectors

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register


@query("op10_bpe")
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(table(spark, sf_dir, "documents"))


@query("op4_token_files")
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"))


@query("op7_secret_scan")
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


@query("op9_quality")
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op2_simhash")
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query(
    "op5_top_k",
    """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
    FROM embeddings WHERE list_aggregate(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)), 'bool_and')
), s AS (
    SELECT a.vec_id AS query_id, b.vec_id,
           CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), r AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
""",
)
def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


@query(
    "op8_near_vectors",
    """
WITH RECURSIVE v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
), u AS (
    SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS size FROM v
    WHERE list_aggregate(list_transform(e, lambda x: x IS NOT NULL AND isfinite(x)), 'bool_and')
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id
    WHERE a.size > 0 AND b.size > 0
      AND list_sum(list_transform(list_zip(a.e, b.e), lambda p: p[1] * p[2])) / (a.size * b.size) >= 0.9
), reach AS (
    SELECT vec_id AS a, vec_id AS b FROM v
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), least_of AS (
    SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = least_of.vec_id) AS n_links, component_id,
       vec_id = component_id AS kept
FROM least_of
""",
)
def op8_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


#: Weights at 98 percent of the largest entropy, all tokens once as budget.
MIX = MixTarget(entropy=0.98)


@query("op6_mixing")
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix_sources(docs, MIX).select(
        "doc_id", "source", F.col("mix_tokens").alias("n_tokens"), F.col("mix_copies").alias("copies"),
        F.col("mix_weight").alias("weight"),
    )


@query("op1_private_data")
def op1_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private_digest(table(spark, sf_dir, "documents"))


@query("op3_language_model")
def op3_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


@query("op13_toxicity")
def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(
    "op11_hard_negatives",
    """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
    FROM embeddings
    WHERE label IS NOT NULL
      AND list_aggregate(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)), 'bool_and')
), s AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
           CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
QUALIFY rank <= 10
""",
)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))


@query(
    "op12_conversation_repair",
    r"""
WITH RECURSIVE bits(i, k, v) AS (
    SELECT i, 0, CAST(i AS BIGINT) FROM range(256) r(i)
    UNION ALL
    SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8
), sums AS (
    SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8
), source AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           xor(list_reduce(
               list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                              lambda c: CAST(ascii(c) AS BIGINT)),
               lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8), CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS chance
    FROM conversations, sums
), damaged AS (
    SELECT conv_id, turn, CASE WHEN chance = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN chance = 1 THEN '' WHEN chance = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM source, range(CASE chance WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
           regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS spoken
    FROM damaged
), faulty AS (
    SELECT *, left(role, 1) AS initial,
           left(role, 1) IN ('s', 'u', 'a') AS known,
           CASE WHEN spoken = '' THEN 'b'
                WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'd'
                WHEN right(spoken, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
           lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY place) || left(role, 1) AS pair
    FROM placed
), counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
           count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
           count(*) AS n
    FROM faulty GROUP BY conv_id
), ins(state, letters, lines, cost, next) AS (
    VALUES (0, '', CAST([] AS VARCHAR[]), 0, 0), (0, 'I', ['user:'], 3, 2), (0, 'II', ['user:', 'assistant:'], 6, 3),
           (1, '', CAST([] AS VARCHAR[]), 0, 1), (1, 'I', ['user:'], 3, 2), (1, 'II', ['user:', 'assistant:'], 6, 3),
           (2, '', CAST([] AS VARCHAR[]), 0, 2), (2, 'I', ['assistant:'], 3, 3),
           (3, '', CAST([] AS VARCHAR[]), 0, 3), (3, 'I', ['user:'], 3, 2)
), reads(state, letter, initial, role, cost, next) AS (
    VALUES (0, 'K', 's', NULL, 0, 1), (0, 'K', 'u', NULL, 0, 2), (1, 'K', 'u', NULL, 0, 2), (2, 'K', 'a', NULL, 0, 3),
           (3, 'K', 'u', NULL, 0, 2), (0, 'R', NULL, 'user', 3, 2), (1, 'R', NULL, 'user', 3, 2),
           (2, 'R', NULL, 'assistant', 3, 3), (3, 'R', NULL, 'user', 3, 2), (0, 'D', NULL, NULL, 4, 0),
           (1, 'D', NULL, NULL, 4, 1), (2, 'D', NULL, NULL, 4, 2), (3, 'D', NULL, NULL, 4, 3)
), paths(conv_id, place, state, best) AS (
    SELECT conv_id, CAST(0 AS BIGINT), 0, {'cost': CAST(0 AS BIGINT), 'audit': '', 'lines': CAST([] AS VARCHAR[])} FROM counts
    UNION ALL
    SELECT p.conv_id, p.place + 1, r.next,
           min({'cost': p.best.cost + i.cost + r.cost + CASE WHEN f.fault = 't' AND r.letter <> 'D' THEN 3 ELSE 0 END,
                'audit': p.best.audit || i.letters || r.letter,
                'lines': list_concat(list_concat(p.best.lines, i.lines), CASE r.letter WHEN 'D' THEN CAST([] AS VARCHAR[])
                    WHEN 'K' THEN [f.role || ':' || f.text] ELSE [r.role || ':' || f.text] END)})
    FROM paths p
    JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.place = p.place + 1
    JOIN ins i ON i.state = p.state
    JOIN reads r ON r.state = i.next AND (r.initial IS NULL OR r.initial = f.initial)
    WHERE r.letter = 'D' OR f.fault NOT IN ('b', 'd')
    GROUP BY p.conv_id, p.place, r.next
), ended AS (
    SELECT p.conv_id, min({'cost': p.best.cost + i.cost, 'audit': p.best.audit || i.letters,
                           'lines': list_concat(p.best.lines, i.lines)}) AS best
    FROM paths p JOIN counts c ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND c.n = p.place
    JOIN ins i ON i.state = p.state AND i.next IN (0, 3)
    GROUP BY p.conv_id
)
SELECT s.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(best.cost, 0) AS BIGINT) AS cost,
       coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) s
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM s.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM s.conv_id
""",
)
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_damaged(table(spark, sf_dir, "conversations"))
