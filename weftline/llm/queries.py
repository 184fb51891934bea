"""The queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe, chat, decontaminate, language, linededup, neighbours, pii, simhash, tokenfile, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.digest(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(_table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.digest(_table(spark, sf_dir, "documents"))


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.digest(_table(spark, sf_dir, "embeddings"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "pages"))


def op7_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(_table(spark, sf_dir, "documents"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digest(_table(spark, sf_dir, "conversations"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (op1_decontamination, op2_token_files, op3_simhash, op4_line_dedup, op5_nearest, op6_language, op7_surrogates, op8_chat, op9_bpe, op10_toxicity)}
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = rf"regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_ESCAPED = r"regexp_replace({}, '[{}]', 'xx', 'g')"

ORACLE_SQL: dict[str, str] = {
    "op1_decontamination": rf"""
        WITH d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
        b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
        bw AS (SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0)),
        dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d CROSS JOIN (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
        m AS (SELECT doc_id, i, n, item FROM dw JOIN bw USING (n, g)),
        h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
        t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)""",
    "op8_chat": rf"""
        WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
            CAST(sum(15 + length({_ESCAPED.format('role', chr(92) * 2 + '#<:')}) + length({_ESCAPED.format('text', chr(92) * 2 + '#<')})) AS BIGINT) AS formatted_chars, false AS rewrites
        FROM c GROUP BY conv_id""",
}
