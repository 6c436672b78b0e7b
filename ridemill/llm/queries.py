"""The corpus operators as named queries over the given tables, and their SQL for DuckDB."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .exact_dedup import exact_groups
from .filter_audit import filter_audit
from .frames import table
from .html_text import main_text
from .language_id import is_held_out, language_id
from .maxent_lm import lm_scores
from .packing import packed
from .periodic_runs import periodic_runs
from .quality_model import learned, quality_scores
from .quality_rules import quality_rules
from .sentencepiece_scan import round_trip
from .sharding import balanced_shards
from .simhash import simhash_components
from .substring_dedup import substring_dedup


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).drop("kept_text")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents")).drop("spans", "kept_text")


def op4_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op6_maxent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = is_held_out(5, 1)
    return lm_scores(table(spark, sf_dir, "documents"), ~held_out).withColumn("held_out", held_out)


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op9_balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = balanced_shards(table(spark, sf_dir, "documents"))
    return placed.withColumn("law", F.lit("rows")).withColumn("grown_shard", F.lit(None).cast("int"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = is_held_out(4, 2)
    return language_id(docs, docs.where(~held_out)).withColumn("held_out", held_out)


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = is_held_out(5, 0)
    weights = learned(docs.where(~held_out), labels.where(~held_out))
    return quality_scores(docs, weights).withColumn("held_out", held_out)


def planted_words(doc_id: int | None, body: bytes) -> list[bytes]:
    """The words of a text; in a tenth of the documents, told by the id, all from one word on repeat its first ones."""
    words = body.split()
    draw = zlib.crc32(str(doc_id).encode())
    if doc_id is None or draw % 10 or not words:
        return words
    turn, size = draw // 10, len(words)
    start = turn % size
    period = 1 + (size - start) // (3 + turn % 8)
    return words[:start] + [words[start + i % period] for i in range(size - start)]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents"), planted_words).drop("runs", "kept_text")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (
        op1_sentencepiece,
        op2_quality_rules,
        op3_substring_dedup,
        op4_simhash_components,
        op5_packing,
        op6_maxent_scores,
        op7_html_text,
        op8_exact_dedup,
        op9_balanced_shards,
        op10_language_id,
        op11_quality_classifier,
        op12_periodic_runs,
        op13_filter_audit,
    )
    return {query.__name__: query for query in named}


EXACT_DEDUP = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


SUBSTRING_DEDUP = r"""
WITH worded AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), starts AS (
    SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS place FROM worded WHERE len(words) >= 13
), windows AS (
    SELECT doc_id, place, min(doc_id) OVER (PARTITION BY list_slice(words, place, place + 12)) AS holder FROM starts
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(place, place + 13)) AS place FROM windows WHERE holder < doc_id
), lost AS (
    SELECT doc_id, list(place) AS places FROM gone GROUP BY doc_id
), kept AS (
    SELECT w.doc_id, len(w.words) AS n_words, coalesce(len(l.places), 0) AS n_removed,
           CASE WHEN l.places IS NULL THEN w.words
                ELSE list_filter(w.words, lambda word, i: NOT list_contains(l.places, i)) END AS words
    FROM worded w LEFT JOIN lost l ON w.doc_id = l.doc_id
)
SELECT doc_id, n_words, n_removed, sha256(array_to_string(words, ' ')) AS kept_sha256 FROM kept
"""


FILTER_AUDIT = r"""
WITH letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit
), orders AS (
    SELECT v.letter || w.letter || x.letter || y.letter || z.letter AS filter_order,
           [v.bit, w.bit, x.bit, y.bit, z.bit] AS bits
    FROM letters v
    JOIN letters w ON w.bit <> v.bit
    JOIN letters x ON x.bit NOT IN (v.bit, w.bit)
    JOIN letters y ON y.bit NOT IN (v.bit, w.bit, x.bit)
    JOIN letters z ON z.bit NOT IN (v.bit, w.bit, x.bit, y.bit)
), steps AS (
    SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS earlier
    FROM orders, (SELECT unnest(range(1, 6)) AS step)
), marks AS (
    SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS bad FROM labels GROUP BY doc_id
), texts AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), failures AS (
    SELECT part, doc_id,
           (len(words) < 200)::INT
           + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
           + 4 * (100 * (length(body) - length(regexp_replace(body, '[A-Z]', '', 'g'))) > 3 * length(body))::INT
           + 8 * regexp_matches(body, '[#$%&*|]')::INT
           + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY body), false)::INT AS mask
    FROM texts
), patterns AS (
    SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(bad, 0)) AS bad
    FROM failures LEFT JOIN marks USING (doc_id) GROUP BY part, mask
), counted AS (
    SELECT part, filter_order, step, bit,
           sum(CASE WHEN mask & (earlier | bit) = 0 THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN mask & bit <> 0 AND mask & earlier = 0 THEN n ELSE 0 END) AS removed,
           sum(CASE WHEN mask & bit <> 0 AND mask & earlier <> 0 THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN mask & bit <> 0 AND mask & earlier = 0 THEN good ELSE 0 END) AS good_lost,
           sum(CASE WHEN mask & bit <> 0 AND mask & earlier = 0 THEN bad ELSE 0 END) AS toxic_lost
    FROM patterns, steps GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM counted
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_substring_dedup": SUBSTRING_DEDUP, "op8_exact_dedup": EXACT_DEDUP, "op13_filter_audit": FILTER_AUDIT}
