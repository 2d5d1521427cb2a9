"""One query for each operator, over its whole table, and the SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from poiloom.llm import html_text, mixing, near_dups, packing, phrases, quality, secrets, substrings, suffixes, warc


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_words(table(spark, sf_dir, "documents"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_classes(table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_warc_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op9_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.fingerprints(table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_seen(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_best_fit_packing,
        op2_secret_scan,
        op3_source_mixing,
        op4_near_dedup,
        op5_substring_dedup,
        op6_html_extraction,
        op7_quality_rules,
        op8_warc_packages,
        op9_document_fingerprints,
        op10_suffix_dedup,
    )
    return {f.__name__: f for f in own}


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

MIXING_SQL = f"""
WITH sized AS (SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size FROM documents),
sums AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS k FROM sized GROUP BY source),
weighed AS (SELECT *, CASE (k - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, CAST(sum(source_size) OVER () AS BIGINT) AS total FROM sums),
filled AS (
  SELECT *, CAST(sum(source_size) OVER up AS BIGINT) - source_size AS size_below, CAST(sum(weight) OVER up AS BIGINT) - weight AS weight_below, CAST(sum(weight) OVER () AS BIGINT) AS weights
  FROM weighed WINDOW up AS (ORDER BY source_size / weight, k ROWS UNBOUNDED PRECEDING)),
capped AS (SELECT *, (total - {mixing.MOST} * size_below) * weight > {mixing.MOST} * source_size * (weights - weight_below) AS full_ FROM filled),
open_ AS (SELECT *, total - {mixing.MOST} * coalesce(CAST(sum(CASE WHEN full_ THEN source_size END) OVER () AS BIGINT), 0) AS rest, weights - coalesce(CAST(sum(CASE WHEN full_ THEN weight END) OVER () AS BIGINT), 0) AS shared FROM capped),
goals AS (SELECT source, source_size, CASE WHEN full_ THEN CAST({mixing.MOST} * source_size AS DOUBLE) ELSE CAST(rest * weight AS DOUBLE) / shared END AS target, CAST('0x' || substr(md5('{mixing.SEED}:' || coalesce('=' || source, '')), 1, {mixing.OFFSET_DIGITS}) AS BIGINT) / CAST({16**mixing.OFFSET_DIGITS} AS DOUBLE) AS shift FROM open_),
placed AS (SELECT *, CAST(row_number() OVER (PARTITION BY source ORDER BY size, doc_id) - 1 AS DOUBLE) AS place FROM sized),
both_ AS (SELECT p.*, g.source_size, g.target, g.shift, CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0 END AS rate FROM placed p JOIN goals g ON p.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target, CAST(floor((place + 1) * rate + shift) - floor(place * rate + shift) AS BIGINT) * size AS taken FROM both_
"""

REPEATS_SQL = f"""
WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) - {substrings.WINDOW} + 2)) AS i FROM w),
g AS (SELECT doc_id, i, array_to_string(ws[i : i + {substrings.WINDOW} - 1], ' ') AS words FROM p),
again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY words) AS n FROM g) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {substrings.WINDOW})) AS j FROM again),
each_ AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS j FROM w),
kept AS (SELECT e.doc_id, count(*) AS n, string_agg(e.ws[e.j], ' ' ORDER BY e.j) AS words FROM each_ e LEFT JOIN gone ON e.doc_id = gone.doc_id AND e.j = gone.j WHERE gone.j IS NULL GROUP BY e.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(kept.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.words, '')) AS kept_sha256 FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""


_FIVE_BITS = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(h, {5 * i + 1}, 5) AS BIGINT) >> {shift}) & 31)::INT, 1)" for i in range(8) for shift in (15, 10, 5, 0))

WARC_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
h AS (SELECT *, sha1(payload) AS h, min(page_id) OVER (PARTITION BY payload) AS first_id FROM p)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, {_FIVE_BITS} AS payload_digest,
  CASE WHEN first_id IS NULL OR page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to FROM h
"""


def oracle_sql() -> dict[str, str]:
    """The queries that SQL can express on whole tables; the others are tested against brute force."""
    return {"op3_source_mixing": MIXING_SQL, "op5_substring_dedup": REPEATS_SQL, "op8_warc_packages": WARC_SQL}
