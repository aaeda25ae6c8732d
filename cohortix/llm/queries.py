"""The registered queries of this subpackage, with the SQL they are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import flac, htmltext, langid, lmscore, mixing, ngramjoin, packing, pii, quality, toxicity
from .common import table


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.score_documents(table(spark, sf_dir, "documents"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.plan(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.join(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op8_flac(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flac.read_media(flac.to_media(table(spark, sf_dir, "documents")))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = quality.apply_policy(quality.ledger(table(spark, sf_dir, "documents")), "full-1")
    base = F.col("failures").bitwiseAND(F.lit(quality.policy_mask("base-1"))) != 0
    return book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_pii": op3_pii,
    "op4_mixing": op4_mixing,
    "op5_ngram_join": op5_ngram_join,
    "op6_toxicity": op6_toxicity,
    "op7_language_id": op7_language_id,
    "op8_flac": op8_flac,
    "op9_html_text": op9_html_text,
    "op10_quality_rules": op10_quality_rules,
}

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLE_SQL: dict[str, str] = {
    # documents in the order of the keyed hash; the water level of the targets from the sources in the order of their ratios
    "op4_mixing": f"""WITH d AS (SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size, md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))) AS o FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS k FROM d GROUP BY source),
w AS (SELECT *, CAST(CASE k % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS weight, CAST(3 * source_size AS DOUBLE) AS f FROM s),
r AS (SELECT *, f / weight AS ratio, (sum(source_size) OVER () - coalesce(sum(f) OVER b, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level FROM w
  WINDOW b AS (ORDER BY f / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT *, CASE WHEN ratio <= level THEN f ELSE weight * (SELECT min_by(level, ratio) FROM r WHERE ratio > level) END AS target FROM r),
p AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS passes FROM t),
q AS (SELECT d.doc_id, d.size, p.source_size, p.target, p.passes, greatest(CAST(0 AS DOUBLE), p.target - p.passes * p.source_size) AS rest, sum(d.size) OVER (PARTITION BY d.source ORDER BY d.o, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size AS before
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, CAST((passes + CASE WHEN size > 0 AND before + size / 2 <= rest THEN 1 ELSE 0 END) * size AS BIGINT) AS taken FROM q""",
    "op10_quality_rules": rf"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
win AS (SELECT r, unnest(range(1, len(w) - 3)) AS i, w FROM d WHERE len(w) >= 5),
keyed AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS k FROM win),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS n FROM keyed) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT i + o) AS n_repeat_words FROM again, range(5) t(o) GROUP BY r),
lines AS (SELECT r, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')) AS l FROM d),
m AS (SELECT d.r, doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[ 	-
]', '', 'g')) AS BIGINT) AS word_chars, CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, length(regexp_replace(text, '[^\p{{Lu}}]', '', 'g')) AS n_upper,
  length(regexp_replace(text, '[^\p{{L}}]', '', 'g')) AS n_letters, length(regexp_replace(text, '[^!]', '', 'g')) AS n_exclamations FROM d JOIN lines USING (r) LEFT JOIN rep USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, NOT ({" OR ".join(f"({sql})" for _, sql in quality.RULES.values())}) AS kept FROM m""",
}
