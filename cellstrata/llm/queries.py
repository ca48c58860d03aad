"""The registered queries of the text operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import decontam, htmlextract, license, mixing, quality, secretscan, sharding, simhash, suffixdedup, tokencount
from .common import table


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measures(table(spark, sf_dir, "documents"))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.digest(table(spark, sf_dir, "documents"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.digest(table(spark, sf_dir, "documents"))


def op10_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.digest(table(spark, sf_dir, "documents"))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.digest(table(spark, sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmlextract.extract(table(spark, sf_dir, "pages"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(table(spark, sf_dir, "documents"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(table(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_secret_scans": op3_secret_scans,
    "op4_suffix_array_dedup": op4_suffix_array_dedup,
    "op5_html_extraction": op5_html_extraction,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_source_mixing": op7_source_mixing,
    "op8_sharding": op8_sharding,
    "op9_quality_rules": op9_quality_rules,
    "op10_license_scans": op10_license_scans,
}

_SPACE = r"[\x20\x09-\x0D]"

_OP9 = rf"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
  x AS (SELECT *, list_filter(string_split_regex(t, '{_SPACE}+'), lambda s: s <> '') AS ws, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM d),
  g AS (SELECT rid, i, array_to_string(ws[i:i + 4], ' ') AS gram FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM x)),
  r AS (SELECT rid, count(DISTINCT i + k) AS n FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS c FROM g), range(5) q(k) WHERE c > 1 GROUP BY rid),
  m AS (SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')) AS n_symbols,
    length(t) - length(replace(t, '!', '')) AS n_marks, len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words FROM x LEFT JOIN r USING (rid))
  SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
    NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR n_symbols > 0.3 * n_words OR n_marks > 0.5 * n_words OR 2 * n_dup_lines > n_lines OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept FROM m"""


def _op3() -> str:
    """Spans of every rule from the pieces between matches and the matches, as running sums of their lengths."""
    parts = []
    for rank, rule in enumerate(secretscan.RULES):
        pattern = rule.pattern.replace("'", "''")
        parts.append(f"""SELECT rid, {rank} AS rank, '{rule.kind}' AS kind, begin, begin + length(hit) AS stop FROM (
      SELECT rid, hit, part, sum(length(gap)) OVER w + coalesce(sum(length(hit)) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begin
      FROM (SELECT rid, unnest(regexp_extract_all(t, '{pattern}', 0)) AS hit, unnest(regexp_extract_all(t, '{pattern}', {rule.group})) AS part, unnest(string_split_regex(t, '{pattern}')) AS gap,
        unnest(range(len(string_split_regex(t, '{pattern}')))) AS i FROM d WHERE regexp_matches(t, '{pattern}')) WHERE hit IS NOT NULL WINDOW w AS (PARTITION BY rid ORDER BY i))
      WHERE length(part) >= {rule.at_least}""")
    spans = " UNION ALL ".join(parts)
    text = "kind || ':' || CAST(begin AS BIGINT) || ':' || CAST(stop AS BIGINT)"
    return f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents), s AS ({spans})
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    sha256(coalesce(string_agg({text}, ',' ORDER BY begin, rank) FILTER (rank < 3), '')) AS base_sha256, coalesce(string_agg({text}, ',' ORDER BY begin, rank), '') AS spans
  FROM d LEFT JOIN s USING (rid) GROUP BY rid, doc_id"""


ORACLE_SQL: dict[str, str] = {"op3_secret_scans": _op3(), "op9_quality_rules": _OP9}
