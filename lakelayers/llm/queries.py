"""One query for each operator, over its whole table, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelayers.llm.brown import score
from lakelayers.llm.decontaminate import contaminations
from lakelayers.llm.divergence import MIN_DOCS, SCALE, TOP_TERMS, source_divergence
from lakelayers.llm.langid import identify
from lakelayers.llm.middle import PLAIN_PERCENT, SPM_PERCENT, fill_in_middle, restored
from lakelayers.llm.packing import pack
from lakelayers.llm.quality import MAX_DOCS, MAX_PERCENT, MIN_PERCENT, MIN_WORDS, quality_rules
from lakelayers.llm.sharding import assign_shards
from lakelayers.llm.simhash import near_duplicates
from lakelayers.llm.substrings import dedup_substrings
from lakelayers.llm.tables import table
from lakelayers.llm.toxicity import score_toxicity
from lakelayers.llm.urls import LIMIT, RULES, VOCABULARY, judge_urls
from lakelayers.llm.warc import MIN_REVISIT, archived_captures


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = archived_captures(table(spark, sf_dir, "pages"))
    return captures.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))


def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_urls(table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "n_strict", "n_soft", "weight")


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_benchmark_decontamination": op1_benchmark_decontamination,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_language_id": op3_language_id,
    "op4_toxicity": op4_toxicity,
    "op5_quality_rules": op5_quality_rules,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_sharding": op7_sharding,
    "op8_warc": op8_warc,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_url_filters": op11_url_filters,
    "op12_source_divergence": op12_source_divergence,
    "op13_fill_in_middle": op13_fill_in_middle,
}

_WORDS = r"CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(text, '[^\x20\x09-\x0D]+') END"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALONE = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"


def _rows(*rows: tuple) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in rows)


ORACLES: dict[str, str] = {
    "op2_substring_dedup": f"""
WITH words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
starts AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS pos, w FROM words WHERE len(w) >= 13),
windows AS (SELECT doc_id, pos, array_to_string(w[pos:pos + 12], ' ') AS shown FROM starts),
firsts AS (SELECT shown, min(doc_id) AS smallest FROM windows GROUP BY shown),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(pos, pos + 13)) AS pos
  FROM windows JOIN firsts USING (shown) WHERE doc_id > smallest
),
placed AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM words),
kept AS (
  SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.pos) AS shown, count(*) AS n
  FROM placed p LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.pos = g.pos
  WHERE g.pos IS NULL GROUP BY p.doc_id
)
SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(shown, '')) AS kept_sha256
FROM words LEFT JOIN kept ON words.doc_id = kept.doc_id""",
    "op5_quality_rules": f"""
WITH words AS (
  SELECT doc_id, source, coalesce(text, '') AS text, {_WORDS} AS w, string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents
),
starts AS (SELECT doc_id, unnest(range(1, len(w) - 3)) AS pos, w FROM words WHERE len(w) >= 5),
windows AS (SELECT doc_id, pos, array_to_string(w[pos:pos + 4], ' ') AS shown FROM starts),
often AS (SELECT doc_id, shown FROM windows GROUP BY doc_id, shown HAVING count(*) > 1),
covered AS (
  SELECT DISTINCT windows.doc_id, unnest(range(pos, pos + 5)) AS pos
  FROM windows JOIN often ON windows.doc_id = often.doc_id AND windows.shown = often.shown
),
repeats AS (SELECT doc_id, count(*) AS n FROM covered GROUP BY doc_id),
each AS (SELECT doc_id, source, unnest(lines) AS line FROM words),
judged AS (
  SELECT doc_id, source, line, trim(regexp_replace(lower(line), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) AS normal,
         len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS n
  FROM each
),
again AS (
  SELECT doc_id, CAST(count(*) - count(DISTINCT line) AS BIGINT) AS n FROM judged WHERE n > 0 GROUP BY doc_id
),
hosts AS (SELECT source, count(*) AS docs FROM documents GROUP BY source),
over AS (
  SELECT j.source, normal FROM judged j JOIN hosts ON j.source = hosts.source WHERE normal <> ''
  GROUP BY j.source, normal, docs
  HAVING count(DISTINCT doc_id) > {MAX_DOCS} AND 100 * count(DISTINCT doc_id) > {MAX_PERCENT} * docs
),
removed AS (
  SELECT doc_id, sum(n) AS n FROM judged JOIN over ON judged.source = over.source AND judged.normal = over.normal
  GROUP BY doc_id
),
base AS (
  SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(again.n, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(repeats.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(removed.n, 0) AS BIGINT) AS n_removed_words
  FROM words LEFT JOIN again ON words.doc_id = again.doc_id LEFT JOIN repeats ON words.doc_id = repeats.doc_id
  LEFT JOIN removed ON words.doc_id = removed.doc_id
),
failed AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base)
SELECT *, NOT base_failed AND n_words - n_removed_words >= {MIN_WORDS}
          AND 100 * (n_words - n_removed_words) >= {MIN_PERCENT} * n_words AS kept
FROM failed""",
    "op8_warc": f"""
WITH payloads AS (
  SELECT page_id, url, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages
),
firsts AS (
  SELECT payload_digest, min(page_id) AS first FROM payloads WHERE payload_bytes >= {MIN_REVISIT}
  GROUP BY payload_digest
)
SELECT page_id, payload_bytes, p.payload_digest,
       CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to
FROM payloads p LEFT JOIN firsts ON p.payload_digest = firsts.payload_digest AND payload_bytes >= {MIN_REVISIT}""",
    "op11_url_filters": f"""
WITH rules(verdict, host, start) AS (VALUES {_rows(*RULES)}),
vocabulary(term, weight) AS (VALUES {_rows(*VOCABULARY.items())}),
rest AS (
  SELECT page_id, regexp_replace({_LOWER.format("coalesce(url, '')")}, '%[0-9a-f]{{2}}', '   ', 'g') AS shown,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
),
cut AS (
  SELECT page_id, shown, {_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
),
ruled AS (
  SELECT page_id, arg_max(r.host || start, length(r.host || start)) AS rule,
         arg_max(r.verdict, length(r.host || start)) AS verdict
  FROM cut c JOIN rules r ON (c.host = r.host OR ends_with(c.host, '.' || r.host)) AND starts_with(path, start)
  GROUP BY page_id
),
hits AS (
  SELECT page_id, count(*) FILTER (weight >= {LIMIT}) AS strict, count(*) FILTER (weight < {LIMIT}) AS soft, sum(weight) AS weight
  FROM cut JOIN vocabulary ON contains(shown, term) AND regexp_matches(shown, '(^|{_ALONE})' || term || '($|{_ALONE})')
  GROUP BY page_id
)
SELECT c.page_id, host, path, rule,
       coalesce(r.verdict, CASE WHEN coalesce(weight, 0) >= {LIMIT} THEN 'block' ELSE 'allow' END) AS verdict,
       CAST(coalesce(strict, 0) AS INTEGER) AS n_strict, CAST(coalesce(soft, 0) AS INTEGER) AS n_soft,
       CAST(coalesce(weight, 0) AS BIGINT) AS weight
FROM cut c LEFT JOIN ruled r ON c.page_id = r.page_id LEFT JOIN hits h ON c.page_id = h.page_id""",
    "op12_source_divergence": f"""
WITH docs AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents
),
often AS (
  SELECT lang, term FROM (SELECT lang, unnest(list_distinct(terms)) AS term FROM docs)
  GROUP BY lang, term HAVING count(*) >= {MIN_DOCS}
),
counts AS (
  SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(terms) AS term FROM docs)
  SEMI JOIN often USING (lang, term) GROUP BY lang, source, term
),
sizes AS (SELECT lang, count(*) AS v FROM often GROUP BY lang),
groups AS (
  SELECT g.lang, g.source, coalesce(v, 0) AS v, coalesce(n, 0) + coalesce(v, 0) AS room
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN sizes ON g.lang = sizes.lang
  LEFT JOIN (SELECT lang, source, sum(n) AS n FROM counts GROUP BY lang, source) c ON g.lang = c.lang AND g.source = c.source
),
shares AS (
  SELECT g.lang, g.source, o.term, coalesce(n, 0) AS n,
         1 + ({SCALE}::HUGEINT * (coalesce(n, 0) + 1)) // room AS p
  FROM groups g JOIN often o ON g.lang = o.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = o.term
),
pairs AS (
  SELECT g.lang, g.source, h.source AS item, coalesce(value, 0) AS value
  FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY a.lang, a.source, b.source
  ) s ON s.lang = g.lang AND s.source = g.source AND s.item = h.source
),
whole AS (
  SELECT c.lang, c.term, 1 + ({SCALE}::HUGEINT * (sum(n) + 1)) // (sum(sum(n)) OVER (PARTITION BY c.lang) + any_value(v)) AS q
  FROM counts c JOIN sizes ON c.lang = sizes.lang GROUP BY c.lang, c.term
),
terms AS (
  SELECT s.lang, s.source, s.term AS item, (p - q) * (p - q) // q AS value
  FROM shares s JOIN whole w ON s.lang = w.lang AND s.term = w.term WHERE n > 0 AND p > q
),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value,
         row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS rank
  FROM pairs
  UNION ALL
  SELECT * FROM (
    SELECT lang, source, 'term', item, value,
           row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS rank
    FROM terms
  ) WHERE rank <= {TOP_TERMS}
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked""",
    "op13_fill_in_middle": f"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
),
numbers AS (
  SELECT *, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM docs
),
cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= {100 - PLAIN_PERCENT}
              THEN 'plain' WHEN h4 % 100 < {SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form
  FROM numbers
),
parts AS (SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix FROM cuts)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CAST(CASE WHEN form <> 'plain' THEN a END AS BIGINT) AS prefix_chars,
       CAST(CASE WHEN form <> 'plain' THEN b - a END AS BIGINT) AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts""",
}
