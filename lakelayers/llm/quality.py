"""Quality rules with cross-document line frequency, on built-in SQL functions only.

Lines are normalised (lower case, every run of characters other than letters and digits one space,
trimmed) and hashed. For each host and line the documents that have it are counted; a line is
removed if they are more than ``max_docs`` and more than ``max_percent`` of the host's documents. A
document is depleted, and rejected, if fewer than ``min_words`` or ``min_percent`` of its words stay.

Per-document statistics stay in the row of the document: only line hashes are shuffled, after a
partial count. Documents that share a hot line meet in an equi-join with the few lines over a limit,
whose partitions adaptive execution splits.

Defined cases: a null text has no words or lines. A null host is a host of its own, a null id an id of
its own. Repeated rows count as documents of their own and come back as often as they are given.
Hashes have 64 bits: 5-word windows are compared within one document only, lines within one host.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_DOCS = 10
MAX_PERCENT = 1
MIN_WORDS = 5
MIN_PERCENT = 20
WINDOW = 5

_SPACE = r"[\\x20\\x09-\\x0D]+"
_HAS_WORD = r"[^\\x20\\x09-\\x0D]"


def base_statistics(df: DataFrame) -> DataFrame:
    """From columns text and any others: the others, and n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed."""
    others = [c for c in df.columns if c != "text"]
    window = ", ".join(f"_w[_i + {k}]" for k in range(WINDOW))
    cut = df.selectExpr(
        *others,
        "coalesce(text, '') _text",
        f"array_remove(split(coalesce(text, ''), '{_SPACE}'), '') _w",
        f"filter(split(coalesce(text, ''), '\\n'), _l -> rlike(_l, '{_HAS_WORD}')) _lines",
    )
    hashed = cut.selectExpr(
        *others,
        "cast(size(_w) as bigint) n_words",
        "cast(char_length(array_join(_w, '')) as bigint) word_chars",
        "cast(regexp_count(_text, '[#*$%&|<>]') as bigint) n_symbols",
        "cast(size(_lines) - size(array_distinct(_lines)) as bigint) n_dup_lines",
        f"case when size(_w) >= {WINDOW} then transform(sequence(0, size(_w) - {WINDOW}), _i -> xxhash64({window})) else array() end _h",
    )
    keep = [*others, "n_words", "word_chars", "n_symbols", "n_dup_lines"]
    ordered = hashed.selectExpr(
        *keep,
        "case when size(array_distinct(_h)) < size(_h) then array_sort(transform(_h, (_x, _i) -> struct(_x as x, _i as i))) end _s",
    )
    # Windows next to an equal one in hash order, back in text order.
    found = ordered.selectExpr(
        *keep,
        """array_sort(transform(filter(transform(_s, (_p, _k) -> struct(_p.i as i,
               case when _k > 0 then try_element_at(_s, _k).x = _p.x else false end
               or coalesce(try_element_at(_s, _k + 2).x = _p.x, false) as again)), _p -> _p.again), _p -> _p.i)) _q""",
    )
    steps = f"transform(_q, (_p, _k) -> least({WINDOW}, coalesce(try_element_at(_q, _k + 2) - _p, {WINDOW})))"
    repeated = found.selectExpr(*keep, f"coalesce(aggregate({steps}, 0L, (_a, _x) -> _a + _x), 0L) n_repeat_words")
    return repeated.selectExpr("*", "n_words < 10 or 100 * n_repeat_words > 20 * n_words base_failed")


def line_hashes(df: DataFrame) -> DataFrame:
    """doc_id, text_key, host, lines: the hash and the number of words of each line that has one."""
    norm = r"trim(regexp_replace(lower(_l), '[^\\p{L}\\p{N}]+', ' '))"
    words = f"size(array_remove(split(_l, '{_SPACE}'), ''))"
    lines = df.selectExpr("doc_id", "text_key", "host", f"transform(split(text, '\\n'), _l -> struct({norm} as line, {words} as n_words)) _lines")
    return lines.selectExpr(
        "doc_id", "text_key", "host",
        "transform(filter(_lines, _l -> _l.line <> ''), _l -> struct(xxhash64(_l.line) as line, _l.n_words as n_words)) lines",
    )


def quality_rules(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    max_docs: int = MAX_DOCS,
    max_percent: int = MAX_PERCENT,
    min_words: int = MIN_WORDS,
    min_percent: int = MIN_PERCENT,
) -> DataFrame:
    """One row per input row: doc_id, the base statistics, base_failed, kept, n_removed_words."""
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(host_col).alias("host"))
    docs = docs.withColumn("text_key", F.xxhash64("text"))
    lines = line_hashes(docs)
    counts = lines.selectExpr("host", "explode(array_distinct(transform(lines, _l -> _l.line))) line").groupBy("host", "line").agg(F.count("*").alias("n_docs"))
    hosts = docs.groupBy("host").agg(F.count("*").alias("host_docs")).withColumnRenamed("host", "counted_host")
    over = (
        counts.filter(F.col("n_docs") > max_docs)
        .join(hosts, F.expr("host <=> counted_host"))
        .filter(100 * F.col("n_docs") > F.lit(max_percent) * F.col("host_docs"))
        .selectExpr("host over_host", "line over_line")
    )
    each = lines.selectExpr("doc_id", "text_key", "host", "inline(lines)")
    removed = (
        each.join(over, F.expr("line = over_line and host <=> over_host"))
        .groupBy("doc_id", "text_key", "host")
        .agg(F.sum("n_words").alias("all_removed"))
        .selectExpr("doc_id removed_id", "text_key removed_key", "host removed_host", "all_removed")
    )
    # Equal rows have equal statistics: they are put together for the join and dealt out again.
    base = base_statistics(docs)
    keys = ["doc_id", "text_key", "host"]
    values = [c for c in base.columns if c not in keys]
    base = base.groupBy(*keys).agg(*[F.max(c).alias(c) for c in values], F.count("*").alias("copies"))
    joined = base.join(removed, F.expr("doc_id <=> removed_id and text_key = removed_key and host <=> removed_host"), "left")
    judged = joined.withColumn("n_removed_words", F.expr("coalesce(all_removed div copies, 0L)"))
    left = F.col("n_words") - F.col("n_removed_words")
    kept = ~F.col("base_failed") & (left >= min_words) & (100 * left >= F.lit(min_percent) * F.col("n_words"))
    return judged.select("doc_id", *values, kept.alias("kept"), "n_removed_words", F.expr("explode(sequence(1L, copies))").alias("_copy")).drop("_copy")
