"""URL filters: a weighted vocabulary counted by an Aho-Corasick automaton, and host rules before it.

All terms are found in one walk over the bytes of a URL. A hit counts if it stands alone: next to it
lies an end of the URL or an ASCII character other than a letter or digit, so ``essex`` holds no ``sex``.
A-Z count as a-z. An escape ``%2F`` counts as a boundary, whatever it stands for; letters that are
written as escapes are therefore not found. A term of weight ``LIMIT`` or more is strict, any other
soft. Each distinct term counts once. A URL is blocked if the weights of its terms make up ``LIMIT``:
one strict term, or as many distinct soft ones.

Rules go before the vocabulary. A rule is a host, with all its subdomains, and the start of a path; the
longest that fits decides. They are one SQL expression, so there may be ``MAX_RULES`` of them at most.
The automaton is built in each task from the terms given, ``MAX_TERMS`` at most. A URL is judged in
its own row: nothing is shuffled, and no host or repeated URL can gather anywhere.

Defined cases: a null URL, and one without ``://``, has an empty host and path. The terms of a URL
without ``://`` count all the same; null and empty URLs are allowed. Host and path are taken as they
stand, with user, port and escapes. Long URLs are read whole. Repeated rows and null ids come back as
often as they are given. Ties of rules of equal length are won by the first given. An empty table gives
an empty one. Only the id and the URL are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelayers.llm.shipping import ship
from lakelayers.llm.words import LOWER, text_bytes

LIMIT = 2
MAX_TERMS = 100_000
MAX_RULES = 500

STRICT_TERMS = (
    "adult", "camgirl", "camgirls", "casino", "casinos", "cialis", "escort", "escorts", "gambling", "hardcore",
    "hentai", "milf", "nsfw", "porn", "porno", "pornstar", "sexcam", "slots", "spam", "viagra", "warez", "xxx",
)
SOFT_TERMS = (
    "ads", "banner", "bet", "bets", "bingo", "bonus", "cam", "cams", "cheap", "click", "crack", "dating", "deal",
    "deals", "download", "fetish", "free", "girls", "hot", "jackpot", "keygen", "loan", "loans", "lottery", "naked",
    "nude", "odds", "pill", "pills", "poker", "popup", "promo", "prize", "roulette", "serial", "sex", "sexy",
    "singles", "teen", "tits", "torrent", "track", "tracker", "tracking", "win", "winner",
)
VOCABULARY = {term: LIMIT for term in STRICT_TERMS} | {term: 1 for term in SOFT_TERMS}

# Verdict, host and path of the rules.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

_ALONE = np.zeros(256, bool)
_ALONE[:128] = True
for _first, _last in ("09", "AZ", "az"):
    _ALONE[ord(_first) : ord(_last) + 1] = False
_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdefABCDEF")] = True
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@lru_cache(4)
def automaton(terms: tuple[str, ...]) -> ahocorasick.Automaton:
    """Walks over bytes, as characters of Latin-1; a hit gives the number of the term."""
    found = ahocorasick.Automaton()
    for number, term in enumerate(terms):
        found.add_word(term.encode().decode("latin-1"), number)
    found.make_automaton()
    return found


def term_hits(urls: pa.Array, terms: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Number of the URL and of the term for every distinct term that stands alone in a URL."""
    data, bounds = text_bytes(urls)
    escapes = np.flatnonzero((data[:-2] == 37) & _HEX[data[1:-1]] & _HEX[data[2:]]) if len(data) > 2 else np.zeros(0, np.int64)
    owner = np.searchsorted(bounds, escapes, "right")
    escapes = escapes[escapes + 2 < bounds[owner]]  # not over the end of its URL
    data = LOWER[data]
    for k in range(3):
        data[escapes + k] = 32
    hits = list(automaton(terms).iter(data.tobytes().decode("latin-1"))) if terms else []
    last, number = np.array(hits, np.int64).reshape(-1, 2).T
    start = last - np.array([len(term.encode()) for term in terms], np.int64)[number] + 1
    url = np.searchsorted(bounds, start, "right") - 1
    begin, end = bounds[url], bounds[url + 1]
    alone = last < end
    alone &= (start == begin) | _ALONE[data[np.maximum(start - 1, 0)]]
    alone &= (last + 1 == end) | _ALONE[data[np.minimum(last + 1, max(0, len(data) - 1))]]
    pairs = np.unique(np.stack([url[alone], number[alone]]), axis=1)
    return pairs[0], pairs[1]


def vocabulary_hits(url: Column, vocabulary: Mapping[str, int] = VOCABULARY, limit: int = LIMIT) -> Column:
    """A struct of ``terms``, the distinct terms found, ``n_strict``, ``n_soft`` and ``weight``."""
    if len(vocabulary) > MAX_TERMS:
        raise ValueError(f"at most {MAX_TERMS} terms, not {len(vocabulary)}")
    for term, weight in vocabulary.items():
        raw = term.encode()
        if not raw or term != term.translate(str.maketrans(_UPPER, _LOWER)) or _ALONE[raw[0]] or _ALONE[raw[-1]] or weight < 1:
            raise ValueError(f"a term is in lower case, begins and ends with a letter or digit and weighs at least 1: {term!r}")
    terms, weights = tuple(vocabulary), np.array(list(vocabulary.values()), np.int64)

    @F.arrow_udf("struct<terms: array<string>, n_strict: int, n_soft: int, weight: bigint>")
    def run(urls: pa.Array) -> pa.Array:
        row, number = term_hits(urls, terms)
        strict = weights[number] >= limit if len(number) else np.zeros(0, bool)
        n = len(urls)
        ends = np.searchsorted(row, np.arange(n + 1)).astype(np.int32)
        names = pa.array(list(terms), pa.string()).take(pa.array(number))
        return pa.StructArray.from_arrays(
            [
                pa.ListArray.from_arrays(pa.array(ends), names),
                pa.array(np.bincount(row[strict], minlength=n).astype(np.int32)),
                pa.array(np.bincount(row[~strict], minlength=n).astype(np.int32)),
                pa.array(np.bincount(row, weights[number] if len(number) else None, n).astype(np.int64)),
            ],
            ["terms", "n_strict", "n_soft", "weight"],
        )

    return run(url)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What follows the first ``://`` up to ``/``, ``?`` or ``#``, in lower case, and the path after it."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    return (
        F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER),
        F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1),
    )


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """A struct of ``rule``, host and path in one text, and ``verdict``; null if no rule fits."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules, not {len(rules)}")
    chain = F
    for verdict, domain, start in sorted(rules, key=lambda rule: -len(rule[1] + rule[2])):
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(start)
        chain = chain.when(fits, F.struct(F.lit(domain + start).alias("rule"), F.lit(verdict).alias("verdict")))
    return F.lit(None).cast("struct<rule: string, verdict: string>") if chain is F else chain


def judge_urls(
    df: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
    vocabulary: Mapping[str, int] = VOCABULARY,
    limit: int = LIMIT,
) -> DataFrame:
    """One row per input row: page_id, url, host, path, rule, verdict, terms, n_strict, n_soft, weight."""
    ship(df.sparkSession)
    pages = df.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    host, path = host_and_path(F.coalesce("url", F.lit("")))
    found = pages.select("*", host.alias("host"), path.alias("path"), vocabulary_hits(F.col("url"), vocabulary, limit).alias("_found"))
    ruled = found.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    blocked = F.when(F.col("_found.weight") >= limit, F.lit("block")).otherwise(F.lit("allow"))
    return ruled.select(
        "page_id", "url", "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), blocked).alias("verdict"), "_found.*",
    )


def allowed(df: DataFrame, url_col: str = "url", **judgement) -> DataFrame:
    """The rows of ``df`` whose URL is allowed, in their own columns."""
    ship(df.sparkSession)
    url = F.col(url_col)
    rules, vocabulary = judgement.get("rules", RULES), judgement.get("vocabulary", VOCABULARY)
    limit = judgement.get("limit", LIMIT)
    host, path = host_and_path(F.coalesce(url, F.lit("")))
    blocked = F.when(vocabulary_hits(url, vocabulary, limit)["weight"] >= limit, F.lit("block")).otherwise(F.lit("allow"))
    return df.filter(F.coalesce(rule_of(host, path, rules)["verdict"], blocked) == "allow")
