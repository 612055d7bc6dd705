import random
import re

import pytest

from lakelayers.llm.urls import LIMIT, VOCABULARY, allowed, judge_urls, rule_of

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def brute(url, rules=RULES, vocabulary=VOCABULARY, limit=LIMIT):
    """host, path, rule, verdict, terms, by regular expressions and plain loops."""
    whole = url or ""
    rest = whole.split("://", 1)[1] if "://" in whole else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fitting = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fitting, key=lambda r: len(r[1] + r[2]), default=None)
    shown = re.sub("%[0-9a-fA-F]{2}", " ", re.sub("[A-Z]", lambda m: m[0].lower(), whole))
    side = r"[\x00-\x2f\x3a-\x60\x7b-\x7f]"
    terms = {t for t in vocabulary if re.search(f"(?:^|(?<={side})){t}(?=$|{side})", shown.replace("\n", " "))}
    weight = sum(vocabulary[t] for t in terms)
    verdict = best[0] if best else "block" if weight >= limit else "allow"
    return host, path, best[1] + best[2] if best else None, verdict, terms


def judged(spark, urls, **settings):
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = judge_urls(frame, **settings).orderBy("page_id").collect()
    return [(r.host, r.path, r.rule, r.verdict, set(r.terms)) for r in rows], rows


def test_equals_regular_expressions(spark):
    rng = random.Random(3)
    pieces = ["casino", "bet", "bets", "sex", "essex", "Poker", "x", "é", "-", ".", "/", "_", "%20", "%7", "%", "free", "a", "9", " ", "://", "?", "#"]
    hosts = ["a.net", "NET", "example.net", "x.Example.NET:80", "example.com", "z.org", "org", "wexample.net", ""]
    urls = [f"http://{rng.choice(hosts)}{rng.choice(['/', '', '/en/', '/de/', '/fr/', '/EN/'])}{''.join(rng.choices(pieces, k=rng.randint(0, 9)))}" for _ in range(700)]
    urls += [None, "", "casino", "no scheme/free-bet", "a://b://c/d", "http://h\n/free\nbet", "%20casino%41", "bet%2", "0bet", "http://u/" + "free " * 70_000 + "win"]
    found, rows = judged(spark, urls)
    assert found == [brute(url) for url in urls]
    assert all(r.weight == sum(VOCABULARY[t] for t in r.terms) and r.n_strict + r.n_soft == len(r.terms) for r in rows)


def test_terms_of_their_own(spark):
    vocabulary = {"a-b": 1, "b": 1, "a-b-c": 5, "ü1": 1}
    urls = ["a-b-c", "a-b", "xa-b b", "ü1", "aü1", "ü1é"]
    assert judged(spark, urls, vocabulary=vocabulary, limit=2, rules=[])[0] == [brute(u, [], vocabulary, 2) for u in urls]
    assert judged(spark, ["casino"], vocabulary={}, rules=())[0] == [("", "", None, "allow", set())]


@pytest.mark.parametrize("vocabulary", [{"": 1}, {"Bet": 1}, {"-bet": 1}, {"bet": 0}])
def test_bad_terms_are_refused(spark, vocabulary):
    with pytest.raises(ValueError):
        judged(spark, ["x"], vocabulary=vocabulary)


def test_bounds_are_checked(spark):
    from pyspark.sql import functions as F

    with pytest.raises(ValueError):
        rule_of(F.lit("a"), F.lit("/"), [("block", f"h{i}", "/") for i in range(501)])


def test_rows_columns_and_empty_tables(spark):
    schema = "page_id long, url string, host string, terms string, weight int"
    rows = [(None, "http://a.net/", "x", "y", 1), (1, "casino", "x", "y", 1), (1, "casino", "x", "y", 1), (2, "free", None, None, None)]
    frame = spark.createDataFrame(rows, schema)
    assert sorted((r.page_id or 0, r.verdict) for r in judge_urls(frame).collect()) == [(0, "block"), (1, "block"), (1, "block"), (2, "allow")]
    kept = allowed(frame)
    assert kept.schema == frame.schema and [tuple(r) for r in kept.collect()] == rows[3:]
    assert judge_urls(frame.limit(0)).count() == 0


def test_a_scan_and_nothing_else(spark):
    frame = spark.createDataFrame([(1, "x")], "page_id long, url string")
    assert "Exchange" not in judge_urls(frame)._jdf.queryExecution().executedPlan().toString()
