import random
import re
from collections import Counter, defaultdict

from lakelayers.llm.quality import quality_rules


def brute(rows, max_docs, max_percent, min_words, min_percent):
    """Rows of doc_id, text, host; every row counts as a document."""
    hosts, having, base = Counter(r[2] for r in rows), defaultdict(set), []
    for number, (_, text, host) in enumerate(rows):
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        often, covered = Counter(windows), [0] * len(words)
        for i, window in enumerate(windows):
            if often[window] > 1:
                covered[i : i + 5] = [1] * 5
        failed = len(words) < 10 or 100 * sum(covered) > 20 * len(words)
        normal = []
        for line in text.split("\n"):
            key = re.sub(r"[\W_]+", " ", line.lower()).strip()
            if key:
                normal.append((key, len(re.findall(r"[^\x20\x09-\x0D]+", line))))
                having[host, key].add(number)
        base.append((len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), sum(covered), failed, normal))
    out = []
    for (doc, _, host), (n, chars, symbols, again, repeat, failed, normal) in zip(rows, base):
        gone = sum(k for line, k in normal if len(having[host, line]) > max_docs and 100 * len(having[host, line]) > max_percent * hosts[host])
        out.append((doc, n, chars, symbols, again, repeat, failed, not failed and n - gone >= min_words and 100 * (n - gone) >= min_percent * n, gone))
    return sorted(out, key=repr)


def check(documents, rows, **limits):
    frame = documents([(d, t, None, h) for d, t, h in rows])
    settings = dict(max_docs=3, max_percent=10, min_words=5, min_percent=20) | limits
    got = sorted((tuple(r) for r in quality_rules(frame, **settings).collect()), key=repr)
    assert got == brute(rows, *settings.values())


def test_equals_brute_force(documents):
    rng = random.Random(4)
    footer = "All RIGHTS reserved - 2024!"
    rows = []
    for i in range(120):
        lines = [" ".join(rng.choices("abcdefgh#*|é", k=rng.randint(0, 12))) for _ in range(rng.randint(1, 6))]
        lines += [footer] * rng.randint(0, 2) + lines[:1] * rng.randint(0, 1)
        rows.append((i, "\n".join(lines), rng.choice(["x", "x", "y", None])))
    check(documents, rows)
    check(documents, rows, min_percent=90, max_docs=1)


def test_nulls_empties_and_repeated_rows(documents):
    line = "one two three four five six seven eight nine ten eleven"
    rows = [(1, None, "h"), (2, "", "h"), (3, " \n\t\r\n", None), (None, line, "h"), (None, line, "h"), (4, line, "h"), (4, line, "h"), (4, line + "\n###", "h")]
    check(documents, rows)
    check(documents, rows, max_docs=1)


def test_empty_table_and_other_columns(documents):
    assert quality_rules(documents([])).count() == 0
    frame = documents([(1, "a b c")]).selectExpr("*", "1 host", "2 n_words", "3 lines", "4 copies")
    assert quality_rules(frame).first()["n_words"] == 3


def test_no_python_in_the_plan(documents):
    plan = quality_rules(documents([(1, "a b c", None, "h")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
