import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import lakelayers.llm.divergence as divergence
from lakelayers.llm.divergence import PatternTree, share, source_divergence, term_counts, text_parts


def brute(rows, min_docs=3, top=200):
    """Every pair of sources and every kept term, one by one; rows are text, lang, source."""
    found = [(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), l or "", s or "") for t, l, s in rows]
    out = []
    for lang in {l for _, l, _ in found}:
        docs = [(terms, s) for terms, l, s in found if l == lang]
        often = Counter(t for terms, _ in docs for t in set(terms))
        kept = sorted(t for t in often if often[t] >= min_docs)
        counts = defaultdict(Counter)
        for terms, source in docs:
            counts[source].update(t for t in terms if often[t] >= min_docs)
            counts[source] += Counter()
        whole = sum(counts.values(), Counter())

        def shares(c):
            total = sum(c.values()) + len(kept)
            return [1 + 10**9 * (c[t] + 1) // total for t in kept]

        p = {s: shares(counts[s]) for s in {s for _, s in docs}}
        q = shares(whole)
        f = lambda a, b: (a - b) ** 2 // b
        for s in p:
            pairs = [(o, sum(map(f, p[s], p[o]))) for o in p if o != s]
            terms = [(t, f(a, b)) for t, a, b in zip(kept, p[s], q) if counts[s][t] and a > b]
            for part, values, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                ranked = sorted(values, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(ranked)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string, source string")


def same(spark, rows, **settings):
    got = sorted(tuple(r) for r in source_divergence(frame(spark, rows), **settings).collect())
    assert got == brute(rows, settings.get("min_docs", 3), settings.get("top_terms", 200))


def test_equals_every_pair_and_term(spark):
    rng = random.Random(2)
    words = [f"w{c}" for c in "abcdefghijklmnop"] + ["Éa", "ÉA", "straße", "x1y", "ﬀ", "😀"]
    rows = []
    for _ in range(260):
        source = rng.choice(["hot"] * 5 + ["a", "b", "c", "B", "é"])
        rows.append((" ".join(rng.choices(words[: 4 + len(source) * 5], k=rng.randint(0, 30))), rng.choice(["en", "en", "de"]), source))
    rows += [(None, "en", "no text"), ("", "xx", "empty"), ("123", "xx", "digits"), ("wa wb", None, None), ("wa", "", None), ("wa", "", "z")]
    rows += [("rare term only here", "de", "rare")] + [("wa wa wb", "en", "a")] * 40
    same(spark, rows)
    same(spark, rows, min_docs=1, top_terms=2)


def test_ties_are_ranked_by_bytes(spark):
    same(spark, [("a z é 😀 ﬀ", "en", s) for s in ("one", "two", "éins", "Zwei")] + [("a", "en", "odd")])


def test_empty_tables_and_other_columns(spark):
    assert source_divergence(frame(spark, []), "text").count() == 0
    rows = [("aa bb aa", "en", s, 1, "t", 5) for s in "xyzx"]
    wide = spark.createDataFrame(rows, "text string, lang string, source string, term int, item string, value int")
    assert sorted(tuple(r) for r in source_divergence(wide).collect()) == brute([r[:3] for r in rows])


def test_long_texts_in_parts_and_passes(spark, monkeypatch):
    rng = random.Random(4)
    text = " ".join("".join(rng.choices("abcé", k=rng.randint(1, 9))) for _ in range(3000)) + " " + "q" * 500
    whole = Counter(re.findall(r"[a-zé]+", text))
    for part, size, held in ((64, 1 << 20, 50), (64, 4000, 10**6), (1 << 20, 1 << 25, 300)):
        monkeypatch.setattr(divergence, "PASS_BYTES", size)
        monkeypatch.setattr(divergence, "HELD", held)
        monkeypatch.setattr(divergence, "PART_BYTES", part)
        monkeypatch.setattr(divergence, "text_parts", lambda data, n=part: text_parts(data, n))
        import pyarrow as pa

        batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 2, "source": ["s"] * 2, "text": [text, text]})
        n, docs = Counter(), Counter()
        for out in divergence._counted(iter([batch])):
            for row in out.to_pylist():
                n[row["term"]] += row["n"]
                docs[row["term"]] += row["docs"]
        assert n.pop("") == 0 and not docs.pop("")
        assert n == Counter({t: 2 * k for t, k in whole.items()}) and set(docs.values()) == {2} and set(docs) == set(whole)


def test_parts_cut_no_term():
    data = np.frombuffer(b"ab  cde " + b"z" * 50 + b" f" + b"y" * 9, np.uint8)
    for limit in (1, 3, 8, 100):
        parts = list(text_parts(data, limit))
        assert b"".join(parts) == data.tobytes()
        assert sorted(re.findall(rb"[a-z]+", b"|".join(parts))) == sorted(re.findall(rb"[a-z]+", data.tobytes()))


def test_tree_pairs_are_those_of_all_rows():
    rng = random.Random(6)
    rows = Counter(tuple((s, rng.randint(1, 2)) for s in "abcd" if rng.random() < 0.6) for _ in range(300))
    expected, tree = Counter(), PatternTree()
    for row, terms in rows.items():
        for j in range(len(row)):
            for i in range(j):
                expected[(*row[i], *row[j])] += terms
    for row in sorted(rows):
        tree.insert(list(row), rows[row])
    tree.close()
    assert tree.take() == expected


@pytest.mark.parametrize("count, room", [(0, 1), (0, 3), (10**13, 10**15 + 7), (2 * 10**18, 2 * 10**18 + 1)])
def test_shares_are_exact(spark, count, room):
    got = spark.range(1).select(share(F.lit(count).cast("long"), F.lit(room).cast("long"))).first()[0]
    assert got == 1 + 10**9 * (count + 1) // room


def test_a_hot_group_sends_partial_counts(spark):
    rows = frame(spark, [("a b a", "en", "hot")] * 5000).repartition(4)
    assert {(r.term, r.n, r.docs) for r in term_counts(rows).collect()} == {("", 0, 0), ("a", 10000, 5000), ("b", 5000, 5000)}
