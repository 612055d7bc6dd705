import hashlib
import random

from lakelayers.llm.middle import BLOCK, fill_in_middle, restored, unit_count
from pyspark.sql import functions as F


def brute(doc_id, text, plain_percent=10, spm_percent=20):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 100 - plain_percent:
        return doc_id, n, "plain", None, None, text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < spm_percent:
        return doc_id, n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


def made(documents, rows, **settings):
    frame = fill_in_middle(documents(rows), **settings)
    frame = frame.withColumn("back", restored(F.col("output"), F.col("form")))
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_equals_slices_of_code_points(documents):
    rng = random.Random(5)
    alphabet = ["a", "é", "😀", "\n", "\r", "$1", "\\", "<", "P", "S>", "<<", " ", "\u0301", "\u2028", "{3}", "."]
    rows = [(i, "".join(rng.choices(alphabet, k=rng.randint(0, 40)))) for i in range(400)]
    rows += [(None, "null id of ten"), (None, None), (1, None), (2, ""), (7, "a<P>b"), (8, "<S"), (9, "<M>"), (3, "same"), (3, "same"), (3, "other")]
    rows += [(1000 + i, "x\n😀" * (BLOCK // 3 * i + i)) for i in range(1, 8)] + [(2000, "é" * BLOCK), (2001, "\n" * (2 * BLOCK))]
    for settings in ({}, {"plain_percent": 0, "spm_percent": 100}, {"plain_percent": 100}):
        expected = [(*brute(d, t, **settings), t or "") for d, t in rows]
        assert made(documents, rows, **settings) == sorted(expected, key=repr)


def test_long_texts(documents):
    rows = [(i, "word é😀\n" * 400_000) for i in (4, 5)]
    assert made(documents, rows) == sorted(((*brute(d, t), t) for d, t in rows), key=repr)


def test_other_units(spark, documents):
    rows = [(i, " ".join(f"w{k}" for k in range(i)) + " " * (i % 3)) for i in range(1, 60)] + [(90, "z " * (2 * BLOCK + 5))]
    frame = fill_in_middle(documents(rows), unit=r"\S+\s*", plain_percent=0)
    frame = frame.withColumn("back", restored(F.col("output"), F.col("form")))
    texts = dict(rows)
    for row in frame.collect():
        assert row.back == texts[row.doc_id] and row.n == len(texts[row.doc_id].split())
        prefix = texts[row.doc_id][: row.prefix_chars]
        assert not prefix or prefix.endswith(" ") or row.prefix_chars == len(texts[row.doc_id])
    assert spark.range(1).select(unit_count(F.lit("abc" * BLOCK))).first()[0] == 3 * BLOCK


def test_columns_and_empty_tables(spark):
    frame = spark.createDataFrame([(1, "abc", "x", 3, "q")], "doc_id long, text string, form string, n int, _text string")
    assert fill_in_middle(frame).columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert tuple(fill_in_middle(frame).first()) == brute(1, "abc")
    assert fill_in_middle(frame.limit(0)).count() == 0


def test_one_scan_without_python(documents):
    plan = fill_in_middle(documents([(1, "abc")]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
