import random

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from lakelayers.llm.queries import ORACLES, QUERIES
from tests.oracle import assert_same, duckdb_on

SF_DIR = "/root/testdata/sf0.001"


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert set(ORACLES) <= set(oracle_sql())
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    assert_same(QUERIES[name](spark, SF_DIR), duckdb_on(SF_DIR), ORACLES[name])


def test_pipeline_on_the_given_tables(spark):
    placed = corpus_pipeline.run(spark, SF_DIR)
    assert {"doc_id", "bin", "n_words"} <= set(placed.columns)
    assert 100 < placed.select("doc_id").distinct().count() <= 200


def test_stages_take_effect(spark, tmp_path):
    rng = random.Random(9)
    word = {"en": "the and tion ing house".split(), "de": "der und ung keit haus".split()}

    def text(lang, n):
        return " ".join(rng.choice(word[lang]) + "".join(rng.choices("aeioulnrst", k=3)) for _ in range(n))

    rows = [(i, text("en" if i % 3 else "de", 60), "en" if i % 3 else "de", "s", 1) for i in range(120)]
    passage, item = text("en", 55), text("en", 40)
    rows += [
        (200, None, "en", "s", 1), (201, "123 !!", "en", "s", 1), (202, rows[7][1], "en", "t", 1),
        (203, text("en", 30) + " " + passage, "en", "s", 1), (204, text("en", 30) + "\n" + passage + " " + text("en", 9), "en", "s", 1),
        (205, text("en", 30) + " " + item + " " + text("en", 30), "en", "s", 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    seen = {}
    for name, function in corpus_pipeline.STAGES:
        result = function(spark, docs, str(tmp_path))
        result.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = {r.doc_id: r for r in docs.collect()}
        if name != "best_fit_packing":
            assert result.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    first = seen["language_id"]
    assert not {200, 201} & set(first) and len(first) == len(rows) - 2
    assert 202 not in seen["simhash_near_dedup"] and 7 in seen["simhash_near_dedup"]
    cut = seen["substring_dedup"]
    assert passage in cut[203].text and passage not in cut[204].text and cut[204].n_chars == len(cut[204].text)
    assert 205 not in seen["benchmark_decontamination"] and set(range(120)) <= set(seen["best_fit_packing"])
