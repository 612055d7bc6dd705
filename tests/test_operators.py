import hashlib
import os

import pytest
from pyspark.sql import functions as F

from lakelayers.functions.rules import Rule, not_null
from lakelayers.operators.audit import METRIC_COLUMNS, classify_messages, lineage_audit, record_metrics
from lakelayers.operators.manifests import manifest_diff
from lakelayers.operators.merge import survivorship_merge
from lakelayers.operators.quality import parse_columns, split_rejects
from lakelayers.scratch import scratch_folder, scratch_root, scratch_space, stage
from lakelayers.sinks.tables import create_managed_table
from lakelayers.sources.files import file_manifest, list_files, read_csv_drop
from lakelayers.sources.jsonl import is_corrupt


def test_parse_columns_reports_rejects(spark):
    frame = spark.createDataFrame([("1", "x"), (None, None), ("a", "2.5")], "n string, f string")
    found = parse_columns(frame, {"n": "int", "f": "float"}, {"n": 7}).collect()
    assert [tuple(row) for row in found] == [(1, None, "f"), (7, None, ""), (None, 2.5, "n")]


def test_parse_columns_can_fail(spark):
    frame = spark.createDataFrame([("1",), ("a",)], "n string")
    assert parse_columns(frame.filter("n = '1'"), {"n": "int"}, on_reject="fail").collect() == [(1,)]
    with pytest.raises(Exception, match="n must be an integer, got: a"):
        parse_columns(frame, {"n": "int"}, on_reject="fail").collect()
    with pytest.raises(ValueError):
        parse_columns(frame, {"n": "int"}, on_reject="ignore")


@pytest.mark.parametrize("staged", [True, False])
def test_split_conserves_rows(spark, staged):
    frame = spark.range(1000).select(F.when(F.col("id") % 3 != 0, F.col("id")).alias("v"))
    rules = [not_null("v"), Rule("small", F.col("v") < 900)]
    good, rejected = split_rejects(frame, rules, staged=staged)
    assert good.columns == ["v"] and rejected.columns == ["v", "failed_rule"]
    counts = {row["failed_rule"]: row["count"] for row in rejected.groupBy("failed_rule").count().collect()}
    assert counts == {"v_not_null": 334, "small": 66}
    assert good.count() == 600


def test_merge_prefers_higher_layers(spark):
    top = spark.createDataFrame([("a", None, "1"), ("b", "tb", None)], "k string, x string, y string")
    middle = spark.createDataFrame([("a", "ma"), ("b", "mb")], "k string, x string")
    low = spark.createDataFrame([("a", "la", "la"), ("c", "lc", None)], "k string, x string, y string")
    found = survivorship_merge({"top": top, "middle": middle, "low": low}, ["k"]).orderBy("k").collect()
    assert [tuple(row) for row in found] == [
        ("a", "ma", "middle", "1", "top"), ("b", "tb", "top", None, None), ("c", "lc", "low", None, None),
    ]


def test_merge_is_independent_of_order_and_copies(spark):
    rows = [("hot", f"v{i:05d}") for i in range(5000)] + [("cold", "c")]
    one = spark.createDataFrame(rows, "k string, x string").repartition(6)
    other = spark.createDataFrame(rows[::-1], "k string, x string").coalesce(1)
    for frame in (one, other):
        found = survivorship_merge({"only": frame}, ["k"]).orderBy("k").collect()
        assert [tuple(row) for row in found] == [("cold", "c", "only"), ("hot", "v00000", "only")]


def test_classification_takes_the_first_class(spark):
    messages = ["Spark CONFIG broken", "invalid s3 path", "SQL and AWS", "Glue", "other", None]
    frame = spark.createDataFrame([(text,) for text in messages], "m string")
    found = [row["error_code"] for row in classify_messages(frame, "m").collect()]
    assert found == [
        "CONFIG_ERROR", "VALIDATION_ERROR", "SPARK_ERROR", "AWS_SERVICE_ERROR", "GENERIC_ERROR", "GENERIC_ERROR",
    ]


LINEAGE_COLUMNS = "source_database string, source_table string, target_database string, target_table string"


def test_lineage(spark):
    steps = [
        ("raw_zone", "t", "bronze_zone", "t"), ("raw_zone", "t", "silver_zone", "t"),
        ("gold_zone", "t", "gold_zone", "u"), ("gold_zone", "t", "raw_zone", "t"),
        ("sales", "withdrawals", "mart", "x"), ("silver_zone", " ", "gold_zone", "t"),
        ("bronze_zone", "my_gold", "silver_zone", None), ("Gold_Zone", "RAW_t", "x", "silver"),
    ]
    frame = spark.createDataFrame(steps, LINEAGE_COLUMNS)
    found = lineage_audit(frame).select("source_layer", "target_layer", "pipeline_type", "is_valid", "message")
    refused = "Invalid pipeline: {} -> {}. Valid transitions from {}: {}"
    assert [tuple(row) for row in found.collect()] == [
        ("raw", "bronze", "raw_to_bronze", True, None),
        ("raw", "silver", "raw_to_silver", False, refused.format("raw", "silver", "raw", "['bronze']")),
        ("gold", "gold", "gold_processing", True, None),
        ("gold", "raw", "gold_to_raw", False, refused.format("gold", "raw", "gold", "[]")),
        ("raw", "bronze", "raw_to_bronze", True, None),
        ("silver", "gold", "silver_to_gold", False, "Table name cannot be empty"),
        ("bronze", "silver", "bronze_to_silver", False, "Table name cannot be empty"),
        ("raw", "silver", "raw_to_silver", False, refused.format("raw", "silver", "raw", "['bronze']")),
    ]


def test_blank_databases_and_unknown_layers_are_invalid(spark):
    steps = [
        (" \u00a0", "raw_t", "bronze", "t", None, None), ("raw", "t", None, "t", None, "bronze"),
        ("x", "t", "y", "t", "foo", "raw"), ("x", "t", "y", "t", "foo", "foo"), (" raw_zone ", "t", "bronze_zone", "t", None, None),
    ]
    frame = spark.createDataFrame(steps, LINEAGE_COLUMNS + ", source_layer string, target_layer string")
    found = lineage_audit(frame).select("is_valid", "message", "source_full_name").collect()
    refused = "Invalid pipeline: foo -> {}. Valid transitions from foo: []"
    assert [(r.is_valid, r.message) for r in found] == [
        (False, "Database name cannot be empty"), (False, "Database name cannot be empty"),
        (False, refused.format("raw")), (False, refused.format("foo")), (True, None),
    ]
    assert found[4].source_full_name == "spark_catalog.raw_zone.t"


def test_rows_without_a_key_are_not_merged(spark):
    one = spark.createDataFrame([(None, "a"), (None, "b"), (1, "c")], "k int, v string")
    two = spark.createDataFrame([(None, "z"), (1, "d")], "k int, v string")
    found = survivorship_merge({"one": one, "two": two}, ["k"]).collect()
    assert sorted(map(repr, ((r.k, r.v, r.v_source) for r in found))) == sorted(map(repr, [
        (None, "a", "one"), (None, "b", "one"), (None, "z", "two"), (1, "c", "one"),
    ]))


def test_given_layers_win(spark):
    frame = spark.createDataFrame(
        [("raw", "t", "bronze", "t", "silver", None)], LINEAGE_COLUMNS + ", source_layer string, target_layer string"
    )
    row = lineage_audit(frame, "lake").first()
    assert (row["source_layer"], row["target_layer"]) == ("silver", "bronze")
    assert row["source_full_name"] == "lake.raw.t"


def test_metrics_table(spark, table):
    ref = table("metrics")
    create_managed_table(spark, ref, METRIC_COLUMNS)
    record_metrics(spark, ref, "r1", "silver", {"rows_in": 5, "rows_out": 4}, "2024-01-01")
    record_metrics(spark, ref, "r1", "gold", {"rows_in": 4})
    found = spark.table(ref.sql).select("run_id", "step", "metric", "value").collect()
    assert sorted(tuple(row) for row in found) == [
        ("r1", "gold", "rows_in", 4), ("r1", "silver", "rows_in", 5), ("r1", "silver", "rows_out", 4),
    ]


def test_manifest_diff(spark):
    schema = "path string, sha256 string"
    before = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], schema)
    after = spark.createDataFrame([("b", "2"), ("c", "x"), ("d", "4")], schema)
    found = manifest_diff(before, after).select("path", "status").orderBy("path").collect()
    assert [tuple(row) for row in found] == [("a", "gone"), ("b", "same"), ("c", "changed"), ("d", "new")]


@pytest.fixture
def drop(tmp_path):
    folder = tmp_path / "a drop"
    folder.mkdir()
    (folder / "b.CSV").write_text("k,v\n2,y\n")
    (folder / "a.csv").write_text("k,v\n1,x\n")
    (folder / "c.Csv").write_text("k,v\n3,z\n")
    (folder / "d.txt").write_text("no table")
    return str(folder) + "/"


def test_manifest_hashes_files_of_all_sizes(spark, drop):
    with open(drop + "large.bin", "wb") as file:
        file.write(os.urandom(100_000))
    found = {row["name"]: row for row in file_manifest(spark, drop).collect()}
    assert set(found) == {"a.csv", "b.CSV", "c.Csv", "d.txt", "large.bin"}
    for name, row in found.items():
        content = open(drop + name, "rb").read()
        assert row["size"] == len(content)
        assert row["sha256"] == hashlib.sha256(content).hexdigest()


def test_listing_with_pattern(spark, drop):
    assert {row["name"] for row in list_files(spark, drop, "*.txt").collect()} == {"d.txt"}


def test_csv_drop(spark, drop):
    found = read_csv_drop(spark, drop, "k int, v string").orderBy("k").collect()
    assert [tuple(row) for row in found] == [(1, "x", "a.csv"), (2, "y", "b.CSV"), (3, "z", "c.Csv")]
    assert [row["k"] for row in read_csv_drop(spark, drop, which="first").collect()] == ["1"]
    assert read_csv_drop(spark, drop + "b.CSV", "k int, v string").count() == 1
    with pytest.raises(ValueError):
        read_csv_drop(spark, drop, which="last")


def test_malformed_csv_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\n1,a\nx,b\n3,c,extra\n4\n")
    kept = read_csv_drop(spark, f"{tmp_path}/", "k int, v string", keep_corrupt=True)
    bad = is_corrupt(kept)
    assert sorted(r._corrupt_record for r in kept.filter(bad).collect()) == ["3,c,extra", "4", "x,b"]
    assert [(r.k, r.v) for r in kept.filter(~bad).collect()] == [(1, "a")]
    assert read_csv_drop(spark, f"{tmp_path}/", "k int, v string", malformed="DROPMALFORMED").collect()[0].k == 1
    with pytest.raises(Exception, match="MALFORMED"):
        read_csv_drop(spark, f"{tmp_path}/", "k int, v string", malformed="FAILFAST").collect()


def test_csv_reader_options(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k;v\n1;"x\ny"\n')
    found = read_csv_drop(spark, f"{tmp_path}/", "k int, v string", options={"sep": ";", "multiLine": "true"})
    assert [tuple(row) for row in found.collect()] == [(1, "x\ny", "a.csv")]


def test_csv_drop_without_csv(spark, tmp_path):
    (tmp_path / "d.txt").write_text("x")
    with pytest.raises(ValueError):
        read_csv_drop(spark, str(tmp_path) + "/")


def test_scratch_lies_in_the_checkpoint_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_root(spark) == root
    assert scratch_folder(spark, "x") != scratch_folder(spark, "x")
    assert scratch_folder(spark, "x").startswith(root)


class FakeSession:
    def __init__(self, **settings):
        self.conf = self
        self.settings = settings

    def get(self, name, default=None):
        return self.settings.get(name, default)


def test_scratch_can_be_cleared(spark, monkeypatch, tmp_path):
    monkeypatch.setattr("lakelayers.scratch.scratch_root", lambda spark: str(tmp_path / "root"))
    with scratch_space(spark):
        assert stage(spark.range(3), "some").count() == 3
        assert any((tmp_path / "root").rglob("*.parquet"))
    assert not any((tmp_path / "root").rglob("*.parquet"))


def test_cluster_needs_a_checkpoint_folder():
    with pytest.raises(RuntimeError):
        scratch_root(FakeSession(**{"spark.master": "spark://host:7077"}))
    local = FakeSession(**{"spark.master": "local[2]", "spark.app.id": "x"})
    assert scratch_root(local) == scratch_root(local)
