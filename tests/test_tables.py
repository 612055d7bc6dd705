import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from lakelayers.names import TableRef, layer_database, layer_table, quote, raw_folder
from lakelayers.sinks.jsonl import write_jsonl
from lakelayers.sinks.layout import gather_by
from lakelayers.sinks.tables import (
    create_databases_for,
    create_external_json_table,
    create_layer_table,
    create_managed_table,
    write_table,
)
from lakelayers.sources.tables import scan_external_table, scan_table


def rows_of(df):
    return sorted(tuple(row) for row in df.collect())


def test_names():
    assert layer_table("public_api", "posts", "bronze") == "public_api_posts_bronze"
    assert layer_database("gold") == "gold_zone"
    assert raw_folder("/raw/", "a", "b") == "/raw/a/b/"
    assert quote("a`b") == "`a``b`"
    assert TableRef("d", "t", "c").sql == "`c`.`d`.`t`"
    with pytest.raises(ValueError):
        layer_table("a", "b", "platinum")


def test_append_matches_names(spark, table):
    ref = table("t")
    create_managed_table(spark, ref, "a INT, b STRING, c DOUBLE")
    write_table(spark.sql("SELECT 'x' AS b, 1.5D AS c, 1 AS a"), ref)
    write_table(spark.sql("SELECT 2 AS a, 'y' AS b"), ref)
    assert rows_of(scan_table(spark, ref)) == [(1, "x", 1.5), (2, "y", None)]
    with pytest.raises(AnalysisException):
        write_table(spark.sql("SELECT 3 AS a, 'z' AS b, 0D AS c, 1 AS extra"), ref)
    assert scan_table(spark, ref).count() == 2


def test_overwrite_replaces_present_partitions_only(spark, table):
    ref = table("t")
    create_managed_table(spark, ref, "v INT, p STRING", ["p"])
    write_table(spark.sql("SELECT * FROM VALUES (1, 'a'), (2, 'b') AS t(v, p)"), ref)
    write_table(spark.sql("SELECT 'a' AS p, 9 AS v"), ref, "overwrite")
    assert rows_of(scan_table(spark, ref)) == [(2, "b"), (9, "a")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").upper() == "STATIC"


def test_overwrite_of_unpartitioned_table_replaces_all(spark, table):
    ref = table("t")
    create_managed_table(spark, ref, "v INT")
    write_table(spark.range(5).select(F.col("id").cast("int").alias("v")), ref)
    write_table(spark.sql("SELECT 7 AS v"), ref, "overwrite")
    assert rows_of(scan_table(spark, ref)) == [(7,)]


@pytest.mark.parametrize("mode", ["append", "overwrite"])
def test_empty_frame_is_not_written(spark, table, mode):
    ref = table("t")
    create_managed_table(spark, ref, "v INT")
    write_table(spark.sql("SELECT 7 AS v"), ref)
    assert write_table(spark.sql("SELECT 1 AS v").filter("v > 1"), ref, mode) is False
    assert rows_of(scan_table(spark, ref)) == [(7,)]


def test_write_counts_rows_without_another_pass(spark, table):
    ref, seen = table("t"), Observation()
    create_managed_table(spark, ref, "v BIGINT")
    write_table(spark.range(1000).withColumnRenamed("id", "v"), ref, observation=seen)
    assert seen.get == {"rows": 1000}


def test_unknown_mode(spark, table):
    with pytest.raises(ValueError):
        write_table(spark.range(1), table("t"), "merge")


def test_rebalance_splits_a_hot_partition_value(spark, table):
    """A value with most rows is written by several tasks, most others by one."""
    ref = table("t")
    create_managed_table(spark, ref, "v BIGINT, text STRING, p STRING", ["p"])
    hot = spark.range(200_000).select(
        F.col("id").alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("text"),
        F.when(F.col("id") % 100 == 0, F.concat(F.lit("p"), F.col("id") % 1000)).otherwise("hot").alias("p"),
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "1m")
    try:
        write_table(hot, ref, rebalance_by=["p"])
    finally:
        spark.conf.set(size, before)
    files = scan_table(spark, ref).groupBy("p").agg(F.countDistinct("_metadata.file_path").alias("n"))
    counts = {row["p"]: row["n"] for row in files.collect()}
    assert counts.pop("hot") > 3
    assert sum(n == 1 for n in counts.values()) > len(counts) / 2
    assert scan_table(spark, ref).count() == 200_000


def test_no_gathering_without_adaptive_execution(spark):
    frame = spark.range(10)
    assert "Exchange" in gather_by(frame, ["id"])._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert "Exchange" not in gather_by(frame, ["id"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_managed_table_is_dropped_only_on_request(spark, table):
    ref = table("t")
    create_managed_table(spark, ref, "v INT")
    write_table(spark.sql("SELECT 7 AS v"), ref)
    create_managed_table(spark, ref, "v INT")
    assert scan_table(spark, ref).count() == 1
    create_managed_table(spark, ref, "w STRING", replace=True)
    assert scan_table(spark, ref).columns == ["w"]


def test_external_table_keeps_files_and_tolerates_bad_lines(spark, table, tmp_path):
    folder = tmp_path / "it's raw"
    folder.mkdir()
    (folder / "a.json").write_text('{"v":1}\n{oops\n{"v":2}\n')
    ref = table("t")
    create_external_json_table(spark, ref, "v INT", str(folder))
    assert {row[0] for row in scan_external_table(spark, ref, is_partitioned=False).collect()} == {1, 2, None}
    create_external_json_table(spark, ref, "v STRING", str(folder), replace=True)
    assert scan_table(spark, ref).dtypes == [("v", "string")]
    assert (folder / "a.json").exists()


def test_partition_repair_and_pruning(spark, table, tmp_path):
    folder, ref = str(tmp_path / "raw"), table("t")
    days = spark.range(30).select(F.col("id").alias("v"), (F.col("id") % 3).cast("int").alias("day"))
    write_jsonl(days.filter("day = 0"), folder, ["day"])
    create_external_json_table(spark, ref, "v BIGINT, day INT", folder, ["day"])
    write_jsonl(days.filter("day > 0"), folder, ["day"])
    assert scan_external_table(spark, ref, is_partitioned=False).count() == 10
    found = scan_external_table(spark, ref, {"day": [1, 2]})
    assert found.count() == 20
    assert "PartitionFilters: [day" in found._jdf.queryExecution().executedPlan().toString()
    assert len(found.inputFiles()) < len(scan_table(spark, ref).inputFiles())


def test_databases_and_layer_tables(spark, tmp_path):
    names = {layer: f"x_{layer}_{tmp_path.name}" for layer in ("raw", "bronze", "silver", "gold")}
    create_databases_for(spark, "bronze", names, location=str(tmp_path))
    assert spark.catalog.databaseExists(names["raw"]) and spark.catalog.databaseExists(names["bronze"])
    assert not spark.catalog.databaseExists(names["silver"])
    create_databases_for(spark, "gold", names, location=str(tmp_path))
    ref = TableRef(names["silver"], "s")
    for _ in range(2):
        create_layer_table(spark, ref, "silver")
    assert spark.table(ref.sql).columns == [
        "record_id", "payload_json", "payload_size", "payload_hash", "processed_at", "standardized_at",
    ]


class OtherCatalogFrame:
    """Stands for a frame whose target lies in a data source V2 catalog."""

    def __init__(self):
        self.sparkSession, self.conf, self.calls = self, {}, []

    def isEmpty(self):
        return False

    def writeTo(self, name):
        self.calls.append(name)
        return self

    def append(self):
        self.calls.append("append")

    def overwritePartitions(self):
        self.calls.append("overwritePartitions")


@pytest.mark.parametrize("mode, call", [("append", "append"), ("overwrite", "overwritePartitions")])
def test_other_catalogs_use_their_own_write(mode, call):
    frame = OtherCatalogFrame()
    assert write_table(frame, TableRef("d", "t", "lake"), mode)
    assert frame.calls == ["`lake`.`d`.`t`", call]


def test_a_column_may_be_called_provider(spark, table):
    ref = table("t")
    create_managed_table(spark, ref, "Provider STRING")
    write_table(spark.sql("SELECT 'x' AS Provider"), ref)
    assert rows_of(scan_table(spark, ref)) == [("x",)]
