"""Digests of large files and the discovery of partitions."""

import hashlib
import os
import subprocess
import sys

from pyspark.sql import functions as F

from lakelayers.sinks.jsonl import write_jsonl
from lakelayers.sinks.tables import create_external_json_table
from lakelayers.sources.digests import stream_sha256
from lakelayers.sources.files import file_manifest
from lakelayers.sources.tables import new_partitions, register_partitions, repair_partitions, scan_external_table, scan_table

GIB = 1 << 30


def test_a_file_of_three_gigabytes_is_hashed_in_little_memory(tmp_path):
    large = tmp_path / "large.bin"
    with large.open("wb") as f:
        f.truncate(3 * GIB)
    code = (
        "import resource, sys; from lakelayers.sources.digests import stream_sha256; "
        "print(stream_sha256(sys.argv[1]), resource.getrusage(resource.RUSAGE_SELF).ru_maxrss)"
    )
    found, peak = subprocess.run([sys.executable, "-c", code, f"file:{large}"], capture_output=True, check=True, text=True).stdout.split()
    expected, block = hashlib.sha256(), bytes(1 << 20)
    for _ in range(3 * 1024):
        expected.update(block)
    assert found == expected.hexdigest() and int(peak) < 200 * 1024


def test_streamed_and_scanned_digests_agree(spark, tmp_path):
    folder = tmp_path / "drop"
    (folder / "sub dir").mkdir(parents=True)
    contents = {"a.txt": b"1", "b é.txt": os.urandom(5000), "sub dir/c%20.txt": b"x" * 200_000, "_hidden": b"1", ".dot": b"2"}
    for name, data in contents.items():
        (folder / name).write_bytes(data)
    shown = {n.rsplit("/")[-1]: hashlib.sha256(d).hexdigest() for n, d in contents.items() if n[0] not in "_."}
    for limit in (0, 4999, 5000, GIB):
        rows = file_manifest(spark, str(folder), whole_bytes=limit).collect()
        assert {r.name: r.sha256 for r in rows} == shown and len(rows) == 3
    assert stream_sha256(str(folder / "b é.txt"), block_bytes=7) == shown["b é.txt"]
    assert "Arrow" not in file_manifest(spark, str(folder))._jdf.queryExecution().executedPlan().toString()


def landed(spark, table, tmp_path):
    ref, folder = table("landed"), str(tmp_path / "landed")
    frame = spark.range(40).select(
        "id", F.concat(F.lit("a'/%= é"), F.col("id") % 3).alias("kind"), F.when(F.col("id") % 4 > 0, (F.col("id") % 4).cast("string")).alias("day_of")
    )
    create_external_json_table(spark, ref, "id BIGINT, kind STRING, `day_of` STRING", folder, ["kind", "day_of"], repair=False)
    return ref, folder, frame


def test_only_new_partitions_are_registered(spark, table, tmp_path):
    ref, folder, frame = landed(spark, table, tmp_path)
    write_jsonl(frame.filter("id < 2"), folder, ["kind", "day_of"])
    assert register_partitions(spark, ref) == 2 and register_partitions(spark, ref) == 0
    write_jsonl(frame.filter("id >= 2"), folder, ["kind", "day_of"])
    os.makedirs(f"{folder}/other=1")
    with open(f"{folder}/other=1/part-x.json", "w") as f:
        f.write("{}")
    assert new_partitions(spark, ref).count() == 10
    rows = scan_external_table(spark, ref).collect()
    assert sorted((r.id, r.kind, r["day_of"]) for r in rows if r["day_of"]) == sorted((r.id, r.kind, r["day_of"]) for r in frame.collect() if r["day_of"])
    assert len(rows) == 40
    repair_partitions(spark, ref)
    assert spark.sql(f"SHOW PARTITIONS {ref.sql}").count() == 12


def test_a_scan_of_registered_partitions_lists_nothing(spark, table, tmp_path, monkeypatch):
    ref, folder, frame = landed(spark, table, tmp_path)
    write_jsonl(frame, folder, ["kind", "day_of"])
    register_partitions(spark, ref)
    import lakelayers.sources.tables as tables

    monkeypatch.setattr(tables, "register_partitions", lambda *_: 1 / 0)
    monkeypatch.setattr(tables, "repair_partitions", lambda *_: 1 / 0)
    assert scan_external_table(spark, ref, {"kind": "a'/%= é1"}, is_partitioned=False).count() == 13


def test_an_empty_location(spark, table, tmp_path):
    ref, folder, _ = landed(spark, table, tmp_path)
    os.makedirs(folder, exist_ok=True)
    assert register_partitions(spark, ref) == 0


def test_a_hot_value_of_one_scan_task_is_written_by_several(spark, tmp_path):
    """Tasks are sized by rows, also where lines compress well and lie in one block."""
    from lakelayers.sinks.layout import gather_counted

    frame = spark.range(0, 6000, 1, 1).selectExpr(
        "repeat('same', 50) || id AS line", "CASE WHEN id % 100 < 90 THEN 'hot' WHEN id % 100 < 95 THEN 'v' || id % 10 END AS kind", "id % 1 AS day"
    )
    tasks = gather_counted(frame, ["kind", "day"], frame, 500).withColumn("task", F.spark_partition_id())
    spread = {r["kind"]: (r["n"], r["tasks"]) for r in tasks.groupBy("kind").agg(F.count("*").alias("n"), F.countDistinct("task").alias("tasks")).collect()}
    assert spread["hot"][0] == 5400 and spread["hot"][1] >= 8
    assert spread[None][0] == 300 and all(n == 60 and t <= 2 for kind, (n, t) in spread.items() if kind not in ("hot", None))
    assert max(r["count"] for r in tasks.groupBy("task").count().collect()) < 1500
    assert sorted(tasks.drop("task").collect(), key=repr) == sorted(frame.collect(), key=repr)
    write_jsonl(frame, f"{tmp_path}/out", ["kind", "day"])
    back = spark.read.json(f"{tmp_path}/out")
    assert back.count() == 6000 and back.filter("kind IS NULL").count() == 300
