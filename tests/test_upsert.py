"""Merges into file tables."""

import os

import pytest
from pyspark.sql import functions as F

import lakelayers.sinks.upsert as upsert
from lakelayers.sinks.tables import create_managed_table, write_table
from lakelayers.sinks.upsert import finish_merges, merge_into
from lakelayers.sources.tables import scan_table, table_location

COLUMNS = "id BIGINT, name STRING, n INT, part STRING"


def files(spark, ref):
    root = table_location(spark, ref).removeprefix("file:")
    found = {}
    for folder, _, names in os.walk(root):
        if "/_" not in folder.removeprefix(root):
            found.update({os.path.join(folder, n): os.stat(os.path.join(folder, n)).st_mtime_ns for n in names if n.startswith("part-")})
    return found


def filled(spark, ref, partition_by=(), rows=100):
    create_managed_table(spark, ref, COLUMNS, partition_by)
    frame = spark.range(rows).selectExpr("id", "concat('a', id) name", "1 n", "concat('p/', id % 2, ' %') part")
    write_table(frame.repartitionByRange(5, "id"), ref)


def changes(spark, rows):
    return spark.createDataFrame(rows, "id long, name string, part string")


@pytest.mark.parametrize("partition_by", [(), ("part",)])
def test_only_touched_files_are_written_anew(spark, table, partition_by):
    ref = table("t")
    filled(spark, ref, partition_by)
    before = files(spark, ref)
    result = merge_into(spark, ref, changes(spark, [(3, "new", "p/1 %"), (500, "more", "q")]), ["id"])
    after = files(spark, ref)
    assert result.files_removed == 1 and len(set(before) - set(after)) == 1
    assert all(after[name] == time for name, time in before.items() if name in after) and len(set(before) & set(after)) == len(before) - 1
    rows = {r.id: (r.name, r.n, r.part) for r in scan_table(spark, ref).collect()}
    assert len(rows) == scan_table(spark, ref).count() == 101
    assert rows[3] == ("new", 1, "p/1 %") and rows[500] == ("more", None, "q") and rows[4] == ("a4", 1, "p/0 %")


def test_nulls_deletes_and_missing_columns(spark, table):
    ref = table("t")
    filled(spark, ref, rows=4)
    write_table(spark.sql("SELECT CAST(NULL AS BIGINT) id, 'none' name, 7 n, 'p' part UNION ALL SELECT 1, 'again', 8, 'p'"), ref)
    source = spark.createDataFrame([(1, 50), (2, 60), (None, 70), (9, 80), (8, 90)], "id long, n int")
    merge_into(spark, ref, source, ["id"], delete=F.col("id").isin(2, 8))
    rows = sorted(((r.id, r.name, r.n) for r in scan_table(spark, ref).collect()), key=repr)
    assert rows == sorted([(0, "a0", 1), (1, "a1", 50), (1, "again", 50), (3, "a3", 1), (None, "none", 7), (None, None, 70), (9, None, 80)], key=repr)


def test_update_or_insert_only(spark, table):
    ref = table("t")
    filled(spark, ref, rows=3)
    merge_into(spark, ref, changes(spark, [(1, "x", "p"), (7, "y", "p")]), ["id"], insert=False)
    merge_into(spark, ref, changes(spark, [(1, "z", "p"), (8, "w", "p")]), ["id"], update=False)
    assert {r.id: r.name for r in scan_table(spark, ref).collect()} == {0: "a0", 1: "x", 2: "a2", 8: "w"}


def test_bad_sources_are_refused(spark, table):
    ref = table("t")
    filled(spark, ref, rows=3)
    before = files(spark, ref)
    for source, keys in (
        (changes(spark, [(1, "x", "p"), (1, "y", "p")]), ["id"]),
        (changes(spark, [(1, "x", "p")]).withColumn("odd", F.lit(1)), ["id"]),
        (changes(spark, [(1, "x", "p")]).drop("id"), ["id"]),
        (changes(spark, [(1, "x", "p")]), []),
    ):
        with pytest.raises(ValueError):
            merge_into(spark, ref, source, keys)
    assert files(spark, ref) == before


def test_an_empty_source_and_an_empty_table(spark, table):
    ref = table("t")
    create_managed_table(spark, ref, COLUMNS)
    assert merge_into(spark, ref, changes(spark, []), ["id"]).files_removed == 0
    merge_into(spark, ref, changes(spark, [(1, "x", "p")]), ["id"])
    assert scan_table(spark, ref).count() == 1


@pytest.mark.parametrize("moves", [0, 1])
def test_a_merge_broken_after_its_journal_is_finished(spark, table, monkeypatch, moves):
    ref = table("t")
    filled(spark, ref, ("part",))
    done, move = [], upsert.Folder.move

    def failing(self, name, to):
        if len(done) == moves:
            raise OSError("lost")
        done.append(to)
        move(self, name, to)

    monkeypatch.setattr(upsert.Folder, "move", failing)
    with pytest.raises(OSError):
        merge_into(spark, ref, changes(spark, [(3, "new", "p/1 %"), (4, "newer", "r")]), ["id"])
    monkeypatch.undo()
    assert finish_merges(spark, ref) == 1 and finish_merges(spark, ref) == 0
    rows = {r.id: r.name for r in scan_table(spark, ref).collect()}
    assert len(rows) == scan_table(spark, ref).count() == 100 and rows[3] == "new" and rows[4] == "newer"


def test_a_merge_broken_before_its_journal_changes_nothing(spark, table, monkeypatch):
    ref = table("t")
    filled(spark, ref)
    before = files(spark, ref)
    monkeypatch.setattr(upsert.Folder, "publish", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        merge_into(spark, ref, changes(spark, [(3, "new", "p")]), ["id"])
    monkeypatch.undo()
    assert finish_merges(spark, ref) == 0 and files(spark, ref) == before and scan_table(spark, ref).count() == 100
