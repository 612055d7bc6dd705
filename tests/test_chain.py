import json
from dataclasses import replace

import pytest
from pyspark.errors import AnalysisException

from lakelayers.__main__ import parse_arguments
from lakelayers.operators.layers import count_records, normalize, standardize
from lakelayers.plans.chain import Entity, run_chain, run_layer
from lakelayers.sinks.tables import create_managed_table, write_table
from lakelayers.sources.jsonl import scan_jsonl
from lakelayers.streaming.bronze import run_bronze_incremental

POSTS = [
    {"id": 1, "userId": 1, "title": "first", "body": "ä"},
    {"id": 2, "userId": 1, "title": "second", "body": None},
    {"id": 3, "userId": 2, "title": "third", "body": "c"},
]


@pytest.fixture
def spec(tmp_path):
    databases = {layer: f"{layer}_{tmp_path.name}" for layer in ("raw", "bronze", "silver", "gold")}
    return Entity(
        "public_api", "posts", str(tmp_path / "lake"), databases=databases,
        database_root=str(tmp_path / "tables"), run_ts="2024-05-06 07:08:09",
    )


@pytest.fixture
def land(tmp_path):
    def write(lines, name="a.json"):
        folder = tmp_path / "lake" / "public_api" / "posts"
        folder.mkdir(parents=True, exist_ok=True)
        texts = [line if isinstance(line, str) else json.dumps({"payload": line}) for line in lines]
        (folder / name).write_text("\n".join(texts))

    return write


def rows(spark, spec, layer):
    return spark.table(spec.table(layer).sql).collect()


@pytest.mark.parametrize("schema", [None, "struct<id: string, title: string>", "string", "variant"])
def test_three_posts(spark, spec, land, schema):
    land(POSTS)
    spec = replace(spec, payload_schema=schema)
    runs = run_chain(spark, spec)
    assert [(run.layer, run.rows_in, run.rows_out) for run in runs] == [
        ("bronze", 3, 3), ("silver", 3, 3), ("gold", 3, 1),
    ]
    silver = rows(spark, spec, "silver")
    assert {row["record_id"] for row in silver} == {"1", "2", "3"}
    assert all(len(row["payload_hash"]) == 64 for row in silver)
    assert all(row["payload_size"] == len(row["payload_json"]) for row in silver)
    (gold,) = rows(spark, spec, "gold")
    assert (gold["records_total"], gold["entity_type"]) == (3, "posts")
    assert str(gold["computed_at"]) == "2024-05-06 07:08:09"


def test_inferred_payload_leaves_nulls_out(spark, spec, land):
    land(POSTS)
    run_layer(spark, spec, "bronze")
    texts = {row["record_id"]: row["payload_json"] for row in rows(spark, spec, "bronze")}
    assert texts["1"] == '{"body":"ä","id":1,"title":"first","userId":1}'
    assert texts["2"] == '{"id":2,"title":"second","userId":1}'


def test_empty_chain_stays_empty(spark, spec, land):
    land([])
    runs = run_chain(spark, spec)
    assert [(run.rows_in, run.rows_out) for run in runs] == [(0, 0), (0, 0), (0, 1)]
    assert rows(spark, spec, "silver") == []
    assert rows(spark, spec, "gold")[0]["records_total"] == 0


def test_folder_without_files(spark, spec, tmp_path):
    (tmp_path / "lake" / "public_api" / "posts").mkdir(parents=True)
    assert run_layer(spark, spec, "bronze").rows_in == 0


def test_missing_folder_is_an_error(spark, spec):
    with pytest.raises(AnalysisException):
        run_layer(spark, spec, "bronze")


def test_null_ids_do_not_reach_silver(spark, spec, land):
    land([*POSTS[:2], {"id": None, "title": "x"}])
    runs = run_chain(spark, spec)
    assert [run.rows_out for run in runs] == [3, 2, 1]
    assert rows(spark, spec, "gold")[0]["records_total"] == 2


def test_ids_keep_their_text_under_a_schema(spark, spec, land):
    land(['{"payload":{"id":1}}', '{"payload":{"id":"A2"}}', '{"payload":{"id":2.50}}', '{"payload":{}}'])
    run_layer(spark, replace(spec, payload_schema="struct<id: string>"), "bronze")
    assert {row["record_id"] for row in rows(spark, spec, "bronze")} == {"1", "A2", "2.50", None}


def test_payload_without_the_id_field(spark):
    assert normalize(spark.sql("SELECT struct(1 AS a) AS payload")).first()["record_id"] is None


def test_variant_payload_keeps_all_fields(spark, spec, land):
    land([POSTS[1], "{oops"])
    run_layer(spark, replace(spec, payload_schema="variant"), "bronze")
    texts = {row["record_id"]: row["payload_json"] for row in rows(spark, spec, "bronze")}
    assert json.loads(texts.pop("2")) == POSTS[1]
    assert texts == {}
    assert [row["line"] for row in spark.table(spec.malformed_table.sql).collect()] == ["{oops"]


def test_timestamps_keep_microseconds(spark):
    frame = spark.sql("SELECT struct(1 AS id, TIMESTAMP_NTZ'2024-01-01 00:00:00.123456' AS ts) AS payload")
    assert normalize(frame).first()["payload_json"] == '{"id":1,"ts":"2024-01-01T00:00:00.123456"}'
    options = {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
    text = normalize(frame, json_options=options).first()["payload_json"]
    assert text == '{"id":1,"ts":"2024-01-01 00:00:00.123456"}'


def test_nested_id_field(spark):
    frame = spark.sql("SELECT struct(struct(5 AS id) AS user) AS payload")
    assert normalize(frame, "user.id").first()["record_id"] == "5"


@pytest.mark.parametrize("schema", [None, "struct<id: bigint, title: string>"])
def test_malformed_lines(spark, spec, land, schema):
    land([*POSTS, "{oops", '{"payload":{"id":4'])
    plain = replace(spec, payload_schema=schema, quarantine=False)
    run = run_layer(spark, plain, "bronze")
    assert (run.rows_in, run.rows_out, run.rows_malformed) == (5, 5, 2)
    assert sum(row["record_id"] is None for row in rows(spark, spec, "bronze")) == 2
    apart = replace(plain, quarantine=True, mode="overwrite")
    run = run_layer(spark, apart, "bronze")
    assert (run.rows_in, run.rows_out, run.rows_malformed) == (5, 3, 2)
    lines = spark.table(apart.malformed_table.sql).collect()
    assert {row["line"] for row in lines} == {"{oops", '{"payload":{"id":4'}


@pytest.mark.parametrize("schema", [None, "struct<id: string>"])
def test_only_malformed_lines(spark, spec, land, schema):
    land(["{oops", "{again"])
    apart = replace(spec, payload_schema=schema, quarantine=True)
    run = run_layer(spark, apart, "bronze")
    assert (run.rows_in, run.rows_out, run.rows_malformed) == (2, 0, 2)
    assert spark.table(apart.malformed_table.sql).count() == 2


def test_rerun_appends_or_overwrites(spark, spec, land):
    land(POSTS)
    run_layer(spark, spec, "bronze")
    run_layer(spark, spec, "bronze")
    assert len(rows(spark, spec, "bronze")) == 6
    run_layer(spark, replace(spec, mode="overwrite"), "bronze")
    assert len(rows(spark, spec, "bronze")) == 3


def test_overwrite_with_nothing_keeps_the_table(spark, spec, land):
    land(POSTS)
    run_chain(spark, spec, "silver")
    run = run_layer(spark, replace(spec, mode="overwrite"), "silver", lambda df: standardize(df.limit(0)))
    assert run.rows_out == 0
    assert len(rows(spark, spec, "silver")) == 3


def test_tables_are_not_created_unless_asked(spark, spec, land):
    land(POSTS)
    with pytest.raises(AnalysisException):
        run_layer(spark, replace(spec, create_tables=False), "bronze")


def test_incremental_bronze_takes_each_file_once(spark, spec, land, table, tmp_path):
    ref = table("bronze")
    checkpoint = tmp_path / "checkpoint"

    def run():
        run_bronze_incremental(
            spark, spec.raw_path, "payload struct<id: string, title: string>", ref, str(checkpoint)
        )
        return spark.table(ref.sql).count()

    land(POSTS[:2])
    assert run() == 2
    assert run() == 2
    write_table(spark.sql("SELECT 'x' AS record_id, 'batch' AS load_id"), ref)
    land([*POSTS[2:], "{oops"], "b.json")
    assert run() == 4
    # A batch that was written but not committed is repeated, and replaces itself.
    for commit in (checkpoint / "commits").glob("*1*"):
        commit.unlink()
    assert run() == 4
    malformed = spark.table(f"`{ref.database}`.`{ref.table}_malformed`")
    assert [row["line"] for row in malformed.collect()] == ["{oops"]


def test_stream_needs_a_load_partition(spark, spec, land, table, tmp_path):
    ref = table("bronze")
    create_managed_table(spark, ref, "record_id STRING, payload_json STRING, processed_at TIMESTAMP")
    land(POSTS)
    with pytest.raises(ValueError, match="load_id"):
        run_bronze_incremental(spark, spec.raw_path, "payload struct<id: string>", ref, str(tmp_path / "c"))


def test_repeated_load_replaces_itself(spark, spec, land):
    land([*POSTS, "{oops"])
    first, second = replace(spec, load_id="a"), replace(spec, load_id="b")
    for load in (first, first, second):
        run_chain(spark, load)
    assert len(rows(spark, spec, "silver")) == 6
    assert sorted((r["load_id"], r["records_total"]) for r in rows(spark, spec, "gold")) == [("a", 3), ("b", 3)]
    assert spark.table(spec.malformed_table.sql).count() == 2


def test_chain_lands_bodies_first(spark, spec):
    bodies = spark.createDataFrame([('[{"id":1},{"id":2}]',), ("{oops",)], "body string")
    runs = run_chain(spark, spec, bodies=bodies)
    assert [(r.layer, r.rows_in, r.rows_out, r.rows_malformed) for r in runs] == [
        ("raw", 2, 2, 1), ("bronze", 2, 2, 0), ("silver", 2, 2, 0), ("gold", 2, 1, 0),
    ]


def test_functions_on_empty_frames(spark):
    empty = spark.createDataFrame([], "record_id string, payload_json string")
    assert standardize(empty).count() == 0
    assert count_records(empty, "posts").first()["records_total"] == 0


def test_scan_modes(spark, land, spec):
    land(["{oops", '{"payload":{"id":1}}'])
    schema = "payload struct<id: int>"
    assert scan_jsonl(spark, spec.raw_path, schema).count() == 2
    dropped = scan_jsonl(spark, spec.raw_path, schema, malformed="DROPMALFORMED")
    assert [row["payload"]["id"] for row in dropped.collect()] == [1]


def test_command_line():
    options = parse_arguments(["chain", "--source", "a", "--entity", "b", "--raw-root", "/r", "--no-quarantine"])
    assert (options.layer, options.create_tables, options.quarantine) == ("chain", True, False)
