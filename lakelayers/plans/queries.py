"""The registered queries: every operator over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelayers.functions import rules
from lakelayers.functions.fingerprint import content_sha256
from lakelayers.functions.json_text import EXACT_TIMES, fill_absent_keys
from lakelayers.functions.masking import (
    clip_text,
    mask_by_key,
    mask_columns,
    mask_full,
    mask_partial,
    preview_by_key,
)
from lakelayers.names import TableRef
from lakelayers.operators import cubes
from lakelayers.operators.asof import asof_join
from lakelayers.operators.audit import METRIC_COLUMNS, classify_messages, lineage_audit, record_metrics
from lakelayers.operators.landing import (
    METADATA_SCHEMA,
    LandingRun,
    envelope,
    land_records,
    land_responses,
    unnest_responses,
    unreadable_responses,
    with_batch_ids,
)
from lakelayers.operators.layers import count_records, normalize, standardize
from lakelayers.operators.manifests import manifest_diff
from lakelayers.operators.merge import survivorship_merge
from lakelayers.operators.multisets import multiset_difference, multiset_intersection
from lakelayers.operators.ordinals import parquet_with_ordinal, with_ordinal
from lakelayers.operators.quality import parse_columns, split_rejects, validate
from lakelayers.operators.ranking import top_k
from lakelayers.operators.sessions import sessions
from lakelayers.plans.chain import Entity, run_chain, run_layer
from lakelayers.scratch import scratch_folder, stage
from lakelayers.sinks.jsonl import write_jsonl, write_lines
from lakelayers.sinks.loads import committed_loads, new_attempt
from lakelayers.sinks.tables import (
    create_database,
    create_external_json_table,
    create_layer_table,
    create_managed_table,
    write_table,
)
from lakelayers.sinks.upsert import merge_into
from lakelayers.sources.files import file_manifest, list_files, read_csv_drop
from lakelayers.sources.jsonl import CORRUPT_COLUMN, is_corrupt, scan_jsonl
from lakelayers.sources.tables import register_partitions, scan_external_table, scan_table
from lakelayers.streaming.bronze import run_bronze_incremental
from lakelayers.streaming.silver import run_silver_incremental

RUN_TIME = datetime(2024, 5, 6, 7, 8, 9)
RUN_TEXT = "2024-05-06 07:08:09"
EVENT_PAYLOAD = (
    "struct<id: string, user_id: bigint, event_type: string, value: double, props: string, ts: string>"
)
EXACT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
ROWS_PER_FILE = 100_000
FILE_IDS = 5_000

# Words that split the conversations; the error keywords do not occur in them.
TEXT_KEYWORDS = (("first", ("ment",)), ("second", ("ent", "tion")), ("third", ("the", "der")))

TOKENS = (
    "true", "1", "YES", "on", "off", "no", "0", " 5 ", "1e3", "5.0", "1_000", "-17", "x", "", ".5",
    "9223372036854775808", "nan", "-Infinity", "inf", "\u00a07\u2003",
)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _database(spark: SparkSession, label: str) -> str:
    """A new database whose tables lie in the scratch folder."""
    name = f"lakelayers_{label}_{uuid.uuid4().hex[:12]}"
    create_database(spark, name, location=scratch_folder(spark, name))
    return name


def _case(key: Column, *values: object) -> Column:
    """The value at position ``key`` modulo their number."""
    items = [value if isinstance(value, Column) else F.lit(value) for value in values]
    return F.get(F.array(*items), (key % len(items)).cast("int"))


def _event_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "events").select(
        F.struct(F.col("event_id").alias("id"), "user_id", "event_type", "value", "props", "ts").alias("payload")
    )


def _land_events(spark: SparkSession, sf_dir: str, raw_root: str) -> None:
    numbered = parquet_with_ordinal(spark, f"{sf_dir}/events.parquet")
    land_records(
        numbered.withColumnRenamed("event_id", "id"), f"{raw_root}/shop/events/",
        LandingRun("shop", "events", "raw_events", RUN_TIME, ROWS_PER_FILE),
        ["id", "user_id", "event_type", "value", "props", "ts"], ordinal="ordinal", skip_empty=False,
    )


def _event_entity(spark: SparkSession, label: str, raw_root: str, schema: str | None) -> Entity:
    folder = scratch_folder(spark, label)
    unique = uuid.uuid4().hex[:12]
    databases = {
        layer: f"lakelayers_{label}_{layer}_{unique}" for layer in ("raw", "bronze", "silver", "gold")
    }
    return Entity(
        "shop", "events", raw_root, payload_schema=schema, databases=databases,
        database_root=folder, run_ts=RUN_TEXT,
    )


def _audited(df: DataFrame) -> DataFrame:
    """The audit timestamps of a layer as text."""
    times = [name for name, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({name: F.date_format(name, "yyyy-MM-dd HH:mm:ss") for name in times})


def _chain(spark: SparkSession, sf_dir: str, until: str) -> DataFrame:
    raw_root = scratch_folder(spark, "raw")
    _land_events(spark, sf_dir, raw_root)
    spec = _event_entity(spark, f"to_{until}", raw_root, EVENT_PAYLOAD)
    run_chain(spark, spec, until)
    return scan_table(spark, spec.table(until))


# --- scans -------------------------------------------------------------------------------


def json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "json_scan")
    rows = _read(spark, sf_dir, "events")
    write_jsonl(rows, folder, rows_per_file=ROWS_PER_FILE)
    return scan_jsonl(spark, folder, rows.schema).withColumn("ts", F.date_format("ts", EXACT))


def json_scan_permissive(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "json_scan_permissive")
    events = _read(spark, sf_dir, "events")
    good = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    bad = F.concat(F.lit("{oops "), F.col("event_id").cast("string"))
    line = F.when(F.col("event_id") % 100 == 0, bad).otherwise(good)
    write_lines(events.select(line.alias("line")), folder, rows_per_file=ROWS_PER_FILE)
    schema = "event_id bigint, user_id bigint, event_type string, value double"
    return scan_jsonl(spark, folder, schema, keep_corrupt=True).withColumnRenamed(
        CORRUPT_COLUMN, "bad_line"
    )


def csv_drop_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "csv_drop") + "/"
    customers = _read(spark, sf_dir, "customer")
    customers.write.mode("append").option("header", "true").csv(folder)
    _read(spark, sf_dir, "supplier").select("s_name").write.mode("append").text(folder)
    return read_csv_drop(spark, folder, customers.schema).drop("source_file")


def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good customers by their columns, broken ones by their text; none is lost."""
    folder = scratch_folder(spark, "csv_rejects") + "/"
    key, name = F.col("c_custkey").cast("string"), F.col("c_name")
    line = _case(
        F.col("c_custkey"), F.concat(key, F.lit(","), name), F.concat(F.lit("x,"), name),
        F.concat(key, F.lit(","), name, F.lit(",extra")), F.concat(key, F.lit(","), name), key,
    )
    lines = _read(spark, sf_dir, "customer").select(line.alias("line"))
    lines.write.mode("append").option("compression", "none").text(folder + "drop.csv")
    rows = read_csv_drop(
        spark, folder + "drop.csv", "k bigint, name string", header=False, keep_corrupt=True
    )
    bad = is_corrupt(rows)
    return rows.select(
        F.when(~bad, F.col("k")).alias("k"), F.when(~bad, F.col("name")).alias("name"),
        F.col(CORRUPT_COLUMN).alias("line"),
    )


def table_scan_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref = TableRef(_database(spark, "scan"), "customer")
    spark.sql(f"CREATE TABLE {ref.sql} USING parquet LOCATION '{sf_dir}/customer.parquet'")
    return scan_table(spark, ref, {"c_mktsegment": ["BUILDING", "MACHINERY"], "c_nationkey": 3})


def _external_events(spark: SparkSession, sf_dir: str, label: str) -> TableRef:
    folder = scratch_folder(spark, label)
    rows = _read(spark, sf_dir, "events").select("event_id", "user_id", "value", "event_type")
    write_jsonl(rows, folder, ["event_type"], ROWS_PER_FILE)
    ref = TableRef(_database(spark, label), "events")
    create_external_json_table(
        spark, ref, "event_id BIGINT, user_id BIGINT, value DOUBLE, event_type STRING", folder,
        ["event_type"],
    )
    return ref


def external_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref = _external_events(spark, sf_dir, "external")
    return scan_external_table(spark, ref, {"event_type": ["click", "purchase"]})


def partition_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per status before and after the repair that follows a second landing."""
    folder = scratch_folder(spark, "repair")
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    open_orders = F.col("o_orderstatus") == "O"
    write_jsonl(orders.filter(open_orders), folder, ["o_orderstatus"], ROWS_PER_FILE)
    ref = TableRef(_database(spark, "repair"), "orders")
    create_external_json_table(
        spark, ref, "o_orderkey BIGINT, o_orderstatus STRING", folder, ["o_orderstatus"]
    )
    write_jsonl(orders.filter(~open_orders), folder, ["o_orderstatus"], ROWS_PER_FILE)

    def counts(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias(name))

    before = stage(counts(scan_external_table(spark, ref, is_partitioned=False), "rows_before"), "before")
    after = counts(scan_external_table(spark, ref), "rows_after")
    return after.join(before, "o_orderstatus", "left").select(
        "o_orderstatus", F.coalesce("rows_before", F.lit(0)).alias("rows_before"), "rows_after"
    )


def partition_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed partitions of a table are found and registered after each landing; scans repair nothing."""
    folder = scratch_folder(spark, "register")
    orders = _read(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(F.col("o_orderpriority"), F.lit("'s 5%/é=")).alias("priority"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("o_orderstatus"),
    )
    ref = TableRef(_database(spark, "register"), "orders")
    columns = "o_orderkey BIGINT, priority STRING, o_orderstatus STRING"
    keys = ["o_orderstatus", "priority"]
    added = []
    for part in (F.col("o_orderstatus") == "O", ~F.col("o_orderstatus").eqNullSafe("O")):
        write_jsonl(orders.filter(part), folder, keys, ROWS_PER_FILE)
        create_external_json_table(spark, ref, columns, folder, keys, repair=False)
        added.append(register_partitions(spark, ref))
    landed = scan_external_table(spark, ref, is_partitioned=False)
    return landed.withColumns({f"added_{i}": F.lit(n).cast("long") for i, n in enumerate(added)})


# --- landing -----------------------------------------------------------------------------


def _bodies(df: DataFrame) -> DataFrame:
    """Response bodies of all shapes from events; the key decides the shape."""
    key, user, kind = (F.col(name).cast("string") for name in ("event_id", "user_id", "event_type"))
    one = F.concat(F.lit('{"id":'), key, F.lit(',"user":'), user, F.lit("}"))
    two = F.concat(F.lit('{"id":'), key, F.lit(',"type":"'), kind, F.lit('"}'))
    body = _case(
        F.col("event_id"),
        F.concat(F.lit("["), one, F.lit(","), two, F.lit("]")),
        F.concat(F.lit('{"total":1,"data":['), one, F.lit("]}")),
        two,
        key,
        F.lit('{"data":null}'),
        F.concat(F.lit('{"data":['), one),
        F.concat(F.lit("["), one, F.lit(",7,null]")),
        F.lit("[]"),
    )
    return df.select("event_id", body.alias("body"))


def unnest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unnest_responses(_bodies(_read(spark, sf_dir, "events")))


def unreadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unreadable_responses(_bodies(_read(spark, sf_dir, "events")))


def response_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decimals of thirty digits in bodies of every shape keep every digit."""
    key = F.col("l_orderkey").cast("string")
    amount = F.concat(F.lit('{"amount":12345678901234567890.'), F.lpad(key, 10, "0"), F.lit('1,"id":'), key, F.lit("}"))
    body = _case(
        F.col("l_orderkey"), amount, F.concat(F.lit("["), amount, F.lit("]")),
        F.concat(F.lit('{"data":['), amount, F.lit("]}")),
    )
    bodies = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", body.alias("body"))
    return unnest_responses(bodies)


def landing_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies that give no records are kept and counted apart from the landed records."""
    folder = scratch_folder(spark, "landing_rejects")
    run = LandingRun("shop", "events", "raw_events", RUN_TIME, ROWS_PER_FILE)
    counts = land_responses(_bodies(_read(spark, sf_dir, "events")), f"{folder}/landed/", run)
    kept = scan_jsonl(spark, f"{folder}/landed_unreadable/", "event_id bigint, body string")
    landed = scan_jsonl(spark, f"{folder}/landed/", "payload struct<id: bigint>").count()
    return kept.withColumns({
        "bodies": F.lit(counts.bodies).cast("long"), "unreadable": F.lit(counts.unreadable).cast("long"),
        "records": F.lit(counts.records).cast("long"), "landed": F.lit(landed).cast("long"),
    })


def landing_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing without records leaves no file behind."""
    folder = scratch_folder(spark, "landing_empty") + "/landed/"
    orders = _read(spark, sf_dir, "orders")
    nothing = orders.filter(F.col("o_orderkey") < 0).select(F.lit("{}").alias("body"))
    counts = land_responses(nothing, folder, LandingRun("shop", "orders", "raw_orders", RUN_TIME))
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    exists = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    return orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders")).withColumns({
        "landed": F.lit(counts.records).cast("long"), "folder_exists": F.lit(bool(exists)),
    })


def enrich_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _read(spark, sf_dir, "events")
    key = F.col("event_id").cast("string")
    record = _case(
        F.col("event_id"),
        F.concat(F.lit('{"id":'), key, F.lit("}")),
        F.concat(F.lit('{"id":'), key, F.lit(',"source":null}')),
        F.concat(F.lit('{"source":"own","id":'), key, F.lit(',"entity_type":"}"}')),
        F.lit("{}"),
    )
    defaults = {"ingested_at": "2024-05-06T07:08:09Z", "source": "shop", "entity_type": F.col("event_type")}
    return events.select("event_id", fill_absent_keys(record, defaults).alias("record"))


def landing_batch_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = LandingRun("shop", "events", "raw_events", RUN_TIME, 500)
    events = _read(spark, sf_dir, "events").select("event_id", "event_type")
    return with_batch_ids(events, run, ["event_id"], unique=True)


def global_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Range of the numbers each return flag gets when all lines are ordered by the flag alone."""
    lines = _read(spark, sf_dir, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber")
    numbered = with_ordinal(lines, "ordinal", ["l_returnflag"])
    return numbered.groupBy("l_returnflag").agg(
        F.min("ordinal").alias("first_ordinal"),
        F.max("ordinal").alias("last_ordinal"),
        F.count("ordinal").alias("ordinals"),
        F.sum(F.col("ordinal") % 1_000_003).alias("checksum"),
    )


def file_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Range and sum of the numbers all lines get by their place in the files."""
    numbered = parquet_with_ordinal(spark, f"{sf_dir}/lineitem.parquet")
    return numbered.agg(
        F.min("ordinal").alias("first_ordinal"),
        F.max("ordinal").alias("last_ordinal"),
        F.count("ordinal").alias("ordinals"),
        F.sum(F.col("ordinal") % 1_000_003).alias("checksum"),
    )


def landing_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = LandingRun("shop", "events", "raw_events", RUN_TIME, 500)
    events = _read(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    request = {
        "request_url": "https://example.com/events",
        "response_status_code": F.when(F.col("event_type") == "error", 500).otherwise(200),
    }
    wrapped = envelope(
        with_batch_ids(events, run, ["event_id"], unique=True), run,
        ["event_id", "user_id", "event_type"], request=request,
    )
    return wrapped.select("payload.*", "metadata.*")


ORDER_LANDING = (
    "payload struct<o_orderkey: bigint, o_custkey: bigint, o_orderstatus: string, "
    "o_totalprice: double, o_orderdate: string, ingested_at: string, source: string, entity_type: string>"
)


def land_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies with one order each, unnested, enriched, wrapped, landed and read back."""
    folder = scratch_folder(spark, "land")
    columns = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    order = F.to_json(F.struct(*columns), EXACT_TIMES)
    body = _case(
        F.col("o_orderkey"), order, F.concat(F.lit("["), order, F.lit("]")),
        F.concat(F.lit('{"data":['), order, F.lit("]}")),
    )
    bodies = _read(spark, sf_dir, "orders").select("o_orderkey", body.alias("body"))
    run = LandingRun("shop", "orders", "raw_orders", RUN_TIME, 500)
    land_responses(bodies, folder, run, order_by=["o_orderkey"], unique=True)
    landed = scan_jsonl(spark, folder, f"{ORDER_LANDING}, metadata {METADATA_SCHEMA}")
    return landed.select(
        "payload.*", "metadata.record_id", "metadata.batch_id", "metadata.file_name",
        "metadata.ingestion_job", "metadata.response_status_code",
    )


def land_jsonl_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "land_partitioned")
    orders = parquet_with_ordinal(spark, f"{sf_dir}/orders.parquet")
    run = LandingRun("shop", "orders", "raw_orders", RUN_TIME, ROWS_PER_FILE)
    land_records(
        orders, folder, run, ["o_orderkey", "o_totalprice"], ["o_orderstatus"], ordinal="ordinal"
    )
    schema = "payload struct<o_orderkey: bigint, o_totalprice: double>, o_orderstatus string"
    landed = scan_jsonl(spark, folder, schema)
    return landed.select("payload.*", "o_orderstatus")


# --- layers ------------------------------------------------------------------------------


def bronze_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _audited(normalize(_event_payloads(spark, sf_dir), run_ts=RUN_TEXT))


def bronze_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scan without schema: Spark infers the fields, in alphabetical order."""
    folder = scratch_folder(spark, "inferred")
    write_jsonl(_event_payloads(spark, sf_dir), folder, rows_per_file=ROWS_PER_FILE)
    return normalize(scan_jsonl(spark, folder)).drop("processed_at")


def bronze_text_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scan that takes payloads as text, for sources whose fields drift."""
    folder = scratch_folder(spark, "text_payload")
    write_jsonl(_event_payloads(spark, sf_dir), folder, rows_per_file=ROWS_PER_FILE)
    return normalize(scan_jsonl(spark, folder, "payload string")).drop("processed_at")


def silver_standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _read(spark, sf_dir, "documents")
    record_id = F.when(F.col("doc_id") % 10 != 0, F.col("doc_id").cast("string"))
    bronze = documents.select(
        record_id.alias("record_id"),
        F.to_json(F.struct("doc_id", "text", "lang")).alias("payload_json"),
    )
    return standardize(bronze).drop("standardized_at")


def gold_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _read(spark, sf_dir, "lineitem")
    return count_records(lines, "lineitem", "l_orderkey").drop("computed_at")


def bronze_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bronze run over lines of which some are broken or hold a value of the wrong type."""
    raw_root = scratch_folder(spark, "raw_broken")
    events = _read(spark, sf_dir, "events")
    key = F.col("event_id").cast("string")
    payload = F.to_json(F.struct(F.struct(key.alias("id"), "user_id", "event_type").alias("payload")))
    broken = F.concat(F.lit('{"payload":{"id":"'), key)
    mistyped = F.concat(F.lit('{"payload":{"id":"'), key, F.lit('","user_id":"none"}}'))
    line = F.when(F.col("event_id") % 100 == 0, broken).when(
        F.col("event_id") % 100 == 1, mistyped
    ).otherwise(payload)
    write_lines(events.select(line.alias("line")), f"{raw_root}/shop/events/", rows_per_file=ROWS_PER_FILE)
    spec = _event_entity(
        spark, "broken", raw_root, "struct<id: string, user_id: bigint, event_type: string>"
    )
    run_layer(spark, spec, "bronze")
    return scan_table(spark, spec.table("bronze")).unionByName(
        scan_table(spark, spec.malformed_table), allowMissingColumns=True
    ).drop("processed_at")


def bronze_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _audited(_chain(spark, sf_dir, "bronze"))


def silver_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _audited(_chain(spark, sf_dir, "silver"))


def gold_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _audited(_chain(spark, sf_dir, "gold"))


def full_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Response bodies of all shapes landed and run through bronze, silver and gold."""
    spec = _event_entity(spark, "full", scratch_folder(spark, "raw"), "string")
    run = LandingRun("shop", "events", "raw_events", RUN_TIME, ROWS_PER_FILE)
    run_chain(spark, spec, bodies=_bodies(_read(spark, sf_dir, "events")), run=run)
    return scan_table(spark, spec.table("gold")).drop("computed_at")


def chain_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver after a chain that ran twice for the same load."""
    raw_root = scratch_folder(spark, "raw")
    _land_events(spark, sf_dir, raw_root)
    spec = replace(_event_entity(spark, "rerun", raw_root, EVENT_PAYLOAD), load_id="2024-05-06")
    for _ in range(2):
        run_chain(spark, spec)
    gold = scan_table(spark, spec.table("gold")).select("records_total", F.col("load_id").alias("gold_load"))
    silver = scan_table(spark, spec.table("silver")).drop("processed_at", "standardized_at")
    return silver.join(gold, F.col("load_id") == F.col("gold_load")).drop("gold_load")


def landing_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze of a load that broke off once and was then landed twice, next to another load."""
    spec = replace(_event_entity(spark, "landing_rerun", scratch_folder(spark, "raw"), "string"), load_id="2024-05-06")
    run = LandingRun("shop", "events", "raw_events", RUN_TIME, ROWS_PER_FILE)
    bodies = _bodies(_read(spark, sf_dir, "events"))
    odd = F.col("event_id") % 2 == 1
    # Files without a record: what an attempt leaves that broke off on the way.
    land_responses(bodies.filter(odd), f"{spec.raw_path}{new_attempt(spec.load_id)}/", run)
    for _ in range(2):
        run_chain(spark, spec, "bronze", bodies.filter(~odd), run)
    other = replace(spec, load_id="a/b c")
    run_chain(spark, other, "bronze", bodies.filter(odd), run)
    records = committed_loads(spark, spec.raw_path).select(F.col("load_id").alias("load"), "records", "unreadable")
    bronze = scan_table(spark, spec.table("bronze"))
    return bronze.join(records, F.col("load") == F.col("load_id")).select("load_id", "record_id", "records", "unreadable")


def load_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a load's runs, taken from its tables, after it ran twice."""
    raw_root = scratch_folder(spark, "raw")
    events = _read(spark, sf_dir, "events")
    key = F.col("event_id").cast("string")
    payload = F.to_json(F.struct(F.struct(F.when(F.col("event_id") % 7 > 0, key).alias("id"), "user_id").alias("payload")))
    line = F.when(F.col("event_id") % 100 == 0, F.concat(F.lit("{"), key)).otherwise(payload)
    write_lines(events.select(line.alias("line")), f"{raw_root}/shop/events/", rows_per_file=ROWS_PER_FILE)
    schema = "struct<id: string, user_id: bigint>"
    spec = replace(_event_entity(spark, "load_metrics", raw_root, schema), load_id="2024-05-06")
    metrics = TableRef(_database(spark, "load_metrics"), "run_metrics")
    create_managed_table(spark, metrics, METRIC_COLUMNS)
    run_chain(spark, spec)
    for run in run_chain(spark, spec):
        record_metrics(spark, metrics, spec.load_id, run.layer, run.metrics, RUN_TIME)
    return scan_table(spark, metrics).drop("run_ts")


def lineitem_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of the lines packed, standardized and written in one observed pass."""
    lines = _read(spark, sf_dir, "lineitem")
    payloads = lines.select(F.struct(*lines.columns).alias("payload"))
    bronze = normalize(payloads, "l_orderkey", json_options={"timestampNTZFormat": EXACT})
    ref = TableRef(_database(spark, "lineitem"), "lineitem_silver")
    create_managed_table(
        spark, ref,
        "record_id STRING, payload_json STRING, payload_size INT, payload_hash STRING",
    )
    silver = standardize(bronze).drop("processed_at", "standardized_at")
    write_table(silver, ref, observation=Observation())
    return scan_table(spark, ref)


def bronze_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch loads and streamed loads into one table; no line is lost or taken twice."""
    folder = scratch_folder(spark, "incremental_raw")
    orders = _read(spark, sf_dir, "orders").select(
        F.struct(F.col("o_orderkey").cast("string").alias("id"), "o_orderstatus").alias("payload"), "o_orderkey"
    )
    parts = [orders.filter(F.col("o_orderkey") % 4 == i).select("payload") for i in range(4)]
    ref = TableRef(_database(spark, "incremental"), "orders_bronze")
    create_layer_table(spark, ref, "bronze", by_load=True)
    checkpoint = scratch_folder(spark, "incremental_checkpoint")
    schema = "payload struct<id: string, o_orderstatus: string>"

    def batch(part: DataFrame, load: str) -> None:
        write_table(normalize(part).withColumn("load_id", F.lit(load)), ref)

    def stream() -> None:
        run_bronze_incremental(spark, folder, schema, ref, checkpoint)

    batch(parts[0], "first")
    for part in parts[1:3]:
        write_jsonl(part, folder, rows_per_file=ROWS_PER_FILE)
        stream()
    batch(parts[3], "last")
    stream()
    return scan_table(spark, ref).drop("processed_at", "load_id")


# --- tables ------------------------------------------------------------------------------


def append_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in another column order, then suppliers, who have no segment."""
    ref = TableRef(_database(spark, "append"), "parties")
    create_managed_table(spark, ref, "party_key BIGINT, name STRING, balance DOUBLE, segment STRING")
    customers = _read(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"),
        F.col("c_name").alias("name"), F.col("c_custkey").alias("party_key"),
    )
    suppliers = _read(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_suppkey").alias("party_key"),
        F.col("s_acctbal").alias("balance"),
    )
    write_table(customers, ref)
    write_table(suppliers, ref)
    return scan_table(spark, ref)


def _orders_table(spark: SparkSession, sf_dir: str, label: str) -> tuple[DataFrame, TableRef]:
    ref = TableRef(_database(spark, label), "orders")
    create_managed_table(
        spark, ref, "o_orderkey BIGINT, o_totalprice DOUBLE, version INT, o_orderstatus STRING",
        ["o_orderstatus"],
    )
    orders = _read(spark, sf_dir, "orders").select(
        "o_orderstatus", "o_orderkey", "o_totalprice", F.lit(1).alias("version")
    )
    write_table(orders, ref, rebalance_by=["o_orderstatus"])
    return orders, ref


def overwrite_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, ref = _orders_table(spark, sf_dir, "overwrite")
    finished = orders.filter(F.col("o_orderstatus") == "F").withColumn("version", F.lit(2))
    write_table(finished, ref, "overwrite", rebalance_by=["o_orderstatus"])
    return scan_table(spark, ref)


def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders merged into a table of orders: some changed, some moved to another status, some deleted,
    some new, and some of no key at all."""
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    ref = TableRef(_database(spark, "merge"), "orders")
    create_managed_table(
        spark, ref, "o_orderkey BIGINT, o_totalprice DOUBLE, version INT, o_orderstatus STRING", ["o_orderstatus"]
    )
    key = F.col("o_orderkey")
    write_table(orders.filter(key % 4 != 3).withColumn("version", F.lit(1)), ref, rebalance_by=["o_orderstatus"])
    changes = orders.filter(key % 5 == 0).select(
        F.when(key % 35 != 0, key).alias("o_orderkey"), (F.col("o_totalprice") * 2).alias("o_totalprice"),
        F.when(key % 3 == 0, F.lit("X")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
    )
    merge_into(spark, ref, changes, ["o_orderkey"], delete=key % 10 == 0)
    return scan_table(spark, ref)


def skip_empty_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, ref = _orders_table(spark, sf_dir, "skip_empty")
    written = write_table(orders.filter(F.col("o_orderkey") < 0), ref, "overwrite")
    return scan_table(spark, ref).withColumn("written", F.lit(written))


def create_external_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dropping and re-creating the definition leaves the landed files alone."""
    ref = _external_events(spark, sf_dir, "external_ddl")
    location = (
        spark.sql(f"DESCRIBE TABLE EXTENDED {ref.sql}").filter("col_name = 'Location'")
        .select("data_type").first()[0]
    )
    create_external_json_table(
        spark, ref, "event_id BIGINT, value DOUBLE, event_type STRING", location, ["event_type"],
        replace=True,
    )
    return scan_table(spark, ref)


def create_managed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A re-created managed table holds the second load only."""
    ref = TableRef(_database(spark, "managed"), "parts")
    parts = _read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_brand")
    columns = "p_partkey BIGINT, p_name STRING, p_size INT, p_brand STRING"
    for _ in range(2):
        create_managed_table(spark, ref, columns, ["p_brand"], replace=True)
        write_table(parts, ref, rebalance_by=["p_brand"])
    return scan_table(spark, ref)


# --- re-aimed helpers --------------------------------------------------------------------


def content_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _read(spark, sf_dir, "documents")
    return documents.select("doc_id", content_sha256("text").alias("sha256"))


def _document_files(spark: SparkSession, sf_dir: str, label: str) -> str:
    """The documents in order as text files, one for every ``FILE_IDS`` ids of a source."""
    folder = scratch_folder(spark, label)
    documents = _read(spark, sf_dir, "documents")
    line = F.to_json(F.struct("doc_id", "text", "source"))
    lines = documents.select("doc_id", line.alias("line"), "source", F.expr(f"doc_id div {FILE_IDS}").alias("block"))
    lines = lines.repartition("source", "block").sortWithinPartitions("source", "block", "doc_id")
    lines.select("line", "source", "block").write.partitionBy("source", "block").text(folder)
    return folder


def _of_document_files(files: DataFrame) -> DataFrame:
    return files.withColumns({
        "source": F.regexp_extract("path", "source=([^/]*)/", 1),
        "block": F.regexp_extract("path", "block=([^/]*)/", 1).cast("bigint"),
    }).drop("path", "name", "mtime")


def file_manifest_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size and digest of the files of all documents."""
    return _of_document_files(file_manifest(spark, _document_files(spark, sf_dir, "manifest"), "*.txt"))


def file_digest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where the larger files are streamed."""
    folder = _document_files(spark, sf_dir, "digests")
    return _of_document_files(file_manifest(spark, folder, "*.txt", whole_bytes=64 << 10))


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of the files of all documents, without reading them; others are not listed."""
    folder = _document_files(spark, sf_dir, "listing")
    _read(spark, sf_dir, "nation").write.mode("append").parquet(folder)
    return _of_document_files(list_files(spark, folder, "*.txt"))


def manifest_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two manifests of all pages; in between some were edited and some moved."""
    pages = _read(spark, sf_dir, "pages")
    number = F.col("page_id").cast("string")
    path = F.concat(F.lit("pages/"), number, F.lit(".html"))
    moved = F.when(F.col("page_id") % 7 == 0, F.concat(F.lit("new/"), number)).otherwise(path)
    edited = F.when(F.col("page_id") % 5 == 0, F.concat(F.col("html"), F.lit(" "))).otherwise(F.col("html"))
    previous = pages.select(path.alias("path"), content_sha256("html").alias("sha256"))
    current = pages.select(moved.alias("path"), content_sha256(edited).alias("sha256"))
    return manifest_diff(previous, current)


def mask_full_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _read(spark, sf_dir, "customer").select(
        "c_custkey",
        _case(F.col("c_custkey"), F.col("c_name"), "", None).alias("api_token"),
        _case(F.col("c_custkey"), F.lit(0), F.col("c_nationkey")).alias("secret_code"),
        _case(F.col("c_custkey"), "api_token", "region", "PASSWORD", "note").alias("name"),
        _case(F.col("c_custkey"), F.col("c_name"), F.col("c_mktsegment"), "").alias("value"),
    )
    masked = mask_columns(customers, ["api_token", "secret_code"])
    return masked.withColumns({
        "masked_value": mask_by_key("name", "value"),
        "masked_number": mask_by_key("name", F.col("c_custkey") % 5, T.LongType()),
        "masked_segment": mask_full("value"),
    })


def mask_partial_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _read(spark, sf_dir, "customer")
    value = _case(F.col("c_custkey"), F.col("c_name"), F.col("c_mktsegment"), "", None, "12345678")
    return customers.select(
        "c_custkey", mask_partial(value).alias("masked"), mask_partial("c_mktsegment").alias("segment")
    )


def clip_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages")
    key = _case(F.col("page_id"), "url", "Session_Token", "html", "SECRET_empty")
    value = _case(F.col("page_id"), F.col("url"), F.col("html"), F.col("html"), "")
    return pages.select(
        "page_id", clip_text("url").alias("url"), clip_text("html").alias("html"),
        preview_by_key(key, value).alias("preview"),
    )


def typed_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    token = _case(F.col("event_id"), *TOKENS, None)
    events = _read(spark, sf_dir, "events").select(
        "event_id", token.alias("as_bool"), token.alias("as_lenient"), token.alias("as_int"),
        token.alias("as_float"),
    )
    kinds = {"as_bool": "bool", "as_lenient": "lenient_bool", "as_int": "int", "as_float": "float"}
    return parse_columns(events, kinds, {"as_int": -1})


def _customer_rules() -> list[rules.Rule]:
    return [
        rules.not_null("c_name"),
        rules.not_blank("c_name"),
        rules.has_prefix("c_name", "Customer#"),
        rules.one_of("c_mktsegment", ("building", "Machinery", "HOUSEHOLD")),
        rules.Rule("c_acctbal_positive", F.col("c_acctbal") > 0),
    ]


def validate_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _read(spark, sf_dir, "customer")
    name = _case(
        F.col("c_custkey"), F.col("c_name"), None, "  ", F.lower("c_name"), F.col("c_name"),
        F.col("c_name"), F.col("c_name"),
    )
    prepared = customers.select("c_custkey", name.alias("c_name"), "c_mktsegment", "c_acctbal")
    return validate(prepared, _customer_rules()).withColumns({
        "c_name": rules.strip_blank("c_name"),
        "c_mktsegment": rules.fold_case("c_mktsegment"),
        "segment_path": rules.with_trailing_slash("c_mktsegment"),
    })


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good and rejected orders through two tables, read back side by side."""
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    checks = [
        rules.one_of("o_orderstatus", ("F", "O")),
        rules.Rule("o_totalprice_range", F.col("o_totalprice").between(1000, 400000)),
    ]
    good, rejected = split_rejects(orders, checks)
    database = _database(spark, "quarantine")
    columns = "o_orderkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE"
    accepted, refused = TableRef(database, "orders"), TableRef(database, "orders_rejected")
    create_managed_table(spark, accepted, columns)
    create_managed_table(spark, refused, f"{columns}, failed_rule STRING")
    write_table(good, accepted)
    write_table(rejected, refused)
    return scan_table(spark, accepted).unionByName(scan_table(spark, refused), allowMissingColumns=True)


def survivorship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three layers of customers with holes; keys are missing in some of them."""
    customers = _read(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    workflow = customers.filter(F.col("c_mktsegment") == "BUILDING").select(
        "c_custkey", F.when(key % 2 == 0, F.concat(F.lit("w"), F.col("c_name"))).alias("name"),
        F.when(key % 5 == 0, F.lit(-1.0)).alias("balance"),
    )
    command = customers.filter(F.col("c_acctbal") > 0).select(
        "c_custkey", F.when(key % 7 != 0, F.concat(F.lit("c"), F.col("c_name"))).alias("name"),
        F.when(key % 11 == 0, F.col("c_mktsegment")).alias("segment"),
    )
    default = customers.select(
        "c_custkey", F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"),
        F.when(key % 13 != 0, F.lit("NONE")).alias("segment"),
    )
    nameless = customers.filter(key % 3 == 0).select(
        F.lit(None).cast("bigint").alias("c_custkey"), F.lit("nobody").alias("name")
    )
    return survivorship_merge(
        {"workflow": workflow.unionByName(nameless, allowMissingColumns=True), "command": command, "default": default},
        ["c_custkey"],
    )


def classify_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _read(spark, sf_dir, "conversations")
    return classify_messages(turns, "text", TEXT_KEYWORDS, "other", "class").drop("text", "role")


def classify_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _read(spark, sf_dir, "events")
    message = F.concat(
        F.col("event_type"), F.lit(" failed: "),
        _case(
            F.col("event_id"), "Configuration of Spark is missing", "INVALID value", "Validation",
            "Spark job lost", "bad SQL text", "Glue access denied", "no SECRET", "disk full",
        ),
    )
    return classify_messages(events.select("event_id", message.alias("message")), "message")


def lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps between tables named after parts; the names decide the layers."""
    parts = _read(spark, sf_dir, "part")
    key = F.col("p_partkey")
    word = F.lower(F.replace("p_type", F.lit(" "), F.lit("_")))
    steps = parts.select(
        "p_partkey",
        _case(key, "raw_zone", "Bronze_Zone", "silver_zone", "gold_zone", "sales", " ").alias("source_database"),
        F.concat(word, _case(key, "", "", "", "", "", "_withdrawals", "_gold")).alias("source_table"),
        _case(F.floor(key / 5), "bronze_zone", "silver_zone", "GOLD_zone", "raw_zone", "mart").alias(
            "target_database"
        ),
        _case(key, word, F.concat(F.lit(" "), word), word, F.lit("  "), word, word).alias("target_table"),
    )
    return lineage_audit(steps)


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a filtered load, taken by the write itself and kept in a metrics table."""
    lines = _read(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_quantity") > 5, F.col("l_orderkey").cast("string")).alias("record_id")
    )
    database = _database(spark, "metrics")
    target, metrics = TableRef(database, "lines"), TableRef(database, "run_metrics")
    create_managed_table(spark, target, "record_id STRING")
    create_managed_table(spark, metrics, METRIC_COLUMNS)
    read, written = Observation(), Observation()
    observed = lines.observe(read, F.count(F.lit(1)).alias("rows"))
    write_table(
        observed.filter(F.col("record_id").isNotNull()), target, skip_empty=False, observation=written
    )
    rows_in, rows_out = read.get["rows"], written.get["rows"]
    record_metrics(
        spark, metrics, "run-1", "silver",
        {"rows_in": rows_in, "rows_out": rows_out, "rows_rejected": rows_in - rows_out}, RUN_TIME,
    )
    return scan_table(spark, metrics).drop("run_ts")


# --- grouped, ranked and joined ----------------------------------------------------------


def _timed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _shown_times(df: DataFrame) -> DataFrame:
    times = [name for name, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({name: F.date_format(name, EXACT) for name in times})


def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that arrive in three batches, with replays and late rows: silver and the late table."""
    folder = scratch_folder(spark, "stream_silver_raw")
    events = _timed_events(spark, sf_dir)
    bounds = events.agg(F.unix_micros(F.min("ts")).alias("first"), F.unix_micros(F.max("ts")).alias("last")).first()
    third = (bounds["last"] - bounds["first"]) // 3
    own = F.least(F.floor((F.unix_micros("ts") - bounds["first"]) / third), F.lit(2))
    key = F.col("event_id")
    arrives = own + F.when((key % 50 == 1) & (own < 2), 1).otherwise(0)  # a batch too late
    again = F.when(key % 10 == 0, F.least(arrives + 1, F.lit(2)))  # once more in the next batch
    database = _database(spark, "stream_silver")
    silver, late = TableRef(database, "silver"), TableRef(database, "late")
    checkpoint = scratch_folder(spark, "stream_silver_checkpoint")
    payload = F.struct(key.cast("string").alias("id"), "event_type", F.date_format("ts", EXACT).alias("at"))
    batch_of = events.select(payload.alias("payload"), F.explode(F.array_compact(F.array(arrives, again))).alias("batch"))
    for number in range(3):
        write_jsonl(batch_of.filter(F.col("batch") == number).select("payload"), folder, rows_per_file=ROWS_PER_FILE)
        run_silver_incremental(
            spark, folder, "payload struct<id: string, event_type: string, at: string>", silver, late, checkpoint, "at",
            timedelta(hours=1), run_ts=RUN_TEXT,
        )
    both = scan_table(spark, silver).withColumn("part", F.lit("silver")).unionByName(scan_table(spark, late).withColumn("part", F.lit("late")))
    return _shown_times(both.drop("load_id", "processed_at", "standardized_at"))


GAP = timedelta(minutes=30)


def event_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of each user."""
    return _shown_times(sessions(_timed_events(spark, sf_dir), ["user_id"], "ts", GAP))


def type_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of each type of event: few hot keys, whose sessions go on over spans."""
    return _shown_times(sessions(_timed_events(spark, sf_dir), ["event_type"], "ts", timedelta(minutes=20), timedelta(hours=6)))


def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sessions of users from a stream over the events, closed by a last row long after them."""
    folder, shown, checkpoint = (scratch_folder(spark, f"stream_sessions_{name}") for name in ("raw", "out", "state"))
    events = _timed_events(spark, sf_dir).select("user_id", "ts")
    last = events.agg((F.max("ts") + F.expr("interval 10 days")).alias("ts")).select(F.lit(-1).cast("long").alias("user_id"), "ts")
    for rows in (events, last):
        rows.write.mode("append").parquet(folder)
        stream = spark.readStream.schema(events.schema).parquet(folder).withWatermark("ts", "1 hour")
        found = sessions(stream, ["user_id"], "ts", GAP)
        writer = found.writeStream.option("checkpointLocation", checkpoint).option("path", shown).trigger(availableNow=True)
        writer.format("parquet").outputMode("append").start().awaitTermination()
    return _shown_times(spark.read.schema(found.schema).parquet(shown))


CUBE_DIMENSIONS = {"l_returnflag": "STRING", "l_linestatus": "STRING", "l_linenumber": "INT"}


def _cube_measures() -> list[cubes.Measure]:
    return [
        cubes.rows("lines"), cubes.total("quantity", "l_quantity", "DECIMAL(38,2)"),
        cubes.least("first_part", "l_partkey", "BIGINT"), cubes.greatest("last_part", "l_partkey", "BIGINT"),
    ]


def gold_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cube of lines written in three loads, of which one is repeated."""
    ref = TableRef(_database(spark, "cube"), "lines")
    lines = _read(spark, sf_dir, "lineitem").withColumn(
        "l_linestatus", F.when(F.col("l_orderkey") % 5 != 0, F.col("l_linestatus"))
    )
    for load in (0, 1, 2, 1):
        part = lines.filter(F.col("l_orderkey") % 3 == load)
        cubes.write_cube(part, ref, f"load-{load}", CUBE_DIMENSIONS, _cube_measures())
    return cubes.read_cube(spark, ref, list(CUBE_DIMENSIONS), _cube_measures()).withColumn("quantity", F.col("quantity").cast("double"))


def gold_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subtotals of orders by status and priority, and one more grouping, of one load."""
    ref = TableRef(_database(spark, "rollup"), "orders")
    dimensions = {"o_orderstatus": "STRING", "o_orderpriority": "STRING"}
    measures = [cubes.rows("orders"), cubes.total("price", "o_totalprice", "DECIMAL(38,2)")]
    sets = [*cubes.rollup_sets(list(dimensions)), ("o_orderpriority",)]
    cubes.write_cube(_read(spark, sf_dir, "orders"), ref, "all", dimensions, measures, sets)
    return cubes.read_cube(spark, ref, list(dimensions), measures).withColumn("price", F.col("price").cast("double"))


PORTION_ROWS = 1_000_000


def gold_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct orders and the median and 90 % quantile of prices by line status and in all, from sketches
    of three loads: whether they keep their bounds, against the exact figures."""
    ref = TableRef(_database(spark, "sketches"), "lines")
    lines = _read(spark, sf_dir, "lineitem")
    measures = [
        cubes.rows("lines"), cubes.distinct("orders", "l_orderkey"), cubes.quantile("median", "l_extendedprice", 0.5),
        cubes.quantile("high", "l_extendedprice", 0.9),
    ]
    for load in range(3):
        part = lines.filter(F.col("l_orderkey") % 3 == load)
        cubes.write_cube(part, ref, f"load-{load}", {"l_linestatus": "STRING"}, measures)
    shown = cubes.read_cube(spark, ref, ["l_linestatus"], measures)
    # Exact ranks of the estimates; a total has every line.
    status = F.explode(F.array(F.col("l_linestatus"), F.lit("all"))).alias("status")
    shown = shown.withColumn("status", F.when(F.col("grouping") == 0, F.col("l_linestatus")).otherwise("all")).drop("l_linestatus")
    # ``shown`` has a row for each status: joined without a shuffle, so that a status is not one task's.
    ranks = lines.select(status, "l_extendedprice").join(F.broadcast(shown), "status").groupBy("status", "lines").agg(
        F.first("orders").alias("orders"),
        *[F.avg((F.col("l_extendedprice") <= F.col(name)).cast("double")).alias(name) for name in ("median", "high")],
    )
    # Exact numbers of orders, counted in as many tasks as there are portions of lines.
    keys = lines.select("l_linestatus", "l_orderkey").filter("l_orderkey IS NOT NULL")
    dealt = keys.repartition(1 + lines.count() // PORTION_ROWS, "l_orderkey").select(status, "l_orderkey")
    orders = dealt.groupBy("status").agg(F.count_distinct("l_orderkey").alias("exact"))
    ranks = ranks.join(orders, "status", "left").withColumn("exact", F.coalesce("exact", F.lit(0)))
    return ranks.select(
        "status", "lines", (F.abs(F.col("orders") - F.col("exact")) <= F.col("exact") * 0.03).alias("distinct_kept"),
        (F.abs(F.col("median") - 0.5) <= 0.01).alias("median_kept"), (F.abs(F.col("high") - 0.9) <= 0.01).alias("high_kept"),
    )


def top_k_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten dearest lines of each return flag."""
    lines = _read(spark, sf_dir, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice")
    order = [F.col("l_extendedprice").desc(), F.col("l_orderkey").asc(), F.col("l_linenumber").asc()]
    return top_k(lines, 10, order, ["l_returnflag"])


def top_k_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hundred dearest orders."""
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return top_k(orders, 100, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()])


def asof_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each purchase and signup the latest click of its user before; a third of all rows belong to one user."""
    events = _timed_events(spark, sf_dir)
    user = F.when(F.col("event_id") % 3 == 0, F.lit(0).cast("long")).otherwise(F.col("user_id"))
    events = events.withColumn("user_id", F.when(F.col("event_id") % 97 != 0, user))
    ours = events.filter(F.col("event_type").isin("purchase", "signup")).select("event_id", "user_id", "ts")
    clicks = events.filter(F.col("event_type") == "click").select(
        "user_id", "ts", F.col("event_id").alias("click_id"), F.col("value").alias("click_value")
    )
    return _shown_times(asof_join(ours, clicks, ["user_id"], "ts", ["click_id", "click_value"]))


def _line_bags(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    lines = _read(spark, sf_dir, "lineitem")
    flag = F.when(F.col("l_linenumber") != 3, F.col("l_returnflag")).alias("flag")
    one = lines.select(flag, F.col("l_linenumber").alias("number"), (F.col("l_partkey") % 10).alias("part"))
    two = lines.filter(F.col("l_orderkey") % 3 != 0).select(
        (F.col("l_suppkey") % 10).alias("part"), flag, F.col("l_linenumber").alias("number")
    )
    return one, two


def except_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiset_difference(*_line_bags(spark, sf_dir))


def intersect_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiset_intersection(*_line_bags(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "json_scan": json_scan,
    "json_scan_permissive": json_scan_permissive,
    "csv_drop_ingest": csv_drop_ingest,
    "csv_rejects": csv_rejects,
    "table_scan_filtered": table_scan_filtered,
    "external_table_scan": external_table_scan,
    "partition_repair": partition_repair,
    "partition_register": partition_register,
    "unnest_responses": unnest,
    "unreadable_responses": unreadable,
    "response_numbers": response_numbers,
    "landing_rejects": landing_rejects,
    "landing_empty": landing_empty,
    "enrich_defaults": enrich_defaults,
    "landing_batch_ids": landing_batch_ids,
    "global_ordinal": global_ordinal,
    "file_ordinal": file_ordinal,
    "landing_envelope": landing_envelope,
    "land_jsonl": land_jsonl,
    "land_jsonl_partitioned": land_jsonl_partitioned,
    "bronze_normalize": bronze_normalize,
    "bronze_inferred": bronze_inferred,
    "bronze_text_payload": bronze_text_payload,
    "silver_standardize": silver_standardize,
    "gold_count": gold_count,
    "bronze_quarantine": bronze_quarantine,
    "bronze_layer": bronze_layer,
    "silver_layer": silver_layer,
    "gold_layer": gold_layer,
    "full_chain": full_chain,
    "chain_rerun": chain_rerun,
    "landing_rerun": landing_rerun,
    "load_metrics": load_metrics,
    "lineitem_silver": lineitem_silver,
    "bronze_incremental": bronze_incremental,
    "append_by_name": append_by_name,
    "overwrite_partitions": overwrite_partitions,
    "merge_upsert": merge_upsert,
    "skip_empty_write": skip_empty_write,
    "create_external_json": create_external_json,
    "create_managed": create_managed,
    "content_sha256": content_fingerprint,
    "file_manifest": file_manifest_totals,
    "file_digest_stream": file_digest_stream,
    "list_files": listing,
    "manifest_diff": manifest_changes,
    "mask_full": mask_full_columns,
    "mask_partial": mask_partial_columns,
    "clip_text": clip_pages,
    "typed_parse": typed_parse,
    "validate_rules": validate_rules,
    "quarantine": quarantine,
    "survivorship_merge": survivorship,
    "classify_messages": classify_conversations,
    "classify_errors": classify_errors,
    "lineage_audit": lineage,
    "run_metrics": run_metrics,
    "stream_silver": stream_silver,
    "event_sessions": event_sessions,
    "type_sessions": type_sessions,
    "stream_sessions": stream_sessions,
    "gold_cube": gold_cube,
    "gold_rollup": gold_rollup,
    "gold_sketches": gold_sketches,
    "top_k_groups": top_k_groups,
    "top_k_overall": top_k_overall,
    "asof_join": asof_purchases,
    "except_all": except_all,
    "intersect_all": intersect_all,
}
