"""Incremental silver: duplicates are dropped in state that ages, late rows are kept apart."""

from __future__ import annotations

import hashlib
import json
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelayers.folders import Folder
from lakelayers.names import TableRef
from lakelayers.operators.layers import normalize, standardize
from lakelayers.sinks.tables import LAYER_COLUMNS, LOAD_COLUMN, create_managed_table, write_table
from lakelayers.sources.jsonl import as_schema

EVENT_TIME = "event_time"
PROGRESS = "event-times"


def run_silver_incremental(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    target: TableRef,
    late: TableRef,
    checkpoint: str,
    time_field: str,
    delay: timedelta,
    id_field: str = "id",
    run_ts: datetime | str | None = None,
    table_format: str = "parquet",
    files_per_batch: int | None = None,
) -> None:
    """Standardize the lines of files that arrived since the last run, each record once, then stop.

    A row is late if its event time is not after the watermark, the latest event time of all batches
    before minus ``delay``, in milliseconds. Late rows go to the table ``late``, as often as they come. Of
    the others the first of each ``record_id`` goes to ``target``: the state store remembers an id for
    ``delay`` beyond its event time, so the state grows with that time, not with the stream. Rows without
    an id go nowhere, as in a batch run; rows without an event time count as late.

    Both tables have the silver columns and ``event_time``, and a partition for each micro-batch, which a
    repeated batch replaces. The checkpoint must be on storage all machines share; next to Spark's own
    files it keeps the latest event time of each batch.
    """
    columns = f"{LAYER_COLUMNS['silver']}, {EVENT_TIME} TIMESTAMP, {LOAD_COLUMN} STRING"
    for ref in (target, late):
        create_managed_table(spark, ref, columns, [LOAD_COLUMN], table_format)
    stream = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:12]
    progress = Folder(spark, checkpoint)
    reader = spark.readStream.schema(as_schema(schema))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lines = reader.json(path)
    time = F.col(f"payload.{time_field}").cast("timestamp")
    timed = lines.select("payload", time.alias(EVENT_TIME))
    rows = standardize(normalize(timed, id_field, run_ts=run_ts, keep=[EVENT_TIME]), run_ts=run_ts)
    marked = rows.withWatermark(EVENT_TIME, f"{int(delay.total_seconds() * 1000)} milliseconds")
    first = marked.dropDuplicatesWithinWatermark(["record_id"]).withColumn("_first", F.lit(True))
    both = first.unionByName(rows.withColumn("_first", F.lit(False)))

    def load(batch: DataFrame, number: int) -> None:
        load_id = F.lit(f"stream-{stream}-{number:08d}")
        latest = _latest_before(progress, number)
        mark = None if latest is None else (latest - delay // timedelta(milliseconds=1)) * 1000
        is_late = F.col(EVENT_TIME).isNull() | (F.lit(False) if mark is None else F.unix_micros(EVENT_TIME) <= mark)
        every = batch.filter(~F.col("_first"))
        kept = batch.filter(F.col("_first") & F.col(EVENT_TIME).isNotNull())
        write_table(kept.drop("_first").withColumn(LOAD_COLUMN, load_id), target, "overwrite", skip_empty=False)
        write_table(every.filter(is_late).drop("_first").withColumn(LOAD_COLUMN, load_id), late, "overwrite", skip_empty=False)
        seen = every.agg(F.unix_millis(F.max(EVENT_TIME))).first()[0]
        known = [value for value in (latest, seen) if value is not None]
        name = f"{PROGRESS}/{number:08d}.json"
        if known and not progress.exists(name):
            progress.publish(name, json.dumps(max(known)))

    query = (
        both.writeStream.option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True)
        .foreachBatch(load).start()
    )
    query.awaitTermination()
    for ref in (target, late):
        spark.catalog.refreshTable(ref.sql)


def _latest_before(progress: Folder, number: int) -> int | None:
    """Latest event time, in milliseconds, of the batches before this one."""
    names = [name for name in progress.names(PROGRESS) if name < f"{number:08d}.json" and name.endswith(".json")]
    return json.loads(progress.read(f"{PROGRESS}/{names[-1]}")) if names else None
