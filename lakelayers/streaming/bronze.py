"""Incremental bronze: every landed file is read once."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelayers.functions.columns import run_time
from lakelayers.names import TableRef
from lakelayers.operators.layers import normalize
from lakelayers.sinks.tables import LOAD_COLUMN, create_layer_table, create_managed_table, write_table
from lakelayers.sources.jsonl import CORRUPT_COLUMN, as_schema, is_corrupt

MALFORMED_COLUMNS = "line STRING, partly_read BOOLEAN, processed_at TIMESTAMP"


def malformed_lines(lines: DataFrame, run_ts: datetime | str | None = None) -> DataFrame:
    """Text of the malformed lines of a scan, and whether any part of the payload was readable."""
    return lines.filter(is_corrupt(lines)).select(
        F.col(CORRUPT_COLUMN).alias("line"),
        F.col("payload").isNotNull().alias("partly_read"),
        run_time(run_ts).alias("processed_at"),
    )


def run_bronze_incremental(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    target: TableRef,
    checkpoint: str,
    id_field: str = "id",
    files_per_batch: int | None = None,
    run_ts: datetime | str | None = None,
    json_options: Mapping[str, str] | None = None,
    create_tables: bool = True,
    table_format: str = "parquet",
) -> None:
    """Write the lines of files that arrived since the last run, then stop.

    A re-run over the same folder adds nothing. Each micro-batch is a load of its own, named after
    the checkpoint and the number of the batch: a batch that Spark repeats after a failure
    replaces its own partition of ``target``, and other loads and batch writes are left alone. The
    table must therefore be partitioned by ``load_id``; it is created so if it is missing. Malformed
    lines go to the table ``…_malformed`` next to it, partitioned alike. The checkpoint folder must
    be on storage all machines share.
    """
    rejected = TableRef(target.database, f"{target.table}_malformed", target.catalog)
    if create_tables:
        create_layer_table(spark, target, "bronze", table_format, by_load=True)
        create_managed_table(
            spark, rejected, f"{MALFORMED_COLUMNS}, {LOAD_COLUMN} STRING", [LOAD_COLUMN], table_format
        )
    if LOAD_COLUMN not in spark.table(target.sql).columns:
        raise ValueError(f"{target.sql} must be partitioned by {LOAD_COLUMN}")
    stream = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:12]
    declared = as_schema(schema)
    if CORRUPT_COLUMN not in declared.fieldNames():
        declared = T.StructType([*declared.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])
    reader = spark.readStream.schema(declared).option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def load(batch: DataFrame, number: int) -> None:
        load_id = F.lit(f"stream-{stream}-{number:08d}")
        good = normalize(batch.filter(~is_corrupt(batch)), id_field, run_ts=run_ts, json_options=json_options)
        write_table(good.withColumn(LOAD_COLUMN, load_id), target, "overwrite", skip_empty=False)
        bad = malformed_lines(batch, run_ts)
        write_table(bad.withColumn(LOAD_COLUMN, load_id), rejected, "overwrite", skip_empty=False)

    query = (
        reader.json(path)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(load)
        .start()
    )
    query.awaitTermination()
    # Batches run in a session of their own; this one may still list the files of before.
    for ref in (target, rejected):
        spark.catalog.refreshTable(ref.sql)
