"""Loads: landings that can be repeated.

A load lands its files in a folder of its own attempt, ``load_id=…/attempt=…``. Its record is written
last, as one small file below ``_loads``, and names that folder; scans read the folders that the latest
record of each load names. A broken attempt leaves files that no record names, so nothing reads them, and
a repeated load takes the place of the one before.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass
from datetime import datetime, timezone
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelayers.folders import Folder
from lakelayers.operators.landing import LandingCounts, LandingRun, land_responses
from lakelayers.sources.jsonl import CORRUPT_COLUMN, EMPTY_LANDING, as_schema, scan_jsonl

RECORDS = "_loads"


@dataclass(frozen=True)
class LoadRecord:
    """What a committed load consists of; folders are relative to the landing folder."""

    load_id: str
    folder: str | None
    bodies: int
    unreadable: int
    records: int
    committed_at: str


def new_attempt(load_id: str) -> str:
    """The folder of a new attempt of a load, relative to the landing folder."""
    return f"load_id={quote(load_id, safe='')}/attempt={uuid.uuid4().hex}"


def land_load(
    df: DataFrame, path: str, run: LandingRun, load_id: str, body: str = "body", **landing
) -> LandingCounts:
    """Land the records of response bodies as the load ``load_id``, replacing an earlier one.

    ``landing`` goes to :func:`lakelayers.operators.landing.land_responses`. Bodies that give no records
    lie in a folder of the same name below ``…_unreadable``. Files of the attempts before stay where
    they are, unread, until :func:`drop_unnamed` removes them. Of two attempts that end at the same
    time the second fails.
    """
    spark, attempt = df.sparkSession, new_attempt(load_id)
    root = path.rstrip("/")
    before = len(_record_names(spark, path, load_id))
    counts = land_responses(df, f"{root}/{attempt}/", run, body, rejects=f"{root}_unreadable/{attempt}/", **landing)
    commit_load(spark, path, load_id, attempt if counts else None, counts, before)
    return counts


def commit_load(
    spark: SparkSession, path: str, load_id: str, attempt: str | None, counts: LandingCounts, before: int | None = None
) -> None:
    """Write the record of a load whose files are complete; ``before`` is the number of earlier ones."""
    number = len(_record_names(spark, path, load_id)) if before is None else before
    now = datetime.now(timezone.utc).isoformat()
    record = LoadRecord(load_id, attempt, counts.bodies, counts.unreadable, counts.records, now)
    Folder(spark, path).publish(f"{RECORDS}/{quote(load_id, safe='')}/{number + 1:08d}.json", json.dumps(asdict(record)))


def _record_names(spark: SparkSession, path: str, load_id: str) -> list[str]:
    folder = Folder(spark, path)
    return [name for name in folder.names(f"{RECORDS}/{quote(load_id, safe='')}") if name.endswith(".json")]


def has_loads(spark: SparkSession, path: str) -> bool:
    return Folder(spark, path).exists(RECORDS)


def committed_loads(spark: SparkSession, path: str) -> DataFrame:
    """The latest record of every load, as a frame of :class:`LoadRecord`'s fields."""
    schema = "load_id string, folder string, bodies bigint, unreadable bigint, records bigint, committed_at string"
    if not has_loads(spark, path):
        return spark.createDataFrame([], schema)
    lines = spark.read.schema(schema).json(f"{path.rstrip('/')}/{RECORDS}/*/*.json")
    named = lines.withColumn("_name", F.col("_metadata.file_name"))
    return named.groupBy("load_id").agg(F.max_by(F.struct(*[c for c in lines.columns if c != "load_id"]), "_name").alias("_last")).select("load_id", "_last.*")


def scan_loads(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType | None = None,
    loads: Sequence[str] | None = None,
    malformed: str = "PERMISSIVE",
    keep_corrupt: bool = False,
) -> DataFrame:
    """The JSON lines of committed loads, all or those named; a named load without a record is an error.

    Only the folders come to the driver, one for each load.
    """
    known = committed_loads(spark, path)
    if loads is not None:
        known = known.filter(F.col("load_id").isin(list(loads)))
    found = known.select("load_id", "folder").collect()
    missing = set(loads or ()) - {row["load_id"] for row in found}
    if missing:
        raise ValueError(f"loads not committed in {path}: {sorted(missing)}")
    folders = [f"{path.rstrip('/')}/{row['folder']}/" for row in found if row["folder"]]
    if folders:
        return scan_jsonl(spark, folders, schema, malformed, keep_corrupt)
    declared = as_schema(schema or EMPTY_LANDING)
    if keep_corrupt and CORRUPT_COLUMN not in declared.fieldNames():
        declared = T.StructType([*declared.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])
    return spark.createDataFrame([], declared)


def drop_unnamed(spark: SparkSession, path: str) -> int:
    """Delete the attempts that no latest record names; returns their number. No load may be running."""
    named = {row["folder"] for row in committed_loads(spark, path).select("folder").collect()}
    dropped = 0
    for root in (path.rstrip("/"), f"{path.rstrip('/')}_unreadable"):
        folder = Folder(spark, root)
        for load in folder.names():
            for attempt in folder.names(load) if load.startswith("load_id=") else ():
                if f"{load}/{attempt}" not in named and attempt.startswith("attempt="):
                    folder.delete(f"{load}/{attempt}")
                    dropped += root == path.rstrip("/")
    return dropped
