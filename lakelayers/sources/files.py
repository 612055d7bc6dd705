"""File listings, file manifests and CSV drops."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelayers.sources.digests import with_digest
from lakelayers.sources.jsonl import CORRUPT_COLUMN, as_schema

logger = logging.getLogger(__name__)

# Files that one task may hold whole.
WHOLE_BYTES = 256 << 20

CSV_GLOB = "*.[cC][sS][vV]"


def _binary_scan(spark: SparkSession, folder: str, pattern: str | None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(folder)


def _described(scan: DataFrame, *more: Column) -> DataFrame:
    return scan.select(
        "path",
        F.substring_index("path", "/", -1).alias("name"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("mtime"),
        *more,
    )


def list_files(spark: SparkSession, folder: str, pattern: str | None = None) -> DataFrame:
    """Path, name, size and modification time of the files below a folder; reads no content."""
    return _described(_binary_scan(spark, folder, pattern))


def file_manifest(
    spark: SparkSession, folder: str, pattern: str | None = None, whole_bytes: int = WHOLE_BYTES
) -> DataFrame:
    """``path, name, size, mtime, sha256`` of every file below a folder.

    Files of up to ``whole_bytes`` are read by the scan itself, with the session's own file systems and
    keys, one in memory at a time in each task. Larger ones, if there are any, are streamed block by
    block, see :mod:`lakelayers.sources.digests`. Empty files, and files whose name starts with ``_``
    or ``.``, are not listed, as in every Spark scan.
    """
    scan = _binary_scan(spark, folder, pattern)
    small = F.col("length") <= whole_bytes  # pushed down: no content of other files is read
    whole = _described(scan.filter(small), F.sha2("content", 256).alias("sha256"))
    large = _described(scan.filter(~small))
    return whole if large.isEmpty() else whole.unionByName(with_digest(large))


def read_csv_drop(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType | None = None,
    which: str = "all",
    header: bool = True,
    options: Mapping[str, str] | None = None,
    malformed: str = "PERMISSIVE",
    keep_corrupt: bool = False,
) -> DataFrame:
    """Rows of the CSV file at ``path``, or of those in the folder if it ends with ``/``.

    ``which="all"`` reads every file whose name ends in ``.csv`` in any letter case;
    ``which="first"`` only the one first by path. ``source_file`` names the file of a row.
    Without a schema all columns are text. ``options`` go to the CSV reader. A folder without
    CSV files is an error.

    Rows with too few, too many or mistyped fields are malformed under a schema: they are read as
    far as possible (``PERMISSIVE``), dropped (``DROPMALFORMED``) or fail the query
    (``FAILFAST``). With ``keep_corrupt`` their text stands in ``_corrupt_record``, so that
    :func:`lakelayers.sources.jsonl.is_corrupt` tells them apart.
    """
    if which not in ("all", "first"):
        raise ValueError(f"which must be 'all' or 'first', not {which!r}")
    target, pattern = path, None
    if path.endswith("/"):
        found = (
            spark.read.format("binaryFile").option("pathGlobFilter", CSV_GLOB).load(path)
            .agg(F.count("path").alias("files"), F.min("path").alias("first"))
            .first()
        )
        if not found["files"]:
            raise ValueError(f"no CSV files in {path}")
        if which == "first":
            if found["files"] > 1:
                logger.warning("%d CSV files in %s, reading only %s", found["files"], path, found["first"])
            target = found["first"]
        else:
            pattern = CSV_GLOB
    reader = spark.read.option("header", str(header).lower()).option("enforceSchema", "false")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    reader = reader.option("mode", malformed).option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    if schema is not None:
        declared = as_schema(schema)
        if keep_corrupt and CORRUPT_COLUMN not in declared.fieldNames():
            declared = T.StructType([*declared.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])
        reader = reader.schema(declared)
    rows = reader.options(**(options or {})).csv(target)
    return rows.select("*", F.col("_metadata.file_name").alias("source_file"))
