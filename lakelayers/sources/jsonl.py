"""Scans of landed JSON Lines."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT_COLUMN = "_corrupt_record"

# Schema of a folder that exists but holds no readable line yet.
EMPTY_LANDING = "payload struct<id: string>"


def as_schema(schema: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def scan_jsonl(
    spark: SparkSession,
    path: str | list[str],
    schema: str | T.StructType | None = None,
    malformed: str = "PERMISSIVE",
    keep_corrupt: bool = False,
) -> DataFrame:
    """All JSON lines below ``path``, a folder or a list of them.

    With a schema only the named fields are parsed and no inference pass runs. A malformed line
    becomes a row of nulls (``PERMISSIVE``), is dropped (``DROPMALFORMED``) or fails the query
    (``FAILFAST``); with ``keep_corrupt`` its text stands in ``_corrupt_record``. A missing path
    is an error, an existing folder without lines an empty frame.
    """
    reader = (
        spark.read.option("mode", malformed)
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    )
    if schema is not None:
        declared = as_schema(schema)
        if keep_corrupt and CORRUPT_COLUMN not in declared.fieldNames():
            declared = T.StructType([*declared.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])
        return reader.schema(declared).json(path)
    try:
        inferred = reader.json(path)
        nothing_found = set(inferred.columns) <= {CORRUPT_COLUMN}
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        nothing_found = True
    return scan_jsonl(spark, path, EMPTY_LANDING, malformed, keep_corrupt) if nothing_found else inferred


def is_corrupt(df: DataFrame) -> Column:
    """Condition for the malformed lines of a scan with ``keep_corrupt``."""
    if CORRUPT_COLUMN not in df.columns:
        return F.lit(False)
    return F.col(CORRUPT_COLUMN).isNotNull()
