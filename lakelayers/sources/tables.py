"""Scans of catalog tables."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelayers.functions.predicates import predicate
from lakelayers.names import TableRef, quote

PARTITIONS_PER_STATEMENT = 500

# Fixed value: the folder of null in a partition column.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def repair_partitions(spark: SparkSession, ref: TableRef) -> None:
    """Make the catalog list the partition folders found at the table's location."""
    spark.sql(f"MSCK REPAIR TABLE {ref.sql}")


def new_partitions(spark: SparkSession, ref: TableRef) -> DataFrame:
    """The partitions whose folders hold files but which the catalog does not list, a row each: column
    ``partition`` in the form ``a=1/b=x``, as folders are named.

    Two tables are compared, the folders that a listing of files finds and the catalog's partitions; no
    file is opened. Folders that are no partitions of the table are left out.
    """
    keys = [column.name for column in spark.catalog.listColumns(ref.sql) if column.isPartition]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(table_location(spark, ref))
    pattern = "/(" + "/".join(f"\\Q{key}\\E=[^/]*" for key in keys) + ")/[^/]*$"
    found = files.select(F.regexp_extract("path", pattern, 1).alias("partition")).filter("partition <> ''").distinct()
    return found.join(spark.sql(f"SHOW PARTITIONS {ref.sql}"), "partition", "left_anti")


def register_partitions(spark: SparkSession, ref: TableRef) -> int:
    """Make the catalog list the partitions it lacks, and those only; returns their number.

    Landed rows are not read again. The names of new folders pass through the driver, which adds
    ``PARTITIONS_PER_STATEMENT`` of them at a time; registered ones stay in the two compared tables.
    """
    added, statement = 0, []
    for row in new_partitions(spark, ref).toLocalIterator():
        statement.append(_specification(row["partition"]))
        if len(statement) == PARTITIONS_PER_STATEMENT:
            added += _add_partitions(spark, ref, statement)
            statement = []
    return added + _add_partitions(spark, ref, statement)


def _add_partitions(spark: SparkSession, ref: TableRef, specifications: list[str]) -> int:
    if specifications:
        spark.sql(f"ALTER TABLE {ref.sql} ADD IF NOT EXISTS {' '.join(specifications)}")
    return len(specifications)


def _specification(folders: str) -> str:
    """``PARTITION (…)`` of a path of partition folders; names and values are escaped in it."""
    pairs = [folder.split("=", 1) for folder in folders.split("/")]
    values = ((unquote(name), "NULL" if value == NULL_FOLDER else _text(unquote(value))) for name, value in pairs)
    return "PARTITION (" + ", ".join(f"{quote(name)} = {value}" for name, value in values) + ")"


def table_location(spark: SparkSession, ref: TableRef) -> str:
    """The folder of a file table."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {ref.sql}").filter("col_name = 'Location'")
    return unquote(described.select("data_type").tail(1)[0][0])


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def scan_table(
    spark: SparkSession, ref: TableRef, filters: Mapping[str, Any] | None = None
) -> DataFrame:
    """Rows of a table that fulfil ``{column: value | [values]}``."""
    df = spark.table(ref.sql)
    return df.filter(predicate(filters)) if filters else df


def scan_external_table(
    spark: SparkSession,
    ref: TableRef,
    filters: Mapping[str, Any] | None = None,
    is_partitioned: bool = True,
) -> DataFrame:
    """Like :func:`scan_table`, after new partitions were registered where the table has any.

    Their search lists the files of the table: pass ``is_partitioned=False`` where landings register
    their partitions themselves.
    """
    if is_partitioned:
        register_partitions(spark, ref)
    return scan_table(spark, ref, filters)
