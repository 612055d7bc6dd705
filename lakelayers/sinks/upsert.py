"""MERGE into file tables: only the files that hold a matched row are written anew."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelayers.folders import Folder
from lakelayers.names import TableRef
from lakelayers.scratch import stage
from lakelayers.sinks.layout import gather_by
from lakelayers.sources.tables import register_partitions, table_location

JOURNALS = "_merges"
MATCHED = "__matched"


@dataclass(frozen=True)
class MergeResult:
    """Files the merge took out of the table and put into it."""

    files_removed: int
    files_added: int


def merge_into(
    spark: SparkSession,
    ref: TableRef,
    source: DataFrame,
    keys: Sequence[str],
    delete: Column | None = None,
    update: bool = True,
    insert: bool = True,
) -> MergeResult:
    """Update the rows of a file table whose keys occur in ``source`` and insert the other source rows.

    Columns are matched by name: those that ``source`` lacks keep their value in updated rows and are null
    in inserted ones; an extra one is an error, and so is a key that several source rows have. Rows with a
    null among their keys match nothing. Where ``delete``, a condition on source columns, is true, a
    matched row is deleted and no row inserted. All rows of a key in the table are matched.

    Keys meet the table in one join that reads its key columns only. The files with a match are read and
    written anew; all others keep name and time. Only names of files pass through the driver. The new files
    are written aside first and named, with the old ones, in a journal below ``_merges``; then they change
    places. A merge that breaks before the journal leaves the table as it was, one that breaks after it is
    finished by :func:`finish_merges`, which every merge calls first. Files have no snapshots: queries
    that run while files change places may see both or none. One merge at a time may run on a table.
    """
    table = spark.table(ref.sql)
    extra = set(source.columns) - set(table.columns)
    if extra or not set(keys) <= set(source.columns) or not keys:
        raise ValueError(f"columns {sorted(extra)} are not in {ref.sql}" if extra else "the keys must be columns of the source")
    finish_merges(spark, ref)
    kinds = dict(zip(table.columns, table.schema.fields, strict=True))
    gone = F.coalesce(delete, F.lit(False)) if delete is not None else F.lit(False)
    typed = source.select(*[F.col(name).cast(kinds[name].dataType).alias(name) for name in source.columns], gone.alias("__gone"))
    changes = stage(typed, "merge-source")
    repeated = changes.dropna(subset=list(keys)).groupBy(*keys).count().filter("count > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"several source rows have the key {tuple(repeated[0][:len(keys)])}")

    location = table_location(spark, ref)
    files = table.select(*keys, F.col("_metadata.file_path").alias("__file"))
    touched = files.join(changes.select(*keys), list(keys), "left_semi").select("__file").distinct()
    touched = stage(touched, "touched-files")
    removed = sorted(unquote(row["__file"]) for row in touched.collect())
    old = _rows_of(spark, ref, location, removed)

    new = changes.select(
        *[F.col(name).alias(name if name in keys else f"__new_{name}") for name in source.columns], "__gone", F.lit(True).alias(MATCHED)
    )
    met = old.join(new, list(keys), "left").withColumn("__hit", F.coalesce(MATCHED, F.lit(False)))
    values = [
        F.when(F.col("__hit"), F.col(f"__new_{name}")).otherwise(F.col(name)).alias(name)
        if update and name in source.columns and name not in keys else F.col(name)
        for name in table.columns
    ]
    merged = met.filter(~(F.col("__hit") & F.col("__gone"))).select(*values)
    if insert:
        absent = changes.filter(~F.col("__gone")).join(old.select(*keys), list(keys), "left_anti").drop("__gone")
        merged = merged.unionByName(absent, allowMissingColumns=True)
    return _exchange(spark, ref, location, merged, removed)


def _rows_of(spark: SparkSession, ref: TableRef, location: str, paths: list[str]) -> DataFrame:
    table = spark.table(ref.sql)
    if not paths:
        return table.limit(0)
    reader = spark.read.format(_provider(spark, ref)).schema(table.schema).option("basePath", location)
    return reader.load(paths).select(*table.columns)


def _exchange(spark: SparkSession, ref: TableRef, location: str, rows: DataFrame, removed: list[str]) -> MergeResult:
    number = uuid.uuid4().hex
    aside = f"_merge-{number}"
    partitions = [column.name for column in spark.catalog.listColumns(ref.sql) if column.isPartition]
    writer = gather_by(rows, partitions).write.format(_provider(spark, ref))
    (writer.partitionBy(*partitions) if partitions else writer).save(f"{location}/{aside}/rows")
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*")
    written = [row["path"] for row in listing.load(f"{location}/{aside}/rows").select("path").collect()]
    mark = f"/{aside}/rows/"
    added = sorted(path.split(mark, 1)[1] for path in written)
    root = _plain(location)
    journal = {
        "add": [[f"{aside}/rows/{name}", name] for name in added],
        "remove": [_plain(path).removeprefix(f"{root}/") for path in removed],
        "aside": aside,
    }
    Folder(spark, location).publish(f"{JOURNALS}/{number}.json", json.dumps(journal))
    finish_merges(spark, ref)
    return MergeResult(len(removed), len(added))


def finish_merges(spark: SparkSession, ref: TableRef) -> int:
    """Carry out what journals of broken merges still say, and drop what broke before its journal; returns
    the number of journals. Steps that are done already are passed over."""
    folder = Folder(spark, table_location(spark, ref))
    journals = [name for name in folder.names(JOURNALS) if name.endswith(".json")]
    for name in journals:
        journal = json.loads(folder.read(f"{JOURNALS}/{name}"))
        for source, target in journal["add"]:
            folder.move(source, target)
        for old in journal["remove"]:
            folder.delete(old)
        folder.delete(journal["aside"])
        folder.delete(f"{JOURNALS}/{name}")
    for name in folder.names():
        if name.startswith("_merge-"):
            folder.delete(name)
    if journals:
        if any(column.isPartition for column in spark.catalog.listColumns(ref.sql)):
            register_partitions(spark, ref)
        spark.catalog.refreshTable(ref.sql)
    return len(journals)


def _provider(spark: SparkSession, ref: TableRef) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {ref.sql}").filter("col_name = 'Provider'")
    return described.select("data_type").tail(1)[0][0]


def _plain(path: str) -> str:
    """A path without the differences that file systems make in writing a scheme."""
    return path.replace("file:///", "/").replace("file:/", "/").rstrip("/")
