"""Table definitions and name-matched writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakelayers.names import LAYERS_OF_RUN, SESSION_CATALOG, TableRef, layer_database, quote
from lakelayers.sinks.layout import gather_by
from lakelayers.sources.tables import repair_partitions

# The columns of the layer tables.
LAYER_COLUMNS = {
    "bronze": "record_id STRING, payload_json STRING, processed_at TIMESTAMP",
    "silver": (
        "record_id STRING, payload_json STRING, payload_size INT, payload_hash STRING, "
        "processed_at TIMESTAMP, standardized_at TIMESTAMP"
    ),
    "gold": "records_total BIGINT, entity_type STRING, computed_at TIMESTAMP",
}

LOAD_COLUMN = "load_id"

FILE_FORMATS = ("parquet", "orc", "json", "csv", "avro", "text")


def create_database(
    spark: SparkSession, database: str, catalog: str = SESSION_CATALOG, location: str | None = None
) -> None:
    name = f"{quote(catalog)}.{quote(database)}"
    where = f" LOCATION {_text(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def create_databases_for(
    spark: SparkSession,
    layer: str,
    names: dict[str, str] | None = None,
    catalog: str = SESSION_CATALOG,
    location: str | None = None,
) -> None:
    """The input and output databases of a layer run; raw always lies in the session catalog."""
    for needed in LAYERS_OF_RUN[layer]:
        database = (names or {}).get(needed, layer_database(needed))
        where = f"{location.rstrip('/')}/{database}" if location else None
        create_database(
            spark, database, SESSION_CATALOG if needed == "raw" else catalog, where
        )


def create_layer_table(
    spark: SparkSession, ref: TableRef, layer: str, table_format: str = "parquet", by_load: bool = False
) -> None:
    """The bronze, silver or gold table, left alone if it exists.

    ``by_load`` adds the partition column ``load_id``, one partition for each load, which a
    repeated load replaces.
    """
    columns = f"{LAYER_COLUMNS[layer]}, {LOAD_COLUMN} STRING" if by_load else LAYER_COLUMNS[layer]
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {ref.sql} ({columns}) USING {table_format}"
        f"{_partition_clause([LOAD_COLUMN] if by_load else [])}"
    )


def create_managed_table(
    spark: SparkSession,
    ref: TableRef,
    columns: str,
    partition_by: Sequence[str] = (),
    table_format: str = "parquet",
    replace: bool = False,
) -> None:
    """A managed table; ``replace`` drops an existing one together with its rows."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {ref.sql}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {ref.sql} ({columns}) USING {table_format}"
        f"{_partition_clause(partition_by)}"
    )


def create_external_json_table(
    spark: SparkSession,
    ref: TableRef,
    columns: str,
    location: str,
    partition_by: Sequence[str] = (),
    replace: bool = False,
    repair: bool = True,
) -> None:
    """A table over the JSON Lines at ``location``; ``replace`` drops only the definition.

    ``columns`` includes the partition columns. Malformed lines read as rows of nulls. ``repair``
    makes the catalog list the partitions already there.
    """
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {ref.sql}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {ref.sql} ({columns}) USING json "
        f"OPTIONS (mode 'PERMISSIVE'){_partition_clause(partition_by)} LOCATION {_text(location)}"
    )
    if partition_by and repair:
        repair_partitions(spark, ref)


def write_table(
    df: DataFrame,
    ref: TableRef,
    mode: str = "append",
    skip_empty: bool = True,
    rebalance_by: Sequence[str] = (),
    observation: Observation | None = None,
) -> bool:
    """Write ``df`` with columns matched by name; returns whether anything was written.

    ``append`` adds the rows. ``overwrite`` replaces the partitions that occur in ``df``, in a
    table without partitions everything. A missing column is filled with null (file tables;
    other catalogs apply their own rule), an extra one is an error.

    An empty frame is not written at all. That check stops at the first row, but repeats the
    shuffles ahead of it, so pass ``skip_empty=False`` for frames known to have rows.
    ``rebalance_by`` lays out the rows by value, see :func:`gather_by`. ``observation`` receives
    ``rows``, counted by the write itself.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode must be 'append' or 'overwrite', not {mode!r}")
    if skip_empty and df.isEmpty():
        return False
    df = gather_by(df, rebalance_by)
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("rows"))
    if not _is_file_table(df.sparkSession, ref):
        writer = df.writeTo(ref.sql)
        writer.overwritePartitions() if mode == "overwrite" else writer.append()
        return True
    target = ref.sql.replace("{", "{{").replace("}", "}}")
    verb = (
        f"INSERT OVERWRITE {target} WITH ('partitionOverwriteMode' = 'dynamic')"
        if mode == "overwrite"
        else f"INSERT INTO {target}"
    )
    df.sparkSession.sql(f"{verb} BY NAME SELECT * FROM {{rows}}", rows=df)
    return True


def _is_file_table(spark: SparkSession, ref: TableRef) -> bool:
    """True for the session catalog's file tables, which have no data source V2 write."""
    if ref.catalog != SESSION_CATALOG:
        return False
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {ref.sql}").filter("col_name = 'Provider'")
    # The table's properties come after its columns, one of which may have that name too.
    provider = described.select("data_type").tail(1)
    return not provider or provider[0][0].lower() in FILE_FORMATS


def _partition_clause(columns: Sequence[str]) -> str:
    return f" PARTITIONED BY ({', '.join(quote(name) for name in columns)})" if columns else ""


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
