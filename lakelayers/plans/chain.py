"""Layer runs: databases and tables, then extract, transform and load."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakelayers.names import SESSION_CATALOG, TableRef, layer_database, layer_table, raw_folder
from lakelayers.operators.landing import LandingRun, land_responses
from lakelayers.operators.layers import count_records, normalize, standardize
from lakelayers.sinks.loads import has_loads, land_load, scan_loads
from lakelayers.sinks.tables import (
    LOAD_COLUMN,
    create_databases_for,
    create_layer_table,
    create_managed_table,
    write_table,
)
from lakelayers.sources.jsonl import is_corrupt, scan_jsonl
from lakelayers.sources.tables import scan_table
from lakelayers.streaming.bronze import MALFORMED_COLUMNS, malformed_lines


@dataclass(frozen=True)
class Entity:
    """One source entity and where its layers live; every source runs through the same code.

    With a ``load_id`` every layer table has a partition for each load. A run writes its own only,
    replacing it if the load is repeated, and reads only its own from the layer below. Bodies are then
    landed as that load, see :mod:`lakelayers.sinks.loads`. A raw folder that holds loads is read load
    by load, any other as a whole.
    """

    source: str
    entity: str
    raw_root: str
    id_field: str = "id"
    payload_schema: str | None = None
    json_options: dict[str, str] = field(default_factory=dict)
    databases: dict[str, str] = field(default_factory=dict)
    tables: dict[str, str] = field(default_factory=dict)
    catalog: str = SESSION_CATALOG
    table_format: str = "parquet"
    database_root: str | None = None
    create_tables: bool = True
    mode: str = "append"
    quarantine: bool = True
    run_ts: datetime | str | None = None
    load_id: str | None = None

    def table(self, layer: str) -> TableRef:
        return TableRef(
            self.databases.get(layer, layer_database(layer)),
            self.tables.get(layer, layer_table(self.source, self.entity, layer)),
            SESSION_CATALOG if layer == "raw" else self.catalog,
        )

    @property
    def malformed_table(self) -> TableRef:
        bronze = self.table("bronze")
        return TableRef(bronze.database, f"{bronze.table}_malformed", bronze.catalog)

    @property
    def raw_path(self) -> str:
        return raw_folder(self.raw_root, self.source, self.entity)


@dataclass(frozen=True)
class LayerRun:
    """Row counts of one layer run: of a load from its tables, else taken while the rows were written."""

    layer: str
    target: TableRef
    rows_in: int
    rows_out: int
    rows_malformed: int = 0

    @property
    def metrics(self) -> dict[str, int]:
        return {
            "rows_in": self.rows_in,
            "rows_out": self.rows_out,
            "rows_malformed": self.rows_malformed,
        }


def extract(spark: SparkSession, spec: Entity, layer: str) -> DataFrame:
    if layer == "bronze":
        schema = f"payload {spec.payload_schema}" if spec.payload_schema else None
        if has_loads(spark, spec.raw_path):
            return scan_loads(spark, spec.raw_path, schema, [spec.load_id] if spec.load_id else None, keep_corrupt=True)
        return scan_jsonl(spark, spec.raw_path, schema, keep_corrupt=True)
    below = scan_table(
        spark, spec.table("bronze" if layer == "silver" else "silver"),
        {LOAD_COLUMN: spec.load_id} if spec.load_id else None,
    )
    return below.drop(LOAD_COLUMN)


def transform(df: DataFrame, spec: Entity, layer: str) -> DataFrame:
    if layer == "bronze":
        return normalize(df, spec.id_field, run_ts=spec.run_ts, json_options=spec.json_options)
    if layer == "silver":
        return standardize(df, run_ts=spec.run_ts)
    return count_records(df, spec.entity, run_ts=spec.run_ts)


def run_layer(
    spark: SparkSession,
    spec: Entity,
    layer: str,
    custom_transform: Callable[[DataFrame], DataFrame] | None = None,
) -> LayerRun:
    """Run bronze, silver or gold once. Any failure is raised, none is swallowed.

    ``custom_transform`` takes the place of the layer's own transformation. Malformed lines go to
    a table of their own, for which the folder is read a second time only if there are any;
    without ``spec.quarantine`` bronze keeps them as rows of nulls. They are counted either way.
    """
    target = spec.table(layer)
    if spec.create_tables:
        create_databases_for(spark, layer, spec.databases, spec.catalog, spec.database_root)
        create_layer_table(spark, target, layer, spec.table_format, spec.load_id is not None)
    extracted = extract(spark, spec, layer)
    change = custom_transform or (lambda df: transform(df, spec, layer))
    malformed = is_corrupt(extracted) if layer == "bronze" else F.lit(False)
    kept = extracted.filter(~malformed) if spec.quarantine else extracted
    totals = F.count(F.lit(1)).alias("rows"), F.count_if(malformed).alias("malformed")
    mode = "overwrite" if spec.load_id else spec.mode
    # Only an overwrite of a table without partitions could erase what an empty frame does not
    # replace; nothing else needs the look for a first row. It asks for a row, not isEmpty(): that
    # would read nothing but the column of corrupt lines.
    erases = mode == "overwrite" and not spec.load_id and layer != "gold"
    if erases and change(kept).first() is None:
        counts, rows_out = extracted.agg(*totals, F.count(extracted.columns[0])).first(), 0
    else:
        read, written = Observation(), Observation()
        observed = extracted.observe(read, *totals)
        rows = change(observed.filter(~malformed) if spec.quarantine else observed)
        if spec.load_id:
            rows = rows.withColumn(LOAD_COLUMN, F.lit(spec.load_id))
        write_table(rows, target, mode, skip_empty=False, observation=written)
        counts, rows_out = read.get, written.get["rows"]
    if counts["malformed"] and spec.quarantine:
        save_malformed(spark, spec, extracted)
    if spec.load_id and (custom_transform is None or layer != "bronze"):
        return committed_counts(spark, spec, layer, counts["malformed"])
    return LayerRun(layer, target, counts["rows"], rows_out, counts["malformed"])


def committed_counts(spark: SparkSession, spec: Entity, layer: str, observed_malformed: int) -> LayerRun:
    """The counts of a load's run, from the rows that are in its tables.

    Parquet and ORC tables know them from their footers. Tasks that ran twice do not change them, as
    they may change what is counted while rows are written. Only malformed lines left in bronze are
    taken as observed.
    """
    def rows(ref: TableRef) -> int:
        return scan_table(spark, ref, {LOAD_COLUMN: spec.load_id}).count()

    out = rows(spec.table(layer))
    if layer != "bronze":
        return LayerRun(layer, spec.table(layer), rows(spec.table("bronze" if layer == "silver" else "silver")), out)
    if not spec.quarantine:
        return LayerRun(layer, spec.table(layer), out, out, observed_malformed)
    malformed = rows(spec.malformed_table) if observed_malformed else 0
    return LayerRun(layer, spec.table(layer), out + malformed, out, malformed)


def save_malformed(spark: SparkSession, spec: Entity, lines: DataFrame) -> None:
    """Append the malformed ones of the scanned lines, or replace those of the same load."""
    rejected, columns = malformed_lines(lines, spec.run_ts), MALFORMED_COLUMNS
    if spec.load_id:
        rejected, columns = rejected.withColumn(LOAD_COLUMN, F.lit(spec.load_id)), f"{columns}, {LOAD_COLUMN} STRING"
    if spec.create_tables:
        create_managed_table(
            spark, spec.malformed_table, columns, [LOAD_COLUMN] if spec.load_id else (), spec.table_format
        )
    write_table(rejected, spec.malformed_table, "overwrite" if spec.load_id else "append", skip_empty=False)


def run_raw(
    spark: SparkSession, spec: Entity, bodies: DataFrame, run: LandingRun | None = None, **landing
) -> LayerRun:
    """Land the records of response bodies (column ``body``) in the raw folder of the entity.

    ``landing`` goes to :func:`lakelayers.operators.landing.land_responses`. With a ``load_id`` a repeated
    landing replaces the one before and a broken one leaves nothing that is read; without it landing
    always adds files: repeat a chain without ``bodies`` if its landing was complete.
    """
    run = run or LandingRun(spec.source, spec.entity)
    if spec.load_id:
        counts = land_load(bodies, spec.raw_path, run, spec.load_id, **landing)
    else:
        counts = land_responses(bodies, spec.raw_path, run, **landing)
    return LayerRun("raw", spec.table("raw"), counts.bodies, counts.records, counts.unreadable)


def run_chain(
    spark: SparkSession,
    spec: Entity,
    until: str = "gold",
    bodies: DataFrame | None = None,
    run: LandingRun | None = None,
) -> list[LayerRun]:
    """Bronze, silver and gold in order, up to the given layer, and before them the landing of
    response bodies where there are any."""
    order = ["raw", "bronze", "silver", "gold"]
    landed = [] if bodies is None else [run_raw(spark, spec, bodies, run)]
    return landed + [run_layer(spark, spec, layer) for layer in order[1 : order.index(until) + 1]]
