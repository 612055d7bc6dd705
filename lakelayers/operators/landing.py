"""From response bodies or records to landed JSON Lines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelayers.functions.json_text import EXACT_TIMES, fill_absent_keys, response_records
from lakelayers.names import quote
from lakelayers.operators.ordinals import with_ordinal
from lakelayers.scratch import stage
from lakelayers.sinks.jsonl import LINE_COLUMN, ROWS_PER_FILE, write_jsonl, write_lines

# The request facts of the metadata struct with type and default.
REQUEST_FIELDS = {
    "request_timestamp": ("string", None),
    "request_url": ("string", ""),
    "response_status_code": ("int", 0),
    "response_time_ms": ("int", 0),
}
INGESTION_METHOD = "api_polling"

# The metadata struct of a landed line.
METADATA_SCHEMA = (
    "struct<request_timestamp: string, request_url: string, response_status_code: int, "
    "response_time_ms: int, ingestion_timestamp: string, ingestion_job: string, "
    "ingestion_source: string, ingestion_method: string, record_id: string, batch_id: string, "
    "file_name: string>"
)

ORDINAL = "__ordinal"
RECORDS = "__records"


@dataclass(frozen=True)
class LandingCounts:
    """Bodies read, bodies that could give no records, and records landed. True if any landed."""

    bodies: int
    unreadable: int
    records: int

    def __bool__(self) -> bool:
        return self.records > 0


@dataclass(frozen=True)
class LandingRun:
    """What one landing run writes into the metadata of every record.

    ``batch_size`` is the number of records of a batch number; ``rows_per_file`` bounds files.
    """

    source: str
    entity: str
    job: str = "landing"
    started: datetime | None = None
    batch_size: int = 500
    rows_per_file: int = ROWS_PER_FILE

    def __post_init__(self) -> None:
        if self.batch_size < 1 or self.rows_per_file < 1:
            raise ValueError("batch_size and rows_per_file must be at least 1")
        if self.started is None:
            object.__setattr__(self, "started", datetime.now(timezone.utc))

    @property
    def _utc(self) -> datetime:
        moment = self.started
        if moment.tzinfo is not None:
            moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
        return moment

    @property
    def label(self) -> str:
        return self._utc.strftime("%Y%m%d_%H%M%S")

    @property
    def iso(self) -> str:
        return self._utc.isoformat() + "Z"


def unnest_responses(df: DataFrame, body: str = "body", record: str = "record") -> DataFrame:
    """One row per record of each response body; the other columns are repeated."""
    rest = [F.col(name) for name in df.columns if name != body]
    return df.select(*rest, F.explode(response_records(body)).alias(record))


def unreadable_responses(df: DataFrame, body: str = "body") -> DataFrame:
    """The rows whose body cannot give records: invalid JSON, scalars, ``data`` that is no array.

    An empty array is readable and simply holds no record.
    """
    return df.filter(response_records(body).isNull())


def enrich_records(df: DataFrame, run: LandingRun, record: str = "record") -> DataFrame:
    """``ingested_at``, ``source`` and ``entity_type`` for JSON records that lack the key."""
    defaults = {"ingested_at": run.iso, "source": run.source, "entity_type": run.entity}
    return df.withColumn(record, fill_absent_keys(record, defaults))


def enrich_columns(df: DataFrame, run: LandingRun) -> DataFrame:
    """The same for typed frames, where a key is absent if the column is."""
    defaults = {"ingested_at": run.iso, "source": run.source, "entity_type": run.entity}
    return df.withColumns({
        name: F.lit(value) for name, value in defaults.items() if name not in df.columns
    })


def _padded(number: Column, width: int) -> Column:
    """Decimal digits with leading zeros; numbers of more digits are not cut."""
    digits = number.cast("string")
    return F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)


def batch_columns(ordinal: str, run: LandingRun) -> dict[str, Column]:
    """``record_id``, ``batch_id`` and ``file_name`` of the record with this global number."""
    batch = _padded(F.expr(f"{quote(ordinal)} div {run.batch_size} + 1"), 3)
    index = _padded(F.col(ordinal) % run.batch_size, 6)
    return {
        "record_id": F.concat(F.lit(f"{run.label}_"), batch, F.lit("_"), index),
        "batch_id": F.concat(F.lit(f"{run.label}_batch_"), batch),
        "file_name": F.concat(F.lit(f"{run.source}_data_{run.label}_batch_"), batch, F.lit(".jsonl")),
    }


def with_batch_ids(
    df: DataFrame,
    run: LandingRun,
    order_by: Sequence[str] | None = None,
    unique: bool = False,
    ordinal: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Add the batch columns, from global numbers given in ``ordinal`` or made here."""
    numbered = df if ordinal else with_ordinal(df, ORDINAL, order_by, unique, partitions)
    return numbered.withColumns(batch_columns(ordinal or ORDINAL, run)).drop(ordinal or ORDINAL)


def envelope(
    df: DataFrame,
    run: LandingRun,
    payload: str | Sequence[str],
    keep: Sequence[str] = (),
    request: Mapping[str, object] | None = None,
) -> DataFrame:
    """``payload``, the kept columns and the ``metadata`` struct, from a frame with batch ids.

    ``payload`` is the name of a column taken as it is, or a list of columns to pack. Request
    facts come from ``request`` (values or columns), else from columns of that name, else from
    the defaults.
    """
    facts = dict(request or {})
    members = []
    for name, (kind, default) in REQUEST_FIELDS.items():
        if name in facts:
            value = facts[name]
            value = value if isinstance(value, Column) else F.lit(value)
        elif name in df.columns:
            value = F.col(name)
        else:
            value = F.lit(run.iso if name == "request_timestamp" else default)
        members.append(value.cast(kind).alias(name))
    members += [
        F.lit(run.iso).alias("ingestion_timestamp"),
        F.lit(run.job).alias("ingestion_job"),
        F.lit(run.source).alias("ingestion_source"),
        F.lit(INGESTION_METHOD).alias("ingestion_method"),
        F.col("record_id"),
        F.col("batch_id"),
        F.col("file_name"),
    ]
    packed = F.col(payload) if isinstance(payload, str) else F.struct(*payload)
    return df.select(packed.alias("payload"), *keep, F.struct(*members).alias("metadata"))


def landing_lines(enveloped: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """JSON text of each enveloped record; a payload of JSON text is embedded as it is.

    Line breaks can only stand between the tokens of a JSON text, so blanks may replace them.
    """
    options = {"ignoreNullFields": "false", **EXACT_TIMES}
    if isinstance(enveloped.schema["payload"].dataType, T.StringType):
        payload = F.translate("payload", "\r\n", "  ")
    else:
        payload = F.to_json("payload", options)
    rest = F.to_json(F.struct(*[F.col(name) for name in keep], F.col("metadata")), options)
    payload = F.coalesce(payload, F.lit("null"))
    line = F.concat(F.lit('{"payload":'), payload, F.lit(","), F.substr(rest, F.lit(2)))
    return enveloped.select(line.alias(LINE_COLUMN), *keep)


def land_records(
    df: DataFrame,
    path: str,
    run: LandingRun,
    payload: str | Sequence[str],
    partition_by: Sequence[str] = (),
    order_by: Sequence[str] | None = None,
    unique: bool = False,
    request: Mapping[str, object] | None = None,
    ordinal: str | None = None,
    skip_empty: bool = True,
    partitions: int | None = None,
) -> bool:
    """Wrap records and append them as JSON Lines; returns whether anything was written.

    Records are numbered over the whole frame as in :func:`with_ordinal`, unless the column
    ``ordinal`` already holds such numbers. Nothing is written for an empty frame; pass
    ``skip_empty=False`` to save the look for a first row where there is one for certain.
    ``partitions`` is the number of ranges of an ordered landing.
    """
    if skip_empty and df.isEmpty():
        return False
    numbered = with_batch_ids(df, run, order_by, unique, ordinal, partitions)
    return _land_numbered(numbered, path, run, payload, partition_by, request)


def _land_numbered(
    numbered: DataFrame,
    path: str,
    run: LandingRun,
    payload: str | Sequence[str],
    partition_by: Sequence[str],
    request: Mapping[str, object] | None,
) -> bool:
    lines = landing_lines(envelope(numbered, run, payload, partition_by, request), partition_by)
    return write_lines(lines, path, partition_by, run.rows_per_file, False, numbered)


def land_responses(
    df: DataFrame,
    path: str,
    run: LandingRun,
    body: str = "body",
    partition_by: Sequence[str] = (),
    order_by: Sequence[str] | None = None,
    request: Mapping[str, object] | None = None,
    unique: bool = False,
    ordinal: str | None = None,
    partitions: int | None = None,
    skip_empty: bool = True,
    rejects: str | None = None,
) -> LandingCounts:
    """The raw layer run: unnest bodies, fill in defaults, wrap and land the records.

    With ``order_by`` the records of bodies that sort equally stay in their order of arrival;
    ``unique`` says that these columns identify a body: bodies are then sorted before they are
    parsed, in as many tasks as there are ranges. A column ``ordinal`` must number records.

    Bodies that can give no records are appended as JSON Lines, with all columns of ``df``, to the
    folder ``rejects``, by default the landing folder's name with ``_unreadable`` behind it; only if
    there are any are the bodies read once more for it. Landed records and kept bodies are counted in
    the tables they are landed from, which tasks that ran twice do not change. All bodies are counted
    while they are read: such tasks may count some twice.
    """
    found = F.size(F.coalesce(F.col(RECORDS), F.array().cast("array<string>")))
    totals = (
        F.count(F.lit(1)).alias("bodies"),
        F.count_if(F.col(RECORDS).isNull()).alias("unreadable"),
        F.coalesce(F.sum(found), F.lit(0)).alias("records"),
    )
    rest = [F.col(name) for name in df.columns if name != body]

    def records_of(frame: DataFrame) -> DataFrame:
        return frame.select(*rest, F.explode(RECORDS).alias("record"))

    parsed = df.withColumn(RECORDS, response_records(body))
    if skip_empty and records_of(parsed).isEmpty():
        counts = parsed.agg(*totals).first().asDict()
    else:
        seen = Observation()
        if order_by and unique and not ordinal:
            ranges = [partitions] if partitions else []
            placed = df.repartitionByRange(*ranges, *order_by).sortWithinPartitions(*order_by)
            parsed, order_by = placed.withColumn(RECORDS, response_records(body)), None
        records = enrich_records(records_of(parsed.observe(seen, *totals)), run)
        if ordinal:
            land_records(records, path, run, "record", partition_by, None, unique, request, ordinal, False)
            counts = dict(seen.get)
        else:
            numbered = with_batch_ids(records, run, order_by, unique, None, partitions)
            _land_numbered(numbered, path, run, "record", partition_by, request)
            counts = dict(seen.get, records=numbered.count())  # reads one column of the staged rows
    if counts["unreadable"]:
        folder = rejects or f"{path.rstrip('/')}_unreadable/"
        kept = stage(unreadable_responses(df, body), "unreadable")
        write_jsonl(kept, folder, rows_per_file=run.rows_per_file, skip_empty=False)
        counts["unreadable"] = kept.count()
    return LandingCounts(counts["bodies"], counts["unreadable"], counts["records"])
