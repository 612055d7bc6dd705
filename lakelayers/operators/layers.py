"""What each layer does with its rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelayers.functions.columns import run_time
from lakelayers.functions.fingerprint import content_sha256
from lakelayers.functions.json_text import EXACT_TIMES


def normalize(
    df: DataFrame,
    id_field: str = "id",
    payload: str = "payload",
    run_ts: datetime | str | None = None,
    json_options: Mapping[str, str] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Bronze: ``record_id``, ``payload_json`` and ``processed_at`` from a payload.

    The payload is a struct, whose null fields are left out of the text, or was read without
    schema as JSON text or variant, which are kept whole. A payload without the id field has a
    null ``record_id``. ``json_options`` go to the JSON writer; timestamps keep their microseconds
    unless they say otherwise. The columns in ``keep`` come after the three.
    """
    options = {**EXACT_TIMES, **(json_options or {})}
    kind = df.schema[payload].dataType
    if isinstance(kind, T.StringType):
        record_id = F.get_json_object(payload, f"$.{id_field}")
        text = F.col(payload)
    elif isinstance(kind, T.VariantType):
        record_id = F.try_variant_get(F.col(payload), f"$.{id_field}", "string")
        text = F.to_json(payload, options)
    else:
        known = isinstance(kind, T.StructType) and id_field.split(".")[0] in kind.fieldNames()
        record_id = F.col(f"{payload}.{id_field}").cast("string") if known else F.lit(None).cast("string")
        text = F.to_json(payload, options)
    return df.select(
        record_id.alias("record_id"),
        text.alias("payload_json"),
        run_time(run_ts).alias("processed_at"),
        *keep,
    )


def standardize(
    df: DataFrame,
    record_id: str = "record_id",
    payload_json: str = "payload_json",
    run_ts: datetime | str | None = None,
) -> DataFrame:
    """Silver: rows with an id, plus the text's length in characters and its SHA-256."""
    return df.filter(F.col(record_id).isNotNull()).withColumns({
        "payload_size": F.length(payload_json),
        "payload_hash": content_sha256(payload_json),
        "standardized_at": run_time(run_ts),
    })


def count_records(
    df: DataFrame,
    entity: str,
    record_id: str = "record_id",
    run_ts: datetime | str | None = None,
) -> DataFrame:
    """Gold: one row with the number of non-null ids, also for an empty input."""
    return df.agg(F.count(record_id).alias("records_total")).select(
        "records_total",
        F.lit(entity).alias("entity_type"),
        run_time(run_ts).alias("computed_at"),
    )
