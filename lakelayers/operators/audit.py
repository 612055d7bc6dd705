"""Message classification, lineage audit and run metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelayers.functions.columns import as_column, contains_any, first_match, run_time
from lakelayers.functions.rules import strip_blank
from lakelayers.names import LAYERS, SESSION_CATALOG, TableRef
from lakelayers.sinks.tables import write_table

# Error classes with their keywords, in the order they are tried.
ERROR_KEYWORDS = (
    ("CONFIG_ERROR", ("configuration", "config")),
    ("VALIDATION_ERROR", ("validation", "invalid")),
    ("SPARK_ERROR", ("spark", "sql")),
    ("AWS_SERVICE_ERROR", ("aws", "s3", "glue", "secret")),
)
OTHER_ERROR = "GENERIC_ERROR"

# Layer assumed for names without a layer word, and the lake's catalog.
UNKNOWN_SOURCE_LAYER = "raw"
UNKNOWN_TARGET_LAYER = "bronze"
LAKE_CATALOG = "glue_catalog"

METRIC_COLUMNS = "run_id STRING, step STRING, metric STRING, value BIGINT, run_ts TIMESTAMP"


def classify_messages(
    df: DataFrame,
    message: str,
    keywords: Sequence[tuple[str, Sequence[str]]] = ERROR_KEYWORDS,
    otherwise: str = OTHER_ERROR,
    column: str = "error_code",
) -> DataFrame:
    """Class of the first keyword group found anywhere in the message, letter case aside."""
    lowered = "__lowered"
    cases = [(contains_any(F.col(lowered), list(words)), F.lit(code)) for code, words in keywords]
    code = first_match(cases, F.lit(otherwise))
    return df.withColumn(lowered, F.lower(message)).withColumn(column, code).drop(lowered)


def detected_layer(
    database: Column | str, table: Column | str, unknown: str, given: Column | None = None
) -> Column:
    """First layer whose word occurs in the database or table name, unless one is given."""
    names = F.lower(as_column(database)), F.lower(as_column(table))
    cases = [(names[0].contains(layer) | names[1].contains(layer), F.lit(layer)) for layer in LAYERS]
    if given is not None:
        cases.insert(0, (given.isNotNull(), given))
    return first_match(cases, F.lit(unknown))


def lineage_audit(df: DataFrame, lake_catalog: str = LAKE_CATALOG) -> DataFrame:
    """Layers, full names, kind and validity of table-to-table steps.

    Input columns: ``source_database, source_table, target_database, target_table`` and, where
    known, ``source_layer`` and ``target_layer``. A step within a layer or to the next one is
    valid if both layers are known ones and no name is blank. The layer word may occur anywhere in a name: ``withdrawals`` reads as raw.
    """
    given = {
        side: F.col(f"{side}_layer") if f"{side}_layer" in df.columns else None
        for side in ("source", "target")
    }
    named = ("source_database", "target_database", "source_table", "target_table")
    trimmed = {name: strip_blank(name) for name in named}
    layered = df.withColumns(trimmed).withColumns({
        "source_layer": detected_layer(
            "source_database", "source_table", UNKNOWN_SOURCE_LAYER, given["source"]
        ),
        "target_layer": detected_layer(
            "target_database", "target_table", UNKNOWN_TARGET_LAYER, given["target"]
        ),
    })
    source, target = F.col("source_layer"), F.col("target_layer")
    order = F.array(*[F.lit(layer) for layer in LAYERS])
    rank = F.array_position(order, source), F.array_position(order, target)
    empty = {name: F.coalesce(F.length(name), F.lit(0)) == 0 for name in named}
    no_database = empty["source_database"] | empty["target_database"]
    no_table = empty["source_table"] | empty["target_table"]
    known = (rank[0] > 0) & (rank[1] > 0)
    legal = known & ((source == target) | (rank[1] == rank[0] + 1))
    following = F.get(order, F.array_position(order, source).cast("int"))
    # The wording of the messages.
    steps = F.when(following.isNull() | (rank[0] == 0), F.lit("[]")).otherwise(
        F.concat(F.lit("['"), following, F.lit("']"))
    )
    refusal = F.concat(
        F.lit("Invalid pipeline: "), source, F.lit(" -> "), target,
        F.lit(". Valid transitions from "), source, F.lit(": "), steps,
    )
    return layered.withColumns({
        "source_full_name": _full_name("source", lake_catalog),
        "target_full_name": _full_name("target", lake_catalog),
        "is_cross_layer": source != target,
        "pipeline_type": F.when(source == target, F.concat(source, F.lit("_processing"))).otherwise(
            F.concat(source, F.lit("_to_"), target)
        ),
        "is_valid": legal & ~no_database & ~no_table,
        "message": F.when(no_database, F.lit("Database name cannot be empty"))
        .when(no_table, F.lit("Table name cannot be empty"))
        .when(~legal, refusal),
    })


def _full_name(side: str, lake_catalog: str) -> Column:
    catalog = F.when(F.col(f"{side}_layer") == "raw", F.lit(SESSION_CATALOG)).otherwise(
        F.lit(lake_catalog)
    )
    return F.concat_ws(".", catalog, F.col(f"{side}_database"), F.col(f"{side}_table"))


def metrics_frame(
    spark: SparkSession,
    run_id: str,
    step: str,
    metrics: Mapping[str, int],
    run_ts: datetime | str | None = None,
) -> DataFrame:
    """The figures of one run step as rows ``run_id, step, metric, value, run_ts``."""
    figures = [
        F.struct(F.lit(name).alias("metric"), F.lit(int(value)).cast("bigint").alias("value"))
        for name, value in metrics.items()
    ]
    return spark.range(1).select(
        F.lit(run_id).alias("run_id"),
        F.lit(step).alias("step"),
        F.inline(F.array(*figures)),
        run_time(run_ts).alias("run_ts"),
    )


def record_metrics(
    spark: SparkSession,
    ref: TableRef,
    run_id: str,
    step: str,
    metrics: Mapping[str, int],
    run_ts: datetime | str | None = None,
) -> None:
    """Append the figures of one run step to a metrics table."""
    write_table(metrics_frame(spark, run_id, step, metrics, run_ts), ref, skip_empty=False)
