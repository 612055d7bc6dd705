"""Dense global row numbers without a single-partition sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from lakelayers.scratch import stage

PART = "__part"
POSITION = "__position"
OFFSET = "__offset"

# monotonically_increasing_id() keeps the row's position in its partition in the low 33 bits.
POSITION_MASK = (1 << 33) - 1

# Offsets are broadcast while their keys and numbers take at most this many bytes.
BROADCAST_BYTES = 64 * 1024 * 1024
OFFSET_BYTES = 24


def _stage_with_positions(df: DataFrame, label: str) -> DataFrame:
    """The staged rows with the number of their partition and their position in it."""
    positions = {
        PART: F.spark_partition_id(),
        POSITION: F.monotonically_increasing_id().bitwiseAND(F.lit(POSITION_MASK)),
    }
    return stage(df.withColumns(positions), label)


def with_ordinal(
    df: DataFrame,
    column: str = "ordinal",
    order_by: Sequence[str] | None = None,
    unique: bool = False,
    partitions: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Number the rows 0, 1, 2, … over the whole frame.

    Without ``order_by`` rows are numbered as they arrive and nothing is shuffled. With it they
    are range-partitioned and sorted by these columns; rows with equal values keep their arrival
    order, which also spreads a hot value over partitions. ``unique=True`` says that the columns
    identify a row and saves the write that fixes the arrival order; the frame is then computed
    twice, for the range boundaries and for the rows, so leave it out for costly frames.
    ``partitions`` sets the number of ranges, else ``spark.sql.shuffle.partitions`` does.

    The numbered rows are staged in a scratch table with partition number and position, so that
    the counting pass and the numbering pass see the same partitions, executors lost or not.
    Only one count per partition goes through a single task. These counts are broadcast while
    they take at most ``broadcast_bytes``, and joined by a shuffle beyond that.
    """
    if order_by:
        keys = [F.col(name) for name in order_by]
        if not unique:
            df = _stage_with_positions(df, "arrival")
            keys += [F.col(PART), F.col(POSITION)]
        ranges = [partitions] if partitions else []
        df = df.repartitionByRange(*ranges, *keys).sortWithinPartitions(*keys).drop(PART, POSITION)
    return _add_offsets(_stage_with_positions(df, "ordinal"), F.col(PART), column, broadcast_bytes)


def parquet_with_ordinal(
    spark: SparkSession,
    path: str | Sequence[str],
    column: str = "ordinal",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The rows of Parquet files numbered 0, 1, 2, … in the order of paths and of rows in them.

    Parquet scans know a row's position in its file, and the footers its number of rows, so
    nothing is staged or shuffled. The files must not change before the frame is used up.
    """
    scan = spark.read.parquet(*([path] if isinstance(path, str) else path))
    file = F.col("_metadata.file_path")
    return _add_offsets(scan, file, column, broadcast_bytes, F.col("_metadata.row_index"))


def _add_offsets(
    df: DataFrame, part: Column, column: str, broadcast_bytes: int, position: Column | None = None
) -> DataFrame:
    """Turn positions within parts into global numbers; the rows of each part are counted once."""
    counts = df.groupBy(part.alias(PART)).agg(F.count(F.lit(1)).alias("rows"))
    earlier = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("rows").over(earlier), F.lit(0)).cast("bigint")
    seen = Observation()
    size = F.coalesce(F.sum(F.octet_length(F.col(PART).cast("string")) + OFFSET_BYTES), F.lit(0))
    offsets = stage(
        counts.select(PART, offset.alias(OFFSET)), "offsets", (), seen, size.alias("bytes")
    )
    small = seen.get["bytes"] <= broadcast_bytes
    positioned = df.withColumns({PART: part, POSITION: F.col(POSITION) if position is None else position})
    return (
        positioned.join(F.broadcast(offsets) if small else offsets.hint("merge"), PART)
        .withColumn(column, F.col(OFFSET) + F.col(POSITION))
        .drop(PART, POSITION, OFFSET)
    )
