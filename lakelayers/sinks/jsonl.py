"""JSON Lines files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelayers.functions.json_text import EXACT_TIMES
from lakelayers.sinks.layout import gather_by, gather_counted

LINE_COLUMN = "line"
ROWS_PER_FILE = 1_000_000


def write_jsonl(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    rows_per_file: int = ROWS_PER_FILE,
    skip_empty: bool = True,
    json_options: Mapping[str, str] | None = None,
) -> bool:
    """One JSON object per row, nulls included; returns whether anything was written.

    Timestamps keep their microseconds, unless ``json_options`` for the writer say otherwise.

    Partition columns stand in the folder name and in each line. They are gathered by value
    first, so that a value's rows lie in few tasks while a hot value is split over several.
    """
    line = F.to_json(F.struct(*[F.col(name) for name in df.columns]), {
        "ignoreNullFields": "false", **EXACT_TIMES, **(json_options or {})
    })
    lines = df.select(line.alias(LINE_COLUMN), *partition_by)
    return write_lines(lines, path, partition_by, rows_per_file, skip_empty, df)


def write_lines(
    lines: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    rows_per_file: int = ROWS_PER_FILE,
    skip_empty: bool = True,
    counted: DataFrame | None = None,
) -> bool:
    """Ready-made lines in column ``line`` plus the partition columns.

    ``counted`` is a frame of the same rows in which partition values can be counted without the lines."""
    if skip_empty and lines.isEmpty():
        return False
    known = counted is not None and bool(partition_by)
    gathered = gather_counted(lines, partition_by, counted) if known else gather_by(lines, partition_by)
    writer = gathered.write.mode("append").option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.text(path)
    return True
