"""Aggregates over several groupings, kept by load and merged when they are read."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelayers.names import TableRef
from lakelayers.sinks.tables import LOAD_COLUMN, create_managed_table, write_table
from lakelayers.sources.tables import scan_table

GROUPING = "grouping"
HLL_BITS = 14
KLL_K = 400


@dataclass(frozen=True)
class Measure:
    """A figure that can be merged: what makes it from rows, what merges it, and how it is shown."""

    name: str
    kind: str
    partial: Column
    merge: str
    shown: Column

    @property
    def merged(self) -> Column:
        return F.expr(f"{self.merge}(`{self.name}`)").alias(self.name)


def rows(name: str = "rows") -> Measure:
    return Measure(name, "BIGINT", F.count(F.lit(1)), "sum", F.col(name))


def total(name: str, column: str, kind: str = "DECIMAL(38,6)") -> Measure:
    """An exact sum; a decimal kind makes it independent of order."""
    return Measure(name, kind, F.sum(F.col(column).cast(kind)).cast(kind), "sum", F.col(name).cast(kind))


def least(name: str, column: str, kind: str) -> Measure:
    return Measure(name, kind, F.min(F.col(column).cast(kind)), "min", F.col(name))


def greatest(name: str, column: str, kind: str) -> Measure:
    return Measure(name, kind, F.max(F.col(column).cast(kind)), "max", F.col(name))


def distinct(name: str, column: str, bits: int = HLL_BITS) -> Measure:
    """An estimate of the number of distinct values, by HyperLogLog: a standard error of about
    ``1.04 / 2 ** (bits / 2)``. Columns are integers, strings or binary values."""
    sketch = F.hll_sketch_agg(column, F.lit(bits))
    return Measure(name, "BINARY", sketch, "hll_union_agg", F.hll_sketch_estimate(name))


def quantile(name: str, column: str, rank: float, k: int = KLL_K) -> Measure:
    """An estimated quantile of doubles, by a KLL sketch: its rank is off by about ``2.3 / k`` at most."""
    sketch = F.kll_sketch_agg_double(F.col(column).cast("double"), F.lit(k))
    return Measure(name, "BINARY", sketch, "kll_merge_agg_double", F.kll_sketch_get_quantile_double(name, F.lit(rank)))


def cube_sets(dimensions: Sequence[str]) -> list[tuple[str, ...]]:
    """All groupings of a cube."""
    return [some for size in range(len(dimensions), -1, -1) for some in combinations(dimensions, size)]


def rollup_sets(dimensions: Sequence[str]) -> list[tuple[str, ...]]:
    return [tuple(dimensions[:size]) for size in range(len(dimensions), -1, -1)]


def partial_cube(
    df: DataFrame, dimensions: Sequence[str], measures: Sequence[Measure], sets: Sequence[Sequence[str]] | None = None
) -> DataFrame:
    """One row for each group of each grouping: ``grouping``, the dimensions, the unfinished measures.

    Rows are aggregated by all dimensions once, partly before the shuffle; only these aggregates are
    copied for the groupings. ``grouping`` has a bit for each dimension, the first the highest, that is
    set where the dimension is summed over, so a null in the data is told from that.
    """
    sets = cube_sets(dimensions) if sets is None else sets
    finest = df.groupBy(*dimensions).agg(*[m.partial.alias(m.name) for m in measures])
    top = len(dimensions) - 1
    members = []
    for some in sets:
        number = sum(1 << top - i for i, name in enumerate(dimensions) if name not in some)
        kept = [(F.col(name) if name in some else F.lit(None).cast(finest.schema[name].dataType)).alias(name) for name in dimensions]
        members.append(F.struct(F.lit(number).alias(GROUPING), *kept))
    spread = finest.withColumn("_set", F.explode(F.array(*members))).select("_set.*", *[m.name for m in measures])
    return spread.groupBy(GROUPING, *dimensions).agg(*[m.merged for m in measures])


def write_cube(
    df: DataFrame,
    ref: TableRef,
    load_id: str,
    dimensions: Mapping[str, str],
    measures: Sequence[Measure],
    sets: Sequence[Sequence[str]] | None = None,
    table_format: str = "parquet",
) -> None:
    """Aggregate one load into its partition of a cube table; a repeated load replaces itself.

    ``dimensions`` maps columns to their SQL types. A load without rows leaves its partition as it is.
    """
    kinds = [f"{GROUPING} INT", *[f"`{name}` {kind}" for name, kind in dimensions.items()]]
    kinds += [f"`{m.name}` {m.kind}" for m in measures]
    create_managed_table(df.sparkSession, ref, ", ".join([*kinds, f"{LOAD_COLUMN} STRING"]), [LOAD_COLUMN], table_format)
    cube = partial_cube(df, list(dimensions), measures, sets).withColumn(LOAD_COLUMN, F.lit(load_id))
    write_table(cube, ref, "overwrite", skip_empty=False)


def read_cube(
    spark: SparkSession, ref: TableRef, dimensions: Sequence[str], measures: Sequence[Measure], loads: Sequence[str] | None = None
) -> DataFrame:
    """``grouping``, the dimensions and the finished measures over all loads, or those named; the rows
    the loads came from are not read."""
    stored = scan_table(spark, ref, {LOAD_COLUMN: list(loads)} if loads is not None else None)
    merged = stored.groupBy(GROUPING, *dimensions).agg(*[m.merged for m in measures])
    return merged.select(GROUPING, *dimensions, *[m.shown.alias(m.name) for m in measures])
