"""Difference and intersection of tables that count their repeated rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COPIES = 100_000


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """The rows of ``left`` without those of ``right``, copy by copy (``EXCEPT ALL``)."""
    return _copied(_counted(left, right), F.col("_l") - F.col("_r"))


def multiset_intersection(left: DataFrame, right: DataFrame) -> DataFrame:
    """The rows both have, as often as both have them (``INTERSECT ALL``)."""
    return _copied(_counted(left, right), F.least("_l", "_r"))


def _counted(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every distinct row with its number in each table; equal nulls are equal. Columns meet by name.

    One aggregation over both sides, begun before the shuffle: copies of a row leave a task as one.
    """
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError(f"columns differ: {left.columns} and {right.columns}")
    sides = left.withColumns({"_l": F.lit(1), "_r": F.lit(0)}).unionByName(right.withColumns({"_l": F.lit(0), "_r": F.lit(1)}))
    return sides.groupBy(*left.columns).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))


def _copied(counted: DataFrame, copies: Column) -> DataFrame:
    """Each row as often as ``copies`` says, in portions that other tasks can write."""
    columns = [name for name in counted.columns if name not in ("_l", "_r")]
    kept = counted.select(*columns, copies.alias("_n")).filter("_n > 0")
    portions = kept.withColumn("_portion", F.expr(f"explode(sequence(0L, (_n - 1) div {COPIES}))"))
    dealt = portions.repartition(*[F.col(f"`{name}`") for name in columns], "_portion")
    each = dealt.withColumn("_copy", F.expr(f"explode(sequence(1L, least({COPIES}L, _n - _portion * {COPIES})))"))
    return each.select(*columns)
