"""The first rows of each group, or of all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK = "rank"


def top_k(df: DataFrame, k: int, order_by: Sequence[Column], by: Sequence[str] = (), rank: str = RANK) -> DataFrame:
    """The first ``k`` rows in the given order, of each group of ``by`` or of all, with their rank from 1.

    The order should end in a column that no two rows share: ties are broken in any way. Nulls stand
    where the order puts them; null groups are a group. Each task keeps its first ``k`` rows of a group
    before the shuffle (for ``k`` up to ``spark.sql.optimizer.windowGroupLimitThreshold``), so a hot group
    sends ``k`` rows a task. Without groups ``k`` rows a task meet in one, and ``k`` must be small.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    if by:
        numbered = df.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order_by)))
        return numbered.filter(F.col(rank) <= k)
    first = df.orderBy(*order_by).limit(k)
    return first.withColumn(rank, F.row_number().over(Window.orderBy(*order_by)))
