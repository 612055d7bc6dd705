"""How rows are laid out over files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelayers.scratch import stage

ROWS = "__rows"
PORTIONS = "__portions"
ROWS_PER_TASK = 500_000


def gather_by(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bring the rows of a value into few tasks, and a hot value into several.

    Adaptive execution does the splitting. Without it a hot value would fall into one task, so
    the rows then stay where they are.
    """
    adaptive = df.sparkSession.conf.get("spark.sql.adaptive.enabled", "true")
    if not columns or adaptive.lower() != "true":
        return df
    return df.hint("rebalance", *[F.col(name) for name in columns])


def gather_counted(df: DataFrame, columns: Sequence[str], counted: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The same for long rows, by counts of the values in ``counted``, a frame with the rows of ``df``.

    A writer sorts the rows of a task by value in memory. Adaptive execution sizes tasks by compressed
    bytes and splits no block of one scan task; here a task has about ``rows_per_task`` rows whatever
    these are. Values with more than a tenth of that are dealt out in portions, by a hash of the first
    column that is no key: rows equal in it stay together. Counting reads the columns ``columns`` only.
    """
    spread = next(name for name in df.columns if name not in columns)
    values = stage(counted.groupBy(*columns).agg(F.count(F.lit(1)).alias(ROWS)), "value-rows")
    rows = values.agg(F.sum(ROWS)).first()[0] or 0
    hot = values.withColumn(PORTIONS, F.ceil(F.col(ROWS) * 10 / rows_per_task)).filter(f"{PORTIONS} > 1")
    hot = hot.select(PORTIONS, *[F.col(name).alias(f"__{i}") for i, name in enumerate(columns)])
    same = [F.col(name).eqNullSafe(F.col(f"__{i}")) for i, name in enumerate(columns)]
    portion = F.coalesce(F.pmod(F.xxhash64(spread), F.col(PORTIONS)), F.lit(0))
    # At most one row for each tenth of a task.
    dealt = df.join(F.broadcast(hot), same, "left").withColumn(PORTIONS, portion)
    return dealt.repartition(1 + rows // rows_per_task, *columns, PORTIONS).select(*df.columns)
