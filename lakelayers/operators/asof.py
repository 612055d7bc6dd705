"""As-of join: for each row the latest row of another table at or before its time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelayers.scratch import stage

PART = "_part"


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    time: str,
    values: Sequence[str],
    how: str = "left",
    partitions: int | None = None,
) -> DataFrame:
    """``left`` with ``values`` of the latest ``right`` row of its keys that is not after it.

    Both have the columns ``keys`` and ``time``. Of right rows of one key and time the one with the
    greatest values counts, nulls the least. Rows with a null key or time meet nothing; with
    ``how="inner"`` left rows that meet nothing are left out.

    Both sides together are cut into ranges of key and time, so that a hot key lies in as many ranges as
    its rows fill. In each range the last right row is carried forward; what enters a range from those
    before follows from one row for each key and range that holds it. The ranges are staged.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    clash = set(values) & set(left.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are in both")
    rest = [name for name in left.columns if name not in (*keys, time)]
    value = F.struct(*[F.col(f"`{name}`") for name in values])
    meets = " and ".join(f"`{name}` is not null" for name in (*keys, time))
    ours = left.select(*keys, time, F.lit(1).alias("_side"), F.struct(F.lit(1).alias("_"), *rest).alias("_left"))
    theirs = right.filter(meets).select(*keys, time, value.alias("_right"))
    theirs = theirs.groupBy(*keys, time).agg(F.max("_right").alias("_right")).withColumn("_side", F.lit(0))
    both = ours.unionByName(theirs, allowMissingColumns=True)
    order = [*keys, time, "_side"]
    spread = F.xxhash64(F.monotonically_increasing_id()).alias("_spread")  # many rows of one key and time
    ranged = both.select("*", spread).repartitionByRange(*([partitions] if partitions else []), *order, "_spread")
    ranged = stage(ranged.withColumn(PART, F.spark_partition_id()), "asof-ranges")

    names = ", ".join(f"`{name}`" for name in keys)
    inside = F.expr(
        f"last(_right, true) over (partition by {PART}, {names} order by `{time}`, _side "
        "range between unbounded preceding and current row)"
    )
    carried = ranged.withColumn("_last", inside).filter("_side = 1")
    ends = ranged.filter("_side = 0").groupBy(PART, *keys).agg(F.max_by("_right", F.struct(time)).alias("_end"))
    held = ranged.select(PART, *keys).distinct().join(ends, [PART, *keys], "left")
    enters = F.expr(f"last(_end, true) over (partition by {names} order by {PART} rows between unbounded preceding and 1 preceding)")
    entering = held.withColumn("_enter", enters).filter("_enter is not null").select(PART, *keys, "_enter")
    met = carried.join(entering, [PART, *keys], "left").withColumn("_found", F.coalesce("_last", "_enter"))
    met = met.withColumn("_found", F.when(F.expr(meets), F.col("_found")))
    if how == "inner":
        met = met.filter("_found is not null")
    shown = {**{name: F.col(f"_left.`{name}`") for name in rest}, **{name: F.col(f"_found.`{name}`") for name in values}}
    ordered = [F.col(f"`{name}`") if name in (*keys, time) else shown[name].alias(name) for name in left.columns]
    return met.select(*ordered, *[shown[name].alias(name) for name in values])
