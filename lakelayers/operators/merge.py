"""Survivorship merge of keyed tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def survivorship_merge(layers: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Per key and column the non-null value of the highest-ranked layer, and its origin.

    ``layers`` maps layer names to frames, highest rank first; a layer may lack columns. Each
    value column ``c`` comes with ``c_source``, null where no layer has a value. Several rows
    of one key in one layer count as one, the smallest value winning. One shuffle on the key,
    with partial aggregation before it, so that copies of a hot key shrink in each task.

    A row with a null among its keys is no statement about any key: such rows come back one by
    one, each with its own layer as origin.
    """
    if not layers:
        raise ValueError("at least one layer is needed")
    names = list(layers)
    ranked = [
        frame.withColumn("__rank", F.lit(rank)) for rank, frame in enumerate(layers.values())
    ]
    stacked = reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), ranked)
    values = [name for name in stacked.columns if name not in keys and name != "__rank"]
    keyed = reduce(and_, [F.col(key).isNotNull() for key in keys], F.lit(True))
    winners = stacked.filter(keyed).groupBy(*keys).agg(*[
        F.min(F.when(F.col(name).isNotNull(), F.struct("__rank", name))).alias(name)
        for name in values
    ])
    origin = F.array(*[F.lit(name) for name in names])
    columns, own = [], []
    for name in values:
        columns.append(F.col(f"{name}.{name}").alias(name))
        columns.append(F.get(origin, F.col(f"{name}.__rank")).alias(f"{name}_source"))
        own.append(F.col(name))
        own.append(F.when(F.col(name).isNotNull(), F.get(origin, F.col("__rank"))).alias(f"{name}_source"))
    loose = stacked.filter(~keyed).select(*keys, *own)
    return winners.select(*keys, *columns).unionByName(loose)
