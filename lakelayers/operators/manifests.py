"""Comparison of file manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def manifest_diff(previous: DataFrame, current: DataFrame) -> DataFrame:
    """``path, status, previous_sha256, sha256`` for all paths of two manifests.

    The status is ``new``, ``gone``, ``changed`` or ``same``, by content hash.
    """
    old = previous.select("path", F.col("sha256").alias("previous_sha256"), F.lit(True).alias("was"))
    now = current.select("path", "sha256", F.lit(True).alias("is"))
    status = (
        F.when(F.col("was").isNull(), F.lit("new"))
        .when(F.col("is").isNull(), F.lit("gone"))
        .when(F.col("sha256").eqNullSafe(F.col("previous_sha256")), F.lit("same"))
        .otherwise(F.lit("changed"))
    )
    return old.join(now, "path", "full_outer").select(
        "path", status.alias("status"), "previous_sha256", "sha256"
    )
