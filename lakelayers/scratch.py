"""Intermediate tables in the folder the cluster shares between its machines."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_local_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where the setting is absent, a local session gets a temporary folder; on a cluster its
    absence is an error, because a machine-local folder would not outlive the machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="lakelayers-")
    return _local_roots[app]


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new, unused folder, below the one folder this application uses.

    Results may read it until the application ends; after that the application's folder as a
    whole can go, see :func:`clear_scratch`.
    """
    return f"{_application_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _application_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/lakelayers-{spark.conf.get('spark.app.id', 'application')}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete everything this application has staged. Frames that still read it become unusable."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_application_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch_space(spark: SparkSession) -> Iterator[None]:
    """Clears what was staged once the block is left: write results inside it."""
    try:
        yield
    finally:
        clear_scratch(spark)


def stage(
    df: DataFrame,
    label: str,
    partition_by: tuple[str, ...] = (),
    observation: Observation | None = None,
    *measures: Column,
) -> DataFrame:
    """Write ``df`` as Parquet to a scratch folder and read it back.

    What follows depends on files only: a lost executor costs the re-read of some files, and
    every later pass sees the same rows in the same files. ``observation`` receives the
    measures, taken by the write itself.
    """
    spark = df.sparkSession
    folder = scratch_folder(spark, label)
    observed = df.observe(observation, *measures) if observation is not None else df
    writer = observed.write.mode("errorifexists").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
