"""The given tables, and which rows a model may learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def remainder(id_column: Column, modulus: int) -> Column:
    """CRC-32 of an id as text, modulo ``modulus``. A null id counts as the empty text."""
    text = F.coalesce(id_column.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % modulus


def is_remainder(id_column: Column, modulus: int, value: int) -> Column:
    return remainder(id_column, modulus) == value
