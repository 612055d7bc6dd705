"""Content fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakelayers.functions.columns import ColumnOrName, as_column


def content_sha256(content: ColumnOrName) -> Column:
    """SHA-256 hex of a string's UTF-8 bytes or of a binary value; null stays null."""
    return F.sha2(as_column(content).cast("binary"), 256)
