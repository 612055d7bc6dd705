"""Masking and clipping of column values for display."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelayers.functions.columns import ColumnOrName, as_column, contains_any

# A name that contains one of these words is sensitive.
SENSITIVE_WORDS = ("password", "secret", "token", "key", "credential")
FULL_MASK = "********"
SHORT_MASK = "***"
NO_VALUE = "None"
EMPTY_VALUE = "(empty)"


def is_sensitive_name(name: str) -> bool:
    """The name rule. It also hits surrogate keys such as ``l_orderkey``."""
    return any(word in name.lower() for word in SENSITIVE_WORDS)


def is_filled(value: Column, data_type: T.DataType) -> Column:
    """Neither null nor the empty or zero value of its type; never null itself."""
    if isinstance(data_type, (T.StringType, T.BinaryType)):
        filled = F.octet_length(value) > 0
    elif isinstance(data_type, T.NumericType):
        filled = value != F.lit(0)
    elif isinstance(data_type, T.BooleanType):
        filled = value
    elif isinstance(data_type, (T.ArrayType, T.MapType)):
        filled = F.size(value) > 0
    else:
        filled = value.isNotNull()
    return F.coalesce(filled, F.lit(False))


def mask_full(value: ColumnOrName, data_type: T.DataType = T.StringType()) -> Column:
    """``********`` for every filled value; null and empty values stay visible as such."""
    column = as_column(value)
    return F.when(is_filled(column, data_type), F.lit(FULL_MASK)).otherwise(column.cast("string"))


def mask_partial(value: ColumnOrName, data_type: T.DataType = T.StringType()) -> Column:
    """First and last four characters of values longer than eight, ``***`` for shorter ones."""
    column = as_column(value)
    text = column.cast("string")
    return (
        F.when(~is_filled(column, data_type), F.lit(NO_VALUE))
        .when(F.length(text) > 8, F.concat(F.left(text, F.lit(4)), F.lit("..."), F.right(text, F.lit(4))))
        .otherwise(F.lit(SHORT_MASK))
    )


def clip_text(value: ColumnOrName, limit: int = 100) -> Column:
    """Values longer than ``limit`` characters cut to the limit, ending in ``...``."""
    column = as_column(value)
    clipped = F.concat(F.left(column, F.lit(limit - 3)), F.lit("..."))
    return F.when(F.length(column) > limit, clipped).otherwise(column)


def mask_by_key(key: ColumnOrName, value: ColumnOrName, data_type: T.DataType | None = None) -> Column:
    """Full mask, as text, for the rows of a key/value table whose key name is sensitive.

    Without the type of the value its text decides whether it is filled: a zero then is.
    """
    column, kind = _typed(value, data_type)
    sensitive = contains_any(F.lower(as_column(key)), SENSITIVE_WORDS)
    return F.when(sensitive, mask_full(column, kind)).otherwise(column.cast("string"))


def preview_by_key(
    key: ColumnOrName, value: ColumnOrName, limit: int = 100, data_type: T.DataType | None = None
) -> Column:
    """Display text of a key/value table: sensitive rows masked, other values clipped."""
    column, kind = _typed(value, data_type)
    sensitive = contains_any(F.lower(as_column(key)), SENSITIVE_WORDS)
    hidden = F.when(is_filled(column, kind), F.lit(FULL_MASK)).otherwise(F.lit(EMPTY_VALUE))
    return F.when(sensitive, hidden).otherwise(clip_text(column.cast("string"), limit))


def _typed(value: ColumnOrName, data_type: T.DataType | None) -> tuple[Column, T.DataType]:
    column = as_column(value)
    return (column.cast("string"), T.StringType()) if data_type is None else (column, data_type)


def mask_columns(df: DataFrame, columns: list[str] | None = None, by_name: bool = False,
                 partial: bool = False) -> DataFrame:
    """Mask the listed columns, and with ``by_name`` also those the name rule hits."""
    chosen = set(columns or [])
    unknown = chosen - set(df.columns)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    if by_name:
        chosen |= {name for name in df.columns if is_sensitive_name(name)}
    mask = mask_partial if partial else mask_full
    return df.withColumns({
        field.name: mask(field.name, field.dataType) for field in df.schema if field.name in chosen
    })
