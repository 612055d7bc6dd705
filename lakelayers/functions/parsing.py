"""Strict and lenient parsing of text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakelayers.functions.columns import BLANK, ColumnOrName, as_column

# The accepted spellings.
STRICT_TRUE = ("true", "1", "yes")
STRICT_FALSE = ("false", "0", "no")
LENIENT_TRUE = ("true", "1", "yes", "on")
INTEGER_PATTERN = f"(?U)^{BLANK}*[+-]?[0-9]+(_[0-9]+)*{BLANK}*$"
FLOAT_PATTERN = (
    rf"(?U)^{BLANK}*[+-]?([0-9]+(_[0-9]+)*(\.([0-9]+(_[0-9]+)*)?)?|\.[0-9]+(_[0-9]+)*)"
    rf"([eE][+-]?[0-9]+(_[0-9]+)*)?{BLANK}*$"
)
FLOAT_WORD_PATTERN = f"(?iU)^{BLANK}*[+-]?(nan|inf|infinity){BLANK}*$"


def parse_bool(text: ColumnOrName) -> Column:
    """true/1/yes and false/0/no in any case; anything else is null."""
    folded = F.lower(as_column(text))
    return F.when(folded.isin(*STRICT_TRUE), F.lit(True)).when(
        folded.isin(*STRICT_FALSE), F.lit(False)
    )


def parse_bool_lenient(text: ColumnOrName) -> Column:
    """true/1/yes/on in any case is true, any other text false; null stays null."""
    return F.lower(as_column(text)).isin(*LENIENT_TRUE)


def parse_long(text: ColumnOrName) -> Column:
    """Decimal integers with optional sign, blanks around and ``_`` between digits.

    Null for other text and for numbers beyond 64 bits.
    """
    column = as_column(text)
    digits = F.translate(F.trim(F.regexp_replace(column, f"(?U){BLANK}", " ")), "_", "")
    return F.when(column.rlike(INTEGER_PATTERN), digits.try_cast("bigint"))


def parse_double(text: ColumnOrName, allow_words: bool = True) -> Column:
    """Decimal and exponent notation; with ``allow_words`` also nan, inf and infinity."""
    column = as_column(text)
    trimmed = F.trim(F.regexp_replace(column, f"(?U){BLANK}", " "))
    parsed = F.when(
        column.rlike(FLOAT_PATTERN), F.translate(trimmed, "_", "").try_cast("double")
    )
    if not allow_words:
        return parsed
    word = F.lower(F.regexp_replace(trimmed, r"^[+-]", ""))
    magnitude = F.when(word == "nan", F.lit(float("nan"))).otherwise(F.lit(float("inf")))
    signed = F.when(trimmed.startswith("-"), -magnitude).otherwise(magnitude)
    return F.when(column.rlike(FLOAT_WORD_PATTERN), signed).otherwise(parsed)
