"""Small helpers shared by the column functions."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime
from typing import Union

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Union[Column, str]

# White space of all kinds, in patterns that start with (?U).
BLANK = r"[\s\x1c-\x1f]"


def as_column(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def run_time(run_ts: datetime | str | None) -> Column:
    """The audit timestamp of a run: the given moment, else the query's start time."""
    if run_ts is None:
        return F.current_timestamp()
    return F.lit(run_ts).cast("timestamp")


def contains_any(text: Column, words: tuple[str, ...] | list[str]) -> Column:
    """True where ``text`` contains at least one of the words."""
    if not words:
        return F.lit(False)
    found = text.contains(words[0])
    for word in words[1:]:
        found = found | text.contains(word)
    return found


def first_match(cases: Iterable[tuple[Column, Column]], otherwise: Column) -> Column:
    """Value of the first case whose condition is true; a null condition does not count."""
    chain = None
    for condition, value in cases:
        chain = (F if chain is None else chain).when(condition, value)
    return otherwise if chain is None else chain.otherwise(otherwise)
