"""Filter dictionaries as Spark predicates."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def column_predicate(name: str, wanted: Any) -> Column:
    """Equality for a value, IN for a list; ``None`` means IS NULL, an empty list no row."""
    column = F.col(name)
    if wanted is None:
        return column.isNull()
    if not isinstance(wanted, (list, tuple, set, frozenset)):
        return column == F.lit(wanted)
    values = [value for value in wanted if value is not None]
    matched = column.isin(values) if values else F.lit(False)
    if len(values) < len(wanted):
        matched = matched | column.isNull()
    return matched


def predicate(filters: Mapping[str, Any] | None) -> Column:
    """All entries of ``{column: value | [values]}`` combined with AND."""
    clauses = [column_predicate(name, wanted) for name, wanted in (filters or {}).items()]
    return reduce(and_, clauses, F.lit(True))
