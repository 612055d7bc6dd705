"""Typed columns, validation and quarantine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelayers.functions.columns import as_column
from lakelayers.functions.parsing import (
    parse_bool,
    parse_bool_lenient,
    parse_double,
    parse_long,
)
from lakelayers.functions.rules import Rule, first_failed_rule
from lakelayers.scratch import stage

# What a rejected text should have been.
KIND_NAMES = {
    "bool": "a boolean (true/false/1/0/yes/no)",
    "lenient_bool": "a boolean",
    "int": "an integer",
    "float": "a float",
}

PARSERS = {
    "bool": parse_bool,
    "lenient_bool": parse_bool_lenient,
    "int": parse_long,
    "float": parse_double,
}


def typed_value(text: Column | str, kind: str, default: object = None) -> tuple[Column, Column]:
    """Typed value and whether the text was rejected; null text gives the default."""
    column = as_column(text)
    parsed = PARSERS[kind](column)
    rejected = column.isNotNull() & parsed.isNull()
    if default is not None:
        parsed = F.when(column.isNull(), F.lit(default)).otherwise(parsed)
    return parsed, rejected


def parse_columns(
    df: DataFrame,
    kinds: Mapping[str, str],
    defaults: Mapping[str, object] | None = None,
    rejects: str = "rejected_columns",
    on_reject: str = "report",
) -> DataFrame:
    """Replace text columns by typed ones.

    With ``on_reject="report"`` text that does not parse becomes null and the column ``rejects``
    lists the names concerned; with ``"fail"`` the first such text fails the query.
    """
    if on_reject not in ("report", "fail"):
        raise ValueError(f"on_reject must be 'report' or 'fail', not {on_reject!r}")
    values, failures = {}, []
    for name, kind in kinds.items():
        parsed, rejected = typed_value(name, kind, (defaults or {}).get(name))
        if on_reject == "fail":
            complaint = F.concat(F.lit(f"{name} must be {KIND_NAMES[kind]}, got: "), F.col(name))
            parsed = F.when(rejected, F.raise_error(complaint)).otherwise(parsed)
        values[name] = parsed
        failures.append(F.when(rejected, F.lit(name)))
    if on_reject == "report":
        values[rejects] = F.concat_ws(",", *failures)
    return df.withColumns(values)


def validate(df: DataFrame, rules: Sequence[Rule], column: str = "failed_rule") -> DataFrame:
    """Add the name of the first rule a row breaks, null for a good row."""
    return df.withColumn(column, first_failed_rule(rules))


def split_rejects(
    df: DataFrame, rules: Sequence[Rule], column: str = "failed_rule", staged: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Good rows without, and rejected rows with the rule column.

    Both sides filter the input, which is cheap for a table scan. For a costly or changing input
    ask for ``staged``: its rows are computed and judged once and written by verdict, and each
    side reads its own folder only.
    """
    verdict = "__rejected"
    judged = validate(df, rules, column)
    flag = F.col(column).isNotNull()
    if staged:
        judged = stage(judged.withColumn(verdict, flag), "verdict", (verdict,))
        flag = F.col(verdict)
    good = judged.filter(~flag).drop(column, verdict)
    rejected = judged.filter(flag).drop(verdict)
    return good, rejected
