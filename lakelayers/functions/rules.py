"""Validation rules and the normalizations that belong to them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakelayers.functions.columns import BLANK, ColumnOrName, as_column, first_match


@dataclass(frozen=True)
class Rule:
    """A named condition a good row fulfils; a null outcome counts as a failure."""

    name: str
    holds: Column


def not_null(column: str) -> Rule:
    return Rule(f"{column}_not_null", F.col(column).isNotNull())


def not_blank(column: str) -> Rule:
    return Rule(f"{column}_not_blank", F.length(strip_blank(column)) > 0)


def one_of(column: str, allowed: Sequence[str]) -> Rule:
    """The value, in any letter case, is one of ``allowed``."""
    folded = [value.lower() for value in allowed]
    return Rule(f"{column}_one_of", F.lower(F.col(column)).isin(*folded))


def has_prefix(column: str, prefix: str) -> Rule:
    return Rule(f"{column}_has_prefix", F.col(column).startswith(prefix))


def first_failed_rule(rules: Sequence[Rule]) -> Column:
    """Name of the first rule a row breaks, null for a good row."""
    cases = [(~F.coalesce(rule.holds, F.lit(False)), F.lit(rule.name)) for rule in rules]
    return first_match(cases, F.lit(None).cast("string"))


def fold_case(column: ColumnOrName, upper: bool = False) -> Column:
    return F.upper(as_column(column)) if upper else F.lower(as_column(column))


def strip_blank(column: ColumnOrName) -> Column:
    """The text without any kind of white space, no-break spaces included, around it."""
    return F.regexp_replace(as_column(column), f"(?U)^{BLANK}+|{BLANK}+$", "")


def with_trailing_slash(column: ColumnOrName) -> Column:
    text = as_column(column)
    return F.when(text.endswith("/"), text).otherwise(F.concat(text, F.lit("/")))
