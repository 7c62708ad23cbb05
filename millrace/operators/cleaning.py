"""Cleaning rules over rows, folded into one projection."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import ascii_lower, ascii_upper, replace_all, trim_white


@dataclass(frozen=True)
class CleaningRule:
    """field: a column, or `*` for every text column. An unknown operation does nothing."""

    field: str
    operation: str
    params: dict[str, str] = field(default_factory=dict)


DEFAULT_RULES = [CleaningRule("*", "trim"), CleaningRule("email", "lowercase")]

_ON_TEXT: dict[str, Callable[[Column], Column]] = {"trim": trim_white, "lowercase": ascii_lower, "uppercase": ascii_upper}


def clean(df: DataFrame, rules: list[CleaningRule] = DEFAULT_RULES) -> DataFrame:
    """Rules in order. Only text columns change; `replace` takes a named column and both params."""
    now: dict[str, Column] = {}
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    for rule in rules:
        names = text if rule.field == "*" else [rule.field] if rule.field in text else []
        for name in names:
            value = now.get(name, F.col(f"`{name}`"))
            if rule.operation in _ON_TEXT:
                now[name] = _ON_TEXT[rule.operation](value)
            elif rule.operation == "replace" and rule.field != "*" and {"old", "new"} <= rule.params.keys():
                now[name] = replace_all(value, rule.params["old"], rule.params["new"])
    return df.select(*(now[c].alias(c) if c in now else F.col(f"`{c}`") for c in df.columns))
