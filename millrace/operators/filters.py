"""Filters over changes. A filter is a callable DataFrame -> Column, a predicate whose null counts as false."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import compare_values, to_text, type_of_literal
from ..model import DELETE, Field, image_field

Filter = Callable[[DataFrame], Column]

_ORDER: dict[str, Callable[[Column], Column]] = {">": lambda c: c > 0, ">=": lambda c: c >= 0, "<": lambda c: c < 0, "<=": lambda c: c <= 0}
_SMALLER: dict[str, Callable[[Column, object], Column]] = {"<": lambda v, x: v < x, "<=": lambda v, x: v <= x}


def _plain(field: Field, operator: str, value: object) -> Column | None:
    """The same comparison in operators that a scan can take over, where the types are known to allow it."""
    v = field.value
    if operator in ("=", "==") and isinstance(field.type, T.StringType) and isinstance(value, str) and value != "<nil>":
        return v == value
    if operator in _ORDER and isinstance(field.type, T.NumericType) and isinstance(value, (int, float)) and not isinstance(value, bool):
        nan = F.isnan(v) if isinstance(field.type, (T.DoubleType, T.FloatType)) else None
        if operator == ">":
            return v > value if nan is None else (v > value) & ~nan
        if operator == ">=":
            return v >= value  # NaN is above all here, and equal to all there
        less = v.isNull() | (_SMALLER[operator](v, value))
        return less | nan if operator == "<=" and nan is not None else less
    return None


def column_filter(column: str, operator: str, value: object) -> Filter:
    """Compares a field of a change's effective image with a value.

    A change without the field goes. `=`, `==` and `!=` compare text, a null's text being
    `<nil>`; `>`, `>=`, `<` and `<=` compare as compare_values() does, so nulls come
    first. An operator of another name keeps every change that has the field.
    """

    def predicate(df: DataFrame) -> Column:
        def on(image: str) -> Column:
            cast = "double" if operator in _ORDER and isinstance(value, (int, float)) and not isinstance(value, bool) else "string"
            field = image_field(df.schema, image, column, cast)
            kind, literal = type_of_literal(value), F.lit(value)
            plain = _plain(field, operator, value)
            if plain is not None:
                kept = plain
            elif operator in ("=", "==", "!="):
                own = F.coalesce(to_text(field.value, field.type), F.lit("<nil>"))
                same = own == F.coalesce(to_text(literal, kind), F.lit("<nil>"))
                kept = ~same if operator == "!=" else same
            elif operator in _ORDER:
                kept = _ORDER[operator](compare_values(field.value, literal, field.type, kind))
            else:
                kept = F.lit(True)
            return field.present & kept

        return F.when(F.col("type") == DELETE, on("before")).otherwise(on("after"))

    return predicate


def no_filter(df: DataFrame) -> Column:
    return F.lit(True)


def type_filter(*kinds: str) -> Filter:
    return lambda df: F.coalesce(F.col("type").isin(*kinds), F.lit(False))


def table_filter(include: list[str] = (), exclude: list[str] = ()) -> Filter:
    """By `database.table` or bare `table`: excluded tables go, and all others stay if none is included."""

    def predicate(df: DataFrame) -> Column:
        full = F.concat_ws(".", "database", "table")
        named = lambda names: full.isin(*names) | F.col("table").isin(*names)
        kept = named(include) if include else F.lit(True)
        return F.coalesce(kept & ~named(exclude) if exclude else kept, F.lit(False))

    return predicate


def apply_filters(df: DataFrame, filters: list[Filter]) -> DataFrame:
    """All filters in order; Catalyst merges them into one scan predicate."""
    return reduce(lambda d, f: d.where(f(d)), filters, df)
