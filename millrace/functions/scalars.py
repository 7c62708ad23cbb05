"""Scalar functions with the change model's own semantics, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Numbers as the model reads them from text: no blanks, no type suffixes.
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Layouts of times in text, in the order in which they are tried.
TIME_LAYOUTS = ("yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")


def type_of_literal(value: object) -> T.DataType:
    return T.BooleanType() if isinstance(value, bool) else T.LongType() if isinstance(value, int) else T.DoubleType() if isinstance(value, float) else T.NullType() if value is None else T.StringType()


def to_number(value: Column, kind: T.DataType) -> Column:
    """value as a double where it is a number or a number's text; null for all else, booleans too."""
    if isinstance(kind, T.NumericType):
        return value.cast("double")
    if isinstance(kind, (T.StringType, T.VarcharType, T.CharType)):
        return F.when(value.rlike(NUMBER), value.try_cast("double"))
    return F.lit(None).cast("double")


def to_text(value: Column, kind: T.DataType) -> Column:
    """value as text; whole doubles have no fraction."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        whole = (value == F.floor(value)) & (F.abs(value) < 1e21)
        return F.when(whole, value.cast("decimal(38,0)").cast("string")).otherwise(value.cast("string"))
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(value)
    return value.cast("string")


def compare_values(a: Column, b: Column, a_type: T.DataType, b_type: T.DataType) -> Column:
    """-1, 0 or 1: nulls first and equal to each other; numbers, also in text, by value; false before true; else bytes of the text.

    NaN equals every number.
    """
    x, y = to_number(a, a_type), to_number(b, b_type)
    by_value = F.when(F.isnan(x) | F.isnan(y), 0).when(x < y, -1).when(x > y, 1).otherwise(0)
    if isinstance(a_type, T.BooleanType) and isinstance(b_type, T.BooleanType):
        rest = F.when(a == b, 0).when(b, -1).otherwise(1)
    else:
        s, t = to_text(a, a_type), to_text(b, b_type)
        rest = F.when(s < t, -1).when(s > t, 1).otherwise(0)
    return F.when(a.isNull() & b.isNull(), 0).when(a.isNull(), -1).when(b.isNull(), 1).when(x.isNotNull() & y.isNotNull(), by_value).otherwise(rest)


def trim_white(s: Column) -> Column:
    """Without blanks, tabs and line ends on either side."""
    return F.btrim(s, F.lit(" \t\n\r"))


def ascii_lower(s: Column) -> Column:
    return F.translate(s, _UPPER, _LOWER)


def ascii_upper(s: Column) -> Column:
    return F.translate(s, _LOWER, _UPPER)


def replace_all(s: Column, old: str, new: str) -> Column:
    """Left to right, without overlaps; an empty `old` changes nothing."""
    return F.replace(s, F.lit(old), F.lit(new)) if old else s


def parse_time(s: Column) -> Column:
    """The first layout that fits; null if none does."""
    return F.coalesce(*(F.try_to_timestamp(s, F.lit(layout)) for layout in TIME_LAYOUTS))


def rfc3339(ts: Column) -> Column:
    """UTC, to the second; the session's time zone is UTC."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def whole_prefix(s: Column) -> Column:
    """The whole number that a text begins with."""
    return F.regexp_extract(s, r"^\s*([+-]?\d+)", 1).try_cast("bigint")


def convert_value(value: Column, kind: T.DataType, to: str) -> Column:
    """value as boolean, int32, int64, float, double or byte_array; null where it cannot be.

    Text becomes a number by its prefix and true if it is `true` or `1`; numbers are
    true unless zero; fractions are cut off.
    """
    text = isinstance(kind, T.StringType)
    if to == "boolean":
        return value.isin("true", "1") if text else value if isinstance(kind, T.BooleanType) else value.cast("double") != 0
    if to in ("int32", "int64"):
        spark_type = "int" if to == "int32" else "bigint"
        if text:
            return whole_prefix(value).try_cast(spark_type)
        return F.when(value, 1).otherwise(0).cast(spark_type) if isinstance(kind, T.BooleanType) else value.try_cast(spark_type)
    if to in ("float", "double"):
        if text:
            return F.regexp_extract(value, r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)", 1).try_cast(to)
        return value.try_cast(to)
    if to == "byte_array":
        return rfc3339(value) if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else to_text(value, kind)
    raise ValueError(f"unknown type {to}")


#: The column model's names of types.
TYPE_NAMES = {"boolean": "BOOLEAN", "int": "INT32", "bigint": "INT64", "float": "FLOAT", "double": "DOUBLE"}


def infer_type(kind: T.DataType) -> str:
    """The column model's name for a Spark type; whatever is no number or boolean is bytes."""
    return TYPE_NAMES.get(kind.simpleString(), "BYTE_ARRAY")


def has_type(value: Column, kind: T.DataType, wanted: str, strict_datetime: bool = False) -> Column:
    """Whether a non-null value is of the wanted type; unknown names hold for all.

    Times in text count as datetime unless strict.
    """
    wanted = wanted.lower()
    number, text = isinstance(kind, T.NumericType), isinstance(kind, T.StringType)
    whole = isinstance(kind, T.IntegralType)
    if wanted in ("string", "varchar", "text"):
        return F.lit(text)
    if wanted in ("int", "integer", "bigint"):
        return F.lit(whole)
    if wanted in ("float", "double", "decimal"):
        return F.lit(number and not whole)
    if wanted in ("bool", "boolean"):
        return F.lit(isinstance(kind, T.BooleanType))
    if wanted in ("datetime", "timestamp", "date"):
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            return F.lit(True)
        return parse_time(value).isNotNull() if text and not strict_datetime else F.lit(False)
    return F.lit(True)


def new_id() -> Column:
    """A random id, another in each row and run."""
    return F.uuid()


def stable_id(*parts: Column) -> Column:
    """An id that depends on the parts alone, so that a task that runs again gives the same; null parts differ from empty ones."""
    marked = [F.when(p.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.replace(p.cast("string"), F.lit("|"), F.lit("||")))) for p in parts]
    return F.sha2(F.concat_ws("|:", *marked), 256)


def quality_score(errors: Column) -> Column:
    """1 without errors, a tenth less for each, never under 0."""
    return F.greatest(F.lit(0.0), F.lit(1.0) - F.lit(0.1) * F.size(errors))


def backoff_ms(attempt: Column, initial: int = 100, most: int = 10_000) -> Column:
    """Delay before a retry, without its jitter."""
    return F.least(F.lit(float(most)), F.lit(float(initial)) * F.pow(F.lit(2.0), attempt)).cast("bigint")


def grain_columns(ts: Column, grain: str) -> dict[str, Column]:
    """Dimensions of a time grain. A week goes with the calendar year, as in the model."""
    if grain == "hourly":
        return {"hour": F.hour(ts), "date": F.date_format(ts, "yyyy-MM-dd")}
    if grain == "daily":
        return {"date": F.date_format(ts, "yyyy-MM-dd")}
    if grain == "weekly":
        return {"week": F.weekofyear(ts), "year": F.year(ts)}
    if grain == "monthly":
        return {"month": F.month(ts), "year": F.year(ts)}
    return {}
