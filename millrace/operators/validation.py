"""Validation rules and schema validation, as expressions that give lists of messages."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import compare_values, has_type, quality_score, type_of_literal


@dataclass(frozen=True)
class ValidationRule:
    """rule: required, type (params type), range (min, max), regex (pattern) or enum (values); others always pass."""

    field: str
    rule: str
    params: dict[str, object] = field(default_factory=dict)


DEFAULT_RULES = [ValidationRule("id", "required"), ValidationRule("created_at", "type", {"type": "datetime"})]


def _messages(df: DataFrame, rule: ValidationRule, strict_datetime: bool) -> list[Column]:
    name, p = rule.field, rule.params
    if name not in df.columns:
        return [F.lit(f"Field '{name}' is required")] if rule.rule == "required" else []
    value, kind = F.col(f"`{name}`"), df.schema[name].dataType
    there = value.isNotNull()
    if rule.rule == "required":
        empty = value == "" if isinstance(kind, T.StringType) else F.lit(False)
        return [F.when(value.isNull() | empty, F.lit(f"Field '{name}' is required"))]
    if rule.rule == "type":
        fits = has_type(value, kind, str(p["type"]), strict_datetime)
        return [F.when(there & ~fits, F.lit(f"Field '{name}' should be of type {p['type']}"))]
    if rule.rule == "range":
        out = []
        for key, sign, word in (("min", -1, "below minimum"), ("max", 1, "above maximum")):
            if key in p:
                order = compare_values(value, F.lit(p[key]), kind, type_of_literal(p[key]))
                out.append(F.when(there & (order == sign), F.lit(f"Field '{name}' is {word}")))
        return out
    if rule.rule == "regex":
        return [F.when(there & ~value.cast("string").rlike(str(p["pattern"])), F.lit(f"Field '{name}' does not match"))]
    if rule.rule == "enum":
        return [F.when(there & ~value.isin(*p["values"]), F.lit(f"Field '{name}' is not allowed"))]
    return []


def errors(df: DataFrame, rules: list[ValidationRule] = DEFAULT_RULES, strict_datetime: bool = False) -> Column:
    """Messages of the rules that a row breaks, in their order."""
    found = [m for rule in rules for m in _messages(df, rule, strict_datetime)]
    none = F.array().cast("array<string>")
    return F.filter(F.array(*found), lambda m: m.isNotNull()) if found else none


def validate(df: DataFrame, rules: list[ValidationRule] = DEFAULT_RULES, strict_datetime: bool = False) -> DataFrame:
    """df with _validation{valid, errors, warnings} and _quality_score."""
    found = errors(df, rules, strict_datetime)
    return df.withColumn("_errors", found).select(
        *df.columns,
        F.struct((F.size("_errors") == 0).alias("valid"), F.col("_errors").alias("errors"), F.array().cast("array<string>").alias("warnings")).alias("_validation"),
        quality_score(F.col("_errors")).alias("_quality_score"),
    )


def validate_schema(df: DataFrame, schema: T.StructType | None) -> DataFrame:
    """df with _schema_check{valid, errors, warnings}: required fields, unknown fields and types against a schema."""
    if schema is None:
        check = F.struct(F.lit(True).alias("valid"), F.array().cast("array<string>").alias("errors"), F.array(F.lit("No schema defined")).alias("warnings"))
        return df.withColumn("_schema_check", check)
    wrong, odd = [], [F.lit(f"Unknown field: {c}") for c in df.columns if c not in schema.names]
    for f in schema:
        if f.name not in df.columns:
            if not f.nullable:
                wrong.append(F.lit(f"Required field missing: {f.name}"))
            continue
        value = F.col(f"`{f.name}`")
        if not f.nullable:
            wrong.append(F.when(value.isNull(), F.lit(f"Required field missing: {f.name}")))
        fits = has_type(value, df.schema[f.name].dataType, {"int": "int", "bigint": "int"}.get(f.dataType.simpleString(), f.dataType.simpleString()))
        odd.append(F.when(value.isNotNull() & ~fits, F.lit(f"Type mismatch: {f.name}")))
    some = lambda xs: F.filter(F.array(*xs), lambda m: m.isNotNull()) if xs else F.array().cast("array<string>")
    return df.withColumn("_schema_check", F.struct((F.size(some(wrong)) == 0).alias("valid"), some(wrong).alias("errors"), some(odd).alias("warnings")))
