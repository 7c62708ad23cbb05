"""Data-quality scores of rows: completeness, validity, timeliness, consistency, uniqueness."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import parse_time

#: Fields that hold times, the longest valid text, and what each check needs to pass.
TIME_FIELDS = ("created_at", "updated_at", "timestamp", "time", "date")
LONGEST = 10_000
NEEDED = {"completeness": 0.8, "validity": 0.9, "timeliness": 0.8}

Check = Callable[[DataFrame], Column]


def _share(parts: list[Column], empty: float) -> Column:
    return reduce(lambda a, b: a + b, parts).cast("double") / len(parts) if parts else F.lit(empty)


def completeness(df: DataFrame, fields: list[str]) -> Column:
    """Share of fields that are not null."""
    return _share([F.col(f"`{c}`").isNotNull().cast("int") for c in fields], 0.0)


def validity(df: DataFrame, fields: list[str]) -> Column:
    """Share of fields that are valid: texts under 10,000 bytes, and whatever is no text."""
    parts = []
    for c in fields:
        kind = df.schema[c].dataType
        good = F.coalesce(F.octet_length(f"`{c}`") < LONGEST, F.lit(True)) if isinstance(kind, T.StringType) else F.lit(not isinstance(kind, T.BinaryType))
        parts.append(good.cast("int"))
    return _share(parts, 0.0)


def timeliness(df: DataFrame, fields: list[str], asof: Column) -> Column:
    """Share of time fields between a year before and a day after `asof`; 1 without time fields.

    Null and unreadable times count against it.
    """
    parts = []
    for c in fields:
        if c in TIME_FIELDS:
            kind = df.schema[c].dataType
            at = parse_time(F.col(f"`{c}`")) if isinstance(kind, T.StringType) else F.col(f"`{c}`").cast("timestamp")
            good = (at > F.add_months(asof, -12).cast("timestamp")) & (at < asof + F.expr("interval 1 day"))
            parts.append(F.coalesce(good, F.lit(False)).cast("int"))
    return _share(parts, 1.0)


def _invalid(df: DataFrame, fields: list[str]) -> Column:
    """What is wrong with the fields that are not valid, a text for each."""
    found = []
    for c in fields:
        kind = df.schema[c].dataType
        if isinstance(kind, T.StringType):
            found.append(F.when(F.octet_length(f"`{c}`") >= LONGEST, F.lit(f"Field {c}: string too long")))
        elif isinstance(kind, T.BinaryType):
            found.append(F.lit(f"Field {c}: unknown type binary"))
    return F.filter(F.array(*found), lambda x: x.isNotNull()) if found else F.array().cast("array<string>")


def _told(title: str, score: str, of: int, what: str) -> Column:
    """`Title: 66.67% (2/3 what)`."""
    share = F.col(f"_q_{score}")
    return F.format_string(f"{title}: %.2f%% (%d/%d {what})", share * 100, F.round(share * of).cast("int"), F.lit(of))


def check_quality(df: DataFrame, fields: list[str], asof: Column, custom: dict[str, Check] | None = None, present: Column | None = None) -> DataFrame:
    """df with _quality: the five scores and a list of checks {name, passed, score, description}.

    present: where false, there is no image: all scores are 0 and one check,
    data_presence, has failed. Custom checks join the list and change no score.
    """
    scores = {"completeness": completeness(df, fields), "validity": validity(df, fields), "timeliness": timeliness(df, fields, asof)}
    times = sum(c in TIME_FIELDS for c in fields)
    work = df.select("*", *(v.alias(f"_q_{k}") for k, v in scores.items()), _invalid(df, fields).alias("_q_errors"))
    told = {
        "completeness": _told("Completeness", "completeness", len(fields), "fields"),
        "validity": F.concat(_told("Validity", "validity", len(fields), "fields valid"), F.when(F.size("_q_errors").between(1, 3), F.concat(F.lit(", errors: ["), F.array_join("_q_errors", " "), F.lit("]"))).otherwise(F.lit(""))),
        "timeliness": _told("Timeliness", "timeliness", times, "timestamps valid") if times else F.lit("No timestamp fields to check"),
    }
    item = lambda name, passed, score, text: F.struct(F.lit(name).alias("name"), passed.alias("passed"), score.cast("double").alias("score"), text.alias("description"))
    checks = [item(k, F.col(f"_q_{k}") >= need, F.col(f"_q_{k}"), told[k]) for k, need in NEEDED.items()]
    for name, check in (custom or {}).items():
        got = check(df)
        checks.append(item(name, got["passed"], got["score"], got["description"]))
    there = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    missing = F.array(item("data_presence", F.lit(False), F.lit(0.0), F.lit("No data to check")))
    score = lambda c: F.when(there, c).otherwise(F.lit(0.0))
    quality = F.struct(
        *(score(F.col(f"_q_{k}")).alias(k) for k in scores),
        score((F.col("_q_completeness") + F.col("_q_validity")) / 2).alias("consistency"),
        score(F.lit(1.0)).alias("uniqueness"),
        F.when(there, F.array(*checks)).otherwise(missing).alias("checks"),
    )
    return work.withColumn("_quality", quality).select(*df.columns, "_quality")


def uniqueness(df: DataFrame, field: str) -> DataFrame:
    """Real uniqueness of a column over a table: distinct values among those that are not null."""
    return df.agg((F.countDistinct(field) / F.count(field)).alias("uniqueness"))
