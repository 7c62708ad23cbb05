"""Transforms of changes. A transform is a callable DataFrame -> DataFrame, used with df.transform()."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import rfc3339, to_text
from ..model import with_effective_image

Transform = Callable[[DataFrame], DataFrame]


def masked(value: Column, mask: str, keep: int) -> Column:
    """The first `keep` bytes and the mask, or the mask alone for texts no longer than that; null stays.

    A byte cut that would split a character leaves it out.
    """
    raw = value.cast("binary")
    cut = F.substring(raw, 1, keep)
    # at most three bytes of a split character stand at the end
    whole = F.coalesce(*(F.try_validate_utf8(F.substring(raw, 1, max(0, keep - k)).cast("string")) for k in range(4))) if keep else F.lit("")
    return F.when(value.isNull(), F.lit(None)).when(F.octet_length(value) > keep, F.concat(F.coalesce(F.try_validate_utf8(cut.cast("string")), whole), F.lit(mask))).otherwise(F.lit(mask))


def _in_images(df: DataFrame, name: str, change: Callable[[Column, T.DataType], Column], add: bool) -> DataFrame:
    for image in ("before", "after"):
        if image not in df.columns:
            continue
        kind = df.schema[image].dataType
        if isinstance(kind, T.StructType):
            if name in kind.names:
                new = F.col(image).withField(f"`{name}`", change(F.col(f"{image}.`{name}`"), kind[name].dataType))
            elif add:
                new = F.col(image).withField(f"`{name}`", change(F.lit(None).cast("string"), T.StringType()))
            else:
                continue
        elif isinstance(kind, T.MapType):
            rest = F.map_filter(image, lambda k, v: k != name)
            put = F.map_concat(rest, F.create_map(F.lit(name), change(F.col(image)[name], kind.valueType).cast(kind.valueType)))
            new = put if add else F.when(F.map_contains_key(image, name), put).otherwise(F.col(image))
        else:
            raise TypeError("a variant image has to be given a schema before it is changed")
        df = df.withColumn(image, F.when(F.col(image).isNotNull(), new))
    return df


def mask_field(name: str, mask: str = "***", keep: int = 0) -> Transform:
    """Masks a field in both images; absent and null fields stay as they are."""
    return lambda df: _in_images(df, name, lambda v, t: masked(to_text(v, t), mask, keep), add=False)


def add_timestamp(name: str, now: Column | None = None) -> Transform:
    """Puts the time, as RFC 3339 text, into both images that are there."""
    return lambda df: _in_images(df, name, lambda v, t: rfc3339(F.current_timestamp() if now is None else now), add=True)


def no_op(df: DataFrame) -> DataFrame:
    return df


def apply_transforms(df: DataFrame, transforms: list[Transform]) -> DataFrame:
    return reduce(lambda d, f: d.transform(f), transforms, df)


def with_metadata(changes: DataFrame) -> DataFrame:
    """The effective image's fields and the six metadata columns beside them."""
    return with_effective_image(changes).select(
        "image.*", F.col("id").alias("_id"), F.col("timestamp").alias("_timestamp"), F.col("type").alias("_type"), F.col("source").alias("_source"), F.col("database").alias("_database"), F.col("table").alias("_table")
    )


def _sorted_keys(changes: DataFrame, column: str) -> Column:
    """A map's keys in order; all else as it is."""
    kind = changes.schema[column].dataType
    value = F.col(f"`{column}`")
    return (F.map_from_entries(F.array_sort(F.map_entries(value))) if isinstance(kind, T.MapType) else value).alias(column)


def rendered(changes: DataFrame, name: str = "json") -> DataFrame:
    """Each change as one JSON text; keys of maps are sorted, null fields left out."""
    return changes.select(json_text(changes, changes.columns).alias(name))


def json_text(rows: DataFrame, columns: list[str]) -> Column:
    """Some columns of a row as one JSON text, as rendered() has it."""
    return F.to_json(F.struct(*(_sorted_keys(rows, c) for c in columns)))


def parsed(texts: DataFrame, column: str, schema: str, name: str = "change") -> DataFrame:
    """JSON texts read by a schema; one that is no such record gives null and stays beside it."""
    value = F.from_json(F.when(F.try_parse_json(column).isNotNull(), F.col(column)), schema)
    return texts.withColumn(name, value)
