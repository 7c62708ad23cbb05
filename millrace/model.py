"""The change event and the records of the layers, as Spark schemas.

A change carries two images of a row. An image is a struct (a registered table), a
map, or a variant (no schema known); image_field() reads all three alike and tells a
field that is absent from one that is null.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INSERT, UPDATE, DELETE = "INSERT", "UPDATE", "DELETE"

CHANGE_SCHEMA = "id string, timestamp timestamp, source string, type string, database string, table string, schema map<string, struct<type: string, nullable: boolean>>, before variant, after variant, binlog_file string, binlog_pos bigint"
DEAD_LETTER_SCHEMA = "original_change struct<id: string, timestamp: timestamp, source: string, type: string, database: string, table: string, before: string, after: string, binlog_file: string, binlog_pos: bigint>, failure_reason string, timestamp timestamp, retry_count int"


@dataclass(frozen=True)
class Field:
    """A field of an image: whether it is there, its value and the value's type."""

    present: Column
    value: Column
    type: T.DataType


def _type_of(schema: T.StructType, path: str) -> T.DataType:
    kind: T.DataType = schema
    for name in path.split("."):
        kind = kind[name].dataType
    return kind


def image_field(schema: T.StructType, image: str, name: str, cast: str = "string") -> Field:
    """The field `name` of the image column; a variant's values come as `cast`."""
    kind = _type_of(schema, image)
    if isinstance(kind, T.StructType):
        if name not in kind.names:
            return Field(F.lit(False), F.lit(None).cast("string"), T.StringType())
        return Field(F.col(image).isNotNull(), F.col(f"{image}.`{name}`"), kind[name].dataType)
    if isinstance(kind, T.MapType):
        return Field(F.coalesce(F.map_contains_key(image, name), F.lit(False)), F.col(image)[name], kind.valueType)
    fields = F.col(image).cast("map<string,variant>")
    return Field(F.coalesce(F.map_contains_key(fields, name), F.lit(False)), F.try_variant_get(F.col(image), f"$.{name}", cast), T._parse_datatype_string(cast))


def effective(before: Column, after: Column, kind: Column) -> Column:
    """What a change is about: the row before a DELETE, after all others."""
    return F.when(kind == DELETE, before).otherwise(after)


def with_effective_image(changes: DataFrame, name: str = "image") -> DataFrame:
    return changes.withColumn(name, effective(F.col("before"), F.col("after"), F.col("type")))


def to_changes(rows: DataFrame, *, id: Column, ts: Column, kind: Column, database: str, table: str, columns: list[str], source: str = "spark://rows") -> DataFrame:
    """Rows of a table as change events, their images structs of `columns`; a DELETE has its row in `before`."""
    image = F.struct(*columns)
    return rows.select(
        id.cast("string").alias("id"),
        ts.cast("timestamp").alias("timestamp"),
        F.lit(source).alias("source"),
        kind.alias("type"),
        F.lit(database).alias("database"),
        F.lit(table).alias("table"),
        F.when(kind != INSERT, image).alias("before"),
        F.when(kind != DELETE, image).alias("after"),
    )
