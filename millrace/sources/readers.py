"""Sources of changes and rows, by name, and what turns raw rows into images."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import CHANGE_SCHEMA

Reader = Callable[..., DataFrame]


def read_changes(spark: SparkSession, path: str, fmt: str = "json", schema: str = CHANGE_SCHEMA) -> DataFrame:
    """Change events in files. Lines that do not parse come with nulls and their text in _corrupt_record."""
    reader = spark.read.schema(f"{schema}, _corrupt_record string" if fmt == "json" else schema)
    return reader.option("mode", "PERMISSIVE").format(fmt).load(path)


def stream_changes(spark: SparkSession, path: str, fmt: str = "json", schema: str = CHANGE_SCHEMA, max_files: int | None = None) -> DataFrame:
    """The same as a stream; max_files bounds each batch, and nothing is dropped. It resumes from its query's checkpoint."""
    reader = spark.readStream.schema(schema).format(fmt)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).load(path)


def read_kafka(spark: SparkSession, brokers: str, topics: str, stream: bool = True) -> DataFrame:
    """Needs Spark's Kafka connector on the class path."""
    reader = (spark.readStream if stream else spark.read).format("kafka").option("kafka.bootstrap.servers", brokers).option("subscribe", topics)
    return reader.load().selectExpr("cast(key as string) key", "cast(value as string) value", "topic", "partition", "offset", "timestamp")


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A table's snapshot; partitionColumn, bounds and numPartitions split the read."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def read_rest(spark: SparkSession, base_url: str, endpoints: list[str], headers: dict[str, str] | None = None) -> DataFrame:
    """JSON documents of the endpoints, fetched on the executors: endpoint, body."""

    def fetch(batches):
        import urllib.request

        import pyarrow as pa

        for batch in batches:
            bodies = []
            for name in batch.column(0).to_pylist():
                with urllib.request.urlopen(urllib.request.Request(base_url.rstrip("/") + name, headers=headers or {}), timeout=60) as answer:
                    bodies.append(answer.read().decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bodies, pa.string())], ["endpoint", "body"])

    return spark.createDataFrame([(e,) for e in endpoints], "endpoint string").repartition(len(endpoints)).mapInArrow(fetch, "endpoint string, body string")


READERS: dict[str, Reader] = {"file": read_changes, "mysql": read_jdbc, "kafka": read_kafka, "postgresql": read_jdbc, "rest": read_rest}


def reader_for(kind: str) -> Reader:
    if kind not in READERS:
        raise ValueError(f"unsupported source type: {kind}")
    return READERS[kind]


def normalised(value: Column, kind: T.DataType) -> Column:
    """Bytes as text; all else as it is."""
    return value.cast("string") if isinstance(kind, T.BinaryType) else value


def rows_to_map(values: Column, names: list[str] | None = None) -> Column:
    """An array of values as a map: by position to names, or col_0, col_1, ... without any.

    Values beyond the names are left out, names without a value are absent.
    """
    if names is None:
        keys = F.transform(values, lambda v, i: F.concat(F.lit("col_"), i.cast("string")))
        return F.map_from_arrays(keys, values)
    n = F.least(F.size(values), F.lit(len(names)))
    return F.map_from_arrays(F.slice(F.array(*map(F.lit, names)), F.lit(1), n), F.slice(values, F.lit(1), n))


def paired_updates(rows: DataFrame, event: str, position: str, image: str) -> DataFrame:
    """Rows of UPDATE events, before and after in turn (even and odd positions), as one change each."""
    order = Window.partitionBy(event).orderBy(position)
    return rows.withColumn("before", F.lag(image).over(order)).where(F.col(position) % 2 == 1).select(event, (F.col(position) / 2).cast("bigint").alias("pair"), "before", F.col(image).alias("after"))


def table_info(df: DataFrame) -> list[tuple[str, str, bool]]:
    """Name, type and nullability of each column."""
    return [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema]


class TableInfos:
    """Metadata of tables by database and name, looked up once and kept until a DDL statement changes a table."""

    def __init__(self, lookup: Callable[[str, str], tuple[T.StructType, list[str]]]):
        self.lookup, self.known = lookup, {}

    def get(self, database: str, table: str) -> dict:
        """columns (name, type, nullable) and keys: position of a key column -> its name."""
        name = f"{database}.{table}"
        if name not in self.known:
            schema, keys = self.lookup(database, table)
            columns = [(f.name, f.dataType.simpleString(), f.nullable) for f in schema]
            self.known[name] = {"columns": columns, "keys": {schema.names.index(k): k for k in keys}}
        return self.known[name]

    def on_statement(self, statement: str, spark: SparkSession | None = None, tables: list[str] = ()) -> bool:
        """Forgets every table on CREATE TABLE and ALTER TABLE, in any case, and refreshes Spark's own cache of `tables`."""
        if not re.search(r"(create|alter)\s+table", statement, re.IGNORECASE):
            return False
        self.known.clear()
        for t in tables if spark else ():
            spark.catalog.refreshTable(t)
        return True


def catalog_lookup(spark: SparkSession, keys: dict[str, list[str]] | None = None) -> Callable[[str, str], tuple[T.StructType, list[str]]]:
    """A lookup in the session's catalog; keys: `database.table` -> key columns, which the catalog does not hold."""
    return lambda database, table: (spark.table(f"`{database}`.`{table}`").schema, (keys or {}).get(f"{database}.{table}", []))


def page(df: DataFrame, order: list[str], offset: int, count: int) -> DataFrame:
    """`count` rows from `offset` on, in a total order; only offset + count rows of each task leave it."""
    return df.orderBy(*order).offset(offset).limit(count)


def replay_dead_letters(letters: DataFrame) -> DataFrame:
    """The changes that dead letters hold."""
    return letters.where("original_change is not null").select("original_change.*")
