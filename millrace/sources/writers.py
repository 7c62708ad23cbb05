"""Sinks: partitioned JSON, CSV and Parquet with codecs, record limits and idempotent rewrites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from ..functions.scalars import rfc3339
from ..operators.transforms import with_metadata
from .config import CODECS, FORMATS, STRATEGIES


def partition_columns(ts: Column, strategy: str) -> dict[str, Column]:
    if strategy not in STRATEGIES:
        strategy = "date"
    if strategy == "none":
        return {}
    date = {"date": F.date_format(ts, "yyyy-MM-dd")}
    return date | {"hour": F.date_format(ts, "HH")} if strategy == "hour" else date


def csv_rows(changes: DataFrame, more: list[str] = ()) -> DataFrame:
    """Seven columns: id, timestamp, type, database, table, after and before as JSON (null: empty); then `more`."""
    image = lambda c: F.when(F.col(c).isNotNull(), F.to_json(c))
    return changes.select("id", rfc3339(F.col("timestamp")).alias("timestamp"), "type", "database", "table", image("after").alias("after"), image("before").alias("before"), *more)


def writer(df: DataFrame, fmt: str, compression: str = "none", max_records: int = 10_000, mode: str = "append", partitions: list[str] = ()) -> DataFrameWriter:
    """A configured writer. max_records bounds each file; overwriting replaces only the partitions written."""
    if fmt not in FORMATS or compression not in CODECS:
        raise ValueError(f"unsupported format or compression: {fmt}, {compression}")
    if compression == "zstd" and fmt != "parquet" or compression == "snappy" and fmt == "csv":
        compression = "gzip"  # the text writers lack these codecs
    out = df.write.mode(mode).format(fmt).option("compression", compression).option("maxRecordsPerFile", max_records).option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        out = out.option("header", False).option("escape", '"')
    return out.partitionBy(*partitions) if partitions else out


def records_for(rows: DataFrame, max_megabytes: float, most: int) -> int:
    """Records of a file that stays near a size in megabytes, by the rows' mean length as JSON; `most` at most."""
    mean = rows.select(F.octet_length(F.to_json(F.struct(*rows.columns))).alias("n")).agg(F.avg("n")).first()[0]
    return max(1, min(most, int(max_megabytes * (1 << 20) / (mean + 1)))) if mean else most


def write_changes(changes: DataFrame, path: str, fmt: str = "json", strategy: str = "date", compression: str = "none", max_records: int = 10_000, ts: Column | None = None, mode: str = "append", max_megabytes: float | None = None) -> None:
    """Changes in files, partitioned by their time; files end at max_records or, about, at max_megabytes before compression."""
    parts = partition_columns(F.col("timestamp") if ts is None else ts, strategy)
    body = changes.withColumns(parts)
    body = csv_rows(body, list(parts)) if fmt == "csv" else body
    if max_megabytes:
        max_records = records_for(body, max_megabytes, max_records)
    writer(body, fmt, compression, max_records, mode, list(parts)).save(path)


def write_tables(changes: DataFrame, path: str, compression: str = "snappy", max_records: int = 1_000_000) -> None:
    """Effective images with their metadata columns as Parquet, a folder for each date, database and table."""
    rows = with_metadata(changes).withColumn("date", F.date_format("_timestamp", "yyyy-MM-dd"))
    writer(rows, "parquet", compression, max_records, "append", ["date", "_database", "_table"]).save(path)


def read_back(spark, path: str, fmt: str, schema: str) -> DataFrame:
    reader = spark.read.schema(schema)
    return (reader.option("header", False).option("escape", '"') if fmt == "csv" else reader).format(fmt).load(path)
