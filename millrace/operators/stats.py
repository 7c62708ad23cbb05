"""Column and table statistics in single aggregation passes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def column_stats(df: DataFrame, columns: list[str], by: list[str] = (), exact: bool = True) -> DataFrame:
    """A row for each column (and group): num_values, null_count, distinct_count, min, max as text, avg of numbers.

    All columns share one pass with partial aggregates; distinct values are estimated
    there, or counted exactly in a pass of each column's own, which reads that column
    only and never multiplies rows.
    """
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"unknown columns: {missing}")
    packed = []
    for c in columns:
        number = df.schema[c].dataType.typeName() in ("integer", "long", "double", "float", "decimal", "short", "byte")
        col = F.col(f"`{c}`")
        packed.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count("*").alias("num_values"),
                F.count_if(col.isNull()).alias("null_count"),
                F.approx_count_distinct(col).alias("distinct_count"),
                F.min(col).cast("string").alias("min"),
                F.max(col).cast("string").alias("max"),
                (F.round(F.avg(col), 6) if number else F.lit(None).cast("double")).alias("avg"),
            ).alias(f"s_{c}")
        )
    one = df.groupBy(*by).agg(*packed)
    out = one.select(*by, F.explode(F.array(*(F.col(f"`s_{c}`") for c in columns))).alias("s")).select(*by, "s.*")
    if not exact:
        return out
    counts = None
    for c in columns:
        own = df.groupBy(*by).agg(F.lit(c).alias("column"), F.countDistinct(F.col(f"`{c}`")).alias("n"))
        counts = own if counts is None else counts.unionAll(own)
    counts = counts.select(*(F.col(k).alias(f"_{k}") for k in by), F.col("column").alias("_column"), "n")
    same = F.col("column") == F.col("_column")
    for k in by:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return out.join(counts, same).select(*by, "column", "num_values", "null_count", F.col("n").alias("distinct_count"), "min", "max", "avg")


def group_stats(df: DataFrame, column: str, group: str) -> DataFrame:
    """Per group of rows: num_values, null_count, min and max of a column, as row groups keep them."""
    return df.groupBy(group).agg(F.count("*").alias("num_values"), F.count_if(F.col(column).isNull()).alias("null_count"), F.min(column).alias("min"), F.max(column).alias("max"))


def rolled_up(groups: DataFrame) -> DataFrame:
    """Statistics of all groups together: sums, the least and the greatest."""
    return groups.agg(F.sum("num_values").alias("num_values"), F.sum("null_count").alias("null_count"), F.min("min").alias("min"), F.max("max").alias("max"))


def latest_entries(entries: DataFrame, key: str = "path", at: str = "created_at") -> DataFrame:
    """The newest entry of each key; a partition added again replaces the one before."""
    order = Window.partitionBy(key).orderBy(F.col(at).desc())
    return entries.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def partition_totals(entries: DataFrame, table: str = "table") -> DataFrame:
    """Files, records and bytes of each table over its latest entries."""
    return latest_entries(entries).groupBy(table).agg(F.sum("file_count").alias("files"), F.sum("record_count").alias("records"), F.sum("size_bytes").alias("bytes"))


def table_counts(changes: DataFrame) -> DataFrame:
    return changes.groupBy("database", "table").agg(F.count("*").alias("rows"))
