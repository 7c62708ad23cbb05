"""Bronze, silver and gold: raw capture, cleaned and scored rows, aggregates by time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import grain_columns
from ..model import with_effective_image
from ..operators import cleaning, validation
from ..sources import paths

#: Format, compression, partitions and days kept of each layer.
LAYERS = {
    "bronze": {"format": "json", "compression": "none", "partition_by": ["date"], "retention_days": 30},
    "silver": {"format": "parquet", "compression": "zstd", "partition_by": ["date", "database"], "retention_days": 90},
    "gold": {"format": "parquet", "compression": "zstd", "partition_by": ["date", "grain"], "retention_days": 365},
}


def to_bronze(changes: DataFrame) -> DataFrame:
    """Changes as they came, under their own names."""
    return changes.select(
        F.col("id").alias("_id"), F.col("timestamp").alias("_ingested_at"), F.col("source").alias("_source"), F.struct("type", "database", "table", "before", "after").alias("_raw_data"), F.lit(1).alias("_schema_version")
    )


def payload(bronze: DataFrame) -> DataFrame:
    """Each record's effective image; records without one go."""
    flat = bronze.select("_id", "_ingested_at", "_source", "_raw_data.*")
    return with_effective_image(flat, "_image").where("_image is not null").drop("before", "after")


def to_silver(bronze: DataFrame, clean_rules: list = cleaning.DEFAULT_RULES, rules: list = validation.DEFAULT_RULES, processed_at: Column | None = None, strict_datetime: bool = False) -> DataFrame:
    """Cleaned images with their validation and score, in one projection."""
    rows = payload(bronze)
    names = rows.schema["_image"].dataType.names
    meta = ["_id", "_ingested_at", "_source", "database", "table", "type"]
    flat = rows.select(*(F.col(m).alias(f"__{m}") for m in meta), *(F.col(f"_image.`{n}`").alias(n) for n in names))
    done = validation.validate(cleaning.clean(flat, [r for r in clean_rules]), rules, strict_datetime)
    return done.select(*(F.col(f"__{m}").alias(m) for m in meta), (F.current_timestamp() if processed_at is None else processed_at).alias("_processed_at"), F.struct(*(F.col(f"`{n}`") for n in names)).alias("_cleaned_data"), "_quality_score", "_validation")


def to_gold(silver: DataFrame, grain: str, time: Column) -> DataFrame:
    """record_count and avg_quality for each database, table and dimension of the grain, by partial aggregates."""
    dims = grain_columns(time, grain)
    keyed = silver.select("database", "table", "_quality_score", *(c.alias(k) for k, c in dims.items()))
    return keyed.groupBy("database", "table", *dims).agg(F.count("*").alias("record_count"), F.round(F.avg("_quality_score"), 6).alias("avg_quality")).withColumn("grain", F.lit(grain))


def expired(dates: DataFrame, layer: str, asof: Column, column: str = "date") -> DataFrame:
    """Partition dates strictly older than the layer keeps them; names that are no dates never are."""
    day = F.try_to_timestamp(F.col(column), F.lit("yyyy-MM-dd")).cast("date")
    return dates.where(F.coalesce(day < F.date_sub(asof.cast("date"), LAYERS[layer]["retention_days"]), F.lit(False)))


def clean_expired(spark: SparkSession, root: str, layer: str, asof: str) -> list[str]:
    """Deletes a layer's expired date folders and returns their names."""
    names = paths.children(spark, f"{root}/{layer}")
    frame = spark.createDataFrame([(n, n.removeprefix("date=")) for n in names], "name string, date string")
    gone = [r.name for r in expired(frame, layer, F.lit(asof)).orderBy("name").collect()]
    for name in gone:
        paths.delete(spark, f"{root}/{layer}/{name}")
    return gone


def layer_totals(spark: SparkSession, root: str) -> DataFrame:
    """Files and bytes under each layer's folder, from file metadata alone."""
    out = None
    for layer in LAYERS:
        if not paths.children(spark, f"{root}/{layer}"):
            continue
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{root}/{layer}").select("path", "length")
        one = files.agg(F.lit(layer).alias("layer"), F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
        out = one if out is None else out.unionAll(one)
    return out if out is not None else spark.createDataFrame([], "layer string, files bigint, bytes bigint")
