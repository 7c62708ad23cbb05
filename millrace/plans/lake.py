"""The layers on disk: bronze, silver and gold tables under one root, and the runs between them.

Each write replaces what the same batch, or the same partitions, wrote before, so a run
that is repeated changes nothing. Rows that cannot be read go to a table of their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import grain_columns
from ..operators import cleaning, validation
from ..sources import paths
from ..sources.writers import writer
from . import layers
from .catalog import Catalog

Cleaner = Callable[[DataFrame], DataFrame]
Validator = Callable[[DataFrame], DataFrame]

BRONZE_SCHEMA = "_id string, _ingested_at timestamp, _source string, _raw_data struct<type: string, database: string, table: string, before: string, after: string>, _binlog struct<file: string, pos: bigint>, _schema_version int"
PARTITIONS = "date string, database string, table string, batch string"
#: What gold holds unless other aggregates are given.
METRICS = {"record_count": F.count, "avg_quality": lambda c: F.round(F.avg(c), 6)}


class Lake:
    """Layers under a root folder; formats, codecs and partitions are those of layers.LAYERS."""

    def __init__(self, spark: SparkSession, root: str, catalog: Catalog | None = None):
        self.spark, self.root, self.catalog = spark, root.rstrip("/"), catalog
        #: row counts and mean quality of the last run
        self.metrics: dict[str, object] = {}

    def path(self, layer: str) -> str:
        return f"{self.root}/{layer}"

    def _write(self, df: DataFrame, layer: str, partitions: list[str]) -> None:
        kind = layers.LAYERS[layer]
        writer(df, kind["format"], kind["compression"], 0, "overwrite", partitions).save(self.path(layer))

    # --- bronze ---

    def write_bronze(self, changes: DataFrame, batch: str, on: Column | None = None) -> None:
        """Changes as JSON records under date, database, table and batch; writing a batch again replaces it.

        Images are kept as JSON text, so tables of any shape share the layer. The catalog,
        if there is one, gets an entry for each partition.
        """
        image = lambda c: F.when(F.col(c).isNotNull(), F.to_json(c))
        optional = {n: F.col(n) if n in changes.columns else F.lit(None).cast(t) for n, t in (("binlog_file", "string"), ("binlog_pos", "bigint"))}
        rows = changes.select(
            F.col("id").alias("_id"),
            F.col("timestamp").alias("_ingested_at"),
            F.col("source").alias("_source"),
            F.struct("type", "database", "table", image("before").alias("before"), image("after").alias("after")).alias("_raw_data"),
            F.when(optional["binlog_file"].isNotNull(), F.struct(optional["binlog_file"].alias("file"), optional["binlog_pos"].alias("pos"))).alias("_binlog"),
            F.lit(1).alias("_schema_version"),
            F.date_format(F.current_timestamp() if on is None else on, "yyyy-MM-dd").alias("date"),
            F.col("database"),
            F.col("table"),
            F.lit(batch).alias("batch"),
        )
        self._write(rows, "bronze", ["date", "database", "table", "batch"])
        if self.catalog is not None:
            self._catalogue(self.read_bronze().where(F.col("batch") == batch), ["date", "database", "table"], "bronze", batch)

    def _catalogue(self, rows: DataFrame, keys: list[str], layer: str, batch: str) -> None:
        files = rows.groupBy(*keys).agg(F.count("*").alias("records"), F.countDistinct("_file").alias("files"), F.sum("_bytes").alias("size"))
        for r in files.collect():  # a row for each partition that the batch has
            name = f"{r.database}.{r.table}"
            if name not in self.catalog.names():
                self.catalog.register(r.database, r.table, T.StructType())
            self.catalog.add_partition(name, f"{layer}/date={r.date}/batch={batch}", {"date": r.date}, r.files, r.records, r.size)

    def read_bronze(self) -> DataFrame:
        """Bronze records with their partitions; text that is no record comes in _corrupt_record, a missing layer is empty."""
        schema = f"{BRONZE_SCHEMA}, _corrupt_record string, {PARTITIONS}"
        if not paths.children(self.spark, self.path("bronze")):
            return self.spark.createDataFrame([], schema).withColumns({"_file": F.lit(""), "_bytes": F.lit(0).cast("bigint")})
        rows = self.spark.read.schema(schema).option("mode", "PERMISSIVE").json(self.path("bronze"))
        return rows.withColumns({"_file": F.col("_metadata.file_path"), "_bytes": F.octet_length(F.to_json("_raw_data")).cast("bigint")})

    # --- silver ---

    def bronze_to_silver(self, schema: T.StructType | str, table: str | None = None, cleaner: Cleaner | list = cleaning.DEFAULT_RULES, validator: Validator | list = validation.DEFAULT_RULES, processed_at: Column | None = None, strict_datetime: bool = False) -> DataFrame:
        """Cleans, validates, scores and writes the images of bronze records, read by `schema`; returns the silver rows.

        Records that are not readable, and images that do not fit the schema, go to
        rejected/ with their text. cleaner and validator are rule lists or functions
        from DataFrame to DataFrame (a validator adds _validation and _quality_score).
        metrics: read, rejected, written and mean quality, counted while writing.
        """
        wanted = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        flat = self.read_bronze().where(F.col("table") == table) if table else self.read_bronze()
        seen = Observation()
        flat = flat.observe(seen, F.count("*").alias("read"))
        text = F.when(F.col("_raw_data.type") == "DELETE", F.col("_raw_data.before")).otherwise(F.col("_raw_data.after"))
        rows = flat.withColumn("_text", text).withColumn("_image", F.from_json("_text", wanted, {"mode": "PERMISSIVE"}))
        names = [f.name for f in wanted]
        fits = F.col("_corrupt_record").isNull() & F.col("_text").isNotNull() & F.try_parse_json("_text").isNotNull()
        bad = rows.where(~F.coalesce(fits, F.lit(False))).select(F.coalesce("_corrupt_record", "_text").alias("text"), "_id", "date", "batch")
        writer(bad, "json", "none", 0, "overwrite").save(self.path("rejected"))
        meta = {"_id": "_id", "_ingested_at": "_ingested_at", "_source": "_source", "database": "_raw_data.database", "table": "_raw_data.table", "type": "_raw_data.type", "date": "date"}
        good = rows.where(F.coalesce(fits, F.lit(False))).select(*(F.col(v).alias(f"__{k}") for k, v in meta.items()), *(F.col(f"_image.`{n}`").alias(n) for n in names))
        cleaned = cleaner(good) if callable(cleaner) else cleaning.clean(good, cleaner)
        done = validator(cleaned) if callable(validator) else validation.validate(cleaned, validator, strict_datetime)
        silver = done.select(*(F.col(f"__{k}").alias(k) for k in meta), (F.current_timestamp() if processed_at is None else processed_at).alias("_processed_at"), F.struct(*(F.col(f"`{n}`") for n in names)).alias("_cleaned_data"), "_quality_score", "_validation")
        told = Observation()
        self.write_silver(silver.observe(told, F.count("*").alias("written"), F.avg("_quality_score").alias("avg_quality")))
        self.metrics = {"read": seen.get["read"], **told.get, "rejected": self.spark.read.schema("text string").json(self.path("rejected")).count()}
        return self.read_silver(silver.schema)

    def write_silver(self, silver: DataFrame) -> None:
        self._write(silver, "silver", layers.LAYERS["silver"]["partition_by"])

    def read_silver(self, schema: T.StructType | None = None) -> DataFrame:
        """All silver rows; where none were written yet, none of the schema given."""
        if not self._has("silver"):
            return self.spark.createDataFrame([], schema or "database string, table string")
        return self.spark.read.parquet(self.path("silver"))

    def _has(self, layer: str) -> bool:
        return any(n.startswith("date=") for n in paths.children(self.spark, self.path(layer)))

    # --- gold ---

    def silver_to_gold(self, grain: str, time: str = "_ingested_at", aggregates: dict[str, Column] | None = None, valid_only: bool = False) -> DataFrame | None:
        """Aggregates silver by database, table and the grain's dimensions, and writes it; None, and nothing written, without rows.

        aggregates: metric name -> aggregate Column; a metric named like a dimension takes its place.
        """
        if not self._has("silver"):
            return None
        silver = self.read_silver()
        silver = silver.where("_validation.valid") if valid_only else silver
        if silver.isEmpty():
            return None
        dims = grain_columns(F.col(time), grain)
        wanted = aggregates or {k: f("_quality_score") for k, f in METRICS.items()}
        keyed = silver.withColumns({f"__{k}": c for k, c in dims.items()})
        out = keyed.groupBy("database", "table", *(f"__{k}" for k in dims)).agg(*(c.alias(f"_m_{k}") for k, c in wanted.items()))
        flat = out.select("database", "table", *(F.col(f"__{k}").alias(k) for k in dims if k not in wanted), *(F.col(f"_m_{k}").alias(k) for k in wanted))
        self.write_gold(flat, grain)
        return self.read_gold(grain)

    def write_gold(self, gold: DataFrame, grain: str, on: Column | None = None) -> None:
        """Under the run's date, or the rows' own, and grain."""
        date = "date" if "date" in gold.columns else None
        day = F.col(date) if date else F.date_format(F.current_timestamp() if on is None else on, "yyyy-MM-dd")
        self._write(gold.withColumns({"date": day, "grain": F.lit(grain)}), "gold", layers.LAYERS["gold"]["partition_by"])

    def read_gold(self, grain: str) -> DataFrame:
        """A grain's rows with their own columns only; grains differ in their dimensions."""
        folders = [f"{self.path('gold')}/{d}/grain={grain}" for d in paths.children(self.spark, self.path("gold")) if d.startswith("date=")]
        found = [p for p in folders if paths.children(self.spark, p)]
        return self.spark.read.option("basePath", self.path("gold")).option("mergeSchema", "true").parquet(*found).drop("grain")
