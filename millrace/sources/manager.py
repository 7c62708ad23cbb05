"""One entry point for sinks: changes by format, and tables with registry and catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.transforms import with_metadata
from ..plans.catalog import Catalog
from ..plans.registry import Registry
from . import paths, writers


class StorageManager:
    """Writes batches of changes by the settings of storage.local.

    JSON and CSV keep the change; Parquet keeps the row images of one table at a time.
    A batch has an id: files of a batch lie in a folder of their own and writing the
    batch again replaces them. Each write closes its files; nothing stays open.
    """

    def __init__(self, spark: SparkSession, root: str, settings: dict, registry: Registry | None = None, catalog: Catalog | None = None, compatibility: str = "BACKWARD"):
        if settings["file_format"] not in writers.FORMATS:
            raise ValueError(f"unsupported file format: {settings['file_format']}")
        self.spark, self.root, self.settings, self.compatibility = spark, root.rstrip("/"), settings, compatibility
        self.registry = registry if registry is not None else Registry(spark, f"{root}/_registry")
        self.catalog = catalog if catalog is not None else Catalog(spark, root)

    def write(self, changes: DataFrame, batch: str) -> None:
        s = self.settings
        if s["file_format"] == "parquet":
            for r in changes.select("database", "table").distinct().collect():  # a row for each table of the batch
                self.write_table(changes.where((F.col("database") == r.database) & (F.col("table") == r.table)), r.database, r.table, batch)
            return
        path = f"{self.root}/{s['file_format']}/batch={batch}"
        writers.write_changes(changes, path, s["file_format"], s["partition_strategy"], s["compression"], s["max_records_per_file"], mode="overwrite", max_megabytes=s["max_file_size_mb"])

    def write_table(self, changes: DataFrame, database: str, table: str, batch: str) -> int:
        """One table's images with their metadata columns; returns the schema's version.

        A schema unlike the newest registered one is registered first, and the write is
        refused (ValueError) where it is not compatible with it.
        """
        s, name = self.settings, f"{database}.{table}"
        schema = changes.select("after.*").schema
        held = self.registry.versions(name) if name in self.registry.names() else []
        version = held[-1] if held and self.registry.schema(name) == schema else self.registry.register(name, schema, self.compatibility)
        parts = writers.partition_columns(F.col("_timestamp"), s["partition_strategy"])
        rows = with_metadata(changes).withColumns(parts)
        path = f"{self.root}/parquet/{database}/{table}/batch={batch}"
        limit = writers.records_for(rows, s["max_file_size_mb"], s["max_records_per_file"])
        writers.writer(rows, "parquet", s["compression"], limit, "overwrite", list(parts)).save(path)
        if name not in self.catalog.names():
            self.catalog.register(database, table, schema, partition_by=list(parts))
        elif self.catalog.schema(name) != schema:
            self.catalog.update_schema(name, schema)
        back = self.spark.read.parquet(path)
        sizes = back.select("_metadata.file_path", "_metadata.file_size").groupBy("file_path").agg(F.max("file_size").alias("size"), F.count("*").alias("n")).agg(F.count("*").alias("files"), F.sum("n").alias("rows"), F.sum("size").alias("size")).first()
        self.catalog.add_partition(name, path.removeprefix(f"{self.root}/"), {"batch": batch}, sizes.files, sizes.rows or 0, sizes["size"] or 0)
        return version

    def read_table(self, database: str, table: str) -> DataFrame:
        return self.spark.read.option("mergeSchema", "true").parquet(f"{self.root}/parquet/{database}/{table}").drop("batch")

    def tables(self) -> list[str]:
        """Tables on disk."""
        return [f"{d}.{t}" for d in paths.children(self.spark, f"{self.root}/parquet") for t in paths.children(self.spark, f"{self.root}/parquet/{d}")]
