"""Data catalog: tables, schema history, partitions, statistics, lineage and quality, as JSON files."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from ..sources import paths


def _now() -> str:
    return datetime.now(timezone.utc).isoformat()


class Catalog:
    """Metadata of tables. Sizes follow from the partitions held, so adding one again replaces it."""

    def __init__(self, spark: SparkSession | None = None, root: str | None = None):
        self.spark, self.root = spark, f"{root}/_catalog" if root else None
        self.tables: dict[str, dict] = {}
        for name in paths.children(spark, self.root) if self.root else []:
            try:
                loaded = json.loads(paths.read_text(spark, f"{self.root}/{name}") or "")
                self.tables[loaded["name"]] = loaded
            except (ValueError, KeyError, TypeError):
                continue

    def _save(self, name: str) -> None:
        self.tables[name]["updated_at"] = _now()
        if self.root:
            paths.write_text(self.spark, f"{self.root}/{name}.json", json.dumps(self.tables[name]))

    def register(self, database: str, table: str, schema: T.StructType, primary_key: list[str] = (), partition_by: list[str] = (), **properties: str) -> None:
        """A new entry; one that was there is replaced, with its history."""
        name = f"{database}.{table}"
        version = {"version": 1, "schema": schema.jsonValue(), "primary_key": list(primary_key), "partition_by": list(partition_by)}
        self.tables[name] = {"name": name, "history": [version], "partitions": {}, "statistics": {}, "lineage": [], "quality": {}, "properties": properties, "created_at": _now()}
        self._save(name)

    def update_schema(self, name: str, schema: T.StructType) -> int:
        held = self.get(name)
        version = len(held["history"]) + 1
        held["history"].append(held["history"][-1] | {"version": version, "schema": schema.jsonValue()})
        held["lineage"].append({"source": name, "transformation": f"schema_v{version}", "timestamp": _now()})
        self._save(name)
        return version

    def add_partition(self, name: str, path: str, values: dict[str, str], files: int, records: int, size: int) -> None:
        self.get(name)["partitions"][path] = {"values": values, "file_count": files, "record_count": records, "size_bytes": size, "created_at": _now()}
        self._save(name)

    def update(self, name: str, **parts: object) -> None:
        """Replaces statistics, quality or properties."""
        self.get(name).update({k: v for k, v in parts.items() if k in ("statistics", "quality", "properties")})
        self._save(name)

    def get(self, name: str) -> dict:
        if name not in self.tables:
            raise KeyError(f"unknown table: {name}")
        return self.tables[name]

    def schema(self, name: str) -> T.StructType:
        return T.StructType.fromJson(self.get(name)["history"][-1]["schema"])

    def names(self) -> list[str]:
        return sorted(self.tables)

    def partition_totals(self, name: str) -> dict[str, int]:
        held = self.get(name)["partitions"].values()
        return {"partitions": len(held)} | {k: sum(p[k] for p in held) for k in ("file_count", "record_count", "size_bytes")}
