"""Schema registry: versions of subjects under a compatibility mode, kept as JSON files."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from ..sources import paths

MODES = ("BACKWARD", "FORWARD", "FULL", "NONE")


@dataclass
class Diff:
    added: list[str] = field(default_factory=list)
    removed: list[str] = field(default_factory=list)
    modified: list[str] = field(default_factory=list)


def diff(old: T.StructType, new: T.StructType) -> Diff:
    """Columns added, removed, and changed in type or nullability, by name."""
    a, b = {f.name: f for f in old}, {f.name: f for f in new}
    changed = [n for n in a.keys() & b.keys() if (a[n].dataType, a[n].nullable) != (b[n].dataType, b[n].nullable)]
    return Diff(sorted(b.keys() - a.keys()), sorted(a.keys() - b.keys()), sorted(changed))


def problems(old: T.StructType, new: T.StructType, mode: str) -> list[str]:
    """What stands against new after old; none: compatible."""
    mode = mode.upper()
    if mode not in MODES:
        return [f"unknown compatibility: {mode}"]
    a, b = {f.name: f for f in old}, {f.name: f for f in new}
    found = []
    if mode in ("BACKWARD", "FULL"):
        found += [f"new column {n} must be optional" for n in sorted(b.keys() - a.keys()) if not b[n].nullable]
        found += [f"column {n} nullable constraint tightened" for n in sorted(a.keys() & b.keys()) if a[n].nullable and not b[n].nullable]
    if mode != "NONE":
        found += [f"column {n} type changed" for n in sorted(a.keys() & b.keys()) if a[n].dataType != b[n].dataType]
    return found


class Registry:
    """A subject keeps the mode it was first registered with, until it is set anew."""

    def __init__(self, spark: SparkSession | None = None, root: str | None = None):
        self.spark, self.root = spark, root
        self.subjects: dict[str, dict] = {}
        for name in paths.children(spark, root) if root else []:
            if name.endswith(".json"):
                try:
                    loaded = json.loads(paths.read_text(spark, f"{root}/{name}") or "")
                    self.subjects[loaded["subject"]] = loaded
                except (ValueError, KeyError, TypeError):
                    continue  # a damaged file is passed over

    def _save(self, subject: str) -> None:
        if self.root:
            paths.write_text(self.spark, f"{self.root}/{subject}.json", json.dumps(self.subjects[subject]))

    def register(self, subject: str, schema: T.StructType, mode: str = "BACKWARD") -> int:
        """The new version's number; raises ValueError if the latest version stands against it."""
        held = self.subjects.setdefault(subject, {"subject": subject, "mode": mode.upper(), "versions": []})
        if held["versions"] and (found := problems(self.schema(subject), schema, held["mode"])):
            raise ValueError("; ".join(found))
        version = len(held["versions"]) + 1
        held["versions"].append({"id": f"{subject}-v{version}", "version": version, "schema": schema.jsonValue()})
        self._save(subject)
        return version

    def schema(self, subject: str, version: int = 0) -> T.StructType:
        """A version, or the latest for 0 and below."""
        versions = self.subjects[subject]["versions"]
        if version > len(versions) or not versions:
            raise KeyError(f"{subject} has no version {version}")
        return T.StructType.fromJson(versions[version - 1 if version > 0 else -1]["schema"])

    def names(self) -> list[str]:
        return sorted(self.subjects)

    def versions(self, subject: str) -> list[int]:
        return [v["version"] for v in self.subjects[subject]["versions"]]

    def set_mode(self, subject: str, mode: str) -> None:
        self.subjects[subject]["mode"] = mode.upper()
        self._save(subject)

    def delete(self, subject: str) -> None:
        if self.subjects.pop(subject, None) and self.root:
            paths.delete(self.spark, f"{self.root}/{subject}.json")
