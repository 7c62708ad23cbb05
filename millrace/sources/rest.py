"""A REST source as Spark data source `millrace_rest`: JSON documents of endpoints, once or by polling.

Options: base_url, endpoints (separated by blanks), header.NAME. As a stream each poll
asks every endpoint for `?after=N`, N being the number of records it has given so far,
and takes a JSON list; the offset is that number, so a restart goes on where it was.
"""

from __future__ import annotations

import json
import urllib.request
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

SCHEMA = "endpoint string, body string"


def _fetch(options: dict, endpoint: str, query: str = "") -> str:
    headers = {k[len("header.") :]: v for k, v in options.items() if k.lower().startswith("header.")}
    request = urllib.request.Request(options["base_url"].rstrip("/") + endpoint + query, headers=headers)
    with urllib.request.urlopen(request, timeout=60) as answer:
        return answer.read().decode()


class _Endpoint(InputPartition):
    def __init__(self, name: str):
        self.name = name


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        return [_Endpoint(e) for e in self.options["endpoints"].split()]

    def read(self, partition: _Endpoint) -> Iterator[tuple]:
        yield partition.name, _fetch(self.options, partition.name)


class _Poller(SimpleDataSourceStreamReader):
    def __init__(self, options: dict):
        self.options = options

    def initialOffset(self) -> dict:
        return {e: 0 for e in self.options["endpoints"].split()}

    def _since(self, endpoint: str, n: int) -> list[str]:
        return [json.dumps(x) for x in json.loads(_fetch(self.options, endpoint, f"?after={n}"))]

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        found = {e: self._since(e, n) for e, n in start.items()}
        rows = [(e, body) for e, bodies in found.items() for body in bodies]
        return iter(rows), {e: n + len(found[e]) for e, n in start.items()}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter([(e, body) for e, n in start.items() for body in self._since(e, n)[: end[e] - n]])


class RestSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "millrace_rest"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return _Poller(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(RestSource)
