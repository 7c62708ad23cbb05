"""A running job from its configuration: `python -m millrace.job settings.yaml [--once]`.

Source, filters, transforms, sink, retry, dead letters and checkpoint all come from the
settings; nothing else has to be written.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .operators import rules
from .sources import config as settings_of
from .sources import readers, rest
from .sources.manager import StorageManager
from .streaming import ingest


def change_schema(image_schema: str) -> str:
    """Change events whose images have the given fields."""
    image = f"struct<{image_schema}>"
    return f"id string, timestamp timestamp, source string, type string, database string, table string, before {image}, after {image}, binlog_file string, binlog_pos bigint"


def source_of(spark: SparkSession, config: dict) -> DataFrame:
    """The configured source as a stream; batch_size bounds the files, or offsets, of a batch."""
    kind, own, size = config["source"]["type"], config["source"][config["source"]["type"]], config["processing"]["batch_size"]
    if kind == "file":
        return readers.stream_changes(spark, own["path"], own["format"], change_schema(own["image_schema"]), size)
    if kind == "kafka":
        text = readers.read_kafka(spark, ",".join(own["brokers"]), own.get("topic", "changes"))
        return text.select(F.from_json("value", change_schema(own["image_schema"])).alias("c")).select("c.*")
    if kind == "rest":
        rest.register(spark)
        options = {"base_url": own["base_url"], "endpoints": " ".join(own.get("endpoints", ["/changes"]))} | {f"header.{k}": v for k, v in own.get("headers", {}).items()}
        text = spark.readStream.format("millrace_rest").options(**options).load()
        return text.select(F.from_json("body", change_schema(own["image_schema"])).alias("c")).select("c.*")
    raise ValueError(f"a {kind} log has to be bridged to change files or Kafka; snapshots are read by sources.readers.read_jdbc")


def pipeline_of(config: dict) -> ingest.Pipeline:
    """Filters and transforms, written as rules."""
    own = config["processing"]
    return ingest.Pipeline([rules.parse_filter(r) for r in own["filters"]], [rules.parse_transform(r) for r in own["transforms"]])


def start(spark: SparkSession, config: dict, once: bool = False, reason: Column | None = None) -> StreamingQuery:
    """Starts the job; once: what is there now, then it ends. Dead letters end it only at a limit that its settings name."""
    local, retry = config["storage"]["local"], config["retry"]
    manager = StorageManager(spark, local["base_path"], local, compatibility=config["schema"]["compatibility"])
    own = config["processing"]
    letters = ingest.DeadLetters(own["dead_letter_queue_path"], int(own.get("dead_letter_max_size_mb", 100)) << 20) if own.get("dead_letter_queue_path") else None
    trigger = None if once else {"processingTime": f"{config['checkpoint']['save_interval_sec']} seconds"}
    return ingest.start(
        source_of(spark, config), pipeline_of(config), lambda df, n: manager.write(df, str(n)), config["checkpoint"]["storage_path"], reason, letters, retry["max_retries"], trigger, retry["initial_interval_ms"], retry["max_interval_ms"],
        stop_when_full="dead_letter_max_size_mb" in own,
    )


def main(args: list[str]) -> int:
    config = settings_of.load(args[0])
    spark = SparkSession.builder.appName(config["app"]["name"]).config("spark.sql.session.timeZone", "UTC").getOrCreate()
    query = start(spark, config, "--once" in args)
    try:
        query.awaitTermination()
    except KeyboardInterrupt:
        return 0 if ingest.stop(query) else 1
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
