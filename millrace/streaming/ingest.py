"""Change streams: filter, transform, validate, then good rows to a sink and the others to dead letters."""

from __future__ import annotations

import logging
import random
import threading
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.redact import redact
from ..operators.filters import Filter, apply_filters
from ..operators.transforms import Transform, apply_transforms
from ..sources import paths

Sink = Callable[[DataFrame, int], None]
_log = logging.getLogger(__name__)


def delay_ms(attempt: int, initial: int = 100, most: int = 10_000, jitter: float = 0.25) -> float:
    """Doubles with each attempt up to `most`; all but the first vary by the jitter."""
    base = min(float(most), initial * 2.0**attempt)
    return base if attempt == 0 else base * (1 + random.uniform(-jitter, jitter))


class Cancelled(Exception):
    """A retry that was called off."""


def with_retry(action: Callable[[], None], retries: int = 3, initial: int = 100, most: int = 10_000, sleep: Callable[[float], None] = time.sleep, cancelled: Callable[[], bool] = lambda: False) -> int:
    """Runs action once and `retries` times more at most; returns the attempts made or raises the last error.

    cancelled is asked before each attempt and once more after each wait.
    """
    for attempt in range(max(0, retries) + 1):
        if cancelled():
            raise Cancelled
        try:
            action()
            return attempt + 1
        except Exception:
            if attempt >= retries:
                raise
            sleep(delay_ms(attempt, initial, most) / 1000)
    return 0


@dataclass
class Pipeline:
    """The same plan for batches and streams."""

    filters: list[Filter] = field(default_factory=list)
    transforms: list[Transform] = field(default_factory=list)

    def apply(self, changes: DataFrame) -> DataFrame:
        return apply_transforms(apply_filters(changes, self.filters), self.transforms)


def as_letters(rows: DataFrame, reason: Column, retries: int = 0, at: Column | None = None) -> DataFrame:
    """Rows as dead letters: the change, the redacted reason, the time and the retries made."""
    return rows.select(
        F.struct(*rows.columns).alias("original_change"), redact(reason).alias("failure_reason"), (F.current_timestamp() if at is None else at).alias("timestamp"), F.lit(retries).alias("retry_count")
    )


def split(rows: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """Rows without a reason against them, and dead letters of the others."""
    marked = rows.withColumn("_reason", reason)
    bad = as_letters(marked.where("_reason is not null"), F.col("_reason"))
    return marked.where("_reason is null").drop("_reason"), bad.withColumn("original_change", F.col("original_change").dropFields("_reason"))


class Full(RuntimeError):
    """A write to a dead-letter folder that holds its limit."""


class DeadLetters:
    """Dead letters as JSON lines under a folder, a part for each batch. A write is an error once the other parts hold max_bytes, unless it may go beyond."""

    def __init__(self, path: str, max_bytes: int = 100 << 20):
        self.path, self.max_bytes = path, max_bytes

    def write(self, letters: DataFrame, batch: str | None = None, beyond: bool = False) -> None:
        """Writes a batch's letters; the same batch written again replaces them. Without a batch each write is one of its own. beyond: into a full folder too."""
        spark = letters.sparkSession
        name = f"batch={uuid.uuid4().hex if batch is None else batch}"
        if not beyond and [n for n in paths.children(spark, self.path) if n != name] and self.size(spark, but=name) >= self.max_bytes:
            raise Full("the dead-letter folder is full")
        letters.write.mode("overwrite").json(f"{self.path}/{name}")

    def read(self, spark, schema: str | None = None) -> DataFrame:
        reader = spark.read.option("mode", "FAILFAST").option("recursiveFileLookup", "true")
        return (reader.schema(schema) if schema else reader).json(self.path)

    def size(self, spark, but: str = "") -> int:
        """Bytes held, without those of one part."""
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").option("recursiveFileLookup", "true").load(self.path)
        return files.where(~F.contains("path", F.lit(f"/{but or chr(0)}/"))).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]

    def count(self, spark) -> int:
        """Letters held."""
        return self.read(spark, "failure_reason string").count() if paths.children(spark, self.path) else 0

    def clear(self, spark) -> None:
        paths.delete(spark, self.path)


def start(changes: DataFrame, pipeline: Pipeline, sink: Sink, checkpoint: str, reason: Column | None = None, dead_letters: DeadLetters | None = None, retries: int = 3, trigger: dict | None = None, initial_ms: int = 100, most_ms: int = 10_000, stop_when_full: bool = False) -> StreamingQuery:
    """Runs the pipeline over a stream. Each batch goes to sink(rows, batch id) under retry.

    Offsets are saved in `checkpoint` after a batch is written, so a restart repeats at
    most the last batch, under the same id. Dead letters replace what their id wrote;
    sinks that do the same are exact. With dead letters, a batch whose sink fails to
    the last attempt becomes dead letters too, and the stream goes on. It also goes on
    when their folder is full: all letters are kept, with a warning for each batch. With
    stop_when_full it ends by an error before that batch is committed.
    """
    stopped = threading.Event()

    def attempt(action: Callable[[], None]) -> None:
        with_retry(action, retries, initial_ms, most_ms, lambda s: stopped.wait(s) and None, stopped.is_set)

    def keep(bad: DataFrame, batch: str) -> None:
        try:
            dead_letters.write(bad, batch)
        except Full:
            if stop_when_full:
                raise
            _log.warning("%s: beyond its %d bytes by the letters of batch %s", dead_letters.path, dead_letters.max_bytes, batch)
            dead_letters.write(bad, batch, beyond=True)

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            good, bad = (batch, None) if reason is None else split(batch, reason)
            try:
                attempt(lambda: sink(good, batch_id))
            except Cancelled:
                raise
            except Exception as e:
                if dead_letters is None:
                    raise
                lost = as_letters(good, F.lit(f"{type(e).__name__}: {e}"[:500]), max(0, retries))
                bad = lost if bad is None else lost.unionByName(bad)
            if dead_letters is not None and bad is not None and not bad.isEmpty():
                attempt(lambda: keep(bad, str(batch_id)))
        finally:
            batch.unpersist()

    query = pipeline.apply(changes).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    _stops[query.id] = stopped
    return query


#: What calls off the retries of a running query, by its id.
_stops: dict[str, threading.Event] = {}


def reset(spark, checkpoint: str) -> bool:
    """Forgets how far a stream has come; the next start reads its source from the beginning."""
    return paths.delete(spark, checkpoint)


def stop(query: StreamingQuery, seconds: int = 30) -> bool:
    """Calls off waiting retries and stops after the batch at hand; whether it ended in time. Offsets of whole batches are saved by then."""
    if query.id in _stops:
        _stops.pop(query.id).set()
    try:
        query.stop()
        return bool(query.awaitTermination(seconds))
    except StreamingQueryException as e:
        if Cancelled.__name__ not in str(e):
            raise
        return not query.isActive


def windowed_counts(events: DataFrame, ts: str, every: str, late: str, *keys: str) -> DataFrame:
    """Rows for each window and key; rows later than `late` are left out of a stream."""
    timed = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    return timed.groupBy(F.window(ts, every), *keys).agg(F.count("*").alias("rows"))


def without_repeats(events: DataFrame, key: str, ts: str, late: str) -> DataFrame:
    """First row of each key; in a stream, state is kept for as long as rows may be late."""
    if events.isStreaming:
        return events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).dropDuplicatesWithinWatermark([key])
    return events.dropDuplicates([key])


def latest_state(changes: DataFrame, key: Column, order: list[Column]) -> DataFrame:
    """Each key's newest image; keys whose newest change is a DELETE are gone. Partial aggregates come before the shuffle."""
    newest = changes.groupBy(key.alias("key")).agg(F.max_by(F.struct("type", "after"), F.struct(*order)).alias("c"))
    return newest.where("c.type <> 'DELETE'").select("key", F.col("c.after").alias("after"))
