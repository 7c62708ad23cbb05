"""Layers on disk, tables with registry and catalog, jobs from settings, streams that stop, fail and start again."""

import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.sql import functions as F

from millrace import job
from millrace import queries as Q
from millrace.plans.catalog import Catalog
from millrace.plans.lake import Lake
from millrace.sources import config, paths, readers, rest, writers
from millrace.sources.manager import StorageManager
from millrace.streaming import ingest

IMAGE = "event_id bigint, id string, created_at string, value double"


def test_bad_records_go_aside(spark, sf, tmp_path):
    lake = Lake(spark, f"file://{tmp_path}/lake")
    assert lake.read_bronze().count() == 0
    ch = Q.event_changes(spark, sf)
    lake.write_bronze(ch, "b1", F.lit("2024-02-01").cast("timestamp"))
    folder = tmp_path / "lake/bronze/date=2024-02-01/database=app/table=events/batch=b1"
    (folder / "part-bad.json").write_text('{"_id": "x", "_raw_data": \n{"_id":"y","_raw_data":{"type":"INSERT","database":"app","table":"events","after":"{oops"}}\n')
    silver = lake.bronze_to_silver(IMAGE, "events")
    assert silver.count() == ch.count() == lake.metrics["written"]
    assert lake.metrics["rejected"] == 2 and lake.metrics["read"] == ch.count() + 2
    lake.bronze_to_silver(IMAGE, "events")
    assert lake.read_silver().count() == ch.count()  # run again, replaced
    own = lake.bronze_to_silver(IMAGE, cleaner=lambda df: df.withColumn("id", F.lit("c")), validator=lambda df: df.withColumns({"_quality_score": F.lit(0.5), "_validation": F.struct(F.lit(True).alias("valid"))}))
    assert {(r.id, r._quality_score) for r in own.select("_cleaned_data.id", "_quality_score").distinct().collect()} == {("c", 0.5)}
    assert lake.silver_to_gold("weekly").agg(F.sum("record_count")).first()[0] == ch.count()


def test_no_gold_without_silver_rows(spark, sf, tmp_path):
    lake = Lake(spark, f"file://{tmp_path}/lake")
    lake.write_bronze(Q.event_changes(spark, sf).where("type = 'DELETE'").withColumn("before", F.lit(None).cast("struct<event_id: bigint>")), "b")
    lake.bronze_to_silver(IMAGE)
    assert lake.metrics["written"] == 0 and lake.silver_to_gold("daily") is None
    assert not paths.children(spark, f"file://{tmp_path}/lake/gold")


def test_incompatible_tables_are_refused(spark, sf, tmp_path):
    local = config.DEFAULTS["storage"]["local"] | {"file_format": "parquet"}
    m = StorageManager(spark, f"file://{tmp_path}", local)
    nation = Q.table(spark, sf, "nation")
    ch = Q.changes_of(nation, "n_nationkey", "nation", ["n_nationkey", "n_name"])
    assert m.write_table(ch, "d", "t", "0") == m.write_table(ch, "d", "t", "1") == 1
    with pytest.raises(ValueError, match="type changed"):
        m.write_table(Q.changes_of(nation.withColumn("n_name", F.lit(1)), "n_nationkey", "nation", ["n_nationkey", "n_name"]), "d", "t", "2")
    assert m.read_table("d", "t").count() == 50 and m.tables() == ["d.t"]
    again = Catalog(spark, f"file://{tmp_path}")
    assert again.partition_totals("d.t")["record_count"] == 50
    with pytest.raises(ValueError):
        StorageManager(spark, "x", local | {"file_format": "xml"})


def test_files_end_near_a_size(spark, sf, tmp_path):
    ch = Q.event_changes(spark, sf).coalesce(1)
    writers.write_changes(ch, f"file://{tmp_path}/j", "json", "none", max_megabytes=0.05)
    sizes = [p.stat().st_size for p in (tmp_path / "j").glob("*.json")]
    assert len(sizes) > 3 and max(sizes) < 0.075 * (1 << 20)


def test_job_once_more_from_settings(spark, sf, tmp_path):
    """A second run reads new files only; after a reset everything is read again, into the same batches."""
    ch = Q.event_changes(spark, sf).withColumns({i: F.when(F.col(i).isNotNull(), F.struct(f"{i}.event_id", f"{i}.value")) for i in ("before", "after")})
    settings = config.from_dict({
        "source": {"type": "file", "file": {"path": f"file://{tmp_path}/in", "image_schema": "event_id: bigint, value: double"}},
        "storage": {"local": {"base_path": f"file://{tmp_path}/out", "file_format": "csv"}},
        "checkpoint": {"storage_path": f"file://{tmp_path}/cp"},
        "processing": {"filters": ["value > 50"], "batch_size": 2},
    })
    out = lambda: spark.read.csv(f"file://{tmp_path}/out/csv").count()
    ch.where("id % 2 = 0").repartition(3).write.json(f"{tmp_path}/in")
    job.start(spark, settings, once=True).awaitTermination()
    want = ch.where(F.coalesce("after.value", "before.value") > 50)
    assert out() == want.where("id % 2 = 0").count()
    ch.where("id % 2 = 1").write.mode("append").json(f"{tmp_path}/in")
    job.start(spark, settings, once=True).awaitTermination()
    assert out() == want.count()
    ingest.reset(spark, settings["checkpoint"]["storage_path"])
    query = job.start(spark, settings, once=True)
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == ch.count()
    with pytest.raises(ValueError, match="bridged"):
        job.source_of(spark, config.from_dict({"source": {"type": "mysql", "mysql": {"host": "h", "user": "u", "server_id": 1}}}))


def test_dead_letters_survive_a_failure_before_the_commit(spark, sf, tmp_path):
    """Letters of a batch that is repeated are replaced; they hold time and retries."""
    rows = Q.table(spark, sf, "events").select("event_id", "event_type")
    rows.write.parquet(f"{tmp_path}/in")

    class Breaks(ingest.DeadLetters):
        failures = 1

        def write(self, letters, batch=None):
            super().write(letters, batch)
            if self.failures:
                self.failures -= 1
                raise OSError("after the write, before the commit")

    letters = Breaks(f"file://{tmp_path}/dead")
    run = lambda: ingest.start(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in"), ingest.Pipeline(), lambda df, n: None, f"{tmp_path}/cp", F.when(F.col("event_id") % 4 == 0, F.lit("fourth")), letters, 0)
    with pytest.raises(Exception, match="before the commit"):
        run().awaitTermination()
    run().awaitTermination()
    got = letters.read(spark)
    assert got.count() == got.select("original_change.event_id").distinct().count() == letters.count(spark) == 250
    assert got.where("timestamp is null or retry_count <> 0 or failure_reason <> 'fourth'").isEmpty()


def test_full_dead_letters_end_no_stream(spark, sf, tmp_path):
    """Every run after the first meets a full folder: good rows and letters are all there, once; a repeated batch replaces its letters."""
    rows = Q.table(spark, sf, "events").select("event_id", "value")
    letters = ingest.DeadLetters(f"file://{tmp_path}/dead", 10)
    sink = lambda df, n: df.write.mode("overwrite").parquet(f"{tmp_path}/out/batch={n}")
    run = lambda: ingest.start(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in"), ingest.Pipeline(), sink, f"{tmp_path}/cp", F.when(F.col("event_id") % 4 == 0, F.lit("fourth")), letters).awaitTermination()
    for part in range(3):
        rows.where(F.col("event_id") % 3 == part).write.mode("append").parquet(f"{tmp_path}/in")
        run()
    (tmp_path / "cp/commits/2").unlink()
    (tmp_path / "cp/commits/.2.crc").unlink(missing_ok=True)
    run()
    good, bad = spark.read.parquet(f"{tmp_path}/out"), letters.read(spark)
    assert paths.children(spark, letters.path) == [f"batch={n}" for n in range(3)]
    assert sorted(r[0] for r in good.select("event_id").collect()) == [n for n in range(1000) if n % 4]
    assert sorted(r[0] for r in bad.select("original_change.event_id").collect()) == list(range(0, 1000, 4))


def test_a_limit_in_the_settings_stops_the_job(spark, sf, tmp_path):
    """Before the batch is committed; once the folder is cleared, the job goes on with that batch."""
    ch = Q.event_changes(spark, sf).withColumns({i: F.when(F.col(i).isNotNull(), F.struct(f"{i}.event_id", f"{i}.value")) for i in ("before", "after")})
    settings = {
        "source": {"type": "file", "file": {"path": f"file://{tmp_path}/in", "image_schema": "event_id: bigint, value: double"}},
        "storage": {"local": {"base_path": f"file://{tmp_path}/out"}},
        "checkpoint": {"storage_path": f"file://{tmp_path}/cp"},
        "processing": {"dead_letter_queue_path": f"file://{tmp_path}/dead", "dead_letter_max_size_mb": 0},
        "retry": {"max_retries": 0},
    }
    letters = ingest.DeadLetters(f"file://{tmp_path}/dead")
    run = lambda: job.start(spark, config.from_dict(settings), True, F.when(F.col("id").cast("int") % 4 == 0, F.lit("fourth"))).awaitTermination()
    ch.where("id % 2 = 0").write.json(f"{tmp_path}/in")
    run()
    ch.where("id % 2 = 1").unionAll(ch.where("id = 4")).write.mode("append").json(f"{tmp_path}/in")
    with pytest.raises(Exception, match="folder is full"):
        run()
    assert letters.count(spark) == 250
    letters.clear(spark)
    run()
    assert [r[0] for r in letters.read(spark).select("original_change.id").collect()] == ["4"]


def test_stop_ends_waiting_retries(spark, sf, tmp_path):
    """A stream whose sink keeps failing is stopped within its time; nothing is committed, so nothing is lost."""
    rows = Q.table(spark, sf, "region")
    rows.write.parquet(f"{tmp_path}/in")
    tried = threading.Event()

    def sink(df, n):
        tried.set()
        raise OSError("no")

    source = lambda: spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    query = ingest.start(source(), ingest.Pipeline(), sink, f"{tmp_path}/cp", retries=1000, trigger={"processingTime": "1 second"}, initial_ms=60_000, most_ms=60_000)
    assert tried.wait(60) and query.isActive
    assert ingest.stop(query, 30) and not query.isActive
    seen = []
    ingest.start(source(), ingest.Pipeline(), lambda df, n: seen.append(df.count()), f"{tmp_path}/cp").awaitTermination()
    assert seen == [5]


def test_cancelled_retry():
    calls = []
    with pytest.raises(ingest.Cancelled):
        ingest.with_retry(lambda: calls.append(1) or 1 / 0, 5, sleep=lambda s: None, cancelled=lambda: len(calls) == 2)
    assert len(calls) == 2


def test_table_infos(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS infos")
    spark.sql("CREATE OR REPLACE TEMP VIEW unused AS SELECT 1")
    asked = []

    def lookup(database, table):
        asked.append(table)
        return spark.createDataFrame([], "id bigint, name string, code int").schema, ["id", "code"]

    infos = readers.TableInfos(lookup)
    assert infos.get("d", "t")["keys"] == {0: "id", 2: "code"} and infos.get("d", "t")["columns"][1] == ("name", "string", True)
    assert not infos.on_statement("INSERT INTO t VALUES (1)") and infos.get("d", "t") and asked == ["t"]
    assert infos.on_statement("alter  TABLE t ADD COLUMN x INT") and infos.get("d", "t") and asked == ["t", "t"]


class _Server(BaseHTTPRequestHandler):
    records: list[dict] = []

    def do_GET(self):
        url = urlparse(self.path)
        after = int(parse_qs(url.query).get("after", ["0"])[0])
        body = json.dumps(self.records[after:] if url.path == "/changes" else {"path": url.path, "key": self.headers.get("x-key")}).encode()
        self.send_response(200)
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *args):
        pass


@pytest.fixture
def server():
    s = HTTPServer(("127.0.0.1", 0), _Server)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}"
    s.shutdown()


def test_rest_source(spark, server, tmp_path):
    rest.register(spark)
    rows = spark.read.format("millrace_rest").options(base_url=server, endpoints="/a /b", **{"header.x-key": "k"}).load().collect()
    assert {json.loads(r.body)["path"] for r in rows} == {"/a", "/b"} and all(json.loads(r.body)["key"] == "k" for r in rows)
    assert {r.endpoint for r in readers.read_rest(spark, server, ["/a"]).collect()} == {"/a"}
    _Server.records = [{"id": str(k), "type": "INSERT", "database": "d", "table": "t", "timestamp": "2024-01-01T00:00:00Z", "after": {"k": k}} for k in range(5)]
    settings = config.from_dict({
        "source": {"type": "rest", "rest": {"base_url": server, "image_schema": "k: bigint"}},
        "storage": {"local": {"base_path": f"file://{tmp_path}/out"}},
        "checkpoint": {"storage_path": f"file://{tmp_path}/cp", "save_interval_sec": 1},
        "processing": {"filters": ["k > 0"]},
    })

    def polled(n):
        query = job.start(spark, settings)
        for _ in range(60):
            query.processAllAvailable()
            held = readers.read_changes(spark, f"file://{tmp_path}/out/json", "json", job.change_schema("k: bigint")) if paths.children(spark, f"file://{tmp_path}/out/json") else None
            if held is not None and held.count() >= n:
                break
        assert ingest.stop(query) and sorted(r.k for r in held.select("after.k").collect()) == list(range(1, n + 1))

    polled(4)
    _Server.records = _Server.records + [{**_Server.records[0], "id": "5", "after": {"k": 5}}]
    polled(5)


def test_transforms_and_filters_on_a_stream_of_maps(spark, tmp_path):
    """Images as maps, a chain of transforms, kept in order."""
    from millrace.operators import rules

    rows = spark.createDataFrame([("1", "INSERT", {"a": "10", "b": "secret"}), ("2", "INSERT", {"a": "3", "b": "x"}), ("3", "INSERT", {"b": "no a"})], "id string, type string, after map<string,string>").withColumn("before", F.lit(None).cast("map<string,string>"))
    rows.write.parquet(f"{tmp_path}/in")
    plan = ingest.Pipeline([rules.parse_filter("a > 5")], [rules.parse_transform("mask:b:#:2"), rules.parse_transform("add_timestamp:seen")])
    seen = []
    ingest.start(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in"), plan, lambda df, n: seen.extend(df.collect()), f"{tmp_path}/cp").awaitTermination()
    assert [(r.id, r.after["b"], "seen" in r.after) for r in seen] == [("1", "se#", True)]
