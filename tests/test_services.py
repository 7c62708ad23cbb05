"""Registry, catalog, configuration, retry, layers on disk, and streams."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import queries as Q
from millrace.plans import catalog, layers, registry
from millrace.sources import config, paths, writers
from millrace.streaming import ingest

BASE = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("name", T.StringType(), False), T.StructField("age", T.IntegerType(), True)])


def changed(**fields):
    out = {f.name: f for f in BASE}
    for name, (kind, nullable) in fields.items():
        out[name] = T.StructField(name, kind, nullable)
    return T.StructType(list(out.values()))


@pytest.mark.parametrize(
    "mode, new, message",
    [
        ("BACKWARD", changed(email=(T.StringType(), True)), None),
        ("BACKWARD", changed(email=(T.StringType(), False)), "must be optional"),
        ("BACKWARD", changed(id=(T.IntegerType(), False)), "type changed"),
        ("BACKWARD", changed(age=(T.IntegerType(), False)), "nullable constraint tightened"),
        ("BACKWARD", changed(name=(T.StringType(), True)), None),
        ("FORWARD", T.StructType(BASE.fields[:2]), None),
        ("FORWARD", changed(id=(T.IntegerType(), False)), "type changed"),
        ("FORWARD", changed(email=(T.StringType(), False)), None),
        ("FULL", changed(email=(T.StringType(), True)), None),
        ("FULL", changed(id=(T.IntegerType(), False)), "type changed"),
        ("NONE", changed(id=(T.IntegerType(), False), email=(T.StringType(), False)), None),
        ("SIDEWAYS", BASE, "unknown compatibility"),
    ],
)
def test_registry(mode, new, message):
    r = registry.Registry()
    assert r.register("s", BASE, mode) == 1
    if message:
        with pytest.raises(ValueError, match=message):
            r.register("s", new)
        assert r.versions("s") == [1]
    else:
        assert r.register("s", new, "BACKWARD") == 2 and r.schema("s") == new and r.schema("s", 1) == BASE


def test_registry_on_disk(spark, tmp_path):
    root = f"file://{tmp_path}/registry"
    r = registry.Registry(spark, root)
    r.register("a", BASE, "NONE")
    r.register("a", T.StructType(BASE.fields[:1]))
    r.register("b", BASE)
    paths.write_text(spark, f"{root}/broken.json", "{")
    again = registry.Registry(spark, root)
    assert again.names() == ["a", "b"] and again.versions("a") == [1, 2] and again.schema("a", 1) == BASE
    with pytest.raises(KeyError):
        again.schema("a", 3)
    again.set_mode("b", "full")
    again.delete("a")
    again.delete("never")
    assert registry.Registry(spark, root).names() == ["b"]


def test_catalog(spark, tmp_path):
    root = f"file://{tmp_path}"
    c = catalog.Catalog(spark, root)
    c.register("db", "t", BASE, ["id"])
    assert c.update_schema("db.t", changed(email=(T.StringType(), True))) == 2
    c.add_partition("db.t", "p1", {"date": "2024-01-01"}, 1, 10, 100)
    c.add_partition("db.t", "p1", {"date": "2024-01-01"}, 2, 20, 150)
    c.add_partition("db.t", "p2", {"date": "2024-01-02"}, 1, 5, 50)
    c.update("db.t", statistics={"rows": 25})
    again = catalog.Catalog(spark, root)
    assert again.partition_totals("db.t") == {"partitions": 2, "file_count": 3, "record_count": 25, "size_bytes": 200}
    assert again.get("db.t")["lineage"][0]["transformation"] == "schema_v2" and again.get("db.t")["statistics"] == {"rows": 25}
    again.register("db", "t", BASE)
    assert len(again.get("db.t")["history"]) == 1
    with pytest.raises(KeyError):
        again.add_partition("db.x", "p", {}, 1, 1, 1)


MYSQL = {"source": {"type": "mysql", "mysql": {"host": "h", "user": "u", "server_id": 1}}}


def test_config(tmp_path):
    got = config.from_dict(MYSQL)
    assert got["source"]["mysql"]["port"] == 3306 and got["retry"]["max_retries"] == 3 and got["storage"]["local"]["max_records_per_file"] == 10000
    for name in ("host", "user", "server_id"):
        with pytest.raises(ValueError, match=name):
            config.from_dict({"source": {"type": "mysql", "mysql": {k: v for k, v in MYSQL["source"]["mysql"].items() if k != name}}})
    for local in ({"file_format": "xml"}, {"partition_strategy": "week"}, {"compression": "lzo"}):
        with pytest.raises(ValueError, match="unsupported"):
            config.from_dict(MYSQL | {"storage": {"local": local}})
    with pytest.raises(ValueError, match="unsupported source"):
        config.from_dict({"source": {"type": "ftp"}})
    secret = {"source": {"type": "mysql", "mysql": {"host": "h", "user": "u", "server_id": 1, "password": "${PW}"}}}
    assert config.from_dict(secret, {"PW": "x"})["source"]["mysql"]["password"] == "x" and config.plaintext_passwords(secret) == []
    assert config.plaintext_passwords({"a": {"password": "x"}, "token": "y"}) == ["a.password", "token"]
    (tmp_path / "c.yaml").write_text("source:\n  type: kafka\n  kafka:\n    brokers: [b]\n")
    pytest.importorskip("yaml")
    assert config.load(str(tmp_path / "c.yaml"))["source"]["type"] == "kafka"


def test_retry():
    calls, slept = [], []

    def fails():
        calls.append(1)
        raise OSError("no")

    with pytest.raises(OSError):
        ingest.with_retry(fails, 3, 100, 500, slept.append)
    assert len(calls) == 4 and 0.1 == slept[0] and all(0.15 <= s <= 0.625 for s in slept[1:])
    assert ingest.with_retry(lambda: None, 0) == 1
    assert all(375 <= ingest.delay_ms(9, 100, 500) <= 625 for _ in range(50))


def test_expiry_and_totals(spark, tmp_path):
    root = f"file://{tmp_path}"
    ch = Q.event_changes(spark, "/root/testdata/sf0.001")
    writers.write_changes(ch, f"{root}/bronze", "json", "date")
    before = {r.layer: r.files for r in layers.layer_totals(spark, root).collect()}
    gone = layers.clean_expired(spark, root, "bronze", "2024-02-10")
    assert gone and all(n < "date=2024-01-11" for n in gone) and len(gone) == 10
    assert {r.layer: r.files for r in layers.layer_totals(spark, root).collect()}["bronze"] < before["bronze"]
    left = paths.children(spark, f"{root}/bronze")
    assert "date=2024-01-11" in left and "_SUCCESS" in left


def test_rewrite_replaces_only_its_partitions(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    ch = Q.event_changes(spark, "/root/testdata/sf0.001").select("id", "timestamp")
    writers.write_changes(ch, path, "parquet", "date")
    n = spark.read.parquet(path).count()
    writers.write_changes(ch.where("date(timestamp) = '2024-01-05'"), path, "parquet", "date", mode="overwrite")
    assert spark.read.parquet(path).count() == n
    with pytest.raises(ValueError):
        writers.writer(ch, "orc")


def test_dead_letters_are_bounded_and_cleared(spark, tmp_path):
    letters = ingest.DeadLetters(f"file://{tmp_path}/dead", 10)
    good, bad = ingest.split(spark.range(4), F.when(F.col("id") % 2 == 1, F.lit("password=x is bad")))
    assert good.count() == 2
    letters.write(bad)
    assert {r.failure_reason for r in letters.read(spark).collect()} == {"[REDACTED] is bad"}
    with pytest.raises(RuntimeError):
        letters.write(bad)
    letters.clear(spark)
    letters.write(bad)


def test_a_restart_repeats_nothing(spark):
    got = Q.queries()["stream_resume"](spark, "/root/testdata/sf0.001")
    assert got.count() == got.select("event_id").distinct().count() == 800


def test_every_query_has_rows(spark):
    empty = {"filter_missing_column"}
    for name in ("gold_weekly", "silver_clean", "retention_expired", "latest_state", "dq_timeliness", "filter_variant_image"):
        assert (Q.queries()[name](spark, "/root/testdata/sf0.01").count() > 0) == (name not in empty)
    assert set(Q.oracle_sql()) <= set(Q.queries())
