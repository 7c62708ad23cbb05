"""One query for each operator, over whole tables, with the same query in SQL where SQL can express it.

Driver tables hold no nulls, padding or junk, so inputs derive them by modulus.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import job
from .functions import redact as R
from .functions import scalars as S
from .model import to_changes, with_effective_image
from .operators import cleaning, filters, quality, rules, stats, transforms, validation
from .plans import layers, registry
from .plans.catalog import Catalog
from .plans.lake import Lake
from .sources import config, paths, readers, writers
from .sources.manager import StorageManager
from .streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- Changes derived from tables --------------------------------------------------

_KIND_SQL = "CASE WHEN event_type = 'signup' THEN 'INSERT' WHEN event_type = 'error' THEN 'DELETE' ELSE 'UPDATE' END"
_TS_SQL = "strftime(ts, '%Y-%m-%dT%H:%M:%SZ')"


def _kind() -> Column:
    return F.when(F.col("event_type") == "signup", "INSERT").when(F.col("event_type") == "error", "DELETE").otherwise("UPDATE")


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with an id that may be blank and a time in text that may be junk."""
    ev = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return ev.withColumns({"id": F.when(F.col("event_id") % 17 == 0, "").otherwise(F.col("event_id").cast("string")), "created_at": F.when(F.col("event_id") % 5 == 0, "junk").otherwise(S.rfc3339(F.col("ts")))})


def event_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_changes(event_rows(spark, sf_dir), id=F.col("event_id"), ts=F.col("ts"), kind=_kind(), database="app", table="events", columns=["event_id", "id", "created_at", "ts", "user_id", "event_type", "value"])


def changes_of(rows: DataFrame, key: str, name: str, columns: list[str], kind: str = "UPDATE") -> DataFrame:
    return to_changes(rows, id=F.col(key), ts=F.lit("2024-01-15 00:00:00"), kind=F.lit(kind), database="tpch", table=name, columns=columns)


def nulled_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").withColumn("c_acctbal", F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal"))).withColumn("c_mktsegment", F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment")))


_NULLED = "SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS c_acctbal, CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS c_mktsegment FROM customer"


# --- A: scans and routing ---------------------------------------------------------


@query(f"SELECT CAST(event_id AS VARCHAR) AS id, {_KIND_SQL} AS type, 'app' AS database, 'events' AS \"table\", {_TS_SQL} AS ts FROM events WHERE event_type IN ('signup', 'error')")
def change_envelope(spark, sf_dir):
    ch = filters.apply_filters(event_changes(spark, sf_dir), [filters.type_filter("INSERT", "DELETE")])
    return ch.select("id", "type", "database", "table", S.rfc3339(F.col("timestamp")).alias("ts"))


@query("SELECT 'tpch' AS database, 'nation' AS \"table\", CAST(n_nationkey AS VARCHAR) AS id FROM nation UNION ALL SELECT 'tpch', 'region', CAST(r_regionkey AS VARCHAR) FROM region")
def table_routing(spark, sf_dir):
    parts = [changes_of(table(spark, sf_dir, n), k, n, [k]).select("database", "table", "id") for n, k in (("nation", "n_nationkey"), ("region", "r_regionkey"), ("supplier", "s_suppkey"), ("part", "p_partkey"))]
    every = parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])
    return filters.apply_filters(every, [filters.table_filter(["tpch.nation", "region", "supplier"], ["tpch.supplier"])])


@query("SELECT CAST(r_regionkey AS VARCHAR) AS col_0, r_name AS col_1, CAST(r_regionkey AS VARCHAR) AS key, NULL::VARCHAR AS name, 1 AS named FROM region")
def row_to_map_fallback(spark, sf_dir):
    r = table(spark, sf_dir, "region")
    raw = F.array(F.col("r_regionkey").cast("string"), F.col("r_name"))
    both = r.select(readers.rows_to_map(raw).alias("m"), readers.rows_to_map(F.slice(raw, 1, 1), ["key", "name"]).alias("n"))
    return both.select(F.col("m")["col_0"].alias("col_0"), F.col("m")["col_1"].alias("col_1"), F.col("n")["key"].alias("key"), F.try_element_at("n", F.lit("name")).alias("name"), F.size("n").alias("named"))


@query("SELECT o_orderkey, CAST(0 AS BIGINT) AS pair, 'O' AS before, o_orderstatus AS after FROM orders")
def paired_updates(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    rows = o.select("o_orderkey", F.posexplode(F.array(F.lit("O"), "o_orderstatus")).alias("pos", "image"))
    return readers.paired_updates(rows, "o_orderkey", "pos", "image")


@query("SELECT event_id, user_id, event_type FROM events ORDER BY event_id LIMIT 10 OFFSET 25")
def offset_limit(spark, sf_dir):
    return readers.page(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type"), ["event_id"], 25, 10)


@query("SELECT * FROM (VALUES ('n_nationkey', 'int', true), ('n_name', 'string', true), ('n_regionkey', 'int', true)) AS t(name, type, nullable)")
def table_metadata(spark, sf_dir):
    return spark.createDataFrame(readers.table_info(table(spark, sf_dir, "nation")), "name string, type string, nullable boolean")


@query("SELECT doc_id, length(text) AS n, md5(text) AS digest FROM documents")
def normalised_bytes(spark, sf_dir):
    d = table(spark, sf_dir, "documents").withColumn("raw", F.col("text").cast("binary"))
    text = readers.normalised(F.col("raw"), d.schema["raw"].dataType)
    return d.select("doc_id", F.length(text).cast("bigint").alias("n"), F.md5(text.cast("binary")).alias("digest"))


# --- B: filters -------------------------------------------------------------------


def _kept(ch: DataFrame, *fs: filters.Filter) -> DataFrame:
    return filters.apply_filters(ch, list(fs)).select("id")


def _orders(spark, sf_dir):
    return changes_of(table(spark, sf_dir, "orders"), "o_orderkey", "orders", ["o_orderstatus", "o_totalprice"])


def _customers(spark, sf_dir):
    return changes_of(nulled_customers(spark, sf_dir), "c_custkey", "customer", ["c_acctbal", "c_mktsegment"])


@query("SELECT CAST(o_orderkey AS VARCHAR) AS id FROM orders WHERE o_orderstatus = 'F'")
def filter_eq_text(spark, sf_dir):
    return _kept(_orders(spark, sf_dir), filters.column_filter("o_orderstatus", "=", "F"))


@query(f"SELECT CAST(c_custkey AS VARCHAR) AS id FROM ({_NULLED}) WHERE c_mktsegment IS DISTINCT FROM 'BUILDING'")
def filter_ne_null_kept(spark, sf_dir):
    return _kept(_customers(spark, sf_dir), filters.column_filter("c_mktsegment", "!=", "BUILDING"))


@query(f"SELECT CAST(c_custkey AS VARCHAR) AS id FROM ({_NULLED}) WHERE c_acctbal > 5000")
def filter_gt_numeric(spark, sf_dir):
    return _kept(_customers(spark, sf_dir), filters.column_filter("c_acctbal", ">", 5000))


@query(f"SELECT CAST(c_custkey AS VARCHAR) AS id FROM ({_NULLED}) WHERE c_acctbal <= 0 OR c_acctbal IS NULL")
def filter_lte_null_kept(spark, sf_dir):
    return _kept(_customers(spark, sf_dir), filters.column_filter("c_acctbal", "<=", 0))


@query("SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer WHERE c_acctbal >= 1234.5")
def filter_numeric_string(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").withColumn("c_acctbal", F.col("c_acctbal").cast("string"))
    return _kept(changes_of(rows, "c_custkey", "customer", ["c_acctbal"]), filters.column_filter("c_acctbal", ">=", "1234.5"))


@query("SELECT CAST(event_id AS VARCHAR) AS id FROM events WHERE value > 50")
def filter_delete_uses_before(spark, sf_dir):
    return _kept(event_changes(spark, sf_dir), filters.column_filter("value", ">", 50))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS id FROM orders WHERE false")
def filter_missing_column(spark, sf_dir):
    return _kept(_orders(spark, sf_dir), filters.column_filter("no_such_column", "!=", "x"))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS id FROM orders")
def filter_unknown_op(spark, sf_dir):
    return _kept(_orders(spark, sf_dir), filters.column_filter("o_orderstatus", "LIKE", "%F%"))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS id FROM orders WHERE o_orderstatus = 'F' AND o_totalprice < 100000")
def filter_chain(spark, sf_dir):
    return _kept(_orders(spark, sf_dir), filters.no_filter, filters.column_filter("o_orderstatus", "==", "F"), filters.column_filter("o_totalprice", "<", 100000))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS id FROM orders WHERE o_totalprice > 200000.5 AND o_orderstatus <> 'P'")
def filter_rule_string(spark, sf_dir):
    return _kept(_orders(spark, sf_dir), rules.parse_filter("o_totalprice > 200000.5"), rules.parse_filter("o_orderstatus != 'P'"))


@query("SELECT CAST(event_id AS VARCHAR) AS id FROM events WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) >= 50")
def filter_variant_image(spark, sf_dir):
    ev = table(spark, sf_dir, "events").withColumn("image", F.try_parse_json("props"))
    ch = ev.select(F.col("event_id").cast("string").alias("id"), F.lit("UPDATE").alias("type"), F.lit(None).cast("variant").alias("before"), F.col("image").alias("after"))
    return _kept(ch, filters.column_filter("k", ">=", 50))


_PAIRS = [(None, None), (None, "1"), ("1", None), ("5", "5"), ("3", "5"), ("3.14", "6.28"), ("abc", "def"), ("def", "abc"), ("5", "5.0"), ("10", "9"), ("a10", "a9"), (" 5", "5"), ("1d", "1")]


@query("SELECT * FROM (VALUES (0, 0), (1, -1), (2, 1), (3, 0), (4, -1), (5, -1), (6, -1), (7, 1), (8, 0), (9, 1), (10, -1), (11, -1), (12, 1)) AS t(n, cmp)")
def compare_matrix(spark, sf_dir):
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(_PAIRS)], "n int, a string, b string")
    return rows.select("n", S.compare_values(F.col("a"), F.col("b"), T.StringType(), T.StringType()).alias("cmp"))


# --- C: transforms ----------------------------------------------------------------


@query("SELECT c_custkey, CASE WHEN strlen(c_name) > 3 THEN substr(c_name, 1, 3) || '***' ELSE '***' END AS c_name FROM customer")
def mask_field(spark, sf_dir):
    ch = changes_of(table(spark, sf_dir, "customer"), "c_custkey", "customer", ["c_custkey", "c_name"], "INSERT")
    return ch.transform(transforms.mask_field("c_name", "***", 3)).select("after.c_custkey", "after.c_name")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE '#' END AS status FROM orders")
def mask_short_and_null(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("status", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderstatus")))
    ch = changes_of(o, "o_orderkey", "orders", ["o_orderkey", "status"])
    return ch.transform(rules.parse_transform("mask:status:#:1")).select("before.o_orderkey", "before.status")


@query("SELECT doc_id, CASE WHEN strlen(text) > 5 THEN CASE WHEN strlen(left(text, 5)) <= 5 THEN left(text, 5) WHEN strlen(left(text, 4)) <= 5 THEN left(text, 4) WHEN strlen(left(text, 3)) <= 5 THEN left(text, 3) WHEN strlen(left(text, 2)) <= 5 THEN left(text, 2) ELSE left(text, 1) END || '…' ELSE '…' END AS head FROM documents")
def mask_multibyte(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", transforms.masked(F.col("text"), "…", 5).alias("head"))


@query("SELECT event_id, '2024-01-15T00:00:00Z' AS seen_at, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS at FROM events")
def rfc3339_text(spark, sf_dir):
    ev = event_rows(spark, sf_dir)
    ch = changes_of(ev, "event_id", "events", ["event_id", "ts"]).transform(transforms.add_timestamp("seen_at", F.lit("2024-01-15").cast("timestamp")))
    return ch.select("after.event_id", "after.seen_at", S.rfc3339(F.col("after.ts")).alias("at"))


@query("SELECT o_orderkey, o_orderstatus, CAST(o_orderkey AS VARCHAR) AS _id, 'UPDATE' AS _type, 'spark://rows' AS _source, 'tpch' AS _database, 'orders' AS _table FROM orders")
def metadata_columns(spark, sf_dir):
    ch = changes_of(table(spark, sf_dir, "orders"), "o_orderkey", "orders", ["o_orderkey", "o_orderstatus"])
    return transforms.with_metadata(ch).drop("_timestamp")


@query("SELECT '{\"id\":\"' || n_nationkey || '\",\"type\":\"UPDATE\",\"after\":{\"n_name\":\"' || n_name || '\"}}' AS json FROM nation")
def json_rendering(spark, sf_dir):
    return transforms.rendered(changes_of(table(spark, sf_dir, "nation"), "n_nationkey", "nation", ["n_name"]).select("id", "type", "after"))


_SECRETS = "text || CASE doc_id % 5 WHEN 0 THEN ' Password= abc' WHEN 1 THEN ' Bearer a-b.c==' WHEN 2 THEN ' basic abc=' WHEN 3 THEN ' api_key:xyz z' ELSE '' END"


@query(
    "SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '(password|passwd|pwd)\\s*[=:]\\s*\\S+', '[REDACTED]', 'gi'), '(secret|token|key)\\s*[=:]\\s*\\S+', '[REDACTED]', 'gi'), "
    f"'bearer\\s+[a-zA-Z0-9._~+/-]+=*', '[REDACTED]', 'gi'), 'basic\\s+[a-zA-Z0-9+/]+=*', '[REDACTED]', 'gi') AS safe FROM (SELECT doc_id, {_SECRETS} AS t FROM documents)"
)
def redact_values(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", R.redact(F.expr(_SECRETS)).alias("safe"))


_NAMES = ["user_password", "access_token", "api_key", "SECRET", "auth_header", "credentials", "passwd", "username", "email", "name", "id"]


@query("SELECT name, regexp_matches(lower(name), 'password|secret|token|key|credential|auth|passwd') AS sensitive FROM (VALUES " + ", ".join(f"('{n}')" for n in _NAMES) + ") AS t(name)")
def sensitive_names(spark, sf_dir):
    return spark.createDataFrame([(n,) for n in _NAMES], "name string").select("name", R.is_sensitive(F.col("name")).alias("sensitive"))


@query("SELECT c_custkey, c_name AS name, '******' AS token FROM customer")
def mask_sensitive_fields(spark, sf_dir):
    m = R.mask_fields(F.create_map(F.lit("name"), F.col("c_name"), F.lit("access_token"), F.col("c_mktsegment")))
    return table(spark, sf_dir, "customer").select("c_custkey", m["name"].alias("name"), m["access_token"].alias("token"))


# --- D: cleaning and conversion ---------------------------------------------------


def _padded(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    pad = lambda x: F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("  \n"), x, F.lit("\t\r "))).otherwise(x)
    return c.select("c_custkey", pad(F.col("c_name")).alias("name"), pad(F.concat(F.lit("User"), F.col("c_custkey").cast("string"), F.lit("@Example.COM"))).alias("email"))


@query("SELECT c_custkey, c_name AS name, 'user' || c_custkey || '@example.com' AS email FROM customer")
def clean_default_rules(spark, sf_dir):
    return cleaning.clean(_padded(spark, sf_dir))


@query("SELECT c_custkey, c_name AS name, 'User' || c_custkey || '@Example.COM' AS email FROM customer")
def clean_trim_all(spark, sf_dir):
    return cleaning.clean(_padded(spark, sf_dir), [cleaning.CleaningRule("*", "trim"), cleaning.CleaningRule("*", "shuffle")])


@query("SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents")
def clean_ascii_lower(spark, sf_dir):
    return cleaning.clean(table(spark, sf_dir, "documents").select("doc_id", "text"), [cleaning.CleaningRule("text", "lowercase")])


@query("SELECT doc_id, translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') AS text FROM documents")
def clean_ascii_upper(spark, sf_dir):
    return cleaning.clean(table(spark, sf_dir, "documents").select("doc_id", "text"), [cleaning.CleaningRule("text", "uppercase")])


@query("SELECT p_partkey, replace(p_type, 'ECONOMY', 'eco') AS p_type FROM part")
def clean_replace(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return cleaning.clean(p, [cleaning.CleaningRule("p_type", "replace", {"old": "ECONOMY", "new": "eco"}), cleaning.CleaningRule("*", "replace", {"old": "S", "new": "?"})])


@query("SELECT * FROM (VALUES ('event_id', 'INT64'), ('ts', 'BYTE_ARRAY'), ('user_id', 'INT64'), ('event_type', 'BYTE_ARRAY'), ('value', 'DOUBLE'), ('props', 'BYTE_ARRAY')) AS t(name, type)")
def infer_types(spark, sf_dir):
    return spark.createDataFrame([(f.name, S.infer_type(f.dataType)) for f in table(spark, sf_dir, "events").schema], "name string, type string")


@query(
    "SELECT event_id, CAST(trunc(value) AS INTEGER) AS i, value <> 0 AS b, CASE WHEN value = floor(value) THEN CAST(CAST(value AS BIGINT) AS VARCHAR) ELSE CAST(value AS VARCHAR) END AS s, "
    "CAST(event_id AS BIGINT) AS prefix, event_id % 2 = 1 AS t FROM events"
)
def convert_values(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    double, text = T.DoubleType(), T.StringType()
    return e.select(
        "event_id",
        S.convert_value(F.col("value"), double, "int32").alias("i"),
        S.convert_value(F.col("value"), double, "boolean").alias("b"),
        S.convert_value(F.col("value"), double, "byte_array").alias("s"),
        S.convert_value(F.concat(F.lit(" "), F.col("event_id").cast("string"), F.lit("abc")), text, "int64").alias("prefix"),
        S.convert_value((F.col("event_id") % 2).cast("string"), text, "boolean").alias("t"),
    )


# --- E: validation and quality ----------------------------------------------------

_R = validation.ValidationRule


def _messages(rows: DataFrame, rule_list: list[validation.ValidationRule], key: str = "event_id") -> DataFrame:
    return rows.select(key, F.array_join(validation.errors(rows, rule_list), "; ").alias("errors"))


@query("SELECT event_id, CASE WHEN event_id % 17 = 0 THEN 'Field ''id'' is required' ELSE '' END AS errors FROM events")
def validate_required(spark, sf_dir):
    return _messages(event_rows(spark, sf_dir), [_R("id", "required")])


@query("SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'Field ''created_at'' should be of type datetime' ELSE '' END AS errors FROM events")
def validate_type(spark, sf_dir):
    return _messages(event_rows(spark, sf_dir), [_R("created_at", "type", {"type": "datetime"}), _R("value", "type", {"type": "double"}), _R("absent", "type", {"type": "int"})])


@query("SELECT event_id, CASE WHEN value < 5 THEN 'Field ''value'' is below minimum' WHEN value > 100 THEN 'Field ''value'' is above maximum' ELSE '' END AS errors FROM events")
def validate_range(spark, sf_dir):
    return _messages(event_rows(spark, sf_dir), [_R("value", "range", {"min": 5, "max": 100})])


@query("SELECT event_id, CASE WHEN event_type NOT IN ('view', 'click', 'signup') THEN 'Field ''event_type'' is not allowed' ELSE '' END || CASE WHEN event_type = 'error' AND NOT regexp_matches(CAST(event_id AS VARCHAR), '[02468]$') THEN '; ' ELSE '' END || CASE WHEN event_type NOT IN ('view', 'click', 'signup') AND event_type <> 'error' AND NOT regexp_matches(CAST(event_id AS VARCHAR), '[02468]$') THEN '; ' ELSE '' END || CASE WHEN NOT regexp_matches(CAST(event_id AS VARCHAR), '[02468]$') THEN 'Field ''event_id'' does not match' ELSE '' END AS errors FROM events")
def validate_regex_enum(spark, sf_dir):
    return _messages(event_rows(spark, sf_dir), [_R("event_type", "enum", {"values": ["view", "click", "signup"]}), _R("event_id", "regex", {"pattern": "[02468]$"})])


_N_ERR = "(CASE WHEN event_id % 17 = 0 THEN 1 ELSE 0 END + CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END)"


@query(f"SELECT event_id, {_N_ERR} = 0 AS valid, CAST({_N_ERR} AS INTEGER) AS n, round(1.0::DOUBLE - 0.1::DOUBLE * {_N_ERR}, 6) AS score FROM events")
def validation_result(spark, sf_dir):
    v = validation.validate(event_rows(spark, sf_dir))
    return v.select("event_id", "_validation.valid", F.size("_validation.errors").alias("n"), F.round("_quality_score", 6).alias("score"))


@query(f"SELECT {_N_ERR} AS errors, count(*) AS rows, round(avg(1.0::DOUBLE - 0.1::DOUBLE * {_N_ERR}), 6) AS score FROM events GROUP BY 1")
def quality_score(spark, sf_dir):
    v = validation.validate(event_rows(spark, sf_dir))
    return v.groupBy(F.size("_validation.errors").alias("errors")).agg(F.count("*").alias("rows"), F.round(F.avg("_quality_score"), 6).alias("score"))


@query("SELECT c_custkey, c_custkey % 7 <> 0 AS valid, CASE WHEN c_custkey % 7 = 0 THEN 'Required field missing: c_mktsegment' ELSE '' END AS errors, CASE WHEN c_custkey % 7 = 0 THEN 'Unknown field: c_custkey' ELSE 'Unknown field: c_custkey; Type mismatch: c_acctbal' END AS warnings FROM customer")
def schema_validator(spark, sf_dir):
    want = T.StructType([T.StructField("c_mktsegment", T.StringType(), False), T.StructField("c_acctbal", T.LongType()), T.StructField("c_phone", T.StringType())])
    v = validation.validate_schema(nulled_customers(spark, sf_dir).select("c_custkey", "c_acctbal", "c_mktsegment"), want)
    return v.select("c_custkey", "_schema_check.valid", F.array_join("_schema_check.errors", "; ").alias("errors"), F.array_join("_schema_check.warnings", "; ").alias("warnings"))


_ASOF = "2024-01-15"


def _scored(spark, sf_dir, **more):
    c = nulled_customers(spark, sf_dir).select("c_custkey", "c_acctbal", "c_mktsegment")
    return quality.check_quality(c, ["c_custkey", "c_acctbal", "c_mktsegment"], F.lit(_ASOF).cast("timestamp"), **more)


@query("SELECT c_custkey, round(CASE WHEN c_custkey % 7 = 0 THEN 1.0 / 3 ELSE 1.0 END, 6)::DOUBLE AS score, c_custkey % 7 <> 0 AS passed FROM customer")
def dq_completeness(spark, sf_dir):
    return _scored(spark, sf_dir).select("c_custkey", F.round("_quality.completeness", 6).alias("score"), F.col("_quality.checks")[0]["passed"].alias("passed"))


@query("SELECT doc_id, (CASE WHEN strlen(text) < 10000 THEN 2 ELSE 1 END / 2)::DOUBLE AS score, strlen(text) < 10000 AS passed FROM documents")
def dq_validity(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    q = quality.check_quality(d, ["doc_id", "text"], F.lit(_ASOF).cast("timestamp"))
    return q.select("doc_id", F.col("_quality.validity").alias("score"), F.col("_quality.checks")[1]["passed"].alias("passed"))


@query("SELECT event_id, CASE WHEN event_id % 5 <> 0 AND event_id % 3 <> 0 AND date_trunc('second', ts) < TIMESTAMP '2024-01-16' THEN 1.0 ELSE 0.0 END::DOUBLE AS score FROM events")
def dq_timeliness(spark, sf_dir):
    """Every third time lies 400 days back, beyond the lower bound."""
    shifted = event_rows(spark, sf_dir).withColumn("created_at", F.when((F.col("event_id") % 3 == 0) & (F.col("created_at") != "junk"), S.rfc3339(F.col("ts") - F.expr("interval 400 days"))).otherwise(F.col("created_at")))
    q = quality.check_quality(shifted, ["event_id", "created_at"], F.lit(_ASOF).cast("timestamp"))
    return q.select("event_id", F.col("_quality.timeliness").alias("score"))


@query("SELECT c_custkey, 'Completeness: ' || CASE WHEN c_custkey % 7 = 0 THEN '33.33% (1/3' ELSE '100.00% (3/3' END || ' fields)' AS completeness, 'Validity: 100.00% (3/3 fields valid)' AS validity, 'No timestamp fields to check' AS timeliness FROM customer")
def dq_descriptions(spark, sf_dir):
    told = _scored(spark, sf_dir)
    return told.select("c_custkey", *(F.col("_quality.checks")[k]["description"].alias(n) for k, n in enumerate(("completeness", "validity", "timeliness"))))


@query("SELECT doc_id, CASE WHEN strlen(text) < 10000 THEN 'Validity: 100.00% (2/2 fields valid)' ELSE 'Validity: 50.00% (1/2 fields valid), errors: [Field text: string too long]' END AS validity FROM documents")
def dq_error_list(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    q = quality.check_quality(d, ["doc_id", "text"], F.lit(_ASOF).cast("timestamp"))
    return q.select("doc_id", F.col("_quality.checks")[1]["description"].alias("validity"))


@query("SELECT c_custkey, round((CASE WHEN c_custkey % 7 = 0 THEN 1.0::DOUBLE / 3 ELSE 1.0::DOUBLE END + 1) / 2, 6) AS score, 1.0::DOUBLE AS uniqueness FROM customer")
def dq_consistency(spark, sf_dir):
    return _scored(spark, sf_dir).select("c_custkey", F.round("_quality.consistency", 6).alias("score"), "_quality.uniqueness")


@query("SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN 0.0 ELSE 1.0 END::DOUBLE AS validity, CASE WHEN c_custkey % 11 = 0 THEN 'data_presence' ELSE 'completeness' END AS first_check FROM customer")
def dq_data_presence(spark, sf_dir):
    q = _scored(spark, sf_dir, present=F.col("c_custkey") % 11 != 0)
    return q.select("c_custkey", "_quality.validity", F.col("_quality.checks")[0]["name"].alias("first_check"))


@query("SELECT c_custkey, coalesce(c_acctbal > 0, false) AS passed, 4 AS checks FROM (" + _NULLED + ")")
def dq_custom_check(spark, sf_dir):
    own = lambda df: F.struct(F.coalesce(F.col("c_acctbal") > 0, F.lit(False)).alias("passed"), F.lit(1.0).alias("score"), F.lit("in credit").alias("description"))
    q = _scored(spark, sf_dir, custom={"credit": own})
    return q.select("c_custkey", F.col("_quality.checks")[3]["passed"].alias("passed"), F.size("_quality.checks").alias("checks"))


@query("SELECT count(DISTINCT user_id)::DOUBLE / count(user_id) AS uniqueness FROM events")
def dq_uniqueness(spark, sf_dir):
    return quality.uniqueness(table(spark, sf_dir, "events"), "user_id")


# --- F: layers --------------------------------------------------------------------


@query(f"SELECT CAST(event_id AS VARCHAR) AS _id, {_KIND_SQL} AS type, event_id, value FROM events")
def bronze_payload(spark, sf_dir):
    return layers.payload(layers.to_bronze(event_changes(spark, sf_dir))).select("_id", "type", "_image.event_id", "_image.value")


@query(f"SELECT CAST(event_id AS VARCHAR) AS _id, CASE WHEN event_id % 17 = 0 THEN '' ELSE CAST(event_id AS VARCHAR) END AS id, round(1.0::DOUBLE - 0.1::DOUBLE * {_N_ERR}, 6) AS score FROM events")
def silver_clean(spark, sf_dir):
    return _silver(spark, sf_dir).select("_id", "_cleaned_data.id", F.round("_quality_score", 6).alias("score"))


def _silver(spark, sf_dir, minimum: float | None = None):
    ch = event_changes(spark, sf_dir)
    ch = filters.apply_filters(ch, [filters.column_filter("value", ">", minimum)]) if minimum is not None else ch
    return layers.to_silver(layers.to_bronze(ch), processed_at=F.lit(_ASOF).cast("timestamp"))


def _gold(spark, sf_dir, grain):
    return layers.to_gold(_silver(spark, sf_dir, 5), grain, F.col("_ingested_at")).drop("database", "table", "grain")


_GOLD = f"SELECT {{dims}}, count(*) AS record_count, round(avg(1.0::DOUBLE - 0.1::DOUBLE * {_N_ERR}), 6) AS avg_quality FROM events WHERE value > 5 GROUP BY {{keys}}"


@query(_GOLD.format(dims="strftime(ts, '%Y-%m-%d') AS date", keys="1"))
def gold_daily(spark, sf_dir):
    return _gold(spark, sf_dir, "daily")


@query(_GOLD.format(dims="CAST(hour(ts) AS INTEGER) AS \"hour\", strftime(ts, '%Y-%m-%d') AS date", keys="1, 2"))
def gold_hourly(spark, sf_dir):
    return _gold(spark, sf_dir, "hourly")


@query(_GOLD.format(dims='CAST(week(ts) AS INTEGER) AS "week", CAST(year(ts) AS INTEGER) AS "year"', keys="1, 2"))
def gold_weekly(spark, sf_dir):
    return _gold(spark, sf_dir, "weekly")


@query(_GOLD.format(dims='CAST(month(ts) AS INTEGER) AS "month", CAST(year(ts) AS INTEGER) AS "year"', keys="1, 2"))
def gold_monthly(spark, sf_dir):
    return _gold(spark, sf_dir, "monthly")


@query(_GOLD.format(dims="'app' AS database", keys="1"))
def gold_no_grain(spark, sf_dir):
    return layers.to_gold(_silver(spark, sf_dir, 5), "all", F.col("_ingested_at")).drop("table", "grain")


@query("SELECT l.layer, d.date FROM (SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS date FROM orders) d, (VALUES ('bronze', 30), ('silver', 90), ('gold', 365)) AS l(layer, days) WHERE CAST(d.date AS DATE) < DATE '1999-01-01' - CAST(l.days AS INTEGER)")
def retention_expired(spark, sf_dir):
    dates = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date")).distinct()
    dates = dates.unionAll(spark.createDataFrame([("_catalog",)], "date string"))
    parts = [layers.expired(dates, name, F.lit("1999-01-01")).select(F.lit(name).alias("layer"), "date") for name in layers.LAYERS]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


# --- G: statistics ----------------------------------------------------------------


@query(
    "SELECT 'c_acctbal' AS \"column\", count(*) AS num_values, count(*) - count(c_acctbal) AS null_count, count(DISTINCT c_acctbal) AS distinct_count, CAST(min(c_acctbal) AS VARCHAR) AS min, CAST(max(c_acctbal) AS VARCHAR) AS max, round(avg(c_acctbal), 6) AS avg FROM (" + _NULLED + ") "
    "UNION ALL SELECT 'c_mktsegment', count(*), count(*) - count(c_mktsegment), count(DISTINCT c_mktsegment), min(c_mktsegment), max(c_mktsegment), NULL FROM (" + _NULLED + ")"
)
def column_stats(spark, sf_dir):
    return stats.column_stats(nulled_customers(spark, sf_dir), ["c_acctbal", "c_mktsegment"])


@query("SELECT count(*) AS num_values, count(*) FILTER (WHERE c_custkey % 7 = 0) AS null_count, min(c_acctbal) FILTER (WHERE c_custkey % 7 <> 0) AS min, max(c_acctbal) FILTER (WHERE c_custkey % 7 <> 0) AS max FROM customer")
def row_group_rollup(spark, sf_dir):
    return stats.rolled_up(stats.group_stats(nulled_customers(spark, sf_dir).withColumn("g", F.floor(F.col("c_custkey") / 1000)), "c_acctbal", "g"))


def _entries(spark, sf_dir):
    """Partition entries, every third of them added again later with other sizes."""
    o = table(spark, sf_dir, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("m"), "o_orderstatus").agg(F.count("*").alias("record_count"))
    first = o.select(F.concat_ws("/", "o_orderstatus", "m").alias("path"), F.col("o_orderstatus").alias("table"), F.lit(1).alias("file_count"), "record_count", (F.col("record_count") * 10).alias("size_bytes"), F.lit(1).alias("created_at"))
    again = first.where("record_count % 3 = 0").withColumns({"file_count": F.lit(2), "size_bytes": F.col("record_count") * 7, "created_at": F.lit(2)})
    return first.unionAll(again)


_ENTRIES_SQL = "SELECT o_orderstatus || '/' || strftime(o_orderdate, '%Y-%m') AS path, o_orderstatus AS \"table\", count(*) AS record_count, CASE WHEN count(*) % 3 = 0 THEN 2 ELSE 1 END AS file_count, count(*) * CASE WHEN count(*) % 3 = 0 THEN 7 ELSE 10 END AS size_bytes, CASE WHEN count(*) % 3 = 0 THEN 2 ELSE 1 END AS created_at FROM orders GROUP BY 1, 2"


@query(f'SELECT "table", CAST(sum(file_count) AS BIGINT) AS files, CAST(sum(record_count) AS BIGINT) AS records, CAST(sum(size_bytes) AS BIGINT) AS bytes FROM ({_ENTRIES_SQL}) GROUP BY 1')
def partition_totals(spark, sf_dir):
    return stats.partition_totals(_entries(spark, sf_dir))


@query(_ENTRIES_SQL)
def latest_partition_entry(spark, sf_dir):
    return stats.latest_entries(_entries(spark, sf_dir))


@query("SELECT 'app' AS database, 'events' AS \"table\", count(*) AS rows FROM events UNION ALL SELECT 'tpch', 'orders', count(*) FROM orders")
def table_row_counts(spark, sf_dir):
    return stats.table_counts(event_changes(spark, sf_dir).select("database", "table").unionAll(_orders(spark, sf_dir).select("database", "table")))


# --- H: schemas -------------------------------------------------------------------

_BASE = T.StructType().add("id", T.LongType(), False).add("name", T.StringType(), False).add("age", T.IntegerType(), True)
_SHAPES = {
    "add_nullable": T.StructType(_BASE.fields[:]).add("email", T.StringType(), True),
    "add_required": T.StructType(_BASE.fields[:]).add("email", T.StringType(), False),
    "change_type": T.StructType().add("id", T.IntegerType(), False).add("name", T.StringType(), False).add("age", T.IntegerType(), True),
    "tighten": T.StructType().add("id", T.LongType(), False).add("name", T.StringType(), False).add("age", T.IntegerType(), False),
    "relax": T.StructType().add("id", T.LongType(), False).add("name", T.StringType(), True).add("age", T.IntegerType(), True),
    "remove": T.StructType().add("id", T.LongType(), False).add("name", T.StringType(), False),
}


@query("SELECT * FROM (VALUES ('added', 'email'), ('removed', 'age'), ('modified', 'name')) AS t(kind, \"column\")")
def schema_diff(spark, sf_dir):
    d = registry.diff(_BASE, T.StructType().add("id", T.LongType(), False).add("name", T.StringType(), True).add("email", T.StringType()))
    return spark.createDataFrame([(k, c) for k in ("added", "removed", "modified") for c in getattr(d, k)], "kind string, column string")


@query(
    "SELECT s.shape, m.mode, CASE m.mode WHEN 'NONE' THEN true WHEN 'FORWARD' THEN s.shape <> 'change_type' WHEN 'UNKNOWN' THEN false ELSE s.shape NOT IN ('add_required', 'change_type', 'tighten') END AS compatible "
    "FROM (VALUES ('add_nullable'), ('add_required'), ('change_type'), ('tighten'), ('relax'), ('remove')) AS s(shape), (VALUES ('BACKWARD'), ('FORWARD'), ('FULL'), ('NONE'), ('UNKNOWN')) AS m(mode)"
)
def schema_compat_matrix(spark, sf_dir):
    return spark.createDataFrame([(s, m, not registry.problems(_BASE, x, m)) for s, x in _SHAPES.items() for m in (*registry.MODES, "UNKNOWN")], "shape string, mode string, compatible boolean")


# --- I: sinks ---------------------------------------------------------------------


@query(f"SELECT CAST(event_id AS VARCHAR) AS id, {_KIND_SQL} AS type, value FROM events")
def json_round_trip(spark, sf_dir):
    ch, path = event_changes(spark, sf_dir), paths.scratch(spark, "json")
    writers.write_changes(ch, path, "json", "date", "gzip")
    return with_effective_image(readers.read_changes(spark, path, "json", _ddl(ch))).select("id", "type", "image.value")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


@query("SELECT CAST(event_id AS VARCHAR) AS id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS timestamp, CASE WHEN event_type <> 'error' THEN CAST(event_id AS VARCHAR) END AS after_id, CASE WHEN event_type <> 'error' THEN value END AS after_value, CASE WHEN event_type <> 'signup' THEN CAST(event_id AS VARCHAR) END AS before_id FROM events")
def csv_round_trip(spark, sf_dir):
    path = paths.scratch(spark, "csv")
    writers.write_changes(event_changes(spark, sf_dir), path, "csv", "none")
    back = writers.read_back(spark, path, "csv", "id string, timestamp string, type string, database string, table string, after string, before string")
    of = lambda image, name, kind: F.from_json(image, f"{name} {kind}")[name]
    return back.select("id", "timestamp", of("after", "event_id", "string").alias("after_id"), of("after", "value", "double").alias("after_value"), of("before", "event_id", "string").alias("before_id"))


@query("SELECT o_orderkey, o_orderstatus, o_totalprice, 'orders' AS _table FROM orders")
def parquet_round_trip(spark, sf_dir):
    path = paths.scratch(spark, "tables")
    writers.write_tables(changes_of(table(spark, sf_dir, "orders"), "o_orderkey", "orders", ["o_orderkey", "o_orderstatus", "o_totalprice"]), path, "zstd")
    return spark.read.parquet(path).select("o_orderkey", "o_orderstatus", "o_totalprice", "_table")


@query("SELECT codec, count(*) AS rows, CAST(sum(n_nationkey) AS BIGINT) AS total FROM nation, (VALUES ('none'), ('snappy'), ('gzip'), ('zstd')) AS c(codec) GROUP BY 1")
def codec_round_trip(spark, sf_dir):
    out = None
    for codec in ("none", "snappy", "gzip", "zstd"):
        path = paths.scratch(spark, codec)
        writers.writer(table(spark, sf_dir, "nation"), "parquet", codec).save(path)
        one = spark.read.parquet(path).agg(F.lit(codec).alias("codec"), F.count("*").alias("rows"), F.sum("n_nationkey").alias("total"))
        out = one if out is None else out.unionAll(one)
    return out


@query("SELECT CAST(sum((n + 499) // 500) AS BIGINT) AS files, CAST(sum(n) AS BIGINT) AS rows FROM (SELECT count(*) AS n FROM events GROUP BY event_id % 16)")
def rotation_file_count(spark, sf_dir):
    path = paths.scratch(spark, "rotation")
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", (F.col("event_id") % 16).alias("part")).repartition("part")
    writers.writer(rows, "json", "none", 500, partitions=["part"]).save(path)
    return spark.read.schema("event_id bigint").json(path).select("event_id", "_metadata.file_path").agg(F.countDistinct("file_path").alias("files"), F.count("*").alias("rows"))


@query("SELECT strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H') AS \"hour\", count(*) AS rows FROM events GROUP BY 1, 2")
def hour_partition_layout(spark, sf_dir):
    path = paths.scratch(spark, "hours")
    writers.write_changes(event_changes(spark, sf_dir).select("id", "timestamp"), path, "parquet", "hour")
    back = spark.read.parquet(path).select(F.regexp_extract("_metadata.file_path", "date=([^/]*)", 1).alias("date"), F.regexp_extract("_metadata.file_path", "hour=([^/]*)", 1).alias("hour"))
    return back.groupBy("date", "hour").agg(F.count("*").alias("rows"))


# --- J: streams -------------------------------------------------------------------


def _streamed(spark, sf_dir, runs: int = 1):
    """Events through the stream pipeline into a table, in `runs` runs over one checkpoint."""
    base = paths.scratch(spark, "stream")
    rows = event_rows(spark, sf_dir).select("event_id", "id", "created_at", "event_type", "value")
    letters = ingest.DeadLetters(f"{base}/dead")
    reason = F.when(S.parse_time(F.col("created_at")).isNull(), F.lit("created_at cannot be read, token=abc"))
    schema = rows.schema
    for run in range(runs):
        part = rows.where(F.col("event_id") % runs == run) if runs > 1 else rows
        part.write.mode("append").parquet(f"{base}/in")
        source = spark.readStream.schema(schema).parquet(f"{base}/in")
        sink = lambda df, n: df.withColumn("batch", F.lit(n)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{base}/out")
        ingest.start(source, ingest.Pipeline(), sink, f"{base}/checkpoint", reason, letters).awaitTermination()
    return spark.read.schema(schema).parquet(f"{base}/out"), letters.read(spark)


@query("SELECT event_id, value FROM events WHERE event_id % 5 <> 0")
def stream_equals_batch(spark, sf_dir):
    return _streamed(spark, sf_dir)[0].select("event_id", "value")


@query("SELECT event_id, value FROM events WHERE event_id % 5 <> 0")
def stream_resume(spark, sf_dir):
    return _streamed(spark, sf_dir, 2)[0].select("event_id", "value")


@query("SELECT event_id, 'created_at cannot be read, [REDACTED]' AS failure_reason FROM events WHERE event_id % 5 = 0")
def dead_letter_split(spark, sf_dir):
    return _streamed(spark, sf_dir)[1].select("original_change.event_id", "failure_reason")


@query("SELECT event_id, event_type FROM events WHERE event_id % 5 = 0")
def dead_letter_replay(spark, sf_dir):
    return readers.replay_dead_letters(_streamed(spark, sf_dir)[1]).select("event_id", "event_type")


@query("SELECT CAST(n AS INTEGER) AS attempt, CAST(least(500, 100 * pow(2, n)) AS BIGINT) AS delay_ms FROM range(0, 6) AS t(n)")
def backoff_schedule(spark, sf_dir):
    return spark.range(6).select(F.col("id").cast("int").alias("attempt"), S.backoff_ms(F.col("id"), 100, 500).alias("delay_ms"))


@query("SELECT strftime(time_bucket(INTERVAL 1 day, ts), '%Y-%m-%d') AS day, event_type, count(*) AS rows FROM events GROUP BY 1, 2")
def windowed_counts(spark, sf_dir):
    w = ingest.windowed_counts(table(spark, sf_dir, "events"), "ts", "1 day", "1 hour", "event_type")
    return w.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", "rows")


@query("SELECT event_id, value FROM events")
def dedup_events(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "value", "ts")
    return ingest.without_repeats(e.unionAll(e.where("event_id % 10 = 0")), "event_id", "ts", "1 hour").select("event_id", "value")


@query("SELECT user_id AS key, arg_max(value, event_id) AS value FROM events GROUP BY 1 HAVING arg_max(event_type, event_id) <> 'error'")
def latest_state(spark, sf_dir):
    ch = event_changes(spark, sf_dir).withColumn("image", F.coalesce("after", "before"))
    return ingest.latest_state(ch, F.col("image.user_id"), [F.col("image.event_id")]).select("key", "after.value")


# --- K: layers, tables and jobs on disk -------------------------------------------

_IMAGE = "event_id bigint, id string, created_at string, user_id bigint, event_type string, value double"


def _lake(spark, sf_dir) -> Lake:
    """Events captured in bronze, twice under one batch id: the second write replaces the first."""
    found = Lake(spark, paths.scratch(spark, "lake"), Catalog(spark, paths.scratch(spark, "lake-catalog")))
    for _ in range(2):
        found.write_bronze(event_changes(spark, sf_dir), "b1", F.col("timestamp"))
    return found


@query(f"SELECT CAST(event_id AS VARCHAR) AS id, {_KIND_SQL} AS type, event_id, 'app' AS database, 'events' AS \"table\", strftime(ts, '%Y-%m-%d') AS date FROM events")
def bronze_write(spark, sf_dir):
    rows = with_effective_image(_lake(spark, sf_dir).read_bronze().select("_id", "database", "table", "date", "_raw_data.type", "_raw_data.before", "_raw_data.after"))
    return rows.select(F.col("_id").alias("id"), "type", F.get_json_object("image", "$.event_id").cast("bigint").alias("event_id"), "database", "table", "date")


@query("SELECT 'app.events' AS name, strftime(ts, '%Y-%m-%d') AS date, CAST(count(*) AS BIGINT) AS records FROM events GROUP BY 2")
def bronze_catalog(spark, sf_dir):
    held = _lake(spark, sf_dir).catalog
    rows = [(n, p["values"]["date"], p["record_count"]) for n in held.names() for p in held.get(n)["partitions"].values()]
    return spark.createDataFrame(rows, "name string, date string, records bigint")


def _silver_lake(spark, sf_dir) -> Lake:
    found = _lake(spark, sf_dir)
    found.bronze_to_silver(_IMAGE, "events", processed_at=F.lit(_ASOF).cast("timestamp"))
    return found


@query(f"SELECT CAST(event_id AS VARCHAR) AS _id, CASE WHEN event_id % 17 = 0 THEN '' ELSE CAST(event_id AS VARCHAR) END AS id, value, round(1.0::DOUBLE - 0.1::DOUBLE * {_N_ERR}, 6) AS score, strftime(ts, '%Y-%m-%d') AS date, 'app' AS database FROM events")
def silver_write(spark, sf_dir):
    silver = _silver_lake(spark, sf_dir).read_silver()
    return silver.select("_id", "_cleaned_data.id", "_cleaned_data.value", F.round("_quality_score", 6).alias("score"), F.col("date").cast("string").alias("date"), "database")


@query(f"SELECT count(*) AS read, count(*) AS written, CAST(0 AS BIGINT) AS rejected, round(avg(1.0::DOUBLE - 0.1::DOUBLE * {_N_ERR}), 6) AS avg_quality FROM events")
def run_metrics(spark, sf_dir):
    m = _silver_lake(spark, sf_dir).metrics
    return spark.createDataFrame([(m["read"], m["written"], m["rejected"], round(m["avg_quality"], 6))], "read bigint, written bigint, rejected bigint, avg_quality double")


@query(_GOLD.replace(" WHERE value > 5", "").format(dims="strftime(ts, '%Y-%m-%d') AS date", keys="1"))
def gold_write(spark, sf_dir):
    return _silver_lake(spark, sf_dir).silver_to_gold("daily").select(F.col("date").cast("string").alias("date"), "record_count", "avg_quality")


@query("SELECT CAST(month(ts) AS INTEGER) AS \"month\", max(value) AS best, CAST(count(DISTINCT event_type) AS BIGINT) AS \"year\" FROM events WHERE event_id % 17 <> 0 AND event_id % 5 <> 0 GROUP BY 1")
def gold_own_aggregates(spark, sf_dir):
    """Aggregates of the caller's; one is named like a dimension and takes its place."""
    wanted = {"best": F.max("_cleaned_data.value"), "year": F.countDistinct("_cleaned_data.event_type")}
    return _silver_lake(spark, sf_dir).silver_to_gold("monthly", aggregates=wanted, valid_only=True).select("month", "best", "year")


@query("SELECT o_orderkey, o_orderstatus, o_totalprice, 'orders' AS _table FROM orders")
def catalogued_write(spark, sf_dir):
    return _managed(spark, sf_dir).read_table("tpch", "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "_table")


def _managed(spark, sf_dir) -> StorageManager:
    """Two tables in a batch that is written twice, then one of them with a new column in a second batch."""
    local = config.DEFAULTS["storage"]["local"] | {"file_format": "parquet", "compression": "zstd", "partition_strategy": "none"}
    manager = StorageManager(spark, paths.scratch(spark, "managed"), local)
    orders = changes_of(table(spark, sf_dir, "orders"), "o_orderkey", "orders", ["o_orderkey", "o_orderstatus", "o_totalprice"])
    for _ in range(2):
        manager.write_table(orders, "tpch", "orders", "0")
    for batch, names in enumerate((["n_nationkey", "n_name"], ["n_nationkey", "n_name", "n_regionkey"])):
        manager.write(changes_of(table(spark, sf_dir, "nation"), "n_nationkey", "nation", names), str(batch))
    return manager


@query("SELECT 'tpch.nation' AS name, 2 AS version, 2 AS batches, CAST(2 * count(*) AS BIGINT) AS records FROM nation UNION ALL SELECT 'tpch.orders', 1, 1, count(*) FROM orders")
def catalog_entries(spark, sf_dir):
    m = _managed(spark, sf_dir)
    totals = {n: m.catalog.partition_totals(n) for n in m.catalog.names()}
    return spark.createDataFrame([(n, m.registry.versions(n)[-1], t["partitions"], t["record_count"]) for n, t in totals.items()], "name string, version int, batches int, records bigint")


def _job(spark, sf_dir, **local):
    """A job from settings alone: change files in, filters, a mask, files out."""
    base = paths.scratch(spark, "job")
    ch = event_changes(spark, sf_dir)
    kept = [n for n in ("event_id", "event_type", "value")]
    ch.withColumns({i: F.when(F.col(i).isNotNull(), F.struct(*(F.col(f"{i}.{n}") for n in kept))) for i in ("before", "after")}).write.json(f"{base}/in")
    settings = config.from_dict({
        "source": {"type": "file", "file": {"path": f"{base}/in", "image_schema": "event_id: bigint, event_type: string, value: double"}},
        "storage": {"local": {"base_path": f"{base}/out", **local}},
        "checkpoint": {"storage_path": f"{base}/checkpoint"},
        "processing": {"filters": ["value > 50", "event_type != 'click'"], "transforms": ["mask:event_type:**:2"], "dead_letter_queue_path": f"{base}/dead"},
    })
    job.start(spark, settings, once=True).awaitTermination()
    return f"{base}/out", job.change_schema(settings["source"]["file"]["image_schema"])


_JOB = "SELECT event_id, substr(event_type, 1, 2) || '**' AS event_type, value FROM events WHERE value > 50 AND event_type <> 'click'"


@query(_JOB)
def config_job(spark, sf_dir):
    out, schema = _job(spark, sf_dir)
    return with_effective_image(readers.read_changes(spark, f"{out}/json", "json", schema)).select("image.event_id", "image.event_type", "image.value")


@query(_JOB)
def config_job_parquet(spark, sf_dir):
    out, _ = _job(spark, sf_dir, file_format="parquet", compression="snappy", partition_strategy="hour")
    return spark.read.parquet(f"{out}/parquet/app/events").select("event_id", "event_type", "value")


@query("SELECT event_id, 'OSError: no room' AS failure_reason, 1 AS retry_count, true AS timed FROM events")
def dead_letters_of_lost_batches(spark, sf_dir):
    """A sink that fails to its last attempt: the batch becomes dead letters and the stream ends well."""
    base = paths.scratch(spark, "lost")
    rows = table(spark, sf_dir, "events").select("event_id", "event_type")
    rows.write.parquet(f"{base}/in")
    letters = ingest.DeadLetters(f"{base}/dead")

    def sink(df, n):
        raise OSError("no room")

    ingest.start(spark.readStream.schema(rows.schema).parquet(f"{base}/in"), ingest.Pipeline(), sink, f"{base}/checkpoint", None, letters, 1, None, 1, 2).awaitTermination()
    return letters.read(spark).select("original_change.event_id", "failure_reason", F.col("retry_count").cast("int").alias("retry_count"), F.col("timestamp").isNotNull().alias("timed"))


def _runs(spark, sf_dir, plan, parts, mode):
    """A streaming plan over files that come in turn, one run for each over a checkpoint; its rows with their run."""
    base = paths.scratch(spark, "runs")
    for part in parts:
        part.write.mode("append").parquet(f"{base}/in")
        source = spark.readStream.schema(part.schema).parquet(f"{base}/in")
        sink = lambda df, n: df.withColumn("batch", F.lit(n)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{base}/out")
        plan(source).writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/out")


@query("SELECT strftime(time_bucket(INTERVAL 1 day, ts), '%Y-%m-%d') AS day, event_type, count(*) AS rows FROM events GROUP BY 1, 2")
def stream_windows(spark, sf_dir):
    """All events, then those of the first ten days again: they come too late to count."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    got = _runs(spark, sf_dir, lambda s: ingest.windowed_counts(s, "ts", "1 day", "1 hour", "event_type"), [e, e.where("ts < '2024-01-11'")], "update")
    return got.groupBy(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type").agg(F.max_by("rows", "batch").alias("rows"))


@query("SELECT event_id, value FROM events")
def stream_without_repeats(spark, sf_dir):
    """Every event twice: half of the repeats in the same batch, all events again in a later one."""
    e = table(spark, sf_dir, "events").select("event_id", "value", F.col("ts").cast("timestamp").alias("ts"))
    return _runs(spark, sf_dir, lambda s: ingest.without_repeats(s, "event_id", "ts", "60 days"), [e.unionAll(e.where("event_id % 2 = 0")), e], "append").select("event_id", "value")


@query("SELECT event_id, sha256('+' || event_id || '|:+' || replace(event_type, '|', '||') || '|:' || CASE WHEN event_id % 7 = 0 THEN '-' ELSE '+x' END) AS id, true AS fresh FROM events")
def event_ids(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    null = F.when(F.col("event_id") % 7 != 0, F.lit("x"))
    return e.select("event_id", S.stable_id(F.col("event_id"), F.col("event_type"), null).alias("id"), S.new_id().rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$").alias("fresh"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, event_id % 4 = 0 AS damaged FROM (SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN props END AS props FROM events)")
def json_decoding(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("props", F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("{"), "props")).otherwise(F.col("props")))
    return transforms.parsed(e, "props", "k string").select("event_id", "change.k", F.col("change").isNull().alias("damaged"))


@query("SELECT n_nationkey, '{\"after\":{\"a\":\"' || n_name || '\",\"b\":\"' || n_regionkey || '\"}}' AS json FROM nation")
def json_sorted_keys(spark, sf_dir):
    n = table(spark, sf_dir, "nation").withColumn("after", F.create_map(F.lit("b"), F.col("n_regionkey").cast("string"), F.lit("a"), F.col("n_name")))
    return n.select("n_nationkey", transforms.json_text(n, ["after"]).alias("json"))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
