"""Filters, transforms, comparison and routing on single changes."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import redact as R
from millrace.functions import scalars as S
from millrace.operators import cleaning, filters, rules, transforms, validation
from millrace.sources import readers

SCHEMA = "id string, type string, database string, table string, before struct<status: string, age: int, note: string>, after struct<status: string, age: int, note: string>"


def change(spark, kind="UPDATE", before=None, after=None, table="users"):
    return spark.createDataFrame([("1", kind, "testdb", table, before, after)], SCHEMA)


@pytest.mark.parametrize(
    "op, column, value, literal, keep",
    [
        ("=", "status", "active", "active", True),
        ("=", "status", "inactive", "active", False),
        ("!=", "status", "inactive", "active", True),
        (">", "age", 25, 18, True),
        (">", "age", 15, 18, False),
        ("<", "age", 50, 100, True),
        (">=", "age", 18, 18, True),
        ("<=", "age", 18, 18, True),
        ("=", "nowhere", None, "value", False),
        ("LIKE", "status", "active", "%active%", True),
        ("!=", "note", None, "x", True),
        ("=", "note", None, "x", False),
        ("<", "note", None, 5, True),
        (">", "note", None, 5, False),
    ],
)
def test_column_filter(spark, op, column, value, literal, keep):
    image = tuple(value if c == column else None for c in ("status", "age", "note"))
    df = change(spark, after=image)
    assert df.where(filters.column_filter(column, op, literal)(df)).count() == int(keep)


def test_delete_filters_on_before(spark):
    df = change(spark, "DELETE", before=("deleted", 1, None))
    assert df.where(filters.column_filter("status", "=", "deleted")(df)).count() == 1
    assert df.where(filters.column_filter("status", "=", "active")(df)).count() == 0


@pytest.mark.parametrize(
    "include, exclude, table, keep",
    [
        ([], [], "users", True),
        (["testdb.users", "testdb.orders"], [], "users", True),
        (["users", "orders"], [], "users", True),
        (["testdb.users", "testdb.orders"], [], "products", False),
        ([], ["testdb.logs", "testdb.temp"], "logs", False),
        ([], ["logs", "temp"], "logs", False),
        (["testdb.users"], ["testdb.users"], "users", False),
        ([], ["testdb.logs"], "users", True),
        (["users", "testdb.orders", "products"], [], "orders", True),
        ([], ["logs", "testdb.temp"], "temp", False),
    ],
)
def test_table_routing(spark, include, exclude, table, keep):
    df = change(spark, table=table)
    assert df.where(filters.table_filter(include, exclude)(df)).count() == int(keep)


VALUES = {"n": T.NullType(), "b": T.BooleanType(), "i": T.LongType(), "d": T.DoubleType(), "s": T.StringType()}


@pytest.mark.parametrize(
    "a, b, want",
    [(None, None, 0), (None, 1, -1), (1, None, 1), (5, 5, 0), (3, 5, -1), (5, 3, 1), (3.14, 6.28, -1), ("abc", "def", -1), ("def", "abc", 1), (False, True, -1), (True, False, 1), (5, 5.0, 0), ("3.14", 3.14, 0), (float("nan"), 1.0, 0), ("1e3", 1000, 0), (" 1", 1, -1)],
)
def test_compare(spark, a, b, want):
    ta, tb = S.type_of_literal(a), S.type_of_literal(b)
    assert spark.range(1).select(S.compare_values(F.lit(a), F.lit(b), ta, tb)).first()[0] == want


@pytest.mark.parametrize("value, want", [("test@example.com", "tes***"), ("ab", "***"), (None, None), ("éé", "é***"), ("ééé", "é***"), ("abc", "***")])
def test_mask(spark, value, want):
    df = change(spark, after=(value, 1, None)).transform(transforms.mask_field("status", "***", 3)).transform(transforms.mask_field("nowhere"))
    got = df.first()
    assert got.after.status == want and got.before is None and got.after.age == 1


def test_add_timestamp_to_images_that_are_there(spark):
    now = F.lit("2024-02-03 04:05:06").cast("timestamp")
    got = change(spark, after=("a", 1, None)).transform(transforms.add_timestamp("seen", now)).transform(transforms.add_timestamp("note", now)).first()
    assert got.after.seen == got.after.note == "2024-02-03T04:05:06Z" and got.before is None


def test_map_images(spark):
    df = spark.createDataFrame([("1", "INSERT", None, {"a": "1", "b": None})], "id string, type string, before map<string,string>, after map<string,string>")
    assert df.where(filters.column_filter("b", "!=", "x")(df)).count() == 1
    assert df.where(filters.column_filter("c", "!=", "x")(df)).count() == 0
    got = df.transform(transforms.mask_field("a", "#", 0)).transform(transforms.mask_field("c", "#", 0)).transform(transforms.mask_field("b", "#", 0)).first()
    assert got.after == {"a": "#", "b": None}


def test_rules(spark):
    df = change(spark, after=("active", 20, None))
    for rule, keep in (("age > 18", 1), ("status = 'active'", 1), ("status != \"active\"", 0), ("age <= 19.5", 0)):
        assert df.where(rules.parse_filter(rule)(df)).count() == keep
    assert df.transform(rules.parse_transform("mask:status:***")).first().after.status == "***"
    for bad in ("age", "age ~ 5", ""):
        with pytest.raises(ValueError):
            rules.parse_filter(bad)
    with pytest.raises(ValueError):
        rules.parse_transform("upper:x")


def test_filters_stay_in_one_scan_predicate(spark, sf):
    from millrace.queries import changes_of

    df = changes_of(spark.read.parquet(f"{sf}/orders.parquet"), "o_orderkey", "orders", ["o_orderstatus", "o_totalprice"])
    plan = filters.apply_filters(df, [filters.column_filter("o_orderstatus", "=", "F"), filters.column_filter("o_totalprice", ">", 5)])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("+- *(1) Filter") == 1 and "Python" not in plan and "Exchange" not in plan
    assert "PushedFilters: [IsNotNull(o_orderstatus), IsNotNull(o_totalprice), " in plan and "GreaterThan(o_total" in plan
    assert "o_custkey" not in plan.rsplit("ReadSchema", 1)[1]


@pytest.mark.parametrize(
    "text, want",
    [
        ("password=abc x", "[REDACTED] x"),
        ("password: abc", "[REDACTED]"),
        ("passwd=1 pwd=2", "[REDACTED] [REDACTED]"),
        ("secret=a token=b key=c", "[REDACTED] [REDACTED] [REDACTED]"),
        ("Authorization: Bearer abc.def", "Authorization: [REDACTED]"),
        ("BASIC dXNlcg==", "[REDACTED]"),
        ("user=john&email=j@x.org", "user=john&email=j@x.org"),
    ],
)
def test_redaction(spark, text, want):
    assert spark.range(1).select(R.redact(F.lit(text))).first()[0] == want


def test_clean_and_validate(spark):
    df = spark.createDataFrame([(" a\t", "Ä@X.ORG\n", 5), (None, "", None)], "id string, email string, n int")
    assert [tuple(r) for r in cleaning.clean(df).collect()] == [("a", "Ä@x.org", 5), (None, "", None)]
    V = validation.ValidationRule
    got = validation.validate(df, [V("id", "required"), V("n", "range", {"min": 6, "max": 4}), V("gone", "required"), V("n", "type", {"type": "string"}), V("n", "odd")]).collect()
    assert got[0]._validation.errors == ["Field 'n' is below minimum", "Field 'n' is above maximum", "Field 'gone' is required", "Field 'n' should be of type string"]
    assert got[1]._validation.errors == ["Field 'id' is required", "Field 'gone' is required"] and abs(got[1]._quality_score - 0.8) < 1e-9
    assert validation.validate(df, []).first()._validation.valid


def test_times_in_text(spark):
    for text, good in (("2024-01-02T03:04:05Z", True), ("2024-01-02T03:04:05.123456+01:00", True), ("2024-01-02T03:04:05", True), ("2024-01-02 03:04:05", True), ("2024-01-02", True), ("junk", False), ("2024-13-02", False)):
        assert spark.range(1).select(S.parse_time(F.lit(text)).isNotNull()).first()[0] == good


def test_rows_to_map(spark):
    df = spark.range(1).select(F.array(F.lit("1"), F.lit("Alice"), F.lit("x")).alias("v"))
    assert df.select(readers.rows_to_map(F.col("v"), ["id", "name"])).first()[0] == {"id": "1", "name": "Alice"}
    assert df.select(readers.rows_to_map(F.slice("v", 1, 1), ["id", "name"])).first()[0] == {"id": "1"}
    assert df.select(readers.rows_to_map(F.slice("v", 1, 2))).first()[0] == {"col_0": "1", "col_1": "Alice"}
    with pytest.raises(ValueError):
        readers.reader_for("oracle")
