"""The type lattice, rows in a merged shape, schemas of JSON text."""

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators import evolution
from tidelog.operators.evolution import SchemaConflict, conform, evolve_union, merge_schemas, schema_of_json, schema_rows, typed_items, wider


@pytest.fixture(autouse=True)
def session(spark):
    """Type texts are read by the session."""


def ddl(text):
    return T.StructType.fromDDL(f"x {text}")["x"].dataType


@pytest.mark.parametrize("left, right, common", [
    ("int", "bigint", "bigint"), ("tinyint", "smallint", "smallint"), ("bigint", "double", "double"), ("int", "float", "double"),
    ("float", "float", "float"), ("decimal(6,1)", "decimal(5,3)", "decimal(8,3)"), ("int", "decimal(4,2)", "decimal(12,2)"),
    ("decimal(38,0)", "decimal(20,10)", "double"), ("date", "timestamp", "timestamp"), ("void", "string", "string"),
    ("array<int>", "array<bigint>", "array<bigint>"), ("map<string,int>", "map<string,double>", "map<string,double>"),
    ("struct<a:int,b:struct<c:float>>", "struct<b:struct<c:double,d:string>>", "struct<a:int,b:struct<c:double,d:string>>"),
    ("array<struct<a:int>>", "array<struct<b:int>>", "array<struct<a:int,b:int>>"),
])
def test_wider_types(left, right, common):
    assert wider(ddl(left), ddl(right)) == ddl(common)
    if "struct" not in left:
        assert wider(ddl(right), ddl(left)) == ddl(common)


def test_lattice_laws():
    """The common type of several does not depend on their order, for numbers that fit; merging again changes nothing."""
    kinds = [ddl(t) for t in ("tinyint", "int", "bigint", "float", "double", "decimal(9,2)", "decimal(20,4)")]
    for a in kinds:
        assert wider(a, a) == a
        for b in kinds:
            joined = wider(a, b)
            assert joined == wider(b, a) and wider(joined, a) == joined == wider(joined, b)


@pytest.mark.parametrize("left, right", [("string", "int"), ("boolean", "int"), ("struct<a:int>", "array<int>"), ("date", "bigint")])
def test_conflicts(left, right):
    with pytest.raises(SchemaConflict, match="deep.at"):
        wider(ddl(left), ddl(right), path="deep.at")
    assert wider(ddl(left), ddl(right), conflicts_to_text=True) == T.StringType()


def test_merged_names_and_nullability():
    have = T.StructType.fromDDL("id bigint not null, who struct<Name:string not null> not null, only int not null")
    given = T.StructType.fromDDL("ID int not null, WHO struct<name:string not null, age:int not null> not null")
    merged = merge_schemas(have, given, case_insensitive=True)
    assert merged.names == ["id", "who", "only"] and merged["who"].dataType.names == ["Name", "age"]
    assert not merged["id"].nullable and merged["only"].nullable and not merged["who"].nullable
    assert not merged["who"].dataType["Name"].nullable and merged["who"].dataType["age"].nullable
    assert merge_schemas(have, given).names == ["id", "who", "only", "ID", "WHO"]
    eased = merge_schemas(have, given, case_insensitive=True, force_optional=True)
    assert all(f.nullable for f in [*eased.fields, *eased["who"].dataType.fields])
    with pytest.raises(SchemaConflict, match="one name"):
        merge_schemas(T.StructType.fromDDL("a int, A int"), given, case_insensitive=True)


def test_rows_in_the_merged_shape(spark):
    left = spark.sql("SELECT 1 AS id, named_struct('n', 2, 'in', named_struct('a', CAST(1.5 AS FLOAT))) AS s, array(named_struct('x', 1)) AS l, map('k', 1) AS m "
                     "UNION ALL SELECT 2, NULL, NULL, NULL")
    right = spark.sql("SELECT CAST(3000000000 AS BIGINT) AS ID, named_struct('IN', named_struct('b', 'z', 'A', 2.5D)) AS S, "
                      "array(named_struct('y', 'w'), NULL) AS L, map('k', 2.5D) AS M, 'new' AS extra")
    rows = {r["id"]: r for r in evolve_union(left, right, case_insensitive=True).collect()}
    assert rows[1].asDict(recursive=True) == {"id": 1, "s": {"n": 2, "in": {"a": 1.5, "b": None}}, "l": [{"x": 1, "y": None}], "m": {"k": 1.0}, "extra": None}
    assert rows[2].asDict() == {"id": 2, "s": None, "l": None, "m": None, "extra": None}
    assert rows[3_000_000_000].asDict(recursive=True) == {
        "id": 3_000_000_000, "s": {"n": None, "in": {"a": 2.5, "b": "z"}}, "l": [{"x": None, "y": "w"}, None], "m": {"k": 2.5}, "extra": "new"}
    text = evolve_union(left.select("s"), spark.sql("SELECT 'plain' AS s"), conflicts_to_text=True)
    assert {r["s"] for r in text.collect()} == {'{"n":2,"in":{"a":1.5}}', None, "plain"}
    assert conform(left, T.StructType.fromDDL("id decimal(5,1)")).first()["id"] == Decimal("1.0")


def texts(spark, *values):
    return spark.createDataFrame([(v if v is None or isinstance(v, str) else json.dumps(v), 1) for v in values], "record string, A int")


def test_schema_of_json(spark):
    rows = texts(spark, [{"a": 1, "b": {"c": "x", "d": None}, "l": [1, 2.5]}, {"a": 2.5, "b": {"c": "y"}, "l": [], "mixed": 1}],
                 {"a": 3, "b": {"c": "z"}, "e": {}, "mixed": "t", "VOID": 1, "a`b c": True, "nothing": None}, "no JSON", None, 7, [])
    found = schema_of_json(rows, "record")
    assert {(p, t): n for p, t, n in schema_rows(found)} == {
        ("a", "double"): False, ("b", "struct"): False, ("b.c", "string"): False, ("b.d", "string"): True, ("l", "array"): True,
        ("e", "string"): True, ("mixed", "string"): True, ("VOID", "bigint"): True, ("a`b c", "boolean"): True, ("nothing", "string"): True}
    assert found["l"].dataType.elementType == T.DoubleType()
    assert schema_of_json(rows.limit(0), "record") == T.StructType([]) == schema_of_json(texts(spark, 1, None), "record")


def test_typed_items(spark):
    rows = texts(spark, [{"a": 1, "record": "r"}, {"a": 2.5}], {"a": 3}, [7, None], None)
    found = typed_items(rows, schema_of_json(rows, "record"))
    assert found.columns == ["record", "A", "item_a", "item_record"]
    assert sorted((r["item_a"], r["item_record"]) for r in found.collect()) == [(1.0, "r"), (2.5, None), (3.0, None)]


def test_large_samples_need_one_row_on_the_driver(spark):
    """Types are merged by an aggregate: partial results are combined across tasks."""
    rows = spark.range(0, 5000, 1, 16).select(F.to_json(F.struct(
        F.col("id").alias("id"), F.when(F.col("id") == 4999, F.lit("late")).alias("rare"))).alias("record"))
    assert schema_of_json(rows, "record") == T.StructType([T.StructField("id", T.LongType(), False), T.StructField("rare", T.StringType(), True)])
    assert evolution.optional_type(T.MapType(T.StringType(), T.LongType(), False)).valueContainsNull


@pytest.mark.parametrize("mixed", [False, True])
def test_items_are_decoded_once(spark, mixed):
    """What is read back has the rows and the schema of the two steps over the text; text of several types is written as there."""
    items = [{"a": 1, "b": {"c": "x", "d": None}, "l": [1, 2.5]}, {"a": 1e-8, "b": {"c": "é\U0001f600"}, "l": [], "e": {}}]
    odd = [{"a": 1e300, "b": {"c": 1e-8}, "l": ["t", {"k": 100.0}], "A b`": True}] if mixed else [{"a": 2**63, "l": [None], "item_a": None}]
    rows = texts(spark, items, {"a": 2.5, "record": "r"}, odd, [7, None], "no JSON", None)
    schema = schema_of_json(rows, "record")
    read, found = evolution.read_items(rows, "record")
    wanted = typed_items(rows, schema)
    assert found == schema and read.columns == wanted.columns
    assert sorted(map(repr, read.collect())) == sorted(map(repr, wanted.collect())) and read.count() == 4
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    assert "parseJson" not in plan and ("from_json" in plan) == mixed
