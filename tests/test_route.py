import pytest
from pyspark.sql import functions as F

from tidelog.operators import route as R
from tidelog.operators.envelope import topic_table


def rows(spark):
    return spark.createDataFrame([(1, "val"), (2, "Db.Tbl"), (3, None), (4, "value")], "n int, fld string")


def pairs(frame):
    return sorted((r.n, r.route_table) for r in frame.collect())


def test_static_without_field(spark):
    assert pairs(R.route_to_all(rows(spark), ["a", "b"])) == [(n, t) for n in range(1, 5) for t in "ab"]


def test_static_by_pattern(spark):
    patterns = {"db.tbl": "val", "db.all": ".*", "db.either": "val|value", "db.off": None}
    assert pairs(R.route_by_pattern(rows(spark), "fld", patterns)) == [
        (1, "db.all"), (1, "db.either"), (1, "db.tbl"), (2, "db.all"), (4, "db.all"), (4, "db.either")]
    assert pairs(R.route_by_pattern(rows(spark), "fld", {"db.off": None})) == []


def test_dynamic(spark):
    assert pairs(R.route_dynamic(rows(spark), "fld")) == [(1, "val"), (2, "db.tbl"), (4, "value")]
    with pytest.raises(ValueError):
        R.route_dynamic(rows(spark), None)


def test_topic_table(spark):
    topics = spark.createDataFrame([("a-b-c",), ("mapped",), (None,)], "topic string")
    found = topics.select(topic_table(F.col("topic"), "ns", {"mapped": "x.y"})).collect()
    assert [r[0] for r in found] == ["ns.a_b_c", "x.y", "ns.unknown"]


def test_unknown_tables(spark):
    data = spark.createDataFrame([("a", 1), ("b", 2)], "iceberg_table string, n int")
    known, unknown = R.split_known_tables(data, spark.createDataFrame([("a",)], "iceberg_table string"))
    assert [r.n for r in known.collect()] == [1] and [r.n for r in unknown.collect()] == [2]
