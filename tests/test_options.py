import pytest

from tests.helpers import PROPERTIES, options
from tidelog.options import IngestOptions, parse_topic_map, split_list
from tidelog.sources.topics import kafka_options


@pytest.mark.parametrize("text, nested, parts", [
    (None, False, []), ("", False, []), ("one ", False, ["one"]), ("one, two", False, ["one", "two"]),
    ("bucket(id, 4)", True, ["bucket(id, 4)"]),
    ("bucket(id, 4), type", True, ["bucket(id, 4)", "type"]),
    ("f(a, g(b, c)), d", True, ["f(a, g(b, c))", "d"]), ("a,,", False, ["a"]), (",a", False, ["", "a"]),
])
def test_split_list(text, nested, parts):
    assert split_list(text, nested=nested) == parts


def test_topic_map():
    text = "plant-air:def.abc, plant-water : prod.water ,bad,also:too:many,plant-water:prod.last"
    assert parse_topic_map(text) == {"plant-air": "def.abc", "plant-water": "prod.last"}


def test_defaults():
    found = options()
    assert (found.commit_interval_ms, found.commit_timeout_ms) == (300_000, 30_000)
    assert (found.task_engine, found.type_ingest, found.control_topic) == ("consumer", "API", "control-iceberg")
    assert found.group_id == "cg-control-sink-stations"
    assert not found.upsert and not found.auto_create and not found.tolerate_errors
    assert found.topic_tables == {"plant-stations": "def.abc"}


@pytest.mark.parametrize("change, complaint", [
    ({"iceberg.catalog.type": None}, "catalog"),
    ({"iceberg.tables": "a.b"}, "exclude"),
    ({"iceberg.tables.dynamic-enabled": "false"}, "name the tables"),
    ({"iceberg.tables.route-field": None}, "route field"),
    ({"iceberg.tables.upsert-mode-enabled": "maybe"}, "true or false"),
    ({"iceberg.control.commit.interval-ms": "soon"}, "whole number"),
    ({"consumer.override.auto.offset.reset": "middle"}, "start position"),
])
def test_contradictions(change, complaint):
    given = {k: v for k, v in {**PROPERTIES, **change}.items() if v is not None}
    with pytest.raises(ValueError, match=complaint):
        IngestOptions.from_properties(given)


def test_table_options_fall_back_to_defaults():
    found = options(**{
        "iceberg.table.db.one.id-columns": "a, b",
        "iceberg.table.db.one.partition-by": "bucket(id, 4), type",
        "iceberg.table.db.one.route-regex": "x.*",
        "iceberg.tables.default-commit-branch": "main",
        "iceberg.table.write-props.compression": "zstd",
    })
    one, other = found.for_table("db.one"), found.for_table("db.two")
    assert one.id_columns == ("a", "b") and one.partition_by == ("bucket(id, 4)", "type")
    assert one.route_regex == "x.*" and one.commit_branch == "main"
    assert other.id_columns == ("dedup_key",) and other.route_regex is None and other.commit_branch == "main"
    assert found.write_properties == {"compression": "zstd"}
    assert found.catalog_properties == {"type": "hive"}


def test_start_position_none_needs_offsets():
    none = options(**{"consumer.override.auto.offset.reset": "none"})
    with pytest.raises(ValueError):
        kafka_options("broker:9092", none)
    assert kafka_options("broker:9092", none, offsets='{"t":{"0":7}}')["startingOffsets"] == '{"t":{"0":7}}'


@pytest.mark.parametrize("start", ["earliest", "latest"])
def test_start_position(start):
    chosen = kafka_options("broker:9092", options(**{"consumer.override.auto.offset.reset": start}), 1000)
    assert chosen["startingOffsets"] == start and chosen["failOnDataLoss"] == "true"
    assert chosen["subscribe"] == "plant-stations" and chosen["maxOffsetsPerTrigger"] == "1000"
