import json

import pytest
from pyspark.errors import PySparkException

from tests.helpers import message, records
from tidelog.operators import envelope as E
from tidelog.schemas import STATION_ITEM, TARGET_COLUMNS


def parse(spark, *values, legacy=False):
    read = E.parse_legacy_envelopes if legacy else E.parse_envelopes
    return read(records(spark, values)).orderBy("offset").collect()


def test_ten_fields(spark):
    row = parse(spark, message((2, 1), "insert", 7))[0]
    assert row.id == "plant-stations-0-0" and row.dedup_key == "TRAM001||TRAM002"
    assert (row.version, row.type, row.key, row.length) == (7, "insert", "MaTram", "2")
    assert (row.ngay_cap_nhat, row.iceberg_table, row._cdc_op) == ("16/05/2026-12:00", "default.plant_stations", "I")
    assert json.loads(row.record) == json.loads(message((2, 1), "insert", 7))["data"]
    assert row.error is None


@pytest.mark.parametrize("value, error", [
    (message((1,), "INSERT", None), E.missing("version")),
    (message((1,), "INSERT", 1, key=...), E.missing("key")),
    (message((1,), "INSERT", 1, data=...), E.missing("data")),
    (message((1,), None, 1), E.missing("type")),
    (message((1,), "INSERT", "not_a_number"), E.BAD_VERSION),
    (message((1,), "INSERT", " 1"), E.BAD_VERSION),
    (message((1,), "INSERT", "1.5"), E.BAD_VERSION),
    (message((1,), "INSERT", True), E.BAD_VERSION),
    (message((1,), "INSERT", 1, data=[]), E.EMPTY_DATA),
    (message((1,), "INSERT", 1, data={"MaTram": "x"}), E.NO_KEY_VALUE),
    (message((1,), "INSERT", 1, data=[1, "x", None]), E.NO_KEY_VALUE),
    (message((1,), "INSERT", 1, data=[{"other": 1}, {"MaTram": None}]), E.NO_KEY_VALUE),
    ("not json", E.MALFORMED), ('{"data":', E.MALFORMED), ("[1]", E.NOT_OBJECT), ('"text"', E.NOT_OBJECT),
])
def test_bad_messages(spark, value, error):
    assert parse(spark, value)[0].error == error


@pytest.mark.parametrize("given, version", [
    (1704067200000, 1704067200000), ("1704067200000", 1704067200000), ("+5", 5), ("-5", -5), (1.9, 1), (-1.9, -1)])
def test_version_forms(spark, given, version):
    row = parse(spark, message((1,), "INSERT", given))[0]
    assert (row.version, row.error) == (version, None)


@pytest.mark.parametrize("data, key", [
    ([{"MaTram": "b"}, {"MaTram": "a"}], "a||b"),
    ([{"MaTram": "a"}, 3, {"MaTram": "a"}, {"x": 1}], "a||a"),
    ([{"MaTram": 10}, {"MaTram": 9}], "10||9"),
    ([{"MaTram": "B"}, {"MaTram": "a"}, {"MaTram": "b"}], "B||a||b"),
    ([{"MaTram": ""}], ""),
    ([{"MaTram": "Trạm"}], "Trạm"),
])
def test_composite_key(spark, data, key):
    assert parse(spark, message((1,), "INSERT", 1, data=data))[0].dedup_key == key


@pytest.mark.parametrize("word, op", [("INSERT", "I"), ("Update", "U"), ("delete", "D"), ("MERGE", "I")])
def test_operation_code(spark, word, op):
    assert parse(spark, message((1,), word, 1))[0]._cdc_op == op


def test_length_defaults_to_zero(spark):
    assert parse(spark, message((1,), "INSERT", 1, length=...))[0].length == "0"


def test_tombstones_are_not_rows(spark):
    assert parse(spark, None, message((1,), "INSERT", 1))[0].offset == 1


def test_id_defaults(spark):
    rows = spark.createDataFrame([(None, None, 5), ("t", 3, 6)], "topic string, partition int, offset bigint")
    assert [r[0] for r in rows.select(E.record_id()).collect()] == ["unknown-0-5", "t-3-6"]
    ids = spark.createDataFrame([("t", 0, None)] * 2, "topic string, partition int, offset bigint").select(
        E.record_id_or_random()).collect()
    assert ids[0] != ids[1]


@pytest.mark.parametrize("value, error", [
    (message((1,), "INSERT", None), E.missing("version")),
    (message((1,), "INSERT", 1, key=...), E.missing("key")),
    (message((1,), "INSERT", 1, data=...), E.missing("data")),
    (message((1,), None, 1), E.missing("type")),
    (message((1,), "INSERT", 1, ngay_cap_nhat=...), E.missing("ngay_cap_nhat")),
    (message((1,), "INSERT", 1, length=...), E.missing("length")),
    (message((1,), "INSERT", "not_a_number"), E.BAD_VERSION),
    (message((1,), "INSERT", 1, length="not_a_number"), E.BAD_LENGTH),
])
def test_legacy_bad_messages(spark, value, error):
    assert parse(spark, value, legacy=True)[0].error == error


def test_legacy_rows(spark):
    full, empty = parse(spark, message((1,), "INSERT", "12", length="4"), message((1,), "INSERT", 1, data=[]), legacy=True)
    assert (full.dedup_key, full.version, full.length) == ("plant-stations:MaTram", 12, 4)
    assert (empty.record, empty.length, empty.error) == ("[]", 0, None)


def test_error_policies(spark):
    rows = E.parse_envelopes(records(spark, [message((1,), "INSERT", 1), "nope"]))
    good, bad = E.split_errors(rows)
    assert [r.offset for r in good.collect()] == [0] and [r.error for r in bad.collect()] == [E.MALFORMED]
    with pytest.raises(PySparkException, match="bad message plant-stations-0-1"):
        E.fail_on_errors(rows).collect()


def test_target_columns_and_items(spark):
    rows = E.split_errors(E.parse_envelopes(records(spark, [message((1, 2), "INSERT", 1)])))[0]
    assert E.to_target(rows).columns == list(TARGET_COLUMNS)
    assert not {"iceberg_table", "_cdc_op"} & set(E.strip_internal(rows).columns)
    items = E.expand_items(rows, STATION_ITEM).orderBy("MaTram").collect()
    assert [(i.MaTram, i.TenTram, i.KinhDo) for i in items] == [
        ("TRAM001", "Trạm Hà Nội", 105.8), ("TRAM002", "Trạm Hà Nội", 105.8)]
