import datetime

import pytest

from tidelog.operators import audit as A
from tidelog.schemas import COMMIT_EVENT

D1, D2 = ("data-1.parquet", 0, 5), ("data-2.parquet", 0, 5)
X1, X2 = ("delete-1.parquet", 0, 1), ("delete-2.parquet", 0, 1)


def event(name, offset, data=None, deletes=None, assignments=None, commit="c"):
    return (name, "g", None, "DATA_WRITTEN", 0, offset, commit, "db.tbl", data, deletes, assignments)


def mentions(spark, *events):
    return A.files(spark.createDataFrame(list(events), COMMIT_EVENT))


E1 = event("e1", 100, [D1], [X1])
E2 = event("e2", 101, [D1, D2], [X1, X2])
E3 = event("e3", 102, [D1, D2, D2], [X1, X2, X2])


@pytest.mark.parametrize("events, files, across, within", [
    ([event("e", 100)], set(), {}, {}),
    ([event("e", 100, [], [])], set(), {}, {}),
    ([E1], {"data-1", "delete-1"}, {}, {}),
    ([event("e", 100, [D1, D2], [X1, X2])], {"data-1", "data-2", "delete-1", "delete-2"}, {}, {}),
    ([event("a", 100, [D1], [X1]), event("b", 101, [D2], [X2])], {"data-1", "data-2", "delete-1", "delete-2"}, {}, {}),
    ([E2, E2], {"data-1", "data-2", "delete-1", "delete-2"},
     {"data-1": 2, "data-2": 2, "delete-1": 2, "delete-2": 2}, {}),
    ([event("e", 100, [D1, D2, D1], [X1, X2, X1])], {"data-1", "data-2", "delete-1", "delete-2"}, {},
     {"data-1": 2, "delete-1": 2}),
    ([E1, E2], {"data-1", "data-2", "delete-1", "delete-2"}, {"data-1": 2, "delete-1": 2}, {}),
    ([E1, E2, E1, E3], {"data-1", "data-2", "delete-1", "delete-2"},
     {"data-1": 4, "data-2": 2, "delete-1": 4, "delete-2": 2}, {"data-2": 2, "delete-2": 2}),
])
def test_file_dedup(spark, events, files, across, within):
    found = mentions(spark, *events)

    def name(row):
        return row.path.removesuffix(".parquet")

    assert {name(r) for r in A.unique_files(found).collect()} == files
    assert {name(r): r.mentions for r in A.duplicates_across_events(found).collect()} == across
    assert {name(r): r.mentions for r in A.duplicates_within_event(found).collect()} == within


def at(ms):
    return datetime.datetime.fromtimestamp(ms / 1000, datetime.timezone.utc)


def reported(spark, *lists, commits=None):
    rows = [event(f"e{i}", i, assignments=[("t", p, 1, None if ms is None else at(ms)) for p, ms in enumerate(times)],
                  commit=(commits or {}).get(i, "c")) for i, times in enumerate(lists)]
    return spark.createDataFrame(rows, COMMIT_EVENT)


@pytest.mark.parametrize("times, partial, wanted", [
    ([[3, 2], [1]], False, 1), ([[3, 2], [1, None]], False, None), ([[3, 2], [1]], True, None)])
def test_low_watermark(spark, times, partial, wanted):
    from pyspark.sql import functions as F
    events = reported(spark, *times).withColumn("partial", F.lit(partial))
    marks = A.low_watermarks(events, partial="partial").select(F.unix_millis("watermark")).collect()
    assert [r[0] for r in marks] == [wanted]


def test_completeness_sums_list_sizes(spark):
    events = reported(spark, [1, 1], [1], [1], commits={2: "other"})
    assert {(r.commit_id, r.received, r.ready) for r in A.completeness(events, 3).collect()} == {
        ("c", 3, True), ("other", 1, False)}
    assert not A.completeness(events, 4).where("commit_id = 'c'").first().ready


def test_events_of_other_groups_and_garbage(spark):
    raw = spark.createDataFrame(
        [(0, 7, '{"group_id":"g"}'), (0, 8, "garbage{"), (1, 3, '{"group_id":"x"}'), (1, 2, None)],
        "partition int, offset bigint, payload string")
    assert [r.offset for r in A.readable_events(raw, "g").collect()] == [7]
    assert {(r.partition, r.next_offset) for r in A.next_offsets(raw).collect()} == {(0, 9), (1, 4)}


def test_committed_and_empty_files(spark):
    found = mentions(spark, event("e", 99, [D1]), event("f", 100, [D2]), event("g", 101, [("z", 0, 0)]))
    committed = spark.createDataFrame([("db.tbl", 0, 100)], "table string, partition int, committed_offset bigint")
    assert {r.offset for r in A.not_committed(found, committed).collect()} == {100, 101}
    elsewhere = spark.createDataFrame([("db.tbl", 1, 100)], committed.schema)
    assert A.not_committed(found, elsewhere).count() == 3
    assert {r.path for r in A.with_records(found).collect()} == {D1[0], D2[0]}


def test_last_spec_carries_offsets(spark):
    found = A.unique_files(mentions(spark, event("e", 1, [("a", 0, 5), ("b", 1, 5), ("c", 1, 5)])))
    specs = A.files_by_spec(found).orderBy("spec_id").collect()
    assert [(r.spec_id, r.files, r.carries_offsets) for r in specs] == [(0, 1, False), (1, 2, True)]
