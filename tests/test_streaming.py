import pytest
from pyspark.errors import StreamingQueryException

from tests.helpers import GOLDEN, GOLDEN_ROWS, golden_records, message, options, records
from tidelog.functions import summary as S
from tidelog.operators import lineage
from tidelog.plans import ingest
from tidelog.sources.changelog import ChangelogStore
from tidelog.sources.topics import replay_batch, replay_stream
from tidelog.streaming.ingest import CHANGELOG, STATE_STORE, commit_trigger, progress_rates, start_ingest


def drop(frame, folder):
    frame.coalesce(1).write.mode("append").parquet(folder)


def run(spark, folder, store, checkpoint, state, **how):
    query = start_ingest(replay_stream(spark, folder), store, how.pop("options", options()), checkpoint, state,
                         trigger={"availableNow": True}, **how)
    query.awaitTermination()
    return query


def view(store):
    rows = store.current(options(), "def.abc").orderBy("dedup_key").collect()
    return [(r.dedup_key, r.type, r.version) for r in rows]


@pytest.mark.parametrize("state", [CHANGELOG, STATE_STORE])
def test_golden_stream_with_restarts(spark, tmp_path, state):
    store, source, checkpoint = ChangelogStore(spark, str(tmp_path / "s")), str(tmp_path / "t"), str(tmp_path / "c")
    for batch in range(len(GOLDEN)):
        drop(golden_records(spark, batch), source)
        query = run(spark, source, store, checkpoint, state)
    assert view(store) == GOLDEN_ROWS
    assert any(p["input_rows"] == 3 for p in progress_rates(query))
    log = store.snapshots().orderBy("commit_seq").collect()
    assert [r.operation for r in log] == ["append", "overwrite", "append"]
    assert [(r.added_records, r.total_records) for r in log] == [(3, 3), (2, 5), (2, 7)]
    assert [r.parent_id for r in log] == [None, log[0].snapshot_id, log[1].snapshot_id]
    key = S.offsets_key("control-iceberg", "cg-control-sink-stations")
    assert [r.summary[key] for r in log] == [f'{{"plant-stations/0":{n}}}' for n in (3, 6, 9)]
    assert [r.dedup_key for r in store.current(options(), "def.abc", as_of=0).orderBy("dedup_key").collect()] == [
        "TRAM001||TRAM002", "TRAM003", "TRAM005||TRAM006"]
    assert store.compact(options()) == 2 and view(store) == GOLDEN_ROWS
    files = store.files()
    assert sum(r.record_count for r in lineage.file_lineage(files, store.snapshots()).collect()) == 8
    traced = lineage.row_lineage(store.with_files().select("id", "file_path"), files)
    assert traced.count() == 8


def test_failed_commit_leaves_nothing_and_is_repeated(spark, tmp_path):
    store, source, checkpoint = ChangelogStore(spark, str(tmp_path / "s")), str(tmp_path / "t"), str(tmp_path / "c")
    drop(golden_records(spark, 0), source)
    broken = []

    def fail_once(rows):
        # Fails while the rows are being written, on the first attempt only.
        if not broken:
            broken.append(1)
            return rows.selectExpr("*", "raise_error('disk full') AS boom").where("boom IS NULL").drop("boom")
        return rows

    with pytest.raises(StreamingQueryException):
        run(spark, source, store, checkpoint, CHANGELOG, steps=[fail_once])
    assert store.cycles().count() == 0 and store.changelog().count() == 0 and store.snapshots().count() == 0
    run(spark, source, store, checkpoint, CHANGELOG, steps=[fail_once])
    assert store.changelog().count() == 3 and [r.commit_seq for r in store.cycles().collect()] == [0]


def test_failed_rows_have_not_paid_for_states(spark, tmp_path):
    store = ChangelogStore(spark, str(tmp_path / "s"))
    broken = [lambda rows: rows.selectExpr("*", "raise_error('disk full') AS boom").where("boom IS NULL").drop("boom")]
    with pytest.raises(Exception, match="disk full"):
        ingest.ingest_batch(store, golden_records(spark, 0), 0, options(), steps=broken)
    assert not store.has_states()
    assert ingest.ingest_batch(store, golden_records(spark, 0), 0, options())
    assert {r.dedup_key for r in store.states().collect()} == {r.dedup_key for r in store.changelog().collect()}


def test_a_streamed_batch_is_parsed_once(spark, tmp_path, monkeypatch):
    store, source, checkpoint = ChangelogStore(spark, str(tmp_path / "s")), str(tmp_path / "t"), str(tmp_path / "c")
    drop(golden_records(spark, 0), source)
    plans, commit = [], ingest.commit

    def looked_at(store, accepted, *args, **how):
        accepted.collect()
        plans.append(accepted._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0])
        return commit(store, accepted, *args, **how)

    monkeypatch.setattr(ingest, "commit", looked_at)
    run(spark, source, store, checkpoint, CHANGELOG)
    assert len(plans) == 1 and "InMemoryTableScan" not in plans[0] and plans[0].count("ReusedExchange") >= 2
    assert store.changelog().count() == 3 and not (tmp_path / "s" / "held" / "commit_seq=0").exists()


def test_commit_is_done_once(spark, tmp_path):
    store = ChangelogStore(spark, str(tmp_path / "s"))
    assert ingest.ingest_batch(store, golden_records(spark, 0), 0, options())
    before = store.snapshots().collect()
    assert not ingest.ingest_batch(store, golden_records(spark, 0), 0, options())
    assert store.snapshots().collect() == before and store.changelog().count() == 3


def test_unfinished_commit_is_invisible_and_overwritten(spark, tmp_path):
    store = ChangelogStore(spark, str(tmp_path / "s"))
    ingest.ingest_batch(store, golden_records(spark, 0), 0, options())
    leftover = store.changelog().drop("commit_seq").limit(2)
    leftover.selectExpr("*", "'applied' AS fate").write.partitionBy("fate", "iceberg_table").parquet(store.folder("changelog", 1))
    assert store.changelog().count() == 3
    ingest.ingest_batch(store, golden_records(spark, 1), 1, options())
    assert store.written(1).count() == 3


def test_messages_sent_while_down_are_picked_up(spark, tmp_path):
    store, source, checkpoint = ChangelogStore(spark, str(tmp_path / "s")), str(tmp_path / "t"), str(tmp_path / "c")
    for at, name in enumerate(["CHK_BEFORE_KILL", "CHK_DURING_DOWN", "CHK_AFTER_RECOVERY"]):
        drop(records(spark, [message((1,), "INSERT", 1, data=[{"MaTram": name}])], first=at), source)
        if name != "CHK_DURING_DOWN":
            run(spark, source, store, checkpoint, STATE_STORE)
    assert [r[0] for r in view(store)] == ["CHK_AFTER_RECOVERY", "CHK_BEFORE_KILL", "CHK_DURING_DOWN"]


def test_full_replay_gives_the_same_table(spark, tmp_path):
    source = str(tmp_path / "t")
    for batch in range(3):
        drop(golden_records(spark, batch), source)
    store = ChangelogStore(spark, str(tmp_path / "s"))
    ingest.ingest_batch(store, replay_batch(spark, source), 0, options())
    assert view(store) == GOLDEN_ROWS


def test_empty_commit_has_a_cycle_but_no_snapshot(spark, tmp_path):
    store = ChangelogStore(spark, str(tmp_path / "s"))
    ingest.ingest_batch(store, records(spark, [None, None]), 0, options())
    assert store.snapshots().count() == 0
    cycle = store.cycles().first()
    assert cycle.offsets == '{"plant-stations/0":2}' and cycle.commit_seq == 0


def test_quarantine_unknown_tables_and_assignment(spark, tmp_path):
    store = ChangelogStore(spark, str(tmp_path / "s"))
    rows = records(spark, [message((1,), "INSERT", 1), "nope"]).union(
        records(spark, [message((2,), "INSERT", 1)], topic="other"))
    assigned = spark.createDataFrame(
        [("plant-stations", 0), ("other", 0), ("idle", 0)], "topic string, partition int")
    registry = spark.createDataFrame([("def.abc",)], "iceberg_table string")
    ingest.ingest_batch(store, rows, 0, options(**{"errors.tolerance": "all"}), registry=registry, assigned=assigned)
    assert [r.iceberg_table for r in store.changelog().collect()] == ["def.abc"]
    assert [r.error for r in store.set_aside("quarantined").collect()] == ["value is not JSON"]
    assert [r.iceberg_table for r in store.set_aside("skipped").collect()] == ["default.other"]
    cycle = store.cycles().first()
    assert cycle.watermark_ms is None and cycle.offsets == '{"other/0":1,"plant-stations/0":1}'


def test_static_tables_and_user_steps(spark, tmp_path):
    store = ChangelogStore(spark, str(tmp_path / "s"))
    both = options(**{"iceberg.tables": "db.a,db.b", "iceberg.tables.dynamic-enabled": "false",
                      "iceberg.tables.route-field": "type", "iceberg.table.db.a.route-regex": "INS.*",
                      "iceberg.table.db.b.route-regex": ".*", "iceberg.table.db.b.commit-branch": "side"})
    values = [message((1,), "INSERT", 1), message((2,), "UPDATE", 1), message((3,), "INSERT", 1)]
    ingest.ingest_batch(store, records(spark, values), 0, both, steps=[lambda df: df.where("dedup_key <> 'TRAM003'")])
    assert sorted((r.iceberg_table, r.dedup_key) for r in store.changelog().collect()) == [
        ("db.a", "TRAM001"), ("db.b", "TRAM001"), ("db.b", "TRAM002")]
    assert [r.iceberg_table for r in store.set_aside("skipped").collect()] == []
    assert {r.table: r.branch for r in store.snapshots().collect()} == {"db.a": None, "db.b": "side"}


def test_state_store_stream_equals_batch_filter(spark, tmp_path):
    from tests.test_versions import expected, make
    from tidelog.streaming.version_filter import drop_redelivered
    rows = make(11, 200)
    values = [(r[0], 0, r[3], None, None, message((1,), r[5], r[4], data=[{"MaTram": r[1]}])) for r in rows]
    from tidelog.schemas import TOPIC_RECORD
    store, source, checkpoint = ChangelogStore(spark, str(tmp_path / "s")), str(tmp_path / "t"), str(tmp_path / "c")
    for low in (0, 90, 130):
        high = {0: 90, 90: 130, 130: 200}[low]
        drop(spark.createDataFrame(values[low:high], TOPIC_RECORD), source)
        run(spark, source, store, checkpoint, STATE_STORE)
    assert sorted(r.offset for r in store.changelog().collect()) == expected(rows)[0]
    assert drop_redelivered(replay_stream(spark, source).selectExpr("*", "'x' AS id")).isStreaming


def test_commit_interval():
    assert commit_trigger(options(**{"iceberg.control.commit.interval-ms": "10000"})) == {"processingTime": "10000 milliseconds"}


def test_keys_share_state_buckets(spark, tmp_path):
    from tests.test_versions import SCHEMA, expected, make
    from tidelog.streaming.version_filter import stateful_filter
    rows, source, made = make(5, 300, keys=40), str(tmp_path / "t"), []
    rows.append(("t", None, 0, 999, None, "INSERT", "no key"))
    for part in (rows[:150], rows[150:]):
        drop(spark.createDataFrame(part, SCHEMA), source)
        passed = stateful_filter(spark.readStream.schema(SCHEMA).parquet(source), buckets=3)
        query = passed.writeStream.foreachBatch(lambda batch, _: made.extend(batch.collect())).option(
            "checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        query.awaitTermination()
    # Three groups with states, whatever the number of keys; every column comes back as it was.
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 3
    wanted = {*expected(rows[:-1])[0], 999}
    assert sorted(map(tuple, made), key=lambda r: r[3]) == sorted((r for r in rows if r[3] in wanted), key=lambda r: r[3])
