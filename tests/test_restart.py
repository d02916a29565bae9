"""Restarts, new checkpoints, states apart from rows, ids per table, nulls and modes."""

import datetime
import shutil

import pytest
from pyspark.sql import functions as F

from tests.helpers import START, message, options, records
from tests.test_streaming import drop, run, view
from tidelog.operators import apply, commits, envelope, versions
from tidelog.plans import ingest
from tidelog.schemas import TOPIC_RECORD
from tidelog.sources.changelog import ChangelogStore
from tidelog.streaming.ingest import CHANGELOG, STATE_STORE


@pytest.mark.parametrize("state", [CHANGELOG, STATE_STORE])
def test_new_checkpoint_on_an_existing_store(spark, tmp_path, state):
    store = ChangelogStore(spark, str(tmp_path / "s"))
    for at, name in enumerate("AB"):
        source = str(tmp_path / f"t{name}")
        drop(records(spark, [message((1,), "INSERT", 1, data=[{"MaTram": name}])], first=at), source)
        run(spark, source, store, str(tmp_path / f"c{name}"), state)
    assert [r[0] for r in view(store)] == ["A", "B"]
    assert sorted(r.commit_seq for r in store.cycles().collect()) == [0, 1]


@pytest.mark.parametrize("state", [CHANGELOG, STATE_STORE])
def test_replay_after_the_commit(spark, tmp_path, state):
    """The process ends after the cycle record and before the checkpoint's own entry of the last batch."""
    store, source = ChangelogStore(spark, str(tmp_path / "s")), str(tmp_path / "t")
    for at, version in enumerate((5, 7)):
        drop(records(spark, [message((1,), "INSERT", version)], first=at), source)
        run(spark, source, store, str(tmp_path / "c"), state)
    shutil.copytree(tmp_path / "c", tmp_path / "d", ignore=lambda at, names: [n for n in names if at.endswith("commits") and n.strip(".").startswith("1")])
    drop(records(spark, [message((1,), "UPDATE", 6), message((2,), "INSERT", 1)], first=2), source)
    run(spark, source, store, str(tmp_path / "d"), state)
    assert sorted((r.dedup_key, r.version) for r in store.changelog().collect()) == [("TRAM001", 5), ("TRAM001", 7), ("TRAM002", 1)]
    assert store.cycles().count() == 3


@pytest.mark.parametrize("cuts", [[4], [1, 1, 1, 1], [2, 2]])
@pytest.mark.parametrize("compacted", [False, True])
def test_states_do_not_depend_on_what_became_of_rows(spark, tmp_path, cuts, compacted):
    values = [message((1,), ..., 10), message((2,), "INSERT", 10), message((1,), "UPDATE", 5), message((2,), "UPDATE", 5)]
    store, at = ChangelogStore(spark, str(tmp_path / "s")), 0
    lenient = options(**{"errors.tolerance": "all"})
    for seq, n in enumerate(cuts):
        ingest.ingest_batch(store, records(spark, values[at:at + n], first=at), seq, lenient,
                            steps=[lambda rows: rows.where("dedup_key <> 'TRAM002'")])
        at += n
        if compacted:
            store.compact(lenient)
    assert store.changelog().count() == 0
    assert {r.dedup_key: r.version for r in store.states().collect()} == {"TRAM001": 10, "TRAM002": 10}


def test_compaction_by_the_ids_of_each_table(spark, tmp_path):
    store = ChangelogStore(spark, str(tmp_path / "s"))
    own = options(**{"iceberg.table.def.abc.id-columns": "dedup_key,length"})
    values = [message((1,), "UPDATE", 1, length=1), message((1,), "UPDATE", 2, length=2), message((1,), "UPDATE", 3, length=2)]
    ingest.ingest_batch(store, records(spark, values), 0, own)

    def current(**where):
        return sorted((r.dedup_key, r.length, r.version) for r in store.current(own, **where).collect())

    wanted = [("TRAM001", "1", 1), ("TRAM001", "2", 3)]
    assert current(table="def.abc") == current() == wanted
    store.compact(own)
    assert current(table="def.abc") == current() == wanted


@pytest.mark.parametrize("mode", [apply.APPEND, apply.UPSERT])
def test_null_ids_meet(spark, mode):
    rows = spark.createDataFrame([(None, "U", 0, 1), (None, "U", 1, 2), ("a", "U", 2, 3)], "k string, _cdc_op string, pos int, v int")
    left = apply.merge_on_read(rows, ["k"], mode, order=["pos"]).collect()
    assert sorted((r.v for r in left)) == [2, 3]
    kept = apply.remove_keys(rows, rows.where("v = 1").select("k"), ["k"]).collect()
    assert [r.v for r in kept] == [3]


def test_state_meets_a_record_without_partition(spark):
    rows = spark.createDataFrame([("t", "k", None, 3, 5, "UPDATE"), ("t", "k", 0, 4, 12, "UPDATE")],
                                 "topic string, dedup_key string, partition int, offset bigint, version bigint, type string")
    initial = spark.createDataFrame([("t", "k", 10)], "topic string, dedup_key string, version bigint")
    found = {r.version: (r.prev_version, r.accepted) for r in versions.version_states(rows, initial=initial).collect()}
    assert found == {5: (10, False), 12: (10, True)}


def test_parse_rules(spark):
    head = '"key":"k","type":"INSERT","version":1'
    texts = ['{"data":[{"k":1.0}],%s}' % head, '{"data":[{"k":1.0},7],%s}' % head, '{"data":[{"k":1e5},"x"],%s}' % head,
             '{"data":[{"k":1e5}],%s}' % head, '{"data":"[{\\"k\\":1}]",%s}' % head, '\n\t{"data":[{"k":"a"}],%s}' % head,
             '{"data":[{"k":"a","data":"x"}],%s}' % head]
    rows = [("t", 0, i, START + datetime.timedelta(seconds=i), None, text) for i, text in enumerate(texts)]
    parsed = envelope.parse_envelopes(spark.createDataFrame(rows, TOPIC_RECORD)).orderBy("offset").collect()
    assert parsed[0].dedup_key == parsed[1].dedup_key == "1.0"
    assert parsed[2].dedup_key == parsed[3].dedup_key
    assert (parsed[4].dedup_key, parsed[4].error) == (None, "missing field data")
    assert [(r.dedup_key, r.error) for r in parsed[5:]] == [("a", None), ("a", None)]


def test_counts_follow_the_mode(spark):
    rows = spark.createDataFrame([("t", 0, op) for op in "IUD"], "iceberg_table string, commit_seq bigint, _cdc_op string")

    def counted(mode, only="IUD"):
        row = commits.table_changes(rows.where(F.col("_cdc_op").isin(list(only))), mode=mode).first()
        return row.added_records, row.removed_keys, row.operation

    assert counted(commits.APPEND_ONLY) == (3, 0, "append")
    assert counted(commits.CHANGES) == (2, 2, "overwrite")
    assert counted(commits.CHANGES, "I") == (1, 0, "append")
    assert counted(commits.UPSERT, "I") == (1, 1, "overwrite")


def test_offsets_behind_a_long_run_of_snapshots(spark):
    from tidelog.functions import summary as S
    from tidelog.operators.lineage import committed_offsets_by_ancestry
    key = S.offsets_key("control", "group")
    with_entry = F.create_map(F.lit(key), F.lit("{}"))
    log = spark.range(1, 3001).select(
        F.lit("t").alias("table"), F.col("id").alias("snapshot_id"), F.when(F.col("id") > 1, F.col("id") - 1).alias("parent_id"),
        F.when(F.col("id") == 400, with_entry).otherwise(F.create_map().cast("map<string,string>")).alias("summary"))
    heads = spark.createDataFrame([("t", 3000), ("t", 400), ("t", 399)], "table string, snapshot_id bigint")
    found = committed_offsets_by_ancestry(log, heads, "control", "group").collect()
    assert sorted((r.head_id, r.offsets, r.depth) for r in found) == [(400, "{}", 0), (3000, "{}", 2600)]


def test_large_versions_without_key_stay_exact(spark, tmp_path):
    store, source = ChangelogStore(spark, str(tmp_path / "s")), str(tmp_path / "t")
    big = 9_007_199_254_740_993
    values = [message((1,), "INSERT", big, key=...), message((1,), "INSERT", None), message((2,), "INSERT", big)]
    drop(records(spark, values), source)
    run(spark, source, store, str(tmp_path / "c"), STATE_STORE, options=options(**{"errors.tolerance": "all"}))
    assert sorted(r.version for r in store.set_aside("quarantined").where("version IS NOT NULL").collect()) == [big]
    assert [r.version for r in store.changelog().collect()] == [big]
