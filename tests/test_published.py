"""Published tables: pruning by spec, buckets replaced, lookups, options honoured; keyed states in buckets."""

import datetime
import os
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.helpers import golden_records, options
from tidelog.operators import versions
from tidelog.operators.evolution import SchemaConflict
from tidelog.plans import ingest
from tidelog.sources import keyed_states, published
from tidelog.sources.changelog import ChangelogStore

UTC = datetime.timezone.utc


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def partition_filters(frame):
    return re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("extended")), re.S).group(1)


@pytest.fixture(scope="module")
def moments(spark):
    start = datetime.datetime(1969, 12, 30, 22, 59, tzinfo=UTC)
    rows = [(i, f"{'abc'[i % 3]}{i:03d}é", start + datetime.timedelta(hours=7 * i, microseconds=i)) for i in range(120)]
    rows += [(None, None, None), (-7, "", datetime.datetime(2400, 2, 29, 23, 59, 59, 999999, tzinfo=UTC))]
    return spark.createDataFrame(rows, "i bigint, s string, ts timestamp").withColumn("d", F.to_date("ts"))


@pytest.mark.parametrize("spec", ["year(ts)", "month(ts)", "day(ts)", "hours(ts)", "month(d)", "bucket(i, 4)", "truncate(i, 10)",
                                  "truncate(s, 2)", "i", "s", "d"])
def test_pruned_rows_are_the_filtered_rows(spark, moments, tmp_path, spec):
    """Every operator on every column gives what the filter alone gives, in any session time zone."""
    path = str(tmp_path / "t")
    published.write_by_spec(moments, path, [spec])
    at = datetime.datetime(1970, 1, 5, 12, 0, tzinfo=UTC)
    conditions = [("i", "=", 17), ("i", "in", [3, -7, 500]), ("i", "<", 25), ("i", ">=", 100), ("s", "=", ""), ("s", "starts with", "b"),
                  ("s", "starts with", "b00"), ("s", "<=", "b05"), ("s", ">", "c1"), ("ts", "<", at), ("ts", ">=", at), ("ts", "=", at),
                  ("d", "=", datetime.date(1970, 1, 2)), ("d", ">", datetime.date(1970, 1, 20))]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Ho_Chi_Minh")
        for condition in conditions:
            found = published.scan(spark, path, [spec], [condition], moments.schema)
            wanted = moments.where(published.condition_column(condition, moments.schema))
            assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect())), (spec, condition)
        assert published.scan(spark, path, [spec], (), moments.schema).count() == 122
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize("spec, condition, folders", [
    ("day(ts)", ("ts", "<", datetime.datetime(1970, 1, 1, tzinfo=UTC)), 3), ("hour(ts)", ("ts", "=", datetime.datetime(1969, 12, 30, 22, 59, tzinfo=UTC)), 1),
    ("bucket(i, 4)", ("i", "=", 17), 1), ("truncate(i, 10)", ("i", "<", 25), 4), ("truncate(s, 2)", ("s", "starts with", "b00"), 1), ("s", ("s", "=", "a003é"), 1)])
def test_files_are_pruned(spark, moments, tmp_path, spec, condition, folders):
    path = str(tmp_path / "t")
    published.write_by_spec(moments, path, [spec])
    found = published.scan(spark, path, [spec], [condition], moments.schema)
    name = published.parse_spec([spec], moments.schema)[0].name
    assert name in partition_filters(found)
    read = {r[0] for r in found.select(F.input_file_name()).distinct().collect()}
    assert 0 < len({os.path.dirname(f) for f in read}) <= folders < len(os.listdir(path)) - 1


def test_specs_that_do_not_fit(moments):
    for spec in (["void(i)"], ["year(i)"], ["hour(d)"], ["truncate(ts, 3)"], ["bucket(i, 0)"], ["bucket(x, 2)"], ["i", "i"]):
        with pytest.raises(ValueError):
            published.parse_spec(spec, moments.schema)
    with pytest.raises(ValueError):
        published.parse_spec(["i"], moments.withColumn("i_identity", F.lit(1)).schema)
    for condition in (("i", "like", 1), ("i", "=", None), ("i", "in", [])):
        with pytest.raises(ValueError):
            published.condition_column(condition, moments.schema)


def test_only_touched_buckets_are_replaced(spark, tmp_path):
    path, schema = str(tmp_path / "t"), T.StructType.fromDDL("k string, v int")
    published.write_buckets(spark.range(200).selectExpr("concat('k', id) AS k", "CAST(id AS INT) AS v"), path, ["k"], 16)
    stamps = {b: sorted(os.listdir(f"{path}/{b}")) for b in os.listdir(path) if b.startswith("_key")}
    columns = "k string, v int, _cdc_op string, partition int, offset bigint"
    batch = spark.createDataFrame([("k1", -1, "U", 0, 1), ("k2", 0, "D", 0, 2), ("new", 5, "I", 0, 3), ("new", 6, "U", 0, 4)], columns)
    touched = published.apply_to_buckets(spark, path, batch, ["k"], 16, schema=schema)
    for name, files in stamps.items():
        assert (sorted(os.listdir(f"{path}/{name}")) != files) == (int(name.split("=")[1]) in touched)
    rows = {r.k: r.v for r in spark.read.parquet(path).collect()}
    assert len(rows) == 200 and rows["k1"] == -1 and rows["new"] == 6 and "k2" not in rows
    assert len(touched) <= 3 and published.apply_to_buckets(spark, path, batch.limit(0), ["k"], 16, schema=schema) == []
    gone = spark.createDataFrame([(k, 0, "D", 0, i) for i, k in enumerate(rows)], columns)
    assert len(published.apply_to_buckets(spark, path, gone, ["k"], 16, schema=schema)) == 16
    assert not [b for b in os.listdir(path) if b.startswith("_key")]


def test_a_lookup_reads_few_row_groups(spark, tmp_path):
    import pyarrow.parquet as pq
    path = str(tmp_path / "t")
    rows = spark.range(0, 400_000).selectExpr("concat('t', id % 2) AS t", "sha2(CAST(id AS STRING), 256) AS k", "repeat('x', 50) AS pad")
    published.write_clustered(rows, path, ["t", "k"], files=8, row_group_bytes=1 << 18)
    key = rows.where("id = 12345" if "id" in rows.columns else F.col("k") == F.sha2(F.lit("12345").cast("binary"), 256)).first()["k"]
    groups = hit = 0
    for name in os.listdir(path):
        if name.endswith(".parquet"):
            meta = pq.ParquetFile(f"{path}/{name}").metadata
            for g in range(meta.num_row_groups):
                stats = meta.row_group(g).column(1).statistics
                groups, hit = groups + 1, hit + (stats.min <= key <= stats.max)
    assert groups >= 60 and hit / groups < 0.05
    found = spark.read.parquet(path).where(F.col("k") == key)
    assert [r.t for r in found.collect()] == ["t1"]
    scanned = found._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value()
    assert scanned < 400_000 * 0.05


def test_options_of_published_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.sql("SELECT 1 AS id, DATE '2024-01-02' AS d")
    base = {"iceberg.table.db.t.partition-by": "day(d), bucket(id, 2)"}
    with pytest.raises(ValueError, match="auto-create"):
        published.publish(rows, path, "db.t", options(**base))
    made = options(**base, **{"iceberg.tables.auto-create-enabled": "true", "iceberg.tables.schema-force-optional": "true",
                              "iceberg.table.write-props.write.parquet.compression-codec": "gzip"})
    assert all(f.nullable for f in published.publish(rows, path, "db.t", made).fields)
    files = [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    assert files and all(".gz." in f for f in files) and any(n.startswith("d_day=") for n in os.listdir(path))
    wide = spark.sql("SELECT CAST(5000000000 AS BIGINT) AS ID, DATE '2024-01-02' AS d, 'n' AS note")
    with pytest.raises(SchemaConflict):
        published.publish(wide, path, "db.t", options(**base, **{"iceberg.tables.schema-case-insensitive": "true"}))
    kept = published.publish(spark.sql("SELECT 2 AS id, DATE '2024-01-03' AS d, 'n' AS note"), path, "db.t", options(**base))
    assert kept.names == ["id", "d"]
    grown = published.publish(wide, path, "db.t", options(**base, **{
        "iceberg.tables.evolve-schema-enabled": "true", "iceberg.tables.schema-case-insensitive": "true"}))
    assert [(f.name, f.dataType.simpleString()) for f in grown.fields] == [("id", "bigint"), ("d", "date"), ("note", "string")]
    with pytest.raises(ValueError, match="cannot be honoured"):
        published.writer_options({"write.delete.mode": "merge-on-read"})


def test_published_records_are_decoded_once(spark, tmp_path, monkeypatch):
    from tidelog.operators import evolution
    calls, own = [], evolution.J.decode
    monkeypatch.setattr(evolution.J, "decode", lambda text: calls.append(text) or own(text))
    made = options(**{"iceberg.tables.auto-create-enabled": "true"})
    rows = spark.sql("""SELECT 7L AS at, '[{"a": 1, "s": {"x": "t"}}, {"a": 2.5, "s": {}}]' AS record""")
    schema = published.publish(rows, str(tmp_path / "t"), "db.t", made, record="record")
    assert len(calls) == 1 and [(f.name, f.nullable) for f in schema.fields] == [("at", True), ("record", True), ("a", False), ("s", False)]
    assert sorted((r.at, r.a, r.s.x) for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [(7, 1.0, "t"), (7, 2.5, None)]


# --- keyed states ---------------------------------------------------------------------------




def test_stored_states_are_not_shuffled(spark, tmp_path):
    """The batch goes to the buckets; the plan has no exchange or sort above the stored side."""
    folder = str(tmp_path / "b")
    stored = spark.range(500).selectExpr("concat('t', id % 3) AS topic", "concat('k', id) AS dedup_key", "id % 50 AS version")
    stored = stored.unionByName(spark.createDataFrame([(None, "k1", 9)], stored.schema))
    keyed_states.write_bucketed(stored, folder, ["topic"], 8)
    name = keyed_states._table_name(f"{folder}/buckets=8")
    spark.sql(f"DROP TABLE {name}")  # as in a session that did not write it
    base = keyed_states.bucketed_table(spark, folder, ["topic"], 8)
    changes = spark.createDataFrame([("t1", "k1", 40, 7), ("t1", "k1", None, 8), ("t2", "k2", 60, 7)],
                                    "topic string, dedup_key string, version bigint, commit_seq bigint")
    states = keyed_states.KeyedStates(("topic",), changes, base)
    rows = spark.createDataFrame([(t, f"k{k}", 0, o, v, "UPDATE") for o, (t, k, v) in enumerate(
        [("t0", 0, 1), ("t1", 1, 5), ("t2", 2, 55), ("t2", 2, 61), (None, 1, 9), (None, 1, 10), ("t0", 9, 3), ("t1", 1, 4), ("t0", 999, 0)])],
        "topic string, dedup_key string, partition int, offset bigint, version bigint, type string")
    plain = stored.where("NOT (topic <=> 't1' AND dedup_key = 'k1') AND NOT (topic <=> 't2' AND dedup_key = 'k2')").unionByName(
        spark.createDataFrame([("t2", "k2", 60)], stored.schema))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        filtered = versions.version_states(rows, initial=states)
        got = {r.offset: (r.prev_version, r.accepted) for r in filtered.collect()}
        assert got == {r.offset: (r.prev_version, r.accepted) for r in versions.version_states(rows, initial=plain).collect()}
        assert got[1] == (None, True) and got[2] == (60, False) and got[4] == (9, False)
        joined = states.enter(rows.select(F.struct("topic", "dedup_key").alias("_key")))
        shown = plan(joined)
        scan = next(i for i, line in enumerate(shown.splitlines()) if name in line or "Bucketed: true" in line)
        above = shown.splitlines()[scan - 4:scan]
        assert "Bucketed: true" in shown.splitlines()[scan] and not any("Exchange" in line for line in above), shown
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_states_of_a_store_in_buckets(spark, tmp_path):
    """A batch after a compaction is filtered by the bucketed base and by the commits behind it, without Python."""
    store = ChangelogStore(spark, str(tmp_path / "s"), state_buckets=4)
    for at in range(3):
        if at:
            store.compact(options())
        ingest.ingest_batch(store, golden_records(spark, at), at, options())
    assert store.keyed_states().base is not None
    assert {r.dedup_key: r.version for r in store.states().collect()} == {
        "TRAM001||TRAM002": 2, "TRAM003": 1, "TRAM005||TRAM006": 2, "TRAM007||TRAM008": 1}
    again = ingest.transform(golden_records(spark, 0), options(), initial=ingest.filter_states(store))
    assert again.count() == 0 and "Python" not in plan(again) and "Pandas" not in plan(again)


def test_long_histories_stay_linear(spark):
    """80,000 messages of one key: states are gathered in parts, not in one list that each step copies."""
    import time
    rows = spark.range(80_000).selectExpr("'t' AS topic", "'k' AS dedup_key", "0 AS partition", "id AS offset",
                                          "(id * 7919) % 50000 AS version", "IF(id % 1000 = 999, 'DELETE', 'UPDATE') AS type")
    began = time.monotonic()
    accepted = sorted(r.offset for r in versions.filter_versions(rows).select("offset").collect())
    took = time.monotonic() - began
    state, wanted = None, []
    for i in range(80_000):
        v = i * 7919 % 50_000
        if state is None or v > state:
            wanted.append(i)
            state = None if i % 1000 == 999 else v
    assert accepted == wanted and took < 30


def test_versions_and_latency_sketches_of_a_store(spark, tmp_path):
    from dataclasses import replace

    from tidelog.operators import lineage
    store, sketching = ChangelogStore(spark, str(tmp_path / "s")), replace(options(), latency_sketch=True)
    for at in range(3):
        ingest.ingest_batch(store, golden_records(spark, at), at, sketching)
    shown = store.versions(sketching, "def.abc", [0, 2]).collect()
    for version in (0, 2):
        assert sorted(r.id for r in shown if r.as_of == version) == sorted(
            r.id for r in store.current(sketching, "def.abc", as_of=version).collect())
    row = lineage.merged_latency(store.snapshots(), (0.0, 1.0)).first()
    ages = [r[0] for r in store.changelog().select(F.unix_millis("timestamp")).collect()]
    assert row.records == len(ages) and 0 <= row.quantiles_ms[1] - row.quantiles_ms[0] - (max(ages) - min(ages)) < 600_000
