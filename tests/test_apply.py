import random

import pytest

from tidelog.operators import apply as A

SCHEMA = "dedup_key string, _cdc_op string, commit_seq bigint, partition int, offset bigint"


def make(seed, n=120):
    rng = random.Random(seed)
    return [(f"k{rng.randrange(6)}", rng.choice("IIUUD"), i // 15, 0, i) for i in range(n)]


def expected(rows, upsert=False):
    table = []
    for row in rows:
        if row[1] != "I" or upsert:
            table = [r for r in table if r[0] != row[0]]
        if row[1] != "D":
            table.append(row)
    return sorted(table)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("mode", [A.APPEND, A.UPSERT])
def test_merge_on_read_equals_one_at_a_time(spark, seed, mode):
    rows = make(seed)
    found = A.merge_on_read(spark.createDataFrame(rows, SCHEMA), ["dedup_key"], mode)
    assert sorted(map(tuple, found.collect())) == expected(rows, mode == A.UPSERT)


@pytest.mark.parametrize("mode", [A.APPEND, A.UPSERT])
def test_copy_on_write_commit_by_commit_equals_merge_on_read(spark, mode):
    rows = make(7, 60)
    log = spark.createDataFrame(rows, SCHEMA)
    table = spark.createDataFrame([], SCHEMA)
    for seq in range(4):
        table = A.copy_on_write(table, log.where(f"commit_seq = {seq}"), ["dedup_key"], mode)
    assert sorted(map(tuple, table.collect())) == expected(rows, mode == A.UPSERT)


def test_time_travel(spark):
    rows = make(2)
    log = A.as_of(spark.createDataFrame(rows, SCHEMA), 3)
    found = A.merge_on_read(log, ["dedup_key"]).collect()
    assert sorted(map(tuple, found)) == expected([r for r in rows if r[2] <= 3])


def test_key_sets(spark):
    log = spark.createDataFrame([("a", "I", 0, 0, 0), ("b", "U", 0, 0, 1), ("c", "D", 0, 0, 2)], SCHEMA)
    assert {r[0] for r in A.delete_keys(log, ["dedup_key"]).collect()} == {"b", "c"}
    assert {r[0] for r in A.delete_keys(log, ["dedup_key"], A.UPSERT).collect()} == {"a", "b", "c"}
    assert {r[0] for r in A.new_rows(log).collect()} == {"a", "b"}
    with pytest.raises(ValueError):
        A.merge_on_read(log, ["dedup_key"], "replace")


def test_lookup_filter_reaches_the_files(spark, tmp_path):
    spark.createDataFrame(make(1), SCHEMA).write.parquet(str(tmp_path / "log"))
    view = A.merge_on_read(spark.read.parquet(str(tmp_path / "log")), ["dedup_key"])
    plan = view.where("dedup_key = 'k1'")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EqualTo(dedup_key,k1)") == 2


def test_merge_input_for_table_formats(spark):
    from tests.helpers import message, records
    from tidelog.operators.envelope import parse_envelopes
    from tidelog.sources import iceberg
    values = [message((1,), "INSERT", 1), message((2,), "UPDATE", 1), message((3,), "DELETE", 1)]
    source = iceberg.delta_source(parse_envelopes(records(spark, values)), ["dedup_key"]).collect()
    assert sorted((r._gone, r._match_dedup_key, r.dedup_key) for r in source if r._gone) == [
        (True, "TRAM002", None), (True, "TRAM003", None)]
    assert sorted((r.dedup_key, r._match_dedup_key) for r in source if not r._gone) == [
        ("TRAM001", None), ("TRAM002", None)]
    statement = iceberg.merge_statement(iceberg.on_branch("db.t", "audit"), "s", ["dedup_key"])
    assert statement.startswith("MERGE INTO db.t.branch_audit t USING s s ON t.dedup_key = s._match_dedup_key WHEN MATCHED")


def test_skewed_join_is_split(spark):
    from pyspark.sql import functions as F
    rows = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("dedup_key"),
        F.lit("U").alias("_cdc_op"), F.lit(0).cast("bigint").alias("commit_seq"), F.lit(0).alias("partition"),
        F.col("id").alias("offset"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1", "spark.sql.shuffle.partitions": "32",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB"}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        found = A.merge_on_read(rows, ["dedup_key"]).groupBy().count()
        assert found.collect()[0][0] == 200_000 - (200_000 + 2) // 3 + 1
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert "SortMergeJoin(skew=true)" in plan


def test_validity_against_every_version(spark):
    """Intervals give, for each commit, what merging the changelog up to it gives; chunks of any size agree."""
    import random

    from tidelog.operators import apply
    rng = random.Random(13)
    rows = [("t", f"k{rng.randint(0, 4)}" if rng.random() < 0.9 else None, rng.choice("IUD"), i // 12, rng.randint(0, 1), i) for i in range(150)]
    log = spark.createDataFrame(rows, "iceberg_table string, k string, _cdc_op string, commit_seq bigint, partition int, offset bigint")
    for mode in (apply.APPEND, apply.UPSERT):
        wanted = {}
        for version in range(13):
            kept = {}
            for row in sorted((r for r in rows if r[3] <= version), key=lambda r: r[3:]):
                if row[2] in ("UD" if mode == apply.APPEND else "IUD"):
                    kept[row[1]] = []
                if row[2] != "D":
                    kept.setdefault(row[1], []).append(row[5])
            wanted[version] = sorted(sum(kept.values(), []))
        for bits in (2, 14):
            found = apply.at_versions(apply.validity(log, ["iceberg_table", "k"], mode, chunk_bits=bits), range(13)).collect()
            got = {v: sorted(r.offset for r in found if r.as_of == v) for v in range(13)}
            assert got == wanted, (mode, bits)
    assert apply.validity(log.limit(0), ["k"]).count() == 0
