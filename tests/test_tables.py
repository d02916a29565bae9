import pytest
from pyspark.sql import types as T

from tests.helpers import message, records
from tidelog.functions import summary as S
from tidelog.functions import text, times
from tidelog.operators import lineage, tables
from tidelog.operators.envelope import parse_envelopes
from tidelog.schemas import TARGET_COLUMNS


@pytest.fixture
def catalog(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS made")
    yield "made"
    spark.sql("DROP SCHEMA made CASCADE")


def test_create_and_evolve(spark, catalog):
    tables.create_table(spark, f"{catalog}.target")
    assert tuple(spark.table(f"{catalog}.target").columns) == TARGET_COLUMNS
    sample = parse_envelopes(records(spark, [message((1,), "INSERT", 1)])).drop("error")
    tables.auto_create(sample, f"{catalog}.auto", force_optional=True)
    assert "_cdc_op" not in spark.table(f"{catalog}.auto").columns
    extra = T.StructType.fromDDL("id string, note string, Version bigint")
    added = tables.evolve_table(spark, f"{catalog}.target", extra, case_insensitive=True)
    assert added.names == ["note"] and "note" in spark.table(f"{catalog}.target").columns
    assert not tables.evolve_table(spark, f"{catalog}.target", extra, case_insensitive=True).fields


def test_schema_differences():
    have, given = T.StructType.fromDDL("id bigint"), T.StructType.fromDDL("ID bigint not null, x int not null")
    assert tables.missing_fields(have, given).names == ["ID", "x"]
    added = tables.missing_fields(have, given, case_insensitive=True, force_optional=True)
    assert added.names == ["x"] and added["x"].nullable


def test_attempts():
    tries = []

    def failing(until):
        tries.append(1)
        if len(tries) < until:
            raise RuntimeError("busy")
        return len(tries)

    assert tables.with_attempts(lambda: failing(3)) == 3
    tries.clear()
    with pytest.raises(RuntimeError):
        tables.with_attempts(lambda: failing(9))
    assert len(tries) == 3


def test_partition_spec(spark):
    frame = spark.sql("SELECT 7 AS i, 'abcdefghijklm' AS s, TIMESTAMP_NTZ '2024-05-06 07:08:09' AS ts")
    spec = ["year(ts)", "month(ts)", "days(ts)", "hour(ts)", "bucket(i, 4)", "truncate(s, 10)", "s"]
    row = tables.with_partition_columns(frame, spec).first()
    assert (row.s_trunc, str(row.ts_month), str(row.ts_hour)) == ("abcdefghij", "2024-05-01 00:00:00", "2024-05-06 07:00:00")
    assert 0 <= row.i_bucket < 4
    with pytest.raises(ValueError):
        tables.partition_columns(["void(x)"])
    assert len(tables.writer_transforms(spec[:5])) == 5


def test_merge_on_read_properties():
    made = tables.create_statement("a.b", provider="iceberg", properties=tables.MERGE_ON_READ)
    assert "USING iceberg TBLPROPERTIES ('format-version' = '2'" in made


def test_scalar_functions(spark):
    from pyspark.sql import functions as F
    rows = spark.createDataFrame([(None,), ("",), ("one ",), ("one, two",), ("bucket(id, 4), type",), ("a,,",)], "s string")
    assert [r[0] for r in rows.select(text.split_trimmed(F.col("s"), nested=True)).collect()] == [
        [], [], ["one"], ["one", "two"], ["bucket(id, 4)", "type"], ["a"]]
    stamps = spark.createDataFrame([("16/05/2026-12:15",), ("2026-04-19T15:00:00Z",), ("soon",)], "s string")
    found = stamps.select(times.to_epoch_ms(times.parse_update_time(F.col("s"))).alias("ms")).collect()
    assert [r.ms for r in found] == [1778933700000, 1776610800000, None]
    offsets = spark.sql("""SELECT '{"0":3,"12":9}' AS t""").select(S.offsets_from_json(F.col("t"))).first()[0]
    assert offsets == {0: 3, 12: 9}


def test_latency_quantiles_are_exact_over_many_snapshots(spark):
    # More distinct latencies than an approximate quantile keeps apart.
    rows = spark.range(40_001).selectExpr("'t' AS table", "id AS snapshot_id", "id * 3 AS latency_ms")
    few = spark.createDataFrame([("u", 1, 7), ("u", 2, None), ("u", 3, 9), ("u", 4, 9)], "table string, snapshot_id long, latency_ms long")
    found = {r.table: tuple(r)[1:] for r in lineage.latency_distribution(rows.unionByName(few)).collect()}
    assert found == {"t": (40_001, 0, 60_000, 114_000, 120_000), "u": (3, 7, 9, 9, 9)}
