"""Whole jobs: ingestion into a store, streams with restarts, user steps."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registry import over_filtered, over_valid, query
from checks.row_queries import CURRENT
from tidelog.operators import commits, envelope, tables, versions
from tidelog.plans import ingest
from tidelog.session import shared_folder
from tidelog.sources.changelog import ChangelogStore
from tidelog.sources.topics import replay_batch, replay_stream, resume
from tidelog.streaming.ingest import CHANGELOG, STATE_STORE, start_ingest
from tidelog.streaming.version_filter import drop_redelivered

OPTIONS = replace(fx.OPTIONS, tolerate_errors=True)
KEYS = ["iceberg_table", "dedup_key"]


def _folder(spark) -> str:
    return f"{shared_folder(spark)}/job-{uuid.uuid4().hex}"


def _streamed(spark, sf, state) -> ChangelogStore:
    """Two runs on one checkpoint: the second half of the messages arrives while the query is down."""
    folder = _folder(spark)
    store = ChangelogStore(spark, f"{folder}/store")
    messages = fx.cdc_messages(spark, sf)
    # Offsets interleave, so the halves are cut by the messages' own order: low offsets first.
    middle = messages.agg(F.max("offset")).first()[0] // 2
    for part in (messages.where(F.col("offset") <= middle), messages.where(F.col("offset") > middle)):
        part.write.mode("append").parquet(f"{folder}/topics")
        start_ingest(replay_stream(spark, f"{folder}/topics"), store, OPTIONS, f"{folder}/checkpoint", state,
                     trigger={"availableNow": True}).awaitTermination()
    return store


@query("str_3_4_5_stream_with_state_store", over_filtered("SELECT id, version, tbl AS iceberg_table FROM acc"))
def stream_with_state_store(spark, sf):
    return _streamed(spark, sf, STATE_STORE).changelog().select("id", "version", "iceberg_table")


@query("str_4_5_stream_from_changelog", over_filtered(
    CURRENT.format(rows="acc") + "SELECT tbl AS iceberg_table, dedup_key, version FROM cur"))
def stream_from_changelog(spark, sf):
    return _streamed(spark, sf, CHANGELOG).current(OPTIONS).select("iceberg_table", "dedup_key", "version")


@query("str_5_new_checkpoint_same_store", over_filtered(
    CURRENT.format(rows="acc") + "SELECT tbl AS iceberg_table, dedup_key, version FROM cur"))
def new_checkpoint_same_store(spark, sf):
    """Each half of the messages has a topic folder and a checkpoint of its own; the store keeps the states."""
    folder = _folder(spark)
    store, messages = ChangelogStore(spark, f"{folder}/store"), fx.cdc_messages(spark, sf)
    middle = messages.agg(F.max("offset")).first()[0] // 2
    for at, part in enumerate((messages.where(F.col("offset") <= middle), messages.where(F.col("offset") > middle))):
        part.write.parquet(f"{folder}/topics{at}")
        start_ingest(replay_stream(spark, f"{folder}/topics{at}"), store, OPTIONS, f"{folder}/checkpoint{at}", CHANGELOG,
                     trigger={"availableNow": True}).awaitTermination()
    return store.current(OPTIONS).select("iceberg_table", "dedup_key", "version")


@query("snk_1_2_6_ingest_commits", over_filtered("""
    , halves AS (SELECT *, CASE WHEN off <= (SELECT max(off) // 2 FROM msg) THEN 0 ELSE 1 END AS half FROM acc)
    SELECT tbl AS "table", CAST(half AS BIGINT) AS commit_seq,
           CASE WHEN count(*) FILTER (op <> 'I') > 0 THEN 'overwrite' ELSE 'append' END AS operation,
           count(*) FILTER (op <> 'D') AS added_records,
           CAST(sum(count(*) FILTER (op <> 'D')) OVER (PARTITION BY tbl ORDER BY half) AS BIGINT) AS total_records
    FROM halves GROUP BY tbl, half"""))
def ingest_commits(spark, sf):
    folder = _folder(spark)
    fx.cdc_messages(spark, sf).write.parquet(f"{folder}/topics")
    records, store = replay_batch(spark, f"{folder}/topics"), ChangelogStore(spark, f"{folder}/store")
    middle = records.agg(F.max("offset")).first()[0] // 2
    ingest.ingest_batch(store, records.where(F.col("offset") <= middle), 0, OPTIONS)
    ingest.ingest_batch(store, records.where(F.col("offset") > middle), 1, OPTIONS)
    ingest.ingest_batch(store, records.where(F.col("offset") > middle), 1, OPTIONS)
    return store.snapshots().select("table", "commit_seq", "operation", "added_records", "total_records")


@query("src_2_start_position", over_valid("""
    SELECT id FROM msg WHERE CASE topic WHEN 'evt-click' THEN off >= (SELECT max(off) // 2 FROM msg)
                                        WHEN 'evt-view' THEN off >= (SELECT max(off) // 2 FROM msg) ELSE TRUE END"""))
def start_position(spark, sf):
    records = fx.cdc_messages(spark, sf)
    middle = records.agg(F.floor(F.max("offset") / 2).alias("next_offset"))
    # Two topics have committed offsets, the others start at the beginning.
    committed = records.where(F.col("topic").isin("evt-click", "evt-view")).select("topic", "partition").distinct()
    committed = committed.withColumn("_one", F.lit(1)).join(middle.withColumn("_one", F.lit(1)), "_one")
    return resume(records, committed, "earliest").select(envelope.record_id().alias("id"))


@query("str_8_stale_rows", over_filtered(
    "SELECT v.id, f.prev AS prev_version, v.version FROM valid v JOIN fold f ON v.off = f.off WHERE NOT f.ok"))
def stale_rows(spark, sf):
    levels = versions.chunk_levels(fx.cdc_messages(spark, sf))
    decided = versions.version_states(fx.valid_rows(spark, sf).select(*fx.FILTER_COLUMNS, "id"), chunk_bits=levels)
    return decided.where("NOT accepted").select("id", "prev_version", "version")


@query("str_9_states_kept", over_filtered("""
    SELECT topic, count(*) AS states FROM (
        SELECT topic, dedup_key FROM acc GROUP BY topic, dedup_key HAVING arg_max(type, off) <> 'DELETE') GROUP BY topic"""))
def states_kept(spark, sf):
    return versions.latest_states(fx.accepted_rows(spark, sf, fx.FILTER_COLUMNS)).groupBy("topic").agg(F.count(F.lit(1)).alias("states"))


@query("str_10_redelivered", over_valid("SELECT id FROM valid"))
def redelivered(spark, sf):
    rows = fx.valid_rows(spark, sf).select("id", "offset")
    return drop_redelivered(rows.unionByName(rows.where(F.col("offset") % 3 == 0))).select("id")


@query("ext_1_transform_chain", over_valid(
    "SELECT id, upper(dedup_key) || '!' AS dedup_key FROM valid WHERE op <> 'D' AND n_items = 2"))
def transform_chain(spark, sf):
    steps = [
        lambda df: df.where(F.col("_cdc_op") != "D"),
        lambda df: df.withColumn("dedup_key", F.concat(F.upper("dedup_key"), F.lit("!"))),
        lambda df: df.where(F.col("length") == "2"),
    ]
    return ingest.chain(fx.valid_rows(spark, sf), steps).select("id", "dedup_key")


@query("snk_13_bucket", "SELECT count(*) AS n, TRUE AS in_range, 16 AS buckets FROM orders")
def bucket(spark, sf):
    rows = tables.with_partition_columns(fx.table(spark, sf, "orders"), ["bucket(o_custkey, 16)"])
    number = F.col("o_custkey_bucket")
    return rows.agg(F.count(F.lit(1)).alias("n"), F.bool_and(number.between(0, 15)).alias("in_range"),
                    F.count_distinct(number).cast("int").alias("buckets"))


@query("snk_11_optional_columns", "SELECT o_orderkey, o_custkey, FALSE AS required FROM orders")
def optional_columns(spark, sf):
    rows = fx.table(spark, sf, "orders").select(F.coalesce("o_orderkey", F.lit(-1)).alias("o_orderkey"), "o_custkey")
    schema = tables.optional(rows.schema)
    return rows.to(schema).withColumn("required", F.lit(not all(f.nullable for f in schema.fields)))


@query("agg_15_commit_rate", over_valid("""
    , per AS (SELECT tbl, commit_seq, count(*) FILTER (op <> 'D') AS added,
                     (epoch_us((SELECT max(ts) FROM valid v WHERE v.commit_seq = m.commit_seq)) // 1000) AS ms
              FROM valid m GROUP BY tbl, commit_seq)
    SELECT tbl AS "table", commit_seq, CAST(floor(added * 1000000 / (ms - lag(ms) OVER w)) AS BIGINT) AS rows_per_1000_sec
    FROM per WINDOW w AS (PARTITION BY tbl ORDER BY commit_seq)"""))
def commit_rate(spark, sf):
    log = fx.snapshots(spark, sf)
    rates = commits.commit_rates(log).join(log.select("snapshot_id", "commit_seq"), "snapshot_id")
    return rates.select("table", "commit_seq", F.floor(F.col("added_records") * 1_000_000 / F.col("gap_ms")).alias(
        "rows_per_1000_sec"))
