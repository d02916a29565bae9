"""Version control, apply, set operations, joins, aggregates and windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registry import over_filtered, over_mentions, over_snapshots, over_valid, query
from checks.row_queries import CURRENT
from tidelog.operators import apply, audit, commits, envelope, lineage, tables, versions
from tidelog.operators.route import split_known_tables
from tidelog.session import cut_lineage, written_once

KEYS = ["iceberg_table", "dedup_key"]


# --- version control ----------------------------------------------------------------------------


def _halves(spark, sf):
    """Commits alternate between the stored table and the incoming batch."""
    rows = fx.changelog(spark, sf)
    return _parted(rows)


def _parted(rows):
    return rows.where(F.col("commit_seq") % 2 == 0), rows.where(F.col("commit_seq") % 2 == 1)


def _classified(spark, sf, rows=None):
    stored, incoming = _halves(spark, sf) if rows is None else _parted(rows)
    batch = versions.dedup_batch(incoming, KEYS)
    return versions.classify(batch, versions.existing_versions(stored, KEYS), KEYS)


CLASSIFIED = """
, stored AS (SELECT * FROM valid WHERE commit_seq % 2 = 0),
batch AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tbl, dedup_key ORDER BY version DESC, part DESC, off DESC) AS rn
                         FROM valid WHERE commit_seq % 2 = 1) WHERE rn = 1),
ex AS (SELECT tbl, dedup_key, max(version) AS existing_version FROM stored GROUP BY ALL),
cls AS (SELECT b.*, existing_version, CASE
    WHEN type = 'INSERT' THEN CASE WHEN existing_version IS NULL THEN 'INSERT' ELSE 'ERROR' END
    WHEN type = 'UPDATE' THEN CASE WHEN existing_version IS NULL THEN 'INSERT' WHEN version > existing_version THEN 'UPDATE' ELSE 'SKIP' END
    WHEN type = 'DELETE' THEN CASE WHEN existing_version IS NOT NULL AND version > existing_version THEN 'DELETE' ELSE 'SKIP' END
    END AS action
    FROM batch b LEFT JOIN ex USING (tbl, dedup_key))
"""


@query("agg_12_batch_dedup", over_valid(CLASSIFIED + "SELECT id, version FROM batch"))
def batch_dedup(spark, sf):
    return versions.dedup_batch(_halves(spark, sf)[1], KEYS).select("id", "version")


@query("joi_1_existing_versions", over_valid(CLASSIFIED + "SELECT id, version, existing_version FROM cls"))
def existing_versions(spark, sf):
    return _classified(spark, sf).select("id", "version", "existing_version")


@query("vc_1_classify", over_valid(CLASSIFIED + "SELECT id, type, version, existing_version, action FROM cls"))
def classify(spark, sf):
    return _classified(spark, sf).select("id", "type", "version", "existing_version", "action")


@query("vc_2_idempotence", over_valid(CLASSIFIED + "SELECT count(*) AS both_runs, 0 AS differing FROM cls"))
def idempotence(spark, sf):
    first, second = _classified(spark, sf), _classified(spark, sf)
    paired = first.select("id", "action").join(second.select("id", F.col("action").alias("again")), "id", "full")
    return paired.agg(
        F.count(F.lit(1)).alias("both_runs"),
        F.count_if(~F.col("action").eqNullSafe(F.col("again"))).cast("int").alias("differing"))


@query("vc_3_apply_classified", over_valid(CLASSIFIED + """
    SELECT id FROM stored WHERE (tbl, dedup_key) NOT IN (SELECT (tbl, dedup_key) FROM cls WHERE action IN ('UPDATE', 'DELETE'))
    UNION ALL SELECT id FROM cls WHERE action IN ('INSERT', 'UPDATE')"""))
def apply_classified(spark, sf):
    # Three branches read the changelog.
    columns = [*KEYS, "id", "version", "type", "partition", "offset", "commit_seq"]
    rows = written_once(fx.changelog(spark, sf).select(*columns))
    return versions.apply_classified(_parted(rows)[0], _classified(spark, sf, rows), KEYS).select("id")


@query("agg_13_batch_counters", over_valid(CLASSIFIED + """
    SELECT tbl AS iceberg_table, count(*) FILTER (action = 'INSERT') AS inserts, count(*) FILTER (action = 'UPDATE') AS updates,
    count(*) FILTER (action = 'DELETE') AS deletes, count(*) FILTER (action = 'SKIP') AS skipped,
    count(*) FILTER (action = 'ERROR') AS conflicts FROM cls GROUP BY tbl"""))
def batch_counters(spark, sf):
    return versions.action_counts(_classified(spark, sf), ["iceberg_table"])


@query("agg_14_conflict_rate", over_valid(CLASSIFIED + """
    SELECT tbl AS iceberg_table, commit_seq, count(*) AS messages,
           CAST(floor(1000.0 * count(*) FILTER (action = 'ERROR') / count(*)) AS BIGINT) AS per_mille,
           count(*) FILTER (action = 'ERROR') * 10 > count(*) AS alarm
    FROM cls GROUP BY tbl, commit_seq"""))
def conflict_rate(spark, sf):
    rates = versions.conflict_rate(_classified(spark, sf), ["iceberg_table", "commit_seq"])
    return rates.select(
        "iceberg_table", "commit_seq", "messages", F.floor(F.col("conflict_share") * 1000).alias("per_mille"), "alarm")


@query("agg_1_max_version", over_valid(
    "SELECT topic, dedup_key, max(version) AS max_version FROM valid WHERE type <> 'DELETE' GROUP BY topic, dedup_key"))
def max_version(spark, sf):
    rows = fx.valid_rows(spark, sf).where(F.col("type") != "DELETE")
    return versions.existing_versions(rows, ["topic", "dedup_key"]).withColumnRenamed("existing_version", "max_version")


@query("win_1_previous_version", over_valid("""
    SELECT id, max(version) OVER (PARTITION BY topic, dedup_key ORDER BY part, off
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_version
    FROM valid WHERE type <> 'DELETE'"""))
def previous_version(spark, sf):
    # No DELETE: the filter state is the running maximum, here without a window over whole keys.
    rows = fx.valid_rows(spark, sf).where(F.col("type") != "DELETE")
    return versions.version_states(rows).select("id", "prev_version")


@query("str_11_final_states", over_filtered("""
    SELECT topic, dedup_key, arg_max(CASE WHEN type = 'DELETE' THEN -1 ELSE version END, off) AS version
    FROM acc GROUP BY topic, dedup_key HAVING arg_max(type, off) <> 'DELETE'"""))
def final_states(spark, sf):
    return versions.latest_states(fx.accepted_rows(spark, sf, fx.FILTER_COLUMNS))


@query("str_11_batches_equal_replay", over_filtered("SELECT id, version FROM acc"))
def batches_equal_replay(spark, sf):
    # Two batches, the second starting from the states the first left, against one pass in the oracle.
    rows = fx.valid_rows(spark, sf)
    early = F.col("offset") < 4000
    first = versions.filter_versions(rows.where(early))
    second = versions.filter_versions(rows.where(~early), initial=versions.latest_states(first))
    return first.unionByName(second).select("id", "version")


# --- apply --------------------------------------------------------------------------------------


@query("app_1_delete_keys", over_valid(
    "SELECT DISTINCT tbl AS iceberg_table, dedup_key FROM valid WHERE op IN ('U', 'D')"))
def delete_keys(spark, sf):
    return apply.delete_keys(fx.changelog(spark, sf), KEYS)


@query("app_2_new_rows", over_valid("SELECT id, type FROM valid WHERE op IN ('I', 'U')"))
def new_rows(spark, sf):
    return apply.new_rows(fx.changelog(spark, sf)).select("id", "type")


COW = """
, stored AS (SELECT * FROM valid WHERE commit_seq % 2 = 0), batch AS (SELECT * FROM valid WHERE commit_seq % 2 = 1),
gone AS (SELECT DISTINCT tbl, dedup_key FROM batch WHERE op IN ('U', 'D'))
"""


@query("app_3_copy_on_write", over_valid(COW + CURRENT.format(rows="batch") + """
    SELECT id FROM stored ANTI JOIN gone USING (tbl, dedup_key) UNION ALL SELECT id FROM cur"""))
def copy_on_write(spark, sf):
    stored, batch = _halves(spark, sf)
    return apply.copy_on_write(stored, batch, KEYS).select("id")


@query("app_4_win_4_merge_on_read", over_valid(CURRENT.format(rows="valid") + "SELECT id, version FROM cur"))
def merge_on_read(spark, sf):
    return apply.merge_on_read(fx.changelog(spark, sf), KEYS).select("id", "version")


@query("app_5_append_only", over_valid("SELECT id FROM valid"))
def append_only(spark, sf):
    stored, batch = _halves(spark, sf)
    return apply.append_only(stored, batch).select("id")


@query("app_6_upsert_mode", over_valid("""
    SELECT id, version FROM (SELECT *, row_number() OVER (PARTITION BY tbl, dedup_key ORDER BY commit_seq DESC, part DESC, off DESC) AS rn
                             FROM valid) WHERE rn = 1 AND op <> 'D'"""))
def upsert_mode(spark, sf):
    return apply.merge_on_read(fx.changelog(spark, sf), KEYS, apply.UPSERT).select("id", "version")


@query("app_7_composite_id_columns", over_valid("""
    , last AS (SELECT tbl, dedup_key, n_items, upd, max((commit_seq, part, off)) AS l FROM valid WHERE op IN ('U', 'D') GROUP BY ALL)
    SELECT id FROM valid a LEFT JOIN last USING (tbl, dedup_key, n_items, upd)
    WHERE op <> 'D' AND (l IS NULL OR (commit_seq, part, off) >= l)"""))
def composite_id_columns(spark, sf):
    ids = [*KEYS, "length", "ngay_cap_nhat"]
    return apply.merge_on_read(fx.changelog(spark, sf), ids).select("id")


@query("app_8_expand_items", over_valid("""
    SELECT id, 'U' || user_id AS user_id, value FROM valid
    UNION ALL SELECT id, 'U' || (user_id + 1), value FROM valid WHERE n_items = 2"""))
def expand_items(spark, sf):
    return envelope.expand_items(fx.valid_rows(spark, sf).select("id", "record"), "user_id string, value double").drop("record")


@query("joi_2_set_1_key_delete", over_valid(COW + "SELECT id FROM stored ANTI JOIN gone USING (tbl, dedup_key)"))
def key_delete(spark, sf):
    stored, batch = _halves(spark, sf)
    return apply.remove_keys(stored, apply.delete_keys(batch, KEYS), KEYS).select("id")


@query("set_1_row_delta", over_valid(COW + """
    SELECT id FROM stored ANTI JOIN gone USING (tbl, dedup_key) UNION ALL SELECT id FROM batch WHERE op IN ('I', 'U')"""))
def row_delta(spark, sf):
    stored, batch = _halves(spark, sf)
    kept = apply.remove_keys(stored, apply.delete_keys(batch, KEYS), KEYS)
    return kept.unionByName(apply.new_rows(batch)).select("id")


@query("srt_2_order_by_key", over_valid("SELECT dedup_key, id FROM valid"))
def order_by_key(spark, sf):
    # Written first: ranges are found by reading the rows once more than the sort itself does.
    return written_once(fx.valid_rows(spark, sf).select("dedup_key", "id")).orderBy("dedup_key", "id")


@query("snk_7_unknown_tables", over_valid("""
    SELECT tbl AS iceberg_table, tbl NOT LIKE '%signup' AS known, count(*) AS n FROM valid GROUP BY ALL"""))
def unknown_tables(spark, sf):
    rows = written_once(fx.valid_rows(spark, sf).select("topic", "iceberg_table"))
    registry = rows.where(~F.col("topic").endswith("signup")).select("iceberg_table").distinct()
    known, unknown = split_known_tables(rows, registry)
    both = known.withColumn("known", F.lit(True)).unionByName(unknown.withColumn("known", F.lit(False)))
    return both.groupBy("iceberg_table", "known").agg(F.count(F.lit(1)).alias("n"))


@query("snk_10_schema_evolution", over_valid("""
    SELECT id, dedup_key, CASE WHEN commit_seq % 2 = 1 THEN version END AS version FROM valid"""))
def schema_evolution(spark, sf):
    stored, batch = _halves(spark, sf)
    return tables.evolve_union(stored.select("id", "dedup_key"), batch.select("id", "dedup_key", "version"))


@query("snk_12_case_insensitive", over_valid("SELECT id, dedup_key FROM valid"))
def case_insensitive(spark, sf):
    stored, batch = _halves(spark, sf)
    shouting = batch.select(F.col("id").alias("ID"), F.col("dedup_key").alias("Dedup_Key"))
    return tables.evolve_union(stored.select("id", "dedup_key"), shouting, case_insensitive=True)


@query("snk_13_partition_columns", """
    SELECT event_id, (epoch_us(date_trunc('year', ts)) // 1000) AS y, (epoch_us(date_trunc('month', ts)) // 1000) AS m,
           (epoch_us(date_trunc('day', ts)) // 1000) AS d, (epoch_us(date_trunc('hour', ts)) // 1000) AS h,
           substr(event_type, 1, 3) AS event_type_trunc, event_type FROM events""")
def partition_columns(spark, sf):
    spec = ["year(ts)", "month(ts)", "day(ts)", "hour(ts)", "truncate(event_type, 3)", "event_type"]
    rows = tables.with_partition_columns(fx.table(spark, sf, "events"), spec)
    moments = [F.unix_millis(F.col(f"ts_{u}").cast("timestamp")).alias(u[0]) for u in ("year", "month", "day", "hour")]
    return rows.select("event_id", *moments, "event_type_trunc", "event_type")


@query("snk_17_error_policy", over_valid("SELECT id, 'missing field key' AS error FROM msg WHERE NOT tomb AND nokey"))
def error_policy(spark, sf):
    return envelope.split_errors(fx.rows_with_errors(spark, sf))[1].select("id", "error")


# --- commit-event audit -------------------------------------------------------------------------


@query("agg_3_files_by_table", over_mentions("""
    SELECT commit_id, tbl AS "table", count(*) FILTER (content = 'data') AS data_files,
           count(*) FILTER (content = 'delete') AS delete_files, CAST(sum(record_count) AS BIGINT) AS records
    FROM f GROUP BY ALL"""))
def files_by_table(spark, sf):
    return audit.files_by_table(audit.files(fx.commit_events(spark, sf)))


@query("agg_4_win_2_unique_files", over_mentions(
    'SELECT commit_id, tbl AS "table", content, path, event_id, spec_id, record_count FROM uniq'))
def unique_files(spark, sf):
    return audit.unique_files(audit.files(fx.commit_events(spark, sf)))


@query("agg_5_duplicates_within_event", over_mentions("""
    SELECT tbl AS "table", commit_id, event_id, content, path, count(*) AS mentions FROM f
    GROUP BY ALL HAVING count(*) > 1"""))
def duplicates_within_event(spark, sf):
    return audit.duplicates_within_event(audit.files(fx.commit_events(spark, sf)))


@query("agg_5_duplicates_across_events", over_mentions("""
    SELECT commit_id, tbl AS "table", content, path, count(DISTINCT event_id) AS mentions, count(DISTINCT event_id) AS events
    FROM f GROUP BY ALL HAVING count(DISTINCT event_id) > 1"""))
def duplicates_across_events(spark, sf):
    return audit.duplicates_across_events(audit.files(fx.commit_events(spark, sf)))


@query("agg_6_completeness", over_mentions("""
    SELECT commit_id, count(asg.off) AS received, count(asg.off) >= 185 AS ready
    FROM (SELECT DISTINCT commit_id FROM ev) LEFT JOIN asg USING (commit_id) GROUP BY commit_id"""))
def completeness(spark, sf):
    return audit.completeness(fx.commit_events(spark, sf), 185)


@query("agg_8_low_watermark", over_mentions("""
    SELECT commit_id, CASE WHEN count(*) = count(ts) THEN min((epoch_us(ts) // 1000)) END AS watermark_ms FROM asg GROUP BY commit_id"""))
def low_watermark(spark, sf):
    marks = audit.low_watermarks(fx.commit_events(spark, sf))
    return marks.select("commit_id", F.unix_millis("watermark").alias("watermark_ms"))


@query("str_2_partial_commits", over_mentions("""
    , total AS (SELECT commit_id, count(asg.off) < 185 AS partial FROM asg GROUP BY commit_id)
    SELECT commit_id, bool_or(partial) AS partial,
           CASE WHEN NOT bool_or(partial) AND count(*) = count(ts) THEN min((epoch_us(ts) // 1000)) END AS watermark_ms
    FROM asg JOIN total USING (commit_id) GROUP BY commit_id"""))
def partial_commits(spark, sf):
    events = fx.commit_events(spark, sf).where(F.col("assignments").isNotNull())
    state = audit.completeness(events, 185).select("commit_id", (~F.col("ready")).alias("partial"))
    marks = audit.low_watermarks(events.join(state, "commit_id"), partial="partial")
    return marks.join(state, "commit_id").select("commit_id", "partial", F.unix_millis("watermark").alias("watermark_ms"))


@query("agg_9_snk_14_files_by_spec", over_mentions("""
    SELECT commit_id, tbl AS "table", spec_id, count(*) AS files, CAST(sum(record_count) AS BIGINT) AS records,
           spec_id = max(spec_id) OVER (PARTITION BY commit_id, tbl) AS carries_offsets
    FROM uniq WHERE content = 'data' AND record_count > 0 GROUP BY commit_id, tbl, spec_id"""))
def files_by_spec(spark, sf):
    unique = audit.unique_files(audit.files(fx.commit_events(spark, sf)))
    return audit.files_by_spec(audit.with_records(unique).where(F.col("content") == audit.DATA))


@query("win_3_last_spec", over_mentions("""
    SELECT commit_id, tbl AS "table", max(spec_id) AS spec_id FROM uniq WHERE record_count > 0 GROUP BY commit_id, tbl"""))
def last_spec(spark, sf):
    unique = audit.unique_files(audit.files(fx.commit_events(spark, sf)))
    specs = audit.files_by_spec(audit.with_records(unique))
    return specs.where("carries_offsets").select("commit_id", "table", "spec_id")


@query("flt_7_not_committed", over_mentions("""
    SELECT event_id, content, path, CAST(pos AS INTEGER) AS pos FROM f
    WHERE NOT (tbl = 'db.click' AND part = 0 AND off < 3000) AND NOT (tbl = 'db.view' AND part = 1 AND off < 5000)"""))
def not_committed(spark, sf):
    events = fx.commit_events(spark, sf)
    # Committed offsets as the table's own history gives them: two of its partitions are known.
    known = events.groupBy("table", "partition").agg(
        F.min(F.when(F.col("table") == "db.click", 3000).otherwise(5000)).cast("bigint").alias("committed_offset"))
    known = known.where("(table = 'db.click' AND partition = 0) OR (table = 'db.view' AND partition = 1)")
    return audit.not_committed(audit.files(events), known).select("event_id", "content", "path", "pos")


@query("flt_8_files_with_records", over_mentions("SELECT path, tbl AS \"table\", commit_id FROM uniq WHERE record_count > 0"))
def files_with_records(spark, sf):
    unique = audit.unique_files(audit.files(fx.commit_events(spark, sf)))
    return audit.with_records(unique).select("path", "table", "commit_id")


@query("flt_9_current_commit", over_mentions("SELECT event_id, type FROM ev WHERE commit_id = 'c1'"))
def current_commit(spark, sf):
    return audit.in_commit(fx.commit_events(spark, sf), "c1").select("event_id", "type")


@query("set_2_combined_responses", over_mentions(
    "SELECT commit_id, count(*) AS responses FROM ev WHERE type = 'DATA_WRITTEN' GROUP BY commit_id"))
def combined_responses(spark, sf):
    events = fx.commit_events(spark, sf).where(F.col("type") == "DATA_WRITTEN")
    parts = [events.where(F.col("partition") == n) for n in range(3)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("commit_id").agg(
        F.count(F.lit(1)).alias("responses"))


# --- commits ------------------------------------------------------------------------------------


@query("agg_2_source_offsets", over_valid("""
    SELECT topic, part AS partition, max(off) + 1 AS next_offset, (epoch_us(arg_max(ts, off)) // 1000) AS ts_ms FROM msg GROUP BY ALL"""))
def source_offsets(spark, sf):
    return commits.source_offsets(fx.cdc_messages(spark, sf)).select(
        "topic", "partition", "next_offset", F.unix_millis("ts").alias("ts_ms"))


@query("agg_10_offsets_json", over_snapshots("SELECT commit_seq, offsets FROM vec"))
def offsets_json(spark, sf):
    return commits.commit_vectors(fx.changelog(spark, sf)).select("commit_seq", "offsets")


@query("agg_10_offsets_round_trip", over_mentions("SELECT part AS partition, max(off) + 1 AS next_offset FROM ev GROUP BY part"))
def offsets_round_trip(spark, sf):
    from tidelog.functions import summary as S
    offsets = audit.next_offsets(fx.raw_commit_events(spark, sf))
    entry = F.struct(F.col("partition").cast("string").alias("name"), F.col("next_offset").alias("offset"))
    text = offsets.agg(S.offsets_to_json(F.collect_list(entry)).alias("text"))
    return text.select(F.explode(S.offsets_from_json(F.col("text"))).alias("partition", "next_offset"))


@query("agg_8_str_7_commit_watermarks", over_snapshots("""
    , want AS (SELECT DISTINCT topic, part FROM valid),
    grid AS (SELECT commit_seq, topic, part FROM (SELECT DISTINCT commit_seq FROM valid), want)
    SELECT commit_seq, CASE WHEN count(*) = count(ts) THEN min((epoch_us(ts) // 1000)) END AS watermark_ms
    FROM grid LEFT JOIN off_p USING (commit_seq, topic, part) GROUP BY commit_seq"""))
def commit_watermarks(spark, sf):
    rows = fx.changelog(spark, sf)
    assigned = rows.select("topic", "partition").distinct()
    vectors = commits.commit_vectors(rows, assigned=assigned)
    return vectors.select("commit_seq", F.unix_millis("watermark").alias("watermark_ms"))


@query("snk_1_2_commit_operation", over_snapshots(
    "SELECT tbl AS iceberg_table, commit_seq, added AS added_records, removed AS removed_keys, operation FROM snap"))
def commit_operation(spark, sf):
    return commits.table_changes(fx.changelog(spark, sf))


@query("snk_1_append_commit", over_valid("""
    SELECT tbl AS iceberg_table, commit_seq, count(*) AS added_records, 'append' AS operation FROM valid
    WHERE op = 'I' GROUP BY ALL"""))
def append_commit(spark, sf):
    changes = commits.table_changes(fx.changelog(spark, sf).where(F.col("_cdc_op") == "I"))
    return changes.select("iceberg_table", "commit_seq", "added_records", "operation")


@query("snk_1_append_only_counts", over_valid("""
    SELECT tbl AS iceberg_table, commit_seq, count(*) AS added_records, CAST(0 AS BIGINT) AS removed_keys,
           'append' AS operation FROM valid GROUP BY ALL"""))
def append_only_counts(spark, sf):
    return commits.table_changes(fx.changelog(spark, sf), mode=commits.APPEND_ONLY)


@query("app_6_upsert_counts", over_valid("""
    SELECT tbl AS iceberg_table, commit_seq, count(*) FILTER (op <> 'D') AS added_records, count(*) AS removed_keys,
           'overwrite' AS operation FROM valid GROUP BY ALL"""))
def upsert_counts(spark, sf):
    return commits.table_changes(fx.changelog(spark, sf), mode=commits.UPSERT)


@query("snk_3_empty_commits", over_valid("""
    SELECT m.commit_seq, count(DISTINCT CASE WHEN op = 'D' AND NOT tomb AND NOT nokey THEN tbl END) AS snapshots
    FROM msg m GROUP BY m.commit_seq"""))
def empty_commits(spark, sf):
    # Only deletes count here, so commits without any leave a cycle record and no snapshot.
    cycles = fx.numbered(fx.cdc_messages(spark, sf)).select("commit_seq").distinct()
    deletes = fx.changelog(spark, sf).where(F.col("_cdc_op") == "D")
    made = commits.skip_empty(commits.table_changes(deletes)).groupBy("commit_seq").agg(F.count(F.lit(1)).alias("n"))
    return cycles.join(made, "commit_seq", "left").select("commit_seq", F.coalesce("n", F.lit(0)).alias("snapshots"))


@query("snk_6_fan_out", over_valid("SELECT tbl AS iceberg_table, commit_seq, count(*) AS n FROM valid GROUP BY ALL"))
def fan_out(spark, sf):
    return fx.changelog(spark, sf).groupBy("iceberg_table", "commit_seq").agg(F.count(F.lit(1)).alias("n"))


@query("agg_11_record_totals", over_snapshots(
    "SELECT tbl AS iceberg_table, commit_seq, added AS added_records, total AS total_records FROM snap"))
def record_totals(spark, sf):
    totals = commits.running_totals(commits.table_changes(fx.changelog(spark, sf)))
    return totals.select("iceberg_table", "commit_seq", "added_records", "total_records")


@query("snk_5_branches", over_snapshots(
    "SELECT snapshot_id, CASE WHEN tbl = 'web.clicks' THEN 'audit' ELSE 'main' END AS branch FROM snap"))
def branches(spark, sf):
    return fx.snapshots(spark, sf).select("snapshot_id", "branch")


@query("snk_16_table_audit", over_snapshots(
    'SELECT commit_id, tbl AS "table", snapshot_id, wm AS watermark_ms FROM snap'))
def table_audit(spark, sf):
    return commits.commit_audit(fx.snapshots(spark, sf))[0]


@query("snk_16_cycle_audit", over_snapshots(
    "SELECT commit_id, count(*) AS tables, max(wm) AS watermark_ms FROM snap GROUP BY commit_id"))
def cycle_audit(spark, sf):
    return commits.commit_audit(fx.snapshots(spark, sf))[1]


@query("agg_15_win_5_commit_rates", over_snapshots("""
    SELECT tbl AS "table", snapshot_id, ingest_ms - lag(ingest_ms) OVER w AS gap_ms, added AS added_records
    FROM snap WINDOW w AS (PARTITION BY tbl ORDER BY commit_seq)"""))
def commit_rates(spark, sf):
    return commits.commit_rates(fx.snapshots(spark, sf)).drop("rows_per_sec")


# --- snapshot metadata --------------------------------------------------------------------------


@query("src_6_snapshot_scan", over_snapshots("""
    SELECT tbl AS "table", snapshot_id, lag(snapshot_id) OVER (PARTITION BY tbl ORDER BY commit_seq) AS parent_id,
           commit_seq, ingest_ms AS committed_ms, operation FROM snap"""))
def snapshot_scan(spark, sf):
    return fx.snapshots(spark, sf).select(
        "table", "snapshot_id", "parent_id", "commit_seq", F.unix_millis("committed_at").alias("committed_ms"), "operation")


@query("met_1_summary_entries", over_snapshots("""
    SELECT snapshot_id, 'task.engine' AS name, 'consumer' AS value FROM snap
    UNION ALL SELECT snapshot_id, 'consumer.typeingest', 'API' FROM snap
    UNION ALL SELECT snapshot_id, 'consumer.connectorname', 'sink-events' FROM snap
    UNION ALL SELECT snapshot_id, 'consumer.ingest.time', CAST(ingest_ms AS VARCHAR) FROM snap
    UNION ALL SELECT snapshot_id, 'kafka.connect.commit-id', commit_id FROM snap
    UNION ALL SELECT snapshot_id, 'kafka.connect.offsets.control-iceberg.cg-control-sink', offsets FROM snap
    UNION ALL SELECT snapshot_id, 'consumer.vtts.time', CAST(wm AS VARCHAR) FROM snap WHERE wm IS NOT NULL
    UNION ALL SELECT snapshot_id, 'added-records', CAST(added AS VARCHAR) FROM snap
    UNION ALL SELECT snapshot_id, 'total-records', CAST(total AS VARCHAR) FROM snap
    UNION ALL SELECT snapshot_id, 'pipeline.owner', 'data-team' FROM snap"""))
def summary_entries(spark, sf):
    return fx.snapshots(spark, sf).select("snapshot_id", F.explode("summary").alias("name", "value"))


NEWEST = "ORDER BY ingest_ms DESC, snapshot_id DESC LIMIT 5"


@query("met_2_srt_1_lineage_report", over_snapshots(f"""
    SELECT snapshot_id, 'consumer' AS task_engine, 'API' AS consumer_typeingest, 'sink-events' AS consumer_connectorname,
           CAST(ingest_ms AS VARCHAR) AS consumer_ingest_time, CAST(wm AS VARCHAR) AS consumer_vtts_time,
           commit_id AS kc_commit_id, CAST(added AS VARCHAR) AS added_records, CAST(total AS VARCHAR) AS total_records
    FROM snap {NEWEST}"""))
def lineage_report(spark, sf):
    return lineage.lineage_report(lineage.newest(fx.snapshots(spark, sf))).drop("committed_at")


@query("met_3_checkpoint_report", over_snapshots(f"""
    SELECT snapshot_id, offsets AS committed_offsets, commit_id, CAST(total AS VARCHAR) AS total_records FROM snap {NEWEST}"""))
def checkpoint_report(spark, sf):
    newest = lineage.newest(fx.snapshots(spark, sf))
    return lineage.checkpoint_report(newest, fx.OPTIONS.control_topic, fx.GROUP).drop("committed_at")


@query("met_4_ingest_latency", over_snapshots(
    'SELECT tbl AS "table", snapshot_id, ingest_ms - wm AS latency_ms FROM snap'))
def ingest_latency(spark, sf):
    return lineage.ingest_latency(fx.snapshots(spark, sf))


@query("met_4_latency_distribution", over_snapshots("""
    SELECT tbl AS "table", count(*) AS snapshots, min(ingest_ms - wm) AS min_ms,
           quantile_disc(ingest_ms - wm, 0.5) AS p50_ms, quantile_disc(ingest_ms - wm, 0.95) AS p95_ms,
           max(ingest_ms - wm) AS max_ms FROM snap WHERE wm IS NOT NULL GROUP BY tbl"""))
def latency_distribution(spark, sf):
    return lineage.latency_distribution(lineage.ingest_latency(fx.snapshots(spark, sf)))


@query("met_5_cycle_tables", over_snapshots("""
    SELECT commit_id, count(DISTINCT tbl) AS tables, count(*) AS snapshots, string_agg(tbl, ',' ORDER BY tbl) AS table_list
    FROM snap GROUP BY commit_id"""))
def cycle_tables(spark, sf):
    return lineage.cycle_tables(fx.snapshots(spark, sf))


@query("met_6_extra_summary", over_snapshots(
    "SELECT snapshot_id, 'data-team' AS owner, CAST(added + removed AS VARCHAR) AS touched FROM snap"))
def extra_summary(spark, sf):
    from tidelog.functions import summary as S
    rows = fx.changelog(spark, sf)
    changes = commits.running_totals(commits.table_changes(rows)).withColumn("ingest_ms", F.lit(0).cast("bigint"))
    touched = {"rows.touched": F.col("added_records") + F.col("removed_keys")}
    made = commits.snapshot_rows(changes, commits.commit_vectors(rows), fx.OPTIONS, fx.GROUP, extra=touched)
    summary = F.col("summary")
    return made.select("snapshot_id", S.summary_value(summary, "pipeline.owner").alias("owner"),
                       S.summary_value(summary, "rows.touched").alias("touched"))


@query("met_8_snapshot_uuid", over_snapshots("""
    SELECT snapshot_id, substr(md5(tbl || '#' || commit_id), 1, 8) AS uuid_head FROM snap"""))
def snapshot_uuid(spark, sf):
    from tidelog.functions import summary as S
    commit_id = S.summary_value(F.col("summary"), S.COMMIT_ID)
    uuid = S.stable_uuid(F.col("table"), commit_id)
    return fx.snapshots(spark, sf).select("snapshot_id", F.substring(uuid, 1, 8).alias("uuid_head"))


def _traced_files(spark, sf):
    """Files as a changelog partitioned by table and commit would have them."""
    # The log and the rows are read for many aggregates, so each is written first.
    columns = ["id", "iceberg_table", "commit_seq", "topic", "partition", "offset", "timestamp", "_cdc_op"]
    stored = written_once(fx.changelog(spark, sf).select(*columns))
    log = written_once(fx.snapshots(spark, sf, rows=stored))
    rows = stored.withColumn(
        "file_path", F.concat_ws("/", F.col("iceberg_table"), F.col("commit_seq").cast("string"), F.col("partition").cast("string")))
    added = log.select(F.col("table").alias("iceberg_table"), "commit_seq", F.col("snapshot_id").alias("added_snapshot_id"))
    files = rows.groupBy("file_path", "iceberg_table", "commit_seq").agg(F.count(F.lit(1)).alias("record_count"))
    return rows, lineage.file_lineage(files.join(added, ["iceberg_table", "commit_seq"]), log)


@query("joi_3_file_lineage", over_snapshots("""
    SELECT tbl || '/' || commit_seq || '/' || part AS file_path, snapshot_id AS added_snapshot_id, operation, count(*) AS record_count
    FROM valid JOIN snap USING (tbl, commit_seq) GROUP BY ALL"""))
def file_lineage(spark, sf):
    return _traced_files(spark, sf)[1].select("file_path", "added_snapshot_id", "operation", "record_count")


@query("met_7_row_trace", over_snapshots("""
    SELECT id, tbl || '/' || commit_seq || '/' || part AS file_path, snapshot_id AS added_snapshot_id, commit_id
    FROM valid JOIN snap USING (tbl, commit_seq)"""))
def row_trace(spark, sf):
    from tidelog.functions import summary as S
    rows, files = _traced_files(spark, sf)
    traced = lineage.row_lineage(rows.select("id", "file_path"), files)
    return traced.select("id", "file_path", "added_snapshot_id", S.summary_value(F.col("summary"), S.COMMIT_ID).alias("commit_id"))


@query("joi_4_connector_config", over_snapshots("""
    SELECT tbl AS "table", snapshot_id, 'sink-events' AS connector_name, 'endpoint-1' AS rdb_endpoints_id,
           (SELECT string_agg(topic, ',' ORDER BY topic) FROM (SELECT DISTINCT topic FROM msg)) AS topics FROM snap"""))
def connector_config(spark, sf):
    topics = fx.cdc_messages(spark, sf).select("topic").distinct()
    configs = topics.agg(F.array_join(F.array_sort(F.collect_list("topic")), ",").alias("topics")).select(
        F.lit("sink-events").alias("connector_name"),
        F.create_map(F.lit("rdbEndpointsId"), F.lit("endpoint-1"), F.lit("topics"), F.col("topics")).alias("config"))
    return lineage.connector_lineage(fx.snapshots(spark, sf), configs)


def _sparse_offsets(spark, sf):
    """The log with the offsets entry left on every third commit only."""
    key = "kafka.connect.offsets.control-iceberg.cg-control-sink"
    thinned = F.map_filter("summary", lambda name, _: (name != key) | (F.col("commit_seq") % 3 == 0))
    return fx.snapshots(spark, sf).withColumn("summary", thinned)


@query("joi_5_offsets_by_ancestry", over_snapshots("""
    SELECT h.tbl AS "table", h.snapshot_id AS head_id, arg_max(a.offsets, a.commit_seq) AS offsets
    FROM snap h JOIN snap a ON a.tbl = h.tbl AND a.commit_seq <= h.commit_seq AND a.commit_seq % 3 = 0 GROUP BY ALL"""))
def offsets_by_ancestry(spark, sf):
    # A written log, as it is in a store: the recursion reads it once per step.
    log = cut_lineage(_sparse_offsets(spark, sf))
    found = lineage.committed_offsets_by_ancestry(
        log, log.select("table", "snapshot_id"), fx.OPTIONS.control_topic, fx.GROUP)
    return found.select("table", "head_id", "offsets")


@query("joi_5_committed_offsets", over_snapshots("""
    SELECT tbl AS "table", arg_max(offsets, commit_seq) AS offsets FROM snap WHERE commit_seq % 3 = 0 GROUP BY tbl"""))
def committed_offsets(spark, sf):
    return lineage.committed_offsets(_sparse_offsets(spark, sf), fx.OPTIONS.control_topic, fx.GROUP)
