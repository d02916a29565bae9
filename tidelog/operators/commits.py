"""Commit metadata: offsets, low watermark, counts, the snapshot log and the commit audit.

Everything is an aggregate over the changelog (or one batch of it) that shrinks before it is shuffled.
The largest group that is ever collected is the list of topic partitions of one commit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions import summary as S
from tidelog.functions.times import to_epoch_ms
from tidelog.options import IngestOptions

APPEND, OVERWRITE = "append", "overwrite"
# How rows change tables: every row is added, changes by operation, or changes whose inserts replace too.
APPEND_ONLY, CHANGES, UPSERT = "append-only", "changes", "upsert"


def source_offsets(records: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Next offset per topic partition and the time of its last record. Tombstones count as read."""
    return records.groupBy(*by, "topic", "partition").agg(
        (F.max("offset") + 1).alias("next_offset"), F.max_by("timestamp", "offset").alias("ts")
    )


def watermark(ts: Column, partial: Column | bool = False) -> Column:
    """Aggregate: the smallest of the last record times; null for a partial commit or an idle partition."""
    partial = partial if isinstance(partial, Column) else F.lit(partial)
    complete = F.count(F.lit(1)) == F.count(ts)
    return F.when(complete & ~F.bool_or(partial), F.min(ts))


def commit_vectors(
    records: DataFrame,
    by: Sequence[str] = ("commit_seq",),
    assigned: DataFrame | None = None,
    partial: Column | bool = False,
) -> DataFrame:
    """Per commit: offsets as JSON keyed ``topic/partition``, and the low watermark.

    ``assigned`` lists all topic partitions a commit was responsible for (``by`` columns optional);
    one without records makes the watermark null.
    """
    offsets = source_offsets(records, by)
    if assigned is not None:
        if not set(by) <= set(assigned.columns):
            assigned = _assigned_per_commit(offsets, assigned, by)
        offsets = assigned.join(offsets, [*by, "topic", "partition"], "left")
    entry = F.struct(F.concat_ws("/", "topic", "partition").alias("name"), F.col("next_offset").alias("offset"))
    return offsets.groupBy(*by).agg(
        S.offsets_to_json(F.collect_list(F.when(F.col("next_offset").isNotNull(), entry))).alias("offsets"),
        watermark(F.col("ts"), partial).alias("watermark"),
    )


def _assigned_per_commit(offsets: DataFrame, assigned: DataFrame, by: Sequence[str]) -> DataFrame:
    """The assignment repeated for each commit: its list of topic partitions rides along as one value."""
    places = assigned.groupBy(F.lit(1).alias("_all")).agg(
        F.collect_set(F.struct("topic", "partition")).alias("_places")
    )
    commits = offsets.select(*by, F.lit(1).alias("_all")).distinct()
    return commits.join(places, "_all").select(*by, F.inline("_places"))


def mode_of(options: IngestOptions) -> str:
    if options.upsert:
        return UPSERT
    return CHANGES if options.cdc_field is not None else APPEND_ONLY


def table_changes(
    changelog: DataFrame, by: Sequence[str] = ("iceberg_table", "commit_seq"), mode: str = CHANGES
) -> DataFrame:
    """Per table and commit: rows added, keys removed, and the operation this makes it.

    Without a change field every row is added and none removed; with upsert an insert removes its key first.
    """
    operation = F.col("_cdc_op")
    added = F.lit(True) if mode == APPEND_ONLY else operation.isin("I", "U")
    removing = {APPEND_ONLY: F.lit(False), CHANGES: operation.isin("U", "D"), UPSERT: operation.isin("I", "U", "D")}
    counted = changelog.groupBy(*by).agg(
        F.count_if(added).alias("added_records"), F.count_if(removing[mode]).alias("removed_keys")
    )
    return counted.withColumn("operation", F.when(F.col("removed_keys") > 0, OVERWRITE).otherwise(APPEND))


def running_totals(changes: DataFrame, by: Sequence[str] = ("iceberg_table",)) -> DataFrame:
    """Adds ``total_records``. The window runs over one row per table and commit."""
    window = Window.partitionBy(*by).orderBy("commit_seq").rowsBetween(Window.unboundedPreceding, 0)
    return changes.withColumn("total_records", F.sum("added_records").over(window))


def skip_empty(changes: DataFrame) -> DataFrame:
    """A commit that brought a table nothing makes no snapshot there."""
    return changes.where((F.col("added_records") > 0) | (F.col("removed_keys") > 0))


def summary_column(options: IngestOptions, extra: dict[str, Column] | None = None) -> Column:
    """Summary map over columns commit_id, ingest_ms, offsets, watermark, added_records, total_records.

    ``extra`` adds fixed or computed entries; the fixed ones of the options are included.
    """
    own = {name: F.lit(value) for name, value in options.extra_summary.items()}
    return S.summary_map(
        {
            S.COMMIT_ID: F.col("commit_id"),
            S.TASK_ENGINE: F.lit(options.task_engine),
            S.TYPE_INGEST: F.lit(options.type_ingest),
            S.CONNECTOR_NAME: F.lit(options.name),
            S.INGEST_TIME: F.col("ingest_ms"),
            S.offsets_key(options.control_topic, options.group_id): F.col("offsets"),
            S.WATERMARK_TIME: to_epoch_ms(F.col("watermark")),
            S.ADDED_RECORDS: F.col("added_records"),
            S.TOTAL_RECORDS: F.col("total_records"),
            **own,
            **(extra or {}),
        }
    )


def snapshot_rows(
    changes: DataFrame,
    vectors: DataFrame,
    options: IngestOptions,
    job: str,
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """Snapshot log rows. ``changes``: table_changes with totals and ``ingest_ms``; ``vectors``: commit_vectors."""
    table, seq = F.col("iceberg_table"), F.col("commit_seq")
    joined = changes.join(vectors, "commit_seq", "left").withColumn("commit_id", S.stable_uuid(F.lit(job), seq))
    history = Window.partitionBy("iceberg_table").orderBy("commit_seq")
    identified = joined.withColumn("snapshot_id", S.stable_snapshot_id(table, seq))
    return identified.select(
        table.alias("table"),
        branch_column(options, table).alias("branch"),
        "snapshot_id",
        F.lag("snapshot_id").over(history).alias("parent_id"),
        "commit_seq",
        F.timestamp_millis("ingest_ms").alias("committed_at"),
        "operation",
        summary_column(options, extra).alias("summary"),
    )


def branch_column(options: IngestOptions, table: Column) -> Column:
    """Branch to commit to: the table's own, else the default, else none."""
    branch = F.lit(options.default_branch).cast("string")
    for name, own in options.table_options.items():
        branch = F.when(table == name, F.lit(own.commit_branch).cast("string")).otherwise(branch)
    return branch


def commit_audit(snapshots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(one record per table and commit, one per commit cycle), each with the watermark."""
    per_table = snapshots.select(
        S.summary_value(F.col("summary"), S.COMMIT_ID).alias("commit_id"),
        "table",
        "snapshot_id",
        S.summary_value(F.col("summary"), S.WATERMARK_TIME).cast("bigint").alias("watermark_ms"),
    )
    per_cycle = per_table.groupBy("commit_id").agg(
        F.count(F.lit(1)).alias("tables"), F.max("watermark_ms").alias("watermark_ms")
    )
    return per_table, per_cycle


def cycle_audit(commits: DataFrame, vectors: DataFrame, job: str) -> DataFrame:
    """One record per cycle, also for cycles that left no snapshot."""
    return commits.select("commit_seq").distinct().join(vectors, "commit_seq", "left").select(
        S.stable_uuid(F.lit(job), F.col("commit_seq")).alias("commit_id"),
        "commit_seq",
        to_epoch_ms(F.col("watermark")).alias("watermark_ms"),
    )


def commit_rates(snapshots: DataFrame) -> DataFrame:
    """Gap to the previous snapshot of the table and rows per second over it."""
    history = Window.partitionBy("table").orderBy("commit_seq")
    now = to_epoch_ms(F.col("committed_at"))
    gap = now - F.lag(now).over(history)
    added = S.summary_value(F.col("summary"), S.ADDED_RECORDS).cast("bigint")
    return snapshots.select(
        "table", "snapshot_id", gap.alias("gap_ms"), added.alias("added_records"),
        F.when(gap > 0, F.round(added * 1000 / gap, 3)).alias("rows_per_sec"),
    )
