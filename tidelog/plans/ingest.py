"""One ingestion commit: records in, changelog rows, snapshots and a cycle record out."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tidelog.functions import summary as S
from tidelog.operators import commits, envelope, lineage, route, versions
from tidelog.options import IngestOptions
from tidelog.sources.changelog import APPLIED, QUARANTINED, SKIPPED, ChangelogStore
from tidelog.sources.keyed_states import KeyedStates

Step = Callable[[DataFrame], DataFrame]


def transform(
    records: DataFrame, options: IngestOptions, scope: Sequence[str] = ("topic",), initial: DataFrame | KeyedStates | None = None,
    chunk_bits: Sequence[int] = versions.DEFAULT_CHUNK_BITS,
) -> DataFrame:
    """Records to accepted ten-field rows; ``error`` is still there."""
    parsed = envelope.parse_envelopes(records, options.namespace, options.topic_tables)
    return versions.filter_versions(parsed, scope=scope, initial=initial, chunk_bits=chunk_bits)


def chain(rows: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """User-defined steps; a step drops a row by filtering it."""
    for step in steps:
        rows = rows.transform(step)
    return rows


def to_tables(rows: DataFrame, options: IngestOptions) -> DataFrame:
    """Rows to their tables by the configured rule; a static rule may send a row to several.

    Rows no rule sends anywhere stay, with a null table: their offsets count as read.
    """
    if options.dynamic_tables:
        routed = route.route_dynamic(rows, options.route_field, keep_unrouted=True)
    elif options.tables is None:
        return rows
    elif options.route_field is None:
        routed = route.route_to_all(rows, options.tables)
    else:
        patterns = {name: options.for_table(name).route_regex for name in options.tables}
        routed = route.route_by_pattern(rows, options.route_field, patterns, keep_unrouted=True)
    return routed.drop("iceberg_table").withColumnRenamed("route_table", "iceberg_table")


def commit(
    store: ChangelogStore,
    accepted: DataFrame,
    seq: int,
    options: IngestOptions,
    tombstones: DataFrame | None = None,
    registry: DataFrame | None = None,
    assigned: DataFrame | None = None,
    steps: Sequence[Step] = (),
    states: Callable[[], DataFrame] | None = None,
) -> bool:
    """Writes commit ``seq`` unless it is already there. Returns whether it was written.

    Order of writing: rows, filter states (if given), snapshots, and the cycle record that makes them visible. A failure
    before the last step leaves nothing readers can see, and the same commit can be done again. The rows are
    computed once, by the job that writes them; counts and offsets are read from what was written.
    """
    if store.committed(seq):
        return False
    rows = chain(accepted, steps)
    if not options.tolerate_errors:
        rows = envelope.fail_on_errors(rows).withColumn("error", F.lit(None).cast("string"))
    routed = to_tables(rows, options)
    known = F.col("iceberg_table").isNotNull()
    if registry is not None:
        routed = route.mark_known_tables(routed, registry)
        known = known & F.col("table_known")
    fate = F.when(F.col("error").isNotNull(), QUARANTINED).when(known, APPLIED).otherwise(SKIPPED)
    # Rebalancing splits what one big table gets over many files and packs small tables together.
    (
        routed.withColumn("fate", fate).drop("table_known").hint("rebalance", "fate", "iceberg_table")
        .write.mode("overwrite").partitionBy("fate", "iceberg_table").parquet(store.folder("changelog", seq))
    )
    if states is not None:
        store.write_states(seq, states())
    _write_metadata(store, seq, options, tombstones, assigned)
    return True


def _write_metadata(store, seq, options, tombstones, assigned) -> None:
    spark, written = store.spark, store.written(seq)
    read = written.where(F.col("fate") != QUARANTINED).select("topic", "partition", "offset", "timestamp")
    if tombstones is not None:
        read = read.unionByName(tombstones.select(*read.columns))
    vectors = commits.commit_vectors(read.withColumn("commit_seq", F.lit(seq).cast("bigint")), assigned=assigned)
    applied = written.where(F.col("fate") == APPLIED)
    changes = commits.skip_empty(commits.table_changes(applied, mode=commits.mode_of(options)))
    before = store.heads_before(seq)
    previous = before.select(
        F.col("table").alias("iceberg_table"), F.col("snapshot_id").alias("parent_id"),
        F.col("total_records").alias("_total"),
    )
    changes = changes.join(previous, "iceberg_table", "left").select(
        *changes.columns,
        "parent_id",
        F.unix_millis(F.current_timestamp()).alias("ingest_ms"),
        (F.coalesce("_total", F.lit(0)) + F.col("added_records")).alias("total_records"),
    )
    counts = changes.select(F.col("iceberg_table").alias("table"), "parent_id", "added_records", "total_records")
    extra = None
    if options.latency_sketch:
        age = lineage.record_latency(F.unix_millis(F.current_timestamp()), F.col("timestamp"))
        changes = changes.join(applied.groupBy("iceberg_table").agg(lineage.latency_sketch(age).alias("_sketch")), "iceberg_table", "left")
        extra = {S.LATENCY_SKETCH: F.col("_sketch")}
    snapshots = commits.snapshot_rows(changes, vectors, options, options.group_id, extra)
    snapshots = snapshots.drop("parent_id", "commit_seq").join(counts, "table")
    # At most one row per table, so one file; it appears as a whole or not at all.
    snapshots.coalesce(1).write.mode("overwrite").parquet(store.folder("snapshots", seq))
    made = store.new_snapshots(seq).select("table", "snapshot_id", "total_records", "commit_seq")
    heads = made.unionByName(before.join(made.select("table"), "table", "left_anti"))
    heads.coalesce(1).write.mode("overwrite").parquet(store.folder("heads", seq))
    cycle = spark.range(1).select(F.lit(seq).cast("bigint").alias("commit_seq")).join(vectors, "commit_seq", "left")
    cycle.select(
        S.stable_uuid(F.lit(options.group_id), F.col("commit_seq")).alias("commit_id"),
        F.unix_millis("watermark").alias("watermark_ms"),
        "offsets",
    ).coalesce(1).write.mode("overwrite").parquet(store.folder("cycles", seq))


def ingest_batch(
    store: ChangelogStore,
    records: DataFrame,
    seq: int,
    options: IngestOptions,
    scope: Sequence[str] = ("topic",),
    chunk_bits: Sequence[int] | None = None,
    **how,
) -> bool:
    """Records to a commit. The filter states come from the store: the last accepted version per key.

    States are those of all accepted rows, before user steps, routing and quarantine, so the result does not depend on
    how a stream is cut into batches. Runs on the JVM alone; a repeated batch gives the same rows.

    Rows come first, so an attempt that fails while they are written has not paid for states. Without user steps the
    states are read back from the written rows, and nothing is held in memory.
    """
    if store.committed(seq):
        return False
    accepted = transform(records, options, scope, filter_states(store, scope), chunk_bits or versions.chunk_levels(records))
    tombstones = records.where(F.col("value").isNull())
    if not how.get("steps") and set(scope) <= {"topic"} and _keeps_rows(options):
        return commit(store, accepted, seq, options, tombstones=tombstones,
                      states=lambda: versions.changed_states(store.written(seq), scope), **how)
    held = accepted.persist(StorageLevel.MEMORY_AND_DISK)  # states and rows come from one run of the filter
    try:
        return commit(store, held, seq, options, tombstones=tombstones, states=lambda: versions.changed_states(held, scope), **how)
    finally:
        held.unpersist()


def _keeps_rows(options: IngestOptions) -> bool:
    """Whether routing keeps every row at least once; sending all rows to an empty list of tables would not."""
    return bool(options.dynamic_tables or options.tables is None or options.route_field is not None or options.tables)


def filter_states(store: ChangelogStore, scope: Sequence[str] = ("topic",)) -> DataFrame | KeyedStates:
    """States in front of the next batch. A store from before states were kept gives those of its rows."""
    if store.has_states():
        return store.keyed_states(scope)
    return versions.latest_states(store.history(), scope, order=("commit_seq", "partition", "offset"))
