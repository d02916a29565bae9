"""The ingestion query: source, version filter, one commit per micro-batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidelog.operators import envelope, versions
from tidelog.options import IngestOptions
from tidelog.plans import ingest
from tidelog.sources.changelog import ChangelogStore
from tidelog.streaming.version_filter import stateful_filter

STATE_STORE, CHANGELOG = "state store", "changelog"


def commit_trigger(options: IngestOptions) -> dict[str, str]:
    """A new cycle when the interval since the start of the last one is over."""
    return {"processingTime": f"{options.commit_interval_ms} milliseconds"}


def start_ingest(
    records: DataFrame,
    store: ChangelogStore,
    options: IngestOptions,
    checkpoint: str,
    state: str = STATE_STORE,
    scope: Sequence[str] = ("topic",),
    trigger: dict | None = None,
    ttl_ms: int | None = None,
    chunk_bits: Sequence[int] = versions.DEFAULT_CHUNK_BITS,
    **how,
) -> StreamingQuery:
    """Starts the query. A commit belongs to a batch of a query: a replayed batch is the same commit, and a
    query with a new checkpoint adds commits of its own to the store.

    ``state="state store"``: filter states live in the query's state store, so a batch costs what its own
    rows cost; the record limit of the trigger (``maxOffsetsPerTrigger``) bounds what one key can bring.
    Offsets of tombstones are then not part of the published offsets; the checkpoint has them either way.

    ``state="changelog"``: states are read from the committed changelog (key columns only), so nothing but
    the tables has to be kept, and a frequent key is spread over tasks. A batch then also costs a scan of
    the stored keys: for large, rarer batches, with compaction.
    """
    if state == STATE_STORE:
        parsed = envelope.parse_envelopes(records, options.namespace, options.topic_tables)
        source = stateful_filter(parsed, scope, ttl_ms=ttl_ms)

        def each(batch: DataFrame, batch_id: int) -> None:
            if not ingest.commit(store, batch, store.number_for(_query_id(batch), batch_id), options, **how):
                # Replayed after its commit: it is read all the same, or its states would not be kept.
                batch.write.format("noop").mode("overwrite").save()
    elif state == CHANGELOG:
        source = records

        def each(batch: DataFrame, batch_id: int) -> None:
            seq = store.number_for(_query_id(batch), batch_id)
            if store.committed(seq):
                return
            # Filter, tombstone offsets and retries inside the commit read the batch; the source is asked once. Files, not
            # the cache: over a cached batch the branches of the filter do not share their exchange, and each would parse.
            held = store.hold(seq, batch)
            try:
                ingest.ingest_batch(store, held, seq, options, scope, chunk_bits, **how)
            finally:
                store.release(seq)
    else:
        raise ValueError(f"state must be {CHANGELOG!r} or {STATE_STORE!r}, not {state!r}")
    writer = source.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or commit_trigger(options))).start()


def _query_id(batch: DataFrame) -> str:
    """Id of the running query; it is kept in the checkpoint and so the same after a restart."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def progress_rates(query: StreamingQuery) -> list[dict]:
    """Rows per second of the recent micro-batches."""
    return [
        {"batch": p["batchId"], "input_rows": p["numInputRows"], "rows_per_sec": p["processedRowsPerSecond"]}
        for p in query.recentProgress
    ]
