"""Snapshot-summary maps and the offset vectors stored in them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Summary keys written on every commit: fixed values.
COMMIT_ID = "kafka.connect.commit-id"
TASK_ENGINE = "task.engine"
TYPE_INGEST = "consumer.typeingest"
CONNECTOR_NAME = "consumer.connectorname"
INGEST_TIME = "consumer.ingest.time"
WATERMARK_TIME = "consumer.vtts.time"
OFFSETS_PREFIX = "kafka.connect.offsets"
ADDED_RECORDS = "added-records"
TOTAL_RECORDS = "total-records"
LATENCY_SKETCH = "record-latency.kll"  # ours


def offsets_key(control_topic: str, group_id: str) -> str:
    return f"{OFFSETS_PREFIX}.{control_topic}.{group_id}"


def summary_value(summary: Column, key: str) -> Column:
    """Map lookup, null when absent."""
    return F.try_element_at(summary, F.lit(key))


def summary_map(entries: dict[str, Column]) -> Column:
    """Map of text values without the null ones."""
    pairs = [part for name, value in entries.items() for part in (F.lit(name), value.cast("string"))]
    return F.map_filter(F.create_map(*pairs), lambda _, value: value.isNotNull())


def offsets_to_json(entries: Column) -> Column:
    """ARRAY<STRUCT<name, offset>> to ``{"name":offset,...}`` with names in order."""
    return F.to_json(F.map_from_entries(F.array_sort(entries)))


def offsets_from_json(text: Column) -> Column:
    """Back to MAP<INT,BIGINT>; JSON map keys are text, so they are cast afterwards."""
    return F.transform_keys(F.from_json(text, "map<string,bigint>"), lambda name, _: name.cast("int"))


def stable_uuid(*parts: Column) -> Column:
    """UUID-shaped digest of the parts: the same commit gets the same id on every replay."""
    digest = F.md5(F.concat_ws("#", *parts))
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.substring(digest, 13, 4),
        F.substring(digest, 17, 4),
        F.substring(digest, 21, 12),
    )


def stable_snapshot_id(*parts: Column) -> Column:
    """Positive BIGINT digest of the parts (60 bits)."""
    return F.conv(F.substring(F.md5(F.concat_ws("#", *parts)), 1, 15), 16, 10).cast("bigint")
