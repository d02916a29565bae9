"""Audit over the history of commit events (shape ``COMMIT_EVENT``), all connectors and cycles at once.

A file path, commit or event may repeat without bound, so duplicates are resolved by aggregates, which
shrink before the shuffle, and never by ranking or collecting a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.operators.commits import watermark

DATA, DELETE = "data", "delete"


def readable_events(raw: DataFrame, group_id: str, payload: str = "payload") -> DataFrame:
    """This group's events; what cannot be decoded is passed over."""
    doc = F.try_parse_json(F.col(payload))
    return raw.where(doc.isNotNull() & (F.try_variant_get(doc, "$.group_id", "string") == group_id))


def next_offsets(raw: DataFrame) -> DataFrame:
    """Next offset per control partition, over everything read, decodable or not."""
    return raw.groupBy("partition").agg((F.max("offset") + 1).alias("next_offset"))


def files(events: DataFrame) -> DataFrame:
    """One row per file mention: table, commit, content, path, position in event."""
    keep = ["event_id", "commit_id", "table", "partition", "offset"]

    def mentions(column: str, content: str) -> DataFrame:
        return events.select(*keep, F.lit(content).alias("content"), F.posexplode(column).alias("pos", "file"))

    return (
        mentions("data_files", DATA).unionByName(mentions("delete_files", DELETE))
        .select(*keep, "content", "pos", "file.*")
    )


def not_committed(mentions: DataFrame, committed: DataFrame) -> DataFrame:
    """Drops events below a table's committed offset; a partition without one passes.

    ``committed``: table, partition, committed_offset.
    """
    known = mentions.join(committed, ["table", "partition"], "left")
    return known.where(
        F.col("committed_offset").isNull() | (F.col("offset") >= F.col("committed_offset"))
    ).drop("committed_offset")


def with_records(mentions: DataFrame) -> DataFrame:
    return mentions.where(F.col("record_count") > 0)


def in_commit(events: DataFrame, commit_id: str) -> DataFrame:
    return events.where(F.col("commit_id") == commit_id)


def unique_files(mentions: DataFrame, by: Sequence[str] = ("commit_id", "table")) -> DataFrame:
    """First mention of each path, in order of arrival and position."""
    first = F.min_by(F.struct("event_id", "spec_id", "record_count"), F.struct("partition", "offset", "pos"))
    return mentions.groupBy(*by, "content", "path").agg(first.alias("_first")).select(
        *by, "content", "path", "_first.*"
    )


def _copies(mentions: DataFrame) -> DataFrame:
    """Per event and path: positions naming it, and how often the event itself was read."""
    place = ["table", "commit_id", "content", "path", "event_id", "partition", "offset"]
    reads = mentions.groupBy(*place, "pos").agg(F.count(F.lit(1)).alias("reads"))
    return reads.groupBy(*place).agg(F.count(F.lit(1)).alias("positions"), F.max("reads").alias("copies"))


def duplicates_within_event(mentions: DataFrame) -> DataFrame:
    """Paths an event names more than once."""
    return _copies(mentions).where(F.col("positions") > 1).select(
        "table", "commit_id", "event_id", "content", "path", F.col("positions").alias("mentions")
    )


def duplicates_across_events(mentions: DataFrame, by: Sequence[str] = ("commit_id", "table")) -> DataFrame:
    """Paths named by several events, or by one read several times; in-event repeats count once."""
    return _copies(mentions).groupBy(*by, "content", "path").agg(
        F.sum("copies").alias("mentions"), F.count(F.lit(1)).alias("events")
    ).where(F.col("mentions") > 1)


def files_by_table(mentions: DataFrame, by: Sequence[str] = ("commit_id", "table")) -> DataFrame:
    return mentions.groupBy(*by).agg(
        F.count_if(F.col("content") == DATA).alias("data_files"),
        F.count_if(F.col("content") == DELETE).alias("delete_files"),
        F.sum("record_count").alias("records"),
    )


def completeness(events: DataFrame, expected: int) -> DataFrame:
    """Per commit: partitions reported, repeats included, against the number expected."""
    reported = F.sum(F.coalesce(F.size("assignments"), F.lit(0))).cast("bigint")
    return events.groupBy("commit_id").agg(reported.alias("received")).withColumn(
        "ready", F.col("received") >= expected
    )


def low_watermarks(events: DataFrame, by: Sequence[str] = ("commit_id",), partial: str | None = None) -> DataFrame:
    """Per commit: the low watermark over all reported partitions."""
    flag = F.col(partial) if partial else F.lit(False)
    reported = events.select(*by, flag.alias("_partial"), F.explode("assignments").alias("a"))
    return reported.groupBy(*by).agg(watermark(F.col("a.ts"), F.col("_partial")).alias("watermark"))


def files_by_spec(unique: DataFrame, by: Sequence[str] = ("commit_id", "table")) -> DataFrame:
    """Files per partition spec, and which spec's snapshot is the commit's last (it carries the offsets)."""
    counted = unique.groupBy(*by, "spec_id").agg(
        F.count(F.lit(1)).alias("files"), F.sum("record_count").alias("records")
    )
    # One row per spec is left here: the window never sees the files themselves.
    last = F.row_number().over(Window.partitionBy(*by).orderBy(F.col("spec_id").desc())) == 1
    return counted.withColumn("carries_offsets", last)
