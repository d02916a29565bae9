"""Epoch milliseconds, update-time text and latency."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two spellings of the update time seen in messages: fixed values.
UPDATE_TIME_PATTERN = "dd/MM/yyyy-HH:mm"


def to_epoch_ms(moment: Column) -> Column:
    return F.unix_millis(moment.cast("timestamp"))


def from_epoch_ms(millis: Column) -> Column:
    return F.timestamp_millis(millis.cast("bigint"))


def parse_update_time(text: Column) -> Column:
    """``dd/MM/yyyy-HH:mm`` or ISO-8601; null when neither fits."""
    return F.coalesce(F.try_to_timestamp(text, F.lit(UPDATE_TIME_PATTERN)), F.try_to_timestamp(text))


def latency_ms(ingest_ms: Column, event_ms: Column) -> Column:
    return ingest_ms.cast("bigint") - event_ms.cast("bigint")
