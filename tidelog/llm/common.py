"""Helpers of the operators: tables in the shared folder, held-out folds, bounded samples."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.session import shared_folder


def written(rows: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Rows written once below the shared folder and read from there: nothing is recomputed when executors go."""
    path = f"{shared_folder(rows.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    rows.write.options(**options or {}).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def free_names(rows: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores at its end as it takes to be no column of the rows (in any case)."""
    taken, out = {c.lower() for c in rows.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of at most so many rows, unless the session has a setting of its own: texts may be long."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name, None) in (None, "10000"):
        spark.conf.set(name, str(rows))


Batches = Iterator[pa.RecordBatch]


def returning_memory(rows: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """The Arrow function, giving unused Arrow memory back when a task ends: workers are reused by other stages."""
    def run(batches: Batches) -> Batches:
        try:
            yield from rows(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return run


def crc_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo the divisor; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(divisor)


def bounded_sample(rows: DataFrame, key: str, size: int) -> DataFrame:
    """At most ``size`` of the rows, those with the smallest hashes of the key (then the smallest keys).

    Rows are first cut at a hash below which about the wanted number lies, so that only those are ordered.
    """
    place = F.xxhash64(F.col(key))
    total = rows.count()
    if total > size:
        share = min(1.0, (size + 6 * size**0.5 + 50) / total)
        rows = rows.filter(place <= F.lit(int(-(2**63) + share * (2**64 - 1025))))
    return rows.orderBy(place, F.col(key)).limit(size)


def small_side(rows: DataFrame, name: str, at_most: int = 200_000) -> DataFrame:
    """A written narrow side of a join, marked for broadcast if its counted rows stay within the bound."""
    kept = written(rows, name)
    return F.broadcast(kept) if kept.count() <= at_most else kept


def word_list(text: Column) -> Column:
    """Words of digits, letters a-z and non-ASCII characters of an already lower-cased text, in order."""
    parts = F.split(F.coalesce(text, F.lit("")), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.array_remove(parts, "")
