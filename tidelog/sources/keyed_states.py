"""Filter states of all keys: a base in hash buckets, sorted within them, and what later commits changed.

A batch joins its keys with the base bucket by bucket. The stored side of that join is neither shuffled nor sorted again:
what moves is the batch, whose histories have been reduced to one pair per key before (see ``versions``).
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STATE_KEY = "state_key"


def state_key(parts: Sequence[Column]) -> Column:
    """Scope and key as one text. Lengths keep parts apart, and a null differs from any text."""
    return F.concat(*[F.coalesce(F.concat(F.length(p.cast("string")).cast("string"), F.lit(":"), p.cast("string")), F.lit("-"))
                      for p in parts])


@dataclass(frozen=True)
class KeyedStates:
    """``base``: a table from ``bucketed_table``, or none. ``changes``: scope, key, version and commit_seq of later commits."""

    scope: tuple[str, ...]
    changes: DataFrame
    base: DataFrame | None = None
    key: str = "dedup_key"

    def newest_changes(self) -> DataFrame:
        """One row per changed key; a null version where the state is gone."""
        own = state_key([F.col(c) for c in (*self.scope, self.key)])
        newest = self.changes.groupBy(own.alias(STATE_KEY)).agg(F.max_by(F.struct("version"), "commit_seq").alias("_changed"))
        return newest

    def enter(self, groups: DataFrame, key: str = "_key") -> DataFrame:
        """Adds ``entering``, the state in front of a batch, to rows with a struct of scope and key."""
        own = state_key([F.col(key)[c] for c in (*self.scope, self.key)])
        placed = groups.withColumn(STATE_KEY, own)
        if self.base is None:
            placed = placed.withColumn("_stored", F.lit(None).cast("bigint"))
        else:
            placed = placed.join(self.base.select(STATE_KEY, F.col("version").alias("_stored")), STATE_KEY, "left")
        placed = placed.join(self.newest_changes(), STATE_KEY, "left")
        entering = F.when(F.col("_changed").isNotNull(), F.col("_changed.version")).otherwise(F.col("_stored"))
        return placed.withColumn("entering", entering).drop(STATE_KEY, "_stored", "_changed")


def write_bucketed(states: DataFrame, folder: str, scope: Sequence[str], buckets: int, key: str = "dedup_key") -> None:
    """States as a bucketed base below ``folder``; its number of buckets is part of the path."""
    spark, place = states.sparkSession, f"{folder}/buckets={buckets}"
    name = _table_name(place)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    keyed = states.withColumn(STATE_KEY, state_key([F.col(c) for c in (*scope, key)]))
    # One file per bucket: dealt out as the buckets are, so that no task writes a file for each of them.
    dealt = keyed.repartition(buckets, STATE_KEY)
    dealt.write.mode("overwrite").bucketBy(buckets, STATE_KEY).sortBy(STATE_KEY).option("path", place).saveAsTable(name)


def bucketed_table(spark: SparkSession, folder: str, scope: Sequence[str], buckets: int, key: str = "dedup_key") -> DataFrame:
    """The base as a table that Spark knows to be bucketed, also in a session that did not write it."""
    place = f"{folder}/buckets={buckets}"
    name = _table_name(place)
    columns = ", ".join(f"`{c}` string" for c in (*scope, key)) + f", version bigint, {STATE_KEY} string"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
              f"CLUSTERED BY ({STATE_KEY}) SORTED BY ({STATE_KEY}) INTO {buckets} BUCKETS LOCATION '{place}'")
    return spark.table(name)


def _table_name(place: str) -> str:
    return f"tidelog_states_{zlib.crc32(place.encode()):08x}_{len(place)}"
