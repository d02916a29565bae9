"""The same commits on Iceberg tables, for sessions that have the Iceberg runtime.

Untested here, where that runtime is not installed; only the statements it builds are tested.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators import apply
from tidelog.schemas import TARGET_COLUMNS

SNAPSHOT_PROPERTY = "snapshot-property."


def on_branch(table: str, branch: str | None) -> str:
    return table if branch is None else f"{table}.branch_{branch}"


def append(
    rows: DataFrame, table: str, summary: Mapping[str, str], branch: str | None = None,
    write_options: Mapping[str, str] | None = None,
) -> None:
    """Append commit: new rows only, one snapshot with the summary entries."""
    writer = rows.select(*TARGET_COLUMNS).writeTo(on_branch(table, branch))
    for name, value in {**{SNAPSHOT_PROPERTY + k: v for k, v in summary.items()}, **(write_options or {})}.items():
        writer = writer.option(name, value)
    writer.append()


def delta_source(changes: DataFrame, id_columns: Sequence[str], insert_mode: str = apply.APPEND) -> DataFrame:
    """Input of the merge: a delete marker per key that goes, and each added row with keys that match nothing."""
    marker = apply.delete_keys(changes, id_columns, insert_mode).select(
        *[F.col(c).alias(f"_match_{c}") for c in id_columns], F.lit(True).alias("_gone"))
    added = apply.merge_on_read(changes, id_columns, insert_mode, order=("partition", "offset")).select(
        *TARGET_COLUMNS, F.lit(False).alias("_gone"))
    return added.unionByName(marker, allowMissingColumns=True)


def merge_statement(table: str, source: str, id_columns: Sequence[str]) -> str:
    match = " AND ".join(f"t.{c} = s._match_{c}" for c in id_columns)
    columns = ", ".join(TARGET_COLUMNS)
    values = ", ".join(f"s.{c}" for c in TARGET_COLUMNS)
    return (
        f"MERGE INTO {table} t USING {source} s ON {match} WHEN MATCHED THEN DELETE "
        f"WHEN NOT MATCHED AND NOT s._gone THEN INSERT ({columns}) VALUES ({values})"
    )


def row_delta(
    changes: DataFrame, table: str, id_columns: Sequence[str], summary: Mapping[str, str],
    branch: str | None = None, insert_mode: str = apply.APPEND,
) -> None:
    """Row-delta commit: key deletes and new rows in one snapshot."""
    spark = changes.sparkSession
    delta_source(changes, id_columns, insert_mode).createOrReplaceTempView("_row_delta")
    for name, value in summary.items():
        spark.conf.set(f"spark.sql.iceberg.{SNAPSHOT_PROPERTY}{name}", value)
    try:
        spark.sql(merge_statement(on_branch(table, branch), "_row_delta", id_columns))
    finally:
        for name in summary:
            spark.conf.unset(f"spark.sql.iceberg.{SNAPSHOT_PROPERTY}{name}")


def already_committed(spark: SparkSession, table: str, commit_id: str) -> bool:
    """Whether the table has a snapshot of this commit: a replayed batch is then left alone."""
    hit = snapshots(spark, table).where(F.col("summary")["kafka.connect.commit-id"] == commit_id)
    return not hit.limit(1).isEmpty()


def snapshots(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(f"{table}.snapshots")


def files(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(f"{table}.files")


def as_of(spark: SparkSession, table: str, snapshot_id: int) -> DataFrame:
    return spark.sql(f"SELECT * FROM {table} VERSION AS OF {snapshot_id}")
