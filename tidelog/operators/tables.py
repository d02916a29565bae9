"""Table definition: creation, schema evolution, partition specs."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators.envelope import strip_internal
from tidelog.options import SCHEMA_ATTEMPTS
from tidelog.schemas import LEGACY_TARGET_SCHEMA, TARGET_SCHEMA

# Merge-on-read properties of a version 2 table: fixed values.
MERGE_ON_READ = {
    "format-version": "2",
    "write.delete.mode": "merge-on-read",
    "write.update.mode": "merge-on-read",
}
_TRANSFORM = re.compile(r"(year|month|day|hour)s?\(\s*(\w+)\s*\)|(bucket|truncate)\(\s*(\w+)\s*,\s*(\d+)\s*\)|(\w+)")


def create_statement(
    table: str, columns: str = TARGET_SCHEMA, provider: str = "parquet", properties: dict[str, str] | None = None
) -> str:
    options = ", ".join(f"'{name}' = '{value}'" for name, value in (properties or {}).items())
    tail = f" TBLPROPERTIES ({options})" if options else ""
    return f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING {provider}{tail}"


def create_table(spark: SparkSession, table: str, legacy: bool = False, **how) -> None:
    """Namespace and table with the target columns."""
    if "." in table:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {table.rsplit('.', 1)[0]}")
    spark.sql(create_statement(table, LEGACY_TARGET_SCHEMA if legacy else TARGET_SCHEMA, **how))


def auto_create(
    sample: DataFrame, table: str, provider: str = "parquet", properties: dict[str, str] | None = None,
    force_optional: bool = False,
) -> None:
    """Creates the table from a record's shape, internal fields left out."""
    shape = strip_internal(sample).schema
    ddl = (optional(shape) if force_optional else shape).toDDL()
    statement = create_statement(table, ddl, provider, properties)
    with_attempts(lambda: sample.sparkSession.sql(statement))


def with_attempts(action, attempts: int = SCHEMA_ATTEMPTS):
    """Another job may change the same table meanwhile, so a failed change is tried again."""
    for attempt in range(1, attempts + 1):
        try:
            return action()
        except Exception:
            if attempt == attempts:
                raise


def optional(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields])


def missing_fields(
    table: T.StructType, record: T.StructType, case_insensitive: bool = False, force_optional: bool = False
) -> T.StructType:
    """Record fields the table lacks."""
    fold = str.lower if case_insensitive else str
    known = {fold(name) for name in table.names}
    added = T.StructType([f for f in record.fields if fold(f.name) not in known])
    return optional(added) if force_optional else added


def evolve_table(spark: SparkSession, table: str, record: T.StructType, **how) -> T.StructType:
    """Adds the missing columns to a catalog table; returns what was added."""
    def change() -> T.StructType:
        added = missing_fields(spark.table(table).schema, record, **how)
        if added.fields:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added.fields)
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
        return added

    return with_attempts(change)


def evolve_union(table: DataFrame, records: DataFrame, case_insensitive: bool = False) -> DataFrame:
    """Table rows and new records under the evolved schema; columns absent on a side are null there."""
    if case_insensitive:
        records = align_case(records, table.columns)
    return table.unionByName(records, allowMissingColumns=True)


def align_case(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Renames columns to the spelling used in ``columns``."""
    spelling = {name.lower(): name for name in columns}
    return rows.select(*[F.col(f"`{c}`").alias(spelling.get(c.lower(), c)) for c in rows.columns])


def partition_columns(spec: Sequence[str]) -> dict[str, Column]:
    """Derived partition columns of a text spec: identity, year/month/day/hour, bucket and truncate."""
    derived: dict[str, Column] = {}
    for text in spec:
        found = _TRANSFORM.fullmatch(text.strip())
        if not found:
            raise ValueError(f"unknown partition transform {text!r}")
        unit, moment, kind, column, width, identity = found.groups()
        if unit:
            derived[f"{moment}_{unit}"] = F.date_trunc(unit, F.col(moment)).cast("timestamp_ntz")
        elif kind == "bucket":
            derived[f"{column}_bucket"] = F.pmod(F.xxhash64(column), F.lit(int(width))).cast("int")
        elif kind == "truncate":
            derived[f"{column}_trunc"] = F.substring(F.col(column), 1, int(width))
        else:
            derived[identity] = F.col(identity)
    return derived


def with_partition_columns(rows: DataFrame, spec: Sequence[str]) -> DataFrame:
    return rows.withColumns(partition_columns(spec))


def writer_transforms(spec: Sequence[str]) -> list[Column]:
    """The same spec for ``writeTo(...).partitionedBy`` on table formats with hidden partitioning."""
    made = []
    for text in spec:
        unit, moment, kind, column, width, identity = _TRANSFORM.fullmatch(text.strip()).groups()
        if unit:
            made.append(getattr(F.partitioning, f"{unit}s")(moment))
        elif kind == "bucket":
            made.append(F.partitioning.bucket(int(width), column))
        elif identity:
            made.append(F.col(identity))
        else:
            raise ValueError("truncate is not available through the DataFrame writer; use SQL DDL")
    return made
