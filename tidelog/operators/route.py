"""Record to table routing. Table lists and patterns are option text, so routing is a projection, never a join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.text import matches_fully
from tidelog.operators.joins import bounded_broadcast


def route_value(rows: DataFrame, route_field: str) -> DataFrame:
    """Adds ``route_value``: the field as text, null-safe."""
    return rows.withColumn("route_value", F.col(route_field).cast("string"))


def route_dynamic(
    rows: DataFrame, route_field: str | None, into: str = "route_table", keep_unrouted: bool = False
) -> DataFrame:
    """Table named by the lower-cased field; rows without a value go nowhere (or keep a null table)."""
    if route_field is None:
        raise ValueError("dynamic routing needs a route field")
    named = rows.withColumn(into, F.lower(F.col(route_field).cast("string")))
    return named if keep_unrouted else named.where(F.col(into).isNotNull())


def route_to_all(rows: DataFrame, tables: Sequence[str], into: str = "route_table") -> DataFrame:
    """Every row to every table."""
    return rows.withColumn(into, F.explode(F.array(*[F.lit(name) for name in tables])))


def route_by_pattern(
    rows: DataFrame,
    route_field: str,
    patterns: Mapping[str, str | None],
    into: str = "route_table",
    keep_unrouted: bool = False,
) -> DataFrame:
    """Every row to each table whose pattern fits the whole field; tables without a pattern get nothing.

    Rows that fit nowhere are left out, or kept once with a null table.
    """
    value = F.col(route_field).cast("string")
    hits = [
        F.when(matches_fully(value, pattern), F.lit(name))
        for name, pattern in patterns.items()
        if pattern is not None
    ]
    found = F.array_compact(F.array(*hits)) if hits else F.array().cast("array<string>")
    return rows.withColumn(into, F.explode_outer(found) if keep_unrouted else F.explode(found))


def mark_known_tables(rows: DataFrame, registry: DataFrame, table: str = "iceberg_table") -> DataFrame:
    """Adds ``table_known``: whether the row's table is in the registry."""
    names = bounded_broadcast(registry.select(table, F.lit(True).alias("table_known")).distinct())
    return rows.join(names, table, "left").withColumn("table_known", F.coalesce("table_known", F.lit(False)))


def split_known_tables(
    rows: DataFrame, registry: DataFrame, table: str = "iceberg_table"
) -> tuple[DataFrame, DataFrame]:
    """(rows whose table exists, rows whose table does not). ``registry`` has the table column."""
    names = bounded_broadcast(registry.select(table).distinct())
    return rows.join(names, table, "left_semi"), rows.join(names, table, "left_anti")
