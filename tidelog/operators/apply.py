"""Applying changes to tables: copy-on-write, and merge-on-read over an ordered changelog.

``insert_mode="append"``: an I row only adds. ``"upsert"``: an I row replaces, as a U row does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.operators.joins import join_per_key

APPEND, UPSERT = "append", "upsert"
DEFAULT_ORDER = ("commit_seq", "partition", "offset")


def _replacing(insert_mode: str) -> list[str]:
    if insert_mode not in (APPEND, UPSERT):
        raise ValueError(f"insert mode must be {APPEND!r} or {UPSERT!r}, not {insert_mode!r}")
    return ["U", "D"] if insert_mode == APPEND else ["I", "U", "D"]


def _nullable(id_columns: Sequence[str]) -> list[str]:
    """Id columns that may be null; rows of tables always have a table and a key."""
    return [name for name in id_columns if name not in ("iceberg_table", "dedup_key")]


def delete_keys(
    changes: DataFrame, id_columns: Sequence[str], insert_mode: str = APPEND, op: str = "_cdc_op"
) -> DataFrame:
    """Keys whose stored rows go away."""
    return changes.where(F.col(op).isin(_replacing(insert_mode))).select(*id_columns).distinct()


def new_rows(changes: DataFrame, op: str = "_cdc_op") -> DataFrame:
    """Rows that are added: inserts and the new side of updates."""
    return changes.where(F.col(op).isin("I", "U"))


def remove_keys(target: DataFrame, keys: DataFrame, id_columns: Sequence[str]) -> DataFrame:
    return join_per_key(target, keys, list(id_columns), "left_anti", _nullable(id_columns))


def copy_on_write(
    target: DataFrame,
    changes: DataFrame,
    id_columns: Sequence[str],
    insert_mode: str = APPEND,
    op: str = "_cdc_op",
    order: Sequence[str] = ("partition", "offset"),
) -> DataFrame:
    """The table after one batch: stored rows minus deleted keys, plus what the batch itself leaves."""
    kept = remove_keys(target, delete_keys(changes, id_columns, insert_mode, op), id_columns)
    added = merge_on_read(changes, id_columns, insert_mode, op, order).select(*target.columns)
    return kept.unionByName(added)


def last_replacement(
    changelog: DataFrame, id_columns: Sequence[str], insert_mode: str, op: str, order: Sequence[str]
) -> DataFrame:
    """Position of the last change per key that removes earlier rows."""
    replacing = changelog.where(F.col(op).isin(_replacing(insert_mode)))
    return replacing.groupBy(*id_columns).agg(F.max(F.struct(*order)).alias("_last"))


def merge_on_read(
    changelog: DataFrame,
    id_columns: Sequence[str],
    insert_mode: str = APPEND,
    op: str = "_cdc_op",
    order: Sequence[str] = DEFAULT_ORDER,
) -> DataFrame:
    """Current rows of an ordered changelog: I and U rows with no later removal of their key.

    The position of the last removal is aggregated first (one row per key and task is sent), then joined:
    a frequent key loads no single task, as a window over its history would.
    In upsert mode at most one row per key is left, so the newest row itself is aggregated, without a join.
    """
    if insert_mode == UPSERT:
        rest = [name for name in changelog.columns if name not in id_columns]
        newest = changelog.groupBy(*id_columns).agg(
            F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
        )
        return newest.select(*id_columns, "_row.*").where(F.col(op) != "D").select(*changelog.columns)
    last = last_replacement(changelog, id_columns, insert_mode, op, order)
    current: Column = F.col("_last").isNull() | (F.struct(*order) >= F.col("_last"))
    joined = join_per_key(new_rows(changelog, op), last, list(id_columns), "left", _nullable(id_columns))
    return joined.where(current).select(*changelog.columns)


def append_only(table: DataFrame, changes: DataFrame) -> DataFrame:
    """No change field configured: every record is added, whatever its type."""
    return table.unionByName(changes.select(*table.columns))


def as_of(changelog: DataFrame, commit_seq: int, seq: str = "commit_seq") -> DataFrame:
    """The changelog as it was after a commit; feed it to ``merge_on_read`` for time travel."""
    return changelog.where(F.col(seq) <= commit_seq)


VALIDITY_CHUNK_BITS = 14  # offsets of a topic partition whose rows of one key may meet in a task


def validity(
    changelog: DataFrame,
    id_columns: Sequence[str],
    insert_mode: str = APPEND,
    op: str = "_cdc_op",
    order: Sequence[str] = DEFAULT_ORDER,
    chunk_bits: int = VALIDITY_CHUNK_BITS,
) -> DataFrame:
    """Rows that were ever current, with ``valid_from`` and ``valid_to``: the commits that brought and removed them.

    A row is part of the table after commits from ``valid_from`` up to, not with, ``valid_to``; null: to this day. Rows
    removed by their own commit were never visible and are left out. ``order`` begins with the commit and ends in a whole
    number, which is cut into chunks: the next removal is looked for in a row's chunk, else among the first removals of
    later chunks (one row per key and chunk), so no task holds the history of a frequent key.
    """
    taken, own = {c.lower() for c in changelog.columns}, "_v"
    while any(c.startswith(own) for c in taken):
        own += "v"
    place, chunk, first, later, after = (own + name for name in ("place", "chunk", "first", "later", "next"))
    keys = list(id_columns)
    removal = F.when(F.col(op).isin(_replacing(insert_mode)), F.col(place))
    cut = F.struct(*order[:-1], F.shiftright(F.col(order[-1]).cast("bigint"), chunk_bits).alias("part"))
    placed = changelog.withColumns({place: F.struct(*order), chunk: cut})
    # Latest first, so that the running minimum over what has been passed is the next removal.
    inside = Window.partitionBy(*keys, chunk).orderBy(F.desc(place)).rowsBetween(Window.unboundedPreceding, -1)
    rows = placed.withColumn(after, F.min(removal).over(inside)).where(F.col(op).isin("I", "U"))
    beyond = Window.partitionBy(*keys).orderBy(F.desc(chunk)).rowsBetween(Window.unboundedPreceding, -1)
    firsts = placed.groupBy(*keys, chunk).agg(F.min(removal).alias(first)).withColumn(later, F.min(first).over(beyond))
    firsts = firsts.where(F.col(later).isNotNull()).select(*keys, chunk, later)
    joined = join_per_key(rows, firsts, [*keys, chunk], "left", [*_nullable(id_columns), chunk])
    commit = order[0]
    ended = joined.withColumns({"valid_from": F.col(commit), "valid_to": F.coalesce(F.col(after)[commit], F.col(later)[commit])})
    shown = ended.where(F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from")))
    return shown.select(*changelog.columns, "valid_from", "valid_to")


def at_versions(intervals: DataFrame, commits: Sequence[int], version: str = "as_of") -> DataFrame:
    """The rows of ``validity`` once for each of the commits after which they were part of the table, in one pass."""
    wanted = F.array(*[F.lit(c).cast("bigint") for c in commits])
    held = F.filter(wanted, lambda c: (c >= F.col("valid_from")) & (F.col("valid_to").isNull() | (c < F.col("valid_to"))))
    return intervals.withColumn(version, F.explode(held))
