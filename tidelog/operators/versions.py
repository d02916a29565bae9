"""Version control: the out-of-order filter, the classifier, in-batch dedup.

The filter is a state machine per key. With state ``s`` (a version, or none):

    a message of version v is accepted when s is none or v > s;
    an accepted message sets s to v, an accepted DELETE sets it to none.

A running maximum cannot express it, because whether a DELETE resets the state depends on whether it
was accepted. But every stretch of messages acts on the state in one way only: with M the largest
version in the stretch,

    s  ->  s   when s >= M          (nothing in the stretch is new)
    s  ->  c   otherwise            (the first message of version M is accepted whatever came before
                                     it, so all smaller states end in the same place c)

so a stretch is a pair (M, c), and two neighbouring pairs combine into one. Histories are therefore
cut into short chunks by offset, chunks are summarised on their own, summaries are combined level by
level, and the state in front of each chunk flows back down. No task ever holds the history of a key:
a key with a third of all rows is spread over as many groups as it has chunks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.text import is_delete
from tidelog.operators.joins import join_per_key
from tidelog.sources.keyed_states import KeyedStates

# 1,024 offsets to a chunk of rows, 4,096 chunks to a group of chunks.
DEFAULT_CHUNK_BITS = (10, 22)
_ROW_BITS, _GROUP_BITS = 10, 12


def chunk_levels(records: DataFrame, cut: str = "offset") -> tuple[int, ...]:
    """As many levels of chunks as the offsets at hand need, so that no group exceeds 4,096 per partition.

    Runs a job that reads the offset column only; a source that cannot prune columns better names the levels.
    """
    low, high = records.agg(F.min(cut), F.max(cut)).first()
    span_bits = int((high or 0) - (low or 0)).bit_length()
    levels = max(1, -(-(span_bits - _ROW_BITS) // _GROUP_BITS))
    return tuple(_ROW_BITS + _GROUP_BITS * level for level in range(levels))

def _none() -> Column:
    return F.lit(None).cast("bigint")


def _pair(largest: Column, outcome: Column) -> Column:
    return F.struct(largest.alias("m"), outcome.alias("c"))


def _after(state: Column, step: Column) -> Column:
    """State behind a step; a step without a version leaves it as it is."""
    taken = step["m"].isNotNull() & (state.isNull() | (state < step["m"]))
    return F.when(taken, step["c"]).otherwise(state)


def _combine(steps: Column) -> Column:
    """Ordered steps to the single pair that acts like all of them."""
    return F.aggregate(
        steps,
        _pair(_none(), _none()),
        lambda done, step: F.when(
            step["m"].isNotNull() & (done["m"].isNull() | (step["m"] > done["m"])), _pair(step["m"], step["c"])
        ).otherwise(_pair(done["m"], _after(done["c"], step))),
    )


_PART = 64  # steps whose states are gathered in one list, which every step copies


def _gathered_states(steps: Column, entering: Column) -> Column:
    return F.aggregate(
        steps,
        F.struct(entering.alias("s"), F.array().cast("array<bigint>").alias("seen")),
        lambda at, step: F.struct(
            _after(at["s"], step).alias("s"), F.concat(at["seen"], F.array(at["s"])).alias("seen")
        ),
        lambda at: at["seen"],
    )


def _states_before(steps: Column, entering: Column) -> Column:
    """The state in front of each ordered step.

    Long lists are cut into parts, whose pairs give the state in front of each part: the work stays near linear.
    """
    starts = F.sequence(F.lit(1), F.size(steps), F.lit(_PART))
    parts = F.transform(starts, lambda at: F.slice(steps, at, F.lit(_PART)))
    in_front = _gathered_states(F.transform(parts, _combine), entering)
    return F.when(F.size(steps) <= _PART, _gathered_states(steps, entering)).otherwise(
        F.flatten(F.zip_with(parts, in_front, _gathered_states)))


def _with_states(groups: DataFrame, *keep: str) -> DataFrame:
    """One row per step of each group, with the state in front of it as ``before``."""
    states = _states_before(F.col("steps"), F.col("entering"))
    # The outer form: groups are never empty, and no "not empty" filter gets to repeat the fold.
    return groups.select(*keep, F.inline_outer(F.arrays_zip(F.col("steps"), states.alias("before"))))


def _grouped(rows: DataFrame, by: Sequence[str], fields: Sequence[str]) -> DataFrame:
    # Shuffle plain rows, not half-built lists: lists do not shrink what is sent, and a plain exchange is
    # recognised as the same one when two branches of a plan need it.
    return rows.repartition(*by).groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("steps"))


def version_states(
    rows: DataFrame,
    scope: Sequence[str] = ("topic",),
    key: str = "dedup_key",
    order: Sequence[str] = ("partition", "offset"),
    chunk_bits: Sequence[int] = DEFAULT_CHUNK_BITS,
    initial: DataFrame | KeyedStates | None = None,
) -> DataFrame:
    """Adds ``prev_version`` (state in front of the row) and ``accepted``.

    ``order`` must be unique within a key and end in an integer column, which is cut into chunks of
    ``2**bits``. ``scope`` lists the columns that separate states of equal keys; ``()`` shares them.
    ``initial`` holds states from earlier batches: rows of the scope columns, the key and ``version``, or ``KeyedStates``.
    Rows without key or version bypass the filter, as validation rejects them later on.
    """
    keys = [*scope, key]
    leading, cut = list(order[:-1]), order[-1]
    payload = [name for name in rows.columns if name not in {*keys, *order}]
    top_level = len(chunk_bits)

    def group_by(level: int) -> list[str]:
        return ["_key"] if level == top_level else ["_key", *leading, f"_chunk{level}"]

    filterable = F.col(key).isNotNull() & F.col("version").isNotNull()
    groups = _grouped(
        rows.select(
            F.struct(*keys).alias("_key"),
            *order,
            F.shiftright(F.col(cut).cast("bigint"), chunk_bits[0]).alias("_chunk0"),
            F.when(filterable, F.col("version")).alias("m"),
            F.when(~is_delete(F.col("type")), F.col("version")).alias("c"),
            F.struct(*payload).alias("_row"),
        ),
        group_by(0),
        [*order, "m", "c", "_row"],
    )
    levels = [groups]
    for level in range(1, top_level + 1):
        below = group_by(level - 1)
        pairs = levels[-1].select(*below, _combine(F.col("steps")).alias("_pair")).select(*below, "_pair.*")
        if level < top_level:
            wider = chunk_bits[level] - chunk_bits[level - 1]
            pairs = pairs.withColumn(f"_chunk{level}", F.shiftright(F.col(below[-1]), wider))
        levels.append(_grouped(pairs, group_by(level), [*below[1:], "m", "c"]))

    top = levels[-1]
    if initial is None:
        top = top.withColumn("entering", _none())
    elif isinstance(initial, KeyedStates):
        top = initial.enter(top)
    else:
        known = initial.select(F.struct(*keys).alias("_key"), F.col("version").alias("entering"))
        top = top.join(known, "_key", "left")
    for level in range(top_level - 1, -1, -1):
        by = group_by(level)
        entering = _with_states(top, "_key").select(
            "_key", *[F.col(f"steps.{name}").alias(name) for name in by[1:]], F.col("before").alias("entering")
        )
        # Every group has its match. The left join only keeps "not null" filters, which an inner join adds
        # to one branch, from making the branches differ and the input being read again.
        # Leading columns may be null (a record without a partition), and a null is a group like any other.
        renamed = entering.select(*[F.col(name).alias(f"_e{i}") for i, name in enumerate(by)], "entering")
        same = reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(f"_e{i}")) for i, name in enumerate(by)])
        top = levels[level].join(renamed, same, "left").drop(*[f"_e{i}" for i in range(len(by))])

    step_version, before = F.col("steps.m"), F.col("before")
    return _with_states(top, "_key").select(
        "_key.*",
        *[F.col(f"steps.{name}").alias(name) for name in order],
        "steps._row.*",
        before.alias("prev_version"),
        (step_version.isNull() | before.isNull() | (step_version > before)).alias("accepted"),
    ).select(*rows.columns, "prev_version", "accepted")


def filter_versions(rows: DataFrame, **how) -> DataFrame:
    """Rows that pass the version filter; see ``version_states`` for the options."""
    return version_states(rows, **how).where("accepted").select(*rows.columns)


def latest_states(
    accepted: DataFrame,
    scope: Sequence[str] = ("topic",),
    key: str = "dedup_key",
    order: Sequence[str] = ("partition", "offset"),
) -> DataFrame:
    """Filter states after the accepted rows: their last version per key, keys ending in DELETE left out."""
    keys = [*scope, key]
    last = F.max_by(
        F.struct(F.when(~is_delete(F.col("type")), F.col("version")).alias("version")),
        F.struct(*order),
    )
    return (
        accepted.groupBy(*keys).agg(last.alias("_last"))
        .select(*keys, "_last.version").where(F.col("version").isNotNull())
    )


def changed_states(accepted: DataFrame, scope: Sequence[str] = ("topic",), key: str = "dedup_key",
                   order: Sequence[str] = ("partition", "offset")) -> DataFrame:
    """The state of every key that a batch touched; a null version where its last accepted row is a DELETE.

    Rows without key or version passed the filter unseen and leave no state.
    """
    keys, seen = [*scope, key], accepted.where(F.col(key).isNotNull() & F.col("version").isNotNull())
    last = F.max_by(F.struct(F.when(~is_delete(F.col("type")), F.col("version")).alias("version")), F.struct(*order))
    return seen.groupBy(*keys).agg(last.alias("_last")).select(*keys, "_last.version")


# --- classification against an existing table ------------------------------------------------

INSERT, UPDATE, DELETE, SKIP, ERROR = "INSERT", "UPDATE", "DELETE", "SKIP", "ERROR"


def dedup_batch(
    rows: DataFrame,
    key: Sequence[str] = ("dedup_key",),
    order: Sequence[str] = ("version", "partition", "offset"),
) -> DataFrame:
    """Newest row per key. An aggregate, not a ranking window: duplicates are reduced before the shuffle."""
    rest = [name for name in rows.columns if name not in key]
    newest = F.max_by(F.struct(*rest), F.struct(*order))
    return rows.groupBy(*key).agg(newest.alias("_row")).select(*key, "_row.*").select(*rows.columns)


def existing_versions(table: DataFrame, key: Sequence[str] = ("dedup_key",)) -> DataFrame:
    return table.groupBy(*key).agg(F.max("version").alias("existing_version"))


def action(change_type: Column, version: Column, existing: Column) -> Column:
    """What to do with a message, given the version stored for its key (null: none)."""
    word, unseen, newer = F.upper(change_type), existing.isNull(), version > existing
    return (
        F.when(word == "INSERT", F.when(unseen, INSERT).otherwise(ERROR))
        .when(word == "UPDATE", F.when(unseen, INSERT).when(newer, UPDATE).otherwise(SKIP))
        .when(word == "DELETE", F.when(~unseen & newer, DELETE).otherwise(SKIP))
        .otherwise(ERROR)
    )


def classify(batch: DataFrame, existing: DataFrame, key: Sequence[str] = ("dedup_key",)) -> DataFrame:
    """Adds ``existing_version`` and ``action``. ``existing`` has the key and ``existing_version``."""
    joined = join_per_key(batch, existing, list(key), "left")
    return joined.withColumn("action", action(F.col("type"), F.col("version"), F.col("existing_version")))


def apply_classified(
    table: DataFrame, classified: DataFrame, key: Sequence[str] = ("dedup_key",)
) -> DataFrame:
    """Removes old rows of updated and deleted keys, then appends inserted and updated rows."""
    gone = classified.where(F.col("action").isin(UPDATE, DELETE)).select(*key).distinct()
    fresh = classified.where(F.col("action").isin(INSERT, UPDATE)).select(*table.columns)
    return join_per_key(table, gone, list(key), "left_anti").unionByName(fresh)


def action_counts(classified: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return classified.groupBy(*by).agg(
        *[F.count_if(F.col("action") == word).alias(name) for word, name in (
            (INSERT, "inserts"), (UPDATE, "updates"), (DELETE, "deletes"),
            (SKIP, "skipped"), (ERROR, "conflicts"))]
    )


# A share of conflicting messages above this calls for a look at the producers: fixed value.
CONFLICT_ALARM_SHARE = 0.10


def conflict_rate(classified: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    share = F.count_if(F.col("action") == ERROR) / F.count(F.lit(1))
    return classified.groupBy(*by).agg(
        F.count(F.lit(1)).alias("messages"), share.alias("conflict_share")
    ).withColumn("alarm", F.col("conflict_share") > CONFLICT_ALARM_SHARE)
