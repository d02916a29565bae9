"""The version filter as keyed streaming state: one version per key, in buckets in the query's state store."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidelog.sources.keyed_states import state_key

BYPASS_GROUPS = 256
STATE_BUCKETS = 4096


def keep_new_versions(
    versions: Sequence[int], deletes: Sequence[bool], state: int | None
) -> tuple[list[bool], int | None]:
    """Which messages of one key, in order, are accepted; and the state behind them."""
    accepted = []
    for version, delete in zip(versions, deletes):
        new = state is None or version > state
        accepted.append(new)
        if new:
            state = None if delete else int(version)
    return accepted, state


def stateful_filter(
    rows: DataFrame,
    scope: Sequence[str] = ("topic",),
    key: str = "dedup_key",
    order: Sequence[str] = ("partition", "offset"),
    ttl_ms: int | None = None,
    buckets: int = STATE_BUCKETS,
) -> DataFrame:
    """Streaming rows that pass the filter. Late rows are judged by version, never by time.

    States are kept in hash buckets of keys, a group each: calls into Python cost more than rows, and their number is
    bounded so. A bucket's rows of one micro-batch meet in one task, so the trigger's record limit bounds the group; a
    bucket that a batch touches is read and written whole. The number of buckets belongs to the checkpoint.
    Rows without key or version pass, spread over a fixed number of groups without state. States are kept for good
    unless ``ttl_ms`` is set, which forgets keys idle for that long; each key then has a group of its own.
    """
    # The version travels as text: a column of whole numbers with nulls would come to pandas as floating point.
    # Each column of each group costs, too: text that is only passed on travels in one array.
    used = [key, *order, "version", "type"]
    carried = [name for name, kind in rows.dtypes if kind == "string" and name not in used]
    usable = F.col(key).isNotNull() & F.col("version").isNotNull()
    own = state_key([F.col(name) for name in (*scope, key)])
    bypass = F.concat(F.lit("r"), F.pmod(F.xxhash64(*order), F.lit(BYPASS_GROUPS)).cast("string"))
    bucket = F.concat(F.lit("b"), F.pmod(F.xxhash64(own), F.lit(buckets)).cast("string"))
    packed = rows.select(
        *[F.col(name).cast("string") if name == "version" else F.col(name) for name in rows.columns if name not in carried],
        F.array(*[F.col(name) for name in carried]).cast("array<string>").alias("_carried"),
        F.when(usable, own).alias("_state_key"),
        F.when(~usable, bypass).otherwise(bucket if ttl_ms is None else F.concat(F.lit("k"), own)).alias("_group"),
    )

    def run(group, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        if group[0].startswith("r"):
            yield from frames
            return
        frames = list(frames)
        frame = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
        # Missing places come last, and are not themselves compared.
        ranks = [tuple((True, 0) if pd.isna(v) else (False, v) for v in place) for place in zip(*[frame[name].tolist() for name in order])]
        keys, versions, types = (frame[name].tolist() for name in ("_state_key", "version", "type"))
        histories: dict[str, list[int]] = {}
        for at in sorted(range(len(frame)), key=ranks.__getitem__):
            histories.setdefault(keys[at], []).append(at)
        states, kept = json.loads(state.get[0]) if state.exists else {}, []
        for name, places in histories.items():
            deletes = [isinstance(types[at], str) and types[at].upper() == "DELETE" for at in places]
            accepted, after = keep_new_versions([int(versions[at]) for at in places], deletes, states.pop(name, None))
            kept += [at for at, new in zip(places, accepted) if new]
            if after is not None:
                states[name] = after
        if states:
            state.update((json.dumps(states),))
            if ttl_ms is not None:
                state.setTimeoutDuration(ttl_ms)
        elif state.exists:
            state.remove()
        if kept:
            yield frame.iloc[kept]

    timeout = GroupStateTimeout.NoTimeout if ttl_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    passed = packed.groupBy("_group").applyInPandasWithState(run, packed.schema, "states string", "append", timeout)
    carried_at = {name: at for at, name in enumerate(carried)}
    return passed.select(*[
        F.col("_carried")[carried_at[name]].alias(name) if name in carried_at
        else F.col(name).cast("bigint").alias(name) if name == "version" else F.col(name) for name in rows.columns])


def drop_redelivered(rows: DataFrame, event_time: str = "timestamp", within: str | None = None) -> DataFrame:
    """Drops repeated ids. All ids are kept as state, and no row is dropped for being late.

    ``within`` bounds the state to ids that arrive within that time of each other, at a price: rows later than that
    behind the newest event time are dropped, repeated or not.
    """
    if within is None:
        return rows.dropDuplicates(["id"])
    return rows.withWatermark(event_time, within).dropDuplicatesWithinWatermark(["id"])
