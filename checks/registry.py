"""Queries and the SQL each is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


# The change messages of fixtures.cdc_messages, recomputed from the base columns without any JSON.
MESSAGES = """
WITH RECURSIVE msg AS (
    SELECT 'evt-' || event_type AS topic, CAST(user_id % 4 AS INTEGER) AS part, event_id AS off, ts, user_id, value,
           event_type, event_id % 101 = 7 AS tomb, event_id % 97 = 5 AS nokey,
           'evt-' || event_type || '-' || (user_id % 4) || '-' || event_id AS id,
           CASE WHEN event_id % 3 = 0
                THEN least('U' || user_id, 'U' || (user_id + 1)) || '||' || greatest('U' || user_id, 'U' || (user_id + 1))
                ELSE 'U' || user_id END AS dedup_key,
           CASE WHEN event_id % 10 = 0 THEN 'DELETE' WHEN event_id % 10 <= 3 THEN 'INSERT' ELSE 'UPDATE' END AS type,
           CASE WHEN event_id % 10 = 0 THEN 'D' WHEN event_id % 10 <= 3 THEN 'I' ELSE 'U' END AS op,
           event_id // 10 + CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS version,
           strftime(ts, '%d/%m/%Y-%H:%M') AS upd,
           CASE WHEN event_id % 3 = 0 THEN 2 ELSE 1 END AS n_items,
           CASE event_type WHEN 'click' THEN 'web.clicks' WHEN 'error' THEN 'ops.errors'
                ELSE 'default.evt_' || event_type END AS tbl,
           event_id // 500 AS commit_seq
    FROM events),
valid AS (SELECT * FROM msg WHERE NOT tomb AND NOT nokey),
"""

# The version filter, one message at a time.
FILTERED = MESSAGES + """
ord AS (SELECT *, row_number() OVER (PARTITION BY topic, dedup_key ORDER BY part, off) AS rn FROM valid),
fold AS (
    SELECT topic, dedup_key, rn, off, CAST(NULL AS BIGINT) AS prev, TRUE AS ok,
           CASE WHEN type = 'DELETE' THEN NULL ELSE version END AS s
    FROM ord WHERE rn = 1
    UNION ALL
    SELECT o.topic, o.dedup_key, o.rn, o.off, f.s, f.s IS NULL OR o.version > f.s,
           CASE WHEN f.s IS NULL OR o.version > f.s
                THEN CASE WHEN o.type = 'DELETE' THEN NULL ELSE o.version END ELSE f.s END
    FROM fold f JOIN ord o ON o.topic = f.topic AND o.dedup_key = f.dedup_key AND o.rn = f.rn + 1),
acc AS (SELECT v.* FROM valid v JOIN fold f ON v.off = f.off WHERE f.ok)
"""


def over_messages(body: str) -> str:
    return MESSAGES + body


def over_valid(select: str) -> str:
    """A single SELECT over msg / valid."""
    return MESSAGES.rstrip().rstrip(",") + "\n" + select


def over_filtered(select: str) -> str:
    return FILTERED + select


# fixtures.commit_events: one row per file mention, recomputed.
MENTIONS = """
WITH ev AS (
    SELECT event_id AS off, user_id, event_type, ts, 'e' || event_id AS event_id,
           CASE WHEN user_id % 5 = 0 THEN 'other' ELSE 'cg-control-sink' END AS group_id,
           CASE WHEN event_id % 4 <> 3 THEN 'DATA_WRITTEN' ELSE 'DATA_COMPLETE' END AS type,
           CAST(user_id % 3 AS INTEGER) AS part, 'c' || (event_id // 500) AS commit_id, 'db.' || event_type AS tbl
    FROM events),
f AS (
    SELECT event_id, commit_id, tbl, part, off, 'data' AS content, p.pos, 'data-' || (off // 7) || '.parquet' AS path,
           CAST((off // 7) % 3 AS INTEGER) AS spec_id, (off // 7) % 13 AS record_count
    FROM ev, (VALUES (0), (1)) p(pos) WHERE type = 'DATA_WRITTEN' AND (p.pos = 0 OR off % 11 = 0)
    UNION ALL
    SELECT event_id, commit_id, tbl, part, off, 'delete', 0, 'delete-' || (off // 9) || '.parquet',
           CAST((off // 9) % 3 AS INTEGER), (off // 9) % 13
    FROM ev WHERE type = 'DATA_WRITTEN' AND user_id % 6 = 0),
uniq AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY commit_id, tbl, content, path ORDER BY part, off, pos) AS rn
                   FROM f) WHERE rn = 1),
asg AS (
    SELECT commit_id, off, user_id % 4 AS part, CASE WHEN off % 97 <> 0 THEN ts END AS ts
    FROM ev, (VALUES (0), (1)) p(pos) WHERE type = 'DATA_COMPLETE' AND (p.pos = 0 OR off % 8 = 3))
"""


def over_mentions(select: str) -> str:
    return MENTIONS + select


# fixtures.snapshots, recomputed.
SNAPSHOTS = MESSAGES + """
off_p AS (SELECT commit_seq, topic, part, max(off) + 1 AS nxt, arg_max(ts, off) AS ts FROM valid GROUP BY ALL),
vec AS (
    SELECT commit_seq,
           '{' || string_agg('"' || topic || '/' || part || '":' || nxt, ',' ORDER BY topic || '/' || part) || '}' AS offsets,
           min((epoch_us(ts) // 1000)) AS wm
    FROM off_p GROUP BY commit_seq),
stamp AS (SELECT commit_seq, (epoch_us(max(ts)) // 1000) + 5000 AS ingest_ms FROM valid GROUP BY commit_seq),
chg AS (
    SELECT tbl, commit_seq, count(*) FILTER (op IN ('I', 'U')) AS added, count(*) FILTER (op IN ('U', 'D')) AS removed
    FROM valid GROUP BY ALL),
snap AS (
    SELECT c.tbl, c.commit_seq, CASE WHEN removed > 0 THEN 'overwrite' ELSE 'append' END AS operation, added, removed,
           CAST(sum(added) OVER (PARTITION BY c.tbl ORDER BY c.commit_seq) AS BIGINT) AS total,
           ingest_ms, offsets, wm,
           CAST('0x' || substr(md5(c.tbl || '#' || c.commit_seq), 1, 15) AS BIGINT) AS snapshot_id,
           substr(md5('cg-control-sink#' || c.commit_seq), 1, 8) || '-' || substr(md5('cg-control-sink#' || c.commit_seq), 9, 4)
           || '-' || substr(md5('cg-control-sink#' || c.commit_seq), 13, 4) || '-'
           || substr(md5('cg-control-sink#' || c.commit_seq), 17, 4) || '-'
           || substr(md5('cg-control-sink#' || c.commit_seq), 21, 12) AS commit_id
    FROM chg c JOIN vec USING (commit_seq) JOIN stamp USING (commit_seq))
"""


def over_snapshots(select: str) -> str:
    return SNAPSHOTS + select
