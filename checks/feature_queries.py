"""Keyed states, open schemas, published tables and lookups, each through the store or a written table."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import fixtures as fx
from checks.registry import over_filtered, over_valid, query
from checks.row_queries import CURRENT
from tidelog.functions import summary as S
from tidelog.operators import apply, envelope, evolution, lineage, tables
from tidelog.options import parse_topic_map
from tidelog.plans import ingest
from tidelog.session import shared_folder, written_once
from tidelog.sources import published
from tidelog.sources.changelog import ChangelogStore
from tidelog.sources.topics import replay_batch, replay_stream
from tidelog.streaming.ingest import CHANGELOG, start_ingest

OPTIONS = replace(fx.OPTIONS, tolerate_errors=True)


def _folder(spark) -> str:
    return f"{shared_folder(spark)}/feature-{uuid.uuid4().hex}"


# --- keyed states -----------------------------------------------------------------------------

HOT = """
WITH RECURSIVE msg AS (
    SELECT event_id AS off, CASE WHEN event_id % 3 = 1 THEN 'HOT' ELSE 'U' || user_id END AS k, event_id % 10 = 0 AS gone,
           event_id // 10 + CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS version
    FROM events),
ord AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY off) AS rn FROM msg),
fold AS (
    SELECT k, rn, off, version, TRUE AS ok, CASE WHEN NOT gone THEN version END AS s FROM ord WHERE rn = 1
    UNION ALL
    SELECT o.k, o.rn, o.off, o.version, f.s IS NULL OR o.version > f.s,
           CASE WHEN f.s IS NULL OR o.version > f.s THEN CASE WHEN NOT o.gone THEN o.version END ELSE f.s END
    FROM fold f JOIN ord o ON o.k = f.k AND o.rn = f.rn + 1)
"""


def _halves(spark, sf, messages):
    """A folder with the messages, and the offset that cuts them in two."""
    folder = _folder(spark)
    messages.write.parquet(f"{folder}/all")
    records = replay_batch(spark, f"{folder}/all")
    return folder, records, records.agg(F.max("offset")).first()[0] // 2


@query("str_3_hot_key", HOT + "SELECT off AS \"offset\", k AS dedup_key, version FROM fold WHERE ok")
def hot_key(spark, sf):
    """Two runs of a stream; the second filters by states in buckets."""
    folder, records, middle = _halves(spark, sf, fx.hot_messages(spark, sf))
    store = ChangelogStore(spark, f"{folder}/store", state_buckets=8)
    for late in (False, True):
        records.where((F.col("offset") > middle) == late).write.mode("append").parquet(f"{folder}/topics")
        start_ingest(replay_stream(spark, f"{folder}/topics"), store, OPTIONS, f"{folder}/checkpoint", CHANGELOG,
                     trigger={"availableNow": True}).awaitTermination()
        if not late:
            store.compact(OPTIONS)
    return store.changelog().select("offset", "dedup_key", "version")


@query("str_9_bucketed_states", HOT + """
    SELECT k AS dedup_key, arg_max(s, rn) AS version FROM (SELECT * FROM fold) GROUP BY k
    HAVING arg_max(CASE WHEN s IS NULL THEN 0 ELSE 1 END, rn) = 1""")
def bucketed_states(spark, sf):
    folder, records, middle = _halves(spark, sf, fx.hot_messages(spark, sf))
    store = ChangelogStore(spark, f"{folder}/store", state_buckets=8)
    for late in (False, True):
        ingest.ingest_batch(store, records.where((F.col("offset") > middle) == late), int(late), OPTIONS)
        store.compact(OPTIONS)
    return store.keyed_states().base.select("dedup_key", "version")


# --- open schemas -----------------------------------------------------------------------------


@query("snk_9_inferred_schema", """
WITH t AS (SELECT *, event_id % 5 = 0 AS no_value, event_id % 2 <> 0 AS no_note, event_id % 4 <> 0 AS no_deep FROM events)
SELECT * FROM (
    SELECT 'event_id' AS path, lower(any_value(typeof(event_id))) AS type, bool_or(event_id IS NULL) AS nullable FROM t
    UNION ALL SELECT 'kind', 'string', bool_or(event_type IS NULL) FROM t
    UNION ALL SELECT 'note', 'string', bool_or(no_note) FROM t
    UNION ALL SELECT 'reading', 'struct', FALSE
    UNION ALL SELECT 'reading.deep', lower(any_value(typeof(value))), bool_or(no_deep OR value IS NULL) FROM t
    UNION ALL SELECT 'reading.inner', 'struct', FALSE
    UNION ALL SELECT 'reading.inner.seventh', lower(any_value(typeof(event_id % 7 = 0))), FALSE FROM t
    UNION ALL SELECT 'reading.inner.side', 'string', bool_or(event_id % 2 <> 0) FROM t
    UNION ALL SELECT 'reading.k', 'bigint', bool_or(regexp_extract(props, '[0-9]+') = '') FROM t
    UNION ALL SELECT 'tags', 'array', FALSE
    UNION ALL SELECT 'tags[].n', 'bigint', TRUE
    UNION ALL SELECT 'tags[].tag', 'string', TRUE
    UNION ALL SELECT 'value', lower(any_value(typeof(value))), bool_or(no_value OR value IS NULL) FROM t)""")
def inferred_schema(spark, sf):
    found = evolution.schema_of_json(fx.open_records(spark, sf), "record")
    return spark.createDataFrame(evolution.schema_rows(found), "path string, type string, nullable boolean")


@query("snk_9_typed_items", """
SELECT event_id AS "offset", event_id, event_type AS kind, CASE WHEN event_id % 5 <> 0 THEN value END AS value,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CASE WHEN event_id % 2 = 0 THEN 'even' END AS side,
       CAST(event_id % 3 * 2 AS BIGINT) AS tag_sum FROM events""")
def typed_items(spark, sf):
    typed, _ = evolution.read_items(fx.open_records(spark, sf), "record")
    total = F.aggregate("tags", F.lit(0).cast("bigint"), lambda done, tag: done + tag["n"])
    return typed.select("offset", "event_id", "kind", "value", F.col("reading.k").alias("k"),
                        F.col("reading.inner.side").alias("side"), total.alias("tag_sum"))


@query("snk_10_11_12_nested_evolution", """
SELECT CAST(event_id AS BIGINT) AS id, CASE WHEN event_id % 2 = 1 THEN value ELSE CAST(floor(value) AS DOUBLE) END AS value,
       CAST(user_id AS BIGINT) AS user_id, CASE WHEN event_id % 2 = 1 THEN event_type END AS kind,
       CAST(user_id % 100 AS DECIMAL(12, 2)) AS share, CAST(event_id % 3 AS BIGINT) AS first_n,
       CASE WHEN event_id % 2 = 1 THEN 'x' END AS first_tag FROM events""")
def nested_evolution(spark, sf):
    """The stored half has narrow numbers; the incoming half wider ones, more fields and names in another case."""
    events, event = fx.table(spark, sf, "events"), F.col("event_id")
    stored = events.where(event % 2 == 0).select(
        event.cast("int").alias("id"), F.floor("value").cast("int").alias("value"),
        F.struct(F.col("user_id").cast("int").alias("user_id"), (F.col("user_id") % 100).cast("decimal(6,1)").alias("share")).alias("who"),
        F.array(F.struct((event % 3).cast("smallint").alias("n"))).alias("tags"))
    incoming = events.where(event % 2 == 1).select(
        F.struct((F.col("user_id") % 100).cast("decimal(12,2)").alias("Share"), F.col("event_type").alias("kind"), F.col("user_id").alias("User_Id")).alias("WHO"),
        F.array(F.struct(F.lit("x").alias("tag"), (event % 3).alias("N"))).alias("Tags"), event.alias("ID"), F.col("value").alias("Value"))
    merged = evolution.evolve_union(stored, incoming, case_insensitive=True, force_optional=True)
    return merged.select("id", "value", "who.user_id", "who.kind", F.col("who.share").cast("decimal(12,2)").alias("share"),
                         F.col("tags")[0]["n"].alias("first_n"), F.col("tags")[0]["tag"].alias("first_tag"))


# --- published tables -------------------------------------------------------------------------

MOMENTS = {"year": ("2024-01-01", "2024-12-31"), "month": ("2024-01-01", "2024-01-31"), "day": ("2024-01-02", "2024-01-03 11:30:00"),
           "hour": ("2024-01-01 05:30:00", "2024-01-01 20:15:00")}


def _pruned(spark, sf, spec, conditions):
    path = f"{_folder(spark)}/events"
    rows = fx.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    published.write_by_spec(rows, path, spec)
    return published.scan(spark, path, spec, conditions, rows.schema).select("event_id", "user_id", "event_type")


def _register_pruned(name, spec, conditions, where):
    query(f"snk_13_pruned_{name}", f"SELECT event_id, user_id, event_type FROM events WHERE {where}")(
        lambda spark, sf: _pruned(spark, sf, spec, conditions(spark) if callable(conditions) else conditions))


for _unit, (_low, _high) in MOMENTS.items():
    _register_pruned(_unit, [f"{_unit}(ts)"], [("ts", ">", _low), ("ts", "<=", _high)], f"ts > TIMESTAMP '{_low}' AND ts <= TIMESTAMP '{_high}'")
_register_pruned("bucket", ["bucket(user_id, 8)"], [("user_id", "in", [7, 8, 9])], "user_id IN (7, 8, 9)")
_register_pruned("truncate", ["truncate(event_type, 2)"], [("event_type", ">=", "cz"), ("event_type", "<", "p")],
                 "event_type >= 'cz' AND event_type < 'p'")
_register_pruned("truncated_number", ["truncate(event_id, 100)"], [("event_id", "<", 250)], "event_id < 250")
_register_pruned("identity", ["event_type", "bucket(user_id, 4)"], [("event_type", "starts with", "c"), ("user_id", "=", 11)],
                 "starts_with(event_type, 'c') AND user_id = 11")


@query("snk_9_10_15_published", """
SELECT event_id AS "offset", event_id, event_type AS kind, CASE WHEN event_id % 5 <> 0 THEN value END AS value,
       CAST(event_id % 2 AS BIGINT) AS late FROM events""")
def published_twice(spark, sf):
    """Created from the even records; the whole, with one field more, evolves the table."""
    path = f"{_folder(spark)}/open"
    options = replace(OPTIONS, auto_create=True, evolve_schema=True, default_partition_by=("day(ts)", "bucket(kind, 4)"),
                      write_properties={"write.parquet.compression-codec": "zstd", "write.format.default": "parquet"})
    published.publish(fx.open_records(spark, sf, 0), path, "db.open", options, record="record")
    more = fx.open_records(spark, sf).withColumn("late", F.col("offset") % 2)
    published.publish(more, path, "db.open", options, record="record")
    return published.scan(spark, path, options.default_partition_by).select("offset", "event_id", "kind", "value", "late")


@query("app_3_changed_buckets", over_valid("""
, base AS (SELECT * FROM valid WHERE off <= (SELECT max(off) // 2 FROM msg) AND op <> 'D'),
batch AS (SELECT * FROM valid WHERE off > (SELECT max(off) // 2 FROM msg) AND dedup_key IN ('U1', 'U2', 'U3')),
last AS (SELECT tbl, dedup_key, max(off) FILTER (op <> 'I') AS cut FROM batch GROUP BY ALL)
SELECT id, version FROM base b WHERE NOT EXISTS (SELECT 1 FROM last l WHERE l.tbl = b.tbl AND l.dedup_key = b.dedup_key AND cut IS NOT NULL)
UNION ALL
SELECT id, version FROM batch b JOIN last l USING (tbl, dedup_key) WHERE op <> 'D' AND (cut IS NULL OR off >= cut)"""))
def changed_buckets(spark, sf):
    """A batch of three users' changes, applied to a table in 32 buckets."""
    path, keys = f"{_folder(spark)}/buckets", ["iceberg_table", "dedup_key"]
    needed = ["id", "version", *keys, "_cdc_op", "partition", "offset"]
    rows = written_once(fx.valid_rows(spark, sf).select(*needed))  # the table and the batch are both cut from them
    middle = F.lit(fx.cdc_messages(spark, sf).agg(F.max("offset")).first()[0] // 2)
    columns = ["id", "version", "dedup_key", "iceberg_table"]
    published.write_buckets(rows.where((F.col("offset") <= middle) & (F.col("_cdc_op") != "D")).select(*columns), path, keys, 32)
    batch = rows.where((F.col("offset") > middle) & F.col("dedup_key").isin("U1", "U2", "U3"))
    schema = T.StructType.fromDDL("id string, version bigint, dedup_key string, iceberg_table string")
    published.apply_to_buckets(spark, path, batch, keys, 32, schema=schema)
    return spark.read.parquet(path).select("id", "version")


@query("flt_10_store_lookup", over_filtered(
    CURRENT.format(rows="acc") + "SELECT tbl AS iceberg_table, dedup_key, type, version FROM cur WHERE tbl = 'web.clicks' AND dedup_key = 'U7'"))
def store_lookup(spark, sf):
    folder, records, middle = _halves(spark, sf, fx.cdc_messages(spark, sf))
    store = ChangelogStore(spark, f"{folder}/store")
    ingest.ingest_batch(store, records.where(F.col("offset") <= middle), 0, OPTIONS)
    store.compact(OPTIONS)
    ingest.ingest_batch(store, records.where(F.col("offset") > middle), 1, OPTIONS)
    return store.lookup(OPTIONS, "web.clicks", "U7").select("iceberg_table", "dedup_key", "type", "version")


# --- versions and sketches ----------------------------------------------------------------------

VERSIONS = (0, 1, 2, 3, 5, 8, 11, 14, 17, 19)


@query("src_8_many_versions", over_valid(f"""
, v AS (SELECT unnest({list(VERSIONS)}) AS as_of),
ranked AS (
    SELECT as_of, m.*, max(CASE WHEN op <> 'I' THEN commit_seq * 1000000000000 + part * 100000000000 + off END)
               OVER (PARTITION BY as_of, tbl, dedup_key) AS cut, commit_seq * 1000000000000 + part * 100000000000 + off AS pos
    FROM valid m JOIN v ON m.commit_seq <= v.as_of)
SELECT CAST(as_of AS BIGINT) AS as_of, tbl AS iceberg_table, count(*) AS n_rows, CAST(sum(version) AS BIGINT) AS versions
FROM ranked WHERE op <> 'D' AND (cut IS NULL OR pos >= cut) GROUP BY ALL"""))
def many_versions(spark, sf):
    intervals = apply.validity(fx.changelog(spark, sf), ["iceberg_table", "dedup_key"])
    shown = apply.at_versions(intervals, VERSIONS)
    return shown.groupBy("as_of", "iceberg_table").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("version").alias("versions"))


@query("met_4_merged_sketches", over_valid(
    "SELECT tbl AS \"table\", count(*) AS records, TRUE AS median_fits, TRUE AS tail_fits FROM valid GROUP BY tbl"))
def merged_sketches(spark, sf):
    """Sketches of each commit, merged by table, against the exact share of records below each estimate."""
    rows = fx.changelog(spark, sf)
    stamped = rows.groupBy("commit_seq").agg((F.unix_millis(F.max("timestamp")) + 5000).alias("ingest_ms"))
    age = lineage.record_latency(F.col("ingest_ms"), F.col("timestamp"))
    aged = rows.join(stamped, "commit_seq").select(F.col("iceberg_table").alias("table"), "commit_seq", age.alias("age"))
    entry = F.create_map(F.lit(S.LATENCY_SKETCH), lineage.latency_sketch(F.col("age")))
    log = aged.groupBy("table", "commit_seq").agg(entry.alias("summary"))
    merged = lineage.merged_latency(log, (0.5, 0.95))
    below = [F.avg((F.col("age") <= F.col("quantiles_ms")[i]).cast("int")) for i in range(2)]
    met = aged.join(merged, "table").groupBy("table").agg(F.max("records").alias("records"), below[0].alias("half"), below[1].alias("tail"))
    # Besides the sketch's own error, one record more or less matters where a table has few.
    slack = 0.02 + 1 / F.col("records")
    return met.select("table", "records", (F.abs(F.col("half") - 0.5) <= slack).alias("median_fits"),
                      (F.abs(F.col("tail") - 0.95) <= slack).alias("tail_fits"))


# --- the store's own files, failures, tables of a catalog ------------------------------------------

HALVES = """
, halves AS (SELECT *, CASE WHEN off <= (SELECT max(off) // 2 FROM msg) THEN 0 ELSE 1 END AS half FROM acc)
"""


def _two_commits(spark, sf, **how) -> ChangelogStore:
    folder, records, middle = _halves(spark, sf, fx.cdc_messages(spark, sf))
    store = ChangelogStore(spark, f"{folder}/store")
    for late in (False, True):
        ingest.ingest_batch(store, records.where((F.col("offset") > middle) == late), int(late), OPTIONS, **how)
    return store


@query("src_7_joi_3_store_files", over_filtered(HALVES + """
SELECT tbl AS iceberg_table, CAST(half AS BIGINT) AS commit_seq, count(*) AS records,
       CASE WHEN count(*) FILTER (op <> 'I') > 0 THEN 'overwrite' ELSE 'append' END AS operation
FROM halves GROUP BY tbl, half"""))
def store_files(spark, sf):
    store = _two_commits(spark, sf)
    traced = lineage.file_lineage(store.files(), store.snapshots().drop("commit_seq"))
    return traced.groupBy("iceberg_table", "commit_seq").agg(
        F.sum("record_count").alias("records"), F.max("operation").alias("operation"))


@query("met_7_store_row_trace", over_filtered(HALVES + "SELECT id, CAST(half AS BIGINT) AS commit_seq, tbl AS iceberg_table FROM halves"))
def store_row_trace(spark, sf):
    store = _two_commits(spark, sf)
    return lineage.row_lineage(store.with_files().select("id", "file_path"), store.files()).select("id", "commit_seq", "iceberg_table")


@query("snk_4_failed_commit", over_filtered(HALVES + """
SELECT CAST(half AS BIGINT) AS commit_seq, count(*) AS records, 0 AS seen_after_failure FROM halves GROUP BY half"""))
def failed_commit(spark, sf):
    """The first attempt of each commit fails while its rows are written; nothing of it shows, and it is done again."""
    folder, records, middle = _halves(spark, sf, fx.cdc_messages(spark, sf))
    store, seen = ChangelogStore(spark, f"{folder}/store"), {}
    for seq, late in enumerate((False, True)):
        batch = records.where((F.col("offset") > middle) == late)
        broken = F.when(F.col("offset") % 50 == 0, F.raise_error(F.lit("disk full")).cast("boolean")).otherwise(F.lit(True))
        try:
            ingest.ingest_batch(store, batch, seq, OPTIONS, steps=[lambda rows: rows.where(broken)])
        except Exception as error:
            if "disk full" not in str(error):
                raise
        seen[seq] = store.changelog().where(F.col("commit_seq") == seq).count()
        ingest.ingest_batch(store, batch, seq, OPTIONS)
    left = F.create_map(*[F.lit(n) for pair in seen.items() for n in pair])
    return store.changelog().groupBy("commit_seq").agg(F.count(F.lit(1)).alias("records")).withColumn(
        "seen_after_failure", left[F.col("commit_seq").cast("int")])


@query("snk_8_created_table", over_valid("SELECT id, dedup_key, version, type FROM valid WHERE tbl = 'web.clicks'"))
def created_table(spark, sf):
    """The eight columns of a target table, in a catalog."""
    name = f"made_{uuid.uuid4().hex[:12]}.clicks"
    tables.create_table(spark, name)
    rows = fx.valid_rows(spark, sf).where(F.col("iceberg_table") == "web.clicks")
    envelope.to_target(rows).write.insertInto(name)
    return spark.table(name).select("id", "dedup_key", "version", "type")


@query("rte_2_map_text", over_valid("SELECT id, tbl AS iceberg_table FROM valid"))
def map_text(spark, sf):
    mapping = parse_topic_map(" evt-click : no.such , evt-error:ops.errors, broken, a:b:c ,evt-click:web.clicks")
    rows = envelope.parse_envelopes(fx.cdc_messages(spark, sf), "default", mapping)
    return envelope.split_errors(rows)[0].select("id", "iceberg_table")
