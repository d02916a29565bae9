"""Change messages, commit events and a snapshot log derived from the given tables.

All three are narrow projections of ``events``: no shuffle, so each query's cost is its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators import commits, envelope, versions
from tidelog.options import IngestOptions, TableOptions

TOPIC_TABLES = {"evt-click": "web.clicks", "evt-error": "ops.errors"}
GROUP = "cg-control-sink"
COMMIT_SPAN = 500
OPTIONS = IngestOptions(
    name="sink-events",
    topic_tables=TOPIC_TABLES,
    dynamic_tables=True,
    route_field="iceberg_table",
    cdc_field="_cdc_op",
    default_id_columns=("dedup_key",),
    control_group=GROUP,
    default_branch="main",
    table_options={"web.clicks": TableOptions(id_columns=("dedup_key",), commit_branch="audit")},
    extra_summary={"pipeline.owner": "data-team"},
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _user_key(shift: int = 0):
    return F.concat(F.lit("U"), (F.col("user_id") + shift).cast("string"))


def cdc_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic records: one per event, with tombstones, invalid, multi-item and stale messages among them."""
    events = table(spark, sf_dir, "events")
    event, user = F.col("event_id"), F.col("user_id")

    def item(key):
        return F.struct(key.alias("user_id"), F.col("value"))

    two = event % 3 == 0
    message = F.struct(
        F.when(two, F.array(item(_user_key(1)), item(_user_key()))).otherwise(F.array(item(_user_key()))).alias("data"),
        F.when(two, 2).otherwise(1).alias("length"),
        F.when(event % 97 != 5, F.lit("user_id")).alias("key"),
        F.when(event % 10 == 0, "DELETE").when(event % 10 <= 3, "INSERT").otherwise("UPDATE").alias("type"),
        (F.floor(event / 10) + F.regexp_extract("props", r"\d+", 0).cast("bigint")).alias("version"),
        F.date_format("ts", "dd/MM/yyyy-HH:mm").alias("ngay_cap_nhat"),
    )
    return events.select(
        F.concat(F.lit("evt-"), F.col("event_type")).alias("topic"),
        F.pmod(user, F.lit(4)).cast("int").alias("partition"),
        event.alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(None).cast("string").alias("key"),
        F.when(event % 101 != 7, F.to_json(message)).alias("value"),
    )


def hot_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic records of which a third have one key."""
    event, user = F.col("event_id"), F.col("user_id")
    hot = event % 3 == 1
    message = F.struct(
        F.array(F.struct(F.when(hot, F.lit("HOT")).otherwise(_user_key()).alias("user_id"))).alias("data"),
        F.lit("user_id").alias("key"), F.when(event % 10 == 0, "DELETE").otherwise("UPDATE").alias("type"),
        (F.floor(event / 10) + F.regexp_extract("props", r"\d+", 0).cast("bigint")).alias("version"))
    return table(spark, sf_dir, "events").select(
        F.lit("evt").alias("topic"), F.when(hot, 0).otherwise(F.pmod(user, F.lit(4))).cast("int").alias("partition"),
        event.alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"), F.lit(None).cast("string").alias("key"),
        F.to_json(message).alias("value"))


def open_records(spark: SparkSession, sf_dir: str, part: int | None = None) -> DataFrame:
    """Records with an open schema: nested, missing and null fields, whole numbers beside fractions, arrays of objects."""
    event = F.col("event_id")
    reading = F.struct(
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.when(event % 4 == 0, F.col("value")).alias("deep"),
        F.struct(F.when(event % 2 == 0, F.lit("even")).alias("side"), (event % 7 == 0).alias("seventh")).alias("inner"))
    item = F.struct(
        event.alias("event_id"), F.col("event_type").alias("kind"), F.when(event % 5 != 0, F.col("value")).alias("value"),
        F.when(event % 2 == 0, (event * 10).cast("string")).alias("note"), reading.alias("reading"),
        F.array(*[F.struct((event % 3).alias("n"), F.lit(tag).cast("string").alias("tag")) for tag in (None, "x")]).alias("tags"))
    rows = table(spark, sf_dir, "events")
    rows = rows if part is None else rows.where(event % 2 == part)
    return rows.select(event.alias("offset"), "ts", F.to_json(F.array(item)).alias("record"))


def rows_with_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.parse_envelopes(cdc_messages(spark, sf_dir), mapping=TOPIC_TABLES)


def valid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.split_errors(rows_with_errors(spark, sf_dir))[0]


# What the version filter itself reads. It deals out and gathers whole rows, so other columns are left out before it.
FILTER_COLUMNS = ("topic", "dedup_key", "partition", "offset", "version", "type")


def accepted_rows(spark: SparkSession, sf_dir: str, columns: tuple[str, ...] | None = None) -> DataFrame:
    levels, rows = versions.chunk_levels(cdc_messages(spark, sf_dir)), valid_rows(spark, sf_dir)
    return versions.filter_versions(rows.select(*columns) if columns else rows, chunk_bits=levels)


def numbered(rows: DataFrame) -> DataFrame:
    """Rows as a changelog: every 500 messages make a commit."""
    return rows.withColumn("commit_seq", F.floor(F.col("offset") / COMMIT_SPAN))


def changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered(valid_rows(spark, sf_dir))


def snapshots(spark: SparkSession, sf_dir: str, options=None, rows: DataFrame | None = None) -> DataFrame:
    """The snapshot log of that changelog (``rows``); each commit is stamped five seconds after its newest record."""
    rows = changelog(spark, sf_dir) if rows is None else rows
    stamped = rows.groupBy("commit_seq").agg((F.unix_millis(F.max("timestamp")) + 5000).alias("ingest_ms"))
    changes = commits.running_totals(commits.skip_empty(commits.table_changes(rows)))
    vectors = commits.commit_vectors(rows)
    return commits.snapshot_rows(changes.join(stamped, "commit_seq"), vectors, options or OPTIONS, GROUP)


def commit_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commit events, one per event row, with files named repeatedly within and across events."""
    event, user = F.col("event_id"), F.col("user_id")

    def file(prefix, number):
        return F.struct(
            F.concat(F.lit(prefix), number.cast("string"), F.lit(".parquet")).alias("path"),
            (number % 3).cast("int").alias("spec_id"),
            (number % 13).alias("record_count"),
        )

    seventh = F.floor(event / 7)
    first = file("data-", seventh)
    written = event % 4 != 3
    assignment = F.struct(
        F.lit("t").alias("topic"), (user % 4).cast("int").alias("partition"), event.alias("offset"),
        F.when(event % 97 != 0, F.col("ts").cast("timestamp")).alias("ts"),
    )
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("e"), event.cast("string")).alias("event_id"),
        F.when(user % 5 == 0, "other").otherwise(GROUP).alias("group_id"),
        F.col("ts").cast("timestamp").alias("event_ts"),
        F.when(written, "DATA_WRITTEN").otherwise("DATA_COMPLETE").alias("type"),
        (user % 3).cast("int").alias("partition"),
        event.alias("offset"),
        F.concat(F.lit("c"), F.floor(event / COMMIT_SPAN).cast("string")).alias("commit_id"),
        F.concat(F.lit("db."), F.col("event_type")).alias("table"),
        F.when(written & (event % 11 == 0), F.array(first, first)).when(written, F.array(first)).alias("data_files"),
        F.when(written & (user % 6 == 0), F.array(file("delete-", F.floor(event / 9)))).alias("delete_files"),
        F.when(~written & (event % 8 == 3), F.array(assignment, assignment))
        .when(~written, F.array(assignment)).alias("assignments"),
    )


def raw_commit_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as undecoded text, some of it broken."""
    return commit_events(spark, sf_dir).select(
        "event_id", "partition", "offset",
        F.when(F.col("offset") % 89 == 3, F.lit("garbage{")).otherwise(
            F.to_json(F.struct("group_id", "type", "commit_id"))
        ).alias("payload"),
    )
