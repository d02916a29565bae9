"""Topic records as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.options import IngestOptions
from tidelog.schemas import TOPIC_RECORD


def kafka_options(
    servers: str, options: IngestOptions, max_records: int | None = None, offsets: str | None = None
) -> dict[str, str]:
    """Reader options for a list of topics. A checkpoint, once there, wins over the start position.

    ``none`` asks for offsets that are already committed: pass them as ``offsets`` (Kafka's JSON), else it is refused.
    Offsets that are no longer there stop the query, whatever the start position.
    """
    if options.start_position == "none" and offsets is None:
        raise ValueError("start position none needs committed offsets")
    chosen = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(options.topics),
        "startingOffsets": offsets or options.start_position,
        "failOnDataLoss": "true",
        **{f"kafka.{name}": value for name, value in options.kafka_properties.items()},
    }
    if max_records is not None:
        chosen["maxOffsetsPerTrigger"] = str(max_records)
    return chosen


def kafka_stream(
    spark: SparkSession, servers: str, options: IngestOptions, max_records: int | None = None, offsets: str | None = None
) -> DataFrame:
    """Needs the Kafka connector on the class path; untested here, where it is not installed."""
    reader = spark.readStream.format("kafka").options(**kafka_options(servers, options, max_records, offsets))
    return as_records(reader.load())


def kafka_batch(spark: SparkSession, servers: str, options: IngestOptions) -> DataFrame:
    """Full replay from the start of the topics."""
    chosen = {**kafka_options(servers, options, offsets="earliest"), "startingOffsets": "earliest"}
    return as_records(spark.read.format("kafka").options(**chosen).load())


def as_records(kafka_rows: DataFrame) -> DataFrame:
    return kafka_rows.select(
        "topic", "partition", "offset", "timestamp",
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
    )


def replay_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Topic dumps in Parquet as a stream, oldest file first."""
    reader = spark.readStream.schema(TOPIC_RECORD)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def replay_batch(spark: SparkSession, folder: str, topics: Sequence[str] = ()) -> DataFrame:
    rows = spark.read.schema(TOPIC_RECORD).parquet(folder)
    return rows.where(F.col("topic").isin(list(topics))) if topics else rows


def resume(records: DataFrame, committed: DataFrame, start: str = "earliest") -> DataFrame:
    """Records a batch job still has to read.

    Where a topic partition has a committed offset (``topic, partition, next_offset``) reading goes on
    there. Elsewhere ``start`` decides: all (earliest), nothing that is already there (latest), or an
    error (none).
    """
    place = ["topic", "partition"]
    known = F.col("next_offset")
    rest = {
        "earliest": F.lit(True),
        "latest": F.lit(False),
        "none": F.raise_error(F.concat(F.lit("no committed offset for "), F.concat_ws("/", *place))).cast("boolean"),
    }[start]
    unread = F.when(known.isNotNull(), F.col("offset") >= known).otherwise(rest)
    return records.join(committed.select(*place, "next_offset"), place, "left").where(unread).select(*records.columns)
