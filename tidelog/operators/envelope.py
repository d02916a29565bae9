"""Change envelopes: decode, validate, project.

The JSON text is read once per row. The reading steps are generators with a single output row, which the
optimizer neither repeats nor merges into the filters above them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions import json_fields as J
from tidelog.functions.text import operation_code, table_from_topic
from tidelog.schemas import INTERNAL_COLUMNS, LINEAGE_COLUMNS, TARGET_COLUMNS

# Words stored in the ``error`` column.
MALFORMED = "value is not JSON"
NOT_OBJECT = "value is not a JSON object"
BAD_VERSION = "version is not an integer"
BAD_LENGTH = "length is not an integer"
EMPTY_DATA = "data is an empty list"
NO_KEY_VALUE = "no key value in data"


def missing(name: str) -> str:
    return f"missing field {name}"


def record_id(topic: str = "topic", partition: str = "partition", offset: str = "offset") -> Column:
    """Replay-stable id ``topic-partition-offset``."""
    return F.concat_ws(
        "-",
        F.coalesce(F.col(topic), F.lit("unknown")),
        F.coalesce(F.col(partition).cast("string"), F.lit("0")),
        F.col(offset).cast("string"),
    )


def record_id_or_random(offset: str = "offset", **names: str) -> Column:
    """Random id where a record carries no offset. Not replay-stable: keep it out of keyed logic."""
    return F.when(F.col(offset).isNotNull(), record_id(offset=offset, **names)).otherwise(F.uuid())


def drop_tombstones(records: DataFrame) -> DataFrame:
    return records.where(F.col("value").isNotNull())


def decode_records(records: DataFrame) -> DataFrame:
    """Adds ``doc``, the decoded value."""
    return records.withColumn("doc", J.decode(F.col("value")))


def struct_as_document(rows: DataFrame, *columns: str) -> DataFrame:
    """Typed columns flattened one level into ``value`` text, so that typed sources join the same path."""
    return rows.withColumn("value", F.to_json(F.struct(*columns)))


def topic_table(topic: Column, namespace: str = "default", mapping: dict[str, str] | None = None) -> Column:
    """Mapped table first, else derived from the topic name. The mapping is option text, so a literal map."""
    derived = table_from_topic(topic, namespace)
    if not mapping:
        return derived
    pairs = [F.lit(part) for item in mapping.items() for part in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), topic), derived)


def _once(rows: DataFrame, value: Column) -> DataFrame:
    """Adds the fields of the struct ``value``, computed exactly once per row."""
    return rows.select("*", F.inline_outer(F.array(value)))


def _read_fields(records: DataFrame) -> DataFrame:
    """Envelope fields beside the lineage columns, and ``_fault`` for text that holds no object."""
    text = F.ltrim(F.col("value"), F.lit(J.BLANKS))
    source = drop_tombstones(records).select(*LINEAGE_COLUMNS, "value")
    read = _once(source, J.envelope(F.col("value")))
    fault = F.when(
        F.col("_corrupt_record").isNotNull() & J.decode(F.col("value")).isNull(), MALFORMED
    ).when(~text.startswith("{"), NOT_OBJECT)
    return read.select(
        *LINEAGE_COLUMNS, record_id().alias("id"), F.when(~F.coalesce(J.is_text_of_list(F.col("value"), F.col("data")), F.lit(False)), F.col("data")).alias("data"), "key", "type", "version", "ngay_cap_nhat", "length",
        fault.alias("_fault"),
    )


def parse_envelopes(
    records: DataFrame, namespace: str = "default", mapping: dict[str, str] | None = None
) -> DataFrame:
    """Topic records to the ten-field row plus lineage columns and ``error`` (null for a valid row).

    Tombstones are left out. A row that breaks several rules carries the first in checking order: the
    version of a row with a usable key is read before the other fields are looked at.
    """
    fields = _read_fields(records).withColumnsRenamed({"version": "_version", "length": "_length"})
    derived = _once(
        _once(fields, F.struct(J.key_objects(F.col("data")).alias("_objects"))),
        F.struct(
            J.key_values(F.col("_objects"), F.col("data"), F.col("key")).alias("_key_values"),
            J.variant_long(F.col("_version")).alias("version"),
            J.kind(F.col("_version")).alias("_version_kind"),
            F.coalesce(F.col("_length").try_cast("string"), F.lit("0")).alias("length"),
        ),
    ).withColumn("dedup_key", J.composite_key(F.col("_key_values")))
    unusable_version = F.col("_version_kind").isNotNull() & F.col("version").isNull()
    error = (
        F.when(F.col("_fault").isNotNull(), F.col("_fault"))
        .when(F.col("dedup_key").isNotNull() & unusable_version, BAD_VERSION)
        .when(F.col("data").isNull(), missing("data"))
        .when(F.col("type").isNull(), missing("type"))
        .when(F.col("_version_kind").isNull(), missing("version"))
        .when(F.col("key").isNull(), missing("key"))
        .when(F.col("data") == "[]", EMPTY_DATA)
        .when(F.col("dedup_key").isNull(), NO_KEY_VALUE)
        .when(unusable_version, BAD_VERSION)
    )
    return derived.withColumn("error", error).withColumnRenamed("data", "record").select(
        *LINEAGE_COLUMNS,
        *TARGET_COLUMNS,
        topic_table(F.col("topic"), namespace, mapping).alias("iceberg_table"),
        operation_code(F.col("type")).alias("_cdc_op"),
        "error",
    )


def parse_legacy_envelopes(records: DataFrame) -> DataFrame:
    """Older message rules: key ``topic:field``, update time and length mandatory, empty data allowed."""
    derived = _once(
        _read_fields(records).withColumnsRenamed({"version": "_version", "length": "_length"}),
        F.struct(
            J.variant_long(F.col("_version")).alias("version"),
            J.kind(F.col("_version")).alias("_version_kind"),
            J.variant_long(F.col("_length")).alias("_given_length"),
            J.kind(F.col("_length")).alias("_length_kind"),
        ),
    )
    required = {
        "key": "key", "type": "type", "version": "_version_kind", "ngay_cap_nhat": "ngay_cap_nhat",
        "length": "_length_kind", "data": "data",
    }
    error = F.when(F.col("_fault").isNotNull(), F.col("_fault"))
    for name, column in required.items():
        error = error.when(F.col(column).isNull(), missing(name))
    error = error.when(F.col("version").isNull(), BAD_VERSION).when(F.col("_given_length").isNull(), BAD_LENGTH)
    length = F.when(F.col("data") == "[]", F.lit(0).cast("bigint")).otherwise(F.col("_given_length"))
    return derived.select(
        *LINEAGE_COLUMNS,
        "id",
        legacy_key().alias("dedup_key"),
        F.col("data").alias("record"),
        F.col("ngay_cap_nhat").alias("ingest_time"),
        length.alias("length"),
        "key",
        "type",
        "version",
        error.alias("error"),
    )


def legacy_key(topic: str = "topic", key: str = "key") -> Column:
    return F.concat(F.col(topic), F.lit(":"), F.col(key))


def fail_on_errors(rows: DataFrame) -> DataFrame:
    """Stops the job at the first bad row; otherwise the rows without their ``error`` column."""
    note = F.concat(F.lit("bad message "), F.col("id"), F.lit(": "), F.col("error"))
    checked = F.when(F.col("error").isNotNull(), F.raise_error(note).cast("boolean")).otherwise(F.lit(True))
    return rows.where(checked).drop("error")


def split_errors(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows)."""
    good = rows.where(F.col("error").isNull()).drop("error")
    return good, rows.where(F.col("error").isNotNull())


def strip_internal(rows: DataFrame) -> DataFrame:
    return rows.drop(*INTERNAL_COLUMNS)


def to_target(rows: DataFrame) -> DataFrame:
    return rows.select(*TARGET_COLUMNS)


def expand_items(rows: DataFrame, item_schema: str) -> DataFrame:
    """One row per object stored in ``record``; the columns of ``item_schema`` are added."""
    items = F.from_json(F.col("record"), f"array<struct<{_as_struct_fields(item_schema)}>>")
    return rows.withColumn("_item", F.explode(items)).select(*rows.columns, "_item.*")


def _as_struct_fields(ddl: str) -> str:
    return ",".join(":".join(part.split(None, 1)) for part in ddl.split(","))
