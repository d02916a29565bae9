"""Published tables: Parquet folders laid out by a partition spec, by key bucket, or in key order for lookups.

Readers name conditions on source columns. ``scan`` adds what each condition says about the partition values, so that
folders are pruned before a file is opened, and keeps the condition itself, so the result never depends on the layout.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators import apply, evolution
from tidelog.options import IngestOptions

Condition = tuple[str, str, Any]  # column, operator, value (a list for "in")
OPERATORS = ("=", "in", "<", "<=", ">", ">=", "starts with")

_UNITS = ("year", "month", "day", "hour")
_SPEC = re.compile(r"(year|month|day|hour)s?\(\s*(\w+)\s*\)|(bucket|truncate)\(\s*(\w+)\s*,\s*(\d+)\s*\)|(\w+)")
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DAY = 86_400_000_000  # microseconds
_HOUR = 3_600_000_000

# Write properties that Parquet folders can honour, and the writer options they set: fixed values.
WRITE_OPTIONS = {
    "write.parquet.compression-codec": "compression",
    "write.parquet.row-group-size-bytes": "parquet.block.size",
    "write.parquet.page-size-bytes": "parquet.page.size",
    "write.parquet.dict-size-bytes": "parquet.dictionary.page.size",
}
BLOOM_PREFIX = "write.parquet.bloom-filter-enabled.column."


@dataclass(frozen=True)
class Part:
    """One entry of a partition spec."""

    kind: str
    column: str
    width: int | None = None

    @property
    def name(self) -> str:
        return f"{self.column}_{self.kind}"

    def rising(self, source: T.DataType) -> bool:
        """Whether a larger value never has a smaller partition value."""
        if self.kind == "identity":
            return isinstance(source, (*_WHOLE, T.StringType))
        return self.kind != "bucket"

    def of(self, value: Column, source: T.DataType) -> Column:
        """The partition value: a whole number, or text behind a letter, as empty text would be read back as null.

        Moments are cut in UTC whatever the session's time zone, so that writers and readers agree.
        """
        if self.kind == "bucket":
            return F.when(value.isNotNull(), F.pmod(F.xxhash64(value), F.lit(self.width)).cast("int"))
        if self.kind == "truncate" and isinstance(source, _WHOLE):
            whole = value.cast("bigint")
            return whole - F.pmod(whole, F.lit(self.width))
        if self.kind == "truncate":
            return F.concat(F.lit("v"), F.substring(value, 1, self.width))
        if self.kind == "identity":
            return value.cast("bigint") if isinstance(source, _WHOLE) else F.concat(F.lit("v"), value.cast("string"))
        if isinstance(source, T.TimestampType):
            micros = F.unix_micros(value)
            if self.kind == "hour":
                return _cut(micros, _HOUR)
            day = _cut(micros, _DAY)
            date = F.date_from_unix_date(day.cast("int"))
        else:
            date = F.to_date(value)
            day = F.unix_date(date).cast("bigint")
            if self.kind == "hour":
                return day * 24 + F.hour(value)
        if self.kind == "day":
            return day
        return F.year(date) if self.kind == "year" else F.year(date) * 12 + F.month(date) - 1


def _cut(micros: Column, unit: int) -> Column:
    return F.round((micros - F.pmod(micros, F.lit(unit))) / unit).cast("bigint")


def parse_spec(spec: Sequence[str], schema: T.StructType) -> list[Part]:
    """Entries of a text spec, checked against the columns they are taken from."""
    parts = []
    for text in spec:
        found = _SPEC.fullmatch(text.strip())
        if not found:
            raise ValueError(f"unknown partition transform {text!r}")
        unit, moment, kind, column, width, identity = found.groups()
        part = Part(unit or kind or "identity", moment or column or identity, int(width) if width else None)
        if part.column not in schema.names:
            raise ValueError(f"{text!r}: no column {part.column!r}")
        source = schema[part.column].dataType
        moments = (T.TimestampType, T.TimestampNTZType) + (() if part.kind == "hour" else (T.DateType,))
        fits = {"truncate": (*_WHOLE, T.StringType)}.get(part.kind, moments if part.kind in _UNITS else T.AtomicType)
        if not isinstance(source, fits) or part.width == 0:
            raise ValueError(f"{text!r} does not fit a column of type {source.simpleString()}")
        if part.name in schema.names or part in parts:
            raise ValueError(f"{text!r}: column {part.name!r} is there already")
        parts.append(part)
    return parts


# --- writing --------------------------------------------------------------------------------


def writer_options(properties: Mapping[str, str]) -> dict[str, str]:
    """Writer options of the write properties; a property that would do nothing is refused."""
    options: dict[str, str] = {}
    for name, value in properties.items():
        if name in WRITE_OPTIONS:
            options[WRITE_OPTIONS[name]] = value
        elif name.startswith(BLOOM_PREFIX):
            options[f"parquet.bloom.filter.enabled#{name[len(BLOOM_PREFIX):]}"] = value
        elif not (name == "write.format.default" and value.lower() == "parquet"):
            raise ValueError(f"write property {name} = {value} cannot be honoured by Parquet folders")
    return options


def write_by_spec(rows: DataFrame, path: str, spec: Sequence[str], properties: Mapping[str, str] | None = None,
                  mode: str = "errorifexists") -> None:
    """Rows in a folder per combination of partition values; source columns stay in the files.

    Rows are rebalanced by partition value: a large partition gets several files, small ones do not get one per task.
    """
    parts = parse_spec(spec, rows.schema)
    laid_out = rows.withColumns({p.name: p.of(F.col(p.column), rows.schema[p.column].dataType) for p in parts}) if parts else rows
    if parts:
        laid_out = laid_out.hint("rebalance", *[p.name for p in parts])
    laid_out.write.mode(mode).options(**writer_options(properties or {})).partitionBy(*[p.name for p in parts]).parquet(path)


# --- reading --------------------------------------------------------------------------------


def _values(condition: Condition) -> list:
    column, operator, value = condition
    if operator not in OPERATORS:
        raise ValueError(f"{column}: operator must be one of {OPERATORS}, not {operator!r}")
    values = list(value) if operator == "in" else [value]
    if not values or any(v is None for v in values):
        raise ValueError(f"{column} {operator}: a condition needs values other than null")
    return values


def _compared(left: Column, operator: str, values: Iterable[Column]) -> Column:
    first, *others = values
    if operator in ("=", "in"):
        return reduce(lambda a, b: a | b, [left == v for v in (first, *others)])
    return {"<": left < first, "<=": left <= first, ">": left > first, ">=": left >= first}[operator]


def condition_column(condition: Condition, schema: T.StructType) -> Column:
    """The condition itself, on the source column."""
    column, operator, _ = condition
    values = _values(condition)
    if operator == "starts with":
        return F.col(column).startswith(values[0])
    return _compared(F.col(column), operator, [F.lit(v).cast(schema[column].dataType) for v in values])


def partition_condition(condition: Condition, part: Part, source: T.DataType) -> Column | None:
    """What a condition on the source column says about the partition value; nothing, for some pairs of the two."""
    column, operator, _ = condition
    values = _values(condition)
    if column != part.column:
        return None
    if operator == "starts with":
        if part.kind == "truncate" and isinstance(source, T.StringType):
            # Characters, as the transform counts them.
            return F.col(part.name) == f"v{values[0][:part.width]}" if len(values[0]) >= part.width else F.col(part.name).startswith(f"v{values[0]}")
        return F.col(part.name).startswith(f"v{values[0]}") if part.kind == "identity" and isinstance(source, T.StringType) else None
    wanted = [part.of(F.lit(v).cast(source), source) for v in values]
    if operator in ("=", "in"):
        return _compared(F.col(part.name), operator, wanted)
    if not part.rising(source):
        return None
    return _compared(F.col(part.name), "<=" if operator.startswith("<") else ">=", wanted)


def scan(spark: SparkSession, path: str, spec: Sequence[str], conditions: Sequence[Condition] = (),
         schema: T.StructType | None = None) -> DataFrame:
    """Rows for which all conditions hold, from the folders that can have any. ``schema``: of the rows as written."""
    schema = schema or _stored_schema(spark, path, spec)
    parts = parse_spec(spec, schema)
    # Partition columns of known types: text like 'v007' or whole numbers, never guessed from folder names.
    typed = [T.StructField(p.name, _part_type(p, schema[p.column].dataType)) for p in parts]
    rows = spark.read.schema(T.StructType([*schema.fields, *typed])).parquet(path)
    for condition in conditions:
        if condition[0] not in schema.names:
            raise ValueError(f"no column {condition[0]!r}")
        rows = rows.where(condition_column(condition, schema))
        for part in parts:
            pruning = partition_condition(condition, part, schema[part.column].dataType)
            if pruning is not None:
                rows = rows.where(pruning)
    return rows.select(*schema.names)


def _part_type(part: Part, source: T.DataType) -> T.DataType:
    text = part.kind in ("identity", "truncate") and not isinstance(source, _WHOLE)
    return T.StringType() if text else T.LongType()


# --- changed buckets only -------------------------------------------------------------------


KEY_BUCKET = "_key_bucket"


def key_bucket(id_columns: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*id_columns), F.lit(buckets)).cast("int")


def write_buckets(rows: DataFrame, path: str, id_columns: Sequence[str], buckets: int) -> None:
    """A table in hash buckets of its key, for ``apply_to_buckets``."""
    placed = rows.withColumn(KEY_BUCKET, key_bucket(id_columns, buckets))
    placed.hint("rebalance", KEY_BUCKET).write.partitionBy(KEY_BUCKET).parquet(path)


def apply_to_buckets(spark: SparkSession, path: str, changes: DataFrame, id_columns: Sequence[str], buckets: int,
                     insert_mode: str = apply.APPEND, schema: T.StructType | None = None) -> list[int]:
    """Copy-on-write of a batch: only the buckets its keys fall into are read and replaced. Returns their numbers.

    ``changes`` has the table's columns, ``_cdc_op``, partition and offset. The buckets are replaced by a dynamic
    partition overwrite: files move into place once all are written. A batch is to be applied once; batches that may be
    replayed go through the store's commits. A table that may lose all its rows needs its ``schema`` named.
    """
    schema = schema or T.StructType([f for f in spark.read.parquet(path).schema.fields if f.name != KEY_BUCKET])
    placed = changes.withColumn(KEY_BUCKET, key_bucket(id_columns, buckets))
    touched = sorted(r[0] for r in placed.select(KEY_BUCKET).distinct().collect())  # at most the number of buckets
    if not touched:
        return []
    stored = spark.read.schema(T.StructType([*schema.fields, T.StructField(KEY_BUCKET, T.IntegerType())])).parquet(path)
    before = stored.where(F.col(KEY_BUCKET).isin(touched))
    after = apply.copy_on_write(before, placed, [KEY_BUCKET, *id_columns], insert_mode)
    files = {bucket: _files(spark, f"{path}/{KEY_BUCKET}={bucket}") for bucket in touched}
    (after.hint("rebalance", KEY_BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(KEY_BUCKET).parquet(path))
    for bucket, names in files.items():
        if names and _files(spark, f"{path}/{KEY_BUCKET}={bucket}") == names:  # no row is left, so nothing was replaced
            place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{KEY_BUCKET}={bucket}")
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return touched


def _files(spark: SparkSession, folder: str) -> set[str]:
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return {e.getPath().getName() for e in files.listStatus(place)} if files.exists(place) else set()


# --- lookups by key -------------------------------------------------------------------------


def write_clustered(rows: DataFrame, path: str, key: Sequence[str], files: int | None = None,
                    row_group_bytes: int | None = None, partition_by: Sequence[str] = (), mode: str = "errorifexists") -> None:
    """Rows in order of the key, in files of neighbouring keys, with a bloom filter for the last key column.

    Range partitions split a frequent leading column (a large table) over many files. A lookup opens few files, by the
    ranges in their footers, and in them the row groups whose range and bloom filter admit the key.
    """
    dealt = rows.repartitionByRange(files, *key) if files else rows.repartitionByRange(*key)
    options = {f"parquet.bloom.filter.enabled#{key[-1]}": "true"}
    if row_group_bytes:
        options["parquet.block.size"] = str(row_group_bytes)
    dealt.sortWithinPartitions(*key).write.mode(mode).options(**options).partitionBy(*partition_by).parquet(path)


# --- publishing by options ------------------------------------------------------------------


def publish(rows: DataFrame, path: str, table: str, options: IngestOptions, record: str | None = None) -> T.StructType:
    """Writes a table's rows as its options say, and returns its schema.

    The first time needs auto-create; later the stored schema counts, widened by that of the rows if evolution is on.
    Without evolution columns that the table lacks are left out, and types that do not fit are refused.
    ``record`` names a column of JSON objects whose fields become columns, typed by what the objects hold. The
    partition spec, write properties, forced optional columns and matching of names by any case are honoured.
    """
    spark, spec = rows.sparkSession, options.for_table(table).partition_by
    if record is not None:
        own = rows.schema
        rows, found = evolution.read_items(rows, record, required=not options.force_optional)
        required = {f.name for f in found.fields if not f.nullable}
        kinds = [*own.fields, *rows.schema.fields[len(own):]]  # what is read back has lost what is never null in the rows
        shape = T.StructType([T.StructField(f.name, f.dataType, f.name not in required) for f in kinds])
    else:
        shape = rows.schema
    stored = _stored_schema(spark, path, spec)
    how = {"case_insensitive": options.case_insensitive, "force_optional": options.force_optional}
    if stored is None:
        if not options.auto_create:
            raise ValueError(f"{table} is not there, and auto-create is off")
        schema = evolution.optional_type(shape) if options.force_optional else shape
    elif options.evolve_schema:
        schema = evolution.merge_schemas(stored, shape, **how)
    else:
        schema = stored
        fold = str.lower if options.case_insensitive else str
        known = {fold(f.name): f for f in stored.fields}
        for f in shape.fields:
            if fold(f.name) in known:
                mine = known[fold(f.name)].dataType
                widened = evolution.wider(mine, f.dataType, options.case_insensitive, True, path=f.name)
                if widened != evolution.optional_type(mine):
                    raise evolution.SchemaConflict(f"{f.name}: {f.dataType.simpleString()} needs evolution of {mine.simpleString()}")
    write_by_spec(evolution.conform(rows, schema, options.case_insensitive), path, spec, options.write_properties, "overwrite")
    return schema


def _stored_schema(spark: SparkSession, path: str, spec: Sequence[str]) -> T.StructType | None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return None
    names = {Part(m.group(1) or m.group(3) or "identity", m.group(2) or m.group(4) or m.group(6)).name
             for m in (_SPEC.fullmatch(s.strip()) for s in spec) if m}
    return T.StructType([f for f in spark.read.parquet(path).schema.fields if f.name not in names])
