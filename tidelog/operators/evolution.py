"""Schemas of open records: read off samples, merged at every depth, and rows brought into their shape.

Types form a lattice: whole numbers widen to wider ones, then to decimals or floating point; a struct widens field by
field, an array by its items, a map by its values. Two types without a common wider one are a conflict, or text if asked.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions import json_fields as J
from tidelog.session import written_once

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = dict(zip(_WHOLE, (3, 5, 10, 19)))
_FLOATS = (T.FloatType, T.DoubleType)
_MOST_DIGITS = 38
# Words of a VARIANT's type text, outside quoted names.
_TYPE_WORD = re.compile(r"`(?:[^`]|``)*`|OBJECT<|\b(?:VOID|VARIANT)\b(?!:)|DECIMAL\(\d+,\s*\d+\)")


class SchemaConflict(ValueError):
    """Two types have no common wider type."""


# --- merging --------------------------------------------------------------------------------


def wider(left: T.DataType, right: T.DataType, case_insensitive: bool = False, force_optional: bool = False,
          conflicts_to_text: bool = False, path: str = "") -> T.DataType:
    """The narrowest type that holds the values of both."""
    how = (case_insensitive, force_optional, conflicts_to_text)
    if left == right and not force_optional:
        return left
    if isinstance(left, T.NullType) or isinstance(right, T.NullType):
        known = right if isinstance(left, T.NullType) else left
        return optional_type(known) if force_optional else known
    if isinstance(left, T.StructType) and isinstance(right, T.StructType):
        return merge_schemas(left, right, *how, path=path)
    if isinstance(left, T.ArrayType) and isinstance(right, T.ArrayType):
        nulls = left.containsNull or right.containsNull or force_optional
        return T.ArrayType(wider(left.elementType, right.elementType, *how, f"{path}[]"), nulls)
    if isinstance(left, T.MapType) and isinstance(right, T.MapType) and left.keyType == right.keyType:
        nulls = left.valueContainsNull or right.valueContainsNull or force_optional
        return T.MapType(left.keyType, wider(left.valueType, right.valueType, *how, f"{path}{{}}"), nulls)
    found = left if left == right else _wider_number(left, right) or _wider_moment(left, right)
    if found is not None:
        return found
    if conflicts_to_text:
        return T.StringType()
    raise SchemaConflict(f"{path or 'value'}: {left.simpleString()} and {right.simpleString()} have no common type")


def _wider_number(left: T.DataType, right: T.DataType) -> T.DataType | None:
    if isinstance(left, _WHOLE) and isinstance(right, _WHOLE):
        return max(left, right, key=lambda t: _DIGITS[type(t)])
    numbers = (*_WHOLE, *_FLOATS, T.DecimalType)
    if not (isinstance(left, numbers) and isinstance(right, numbers)):
        return None
    if isinstance(left, _FLOATS) or isinstance(right, _FLOATS):
        both = isinstance(left, T.FloatType) and isinstance(right, T.FloatType)
        return T.FloatType() if both else T.DoubleType()
    whole, scale = zip(*((t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (_DIGITS[type(t)], 0)
                         for t in (left, right)))
    digits = max(whole) + max(scale)
    return T.DecimalType(digits, max(scale)) if digits <= _MOST_DIGITS else T.DoubleType()


def _wider_moment(left: T.DataType, right: T.DataType) -> T.DataType | None:
    kinds = {type(left), type(right)}
    for moment in (T.TimestampType, T.TimestampNTZType):
        if kinds == {T.DateType, moment}:
            return moment()
    return None


def merge_schemas(table: T.StructType, record: T.StructType, case_insensitive: bool = False, force_optional: bool = False,
                  conflicts_to_text: bool = False, path: str = "") -> T.StructType:
    """The table's schema widened by that of records: its fields first, in its spelling, then those it lacks.

    A field that one side lacks may be missing in rows, so it is nullable; with ``force_optional`` all are. With
    ``case_insensitive`` names that differ in case alone are one field, at every depth.
    """
    fold = str.lower if case_insensitive else str
    given = _by_name(record, fold, path)
    fields = []
    for name, field in _by_name(table, fold, path).items():
        at = f"{path}.{field.name}" if path else field.name
        other = given.pop(name, None)
        if other is None:
            merged, nulls = field.dataType, True
        else:
            merged = wider(field.dataType, other.dataType, case_insensitive, force_optional, conflicts_to_text, at)
            nulls = field.nullable or other.nullable or force_optional
        fields.append(T.StructField(field.name, optional_type(merged) if force_optional else merged, nulls, field.metadata))
    added = [T.StructField(f.name, optional_type(f.dataType) if force_optional else f.dataType, True, f.metadata)
             for f in given.values()]
    return T.StructType(fields + added)


def _by_name(schema: T.StructType, fold, path: str) -> dict[str, T.StructField]:
    named: dict[str, T.StructField] = {}
    for field in schema.fields:
        if fold(field.name) in named:
            raise SchemaConflict(f"{path or 'schema'}: {field.name!r} and {named[fold(field.name)].name!r} are one name")
        named[fold(field.name)] = field
    return named


def optional_type(kind: T.DataType) -> T.DataType:
    """The type with every field, item and value nullable."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, optional_type(f.dataType), True, f.metadata) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(optional_type(kind.elementType), True)
    if isinstance(kind, T.MapType):
        return T.MapType(kind.keyType, optional_type(kind.valueType), True)
    return kind


# --- rows in the shape of a schema ------------------------------------------------------------


def conform(rows: DataFrame, schema: T.StructType, case_insensitive: bool = False) -> DataFrame:
    """Rows with the columns of ``schema``: renamed, reordered and widened at every depth; missing fields are null.

    Columns that the schema lacks are left out; merge first to keep them.
    """
    fold = str.lower if case_insensitive else str
    own = _by_name(rows.schema, fold, "")
    return rows.select(*[
        (_shaped(F.col(_quoted(own[fold(f.name)].name)), own[fold(f.name)].dataType, f.dataType, fold) if fold(f.name) in own
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _shaped(value: Column, have: T.DataType, want: T.DataType, fold) -> Column:
    if have == want:
        return value
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        own = _by_name(have, fold, "")
        parts = [
            (_shaped(value.getField(own[fold(f.name)].name), own[fold(f.name)].dataType, f.dataType, fold)
             if fold(f.name) in own else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want.fields]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(value, lambda item: _shaped(item, have.elementType, want.elementType, fold))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        return F.transform_values(value, lambda _, item: _shaped(item, have.valueType, want.valueType, fold))
    if isinstance(want, T.StringType) and isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(value)
    return value.cast(want)


def evolve_union(table: DataFrame, records: DataFrame, case_insensitive: bool = False, force_optional: bool = False,
                 conflicts_to_text: bool = False) -> DataFrame:
    """Table rows and new records under the merged schema, whatever the depth at which they differ."""
    merged = merge_schemas(table.schema, records.schema, case_insensitive, force_optional, conflicts_to_text)
    return conform(table, merged, case_insensitive).unionByName(conform(records, merged, case_insensitive))


# --- schemas of JSON text ---------------------------------------------------------------------


def _as_spark_type(words: str) -> str:
    """Type text of a VARIANT as a column type: decimals are floating point, mixed or unknown types are text."""
    def word(found: re.Match) -> str:
        text = found.group()
        if text.startswith("`"):
            return text
        if text == "OBJECT<":
            return "STRUCT<"
        return "DOUBLE" if text.startswith("DECIMAL") else "STRING"

    return _TYPE_WORD.sub(word, words)


def _storable(kind: T.DataType) -> T.DataType:
    """Objects without any field become text."""
    if isinstance(kind, T.StructType):
        fields = [T.StructField(f.name, _storable(f.dataType), True) for f in kind.fields]
        return T.StructType(fields) if fields else T.StringType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_storable(kind.elementType), True)
    return kind


def schema_of_json(texts: DataFrame, column: str, required: bool = True) -> T.StructType:
    """The schema that holds all JSON objects of a text column, and of arrays of objects.

    Two aggregations over the rows given, however many: one merges the types, the other (with ``required``) finds the
    fields that are never missing and never null, at every depth outside arrays. Text that is no JSON, or holds no
    object, counts for nothing; without any object the schema has no fields.
    """
    return _schema_of(_objects(texts.select(F.col(column).alias("doc")), "doc", "doc"), required)[0]


def _objects(rows: DataFrame, column: str, place: str) -> DataFrame:
    """One row per object of the JSON array (or object) in ``column``, with the object in ``place``."""
    doc = J.decode(F.col(column))
    items = F.explode(F.coalesce(doc.try_cast("array<variant>"), F.array(doc)))
    return rows.withColumn(place, items).where(J.is_object(F.col(_quoted(place))))


def _schema_of(objects: DataFrame, required: bool) -> tuple[T.StructType, bool]:
    """The schema of the objects in the column ``doc``, and whether any of its text holds values of several types."""
    words = objects.agg(F.schema_of_variant_agg("doc").alias("words")).first()["words"]
    if words is None or not words.startswith("OBJECT<"):
        return T.StructType([]), False
    schema = _storable(T.StructType.fromDDL(f"doc {_as_spark_type(words)}")["doc"].dataType)
    if not isinstance(schema, T.StructType):
        return T.StructType([]), False
    mixed = any(found.group() == "VARIANT" for found in _TYPE_WORD.finditer(words))
    return _with_required(objects, schema) if required else schema, mixed


def typed(doc: Column, kind: T.DataType) -> Column:
    """A VARIANT as a value of the type; what does not fit is null."""
    return F.from_json(F.to_json(doc), kind)


def _with_required(objects: DataFrame, schema: T.StructType) -> T.StructType:
    # Null in the same places as ``typed``, which writes numbers among text differently.
    read = objects.select(F.col("doc").try_cast(schema).alias("r"))
    counts: list[Column] = []

    def gather(value: Column, kind: T.StructType) -> None:
        for f in kind.fields:
            inner = value.getField(f.name)
            counts.append(F.count(inner))
            if isinstance(f.dataType, T.StructType):
                gather(inner, f.dataType)

    gather(F.col("r"), schema)
    found = iter(read.agg(F.count("r"), *counts).first())
    total = next(found)

    def marked(kind: T.StructType, present: int) -> T.StructType:
        fields = []
        for f in kind.fields:
            n = next(found)
            inner = marked(f.dataType, n) if isinstance(f.dataType, T.StructType) else f.dataType
            fields.append(T.StructField(f.name, inner, n < present))
        return T.StructType(fields)

    return marked(schema, total)


def schema_rows(schema: T.StructType) -> list[tuple[str, str, bool]]:
    """(path, type, nullable) of every field at every depth; items of an array are ``path[]``."""
    rows = []

    def visit(kind: T.DataType, path: str) -> None:
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                at = f"{path}.{f.name}" if path else f.name
                rows.append((at, f.dataType.typeName() if isinstance(f.dataType, (T.StructType, T.ArrayType)) else f.dataType.simpleString(),
                             f.nullable))
                visit(f.dataType, at)
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StructType, T.ArrayType)):
            visit(kind.elementType, f"{path}[]")

    visit(schema, "")
    return rows


def typed_items(rows: DataFrame, schema: T.StructType, column: str = "record") -> DataFrame:
    """One row per object of the JSON array (or object) in ``column``; its fields are columns behind those of the row.

    Fields named like a column of the row, in any case, get the prefix ``item_`` until the name is free.
    """
    place = _free_name(rows)
    return _with_fields(_objects(rows, column, place), schema, place, typed)


def read_items(rows: DataFrame, column: str = "record", required: bool = True) -> tuple[DataFrame, T.StructType]:
    """:func:`typed_items` under the schema that :func:`schema_of_json` finds, and this schema.

    The text is decoded once: its objects are written, and the types, the required fields and the columns read there.
    """
    place = _free_name(rows)
    objects = written_once(_objects(rows, column, place))
    schema, mixed = _schema_of(objects.select(F.col(_quoted(place)).alias("doc")), required)
    # A cast does for values of the field's own type; what becomes text is written by ``typed`` in a way of its own.
    return _with_fields(objects, schema, place, typed if mixed else Column.try_cast), schema


def _free_name(rows: DataFrame) -> str:
    return "_" + max([*rows.columns, ""], key=len)  # longer than any name in use


def _with_fields(objects: DataFrame, schema: T.StructType, place: str, read_as: Callable[[Column, T.DataType], Column]) -> DataFrame:
    """The columns but ``place``, then the fields of the objects there."""
    columns = [c for c in objects.columns if c != place]
    taken = {name.lower() for name in columns}
    names = []
    for name in schema.names:
        while name.lower() in taken:
            name = f"item_{name}"
        taken.add(name.lower())
        names.append(name)
    read = objects.withColumn(place, read_as(F.col(_quoted(place)), optional_type(schema)))
    fields = [F.col(_quoted(place)).getField(f.name).alias(name) for f, name in zip(schema.fields, names)]
    return read.select(*[F.col(_quoted(c)) for c in columns], *fields)
