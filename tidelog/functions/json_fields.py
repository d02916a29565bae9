"""Typed reads from a decoded JSON document (a VARIANT column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_SEPARATOR = "||"
BLANKS = " \t\r\n"  # white space around JSON values


def _path(name: str) -> str:
    return f'$["{name}"]'


def decode(text: Column) -> Column:
    """Schemaless decode; text that is not JSON becomes null instead of an error."""
    return F.try_parse_json(text)


def is_object(doc: Column) -> Column:
    return doc.try_cast("struct<>").isNotNull()


def field_text(doc: Column, name: str) -> Column:
    """Field as text; absent fields and JSON nulls are null."""
    return F.try_variant_get(doc, _path(name), "string")


def strict_long(text: Column) -> Column:
    """Integer text to BIGINT; blanks, fractions and overflow give null."""
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("bigint"))


def field_long(doc: Column, name: str) -> Column:
    return variant_long(F.try_variant_get(doc, _path(name), "variant"))


def item_list(doc: Column, name: str = "data") -> Column:
    """Array field as ARRAY<VARIANT>; anything but a JSON array gives null."""
    return F.try_variant_get(doc, _path(name), "array<variant>")


def is_text_of_list(text: Column, data: Column, name: str = "data") -> Column:
    """Whether the field is a JSON text that looks like an array. ``data`` is what the field holds.

    The document is decoded once more only where the field's name is followed by a quotation mark somewhere.
    """
    kept_as_text = text.rlike(rf'"{name}"\s*:\s*"')
    kind_word = F.schema_of_variant(F.try_variant_get(decode(text), _path(name), "variant"))
    return F.ltrim(data, F.lit(BLANKS)).startswith("[") & kept_as_text & F.coalesce(kind_word == "STRING", F.lit(False))


def key_objects(data: Column) -> Column:
    """Objects of a JSON array text as maps; null where an item is no object or ``data`` no array."""
    return F.from_json(data, "array<map<string,string>>")


def key_values(objects: Column, data: Column, key_field: Column) -> Column:
    """Values found under ``key_field`` in each object of ``data``, sorted. ``objects`` is ``key_objects(data)``.

    Duplicates stay; items that are not objects and null values are skipped.
    """
    values = F.when(
        objects.isNull() | F.exists(objects, lambda item: item.isNull()),
        # Arrays with other items in them do not fit the map type; their objects are read one by one, as maps too, so
        # that a key value is written alike on both routes.
        F.zip_with(
            F.try_parse_json(data).try_cast("array<variant>"), F.from_json(data, "array<string>"),
            lambda doc, text: F.when(is_object(doc), F.try_element_at(F.from_json(text, "map<string,string>"), key_field)),
        ),
    ).otherwise(F.transform(objects, lambda item: F.try_element_at(item, key_field)))
    return F.array_sort(F.array_compact(values))


def composite_key(values: Column) -> Column:
    """Sorted key values as one text; null when there are none."""
    return F.when(F.size(values) > 0, F.array_join(values, KEY_SEPARATOR))


# Fields of a change envelope. ``data`` stays JSON text; ``version`` keeps its JSON type, because numbers
# and text follow different rules.
ENVELOPE = (
    "data string, key string, type string, version variant, ngay_cap_nhat string, length variant, "
    "_corrupt_record string"
)


def envelope(text: Column) -> Column:
    """All envelope fields in one pass over the text."""
    return F.from_json(text, ENVELOPE, {"columnNameOfCorruptRecord": "_corrupt_record"})


def kind(value: Column) -> Column:
    """Type word of a VARIANT (``BIGINT``, ``STRING``, ...); null when absent or JSON null."""
    word = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    return F.when(word != "VOID", word)


def variant_long(value: Column) -> Column:
    """Numbers are truncated towards zero, text must be a plain integer, the rest is null."""
    word = F.schema_of_variant(value)
    text = value.try_cast("string")
    return F.when(word == "STRING", strict_long(text)).when(
        word.isin("BIGINT", "DOUBLE", "FLOAT") | word.startswith("DECIMAL"), value.try_cast("bigint")
    )
