"""Text functions used by routing and by list-valued options."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EDGE_BLANKS = r"^[\x00-\x20]+|[\x00-\x20]+$"


def _depth(text: Column) -> Column:
    """How many parentheses are open behind the text."""
    opened, closed = (F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit(""))) for mark in "()")
    return opened - closed


def split_trimmed(text: Column, nested: bool = False) -> Column:
    """Split at commas and trim each part. Null and empty text give an empty list, trailing empty parts are dropped.

    With ``nested`` a comma inside parentheses, as in "bucket(id, 4), type", separates nothing.
    """
    body = F.regexp_replace(text, r",+$", "")
    pieces = F.split(body, ",")
    if nested:
        pieces = F.aggregate(
            pieces, F.array().cast("array<string>"),
            lambda done, piece: F.when(
                (F.size(done) > 0) & (_depth(F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(""))) > 0),
                F.concat(F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))),
                         F.array(F.concat(F.try_element_at(done, F.lit(-1)), F.lit(","), piece)))
            ).otherwise(F.concat(done, F.array(piece))))
    parts = F.transform(pieces, lambda part: F.regexp_replace(part, EDGE_BLANKS, ""))
    return F.when(body.isNull() | (body == ""), F.array().cast("array<string>")).otherwise(parts)


def matches_fully(text: Column, pattern: str) -> Column:
    return text.rlike(rf"\A(?:{pattern})\z")


def table_from_topic(topic: Column, namespace: str) -> Column:
    name = F.coalesce(F.replace(topic, F.lit("-"), F.lit("_")), F.lit("unknown"))
    return F.concat(F.lit(f"{namespace}."), name)


def operation_code(change_type: Column) -> Column:
    """INSERT, UPDATE and DELETE in any case to I, U and D; every other word counts as I."""
    word = F.upper(change_type)
    return F.when(word == "UPDATE", "U").when(word == "DELETE", "D").otherwise("I")


def is_delete(change_type: Column) -> Column:
    return F.coalesce(F.upper(change_type) == "DELETE", F.lit(False))
