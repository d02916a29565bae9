"""Words of Arrow text columns: where they stand, and 64-bit keys of them, found by numpy over the UTF-8 bytes.

A text column is one run of bytes with offsets, so a few vector operations over it find all words of thousands of texts.
Separators are ASCII, so no character of more than one byte is ever cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

from tidelog.llm.common import small_batches

BLANK, WORD, BREAK = 0, 1, 2
CHUNK = 1 << 21  # bytes whose keys are found at a time
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Words(NamedTuple):
    """Lower-cased bytes, first and end byte of each word, the text it stands in, and a number that changes at breaks."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    piece: np.ndarray


def byte_kinds(blanks: bytes, breaks: bytes = b"") -> np.ndarray:
    """The kind of every byte; what is neither blank nor break belongs to words."""
    kinds = np.full(256, WORD, dtype=np.uint8)
    kinds[list(blanks)] = BLANK
    kinds[list(breaks)] = BREAK
    return kinds


# Words of digits, letters and non-ASCII characters of lower-cased texts.
ALPHANUMERIC = byte_kinds(bytes([*range(48), *range(58, 97), *range(123, 128)]))


def bounded_batches(spark: SparkSession, size: int = 32 << 20) -> None:
    """Arrow batches of at most about so many bytes, and of few rows, unless the session has settings of its own."""
    small_batches(spark)
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(name, None) or 2**31) > 1 << 28:
        spark.conf.set(name, str(size))


def text_array(column: pa.Array) -> pa.Array:
    """Strings with 64-bit offsets; nulls are empty texts."""
    return column.cast(pa.large_string()).fill_null("")


def slices(column: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``size`` bytes of text each, or of one row."""
    offsets = _offsets(column)
    at = 0
    while at < len(column):
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1)
        yield at, stop
        at = stop


def _offsets(column: pa.Array) -> np.ndarray:
    return np.frombuffer(column.buffers()[1], dtype=np.int64, count=column.offset + len(column) + 1)[column.offset:]


def words_of(column: pa.Array, kinds: np.ndarray) -> Words:
    """All words of a ``text_array`` (or a slice of one), in order."""
    offsets = _offsets(column)
    first, last = int(offsets[0]), int(offsets[-1])
    if first == last:
        none = np.zeros(0, dtype=np.int64)
        return Words(np.zeros(0, dtype=np.uint8), none, none, none, none)
    data = _LOWER[np.frombuffer(column.buffers()[2], dtype=np.uint8, count=last)[first:]]
    begins = offsets[:-1] - first
    kind = kinds[data]
    inside = kind == WORD
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    edges = np.unique(begins[(begins > 0) & (begins < len(data))])  # a text begins: words never reach across
    opens[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    text = np.searchsorted(begins, starts, side="right") - 1
    parts = np.union1d(np.flatnonzero(kind == BREAK), edges - 1)  # what lies behind the end of a text is another piece
    return Words(data, starts, ends, text, np.searchsorted(parts, starts, side="left"))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _weights(first: int, n: int, seed: int) -> np.ndarray:
    at = np.arange(first + 1, first + n + 1, dtype=np.uint64) + np.uint64(seed << 40)
    return _mixed(at * np.uint64(0x9E3779B97F4A7C15))


def word_keys(words: Words, salt: np.ndarray | None = None, seed: int = 0) -> np.ndarray:
    """A signed 64-bit key per word: a weighted sum of its bytes' random values, mixed with ``salt`` (one per word)."""
    starts, ends, total = words.starts, words.ends, len(words.starts)
    sums, values = np.zeros(total, dtype=np.uint64), _weights(1 << 39, 256, seed)
    lengths = ends - starts
    weights = _weights(0, min(int(lengths.max(initial=0)), CHUNK), seed)
    at = 0
    while at < total:
        stop = max(at + 1, int(np.searchsorted(ends, starts[at] + CHUNK, side="right")))
        if stop == at + 1 and lengths[at] > CHUNK:  # a single very long word, part by part
            for low in range(0, int(lengths[at]), CHUNK):
                part = words.data[starts[at] + low:min(int(ends[at]), int(starts[at]) + low + CHUNK)]
                sums[at:stop] += (values[part] * _weights(low, len(part), seed)).sum(keepdims=True)
        else:
            n = lengths[at:stop]
            packed = np.cumsum(n) - n
            within = np.arange(int(n.sum())) - np.repeat(packed, n)
            places = within + np.repeat(starts[at:stop], n)
            sums[at:stop] = np.add.reduceat(values[words.data[places]] * weights[within], packed)
        at = stop
    sums += lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    if salt is not None:
        sums = _mixed(sums) + salt.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return _mixed(sums).view(np.int64)


def list_array(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A column of lists, laid out one after another."""
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))
