"""Benchmark decontamination over a positional inverted index.

``index_tokens`` stores the postings of all words of all texts: every row of the index holds those of some neighbouring
documents (a segment), as one rising list of places per word. Documents follow each other with a free place between, so
no run of places reaches from one into the next. The index is written once and serves any number of test sets.

A phrase is looked up in a segment from its rarest words: the places of the word with the shortest list, less its
offset in the phrase, are the possible starts; they are intersected with the list of the second rarest word, less that
word's offset, and so on. All phrases of a lot go through this at once, one vector operation per step. What is left
after the last word is an exact match. ``near_matches`` goes from the rarest word outwards instead, to the next place of
each neighbouring word of the phrase, and so finds its words in order within a stretch of any given length.

Words are told apart by 64-bit keys. A wrong match needs a word of a text to have the key of another word at the very
place where that other word would complete the phrase.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import word_list, written
from tidelog.llm.licenses import lowered
from tidelog.llm.tokens import ALPHANUMERIC, bounded_batches, list_array, slices, text_array, word_keys, words_of

WIDTH = 10  # words of a window
SEGMENT_BYTES = 4 << 20  # of text whose postings make a row of the index
LOT_WORDS = 1 << 19  # of phrases that are looked up, and sent to the tasks, at a time
STARTS = 1 << 21  # possible starts that are checked at a time

INDEX = "segment string, first array<int>, n_words array<int>, term array<bigint>, end array<int>, place array<int>"
SPAN = "array<struct<start:int,stop:int>>"
# A row of the index takes megabytes, and a row group is in memory as a whole where it is written and where it is read. Its
# size, and that of a page, would be looked at first after 100 rows.
FEW_ROWS = {"parquet.block.size": str(16 << 20), "parquet.page.size.row.check.min": "1"}


class Segment(NamedTuple):
    first: np.ndarray  # place of the first word of each document
    n_words: np.ndarray
    term: np.ndarray  # rising
    end: np.ndarray  # of each term's list
    posting: np.ndarray  # number of the term * 2^32 + place, rising


class Phrases(NamedTuple):
    owner: np.ndarray  # which item a phrase belongs to
    words: np.ndarray  # keys, a row per phrase, filled up with 0
    length: np.ndarray


def index_tokens(docs: DataFrame, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """The written index of ``docs`` (doc_id, text); each document is an entry of exactly one row of it.

    A null text has no words. Rows alike in id or text are entries of their own. Other columns are not looked at.
    """
    bounded_batches(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", T.ArrayType(id_type)), *T._parse_datatype_string(INDEX).fields])

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_array(batch.column("text"))
            for low, high in slices(texts, segment_bytes):
                yield _segment_row(batch.column("doc_id")[low:high], texts[low:high])

    return written(docs.select("doc_id", "text").mapInArrow(segments, schema), "token-index", FEW_ROWS)


def _segment_row(ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    words = words_of(texts, ALPHANUMERIC)
    n_words = np.bincount(words.text, minlength=len(texts))
    first = np.cumsum(n_words) - n_words + np.arange(len(texts))  # a free place between documents
    place = (np.arange(len(words.text)) + words.text).astype(np.int32)
    keys = word_keys(words)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    last = np.flatnonzero(np.append(keys[1:] != keys[:-1], True)) if len(keys) else np.zeros(0, dtype=np.int64)

    def one(values: np.ndarray, kind: pa.DataType) -> pa.Array:
        return list_array(values, np.array([len(values)]), kind)

    return pa.RecordBatch.from_arrays(
        [pa.ListArray.from_arrays(pa.array([0, len(ids)], type=pa.int32()), ids), pa.array([uuid.uuid4().hex]),
         one(first, pa.int32()), one(n_words, pa.int32()), one(keys[last], pa.int64()), one(last + 1, pa.int32()),
         one(place[order], pa.int32())],
        names=["doc_id", "segment", "first", "n_words", "term", "end", "place"])


def windows(words: Sequence[str], width: int = WIDTH) -> list[list[str]]:
    """All runs of ``width`` words; the whole, if it has fewer but not none."""
    if len(words) <= width:
        return [list(words)] if words else []
    return [list(words[i:i + width]) for i in range(len(words) - width + 1)]


def phrases_of(items: Sequence[Sequence[str]], width: int | None = WIDTH) -> Phrases:
    """The windows of each item's words (``width=None``: its words as one phrase); equal windows of an item count once."""
    made = [(i, w) for i, words in enumerate(items)
            for w in dict.fromkeys(map(tuple, windows(words, width) if width else [words] if words else []))]
    longest = max((len(w) for _, w in made), default=0)
    vocabulary = {w: None for _, run in made for w in run}
    text = text_array(pa.array(list(vocabulary), type=pa.string()))
    key = dict(zip(vocabulary, word_keys(words_of(text, ALPHANUMERIC)).tolist()))
    keys = np.zeros((len(made), longest), dtype=np.int64)
    for row, (_, run) in enumerate(made):
        keys[row, :len(run)] = [key[w] for w in run]
    return Phrases(np.array([i for i, _ in made], dtype=np.int64), keys, np.array([len(w) for _, w in made], dtype=np.int64))


def read_segment(batch: pa.RecordBatch, row: int) -> Segment:
    def values(name: str) -> np.ndarray:
        return batch.column(name)[row].values.to_numpy(zero_copy_only=False)

    end, place = values("end").astype(np.int64), values("place").astype(np.int64)
    number = np.repeat(np.arange(len(end)), np.diff(end, prepend=0))
    return Segment(values("first").astype(np.int64), values("n_words").astype(np.int64), values("term"), end,
                   (number << 32) | place)


def _lists(segment: Segment, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the phrases all of whose words the segment has: their rows, the words' numbers, and lengths of the words' lists."""
    columns = np.arange(phrases.words.shape[1])
    vocabulary, inverse = np.unique(phrases.words, return_inverse=True)
    if not len(segment.term) or not len(vocabulary):
        return np.zeros(0, dtype=np.int64), np.zeros((0, len(columns)), dtype=np.int64), np.zeros((0, len(columns)), dtype=np.int64)
    number = np.minimum(np.searchsorted(segment.term, vocabulary), len(segment.term) - 1)
    n = np.where(segment.term[number] == vocabulary, np.diff(segment.end, prepend=0)[number], 0)
    number, n = (x[inverse.reshape(phrases.words.shape)] for x in (number, n))
    used = columns < phrases.length[:, None]
    kept = np.flatnonzero(((n > 0) | ~used).all(axis=1) & (phrases.length > 0))
    return kept, number[kept], np.where(used, n, np.iinfo(np.int64).max)[kept]


def _lots(n: np.ndarray) -> Iterator[slice]:
    """Ranges of phrases with a bounded number of starts, or of one phrase."""
    total, at = np.cumsum(n), 0
    while at < len(n):
        stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + STARTS, side="right")))
        yield slice(at, stop)
        at = stop


def _places(segment: Segment, number: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists of the numbered words behind each other, as postings, and which list each is from."""
    which = np.repeat(np.arange(len(n)), n)
    begin = segment.end[number] - n
    return segment.posting[np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + begin[which]], which


def _held(segment: Segment, number: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Whether the word of that number stands at that place."""
    wanted = (number << 32) | place
    at = np.minimum(np.searchsorted(segment.posting, wanted), len(segment.posting) - 1)
    return (segment.posting[at] == wanted) & (place >= 0)


def exact_places(segment: Segment, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(row of the phrase, place of its first word) of every occurrence."""
    kept, number, n = _lists(segment, phrases)
    rarest = np.argsort(n, axis=1, kind="stable")
    found = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))]
    rows = np.arange(len(kept))
    for lot in _lots(n[rows, rarest[:, 0]] if len(kept) else np.zeros(0, dtype=np.int64)):
        mine = rows[lot]
        lead = rarest[mine, 0]
        postings, which = _places(segment, number[mine, lead], n[mine, lead])
        start = (postings & 0xFFFFFFFF) - lead[which]
        row = mine[which]
        for step in range(1, rarest.shape[1]):
            offset = rarest[row, step]
            ended = step >= phrases.length[kept[row]]
            held = ended | _held(segment, number[row, offset], start + offset)
            row, start = row[held & (start >= 0)], start[held & (start >= 0)]
        found.append((kept[row], start))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def near_places(segment: Segment, phrases: Phrases, slop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first place, last place): a phrase's words in order, with at most ``slop`` other words between them.

    One match for each place of the rarest word around which there is one: the shortest.
    """
    kept, number, n = _lists(segment, phrases)
    found = [(np.zeros(0, dtype=np.int64),) * 3]
    lead = np.argmin(n, axis=1) if len(kept) else np.zeros(0, dtype=np.int64)
    rows = np.arange(len(kept))
    for lot in _lots(n[rows, lead]):
        mine = rows[lot]
        postings, which = _places(segment, number[mine, lead[mine]], n[mine, lead[mine]])
        row = mine[which]
        ends = [postings & 0xFFFFFFFF, postings & 0xFFFFFFFF]
        length = phrases.length[kept]
        for side, step in ((0, -1), (1, 1)):
            for far in range(1, number.shape[1]):
                column = lead[row] + step * far
                more = (column >= 0) & (column < length[row])
                wanted = number[row, np.clip(column, 0, number.shape[1] - 1)]
                at = np.searchsorted(segment.posting, (wanted << 32) | (ends[side] + (step > 0))) - (step < 0)
                there = segment.posting[np.clip(at, 0, len(segment.posting) - 1)]
                good = ~more | ((at >= 0) & (at < len(segment.posting)) & (there >> 32 == wanted))
                ends[side] = np.where(more, there & 0xFFFFFFFF, ends[side])
                row, ends = row[good], [e[good] for e in ends]
        document = [np.searchsorted(segment.first, e, side="right") for e in ends]
        good = (ends[1] - ends[0] < length[row] + slop) & (document[0] == document[1])
        found.append((kept[row[good]], ends[0][good], ends[1][good]))
    return tuple(np.concatenate([f[i] for f in found]) for i in range(3))


def _matches(index: DataFrame, lots: list[tuple[Phrases, list]], find) -> DataFrame:
    """Rows of every lot's matches: segment, nth (document of the segment), doc_id, n_words, spans, items.

    The first lot has a row for every document, the others for documents with matches.
    """
    bounded_batches(index.sparkSession)
    fields = [T.StructField("segment", T.StringType()), T.StructField("nth", T.IntegerType()),
              T.StructField("doc_id", index.schema["doc_id"].dataType.elementType), T.StructField("n_words", T.LongType()),
              T.StructField("spans", T._parse_datatype_string(SPAN)), T.StructField("items", T.ArrayType(T.StringType()))]

    def looked_up(phrases: Phrases, names: list, every: bool):
        known = pa.array(names, type=pa.string())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(batch.num_rows):
                    segment = read_segment(batch, row)
                    which, start, stop = find(segment, phrases)
                    document = np.searchsorted(segment.first, start, side="right") - 1
                    spans = np.unique(np.stack([document, start, stop], axis=1), axis=0)
                    item = np.unique(np.stack([document, phrases.owner[which]], axis=1), axis=0)
                    shown = np.arange(len(segment.first)) if every else np.unique(document)
                    own = [np.searchsorted(x[:, 0], shown, side="right") - np.searchsorted(x[:, 0], shown) for x in (spans, item)]
                    ends = [np.concatenate([[0], np.cumsum(n)]).astype(np.int32) for n in own]
                    pairs = pa.StructArray.from_arrays(
                        [pa.array((spans[:, i] - segment.first[spans[:, 0]]).astype(np.int32)) for i in (1, 2)], ["start", "stop"])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([batch.column("segment")[row].as_py()] * len(shown), type=pa.string()),
                         pa.array(shown.astype(np.int32)), batch.column("doc_id")[row].values.take(pa.array(shown)),
                         pa.array(segment.n_words[shown]), pa.ListArray.from_arrays(pa.array(ends[0]), pairs),
                         pa.ListArray.from_arrays(pa.array(ends[1]), known.take(pa.array(item[:, 1])))],
                        names=[f.name for f in fields])

        return run

    parts = [index.mapInArrow(looked_up(phrases, names, i == 0), T.StructType(fields)) for i, (phrases, names) in enumerate(lots)]
    if len(parts) == 1:
        return parts[0]
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    return together.groupBy("segment", "nth").agg(
        F.any_value("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))


def item_lots(items: DataFrame, width: int | None, lot_words: int = LOT_WORDS) -> list[tuple[Phrases, list]]:
    """Phrases of the items (item_id, text) in lots of at most ``lot_words`` words, or of one item.

    Items reach the driver a lot after the other, by hash; a null id has no name.
    """
    named = items.select(F.col("item_id").cast("string").alias("item"), word_list(lowered(F.col("text"))).alias("words"))
    n = named.agg(F.sum(F.size("words"))).first()[0] or 0
    count = -(-2 * n // lot_words) or 1
    lot = F.pmod(F.xxhash64("item", "words"), F.lit(count))
    lots = []
    for i in range(count):
        rows = named.filter(lot == i).distinct().collect()
        lots.append((phrases_of([r["words"] for r in rows], width), [r["item"] for r in rows]))
    return lots


def phrase_matches(index: DataFrame, items: DataFrame, width: int | None = WIDTH, lot_words: int = LOT_WORDS) -> DataFrame:
    """segment, nth, doc_id, n_words, spans (first and last word of every occurrence), items: a row for each document.

    ``items`` has item_id and text; with ``width=None`` an item is one phrase. Items of equal id are one item; those
    without words match nothing, those with a null id match but are not listed among the items.
    """
    def find(segment: Segment, phrases: Phrases):
        which, start = exact_places(segment, phrases)
        return which, start, start + phrases.length[which] - 1

    return _matches(index, item_lots(items, width, lot_words), find)


def near_matches(index: DataFrame, items: DataFrame, slop: int, width: int | None = WIDTH, lot_words: int = LOT_WORDS) -> DataFrame:
    """As ``phrase_matches``, for words in order with at most ``slop`` other words between them."""
    def find(segment: Segment, phrases: Phrases):
        return near_places(segment, phrases, slop)

    return _matches(index, item_lots(items, width, lot_words), find)


def covered_words(spans: Column) -> Column:
    """How many words lie in at least one span."""
    start = F.struct(F.lit(-1).alias("reach"), F.lit(0).cast("bigint").alias("n"))
    return F.aggregate(F.array_sort(spans), start, lambda done, s: F.struct(
        F.greatest(done["reach"], s["stop"]).alias("reach"),
        (done["n"] + F.greatest(s["stop"] - F.greatest(done["reach"], s["start"] - 1), F.lit(0))).alias("n")), lambda done: done["n"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, lot_words: int = LOT_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated: a row for each row of ``docs``.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text. A null or empty text has no words, none of them hit.
    Repeated documents have a row each, repeated items count once; without items nothing is hit. Texts of any length
    are looked up as a whole. Other columns are not looked at.
    """
    found = phrase_matches(index_tokens(docs), benchmark, width, lot_words)
    listed = F.array_sort(F.array_distinct(F.filter("items", lambda i: i.isNotNull())))
    return found.select(
        "doc_id", "n_words", covered_words(F.col("spans")).alias("n_hit"), F.size(listed).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(listed, ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))
