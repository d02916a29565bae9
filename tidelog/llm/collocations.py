"""Phrase collocations, counted in HAT-tries.

Each task counts phrases in a trie: a shallow level of word ids over hash containers that hold the rest of the phrase
and its count. A container that grows too large bursts into a node with a container for each next word. When a trie is
full, its largest subtrees leave as a whole, as runs sorted by prefix; Spark deals the runs out by prefix (the first
two words, so that a frequent first word is spread) and merges them there.

Phrases are counted by length. A phrase is frequent only if its parts are, so a pass passes over what a bit map of the
frequent shorter phrases rules out. The map has a fixed size whatever the corpus: where it fills up it rules out less,
and nothing frequent is ever ruled out. Words travel as 64-bit keys; the table of words has each key's word, and shows
whether two words share a key, in which case the count is done again with other keys.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import written
from tidelog.llm.tokens import bounded_batches, byte_kinds, slices, text_array, word_keys, words_of

KINDS = byte_kinds(b" \t", b".,;:!?\n\x0b\x0c\r")
UNKNOWN = "und"  # language of texts without one
LEAST = 10  # occurrences of a candidate
INSIDE = (100, 50)  # a candidate goes if 100 * f(longer) >= 50 * f(candidate)
TOP = 2000
BURST = 4096  # phrases of a container before it bursts
FULL = 600_000  # phrases of a trie before subtrees are spilled
SLICE_BYTES = 2 << 20  # of text whose phrases enter the trie at a time
MAP_BITS = 1 << 26  # of the map of frequent phrases: 8 MB
_BUCKET = 32768  # bits in a row of Spark's bit maps


class HatTrie:
    """Counts of phrases of two or three word ids below 2**31."""

    def __init__(self, burst: int = BURST, full: int = FULL) -> None:
        self.root: dict[int, Counter | dict[int, Counter]] = {}
        self.sizes: dict[int, int] = {}
        self.total, self.burst, self.full = 0, burst, full

    def add(self, ids: np.ndarray) -> None:
        """Counts one phrase per row; two columns or three."""
        order = np.argsort(ids[:, 0], kind="stable")
        first = ids[order, 0]
        rest = ids[order, 1].astype(np.int64) << 32
        if ids.shape[1] > 2:
            rest |= ids[order, 2].astype(np.int64) + 1
        ends = np.flatnonzero(np.append(first[1:] != first[:-1], True)) + 1 if len(first) else []
        at, keys = 0, rest.tolist()
        for word, end in zip(first[np.asarray(ends, dtype=np.int64) - 1].tolist(), np.asarray(ends).tolist()):
            self._count(word, keys[at:end], ids.shape[1] > 2)
            at = end

    def _count(self, word: int, keys: list[int], deeper: bool) -> None:
        below = self.root.get(word)
        if below is None:
            below = self.root[word] = Counter()
        before = self.sizes.get(word, 0)
        if isinstance(below, Counter):
            below.update(keys)
            size = len(below)
            if deeper and size > self.burst:
                self.root[word] = self._burst(below)
        else:
            size = before
            for key in keys:
                container = below.get(key >> 32)
                if container is None:
                    container = below[key >> 32] = Counter()
                had = len(container)
                container[key] += 1
                size += len(container) - had
        self.sizes[word] = size
        self.total += size - before

    @staticmethod
    def _burst(container: Counter) -> dict[int, Counter]:
        node: dict[int, Counter] = {}
        for key, n in container.items():
            node.setdefault(key >> 32, Counter())[key] = n
        return node

    def spill(self, everything: bool = False) -> tuple[np.ndarray, np.ndarray] | None:
        """(ids, counts) of the largest subtrees, sorted, if the trie is full: they leave until it is half empty."""
        if not self.total or (self.total <= self.full and not everything):
            return None
        left = 0 if everything else self.full // 2
        words = list(self.root) if everything else sorted(self.root, key=self.sizes.get, reverse=True)
        keys, counts, prefix = [], [], []
        for word in words:
            if self.total <= left:
                break
            below = self.root.pop(word)
            containers = [below] if isinstance(below, Counter) else below.values()
            for container in containers:
                keys += container.keys()
                counts += container.values()
            prefix.append((word, self.sizes[word]))
            self.total -= self.sizes.pop(word)
        key = np.array(keys, dtype=np.int64)
        first = np.repeat(*np.array(prefix, dtype=np.int64).T)
        ids = np.stack([first, key >> 32, (key & 0xFFFFFFFF) - 1], axis=1)
        order = np.lexsort((key, first))
        return ids[order], np.array(counts, dtype=np.int64)[order]


class WordIds:
    """Dense ids of the 64-bit keys met so far."""

    def __init__(self) -> None:
        self.ids: dict[int, int] = {}

    def of(self, keys: np.ndarray) -> np.ndarray:
        distinct, inverse = np.unique(keys, return_inverse=True)
        ids = self.ids
        return np.array([ids.setdefault(k, len(ids)) for k in distinct.tolist()], dtype=np.int64)[inverse]

    def keys(self) -> np.ndarray:
        return np.fromiter(self.ids, dtype=np.int64, count=len(self.ids))


def _keyed(batches: Iterator[pa.RecordBatch], seed: int):
    """(words, keys, languages) of every slice of texts; a word's key depends on its language."""
    for batch in batches:
        texts, langs = text_array(batch.column("text")), text_array(batch.column("lang"))
        for low, high in slices(texts, SLICE_BYTES):
            words = words_of(texts[low:high], KINDS)
            lang = langs[low:high].dictionary_encode()
            names = lang.dictionary.to_pylist()
            salt = np.array([int.from_bytes(hashlib.blake2b(n.encode(), digest_size=8).digest(), "little") for n in names],
                            dtype=np.uint64)
            of_text = lang.indices.to_numpy()
            yield words, word_keys(words, salt[of_text[words.text]], seed), names, of_text


def word_runs(batches: Iterator[pa.RecordBatch], seed: int = 0) -> Iterator[pa.RecordBatch]:
    """Runs of key, lang, word, n. A second word met under a key has a row of its own, with n 0."""
    ids, n, langs, texts = WordIds(), np.zeros(0, dtype=np.int64), [], []
    others: list[tuple[int, str, str]] = []

    def run() -> pa.RecordBatch:
        columns = zip(*others) if others else ((), (), ())
        key, lang, word = (list(c) for c in columns)
        return pa.RecordBatch.from_arrays(
            [pa.array([*ids.keys().tolist(), *key], type=pa.int64()), pa.array(langs + lang, type=pa.string()),
             pa.array(texts + word, type=pa.string()), pa.array([*n.tolist(), *[0] * len(key)], type=pa.int64())],
            names=["key", "lang", "word", "n"])

    for words, keys, names, of_text in _keyed(batches, seed):
        if not len(keys):
            continue
        data = words.data.tobytes()

        def shown(at: np.ndarray) -> tuple[list[str], list[str]]:
            return ([names[i] for i in of_text[words.text[at]].tolist()],
                    [data[a:b].decode() for a, b in zip(words.starts[at].tolist(), words.ends[at].tolist())])

        known = len(ids.ids)
        distinct, at, inverse, times = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
        check = word_keys(words, of_text[words.text], seed + 100)
        own = ids.of(distinct)
        fresh = at[own >= known][np.argsort(own[own >= known])]
        n = np.concatenate([n, np.zeros(len(fresh), dtype=np.int64)])
        n[own] += times
        for part, text in zip((langs, texts), shown(fresh)):
            part += text
        before = own < known
        odd = [i for i, o, lang, word in zip(at[before].tolist(), own[before].tolist(), *shown(at[before]))
               if (langs[o], texts[o]) != (lang, word)]
        odd += np.flatnonzero(check != check[at][inverse]).tolist()
        if odd:
            others += dict.fromkeys(zip(keys[odd].tolist(), *shown(np.array(odd))))
        if len(ids.ids) > FULL:
            yield run()
            ids, n, langs, texts, others = WordIds(), n[:0], [], [], []
    if len(ids.ids):
        yield run()


def count_words(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The written table key, lang, word, shared (another word has the key too), n of all words."""
    bounded_batches(docs.sparkSession)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return word_runs(batches, seed)

    runs = _texts(docs).mapInArrow(counted, "key bigint, lang string, word string, n bigint")
    own = F.struct("lang", "word")
    merged = runs.groupBy("key").agg(F.min(own).alias("own"), F.max(own).alias("other"), F.sum("n").alias("n"))
    return written(merged.select("key", "own.lang", "own.word", (F.col("own") != F.col("other")).alias("shared"), "n"), "words")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col("text"))


def phrase_bit(keys: list[Column]) -> Column:
    """Bit of a phrase in the map."""
    place = F.lit(0).cast("bigint")
    for key in keys:
        place = F.shiftright(place, 7).bitwiseXOR(F.shiftleft(place, 25)).bitwiseXOR(key)
    return F.pmod(place, F.lit(MAP_BITS))


def _bits(keys: np.ndarray) -> np.ndarray:
    """As ``phrase_bit``, of a row of keys per phrase."""
    place = np.zeros(len(keys), dtype=np.int64)
    for column in keys.T:
        place = (place >> 7) ^ (place << 25) ^ column
    return place % MAP_BITS


def bit_map(phrases: DataFrame, keys: list[str]) -> np.ndarray:
    """The map of all the phrases, one byte for eight of its bits; its rows are few and of a fixed size."""
    bits = phrases.select(phrase_bit([F.col(k) for k in keys]).alias("bit"))
    rows = bits.groupBy(F.floor(F.col("bit") / _BUCKET).alias("bucket")).agg(
        F.bitmap_construct_agg(F.col("bit") % _BUCKET).alias("bits"))
    out = np.zeros(MAP_BITS // 8, dtype=np.uint8)
    for row in rows.toLocalIterator():
        at = row["bucket"] * (_BUCKET // 8)
        out[at:at + _BUCKET // 8] = np.frombuffer(bytes(row["bits"]), dtype=np.uint8)
    return out


def count_phrases(docs: DataFrame, length: int, frequent: np.ndarray, seed: int = 0, least: int = LEAST,
                  full: int = FULL, burst: int = BURST) -> DataFrame:
    """The written table w1, w2(, w3), n of the phrases of so many words (2 or 3) that occur ``least`` times or more.

    ``frequent`` is the bit map of the frequent phrases with a word less.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(frequent)
    columns = [f"w{i + 1}" for i in range(length)]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = shared.value
        trie, ids = HatTrie(burst, full), WordIds()

        def run(everything: bool) -> Iterator[pa.RecordBatch]:
            spilled = trie.spill(everything)
            if spilled is not None:
                keys = ids.keys()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[spilled[0][:, i]]) for i in range(length)] + [pa.array(spilled[1])], names=[*columns, "n"])

        for words, keys, _, _ in _keyed(batches, seed):
            if len(keys) < length:
                continue
            n = len(keys) - length + 1
            together = words.piece[:n] == words.piece[length - 1:]
            part = _bits(np.lib.stride_tricks.sliding_window_view(keys, length - 1))
            known = (marks[part >> 3] >> (part & 7)) & 1 == 1
            at = np.flatnonzero(together & known[:n] & known[1:])
            if not len(at):
                continue
            own = ids.of(keys[(at[:, None] + np.arange(length)).ravel()]).reshape(-1, length)
            trie.add(own)
            yield from run(False)
            if len(ids.ids) > 2 * full:  # ids of words that are long gone
                yield from run(True)
                trie, ids = HatTrie(burst, full), WordIds()
        yield from run(True)

    runs = _texts(docs).mapInArrow(counted, ", ".join(f"{c} bigint" for c in columns) + ", n bigint")
    merged = runs.repartition("w1", "w2").groupBy(*columns).agg(F.sum("n").alias("n"))
    return written(merged.filter(F.col("n") >= least), f"phrases-{length}")


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)) in whole numbers of 38 digits: exact for counts up to 10**15."""
    wide = [x.cast("decimal(18,0)") for x in (a, left, right)]
    top = (wide[0] * wide[0]).cast("decimal(32,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    bottom = (wide[1] * wide[2]).cast("decimal(32,0)")
    top = top.cast("decimal(38,0)")
    return ((top - top % bottom) / bottom).cast("decimal(38,0)").cast("bigint")  # no remainder, so nothing is rounded


def mine_collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` collocations of two and three words of every language.

    ``docs`` has text and lang. A null text is empty, a null lang is ``und`` (as one that says so). Repeated documents
    count as often as they come. A language without candidates has no rows. Ties in score go by a, then by the phrase's
    bytes. Other columns are not looked at.
    """
    for seed in range(8):
        words = count_words(docs, seed)
        if words.filter("shared").isEmpty():
            break
    else:
        raise RuntimeError("two words share a key under every seed")
    frequent = words.filter(F.col("n") >= least).select("key", "lang", "word", "n")
    pairs = count_phrases(docs, 2, bit_map(frequent, ["key"]), seed, least)
    triples = count_phrases(docs, 3, bit_map(pairs, ["w1", "w2"]), seed, least)

    def word(at: int) -> DataFrame:
        return frequent.select(F.col("key").alias(f"w{at}"), F.col("word").alias(f"t{at}"), F.col("n").alias(f"f{at}"),
                               *([F.col("lang").alias("lang")] if at == 1 else []))

    two = pairs.withColumnRenamed("n", "a").join(word(1), "w1").join(word(2), "w2")
    two = two.select("w1", "w2", "lang", "a", F.concat_ws(" ", "t1", "t2").alias("phrase"), F.col("f1").alias("l"),
                     F.col("f2").alias("r")).withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))
    inside = triples.select(F.explode(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))).alias("p"), "n")
    longer = inside.groupBy("p").agg(F.max("n").alias("most")).select("p.*", "most")
    kept = two.join(longer, ["w1", "w2"], "left").filter(
        F.col("most").isNull() | (F.col("most") * INSIDE[0] < F.col("a") * INSIDE[1]))
    front = pairs.withColumnRenamed("n", "front")
    back = pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("n").alias("back"))
    three = triples.withColumnRenamed("n", "a").join(front, ["w1", "w2"]).join(back, ["w2", "w3"])
    three = three.join(word(1), "w1").join(word(2), "w2").join(word(3), "w3")
    early, late = _score(F.col("a"), F.col("f1"), F.col("back")), _score(F.col("a"), F.col("front"), F.col("f3"))
    three = three.withColumns({"early": early, "late": late}).select(
        "lang", "a", F.concat_ws(" ", "t1", "t2", "t3").alias("phrase"),
        F.when(F.col("early") <= F.col("late"), F.col("f1")).otherwise(F.col("front")).alias("l"),
        F.when(F.col("early") <= F.col("late"), F.col("back")).otherwise(F.col("f3")).alias("r"),
        F.least("early", "late").alias("score"))
    candidates = kept.select(*three.columns).unionByName(three)
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = candidates.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
