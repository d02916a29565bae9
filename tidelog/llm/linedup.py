"""Line deduplication by pairwise alignment.

Documents overlap when they share a run of lines that is long enough to be evidence. Each shortest such run around a line
links every later document to the first one that holds the run, so even a run of a third of all documents makes one pair
per document, and no frequency has to be capped. A line goes if it stands in a long enough run of an earlier document:
then it stands in one of these shortest runs, and is found with that run's first holder. Each pair is aligned with patience diff, and aligned common blocks go from the later document. What is
left is aligned again until nothing goes, which also finds blocks in another order or more than once.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import free_names, written
from tidelog.operators.joins import join_per_key

MIN_WORDS = 4
CHARS_A_WORD = 5
_LAST = 2**63 - 1


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest run of pairs (sorted by their first members) whose second members rise."""
    tails: list[int] = []
    where: list[int] = []
    before: list[int] = []
    for i, (_, y) in enumerate(pairs):
        at = bisect_left(tails, y)
        before.append(where[at - 1] if at else -1)
        if at == len(tails):
            tails.append(y)
            where.append(i)
        else:
            tails[at], where[at] = y, i
    out, i = [], where[-1] if where else -1
    while i >= 0:
        out.append(pairs[i])
        i = before[i]
    return out[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned positions (in a, in b) of equal lines, both rising.

    Common ends are aligned first, then lines that are unique on both sides along a longest rising run, then the gaps
    between those. A gap without such lines is aligned by its lines' numbers of occurrence.
    """
    out, gaps = [], [(0, len(a), 0, len(b))]
    while gaps:
        i, j, k, m = gaps.pop()
        while i < j and k < m and a[i] == b[k]:
            out.append((i, k))
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            j, m = j - 1, m - 1
            out.append((j, m))
        if i == j or k == m:
            continue
        in_a, in_b = Counter(a[i:j]), Counter(b[k:m])
        place = {a[x]: x for x in range(i, j) if in_a[a[x]] == 1}
        anchors = _rising([(y, place[b[y]]) for y in range(k, m) if b[y] in place and in_b[b[y]] == 1])
        if not anchors:
            seen_a, seen_b, numbered, matched = Counter(), Counter(), {}, []
            for x in range(i, j):
                seen_a[a[x]] += 1
                numbered[a[x], seen_a[a[x]]] = x
            for y in range(k, m):
                seen_b[b[y]] += 1
                if (x := numbered.get((b[y], seen_b[b[y]]))) is not None:
                    matched.append((y, x))
            out += [(x, y) for y, x in _rising(matched)]
            continue
        last_x, last_y = i, k
        for y, x in [*anchors, (m, j)]:
            gaps.append((last_x, x, last_y, y))
            if y < m:
                out.append((x, y))
            last_x, last_y = x + 1, y + 1
    return sorted(out)


def common_blocks(earlier: list[int], later: list[int], words: list[int], min_words: int = MIN_WORDS) -> list[int]:
    """Positions of ``later`` that lie in common blocks of at least ``min_words`` words, rising.

    Blocks are aligned; those that no alignment has in one piece are then looked up by their shortest runs.
    """
    shared = set(earlier) & set(later)
    a = [(h, x) for x, h in enumerate(earlier) if h in shared]
    b = [(h, y) for y, h in enumerate(later) if h in shared]
    gone: list[int] = []
    while b:
        found = [(a[i][1], b[k][1], k) for i, k in patience([h for h, _ in a], [h for h, _ in b])]
        blocks: list[list] = []
        for x, y, k in found:
            if blocks and (x, y) == (blocks[-1][-1][0] + 1, blocks[-1][-1][1] + 1):
                blocks[-1].append((x, y, k))
            else:
                blocks.append([(x, y, k)])
        taken = {k for block in blocks if sum(words[y] for _, y, _ in block) >= min_words for _, _, k in block}
        if not found:
            break
        gone += [b[k][1] for k in taken]
        if not taken:  # short blocks only: set aside, as they may stand in the way of others
            taken = {k for _, _, k in found}
        b = [line for k, line in enumerate(b) if k not in taken]
    left = {y for y, h in enumerate(later) if h in shared}.difference(gone)
    if left and sum(words[y] for y, h in enumerate(later) if h in shared) >= min_words:
        count = dict(zip(later, words))  # equal lines have equal words
        held = {h for _, h in runs(earlier, [count.get(h, 1) for h in earlier], min_words)}
        gone += left.intersection(y for y, h in runs(later, words, min_words) if h in held)
    return sorted(gone)


_PRIME, _BASE = 2**61 - 1, 1_442_695_040_888_963_407


def runs(lines: list[int], words: list[int], min_words: int) -> list[tuple[int, int]]:
    """(position, hash) of the shortest runs of at least ``min_words`` words around each line.

    Of a run no end can be left out, unless it is the line itself. A line that is long enough is its own and only run,
    and the hash is the line's.
    """
    n = len(lines)
    hashes, powers, total = [0], [1], [0]
    for h, w in zip(lines, words):
        hashes.append((hashes[-1] * _BASE + h + 2**63 + 1) % _PRIME)
        powers.append(powers[-1] * _BASE % _PRIME)
        total.append(total[-1] + w)
    worded = [i for i in range(n) if words[i]]
    out, at = [], 0  # at: how many of worded are before y
    for y in range(n):
        if words[y] >= min_words:
            out.append((y, lines[y]))
        else:
            after = at + (words[y] > 0)
            right, stop = after, y + 1  # the run ends before stop, after a line with words, or with y
            while right < len(worded) and total[stop] - total[y] < min_words:
                stop, right = worded[right] + 1, right + 1
            left, start = at, y
            while True:
                if total[stop] - total[start] >= min_words:
                    while right > after:  # shorten as far as the words allow
                        shorter = worded[right - 2] + 1 if right - 1 > after else y + 1
                        if total[shorter] - total[start] < min_words:
                            break
                        stop, right = shorter, right - 1
                    value = (hashes[stop] - hashes[start] * powers[stop - start]) % _PRIME
                    out.append((y, value * 4 + 1 if stop - start > 1 else lines[y]))
                    if right == after:
                        break
                if left == 0:
                    break
                left -= 1
                start = worded[left]
        at += words[y] > 0
    return out


def hashed_lines(docs: DataFrame) -> DataFrame:
    """row_id (doc_id; the largest number for null), mark (hash of the text), lines (hashes of trimmed lines), words.

    Blank lines hash to 0 and have no words. A line has as many words as runs of characters between Unicode white space,
    or one per ``CHARS_A_WORD`` code points (white space counted once) if these are more: not every script parts words.
    One row per row of ``docs`` with a text that is not empty.
    """
    lines = F.transform(F.split("text", "\n"), lambda x: F.trim(F.translate(x, "\t\r", "  ")))
    hashed = F.transform("l", lambda x: F.when(x == "", F.lit(0).cast("bigint")).otherwise(F.xxhash64(x)))
    plain = F.transform("l", lambda x: F.trim(F.regexp_replace(x, r"(?U)\s+", " ")))
    counted = F.transform("plain", lambda x: F.when(x == "", F.lit(0)).otherwise(
        F.greatest(F.length(x) - F.length(F.replace(x, F.lit(" "))) + 1, F.floor(F.length(x) / CHARS_A_WORD).cast("int"))))
    rows = docs.select("doc_id", "text").filter("text <> ''")
    keyed = rows.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("row_id"), F.xxhash64("text").alias("mark"), lines.alias("l"))
    return keyed.withColumn("plain", plain).select("row_id", "mark", hashed.alias("lines"), counted.alias("words"))


def overlaps(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """row_id, mark, first (row_id, mark of an earlier document): the pairs to align, each once."""
    @F.pandas_udf("array<bigint>")
    def around_short(lines: pd.Series, words: pd.Series) -> pd.Series:
        return pd.Series([list({h for y, h in runs(a.tolist(), w.tolist(), min_words) if w[y] < min_words}) for a, w in zip(lines, words)],
                         dtype=object)

    zipped = F.filter(F.arrays_zip("lines", "words"), lambda x: x["words"] >= min_words)
    alone = lines.select("row_id", "mark", F.explode(F.array_distinct(F.transform(zipped, lambda x: x["lines"]))).alias("h"))
    short = lines.filter(F.exists("words", lambda w: w < min_words) & (F.size("words") > 1))
    each = alone.unionByName(short.select("row_id", "mark", F.explode(around_short("lines", "words")).alias("h")))
    key = F.struct("row_id", "mark")
    shared = each.groupBy("h").agg(F.min(key).alias("first"), F.max(key).alias("last")).filter("first <> last")
    met = join_per_key(each, shared.select("h", "first"), ["h"], "inner")
    return met.filter(F.struct("row_id", "mark") != F.col("first")).select("row_id", "mark", "first").distinct()


def doomed_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """row_id, mark, gone (positions of lines to delete): one row per document that loses lines."""
    @F.pandas_udf("array<int>")
    def aligned(earlier: pd.Series, later: pd.Series, words: pd.Series) -> pd.Series:
        return pd.Series([common_blocks(a.tolist(), b.tolist(), w.tolist(), min_words) for a, b, w in zip(earlier, later, words)], dtype=object)

    lines = written(hashed_lines(docs), "lines")
    pairs = written(overlaps(lines, min_words), "overlaps")
    once = lines.groupBy("row_id", "mark").agg(F.first("lines").alias("lines"), F.first("words").alias("words"))
    firsts = once.select(F.struct("row_id", "mark").alias("first"), F.col("lines").alias("earlier"))
    both = join_per_key(join_per_key(pairs, firsts, ["first"], "inner"), once, ["row_id", "mark"], "inner")
    found = both.select("row_id", "mark", aligned("earlier", "lines", "words").alias("gone")).filter(F.size("gone") > 0)
    return found.groupBy("row_id", "mark").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("gone"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, count_as: str = "n_deleted") -> DataFrame:
    """All columns of ``docs`` with the text deduplicated, and ``count_as`` (lines gone): one row per row of ``docs``.

    A document is later if its id is greater, for equal ids if its text's hash is; a null id is last. Rows alike in id
    and text are one document: none is later, and all lose the same lines. Every line of at least ``min_words`` words
    (or 5 x ``min_words`` characters) stays in the first document that holds it. Shorter and blank lines go only inside a longer common block. Lines are
    compared without blanks, tabs and returns at their ends; a null or empty text stays as it is. A column of ``docs``
    named as ``count_as`` is replaced; any other name may be there.
    """
    row_id, mark, gone = free_names(docs, "_row_id", "_mark", "_gone")
    doomed = doomed_lines(docs, min_words).withColumnsRenamed({"row_id": row_id, "mark": mark, "gone": gone})
    others = [c for c in docs.columns if c.lower() != count_as.lower()]
    keyed = docs.select(*others, F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias(row_id), F.xxhash64("text").alias(mark))
    met = keyed.join(doomed, [row_id, mark], "left")
    lines = F.split("text", "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n"))
    return met.select(*[text.alias("text") if c == "text" else c for c in others], F.coalesce(F.size(gone), F.lit(0)).alias(count_as))
