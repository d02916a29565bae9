"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is cut into pieces (its paragraphs, long ones at sentence ends), each piece and its number among equal pieces
makes a 64-bit digest, and every digest is added to three cells of a sketch. Cells subtract, so the difference of two
sketches holds only digests of one side. Peeling takes digests out of cells that hold just one until nothing is left;
if that fails, the two texts are sketched again with more cells.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import small_batches

CELLS = 24
GROWTH = 4
LONGEST_PIECE = 160
_PIECE = re.compile(r"[^.!?\n]+[.!?]*|[.!?\n]+")
_BATCH = 512  # texts compared at a time, unless they are long
_BATCH_CHARS = 4_000_000
_CELLS_AT_ONCE = 1 << 19


def pieces(text: str) -> list[str]:
    """Paragraphs cut after sentence ends; anything longer than 160 code points every 160 from its start."""
    found = [p for p in (x.strip() for x in _PIECE.findall(text)) if p]
    if all(len(p) <= LONGEST_PIECE for p in found):
        return found
    return [p[i:i + LONGEST_PIECE] for p in found for i in range(0, len(p), LONGEST_PIECE)]


def digests(text: str) -> np.ndarray:
    """Digests of the pieces as a multiset: the k-th of equal pieces has a digest of its own."""
    raw = bytearray()
    for piece, times in Counter(pieces(text)).items():
        data = piece.encode("utf-8", "replace")
        raw += hashlib.blake2b(data, digest_size=8).digest()
        for k in range(1, times):
            raw += hashlib.blake2b(data, digest_size=8, salt=k.to_bytes(8, "little")).digest()
    return np.sort(np.frombuffer(bytes(raw), dtype=np.uint64))


def _mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply, twice)."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _places(keys: np.ndarray, cells: int) -> np.ndarray:
    """Cell of each key in each of the three thirds of a sketch."""
    third = cells // 3
    return np.stack([_mixed(keys, 3 * cells + i) % np.uint64(third) + np.uint64(i * third) for i in range(3)]).astype(np.int64)


class Sketches:
    """Sketches of many texts side by side: number, sum of digests and sum of their checks in each cell."""

    def __init__(self, sets: list[np.ndarray], cells: int) -> None:
        self.n, self.cells = len(sets), cells
        self.count = np.zeros(self.n * cells, dtype=np.int64)
        self.keys = np.zeros(self.n * cells, dtype=np.uint64)
        self.checks = np.zeros(self.n * cells, dtype=np.uint64)
        if sets:
            self._add(np.concatenate(sets), np.repeat(np.arange(self.n), [len(s) for s in sets]), 1)

    def _add(self, keys: np.ndarray, owner: np.ndarray, sign: int) -> None:
        checks = _mixed(keys, -1)
        for place in _places(keys, self.cells):
            at = owner * self.cells + place
            self.count += sign * np.bincount(at, minlength=len(self.count))
            if sign > 0:
                np.add.at(self.keys, at, keys)
                np.add.at(self.checks, at, checks)
            else:
                np.subtract.at(self.keys, at, keys)
                np.subtract.at(self.checks, at, checks)

    def minus(self, other: Sketches) -> Sketches:
        out = Sketches([], self.cells)
        out.n = self.n
        with np.errstate(over="ignore"):
            out.count, out.keys, out.checks = self.count - other.count, self.keys - other.keys, self.checks - other.checks
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Digests only on the left and only on the right per sketch, and whether peeling was complete.

        Consumes the sketches.
        """
        left, right = np.zeros(self.n, dtype=np.int64), np.zeros(self.n, dtype=np.int64)
        with np.errstate(over="ignore"):
            while True:
                pure = np.flatnonzero(np.abs(self.count) == 1)
                sign = self.count[pure]
                keys = np.where(sign > 0, self.keys[pure], np.uint64(0) - self.keys[pure])
                checks = np.where(sign > 0, self.checks[pure], np.uint64(0) - self.checks[pure])
                good = checks == _mixed(keys, -1)
                if not good.any():
                    break
                found = np.unique(np.stack([(pure[good] // self.cells).astype(np.uint64), keys[good],
                                            (sign[good] > 0).astype(np.uint64)]), axis=1)
                owner, keys, positive = found[0].astype(np.int64), found[1], found[2] > 0
                left += np.bincount(owner[positive], minlength=self.n)
                right += np.bincount(owner[~positive], minlength=self.n)
                self._add(keys[positive], owner[positive], -1)
                self._add(keys[~positive], owner[~positive], 1)
        empty = (self.count == 0) & (self.keys == 0) & (self.checks == 0)
        return left, right, empty.reshape(self.n, self.cells).all(axis=1)

    def texts(self) -> list[str]:
        """Each sketch as text: base64 of its cells (number, digests, checks; little endian)."""
        packed = np.zeros(self.n * self.cells, dtype=[("count", "<i4"), ("keys", "<u8"), ("checks", "<u4")])
        packed["count"], packed["keys"] = self.count, self.keys
        packed["checks"] = (self.checks & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        rows = packed.reshape(self.n, self.cells)
        return [base64.b64encode(row.tobytes()).decode("ascii") for row in rows]


def likeness(ours: list[np.ndarray], theirs: list[np.ndarray], cells: int = CELLS,
             sketched: tuple[Sketches, Sketches] | None = None) -> np.ndarray:
    """Shared part of each pair of digest multisets (intersection over union, 1 for two empty ones).

    The difference is recovered from sketches of ``cells`` cells; pairs that do not peel are sketched anew with four
    times as many, until all have; of these so many at a time that their cells take a bounded part of memory.
    """
    out = np.zeros(len(ours))
    todo = np.arange(len(ours))
    while len(todo):
        left_open, lot = [], max(_CELLS_AT_ONCE // cells, 1) if sketched is None else len(todo)
        for some in (todo[i:i + lot] for i in range(0, len(todo), lot)):
            a, b = sketched or (Sketches([ours[i] for i in some], cells), Sketches([theirs[i] for i in some], cells))
            left, right, whole = a.minus(b).peel()
            sizes_a, sizes_b = (np.array([len(s[i]) for i in some]) for s in (ours, theirs))
            common, union = sizes_a - left, sizes_b + left
            whole &= (common >= 0) & (sizes_b - right == common)
            value = np.where(union > 0, common / np.maximum(union, 1), 1.0)
            out[some[whole]] = value[whole]
            left_open.append(some[~whole])
        todo, cells, sketched = np.concatenate(left_open), cells * GROWTH, None
    return out


def edited_text(text: str, following: str) -> str:
    """The text with its last half (rounded down) replaced by the first as many code points of the following one."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def with_successor(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Rows (bucket, guest, doc_id, text) such that, in a bucket by falling id (nulls last, then text hash), every row but
    guests is followed by its successor in the whole table; the last row's successor is the first.

    Buckets are ranges of ids between approximate quantiles. An id that fills several quantiles, and the rows without an
    id, are dealt in ranges of the text hash; only rows alike in id and text share a bucket whatever their number, and
    stream through its task. The first row of each bucket is also a guest at the end of the one before. Only the bounds
    of buckets, a few numbers each, reach the driver or are broadcast.
    """
    small_batches(docs.sparkSession)
    wanted = buckets or 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    shares = [i / wanted for i in range(1, wanted)] or [0.5]
    falling = F.bitwise_not("doc_id")
    seen = plain.agg(F.count(F.lit(1)).alias("n"), F.count("doc_id").alias("ids"),
                     F.percentile_approx(falling, shares, 10 * wanted).alias("cuts")).first()
    bounds, parts = _ranges(seen["cuts"] or [])
    parts.append(-(-wanted * (seen["n"] - seen["ids"]) // max(seen["n"], 1)) or 1)  # of the rows without an id
    before = np.concatenate([[0], np.cumsum(parts)[:-1]]).tolist()
    dealt = plain.select(
        "doc_id", "text", F.col("doc_id").isNull().alias("missing"), F.coalesce(falling, F.lit(0)).alias("falling"),
        F.xxhash64("text").alias("mark"))
    at = F.when(F.col("missing"), len(bounds) + 1).otherwise(_bounds_at_or_below(bounds, F.col("falling"))) + 1
    share = (F.shiftright("mark", 33) + 2**30) * F.element_at(F.lit(parts), at)  # of 2^31, in order of the hash
    dealt = dealt.withColumn("bucket", (F.element_at(F.lit(before), at) + F.shiftright(share, 31)).cast("int"))
    place = F.struct("missing", "falling", "mark")
    firsts = dealt.groupBy("bucket").agg(F.min(place).alias("first"))  # a row per bucket
    order = Window.orderBy("bucket")
    last = F.max("bucket").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    firsts = firsts.select("bucket", "first", F.coalesce(F.lag("bucket").over(order), last).alias("into"))
    own = F.struct(F.col("bucket"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("into").alias("bucket"), F.lit(True).alias("guest"))
    seats = F.explode(F.when(place == F.col("first"), F.array(own, guest)).otherwise(F.array(own)))
    return (
        dealt.join(F.broadcast(firsts), "bucket").select(seats.alias("seat"), "missing", "falling", "mark", "doc_id", "text")
        .select("seat.*", "missing", "falling", "mark", "doc_id", "text")
        .repartition("bucket").sortWithinPartitions("bucket", "guest", "missing", "falling", "mark")
        .select("bucket", "guest", "doc_id", "text")
    )


def _ranges(cuts: list[int]) -> tuple[list[int], list[int]]:
    """Least values of all ranges but the first, and into how many parts each range is to be cut.

    ``cuts`` are quantiles. A value met more than once is a range of its own, in one part more than it was met.
    """
    starts, parts = [], [1]
    for cut, times in sorted(Counter(cuts).items()):
        if starts and starts[-1] == cut:  # the value after one that was met more than once
            parts[-1] = times + 1 if times > 1 else 1
        else:
            starts.append(cut)
            parts.append(times + 1 if times > 1 else 1)
        if times > 1 and cut < 2**63 - 1:
            starts.append(cut + 1)
            parts.append(1)
    return starts, parts


def _bounds_at_or_below(rising: list[int], value: Column) -> Column:
    """How many of the bounds are at or below the value: first among every k-th of them, then between two of those."""
    if not rising:
        return F.lit(0)
    step = max(int(len(rising) ** 0.5), 1)
    groups = [rising[i:i + step] for i in range(0, len(rising), step)]
    whole = F.size(F.filter(F.lit([g[-1] for g in groups]), lambda b: b <= value))  # groups that lie at or below as a whole
    rest = F.element_at(F.array(*[F.lit(g) for g in groups], F.array().cast("array<bigint>")), whole + 1)
    return F.least(whole * step, F.lit(len(rising))) + F.size(F.filter(rest, lambda b: b <= value))


FINGERPRINTS = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                "near_edited double, near_next double")


def fingerprint_documents(docs: DataFrame, cells: int = CELLS) -> DataFrame:
    """Fingerprints of every text and its edited text, and their likeness: one row per row of ``docs``.

    A null text is an empty one; two empty texts are alike (1), an empty and another one are not (0). A single document
    follows itself. Repeated ids follow each other by text hash. Other columns are not looked at.
    """
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        for batch in batches:
            chars = 0
            for b, g, i, t in zip(batch["bucket"], batch["guest"], batch["doc_id"].astype("Int64"), batch["text"]):
                held.append((b, g, i, t, digests(t)))
                chars += len(t)
                if len(held) > _BATCH or chars >= _BATCH_CHARS:
                    yield _compared(held, cells)
                    held, chars = held[-1:], 0
            yield _compared(held, cells)
            held = held[-1:]

    return with_successor(docs).mapInPandas(rows, FINGERPRINTS)


def _compared(run: list[tuple], cells: int) -> pd.DataFrame:
    pairs = [(a, b) for a, b in zip(run, run[1:]) if a[0] == b[0] and not a[1]]
    edited = [edited_text(a[3], b[3]) for a, b in pairs]
    ours, theirs = [a[4] for a, _ in pairs], [b[4] for _, b in pairs]
    changed = [digests(t) for t in edited]
    own, other = Sketches(ours, cells), Sketches(changed, cells)
    out = pd.DataFrame({
        "doc_id": pd.array([a[2] for a, _ in pairs], dtype="Int64"), "n_chars": [len(a[3]) for a, _ in pairs],
        "edited_sha256": [hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in edited],
        "fingerprint": own.texts(), "edited_fingerprint": other.texts(),
        "near_edited": likeness(ours, changed, cells, (own, other)),
        "near_next": likeness(ours, theirs, cells, (own, Sketches(theirs, cells))),
    })
    return out.astype({"n_chars": "int64"})
