"""Hard negatives by exact scores: Strassen products of anchor and candidate tiles, then mergeable heaps.

Candidates are dealt out to blocks by hash; each block meets all anchors, which stream through it batch by batch in one
task. The scores of a tile (some anchors, some candidates) are one product of whole-number matrices by Strassen's seven
recursive products, with an even number of rows and columns by zero padding. Sums and products of 64-bit numbers are
exact modulo 2**64, so a score that fits 64 bits is exact whatever the steps on the way.

A first pass keeps, for each anchor, a heap of its best candidates of the same label; heaps of blocks merge into the
anchor's positives. In a second pass each positive has a window of scores, and a heap of the best candidates of other
labels within it; heaps of blocks merge again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import written
from tidelog.llm.tokens import bounded_batches

LEAF = 16  # sides up to here are multiplied directly
BLOCK = 4096  # candidates of a block
TILE = 2048  # candidates of a tile
ANCHORS = 512  # anchors of a tile


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The matrix product of 64-bit whole numbers, modulo 2**64."""
    if min(*a.shape, b.shape[1]) <= leaf:
        return a @ b
    rows, inner, columns = a.shape[0], a.shape[1], b.shape[1]
    a = np.pad(a, ((0, rows % 2), (0, inner % 2)))
    b = np.pad(b, ((0, inner % 2), (0, columns % 2)))
    m, k, n = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * m, 2 * n), dtype=np.int64)
    out[:m, :n], out[:m, n:] = p1 + p4 - p5 + p7, p3 + p5
    out[m:, :n], out[m:, n:] = p2 + p4, p1 - p2 + p3 + p6
    return out[:rows, :columns]


class Heaps:
    """For each owner the best of the (score, id) offered: higher scores first, then smaller ids."""

    def __init__(self, owners: int, size: int) -> None:
        self.size = size
        self.owner, self.score, self.id = (np.zeros(0, dtype=np.int64) for _ in range(3))

    def offer(self, owner: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Merges entries in; those of another ``Heaps`` are entries too."""
        owner, score, ids = (np.concatenate(x) for x in ((self.owner, owner), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, ~score, owner))  # ~score falls as the score rises, and never overflows
        owner = owner[order]
        place = np.arange(len(owner)) - np.searchsorted(owner, owner)
        kept = order[place < self.size]
        self.owner, self.score, self.id = owner[place < self.size], score[kept], ids[kept]


class Block:
    """Candidates of a block, different from each other, ordered by id; and by label for the products within a label."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        order = np.lexsort((ids, labels))
        self.ids, self.labels, self.vectors = ids[order], labels[order], np.ascontiguousarray(vectors[order].T)

    def tiles(self, low: int = 0, high: int | None = None) -> Iterator[slice]:
        high = len(self.ids) if high is None else high
        for at in range(low, high, TILE):
            yield slice(at, min(at + TILE, high))

    def same_label(self, label: int) -> tuple[int, int]:
        return int(np.searchsorted(self.labels, label)), int(np.searchsorted(self.labels, label, side="right"))


def _best(scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's best allowed entries, ties to smaller ids; ties at the end may stay all."""
    n = scores.shape[1]
    if n > size:
        # The lowest number stands for what is not allowed; an allowed score that low ties with it and stays.
        masked = np.where(allowed, scores, np.iinfo(np.int64).min)
        bound = np.partition(masked, n - size, axis=1)[:, n - size]
        allowed = allowed & (scores >= bound[:, None])
    return np.nonzero(allowed)


def positives(block: Block, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, size: int) -> Heaps:
    heaps = Heaps(len(ids), size)
    for label in np.unique(labels):
        low, high = block.same_label(label)
        mine = np.flatnonzero(labels == label)
        for tile in block.tiles(low, high):
            scores = strassen(vectors[mine], block.vectors[:, tile])
            row, column = _best(scores, block.ids[tile] != ids[mine][:, None], block.ids[tile], size)
            heaps.offer(mine[row], scores[row, column], block.ids[tile][column])
    return heaps


def negatives(block: Block, labels: np.ndarray, vectors: np.ndarray, windows: list[list[int]], size: int,
              low: int, high: int) -> Heaps:
    """Heaps of (anchor, nth positive); ``windows`` has the scores of each anchor's positives."""
    most = max((len(w) for w in windows), default=0)
    heaps = Heaps(len(labels) * most, size)
    # Floor division: 100 * s >= low * p holds from the rounded-up quotient on.
    bounds = np.array([[(-(-low * p // 100), high * p // 100) for p in w] + [(1, 0)] * (most - len(w)) for w in windows],
                      dtype=np.int64).reshape(len(windows), most, 2)
    for tile in block.tiles():
        scores = strassen(vectors, block.vectors[:, tile])
        other = block.labels[tile] != labels[:, None]
        for nth in range(most):
            inside = other & (scores >= bounds[:, nth, :1]) & (scores <= bounds[:, nth, 1:])
            row, column = _best(scores, inside, block.ids[tile], size)
            heaps.offer(row * most + nth, scores[row, column], block.ids[tile][column])
    return heaps


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of vectors, filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values, lengths = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), width), dtype=np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def _through_blocks(candidates: DataFrame, anchors: DataFrame, blocks: int, width: int, schema: str,
                    meet: Callable[[Block, pa.RecordBatch], pa.RecordBatch]) -> DataFrame:
    """Every anchor meets every block: a block's candidates arrive first, its anchors pass by after them."""
    extra = [c for c in anchors.columns if c not in candidates.columns]
    place = F.pmod(F.xxhash64("vec_id", "label", "vector"), F.lit(blocks)).cast("int")
    held = candidates.select(place.alias("block"), F.lit(False).alias("asks"), *candidates.columns,
                             *[F.lit(None).cast(anchors.schema[c].dataType).alias(c) for c in extra])
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    asking = anchors.select(every, F.lit(True).alias("asks"), *candidates.columns, *extra)
    dealt = held.unionByName(asking).repartition(blocks, "block").sortWithinPartitions("block", "asks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts, block = None, [], None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            of_block = table.column("block").to_numpy()
            cuts = np.flatnonzero(np.diff(of_block)) + 1
            for low, high in zip([0, *cuts], [*cuts, len(of_block)]):
                part = table.slice(low, high - low)
                if of_block[low] != number:
                    number, parts, block = of_block[low], [], None
                asks = part.column("asks").to_numpy()
                split = int(np.searchsorted(asks, True))
                if split:
                    own = part.slice(0, split)
                    parts.append((own.column("vec_id").to_numpy(), own.column("label").to_numpy(), _matrix(own.column("vector"), width)))
                for at in range(split, len(asks), ANCHORS):
                    if block is None and parts:
                        block = Block(*(np.concatenate(x) for x in zip(*parts)))
                        parts = []
                    if block is not None:
                        yield meet(block, part.slice(at, min(ANCHORS, len(asks) - at)).combine_chunks().to_batches()[0])

    return dealt.mapInArrow(run, schema)


def hard_negatives(vectors: DataFrame, anchors: DataFrame, n_positives: int = 5, n_negatives: int = 10,
                   low: int = 30, high: int = 90, block_rows: int = BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` and ``anchors`` have vec_id, label (whole numbers) and vector (array of bigint). Rows with a null among
    them take no part. An anchor's positives are the ``n_positives`` best other rows of its label; the negatives of a
    pair the ``n_negatives`` best rows of other labels with low % to high % of the positive's score. Higher scores come
    first, then smaller ids. Rows alike in all three count once; rows with the anchor's id are its own, and an anchor id
    with several rows asks with the smallest. Missing trailing components are 0. Scores, and 100 times them, must fit 64
    bits. An anchor without positives, and a pair without negatives, has no rows. Other columns are not looked at.
    """
    bounded_batches(vectors.sparkSession)
    columns, whole = ["vec_id", "label", "vector"], "vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL"
    known = written(_plain(vectors).filter(whole).distinct(), "candidates")
    asked = _plain(anchors).filter(whole).groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("v"))
    asked = written(asked.select("vec_id", "v.label", "v.vector"), "anchors")
    n, wide = known.agg(F.count("*"), F.max(F.size("vector"))).first()
    width = max(wide or 0, asked.agg(F.max(F.size("vector"))).first()[0] or 0, 1)
    blocks = -(-n // block_rows) or 1

    def find_positives(block: Block, batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, labels = batch.column("vec_id").to_numpy(), batch.column("label").to_numpy()
        heaps = positives(block, ids, labels, _matrix(batch.column("vector"), width), n_positives)
        return pa.RecordBatch.from_arrays([pa.array(ids[heaps.owner]), pa.array(heaps.id), pa.array(heaps.score)],
                                          names=["anchor_id", "positive_id", "positive_score"])

    def find_negatives(block: Block, batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, labels = batch.column("vec_id").to_numpy(), batch.column("label").to_numpy()
        pairs = batch.column("positives").to_pylist()  # in order of nth
        most = max(map(len, pairs))
        heaps = negatives(block, labels, _matrix(batch.column("vector"), width),
                          [[p["score"] for p in own] for own in pairs], n_negatives, low, high)
        anchor, nth = heaps.owner // most, heaps.owner % most
        own = [pairs[a][i] for a, i in zip(anchor.tolist(), nth.tolist())]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[anchor]), pa.array(nth), pa.array([p["id"] for p in own], type=pa.int64()),
             pa.array([p["score"] for p in own], type=pa.int64()), pa.array(heaps.id), pa.array(heaps.score)],
            names=["anchor_id", "nth", "positive_id", "positive_score", "negative_id", "negative_score"])

    heaps = _through_blocks(known, asked, blocks, width, "anchor_id bigint, positive_id bigint, positive_score bigint", find_positives)
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    best = heaps.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= n_positives)
    pair = F.struct("nth", F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))
    pairs = best.groupBy("anchor_id").agg(F.array_sort(F.collect_list(pair)).alias("positives"))
    asking = written(asked.join(pairs.withColumnRenamed("anchor_id", "vec_id"), "vec_id").select(*columns, "positives"), "anchors")
    found = _through_blocks(known, asking, blocks, width, "anchor_id bigint, nth bigint, positive_id bigint, "
                            "positive_score bigint, negative_id bigint, negative_score bigint", find_negatives)
    order = Window.partitionBy("anchor_id", "nth").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n_negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _plain(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"),
                       F.col("vector").cast("array<bigint>").alias("vector"))
