"""Near duplicates of word shingles with DartMinHash signatures.

A document is a weighted set of five-word shingles. For each shingle, hashed darts fall on the plane of weight and rank;
those within the shingle's weight count. Each dart belongs to a coordinate of the signature, and every coordinate keeps
its dart of lowest rank, so two documents agree in a coordinate with the probability of their weighted Jaccard
similarity. A dart field is thrown only as far up as a document needs, for all shingles at once, not per coordinate.

Signatures are cut into bands. Documents that share a band are linked to one of them, the links are verified on whole
shingle sets, and linked documents become components. Documents of a band that are not in the component of its centre get
a centre of their own, for a few rounds. Where documents of one band still lie in different components, all pairs of
them that can be similar at all are verified, so no link depends on which of them was chosen.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import free_names, returning_memory, small_batches, small_side, written
from tidelog.llm.components import connected_components
from tidelog.operators.joins import join_per_key

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 35, 5  # a pair of similarity 0.8 shares no band once in a million
ROUNDS = 2  # of new centres for what is not linked to a band's centre
_BATCH = 64

_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply, twice)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_STEP = np.uint64(0x9E3779B97F4A7C15)
with np.errstate(over="ignore"):
    _BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * _STEP)
    _FACTOR = mixed(np.arange(1, SHINGLE + 1, dtype=np.uint64) * _STEP) | np.uint64(1)


def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _STEP | np.uint64(1), dtype=np.uint64)]))


def shingle_hashes(texts: list[str]) -> list[np.ndarray]:
    """Hashes of each text's shingles, in order. Words are lower-cased runs of digits, letters a-z and non-ASCII bytes.

    A text of one to four words has one shingle of all its words; one without words has none.
    """
    raw = [t.lower().encode("utf-8", "replace") for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
    inside = _WORD[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    ends = np.cumsum([len(r) + 1 for r in raw])
    first_word = np.searchsorted(starts, np.concatenate([[0], ends]))
    with np.errstate(over="ignore"):
        if len(starts):
            offsets = np.cumsum(lengths) - lengths
            place = np.arange(int(lengths.sum())) - np.repeat(offsets, lengths)
            words = mixed(np.add.reduceat(_BYTE[data[inside]] * _powers(int(lengths.max()))[place], offsets))
        else:
            words = np.zeros(0, dtype=np.uint64)
        out = []
        for a, b in zip(first_word, first_word[1:]):
            own = words[a:b]
            n = max(len(own) - SHINGLE + 1, min(len(own), 1))
            total = np.full(n, np.uint64(len(own) if len(own) < SHINGLE else SHINGLE))
            for i in range(min(SHINGLE, len(own))):
                total = total + own[i:i + n] * _FACTOR[i]
            out.append(mixed(total))
    return out


def dart_signatures(elements: list[np.ndarray], weights: list[np.ndarray], size: int) -> np.ndarray:
    """Signatures (documents x ``size``) of weighted sets, each of at least one element with a weight above 0.

    The weight axis is cut into units, the rank axis into levels: 0 to 1/16, doubling up to 16, then steps of 16. A
    region of one element, unit and level holds a Poisson number of darts with its area as mean. A document goes up as
    many levels as it takes to fill all coordinates.
    """
    signatures = np.zeros((len(elements), size), dtype=np.uint64)
    filled = np.zeros((len(elements), size), dtype=bool)
    todo = np.arange(len(elements))
    units = [np.ceil(w).astype(np.int64) for w in weights]
    level, low, high = 0, 0.0, 1 / 16
    with np.errstate(over="ignore"):
        while len(todo):
            owner = np.repeat(todo, [int(units[d].sum()) for d in todo])
            element = np.concatenate([np.repeat(elements[d], units[d]) for d in todo])
            unit = np.concatenate([np.arange(int(u.sum())) - np.repeat(np.cumsum(u) - u, u) for u in (units[d] for d in todo)])
            left = np.concatenate([np.repeat(weights[d], units[d]) for d in todo]) - unit
            region = mixed(element + (unit.astype(np.uint64) * np.uint64(1 << 20) + np.uint64(level + 1)) * _STEP)
            darts = _poisson(region, high - low)
            owner, left, region = (np.repeat(a, darts) for a in (owner, left, region))
            nth = np.arange(len(region)) - np.repeat(np.cumsum(darts) - darts, darts)
            identity = mixed(region + (nth.astype(np.uint64) + np.uint64(1)) * _STEP)
            if len(owner) and left.min(initial=1) < 1:
                within = (mixed(identity ^ _STEP) >> np.uint64(11)) * 2.0**-53 < left
                owner, identity = owner[within], identity[within]
            rank = mixed(identity + _STEP)
            key = owner * size + (identity % np.uint64(size)).astype(np.int64)
            latest = np.argsort(rank, kind="stable")[::-1]  # the lowest rank is written last
            fresh = ~filled.ravel()[key[latest]]
            key, identity = key[latest][fresh], identity[latest][fresh]
            signatures.ravel()[key] = identity
            filled.ravel()[key] = True
            todo = todo[(~filled[todo]).any(axis=1)]
            level, low, high = level + 1, high, high + min(high, 16)
    return signatures


def _poisson(region: np.ndarray, mean: float) -> np.ndarray:
    """A Poisson number per region, from its hash."""
    u = (mixed(region ^ np.uint64(0xD1B54A32D192ED03)) >> np.uint64(11)) * 2.0**-53
    count, k, term = np.zeros(len(u), dtype=np.int64), 0, np.exp(-mean)
    below = term
    while k < 80 and (more := u >= below).any():
        count += more
        k += 1
        term *= mean / k
        below += term
    return count


def bands_of(signatures: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit value per band, different between bands."""
    n, size = signatures.shape
    cut = signatures.reshape(n, size // rows, rows)
    with np.errstate(over="ignore"):
        total = np.arange(1, size // rows + 1, dtype=np.uint64)[None, :] * _STEP
        for i in range(rows):
            total = mixed(total ^ cut[:, :, i])
    return total.view(np.int64)


SIGNED = "doc_id bigint, mark bigint, node bigint, n bigint, bands array<bigint>"


def signed_documents(docs: DataFrame, weighted: bool = False, bands: int = BANDS) -> DataFrame:
    """doc_id, mark, node (digest of the shingle set; null for an empty text), n (its size), bands.

    Weights are 1, or the numbers of times that a shingle comes if ``weighted``. A text that is not empty but has no
    word is a set of its own text.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), _BATCH):
                part = batch.slice(start, _BATCH)
                yield _signed(part, weighted, bands)

    needed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")
    return needed.mapInArrow(returning_memory(rows), SIGNED)


def _signed(batch: pa.RecordBatch, weighted: bool, bands: int) -> pa.RecordBatch:
    texts = [t or "" for t in batch.column("text").to_pylist()]
    found = [np.unique(h, return_counts=True) for h in shingle_hashes(texts)]
    some = [i for i, (h, _) in enumerate(found) if len(h)]
    weights = [found[i][1].astype(np.float64) if weighted else np.ones(len(found[i][0])) for i in some]
    values = bands_of(dart_signatures([found[i][0] for i in some], weights, bands * ROWS)) if some else np.zeros((0, bands), np.int64)
    of_row: list = [[] for _ in texts]
    for i, v in zip(some, values.tolist()):
        of_row[i] = v
    nodes = [_digest(h.tobytes() + (c.tobytes() if weighted else b"")) if len(h)
             else _digest(t.encode("utf-8", "replace"), b"text") if t else None for t, (h, c) in zip(texts, found)]
    return pa.RecordBatch.from_arrays([
        batch.column("doc_id"), batch.column("mark"), pa.array(nodes, pa.int64()),
        pa.array([len(h) for h, _ in found], pa.int64()), pa.array(of_row, pa.list_(pa.int64()))],
        names=["doc_id", "mark", "node", "n", "bands"])


def _digest(data: bytes, person: bytes = b"") -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8, person=person).digest(), "little", signed=True)


_COMPARED = T.StructType([T.StructField("near", T.DoubleType()), T.StructField("diff", T.ArrayType(T.IntegerType()))])


@F.pandas_udf(_COMPARED)
def _compared(centre: pd.Series, other: pd.Series) -> pd.DataFrame:
    """Jaccard similarity, and in what the other set differs: its own elements, then those it lacks."""
    near, diff = [], []
    for c, x in zip(centre, other):
        own = np.setdiff1d(x, c, assume_unique=True)
        union = len(c) + len(own)
        near.append((len(x) - len(own)) / max(union, 1))
        diff.append(np.concatenate([own, np.setdiff1d(c, x, assume_unique=True)]))
    return pd.DataFrame({"near": near, "diff": diff})


@F.pandas_udf(T.DoubleType())
def _similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    common = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(a, b)]
    return pd.Series([n / max(len(x) + len(y) - n, 1) for n, x, y in zip(common, a, b)], dtype="float64")


def _elements(hashes: np.ndarray, weighted: bool) -> np.ndarray:
    """Sorted 32-bit elements of a set; with weights, the k-th time of a shingle is an element of its own."""
    if weighted and len(hashes):
        hashes = np.sort(hashes)
        fresh = np.concatenate([[True], hashes[1:] != hashes[:-1]])
        first = np.flatnonzero(fresh)
        nth = np.arange(len(hashes)) - np.repeat(first, np.diff(np.concatenate([first, [len(hashes)]])))
        with np.errstate(over="ignore"):
            hashes = mixed(hashes + nth.astype(np.uint64) * _STEP)
    return np.unique((hashes >> np.uint64(32)).astype(np.uint32).view(np.int32))


def _shingle_sets(texts: DataFrame, weighted: bool) -> DataFrame:
    """node, elements of one text per node."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), _BATCH):
                part = batch.slice(start, _BATCH)
                found = [_elements(h, weighted) for h in shingle_hashes([t or "" for t in part.column("text").to_pylist()])]
                ends = np.concatenate([[0], np.cumsum([len(h) for h in found])]).astype(np.int32)
                flat = np.concatenate(found) if found else np.zeros(0, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=["node", "elements"])

    return texts.mapInArrow(returning_memory(rows), "node bigint, elements array<int>")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, weighted: bool = False, bands: int = BANDS) -> DataFrame:
    """doc_id, mark, class_id, class_key, copies: one row per row of ``docs``.

    Documents whose shingle sets have a (weighted) Jaccard similarity of at least ``similarity`` are linked, and linked
    documents form a class, named by its smallest doc_id. ``mark`` is the hash of the text, ``copies`` the number of
    rows with the same shingle set, ``class_key`` a number that no other class has.

    Null and empty texts are classes of their own, without a key. Null ids never name a class unless all its ids are null. Repeated
    rows are copies. Other columns are not looked at.
    """
    small_batches(docs.sparkSession)
    signed = written(signed_documents(docs, weighted, bands), "signed")
    known = signed.filter("node IS NOT NULL")
    nodes = written(
        known.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), F.max("n").alias("n"),
                                  F.min(F.struct(_row_id().alias("row_id"), "mark")).alias("row")), "nodes")
    ranked = written(_ranked(known), "ranked-bands")
    sets = written(_shingle_sets(_one_text_each(docs, nodes.join(ranked.select("node"), "node", "left_semi")), weighted), "shingle-sets")

    def with_sets(pairs: DataFrame) -> DataFrame:
        one = sets.select(F.col("node").alias("a"), F.col("elements").alias("xs"))
        two = sets.select(F.col("node").alias("b"), F.col("elements").alias("ys"))
        return join_per_key(pairs, one, ["a"], "inner").join(two, "b")  # a may be a centre of many, b is in few stars

    centres = written(_centres(ranked), "centres")
    sized = with_sets(_stars(ranked, centres)).withColumns({"na": F.size("xs"), "nb": F.size("ys"), "c": _compared("xs", "ys")})
    stars = written(sized.select("a", "b", "na", "nb", "c.*"), "stars")
    links = stars.filter(F.col("near") >= similarity).select("a", "b")
    labels = connected_components(links)
    left = ranked
    for _ in range(ROUNDS):
        left = written(_open_members(left, centres, labels), "open-members")
        fresh = written(_centres(left), "centres")
        if fresh.isEmpty():
            break
        found = with_sets(_stars(left, fresh)).filter(_similarity("xs", "ys") >= similarity).select("a", "b")
        links = written(links.unionByName(found), "links-so-far")
        labels = connected_components(links)
        centres = centres.unionByName(fresh)
    apart = _pairs_apart(stars, labels, similarity)
    near = with_sets(apart).filter(_similarity("xs", "ys") >= similarity).select("a", "b")
    more = written(near, "cross-links")
    if not more.isEmpty():
        labels = connected_components(links.unionByName(more))
    return _classes(signed, nodes, labels)


def _row_id():
    """The id, a number for a null one too."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))


def _one_text_each(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, text: the text of one row of each wanted node."""
    rows = small_side(wanted.select("node", "row.*"), "wanted")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").select(
        _row_id().alias("row_id"), F.xxhash64("text").alias("mark"), "text")
    once = Window.partitionBy("row_id", "mark").orderBy("row_id")
    met = texts.join(rows, ["row_id", "mark"]).withColumn("i", F.row_number().over(once))
    return met.filter("i = 1").select("node", "text")


def _ranked(known: DataFrame) -> DataFrame:
    """node, band, reach of bands that several nodes share. Reach: how many documents the shared bands of a node hold
    together. The text that others were made of, where there is one, reaches the most."""
    members = known.select("node", F.explode("bands").alias("band"))
    buckets = members.groupBy("band").agg(F.min("node").alias("least"), F.max("node").alias("last"), F.count("*").alias("size"))
    sizes = buckets.filter("least <> last").select("band", "size")
    shared = join_per_key(members, sizes, ["band"], "inner").distinct()
    return shared.select("node", "band", F.sum("size").over(Window.partitionBy("node")).alias("reach"))


def _centres(ranked: DataFrame) -> DataFrame:
    """band, centre: of bands of several nodes, that of the greatest reach."""
    tops = ranked.groupBy("band").agg(F.max(F.struct("reach", "node")).alias("top"), F.count("*").alias("size"))
    return tops.filter("size > 1").select("band", F.col("top.node").alias("centre"))


def _stars(ranked: DataFrame, centres: DataFrame) -> DataFrame:
    """a, b: in each band, the links of its centre (a) to the others."""
    met = join_per_key(ranked, centres, ["band"], "inner").filter("node <> centre")
    return met.select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()


def _labelled(rows: DataFrame, node: str, labels: DataFrame) -> DataFrame:
    """The rows with the label of a node, itself if it has none; a node is in few of the rows."""
    own = labels.select(F.col("node").alias(node), "label")
    return rows.join(own, node, "left").withColumn("label", F.coalesce("label", node))


def _open_members(ranked: DataFrame, centres: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``ranked`` outside the components of all centres that their band has had. What was left out before stays
    out, as components only grow."""
    taken = _labelled(centres, "centre", labels).select("band", "label")
    return join_per_key(_labelled(ranked, "node", labels), taken, ["band", "label"], "left_anti").select(*ranked.columns)


def _pairs_apart(stars: DataFrame, labels: DataFrame, t: float) -> DataFrame:
    """Pairs a < b that may be similar, compared with one centre c, not both linked to it, in different components.

    Let Dx and Dy be the sizes of the symmetric differences of x and y with c, S the size of what these have in common
    and r = (1 - t) / (1 + t). Similarity t means that x and y differ in at most r (|x| + |y|) elements, that is
    2 S >= Dx + Dy - r (|x| + |y|). If x is not linked to c, Dx > r (|x| + |c|), so 2 S > Dy + r (|c| - |y|). What Dx has
    and Dy has not is a difference of x and y, and |y| <= |x| / t, so S >= Dx - r (|x| + |y|) >= Dx - (1 - t) / t |x|;
    likewise S >= Dy - (1 - t) / t |y|. Hence, in any fixed order, the first element that both differences have is among the
    first D - S + 1 of either. Differences are ordered by their number in the star, the rarest first: what many members
    have in common comes last, where hardly any pair can begin with it. A pair is met only where enough can follow.
    """
    r = (1 - t) / (1 + t)
    open_centres = stars.filter(F.col("near") < t).select("a").distinct()
    around = join_per_key(stars, open_centres, ["a"], "left_semi").filter(F.size("diff") > 0)
    around = _labelled(around.withColumnRenamed("b", "node"), "node", labels)
    around = written(around.select("a", "node", "label", "near", "na", F.col("nb").alias("n"),
                                   F.size("diff").alias("d"), "diff"), "differences")
    around = written(_rarest_first(around), "ordered-differences")
    own = F.ceil(F.col("d") - (1 - t) / t * F.col("n") - 1e-6)
    of_linked = F.ceil((F.col("d") + r * (F.col("na") - F.col("n"))) / 2 - 1e-6)

    def first(least):
        return F.slice("diff", F.lit(1), F.greatest(F.col("d") - F.greatest(least, F.lit(1)) + 1, F.lit(0)).cast("int"))

    x = around.filter(F.col("near") < t).select("a", *[F.col(c).alias(c + "x") for c in ("node", "label", "n", "d")], F.posexplode(first(own)).alias("ix", "e"))
    y = around.select("a", *[F.col(c).alias(c + "y") for c in ("node", "label", "n", "d")], F.posexplode(first(F.greatest(own, of_linked))).alias("iy", "e"))
    common = (F.col("dx") + F.col("dy") - r * (F.col("nx") + F.col("ny"))) / 2
    enough = F.least(F.col("dx") - F.col("ix"), F.col("dy") - F.col("iy")) >= common - 1e-6
    sizes = (F.col("nx") >= t * F.col("ny")) & (F.col("ny") >= t * F.col("nx"))
    met = x.join(y, ["a", "e"]).filter((F.col("nodex") != F.col("nodey")) & (F.col("labelx") != F.col("labely")) & sizes & enough)
    return met.select(F.least("nodex", "nodey").alias("a"), F.greatest("nodex", "nodey").alias("b")).distinct()


def _rarest_first(around: DataFrame) -> DataFrame:
    """The rows with each difference in order of its number of members in the star, then of its value."""
    posted = around.select("a", "node", F.explode("diff").alias("e"))
    counts = posted.groupBy("a", "e").agg(F.count("*").alias("times")).filter("times > 1")
    counted = join_per_key(posted, counts, ["a", "e"], "left")
    entry = F.struct(F.coalesce("times", F.lit(1)).alias("times"), "e")
    ordered = counted.groupBy("a", "node").agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    return around.drop("diff").join(ordered.select("a", "node", F.col("entries.e").alias("diff")), ["a", "node"])


def _classes(signed: DataFrame, nodes: DataFrame, labels: DataFrame) -> DataFrame:
    of_node = _labelled(nodes.select("node", "first_id", "copies"), "node", labels)
    names = of_node.groupBy("label").agg(F.min("first_id").alias("class_id"))
    named = join_per_key(of_node, names, ["label"], "left").select(
        "node", "class_id", F.col("label").alias("class_key"), "copies")
    rows = join_per_key(signed.select("doc_id", "mark", "node"), named, ["node"], "left")
    return rows.select(
        "doc_id", "mark", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        "class_key", F.coalesce("copies", F.lit(1)).alias("copies"))


def first_of_classes(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay when each class of :func:`near_duplicates` keeps one; all columns as they are.

    Of a class the first by id (null last), then by text hash, stays; of rows alike in both, any one. Null and empty
    texts all stay.
    """
    place = F.struct(F.col("doc_id").isNull().alias("missing"), _row_id().alias("row_id"), "mark")
    firsts = classes.filter("class_key IS NOT NULL").groupBy("class_key").agg(F.min(place).alias("first")).select("first.row_id", "first.mark")
    row_id, mark, nth = free_names(docs, "_row_id", "_mark", "_nth")
    chosen = firsts.withColumnsRenamed({"row_id": row_id, "mark": mark})
    keyed = docs.withColumns({row_id: _row_id(), mark: F.xxhash64("text")})
    once = Window.partitionBy(row_id, mark).orderBy(row_id)
    met = keyed.join(chosen, [row_id, mark]).withColumn(nth, F.row_number().over(once))
    empty = docs.filter("text IS NULL OR text = ''")
    return met.filter(F.col(nth) == 1).select(*docs.columns).unionByName(empty)
