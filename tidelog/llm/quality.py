"""Quality classifier: histogram gradient-boosted trees over statistics of whole texts.

The trees are grown on the driver from a bounded sample of labelled rows (``max_labelled``); their statistics are
computed by Spark tasks. A grown forest is a few flat arrays, and scoring walks all rows of a batch through all trees
at once, a level at a time.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import bounded_sample, crc_remainder, small_batches

STATISTICS = (
    "log_chars", "log_words", "mean_word", "longest_word", "upper_share", "digit_share", "mark_share", "symbol_share",
    "bar_per_word", "shout_per_word", "stop_per_word", "comma_per_word", "non_ascii_share", "distinct_words",
    "top_word_share", "same_as_last_word", "capital_words", "log_lines", "words_per_line", "repeated_lines",
    "short_lines", "byte_entropy", "distinct_pairs",
)
_SYMBOLS = np.frombuffer(b"#$%&*+/<=>@\\^_`{|}~[]", dtype=np.uint8)
_MARKS = np.frombuffer(b"!\"'(),-.:;?", dtype=np.uint8)


def text_statistics(text: str | None) -> list[float]:
    """The statistics of one whole text; all zero for a null or empty text."""
    if not text:
        return [0.0] * len(STATISTICS)
    raw = text.encode("utf-8", "replace")
    by_byte = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    upper, lower = int(by_byte[65:91].sum()), int(by_byte[97:123].sum())
    non_ascii = int(by_byte[192:].sum())
    chars, words = len(text), text.split()
    n = max(len(words), 1)
    counts = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    lines = [line for line in text.split("\n") if line.strip()]
    n_lines = max(len(lines), 1)
    share = by_byte[by_byte > 0] / len(raw)
    return [
        float(np.log1p(chars)), float(np.log1p(len(words))), sum(map(len, words)) / n,
        float(min(max(map(len, words), default=0), 200)),
        upper / max(upper + lower + non_ascii, 1), int(by_byte[48:58].sum()) / chars, int(by_byte[_MARKS].sum()) / chars,
        int(by_byte[_SYMBOLS].sum()) / chars, int(by_byte[124]) / n, int(by_byte[33]) / n, int(by_byte[46]) / n,
        int(by_byte[44]) / n, non_ascii / chars, len(counts) / n, max(counts.values(), default=0) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n, sum(w[0].isupper() for w in words) / n,
        float(np.log1p(len(lines))), len(words) / n_lines, 1.0 - len(set(lines)) / n_lines,
        sum(len(line) < 30 for line in lines) / n_lines, float(-(share * np.log2(share)).sum()), pairs / n,
    ]


def statistics_matrix(texts) -> np.ndarray:
    return np.array([text_statistics(t) for t in texts], dtype=np.float64).reshape(-1, len(STATISTICS))


@dataclass(frozen=True)
class Forest:
    """Trees as flat arrays: node i asks ``x[feature] <= cut``; a leaf points to itself and has a value."""

    base: float
    depth: int
    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities; rows and trees advance together, one level a step."""
        if not len(self.roots):
            return np.full(len(x), 1 / (1 + np.exp(-self.base)))
        rows = np.arange(len(x))[:, None]
        node = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        for _ in range(self.depth):
            goes_left = x[rows, self.feature[node]] <= self.cut[node]
            node = np.where(goes_left, self.left[node], self.right[node])
        return 1 / (1 + np.exp(-(self.base + self.value[node].sum(axis=1))))


def grow_forest(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, bins: int = 64, rate: float = 0.15,
                leaf_weight: float = 2.0, ridge: float = 1.0) -> Forest:
    """Newton boosting of the logistic loss on histograms. Ties go to the first feature, then the lowest cut.

    Without rows the score is 0.5 for all; with one class only it is that class's smoothed share.
    """
    rate_of_ones = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(rate_of_ones / (1 - rate_of_ones)))
    columns: dict[str, list] = {k: [] for k in ("feature", "cut", "left", "right", "value")}
    roots: list[int] = []

    def node() -> int:
        at = len(columns["feature"])
        for name, start in (("feature", 0), ("cut", np.inf), ("left", at), ("right", at), ("value", 0.0)):
            columns[name].append(start)
        return at

    if len(y) and 0 < y.sum() < len(y):
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
        margin = np.full(len(y), base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            grad, hess = y - p, np.maximum(p * (1 - p), 1e-9)
            roots.append(node())
            place, level = np.zeros(len(y), dtype=np.int64), [roots[-1]]
            leaf_of = np.full(len(y), roots[-1])
            for _ in range(depth):
                k = len(level)
                best = np.full(k, 1e-6)
                split: list[tuple[int, int] | None] = [None] * k
                live = place >= 0
                at = place[live]
                g_all, h_all = np.bincount(at, grad[live], k), np.bincount(at, hess[live], k)
                for f, c in enumerate(cuts):
                    if not len(c):
                        continue
                    cell = at * (len(c) + 1) + binned[live, f]
                    g = np.bincount(cell, grad[live], k * (len(c) + 1)).reshape(k, -1).cumsum(axis=1)[:, :-1]
                    h = np.bincount(cell, hess[live], k * (len(c) + 1)).reshape(k, -1).cumsum(axis=1)[:, :-1]
                    gain = (g**2 / (h + ridge) + (g_all[:, None] - g) ** 2 / (h_all[:, None] - h + ridge)
                            - (g_all**2 / (h_all + ridge))[:, None])
                    gain[(h < leaf_weight) | (h_all[:, None] - h < leaf_weight)] = -1
                    top = gain.argmax(axis=1)
                    for i in np.flatnonzero(gain[np.arange(k), top] > best):
                        best[i], split[i] = gain[i, top[i]], (f, int(top[i]))
                following, new_place = [], np.full(len(y), -1)
                for i, at_node in enumerate(level):
                    if split[i] is None:
                        continue
                    f, b = split[i]
                    mine = place == i
                    goes_left = mine & (binned[:, f] <= b)
                    columns["feature"][at_node], columns["cut"][at_node] = f, float(cuts[f][b])
                    for side, chosen in (("left", goes_left), ("right", mine & ~goes_left)):
                        columns[side][at_node] = child = node()
                        new_place[chosen], leaf_of[chosen] = len(following), child
                        following.append(child)
                place, level = new_place, following
                if not level:
                    break
            for leaf in np.unique(leaf_of):
                inside = leaf_of == leaf
                columns["value"][leaf] = rate * grad[inside].sum() / (hess[inside].sum() + ridge)
            margin += np.array(columns["value"])[leaf_of]
    return Forest(base, depth, np.array(roots, dtype=np.int64), np.array(columns["feature"], dtype=np.int64),
                  np.array(columns["cut"]), np.array(columns["left"], dtype=np.int64),
                  np.array(columns["right"], dtype=np.int64), np.array(columns["value"]))


def fit_quality(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000, held_out_of: int = 5) -> Forest:
    """Grows the forest from at most ``max_labelled`` labelled documents outside the held-out fold.

    A label that is neither 0 nor 1, or has a null id, counts for nothing. Of several labels of one id the greatest
    counts. Rows alike in id and text are one row of the sample. Where ids with several texts carry it past the bound,
    it is cut again in order of the ids' hashes, so the sample is the same however rows are dealt out.
    """
    small_batches(docs.sparkSession)
    known = (
        labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("label"))
        .filter(F.col("label").isin(0, 1) & (crc_remainder(F.col("id"), held_out_of) != 0))
        .groupBy("id").agg(F.max("label").alias("label"))
    )
    chosen = F.broadcast(bounded_sample(known, "id", max_labelled))  # bounded: max_labelled rows of two numbers
    statistics = F.pandas_udf(lambda texts: pd.Series(list(statistics_matrix(texts))), T.ArrayType(T.DoubleType()))
    rows = (
        docs.select(F.col("doc_id").alias("id"), "text").join(chosen, "id")
        .groupBy("id", "label", F.xxhash64("text").alias("mark")).agg(F.min("text").alias("text"))
        .select("id", "label", "mark", statistics("text").alias("x"))
        .orderBy(F.xxhash64("id"), "id", "mark").limit(max_labelled).collect()
    )
    rows.sort(key=lambda r: (r["id"], r["x"]))
    x = np.array([r["x"] for r in rows], dtype=np.float64).reshape(-1, len(STATISTICS))
    return grow_forest(x, np.array([r["label"] for r in rows], dtype=np.float64))


def quality_score(text: Column, forest: Forest) -> Column:
    """Probability that the text is labelled 1; null and empty texts have a score too."""
    return F.pandas_udf(lambda texts: pd.Series(forest.score(statistics_matrix(texts))), T.DoubleType())(text)


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_labelled: int = 20_000) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of ``docs``.

    Nulls: a null text scores like an empty one, a null id is not held out. Repeated rows score alike. Other columns
    of either table are not looked at.
    """
    forest = fit_quality(docs, labels, max_labelled)
    scored = docs.select(
        "doc_id", F.coalesce(crc_remainder(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        quality_score(F.col("text"), forest).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
