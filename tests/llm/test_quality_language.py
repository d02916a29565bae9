"""Classifier and language profiles: held-out accuracy, flat trees against a plain walk, defined edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelog.llm.language import LetterVectors, identify_language, text_vector, windows
from tidelog.llm.quality import STATISTICS, Forest, fit_quality, grow_forest, score_quality, text_statistics

SF = "/root/testdata/sf0.01"


def walk(forest: Forest, x):
    total = forest.base
    for node in forest.roots:
        while forest.left[node] != node:
            node = forest.left[node] if x[forest.feature[node]] <= forest.cut[node] else forest.right[node]
        total += forest.value[node]
    return 1 / (1 + np.exp(-total))


def test_flat_trees_equal_a_plain_walk():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 5))
    y = ((x[:, 0] > 0.2) ^ (x[:, 3] > -0.5)).astype(float)
    forest = grow_forest(x, y, trees=15)
    assert np.allclose(forest.score(x), [walk(forest, row) for row in x])
    assert ((forest.score(x) > 0.5) == (y > 0.5)).mean() > 0.95


def brute_boosting(x, y, trees, depth, bins, rate=0.15, leaf_weight=2.0, ridge=1.0):
    """Scores of the rows learned from: every cut of every node is tried on the rows themselves."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    margin = np.full(len(y), np.log(share / (1 - share)))
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in x.T]

    def grown(inside, levels, grad, hess, add):
        def loss_cut(mask):
            return grad[mask].sum() ** 2 / (hess[mask].sum() + ridge)

        best, sides = 1e-6, None
        for f, of_feature in enumerate(cuts if levels else []):
            for cut in of_feature:
                left, right = inside & (x[:, f] <= cut), inside & (x[:, f] > cut)
                if min(hess[left].sum(), hess[right].sum()) >= leaf_weight:
                    gain = loss_cut(left) + loss_cut(right) - loss_cut(inside)
                    if gain > best + 1e-9:
                        best, sides = gain, (left, right)
        if sides is None:
            add[inside] = rate * grad[inside].sum() / (hess[inside].sum() + ridge)
            return
        for side in sides:
            grown(side, levels - 1, grad, hess, add)

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        add = np.zeros(len(y))
        grown(np.ones(len(y), dtype=bool), depth, y - p, p * (1 - p), add)
        margin = margin + add
    return 1 / (1 + np.exp(-margin))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_grown_trees_equal_a_search_over_all_cuts(seed):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=300), rng.integers(0, 6, 300), rng.exponential(size=300), np.ones(300)])
    y = ((x[:, 0] + 0.3 * x[:, 1] - x[:, 2] + rng.normal(scale=0.5, size=300)) > 0.4).astype(float)
    forest = grow_forest(x, y, trees=8, depth=3, bins=16)
    assert len(forest.roots) == 8 and (forest.left != np.arange(len(forest.left))).sum() > 16
    assert np.allclose(forest.score(x), brute_boosting(x, y, trees=8, depth=3, bins=16))


@pytest.mark.parametrize("y, expected", [([], 0.5), ([1, 1, 1], 3.5 / 4)])
def test_forest_without_two_classes(y, expected):
    forest = grow_forest(np.zeros((len(y), 2)), np.array(y, dtype=float))
    assert np.allclose(forest.score(np.zeros((2, 2))), expected)


def test_statistics_of_odd_texts():
    for text in (None, "", " ", "\n\n", "\x00", "a" * 100_000, "é" * 1000, "||||"):
        values = text_statistics(text)
        assert len(values) == len(STATISTICS) and np.isfinite(values).all()


def test_quality_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = score_quality(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.95


def test_quality_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, "x"), (1, None, "x"), (None, "good text here", "y"), (2, "", "z")], "doc_id bigint, text string, score string")
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 7)], "doc_id bigint, quality int")
    rows = score_quality(docs, labels).collect()
    assert len(rows) == 4 and {r["score"] for r in rows} == {0.5}
    assert [r["held_out"] for r in rows if r["doc_id"] is None] == [False]
    assert score_quality(docs.limit(0), labels).count() == 0


def brute_vector(text, letters):
    kept = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    line = " " + " ".join(kept) + " "
    total = np.zeros(letters.rotated.shape[2])
    for trio in zip(line, line[1:], line[2:]):
        rows = [letters.rows(np.array([ord(c)]))[0] for c in trio]
        total += letters.rotated[0][rows[0]].astype(int) * letters.rotated[1][rows[1]] * letters.rotated[2][rows[2]]
    return total / np.sqrt((total**2).sum())


def test_text_vector_against_a_loop():
    letters = LetterVectors()
    text = "Été 12 chat!! noir, ébène\n x"
    assert np.allclose(text_vector(text, letters), brute_vector(text, letters))
    assert windows("12 !?") is None and windows(None) is None


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = identify_language(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) > 0.97


def test_language_edge_cases(spark):
    docs = spark.createDataFrame(
        [(1, "the cat and the dog", "en", 0), (1, "the cat and the dog", "en", 0), (None, "le chat et le chien", "fr", 1),
         (7, None, "en", 2), (8, "123 --", None, 3), (9, "the dog", None, 4)], "doc_id bigint, text string, lang string, score int")
    rows = {(r["doc_id"], r["lang_pred"]): r["score"] for r in identify_language(docs).collect()}
    assert set(rows) == {(1, "en"), (None, "fr"), (7, "und"), (8, "und"), (9, "en")}
    assert rows[7, "und"] == 0 and all(0 <= s <= 1 for s in rows.values())
    unknown = identify_language(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in unknown.collect()} == {"und"}
    assert identify_language(docs.limit(0)).count() == 0


def test_sample_does_not_depend_on_how_rows_are_dealt(spark):
    """One labelled document repeated thousands of times neither crowds the others out nor makes the order matter."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    one = docs.join(labels.select("doc_id"), "doc_id").orderBy("doc_id").limit(1)
    copies = one.crossJoin(spark.range(4000)).drop("id")
    first, last = (fit_quality(d, labels, max_labelled=200) for d in (copies.union(docs), docs.union(copies).repartition(7)))
    plain = fit_quality(docs, labels, max_labelled=200)
    for forest in (first, last):
        assert forest.value.tolist() == plain.value.tolist() and forest.cut.tolist() == plain.cut.tolist()
    assert len(set(plain.value.tolist())) > 10
