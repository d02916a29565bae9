"""Line deduplication, near duplicates, components and fingerprints against brute force."""

import random
import re

import numpy as np
import pytest

from tidelog.llm.components import connected_components
from tidelog.llm.fingerprint import Sketches, digests, edited_text, fingerprint_documents, likeness, with_successor
from tidelog.llm.linedup import common_blocks, dedup_lines, patience
from tidelog.llm.neardup import bands_of, dart_signatures, first_of_classes, near_duplicates, shingle_hashes


def test_patience_is_a_rising_alignment():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.randint(0, 8) for _ in range(rng.randint(0, 14))] for _ in range(2))
        found = patience(a, b)
        assert all(a[i] == b[k] for i, k in found)
        assert all(i < j and k < m for (i, k), (j, m) in zip(found, found[1:]))


@pytest.mark.parametrize("a, b, gone", [
    ([1, 2, 3], [1, 2, 3], [0, 1, 2]), ([1, 2, 3], [3, 9, 1, 2], [0, 2, 3]), ([1], [1, 1, 1], [0, 1, 2]), ([], [1], []), ([5], [], [])])
def test_common_blocks(a, b, gone):
    assert common_blocks(a, b, [5] * len(b)) == gone
    assert common_blocks(a, b, [1] * len(b), 100) == []


def words(i, n=6):
    rng = random.Random(i)
    return " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(n))


def test_lines_against_brute_force(spark):
    rng = random.Random(2)
    pool = [words(i) for i in range(30)] + ["short", "", "three little words"]
    docs = [(i, "\n".join(rng.choice(pool) if rng.random() < 0.5 else words(1000 + i * 50 + k) for k in range(rng.randint(0, 9)))) for i in range(120)]
    docs += [(200, docs[3][1]), (200, docs[3][1]), (201, None), (None, docs[5][1])]
    frame = spark.createDataFrame([(i, t, 5) for i, t in docs], "doc_id bigint, text string, n_deleted int")
    rows = dedup_lines(frame).collect()
    first = {}
    for i, text in sorted(docs, key=lambda d: (d[0] is None, d[0])):
        for line in (text or "").split("\n"):
            if len(line.split()) >= 4:
                first.setdefault(line, i)
    assert len(rows) == len(docs)
    texts = {}
    for i, text in docs:
        texts.setdefault(i, text)
    for r in rows:
        kept = [x for x in (r["text"] or "").split("\n") if len(x.split()) >= 4]
        wanted = [x for x in (texts[r["doc_id"]] or "").split("\n") if len(x.split()) >= 4 and first[x] == r["doc_id"]]
        assert kept == wanted
        assert (r["n_deleted"] == 0) == (r["text"] == texts[r["doc_id"]])
    assert dedup_lines(frame.limit(0)).count() == 0


def brute_gone(later, earlier, min_words=4):
    """Positions in a run of lines, of so many words, that an earlier document holds too."""
    held = {tuple(e[i:j]) for e in earlier for i in range(len(e)) for j in range(i + 1, len(e) + 1)}
    n, size = len(later), lambda x: max(len(x.split()), len(x) // 5)
    return {y for i in range(n) for j in range(i + 1, n + 1) if tuple(later[i:j]) in held and sum(map(size, later[i:j])) >= min_words
            for y in range(i, j)}


def test_short_lines_inside_blocks_against_brute_force(spark):
    rng = random.Random(9)
    pool = ["a", "b", "c d", "", "e f g", "Home", "us", words(1), words(2), words(3)]
    docs = [[words(7)], [words(7), "Home", "About us", "Contact"], [words(7), "Home", "About us", "Contact"]]
    docs += [[rng.choice(pool) for _ in range(rng.randint(1, 8))] for _ in range(70)]
    frame = spark.createDataFrame([(i, "\n".join(d)) for i, d in enumerate(docs)], "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in dedup_lines(frame).collect()}
    assert found[2]["n_deleted"] == 4
    for i, d in enumerate(docs):
        gone = brute_gone(d, docs[:i])
        assert found[i]["text"] == "\n".join(x for y, x in enumerate(d) if y not in gone), i


@pytest.mark.parametrize("line, goes", [
    ("\u8fd9\u662f\u4e00\u884c\u6ca1\u6709\u7a7a\u683c" * 3, True), ("\u8fd9\u662f\u4e00\u884c", False), ("a\u00a0b\u3000c\u2003d", True),
    ("a     b", False), ("a  \u3000 b\t\tc", False), ("All rights reserved.", True), ("Rights reserved.", False)])
def test_words_of_any_script(spark, line, goes):
    frame = spark.createDataFrame([(i, f"own{i}\n{line}") for i in range(3)], "doc_id bigint, text string")
    found = {r["doc_id"]: r["n_deleted"] for r in dedup_lines(frame).collect()}
    assert found == {0: 0, 1: int(goes), 2: int(goes)}


def shingles(text):
    found = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").lower().encode())
    return frozenset(tuple(found[i:i + 5]) for i in range(max(len(found) - 4, 1))) if found else None


def test_shingles_are_told_apart():
    texts = ["a b c d e f", "A, b; c d e f!", "b a c d e f", "a b", "a b c", "", "...", "x " * 1000]
    hashes = [frozenset(h.tolist()) for h in shingle_hashes(texts)]
    for i, x in enumerate(texts):
        for j, y in enumerate(texts):
            assert (hashes[i] == hashes[j]) == ((shingles(x) or frozenset()) == (shingles(y) or frozenset()))


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(4)
    keys = rng.integers(0, 2**63, 300).astype(np.uint64)
    a, b = rng.uniform(0.1, 3, 300), rng.uniform(0.1, 3, 300)
    sigs = dart_signatures([keys, keys, keys[:1]], [a, b, np.ones(1)], 2000)
    wanted = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((sigs[0] == sigs[1]).mean() - wanted) < 0.04
    assert bands_of(sigs[:2], 5).shape == (2, 400)


def brute_classes(docs, t=0.8):
    parent = {i: i for i, _ in docs}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    sets = {i: shingles(t) for i, t in docs}
    for i, x in sets.items():
        for j, y in sets.items():
            if j < i and x and y and len(x & y) >= t * len(x | y):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in parent}


@pytest.fixture(scope="module")
def copies():
    """Groups of edited copies around the threshold, so that stars alone do not hold them together."""
    rng = random.Random(6)
    docs = []
    for group in range(12):
        base = [f"g{group}x{rng.randint(0, 10**6)}" for _ in range(rng.choice([30, 60, 120]))]
        for _ in range(rng.randint(1, 14)):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                own[rng.randrange(len(own))] = f"e{rng.randint(0, 10**6)}"
            docs.append((len(docs), " ".join(own)))
    return docs + [(900, ""), (901, ""), (902, "..."), (903, "..."), (904, "two words"), (905, "Two, words")]


@pytest.mark.parametrize("weighted", [False, True])
def test_near_duplicates_against_brute_force(spark, copies, weighted):
    frame = spark.createDataFrame([(i, t, "x") for i, t in copies], "doc_id bigint, text string, node string")
    found = {r["doc_id"]: r["class_id"] for r in near_duplicates(frame, weighted=weighted).collect()}
    wanted = brute_classes(copies)
    wanted[903] = 902
    assert found == wanted


def test_first_of_classes(spark, copies):
    docs = [*copies, (3, copies[3][1]), (None, copies[0][1]), (None, None)]
    frame = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id bigint, text string, mark string")
    kept = first_of_classes(frame, near_duplicates(frame)).collect()
    wanted = brute_classes(copies)
    wanted[903] = 902
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == sorted(set(wanted.values()))
    assert [r["text"] for r in kept if r["doc_id"] is None] == [None] and kept[0]["mark"] == "x"
    assert first_of_classes(frame.limit(0), near_duplicates(frame.limit(0))).count() == 0


def test_components(spark):
    rng = random.Random(7)
    links = [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(60)] + [(i, i + 1) for i in range(200, 240)] + [(5, 5)]
    parent = {x: x for pair in links for x in pair}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    rows = {r["node"]: r["label"] for r in connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert set(rows) == linked
    assert all((rows[x] == rows[y]) == (find(x) == find(y)) for x in linked for y in linked)


def test_likeness_is_exact():
    rng = random.Random(8)
    lines = [words(i) + "." for i in range(60)]
    texts = [" ".join(rng.choice(lines) for _ in range(rng.randint(0, 70))) for _ in range(80)] + ["", "x" * 1000]
    sets = [digests(t) for t in texts]
    for shift in (0, 1, 7):
        other = sets[shift:] + sets[:shift]
        wanted = [1.0 if not len(a) + len(b) else len(np.intersect1d(a, b)) / len(np.union1d(a, b)) for a, b in zip(sets, other)]
        assert np.allclose(likeness(sets, other), wanted)
    assert Sketches([sets[0]], 24).texts() == Sketches([digests(texts[0])], 24).texts()


@pytest.mark.parametrize("buckets", [1, 8])
def test_fingerprints_follow_falling_ids(spark, buckets, monkeypatch):
    docs = [(i * 3 % 101, words(i, 20) * (i % 3)) for i in range(60)] + [(None, "no id"), (500, None)]
    frame = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id bigint, text string, n_chars int").repartition(5)
    rows = {r["doc_id"]: r for r in fingerprint_documents(frame).collect()}
    order = sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0)))
    import hashlib
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        edited = edited_text(text or "", after or "")
        assert rows[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert rows[i]["n_chars"] == len(text or "")
    alone = fingerprint_documents(frame.filter("doc_id = 500")).collect()
    assert len(alone) == 1 and alone[0]["near_next"] == 1.0
    assert fingerprint_documents(frame.limit(0)).count() == 0


@pytest.mark.parametrize("buckets", [1, 20, 200])
def test_successors_where_ids_are_missing_or_repeated(spark, buckets):
    """A third without an id and a third under one id are spread over buckets, and still follow each other in order."""
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"text {i % 80 if i % 2 else i}") for i in range(600)]
    rows += [(2**63 - 1, "greatest"), (2**63 - 1, "greatest too"), (-(2**63), None)]
    found = with_successor(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5), buckets).collect()
    by_bucket = {}
    for r in found:
        by_bucket.setdefault(r["bucket"], []).append(r)
    own = [[r for r in by_bucket[b] if not r["guest"]] for b in sorted(by_bucket)]
    flat = [(r["doc_id"], r["text"]) for rows_of in own for r in rows_of]
    assert sorted(flat, key=str) == sorted(((i, t or "") for i, t in rows), key=str)
    places = [(i is None, -(i or 0)) for i, _ in flat]
    assert places == sorted(places)
    for here, after in zip(sorted(by_bucket), own[1:] + own[:1]):
        guests = [r for r in by_bucket[here] if r["guest"]]
        assert by_bucket[here][-len(guests):] == guests and len(guests) > 0
        assert {(r["doc_id"], r["text"]) for r in guests} == {(after[0]["doc_id"], after[0]["text"])}
    if buckets == 20:
        assert max(len(x) for x in own) < 100


def test_likeness_in_lots(monkeypatch):
    rng = random.Random(9)
    sets = [digests(" ".join(words(rng.randint(0, 300)) + "." for _ in range(rng.randint(0, 90)))) for _ in range(30)]
    whole = likeness(sets, sets[1:] + sets[:1])
    monkeypatch.setattr("tidelog.llm.fingerprint._CELLS_AT_ONCE", 200)
    assert likeness(sets, sets[1:] + sets[:1]).tolist() == whole.tolist()
