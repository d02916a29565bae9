"""Decontamination, collocations and hard negatives against brute force and against their SQL."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidelog.llm import collocations, decontam, negatives, tokens
from tidelog.llm.queries import op11, op12, op13
from tidelog.llm.registry import ORACLES
from tidelog.llm.topk import quantised

SF = "/root/testdata/sf0.001"
UPPER = {c: c + 32 for c in range(65, 91)}
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@pytest.mark.parametrize("query, name", [
    (op11, "op11_benchmark_decontamination"), (op12, "op12_phrase_collocations"), (op13, "op13_hard_negatives")])
def test_queries_against_sql(spark, query, name):
    base = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        base.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    found = query(spark, SF)
    columns = sorted(found.columns)
    wanted = base.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    key = lambda row: tuple((v is not None, str(v)) for v in row)
    got = sorted(map(tuple, found.select(*columns).collect()), key=key)
    assert got and got == sorted(wanted, key=key)


def _words(text, pattern=ALNUM):
    return re.findall(pattern, (text or "").translate(UPPER))


def test_words_and_keys():
    rng = random.Random(1)
    texts = ["".join(rng.choice(["a", "B", "é", "漢", " ", ",", "\n", "z9", "\x00"]) for _ in range(rng.randint(0, 30))) for _ in range(200)]
    texts += [None, "", "  ", "x" * 10_000, "," * 50, "end"]
    column = tokens.text_array(pa.array(texts))[3:]  # a slice has an offset
    words = tokens.words_of(column, tokens.ALPHANUMERIC)
    got = [(t, words.data[a:b].tobytes().decode()) for t, a, b in zip(words.text, words.starts, words.ends)]
    assert got == [(i, w) for i, text in enumerate(texts[3:]) for w in _words(text)]
    keys = dict(zip((w for _, w in got), tokens.word_keys(words).tolist()))
    assert len(set(keys.values())) == len(keys)
    whole = {w: k for (_, w), k in zip(got, tokens.word_keys(words).tolist())}
    assert whole == keys
    pieces = tokens.words_of(column, collocations.KINDS)
    shown = defaultdict(list)
    for t, p, a, b in zip(pieces.text, pieces.piece, pieces.starts, pieces.ends):
        shown[t, p].append(pieces.data[a:b].tobytes().decode())
    cut = [re.findall(r"[^ \t]+", part) for text in texts[3:] for part in re.split(r"[.,;:!?\n-\r]", (text or "").translate(UPPER))]
    assert list(shown.values()) == [c for c in cut if c]


def test_a_word_longer_than_a_chunk(monkeypatch):
    texts = pa.array(["ab " + "xyz" * 50 + " c", "xyz" * 50])
    words = tokens.words_of(tokens.text_array(texts), tokens.ALPHANUMERIC)
    at_once = tokens.word_keys(words)
    monkeypatch.setattr(tokens, "CHUNK", 16)
    assert tokens.word_keys(words).tolist() == at_once.tolist() and at_once[1] == at_once[3]


# --- decontamination ------------------------------------------------------------------------


def _occurrences(words, phrase):
    return [i for i in range(len(words) - len(phrase) + 1) if words[i:i + len(phrase)] == phrase]


def _by_hand(docs, items, width):
    rows = []
    for doc_id, text in docs:
        words, hit, met = _words(text), set(), set()
        for item, body in items:
            for window in decontam.windows(_words(body), width):
                for i in _occurrences(words, window):
                    hit |= set(range(i, i + len(window)))
                    met.add(item)
        named = sorted(str(m) for m in met - {None})
        rows.append((doc_id, len(words), len(hit), len(named), hashlib.sha256(",".join(named).encode()).hexdigest(), bool(hit)))
    return rows


@pytest.mark.parametrize("lot_words", [1 << 19, 12])
def test_decontamination_against_a_scan(spark, lot_words):
    """Small lots of phrases give the same rows."""
    rng = random.Random(2)
    pool = ["a", "B", "c", "É", "x1"]

    def text(low, high):
        return " ".join(rng.choice(pool) for _ in range(rng.randint(low, high)))

    items = [(i, text(0, 9)) for i in range(12)] + [(3, "c a c a"), (None, "x1 x1 a"), (90, None), (91, ","), (92, "a"), (92, "a")]
    docs = [(i, text(0, 60)) for i in range(40)] + [(1, None), (2, ""), (None, "A-c. B"), (7, items[0][1]), (7, items[0][1])]
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id bigint, text string, segment string, n_words int")
    tests = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontam.decontaminate(frame, tests, width=4, lot_words=lot_words).collect()
    key = lambda row: tuple(map(str, row))
    assert sorted(map(tuple, got), key=key) == sorted(_by_hand(docs, items, 4), key=key)


def test_lots_of_starts_and_segments(spark, monkeypatch):
    rng = random.Random(9)
    texts = pa.array([" ".join(rng.choice("abc") for _ in range(rng.randint(0, 50))) for _ in range(30)])
    segment = decontam.read_segment(decontam._segment_row(pa.array(range(30)), tokens.text_array(texts)), 0)
    phrases = decontam.phrases_of([[rng.choice("abcd") for _ in range(rng.randint(1, 8))] for _ in range(20)], 4)
    exact = [x.tolist() for x in decontam.exact_places(segment, phrases)]
    near = [x.tolist() for x in decontam.near_places(segment, phrases, 2)]
    assert len(exact[0]) > 100
    monkeypatch.setattr(decontam, "STARTS", 5)
    assert [x.tolist() for x in decontam.exact_places(segment, phrases)] == exact
    assert [x.tolist() for x in decontam.near_places(segment, phrases, 2)] == near
    docs = spark.createDataFrame(list(enumerate(texts.to_pylist())), "doc_id bigint, text string")
    tests = spark.createDataFrame([(1, "a b c a"), (2, "c c")], "item_id bigint, text string")
    cut, whole = (decontam.phrase_matches(decontam.index_tokens(docs, size), tests).drop("segment", "nth").collect() for size in (60, 1 << 20))
    assert sorted(cut) == sorted(whole)


def test_decontamination_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    none = spark.createDataFrame([], "item_id bigint, text string")
    row = decontam.decontaminate(docs, none).first()
    assert (row["n_words"], row["n_hit"], row["contaminated"]) == (2, 0, False)
    assert decontam.decontaminate(docs.limit(0), spark.createDataFrame([(1, "a b")], "item_id bigint, text string")).count() == 0


def test_index_is_written_a_few_rows_at_a_time(spark):
    """Rows of megabytes are not kept until there are 100 of them: every row group stays small, and none is passed over."""
    words = "transform(sequence(1, 200000), i -> cast(i * 12 + id as string))"
    docs = spark.range(0, 12, 1, 1).selectExpr("id AS doc_id", f"concat_ws(' ', {words}) AS text")
    index = decontam.index_tokens(docs, 1 << 20)
    groups = []
    for path in index.inputFiles():
        held = pq.ParquetFile(path.removeprefix("file://")).metadata
        groups += [held.row_group(i) for i in range(held.num_row_groups)]
    assert sum(g.num_rows for g in groups) == 12
    assert max(g.total_byte_size for g in groups) <= 16 << 20
    tests = spark.createDataFrame([(i, f"{24 + i} {36 + i}") for i in range(12)], "item_id bigint, text string")
    found = decontam.phrase_matches(index, tests).select("doc_id", "n_words", "items").collect()
    assert sorted(map(tuple, found)) == [(i, 200_000, [str(i)]) for i in range(12)]


def test_near_matches_against_a_scan(spark):
    """Words in order with other words between them: every span is one, and every document with one has a span."""
    rng = random.Random(4)
    pool = list("abcdefg")
    docs = [(i, " ".join(rng.choice(pool) for _ in range(rng.randint(0, 40)))) for i in range(60)]
    items = [(i, " ".join(rng.choice(pool) for _ in range(rng.randint(1, 5)))) for i in range(15)]
    index = decontam.index_tokens(spark.createDataFrame(docs, "doc_id bigint, text string"))
    tests = spark.createDataFrame(items, "item_id bigint, text string")
    for slop in (0, 2):
        near = {r["doc_id"]: r for r in decontam.near_matches(index, tests, slop, width=None).collect()}
        for doc_id, text in docs:
            words, wanted = text.split(), set()
            for item, body in items:
                phrase = body.split()
                for start in range(len(words)):
                    at, place = start, -1
                    for n, word in enumerate(phrase):
                        at = next((i for i in range(at, len(words)) if words[i] == word and (n or i == start)), None)
                        if at is None:
                            break
                        place, at = at, at + 1
                    if at is not None and place - start < len(phrase) + slop:
                        wanted.add(str(item))
            assert set(near[doc_id]["items"]) == wanted, (doc_id, slop)
        if slop == 0:
            exact = {r["doc_id"]: r["spans"] for r in decontam.phrase_matches(index, tests, width=None).collect()}
            assert all(sorted(r["spans"]) == sorted(exact[i]) for i, r in near.items())


# --- collocations ---------------------------------------------------------------------------


def _collocations(docs, least, top):
    f, n = defaultdict(Counter), Counter()
    for text, lang in docs:
        for part in re.split(r"[.,;:!?\n-\r]", (text or "").translate(UPPER)):
            words = re.findall(r"[^ \t]+", part)
            n[lang or "und"] += len(words)
            for k in (1, 2, 3):
                f[lang or "und"].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    rows = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and 100 * b >= 50 * a and _occurrences(list(q), list(p)) for q, b in candidates.items()):
                continue
            cuts = [(1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            rows.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return rows


@pytest.mark.parametrize("full, burst", [(collocations.FULL, collocations.BURST), (60, 4)])
def test_collocations_against_a_count(spark, monkeypatch, full, burst):
    """A trie that bursts and spills all the time counts the same."""
    monkeypatch.setattr(collocations.count_phrases, "__defaults__", (0, 3, full, burst))
    rng = random.Random(5)
    pool = ["the", "The", "of", "new", "york", "é", "a\x00b", "x"]
    docs = [(" ".join(rng.choice(pool) + rng.choice(["", "", "", ",", "\n", "\t"]) for _ in range(rng.randint(0, 60))),
             rng.choice(["en", "EN", "fr", None, "und"])) for _ in range(120)]
    docs += [(None, "en"), ("", None), ("new york " * 30, "de"), ("new york", "de")]
    frame = spark.createDataFrame([(t, lang, 1, "x") for t, lang in docs], "text string, lang string, w1 int, key string")
    got = sorted(map(tuple, collocations.mine_collocations(frame, least=3, top=25).collect()))
    assert got == sorted(_collocations(docs, 3, 25))
    assert collocations.mine_collocations(frame.limit(0)).count() == 0


def test_scores_past_64_bits(spark):
    a, left, right = 3_000_000_001, 3_000_000_007, 3_000_000_019
    row = spark.createDataFrame([(a, left, right)], "a bigint, l bigint, r bigint")
    score = row.select(collocations._score(F.col("a"), F.col("l"), F.col("r")).alias("s")).first()["s"]
    assert score == 1_000_000 * a * a // (left * right)


def test_words_that_share_a_key_are_noticed(monkeypatch):
    """Within a slice of texts, between slices, and between languages."""
    real = collocations.word_keys
    monkeypatch.setattr(collocations, "word_keys", lambda words, salt, seed: real(words, salt, seed) % (2 if seed < 100 else 2**40))
    for size in (1, 1 << 20):
        monkeypatch.setattr(collocations, "SLICE_BYTES", size)
        batch = pa.RecordBatch.from_arrays([pa.array(["a b c d e", "f g", "a"]), pa.array(["en", "fr", "en"])], names=["text", "lang"])
        rows = pa.Table.from_batches(collocations.word_runs(iter([batch]))).to_pylist()
        words = defaultdict(set)
        for r in rows:
            words[r["key"]].add((r["lang"], r["word"]))
        assert sum(r["n"] for r in rows) == 8 and set.union(*words.values()) == {*zip(["en"] * 5 + ["fr"] * 2, "abcdefg")}


def test_trie_spills_its_largest_subtrees():
    trie, rng, wanted, got = collocations.HatTrie(burst=8, full=100), np.random.default_rng(2), Counter(), Counter()
    for _ in range(50):
        ids = rng.zipf(1.5, (40, 3)) % 50
        wanted.update(map(tuple, ids.tolist()))
        trie.add(ids)
        assert trie.total == sum(trie.sizes.values()) and set(trie.sizes) == set(trie.root)
        spilled = trie.spill()
        if spilled is not None:
            assert spilled[0].tolist() == sorted(spilled[0].tolist()) and trie.total <= 50
            assert not set(spilled[0][:, 0].tolist()) & set(trie.root)  # subtrees leave as a whole
            got.update(dict(zip(map(tuple, spilled[0].tolist()), spilled[1].tolist())))
    rest = trie.spill(everything=True)
    got.update(dict(zip(map(tuple, rest[0].tolist()), rest[1].tolist())))
    assert got == wanted and trie.spill(everything=True) is None


# --- hard negatives -------------------------------------------------------------------------


@pytest.mark.parametrize("shape", [(1, 1, 1), (33, 64, 47), (64, 64, 64), (70, 5, 129), (128, 65, 31)])
def test_strassen(shape):
    rng = np.random.default_rng(3)
    a, b = rng.integers(-2**40, 2**40, shape[:2]), rng.integers(-2**20, 2**20, shape[1:])
    for leaf in (1, 8, 16):
        assert (negatives.strassen(a, b, leaf) == a @ b).all()
    wide = rng.integers(-2**62, 2**62, shape[:2])  # exact modulo 2**64
    assert (negatives.strassen(wide, b, 4) == wide @ b).all()


def test_heaps_merge():
    rng = np.random.default_rng(4)
    entries = [(int(o), int(s), i) for i, (o, s) in enumerate(zip(rng.integers(0, 5, 200), rng.integers(-3, 4, 200)))]
    one, parts = negatives.Heaps(5, 4), negatives.Heaps(5, 4)
    one.offer(*np.array(entries).T)
    for low in range(0, 200, 30):
        part = negatives.Heaps(5, 4)
        part.offer(*np.array(entries[low:low + 30]).T)
        parts.offer(part.owner, part.score, part.id)
    wanted = [e for o in range(5) for e in sorted((e for e in entries if e[0] == o), key=lambda e: (-e[1], e[2]))[:4]]
    for heaps in (one, parts):
        assert list(zip(heaps.owner.tolist(), heaps.score.tolist(), heaps.id.tolist())) == wanted


def _negatives(rows, anchors, n_positives=5, n_negatives=10):
    rows, out = sorted(set(rows)), []
    asking = {}
    for r in sorted(set(anchors)):
        asking.setdefault(r[0], r)

    def score(a, b):
        return sum(x * y for x, y in itertools.zip_longest(a[2], b[2], fillvalue=0))

    for anchor in asking.values():
        others = [(-score(anchor, r), r[0], r[1]) for r in rows if r[0] != anchor[0]]
        for s, positive, _ in sorted(o for o in others if o[2] == anchor[1])[:n_positives]:
            found = sorted(o for o in others if o[2] != anchor[1] and -30 * s <= -100 * o[0] <= -90 * s)[:n_negatives]
            out += [(anchor[0], positive, i, o[1], -s, -o[0]) for i, o in enumerate(found, 1)]
    return out


@pytest.mark.parametrize("block_rows", [7, 4096])
def test_hard_negatives_against_all_products(spark, block_rows):
    rng = random.Random(7)
    rows = [(i, rng.randint(0, 3), tuple(rng.randint(-4, 6) for _ in range(rng.choice([5, 5, 3, 0])))) for i in range(150)]
    rows += rows[10:14] + rows[10:14] + [(-100, 1, (3, 3, 3, 3, 3))]
    odd = [(None, 1, (1,)), (500, None, (1,)), (600, 2, None)]
    frame = spark.createDataFrame([(i, lab, None if v is None else list(v), 0, "x") for i, lab, v in rows + odd],
                                  "vec_id bigint, label int, vector array<bigint>, block int, nth string")
    got = negatives.hard_negatives(frame, frame.filter("vec_id % 10 = 0"), block_rows=block_rows).collect()
    assert sorted(map(tuple, got)) == sorted(_negatives(rows, [r for r in rows if r[0] % 10 == 0]))
    assert negatives.hard_negatives(frame, frame.limit(0)).count() == 0
    assert negatives.hard_negatives(frame.limit(0), frame.limit(0)).count() == 0


def test_vectors_that_take_no_part(spark):
    nan = float("nan")
    rows = [(0, 1, [1.0, 0.5]), (1, 1, [1.0, 0.5]), (2, 2, [0.5, 0.25]), (3, 2, [nan, 1.0]), (4, 2, [None, 1.0]), (5, None, [1.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>")
    vectors = frame.select("vec_id", "label", quantised(F.col("embedding")).alias("vector"))
    got = list(map(tuple, negatives.hard_negatives(vectors, vectors.filter("vec_id % 100 = 0")).collect()))
    assert got == [(0, 1, 1, 2, 256 * 256 + 128 * 128, 256 * 128 + 128 * 64)]
