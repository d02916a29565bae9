"""Mixing, license scans and top-k search against brute force; queries against their SQL."""

import math
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelog.llm import mixing
from tidelog.llm.licenses import PHRASES, scan_licenses
from tidelog.llm.queries import op8, op9, op10
from tidelog.llm.registry import ORACLES
from tidelog.llm.topk import ImpactIndex, exact_top_k, quantised

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("query, name", [(op8, "op8_chat_formatting"), (op9, "op9_license_scan"), (op10, "op10_exact_top_k")])
def test_queries_against_sql(spark, query, name):
    base = duckdb.connect()
    for table in ("documents", "conversations", "embeddings"):
        base.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    found = query(spark, SF)
    columns = sorted(found.columns)
    wanted = base.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    key = lambda row: tuple((v is not None, str(v)) for v in row)
    assert sorted(map(tuple, found.select(*columns).collect()), key=key) == sorted(wanted, key=key)


def test_phrases_against_a_scan(spark):
    rng = random.Random(3)
    pool = ["mit", "license", "apache", "general", "public", "GENERAL", "é", "Mit", "x1"]
    docs = [(i, " ".join(rng.choice(pool) + rng.choice(["", "", ",", "\n"]) for _ in range(rng.randint(0, 40)))) for i in range(80)]
    docs += [(900, None), (901, ""), (902, "..."), (3, docs[3][1]), (3, docs[3][1]), (None, "the MIT license")]
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id bigint, text string, label int, mark string")
    rows = scan_licenses(frame).collect()
    assert len(rows) == len(docs)
    found = {r["doc_id"]: r for r in rows}
    upper = {c: c + 32 for c in range(65, 91)}
    for i, text in docs:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(upper))
        at = [(k, label) for phrase, label in PHRASES.items() for k in range(len(words))
              if words[k:k + len(phrase.split())] == phrase.split()]
        r = found[i]
        assert (r["n_words"], r["n_base"]) == (len(words), len(at))
        assert (r["first_word"], r["last_word"]) == ((min(at)[0], max(at)[0]) if at else (None, None))
        assert r["base_labels"] == ",".join(sorted({label for _, label in at}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) | {""}
        assert (r["score"] == 1.0) if at else 0 <= r["score"] <= 1
    assert scan_licenses(frame.limit(0)).count() == 0


def test_a_template_with_a_word_too_many(spark):
    text = "x y permission is hereby granted free of any charge to any person obtaining a copy of this software and the " \
           "associated documentation files the software to deal in the software without any restriction z"
    row = scan_licenses(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert row["labels"] == "mit-text" and row["score"] > 0.75 and row["n_base"] == 0


@pytest.mark.parametrize("ties", [False, True])
def test_index_against_all_products(ties):
    rng = np.random.default_rng(5)
    vectors = rng.integers(-3, 4, (300, 6)) if ties else rng.integers(-256, 256, (300, 16))
    ids = rng.permutation(300)
    index = ImpactIndex(ids, vectors)
    for q in range(40):
        query = vectors[q] if q else np.zeros(vectors.shape[1], dtype=np.int64)
        scores = vectors @ query
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != ids[q]][:5]
        got_ids, got_scores = index.search(query, ids[q], 5)
        assert got_ids.tolist() == ids[order].tolist() and got_scores.tolist() == scores[order].tolist()


def test_top_k_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, 0.25]), (50, [0.5, 0.25]), (50, [0.5, 0.25]), (7, None), (8, [0.1, None]), (9, [nan, 0.0]), (10, [inf, 0.0]),
            (11, [0.5]), (12, []), (None, [9.0, 9.0]), (13, [-0.001, 0.0])]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id bigint, embedding array<float>, rank int")
    vectors = frame.select("vec_id", quantised(F.col("embedding")).alias("vector"), "rank")
    found = sorted(map(tuple, exact_top_k(vectors, vectors.filter("vec_id % 50 = 0"), candidate_block=2, query_block=1).collect()))
    own = 128 * 128 + 64 * 64
    assert [r for r in found if r[0] == 0] == [(0, 1, 50, own), (0, 2, 11, 128 * 128), (0, 3, 12, 0), (0, 4, 13, -128)]
    assert [r[2] for r in found if r[0] == 50] == [0, 11, 12, 13]
    assert exact_top_k(vectors.limit(0), vectors.limit(0)).count() == 0


def brute_posteriors(texts, domain_of):
    """Naive Bayes over which words a text holds and how its shares fall into halvings, from its definition."""
    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())
        size, n = max(len(text), 1), max(len(words), 1)
        shares = [text.count(m) / size for m in mixing.MARKS] + [len(set(words)) / n, len(text) / n / 20]
        return set(words), [min(max(math.floor(math.log2(x)) + 12, 0), 11) if x > 0 else 0 for x in shares], len(words)

    known = [(domain_of[i], *features(texts[i])[:2]) for i in domain_of if i in texts]
    domains = sorted({d for d, _, _ in known})
    total = {d: sum(k == d for k, _, _ in known) for d in domains}
    held = {w: [sum(k == d and w in ws for k, ws, _ in known) for d in domains] for _, own, _ in known for w in own}
    share = {w: [(c + 0.5) / (total[d] + 1) for c, d in zip(cs, domains)] for w, cs in held.items()}
    gain = {w: sum(c * math.log(c * len(known) / (sum(cs) * total[d])) for c, d in zip(cs, domains) if c) for w, cs in held.items()}
    told = sorted((w for w, cs in held.items() if sum(cs) >= 5 and max(share[w]) >= 10 * min(share[w])), key=lambda w: (-gain[w], w))[:64]
    out = {}
    for i, text in texts.items():
        own, bins, n = features(text)
        logs = []
        for j, d in enumerate(domains):
            log = math.log(total[d] / len(known))
            log += sum(math.log(share[w][j] if w in own else 1 - share[w][j]) for w in told)
            if n:
                log += sum(math.log((sum(k == d and b[at] == own_bin for k, _, b in known) + 0.5) / (total[d] + 6)) for at, own_bin in enumerate(bins))
            logs.append(log)
        raised = [math.exp(x - max(logs)) for x in logs]
        out[i] = {d: x / sum(raised) for d, x in zip(domains, raised)}
    return out, told


def test_posteriors_against_brute_force(spark):
    rng = random.Random(12)
    kinds = {"good": "the study of rivers shows how water shapes land and soil".split(), "poor": "click buy now cheap offer win best".split(),
             "toxic": "you idiot stupid shut up loser".split()}
    texts, domain_of = {}, {}
    for i in range(240):
        kind = rng.choice(["good", "good", "poor", "toxic"])
        words = [rng.choice(kinds[kind] if rng.random() < 0.7 else kinds["good"]) for _ in range(rng.randint(1, 25))]
        texts[i] = " ".join(words) + rng.choice(["", ".", "!!!", " ###"])
        if i % 3:
            domain_of[i] = kind if rng.random() < 0.9 else "good"
    texts |= {900: "", 901: "?!", 902: "Äpfel über click"}
    docs = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id bigint, text string")
    labelled = spark.createDataFrame(list(domain_of.items()), "id bigint, domain string")
    model = mixing.learn_domains(docs, labelled)
    wanted, told = brute_posteriors(texts, domain_of)
    assert set(model["words"]) == set(told) and told
    found = {r["doc_id"]: dict(zip(model["domains"], r["p"])) for r in mixing.posteriors(docs, model).collect()}
    assert found.keys() == wanted.keys() and all(sum(p.values()) == mixing.GRID for p in found.values())
    assert all(abs(found[i][d] - mixing.GRID * p) <= 1.001 for i, of in wanted.items() for d, p in of.items())


def test_rates_meet_targets(spark):
    rng = random.Random(6)
    members = []
    for _ in range(500):
        a = min(1000, max(0, int(rng.gauss(rng.choice([100, 900, 500]), 100))))
        members.append((rng.randint(0, 2000), [a, 1000 - a]))
    frame = spark.createDataFrame(members, "n_tokens bigint, p array<int>")
    rate = mixing.fit_rates(frame, ["a", "b"], {"a": 3, "b": 1}, budget=400_000)
    rows = frame.select("*", rate.alias("r")).collect()
    expected = [sum(r["n_tokens"] * r["r"] * r["p"][d] / 1000 for r in rows) for d in range(2)]
    assert np.allclose(expected, [300_000, 100_000], rtol=2e-3) and all(0 <= r["r"] <= 4 for r in rows)


def test_bounded_rates_are_least_squares(spark):
    """Targets out of reach: no other rates within the bounds come closer."""
    members = [(100, [1000, 0]), (100, [0, 1000]), (50, [500, 500])]
    frame = spark.createDataFrame(members, "n_tokens bigint, p array<int>")
    fitted = mixing.fit_rates(frame, ["a", "b"], {"a": 0.99, "b": 0.01}, budget=2000, high=2.0, most_steps=60)
    rates = [r["r"] for r in frame.select(fitted.alias("r")).collect()]
    target = np.array([1980.0, 20.0])

    def distance(rates):
        made = np.array([[n * r * p[d] / 1000 for d in range(2)] for (n, p), r in zip(members, rates)]).sum(axis=0)
        return (((made - target) ** 2) / target).sum()

    grid = np.linspace(0, 2, 21)
    best = min(distance((x, y, z)) for x in grid for y in grid for z in grid)
    assert distance(rates) <= best * 1.05 + 1


@pytest.mark.parametrize("shares, soft", [((0.985, 0.01, 0.005), 0.001), ((0.75, 0.13, 0.12), 0.25)])
def test_rates_are_fitted_to_the_end(spark, caplog, shares, soft):
    """Rare domains need rates over 4, soft posteriors many gradient steps: the targets are met, and nothing is logged."""
    rng = np.random.default_rng(8)
    kinds = rng.choice(3, 4000, p=shares)
    sure = rng.beta(2, 2 * soft / (1 - soft), 4000)
    p = np.rint(1000 * ((1 - sure)[:, None] * rng.dirichlet([2, 1, 1], 4000) + sure[:, None] * np.eye(3)[kinds])).astype(int)
    p[:, 0] = 1000 - p[:, 1] - p[:, 2]
    tokens = rng.integers(1, 2000, 4000)
    frame = spark.createDataFrame([(int(t), x.tolist()) for t, x in zip(tokens, p)], "n_tokens bigint, p array<int>")
    rate = mixing.fit_rates(frame, ["good", "poor", "toxic"], mixing.WEIGHTS)
    rows = frame.select("*", rate.alias("r")).collect()
    made = np.array([np.array(r["p"]) * r["n_tokens"] * r["r"] / 1000 for r in rows]).sum(axis=0)
    assert np.allclose(made / tokens.sum(), [0.90, 0.07, 0.03], rtol=1.1e-3) and min(r["r"] for r in rows) >= 0
    assert not caplog.records


def test_targets_out_of_reach_are_logged(spark, caplog):
    frame = spark.createDataFrame([(100, [1000, 0]), (100, [0, 1000])], "n_tokens bigint, p array<int>")
    rate = mixing.fit_rates(frame, ["a", "b"], {"a": 0.9, "b": 0.1}, high=1.5)
    assert [r["r"] for r in frame.select(rate.alias("r")).collect()] == pytest.approx([1.5, 0.2], rel=1e-3)
    assert "a 150 of 180 tokens" in caplog.text


def test_mixing_edge_cases(spark):
    docs = spark.createDataFrame([(i, f"good words number {i}", "x") for i in range(20)] + [(i, "IDIOT trash!! ###", "x") for i in range(20, 40)]
                                 + [(None, None, "x"), (3, "good words number 3", "x")], "doc_id bigint, text string, rate string")
    labels = spark.createDataFrame([(i, 1, int(i >= 20)) for i in range(40)] + [(3, None, None), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    rows = mixing.mix_to_weights(docs, labels, {"good": 0.9, "toxic": 0.1}).collect()
    assert len(rows) == 42 and all(abs(sum(r["posterior"].values()) - 1) < 1e-9 for r in rows)
    assert min(r["rate"] for r in rows if r["doc_id"] in range(20)) > max(r["rate"] for r in rows if r["doc_id"] in range(20, 40))
    plain = mixing.mix_to_weights(docs, labels.limit(0)).collect()
    assert {r["rate"] for r in plain} == {1.0}
    drawn = mixing.drawn(docs, mixing.mix_to_weights(docs, labels.limit(0)))
    assert drawn.count() == 42 and drawn.columns == docs.columns
    assert mixing.mix_to_weights(docs.limit(0), labels).count() == 0
