"""Soft-membership mixing, in DataFrame functions only.

A naive Bayes classifier, learned from labelled documents, gives every document posteriors over the labels' domains.
Projected least squares then fits one nonnegative rate per document, such that the expected tokens of each domain
(tokens x rate x posterior) come to its target. A rate depends on the posteriors alone, so the fit runs over the
distinct posteriors (on a grid) with their summed tokens; each step is one aggregation to a few numbers per pair of
domains, which give a Newton step.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import bounded_sample, free_names, word_list, written

log = logging.getLogger(__name__)

MARKS = ("|", "!", "#", "%", "$", "&", "*", "E", "A", "N", "T", ".")
GRID = 1000  # posteriors are whole thousandths
_BINS = 12  # halvings of a share, from 1 down
_MOST_DOMAINS = 64
_LIFT = 10  # a telling word is so many times as frequent in one domain as in another


def domains_of(labels: DataFrame) -> DataFrame:
    """id, domain of ``labels`` (doc_id, quality, toxic): toxic, else good or poor. Several labels of an id: the least."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")
    known = labels.select(F.col("doc_id").alias("id"), domain.alias("domain")).filter("id IS NOT NULL AND domain IS NOT NULL")
    return known.groupBy("id").agg(F.min("domain").alias("domain"))


def _counted(docs: DataFrame) -> DataFrame:
    """doc_id, mark, n_tokens, vocabulary (distinct words), bins (one per statistic)."""
    text = F.coalesce("text", F.lit(""))
    size = F.greatest(F.length("t"), F.lit(1))
    shares = [(F.length("t") - F.length(F.replace("t", F.lit(m), F.lit("")))) / size for m in MARKS]
    shares += [F.size("vocabulary") / F.greatest(F.col("n_tokens"), F.lit(1)),
               F.length("t") / F.greatest(F.col("n_tokens"), F.lit(1)) / 20]
    bins = [F.least(F.greatest(F.coalesce(F.floor(F.log2(share)), F.lit(-_BINS)) + _BINS, F.lit(0)), F.lit(_BINS - 1)).cast("int") for share in shares]
    words = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), text.alias("t"),
                        word_list(F.lower(text)).alias("words"))
    sized = words.select("doc_id", "mark", "t", F.size("words").cast("long").alias("n_tokens"), F.array_distinct("words").alias("vocabulary"))
    return sized.select("doc_id", "mark", "n_tokens", "vocabulary", F.array(*bins).alias("bins"))


def learn_domains(docs: DataFrame, labelled: DataFrame, max_labelled: int = 20_000, max_words: int = 64) -> dict:
    """The classifier: domains, log likelihoods with no word, of bins, and odds of the ``max_words`` most telling words.

    Learns from at most ``max_labelled`` of ``labelled`` (id, domain). A word is told by how unevenly documents of the
    domains hold it (mutual information). Only sums per domain, bin and chosen word reach the driver.
    """
    chosen = F.broadcast(bounded_sample(labelled, "id", max_labelled))  # bounded: max_labelled rows
    texts = docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("id"), "left_semi")
    known = _counted(texts).join(chosen, F.col("doc_id") == F.col("id")).select("domain", "vocabulary", "bins")
    known = written(known, "labelled-texts")
    totals = {r["domain"]: r["count"] for r in known.groupBy("domain").count().collect()}
    domains = sorted(totals)
    if len(domains) > _MOST_DOMAINS:
        raise ValueError(f"more than {_MOST_DOMAINS} domains")
    if not domains:
        return {"domains": ["all"], "priors": [0.0], "bins": [], "words": {}}
    everyone = sum(totals.values())
    per_bin = known.select("domain", F.posexplode("bins").alias("at", "bin")).groupBy("domain", "at", "bin").count().collect()
    held = {(r["domain"], r["at"], r["bin"]): r["count"] for r in per_bin}
    bins = [[[math.log((held.get((d, at, b), 0) + 0.5) / (totals[d] + 0.5 * _BINS)) for b in range(_BINS)] for d in domains]
            for at in range(len(MARKS) + 2)]
    per_word = known.select("domain", F.explode("vocabulary").alias("word")).groupBy("word").agg(
        *[F.count(F.when(F.col("domain") == d, 1)).alias(f"n{i}") for i, d in enumerate(domains)])
    count = reduce(lambda a, b: a + b, [F.col(f"n{i}") for i in range(len(domains))])
    gain = reduce(lambda a, b: a + b, [
        F.when(F.col(f"n{i}") > 0, F.col(f"n{i}") * F.log(F.col(f"n{i}") * everyone / (count * totals[d]))).otherwise(0.0)
        for i, d in enumerate(domains)])
    shares = [(F.col(f"n{i}") + 0.5) / (totals[d] + 1) for i, d in enumerate(domains)]
    uneven = F.greatest(*shares, F.lit(0.0)) >= _LIFT * F.least(*shares, F.lit(1.0))
    told = per_word.filter((count >= 5) & uneven).withColumn("gain", gain).orderBy(F.desc("gain"), "word").limit(max_words).collect()
    shares = {r["word"]: [(r[f"n{i}"] + 0.5) / (totals[d] + 1) for i, d in enumerate(domains)] for r in told}
    words = {w: [math.log(p / (1 - p)) for p in ps] for w, ps in shares.items()}
    priors = [math.log(totals[d] / everyone) + sum(math.log(1 - ps[i]) for ps in shares.values()) for i, d in enumerate(domains)]
    return {"domains": domains, "priors": priors, "bins": bins, "words": words}


def _looked_up(words: str, table: Column) -> Column:
    return F.aggregate(words, F.lit(0.0), lambda total, word: total + F.element_at(table, word))


def posteriors(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, mark, n_tokens, p (posterior of each domain in whole thousandths, together 1000): one row per row.

    A text without words has the posteriors that holding none of the words gives.
    """
    counted, n = _counted(docs), len(model["domains"])
    hits = F.array_intersect("vocabulary", F.lit(list(model["words"]))) if model["words"] else F.array().cast("array<string>")
    counted = counted.withColumn("hits", hits)
    logs = []
    for d in range(n):
        value = F.lit(model["priors"][d])
        if model["words"]:
            table = F.map_from_arrays(F.lit(list(model["words"])), F.lit([v[d] for v in model["words"].values()]))
            value = value + _looked_up("hits", table)
        for at, table in enumerate(model["bins"]):
            value = value + F.when(F.col("n_tokens") > 0, F.element_at(F.lit(table[d]), F.col("bins")[at] + 1)).otherwise(0.0)
        logs.append(value.alias(f"l{d}"))
    scored = counted.select("doc_id", "mark", "n_tokens", *logs)
    top = F.greatest(*[F.col(f"l{d}") for d in range(n)]) if n > 1 else F.col("l0")
    raised = [F.exp(F.col(f"l{d}") - F.col("top")) for d in range(n)]
    whole = reduce(lambda a, b: a + b, [F.col(f"e{d}") for d in range(n)])
    scored = scored.withColumn("top", top).select("doc_id", "mark", "n_tokens", *[e.alias(f"e{d}") for d, e in enumerate(raised)])
    below = [F.lit(0)]  # thousandths by differences of rounded sums, so that they come to 1000
    for d in range(n):
        below.append(F.round(reduce(lambda a, b: a + b, [F.col(f"e{i}") for i in range(d + 1)]) / whole * GRID).cast("int"))
    return scored.select("doc_id", "mark", "n_tokens", F.array(*[below[d + 1] - below[d] for d in range(n)]).alias("p"))


def _rate(p: Column, at: list[float], low: Column, high: Column) -> Column:
    return F.least(F.greatest(reduce(lambda a, b: a + b, [p[d] * F.lit(w / GRID) for d, w in enumerate(at)]), low), high)


def _solved(rows: list[list[float]], right: list[float]) -> list[float]:
    """Solution of a small positive definite system by elimination."""
    n, m = len(right), [[*row, r] for row, r in zip(rows, right)]
    for i in range(n):
        for j in range(i + 1, n):
            f = m[j][i] / m[i][i]
            m[j] = [x - f * y for x, y in zip(m[j], m[i])]
    out = [0.0] * n
    for i in reversed(range(n)):
        out[i] = (m[i][n] - sum(m[i][k] * out[k] for k in range(i + 1, n))) / m[i][i]
    return out


def nearest_rates(evaluate: Callable, start: list[float], target: list[float], unit: list[float], tolerance: float,
                  most_steps: int) -> tuple[list[float], list[float], bool]:
    """Weights w of rates clip(w x posterior), their tokens by domain, and whether they are as good as can be.

    ``evaluate`` gives for weights the tokens by domain and, summed over rates off their bounds, tokens x posterior x
    posterior. Of the rates with the least squared distance from the targets (each over its unit), those are sought that
    differ least from start x posterior. They have the form above: w - start is the multiplier of the targets, and
    mu x unit x (w - start) what is missing. Newton steps solve that for a mu that falls to 1e-8, until the targets are
    met within ``tolerance`` or what is missing is stationary.
    """
    n, w = len(start), list(start)
    made, curve = evaluate(w)
    steps = 0
    for mu in (1e-2, 1e-4, 1e-6, 1e-8):
        while True:
            if max(abs(made[d] - target[d]) / unit[d] for d in range(n)) <= tolerance:
                return w, made, True
            off = [target[d] - made[d] - mu * unit[d] * (w[d] - start[d]) for d in range(n)]
            if max(abs(off[d]) / unit[d] for d in range(n)) <= tolerance / 100:
                break
            way = _solved([[curve[d][e] + (mu * unit[d] if d == e else 0.0) for e in range(n)] for d in range(n)], off)
            slope, length = sum(x * y for x, y in zip(off, way)), 1.0
            while True:
                if steps == most_steps:
                    return w, made, False
                steps += 1
                to = [x + length * y for x, y in zip(w, way)]
                made, curve = evaluate(to)
                over = -sum((target[d] - made[d] - mu * unit[d] * (to[d] - start[d])) * way[d] for d in range(n))
                if over <= slope / 2:
                    break
                length *= max(slope / (slope + over), 1 / 16)
            w = to
    return w, made, True


def fit_rates(members: DataFrame, domains: list[str], weights: Mapping[str, float], budget: float | None = None,
              low: float = 0.0, high: float = math.inf, tolerance: float = 1e-3, most_steps: int = 400,
              kept: str | None = None) -> Column:
    """The rate of a row of ``members`` (n_tokens, p), between ``low`` and ``high``.

    Minimises the squared distances of the domains' expected tokens from ``weights`` x ``budget`` (the tokens there are,
    if none is given), each over its target. Weights of domains that are not there are left out, the others scaled to 1.
    Of the rates that do, takes those nearest to posterior x target / tokens (:func:`nearest_rates`). Targets out of
    reach are approached as far as they go, and logged with the tokens reached.

    Rows with no likelier domain than ``kept`` have a rate of at least one, all others of at most one. The budget is
    then raised until the target of ``kept`` is no less than its tokens, and no other domain's is more than its tokens.
    """
    n = len(domains)
    groups = written(members.groupBy("p").agg(F.sum("n_tokens").alias("n")), "posteriors")
    tokens = F.col("n").cast("decimal(20,0)")  # whole numbers are summed: rates do not depend on the order of rows
    part = [F.col("p")[d].cast("decimal(5,0)") for d in range(n)]
    row = groups.agg(*[F.sum(tokens * part[d]).alias(f"t{d}") for d in range(n)]).first()
    there = [float(row[f"t{d}"] or 0) / GRID for d in range(n)]
    live = [d for d in range(n) if there[d] > 0]
    scale = sum(weights.get(domains[d], 0.0) for d in live)
    if not live or scale <= 0:
        return F.lit(1.0)
    total = sum(there) if budget is None else budget
    target = [weights.get(domains[d], 0.0) / scale * total if d in live else 0.0 for d in range(n)]
    least, most = F.lit(float(low)), F.lit(float(high))
    if kept in domains and there[k := domains.index(kept)] > 0 and target[k] > 0:
        more = max(1.0, there[k] / target[k])
        total, target = total * more, [t * more if d == k else min(t * more, there[d]) for d, t in enumerate(target)]
        main = F.col("p")[k] >= F.array_max("p")
        least = F.when(main, F.lit(max(low, 1.0))).otherwise(least)
        most = F.when(main, most).otherwise(F.lit(min(high, 1.0)))
    unit = [max(t, 1e-3 * total / n) for t in target]  # a target of 0 is weighed like a small one
    start = [target[d] / there[d] if d in live else 0.0 for d in range(n)]

    def evaluate(at: list[float]) -> tuple[list[float], list[list[float]]]:
        inside = F.lit(0.0) + reduce(lambda a, b: a + b, [F.col("p")[d] * F.lit(w / GRID) for d, w in enumerate(at)])
        free = F.when((inside > least) & (inside < most), tokens)
        made = [F.sum((F.col("n") * _rate(F.col("p"), at, least, most) * F.col("p")[d] / GRID).cast("decimal(28,6)")).alias(f"t{d}")
                for d in range(n)]
        curve = [F.sum(free * part[d] * part[e]).alias(f"a{d}_{e}") for d in range(n) for e in range(d, n)]
        row = groups.agg(*made, *curve).first()
        return [float(row[f"t{d}"]) for d in range(n)], [
            [float(row[f"a{min(d, e)}_{max(d, e)}"] or 0) / GRID**2 for e in range(n)] for d in range(n)]

    at, made, ended = nearest_rates(evaluate, start, target, unit, tolerance, most_steps)
    missed = [d for d in live if abs(made[d] - target[d]) > tolerance * unit[d]]
    if missed:
        log.warning("%s: %s", "Targets out of reach of the rates" if ended else f"Rates not fitted after {most_steps} steps",
                    ", ".join(f"{domains[d]} {made[d]:.0f} of {target[d]:.0f} tokens" for d in missed))
    return _rate(F.col("p"), at, least, most)


WEIGHTS = {"good": 0.90, "poor": 0.07, "toxic": 0.03}


def mix_to_weights(docs: DataFrame, labels: DataFrame, weights: Mapping[str, float] | None = None, budget: float | None = None,
                   low: float = 0.0, high: float = math.inf, kept: str | None = None) -> DataFrame:
    """doc_id, mark, n_tokens, posterior (by domain), rate: one row per row of ``docs``.

    Null texts have no tokens; null ids are mixed but never labelled. Without labels all documents are one domain and
    have rate 1. Repeated rows have equal rates. Other columns are not looked at. Documents of ``kept`` are never thinned
    out, and no others repeated (:func:`fit_rates`).
    """
    model = learn_domains(docs, domains_of(labels))
    members = written(posteriors(docs, model), "members")
    rate = fit_rates(members, model["domains"], WEIGHTS if weights is None else weights, budget, low, high, kept=kept)
    names = [F.lit(d) for d in model["domains"]]
    shares = F.map_from_arrays(F.array(*names), F.transform("p", lambda x: x / GRID))
    return members.select("doc_id", "mark", "n_tokens", shares.alias("posterior"), rate.alias("rate"))


def drawn(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as its rate says: its whole part, and once more by a hash of id and text.

    ``mixed`` is :func:`mix_to_weights` of the same documents; all columns stay as they are.
    """
    own, mark, doc, text, many, nth = free_names(docs, "_id", "_mark", "_doc", "_text", "_times", "_n")
    chance = (F.shiftrightunsigned(F.xxhash64("doc_id", "mark", F.lit(7)), 11)) * F.lit(2.0**-53)
    times = mixed.groupBy("doc_id", "mark").agg(F.max(F.floor(F.col("rate") + chance)).cast("int").alias(many))
    keyed = docs.withColumns({own: F.col("doc_id").cast("long"), mark: F.xxhash64("text")})
    named = times.withColumnsRenamed({"doc_id": doc, "mark": text})
    met = keyed.join(named, F.col(own).eqNullSafe(F.col(doc)) & (F.col(mark) == F.col(text)))
    again = met.filter(F.col(many) > 0).withColumn(nth, F.explode(F.sequence(F.lit(1), F.col(many))))
    return again.select(*docs.columns)
