"""License scans by diagonal voting, in DataFrame functions only.

All rolling word pairs of all texts join the pairs of short license templates. A hit votes for the diagonal (place in
the text minus place in the template) it lies on. Neighbouring diagonals of a text and template, as inserted or left
out words make them, are merged, and a merged span counts if it holds enough of the template's pairs. Three phrases are
templates too: a phrase stands wherever all of its pairs lie on one diagonal.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.llm.common import word_list

# Phrases that must stand word by word, with their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Characteristic passages of public licenses and license notices, with labels of this scan.
TEMPLATES = {
    "apache-2.0": "licensed under the apache license version 2 0",
    "mit-notice": "released under the mit license",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "cc-by-nc-4.0": "licensed under cc by nc 4 0",
    "all-rights-reserved": "all rights reserved",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                "associated documentation files the software to deal in the software without restriction",
    "bsd-text": "redistribution and use in source and binary forms with or without modification are permitted "
                "provided that the following conditions are met",
    "apache-text": "you may not use this file except in compliance with the license you may obtain a copy of the license at",
    "gpl-text": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                "general public license as published by the free software foundation",
    "lgpl-text": "under the terms of the gnu lesser general public license as published by the free software foundation",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "isc-text": "permission to use copy modify and or distribute this software for any purpose with or without fee is "
                "hereby granted",
    "cc-by-sa": "this work is licensed under a creative commons attribution sharealike",
}
LIMIT = 10_000  # words of all templates together; they are broadcast


NEIGHBOURS = 2  # diagonals that lie at most so far apart are merged
COVERAGE = 0.6  # part of a template's pairs that a merged span must hold
VOTES = 0.3  # part of them that must lie on one diagonal of the span


def template_pairs(spark: SparkSession, templates: Mapping[str, str], phrases: Mapping[str, str]) -> DataFrame:
    """label, exact, at, first, second, pairs: the word pairs of templates and phrases; refuses more than the bound."""
    rows = []
    for exact, texts in ((False, {text: label for label, text in templates.items()}), (True, phrases)):
        for text, label in texts.items():
            words = text.split()
            if len(words) < 2:
                raise ValueError(f"{text!r} has fewer than two words")
            rows += [(label, exact, i, a, b, len(words) - 1) for i, (a, b) in enumerate(zip(words, words[1:]))]
    if len(rows) > LIMIT:
        raise ValueError(f"more than {LIMIT} template words")
    return spark.createDataFrame(rows, "label string, exact boolean, at int, first string, second string, pairs int")


def lowered(text: Column) -> Column:
    """A-Z in lower case, all else as it is; null as empty."""
    upper = "".join(map(chr, range(65, 91)))
    return F.translate(F.coalesce(text, F.lit("")), upper, upper.lower())


def template_hits(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """doc_id, mark, n_words, label, exact, pairs, diagonal, at: places where a word pair of a text is one of a template.

    Each text has one more row with a null label, so that texts without hits stay.
    """
    words = docs.select("doc_id", F.xxhash64("text").alias("mark"), word_list(lowered(F.col("text"))).alias("words"))
    rolling = F.expr("""concat(
        transform(slice(words, 2, greatest(size(words) - 1, 0)),
                  (b, i) -> named_struct('i', i, 'h', xxhash64(words[i], b), 'a', words[i], 'b', b)),
        array(named_struct('i', -1, 'h', CAST(NULL AS BIGINT), 'a', CAST(NULL AS STRING), 'b', CAST(NULL AS STRING))))""")
    grams = words.select("doc_id", "mark", F.size("words").cast("long").alias("n_words"), F.explode(rolling).alias("g"))
    keyed = templates.withColumn("h", F.xxhash64("first", "second"))
    same = (F.col("g.h") == F.col("h")) & (F.col("g.a") == F.col("first")) & (F.col("g.b") == F.col("second"))
    met = grams.join(F.broadcast(keyed), same, "left").filter(F.col("label").isNotNull() | (F.col("g.i") < 0))
    return met.select("doc_id", "mark", "n_words", "label", "exact", "pairs", (F.col("g.i") - F.col("at")).alias("diagonal"), "at")


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] | None = None,
                  phrases: Mapping[str, str] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score: one row per row of ``docs``.

    Without a phrase n_base is 0, first_word and last_word are null and base_labels is empty; score is the largest
    covered part of a template, 1 for a phrase, 0 for neither. A null text has no words. Rows alike in id and text are
    scanned once and returned as often as they come. Other columns are not looked at.
    """
    pairs = template_pairs(docs.sparkSession, TEMPLATES if templates is None else templates, PHRASES if phrases is None else phrases)
    doc = ["doc_id", "mark"]
    diagonals = (
        template_hits(docs, pairs).groupBy(*doc, "label", "exact", "diagonal")
        .agg(F.max("n_words").alias("n_words"), F.max("pairs").alias("pairs"), F.collect_set("at").alias("at"),
             F.count("*").alias("rows"))
        .repartition(*doc)
    )
    ordered = Window.partitionBy(*doc, "label", "exact").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(ordered) > NEIGHBOURS, F.lit(False)) | F.col("exact")
    spans = (
        diagonals.withColumn("apart", apart.cast("int"))
        .withColumn("span", F.sum("apart").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*doc, "label", "exact", "span")
        .agg(F.max("n_words").alias("n_words"), F.max("pairs").alias("pairs"), F.min("diagonal").alias("start"),
             F.max(F.size("at")).alias("votes"), F.size(F.array_distinct(F.flatten(F.collect_list("at")))).alias("held"),
             F.max("rows").alias("rows"))
        .withColumn("covered", F.col("held") / F.col("pairs"))
    )
    phrase = F.col("exact") & (F.col("held") == F.col("pairs"))
    found = phrase | (~F.col("exact") & (F.col("covered") >= COVERAGE) & (F.col("votes") >= F.ceil(F.col("pairs") * VOTES)))
    joined = [F.concat_ws(",", F.array_sort(F.collect_set(F.when(which, F.col("label"))))) for which in (phrase, found)]
    scanned = spans.groupBy(*doc).agg(
        F.max("n_words").alias("n_words"), F.count(F.when(phrase, 1)).alias("n_base"),
        F.min(F.when(phrase, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(phrase, F.col("start"))).cast("long").alias("last_word"),
        joined[0].alias("base_labels"), joined[1].alias("labels"),
        F.coalesce(F.max(F.when(found, F.col("covered"))), F.lit(0.0)).alias("score"),
        F.max(F.when(F.col("label").isNull(), F.col("rows"))).alias("copies"))
    again = scanned.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return again.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def scan_sql() -> str:
    """The same scan in DuckDB SQL, over the table documents."""
    values = ", ".join(f"('{label}', false, '{text}')" for label, text in TEMPLATES.items())
    values += ", " + ", ".join(f"('{label}', true, '{text}')" for text, label in PHRASES.items())
    upper = "".join(map(chr, range(65, 91)))
    return f"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents),
g AS (SELECT r, w, unnest(generate_series(1, len(w) - 1)) AS i FROM d),
t AS (SELECT label, exact, string_split(text, ' ') AS tw FROM (VALUES {values}) v(label, exact, text)),
p AS (SELECT label, exact, tw, len(tw) - 1 AS pairs, unnest(generate_series(1, len(tw) - 1)) AS pos FROM t),
h AS (
    SELECT r, label, exact, pairs, i - pos AS diagonal, pos FROM g JOIN p ON g.w[i] = p.tw[pos] AND g.w[i + 1] = p.tw[pos + 1]),
v AS (SELECT r, label, exact, pairs, diagonal, list(DISTINCT pos) AS pos FROM h GROUP BY ALL),
o AS (
    SELECT *, CASE WHEN exact OR diagonal - lag(diagonal) OVER (PARTITION BY r, label, exact ORDER BY diagonal) > {NEIGHBOURS}
                   THEN 1 ELSE 0 END AS apart FROM v),
n AS (SELECT *, sum(apart) OVER (PARTITION BY r, label, exact ORDER BY diagonal ROWS UNBOUNDED PRECEDING) AS span FROM o),
s AS (
    SELECT r, label, exact, span, pairs, min(diagonal) AS start, max(len(pos)) AS votes,
           len(list_distinct(flatten(list(pos)))) AS held FROM n GROUP BY ALL),
f AS (
    SELECT *, held / pairs AS covered, exact AND held = pairs AS phrase,
           CASE WHEN exact THEN held = pairs ELSE held / pairs >= {COVERAGE} AND votes >= ceil(pairs * {VOTES}) END AS found
    FROM s)
SELECT any_value(d.doc_id) AS doc_id, CAST(any_value(len(d.w)) AS BIGINT) AS n_words, count(*) FILTER (phrase) AS n_base,
       CAST(min(start) FILTER (phrase) AS BIGINT) AS first_word, CAST(max(start) FILTER (phrase) AS BIGINT) AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (phrase), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (found), '') AS labels,
       coalesce(max(covered) FILTER (found), 0.0) AS score
FROM d LEFT JOIN f USING (r) GROUP BY d.r"""
