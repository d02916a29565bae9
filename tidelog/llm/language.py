"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A three-letter window is the product of its letters' vectors, each
rotated by its place. A text is the sum of its windows, a language the sum of the normalised vectors of its learned
texts. A text gets the language whose prototype has the largest cosine with it.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import crc_remainder, small_batches, small_side

DIMENSIONS = 512
SEED = 20_011
_BLOCK = 4096
_LETTERS_KEPT = 2048


@lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


class LetterVectors:
    """Vectors of letters in their three rotations, made when first met; a few thousand are kept between texts."""

    def __init__(self) -> None:
        self.row_of = np.full(0x110000, -1, dtype=np.int32)
        self.rotated = np.empty((3, 0, DIMENSIONS), dtype=np.int8)

    def rows(self, codes: np.ndarray) -> np.ndarray:
        if self.rotated.shape[1] > _LETTERS_KEPT:
            self.__init__()
        rows = self.row_of[codes]
        if (rows < 0).any():
            new = np.unique(codes[rows < 0])
            made = np.array([np.random.Generator(np.random.PCG64([SEED, c])).integers(0, 2, DIMENSIONS, dtype=np.int8) * 2 - 1
                             for c in new.tolist()], dtype=np.int8)
            self.row_of[new] = np.arange(len(new)) + self.rotated.shape[1]
            rotations = np.stack([np.roll(made, 2 - place, axis=1) for place in range(3)])
            self.rotated = np.concatenate([self.rotated, rotations], axis=1)
            rows = self.row_of[codes]
        return rows


def windows(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Distinct three-letter windows (as numbers of three 21-bit code points) and their counts.

    Letters are lower-cased, every stretch of other characters is one blank, and a blank stands at either end. None if
    there is no letter.
    """
    if not text:
        return None
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.int64)
    letter = _is_letter()[points]
    if not letter.any():
        return None
    kept = np.where(letter, points, 32)[letter | np.concatenate([[True], letter[:-1]])]
    kept = np.concatenate([[32] if letter[0] else [], kept, [32] if letter[-1] else []]).astype(np.int64)
    return np.unique((kept[:-2] << 42) | (kept[1:-1] << 21) | kept[2:], return_counts=True)


def text_vector(text: str | None, letters: LetterVectors) -> np.ndarray | None:
    """The text's bundled vector, of length 1; None without a letter."""
    found = windows(text)
    if found is None:
        return None
    codes, counts = found
    mask = (1 << 21) - 1
    place = letters.rows(np.stack([codes >> 42, (codes >> 21) & mask, codes & mask]))
    first, second, third = letters.rotated
    total = np.zeros(DIMENSIONS, dtype=np.float64)
    for start in range(0, len(codes), _BLOCK):
        part = slice(start, start + _BLOCK)
        bound = first[place[0, part]] * second[place[1, part]] * third[place[2, part]]
        total += counts[part].astype(np.float32) @ bound.astype(np.float32)
    length = np.sqrt((total**2).sum())
    return total / length if length > 0 else total


def learn_languages(docs: DataFrame, max_per_language: int = 1024, salts: int = 16) -> dict[str, np.ndarray]:
    """Prototype of each language of ``docs`` (columns doc_id, text, lang), null languages apart.

    A prototype bundles at most ``max_per_language`` texts: in each of ``salts`` groups of rows, those with the smallest
    hashes, so that no frequent language (or id, or rows without one) meets in one task. Only the prototypes reach the
    driver.
    """
    small_batches(docs.sparkSession)
    place, group = F.xxhash64("id", "mark"), F.pmod(F.xxhash64("mark", "id"), F.lit(salts)).cast("int")
    first = Window.partitionBy("lang", "grp").orderBy("place", "mark")
    chosen = small_side(
        docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
        .select(F.col("doc_id").alias("id"), "lang", F.xxhash64("text").alias("mark")).distinct()
        .withColumns({"place": place, "grp": group})
        .withColumn("n", F.row_number().over(first)).filter(F.col("n") <= max_per_language // salts)
        .select(F.col("id").alias("own_id"), F.col("lang").alias("own_lang"), F.col("mark").alias("own_mark")), "language-sample")
    texts = docs.select(F.col("doc_id").alias("id"), "lang", "text", F.xxhash64("text").alias("mark"))
    same = F.col("id").eqNullSafe(F.col("own_id")) & (F.col("lang") == F.col("own_lang")) & (F.col("mark") == F.col("own_mark"))
    sampled = texts.join(chosen, same, "left_semi").select("lang", "text")

    def bundle(batches):
        letters, sums = LetterVectors(), {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                if (vector := text_vector(text, letters)) is not None:
                    sums[lang] = sums.get(lang, 0) + np.rint(vector * 2**20).astype(np.int64)
        if sums:
            yield pd.DataFrame({"lang": list(sums), "vector": [v.tolist() for v in sums.values()]})

    parts = sampled.mapInPandas(bundle, T.StructType([T.StructField("lang", T.StringType()), T.StructField("vector", T.ArrayType(T.LongType()))]))
    summed = parts.select("lang", F.posexplode("vector").alias("at", "x")).groupBy("lang", "at").agg(F.sum("x").alias("x"))
    whole = summed.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("v")).select("lang", "v.x").collect()
    found = {r["lang"]: np.array(r["x"], dtype=np.float64) for r in whole}
    return {k: v / max(np.sqrt((v**2).sum()), 1e-12) for k, v in sorted(found.items())}


def predict_language(text: Column, prototypes: dict[str, np.ndarray]) -> Column:
    """Struct of lang_pred and score (cosine, 0 to 1). Ties go to the language first in order; ``und`` scores 0."""
    names = list(prototypes)
    matrix = np.stack([prototypes[k] for k in names]) if names else np.zeros((0, DIMENSIONS))

    def predict(texts: pd.Series) -> pd.DataFrame:
        letters, out = LetterVectors(), []
        for text in texts:
            vector = text_vector(text, letters)
            if vector is None or not names:
                out.append(("und", 0.0))
                continue
            cosines = matrix @ vector
            best = int(cosines.argmax())
            out.append((names[best], float(min(max(cosines[best], 0.0), 1.0))))
        return pd.DataFrame(out, columns=["lang_pred", "score"])

    kind = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return F.pandas_udf(predict, kind)(text)


def identify_language(docs: DataFrame, max_per_language: int = 1024) -> DataFrame:
    """doc_id, held_out, lang_pred, score: one row per row of ``docs``.

    Learns from rows outside the held-out fold (crc32 of the id modulo 4 is 2) with a language and a text; a null id is
    not held out and is learned from. Without any such row every prediction is ``und``. Repeated rows are predicted
    alike and learned once. A text that is null or has no letter is ``und`` with score 0.
    """
    held_out = F.coalesce(crc_remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    prototypes = learn_languages(docs.select("doc_id", "text", "lang").filter(~held_out), max_per_language)
    found = docs.select("doc_id", held_out.alias("held_out"), predict_language(F.col("text"), prototypes).alias("found"))
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score")
