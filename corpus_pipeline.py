"""The corpus pipeline: stages over ``documents``, each written and read again before the next.

Each stage takes all rows that its predecessor kept. All but the last return the columns of ``documents``; the last
returns the encoded documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import free_names, written
from tidelog.llm.linedup import dedup_lines
from tidelog.llm.mixing import drawn, mix_to_weights
from tidelog.llm.neardup import first_of_classes, near_duplicates
from tidelog.llm.pieces import encode_documents
from tidelog.llm.quality import fit_quality, quality_score
from tidelog.llm.registry import query

REJECT_BELOW = 0.3
# Shares of tokens in the mixture. Toxic and poor text is thinned out to its share, and never repeated if it has less; good
# text keeps a rate of at least one, as its share is met by raising the budget.
WEIGHTS = {"good": 0.93, "poor": 0.02, "toxic": 0.05}
MOST_TIMES = 4.0  # rate of a good document, if the shares are out of reach


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; null and empty texts are scored like others."""
    forest = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.filter(quality_score(F.col("text"), forest) >= REJECT_BELOW)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the blocks they share with earlier ones; those of which nothing is left go."""
    gone = F.col(free := free_names(docs, "n_deleted")[0])
    left = dedup_lines(docs, count_as=free).filter((gone == 0) | (F.trim(F.coalesce("text", F.lit(""))) != ""))
    counted = F.when(gone > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", counted).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near duplicates."""
    return first_of_classes(docs, near_duplicates(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rates say."""
    mixed = mix_to_weights(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), WEIGHTS, high=MOST_TIMES, kept="good")
    return drawn(docs, mixed)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The best segmentation of every document, with its N best, checked to decode to the text."""
    return encode_documents(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_repeated_lines),
    ("near duplicates", drop_near_duplicates),
    ("mixing sources", mix_sources),
    ("encoding", encode),
]

# The classifier, the alignment, the rates and the segmentation are beyond SQL; tests/llm holds brute-force versions.
ORACLE_SQL = None


@query("pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
