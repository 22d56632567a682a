"""Corpus pipeline: stages over ``documents``, in order.

Each stage is a (name, function) of STAGES; a function takes
(spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackline.llm.common import cut
from trackline.llm.decontaminate import find_contamination
from trackline.llm.language import fit, identify
from trackline.llm.mixing import mix_sources
from trackline.llm.near_dup import drop_near_duplicates
from trackline.llm.suffix_dedup import suffix_dedup


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model rejects go (no letter, or too far
    from every centroid).  It learns from the documents' own labels."""
    named = identify(docs, fit(docs))
    return named.where(~F.col("rejected")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the smallest id."""
    return drop_near_duplicates(docs, words=5, percent=80)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages of 100 bytes and more leave the text; a character
    that a cut splits goes as a whole.  ``n_chars`` follows the text."""
    cleaned = suffix_dedup(docs, length=100)
    # what a cut leaves of a split character is not valid UTF-8
    text = F.replace(F.make_valid_utf8(F.col("kept").cast("string")), F.lit("\ufffd"), F.lit(""))
    same = F.col("n_removed") == 0
    whole = F.col("kept").cast("string")
    out = cleaned.withColumn("text", F.when(same, whole).otherwise(text))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    found = find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.where(~F.col("contaminated")).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which the mix takes words, with their source's target and
    ``taken``, the words to take (repeats counted)."""
    return mix_sources(docs, weights=(5, 2, 1), max_epochs=3).where("taken > 0")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("minhash_near_dedup", near_dedup),
    ("suffix_array_dedup", passage_dedup),
    ("decontamination", decontamination),
    ("mixture", mixture),
]

# near-duplicate components and suffix arrays are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
