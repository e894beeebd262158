"""A training corpus from the documents: five stages, each one of the operators, on all that the last one kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortflow.llm import dedup, jaccard, mixing, packing, quality
from cohortflow.llm.common import read
from cohortflow.session import stage


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from all labels."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def different_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the largest id."""
    return dedup.exact_dedup(docs)


def dissimilar_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles overlap to four fifths, the smallest id."""
    return jaccard.keep_one(docs, words=5, percent=80)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them: not at all, or once to three times."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture's documents, repeats included, in sequences of at most 1,024 tokens."""
    cut = packing.pack(packing.pieces(docs))
    return cut.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_documents),
    ("exact dedup", different_texts),
    ("near dedup", dissimilar_texts),
    ("mixing", mixture),
    ("packing", packed),
]

#: A fitted classifier and a tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the table ``documents``; every other stage is written and reread."""
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
