"""A corpus pipeline: keep texts of a known language, drop copies and near copies, mix the sources, encode.

Each stage takes the documents its predecessor kept and returns those it keeps, with all their columns; the mix
repeats documents that it takes twice, and the last stage returns their token ids. Nulls and empty tables pass
through as the stages' operators state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wavequill.llm import exact_dedup, jaccard_join, language_id, mixing, sentence_pieces
from wavequill.llm.common import table, written
from wavequill.llm.entries import PIECE_MODEL


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; those without letters or unlike every learned language go."""
    found = language_id.identify(docs, language_id.train(docs), carry=True)
    return found.filter("not rejected").select("row.*")


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest identifier."""
    return exact_dedup.without_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 on five-word shingles the one with the smallest identifier."""
    return jaccard_join.one_of_each(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return sentence_pieces.encode_pieces(docs, PIECE_MODEL)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", known_languages), ("exact dedup", without_copies), ("n-gram Jaccard join", without_near_copies), ("mixing", mixed_sources), ("SentencePiece", encoded),
]

#: documents that a stage's Python gets at once (10000 by default, with their whole texts on both sides)
ARROW_BATCH = 1000

#: a language model's decisions are not SQL; the stages are tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + "".join(c if c.isalnum() else "-" for c in name), arrow_rows=ARROW_BATCH)
    return docs
