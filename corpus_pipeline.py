"""A training corpus from raw documents: quality, near-duplicates, secrets, mix, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes what a stage returns as Parquet and hands the
table to the next. All stages but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loadcast.llm import mixing, near_text, pieces, quality, secrets
from loadcast.llm.common import table
from loadcast.session import materialize


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, linked from a similarity of 0.8 on."""
    return near_text.one_of_each(docs, near_text.Limit(percent=80))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced."""
    return secrets.redacted_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: a row for every time it takes a document, shuffled."""
    return mixing.mixed_documents(docs)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text."""
    return pieces.encoded_documents(docs)


STAGES = [
    ("quality", keep_good),
    ("near_dedup", drop_near_copies),
    ("secrets", hide_secrets),
    ("mix", mix_sources),
    ("tokens", to_pieces),
]

#: A trained network, hashed sampling and Viterbi paths are beyond SQL; tests compare every stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
