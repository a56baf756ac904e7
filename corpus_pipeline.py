"""From raw documents to token digests: language, near-duplicates, mixture, pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.durable import durable
from tidemark.llm import language, mixing, neardup, pieces
from tidemark.llm.queries import piece_model
from tidemark.llm.shipping import ship


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter have no language and go."""
    ship(spark)
    return language.known_language(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    ship(spark)
    return neardup.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    return mixing.mixed_rows(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document of the mixture."""
    ship(spark)
    return pieces.token_digests(docs, piece_model())


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("pieces", encode_pieces),
]

# Trained filters, signatures and a tokenizer are beyond SQL; tests compare the stages with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
