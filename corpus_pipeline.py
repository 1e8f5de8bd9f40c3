"""A training corpus from raw documents, in five stages, each written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import bayes_minhash, exact, mixing, packing, toxicity
from tributary.llm.common import table
from tributary.llm.queries import MIX_BLOCK, MIX_OTHER, MIX_WEIGHTS, TOKENIZER
from tributary.session import kept_table


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: that with the largest id."""
    return exact.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest id."""
    return bayes_minhash.drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, laid out in an order in which every source keeps its target weight."""
    return mixing.mixed_order(docs, MIX_WEIGHTS, MIX_OTHER, MIX_BLOCK)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents with their places in sequences of 1024 tokens, which follow the mix."""
    return packing.best_fit_pack(docs, TOKENIZER, place=F.col("mix_slot") * MIX_BLOCK + F.col("mix_place"))


STAGES = [("toxicity", clean), ("exact dedup", exact_copies), ("near dedup", near_copies), ("source mix", mix), ("packing", pack)]
# Packing needs the tokenizer, which SQL does not have.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = kept_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
