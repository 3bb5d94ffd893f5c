"""A pipeline over ``documents``: language, near copies, leaks, mix, shards."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from flowtables.llm.language import of_known_language
from flowtables.llm.leaks import without_leaks
from flowtables.llm.mixing import mix_documents
from flowtables.llm.near_texts import one_of_each
from flowtables.llm.shards import shard_documents
from flowtables.plans.sizes import written

SHARDS = 16


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is of a language that the model knows."""
    return of_known_language(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return one_of_each(docs)


def no_benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target weights: each document as often as the mix takes it."""
    return mix_documents(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shards of near equal bytes, with a place in the shard."""
    return shard_documents(docs, SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", known_language),
    ("near copies", no_near_copies),
    ("decontamination", no_benchmark_items),
    ("mix", mixed),
    ("shards", sharded),
]

#: SQL has no Kneser-Ney model, MinHash forest or pivotal rounding; tests compare the stages
#: with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
