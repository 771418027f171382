"""From raw documents to token ids in five stages; each stage's result is written to Parquet and read again as the next one's input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from caseloom.llm import bagminhash, bpe, mixing, ordinal, registry, templates
from caseloom.sources.sinks import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps."""
    return ordinal.kept_documents(docs, registry.table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without recurring lines."""
    registry.reachable(spark)
    return templates.cleaned(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    registry.reachable(spark)
    return bagminhash.kept_documents(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in place of the texts."""
    registry.reachable(spark)
    return bpe.encode(docs, bpe.default_ranks())


STAGES: list[tuple[str, Stage]] = [("quality", quality), ("lines", lines), ("near_copies", near_copies), ("mixing", mix), ("bpe", tokens)]

# The classifier and the signatures cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{name}")
    return docs
