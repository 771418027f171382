"""The queries of this subpackage, one for each operator and one for the pipeline, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from . import adscan, bagminhash, bpe, filteraudit, gearchunks, imatch, mixing, ordinal, ppm, prefixfree, templates, wordbpe, zonemine

Query = Callable[[SparkSession, str], DataFrame]


def reachable(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it; a cluster has it installed or shipped."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{root}:{known}" if known else root


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reachable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def queries() -> dict[str, Query]:
    docs = lambda spark, sf_dir: table(spark, sf_dir, "documents")
    return {
        "op1_imatch": lambda spark, sf_dir: imatch.op1_imatch(docs(spark, sf_dir)),
        "op2_bpe": lambda spark, sf_dir: bpe.op2_bpe(spark, docs(spark, sf_dir)),
        "op3_adscan": lambda spark, sf_dir: adscan.op3_adscan(table(spark, sf_dir, "embeddings")),
        "op4_templates": lambda spark, sf_dir: templates.op4_templates(docs(spark, sf_dir)),
        "op5_ppm": lambda spark, sf_dir: ppm.op5_ppm(docs(spark, sf_dir)),
        "op6_mixing": lambda spark, sf_dir: mixing.op6_mixing(docs(spark, sf_dir)),
        "op7_ordinal": lambda spark, sf_dir: ordinal.op7_ordinal(docs(spark, sf_dir), table(spark, sf_dir, "labels")),
        "op8_prefix_free": lambda spark, sf_dir: prefixfree.op8_prefix_free(docs(spark, sf_dir)),
        "op9_bagminhash": lambda spark, sf_dir: bagminhash.op9_bagminhash(docs(spark, sf_dir)),
        "op10_gear_chunks": lambda spark, sf_dir: gearchunks.op10_gear_chunks(docs(spark, sf_dir)),
        "op11_zone_mining": lambda spark, sf_dir: zonemine.op11_zone_mining(table(spark, sf_dir, "embeddings")),
        "op12_filter_audit": lambda spark, sf_dir: filteraudit.op12_filter_audit(docs(spark, sf_dir), table(spark, sf_dir, "labels")),
        "op13_word_bpe": lambda spark, sf_dir: wordbpe.op13_word_bpe(spark, docs(spark, sf_dir)),
    }


def oracles() -> dict[str, str]:
    return {"op6_mixing": mixing.ORACLE, "op11_zone_mining": zonemine.ORACLE, "op12_filter_audit": filteraudit.ORACLE}
