"""The pN_ queries on texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelattice.llm import mixing, packing, spam


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p8_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "pack_limits"))


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.fill_report(p8_packed(spark, sf_dir), _table(spark, sf_dir, "pack_limits"))


def p9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "mix_targets"))[0]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "mix_targets"))[1].withColumn("reached_share", F.round("reached_share", 6))


def p10_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures of every page."""
    return spam.page_figures(_table(spark, sf_dir, "documents"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spam.spam_pages(_table(spark, sf_dir, "documents")).select("doc_id")


QUERIES = {"p8_packed": p8_packed, "p8_fill": p8_fill, "p9_mixture": p9_mixture, "p9_shares": p9_shares, "p10_found": p10_found, "p10_pages": p10_pages}
ORACLES: dict[str, str] = {}
