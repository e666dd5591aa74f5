"""Queries as frames and probes of the catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def query(spark: SparkSession, sql: str, **args) -> DataFrame:
    """A SQL text with named parameters (`:name`)."""
    return spark.sql(sql, args=args)


def has_table(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def columns(spark: SparkSession, name: str) -> dict[str, str]:
    """Types of a table's columns by name."""
    return {c.name: c.dataType for c in spark.catalog.listColumns(name)}


def jdbc(spark: SparkSession, url: str, table: str, column: str, low: int, high: int, parts: int, **options) -> DataFrame:
    """A database table read in parallel by ranges of a whole-number column; filters and columns are pushed down."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=parts, **options).load()
