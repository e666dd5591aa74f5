"""Reading the lake: Parquet tables partitioned by `period` (a day or a month), and keyed serving tables."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """A Parquet table, or None where there is none; other failures are raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def list_objects(spark: SparkSession, prefix: str, recursive: bool = True) -> list[str]:
    """Paths of the files under a prefix, sorted."""
    path = spark._jvm.org.apache.hadoop.fs.Path(prefix)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    found, it = [], fs.listFiles(path, recursive)
    while it.hasNext():
        found.append(it.next().getPath().toString())
    return sorted(found)


def period_window(day: date, monthly: bool = False) -> list[str]:
    """The periods that a day's periods of up to one day need: the day and the one before, or the month and the one before."""
    if not monthly:
        return [(day - timedelta(days=1)).isoformat(), day.isoformat()]
    first = day.replace(day=1)
    return [(first - timedelta(days=1)).strftime("%Y-%m"), first.strftime("%Y-%m")]


def scan_window(spark: SparkSession, path: str, day: date, monthly: bool = False) -> DataFrame:
    """Only the partitions of a day's window are read."""
    return spark.read.parquet(path).filter(F.col("period").isin(period_window(day, monthly)))


def partitions(spark: SparkSession, path: str, column: str = "period") -> list[str]:
    """Values of a table's partitions, sorted, from the names of its folders; no file is opened."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(n.removeprefix(f"{column}=") for n in names if n.startswith(f"{column}="))


def scan_last(spark: SparkSession, path: str, n: int = 2) -> DataFrame:
    """The newest n periods, found from the folders' names; only they are read."""
    return spark.read.parquet(path).filter(F.col("period").cast("string").isin(partitions(spark, path)[-n:]))


def history(df: DataFrame, time: str, before: int, n: int = 60) -> DataFrame:
    """The last n rows before a time, in order; a top-n, not a sort of the table."""
    return df.filter(F.col(time) < before).orderBy(F.desc(time)).limit(n).orderBy(time)


def keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).filter(F.col(key).isNotNull())
