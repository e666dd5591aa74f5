"""Exponential averages over a bounded frame, seeded with the frame's first value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of history that a feature row is computed from.
HISTORY = 60


def _step(old: Column, x: Column, span: int) -> Column:
    a = 2.0 / (span + 1)
    return x * a + old * (1 - a)


def fold_ema(values: Column, span: int) -> Column:
    """EMA of an array at its end; null for an empty array."""
    return F.when(F.size(values) > 0, F.aggregate(F.slice(values, 2, HISTORY + 1), F.get(values, F.lit(0)), lambda a, x: _step(a, x, span)))


def fold_macd(values: Column) -> Column:
    """(fast, slow, signal) at an array's end; all carried in one pass, so the signal is that of the same frame."""
    first = F.get(values, F.lit(0))
    start = F.struct(first.alias("fast"), first.alias("slow"), F.lit(0.0).alias("signal"))

    def step(a: Column, x: Column) -> Column:
        fast, slow = _step(a["fast"], x, 12), _step(a["slow"], x, 26)
        return F.struct(fast.alias("fast"), slow.alias("slow"), _step(a["signal"], fast - slow, 9).alias("signal"))

    return F.when(F.size(values) > 0, F.aggregate(F.slice(values, 2, HISTORY + 1), start, step))


def with_ema(df: DataFrame, value: str, key: list[str], order: str, history: int = HISTORY) -> DataFrame:
    """Adds ema20, ema50, macd, macd_signal and macd_histogram over each row and up to `history` rows before it."""
    frame = Window.partitionBy(*key).orderBy(order).rowsBetween(-history, 0)
    df = df.withColumn("frame_", F.collect_list(value).over(frame))
    df = df.select("*", fold_ema(F.col("frame_"), 20).alias("ema20"), fold_ema(F.col("frame_"), 50).alias("ema50"), fold_macd(F.col("frame_")).alias("macd_"))
    df = df.withColumn("macd", F.col("macd_.fast") - F.col("macd_.slow"))
    return df.select("*", F.col("macd_.signal").alias("macd_signal"), (F.col("macd") - F.col("macd_.signal")).alias("macd_histogram")).drop("frame_", "macd_")
