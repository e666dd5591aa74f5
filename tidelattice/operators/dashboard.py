"""Dashboard tables: candles, readings and moods with the words of a period, for all intervals in one pass over the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelattice.functions.normalize import DAY_MS, HOUR_MS, MINUTE_MS
from tidelattice.operators.bars import ohlc_aggregates
from tidelattice.operators.social import moods, tokens
from tidelattice.operators.trade_stats import METRICS

#: The intervals of each table, in milliseconds.
INTERVALS = {"1m": MINUTE_MS, "5m": 5 * MINUTE_MS, "15m": 15 * MINUTE_MS, "1h": HOUR_MS, "4h": 4 * HOUR_MS, "1d": DAY_MS}
CANDLES, READINGS, MOODS = tuple(INTERVALS), tuple(INTERVALS)[1:], tuple(INTERVALS)[3:]


def _each(rows: DataFrame, intervals: tuple[str, ...], offset: int) -> DataFrame:
    """Each row once for every interval, with the start of its period; offset 1 for periods that hold their end. The aggregates that follow are partial, so copies don't travel."""
    kinds = F.array(*[F.struct(F.lit(k).alias("interval"), F.lit(INTERVALS[k]).cast("long").alias("step")) for k in intervals])
    each = rows.select("*", F.explode(kinds).alias("i_")).select("*", "i_.interval", "i_.step").drop("i_")
    t = F.col("t") - offset
    return each.withColumn("start_", t - F.pmod(t, F.col("step")))


def candles(minutes: DataFrame, intervals: tuple[str, ...] = CANDLES) -> DataFrame:
    """(symbol, interval, open_time, close_time, open, high, low, close) from minute bars; [b, b + step) labelled by its start."""
    out = _each(minutes.select("symbol", "t", "open", "high", "low", "close"), intervals, 0).groupBy("symbol", "interval", "step", F.col("start_").alias("open_time")).agg(*ohlc_aggregates())
    return out.select("symbol", "interval", "open_time", (F.col("open_time") + F.col("step") - 1).alias("close_time"), "open", "high", "low", "close")


def readings(snaps: DataFrame, intervals: tuple[str, ...] = READINGS) -> DataFrame:
    """(symbol, interval, create_time, the last value of each field that isn't null) from readings; (b - step, b] labelled by its end. Periods with nothing at all are left out."""
    last: list[Column] = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("t"))).alias(c) for c in METRICS]
    out = _each(snaps.select("symbol", "t", *METRICS), intervals, 1).groupBy("symbol", "interval", (F.col("start_") + F.col("step")).alias("create_time")).agg(*last)
    return out.dropna(how="all", subset=METRICS)


def sentiment(rows: DataFrame, intervals: tuple[str, ...] = MOODS, most: int = 100, least: int = 2) -> DataFrame:
    """(interval, create_time, word_frequency, count and the moods) of social rows; [b - step, b) labelled by its end. word_frequency is JSON: the most frequent words that occur at least twice, the commonest first."""
    end = (F.col("start_") + F.col("step")).alias("create_time")
    mood = _each(rows.select("t", "sentiment"), intervals, 0).groupBy("interval", end).agg(*moods())
    words = rows.select("t", F.explode(tokens("text")).alias("word"))
    counts = _each(words, intervals, 0).groupBy("interval", end, "word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    # the commonest of each of 16 parts of a period first, so no task ranks all its words
    part = F.pmod(F.xxhash64("word"), F.lit(16)).alias("part_")
    top = counts.select("*", part)
    for by in (("interval", "create_time", "part_"), ("interval", "create_time")):
        top = top.withColumn("rank_", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("n"), "word"))).filter(F.col("rank_") <= most)
    listed = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "word")))
    maps = top.groupBy("interval", "create_time").agg(F.to_json(F.map_from_entries(F.transform(listed, lambda x: F.struct(x["word"], -x["n"])))).alias("word_frequency"))
    return mood.join(maps, ["interval", "create_time"], "left").select("interval", "create_time", F.coalesce("word_frequency", F.lit("{}")).alias("word_frequency"), "count", "score", "confidence", "pct_negative", "pct_positive", "pct_neutral")
