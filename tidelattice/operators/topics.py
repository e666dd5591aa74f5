"""The three delivery topics in one canonical form."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelattice.functions.normalize import MINUTE_MS, epoch_ms, snap, symbol_of, text_to_ms

#: Milliseconds between the readings of metrics_messages.
READING_MS = 300_000


def bar_close_ms() -> Column:
    """Identity of a bar: its effective close, else its open cut to the minute plus one minute."""
    return F.coalesce(epoch_ms("effective_close_time"), snap(epoch_ms("open_time"), MINUTE_MS) + MINUTE_MS)


def reading_ms() -> Column:
    """Identity of a reading: its bucket, else its create_time cut to five minutes."""
    return F.coalesce(epoch_ms("bucket_create_time"), snap(text_to_ms("create_time"), READING_MS))


#: Topic -> (identity within the symbol, event time in ms).
TOPICS = {
    "futures_aggtrades": (lambda: F.col("agg_trade_id"), lambda: epoch_ms("transact_time")),
    "futures_klines": (bar_close_ms, bar_close_ms),
    "metrics_messages": (reading_ms, reading_ms),
}


def deliveries(df: DataFrame, topic: str, *keep: str) -> DataFrame:
    """(topic, symbol, message_key, event_ms, delivery_id, arrived_us) of each delivery of a topic, and the columns in `keep`. arrived_us is exact."""
    key, event = TOPICS[topic]
    return df.select(F.lit(topic).alias("topic"), symbol_of("symbol").alias("symbol"), key().cast("long").alias("message_key"), event().alias("event_ms"), F.col("delivery_id"), F.unix_micros("received_at").alias("arrived_us"), *keep)


def read_deliveries(spark: SparkSession, sf_dir: str, topics: list[str]) -> DataFrame:
    """All deliveries of some topics."""
    return reduce(DataFrame.unionByName, [deliveries(spark.read.parquet(f"{sf_dir}/{t}.parquet"), t) for t in topics])
