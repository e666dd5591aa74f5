"""Periods under the three labelling conventions, and bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelattice.functions.normalize import epoch_ms, snap, symbol_of
from tidelattice.operators.topics import bar_close_ms, reading_ms


def bucket(t: Column | str, step: int, convention: str) -> Column:
    """Label of the period of an instant in ms: `open` [b, b + step), `end` [b - step, b), `end_closed` (b - step, b]."""
    x = (F.col(t) if isinstance(t, str) else t).cast("long")
    if convention == "open":
        return snap(x, step)
    if convention == "end":
        return snap(x, step) + step
    if convention == "end_closed":
        return snap(x - 1, step) + step
    raise ValueError(convention)


def keep_last(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row with the greatest `order` of each key, by one aggregation that is partial before its shuffle; rows lacking a key are left out."""
    rest = [c for c in df.columns if c not in keys]
    one = df.dropna(subset=keys).groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("kept_"))
    return one.select(*keys, *[F.col(f"kept_.{c}").alias(c) for c in rest]).select(*df.columns)


def minute_bars(df: DataFrame) -> DataFrame:
    """One row per symbol and minute from deliveries of futures_klines; the last delivery counts."""
    rows = df.select(symbol_of("symbol").alias("symbol"), (bar_close_ms() - 60_000).alias("t"), "delivery_id", "open", "high", "low", "close", "volume", "quote_volume", "count", "taker_buy_volume", "taker_buy_quote_volume")
    return keep_last(rows, ["symbol", "t"], "delivery_id").drop("delivery_id")


def trades(df: DataFrame) -> DataFrame:
    """One row per trade from deliveries of futures_aggtrades; the last delivery counts, rows without time, price or quantity are left out."""
    rows = df.select(symbol_of("symbol").alias("symbol"), "agg_trade_id", "delivery_id", epoch_ms("transact_time").alias("t"), "price", "quantity", "is_buyer_maker")
    return keep_last(rows, ["symbol", "agg_trade_id"], "delivery_id").drop("delivery_id").dropna(subset=["t", "price", "quantity"])


def snapshots(df: DataFrame, fields: list[str]) -> DataFrame:
    """One row per symbol and five minutes from deliveries of metrics_messages; the last delivery counts."""
    rows = df.select(symbol_of("symbol").alias("symbol"), reading_ms().alias("t"), "delivery_id", *fields)
    return keep_last(rows, ["symbol", "t"], "delivery_id").drop("delivery_id")


def ohlc_aggregates(t: str = "t") -> list[Column]:
    first, last = (lambda c: F.min_by(c, t)), (lambda c: F.max_by(c, t))
    return [first("open").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), last("close").alias("close")]


def volume_aggregates() -> list[Column]:
    names = {"volume": "trade_quantity", "quote_volume": "trade_turnover", "count": "trade_count", "taker_buy_volume": "buy_quantity", "taker_buy_quote_volume": "buy_turnover"}
    return [F.sum(c).cast("double").alias(n) for c, n in names.items()]


def ohlcv(minutes: DataFrame, step: int, prices: bool = True, volumes: bool = True) -> DataFrame:
    """Bars of `step` ms from minute bars, labelled by open_time; close_time is the last millisecond."""
    out = minutes.groupBy("symbol", bucket("t", step, "open").alias("open_time")).agg(*(ohlc_aggregates() if prices else []), *(volume_aggregates() if volumes else []))
    rest = [c for c in out.columns if c not in ("symbol", "open_time")]
    return out.select("symbol", "open_time", (F.col("open_time") + step - 1).alias("close_time"), *rest)


def bars_from_trades(rows: DataFrame, step: int) -> DataFrame:
    """Bars of `step` ms straight from trades, ordered by time, then identifier."""
    order = F.struct("t", "agg_trade_id")
    turnover = F.col("price") * F.col("quantity")
    return rows.groupBy("symbol", bucket("t", step, "open").alias("open_time")).agg(F.min_by("price", order).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", order).alias("close"), F.sum("quantity").alias("trade_quantity"), F.sum(turnover).alias("trade_turnover"), F.count("*").cast("double").alias("trade_count"))
