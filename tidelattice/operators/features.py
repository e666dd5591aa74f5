"""Feature families: a table of what each is made of, and the ordered steps over its series."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelattice.functions.safe import eps_div, log_return, safe_div, zscore
from tidelattice.operators.ema import HISTORY, with_ema
from tidelattice.operators.trade_stats import METRIC_DISTRIBUTIONS, METRIC_RATIOS

#: Rows in the rolling windows and momenta, and rows of the lags.
WINDOWS = (4, 8, 16, 32)
LAGS = (1, 2, 4, 8, 16, 32)
_QUANTILED = ("mean", "min", "p25", "p50", "p75", "max")
_DISTRIBUTION = ("mean", "std", "min", "p25", "p50", "p75", "max", "skew", "kurtosis")
_VOLUMES = ["trade_quantity", "trade_turnover", "trade_count", "buy_quantity", "buy_turnover"]
_SIDES = ["trade_price", "buy_price", "trade_quantity", "buy_quantity"]


@dataclass(frozen=True)
class Family:
    """time: its key; base: columns before the steps; derived: by the derivative and indicator steps; returns: columns with a log return; rolled: columns with
    rolling deviation and score; means: those that keep the rolling mean too; temporal: columns with momentum and lags."""

    time: str
    base: tuple[str, ...]
    derived: tuple[str, ...]
    returns: tuple[str, ...]
    rolled: tuple[str, ...]
    means: tuple[str, ...]
    temporal: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        """All columns of the family's table."""
        out = [self.time, *self.base, *self.derived, *[f"log_return_{c}" for c in self.returns]]
        for w in WINDOWS:
            for c in self.rolled:
                out += [f"{c}_rolling_std_{w}", *([f"{c}_rolling_mean_{w}"] if c in self.means else []), f"{c}_rolling_zscore_{w}"]
            out += [f"{c}_momentum_{w}" for c in self.temporal]
        return out + [f"{c}_lag_{k}" for k in LAGS for c in self.temporal]


def _lr(*names: str) -> tuple[str, ...]:
    return tuple(f"log_return_{n}" for n in names)


_IMBALANCES = ("imbalance_buy_quantity", "imbalance_buy_turnover")
_KLINE_TEMPORAL = ("relative_range", *_IMBALANCES, *_lr("close", *_VOLUMES))
_TRADE_TEMPORAL = (*_lr("trade_price_mean", "buy_price_mean", "trade_rate_mean", "buy_rate_mean", "buy_count", "tickup_count", "trade_vwap", "buy_vwap"), "imbalance_buy_count", "imbalance_tickup_count")
_METRIC_TEMPORAL = (*_lr(*[f"{c}_last" for c in METRIC_DISTRIBUTIONS]), *[f"{c}_last" for c in METRIC_RATIOS])
_MOODS = ("score", "confidence", "pct_negative", "pct_positive", "pct_neutral")

FAMILIES = {
    "futures_klines": Family("open_time", ("close_time", "open", "high", "low", "close", *_VOLUMES), ("relative_range", *_IMBALANCES, "body_percentage", "upper_wick_percentage", "lower_wick_percentage", "gap_percentage", "ema20", "ema50", "macd", "macd_signal", "atr14", "rsi14", "macd_histogram"), ("open", "high", "low", "close", *_VOLUMES), _KLINE_TEMPORAL, _lr("close"), _KLINE_TEMPORAL),
    "spot_klines": Family("open_time", ("close_time", *_VOLUMES), _IMBALANCES, tuple(_VOLUMES), (*_IMBALANCES, *_lr(*_VOLUMES)), (), (*_IMBALANCES, *_lr(*_VOLUMES))),
    "futures_premiumindexklines": Family("open_time", ("close_time", "open", "high", "low", "close"), ("body_percentage", "gap_percentage"), (), ("close",), (), ("close",)),
    "futures_metrics": Family("create_time", (*[f"{c}_{s}" for c in METRIC_DISTRIBUTIONS for s in (*_DISTRIBUTION, "last")], *[f"{c}_{s}" for c in METRIC_RATIOS for s in ("mean", "std", "last")]), (), tuple(f"{c}_{s}" for c in METRIC_DISTRIBUTIONS for s in (*_QUANTILED, "last")), _METRIC_TEMPORAL, _lr(*[f"{c}_last" for c in METRIC_DISTRIBUTIONS]), _METRIC_TEMPORAL),
    "sentiment": Family("create_time", ("count", *_MOODS), (), ("count",), ("log_return_count", *_MOODS), (), ("log_return_count", *_MOODS)),
    "futures_aggtrades": Family(
        "create_time",
        (*[f"{c}_{s}" for c in _SIDES for s in _DISTRIBUTION], "trade_vwap", "buy_vwap", "trade_rate_mean", "trade_rate_std", "trade_count", "buy_rate_mean", "buy_rate_std", "buy_count", "tickup_count", "trade_turnover_std", "buy_turnover_std", *[f"{s}_corr_{p}" for s in ("trade", "buy") for p in ("price_quantity", "price_time", "quantity_time")]),
        ("imbalance_buy_count", "imbalance_tickup_count"),
        (*[f"{c}_{s}" for c in _SIDES for s in _QUANTILED], "trade_rate_mean", "buy_rate_mean", "buy_count", "tickup_count", "trade_vwap", "buy_vwap"),
        _TRADE_TEMPORAL,
        _lr("trade_price_mean", "buy_price_mean", "trade_vwap", "buy_vwap"),
        _TRADE_TEMPORAL,
    ),
}


def imbalance(part: str, whole: str) -> Column:
    """Share of one side less the other's."""
    p, w = F.col(part), F.col(whole)
    return safe_div(p - (w - p), w)


def rolling(c: str, n: int, w) -> tuple[Column, Column]:
    """Mean and deviation over the last n rows; null unless all n have a value."""
    frame = w.rowsBetween(-(n - 1), 0)
    full = F.count(c).over(frame) == n
    return F.when(full, F.avg(c).over(frame)), F.when(full, F.stddev_samp(c).over(frame))


def derivative_klines(df: DataFrame, w) -> DataFrame:
    o, h, lo, c = (F.col(x) for x in ("open", "high", "low", "close"))
    before = F.lag("close").over(w)
    return df.select("*", safe_div(h - lo, c).alias("relative_range"), imbalance("buy_quantity", "trade_quantity").alias("imbalance_buy_quantity"), imbalance("buy_turnover", "trade_turnover").alias("imbalance_buy_turnover"), safe_div(c - o, o).alias("body_percentage"), safe_div(h - F.greatest(o, c), h - lo).alias("upper_wick_percentage"), safe_div(F.least(o, c) - lo, h - lo).alias("lower_wick_percentage"), safe_div(o - before, before).alias("gap_percentage"))


def indicators(df: DataFrame, key: list[str], order: str, history: int = HISTORY) -> DataFrame:
    """EMA, MACD, RSI14 and ATR14 (both by simple means)."""
    w = Window.partitionBy(*key).orderBy(order)
    before = F.lag("close").over(w)
    change = F.col("close") - before
    df = with_ema(df, "close", key, order, history)
    true_range = F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - before), F.abs(F.col("low") - before))
    df = df.select("*", F.when(change > 0, change).otherwise(0.0).alias("gain_"), F.when(change < 0, -change).otherwise(0.0).alias("loss_"), true_range.alias("range_"))
    gain, loss, atr = (rolling(c, 14, w)[0] for c in ("gain_", "loss_", "range_"))
    df = df.select("*", gain.alias("avg_gain_"), loss.alias("avg_loss_"), atr.alias("atr14"))
    g, lo = F.col("avg_gain_"), F.col("avg_loss_")
    rsi = F.when((g == 0) & (lo == 0), 50.0).when(lo == 0, 100.0).otherwise(100.0 - F.try_divide(F.lit(100.0), 1.0 + F.try_divide(g, lo)))
    return df.withColumn("rsi14", rsi).drop("gain_", "loss_", "range_", "avg_gain_", "avg_loss_")


def derive(name: str, df: DataFrame, key: list[str], order: str, history: int = HISTORY) -> DataFrame:
    """The derivative and indicator steps of a family."""
    w = Window.partitionBy(*key).orderBy(order)
    if name == "futures_klines":
        return indicators(derivative_klines(df, w), key, order, history)
    if name == "spot_klines":
        return df.select("*", imbalance("buy_quantity", "trade_quantity").alias("imbalance_buy_quantity"), imbalance("buy_turnover", "trade_turnover").alias("imbalance_buy_turnover"))
    if name == "futures_premiumindexklines":
        before = F.lag("close").over(w)
        return df.select("*", eps_div(F.col("close") - F.col("open"), "open").alias("body_percentage"), eps_div(F.col("open") - before, before).alias("gap_percentage"))
    if name == "futures_aggtrades":
        return df.select("*", imbalance("buy_count", "trade_count").alias("imbalance_buy_count"), imbalance("tickup_count", "trade_count").alias("imbalance_tickup_count"))
    return df


def log_returns(names, w) -> list[Column]:
    """log_return_<name>: against the row before."""
    return [log_return(c, F.lag(c).over(w)).alias(f"log_return_{c}") for c in names]


def momenta(names, w, windows=WINDOWS) -> list[Column]:
    """<name>_momentum_<n>: the difference to the value n rows before."""
    return [(F.col(c) - F.lag(c, n).over(w)).alias(f"{c}_momentum_{n}") for n in windows for c in names]


def lags(names, w, rows=LAGS) -> list[Column]:
    """<name>_lag_<k>: the value k rows before."""
    return [F.lag(c, k).over(w).alias(f"{c}_lag_{k}") for k in rows for c in names]


def log_level(c: str) -> Column:
    """Logarithm of a count, under the name of a return."""
    return F.when(F.col(c) > 0, F.ln(c)).alias(f"log_return_{c}")


def features(name: str, df: DataFrame, key: list[str], history: int = HISTORY) -> DataFrame:
    """All steps of a family over its series; the rows of each key are one series ordered by the family's time. One select a step, one sort for all windows."""
    f = FAMILIES[name]
    w = Window.partitionBy(*key).orderBy(f.time)
    df = derive(name, df, key, f.time, history)
    if name == "sentiment":  # the level's logarithm, under the return's name
        df = df.select("*", *[log_level(c) for c in f.returns])
    else:
        df = df.select("*", *log_returns(f.returns, w))
    rolled = []
    for n in WINDOWS:
        for c in f.rolled:
            mean, std = rolling(c, n, w)
            rolled += [mean.alias(f"{c}_rolling_mean_{n}"), std.alias(f"{c}_rolling_std_{n}")]
    df = df.select("*", *rolled)
    scores = [zscore(c, f"{c}_rolling_mean_{n}", f"{c}_rolling_std_{n}").alias(f"{c}_rolling_zscore_{n}") for n in WINDOWS for c in f.rolled]
    return df.select("*", *scores, *momenta(f.temporal, w), *lags(f.temporal, w)).select(*[k for k in key], *f.columns)


def strict_history(df: DataFrame, key: list[str], time: str, step: int, history: int = HISTORY) -> DataFrame:
    """Only the rows that have exactly the `history` boundaries before them."""
    w = Window.partitionBy(*key).orderBy(time)
    return df.withColumn("back_", F.lag(time, history).over(w)).filter(F.col(time) - F.col("back_") == history * step).drop("back_")


def combine_history(history: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Stored rows and new ones; of a key the new row counts."""
    both = history.select(*batch.columns, F.lit(0).alias("new_")).unionByName(batch.withColumn("new_", F.lit(1)))
    rest = [c for c in batch.columns if c not in keys]
    return both.groupBy(*keys).agg(F.max_by(F.struct(*rest), "new_").alias("x")).select(*keys, *[F.col(f"x.{c}").alias(c) for c in rest]).select(*batch.columns)
