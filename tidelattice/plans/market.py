"""Queries of the market and text operators on this project's tables, and the same in SQL.

Adapters: trades, minute bars and readings come from the three delivery topics, one copy of each; the series of features are the minute bars of each
symbol. Documents stand for submissions and comments: sentiment is doc_id modulo 3, and a comment's thread is the multiple of 8 at or below its doc_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelattice.functions import normalize as nz
from tidelattice.functions.safe import zscore
from tidelattice.operators import bars, dashboard, ema, features, gaps, social, trade_stats
from tidelattice.operators.csv_machine import COLUMNS
from tidelattice.session import scratch
from tidelattice.sinks import lake
from tidelattice.streaming import pipelines

HOUR, DAY, MINUTE = nz.HOUR_MS, nz.DAY_MS, nz.MINUTE_MS
#: Fixed instant that gap queries take for now.
NOW = 1_767_225_600_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _minutes(s, d):
    return bars.minute_bars(table(s, d, "futures_klines"))


def _trades(s, d):
    return bars.trades(table(s, d, "futures_aggtrades"))


def _snaps(s, d):
    return bars.snapshots(table(s, d, "metrics_messages"), trade_stats.METRICS)


def _series(s, d):
    """Minute bars under the names of the feature steps."""
    return bars.ohlcv(_minutes(s, d), MINUTE)


def _shift(digits: int) -> float:
    """Added before rounding: sums and means of few decimals would often lie on a tie, where engines that add in another order differ."""
    return 0.13720391 * 10.0**-digits


def _r(*names: str, digits: int = 6):
    """Rounded, and without negative zeros."""
    return [(F.round(F.col(n) + _shift(digits), digits) + 0.0).alias(n) for n in names]


#: Bounds of sizes, and the digits that numbers below each keep.
_SIZES = ((1.0, 7), (1e3, 5), (1e6, 2))


def _significant(df):
    """Doubles to about seven digits, whatever their size."""
    def cut(c):
        x = F.col(c)
        out = F.round(x / 1e3 + _shift(3), 3)
        for bound, digits in reversed(_SIZES):
            out = F.when(F.abs(x) < bound, F.round(x + _shift(digits), digits)).otherwise(out)
        return (out + 0.0).alias(c)

    return df.select(*[cut(f.name) if f.dataType.simpleString() == "double" else f.name for f in df.schema])


def _key():
    return Window.partitionBy("symbol").orderBy("open_time")


_MEASURES = ["trade_quantity", "trade_turnover", "trade_count", "buy_quantity", "buy_turnover"]


def _ohlcv(step):
    return lambda s, d: bars.ohlcv(_minutes(s, d), step).select("symbol", "open_time", "close_time", "open", "high", "low", "close", *_r(*_MEASURES, digits=3))


def _ohlc(s, d):
    return bars.ohlcv(_minutes(s, d), HOUR, volumes=False)


def _trade_bars(s, d):
    return bars.bars_from_trades(_trades(s, d), HOUR).select("symbol", "open_time", "open", "high", "low", "close", *_r("trade_quantity", "trade_turnover", digits=3), "trade_count")


def _labelled(convention):
    return lambda s, d: _trades(s, d).groupBy("symbol", bars.bucket("t", HOUR, convention).alias("bucket")).agg(F.count("*").alias("n"))


def _trade_columns(*names, digits: int = 6):
    return lambda s, d: trade_stats.trade_features(_trades(s, d), HOUR).select("symbol", "create_time", *_r(*names, digits=digits))


_PARTS = ("mean", "std", "min", "p25", "p50", "p75", "max")


def _derivative(s, d):
    return features.derivative_klines(_series(s, d), _key()).select("symbol", "open_time", *_r("relative_range", "imbalance_buy_quantity", "imbalance_buy_turnover", "body_percentage", "upper_wick_percentage", "lower_wick_percentage", digits=7))


def _gap_pct(s, d):
    return features.derivative_klines(_series(s, d), _key()).select("symbol", "open_time", *_r("gap_percentage", digits=7))


def _premium(s, d):
    x = features.derive("futures_premiumindexklines", _series(s, d), ["symbol"], "open_time")
    return x.withColumnsRenamed({"body_percentage": "body", "gap_percentage": "gap"}).select("symbol", "open_time", *_r("body", "gap", digits=7))


def _returns(s, d):
    names = ["close", "trade_quantity", "trade_count"]
    return _series(s, d).select("symbol", "open_time", *features.log_returns(names, _key())).select("symbol", "open_time", *_r(*[f"log_return_{c}" for c in names], digits=7))


def _rolled(s, d):
    out = []
    for n in features.WINDOWS:
        mean, std = features.rolling("close", n, _key())
        out += [mean.alias(f"mean_{n}"), std.alias(f"std_{n}")]
    return _series(s, d).select("symbol", "open_time", "close", *out)


def _rolling(s, d):
    return _rolled(s, d).select("symbol", "open_time", *_r(*[f"{a}_{n}" for n in features.WINDOWS for a in ("mean", "std")], digits=5))


def _zscores(s, d):
    return _rolled(s, d).select("symbol", "open_time", *[zscore("close", f"mean_{n}", f"std_{n}").alias(f"z_{n}") for n in features.WINDOWS]).select("symbol", "open_time", *_r(*[f"z_{n}" for n in features.WINDOWS], digits=4))


def _momentum(s, d):
    names = {f"close_momentum_{n}": f"momentum_{n}" for n in features.WINDOWS}
    return _series(s, d).select("symbol", "open_time", *features.momenta(["close"], _key())).withColumnsRenamed(names).select("symbol", "open_time", *_r(*names.values()))


def _lags(s, d):
    return _series(s, d).select("symbol", "open_time", *features.lags(["close"], _key())).withColumnsRenamed({f"close_lag_{k}": f"lag_{k}" for k in features.LAGS})


def _ema(s, d):
    return ema.with_ema(_series(s, d), "close", ["symbol"], "open_time").select("symbol", "open_time", *_r("ema20", "ema50", digits=5))


def _macd(s, d):
    return ema.with_ema(_series(s, d), "close", ["symbol"], "open_time").select("symbol", "open_time", *_r("macd", "macd_signal", "macd_histogram", digits=5))


def _indicator(name):
    return lambda s, d: features.indicators(_series(s, d), ["symbol"], "open_time").select("symbol", "open_time", *_r(name, digits=4))


def _fill_stats(s, d):
    names = [f"{c}_{p}" for c in trade_stats.METRIC_DISTRIBUTIONS for p in (*_PARTS, "last")] + [f"{c}_{p}" for c in trade_stats.METRIC_RATIOS for p in ("mean", "std", "last")]
    return trade_stats.metric_features(_snaps(s, d), HOUR).select("symbol", "create_time", *_r(*names, digits=4))


def _fill_shape(s, d):
    return trade_stats.metric_features(_snaps(s, d), HOUR).select("symbol", "create_time", *_r("sum_open_interest_skew", "sum_open_interest_kurtosis", digits=4))


def _documents(s, d, source: str | None = None):
    x = table(s, d, "documents").withColumn("sentiment", F.pmod("doc_id", F.lit(3)))
    return x if source is None else x.filter(F.col("source") == source)


def _social(s, d):
    parts = [social.social_rows(_documents(s, d, src), kind, F.col("text")) for src, kind in (("submissions", "submission"), ("comments", "comment"))]
    return parts[0].unionByName(parts[1])


def _moods(s, d):
    return social.mood_features(_social(s, d), DAY).select("create_time", "count", *_r("score", "confidence", "pct_negative", "pct_positive", "pct_neutral", digits=7))


def _log_count(s, d):
    return social.mood_features(_social(s, d), DAY).select("create_time", features.log_level("count")).select("create_time", *_r("log_return_count", digits=9))


def _words(s, d):
    return social.top_words(_social(s, d), DAY)


def _hours(s, d):
    return _minutes(s, d).select("symbol", bars.bucket("t", HOUR, "open").alias("boundary")).distinct()


def _wanted(s, d, step):
    spans = _minutes(s, d).groupBy("symbol").agg(F.min("t").alias("first"), (F.max("t") + DAY).alias("last"))
    return gaps.expected(spans, step, "open")


def _gap_missing(s, d):
    return gaps.missing(_wanted(s, d, HOUR), _hours(s, d), ["symbol"]).withColumn("date", F.col("date").cast("string"))


def _gap_propagate(s, d):
    gone = gaps.missing(_wanted(s, d, HOUR), _hours(s, d), ["symbol"])
    return gaps.propagate(gone, HOUR, 4 * HOUR, "open", _wanted(s, d, 4 * HOUR), ["symbol"])


def _ends(s, d, step):
    """Boundaries of END-labelled periods: those that the readings make, and those that there should be."""
    rows = _snaps(s, d)
    there = rows.select("symbol", bars.bucket("t", step, "end_closed").alias("boundary")).distinct()
    return gaps.expected(rows.groupBy("symbol").agg(F.min("t").alias("first"), F.max("t").alias("last")), step, "end"), there


def _gap_ends(s, d):
    """Missing hours, and the hours of 4 that are missing or hold a missing one."""
    steps = (HOUR, 4 * HOUR)
    wanted = {k: _ends(s, d, k)[0] for k in steps}
    gone = {k: gaps.missing(wanted[k], _ends(s, d, k)[1], ["symbol"]) for k in steps}
    both = gaps.propagate_all(gone, "end", wanted, ["symbol"])
    return both[HOUR].withColumn("step", F.lit(HOUR)).unionByName(both[4 * HOUR].withColumn("step", F.lit(4 * HOUR)))


def _gap_within(s, d):
    """Gaps of the week before the last bar of all."""
    rows = _minutes(s, d).select("symbol", "t")
    now = rows.agg(F.max("t")).first()[0] or 0
    return gaps.within(gaps.internal_gaps(rows, ["symbol"], gaps.THRESHOLDS["futures_klines"]), now, 7).withColumn("hours", F.round("hours", 6))


def _derivative_trades(s, d):
    x = features.derive("futures_aggtrades", trade_stats.trade_features(_trades(s, d), HOUR), ["symbol"], "create_time")
    return x.select("symbol", "create_time", *_r("imbalance_buy_count", "imbalance_tickup_count", digits=7))


def _dashboard_moods(s, d):
    x = dashboard.sentiment(_social(s, d))
    return x.select("interval", "create_time", "word_frequency", "count", *_r("score", "confidence", "pct_negative", "pct_positive", "pct_neutral", digits=7))


def _gap(kind):
    def run(s, d):
        rows, limit = _minutes(s, d).select("symbol", "t"), gaps.THRESHOLDS["futures_klines"]
        if kind == "internal":
            g = gaps.internal_gaps(rows, ["symbol"], limit)
        elif kind == "boundary":
            g = gaps.boundary_gaps(rows.withColumn("period", nz.snap("t", HOUR)), ["symbol"], "period", limit)
        else:
            g = gaps.recent_gap(rows, ["symbol"], limit, NOW)
        return g.withColumn("hours", F.round("hours", 6))

    return run


def _dedupe(s, d):
    return _trades(s, d)


def _halves(s, d):
    rows = table(s, d, "futures_klines").select(nz.symbol_of("symbol").alias("symbol"), bars.bar_close_ms().alias("key"), "close", "delivery_id").dropna(subset=["symbol", "key"])
    return bars.keep_last(rows.filter("delivery_id % 2 = 0"), ["symbol", "key"], "delivery_id").drop("delivery_id"), bars.keep_last(rows.filter("delivery_id % 2 = 1"), ["symbol", "key"], "delivery_id").drop("delivery_id")


def _period(df):
    return df.withColumn("period", lake.period_of("key"))


def _merged(s, d) -> tuple[str, int]:
    """A lake of stored rows after a batch was merged into it, and how many keys were new."""
    old, new = _halves(s, d)
    path = scratch(s, "lake")
    lake.merge_periods(_period(old).withColumn("turn", F.lit(0)), path, ["symbol", "key"], "turn", "key")
    return path, lake.merge_periods(_period(new).withColumn("turn", F.lit(1)), path, ["symbol", "key"], "turn", "key")


def _lake_merge(s, d):
    """Stored rows and a batch, the batch's rows counting, with the period that each is stored in."""
    return s.read.parquet(_merged(s, d)[0]).select("symbol", "key", "close", F.date_format(F.col("period").cast("date"), "yyyy-MM-dd").alias("period"))


def _new_rows(s, d):
    """Rows that a batch adds to each stored period."""
    old, new = _halves(s, d)
    return _period(lake.new_keys(new, old, ["symbol", "key"])).groupBy("period").agg(F.count("*").alias("added"))


def _upsert(s, d):
    """A table after an upsert; the batch states each key several times, of which the last delivery counts."""
    old, new = _halves(s, d)
    path = scratch(s, "table")
    old.withColumn("delivery_id", F.lit(0).cast("long")).write.parquet(path)
    rows = table(s, d, "futures_klines").select(nz.symbol_of("symbol").alias("symbol"), bars.bar_close_ms().alias("key"), "close", "delivery_id").filter("delivery_id % 2 = 1")
    lake.upsert(rows, path, ["symbol", "key"], order="delivery_id")
    return s.read.parquet(path).select("symbol", "key", "close")


def _strict(s, d):
    return features.strict_history(_series(s, d).select("symbol", "open_time"), ["symbol"], "open_time", MINUTE)


def _epochs(s, d):
    return table(s, d, "futures_aggtrades").select("delivery_id", nz.epoch_ms("transact_time").alias("ms"), nz.epoch_ms_micros_only("transact_time").alias("ms_micros_only"))


def _fields(s, d, kind):
    """Lines of one kind cut at commas, as an old loader would see them."""
    rows = table(s, d, "raw_rows").filter(F.col("file_kind") == kind).select("raw_id", F.split(F.rtrim(F.col("line"), F.lit("\r")), ",").alias("f"))
    return rows.filter(F.size("f") == len(COLUMNS[kind])).select("raw_id", *[F.get("f", F.lit(i)).alias(c) for i, c in enumerate(COLUMNS[kind])])


def _headers(s, d):
    names = COLUMNS["futures_klines"]
    return nz.drop_header_rows(_fields(s, d, "futures_klines").drop("raw_id")).groupBy("open_time").agg(F.count("*").alias("n"), F.max(names[4]).alias("close"))


def _blanks(s, d):
    return _fields(s, d, "futures_klines").select("raw_id", *[nz.blank_to_double(c).alias(c) for c in ("open", "close", "volume")])


def _bools(s, d):
    return _fields(s, d, "futures_aggtrades").select("raw_id", nz.parse_bool("is_buyer_maker").alias("is_buyer_maker"))


def _datetimes(s, d):
    return _fields(s, d, "futures_metrics").select("raw_id", nz.text_to_ms("create_time").alias("ms"))


def _threads(s, d):
    subs = _documents(s, d, "submissions").select(F.concat(F.lit("s"), F.col("doc_id") - F.pmod("doc_id", F.lit(8))).alias("id"), "created_utc").groupBy("id").agg(F.min("created_utc").alias("created_utc"))
    com = _documents(s, d, "comments").select(F.concat(F.lit("c"), "doc_id").alias("id"), F.concat(F.lit("s"), F.col("doc_id") - F.pmod("doc_id", F.lit(8))).alias("submission_id"), "created_utc")
    return subs.filter("created_utc is not null"), com.filter("created_utc is not null").dropDuplicates(["id"])


def _watchlist_join(s, d):
    return social.thread_sizes(*_threads(s, d))


def _semi(s, d):
    subs, com = _threads(s, d)
    return social.with_parent(com, subs)


def _latest(s, d):
    return social.newest_of(_documents(s, d, "submissions"), "subreddit", "created_utc", "doc_id")


def _activity(s, d):
    _, com = _threads(s, d)
    times = com.groupBy("submission_id").agg(F.array_sort(F.collect_list("created_utc")).alias("times"))
    newest = F.array_max("times")
    return times.select("submission_id", social.decayed(F.col("times"), newest).alias("score"), social.activity(F.col("times"), newest).alias("active")).select("submission_id", *_r("score"), "active")


def _clean(s, d):
    return _documents(s, d).select("doc_id", social.clean_text("text").alias("text"))


def _language(s, d):
    return _documents(s, d).select("doc_id", social.language_rule("text").alias("language"))


BOTS, BOT_SAYS = ["deskrelay"], r"written by a script|automatic reply|i am a bot"


def _bots(s, d):
    x = _documents(s, d).withColumn("relevance", F.when(F.pmod("doc_id", F.lit(5)) != 0, F.lit(1)).otherwise(0))
    return x.select("doc_id", social.bot_flag(F.col("relevance"), F.col("author"), F.col("text"), BOTS, BOT_SAYS).alias("bot"))


def _ensemble(s, d):
    p = lambda k: F.array(*[((F.pmod(F.col("doc_id") * (k + 3 * i), F.lit(17)) + 1) / 18.0) for i in range(3)])
    return _documents(s, d).select("doc_id", social.ensemble(p(5), p(7)).alias("sentiment"))


def _stream_counts(s, d):
    return pipelines.trade_counts(s, f"{d}/futures_aggtrades.parquet", DAY, scratch(s, "trade-counts"))


def _stream_bars(s, d):
    return pipelines.last_bars(s, f"{d}/futures_klines.parquet", scratch(s, "last-bars"))


def _family(name, step):
    def run(s, d):
        if name in ("futures_klines", "spot_klines", "futures_premiumindexklines"):
            x = bars.ohlcv(_minutes(s, d), step, prices=name != "spot_klines", volumes=name != "futures_premiumindexklines")
        elif name == "futures_metrics":
            x = trade_stats.metric_features(_snaps(s, d), step)
        elif name == "sentiment":
            x = social.mood_features(_social(s, d).withColumn("symbol", F.lit("all")), step, ["symbol"])
        else:
            x = trade_stats.trade_features(_trades(s, d), step)
        return _significant(features.features(name, x, ["symbol"]))

    return run


#: The intervals of the feature families; the queries without an interval in their name are of an hour, sentiment of a day.
STEPS = {"1h": HOUR, "4h": 4 * HOUR, "1d": DAY}
FAMILY_QUERIES = {f"family_{name}" + ("" if k == ("1d" if name == "sentiment" else "1h") else f"_{k}"): (name, step) for name in features.FAMILIES for k, step in STEPS.items()}

QUERIES = {
    "ohlcv_1h": _ohlcv(HOUR), "ohlcv_4h": _ohlcv(4 * HOUR), "ohlcv_1d": _ohlcv(DAY), "ohlc_only_1h": _ohlc, "bars_from_trades_1h": _trade_bars,
    "bars_open_labelled": _labelled("open"), "bars_end_labelled": _labelled("end"), "bars_end_closed": _labelled("end_closed"),
    "trade_stats_1h": _trade_columns(*[f"trade_{c}_{p}" for c in ("price", "quantity") for p in _PARTS], digits=4), "buy_stats_1h": _trade_columns(*[f"buy_{c}_{p}" for c in ("price", "quantity") for p in _PARTS], digits=4),
    "trade_shape_1h": _trade_columns("trade_price_skew", "trade_price_kurtosis", "trade_quantity_skew", "trade_quantity_kurtosis", digits=3), "vwap_1h": _trade_columns("trade_vwap", "buy_vwap", digits=4), "interarrival_1h": _trade_columns("trade_rate_mean", "trade_rate_std", "buy_rate_mean", "buy_rate_std", digits=3),
    "tickup_1h": _trade_columns("trade_count", "buy_count", "tickup_count"), "turnover_std_1h": _trade_columns("trade_turnover_std", "buy_turnover_std", digits=3), "corr_1h": _trade_columns(*[f"{x}_corr_{p}" for x in ("trade", "buy") for p in ("price_quantity", "price_time", "quantity_time")], digits=5),
    "derivative_klines": _derivative, "gap_pct": _gap_pct, "premium_safe_div": _premium, "log_return": _returns, "rolling_stats": _rolling, "rolling_zscore": _zscores, "momentum": _momentum, "lags": _lags,
    "ema_bounded": _ema, "macd": _macd, "rsi14": _indicator("rsi14"), "atr14": _indicator("atr14"),
    "metrics_fill_stats": _fill_stats, "metrics_fill_shape": _fill_shape, "last_non_null": lambda s, d: trade_stats.last_non_null(_snaps(s, d), HOUR), "last_row": lambda s, d: trade_stats.last_row(_snaps(s, d), HOUR),
    "sentiment_ratio": _moods, "sentiment_log_count": _log_count, "word_freq_top100": _words,
    "gap_missing": _gap_missing, "gap_propagate": _gap_propagate, "gap_internal": _gap("internal"), "gap_boundary": _gap("boundary"), "gap_recent": _gap("recent"),
    "dedupe_keep_last": _dedupe, "lake_merge": _lake_merge, "lake_new_rows": _new_rows, "upsert_merge": _upsert, "history_strict": _strict,
    "epoch_normalize": _epochs, "header_row_drop": _headers, "blank_to_null": _blanks, "bool_parse": _bools, "datetime_parse": _datetimes,
    "watchlist_left_join": _watchlist_join, "semi_parent": _semi, "latest_per_group": _latest, "activity_decay": _activity,
    "clean_text": _clean, "language_rule": _language, "bot_flag": _bots, "sentiment_ensemble": _ensemble,
    "stream_trade_counts_1d": _stream_counts, "stream_last_bars": _stream_bars,
    "dashboard_klines": lambda s, d: dashboard.candles(_minutes(s, d)), "dashboard_metrics": lambda s, d: dashboard.readings(_snaps(s, d)), "dashboard_sentiment": _dashboard_moods,
    "derivative_trades": _derivative_trades, "gap_ends": _gap_ends, "gap_within": _gap_within,
    **{query: _family(name, step) for query, (name, step) in FAMILY_QUERIES.items()},
}

# ---- the same in SQL ----

_S = "upper(replace(replace(replace(symbol, ' ', ''), chr(9), ''), chr(160), ''))"


def _ms(c: str) -> str:
    return f"(case when {c} < 100000000000 then {c} * 1000 when {c} >= 10000000000000 then {c} // 1000 else {c} end)"


_CLOSE = f"coalesce({_ms('effective_close_time')}, {_ms('open_time')} // 60000 * 60000 + 60000)"
_READING = f"coalesce({_ms('bucket_create_time')}, epoch_ms(try_strptime(create_time, '%Y-%m-%d %H:%M:%S')) // 300000 * 300000)"
_M = f"""minutes as (select {_S} as symbol, {_CLOSE} - 60000 as t, unnest(arg_max({{'open': open, 'high': high, 'low': low, 'close': close, 'volume': volume, 'quote_volume': quote_volume, 'count': "count",
    'taker_buy_volume': taker_buy_volume, 'taker_buy_quote_volume': taker_buy_quote_volume}}, delivery_id)) from futures_klines where {_CLOSE} is not null group by 1, 2)"""
_T = f"""trades as (select * from (select {_S} as symbol, agg_trade_id, unnest(arg_max({{'t': {_ms('transact_time')}, 'price': price, 'quantity': quantity, 'is_buyer_maker': is_buyer_maker}}, delivery_id))
    from futures_aggtrades group by 1, 2) where t is not null and price is not null and quantity is not null)"""
_FIELDS = ", ".join(f"'{c}': {c}" for c in trade_stats.METRICS)
_R = f"snaps as (select {_S} as symbol, {_READING} as t, unnest(arg_max({{{_FIELDS}}}, delivery_id)) from metrics_messages where {_READING} is not null group by 1, 2)"
_VOL = "sum(volume) as trade_quantity, sum(quote_volume) as trade_turnover, cast(sum(\"count\") as double) as trade_count, sum(taker_buy_volume) as buy_quantity, sum(taker_buy_quote_volume) as buy_turnover"


def _bars_sql(step: int) -> str:
    return f"bars as (select symbol, t // {step} * {step} as open_time, arg_min_null(open, t) as open, max(high) as high, min(low) as low, arg_max_null(close, t) as close, {_VOL} from minutes group by 1, 2)"


_B = f"with {_M}, {_bars_sql(MINUTE)}"


def _rd(expr: str, name: str, digits: int | None = 6) -> str:
    if digits is None:
        return f"{expr} as {name}"
    return f"round({expr} + {_shift(digits)!r}, {digits}) + 0.0 as {name}"


def _ohlcv_sql(step: int) -> str:
    return f"with {_M}, {_bars_sql(step)} select symbol, open_time, open_time + {step - 1} as close_time, open, high, low, close, {', '.join(_rd(c, c, 3) for c in _MEASURES)} from bars"


def _label_sql(expr: str) -> str:
    return f"with {_T} select symbol, {expr} as bucket, count(*) as n from trades group by 1, 2"


def _sided(step: int) -> str:
    return f"""with {_T}, b as (select *, t // {step} * {step} + {step} as create_time, coalesce(not is_buyer_maker, false) as buy from trades),
    g as (select *, cast(t - lag(t) over w as double) as gap, case when buy then cast(t - lag(t) over (partition by symbol, create_time, buy order by t, agg_trade_id) as double) end as buy_gap,
        coalesce(price > lag(price) over w, false) as up, cast(t - first_value(t) over w as double) as since from b window w as (partition by symbol, create_time order by t, agg_trade_id))"""


_SIDED = _sided(HOUR)


def _side(label: str) -> str:
    return " filter (where buy)" if label == "buy" else ""


def _dist_sql(label: str, c: str, digits: int | None) -> list[str]:
    f, n = _side(label), f"{label}_{c}"
    rank = lambda q: f"list_sort(list({c}){f})[cast(round((count({c}){f} - 1) * {q}) as int) + 1]"
    parts = {"mean": f"avg({c}){f}", "std": f"stddev_samp({c}){f}", "min": f"min({c}){f}", "p25": rank(0.25), "p50": rank(0.5), "p75": rank(0.75), "max": f"max({c}){f}"}
    return [_rd(f"coalesce({e}, 0)", f"{n}_{p}", digits) for p, e in parts.items()]


def _trade_sql(*columns: str) -> str:
    return f"{_SIDED} select symbol, create_time, {', '.join(columns)} from g group by 1, 2"


def _moment_sql(c: str, name: str, digits: int | None, mu: str = "", where: str = "") -> list[str]:
    m = lambda k: f"avg(power({c} - mu_{mu}{c}, {k})){where}"
    ok = f"stddev_pop({c}){where} > 1e-12"
    return [_rd(f"coalesce(case when {ok} then {m(3)} / power({m(2)}, 1.5) end, 0)", f"{name}_skew", digits), _rd(f"coalesce(case when {ok} then {m(4)} / power({m(2)}, 2) - 3 end, 0)", f"{name}_kurtosis", digits)]


def _corr_sql(label: str, x: str, y: str, name: str, digits: int | None = 5) -> str:
    f = _side(label)
    spread = f"(stddev_pop({x}){f} * stddev_pop({y}){f})"
    return _rd(f"coalesce(case when {spread} > 1e-12 then covar_pop({x}, {y}){f} / {spread} end, 0)", f"{label}_corr_{name}", digits)


_W = "(partition by symbol order by open_time)"


def _div(n: str, d: str) -> str:
    return f"case when coalesce({d}, 0) = 0 then 0.0 else ({n}) / ({d}) end"


def _roll_sql(c: str, n: int, time: str = "open_time") -> tuple[str, str]:
    w = f"over (partition by symbol order by {time} rows between {n - 1} preceding and current row)"
    return tuple(f"case when count({c}) {w} = {n} then {f}({c}) {w} end" for f in ("avg", "stddev_samp"))  # type: ignore[return-value]


_FRAME = "list(close) over (partition by symbol order by open_time rows between 60 preceding and current row)"


def _ema_sql(span: int) -> str:
    a = 2.0 / (span + 1)
    return f"list_reduce(l, lambda a, x: x * {a!r} + a * {1 - a!r})"


def _mix(span: int, old: str, x: str) -> str:
    a = 2.0 / (span + 1)
    return f"({x} * {a!r} + {old} * {1 - a!r})"


_MACD = f"list_reduce(list_transform(l[2:], lambda x: {{'f': x, 's': x, 'g': 0.0}}), lambda a, x: {{'f': {_mix(12, 'a.f', 'x.f')}, 's': {_mix(26, 'a.s', 'x.f')}, 'g': {_mix(9, 'a.g', '(' + _mix(12, 'a.f', 'x.f') + ' - ' + _mix(26, 'a.s', 'x.f') + ')')}}}, {{'f': l[1], 's': l[1], 'g': cast(0.0 as double)}})"


def _filled(step: int) -> str:
    return f"""with {_R}, z as (select symbol, t, (t - 1) // {step} * {step} + {step} as create_time, {', '.join(f'nullif({c}, 0) as {c}' for c in trade_stats.METRICS)} from snaps),
    filled as (select symbol, t, create_time, {', '.join(f"coalesce(last_value({c} ignore nulls) over (partition by symbol, create_time order by t rows between unbounded preceding and current row), first_value({c} ignore nulls) over (partition by symbol, create_time order by t rows between current row and unbounded following)) as {c}" for c in trade_stats.METRICS)} from z)"""


_FILLED = _filled(HOUR)


def _fill_parts(digits: int | None) -> list[str]:
    out = []
    for c in trade_stats.METRIC_DISTRIBUTIONS:
        rank = lambda q, c=c: f"list_sort(list({c}) filter (where {c} is not null))[cast(round((count({c}) - 1) * {q}) as int) + 1]"
        out += [_rd(f"coalesce({e}, 0)", f"{c}_{p}", digits) for p, e in (("mean", f"avg({c})"), ("std", f"stddev_samp({c})"), ("min", f"min({c})"), ("p25", rank(0.25)), ("p50", rank(0.5)), ("p75", rank(0.75)), ("max", f"max({c})"))]
    out += [_rd(f"coalesce({e}, 0)", f"{c}_{p}", digits) for c in trade_stats.METRIC_RATIOS for p, e in (("mean", f"avg({c})"), ("std", f"stddev_samp({c})"))]
    return out + [_rd(f"arg_max_null({c}, t)", f"{c}_last", digits) for c in trade_stats.METRICS]


def _fill_sql() -> str:
    return f"{_FILLED} select symbol, create_time, {', '.join(_fill_parts(4))} from filled group by 1, 2"


_D = "docs as (select *, doc_id % 3 as sentiment from documents)"
_SOC = f"{_D}, soc as (select {_ms('created_utc')} as t, sentiment, coalesce(text, '') as text from docs where source in ('submissions', 'comments') and created_utc is not null)"
_OUT = "', '".join(w.replace("'", "''") for w in sorted({*social.STOPWORDS, *social.MORE_STOPWORDS}))
_WORDS_SQL = f"""words as (select t, word from (select t, unnest(list_transform(regexp_split_to_array(regexp_replace(replace(replace(replace(regexp_replace(lower(text), 'https?://[^\\s]+|www\\.[^\\s]+', ' ', 'g'), '’', ''''), '‘', ''''), chr(8203), ' '), '[^\\p{{L}}\\p{{N}}\\p{{M}}\\p{{Z}}\\p{{C}}'']', ' ', 'g'), '\\s+'), lambda x: trim(x, ''''))) as word from soc)
    where length(word) > 1 and word not in ('{_OUT}') and not regexp_full_match(word, '\\p{{Nd}}+') and (length(word) > 2 or word in ('ai', 'us', 'uk', 'eu')))"""
_HALF = f"""rows_ as (select {_S} as symbol, {_CLOSE} as key, close, delivery_id from futures_klines where {_CLOSE} is not null),
    old as (select symbol, key, arg_max_null(close, delivery_id) as close from rows_ where delivery_id % 2 = 0 group by 1, 2), new as (select symbol, key, arg_max_null(close, delivery_id) as close from rows_ where delivery_id % 2 = 1 group by 1, 2)"""
_WANTED = "(select symbol, unnest(generate_series(min(t) // {0} * {0}, (max(t) + 86400000) // {0} * {0} - {0}, {0})) as boundary from minutes group by 1)"
_GONE = f"gone as (select w.symbol, w.boundary from {_WANTED.format(HOUR)} w anti join (select symbol, t // {HOUR} * {HOUR} as boundary from minutes) e using (symbol, boundary))"
_THREADS = """subs as (select concat('s', doc_id - doc_id % 8) as id, min(created_utc) as created_utc from documents where source = 'submissions' group by 1 having min(created_utc) is not null),
    com as (select distinct on (id) * from (select concat('c', doc_id) as id, concat('s', doc_id - doc_id % 8) as submission_id, created_utc from documents where source = 'comments' and created_utc is not null))"""


def _cells(kind: str, columns: str) -> str:
    n = len(COLUMNS[kind])
    return f"with f as (select raw_id, string_split(rtrim(line, chr(13)), ',') as f from raw_rows where file_kind = '{kind}') select raw_id, {columns} from f where len(f) = {n}"


def _number_sql(i: int, name: str) -> str:
    return f"try_cast(nullif(trim(f[{i}]), '') as double) as {name}"


def _dashboard_moods_sql() -> str:
    n = lambda k: f"count_if(sentiment = {k})"
    parts = []
    for k in dashboard.MOODS:
        step = dashboard.INTERVALS[k]
        parts.append(f"""select '{k}' as interval, c.create_time, coalesce(word_frequency, '{{}}') as word_frequency, c.* exclude (create_time) from (select t // {step} * {step} + {step} as create_time, count(*) as count, {_rd(f'({n(2)} - {n(0)}) / count(*)', 'score', 7)}, {_rd(f'({n(2)} + {n(0)}) / count(*)', 'confidence', 7)},
            {_rd(f'{n(0)} / count(*)', 'pct_negative', 7)}, {_rd(f'{n(2)} / count(*)', 'pct_positive', 7)}, {_rd(f'{n(1)} / count(*)', 'pct_neutral', 7)} from soc group by 1) c left join (
            select create_time, '{{' || string_agg('"' || word || '":' || n, ',' order by n desc, word) || '}}' as word_frequency from (select * from (select t // {step} * {step} + {step} as create_time, word, count(*) as n from words group by 1, 2 having count(*) >= 2)
                qualify row_number() over (partition by create_time order by n desc, word) <= 100) group by 1) w using (create_time)""")
    return f"with {_SOC}, {_WORDS_SQL} " + " union all ".join(parts)


def _ends_sql(step: int) -> str:
    """SQL tables of END-labelled boundaries of a step: wanted and missing."""
    return f"""want{step} as (select symbol, unnest(generate_series((min(t) + {step - 1}) // {step} * {step}, max(t) // {step} * {step}, {step})) as boundary from snaps group by 1),
        gone{step} as (select symbol, boundary from want{step} anti join (select symbol, (t - 1) // {step} * {step} + {step} as boundary from snaps) e using (symbol, boundary))"""


def _significant_sql(c: str) -> str:
    cases = " ".join(f"when abs({c}) < {bound!r} then round({c} + {_shift(digits)!r}, {digits})" for bound, digits in _SIZES)
    return f"case {cases} else round({c} / 1000.0 + {_shift(3)!r}, 3) end + 0.0 as {c}"


def _trade_parts() -> list[str]:
    """All trade aggregates of a symbol and hour, from rows with the means of their hour."""
    out = []
    for x, gap in (("trade", "gap"), ("buy", "buy_gap")):
        f = _side(x)
        for c in ("price", "quantity"):
            out += _dist_sql(x, c, None) + _moment_sql(c, f"{x}_{c}", None, "buy_" if x == "buy" else "", f)
        out += [_rd(f"coalesce(sum(price * quantity){f} / nullif(sum(quantity){f}, 0), 0)", f"{x}_vwap", None), _rd(f"coalesce(stddev_samp(price * quantity){f}, 0)", f"{x}_turnover_std", None)]
        out += [_rd(f"coalesce({g}({gap}), 0)", f"{x}_rate_{p}", None) for p, g in (("mean", "avg"), ("std", "stddev_samp"))]
        out += [_corr_sql(x, a, b, n, None) for a, b, n in (("price", "quantity", "price_quantity"), ("price", "since", "price_time"), ("quantity", "since", "quantity_time"))]
    return [*out, "count(*) + 0.0::double as trade_count", "count_if(buy) + 0.0::double as buy_count", "count_if(up) + 0.0::double as tickup_count"]


def _family_base(name: str, step: int) -> str:
    """SQL of the series that a family's steps run over, as the table `base`."""
    if name == "futures_metrics":
        means = ", ".join(f"avg({c}) over (partition by symbol, create_time) as mu_{c}" for c in trade_stats.METRIC_DISTRIBUTIONS)
        moments = [x for c in trade_stats.METRIC_DISTRIBUTIONS for x in _moment_sql(c, c, None)]
        return f"{_filled(step)}, mu as (select *, {means} from filled), base as (select symbol, create_time, {', '.join(_fill_parts(None) + moments)} from mu group by 1, 2)"
    if name == "sentiment":
        n = lambda k: f"count_if(sentiment = {k})"
        return f"with {_SOC}, base as (select 'all' as symbol, t // {step} * {step} + {step} as create_time, count(*) as count, ({n(2)} - {n(0)}) / count(*) as score, ({n(2)} + {n(0)}) / count(*) as confidence, {n(0)} / count(*) as pct_negative, {n(2)} / count(*) as pct_positive, {n(1)} / count(*) as pct_neutral from soc group by 2)"
    if name == "futures_aggtrades":
        over = "over (partition by symbol, create_time)"
        means = ", ".join(f"avg({c}) {over} as mu_{c}, avg({c}) filter (where buy) {over} as mu_buy_{c}" for c in ("price", "quantity"))
        return f"{_sided(step)}, mu as (select *, {means} from g), base as (select symbol, create_time, {', '.join(_trade_parts())} from mu group by 1, 2)"
    return f"with {_M}, {_bars_sql(step)}, base as (select *, open_time + {step - 1} as close_time from bars)"


def _share(part: str, whole: str) -> str:
    return _div(f"{part} - ({whole} - {part})", whole)


def _family_sql(name: str, step: int) -> str:
    f = features.FAMILIES[name]
    w = f"(partition by symbol order by {f.time})"
    buys = f"{_share('buy_quantity', 'trade_quantity')} as imbalance_buy_quantity, {_share('buy_turnover', 'trade_turnover')} as imbalance_buy_turnover"
    steps = [_family_base(name, step)]
    if name == "futures_klines":
        steps.append(f"p as (select *, lag(close) over {w} as before, {_FRAME} as l from base)")
        steps.append(f"""q as (select *, {_div('high - low', 'close')} as relative_range, {buys}, {_div('close - open', 'open')} as body_percentage, {_div('high - greatest(open, close)', '(high - low)')} as upper_wick_percentage,
            {_div('least(open, close) - low', '(high - low)')} as lower_wick_percentage, {_div('open - before', 'before')} as gap_percentage, {_ema_sql(20)} as ema20, {_ema_sql(50)} as ema50, {_MACD} as m,
            case when close > before then close - before else 0.0 end as g, case when close < before then before - close else 0.0 end as lo, greatest(high - low, abs(high - before), abs(low - before)) as tr from p)""")
        steps.append(f"r as (select *, m.f - m.s as macd, m.g as macd_signal, m.f - m.s - m.g as macd_histogram, {_roll_sql('g', 14)[0]} as ag, {_roll_sql('lo', 14)[0]} as al, {_roll_sql('tr', 14)[0]} as atr14 from q)")
        steps.append("d as (select *, case when ag = 0 and al = 0 then 50.0 when al = 0 then 100.0 else 100.0 - 100.0 / (1.0 + ag / al) end as rsi14 from r)")
    elif name == "spot_klines":
        steps.append(f"d as (select *, {buys} from base)")
    elif name == "futures_premiumindexklines":
        steps.append(f"d as (select *, (close - open) / (open + 1e-8) as body_percentage, (open - lag(close) over {w}) / (lag(close) over {w} + 1e-8) as gap_percentage from base)")
    elif name == "futures_aggtrades":
        steps.append(f"d as (select *, {_share('buy_count', 'trade_count')} as imbalance_buy_count, {_share('tickup_count', 'trade_count')} as imbalance_tickup_count from base)")
    else:
        steps.append("d as (select * from base)")
    returns = [f"case when {c} > 0 and lag({c}) over {w} > 0 then ln({c} / lag({c}) over {w}) end as log_return_{c}" for c in f.returns] if name != "sentiment" else ["ln(count) as log_return_count"]
    steps.append(f"e as (select {', '.join(['*', *returns])} from d)")
    rolled = [f"{x} as {c}_rolling_{a}_{n}" for n in features.WINDOWS for c in f.rolled for a, x in zip(("mean", "std"), _roll_sql(c, n, f.time))]
    steps.append(f"h as (select {', '.join(['*', *rolled])} from e)")
    scores = [f"case when abs({c}_rolling_std_{n}) >= 1e-12 then ({c} - {c}_rolling_mean_{n}) / {c}_rolling_std_{n} end as {c}_rolling_zscore_{n}" for n in features.WINDOWS for c in f.rolled]
    momenta = [f"{c} - lag({c}, {n}) over {w} as {c}_momentum_{n}" for n in features.WINDOWS for c in f.temporal]
    lags = [f"lag({c}, {k}) over {w} as {c}_lag_{k}" for k in features.LAGS for c in f.temporal]
    steps.append(f"i as (select {', '.join(['*', *scores, *momenta, *lags])} from h)")
    whole = {f.time, "close_time", "count"}
    return f"{', '.join(steps)} select symbol, {', '.join(c if c in whole else _significant_sql(c) for c in f.columns)} from i"


_GAP_COLUMNS = "t + 1 as start, next - 1 as \"end\", round((next - t) / 3600000, 6) as hours"

ORACLES = {
    "ohlcv_1h": _ohlcv_sql(HOUR), "ohlcv_4h": _ohlcv_sql(4 * HOUR), "ohlcv_1d": _ohlcv_sql(DAY), "ohlc_only_1h": f"with {_M}, {_bars_sql(HOUR)} select symbol, open_time, open_time + {HOUR - 1} as close_time, open, high, low, close from bars",
    "bars_from_trades_1h": f"with {_T} select symbol, t // {HOUR} * {HOUR} as open_time, arg_min(price, (t, agg_trade_id)) as open, max(price) as high, min(price) as low, arg_max(price, (t, agg_trade_id)) as close, {_rd('sum(quantity)', 'trade_quantity', 3)}, {_rd('sum(price * quantity)', 'trade_turnover', 3)}, cast(count(*) as double) as trade_count from trades group by 1, 2",
    "bars_open_labelled": _label_sql(f"t // {HOUR} * {HOUR}"), "bars_end_labelled": _label_sql(f"t // {HOUR} * {HOUR} + {HOUR}"), "bars_end_closed": _label_sql(f"(t - 1) // {HOUR} * {HOUR} + {HOUR}"),
    "trade_stats_1h": _trade_sql(*_dist_sql("trade", "price", 4), *_dist_sql("trade", "quantity", 4)), "buy_stats_1h": _trade_sql(*_dist_sql("buy", "price", 4), *_dist_sql("buy", "quantity", 4)),
    "trade_shape_1h": f"{_SIDED}, mu as (select *, avg(price) over (partition by symbol, create_time) as mu_price, avg(quantity) over (partition by symbol, create_time) as mu_quantity from g) select symbol, create_time, {', '.join(_moment_sql('price', 'trade_price', 3) + _moment_sql('quantity', 'trade_quantity', 3))} from mu group by 1, 2",
    "vwap_1h": _trade_sql(*[_rd(f"coalesce(sum(price * quantity){_side(x)} / nullif(sum(quantity){_side(x)}, 0), 0)", f"{x}_vwap", 4) for x in ("trade", "buy")]),
    "interarrival_1h": _trade_sql(*[_rd(f"coalesce({f}({c}), 0)", f"{x}_rate_{p}", 3) for x, c in (("trade", "gap"), ("buy", "buy_gap")) for p, f in (("mean", "avg"), ("std", "stddev_samp"))]),
    "tickup_1h": _trade_sql("count(*) + 0.0::double as trade_count", "count_if(buy) + 0.0::double as buy_count", "count_if(up) + 0.0::double as tickup_count"),
    "turnover_std_1h": _trade_sql(*[_rd(f"coalesce(stddev_samp(price * quantity){_side(x)}, 0)", f"{x}_turnover_std", 3) for x in ("trade", "buy")]),
    "corr_1h": _trade_sql(*[_corr_sql(x, a, b, n) for x in ("trade", "buy") for a, b, n in (("price", "quantity", "price_quantity"), ("price", "since", "price_time"), ("quantity", "since", "quantity_time"))]),
    "derivative_klines": f"{_B} select symbol, open_time, {_rd(_div('high - low', 'close'), 'relative_range', 7)}, {_rd(_div('buy_quantity - (trade_quantity - buy_quantity)', 'trade_quantity'), 'imbalance_buy_quantity', 7)}, {_rd(_div('buy_turnover - (trade_turnover - buy_turnover)', 'trade_turnover'), 'imbalance_buy_turnover', 7)}, {_rd(_div('close - open', 'open'), 'body_percentage', 7)}, {_rd(_div('high - greatest(open, close)', '(high - low)'), 'upper_wick_percentage', 7)}, {_rd(_div('least(open, close) - low', '(high - low)'), 'lower_wick_percentage', 7)} from bars",
    "gap_pct": f"{_B}, p as (select *, lag(close) over {_W} as before from bars) select symbol, open_time, {_rd(_div('open - before', 'before'), 'gap_percentage', 7)} from p",
    "premium_safe_div": f"{_B}, p as (select *, lag(close) over {_W} as before from bars) select symbol, open_time, {_rd('(close - open) / (open + 1e-8)', 'body', 7)}, {_rd('(open - before) / (before + 1e-8)', 'gap', 7)} from p",
    "log_return": f"{_B}, p as (select *, {', '.join(f'lag({c}) over {_W} as p_{c}' for c in ('close', 'trade_quantity', 'trade_count'))} from bars) select symbol, open_time, {', '.join(_rd(f'case when {c} > 0 and p_{c} > 0 then ln({c} / p_{c}) end', f'log_return_{c}', 7) for c in ('close', 'trade_quantity', 'trade_count'))} from p",
    "rolling_stats": f"{_B} select symbol, open_time, {', '.join(_rd(e, f'{a}_{n}', 5) for n in features.WINDOWS for a, e in zip(('mean', 'std'), _roll_sql('close', n)))} from bars",
    "rolling_zscore": f"{_B}, r as (select *, {', '.join(f'{e} as {a}_{n}' for n in features.WINDOWS for a, e in zip(('mean', 'std'), _roll_sql('close', n)))} from bars) select symbol, open_time, {', '.join(_rd(f'case when abs(std_{n}) >= 1e-12 then (close - mean_{n}) / std_{n} end', f'z_{n}', 4) for n in features.WINDOWS)} from r",
    "momentum": f"{_B} select symbol, open_time, {', '.join(_rd(f'close - lag(close, {n}) over {_W}', f'momentum_{n}', 6) for n in features.WINDOWS)} from bars",
    "lags": f"{_B} select symbol, open_time, {', '.join(f'lag(close, {k}) over {_W} as lag_{k}' for k in features.LAGS)} from bars",
    "ema_bounded": f"{_B}, f as (select symbol, open_time, {_FRAME} as l from bars) select symbol, open_time, {_rd(_ema_sql(20), 'ema20', 5)}, {_rd(_ema_sql(50), 'ema50', 5)} from f",
    "macd": f"{_B}, f as (select symbol, open_time, {_FRAME} as l from bars), m as (select symbol, open_time, {_MACD} as m from f) select symbol, open_time, {_rd('m.f - m.s', 'macd', 5)}, {_rd('m.g', 'macd_signal', 5)}, {_rd('m.f - m.s - m.g', 'macd_histogram', 5)} from m",
    "rsi14": f"{_B}, p as (select *, close - lag(close) over {_W} as d from bars), q as (select symbol, open_time, case when d > 0 then d else 0.0 end as g, case when d < 0 then -d else 0.0 end as l from p), r as (select symbol, open_time, {_roll_sql('g', 14)[0]} as g, {_roll_sql('l', 14)[0]} as l from q) select symbol, open_time, {_rd('case when g = 0 and l = 0 then 50.0 when l = 0 then 100.0 else 100.0 - 100.0 / (1.0 + g / l) end', 'rsi14', 4)} from r",
    "atr14": f"{_B}, p as (select *, lag(close) over {_W} as before from bars), q as (select symbol, open_time, greatest(high - low, abs(high - before), abs(low - before)) as tr from p) select symbol, open_time, {_rd(_roll_sql('tr', 14)[0], 'atr14', 4)} from q",
    "metrics_fill_stats": _fill_sql(), "metrics_fill_shape": f"{_FILLED}, mu as (select *, avg(sum_open_interest) over (partition by symbol, create_time) as mu_sum_open_interest from filled) select symbol, create_time, {', '.join(_moment_sql('sum_open_interest', 'sum_open_interest', 4))} from mu group by 1, 2",
    "last_non_null": f"with {_R} select symbol, (t - 1) // {HOUR} * {HOUR} + {HOUR} as create_time, {', '.join(f'arg_max({c}, t) as {c}' for c in trade_stats.METRICS)} from snaps group by 1, 2 having {' or '.join(f'count({c}) > 0' for c in trade_stats.METRICS)}",
    "last_row": f"with {_R} select symbol, (t - 1) // {HOUR} * {HOUR} + {HOUR} as create_time, {', '.join(f'arg_max_null({c}, t) as {c}' for c in trade_stats.METRICS)} from snaps group by 1, 2",
    "sentiment_ratio": f"with {_SOC} select t // {DAY} * {DAY} + {DAY} as create_time, count(*) as count, {_rd('(count_if(sentiment = 2) - count_if(sentiment = 0)) / count(*)', 'score', 7)}, {_rd('(count_if(sentiment = 2) + count_if(sentiment = 0)) / count(*)', 'confidence', 7)}, {_rd('count_if(sentiment = 0) / count(*)', 'pct_negative', 7)}, {_rd('count_if(sentiment = 2) / count(*)', 'pct_positive', 7)}, {_rd('count_if(sentiment = 1) / count(*)', 'pct_neutral', 7)} from soc group by 1",
    "sentiment_log_count": f"with {_SOC} select t // {DAY} * {DAY} + {DAY} as create_time, {_rd('ln(count(*))', 'log_return_count', 9)} from soc group by 1",
    "word_freq_top100": f"with {_SOC}, {_WORDS_SQL}, n as (select t // {DAY} * {DAY} + {DAY} as create_time, word, count(*) as n from words group by 1, 2 having count(*) >= 2) select create_time, word, n from n qualify row_number() over (partition by create_time order by n desc, word) <= 100",
    "gap_missing": f"with {_M}, {_GONE} select symbol, boundary, strftime(make_timestamp(boundary * 1000), '%Y-%m-%d') as date from gone",
    "gap_propagate": f"with {_M}, {_GONE} select distinct g.symbol, g.boundary // {4 * HOUR} * {4 * HOUR} as boundary from gone g semi join {_WANTED.format(4 * HOUR)} w on g.symbol = w.symbol and g.boundary // {4 * HOUR} * {4 * HOUR} = w.boundary",
    "gap_internal": f"with {_M}, n as (select symbol, t, lead(t) over (partition by symbol order by t) as next from minutes) select symbol, 'internal' as kind, {_GAP_COLUMNS} from n where next - t > 61000",
    "gap_boundary": f"with {_M}, e as (select symbol, t // {HOUR} as p, min(t) as lo, max(t) as t from minutes group by 1, 2), n as (select symbol, t, lead(lo) over (partition by symbol order by p) as next from e) select symbol, 'boundary' as kind, {_GAP_COLUMNS} from n where next - t > 61000",
    "gap_recent": f"with {_M}, n as (select symbol, max(t) as t, {NOW} - 3 * 61000 as next from minutes group by 1) select symbol, 'recent' as kind, {_GAP_COLUMNS} from n where next - t > 61000",
    "dedupe_keep_last": f"with {_T} select symbol, agg_trade_id, t, price, quantity, is_buyer_maker from trades",
    "lake_merge": f"with {_HALF} select symbol, key, case when n.symbol is not null then n.close else o.close end as close, strftime(make_timestamp(key * 1000), '%Y-%m-%d') as period from old o full join new n using (symbol, key)".replace("n.symbol is not null", "n.present").replace("full join new n", "full join (select *, true as present from new) n"),
    "lake_new_rows": f"with {_HALF} select strftime(make_timestamp(key * 1000), '%Y-%m-%d') as period, count(*) as added from new anti join old using (symbol, key) group by 1",
    "upsert_merge": f"with {_HALF} select symbol, key, close from old anti join new using (symbol, key) union all select symbol, key, close from new",
    "history_strict": f"{_B}, h as (select symbol, open_time, lag(open_time, 60) over {_W} as back from bars) select symbol, open_time from h where open_time - back = 60 * 60000",
    "epoch_normalize": f"select delivery_id, {_ms('transact_time')} as ms, case when transact_time >= 10000000000000 then transact_time // 1000 else transact_time end as ms_micros_only from futures_aggtrades",
    "header_row_drop": f"with c as ({_cells('futures_klines', 'f')}) select f[1] as open_time, count(*) as n, max(f[5]) as close from c where array_to_string(f, ',') != '{','.join(COLUMNS['futures_klines'])}' group by 1",
    "blank_to_null": _cells("futures_klines", ", ".join(_number_sql(i, c) for i, c in ((2, "open"), (5, "close"), (6, "volume")))),
    "bool_parse": _cells("futures_aggtrades", "case when lower(trim(f[7])) in ('true', '1', 't') then true when lower(trim(f[7])) in ('false', '0', 'f') then false end as is_buyer_maker"),
    "datetime_parse": _cells("futures_metrics", f"case when regexp_full_match(trim(f[1]), '[0-9]{{1,18}}') then {_ms('try_cast(trim(f[1]) as bigint)')} when regexp_full_match(trim(f[1]), '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}[ T][0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}') then epoch_ms(try_strptime(replace(trim(f[1]), 'T', ' '), '%Y-%m-%d %H:%M:%S')) end as ms"),
    "watchlist_left_join": f"with {_THREADS} select s.id, s.created_utc, g.comments, g.newest from subs s left join (select submission_id, count(*) as comments, max(created_utc) as newest from com group by 1) g on s.id = g.submission_id",
    "semi_parent": f"with {_THREADS} select com.id, com.submission_id, com.created_utc from com semi join subs on com.submission_id = subs.id",
    "latest_per_group": "select subreddit, arg_max(doc_id, (created_utc, doc_id)) as doc_id from documents where source = 'submissions' and subreddit is not null and created_utc is not null group by 1",
    "activity_decay": f"with {_THREADS}, l as (select submission_id, list_sort(list(created_utc)) as l from com group by 1), s as (select submission_id, l, list_sum(list_transform(l, lambda t: exp(-0.075 * (l[-1] - t) / 3600.0))) as score from l) select submission_id, {_rd('score', 'score', 6)}, (l[-1] - l[1]) / 3600.0 <= 168 and score >= 0.55 as active from s",
    "stream_trade_counts_1d": f"with x as (select {_S} as symbol, {_ms('transact_time')} as t, quantity from futures_aggtrades where transact_time is not null), y as (select symbol, t // {DAY} * {DAY} + {DAY} as create_time, count(*) as deliveries, count(quantity) as quantities from x group by 1, 2) select * from y where create_time <= (select max(t) from x)",
    "stream_last_bars": f"with x as (select {_S} as symbol, {_CLOSE} - 60000 as t, delivery_id, close, volume from futures_klines where {_CLOSE} is not null) select * from x qualify row_number() over (partition by symbol, t order by delivery_id desc) = 1",
    "bot_flag": f"select doc_id, case when doc_id % 5 != 0 then case when coalesce(lower(author) = 'deskrelay', false) or coalesce(regexp_matches(lower(text), '{BOT_SAYS}'), false) then 1 else 0 end end as bot from documents",
    "language_rule": "select doc_id, case when text is null or not regexp_matches(text, '\\p{L}') then 'empty' when length(regexp_replace(text, '[^A-Za-z]', '', 'g')) >= 0.9 * length(regexp_replace(text, '[^\\p{L}]', '', 'g')) then 'en' else 'non-en' end as language from documents",
    "sentiment_ensemble": "with p as (select doc_id, [" + ", ".join(f"((doc_id * {5 + 3 * i}) % 17 + 1) / 18.0 * {social.ENSEMBLE[0][i]} + ((doc_id * {7 + 3 * i}) % 17 + 1) / 18.0 * {social.ENSEMBLE[1][i]}" for i in range(3)) + "] as w from documents), q as (select doc_id, list_transform(w, lambda x: x / (w[1] + w[2] + w[3])) as w from p) select doc_id, cast(list_position(w, list_max(w)) - 1 as int) as sentiment from q",
    "dashboard_klines": f"with {_M} " + " union all ".join(f"select symbol, '{k}' as interval, t // {n} * {n} as open_time, t // {n} * {n} + {n - 1} as close_time, arg_min_null(open, t) as open, max(high) as high, min(low) as low, arg_max_null(close, t) as close from minutes group by 1, 2, 3, 4" for k, n in dashboard.INTERVALS.items()),
    "dashboard_metrics": f"with {_R} " + " union all ".join(f"select symbol, '{k}' as interval, (t - 1) // {n} * {n} + {n} as create_time, {', '.join(f'arg_max({c}, t) as {c}' for c in trade_stats.METRICS)} from snaps group by 1, 2, 3 having {' or '.join(f'count({c}) > 0' for c in trade_stats.METRICS)}" for k, n in dashboard.INTERVALS.items() if k in dashboard.READINGS),
    "dashboard_sentiment": _dashboard_moods_sql(),
    "derivative_trades": f"{_SIDED}, c as (select symbol, create_time, cast(count(*) as double) as n, cast(count_if(buy) as double) as b, cast(count_if(up) as double) as u from g group by 1, 2) select symbol, create_time, {_rd(_share('b', 'n'), 'imbalance_buy_count', 7)}, {_rd(_share('u', 'n'), 'imbalance_tickup_count', 7)} from c",
    "gap_ends": f"with {_R}, " + ", ".join(_ends_sql(k) for k in (HOUR, 4 * HOUR)) + f" select symbol, boundary, {HOUR} as step from gone{HOUR} union all (select symbol, boundary, {4 * HOUR} from gone{4 * HOUR} union select distinct g.symbol, (g.boundary - 1) // {4 * HOUR} * {4 * HOUR} + {4 * HOUR}, {4 * HOUR} from gone{HOUR} g semi join want{4 * HOUR} w on g.symbol = w.symbol and (g.boundary - 1) // {4 * HOUR} * {4 * HOUR} + {4 * HOUR} = w.boundary)",
    "gap_within": f"with {_M}, n as (select symbol, t, lead(t) over (partition by symbol order by t) as next from minutes) select symbol, 'internal' as kind, {_GAP_COLUMNS} from n where next - t > 61000 and t + 1 >= (select max(t) from minutes) - 7 * 86400000",
    **{query: _family_sql(name, step) for query, (name, step) in FAMILY_QUERIES.items()},
}
