"""Distribution statistics of trades and of readings per period."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelattice.functions.normalize import fill_zero_gaps
from tidelattice.functions.safe import corr, moments, nearest_rank
from tidelattice.operators.bars import bucket
from tidelattice.session import cut, lookup

_QUANTILES = (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))


def _zero(a: Column) -> Column:
    return F.coalesce(a, F.lit(0.0))


def _distribution(x: Column, name: str) -> list[Column]:
    """mean, std, min, max, skew, kurtosis of an aggregate; undefined figures are 0.0. All are partial before a shuffle."""
    skew, kurt = moments(x)
    return [_zero(F.avg(x)).alias(f"{name}_mean"), _zero(F.stddev_samp(x)).alias(f"{name}_std"), _zero(F.min(x)).alias(f"{name}_min"), _zero(F.max(x)).alias(f"{name}_max"), skew.alias(f"{name}_skew"), kurt.alias(f"{name}_kurtosis")]


def _sorted(x: Column, name: str) -> Column:
    return F.array_sort(F.collect_list(x)).alias(f"{name}_sorted_")


def _with_quantiles(df: DataFrame, names: list[str]) -> DataFrame:
    ranks = [_zero(nearest_rank(F.col(f"{n}_sorted_"), q)).alias(f"{n}_{p}") for n in names for p, q in _QUANTILES]
    return df.select("*", *ranks).drop(*[f"{n}_sorted_" for n in names])


#: Parts of a period within which trades are put in order.
SLICES = 256
#: Trades of a symbol and period from which its quantiles are found by counting instead of in arrays of one row.
HOT = 1_000_000
#: Bins to a doubling in which values are counted first.
FINE = 4096


def hot_ranks(rows: DataFrame, key: list[str], columns: dict[str, Column]) -> DataFrame:
    """Exact nearest-rank quantiles <name>_p25, _p50, _p75 of groups of any size; columns: name to value, of which nulls don't count.

    Counts by group and bin find the bin that a rank lies in; only values of those bins are put in order then, equal ones as one. Both counts are partial before
    the shuffle, and no task orders more than a group's bins or the different values of one of them.
    """
    each = rows.select(*key, F.explode(F.array(*[F.struct(F.lit(n).alias("name"), c.cast("double").alias("v")) for n, c in columns.items()])).alias("x")).select(*key, "x.name", "x.v").filter("v is not null")
    v, far = F.col("v"), 1 << 24
    size = F.floor(F.log2(F.abs(v)) * FINE) + far
    each = each.withColumn("bin", F.when(v > 0, size).when(v < 0, -size).otherwise(0).cast("long"))
    of = [*key, "name"]
    bins = each.groupBy(*of, "bin").agg(F.count("*").alias("n"))
    before = Window.partitionBy(*of).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select("*", _count_before(before).alias("before"), F.sum("n").over(Window.partitionBy(*of)).alias("whole"))
    wanted = bins.select(*of, "bin", "n", "before", F.explode(F.array(*[F.struct(F.lit(p).alias("part"), F.round((F.col("whole") - 1) * F.lit(q)).cast("long").alias("rank")) for p, q in _QUANTILES])).alias("w"))
    wanted = wanted.filter((F.col("w.rank") >= F.col("before")) & (F.col("w.rank") < F.col("before") + F.col("n"))).select(*of, "bin", "w.part", (F.col("w.rank") - F.col("before")).alias("rank"))
    values = each.join(wanted.select(*of, "bin").distinct(), [*of, "bin"], "left_semi").groupBy(*of, "bin", "v").agg(F.count("*").alias("n"))
    within = Window.partitionBy(*of, "bin").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    values = values.select("*", _count_before(within).alias("before"))
    got = values.join(wanted, [*of, "bin"]).filter((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("n")))
    return got.groupBy(*key).agg(*[F.max(F.when((F.col("name") == n) & (F.col("part") == p), F.col("v"))).alias(f"{n}_{p}") for n in columns for p, _ in _QUANTILES])


def _count_before(w) -> Column:
    return F.coalesce(F.sum("n").over(w), F.lit(0))


def _gaps(name: str, edges: Column) -> list[Column]:
    """Mean and deviation of the times between trades: sums within slices (already aggregated under <name>_n_, _sum_, _squares_) and the steps from slice to slice."""
    steps = F.zip_with(F.slice(edges, 2, SLICES), edges, lambda b, a: (b["first"] - a["last"]).cast("double"))
    steps = F.filter(steps, lambda x: x.isNotNull())
    add = lambda f: F.aggregate(F.transform(steps, f), F.lit(0.0), lambda a, x: a + x)
    n = F.col(f"{name}_n_") + F.size(steps)
    total, squares = _zero(F.col(f"{name}_sum_")) + add(lambda x: x), _zero(F.col(f"{name}_squares_")) + add(lambda x: x * x)
    mean = F.try_divide(total, F.nullif(n, F.lit(0)))
    std = F.when(n > 1, F.sqrt(F.greatest(squares - total * mean, F.lit(0.0)) / (n - 1)))
    return [_zero(mean).alias(f"{name}_rate_mean"), _zero(std).alias(f"{name}_rate_std")]


def trade_features(rows: DataFrame, step: int, hot: int = HOT) -> DataFrame:
    """All trade aggregates per symbol and period, labelled by its end ([b - step, b)).

    Only times between trades and rises need an order; they are found within SLICES parts of a period, whose ends are then put together (a row of at most SLICES
    parts a period). Everything else is a partial aggregate. Quantiles are taken from arrays of a period's values where these are fewer than `hot`, else by
    counting (`hot_ranks`); both are exact. So one symbol and period may hold any share of all trades.
    """
    key = ["symbol", "create_time"]
    rows = rows.withColumn("create_time", bucket("t", step, "end")).withColumn("buy_", F.coalesce(~F.col("is_buyer_maker"), F.lit(False)))
    # a correlation doesn't change with the instant that times are counted from
    rows = rows.withColumn("since_", (F.col("t") - F.col("create_time") + step).cast("double")).withColumn("slice_", F.floor(F.col("since_") * SLICES / step).cast("int"))
    sides = {"trade": F.lit(True), "buy": F.col("buy_")}
    of = lambda c, on: F.when(on, F.col(c) if isinstance(c, str) else c)
    values = {f"{label}_{c}": of(c, on) for label, on in sides.items() for c in ("price", "quantity")}

    part = Window.partitionBy(*key, "slice_")
    w = part.orderBy("t", "agg_trade_id")
    before = F.last(of("t", F.col("buy_")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    point = F.struct("t", "agg_trade_id", "price")
    end = F.struct(F.min(point).over(part).alias("first"), F.max(point).over(part).alias("last"), F.min(of("t", F.col("buy_"))).over(part).alias("first_buy"), F.max(of("t", F.col("buy_"))).over(part).alias("last_buy"))
    rows = rows.select("*", (F.col("t") - F.lag("t").over(w)).cast("double").alias("trade_gap_"), of((F.col("t") - before).cast("double"), F.col("buy_")).alias("buy_gap_"), F.coalesce(F.col("price") > F.lag("price").over(w), F.lit(False)).alias("up_"), F.when(F.lead("t").over(w).isNull(), end).alias("end_"))

    big = rows.groupBy(*key).agg(F.count("*").alias("n_")).filter(F.col("n_") >= hot).select(*key)
    big = cut(big)
    any_big = not big.isEmpty()
    if any_big:
        rows = rows.join(lookup(big.withColumn("big_", F.lit(True))), key, "left").withColumn("big_", F.coalesce("big_", F.lit(False)))
    turnover = F.col("price") * F.col("quantity")
    aggs: list[Column] = [F.collect_list("end_").alias("ends_"), F.count_if("up_").alias("ups_")]
    for n, x in values.items():
        aggs += [*_distribution(x, n), _sorted(F.when(~F.col("big_"), x) if any_big else x, n)]
    for label, on in sides.items():
        gap = F.col(f"{label}_gap_")
        aggs += [F.count(gap).alias(f"{label}_n_"), F.sum(gap).alias(f"{label}_sum_"), F.sum(gap * gap).alias(f"{label}_squares_")]
        aggs += [
            _zero(F.try_divide(F.sum(of(turnover, on)), F.nullif(F.sum(of("quantity", on)), F.lit(0.0)))).alias(f"{label}_vwap"),
            F.count_if(on).cast("double").alias(f"{label}_count"),
            _zero(F.stddev_samp(of(turnover, on))).alias(f"{label}_turnover_std"),
            corr("price", "quantity", on).alias(f"{label}_corr_price_quantity"),
            corr("price", "since_", on).alias(f"{label}_corr_price_time"),
            corr("quantity", "since_", on).alias(f"{label}_corr_quantity_time"),
        ]
    out = _with_quantiles(rows.groupBy(*key).agg(*aggs), list(values)).withColumn("ends_", F.array_sort("ends_"))
    buys = F.filter("ends_", lambda e: e["first_buy"].isNotNull())
    rises = F.zip_with(F.slice("ends_", 2, SLICES), F.col("ends_"), lambda b, a: F.when(b["first"]["price"] > a["last"]["price"], 1).otherwise(0))
    # the longer array has no partner for its last member, which counts nothing
    ticks = (F.col("ups_") + F.aggregate(rises, F.lit(0), lambda a, x: a + x)).cast("double").alias("tickup_count")
    times = F.transform("ends_", lambda e: F.struct(e["first"]["t"].alias("first"), e["last"]["t"].alias("last")))
    buy_times = F.transform(buys, lambda e: F.struct(e["first_buy"].alias("first"), e["last_buy"].alias("last")))
    out = out.select("*", *_gaps("trade", times), *_gaps("buy", buy_times), ticks)
    out = out.drop("ends_", "ups_", *[f"{label}_{x}_" for label in sides for x in ("n", "sum", "squares")])
    if any_big:
        exact = hot_ranks(rows.filter("big_"), key, values)
        names = [f"{n}_{p}" for n in values for p, _ in _QUANTILES]
        out = out.join(lookup(exact.withColumnsRenamed({n: f"{n}_hot_" for n in names})), key, "left")
        out = out.select(*[F.coalesce(f"{c}_hot_", c).alias(c) if c in names else c for c in out.columns if not c.endswith("_hot_")])
    return out


METRIC_DISTRIBUTIONS = ["sum_open_interest", "sum_open_interest_value"]
METRIC_RATIOS = ["count_toptrader_long_short_ratio", "sum_toptrader_long_short_ratio", "count_long_short_ratio", "sum_taker_long_short_vol_ratio"]
METRICS = METRIC_DISTRIBUTIONS + METRIC_RATIOS


def metric_features(rows: DataFrame, step: int) -> DataFrame:
    """All aggregates of readings per symbol and period (b - step, b], labelled by its end; zeros are filled from their neighbours in the period first."""
    key = ["symbol", "create_time"]
    rows = fill_zero_gaps(rows.withColumn("create_time", bucket("t", step, "end_closed")), METRICS, key, ["t"])
    aggs = [a for c in METRIC_DISTRIBUTIONS for a in (*_distribution(F.col(c), c), _sorted(F.col(c), c))]
    aggs += [a for c in METRIC_RATIOS for a in (_zero(F.avg(c)).alias(f"{c}_mean"), _zero(F.stddev_samp(c)).alias(f"{c}_std"))]
    aggs += [F.max_by(c, "t").alias(f"{c}_last") for c in METRICS]
    return _with_quantiles(rows.groupBy(*key).agg(*aggs), METRIC_DISTRIBUTIONS)


def last_non_null(rows: DataFrame, step: int) -> DataFrame:
    """Last value of each column that isn't null, per symbol and period; periods with nothing at all are left out."""
    out = rows.groupBy("symbol", bucket("t", step, "end_closed").alias("create_time")).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("t"))).alias(c) for c in METRICS])
    return out.dropna(how="all", subset=METRICS)


def last_row(rows: DataFrame, step: int) -> DataFrame:
    """The last row of each symbol and period, with its nulls."""
    out = rows.groupBy("symbol", bucket("t", step, "end_closed").alias("create_time")).agg(F.max_by(F.struct(*METRICS), "t").alias("x"))
    return out.select("symbol", "create_time", "x.*")
