"""Aggregates per period of event time that late records correct, up to a cut-off.

Two layers over one log. The fast layer turns each batch of arrivals into increments of provisional periods, which add up because every
measure is a commutative monoid. The batch layer recomputes, on a schedule, all periods that are still open from the full log (one copy of
each message), replaces the provisional values and freezes the periods whose cut-off has passed. Records later than the cut-off change
nothing and are kept apart.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelattice.functions.normalize import HOUR_MS, floor_div
from tidelattice.session import cut

ON_TIME, CORRECTED, DROPPED = "on_time", "corrected", "dropped"


@dataclass(frozen=True)
class Period:
    """length_ms; closed: the end that belongs to a period; a record is on time up to on_time_ms after the end, and corrects it up to cutoff_ms after."""

    length_ms: int = HOUR_MS
    closed: str = "left"
    on_time_ms: int = 60_000
    cutoff_ms: int = 1_800_000

    def end(self, t: Column | str) -> Column:
        """End of the period that an instant belongs to."""
        x = F.col(t) if isinstance(t, str) else t
        if self.closed == "left":
            return (floor_div(x, self.length_ms) + 1) * self.length_ms
        return (floor_div(x - 1, self.length_ms) + 1) * self.length_ms

    def outcome(self, end: Column, arrived_us: Column) -> Column:
        """What becomes of a record."""
        return F.when(arrived_us <= (end + self.on_time_ms) * 1000, ON_TIME).when(arrived_us <= (end + self.cutoff_ms) * 1000, CORRECTED).otherwise(DROPPED)


TRADES, BARS = Period(), Period(closed="right")
KEYS = ["topic", "symbol", "message_key"]


@dataclass(frozen=True)
class Shape:
    """Columns that aggregates take instead of the value, and further ones that are added up as total_<column>."""

    opening: str | None = None
    high: str | None = None
    low: str | None = None
    totals: tuple[str, ...] = ()

    def columns(self, value: str, weight: str) -> list[str]:
        return list(dict.fromkeys([value, weight, *[c for c in (self.opening, self.high, self.low) if c], *self.totals]))


PLAIN = Shape()


def messages(log: DataFrame, measures: list[str] = (), by: tuple[str, ...] = ()) -> DataFrame:
    """One row a message: first_us, when its earliest delivery arrived; event_ms, the greatest that any delivery states; the measures of its last delivery.

    The aggregates are partial before the shuffle, so a message with very many copies costs one row a task. by: columns that set a message's deliveries apart.
    """
    last = [F.max_by(F.struct(*measures), "delivery_id").alias("last")] if measures else []
    out = log.groupBy(*KEYS, *by).agg(F.min("arrived_us").alias("first_us"), F.max("event_ms").alias("event_ms"), *last)
    return out.select(*KEYS, *by, "first_us", "event_ms", *[F.col(f"last.{m}").alias(m) for m in measures])


def batch_records(log: DataFrame, period: Period, measures: list[str] = (), as_of_us: int | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """The batch layer's records: each message with its period's end and its outcome. as_of_us: arrivals after it are not known yet."""
    if as_of_us is not None:
        log = log.filter(F.col("arrived_us") <= as_of_us)
    m = messages(log.filter(F.col("symbol").isNotNull() & F.col("message_key").isNotNull()), measures, by).filter(F.col("event_ms").isNotNull())
    m = m.withColumn("period_end", period.end("event_ms"))
    return m.withColumn("outcome", period.outcome(F.col("period_end"), F.col("first_us")))


def _aggregates(value: str, weight: str, shape: Shape = PLAIN) -> list[Column]:
    v, w = F.col(value), F.col(weight)
    opening, high, low = (F.col(c or value) for c in (shape.opening, shape.high, shape.low))
    end = lambda x: F.when(x.isNotNull(), F.struct(F.col("event_ms").alias("t"), F.col("message_key").alias("k"), x.alias("v")))
    totals = [F.sum(c).alias(f"total_{c}") for c in shape.totals]
    return [F.count("*").alias("records"), F.count(v).alias("values"), F.sum(w).alias("weight"), F.sum(v * w).alias("weighted"), F.min(low).alias("low"), F.max(high).alias("high"), F.min(end(opening)).alias("first"), F.max(end(v)).alias("last"), *totals]


_MERGE = {"records": F.sum, "values": F.sum, "weight": F.sum, "weighted": F.sum, "low": F.min, "high": F.max, "first": F.min, "last": F.max}
VIEW_KEYS = ["topic", "symbol", "period_end"]


def fast_increment(batch: DataFrame, period: Period, value: str, weight: str, shape: Shape = PLAIN, by: tuple[str, ...] = ()) -> DataFrame:
    """One batch of arrivals as increments of its periods. Copies within the batch count once; copies in other batches count again until the batch layer replaces the period.

    by: columns that number the batches, where `batch` holds several; each has increments of its own.
    """
    rows = batch_records(batch, period, shape.columns(value, weight), by=by).filter(F.col("outcome") == ON_TIME)
    return rows.groupBy(*VIEW_KEYS, *by).agg(*_aggregates(value, weight, shape))


def add_increments(*parts: DataFrame) -> DataFrame:
    """Increments of any batches added up."""
    from functools import reduce

    both = reduce(DataFrame.unionByName, parts)
    totals = [F.sum(c).alias(c) for c in both.columns if c.startswith("total_")]
    return both.groupBy(*VIEW_KEYS).agg(*[f(c).alias(c) for c, f in _MERGE.items()], *totals)


#: Furthest apart that copies of one message state its time.
SKEW_MS = 86_400_000


def still_open(log: DataFrame, frozen: DataFrame, skew_ms: int = SKEW_MS) -> DataFrame:
    """What of the log can still matter to periods after the last frozen one, before anything is shuffled: deliveries of times up to skew_ms before its end are left out, those that state no time by their arrival."""
    last = frozen.filter(F.col("state") == "frozen").agg(F.max("period_end")).first()[0]
    if last is None:
        return log
    return log.filter(F.coalesce(F.col("event_ms"), F.floor(F.col("arrived_us") / 1000)) > last - skew_ms)


def recompute(log: DataFrame, period: Period, value: str, weight: str, as_of_us: int | None = None, frozen: DataFrame | None = None, shape: Shape = PLAIN, skew_ms: int = SKEW_MS) -> DataFrame:
    """The batch layer's view: all periods of the log except those in `frozen`, from every record up to the cut-off; corrected counts the late ones among them.

    state is `frozen` where the cut-off is before as_of_us (no as_of_us: everything is), else `open`. With `frozen` only the part of the log is read that open periods
    can need: copies of one message that state times more than skew_ms apart may then count as two.
    """
    if frozen is not None:
        log = still_open(log, frozen, skew_ms)
    rows = batch_records(log, period, shape.columns(value, weight), as_of_us).filter(F.col("outcome") != DROPPED)
    if frozen is not None:
        rows = rows.join(frozen.filter(F.col("state") == "frozen").select(*VIEW_KEYS), VIEW_KEYS, "left_anti")
    view = rows.groupBy(*VIEW_KEYS).agg(*_aggregates(value, weight, shape), F.count_if(F.col("outcome") == CORRECTED).alias("corrected"))
    done = F.lit(True) if as_of_us is None else (F.col("period_end") + period.cutoff_ms) * 1000 < as_of_us
    view = view.withColumn("state", F.when(done, "frozen").otherwise("open"))
    return view if frozen is None else view.unionByName(frozen.filter(F.col("state") == "frozen"))


def serve(batch_view: DataFrame, provisional: DataFrame) -> DataFrame:
    """What a reader sees: the batch layer's periods, and provisional ones the batch layer has not met."""
    new = provisional.join(batch_view.select(*VIEW_KEYS), VIEW_KEYS, "left_anti").withColumns({"corrected": F.lit(0).cast("long"), "state": F.lit("provisional")})
    return batch_view.unionByName(new)


def schedule(log: DataFrame, period: Period, runs: int) -> list[int]:
    """At most `runs` instants in us to recompute at, evenly far apart and each on_time_ms after a period's end; the last is the last such one among the arrivals."""
    first, last = log.agg(F.min("arrived_us"), F.max("arrived_us")).first()
    if last is None:
        return []
    step, on_time = period.length_ms * 1000, period.on_time_ms * 1000
    a, b = -(-(first - on_time) // step), (last - on_time) // step
    every = max(1, -(-(b - a + 1) // runs))
    return [n * step + on_time for n in range(b - (b - a) // every * every, b + 1, every)] if b >= a else []


def replay(log: DataFrame, period: Period, value: str, weight: str, batch: str, runs: int, shape: Shape = PLAIN) -> DataFrame:
    """What a reader sees after the last arrival: both layers over the arrivals as they came.

    The batch layer runs by `schedule`, each run on what had arrived and with the periods frozen before left as they are. It takes the periods that
    have ended; of later ones the increments of the batches (numbered in the column `batch`) are served. A frozen period keeps what was known when
    it froze: a copy that comes later and states another value or time changes it no more.
    """
    fast = add_increments(fast_increment(log, period, value, weight, shape, (batch,)))
    view = recompute(log.limit(0), period, value, weight, shape=shape)
    for at in schedule(log, period, runs):
        view = cut(recompute(log, period, value, weight, at, view, shape).filter(F.col("period_end") * 1000 <= at))
    return serve(view, fast)


def views(log: DataFrame, period: Period, value: str, weight: str, batch: str, now_us: int, shape: Shape = PLAIN) -> DataFrame:
    """What a reader sees at an instant at which the batch layer has just run: frozen and open periods that have ended from it, provisional ones from the increments of the batches."""
    known = log.filter(F.col("arrived_us") <= now_us)
    view = cut(recompute(known, period, value, weight, now_us, shape=shape).filter(F.col("period_end") * 1000 <= now_us))
    return serve(view, add_increments(fast_increment(known, period, value, weight, shape, (batch,))))


def late_records(log: DataFrame, period: Period) -> DataFrame:
    """(topic, symbol, message_key, outcome) of the messages that came late: `corrected` up to the cut-off, `dropped` after it.

    Nulls: a delivery without symbol or identity is no message; a message none of whose deliveries states its time belongs to no period. Ties and
    repeated rows: a message counts once, by its earliest arrival. Empty in, empty out; further columns are ignored.
    """
    return batch_records(log, period).filter(F.col("outcome") != ON_TIME).select(*KEYS, "outcome")
