"""Finding and filling gaps: expected boundaries, what is missing, what it touches, and gaps inside stored periods."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelattice.functions.normalize import DAY_MS, snap
from tidelattice.operators.bars import bucket

#: Milliseconds between neighbours from which there is a gap, by source.
THRESHOLDS = {"futures_aggtrades": 15_000, "futures_klines": 61_000, "futures_metrics": 301_000, "futures_fundingrate": 28_801_000}


def expected(spans: DataFrame, step: int, convention: str, now: Column | None = None) -> DataFrame:
    """(key columns, boundary) of every boundary from first to last of each row of `spans`: `end` from the first at or after to the last at or before; `open` from the one that holds the first to the last that is closed by then."""
    keys = [c for c in spans.columns if c not in ("first", "last")]
    last = F.col("last") if now is None else now
    if convention == "open":
        a, b = snap("first", step), snap(last, step) - step
    else:
        a, b = snap(F.col("first") + step - 1, step), snap(last, step)
    return spans.select(*keys, F.explode(F.when(a <= b, F.sequence(a, b, F.lit(step).cast("long"))).otherwise(F.array().cast("array<bigint>"))).alias("boundary"))


def missing(wanted: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Wanted boundaries that don't exist, with their date."""
    out = wanted.join(existing.select(*keys, "boundary").dropna(), [*keys, "boundary"], "left_anti")
    return out.withColumn("date", F.to_date(F.timestamp_millis("boundary")))


def propagate(gone: DataFrame, step: int, coarser: int, convention: str, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Boundaries of a coarser step that a missing finer one falls in, as far as they are wanted."""
    label = bucket("boundary", coarser, "open" if convention == "open" else "end_closed")
    return gone.select(*keys, label.alias("boundary")).distinct().join(wanted.select(*keys, "boundary"), [*keys, "boundary"], "left_semi")


def internal_gaps(rows: DataFrame, keys: list[str], threshold: int) -> DataFrame:
    """Gaps between neighbours that are more than `threshold` ms apart: (keys, kind, start, end, hours); start and end are the first and last missing millisecond.

    Neighbours are found per day, so that a source's history is never in one task; the step from one day to the next comes from the days' ends.
    """
    day = snap("t", DAY_MS).alias("day")
    w = Window.partitionBy(*keys, "day").orderBy("t")
    inside = rows.select(*keys, "t", day).withColumn("next", F.lead("t").over(w)).select(*keys, "t", "next")
    ends = rows.groupBy(*keys, day).agg(F.min("t").alias("lo"), F.max("t").alias("hi"))
    across = ends.select(*keys, F.col("hi").alias("t"), F.lead("lo").over(Window.partitionBy(*keys).orderBy("day")).alias("next"))
    return _gap(inside.unionByName(across).filter(F.col("next") - F.col("t") > threshold), keys, "internal")


def _gap(df: DataFrame, keys: list[str], kind: str) -> DataFrame:
    return df.select(*keys, F.lit(kind).alias("kind"), (F.col("t") + 1).alias("start"), (F.col("next") - 1).alias("end"), ((F.col("next") - F.col("t")) / 3_600_000).alias("hours"))


def boundary_gaps(rows: DataFrame, keys: list[str], period: str, threshold: int) -> DataFrame:
    """Gaps between the last row of a stored period and the first of the next."""
    ends = rows.groupBy(*keys, period).agg(F.min("t").alias("lo"), F.max("t").alias("hi"))
    steps = ends.select(*keys, F.col("hi").alias("t"), F.lead("lo").over(Window.partitionBy(*keys).orderBy(period)).alias("next"))
    return _gap(steps.filter(F.col("next") - F.col("t") > threshold), keys, "boundary")


def recent_gap(rows: DataFrame, keys: list[str], threshold: int, now: int) -> DataFrame:
    """The gap between the last row and now, three thresholds of grace left out."""
    last = rows.groupBy(*keys).agg(F.max("t").alias("t")).withColumn("next", F.lit(now - 3 * threshold).cast("long"))
    return _gap(last.filter(F.col("next") - F.col("t") > threshold), keys, "recent")


def within(found: DataFrame, now: int, days: int) -> DataFrame:
    """Gaps that begin within the last `days` days: what a source still has."""
    return found.filter(F.col("start") >= now - days * DAY_MS)


def propagate_all(gone: dict[int, DataFrame], convention: str, wanted: dict[int, DataFrame], keys: list[str]) -> dict[int, DataFrame]:
    """Missing boundaries of all steps: those of each step and those that the missing ones of every finer step fall in, each once."""
    steps = sorted(gone)
    out = {}
    for step in steps:
        parts = [gone[step].select(*keys, "boundary")] + [propagate(gone[fine], fine, step, convention, wanted[step], keys) for fine in steps if fine < step]
        out[step] = reduce(DataFrame.unionByName, parts).distinct()
    return out
