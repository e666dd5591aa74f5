"""Irregular readings as a regular series per source, with every missing period filled and marked.

A source's periods are cut into blocks, so no task holds more than a block of a source. What a block needs from outside is the nearest usable
reading before and after it; that comes from summaries of the blocks (a row a block, over which the carry runs), not from other blocks' rows.
In a block, the sorted grid and the sorted readings are merged as of each grid instant in both directions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelattice.functions.normalize import floor_div
from tidelattice.operators.chunks import segments
from tidelattice.session import cut

#: Periods in a block.
BLOCK = 1024
OBSERVED, INTERPOLATED, HELD, AHEAD, NONE = "observed", "interpolated", "held", "ahead", "none"


#: Rows of a result that are handed over at once.
OUT = 100_000


def _merge(g: dict[str, np.ndarray], fields: list[str], step: int, gap_ms: int) -> dict[str, np.ndarray]:
    """One block: its control row with the source's first and last period and the neighbours outside comes first, then its periods with readings."""
    block, first, last = (int(g[c][0]) for c in ("block", "first", "last"))
    begin, stop = max(first, block * BLOCK), min(last, block * BLOCK + BLOCK - 1)
    grid = np.arange(begin, stop + 1)
    n = len(grid)
    at = g["period"][1:] - begin
    out = {"source": np.full(n, g["source"][0], object), "at": grid * step}
    for i, f in enumerate(fields):
        has = g[f"n{i}"][1:] > 0
        pos = at[has]
        # as of: index of the nearest period with a reading, on either side
        before, after = np.full(n, -1), np.full(n, n)
        before[pos] = after[pos] = pos
        before = np.maximum.accumulate(before)
        after = np.minimum.accumulate(after[::-1])[::-1]
        # neighbours' times and values; slot n is the carried one
        lt, lv, rt, rv = (np.full(n + 1, np.nan) for _ in range(4))
        for arr, c in ((lt, "lt"), (lv, "lv"), (rt, "ft"), (rv, "fv")):
            column = g[f"{c}{i}"]
            arr[pos] = column[1:][has]
            arr[n] = column[0]
        b = np.where(before < 0, n, before)
        t0, v0, t1, v1 = lt[b], lv[b], rt[after], rv[after]
        seen = np.zeros(n, bool)
        seen[pos] = True
        with np.errstate(all="ignore"):
            between = v0 + (v1 - v0) * ((grid * step - t0) / (t1 - t0))
        near = ~np.isnan(t0) & ~np.isnan(t1) & (t1 - t0 <= gap_ms)
        out[f] = np.where(seen, lv[:n], np.where(near, between, np.where(np.isnan(v0), v1, v0)))
        out[f"{f}_state"] = np.select([seen, near, ~np.isnan(v0), ~np.isnan(v1)], range(4), 4)
    return out


_STATES = np.array([OBSERVED, INTERPOLATED, HELD, AHEAD, NONE], object)


def _merged(batches: Iterator[pd.DataFrame], fields: list[str], step: int, gap_ms: int) -> Iterator[pd.DataFrame]:
    """All blocks of a sorted partition."""
    parts: list[dict[str, np.ndarray]] = []
    rows = 0

    def done() -> pd.DataFrame:
        out = {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}
        return pd.DataFrame(out | {f"{f}_state": _STATES[out[f"{f}_state"]] for f in fields})

    for g in segments(batches, ["source", "block"]):
        if not g["control"][0]:
            continue
        parts.append(_merge(g, fields, step, gap_ms))
        rows += len(parts[-1]["at"])
        if rows >= OUT:
            yield done()
            parts, rows = [], 0
    if parts:
        yield done()


def regular_grid(rows: DataFrame, source: str, time_ms: Column, order: str, fields: list[str], step_ms: int, gap_ms: int, usable=lambda v: v > 0) -> DataFrame:
    """(source, at, <field>, <field>_state ...) for every period [at, at + step_ms) of a source from that of its first row to that of its last.

    usable: which finite values count; others are as if missing. state: `observed` (the period's last usable reading by time, then `order`);
    `interpolated` at the period's start between the neighbours, weighted by time, if these are at most gap_ms apart; `held` (the value before,
    neighbours too far apart or none after); `ahead` (the value after, none before); `none` (null: the source has no usable reading).
    Rows without source or time are left out; an empty table gives an empty one; repeated rows and further columns change nothing.
    """
    v = [F.col(f).cast("double") for f in fields]
    ok = [F.when(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")) & usable(x), F.struct(F.col("t"), F.col("o"), x.alias("v"))) for x in [F.col(f"v{i}") for i in range(len(fields))]]
    r = rows.select(F.col(source).alias("source"), time_ms.cast("long").alias("t"), F.col(order).alias("o"), *[x.alias(f"v{i}") for i, x in enumerate(v)]).filter("source is not null and t is not null")
    r = r.withColumn("period", floor_div("t", step_ms))
    by_period = r.groupBy("source", "period").agg(*[a for i, x in enumerate(ok) for a in (F.min(x).alias(f"f{i}"), F.max(x).alias(f"l{i}"))])
    by_period = cut(by_period.withColumn("block", F.floor(F.col("period") / BLOCK)))  # read three times from here on
    spans = by_period.groupBy("source").agg(F.min("period").alias("first"), F.max("period").alias("last"))
    blocks = spans.select("source", "first", "last", F.explode(F.sequence(F.floor(F.col("first") / BLOCK), F.floor(F.col("last") / BLOCK))).alias("block"))
    held = by_period.groupBy("source", "block").agg(*[a for i in range(len(fields)) for a in (F.min(f"f{i}").alias(f"f{i}"), F.max(f"l{i}").alias(f"l{i}"))])
    blocks = blocks.join(held, ["source", "block"], "left")
    past = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    future = Window.partitionBy("source").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    n = range(len(fields))
    carry = [c for i in n for c in (F.last(f"l{i}", ignorenulls=True).over(past).alias(f"l{i}"), F.last(f"f{i}", ignorenulls=True).over(future).alias(f"f{i}"))]
    flat = lambda: [c for i in n for c in (F.col(f"f{i}.t").cast("double").alias(f"ft{i}"), F.col(f"f{i}.v").alias(f"fv{i}"), F.col(f"l{i}.t").cast("double").alias(f"lt{i}"), F.col(f"l{i}.v").alias(f"lv{i}"), F.col(f"l{i}").isNotNull().cast("int").alias(f"n{i}"))]
    control = blocks.select("source", "block", "first", "last", *carry).select("source", "block", F.lit(0).cast("long").alias("period"), F.lit(True).alias("control"), "first", "last", *flat())
    data = by_period.select("source", "block", "period", F.lit(False).alias("control"), F.lit(0).cast("long").alias("first"), F.lit(0).cast("long").alias("last"), *flat())
    kind, names = rows.schema[source].dataType.simpleString(), list(fields)
    schema = f"source {kind}, at long, " + ", ".join(f"`{f}` double, `{f}_state` string" for f in names)
    ordered = control.unionByName(data).repartition("source", "block").sortWithinPartitions("source", "block", F.desc("control"), "period")
    return ordered.mapInPandas(lambda batches: _merged(batches, names, step_ms, gap_ms), schema)
