"""Totals and averages over trailing periods of calendar days, for every entity and day.

Every entity's days are cut into blocks; a row goes to the block of its day and, near a block's end, to the next one too, whose first windows
reach back to it. So no group grows with an entity's history. In a block, sorted by day, a two-stack queue holds the window: arriving values
are folded onto the back stack's running aggregate; when the front stack is empty the back stack is turned over, which leaves at each depth the
fold of all that is still to leave. The window's aggregate is the fold of both tops. It needs an associative operation but no inverse, so
minima and maxima work as well as totals. Because a window of w days turns over every w days, both stacks of a whole block are two
accumulations over rows of w values.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelattice.operators.chunks import segments

#: Days in a block.
BLOCK = 512


class TwoStackQueue:
    """The queue one value at a time; `window` is the same for a whole array."""

    def __init__(self, op: Callable, identity) -> None:
        self.op, self.identity = op, identity
        self.front: list[tuple] = []  # (value, fold of it and all below)
        self.back: list = []
        self.top = identity

    def push(self, x) -> None:
        self.back.append(x)
        self.top = self.op(self.top, x)

    def pop(self) -> None:
        if not self.front:
            fold = self.identity
            for x in reversed(self.back):
                fold = self.op(x, fold)
                self.front.append((x, fold))
            self.back, self.top = [], self.identity
        self.front.pop()

    def fold(self):
        return self.op(self.front[-1][1], self.top) if self.front else self.top


#: Operations by name, with their identities.
MONOIDS: dict[str, tuple[np.ufunc, float]] = {"total": (np.add, 0.0), "low": (np.minimum, np.inf), "high": (np.maximum, -np.inf)}


def window(x: np.ndarray, w: int, op: np.ufunc, identity: float) -> np.ndarray:
    """Fold of the last w values at each position from the w-th on."""
    n = len(x)
    grid = np.concatenate([x, np.full(-n % w, identity)]).reshape(-1, w)
    back = op.accumulate(grid, axis=1).ravel()
    front = op.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    last = np.arange(w - 1, n)
    first = last - w + 1
    return np.where(first % w == 0, back[last], op(front[first], back[last]))


#: Rows of a result that are handed over at once.
OUT = 100_000


def _block(g: dict[str, np.ndarray], measures: list[str], windows: list[int], aggregates: list[str]) -> dict[str, np.ndarray]:
    """One block of an entity: its control row (first and last day of the entity) comes first, then the rows of the days that its windows reach."""
    block, first, last = (int(g[c][0]) for c in ("block", "first", "last"))
    reach = max(windows) - 1
    begin, stop = max(first, block * BLOCK), min(last, block * BLOCK + BLOCK - 1)
    n = stop - begin + 1
    at = g["day"][1:] - (begin - reach)
    inside = (at >= 0) & (at < n + reach)
    day = np.arange(begin, stop + 1)
    out = {"entity": np.full(n, g["entity"][0], object), "day": day, "nth": day - first + 1}
    for m in measures:
        v = g[m][1:].astype(float)
        use = inside & np.isfinite(v)
        for a in aggregates:
            op, identity = MONOIDS[a]
            x = np.full(n + reach, identity)
            x[at[use]] = v[use]
            for w in windows:
                got = window(x[reach - w + 1 :], w, op, identity)
                out[f"{m}_{a}_{w}"] = np.where(np.isinf(got), np.nan, got)
    return out


def _blocks(batches: Iterator[pd.DataFrame], measures: list[str], windows: list[int], aggregates: list[str]) -> Iterator[pd.DataFrame]:
    """All blocks of a sorted partition."""
    parts: list[dict[str, np.ndarray]] = []
    rows = 0
    for g in segments(batches, ["entity", "block"]):
        if not g["control"][0]:
            continue
        parts.append(_block(g, measures, windows, aggregates))
        rows += len(parts[-1]["day"])
        if rows >= OUT:
            yield pd.DataFrame({c: np.concatenate([p[c] for p in parts]) for c in parts[0]})
            parts, rows = [], 0
    if parts:
        yield pd.DataFrame({c: np.concatenate([p[c] for p in parts]) for c in parts[0]})


def trailing(rows: DataFrame, entity: str, day: Column, order: str, measures: list[str], windows: list[int], aggregates: tuple[str, ...] = ("total",)) -> DataFrame:
    """(entity, day, nth, <measure>_<aggregate>_<window>...) for each entity and each day from its first to its last; nth counts days from 1.

    day: date of a row; of several rows of an entity and day the one with the greatest `order` counts, also where its value is null. A day
    without a row or without a finite value adds nothing (0 to totals); where a window has no value, minima and maxima are null. Totals divided
    by the window's length are its averages. Rows without entity or day are left out; an empty table gives an empty one; ties of `order` on equal rows
    don't matter, on different ones the greater values count. Further columns are ignored.
    """
    number = F.unix_date(day.cast("date"))
    named = rows.select(F.col(entity).alias("entity"), number.alias("day"), F.col(order).alias("order"), *[F.col(m).cast("double").alias(m) for m in measures]).filter("entity is not null and day is not null")
    latest = named.groupBy("entity", "day").agg(F.max(F.struct("order", *measures)).alias("x")).select("entity", "day", *[f"x.{m}" for m in measures])
    spans = named.groupBy("entity").agg(F.min("day").alias("first"), F.max("day").alias("last"))
    block = lambda c: F.floor(c / BLOCK).cast("int")
    control = spans.select("entity", F.explode(F.sequence(block(F.col("first")), block(F.col("last")))).alias("block"), F.lit(0).alias("day"), F.lit(True).alias("control"), "first", "last", *[F.lit(None).cast("double").alias(m) for m in measures])
    both = F.array_distinct(F.array(block(F.col("day")), block(F.col("day") + max(windows) - 1)))
    copies = latest.select("entity", F.explode(both).alias("block"), "day", F.lit(False).alias("control"), F.lit(0).alias("first"), F.lit(0).alias("last"), *measures)
    names, spans_, kinds = list(measures), list(windows), list(aggregates)
    kind = rows.schema[entity].dataType.simpleString()
    schema = f"entity {kind}, day int, nth int, " + ", ".join(f"`{m}_{a}_{w}` double" for m in names for a in kinds for w in spans_)
    ordered = control.unionByName(copies).repartition("entity", "block").sortWithinPartitions("entity", "block", F.desc("control"), "day")
    return ordered.mapInPandas(lambda batches: _blocks(batches, names, spans_, kinds), schema)
