"""Filling gaps of a serving table: what is missing, its features over the complete series, and the rows after it that depend on it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelattice.operators import features, gaps
from tidelattice.session import cut
from tidelattice.sinks.lake import upsert
from tidelattice.sources.lake import read_or_none


def to_fill(wanted: DataFrame, existing: DataFrame, key: list[str], time: str) -> DataFrame:
    """(key, time) of the boundaries that lack."""
    return gaps.missing(wanted, existing.select(*key, F.col(time).alias("boundary")), key).select(*key, F.col("boundary").alias(time))


def touched(series: DataFrame, missing: DataFrame, key: list[str], time: str, reach: int = features.HISTORY) -> DataFrame:
    """(key, time) of the rows of a series that are missing or lie within `reach` rows after a missing one."""
    w = Window.partitionBy(*key).orderBy(time).rowsBetween(-reach, 0)
    marked = series.select(*key, time).join(missing.select(*key, time, F.lit(1).alias("gone_")), [*key, time], "left")
    return marked.withColumn("near_", F.max("gone_").over(w)).filter("near_ = 1").select(*key, time)


def fill(family: str, aggregate: Callable[[], DataFrame], path: str, key: list[str], step: int, convention: str, also: DataFrame | None = None) -> int:
    """Fills a family's table at `path` from `aggregate()`, the base rows of all boundaries that the lake can give; returns how many rows were written.

    All dates are one job: features run once over the complete ordered series, and only the missing rows and those that depend on them are upserted.
    also: (key, boundary) of further rows to compute again.
    """
    f = features.FAMILIES[family]
    base = aggregate()
    stored = read_or_none(base.sparkSession, path)
    if stored is None:
        raise ValueError(f"no table at {path}")
    missing = to_fill(gaps.expected(_spans(base, key, f.time, step, convention), step, convention), stored, key, f.time)
    if also is not None:
        missing = missing.unionByName(also.select(*key, F.col("boundary").alias(f.time))).distinct()
    missing = missing.join(base.select(*key, f.time), [*key, f.time], "left_semi")
    rows = features.features(family, base, key).join(touched(base, missing, key, f.time), [*key, f.time], "left_semi")
    n = rows.count()
    if n:
        upsert(rows, path, [*key, f.time])
    return n


def _spans(base: DataFrame, key: list[str], time: str, step: int, convention: str) -> DataFrame:
    return base.groupBy(*key).agg(F.min(time).alias("first"), (F.max(time) + (step if convention == "open" else 0)).alias("last"))


def fill_all(family: str, aggregate: Callable[[int], DataFrame], paths: dict[int, str], key: list[str], convention: str) -> dict[int, int]:
    """`fill` of the tables of several steps; what is missing in a finer one is computed again in the coarser ones that it falls in. Returns rows written by step."""
    f = features.FAMILIES[family]
    base = {step: aggregate(step) for step in paths}
    wanted = {step: gaps.expected(_spans(b, key, f.time, step, convention), step, convention) for step, b in base.items()}
    gone = {step: gaps.missing(wanted[step], read_or_none(b.sparkSession, paths[step]).select(*key, F.col(f.time).alias("boundary")), key) for step, b in base.items()}
    # what is missing is kept before any table is changed
    also = {step: cut(x) for step, x in gaps.propagate_all(gone, convention, wanted, key).items()}
    return {step: fill(family, lambda step=step: base[step], paths[step], key, step, convention, also[step]) for step in sorted(paths)}
