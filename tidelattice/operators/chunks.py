"""Long ordered series cut into chunks of equal length, each with its neighbours, whatever the length of a series."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def segments(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """The columns of each run of rows that agree in `keys`, from batches sorted by them; a run may go over several batches. Keys have no nulls."""
    held = None
    for b in batches:
        if not len(b):
            continue
        cols = {c: b[c].to_numpy() for c in b.columns}
        if held is not None:
            cols = {c: np.concatenate([held[c], a]) for c, a in cols.items()}
        change = np.zeros(len(cols[keys[0]]), bool)
        for k in keys:
            change[1:] |= cols[k][1:] != cols[k][:-1]
        bounds = [0, *np.flatnonzero(change).tolist()]
        for i, j in zip(bounds, bounds[1:]):
            yield {c: a[i:j] for c, a in cols.items()}
        held = {c: a[bounds[-1] :] for c, a in cols.items()}
    if held is not None:
        yield held


def dense_chunks(df: DataFrame, keys: list[str], order: list[str], coarse: Column, fields: list[str], length: int, halo: int) -> DataFrame:
    """The values of each field as a series of its own, cut into chunks: (keys, order, field, v, index_, total_, chunk_, core_).

    Each field's nulls and zeros are left out before places are counted: field is its number, index_ the place of a value in its series (from 0), total_ the length of the series.
    A value is in its own chunk (core_) and in a neighbouring one if it lies within `halo` of it.
    coarse: a value that never falls along the order; the places within one value of it are counted in one task, the places before it come
    from a running sum over the counts. So no task ever holds a whole series, and one series may have any share of all rows. Rows move once with all their fields, and once more by chunk.
    """
    df = df.select(*keys, *order, *fields, coarse.alias("coarse_"))
    part, n = [*keys, "coarse_"], range(len(fields))
    there = [(F.col(f).isNotNull() & (F.col(f) != 0)).cast("int") for f in fields]
    upto = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    places = df.select("*", *[F.sum(t).over(upto).alias(f"place_{i}") for i, t in enumerate(there)])
    counts = df.groupBy(*part).agg(*[F.sum(t).alias(f"n_{i}") for i, t in enumerate(there)])
    before = Window.partitionBy(*keys).orderBy("coarse_").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*part, *[F.coalesce(F.sum(f"n_{i}").over(before), F.lit(0)).alias(f"offset_{i}") for i in n], *[F.sum(f"n_{i}").over(Window.partitionBy(*keys)).alias(f"total_{i}") for i in n])
    whole = places.join(offsets, part)
    values = F.array(*[F.struct(F.lit(i).cast("tinyint").alias("field"), F.col(f).cast("double").alias("v"), (F.col(f"offset_{i}") + F.col(f"place_{i}") - 1).alias("index_"), F.col(f"total_{i}").alias("total_")) for i, f in enumerate(fields)])
    each = whole.select(*keys, *order, F.explode(values).alias("x")).select(*keys, *order, "x.*").filter("v is not null and v != 0")
    own = F.floor(F.col("index_") / length)
    shifted = [F.floor((F.col("index_") + d) / length) for d in (-halo, halo)]
    copies = each.withColumn("own_", own).withColumn("chunk_", F.explode(F.array_distinct(F.array(F.col("own_"), *shifted))))
    return copies.withColumn("core_", F.col("chunk_") == F.col("own_")).drop("own_").filter("chunk_ >= 0")
