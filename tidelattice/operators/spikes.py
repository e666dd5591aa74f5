"""Implausible measurements, against what is normal for their own source: impossible values, stuck runs and spikes.

Bounds find the impossible. A wavelet decomposition of each source's series (Haar, without decimation, two scales) gives detail coefficients.
Where one is DETAIL times the source's usual coefficient or more, the series has an edge; readings between two opposite edges that are a spike's width
apart are a spike's, and no others are: a lasting change of level has one edge only. Runs of zero coefficients at the finest scale (equal neighbours) are a stuck
sensor. An exact check follows on the readings between edges only: the distance from the level around (the nearest of the medians before, after and around),
in units of the source's usual distance, and that it is back on either side. Measurements that can't be negative vary in proportion to their level, so
distances are taken between logarithms.

Series are worked on in chunks with neighbours. A series that is one chunk is judged at once; chunks of a longer one pass on how often its coefficients
and distances have which size, which add up over chunks, and are judged by what comes out. So no task needs a whole series.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelattice.operators.chunks import dense_chunks, segments
from tidelattice.session import lookup, stored

#: Readings in a chunk and neighbours on either side.
CHUNK, HALO = 4096, 48
#: Readings on either side that make the level; equal readings in a stuck run; readings of a spike.
REACH, RUN, WIDTH = 8, 12, 3
#: Times the usual coefficient from which one is an edge, and times the usual spread from which a reading between edges is a spike.
DETAIL, FAR = 8.0, 10.0
#: Median distance to standard deviation for normal noise.
MAD = 1.4826
#: Sizes that are told apart within a doubling, and the number of that of zero.
STEPS, ZERO = 256, -(1 << 20)

BLOCK_MS = 172_800_000


def details(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Haar detail coefficients at two scales, without decimation: a reading against the one before, and two against the two before. Places without enough before them have none (0)."""
    fine, coarse = np.zeros(len(v)), np.zeros(len(v))
    fine[1:] = (v[1:] - v[:-1]) / 2
    coarse[3:] = (v[3:] + v[2:-1] - v[1:-2] - v[:-3]) / 4
    return fine, coarse


def between_edges(fine: np.ndarray, coarse: np.ndarray, usual: tuple[float, float]) -> np.ndarray:
    """Readings between opposite edges at most WIDTH apart at the finest scale, or as far as such a spike puts them at the coarser one."""
    out = np.zeros(len(fine), bool)
    for d, u, before, widest in ((fine, usual[0], 0, WIDTH), (coarse, usual[1], 1, WIDTH + 2)):
        if not u > 0:
            continue
        edges = np.flatnonzero(np.abs(d) >= DETAIL * u)
        up = d > 0
        for k in range(1, widest + 1):
            first = edges[edges + k < len(d)]
            first = first[(np.abs(d[first + k]) >= DETAIL * u) & (up[first + k] != up[first])]
            for step in range(-before, k):
                out[np.maximum(first + step, 0)] = True
    return out


def _around(x: np.ndarray, reach: int) -> np.ndarray:
    """(n, 2 * reach + 1) windows, NaN beyond the ends."""
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([np.full(reach, np.nan), x, np.full(reach, np.nan)]), 2 * reach + 1)


def _median(windows: np.ndarray) -> np.ndarray:
    """Median of each row without its NaNs; NaN for a row of nothing else."""
    s = np.sort(windows, axis=1)
    n = (~np.isnan(s)).sum(axis=1)
    at = np.arange(len(s))
    return (s[at, np.maximum(n - 1, 0) // 2] + s[at, n // 2]) / 2


def _stuck(v: np.ndarray) -> np.ndarray:
    """Members of runs of zero finest details long enough to be RUN equal readings."""
    if not len(v):
        return np.zeros(0, bool)
    cuts = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1], [True]]))
    return np.repeat(np.diff(cuts) >= RUN, np.diff(cuts))


def _distances(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Distance of the readings at some places from the nearest of the medians before, after and around them."""
    w = _around(x, REACH)[at]
    r = np.abs(x[at] - _median(w))
    for side in (w[:, :REACH], w[:, REACH + 1 :]):
        r = np.fmin(r, np.abs(x[at] - _median(side)))
    return r


def _spikes(x: np.ndarray, places: np.ndarray, far: float) -> np.ndarray:
    """Which of `places` are far from the level, in a run of at most WIDTH such readings that has others on either side."""
    if not len(places):
        return np.zeros(0, bool)
    near = np.arange(-WIDTH, WIDTH + 1)
    needed = np.unique(np.clip(places[:, None] + near, 0, len(x) - 1))
    r = np.full(len(x) + 2 * WIDTH, np.nan)
    r[needed + WIDTH] = _distances(x, needed)
    w = r[places[:, None] + near + WIDTH]
    there, away = ~np.isnan(w), w >= far
    run = [np.cumprod(side, axis=1).sum(axis=1) for side in (away[:, WIDTH - 1 :: -1], away[:, WIDTH + 1 :])]
    rows = np.arange(len(places))
    back = [np.where(n < WIDTH, there[rows, np.clip(WIDTH + s * (n + 1), 0, 2 * WIDTH)], False) for n, s in zip(run, (-1, 1))]
    return away[:, WIDTH] & (run[0] + run[1] + 1 <= WIDTH) & back[0] & back[1]


def _sizes(x: np.ndarray) -> np.ndarray:
    """Numbers of sizes, STEPS to a doubling."""
    with np.errstate(divide="ignore"):
        return np.where(x > 0, np.floor(np.log2(x) * STEPS), ZERO).astype(np.int32)


def _size(number: float) -> float:
    return 0.0 if number == ZERO else 2.0 ** ((number + 0.5) / STEPS)


STATS = ("around", "fine", "coarse")


def _look(v: np.ndarray):
    """What a chunk shows by itself: impossible and stuck readings, places and logarithms of the possible ones, their coefficients, and the sizes that scales are made of."""
    impossible = ~np.isfinite(v) | (v < 0)
    stuck = _stuck(v)
    places = np.flatnonzero(~impossible)
    x = np.log(v[places])
    return impossible, stuck, places, x, details(x)


def _kinds(v: np.ndarray, usual: dict[str, float], seen) -> np.ndarray:
    impossible, stuck, places, x, (fine, coarse) = seen
    spike = np.zeros(len(v), bool)
    if usual["around"] > 0:
        at = np.flatnonzero(between_edges(fine, coarse, (usual["fine"], usual["coarse"])))
        spike[places[at[_spikes(x, at, usual["around"] * FAR * MAD)]]] = True
    return np.where(impossible, "impossible", np.where(stuck, "stuck", np.where(spike, "spike", "")))


def _bad(g: dict[str, np.ndarray], kinds: np.ndarray) -> dict:
    at = np.flatnonzero((kinds != "") & g["core_"])
    return {"t": g["t"][at].tolist(), "h": g["h"][at].tolist(), "kind": kinds[at].tolist()}


_FOUND = "t array<long>, h array<long>, kind array<string>"
_NOTHING = {"t": [], "h": [], "kind": []}


def _first_look(batches: Iterator[pd.DataFrame], chunk: int) -> Iterator[pd.DataFrame]:
    """One row a chunk: judged if it is the whole series, else with its readings and how often which sizes occur among its own."""
    rows = []
    for g in segments(batches, ["symbol", "field", "chunk_"]):
        v = g["v"].astype(float)
        seen = _look(v)
        impossible, stuck, places, x, (fine, coarse) = seen
        use = (~stuck & g["core_"])[places]
        sizes = {s: _sizes(a[use]) for s, a in zip(STATS, (np.abs(x - _median(_around(x, REACH))) if len(x) else x, np.abs(fine), np.abs(coarse)))}
        row = {"symbol": g["symbol"][0], "field": g["field"][0], **_NOTHING, "pending": None, "sizes": None}
        if g["total_"][0] <= chunk:
            usual = {s: _size(np.partition(a, (len(a) - 1) // 2)[(len(a) - 1) // 2]) if len(a) else 0.0 for s, a in sizes.items()}
            row |= _bad(g, _kinds(v, usual, seen))
        else:
            row["pending"] = {"t": g["t"].tolist(), "h": g["h"].tolist(), "v": v.tolist(), "core": g["core_"].tolist()}
            row["sizes"] = [{"stat": s, "size": int(k), "n": int(n)} for s, a in sizes.items() for k, n in zip(*np.unique(a, return_counts=True))]
        rows.append(row)
        if len(rows) >= 500:
            yield pd.DataFrame(rows)
            rows = []
    if rows:
        yield pd.DataFrame(rows)


def _second_look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Chunks of longer series, by the scales of their series."""
    for b in batches:
        out = []
        for r in b.itertuples(index=False):
            g = {"t": np.asarray(r.pending["t"]), "h": np.asarray(r.pending["h"]), "core_": np.asarray(r.pending["core"], bool)}
            v = np.asarray(r.pending["v"], float)
            usual = {s: 0.0 if pd.isna(n) else _size(n) for s, n in zip(STATS, (r.around, r.fine, r.coarse))}
            out.append({"symbol": r.symbol, "field": r.field, **_bad(g, _kinds(v, usual, _look(v)))})
        if out:
            yield pd.DataFrame(out)


def implausible(rows: DataFrame, source: str, time_ms: str, row_id: str, content: list[str], fields: list[str], chunk: int = CHUNK) -> DataFrame:
    """(row_id, field, kind) of implausible values; kind is `impossible`, `stuck` or `spike`.

    rows: row_id, source, time_ms (long) and fields, read twice, so what is dear to make should be stored; content: the columns in which rows that were stored again agree; they are one reading, and
    each of them is returned. Nulls and zeros of a field are no readings of it. Rows without source or time can't be put in order: only their
    impossible values are found. Readings of one instant are ordered by a hash of their content. At either end of a series nothing returns, so
    no spike is found there. A source whose usual distance is zero has no spikes. An empty table gives an empty one; further columns are ignored.
    """
    kind = rows.schema[source].dataType.simpleString()
    base = rows.select(F.col(row_id).alias("row_id"), F.col(source).alias("symbol"), F.col(time_ms).alias("t"), F.xxhash64(*content).alias("h"), *[F.col(f).cast("double").alias(f) for f in fields])
    # a third of all rows may be copies of one reading: they are one row before the shuffle
    once = base.filter("symbol is not null and t is not null").groupBy("symbol", "t", "h").agg(*[F.first(f).alias(f) for f in fields])
    chunks = dense_chunks(once, ["symbol"], ["t", "h"], F.floor(F.col("t") / BLOCK_MS), fields, chunk, HALO)
    chunks = chunks.repartition("symbol", "field", "chunk_").sortWithinPartitions("symbol", "field", "chunk_", "index_").select("symbol", "field", "chunk_", "t", "h", "v", "total_", "core_")
    shape = f"symbol {kind}, field tinyint, {_FOUND}, pending struct<t: array<long>, h: array<long>, v: array<double>, core: array<boolean>>, sizes array<struct<stat: string, size: int, n: long>>"
    seen = stored(chunks.mapInPandas(lambda batches: _first_look(batches, chunk), shape), "chunks")
    sizes = seen.select("symbol", "field", F.explode("sizes").alias("s")).groupBy("symbol", "field", "s.stat", "s.size").agg(F.sum("s.n").alias("n"))
    of = Window.partitionBy("symbol", "field", "stat")
    halves = sizes.select("*", F.sum("n").over(of.orderBy("size")).alias("upto"), F.sum("n").over(of).alias("whole")).filter("2 * upto >= whole")
    usual = halves.groupBy("symbol", "field").agg(*[F.min(F.when(F.col("stat") == s, F.col("size"))).alias(s) for s in STATS])
    late = seen.filter("pending is not null").select("symbol", "field", "pending").join(lookup(usual), ["symbol", "field"], "left").mapInPandas(_second_look, f"symbol {kind}, field tinyint, {_FOUND}")
    found = seen.select("symbol", "field", "t", "h", "kind").unionByName(late)
    name = F.get(F.array(*[F.lit(f) for f in fields]), F.col("field")).alias("field")  # fields go by their numbers where all readings are moved
    bad = stored(found.select("symbol", name, F.explode(F.arrays_zip("t", "h", "kind")).alias("x")).select("symbol", "field", "x.t", "x.h", "x.kind"), "found")
    placed = base.select("row_id", "symbol", "t", "h").join(lookup(bad), ["symbol", "t", "h"]).select("row_id", "field", "kind")
    unplaced = base.filter("symbol is null or t is null").select("row_id", F.explode(F.array(*[F.when((F.col(f) < 0) | F.isnan(f) | (F.abs(f) == float("inf")), F.lit(f)) for f in fields])).alias("field")).filter("field is not null").withColumn("kind", F.lit("impossible"))
    return placed.unionByName(unplaced)
