"""Mixing sources to target shares of all tokens by Poisson replication.

Every record draws a number from a hash of its identity and a seed; the inverted Poisson distribution with its source's mean turns it into the
number of copies, cut at the greatest number of uses allowed. The means start from the repetition rates the targets ask for and are then set by
what the draws really give: two passes sum, per source, the tokens that each of a grid of means would yield on the very same draws, so shares
miss their targets by no more than about a record. The copies are shuffled globally by a second hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelattice.llm.tokens import encode, vocabulary_path
from tidelattice.session import cut, spread

#: Share of the greatest total that the tightest source allows; at the whole of it that source would need an endless mean.
REACH = 0.9
#: Means tried in a pass.
GRID = 64
#: Most sources with a target; they are settings.
MOST_SOURCES = 10_000


def copies(u: np.ndarray, means: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Poisson counts, cut at `most`, of the draws u in [0, 1) under the means: the inverse of the distribution function."""
    k = np.zeros(np.broadcast(u, means).shape, np.int64)
    term = np.exp(-means)
    below = term.copy()
    for j in range(1, int(most.max(initial=0)) + 1):
        k += (u >= below) & (j <= most)
        term = term * means / j
        below = below + term
    return k


def expected(mean: float, most: int) -> float:
    """Mean of the Poisson count cut at `most`."""
    term, below, out = np.exp(-mean), 0.0, 0.0
    for k in range(most):
        out += 1 - (below := below + term)
        term *= mean / (k + 1)
    return float(out)


def mean_for(rate: float, most: int) -> float:
    """The mean whose cut count has the expectation `rate`."""
    low, high = 0.0, 1.0
    while expected(high, most) < rate and high < 500:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if expected(mid, most) < rate else (low, mid)
    return high


def _sizes(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.drop(columns=["text"]).assign(tokens=[len(i) for i in encode(b["text"].tolist(), path)])

    return run


def _yields(sources: list[str], grid: np.ndarray, most: np.ndarray):
    """Tokens per source and mean of its grid, summed over a task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(grid.shape, np.int64)
        at = {s: i for i, s in enumerate(sources)}
        for b in batches:
            for i, g in b.groupby(b["source"].map(at)):
                i = int(i)
                u, t = g["u"].to_numpy(), g["tokens"].to_numpy()
                total[i] += [int((copies(u, np.float64(m), most[i : i + 1]) * t).sum()) for m in grid[i]]
        yield pd.DataFrame({"no": np.repeat(np.arange(len(sources)), GRID), "step": np.tile(np.arange(GRID), len(sources)), "tokens": total.ravel()})

    return run


def plan(sized: DataFrame, targets: DataFrame) -> dict[str, dict]:
    """By source with a target: share, most, own tokens, wanted tokens, mean. Sources without tokens keep a mean of 0; the others' shares are scaled up to sum to 1."""
    rows = targets.filter("source is not null and target_share > 0").groupBy("source").agg(F.max("target_share").alias("share"), F.max("max_repeats").alias("most")).orderBy("source").limit(MOST_SOURCES + 1).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    own = {r.source: int(r.tokens) for r in sized.groupBy("source").agg(F.sum("tokens").alias("tokens")).collect()}  # only sources with a target are in `sized`
    out = {r.source: {"target": float(r.share), "most": max(0, int(r.most or 0)), "own": own.get(r.source, 0), "wanted": 0.0, "mean": 0.0} for r in rows}
    live = {s: p for s, p in out.items() if p["own"] and p["most"]}
    if not live:
        return out
    scale = sum(p["target"] for p in live.values())
    total = REACH * min(p["own"] * p["most"] * scale / p["target"] for p in live.values())
    for p in live.values():
        p["wanted"] = total * p["target"] / scale
        p["mean"] = mean_for(p["wanted"] / p["own"], p["most"])
    names, most = list(live), np.array([p["most"] for p in live.values()])
    low, high = np.zeros(len(names)), np.array([3 * p["mean"] + 1 for p in live.values()])
    for _ in range(2):
        grid = np.linspace(low, high, GRID, axis=1)
        got = np.zeros(grid.shape)
        sums = sized.select("source", "u", "tokens").filter(F.col("source").isin(names)).mapInPandas(_yields(names, grid, most), "no int, step int, tokens long").groupBy("no", "step").agg(F.sum("tokens").alias("tokens"))
        for r in sums.collect():  # GRID rows a source
            got[r.no, r.step] = r.tokens
        wanted = np.array([live[s]["wanted"] for s in names])
        best = np.abs(got - wanted[:, None]).argmin(axis=1)
        i = np.arange(len(names))
        for s, m in zip(names, grid[i, best]):
            live[s]["mean"] = float(m)
        low, high = grid[i, np.maximum(best - 1, 0)], grid[i, np.minimum(best + 1, GRID - 1)]
    return out


def mix(docs: DataFrame, targets: DataFrame, seed: int = 17, tokenizer: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The mixture (place, doc_id, source, copy, tokens), sorted by place over all partitions, and the report (source, target_share, reached_share, tokens, records, uses, most_uses).

    docs: doc_id, text, source. targets: source, target_share, max_repeats; of several rows of a source the greatest values count. Sources without a
    target or with max_repeats below one add nothing; a target without records is reported with 0 and its share goes to the others in proportion. Null
    and empty texts have no tokens and aren't used, nor are rows without doc_id. Rows that repeat a doc_id draw the same number. The total is REACH of the greatest
    that the repeats allow. Empty tables give an empty mixture; further columns are ignored.
    """
    path = tokenizer or vocabulary_path()
    wanted = F.broadcast(targets.select("source").filter("source is not null").distinct().limit(MOST_SOURCES))
    mine = spread(docs.select("doc_id", "text", "source")).join(wanted, "source", "left_semi").filter("doc_id is not null and text is not null and text != ''")
    hash_ = lambda s: F.pmod(F.xxhash64(F.lit(s), "doc_id", "source"), F.lit(1 << 52)) / float(1 << 52)
    sized = cut(mine.select("doc_id", "source", hash_(seed).alias("u"), "text").mapInPandas(_sizes(path), "doc_id long, source string, u double, tokens long"))
    p = plan(sized, targets)
    live = {s: x for s, x in p.items() if x["mean"] > 0}
    if live:
        look = lambda key, kind: F.try_element_at(F.create_map(*[F.lit(v) for s, x in live.items() for v in (s, x[key])]), F.col("source")).cast(kind)
        n = F.pandas_udf(lambda u, m, k: pd.Series(copies(u.to_numpy(), m.to_numpy(), k.to_numpy())), "long")
        used = sized.filter(F.col("source").isin(list(live))).withColumn("n", n("u", look("mean", "double"), look("most", "long"))).filter("n > 0")
    else:
        used = sized.withColumn("n", F.lit(0).cast("long")).filter("n > 0")
    each = used.select("doc_id", "source", "tokens", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy"))
    placed = each.withColumn("place", F.xxhash64(F.lit(seed + 1), "doc_id", "source", "copy"))
    mixture = placed.repartitionByRange("place", "doc_id", "copy").sortWithinPartitions("place", "doc_id", "copy").select("place", "doc_id", "source", F.col("copy").cast("int").alias("copy"), "tokens")
    sums = used.groupBy("source").agg(F.sum(F.col("tokens") * F.col("n")).alias("tokens"), F.count("*").alias("records"), F.sum("n").alias("uses"), F.max("n").alias("most_uses"))
    rows = docs.sparkSession.createDataFrame([(s, x["target"]) for s, x in p.items()], "source string, target_share double")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    report = rows.join(F.broadcast(sums), "source", "left").withColumn("all", F.sum("tokens").over(Window.partitionBy()))  # a row a source
    return mixture, report.select("source", "target_share", F.coalesce(F.try_divide("tokens", "all"), F.lit(0.0)).alias("reached_share"), zero("tokens"), zero("records"), zero("uses"), zero("most_uses"))
