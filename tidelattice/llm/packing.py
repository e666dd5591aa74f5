"""Filling containers of fixed capacity with texts, neighbours in content together.

Each text is a hashed vector: the mean of fixed random directions of its tokens, in three dimensions. Scaled to an even spread, the three
coordinates are interleaved to a position on a Hilbert curve. The items are range-sorted by that position, and every range is packed along the
curve: a container starts with the item that has waited longest and takes from the next few hundred the one or two that leave the least space.
Items larger than a container give full containers of their own; only what remains of them is packed.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelattice.llm.tokens import encode, vocabulary_path
from tidelattice.session import cut, spread

DIMENSIONS, BITS = 3, 10
#: Items along the curve that a container may choose from.
AHEAD = 512
#: Containers in a range at least, so that the last ones of a range don't matter.
RANGE = 512


def hilbert(x: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Positions on the Hilbert curve of (n, d) whole coordinates below 2 ** bits, by Gray code from the highest bit down."""
    x = x.astype(np.int64).copy()
    d = x.shape[1]
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(d):
            on = (x[:, i] & q) != 0
            t = np.where(on, 0, (x[:, 0] ^ x[:, i]) & p)
            x[:, 0] ^= np.where(on, p, t)
            x[:, i] ^= t
        q >>= 1
    for i in range(1, d):
        x[:, i] ^= x[:, i - 1]
    t = np.zeros(len(x), np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[:, d - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t[:, None]
    key = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[:, i] >> b) & 1)
    return key


def _vectors(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        directions = None
        for b in batches:
            ids = encode(b["text"].tolist(), path)
            if directions is None:
                directions = np.random.default_rng(20_240_501).standard_normal((1 << 16, DIMENSIONS)).astype(np.float32)
            v = np.array([directions[np.asarray(i, np.int64) & 0xFFFF].mean(axis=0) if i else np.zeros(DIMENSIONS) for i in ids], float).reshape(-1, DIMENSIONS)
            yield pd.DataFrame({"doc_id": b["doc_id"], "tokens": [len(i) for i in ids], **{f"v{k}": v[:, k] for k in range(DIMENSIONS)}})

    return run


def _even(mean: np.ndarray, std: np.ndarray):
    """Coordinates to whole numbers spread evenly, by the logistic curve nearest to the normal distribution's."""

    def run(v: np.ndarray) -> np.ndarray:
        z = (v - mean) / np.where(std > 0, std, 1.0)
        return np.clip((1 / (1 + np.exp(-1.702 * np.clip(z, -20, 20))) * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1)

    return run


class Window:
    """The next items along the curve, by size."""

    def __init__(self) -> None:
        self.sizes: list[tuple[int, int]] = []  # (size, number), sorted
        self.gone: set[int] = set()

    def add(self, size: int, n: int) -> None:
        insort(self.sizes, (size, n))

    def take(self, i: int) -> tuple[int, int]:
        x = self.sizes.pop(i)
        self.gone.add(x[1])
        return x

    def best(self, room: int) -> list[int]:
        """Places of the one or two items that fill `room` best, the larger place first; none if nothing fits."""
        s = self.sizes
        end = bisect_right(s, (room, 1 << 62))
        if not end:
            return []
        top, pick = s[end - 1][0], [end - 1]
        if top == room:
            return pick
        i, j = 0, end - 1
        while i < j:
            both = s[i][0] + s[j][0]
            if both > room:
                j -= 1
            else:
                if both > top:
                    top, pick = both, [j, i]
                    if both == room:
                        break
                i += 1
        return pick


def fill(sizes: list[int], capacity: int, ahead: int = AHEAD) -> list[list[int]]:
    """Containers as lists of item numbers. Every item is at most `capacity`; each container starts with the first item that has none."""
    w, nxt, head, out = Window(), 0, 0, []
    n = len(sizes)
    while head < n:
        while nxt < n and len(w.sizes) < ahead:
            w.add(sizes[nxt], nxt)
            nxt += 1
        if head in w.gone:
            w.gone.discard(head)
            head += 1
            continue
        start = w.take(bisect_left(w.sizes, (sizes[head], head)))
        box, room = [start[1]], capacity - start[0]
        while room > 0 and w.sizes and w.sizes[0][0] <= room:
            # with much room left the largest item is taken; the last two places decide together
            if room > 2 * w.sizes[-1][0]:
                places = [len(w.sizes) - 1]
            else:
                places = w.best(room)
                if len(places) == 2 and w.sizes[0][0] * 3 <= room and sum(w.sizes[p][0] for p in places) < room:
                    places = [bisect_right(w.sizes, (room, 1 << 62)) - 1]
            for p in places:
                size, k = w.take(p)
                box.append(k)
                room -= size
        out.append(box)
    return out


def _pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One range: its items come sorted by kind and key."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    rows = [b for b in batches if len(b)]
    if not rows:
        return
    d = pd.concat(rows, ignore_index=True)
    for kind, g in d.groupby("container_kind", sort=False):
        boxes = fill(g["tokens"].tolist(), int(g["capacity_tokens"].iloc[0]))
        order = np.concatenate([np.asarray(b, np.int64) for b in boxes])
        number = np.repeat(np.arange(len(boxes)), [len(b) for b in boxes])
        yield g.iloc[order][["container_kind", "doc_id", "piece", "tokens"]].assign(container=[f"{kind}/r{part}/{k}" for k in number])


#: Most kinds of containers; they are settings, each of which packs the whole corpus once more.
MOST_KINDS = 100


def capacities(limits: DataFrame) -> dict[str, int]:
    """Capacity of each kind of container."""
    rows = limits.filter("container_kind is not null and capacity_tokens > 0").groupBy("container_kind").agg(F.min("capacity_tokens").alias("c")).orderBy("container_kind").limit(MOST_KINDS + 1).collect()
    if len(rows) > MOST_KINDS:
        raise ValueError(f"more than {MOST_KINDS} kinds of containers")
    return {r.container_kind: int(r.c) for r in rows}


def pack(docs: DataFrame, limits: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(container_kind, container, doc_id, piece, tokens): every text in containers of every kind; piece counts the parts of a text from 0.

    docs: doc_id, text. limits: container_kind, capacity_tokens; kinds without a capacity above zero are left out, of several rows of a kind the
    smallest capacity counts. A text that alone exceeds the capacity is cut into pieces of the capacity and a last one; no other text is split. Null and
    empty texts have no tokens and get no container, nor do rows without doc_id. Rows that repeat a text or doc_id are items of their own; equal positions are ordered by doc_id.
    Empty tables give an empty result; further columns are ignored.
    """
    path = tokenizer or vocabulary_path()
    sized = cut(spread(docs.select("doc_id", "text").filter("doc_id is not null")).mapInPandas(_vectors(path), "doc_id long, tokens long, " + ", ".join(f"v{k} double" for k in range(DIMENSIONS))).filter("tokens > 0").withColumn("item", F.monotonically_increasing_id()))
    dims = range(DIMENSIONS)
    total = sized.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), *[F.avg(f"v{k}").alias(f"m{k}") for k in dims], *[F.stddev_pop(f"v{k}").alias(f"s{k}") for k in dims]).first()
    even = _even(np.array([total[f"m{k}"] or 0.0 for k in dims]), np.array([total[f"s{k}"] or 0.0 for k in dims]))

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b[["item", "doc_id", "tokens"]].assign(key=hilbert(even(b[[f"v{k}" for k in dims]].to_numpy(float))))

    kinds = capacities(limits)
    if not kinds:
        return docs.sparkSession.createDataFrame([], "container_kind string, container string, doc_id long, piece int, tokens long")
    boxes = sum(-(-total["tokens"] // c) for c in kinds.values())
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("container_kind"), F.lit(c).cast("long").alias("capacity_tokens")) for k, c in kinds.items()]))
    items = sized.mapInPandas(keyed, "item long, doc_id long, tokens long, key long").select("item", "doc_id", "tokens", "key", each.alias("x")).select("item", "doc_id", "tokens", "key", "x.*")
    full = F.floor(F.col("tokens") / F.col("capacity_tokens"))
    rest = F.col("tokens") % F.col("capacity_tokens")
    whole = items.filter(full > 0).select("container_kind", "item", "doc_id", "capacity_tokens", F.explode(F.sequence(F.lit(0).cast("long"), full - 1)).alias("piece"))
    whole = whole.select("container_kind", F.concat_ws("/", "container_kind", F.concat(F.lit("i"), F.col("item")), F.col("piece")).alias("container"), "doc_id", F.col("piece").cast("int").alias("piece"), F.col("capacity_tokens").alias("tokens"))
    parts = items.filter(rest > 0).select("container_kind", "capacity_tokens", "key", "doc_id", full.cast("int").alias("piece"), rest.alias("tokens"))
    ranges = max(1, int(boxes // RANGE))
    packed = parts.repartitionByRange(ranges, "container_kind", "key", "doc_id").sortWithinPartitions("container_kind", "key", "doc_id", "tokens")
    packed = packed.mapInPandas(_pack, "container_kind string, doc_id long, piece int, tokens long, container string")
    return packed.select("container_kind", "container", "doc_id", "piece", "tokens").unionByName(whole)


def fill_report(packed: DataFrame, limits: DataFrame) -> DataFrame:
    """(container_kind, containers, tokens, capacity_tokens, used) of each kind; used is the share of all containers' space that tokens take."""
    size = F.create_map(*[F.lit(x) for k, c in capacities(limits).items() for x in (k, c)])[F.col("container_kind")].cast("long")
    boxes = packed.groupBy("container_kind", "container").agg(F.sum("tokens").alias("tokens"))
    by_kind = boxes.groupBy("container_kind").agg(F.count("*").alias("containers"), F.sum("tokens").alias("tokens")).withColumn("capacity_tokens", size)
    return by_kind.withColumn("used", F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")))
