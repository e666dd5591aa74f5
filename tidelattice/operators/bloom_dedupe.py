"""Exactly one copy of messages that were delivered at least once.

Each message belongs to a time bucket that follows from its identity, so all copies of it share the bucket wherever and whenever they
arrive. Every input task sets the bits of its own deliveries in one Bloom filter per bucket, with a second plane for bits that were set more
than once; the planes are merged per bucket and stored by bucket in the shared folder. There a task opens those of the buckets that it meets, which are
few because rows follow arrival; nothing is broadcast. A delivery of which any bit was set only once has no copy: it is definitely new and goes no
further. Only the possible repeats are verified exactly, against the possible repeats of their own bucket. What is shuffled is thus
the filters and the few possible repeats, not the deliveries, at any size.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelattice.session import cut, qualified, scratch, worker_files

#: Bits of one filter; larger buckets are split by identifier into several filters of this size.
CELL_BITS = 1 << 20
#: Bits per delivery, and bits set for each. With a sixteenth of the bits for each delivery and three bits, one in two hundred deliveries is a false repeat.
BITS_EACH, HASHES = 16, 3
#: Filters that are stored together on average; those of one bucket always are. Stored parts that a worker holds, and filters that it holds unpacked.
TOGETHER, PARTS_HELD, OPEN = 32, 8, 64
#: Possible repeats that a task holds to settle copies among them.
HELD = 200_000

CELL = "part int, topic_no int, bucket long, slice int"
CELL_NAMES = ["part", "topic_no", "bucket", "slice"]


def _positions(h: np.ndarray) -> np.ndarray:
    """(HASHES, n) bit positions from 64-bit hashes."""
    u = h.astype(np.uint64)
    a, b = u >> np.uint64(32), (u & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    return np.stack([((a + np.uint64(i) * b) % np.uint64(CELL_BITS)).astype(np.int64) for i in range(HASHES)])


def _pack(bits: np.ndarray) -> bytes:
    return zlib.compress(np.packbits(bits).tobytes(), 1)


def _unpack(data: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(data), np.uint8)).astype(bool)


def _planes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The two planes of each cell that the task met. Positions are held, not planes, so memory follows the task's rows."""
    held: dict[tuple, list[np.ndarray]] = {}
    for b in batches:
        for cell, rows in b.groupby(CELL_NAMES, sort=False)["h"]:
            held.setdefault(cell, []).append(rows.to_numpy())
    for cell, parts in held.items():
        pos = _positions(np.concatenate(parts)).ravel()
        n = np.bincount(pos, minlength=CELL_BITS)
        yield pd.DataFrame({**{k: [x] for k, x in zip(CELL_NAMES, cell)}, "once": [_pack(n > 0)], "twice": [_pack(n > 1)]})


def _merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Planes sorted by cell to one repeat plane a cell; holds the planes of one cell at a time."""
    cell, once, twice = None, None, None

    def done() -> pd.DataFrame:
        return pd.DataFrame({**{k: [x] for k, x in zip(CELL_NAMES, cell)}, "twice": [_pack(twice)]})

    for b in batches:
        for r in b.itertuples(index=False):
            here = (r.part, r.topic_no, r.bucket, r.slice)
            o, t = _unpack(r.once), _unpack(r.twice)
            if here == cell:
                twice |= t | (once & o)
                once |= o
            else:
                if cell is not None:
                    yield done()
                cell, once, twice = here, o, t
    if cell is not None:
        yield done()


def _settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Possible repeats of one task: a copy that isn't the last of its message among those held is settled here and isn't shuffled, so a shuffled group has about one row a task. Holds at most HELD rows besides a batch."""
    held = None
    for b in batches:
        d = b if held is None else pd.concat([held, b], ignore_index=True)
        last = d.groupby(["topic", "symbol", "message_key"], sort=False, dropna=False)["delivery_id"].transform("max")
        done = d["delivery_id"] < last
        if done.any():
            yield d[done].assign(settled=True)
        held = d[~done]
        if len(held) > HELD:
            yield held.assign(settled=False)
            held = None
    if held is not None and len(held):
        yield held.assign(settled=False)


class _Filters:
    """Repeat planes by cell, read from where they are stored when they are first asked for."""

    def __init__(self, uri: str) -> None:
        self.files, self.path = worker_files(uri)
        self.parts: dict[int, dict[tuple, bytes]] = {}
        self.planes: dict[tuple, np.ndarray] = {}

    def plane(self, cell: tuple) -> np.ndarray:
        if cell not in self.planes:
            part = cell[0]
            if part not in self.parts:
                if len(self.parts) >= PARTS_HELD:
                    self.parts.pop(next(iter(self.parts)))
                t = pq.read_table(f"{self.path}/part={part}", filesystem=self.files, columns=[*CELL_NAMES[1:], "twice"])
                self.parts[part] = dict(zip(zip(*[t[c].to_pylist() for c in CELL_NAMES[1:]]), t["twice"].to_pylist()))
            if len(self.planes) >= OPEN:
                self.planes.pop(next(iter(self.planes)))
            self.planes[cell] = _unpack(self.parts[part][cell[1:]])
        return self.planes[cell]


def find_repeats(rows: DataFrame, bucket: Column) -> DataFrame:
    """(topic, symbol, message_key, delivery_id) of every delivery that isn't the one with the greatest delivery_id of its message.

    rows: topic, symbol, message_key, delivery_id. bucket: a long that follows from topic, symbol and message_key.
    Nulls: a delivery without symbol, message_key or delivery_id can't be identified, so it is nobody's copy and never returned. Rows that repeat a
    delivery_id too are equal copies; the one that stays counts once and its equals aren't returned. An empty table gives an empty result;
    other columns are ignored.
    """
    spark = rows.sparkSession
    known = rows.filter(F.col("symbol").isNotNull() & F.col("message_key").isNotNull() & F.col("delivery_id").isNotNull()).select("topic", "symbol", "message_key", "delivery_id", bucket.cast("long").alias("bucket"))
    plan = {r.topic: r for r in known.groupBy("topic").agg(F.count("*").alias("n"), F.approx_count_distinct("bucket").alias("buckets")).collect()}  # a row a topic
    names = ["topic", "symbol", "message_key", "delivery_id"]
    if not plan:
        return known.select(*names).limit(0)
    topics = sorted(plan)
    slices = [max(1, -(-plan[t].n * BITS_EACH // (CELL_BITS * max(1, plan[t].buckets)))) for t in topics]
    parts = max(1, -(-sum(plan[t].buckets * s for t, s in zip(topics, slices)) // TOGETHER))
    number = F.create_map(*[F.lit(x) for i, t in enumerate(topics) for x in (t, i)])[F.col("topic")]
    many = F.create_map(*[F.lit(x) for t, s in zip(topics, slices) for x in (t, s)])[F.col("topic")]
    hashed = known.withColumn("h", F.xxhash64("symbol", "message_key")).withColumns({"topic_no": number.cast("int"), "slice": F.pmod(F.hash("message_key", "symbol"), many).cast("int")})
    hashed = hashed.withColumn("part", F.pmod(F.hash("topic_no", "bucket"), F.lit(parts)).cast("int"))

    planes = hashed.select(*CELL_NAMES, "h").mapInPandas(_planes, f"{CELL}, once binary, twice binary")
    path = scratch(spark, "filters")
    planes.repartition("part").sortWithinPartitions(*CELL_NAMES).mapInPandas(_merge, f"{CELL}, twice binary").write.partitionBy("part").option("compression", "none").parquet(path)
    uri = qualified(spark, path)

    @F.pandas_udf("boolean")
    def maybe(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        filters = _Filters(uri)
        for *cells, h in batches:
            out = np.zeros(len(h), bool)
            pos = _positions(h.to_numpy())
            for cell, at in pd.DataFrame(dict(zip(CELL_NAMES, cells))).groupby(CELL_NAMES, sort=False).indices.items():
                out[at] = filters.plane(tuple(int(x) for x in cell))[pos[:, at]].all(axis=0)
            yield pd.Series(out)

    suspects = hashed.withColumn("maybe", maybe(*CELL_NAMES, "h")).filter("maybe")
    kept = "topic string, symbol string, message_key long, delivery_id long, bucket long"
    checked = cut(suspects.select(*names, "bucket").mapInPandas(_settle, f"{kept}, settled boolean"))
    last = F.max("delivery_id").over(Window.partitionBy("topic", "bucket", "symbol", "message_key"))
    # the last of a message's rows is never settled, so the others of its tasks suffice to find it
    open_ = checked.filter(~F.col("settled")).withColumn("last", last).filter(F.col("delivery_id") < F.col("last"))
    return checked.filter("settled").select(*names).unionByName(open_.select(*names))


#: Identifiers of a symbol's trades rise with time, so a run of them is a bucket of time that all copies share (copies may differ in transact_time).
#: A run of this length fills one filter at BITS_EACH bits an identifier.
TRADES_A_BUCKET = CELL_BITS // BITS_EACH
#: Days of event time in a bucket of bars and readings.
BUCKET_MS = 86_400_000


def time_bucket() -> Column:
    """Bucket of a canonical delivery: the day of a bar or reading, a run of trade identifiers."""
    from tidelattice.functions.normalize import floor_div

    return F.when(F.col("topic") == "futures_aggtrades", floor_div("message_key", TRADES_A_BUCKET)).otherwise(floor_div("message_key", BUCKET_MS))
