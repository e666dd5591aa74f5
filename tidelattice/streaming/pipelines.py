"""Streams: sources, tumbling periods with a watermark, and micro-batches that call the batch operators."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelattice.functions.normalize import epoch_ms, symbol_of
from tidelattice.operators import features, lambda_views

from tidelattice.session import lookup
from tidelattice.sinks.lake import merge_periods, period_of, upsert
from tidelattice.sources.lake import partitions, read_or_none


def kafka(spark: SparkSession, servers: str, topic: str, schema: str, start: str = "latest", per_trigger: int | None = None) -> DataFrame:
    """Messages of a topic as columns. start: `latest`, `earliest` or offsets as JSON, which is how a reader warms up on the last n messages."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", start)
    if per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    return reader.load().select(F.from_json(F.col("value").cast("string"), schema).alias("m"), "offset", "timestamp").select("m.*", "offset", F.col("timestamp").alias("received_at"))


def warm_up(topic: str, ends: dict[int, int], n: int) -> str:
    """Offsets to start from so that the last n messages of each partition are read first; ends: each partition's end."""
    return json.dumps({topic: {str(p): max(0, end - n) for p, end in sorted(ends.items())}})


def to_kafka(df: DataFrame, servers: str, topic: str, checkpoint: str, key: str | None = None, acks: str = "all") -> StreamingQuery:
    """Rows as JSON messages, keyed for a table of records. acks: how many brokers must have a message before it counts as sent."""
    value = df.select(*([F.col(key).cast("string").alias("key")] if key else []), F.to_json(F.struct(*df.columns)).alias("value"))
    return value.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).option("kafka.compression.type", "lz4").option("kafka.acks", acks).option("checkpointLocation", checkpoint).start()


def files(spark: SparkSession, path: str, like: DataFrame | None = None, per_trigger: int | None = None) -> DataFrame:
    """Parquet files as a stream: a folder's, or the one at a path; the schema is that of the files there unless `like` gives it."""
    schema = (like if like is not None else spark.read.parquet(path)).schema
    reader = spark.readStream.schema(schema)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")  # as a pattern, since a plain path must be a folder


def event_time(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def tumbling(stream: DataFrame, t: Column, step_ms: int, closed: str, late: str, aggregates: list[Column], key: list[str]) -> DataFrame:
    """Aggregates per key and period, given out once the watermark has passed the period's end. closed: `start` [s, e) or `end` (s, e]; label is the end.

    late: how long a period stays open for late rows, `0 seconds` as the plain clock has it; state is dropped with the watermark.
    """
    at = t if closed == "start" else t - 1
    rows = stream.withColumn("event_", event_time(at)).withWatermark("event_", late)
    out = rows.groupBy(*key, F.window("event_", f"{step_ms} milliseconds").alias("w")).agg(*aggregates)
    rest = [c for c in out.columns if c not in (*key, "w")]
    return out.select(*key, F.unix_millis("w.end").alias("create_time"), *rest)


def active_steps(boundary: int, steps: dict[str, int]) -> list[str]:
    """The intervals that end at a boundary."""
    return [k for k, s in steps.items() if boundary % s == 0]


def each_interval(steps: dict[str, int], run: Callable[[str, DataFrame, int], None], time: str = "create_time") -> Callable[[DataFrame, int], None]:
    """For each interval the rows of a micro-batch at whose boundary it ends; a finer interval's run comes before a coarser one's."""

    def batch(df: DataFrame, n: int) -> None:
        boundaries = [r[0] for r in df.select(time).distinct().collect()]  # periods that closed in one micro-batch
        for name in sorted(steps, key=steps.get):
            here = [b for b in boundaries if name in active_steps(b, steps)]
            if here:
                run(name, df.filter(F.col(time).isin(here)), n)

    return batch


def next_boundary(now: int, step: int) -> int:
    return (now // step + 1) * step


def run_once(stream: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Everything that is there now, in micro-batches; offsets are kept after each, so a batch may come again but isn't lost."""
    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def into_lake(path: str, keys: list[str], order: str, time: str) -> Callable[[DataFrame, int], None]:
    """A micro-batch merged into the lake's periods."""
    return lambda df, _: merge_periods(df, path, keys, order, time) and None


def into_table(path: str, keys: list[str], partition: str | None = None, order: str | None = None) -> Callable[[DataFrame, int], None]:
    """A micro-batch upserted into a keyed table; it may be repeated."""
    return lambda df, _: upsert(df, path, keys, partition, order)


def with_features(family: str, path: str, key: list[str], step: int, strict: bool = True) -> Callable[[DataFrame, int], None]:
    """Closed periods of a micro-batch with their features: computed by the batch steps over the last stored rows and the new ones, only the new ones kept.

    strict: periods whose history has gaps get none; only the rows that a whole history can have are read then. In a table that has `period` partitions (days or months, see
    `period_of`) only those of the batch are rewritten.
    """
    f = features.FAMILIES[family]

    def run(batch: DataFrame, _: int) -> None:
        base = [*key, f.time, *f.base]
        stored = read_or_none(batch.sparkSession, path)
        rows = batch.select(*base, F.lit(True).alias("new_"))
        there = partitions(batch.sparkSession, path)
        by_period, monthly = bool(there), bool(there) and len(there[-1]) == len("yyyy-MM")
        if stored is not None:
            # history is bounded: the rows before a batch's first period that any feature reaches back to
            first = batch.groupBy(*key).agg(F.min(f.time).alias("first_"))
            begin = first.agg(F.min("first_")).first()[0]
            if begin is None:
                return
            if strict:
                since = begin - features.HISTORY * step
                stored = stored.filter(F.col(f.time) >= since)
                if by_period:
                    stored = stored.filter(F.col("period").cast("string") >= period_of(F.lit(since), monthly))
            near = stored.select(*base).join(lookup(first), key).filter(F.col(f.time) < F.col("first_"))
            last = Window.partitionBy(*key).orderBy(F.desc(f.time))
            near = near.withColumn("n_", F.row_number().over(last)).filter(F.col("n_") <= features.HISTORY).drop("n_", "first_")
            rows = near.withColumn("new_", F.lit(False)).unionByName(rows)
        done = features.features(family, rows.drop("new_"), key)
        if strict:
            done = features.strict_history(done, key, f.time, step)
        done = done.join(rows.filter("new_").select(*key, f.time), [*key, f.time], "left_semi")
        if by_period:
            done = done.withColumn("period", period_of(f.time, monthly))
        upsert(done, path, [*key, f.time], "period" if by_period else None)

    return run


def gated(batch: DataFrame, pings: DataFrame, time: str = "create_time") -> DataFrame:
    """Only the periods for whose end a status ping has come."""
    return batch.join(pings.select(epoch_ms("timestamp_utc").alias(time)).distinct(), time, "left_semi")


def fast_layer(path: str, period: lambda_views.Period, value: str, weight: str) -> Callable[[DataFrame, int], None]:
    """Increments of each micro-batch of canonical deliveries, appended under the batch's number; a repeated batch replaces its own."""
    return lambda df, n: lambda_views.fast_increment(df, period, value, weight).write.mode("overwrite").parquet(f"{path}/batch={n}")


def trade_counts(spark: SparkSession, path: str, step: int, out: str) -> DataFrame:
    """Deliveries and quantity per symbol and closed period of the trade topic, by a stream over its files."""
    s = files(spark, path).withColumn("symbol", symbol_of("symbol"))
    t = tumbling(s.filter("transact_time is not null"), epoch_ms("transact_time"), step, "start", "0 seconds", [F.count("*").alias("deliveries"), F.count("quantity").alias("quantities")], ["symbol"])
    t.writeStream.format("parquet").outputMode("append").option("path", f"{out}/table").option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(t.schema).parquet(f"{out}/table")


def last_bars(spark: SparkSession, path: str, out: str) -> DataFrame:
    """The last delivery of each bar, kept by merging micro-batches into the lake."""
    from tidelattice.operators.topics import bar_close_ms

    s = files(spark, path).select(symbol_of("symbol").alias("symbol"), (bar_close_ms() - 60_000).alias("t"), "delivery_id", "close", "volume").filter("t is not null")
    s = s.withColumn("period", F.date_format(F.timestamp_millis("t"), "yyyy-MM-dd"))
    run_once(s, into_lake(f"{out}/table", ["symbol", "t"], "delivery_id", "t"), f"{out}/state")
    return spark.read.parquet(f"{out}/table").select("symbol", "t", "delivery_id", "close", "volume")


