"""Writing: period partitions merged by key, keyed upserts, JSON columns, serving schemas and exports. One writer a table."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelattice.functions.normalize import to_ms
from tidelattice.operators.dashboard import CANDLES, MOODS, READINGS
from tidelattice.operators.features import FAMILIES
from tidelattice.operators.trade_stats import METRICS
from tidelattice.session import cut
from tidelattice.sources.lake import read_or_none


def period_of(ms: Column | str, monthly: bool = False) -> Column:
    """Day or month that an instant is stored under."""
    return F.date_format(F.timestamp_millis(F.col(ms) if isinstance(ms, str) else ms), "yyyy-MM" if monthly else "yyyy-MM-dd")


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns: unknown ones are dropped, lacking ones null."""
    return df.select([(F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema])


def last_of(rows: DataFrame, keys: list[str], order: Column | str) -> DataFrame:
    """One row a key, the one with the greatest `order`; a partial aggregate, so a key of any weight is one row a task."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("x")).select(*keys, *[F.col(f"x.{c}").alias(c) for c in rest])


def new_keys(batch: DataFrame, stored: DataFrame | None, keys: list[str]) -> DataFrame:
    """Rows of the batch, one a key, whose key isn't stored yet."""
    once = batch.dropDuplicates(keys)
    return once if stored is None else once.join(stored.select(*keys), keys, "left_anti")


def merge_periods(batch: DataFrame, path: str, keys: list[str], order: str, time: str) -> int:
    """Merges a batch with `period` into the lake: of each key the row with the greatest `order` stays, the batch's among equals. Only the batch's periods are read and rewritten. Returns how many keys are new."""
    spark = batch.sparkSession
    touched = [r.period for r in batch.select("period").distinct().collect()]  # the batch's periods: a few days
    stored = read_or_none(spark, path)
    new = batch.withColumn("from_", F.lit(1))
    if stored is not None:
        stored = stored.filter(F.col("period").isin(touched)).select(*batch.columns)
        new = stored.withColumn("from_", F.lit(0)).unionByName(new)
    added = new_keys(batch, stored, keys).count()
    done = cut(last_of(new, keys, F.struct(order, "from_")).select(*batch.columns))  # the files it comes from are about to be replaced
    done.repartition("period").sortWithinPartitions("period", time).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period").parquet(path)
    return added


def _replace(df: DataFrame, path: str) -> None:
    """`df`, which may be read from it, in place of the table at `path`: written beside it first, so there is a whole table at any time, if a failure comes between the two renames under the name with `.old`."""
    spark, mark = df.sparkSession, uuid.uuid4().hex
    at = {k: spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + k) for k in ("", f".new-{mark}", f".old-{mark}")}
    now, new, old = at.values()
    df.write.parquet(new.toString())
    fs = now.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.rename(now, old) or not fs.rename(new, now):
        raise OSError(f"the table at {path} could not be replaced; see {old} and {new}")
    fs.delete(old, True)
    spark.catalog.refreshByPath(path)


def upsert(batch: DataFrame, path: str, keys: list[str], partition: str | None = None, order: str | None = None) -> None:
    """Rows of the batch replace those of the same key, others stay. The table must exist (see `ensure`). Repeating it changes nothing.

    Of rows of the batch with one key the one with the greatest `order` counts (without it the greatest by its other columns). Rows without a full key are left out.
    partition: a column of the table's partitions; only those that the batch touches are rewritten. Without it the whole table is written anew and then swapped in.
    """
    stored = read_or_none(batch.sparkSession, path)
    if stored is None:
        raise ValueError(f"no table at {path}")
    batch = batch.dropna(subset=keys)
    rest = [c for c in batch.columns if c not in keys]
    # maps can't be ordered; their text can
    orderable = [F.to_json(c) if isinstance(batch.schema[c].dataType, T.MapType) else F.col(c) for c in rest]
    new = align(last_of(batch, keys, F.col(order) if order else F.struct(*orderable)) if rest else batch.distinct(), stored.schema)
    if partition:
        stored = stored.filter(F.col(partition).isin([r[0] for r in batch.select(partition).distinct().collect()]))
    done = stored.join(new.select(*keys), keys, "left_anti").select(*new.columns).unionByName(new)
    if partition:
        cut(done).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    else:
        _replace(done, path)


def ensure(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """An empty table where there is none; columns that lack are added with nulls."""
    stored = read_or_none(spark, path)
    if stored is None:
        spark.createDataFrame([], schema).write.parquet(path)
    elif set(schema.names) - set(stored.columns):
        _replace(stored.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema if f.name not in stored.columns]), path)


def serving_schema(family: str) -> T.StructType:
    """Schema of a family's table: its key and times as long (epoch ms), everything else as double."""
    f = FAMILIES[family]
    return T.StructType([T.StructField(c, T.LongType() if c in (f.time, "close_time") or (family, c) == ("sentiment", "count") else T.DoubleType()) for c in f.columns])


def dashboard_schema(table: str) -> T.StructType:
    """Schema of a dashboard table (`futures_klines`, `futures_metrics` or `sentiment`) of one interval."""
    long, double = T.LongType(), T.DoubleType()
    columns = {
        "futures_klines": [("open_time", long), ("close_time", long), *[(c, double) for c in ("open", "high", "low", "close")]],
        "futures_metrics": [("create_time", long), *[(c, double) for c in METRICS]],
        "sentiment": [("create_time", long), ("word_frequency", T.StringType()), ("count", long), *[(c, double) for c in ("score", "confidence", "pct_negative", "pct_positive", "pct_neutral")]],
    }
    return T.StructType([T.StructField(c, t) for c, t in columns[table]])


def ensure_all(spark: SparkSession, root: str, steps: tuple[str, ...] = ("1h", "4h", "1d")) -> list[str]:
    """Empty serving and dashboard tables of all intervals where there are none; returns their paths."""
    tables = {f"features/{f}_{k}": serving_schema(f) for f in FAMILIES for k in steps}
    tables |= {f"dashboard/{t}_{k}": dashboard_schema(t) for t, ks in (("futures_klines", CANDLES), ("futures_metrics", READINGS), ("sentiment", MOODS)) for k in ks}
    for name, schema in tables.items():
        ensure(spark, f"{root}/{name}", schema)
    return [f"{root}/{name}" for name in tables]


def json_column(c: Column | str) -> Column:
    """A map, struct or array as JSON, without null members."""
    return F.to_json(F.col(c) if isinstance(c, str) else c, {"ignoreNullFields": "true"})


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def export_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    df.select(*columns).write.mode("overwrite").option("header", "true").csv(path)


def with_period(df: DataFrame, time: str, monthly: bool = False) -> DataFrame:
    """Adds `period` from a timestamp column."""
    return df.withColumn("period", period_of(to_ms(time), monthly))
