"""Session helpers: settings the engine relies on, the shared work folder and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NullType

#: Most rows a lookup table may have to be broadcast by `lookup`; a few hundred bytes a row keep it under some 20 MB.
BROADCAST_ROWS = 50_000


def make_session(app: str = "tidelattice", master: str | None = None, partitions: int | None = None) -> SparkSession:
    """A session with UTC times and adaptive execution; anything else stays as the cluster sets it."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    return builder.getOrCreate()


def _hadoop(spark: SparkSession, path: str):
    """Path and file system of a shared path, whatever the scheme."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: that of `setCheckpointDir` if it was called, else the one spark.checkpoint.dir names.

    Where neither names one, a temporary folder is set in local mode only (tests on one machine); on a cluster that is an error.
    """
    set_already = spark.sparkContext._jsc.sc().getCheckpointDir()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if set_already.isDefined():
        return named or set_already.get()
    if named is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="tidelattice-")
        spark.conf.set("spark.checkpoint.dir", named)
    spark.sparkContext.setCheckpointDir(named)
    return named


def qualified(spark: SparkSession, path: str) -> str:
    """`path` with its scheme, as workers need it."""
    p, fs = _hadoop(spark, path)
    return p.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString()


def worker_files(uri: str):
    """File system and path of a qualified shared path, in a Python worker."""
    from pyarrow import fs

    scheme, rest = uri.split(":", 1)
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(("s3" if scheme in ("s3a", "s3n") else scheme) + ":" + rest)


#: Paths under the shared folder that `scratch` gave out, by application.
_GIVEN: dict[str, list[str]] = {}


def cut(df: DataFrame) -> DataFrame:
    """`df` written to the shared folder and read from there: a lost executor can't lose it, later uses don't compute it again."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` as a compressed columnar table in the shared folder: like `cut` where later uses read few of its columns or wide rows should be small."""
    names = [c.lower() for c in df.columns]
    if len(set(names)) < len(names) or any(isinstance(f.dataType, NullType) for f in df.schema):
        return cut(df)  # files can't tell such columns apart, or hold them
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _GIVEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release(spark: SparkSession) -> None:
    """Deletes what this application wrote into the shared folder. Results that were not written or collected yet can't be read after it."""
    paths = _GIVEN.pop(spark.sparkContext.applicationId, [])
    made = spark.sparkContext._jsc.sc().getCheckpointDir()
    if made.isDefined():
        p, fs = _hadoop(spark, made.get())
        paths += [f.getPath().toString() for f in fs.listStatus(p)] if fs.exists(p) else []
    for path in paths:
        p, fs = _hadoop(spark, path)
        fs.delete(p, True)


def spread(df: DataFrame) -> DataFrame:
    """`df`, dealt out evenly if it is read in fewer tasks than there are cores: a few small files before costly work. Larger tables stay as they are read."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def lookup(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df`, with a broadcast hint if it is counted to have at most `max_rows` rows; beyond that Spark joins it by shuffle."""
    small = df.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(df) if small else df
