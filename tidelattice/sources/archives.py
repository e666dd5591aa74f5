"""Bulk files: CSV in ZIP and JSON lines in zstandard, one file a task, read as streams."""

from __future__ import annotations

import csv
import io
import json
import zipfile
from collections.abc import Iterator
from datetime import date, timedelta
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelattice.functions.normalize import drop_header_rows
from tidelattice.operators import csv_machine
from tidelattice.session import stored
from tidelattice.sources.lake import partitions

#: Rows that are handed over at once.
BATCH = 20_000


def _open(path: str):
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    return system.open_input_file(inner)


def _paths(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths)), "path")


def periods(first: date, last: date, monthly: bool = False) -> list[str]:
    """Days, or months, from one date to another, as files are named by them."""
    if not monthly:
        return [(first + timedelta(days=i)).isoformat() for i in range((last - first).days + 1)]
    months = range(first.year * 12 + first.month - 1, last.year * 12 + last.month)
    return [f"{m // 12:04d}-{m % 12 + 1:02d}" for m in months]


def _members(path: str) -> Iterator[io.TextIOWrapper]:
    """The first CSV in a ZIP as text; nothing if there is none."""
    with _open(path) as f, zipfile.ZipFile(f) as z:
        name = next((n for n in z.namelist() if n.lower().endswith(".csv")), None)
        if name is not None:
            yield io.TextIOWrapper(z.open(name), "utf-8", "replace", newline="\n")


def zipped_lines(spark: SparkSession, paths: list[str], kind: str) -> DataFrame:
    """(raw_id, file_kind, file_name, line_no, line) of the first CSV in each ZIP: what `csv_machine.parse` takes, which sets bad lines apart with the reason. raw_id follows the order of `paths`."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["raw_id", "file_kind", "file_name", "line_no", "line"]
        for b in batches:
            for path, nth in zip(b["path"], b["nth"]):
                for text in _members(path):
                    rows = []
                    for no, line in enumerate(text, 1):
                        rows.append(((int(nth) << 40) + no, kind, path, no, line.removesuffix("\n")))
                        if len(rows) >= BATCH:
                            yield pd.DataFrame(rows, columns=names)
                            rows = []
                    if rows:
                        yield pd.DataFrame(rows, columns=names)

    files = spark.createDataFrame([(p, i) for i, p in enumerate(paths)], "path string, nth long").repartition(max(1, len(paths)), "path")
    return files.mapInPandas(run, "raw_id long, file_kind string, file_name string, line_no long, line string")


def zipped_csv(spark: SparkSession, paths: list[str], columns: list[str]) -> DataFrame:
    """Rows of the first CSV in each ZIP as texts under the given names; header rows are dropped. A line of another width is an error that names it: files that may have such lines are for `zipped_lines`."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path in b["path"]:
                for text in _members(path):
                    rows = []
                    for no, r in enumerate(csv.reader(text), 1):
                        if r and len(r) != len(columns):
                            raise ValueError(f"{path}, line {no}: {len(r)} columns instead of {len(columns)}")
                        if r:
                            rows.append(r)
                        if len(rows) >= BATCH:
                            yield pd.DataFrame(rows, columns=columns)
                            rows = []
                    yield pd.DataFrame(rows, columns=columns)

    return drop_header_rows(_paths(spark, paths).mapInPandas(run, ", ".join(f"`{c}` string" for c in columns)))


def bulk_load(spark: SparkSession, files: dict[str, str], kind: str, lake: str, rejects: str) -> list[str]:
    """Loads the ZIPs of periods (period to path) that the lake doesn't have: typed rows under their period, bad lines with their reasons under `rejects`. Returns the periods that were loaded.

    All files are one job, a file a task. A period counts as there if the lake has a folder for it.
    """
    there = set(partitions(spark, lake))
    new = {p: f for p, f in sorted(files.items()) if p not in there}
    if not new:
        return []
    of = F.create_map(*[F.lit(x) for p, f in new.items() for x in (f, p)])
    parsed = stored(csv_machine.parse(zipped_lines(spark, list(new.values()), kind)).withColumn("period", of[F.col("file_name")]), "lines")
    good = csv_machine.rows_of(parsed, kind, "period").drop("raw_id")
    for df, path in ((good, lake), (csv_machine.rejects(parsed, "period"), rejects)):
        df.repartition("period").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period").parquet(path)
    return list(new)


def zstd_json_lines(spark: SparkSession, paths: list[str], fields: list[str], communities: list[str] | None = None) -> DataFrame:
    """(path, line_no, the fields as texts, bad) of zstandard files of JSON lines; bad marks lines that aren't JSON objects. communities: only rows of these subreddits, in any case."""
    wanted = {c.lower() for c in communities} if communities else None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        names = ["path", "line_no", *fields, "bad"]
        for b in batches:
            for path in b["path"]:
                rows = []
                with _open(path) as f, zstandard.ZstdDecompressor(max_window_size=2**31).stream_reader(f) as z:
                    for no, line in enumerate(io.TextIOWrapper(z, "utf-8", "replace")):
                        try:
                            x = json.loads(line)
                            bad = not isinstance(x, dict)
                        except ValueError:
                            x, bad = {}, True
                        if not bad and wanted and str(x.get("subreddit", "")).lower() not in wanted:
                            continue
                        get = {} if bad else x
                        rows.append((path, no, *[v if v is None or isinstance(v, str) else json.dumps(v) for v in (get.get(k) for k in fields)], bad))
                        if len(rows) >= BATCH:
                            yield pd.DataFrame(rows, columns=names)
                            rows = []
                yield pd.DataFrame(rows, columns=names)

    return _paths(spark, paths).mapInPandas(run, "path string, line_no long, " + ", ".join(f"`{c}` string" for c in fields) + ", bad boolean")


def social_fields(df: DataFrame) -> DataFrame:
    """Adds created, created_date, author_prefixed, link and text to rows of a dump."""
    at = F.timestamp_seconds(F.col("created_utc").try_cast("long"))
    title = F.col("title") if "title" in df.columns else F.lit(None).cast("string")
    body = F.col("selftext") if "selftext" in df.columns else F.col("body")
    link = F.coalesce(F.col("permalink"), F.lit("")) if "permalink" in df.columns else F.lit("")
    return df.select("*", F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("created"), F.to_date(at).alias("created_date"), F.concat(F.lit("u/"), F.coalesce("author", F.lit(""))).alias("author_prefixed"), link.alias("link"), F.trim(F.concat_ws(" ", title, body)).alias("text"))


def tree_comments(df: DataFrame, column: str, depth: int = 8) -> DataFrame:
    """(id, author, link_id, body, created_utc, level) of the comments of a listing's JSON, with the answers to them down to `depth` levels; and, with kind `more`, a row for each comment that the listing only names (id, level), to be asked for."""
    schema = "struct<data: struct<children: array<struct<kind: string, data: struct<id: string, author: string, link_id: string, body: string, created_utc: double, replies: string, children: array<string>>>>>>"
    level = df.select(F.from_json(column, schema)["data"]["children"].alias("c"))
    out = []
    for k in range(depth):
        each = level.select(F.explode("c").alias("c"))
        said = each.filter("c.kind = 't1'")
        out.append(said.select(F.lit("t1").alias("kind"), "c.data.id", "c.data.author", "c.data.link_id", "c.data.body", F.col("c.data.created_utc").cast("long").alias("created_utc"), F.lit(k).alias("level")))
        none = F.lit(None).cast("string")
        named = each.filter("c.kind = 'more'").select(F.explode("c.data.children").alias("id"))
        out.append(named.select(F.lit("more").alias("kind"), "id", none.alias("author"), none.alias("link_id"), none.alias("body"), F.lit(None).cast("long").alias("created_utc"), F.lit(k).alias("level")))
        level = said.filter("c.data.replies like '{%'").select(F.from_json("c.data.replies", schema)["data"]["children"].alias("c"))
    return reduce(DataFrame.unionByName, out)
