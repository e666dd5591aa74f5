"""A batch data source over paged interfaces: one partition a stretch of time, each read page by page with retries."""

from __future__ import annotations

import importlib
import time
from collections.abc import Callable, Iterator
from functools import reduce
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

T = TypeVar("T")

#: Attempts at a page, seconds before the second (doubled each time), and milliseconds that are passed over when none succeeds.
ATTEMPTS, WAIT_S, SKIP_MS = 5, 1.0, 60_000


class RateLimited(OSError):
    """Raised by a fetch that came too often; wait_s says when it may come again."""

    def __init__(self, wait_s: float = 60.0) -> None:
        super().__init__("rate limit")
        self.wait_s = wait_s


def attempt(call: Callable[[], T], wait_s: float = WAIT_S, attempts: int = ATTEMPTS) -> T | None:
    """What `call` gives, tried again after failures of the connection and as long as the rate limit asks; None if no attempt succeeds."""
    for n in range(attempts):
        try:
            return call()
        except RateLimited as e:
            time.sleep(e.wait_s)
        except OSError:
            time.sleep(wait_s * 2**n)
    return None


def pages(fetch: Callable[[int, int, int], list[tuple]], start: int, end: int, limit: int, time_of: Callable[[tuple], int], wait_s: float = WAIT_S, missed: list[tuple[int, int]] | None = None) -> Iterator[tuple]:
    """Rows from start to before end, page by page. A page begins at the last row's time, whose rows may go over its end; those seen already are left out.

    A page that can't be had costs SKIP_MS, and a millisecond with more rows than a page holds the rest of them; both are noted in `missed` as (from, to).
    """
    at, seen = start, set()
    missed = [] if missed is None else missed
    while at < end:
        got = attempt(lambda: fetch(at, end, limit), wait_s)
        if got is None:
            missed.append((at, min(at + SKIP_MS, end)))
            at, seen = at + SKIP_MS, set()
            continue
        inside = [r for r in got if at <= time_of(r) < end and r not in seen]
        yield from inside
        if len(got) < limit:
            return
        last = max([time_of(r) for r in inside], default=at)
        if last == at and not inside:
            missed.append((at, at + 1))
            at, seen = at + 1, set()
        else:
            seen = {r for r in inside if time_of(r) == last} | (seen if last == at else set())
            at = last


def complete(fetches: dict[str, Callable[[int], dict | None]], bucket: int, attempts: int = ATTEMPTS, wait_s: float = WAIT_S) -> dict[str, dict] | None:
    """What all endpoints have for a bucket, by their names: those that lack it are asked again until every one has it; None if one never has."""
    got: dict[str, dict] = {}
    for n in range(attempts):
        for name in fetches.keys() - got.keys():
            x = attempt(lambda name=name: fetches[name](bucket), wait_s, 1)
            if x:
                got[name] = x
        if len(got) == len(fetches):
            return got
        if n < attempts - 1:
            time.sleep(wait_s)
    return None


class Stretch(InputPartition):
    def __init__(self, start: int, end: int) -> None:
        self.start, self.end = start, end


class PagedReader(DataSourceReader):
    def __init__(self, options: dict, schema) -> None:
        self.o, self.schema = options, schema

    def partitions(self) -> list[Stretch]:
        a, b, step = int(self.o["start"]), int(self.o["end"]), int(self.o.get("stretch", 86_400_000))
        return [Stretch(x, min(x + step, b)) for x in range(a, b, step)]

    def read(self, partition: Stretch) -> Iterator[tuple]:
        module, name = self.o["fetch"].split(":")
        fetch = getattr(importlib.import_module(module), name)
        column, width = int(self.o.get("time_column", 0)), len(self.schema.fields)
        missed: list[tuple[int, int]] = []
        yield from ((*r, None) for r in pages(fetch, partition.start, partition.end, int(self.o.get("limit", 1000)), lambda r: r[column], float(self.o.get("wait_s", WAIT_S)), missed))
        for a, b in missed:
            yield tuple(a if i == column else b if i == width - 1 else None for i in range(width))


class PagedSource(DataSource):
    """Options: fetch (`module:function` of start, end, limit), start, end, stretch (ms), limit, time_column, wait_s, and the schema. A column missed_until is added: null for rows; a row of nulls with a time and missed_until marks a stretch that could not be had."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return self.options["row_schema"] + ", missed_until long"

    def reader(self, schema) -> PagedReader:
        return PagedReader(dict(self.options), schema)


def read_paged(spark: SparkSession, fetch: str, schema: str, start: int, end: int, **options) -> DataFrame:
    spark.dataSource.register(PagedSource)
    return spark.read.format("paged").options(fetch=fetch, row_schema=schema, start=start, end=end, **options).load()


def merge_endpoints(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Rows of the keys that all frames have, their columns side by side."""
    return reduce(lambda a, b: a.join(b, keys, "inner"), frames)
