"""Cleansing expressions: epochs, symbols, booleans, blank numbers, date texts, header rows. All stay in the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Below the first an epoch number is in seconds, from the second on in microseconds, else in milliseconds.
SECONDS_BELOW = 100_000_000_000
MICROS_FROM = 10_000_000_000_000

MINUTE_MS = 60_000
HOUR_MS = 3_600_000
DAY_MS = 86_400_000

#: The bar lengths in milliseconds.
INTERVALS = {"1m": 60_000, "5m": 300_000, "15m": 900_000, "1h": 3_600_000, "4h": 14_400_000, "1d": 86_400_000}

_BLANKS = " \t\n\r\x0b\x0c\u00a0\u2009\u200b\u3000"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_div(c: Column | str, step: int) -> Column:
    """Whole division that rounds down, also below zero."""
    x = _col(c).cast("long")
    return ((x - F.pmod(x, F.lit(step))) / F.lit(step)).cast("long")


def snap(c: Column | str, step: int) -> Column:
    """The largest multiple of `step` not above the value."""
    x = _col(c).cast("long")
    return x - F.pmod(x, F.lit(step))


def epoch_ms(c: Column | str) -> Column:
    """Epoch number of unknown unit to milliseconds; finer digits are cut off. Null stays null."""
    x = _col(c).cast("long")
    size = F.abs(x)
    return F.when(size < SECONDS_BELOW, x * 1000).when(size >= MICROS_FROM, floor_div(x, 1000)).otherwise(x)


def epoch_ms_micros_only(c: Column | str) -> Column:
    """As `epoch_ms` for sources that mix only milliseconds and microseconds."""
    x = _col(c).cast("long")
    return F.when(F.abs(x) >= MICROS_FROM, floor_div(x, 1000)).otherwise(x)


def symbol_of(c: Column | str) -> Column:
    """Upper case without any blank."""
    return F.upper(F.translate(_col(c), _BLANKS, ""))


def blank_to_double(c: Column | str) -> Column:
    """A number text; blank or unreadable gives null."""
    return F.nullif(F.trim(_col(c).cast("string")), F.lit("")).try_cast("double")


#: Texts that stand for nothing.
NOTHING = ("", "none", "null", "nan")


def nothing_to_null(c: Column | str) -> Column:
    """Null for a text that stands for nothing, in any case and with blanks around it; other texts unchanged."""
    x = _col(c).cast("string")
    return F.when(~F.lower(F.trim(x)).isin(*NOTHING), x)


def coerced(c: Column | str, kind: str) -> Column:
    """A message's member as `kind`, whatever type it came as: texts that stand for nothing, unreadable ones and NaN are null."""
    x = nothing_to_null(c)
    if kind == "boolean":
        return parse_bool(x)
    if kind in ("float", "double"):
        v = F.trim(x).try_cast(kind)
        return F.when(~F.isnan(v), v)
    if kind in ("int", "bigint", "long"):
        return F.coalesce(F.trim(x).try_cast(kind), F.trim(x).try_cast("double").try_cast(kind))  # 5.0 is 5
    return x if kind == "string" else F.trim(x).try_cast(kind)


def parse_bool(c: Column | str) -> Column:
    """true/1/t and false/0/f in any case; anything else is null."""
    x = F.lower(F.trim(_col(c).cast("string")))
    return F.when(x.isin("true", "1", "t"), F.lit(True)).when(x.isin("false", "0", "f"), F.lit(False))


def text_to_ms(c: Column | str) -> Column:
    """Digits as an epoch number, else `yyyy-MM-dd HH:mm:ss` or the same with a T, as UTC; else null."""
    x = F.trim(_col(c).cast("string"))
    parts = F.split(F.regexp_replace(x, r"^(\d{4})-(\d{2})-(\d{2})[ T](\d{2}):(\d{2}):(\d{2})$", "$1-$2-$3-$4-$5-$6"), "-")
    n = lambda i: F.try_element_at(parts, F.lit(i)).try_cast("int")
    when = F.try_make_timestamp(n(1), n(2), n(3), n(4), n(5), n(6).cast("decimal(16,6)"), F.lit("UTC"))
    return F.when(x.rlike(r"^\d{1,18}$"), epoch_ms(x.try_cast("long"))).when(x.rlike(r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}$") & (n(6) < 60), F.unix_millis(when))


def to_ms(c: Column | str) -> Column:
    """Timestamp to epoch milliseconds."""
    return F.unix_millis(_col(c).cast("timestamp"))


def drop_header_rows(df: DataFrame) -> DataFrame:
    """Without the rows in which every cell equals its column's name; nulls count as different."""
    same = reduce(lambda a, b: a & b, [F.col(f"`{c}`").cast("string").eqNullSafe(F.lit(c)) for c in df.columns])
    return df.filter(~same)


def recover_headerless(df: DataFrame, names: list[str]) -> DataFrame:
    """A frame whose first data row became its header: columns get `names`, the row comes back (repeat marks `_duplicated_N` cut off)."""
    if set(names) & set(df.columns):
        return df
    if len(df.columns) != len(names):
        raise ValueError(f"expected {len(names)} columns, found {len(df.columns)}")
    first = [c.split("_duplicated_")[0] for c in df.columns]
    row = df.sparkSession.createDataFrame([tuple(first)], ", ".join(f"`{n}` string" for n in names))
    return df.toDF(*names).select([F.col(n).cast("string").alias(n) for n in names]).unionByName(row)


def filter_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Without rows that lack any of the key columns."""
    return df.dropna(subset=list(keys))


def fill_zero_gaps(df: DataFrame, columns: list[str], partition: list[str], order: list[str]) -> DataFrame:
    """Zeros count as missing; missing values take the last value before them in their partition, else the first one after."""
    from pyspark.sql import Window

    w = Window.partitionBy(*partition)
    # reading ahead as a look back in reverse order: frames that end at the partition's end are quadratic
    back, ahead = (w.orderBy(*o).rowsBetween(Window.unboundedPreceding, 0) for o in (order, [F.desc(c) for c in order]))
    x = {c: F.nullif(F.col(c), F.lit(0.0)) for c in columns}
    rest = [c for c in df.columns if c not in columns]
    df = df.select(*rest, *[F.last(v, ignorenulls=True).over(back).alias(f"_b_{c}") for c, v in x.items()], *[F.last(v, ignorenulls=True).over(ahead).alias(f"_a_{c}") for c, v in x.items()])
    return df.select(*rest, *[F.coalesce(f"_b_{c}", f"_a_{c}").alias(c) for c in columns])
