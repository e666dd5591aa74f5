"""Rows of CSV lines, and the lines that are none with the reason.

The lines of a batch are one run of bytes, cut into chunks of equal width that may begin anywhere, also inside a quoted field. A finite
machine with five states reads them. For every chunk the map from each possible start state to its end state is computed, all chunks at once;
maps compose, so a prefix composition in a logarithmic number of steps gives each chunk's real start state, and a second sweep the state
before every byte. Delimiters, broken quoting and its offset follow from those states. Values are checked where the fields are cut; good rows are typed in the JVM.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelattice.functions.normalize import MICROS_FROM, SECONDS_BELOW, epoch_ms, parse_bool

#: The columns of the three kinds of files in their order.
COLUMNS = {
    "futures_klines": ["open_time", "open", "high", "low", "close", "volume", "close_time", "quote_volume", "count", "taker_buy_volume", "taker_buy_quote_volume", "ignore"],
    "futures_metrics": ["create_time", "symbol", "sum_open_interest", "sum_open_interest_value", "count_toptrader_long_short_ratio", "sum_toptrader_long_short_ratio", "count_long_short_ratio", "sum_taker_long_short_vol_ratio"],
    "futures_aggtrades": ["agg_trade_id", "price", "quantity", "first_trade_id", "last_trade_id", "transact_time", "is_buyer_maker"],
}
#: The type of each column that isn't a number with a fraction.
TYPES = {"open_time": "epoch", "close_time": "epoch", "transact_time": "epoch", "create_time": "time", "agg_trade_id": "id", "first_trade_id": "count", "last_trade_id": "count", "count": "count", "is_buyer_maker": "bool", "symbol": "text"}
#: The first millisecond of 2017 and of 2035.
SINCE_MS, UNTIL_MS = 1_483_228_800_000, 2_051_222_400_000

CHUNK = 256
OTHER, COMMA, QUOTE, END = range(4)
START, PLAIN, QUOTED, CLOSED, BROKEN = range(5)
#: Next state by class of byte and state. A quote may open only at a field's start, and after the closing one only a comma or the line's end may follow.
STEP = np.array([[PLAIN, PLAIN, QUOTED, BROKEN, BROKEN], [START, START, QUOTED, START, BROKEN], [QUOTED, BROKEN, CLOSED, QUOTED, BROKEN], [START] * 5], np.uint8)


def states(classes: np.ndarray) -> np.ndarray:
    """State of the machine before each byte, from the bytes' classes; the first byte is at a field's start."""
    n = len(classes)
    rows = max(1, -(-n // CHUNK))
    grid = np.full(rows * CHUNK, OTHER, np.uint8)
    grid[:n] = classes
    grid = grid.reshape(rows, CHUNK)
    maps = np.tile(np.arange(5, dtype=np.uint8), (rows, 1))
    for j in range(CHUNK):
        maps = STEP[grid[:, j, None], maps]
    k = 1
    while k < rows:  # after it maps[i] leads from the start of the run to the end of chunk i
        maps[k:] = np.take_along_axis(maps[k:], maps[:-k].astype(np.intp), axis=1)
        k *= 2
    state = np.concatenate([[START], maps[:-1, START]]).astype(np.uint8)
    before = np.empty((rows, CHUNK), np.uint8)
    for j in range(CHUNK):
        before[:, j] = state
        state = STEP[grid[:, j], state]
    return before.ravel()[:n]


def tokenize(lines: list[str]) -> tuple[list[list[str] | None], list[list[int]], np.ndarray]:
    """Fields of each line, their byte offsets, and the byte offset at which its quoting breaks (-1: nowhere; the fields are None then)."""
    raw = [(x[:-1] if x.endswith("\r") else x).encode("utf-8", "surrogatepass") for x in lines]
    size = np.array([len(x) + 1 for x in raw], np.int64)
    ends = np.cumsum(size) - 1
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    classes = np.zeros(len(data), np.uint8)
    classes[data == 0x2C], classes[data == 0x22] = COMMA, QUOTE
    classes[ends] = END
    before = states(classes)
    broken = np.full(len(raw), -1, np.int64)
    bad = np.flatnonzero(before[ends] == BROKEN)
    if len(bad):
        entry = np.flatnonzero((before[1:] == BROKEN) & (before[:-1] != BROKEN))  # a line enters the broken state once
        broken[np.searchsorted(ends, entry)] = entry - (ends - size + 1)[np.searchsorted(ends, entry)]
    open_ = before[ends] == QUOTED
    broken[open_] = size[open_] - 1
    cuts = np.flatnonzero((classes == COMMA) & (before != QUOTED) & (before != BROKEN))
    at = np.searchsorted(cuts, ends - size + 1)
    upto = np.searchsorted(cuts, ends)
    fields: list[list[str] | None] = []
    starts: list[list[int]] = []
    for i, line in enumerate(raw):
        begin = int(ends[i] - size[i] + 1)
        c = (cuts[at[i] : upto[i]] - begin).tolist()
        begins = [0, *(x + 1 for x in c)]
        starts.append(begins)
        if broken[i] >= 0:
            fields.append(None)
            continue
        parts = [line[b:e].decode("utf-8", "replace") for b, e in zip(begins, [*c, len(line)])]
        fields.append([p[1:-1].replace('""', '"') if p[:1] == '"' else p for p in parts])
    return fields, starts, broken


_DIGITS = re.compile(r"[0-9]{1,18}")
_DECIMAL = re.compile(r"[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?")
_TIME = re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}")
_BOOLS = {"true", "false", "t", "f", "1", "0"}


def _is_epoch(x: str) -> bool:
    if not _DIGITS.fullmatch(x):
        return False
    n = int(x)
    return SINCE_MS <= (n * 1000 if n < SECONDS_BELOW else n // 1000 if n >= MICROS_FROM else n) < UNTIL_MS


def _is_time(x: str) -> bool:
    if not _TIME.fullmatch(x):
        return _is_epoch(x)
    try:
        return x[11:13] < "24" and 2017 <= datetime.fromisoformat(x).year < 2035
    except ValueError:
        return False


#: What makes a value good, by the type of its column.
VALID = {
    "epoch": _is_epoch,
    "time": _is_time,
    "id": lambda x: bool(_DIGITS.fullmatch(x)),
    "count": lambda x: not x or bool(_DIGITS.fullmatch(x)),
    "bool": lambda x: x.lower() in _BOOLS,
    "text": bool,
    "double": lambda x: not x or (bool(_DECIMAL.fullmatch(x)) and math.isfinite(float(x))),
}
_CHECKS = {k: [VALID[TYPES.get(c, "double")] for c in names] for k, names in COLUMNS.items()}


def _tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        if not len(b):
            continue
        lines = b["line"].tolist()
        tokens, starts, broken = tokenize(["" if x is None else x for x in lines])
        rows = []
        for i, (raw_id, kind, name, no, line) in enumerate(zip(b["raw_id"], b["file_kind"], b["file_name"], b["line_no"], lines)):
            bare = (line or "").removesuffix("\r")
            checks = _CHECKS.get(kind)
            if not bare.strip(" \t") or (checks and bare == ",".join(COLUMNS[kind])):
                continue
            reason, at, column, fields = None, None, None, tokens[i]
            if checks is None:
                reason = "unknown_kind"
            elif fields is None:
                reason, at = "broken_quoting", int(broken[i])
            else:
                fields = [x.strip(" \t") for x in fields]
                if len(fields) != len(checks):
                    reason, at = "wrong_column_count", starts[i][min(len(checks), len(fields) - 1)]
                else:
                    first = next((j for j, (ok, x) in enumerate(zip(checks, fields)) if not ok(x)), None)
                    if first is not None:
                        reason, at, column = "invalid_value", starts[i][first], COLUMNS[kind][first]
            rows.append((raw_id, kind, name, no, fields, reason, at, column))
        out = pd.DataFrame(rows, columns=["raw_id", "file_kind", "file_name", "line_no", "fields", "reason", "error_at", "error_column"])
        yield out.astype({"error_at": "Int64"})


def _value(kind: str, x: Column) -> Column:
    """Typed value of a good field; null where it is empty. What is good was decided by VALID, once."""
    x = F.nullif(x, F.lit(""))
    if kind in ("epoch", "time"):
        ms = epoch_ms(x.try_cast("long"))
        if kind == "time":
            part = lambda i: F.substring(x, i, 2).try_cast("long")
            day = F.unix_date(F.substring(x, 1, 10).try_cast("date")).cast("long") * 86_400_000
            ms = F.when(F.contains(x, F.lit("-")), day + ((part(12) * 60 + part(15)) * 60 + part(18)) * 1000).otherwise(ms)
        return ms
    if kind in ("id", "count"):
        return x.try_cast("long")
    if kind == "bool":
        return parse_bool(x)
    return x if kind == "text" else x.try_cast("double")


def parse(lines: DataFrame) -> DataFrame:
    """raw_id, file_kind, file_name, line_no, and: fields (texts without blanks around; null where quoting breaks), reason, error_at, error_column.

    lines: raw_id, file_kind, file_name, line_no, line. reason is null for a good row, else the first that applies of `broken_quoting`,
    `wrong_column_count`, `invalid_value`, or `unknown_kind` for a kind without columns. error_at is a byte offset in the line: where the quoting
    breaks (the line's end for an open quote), where the first surplus field starts (the last field if some lack), where the first wrong value starts.
    Null or blank lines and lines equal to their kind's header give no row. Repeated lines are parsed alike, an empty table gives an empty
    one; further columns are ignored.
    """
    # whole numbers travel as texts, since nulls among them would make them fractions
    cols = lines.select(F.col("raw_id").cast("string").alias("raw_id"), "file_kind", "file_name", F.col("line_no").cast("string").alias("line_no"), "line")
    out = cols.mapInPandas(_tokens, "raw_id string, file_kind string, file_name string, line_no string, fields array<string>, reason string, error_at long, error_column string")
    return out.withColumns({"raw_id": F.col("raw_id").cast("long"), "line_no": F.col("line_no").cast("long")})


def rows_of(parsed: DataFrame, kind: str, *keep: str) -> DataFrame:
    """The good rows of one kind with its columns typed: times in epoch ms, identifiers and counts as long, the rest as double, boolean or text; and the columns in `keep`."""
    good = parsed.filter(F.col("reason").isNull() & (F.col("file_kind") == kind))
    return good.select("raw_id", *keep, *[_value(TYPES.get(c, "double"), F.get("fields", F.lit(i))).alias(c) for i, c in enumerate(COLUMNS[kind])])


def all_rows(parsed: DataFrame) -> DataFrame:
    """The good rows of every kind, typed as in `rows_of`, in one pass: raw_id, file_kind and the columns of all kinds, null where a kind has none."""
    names = list(dict.fromkeys(c for columns in COLUMNS.values() for c in columns))
    good = parsed.filter(F.col("reason").isNull() & F.col("file_kind").isin(*COLUMNS))

    def text(c: str) -> Column:
        at = F.lit(None).cast("int")
        for kind, columns in COLUMNS.items():
            if c in columns:
                at = F.when(F.col("file_kind") == kind, columns.index(c)).otherwise(at)
        return F.get("fields", at)

    return good.select("raw_id", "file_kind", *[_value(TYPES.get(c, "double"), text(c)).alias(c) for c in names])


def rejects(parsed: DataFrame, *keep: str) -> DataFrame:
    """The lines that are no rows, and the columns in `keep`."""
    return parsed.filter(F.col("reason").isNotNull()).select("raw_id", "file_kind", "file_name", "line_no", "reason", "error_at", "error_column", *keep)


