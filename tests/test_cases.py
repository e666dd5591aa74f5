"""The data problems against plain Python on the smallest tables."""

import math
import re
from collections import defaultdict
from datetime import datetime, timezone
from decimal import Decimal
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from tidelattice.operators import lambda_views
from tidelattice.operators.csv_machine import COLUMNS, TYPES
from tidelattice.operators.topics import deliveries
from tidelattice.plans import cases

ZONES = {"CET": 60, "CEST": 120, "EST": -300, "EDT": -240, "GMT": 0, "Z": 0}
PLAIN = ["%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y/%m/%d %H:%M:%S", "%Y-%m-%d %H:%M:%S.%f", "%Y-%m-%dT%H:%M:%S.%f", "%Y%m%dT%H%M%S", "%d.%m.%Y %H:%M:%S", "%d %b %Y %H:%M:%S", "%a, %d %b %Y %H:%M:%S"]


def read_time(text, zone, day_first, received):
    """Instant of a text in ms, by strptime and zoneinfo."""
    if text is None:
        return None
    t = text.strip()
    if re.fullmatch(r"\d{9,}(\.\d+)?|\d(\.\d+)?E\d+", t):
        x = Decimal(t)
        return int(x * 1000) if x < 10**11 else int(x / 1000) if x >= 10**13 else int(x)
    own, m = None, re.search(r"(Z|[+-]\d\d:?\d\d| [A-Z]{3,4})$", t)
    if m and ":" in t + ":" * ("T" in t):
        g = m[1].strip()
        t = t[: m.start()].strip()
        own = ZONES[g] if g in ZONES else (-1 if g[0] == "-" else 1) * (int(g[1:3]) * 60 + int(g[-2:]))
    mine = ["%d/%m/%Y %H:%M:%S", "%d/%m/%Y %H:%M"] if day_first else ["%m/%d/%Y %H:%M:%S", "%m/%d/%Y %I:%M:%S %p", "%m/%d/%Y %H:%M"]
    for f in PLAIN + mine:
        try:
            d = datetime.strptime(t, f)
            break
        except ValueError:
            pass
    else:
        return None
    ms = lambda x: round(x.timestamp() * 1000)
    if own is not None:
        return ms(d.replace(tzinfo=timezone.utc)) - own * 60_000
    at = [u for fold in (0, 1) for u in [d.replace(tzinfo=ZoneInfo(zone), fold=fold)] if u.astimezone(timezone.utc).astimezone(ZoneInfo(zone)).replace(tzinfo=None) == d]
    at = [ms(u) for u in at]
    return max([a for a in at if a <= received] or at, default=None)


@pytest.fixture(scope="module")
def times(duck):
    feeds = {f: (z, d) for f, z, d in duck.sql("select feed, time_zone, day_first from feeds").fetchall()}
    out = {}
    for t, columns in (("spot_klines", ["open_time", "close_time"]), ("futures_metrics", ["create_time"])):
        for c in columns:
            for row, feed, text, r in duck.sql(f"select row_id, feed, {c}, epoch_ms(received_at) from {t}").fetchall():
                out[t, row, c] = (text, read_time(text, *feeds[feed], r))
    return out


def test_p6(spark, sf_dir, times):
    want = set()
    for (t, row, c), (text, ms) in times.items():
        if ms is None:
            continue
        x, own = text.strip(), None
        if t == "spot_klines":
            own = int(x) if re.fullmatch(r"\d+", x) else None
        elif re.fullmatch(r"\d{4}-\d\d-\d\d \d\d:\d\d:\d\d", x):
            own = round(datetime.strptime(x, "%Y-%m-%d %H:%M:%S").replace(tzinfo=timezone.utc).timestamp() * 1000)
        if own != ms:
            want.add((t, row, c, ms))
    got = [tuple(r) for r in cases.p6_found(spark, sf_dir).select("source_table", "row_id", "field", "utc_ms").collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_p1(spark, sf_dir, times, duck):
    periods, usable = defaultdict(set), defaultdict(set)
    for row, symbol, a, b in duck.sql("select row_id, symbol, sum_open_interest, sum_open_interest_value from futures_metrics").fetchall():
        ms = times["futures_metrics", row, "create_time"][1]
        if ms is None:
            continue
        p = ms // 300_000
        periods[symbol].add(p)
        for field, v in (("sum_open_interest", a), ("sum_open_interest_value", b)):
            if v is not None and math.isfinite(v) and v > 0:
                usable[symbol, field].add(p)
    want = {(s, p * 300_000, f) for s, ps in periods.items() for f in cases.INTEREST for p in range(min(ps), max(ps) + 1) if p not in usable[s, f]}
    got = [tuple(r) for r in cases.p1_found(spark, sf_dir).select("symbol", "bucket_create_time", "field").collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_p2(spark, sf_dir, times, duck):
    """Impossible values and stuck runs exactly; spikes are tested on a small series in test_edges."""
    names = [c for c in duck.sql("select * from futures_metrics limit 0").columns if c != "row_id"]
    data = duck.sql(f"select row_id, {', '.join(names)} from futures_metrics").fetchall()
    want = set()
    at = {c: i + 1 for i, c in enumerate(names)}
    readings = defaultdict(list)
    for r in data:
        for f in cases.RATIOS:
            v = r[at[f]]
            if v is not None and (not math.isfinite(v) or v < 0):
                want.add((r[0], f))
        ms = times["futures_metrics", r[0], "create_time"][1]
        if ms is not None:
            readings[ms, tuple(repr(x) for x in r[1:])].append(r)
    by_symbol = defaultdict(list)
    for (ms, _), copies in readings.items():
        by_symbol[copies[0][at["symbol"]]].append((ms, copies))
    for rows in by_symbol.values():
        rows.sort(key=lambda x: x[0])
        for f in cases.RATIOS:
            seq = [(c[0][at[f]], c) for _, c in rows if c[0][at[f]] not in (None, 0)]
            i = 0
            while i < len(seq):
                j = i
                while j < len(seq) and seq[j][0] == seq[i][0]:
                    j += 1
                if j - i >= 12:
                    want |= {(r[0], f) for _, c in seq[i:j] for r in c}
                i = max(j, i + 1)
    got = {(r.row_id, r.field) for r in cases.p2_kinds(spark, sf_dir).filter("kind != 'spike'").collect()}
    assert got == want


def cut_line(line):
    out, i = [], 0
    while True:
        if line[i : i + 1] == '"':
            j, value = i + 1, ""
            while True:
                if j >= len(line):
                    return None
                if line[j] != '"':
                    value += line[j]
                    j += 1
                elif line[j + 1 : j + 2] == '"':
                    value += '"'
                    j += 2
                else:
                    break
            j += 1
            if j < len(line) and line[j] != ",":
                return None
        else:
            j = line.find(",", i) if "," in line[i:] else len(line)
            value = line[i:j]
            if '"' in value:
                return None
        out.append(value)
        if j >= len(line):
            return out
        i = j + 1


def good(kind, x):
    x = x.strip(" \t")
    if kind in ("epoch", "time"):
        if kind == "time" and re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}", x):
            try:
                return 2017 <= datetime.strptime(x, "%Y-%m-%d %H:%M:%S").year < 2035
            except ValueError:
                return False
        if not re.fullmatch("[0-9]+", x):
            return False
        n = int(x)
        return 1_483_228_800_000 <= (n * 1000 if n < 10**11 else n // 1000 if n >= 10**13 else n) < 2_051_222_400_000
    if kind == "id":
        return bool(re.fullmatch("[0-9]{1,18}", x))
    if kind == "count":
        return x == "" or bool(re.fullmatch("[0-9]{1,18}", x))
    if kind == "bool":
        return x.lower() in ("true", "false", "t", "f", "1", "0")
    if kind == "text":
        return x != ""
    return x == "" or bool(re.fullmatch(r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?", x)) and math.isfinite(float(x))


def test_p5(spark, sf_dir, duck):
    want = set()
    for raw_id, kind, line in duck.sql("select raw_id, file_kind, line from raw_rows").fetchall():
        line = line.removesuffix("\r")
        if not line.strip(" \t") or line == ",".join(COLUMNS[kind]):
            continue
        f = cut_line(line)
        if f is None:
            want.add((raw_id, "broken_quoting"))
        elif len(f) != len(COLUMNS[kind]):
            want.add((raw_id, "wrong_column_count"))
        elif not all(good(TYPES.get(c, "double"), x) for c, x in zip(COLUMNS[kind], f)):
            want.add((raw_id, "invalid_value"))
    got = [tuple(r) for r in cases.p5_found(spark, sf_dir).select("raw_id", "reason").collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_p4_served(spark, sf_dir, duck):
    """Frozen hours are the batch layer's of all arrivals."""
    got = {(r.topic, r.symbol, r.hour_end): r for r in cases.p4_served(spark, sf_dir).collect()}
    for topic, query, n in (("futures_aggtrades", cases.p4_hourly, "trades"), ("futures_klines", cases.p4_bars, "bars")):
        want = {(topic, r.symbol, r.hour_end): r for r in query(spark, sf_dir).collect()}
        assert {k for k, r in got.items() if k[0] == topic and r.state == "frozen"} <= set(want)
        last = max(r.hour_end for k, r in got.items() if k[0] == topic and r.state == "frozen")
        for k, w in want.items():
            if k[2] <= last:
                r = got[k]
                assert (r.state, r.records, r.corrected, r.open, r.high, r.low, r.close) == ("frozen", w[n], w.corrected, w.open, w.high, w.low, w.close), k
        assert sum(w.corrected for w in want.values()) > 0


def test_p4_replay(spark, sf_dir, duck):
    """Arrivals up to an instant within an hour: hours that have not ended are what the batches on time add up to, each on its own."""
    symbol, close = cases._SYMBOL, cases._CLOSE
    each = f"select distinct {symbol} as s, {close} as t, batch_id, ((t - 1) // 3600000 + 1) * 3600000 as e, min(epoch_us(received_at)) over (partition by s, t, batch_id) as r from futures_klines"
    # the middle of an hour with bars on time
    now = duck.sql(f"select max(r) from ({each}) where t is not null and r <= e * 1000 and r // 1000000 % 3600 between 1200 and 2400").fetchall()[0][0]
    log = deliveries(cases.table(spark, sf_dir, "futures_klines"), "futures_klines", "batch_id", "close", "volume").filter(F.col("arrived_us") <= now)
    got = lambda_views.replay(log, lambda_views.BARS, "close", "volume", "batch_id", 3).collect()
    want = duck.sql(f"select s, e, count(*) from ({each}) where t is not null and r <= {now} and r <= (e + 60000) * 1000 and e * 1000 > {now} group by 1, 2").fetchall()
    assert {(r.symbol, r.period_end, r.records) for r in got if r.state == "provisional"} == set(want) and want
    assert {"frozen", "provisional"} <= {r.state for r in got} and len(got) == len({(r.symbol, r.period_end) for r in got})


def typed(kind, x):
    """Value of a good field, by plain Python."""
    x = x.strip(" \t")
    if kind == "time" and "-" in x:
        return round(datetime.strptime(x, "%Y-%m-%d %H:%M:%S").replace(tzinfo=timezone.utc).timestamp() * 1000)
    if kind in ("epoch", "time"):
        n = int(x)
        return n * 1000 if n < 10**11 else n // 1000 if n >= 10**13 else n
    if kind in ("bool", "text"):
        return x.lower() in ("true", "t", "1") if kind == "bool" else x
    return None if x == "" else int(x) if kind in ("id", "count") else float(x)


def test_p5_loaded(spark, sf_dir, duck):
    """Every line that is no reject, no header and not blank is a row with all its values, whatever its kind."""
    want = {}
    for raw_id, kind, line in duck.sql("select raw_id, file_kind, line from raw_rows where line is not null").fetchall():
        line = line.removesuffix("\r")
        f = cut_line(line) if line.strip(" \t") and line != ",".join(COLUMNS[kind]) else None
        if f and len(f) == len(COLUMNS[kind]) and all(good(TYPES.get(c, "double"), x) for c, x in zip(COLUMNS[kind], f)):
            want[raw_id] = (kind, {c: typed(TYPES.get(c, "double"), x) for c, x in zip(COLUMNS[kind], f)})
    rows = cases.p5_loaded(spark, sf_dir).collect()
    got = {r.raw_id: (r.file_kind, {c: r[c] for c in COLUMNS[r.file_kind]}) for r in rows}
    assert len(rows) == len(got) and got == want and {k for k, _ in got.values()} == set(COLUMNS)
    assert all(r[c] is None for r in rows for c in r.__fields__ if c not in ("raw_id", "file_kind", *COLUMNS[r.file_kind]))
