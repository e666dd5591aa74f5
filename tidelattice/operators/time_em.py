"""Time texts of mixed form, precision and zone as one UTC instant.

Each text is read, once and in Arrow batches, under every reading that it allows: an epoch number, or a calendar form with or without zone, where purely
numeric dates allow day first and month first, and some zone abbreviations two zones. What it may mean is stored beside the row. Expectation maximisation then runs per source over the mixture of readings: how often
each reading occurs at the source (starting from what is known of the source) times how likely the candidate is given the row's arrival.
It needs only the counts of signatures (which readings a text allows, and how each lies to the arrival), so one aggregation over all rows
feeds it and its size doesn't depend on theirs. Posteriors choose the reading; where none reaches the threshold the text is marked ambiguous.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from decimal import Decimal, InvalidOperation

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelattice.session import lookup, stored

#: Minutes east of UTC of zone abbreviations.
ABBREVIATIONS = {"Z": 0, "UTC": 0, "GMT": 0, "WET": 0, "BST": 60, "WEST": 60, "CET": 60, "CEST": 120, "EET": 120, "EEST": 180, "MSK": 180, "IST": 330, "SGT": 480, "HKT": 480, "AWST": 480, "JST": 540, "KST": 540, "ACST": 570, "ACDT": 630, "AEST": 600, "AEDT": 660, "NZST": 720, "NZDT": 780, "AST": -240, "ADT": -180, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420, "AKST": -540, "AKDT": -480, "HST": -600}
#: The other zone that some of them are used for (Israel, China, Bangladesh, Arabia, Malaysia).
OTHER_ZONES = {"IST": 120, "CST": 480, "BST": 360, "AST": 180, "MST": 480}
#: Months by the first three letters of their names.
MONTHS = {m: i + 1 for i, m in enumerate(("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"))}

#: A text without zone came less than this after its instant.
PROMPT_MS = 1_800_000
#: Likelihood of a candidate by its lag: the row came promptly, later, before it, or it isn't known when.
LIKELIHOOD = {"prompt": 1.0, "late": 0.01, "early": 1e-5, "unknown": 0.05}
#: Posterior from which a reading is taken.
SURE = 0.9
#: Pseudo counts of the reading that the source is known to use, and of any other.
KNOWN, OTHER = 20.0, 0.5
#: Epoch numbers before 1990 or from 2100 on are no instants.
EPOCH_MS = (631_152_000_000, 4_102_444_800_000)

_CLOCK = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?\s*([AaPp]\.?[Mm]\.?)?\s*(Z|z|[A-Za-z]{2,5}|(?:UTC|GMT)?[+-]\d{2}:?\d{2}|(?:UTC|GMT)?[+-]\d{1,2})?$"
#: Patterns of the calendar forms: three date groups, then hour, minute, second, fraction, half of the day, zone.
FORMS = {
    "iso": r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})(?:T|,?\s+)" + _CLOCK,
    "compact": r"^(\d{4})(\d{2})(\d{2})[T ]?(\d{2})(\d{2})(\d{2})?(?:[.,](\d{1,9}))?()\s*(Z|z|[A-Za-z]{2,5}|[+-]\d{2}:?\d{2}|[+-]\d{2})?$",
    "numeric": r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})(?:T|,?\s+)" + _CLOCK,
    "day_month": r"^(?:[A-Za-z]{3,9},?\s+)?(\d{1,2})[ -]([A-Za-z]{3,9})\.?,?[ -](\d{4}),?\s+" + _CLOCK,
    "month_day": r"^(?:[A-Za-z]{3,9},?\s+)?([A-Za-z]{3,9})\.?\s+(\d{1,2}),?\s+(\d{4}),?\s+" + _CLOCK,
}
NUMBER = r"^\d{9,18}$|^\d{9,18}\.\d*$|^\d(\.\d+)?[eE]\+?\d{1,2}$"


def trimmed(c: Column | str) -> Column:
    return F.btrim(F.col(c) if isinstance(c, str) else c, F.lit(" \t\n\x0b\f\r\u00a0"))


_NONE = np.iinfo(np.int64).min
_EMPTY = ("",) * 9


def _number(text: str) -> tuple[str | None, int]:
    """Kind and milliseconds of an epoch number."""
    try:
        x = Decimal(text)
    except InvalidOperation:
        return None, _NONE
    kind, ms = ("epoch_s", int(x * 1000)) if x < 100_000_000_000 else ("epoch_us", int(x / 1000)) if x >= 10_000_000_000_000 else ("epoch_ms", int(x))
    return (kind, ms) if EPOCH_MS[0] <= ms < EPOCH_MS[1] else (None, _NONE)


def _east(zone: str) -> int:
    """Milliseconds east of UTC that a zone states."""
    z = zone.upper()
    if z in ABBREVIATIONS:
        return ABBREVIATIONS[z] * 60_000
    m = re.fullmatch(r"(?:UTC|GMT)?([+-])(\d{1,2}):?(\d{2})?", z)
    if not m or int(m[2]) > 14 or int(m[3] or 0) > 59:
        return _NONE
    return (-1 if m[1] == "-" else 1) * (int(m[2]) * 60 + int(m[3] or 0)) * 60_000


def _day_ms(y: np.ndarray, m: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Midnight of a date in ms; _NONE where there is no such date."""
    good = (m >= 1) & (m <= 12) & (y >= 1)
    months = np.where(good, (y - 1970) * 12 + m - 1, 0)
    start, end = (x.astype("datetime64[M]").astype("datetime64[D]").astype(np.int64) for x in (months, months + 1))
    return np.where(good & (d >= 1) & (d <= end - start), (start + d - 1) * 86_400_000, _NONE)


def _from_zone(local: np.ndarray, tz: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Instants of clock readings in their zones: of two the later one that isn't after the arrival; _NONE where the zone skips the reading or isn't known."""
    out = np.full(len(local), _NONE)
    for zone in pd.unique(tz):
        rows = np.flatnonzero((tz == zone) & (local != _NONE))
        if not isinstance(zone, str) or not len(rows):
            continue
        try:
            clock = pd.DatetimeIndex(local[rows].astype("datetime64[ms]"))
            summer, winter = (clock.tz_localize(zone, ambiguous=np.full(len(rows), dst), nonexistent="NaT").as_unit("ms") for dst in (True, False))
        except (KeyError, ValueError, OSError):
            continue
        a, b = summer.asi8, winter.asi8
        out[rows] = np.where(summer.isna(), _NONE, np.where((b > a) & (b <= at[rows]), b, a))
    return out


def read_texts(texts: list, tz: np.ndarray, at: np.ndarray) -> pd.DataFrame:
    """kind, zoned, first, second of each text: the candidates in ms; second is the month-first one of a numeric date, or the one in the other zone that an abbreviation stands for (of a numeric date with such a zone only the date's two are told apart). at: arrivals in ms, _NONE if not known."""
    number, forms = re.compile(NUMBER, re.ASCII), [(k, re.compile(p, re.ASCII)) for k, p in FORMS.items()]
    kinds, first, groups = [], np.full(len(texts), _NONE), []
    for i, text in enumerate(texts):
        kind, group = None, _EMPTY
        if text:
            t = text.strip()
            if number.match(t):
                kind, first[i] = _number(t)
            else:
                for k, p in forms:
                    if m := p.match(t):
                        kind, group = k, m.groups("")
                        break
        kinds.append(kind)
        groups.append(group)
    kind = np.array(kinds, object)
    rows = np.flatnonzero([bool(g[0]) for g in groups])
    second, zoned = np.full(len(texts), _NONE), np.full(len(texts), "", object)
    if len(rows):
        g = np.array([groups[i] for i in rows], object)
        f = kind[rows]
        ints = lambda c: np.array([int(x) if x.isdigit() else -1 for x in c], np.int64)
        one, two, three = ints(g[:, 0]), ints(g[:, 1]), ints(g[:, 2])
        name = np.array([MONTHS.get(x[:3].lower(), -1) for x in np.where(f == "day_month", g[:, 1], g[:, 0])], np.int64)
        iso, md = np.isin(f, ["iso", "compact"]), f == "month_day"
        y, m, d = np.where(iso, one, three), np.where(np.isin(f, ["day_month", "month_day"]), name, two), np.where(iso, three, np.where(md, two, one))
        half, h, mi, sec = np.array([x[:1].upper() for x in g[:, 7]], object), ints(g[:, 3]), ints(g[:, 4]), np.where(g[:, 5] == "", 0, ints(g[:, 5]))
        hour = np.where(half == "", h, np.where((h >= 1) & (h <= 12), h % 12 + np.where(half == "P", 12, 0), 99))
        clock = ((hour * 60 + mi) * 60 + sec) * 1000 + np.array([int((x + "000")[:3]) for x in g[:, 6]], np.int64)
        good = (hour < 24) & (mi < 60) & (sec < 60)
        east = np.array([_east(z) if z else 0 for z in g[:, 8]], np.int64)
        own = g[:, 8] != ""
        other = np.array([OTHER_ZONES.get(z.upper(), _NONE) if z else _NONE for z in g[:, 8]], np.int64)
        twofold = (other != _NONE) & (f != "numeric")
        zoned[rows] = np.where(twofold, np.char.add("zoned:", np.char.upper(g[:, 8].astype(str))), np.where(own, "zoned", "local"))
        first_day = _day_ms(y, m, d)
        for out, day in ((first, first_day), (second, np.where(f == "numeric", _day_ms(y, d, m), _NONE))):
            local = np.where(good & (day != _NONE), day + clock, _NONE)
            if out is second:
                local = np.where(twofold & good & (first_day != _NONE), first_day + clock, local)
                east = np.where(twofold, other * 60_000, east)
            out[rows] = np.where(own, np.where((local != _NONE) & (east != _NONE), local - east, _NONE), _from_zone(np.where(own, _NONE, local), tz[rows], at[rows]))
    return pd.DataFrame({"kind": np.where((first == _NONE) & (second == _NONE), None, kind), "zoned": zoned, "first": pd.arrays.IntegerArray(first, first == _NONE), "second": pd.arrays.IntegerArray(second, second == _NONE)})


def _candidates(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for text, tz, at in parts:
        yield read_texts(text.tolist(), tz.to_numpy(object), at.fillna(_NONE).to_numpy(np.int64) if at.isna().any() else at.to_numpy(np.int64))


def _lag(ms: Column, received: Column) -> Column:
    return F.when(received.isNull(), "unknown").when(ms > received, "early").when(received - ms < PROMPT_MS, "prompt").otherwise("late")


def _with_candidates(df: DataFrame, column: str, tz: str, received: Column) -> DataFrame:
    """Adds `__first`, `__second` and `__sig`, which holds kind, zone and both lags; null if the text has no reading."""
    # not deterministic, so that filters on what follows from it aren't pushed below it, which would read each text twice
    read = F.pandas_udf(_candidates, "kind string, zoned string, first long, second long").asNondeterministic()(F.col(column), F.col(tz), F.col("__at"))
    df = df.select("*", received.alias("__at")).select("*", read.alias("__x"))
    one, two, at = F.col("__x.first"), F.col("__x.second"), F.col("__at")
    sig = F.when(F.col("__x.kind").isNotNull(), F.concat_ws("|", "__x.kind", "__x.zoned", F.when(one.isNotNull(), _lag(one, at)).otherwise("-"), F.when(two.isNotNull(), _lag(two, at)).otherwise("-")))
    return df.select("*", one.alias("__first"), two.alias("__second"), sig.alias("__sig")).drop("__x", "__at")


def expectation_maximisation(kind: list[tuple[str | None, str | None]], like: np.ndarray, n: np.ndarray, start: dict[str, float], rounds: int = 60) -> np.ndarray:
    """Posteriors (signatures x 2) of the two candidates' readings.

    kind: the reading of either candidate (None: there is none); like: their likelihoods; n: rows with the signature; start: pseudo counts.
    """
    names = sorted({k for pair in kind for k in pair if k} | set(start))
    at = {k: i for i, k in enumerate(names)}
    idx = np.array([[at.get(k, 0) for k in pair] for pair in kind])
    there = np.array([[k is not None for k in pair] for pair in kind])
    prior = np.array([start.get(k, OTHER) for k in names])
    weight = prior / prior.sum()
    post = np.zeros(idx.shape)
    for _ in range(rounds):
        joint = np.where(there, weight[idx] * like, 0.0)
        post = joint / np.maximum(joint.sum(axis=1, keepdims=True), 1e-300)
        mass = prior.copy()
        np.add.at(mass, idx.ravel(), (post * there * n[:, None]).ravel())
        new = mass / mass.sum()
        if np.abs(new - weight).max() < 1e-10:
            break
        weight = new
    return post


def _readings(kind: str, zoned: str) -> tuple[str, str]:
    """Names of the readings that the two candidates of a signature are."""
    if kind == "numeric":
        return "dmy", "mdy"
    zone = zoned.partition(":")[2]
    return (f"{zone}:first", f"{zone}:other") if zone else (kind, kind)


def _em(d: pd.DataFrame) -> pd.DataFrame:
    """One source's signatures, all fields together: order of dates is a habit of the source."""
    parts = [s.split("|") for s in d["sig"]]
    kind = [tuple(k if lag != "-" else None for k, lag in zip(_readings(p[0], p[1]), p[2:])) for p in parts]
    like = np.array([[LIKELIHOOD.get(lag, 0.0) for lag in p[2:]] for p in parts])
    order = d["day_first"].dropna()
    start = {"dmy": OTHER, "mdy": OTHER}
    if len(order):
        start["dmy" if order.iloc[0] else "mdy"] = KNOWN
    post = expectation_maximisation(kind, like, d["n"].to_numpy(float), start)
    return pd.DataFrame({"source": d["source"], "sig": d["sig"], "pick": np.where(post[:, 0] >= post[:, 1], 1, 2), "posterior": post.max(axis=1)})


def normalise(df: DataFrame, column: str, feeds: DataFrame, source: str = "feed", received: str = "received_at") -> DataFrame:
    """`df` with `<column>_utc_ms` and `<column>_state` for a text column.

    feeds: (feed, time_zone, day_first); a source without a row there has no zone, and its texts without zone are unreadable.
    state: `read`; `ambiguous` (two readings, none of them sure: no instant); `unreadable` (no instant, also a clock reading that its zone
    skips); `missing` (null). A null arrival rules no reading out; the earlier of two instants is taken then. A null source counts as unknown.
    Repeated rows are read alike, an empty table gives an empty one; other columns pass unchanged, but the two
    added ones replace columns of their names.
    """
    known = feeds.filter(F.col("feed").isNotNull()).groupBy(F.col("feed").alias("__feed")).agg(F.max("time_zone").alias("__tz"), F.max("day_first").alias("__day_first"))
    ours = [c for c in df.columns if c.startswith("__")]
    clash = {c: f"was{c}" for c in ours}
    rows = df.withColumnsRenamed(clash).join(lookup(known), F.col(source) == F.col("__feed"), "left").drop("__feed")
    rows = stored(_with_candidates(rows, column, "__tz", F.unix_millis(F.col(received).cast("timestamp"))).drop("__tz"), "times")
    of = F.coalesce(F.col(source), F.lit(""))
    seen = rows.filter("__sig is not null").groupBy(of.alias("source"), F.col("__day_first").alias("day_first"), F.col("__sig").alias("sig")).agg(F.count("*").alias("n"))
    picks = seen.groupBy("source").applyInPandas(_em, "source string, sig string, pick int, posterior double")
    picks = stored(picks.select(F.col("source").alias("__source"), F.col("sig").alias("__of"), F.col("pick").alias("__pick"), F.col("posterior").alias("__posterior")), "picks")  # a signature has four small parts, so a source has few
    rows = rows.join(lookup(picks), (of == F.col("__source")) & (F.col("__sig") == F.col("__of")), "left")
    first, second = F.col("__first"), F.col("__second")
    two = first.isNotNull() & second.isNotNull() & (first != second)
    sure = F.col("__posterior") >= SURE
    chosen = F.when(~two, F.coalesce(first, second)).when(sure, F.when(F.col("__pick") == 1, first).otherwise(second))
    state = F.when(F.col(column).isNull(), "missing").when(F.col("__sig").isNull(), "unreadable").when(two & ~sure, "ambiguous").otherwise("read")
    own = {f"{column}_utc_ms", f"{column}_state"}
    return rows.select(*[F.col(f"`{clash.get(k, k)}`").alias(k) for k in df.columns if k not in own], chosen.alias(f"{column}_utc_ms"), state.alias(f"{column}_state"))
