"""The pN_ queries of the core: the data problems on this project's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelattice.operators import bloom_dedupe, csv_machine, lambda_views, regular_grid, spikes, time_em, trailing
from tidelattice.operators.topics import TOPICS, deliveries, read_deliveries


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


READING_MS = 300_000
#: Neighbours of a missing period may be six hours apart to be interpolated between.
GRID_GAP_MS = 21_600_000


def readings(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Collected readings with create_time_utc_ms."""
    return time_em.normalise(table(spark, sf_dir, "futures_metrics").select("row_id", "feed", "symbol", "received_at", "create_time", *columns), "create_time", table(spark, sf_dir, "feeds"))


INTEREST = ["sum_open_interest", "sum_open_interest_value"]


def p1_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The regular five-minute series of every symbol."""
    return regular_grid.regular_grid(readings(spark, sf_dir, *INTEREST), "symbol", F.col("create_time_utc_ms"), "row_id", INTEREST, READING_MS, GRID_GAP_MS)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    missing = F.array_compact(F.array(*[F.when(F.col(f"{f}_state") != regular_grid.OBSERVED, f) for f in INTEREST]))
    return p1_grid(spark, sf_dir).select(F.col("source").alias("symbol"), F.col("at").alias("bucket_create_time"), F.explode(missing).alias("field"))


RATIOS = ["sum_open_interest", "sum_taker_long_short_vol_ratio", "count_long_short_ratio"]
OTHER_RATIOS = ["sum_open_interest_value", "count_toptrader_long_short_ratio", "sum_toptrader_long_short_ratio"]


def p2_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every implausible value with its kind."""
    rows = readings(spark, sf_dir, *RATIOS, *OTHER_RATIOS)
    return spikes.implausible(rows, "symbol", "create_time_utc_ms", "row_id", ["feed", "symbol", "received_at", "create_time", *RATIOS, *OTHER_RATIOS], RATIOS)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p2_kinds(spark, sf_dir).select("row_id", "field")


def _trailing_days(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    bars = trailing.trailing(table(spark, sf_dir, "futures_klines_1d"), "symbol", F.col("open_time"), "load_seq", ["relative_range", "log_return_close"], [7, 30])
    # create_time is the end of the day that a row describes
    interest = trailing.trailing(table(spark, sf_dir, "futures_metrics_1d"), "symbol", F.col("create_time") - F.expr("interval 1 day"), "load_seq", ["log_return_sum_open_interest_last"], [7, 30])
    return bars, interest


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars, interest = _trailing_days(spark, sf_dir)
    t = lambda m, w: F.col(f"{m}_total_{w}")
    # features have six decimals: a margin far below that keeps sums of other order from making cases of ties
    tiny = 1e-10
    rules = [
        (bars, "relative_range", t("relative_range", 7) / 7 - 1.8 * t("relative_range", 30) / 30 > tiny),
        (bars, "log_return_close", (t("log_return_close", 7) < -0.1500005) & (t("log_return_close", 30) > -0.1500005)),
        (interest, "log_return_sum_open_interest_last", (t("log_return_sum_open_interest_last", 7) > 0.1500005) & (t("log_return_sum_open_interest_last", 7) - t("log_return_sum_open_interest_last", 30) > tiny)),
    ]
    found = []
    for rows in (bars, interest):
        own = F.array_compact(F.array(*[F.when(rule, m) for r, m, rule in rules if r is rows]))
        found.append(rows.filter("nth >= 30").select(F.col("entity").alias("symbol"), F.date_from_unix_date("day").cast("string").alias("day"), F.explode(own).alias("measure")))
    return found[0].unionByName(found[1])


def _totals(rows: DataFrame, measures: list[str]) -> DataFrame:
    value = lambda m, w: [(F.round(f"{m}_total_{w}", 6) + 0).alias(f"{m}_total_{w}"), (F.round(F.col(f"{m}_total_{w}") / w, 7) + 0).alias(f"{m}_avg_{w}")]
    return rows.select(F.col("entity").alias("symbol"), F.date_from_unix_date("day").cast("string").alias("day"), *[c for m in measures for w in (7, 30) for c in value(m, w)])


def p3_trailing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals and averages of every symbol and day of the daily bars."""
    return _totals(_trailing_days(spark, sf_dir)[0], ["relative_range", "log_return_close"])


def p3_interest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals and averages of every symbol and day of the daily open interest."""
    return _totals(_trailing_days(spark, sf_dir)[1], ["log_return_sum_open_interest_last"])


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [lambda_views.late_records(read_deliveries(spark, sf_dir, [t]), p) for t, p in (("futures_aggtrades", lambda_views.TRADES), ("futures_klines", lambda_views.BARS))]
    return parts[0].unionByName(parts[1])


#: Part of the last digit added before rounding: sums of few decimals often lie on a tie, where engines that add in another order differ.
TIE = 0.13720391


def p4_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly trade aggregates as the batch layer leaves them."""
    log = deliveries(table(spark, sf_dir, "futures_aggtrades"), "futures_aggtrades", "price", "quantity")
    v = lambda_views.recompute(log, lambda_views.TRADES, "price", "quantity")
    return v.select("symbol", F.col("period_end").alias("hour_end"), F.col("records").alias("trades"), "corrected", F.round(F.col("weight") + TIE * 1e-6, 6).alias("quantity"), F.round(F.col("weighted") + TIE * 1e-3, 3).alias("turnover"), "low", "high", F.col("first.v").alias("open"), F.col("last.v").alias("close"))


BAR = lambda_views.Shape("open", "high", "low", ("quote_volume", "count"))


def p4_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly aggregates of the bars as the batch layer leaves them."""
    log = deliveries(table(spark, sf_dir, "futures_klines"), "futures_klines", "close", "volume", "open", "high", "low", "quote_volume", "count")
    v = lambda_views.recompute(log, lambda_views.BARS, "close", "volume", shape=BAR)
    total = lambda c, digits: F.round(F.col(c) + TIE * 10.0**-digits, digits)
    return v.select("symbol", F.col("period_end").alias("hour_end"), F.col("records").alias("bars"), "corrected", total("weight", 6).alias("volume"), total("total_quote_volume", 3).alias("quote_volume"), F.col("total_count").alias("count"), F.col("first.v").alias("open"), "high", "low", F.col("last.v").alias("close"))


#: Recomputations among the arrivals of a topic.
RUNS = 4


def p4_served(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly aggregates of trades and bars as a reader sees them after the last arrival, from both layers: batches in arrival order, scheduled recomputations, frozen hours."""
    trades = deliveries(table(spark, sf_dir, "futures_aggtrades"), "futures_aggtrades", "batch_id", "price", "quantity")
    bars = deliveries(table(spark, sf_dir, "futures_klines"), "futures_klines", "batch_id", "close", "volume", "open", "high", "low", "quote_volume", "count")
    parts = [lambda_views.replay(trades, lambda_views.TRADES, "price", "quantity", "batch_id", RUNS), lambda_views.replay(bars, lambda_views.BARS, "close", "volume", "batch_id", RUNS, BAR)]
    both = parts[0].unionByName(parts[1], allowMissingColumns=True)
    return both.select("topic", "symbol", F.col("period_end").alias("hour_end"), "state", "records", "corrected", "weight", "weighted", F.col("first.v").alias("open"), "high", "low", F.col("last.v").alias("close"), F.col("total_quote_volume").alias("quote_volume"), F.col("total_count").alias("count"))


def p4_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly trade aggregates as they stand ten minutes into the last hour that has so many: earlier hours frozen, the one before open, the current one provisional."""
    log = deliveries(table(spark, sf_dir, "futures_aggtrades"), "futures_aggtrades", "batch_id", "price", "quantity")
    hour, ten = 3_600_000_000, 600_000_000
    last = log.agg(F.max("arrived_us")).first()[0] or 0
    now = (last - ten) // hour * hour + ten
    v = lambda_views.views(log, lambda_views.TRADES, "price", "quantity", "batch_id", now)
    return v.select("symbol", F.col("period_end").alias("hour_end"), "state", F.col("records").alias("trades"), "corrected", F.round(F.col("weight") + TIE * 1e-6, 6).alias("quantity"), "low", "high", F.col("first.v").alias("open"), F.col("last.v").alias("close"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_dedupe.find_repeats(read_deliveries(spark, sf_dir, list(TOPICS)), bloom_dedupe.time_bucket()).select("topic", "delivery_id")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return csv_machine.rejects(csv_machine.parse(table(spark, sf_dir, "raw_rows"))).filter(F.col("reason") != "unknown_kind").select("raw_id", "reason")


def p5_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All good raw lines as typed rows, of all three kinds."""
    return csv_machine.all_rows(csv_machine.parse(table(spark, sf_dir, "raw_rows")))


def _cases_of_time(spark: SparkSession, sf_dir: str, name: str, columns: list[str], own) -> DataFrame:
    """Texts of a table that aren't what its own form writes for their instant."""
    each = table(spark, sf_dir, name).select("row_id", "feed", "received_at", F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("text")) for c in columns])).alias("x"))
    rows = time_em.normalise(each.select("row_id", "feed", "received_at", "x.field", "x.text"), "text", table(spark, sf_dir, "feeds"))
    return rows.filter(F.col("text_utc_ms").isNotNull() & (time_em.trimmed("text") != own(F.col("text_utc_ms")))).select(F.lit(name).alias("source_table"), "row_id", "field", F.col("text_utc_ms").alias("utc_ms"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    spot = _cases_of_time(spark, sf_dir, "spot_klines", ["open_time", "close_time"], lambda ms: ms.cast("string"))
    # an instant with a fraction of a second is written by no text of the form
    readings = _cases_of_time(spark, sf_dir, "futures_metrics", ["create_time"], lambda ms: F.when(ms % 1000 == 0, F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd HH:mm:ss")).otherwise(""))
    return spot.unionByName(readings)


QUERIES = {"p1_found": p1_found, "p1_grid": p1_grid, "p2_found": p2_found, "p2_kinds": p2_kinds, "p3_found": p3_found, "p3_trailing": p3_trailing, "p3_interest": p3_interest, "p4_found": p4_found, "p4_hourly": p4_hourly, "p4_bars": p4_bars, "p4_served": p4_served, "p4_views": p4_views, "p5_found": p5_found, "p5_loaded": p5_loaded, "p6_found": p6_found, "p7_found": p7_found}

_SYMBOL = "upper(replace(replace(replace(symbol, ' ', ''), chr(9), ''), chr(160), ''))"


def _ms(c: str) -> str:
    return f"(case when {c} < 100000000000 then {c} * 1000 when {c} >= 10000000000000 then {c} // 1000 else {c} end)"


_CLOSE = f"coalesce({_ms('effective_close_time')}, {_ms('open_time')} // 60000 * 60000 + 60000)"
_READING = f"coalesce({_ms('bucket_create_time')}, epoch_ms(try_strptime(create_time, '%Y-%m-%d %H:%M:%S')) // 300000 * 300000)"

_TRADES = f"""trades as (select {_SYMBOL} as symbol, agg_trade_id as message_key, max({_ms('transact_time')}) as t, min(epoch_us(received_at)) as r,
    arg_max({{'p': price, 'q': quantity}}, delivery_id) as kept from futures_aggtrades group by 1, 2)"""


def _days(name: str, time: str, measures: list[str]) -> str:
    """SQL for every day of a daily table with the sums over 7 and 30 days."""
    sums = ", ".join(f"sum(coalesce({m}, 0)) over (partition by symbol order by day rows between {w - 1} preceding and current row) as {m}_{w}" for m in measures for w in (7, 30))
    return f"""(select *, row_number() over (partition by symbol order by day) as nth, {sums} from (
        select g.symbol, g.day, {", ".join(f"l.{m}" for m in measures)} from (select symbol, unnest(generate_series(min({time}), max({time}), interval 1 day)) as day from {name} group by 1) g
        left join (select symbol, {time} as day, {", ".join(f"arg_max_null({m}, load_seq) as {m}" for m in measures)} from {name} group by 1, 2) l using (symbol, day)))"""


_BAR_DAYS = _days("futures_klines_1d", "cast(open_time as timestamp)", ["relative_range", "log_return_close"])
_INTEREST_DAYS = _days("futures_metrics_1d", "(cast(create_time as timestamp) - interval 1 day)", ["log_return_sum_open_interest_last"])

_CELL = '(?:"(?:[^"]|"")*"|[^",]*)'


def _wrong(kind: str, i: int) -> str:
    """SQL for a wrong value in the i-th field."""
    v, digits = f"v[{i}]", f"regexp_full_match(v[{i}], '[0-9]{{1,18}}')"
    n = f"try_cast({v} as bigint)"
    epoch = f"coalesce({digits} and {_ms(n)} between 1483228800000 and 2051222399999, false)"
    good = {
        "epoch": epoch,
        "time": f"({epoch} or (regexp_full_match({v}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}} [0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}') and coalesce(year(try_strptime({v}, '%Y-%m-%d %H:%M:%S')) between 2017 and 2034, false)))",
        "id": digits,
        "count": f"({v} = '' or {digits})",
        "bool": f"lower({v}) in ('true', 'false', 't', 'f', '1', '0')",
        "text": f"{v} != ''",
        "double": f"({v} = '' or (regexp_full_match({v}, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') and coalesce(isfinite(try_cast({v} as double)), false)))",
    }
    return f"not {good[kind]}"


def _lines_ctes() -> tuple[str, str, str]:
    """SQL that cuts lines into fields: the tables up to `f`, the right number of fields and whether a value is wrong."""
    columns, types = csv_machine.COLUMNS, csv_machine.TYPES
    case = lambda f: "case file_kind " + " ".join(f"when '{k}' then {f(c)}" for k, c in columns.items()) + " end"
    wrong = case(lambda c: "(" + " or ".join(_wrong(types.get(x, "double"), i + 1) for i, x in enumerate(c)) + ")")
    ctes = f"""with l as (select raw_id, file_kind, regexp_replace(line, '\\r$', '') as line from raw_rows where line is not null),
        r as (select *, regexp_full_match(line, '{_CELL}(?:,{_CELL})*') as whole from l where trim(line, chr(9) || ' ') != '' and line != {case(lambda c: "'" + ",".join(c) + "'")}),
        f as (select *, list_transform(regexp_extract_all(',' || line, ',({_CELL})', 1), lambda x: trim(case when starts_with(x, '"') then replace(x[2:-2], '""', '"') else x end, chr(9) || ' ')) as v from r)"""
    return ctes, case(lambda c: len(c)), wrong


def _lines_sql() -> str:
    ctes, width, wrong = _lines_ctes()
    return f"{ctes} select raw_id, case when not whole then 'broken_quoting' when len(v) != {width} then 'wrong_column_count' else 'invalid_value' end as reason from f where not whole or len(v) != {width} or {wrong}"


def _loaded_sql() -> str:
    ctes, width, wrong = _lines_ctes()
    columns, types = csv_machine.COLUMNS, csv_machine.TYPES

    def value(c: str) -> str:
        v = "case file_kind " + " ".join(f"when '{k}' then nullif(v[{names.index(c) + 1}], '')" for k, names in columns.items() if c in names) + " end"
        kind = types.get(c, "double")
        epoch = _ms(f"try_cast({v} as bigint)")
        sql = {"epoch": epoch, "time": f"coalesce(epoch_ms(try_strptime({v}, '%Y-%m-%d %H:%M:%S')), {epoch})", "id": f"try_cast({v} as bigint)", "count": f"try_cast({v} as bigint)", "bool": f"lower({v}) in ('true', 't', '1')", "text": v}
        return f"{sql.get(kind, f'try_cast({v} as double)')} as \"{c}\""

    names = list(dict.fromkeys(c for x in columns.values() for c in x))
    return f"{ctes}, g as (select * from f where whole and len(v) = {width}) select raw_id, file_kind, {', '.join(value(c) for c in names)} from g where not coalesce({wrong}, false)"


#: Forms of time texts that SQL tries, and those of numeric dates by the order of day and month.
_FORMS = ["%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y/%m/%d %H:%M:%S", "%Y-%m-%d %H:%M:%S.%f", "%Y-%m-%dT%H:%M:%S.%f", "%Y%m%dT%H%M%S", "%d.%m.%Y %H:%M:%S", "%d %b %Y %H:%M:%S", "%a, %d %b %Y %H:%M:%S"]
_ORDERED = {True: ["%d/%m/%Y %H:%M:%S", "%d/%m/%Y %H:%M"], False: ["%m/%d/%Y %H:%M:%S", "%m/%d/%Y %I:%M:%S %p", "%m/%d/%Y %H:%M"]}
#: Minutes east of UTC of zones that texts name.
_NAMED = {"Z": 0, "GMT": 0, "CET": 60, "CEST": 120, "EST": -300, "EDT": -240}


def _instants(name: str, columns: list[str], keep: str = "") -> str:
    """SQL tables up to `instants`: row_id, field, text, ms of each time text, read form by form with the zone it names or its feed's. keep: further columns."""
    each = " union all ".join(f"select row_id, feed, '{c}' as field, {c} as text, epoch_ms(received_at) as r{keep} from {name}" for c in columns)
    forms = lambda first: "[" + ", ".join(f"'{x}'" for x in [*_FORMS, *_ORDERED[first]]) + "]"
    east = " ".join(f"when '{k}' then {v}" for k, v in _NAMED.items())
    back = lambda c: f"timezone(time_zone, make_timestamptz({c} * 1000)) = clock"
    return f"""x as (select *, trim(text, ' ' || chr(9) || chr(10) || chr(13) || chr(160)) as t from ({each}) left join feeds using (feed)),
        z as (select *, regexp_full_match(t, '[0-9]{{9,}}([.][0-9]+)?|[0-9]([.][0-9]+)?E[+]?[0-9]+') as number, case when contains(t, ':') or contains(t, 'T') then regexp_extract(t, '(Z|[+-][0-9]{{2}}:?[0-9]{{2}}| [A-Z]{{3,4}})$', 1) else '' end as zone from x),
        p as (select *, trim(left(t, length(t) - length(zone))) as bare, try_cast(case when number then t end as decimal(38, 10)) as d from z),
        q as (select *, case when not number then case when day_first then try_strptime(bare, {forms(True)}) else try_strptime(bare, {forms(False)}) end end as clock, case trim(zone) {east} when '' then null
            else (case when starts_with(zone, '-') then -1 else 1 end) * (try_cast(zone[2:3] as int) * 60 + try_cast(zone[-2:] as int)) end as east from p),
        s as (select *, case when east is null and zone = '' and time_zone is not null then epoch_ms(timezone(time_zone, clock)) end as c from q),
        u as (select *, case when {back('c')} then c end as c0, case when {back('(c + 3600000)')} then c + 3600000 end as c1, case when {back('(c - 3600000)')} then c - 3600000 end as c2 from s),
        instants as (select *, case when number then cast(trunc(case when d < 100000000000 then d * 1000 when d >= 10000000000000 then d / 1000 else d end) as bigint) when east is not null then epoch_ms(clock) - east * 60000
            else coalesce(greatest(case when c0 <= r then c0 end, case when c1 <= r then c1 end, case when c2 <= r then c2 end), greatest(c0, c1, c2)) end as ms from u)"""


def _p6_sql() -> str:
    spot = f"select 'spot_klines' as source_table, row_id, field, ms as utc_ms from (with {_instants('spot_klines', ['open_time', 'close_time'])} select * from instants where ms is not null and not coalesce(regexp_full_match(t, '[0-9]+') and try_cast(t as bigint) = ms, false))"
    own = "coalesce(regexp_full_match(t, '[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}') and epoch_ms(try_strptime(t, '%Y-%m-%d %H:%M:%S')) = ms, false)"
    return f"{spot} union all select 'futures_metrics', row_id, field, ms from (with {_instants('futures_metrics', ['create_time'])} select * from instants where ms is not null and not {own})"


def _grid_sql() -> str:
    """SQL tables up to `whole`: each period of each symbol with its first and last usable reading of either field and the neighbours'."""
    ok = lambda f: f"case when {f} > 0 and isfinite({f}) then {{'t': ms, 'o': row_id, 'v': {f}}} end"
    ends = ", ".join(f"min({ok(f)}) as f{i}, max({ok(f)}) as l{i}" for i, f in enumerate(INTEREST))
    near = ", ".join(f"last_value(l{i} ignore nulls) over (w rows between unbounded preceding and 1 preceding) as b{i}, first_value(f{i} ignore nulls) over (w rows between 1 following and unbounded following) as a{i}" for i in range(2))
    return f"""with {_instants('futures_metrics', ['create_time'], ', symbol, ' + ', '.join(INTEREST))}, m as (select symbol, ms // 300000 as p, {ends} from instants where ms is not null and symbol is not null group by 1, 2),
        g as (select symbol, unnest(generate_series(min(p), max(p))) as p from m group by 1), whole as (select symbol, p, f0, l0, f1, l1, {near} from g left join m using (symbol, p) window w as (partition by symbol order by p))"""


def _grid_columns() -> str:
    out = []
    for i, f in enumerate(INTEREST):
        b, a, seen = f"b{i}", f"a{i}", f"l{i} is not null"
        near = f"({b} is not null and {a} is not null and {a}.t - {b}.t <= {GRID_GAP_MS})"
        out.append(f"case when {seen} then l{i}.v when {near} then {b}.v + ({a}.v - {b}.v) * ((p * 300000 - {b}.t) / ({a}.t - {b}.t)) when {b} is not null then {b}.v else {a}.v end as {f}")
        out.append(f"case when {seen} then 'observed' when {near} then 'interpolated' when {b} is not null then 'held' when {a} is not null then 'ahead' else 'none' end as {f}_state")
    return ", ".join(out)


ORACLES = {
    "p1_found": " union all ".join(f"select symbol, p * 300000 as bucket_create_time, '{f}' as field from ({_grid_sql()} select * from whole where l{i} is null)" for i, f in enumerate(INTEREST)),
    "p1_grid": f"{_grid_sql()} select symbol as source, p * 300000 as \"at\", {_grid_columns()} from whole",
    "p5_found": _lines_sql(),
    "p5_loaded": _loaded_sql(),
    "p6_found": _p6_sql(),
    "p3_found": f"""select symbol, strftime(day, '%Y-%m-%d') as day, 'relative_range' as measure from {_BAR_DAYS} where nth >= 30 and relative_range_7 / 7 - 1.8 * relative_range_30 / 30 > 1e-10
        union all select symbol, strftime(day, '%Y-%m-%d'), 'log_return_close' from {_BAR_DAYS} where nth >= 30 and log_return_close_7 < -0.1500005 and log_return_close_30 > -0.1500005
        union all select symbol, strftime(day, '%Y-%m-%d'), 'log_return_sum_open_interest_last' from {_INTEREST_DAYS} where nth >= 30 and log_return_sum_open_interest_last_7 > 0.1500005
            and log_return_sum_open_interest_last_7 - log_return_sum_open_interest_last_30 > 1e-10""",
    "p3_trailing": f"""select symbol, strftime(day, '%Y-%m-%d') as day, {", ".join(f"round({m}_{w}, 6) + 0 as {m}_total_{w}, round({m}_{w} / {w}, 7) + 0 as {m}_avg_{w}" for m in ("relative_range", "log_return_close") for w in (7, 30))} from {_BAR_DAYS}""",
    "p3_interest": f"""select symbol, strftime(day, '%Y-%m-%d') as day, {", ".join(f"round({m}_{w}, 6) + 0 as {m}_total_{w}, round({m}_{w} / {w}, 7) + 0 as {m}_avg_{w}" for m in ("log_return_sum_open_interest_last",) for w in (7, 30))} from {_INTEREST_DAYS}""",
    "p4_found": f"""with {_TRADES}, bars as (select {_SYMBOL} as symbol, {_CLOSE} as message_key, min(epoch_us(received_at)) as r from futures_klines group by 1, 2),
        late as (select 'futures_aggtrades' as topic, symbol, message_key, r, (t // 3600000 + 1) * 3600000 as e from trades where t is not null
            union all select 'futures_klines', symbol, message_key, r, ((message_key - 1) // 3600000 + 1) * 3600000 from bars where message_key is not null)
        select topic, symbol, message_key, case when r <= (e + 1800000) * 1000 then 'corrected' else 'dropped' end as outcome from late where r > (e + 60000) * 1000""",
    "p4_hourly": f"""with {_TRADES}, h as (select *, (t // 3600000 + 1) * 3600000 as e, kept.p as p, kept.q as q from trades where t is not null)
        select symbol, e as hour_end, count(*) as trades, cast(count_if(r > (e + 60000) * 1000) as bigint) as corrected, round(sum(q) + {TIE * 1e-6!r}, 6) as quantity, round(sum(p * q) + {TIE * 1e-3!r}, 3) as turnover, min(p) as low, max(p) as high,
            arg_min(p, (t, message_key)) as open, arg_max(p, (t, message_key)) as close from h where r <= (e + 1800000) * 1000 group by 1, 2""",
    "p4_bars": f"""with m as (select {_SYMBOL} as symbol, {_CLOSE} as t, min(epoch_us(received_at)) as r, arg_max({{'o': open, 'h': high, 'l': low, 'c': close, 'v': volume, 'q': quote_volume, 'n': "count"}}, delivery_id) as kept from futures_klines group by 1, 2),
        h as (select *, ((t - 1) // 3600000 + 1) * 3600000 as e from m where t is not null and symbol is not null)
        select symbol, e as hour_end, count(*) as bars, cast(count_if(r > (e + 60000) * 1000) as bigint) as corrected, round(sum(kept.v) + {TIE * 1e-6!r}, 6) as volume, round(sum(kept.q) + {TIE * 1e-3!r}, 3) as quote_volume, cast(sum(kept.n) as bigint) as "count",
            arg_min(kept.o, t) as open, max(kept.h) as high, min(kept.l) as low, arg_max(kept.c, t) as close from h where r <= (e + 1800000) * 1000 group by 1, 2""",
    "p4_views": f"""with d as (select {_SYMBOL} as symbol, agg_trade_id as k, {_ms('transact_time')} as t, epoch_us(received_at) as r, batch_id, delivery_id, {{'p': price, 'q': quantity}} as v from futures_aggtrades where symbol is not null and agg_trade_id is not null),
        c as (select (max(r) - 600000000) // 3600000000 * 3600000000 + 600000000 as now from d), seen as (select * from d, c where r <= now),
        m as (select symbol, k, max(t) as t, min(r) as r, arg_max(v, delivery_id) as v, any_value(now) as now from seen group by 1, 2), h as (select *, (t // 3600000 + 1) * 3600000 as e from m where t is not null),
        done as (select symbol, e as hour_end, case when (e + 1800000) * 1000 < now then 'frozen' else 'open' end as state, count(*) as trades, cast(count_if(r > (e + 60000) * 1000) as bigint) as corrected, round(sum(v.q) + {TIE * 1e-6!r}, 6) as quantity,
            min(v.p) as low, max(v.p) as high, arg_min(v.p, (t, k)) as open, arg_max(v.p, (t, k)) as close from h where r <= (e + 1800000) * 1000 and e * 1000 <= now group by 1, 2, 3),
        b as (select symbol, k, batch_id, max(t) as t, min(r) as r, arg_max(v, delivery_id) as v from seen group by 1, 2, 3), i as (select *, (t // 3600000 + 1) * 3600000 as hour_end from b where t is not null),
        new as (select symbol, hour_end, 'provisional' as state, count(*) as trades, cast(0 as bigint) as corrected, round(sum(v.q) + {TIE * 1e-6!r}, 6) as quantity, min(v.p) as low, max(v.p) as high, arg_min(v.p, (t, k)) as open, arg_max(v.p, (t, k)) as close
            from i where r <= (hour_end + 60000) * 1000 group by 1, 2)
        select * from done union all select * from new anti join done using (symbol, hour_end)""",
    "p7_found": f"""with d as (select 'futures_aggtrades' as topic, delivery_id, {_SYMBOL} as s, agg_trade_id as k from futures_aggtrades
            union all select 'futures_klines', delivery_id, {_SYMBOL}, {_CLOSE} from futures_klines union all select 'metrics_messages', delivery_id, {_SYMBOL}, {_READING} from metrics_messages)
        select topic, delivery_id from (select *, max(delivery_id) over (partition by topic, s, k) as last from d where s is not null and k is not null) where delivery_id < last""",
}
