"""Micro-cases of the market and text operators, sources, sinks and streams."""

import io
import zipfile
from datetime import date

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidelattice.functions import normalize as nz
from tidelattice.functions.safe import eps_div, log_return, nearest_rank, safe_div
from tidelattice.operators import bars, csv_machine, ema, features, gaps, social, trade_stats
from tidelattice.sinks import lake as sink
from tidelattice.sources import archives, lake, paged
from tidelattice.streaming import pipelines

HOUR = 3_600_000


def one(spark, *columns):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()


@pytest.mark.parametrize("family,n", [("futures_klines", 200), ("futures_metrics", 163), ("futures_premiumindexklines", 26), ("spot_klines", 140), ("sentiment", 116), ("futures_aggtrades", 282)])
def test_columns_of_families(family, n):
    c = features.FAMILIES[family].columns
    assert len(c) == len(set(c)) == n and len(sink.serving_schema(family)) == n


def test_periods(spark):
    df = spark.createDataFrame([(0,), (1,), (HOUR,), (HOUR + 1,)], "t long")
    got = df.orderBy("t").select(*[bars.bucket("t", HOUR, c).alias(c) for c in ("open", "end", "end_closed")]).collect()
    assert [r.open // HOUR for r in got] == [0, 0, 1, 1] and [r.end // HOUR for r in got] == [1, 1, 2, 2] and [r.end_closed // HOUR for r in got] == [0, 1, 1, 2]


def test_arithmetic(spark):
    x = lambda v: F.lit(v).cast("double")
    r = one(spark, safe_div(x(1.0), x(0.0)), safe_div(x(1.0), x(None)), safe_div(x(None), x(2.0)), eps_div(x(None), x(1.0)), log_return(x(2.0), x(0.0)), nearest_rank(F.array(*map(F.lit, (1.0, 2.0, 3.0, 10.0))), 0.25), nearest_rank(F.array(*map(F.lit, (1.0, 2.0, 3.0, 10.0))), 0.5), nearest_rank(F.array().cast("array<double>"), 0.5))
    assert list(r) == [0.0, 0.0, None, None, None, 2.0, 3.0, None]


def test_cleansing(spark):
    r = one(spark, *[nz.epoch_ms(F.lit(v)) for v in (1_700_000_000, 1_700_000_000_000, 1_700_000_000_000_000, -7_000_000_000_000_001)], nz.parse_bool(F.lit(" True")), nz.parse_bool(F.lit("0")), nz.parse_bool(F.lit("x")), nz.blank_to_double(F.lit("  ")), nz.blank_to_double(F.lit("abc")), nz.blank_to_double(F.lit("1.5")), nz.text_to_ms(F.lit("2024-02-30 00:00:00")), nz.text_to_ms(F.lit("2024-02-29T00:00:01")))
    assert list(r) == [1_700_000_000_000] * 3 + [-7_000_000_000_001] + [True, False, None, None, None, 1.5, None, 1709164801000]
    heads = spark.createDataFrame([("a", "b"), ("a", None), ("1", "2")], "a string, b string")
    assert nz.drop_header_rows(heads).count() == 2
    lost = spark.createDataFrame([("3", "4")], "`1` string, `1_duplicated_0` string")
    assert sorted(map(tuple, nz.recover_headerless(lost, ["a", "b"]).collect())) == [("1", "1"), ("3", "4")]
    with pytest.raises(ValueError):
        nz.recover_headerless(lost, ["a", "b", "c"])


def test_zeros_are_filled(spark):
    df = spark.createDataFrame([("A", i, v) for i, v in enumerate((0.0, 5.0, 0.0, 7.0, None))], "s string, t int, v double")
    assert [r.v for r in nz.fill_zero_gaps(df, ["v"], ["s"], ["t"]).orderBy("t").collect()] == [5, 5, 5, 7, 7]


def closes(spark, values):
    return spark.createDataFrame([("A", i, float(v), float(v), float(v), float(v)) for i, v in enumerate(values)], "symbol string, t int, open double, high double, low double, close double")


def test_rolling_and_ema(spark):
    w = Window.partitionBy("symbol").orderBy("t")
    mean, std = features.rolling("close", 3, w)
    got = closes(spark, [1, 2, 4, 3, 7]).select("t", mean.alias("m"), std.alias("s")).orderBy("t").collect()
    assert [r.m and round(r.m, 4) for r in got] == [None, None, 2.3333, 3, 4.6667] and [r.s and round(r.s, 4) for r in got] == [None, None, 1.5275, 1, 2.0817]
    frame = closes(spark, [1, 2, 4, 3, 7]).withColumn("l", F.collect_list("close").over(w.rowsBetween(-60, 0))).orderBy("t")
    assert [round(r.e, 6) for r in frame.select(ema.fold_ema(F.col("l"), 12).alias("e")).collect()] == [1, 1.153846, 1.591716, 1.808375, 2.607087]
    x = features.indicators(closes(spark, range(1, 16)), ["symbol"], "t").orderBy("t").collect()
    assert [r.rsi14 for r in x] == [None] * 13 + [100, 100]
    assert [r.rsi14 for r in features.indicators(closes(spark, [5] * 15), ["symbol"], "t").orderBy("t").collect()] == [None] * 13 + [50, 50]


def test_trade_figures(spark):
    rows = [("A", i, t, p, q, m) for i, (t, p, q, m) in enumerate([(0, 10.0, 1.0, False), (10, 20.0, 3.0, True), (40, 20.0, 1.0, None)])]
    r = trade_stats.trade_features(spark.createDataFrame(rows, "symbol string, agg_trade_id int, t long, price double, quantity double, is_buyer_maker boolean"), HOUR).first()
    assert (r.trade_rate_mean, round(r.trade_rate_std, 4), r.tickup_count, r.buy_count, r.trade_vwap, r.buy_vwap, r.buy_rate_mean, r.buy_corr_price_quantity) == (20, 14.1421, 1, 1, 18, 10, 0, 0)
    assert r.create_time == HOUR


def test_trade_figures_of_hot_periods(spark, sf_dir):
    """Quantiles by counting, and times across slices, are those of a period taken as a whole."""
    trades = bars.trades(spark.read.parquet(f"{sf_dir}/futures_aggtrades.parquet"))
    plain, counted = ({(r.symbol, r.create_time): r.asDict() for r in trade_stats.trade_features(trades, 24 * HOUR, hot).collect()} for hot in (10**9, 1))
    assert plain.keys() == counted.keys() and all(plain[k] == pytest.approx(counted[k], nan_ok=True) for k in plain)


def test_hot_day(spark):
    """One symbol and day with two million trades, a third of them at one instant and price."""
    n = 2_000_000
    i = F.col("id")
    same = i % 3 == 0
    price = F.when(same, 5.0).otherwise(F.pmod(i * 7919, F.lit(n)).cast("double") + 10)
    rows = spark.range(n, numPartitions=8).select(F.lit("A").alias("symbol"), F.when(same, 3600_000).otherwise(F.floor(i * 43)).alias("t"), i.alias("agg_trade_id"), price.alias("price"), F.lit(1.0).alias("quantity"), (i % 2 == 0).alias("is_buyer_maker"))
    r = trade_stats.trade_features(rows, 24 * HOUR).collect()
    others = sorted((k * 7919 % n) + 10.0 for k in range(n) if k % 3)
    ranked = [5.0] * (n - len(others)) + others
    assert len(r) == 1 and r[0].trade_count == n and r[0].buy_count == n // 2
    assert [r[0][f"trade_price_{p}"] for p in ("p25", "p50", "p75")] == [ranked[round((n - 1) * q)] for q in (0.25, 0.5, 0.75)] and r[0].trade_quantity_p50 == 1.0
    assert r[0].trade_rate_mean == pytest.approx((n - 1) // 3 * 3 * 43 / (n - 1), rel=1e-4)


def test_strict_history_and_merge(spark):
    df = spark.createDataFrame([("A", i * HOUR) for i in range(70) if i != 65], "s string, t long")
    assert {r.t // HOUR for r in features.strict_history(df, ["s"], "t", HOUR).collect()} == {60, 61, 62, 63, 64}
    old, new = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert {tuple(r) for r in features.combine_history(old, new, ["k"]).collect()} == {(1, "a"), (2, "c"), (3, "d")}


def test_gaps(spark):
    spans = spark.createDataFrame([("A", 1, 3 * HOUR + 5)], "s string, first long, last long")
    assert [r.boundary // HOUR for r in gaps.expected(spans, HOUR, "end").orderBy("boundary").collect()] == [1, 2, 3]
    assert [r.boundary // HOUR for r in gaps.expected(spans, HOUR, "open").orderBy("boundary").collect()] == [0, 1, 2]
    gone = spark.createDataFrame([("A", 5 * HOUR)], "s string, boundary long")
    want = spark.createDataFrame([("A", i * HOUR) for i in (0, 4, 8, 24)], "s string, boundary long")
    step = lambda n, c: [r.boundary // HOUR for r in gaps.propagate(gone, HOUR, n * HOUR, c, want, ["s"]).collect()]
    assert (step(4, "open"), step(24, "open"), step(4, "end"), step(24, "end")) == ([4], [0], [8], [24])
    rows = spark.createDataFrame([("A", t) for t in (0, 60_000, 200_000, nz.DAY_MS + 5)], "s string, t long")
    assert {(r.start, r.end) for r in gaps.internal_gaps(rows, ["s"], 61_000).collect()} == {(60_001, 199_999), (200_001, nz.DAY_MS + 4)}


def test_texts(spark):
    t = "It's GREAT!! see https://a.b/c $BTC+1 don't x200b 42 ai ok 'quoted'"
    assert spark.range(1).select(social.tokens(F.lit(t)).alias("w")).first().w == ["it's", "great", "btc", "ai", "quoted"]
    probs = lambda *p: F.array(*map(F.lit, p))
    assert spark.range(1).select(social.ensemble(probs(0.2, 0.5, 0.3), probs(0.1, 0.2, 0.7)).alias("c")).first().c == 2
    hour = lambda h: F.array(F.lit(0).cast("long")), lambda h: F.lit(int(h * 3600))
    assert [spark.range(1).select(social.activity(hour[0](h), hour[1](h)).alias("a")).first().a for h in (7.9, 8.0)] == [True, False]
    moods = spark.createDataFrame([(5, s) for s in (2, 2, 1, 0)], "t long, sentiment int")
    r = social.mood_features(moods, HOUR).first()
    assert (r["count"], r.score, r.confidence, r.pct_negative, r.pct_positive, r.pct_neutral) == (4, 0.25, 0.75, 0.25, 0.5, 0.25)
    clean = spark.createDataFrame([("See&amp;  https://x.y/z by u/Bob in r/btc sooooo good \U0001f680 **yes**",), (None,)], "t string").select(social.clean_text("t").alias("c")).collect()
    assert [r.c for r in clean] == ["See& [URL] by [USER] in [SUBREDDIT] soo good \U0001f680 yes", ""]
    cases = [
        ("![a](b.c) and [x](https://q.r/s)", {}, "[MEDIA] and [x]([URL])"),
        ("go r/btc/wiki/x or u/a-b/c", {}, "go [REDDIT PATH] or [REDDIT PATH]"),
        ("a\u2014b 2\u20133 x - y -5 - 5 end-", {}, "a-b 2-3 x y -5 - 5 end"),
        ("( ) { } [ ] ( a )", {}, "(a)"),
        ("Ｗide &lt;b&gt; \u200bnow", {"lower": True}, "wide <b now"),
        ("see https://x.y by u/Bob \U0001f680!", {"marks": False, "emoji": "drop"}, "see by !"),
        ("up \U0001f680", {"emoji": "name"}, "up [rocket]"),
        ("[removed]", {"blocked": social.BLOCKED_BODIES}, ""),
        ("[deleted by user]", {"blocked": social.BLOCKED_TITLES}, ""),
        ("   ", {}, ""),
    ]
    for text, how, want in cases:
        assert spark.range(1).select(social.clean_text(F.lit(text), **how).alias("c")).first().c == want, text
    lang = spark.createDataFrame([("12 !!",), ("hello",), ("привет",), (None,)], "t string").select(social.language_rule("t").alias("l")).collect()
    assert [r.l for r in lang] == ["empty", "en", "non-en", "empty"]


def test_watchlist(spark):
    now = 100 * 86_400
    subs = spark.createDataFrame([("a", now - 3600), ("b", now - 40 * 86_400), ("c", now - 5 * 86_400)], "id string, created_utc long")
    com = spark.createDataFrame([("x", "a", now - 60), ("y", "a", now - 120), ("z", "b", now - 60)], "id string, submission_id string, created_utc long")
    got = {r.id: r for r in social.watchlist(subs, com, now).collect()}
    assert set(got) == {"a", "c"} and got["a"].comment_ids == ["y", "x"] and got["a"].active and not got["c"].active


def test_archives(spark, tmp_path):
    import zstandard

    with zipfile.ZipFile(tmp_path / "x.zip", "w") as z:
        z.writestr("a.csv", "a,b\n1,2\n3,4\n")
    assert sorted(map(tuple, archives.zipped_csv(spark, [str(tmp_path / "x.zip")], ["a", "b"]).collect())) == [("1", "2"), ("3", "4")]
    with zipfile.ZipFile(tmp_path / "bad.zip", "w") as z:
        z.writestr("a.csv", "1,2\n3\n")
    with pytest.raises(Exception, match="line 2: 1 columns instead of 2"):
        archives.zipped_csv(spark, [str(tmp_path / "bad.zip")], ["a", "b"]).collect()
    raw = b'{"id": "1", "subreddit": "Btc", "n": 5}\nnot json\n{"id": "2", "subreddit": "other"}\n[1]\n'
    (tmp_path / "d.zst").write_bytes(zstandard.ZstdCompressor().compress(raw))
    got = archives.zstd_json_lines(spark, [str(tmp_path / "d.zst")], ["id", "n"], ["btc"]).orderBy("line_no").collect()
    assert [(r.id, r.n, r.bad) for r in got] == [("1", "5", False), (None, None, True), (None, None, True)]
    assert io.BytesIO(raw)


def test_bulk_load(spark, tmp_path):
    """Dumps of three days, one there already: typed rows by period, bad lines apart with the reason, headerless and quoted files alike."""
    head = ",".join(csv_machine.COLUMNS["futures_aggtrades"])
    content = {"2024-05-01": f"{head}\n1,2.5,,3,4,1714564800000,true\r\n2,x,1,3,4,1714564800000,true\r\n", "2024-05-02": '7,"1.5",2,3,4,1714651200,f\n8,1\n', "2024-05-03": "9,1,1,1,1,1714737600000,T"}
    files = {}
    for p in archives.periods(date(2024, 5, 1), date(2024, 5, 3)):
        files[p] = str(tmp_path / f"{p}.zip")
        with zipfile.ZipFile(files[p], "w") as z:
            z.writestr("a.csv", content[p])
    out, bad = f"{tmp_path}/lake", f"{tmp_path}/bad"
    assert archives.bulk_load(spark, {"2024-05-03": files["2024-05-03"]}, "futures_aggtrades", out, bad) == ["2024-05-03"]
    assert archives.bulk_load(spark, files, "futures_aggtrades", out, bad) == ["2024-05-01", "2024-05-02"]
    assert archives.bulk_load(spark, files, "futures_aggtrades", out, bad) == []
    assert {(r.agg_trade_id, r.price, r.quantity, r.transact_time, r.is_buyer_maker, str(r.period)) for r in spark.read.parquet(out).collect()} == {(1, 2.5, None, 1714564800000, True, "2024-05-01"), (7, 1.5, 2.0, 1714651200000, False, "2024-05-02"), (9, 1.0, 1.0, 1714737600000, True, "2024-05-03")}
    assert {(r.reason, r.line_no, str(r.period)) for r in spark.read.parquet(bad).collect()} == {("invalid_value", 3, "2024-05-01"), ("wrong_column_count", 2, "2024-05-02")}
    assert archives.periods(date(2023, 11, 30), date(2024, 1, 2), True) == ["2023-11", "2023-12", "2024-01"]


def test_comment_tree(spark):
    import json

    leaf = lambda i, **more: {"kind": "t1", "data": {"id": i, "author": "a", "link_id": "t3_x", "body": i, "created_utc": 5.0, "replies": "", **more}}
    listing = lambda *c: {"data": {"children": list(c)}}
    tree = listing(leaf("a", replies=listing(leaf("b", replies=listing({"kind": "more", "data": {"id": "_", "children": ["x", "y"]}})))), leaf("c"))
    got = archives.tree_comments(spark.createDataFrame([(json.dumps(tree),)], "j string"), "j").collect()
    assert {(r.kind, r.id, r.level) for r in got} == {("t1", "a", 0), ("t1", "c", 0), ("t1", "b", 1), ("more", "x", 2), ("more", "y", 2)}


def test_tables_of_all_intervals(spark, tmp_path):
    paths = sink.ensure_all(spark, str(tmp_path / "t"))
    assert len(paths) == 18 + 6 + 5 + 3 and spark.read.parquet(f"{tmp_path}/t/dashboard/sentiment_4h").columns[:2] == ["create_time", "word_frequency"]


def test_pages():
    data, calls = [(t, t) for t in range(0, 1000, 7)], []

    def fetch(start, end, limit):
        calls.append(start)
        if len(calls) == 2:
            raise OSError("busy")
        return [r for r in data if start <= r[0] < end][:limit]

    assert list(paged.pages(fetch, 0, 1000, 10, lambda r: r[0], wait_s=0.0)) == data
    # rows of one millisecond over a page's end, and more of them than a page holds
    data = [(5, i) for i in range(3)] + [(6, i) for i in range(9)] + [(7, 0)]
    missed = []
    plain = lambda start, end, limit: [r for r in data if start <= r[0] < end][:limit]
    assert list(paged.pages(plain, 0, 10, 4, lambda r: r[0], 0.0, missed)) == data[:7] + data[-1:] and missed == [(6, 7)]

    def never(start, end, limit):
        if start < paged.SKIP_MS:
            raise paged.RateLimited(0.0)
        return [(start, 1)]

    missed = []
    assert list(paged.pages(never, 0, 2 * paged.SKIP_MS, 4, lambda r: r[0], 0.0, missed)) == [(paged.SKIP_MS, 1)] and missed == [(0, paged.SKIP_MS)]


def test_buckets_of_all_endpoints():
    asked = []
    late = lambda b: asked.append(b) or ({"v": 2} if len(asked) > 2 else None)
    assert paged.complete({"a": lambda b: {"v": 1}, "b": late}, 5, wait_s=0.0) == {"a": {"v": 1}, "b": {"v": 2}} and asked == [5, 5, 5]
    assert paged.complete({"a": lambda b: {"v": 1}, "b": lambda b: None}, 5, 2, 0.0) is None


def test_paged_source(spark, tmp_path, monkeypatch):
    (tmp_path / "fetches_of_test.py").write_text("def get(start, end, limit):\n    if start == 0:\n        raise OSError('gone')\n    return [(start, float(start))]\n")
    spark.sparkContext.addPyFile(str(tmp_path / "fetches_of_test.py"))
    monkeypatch.syspath_prepend(str(tmp_path))
    rows = paged.read_paged(spark, "fetches_of_test:get", "t long, v double", 0, 180_000, stretch=60_000, wait_s=0.0).collect()
    assert {(r.t, r.v, r.missed_until) for r in rows} == {(0, None, 60_000), (60_000, 60_000.0, None), (120_000, 120_000.0, None)}


def test_lake(spark, tmp_path):
    path = str(tmp_path / "lake")
    batch = lambda rows: spark.createDataFrame(rows, "k int, t long, seq int, v string").withColumn("period", sink.period_of("t"))
    assert sink.merge_periods(batch([(1, 5, 1, "a"), (2, nz.DAY_MS, 1, "b")]), path, ["k"], "seq", "t") == 2
    again = batch([(1, 5, 2, "c"), (3, 6, 1, "d")])
    assert sink.merge_periods(again, path, ["k"], "seq", "t") == 1 and sink.merge_periods(again, path, ["k"], "seq", "t") == 0
    spark.catalog.clearCache()
    assert {(r.k, r.v) for r in spark.read.parquet(path).collect()} == {(1, "c"), (2, "b"), (3, "d")}
    assert lake.scan_last(spark, path, 1).count() == 1 and lake.scan_window(spark, path, date(1970, 1, 1)).count() == 2
    assert lake.period_window(date(2024, 3, 1)) == ["2024-02-29", "2024-03-01"] and lake.period_window(date(2024, 1, 9), True) == ["2023-12", "2024-01"]
    assert lake.read_or_none(spark, str(tmp_path / "none")) is None and len(lake.list_objects(spark, path)) >= 2


def test_upsert(spark, tmp_path):
    path = str(tmp_path / "table")
    with pytest.raises(ValueError):
        sink.upsert(spark.createDataFrame([(1, "a")], "k int, v string"), path, ["k"])
    sink.write_parquet(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), path)
    for _ in range(2):
        sink.upsert(spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string"), path, ["k"])
        assert {tuple(r) for r in spark.read.parquet(path).collect()} == {(1, "a"), (2, "c"), (3, "d")}
    sink.ensure(spark, path, spark.createDataFrame([], "k int, v string, w double").schema)
    assert spark.read.parquet(path).columns == ["k", "v", "w"]


def test_upsert_of_repeated_keys(spark, tmp_path):
    """The last of a key's rows counts, rows without a key are left out; without partitions the table is swapped in and nothing else is left."""
    path = f"{tmp_path}/tables/t"
    spark.createDataFrame([("a", 1, 1.0, 0), ("b", 1, 2.0, 0)], "k string, t long, v double, n long").write.parquet(path)
    batch = spark.createDataFrame([("a", 1, 5.0, 2), ("a", 1, 9.0, 1), ("a", 1, 5.0, 2), ("c", 2, None, 1), (None, 1, 7.0, 1)], "k string, t long, v double, n long")
    for _ in range(2):
        sink.upsert(batch, path, ["k", "t"], order="n")
        assert {(r.k, r.t): r.v for r in spark.read.parquet(path).collect()} == {("a", 1): 5.0, ("b", 1): 2.0, ("c", 2): None} and spark.read.parquet(path).count() == 3
    assert [p.name for p in (tmp_path / "tables").iterdir()] == ["t"]


def test_newest_partitions(spark, tmp_path):
    path = f"{tmp_path}/lake"
    spark.createDataFrame([(i, f"2024-05-0{i}") for i in range(1, 5)], "v long, period string").write.partitionBy("period").parquet(path)
    assert lake.partitions(spark, path) == [f"2024-05-0{i}" for i in range(1, 5)] and lake.partitions(spark, f"{tmp_path}/none") == []
    assert {r.v for r in lake.scan_last(spark, path, 2).collect()} == {3, 4}


def test_stream_features_equal_batch(spark, tmp_path):
    """Micro-batches through the feature sink give the batch's rows."""
    base = features.FAMILIES["futures_premiumindexklines"].base
    df = spark.range(90).select(F.lit("A").alias("symbol"), (F.col("id") * HOUR).alias("open_time"), (F.col("id") * HOUR + HOUR - 1).alias("close_time"), *[(100 + F.sin(F.col("id") * k) * 3).alias(c) for k, c in enumerate(base[1:], 1)])
    whole = features.features("futures_premiumindexklines", df, ["symbol"])
    path = str(tmp_path / "table")
    spark.createDataFrame([], whole.schema).write.parquet(path)
    run = pipelines.with_features("futures_premiumindexklines", path, ["symbol"], HOUR, strict=False)
    for a, b in ((0, 50), (50, 51), (51, 90)):
        run(df.filter((F.col("open_time") >= a * HOUR) & (F.col("open_time") < b * HOUR)), a)
    got = {r.open_time: r.asDict() for r in spark.read.parquet(path).collect()}
    for r in whole.collect():
        assert all(v == got[r.open_time][k] or abs(v - got[r.open_time][k]) < 1e-9 for k, v in r.asDict().items()), r.open_time
    assert len(got) == 90


@pytest.mark.parametrize("monthly", [False, True])
def test_stream_features_by_period(spark, tmp_path, monthly):
    """In a table of periods only the batch's periods are rewritten; with strict history only rows with all boundaries before them get features."""
    name = "futures_premiumindexklines"
    base = features.FAMILIES[name].base
    df = spark.range(200).select(F.lit("A").alias("symbol"), (F.col("id") * HOUR).alias("open_time"), (F.col("id") * HOUR + HOUR - 1).alias("close_time"), *[(100 + F.sin(F.col("id") * k) * 3).alias(c) for k, c in enumerate(base[1:], 1)])
    path = str(tmp_path / "table")
    whole = features.features(name, df, ["symbol"])
    first = whole.filter(F.col("open_time") < 100 * HOUR)
    sink.with_period(first.withColumn("at_", F.timestamp_millis("open_time")), "at_", monthly).drop("at_").write.partitionBy("period").parquet(path)
    files = lambda: {str(p) for p in (tmp_path / "table").rglob("*.parquet")}
    before = files()
    run = pipelines.with_features(name, path, ["symbol"], HOUR)
    for _ in range(2):
        run(df.filter((F.col("open_time") >= 100 * HOUR) & (F.col("open_time") < 130 * HOUR)), 0)
    got = {r.open_time: r.asDict() for r in spark.read.parquet(path).collect()}
    want = {r.open_time: r.asDict() for r in whole.filter(F.col("open_time") < 130 * HOUR).collect()}
    assert got.keys() == want.keys() and all(abs(v - got[t][k]) < 1e-9 for t, r in want.items() for k, v in r.items() if isinstance(v, float))
    assert len(before) == (1 if monthly else 5) and len(before & files()) == (0 if monthly else 4)


def test_boundaries():
    assert pipelines.next_boundary(HOUR, HOUR) == 2 * HOUR
    assert pipelines.active_steps(4 * HOUR, {"1h": HOUR, "4h": 4 * HOUR, "1d": nz.DAY_MS}) == ["1h", "4h"]


def test_each_interval(spark):
    calls = []
    df = spark.createDataFrame([(k * HOUR, k) for k in (1, 2, 4, 24)], "create_time long, v long")
    pipelines.each_interval({"1d": 24 * HOUR, "1h": HOUR, "4h": 4 * HOUR}, lambda name, rows, n: calls.append((name, sorted(r.v for r in rows.collect()), n)))(df, 7)
    assert calls == [("1h", [1, 2, 4, 24], 7), ("4h", [4, 24], 7), ("1d", [24], 7)]
    assert pipelines.warm_up("t", {1: 50, 0: 500}, 100) == '{"t": {"0": 400, "1": 0}}'


def test_coercion(spark):
    lit = lambda v: F.lit(v)
    r = one(spark, *[nz.coerced(lit(v), k) for v, k in ((" None", "string"), ("NULL", "int"), ("nan", "double"), (float("nan"), "double"), ("5.0", "bigint"), (" 7 ", "int"), ("yes", "boolean"), ("T", "boolean"), ("x", "double"), (" a ", "string"))])
    assert list(r) == [None, None, None, None, 5, 7, None, True, None, " a "]


def test_gated(spark):
    rows = spark.createDataFrame([(HOUR,), (2 * HOUR,)], "create_time long")
    pings = spark.createDataFrame([(True, 3600)], "first_run boolean, timestamp_utc long")
    assert [r.create_time for r in pipelines.gated(rows, pings).collect()] == [HOUR]


def test_backfill(spark, tmp_path):
    """After a gap is filled, the table is what one run over everything gives."""
    from tidelattice.plans import backfill

    base = features.FAMILIES["futures_premiumindexklines"].base
    df = spark.range(100).select(F.lit("A").alias("symbol"), (F.col("id") * HOUR).alias("open_time"), (F.col("id") * HOUR + HOUR - 1).alias("close_time"), *[(100 + F.sin(F.col("id") * k) * 3).alias(c) for k, c in enumerate(base[1:], 1)])
    whole = features.features("futures_premiumindexklines", df, ["symbol"])
    path = str(tmp_path / "table")
    features.features("futures_premiumindexklines", df.filter("open_time not between 20 * 3600000 and 22 * 3600000"), ["symbol"]).write.parquet(path)
    assert backfill.fill("futures_premiumindexklines", lambda: df, path, ["symbol"], HOUR, "open") == 63
    got = {r.open_time: r.asDict() for r in spark.read.parquet(path).collect()}
    assert len(got) == 100
    for r in whole.collect():
        assert all(v == got[r.open_time][k] or abs(v - got[r.open_time][k]) < 1e-9 for k, v in r.asDict().items()), r.open_time
    assert backfill.fill("futures_premiumindexklines", lambda: df, path, ["symbol"], HOUR, "open") == 0


def test_prompt(spark):
    r = one(spark, social.relevance_prompt(F.lit("btc"), F.lit(None).cast("string"), F.lit(" Hi "), F.lit("")), social.relevance(F.lit("en"), F.lit(0.7)), social.relevance(F.lit("non-en"), F.lit(0.7)))
    assert list(r) == ["Subreddit: btc\nTitle: Hi", 1, None]


def test_sql(spark):
    from tidelattice.sources import sql

    spark.range(3).createOrReplaceTempView("three_rows")
    assert sql.query(spark, "select * from three_rows where id >= :low", low=1).count() == 2
    assert sql.has_table(spark, "three_rows") and sql.columns(spark, "three_rows") == {"id": "bigint"}
