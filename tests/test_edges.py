"""Nulls, empty tables, ties, repeated rows, clashing names and boundaries of every dealt operator of the core."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidelattice.operators import bloom_dedupe, chunks, csv_machine, lambda_views, regular_grid, spikes, time_em, trailing
from tidelattice.operators.topics import deliveries

FEEDS = "feed string, time_zone string, day_first boolean"


@pytest.fixture(scope="module")
def feeds(spark):
    return spark.createDataFrame([("eu", "Europe/Berlin", True), ("us", "America/New_York", False), ("eu", "Europe/Berlin", True)], FEEDS)


def at(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# -- times --


def times(spark, feeds, rows):
    df = at(spark, rows, "id int, feed string, received_at string, text string, time_zone string, __ignored string").withColumn("received_at", F.to_timestamp("received_at"))
    return {r.id: (r.text_utc_ms, r.text_state) for r in time_em.normalise(df, "text", feeds).collect()}


def test_times(spark, feeds):
    rows = [
        (1, "eu", "2025-10-26 00:40:00", "26.10.2025 02:30:00", "x", None),  # the first half past two
        (2, "eu", "2025-10-26 01:40:00", "26.10.2025 02:30:00", None, None),  # the second
        (3, "eu", "2025-03-30 01:40:00", "30.03.2025 02:30:00", None, None),  # skipped
        (4, "us", "2025-05-04 14:00:00", "05/04/2025 09:59:00 AM", None, None),
        (5, "eu", "2025-05-04 08:00:00", "04/05/2025 09:59", None, None),
        (6, "zz", "2025-05-04 08:00:00", "2025-05-04 07:59:00", None, None),  # no zone known
        (7, "zz", "2025-05-04 08:00:00", "2025-05-04T07:59:00+02:00", None, None),
        (8, "us", None, "1746345540", None, None),
        (9, None, "2025-05-04 08:00:00", "1746345540000999", None, None),
        (10, "us", "2025-05-04 08:00:00", None, None, None),
        (11, "us", "2025-05-04 08:00:00", "", None, None),
        (12, "us", "2025-05-04 08:00:00", "x" * 100_000, None, None),
        (13, "us", "2025-05-04 08:00:00", " 1.74634554E9\t", None, None),
        (14, "us", "2025-05-04 08:00:00", "02/30/2025 01:00:00", None, None),
    ]
    got = times(spark, feeds, rows)
    assert got[1][0] == 1761438600000 and got[2][0] == 1761438600000 + 3_600_000
    assert got[3] == (None, "unreadable")
    assert got[4][0] == 1746367140000 and got[5][0] == 1746345540000
    assert got[6] == (None, "unreadable") and got[7][0] == 1746338340000
    assert got[8][0] == got[13][0] == 1746345540000 and got[9][0] == 1746345540000
    assert got[10] == (None, "missing") and all(got[i] == (None, "unreadable") for i in (11, 12, 14))


def test_ambiguous_order_is_learned(spark, feeds):
    """A source of unknown habit whose dates were nearly all day first reads an undatable one so; without evidence it stays ambiguous."""
    known = feeds.select("feed", "time_zone", F.lit(None).cast("boolean").alias("day_first"))
    rows = [(i, "eu", None, f"{13 + i % 15}/04/2025 10:00:00", None, None) for i in range(60)] + [(99, "eu", None, "05/04/2025 10:00:00", None, None), (100, "us", None, "05/04/2025 10:00:00", None, None)]
    got = times(spark, known, rows)
    assert got[99] == (1743840000000, "read") and got[100] == (None, "ambiguous")


def test_abbreviation_of_two_zones(spark, feeds):
    """The arrival tells which zone a source means; a row that says nothing takes the source's, and without any evidence it stays ambiguous."""
    here, there = 1714564800000 - 330 * 60_000, 1714564800000 - 120 * 60_000
    rows = [(i, "eu", "2024-05-01 10:05:00", "2024-05-01 12:00:00 IST", None, None) for i in range(40)] + [(98, "eu", None, "2024-05-01 12:00:00 IST", None, None)]
    rows += [(60 + i, "us", "2024-05-01 06:35:00", "2024-05-01 12:00:00 ist", None, None) for i in range(20)] + [(99, None, None, "1 May 2024 12:00:00 IST", None, None)]
    got = times(spark, feeds, rows)
    assert {got[i] for i in range(40)} == {(there, "read")} == {got[98]} and {got[60 + i] for i in range(20)} == {(here, "read")}
    assert got[99] == (None, "ambiguous")


def test_times_empty(spark, feeds):
    assert times(spark, feeds, []) == {}


# -- repeats --


def test_repeats(spark):
    rows = [("futures_aggtrades", "A", 1, i) for i in (5, 6, 7)] + [("futures_aggtrades", "B", 1, 8), ("futures_aggtrades", None, 1, 9), ("futures_aggtrades", "A", None, 10), ("futures_klines", "A", 1, 11), ("futures_klines", "A", 1, None), ("futures_aggtrades", "A", 1, 7)]
    df = at(spark, rows, "topic string, symbol string, message_key long, delivery_id long").withColumns({"bucket": F.lit("x"), "h": F.lit(1), "slice": F.lit(None)})
    got = sorted(r.delivery_id for r in bloom_dedupe.find_repeats(df, bloom_dedupe.time_bucket()).collect())
    assert got == [5, 6]
    assert bloom_dedupe.find_repeats(df.limit(0), bloom_dedupe.time_bucket()).count() == 0


def test_hot_message(spark):
    """One message makes a third of all rows, in many tasks."""
    df = spark.range(30_000, numPartitions=6).select(F.lit("futures_aggtrades").alias("topic"), F.lit("A").alias("symbol"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 100).cast("long").alias("message_key"), F.col("id").alias("delivery_id"))
    got = {r.delivery_id for r in bloom_dedupe.find_repeats(df, bloom_dedupe.time_bucket()).collect()}
    assert got == {i for i in range(0, 29_997, 3)}


def test_symbols_are_cleaned(spark):
    df = at(spark, [(1, " a\tbUSDT", 5, None)], "delivery_id long, symbol string, agg_trade_id long, transact_time long").withColumn("received_at", F.current_timestamp())
    r = deliveries(df, "futures_aggtrades").first()
    assert r.symbol == "ABUSDT" and r.event_ms is None


# -- late records --

HOUR = 3_600_000


def log(spark, rows):
    return at(spark, [("t", "A", k, e, d, a * 1000, p, 1.0) for k, e, d, a, p in rows], "topic string, symbol string, message_key long, event_ms long, delivery_id long, arrived_us long, price double, quantity double").withColumn("period_end", F.lit("clash"))


def test_late_boundaries(spark):
    rows = [
        (1, 0, 1, HOUR + 60_000, 1.0),  # just on time
        (2, 0, 2, HOUR + 60_001, 2.0),  # corrects
        (3, HOUR - 1, 3, HOUR + 1_800_000, 3.0),  # just corrects
        (4, HOUR - 1, 4, HOUR + 1_800_001, 4.0),  # too late
        (5, None, 5, 0, 5.0),
        (6, None, 6, 10, 6.0), (6, 0, 7, 9 * HOUR, 6.5),  # earliest delivery without time
        (7, HOUR, 8, 2 * HOUR, 7.0),
    ]
    df = log(spark, rows)
    got = {r.message_key: r.outcome for r in lambda_views.late_records(df, lambda_views.TRADES).collect()}
    assert got == {2: "corrected", 3: "corrected", 4: "dropped"}
    assert lambda_views.late_records(df.limit(0), lambda_views.TRADES).count() == 0
    # a bar at the full hour belongs to the hour that ends then
    bars = {r.message_key: r.outcome for r in lambda_views.late_records(log(spark, [(HOUR, HOUR, 1, HOUR + 60_001, 1.0)]), lambda_views.BARS).collect()}
    assert bars == {HOUR: "corrected"}


def test_layers_agree(spark):
    """Increments of on-time batches make what the batch layer makes of them; a recomputation replaces, freezes and is served first."""
    rows = [(k, (k * 977_000) % (3 * HOUR), k, (k * 977_000) % (3 * HOUR) + 500, float(k)) for k in range(60)]
    df = log(spark, rows)
    parts = [lambda_views.fast_increment(df.filter(F.col("message_key") % 3 == i), lambda_views.TRADES, "price", "quantity") for i in range(3)]
    fast = lambda_views.add_increments(*parts)
    full = lambda_views.recompute(df, lambda_views.TRADES, "price", "quantity")
    columns = ["period_end", "records", "weighted", "low", "high", "first", "last"]
    assert sorted(fast.select(*columns).collect()) == sorted(full.select(*columns).collect())
    early = lambda_views.recompute(df, lambda_views.TRADES, "price", "quantity", as_of_us=int(1.9 * HOUR) * 1000)
    assert {r.period_end // HOUR: r.state for r in early.collect()} == {1: "frozen", 2: "open"}
    served = {r.period_end // HOUR: r.state for r in lambda_views.serve(early, fast).collect()}
    assert served == {1: "frozen", 2: "open", 3: "provisional"}
    again = lambda_views.recompute(df, lambda_views.TRADES, "price", "quantity", frozen=early)
    assert sorted(again.select(*columns).collect()) == sorted(full.select(*columns).collect())


# -- trailing --


def test_trailing(spark):
    day = lambda n: f"2024-{1 + n // 28:02d}-{1 + n % 28:02d}"
    rows = [("A", "2024-01-01", 1, 1.0), ("A", "2024-01-01", 2, None), ("A", "2024-01-04", 1, 5.0), ("A", "2024-01-12", 1, float("nan")), (None, "2024-01-01", 1, 1.0), ("B", None, 1, 1.0), ("C", "2024-01-31", 3, 2.0), ("C", "2024-01-31", 3, 2.0)]
    df = at(spark, rows, "symbol string, d string, seq int, x double").withColumns({"entity": F.lit(0), "block": F.lit(1), "control": F.lit(True), "day": F.lit("z")})
    got = {(r.entity, r.nth): r for r in trailing.trailing(df, "symbol", F.to_date("d"), "seq", ["x"], [2, 7], ("total", "high")).collect()}
    assert {k for k in got} == {("A", i) for i in range(1, 13)} | {("C", 1)}
    assert got["A", 1].x_total_7 == 0 and got["A", 1].x_high_7 is None  # the later load has no value
    assert [got["A", i].x_total_7 for i in (4, 10, 11)] == [5, 5, 0] and got["A", 5].x_high_2 == 5 and got["C", 1].x_total_2 == 2
    assert trailing.trailing(df.limit(0), "symbol", F.to_date("d"), "seq", ["x"], [7]).count() == 0
    assert day(0)


def test_trailing_across_blocks(spark):
    df = spark.range(1500).select(F.lit("A").alias("s"), F.date_add(F.lit("2019-03-01").cast("date"), F.col("id").cast("int")).alias("d"), "id", (F.col("id") % 13).cast("double").alias("x"))
    got = sorted(trailing.trailing(df, "s", F.col("d"), "id", ["x"], [30], ("total", "low")).collect(), key=lambda r: r.nth)
    x = np.arange(1500) % 13
    assert [r.x_total_30 for r in got] == [x[max(0, i - 29) : i + 1].sum() for i in range(1500)]
    assert [r.x_low_30 for r in got] == [x[max(0, i - 29) : i + 1].min() for i in range(1500)]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=60), st.integers(1, 9))
def test_two_stacks(values, w):
    q, out = trailing.TwoStackQueue(max, -1000), []
    for i, v in enumerate(values):
        q.push(v)
        if i >= w:
            q.pop()
        out.append(q.fold())
    assert out == [max(values[max(0, i - w + 1) : i + 1]) for i in range(len(values))]
    if len(values) >= w:
        assert trailing.window(np.array(values, float), w, np.maximum, -np.inf).tolist() == out[w - 1 :]


# -- grid --


def test_grid(spark):
    rows = [("A", 0, 1, 10.0), ("A", 1_200, 2, 22.0), ("A", 1_200, 3, 24.0), ("A", 100_500, 4, 50.0), ("A", 101_000, 5, 0.0), ("B", 500, 1, None), ("B", 2_500, 2, float("inf")), ("B", 3_500, 3, 7.0), ("C", 0, 1, -1.0), (None, 0, 1, 1.0), ("D", None, 1, 1.0)]
    df = at(spark, rows, "s string, t long, id long, v double").withColumns({"source": F.lit("x"), "period": F.lit(1), "block": F.lit(2), "at": F.lit(3)})
    got = {(r.source, r["at"]): (r.v, r.v_state) for r in regular_grid.regular_grid(df, "s", F.col("t"), "id", ["v"], 1000, 5000).collect()}
    assert got["A", 0] == (10.0, "observed") and got["A", 1000] == (24.0, "observed")  # of equal times the later row
    assert got["A", 50_000] == (24.0, "held") and got["A", 101_000] == (50.0, "held")
    assert got["B", 0] == (7.0, "ahead") and got["C", 0] == (None, "none") and ("D", 0) not in got
    near = regular_grid.regular_grid(at(spark, [("A", 0, 1, 10.0), ("A", 4000, 2, 30.0)], "s string, t long, id long, v double"), "s", F.col("t"), "id", ["v"], 1000, 5000)
    assert {r["at"]: r.v for r in near.collect()} == {0: 10.0, 1000: 15.0, 2000: 20.0, 3000: 25.0, 4000: 30.0}
    assert regular_grid.regular_grid(df.limit(0), "s", F.col("t"), "id", ["v"], 1000, 5000).count() == 0


def test_grid_across_blocks(spark):
    n = regular_grid.BLOCK
    rows = [("A", 10, 1, 1.0), ("A", 3 * n + 10, 2, 1.0 + 3 * n)]
    got = regular_grid.regular_grid(at(spark, rows, "s string, t long, id long, v double"), "s", F.col("t"), "id", ["v"], 1, 10 * n).collect()
    assert len(got) == 3 * n + 1 and all(abs(r.v - (r["at"] - 9)) < 1e-6 for r in got)


# -- spikes --


def series(spark, values, copies=()):
    rows = [(i, "A", i * 300_000, v) for i, v in enumerate(values)] + [(10_000 + i, "A", i * 300_000, values[i]) for i in copies]
    return at(spark, rows, "row_id long, s string, t long, v double").withColumns({"symbol": F.lit("z"), "field": F.lit(1), "h": F.lit(2), "kind": F.lit("?")})


def found(df):
    return {(r.row_id, r.kind) for r in spikes.implausible(df, "s", "t", "row_id", ["s", "t", "v"], ["v"]).collect()}


def noise(n, level=100.0):
    return [float(level * (1 + 0.01 * np.sin(i * 2.3) + 0.005 * np.cos(i * 7.1))) for i in range(n)]


def test_spikes(spark):
    v = noise(400)
    v[50] *= 3  # alone
    v[100:103] = [30.0, 31.0, 30.5]  # three together
    v[150:155] = [250.0, 251.0, 252.0, 250.0, 251.0]  # too long
    for i in range(200, 400):
        v[i] *= 2  # a new level
    v[250:262] = [205.5] * 12  # stuck
    v[300:311] = [207.5] * 11  # not long enough
    v[330], v[331], v[332], v[333] = -1.0, float("nan"), float("inf"), None
    v[340] = 0.0
    got = found(series(spark, v, copies=[50]))
    assert {i for i, k in got if k == "spike"} == {50, 10_050, 100, 101, 102}
    assert {i for i, k in got if k == "stuck"} == set(range(250, 262)) and {i for i, k in got if k == "impossible"} == {330, 331, 332}


def test_spikes_across_chunks(spark):
    n = spikes.CHUNK
    v = noise(2 * n + 100)
    v[n - 1], v[n] = 500.0, 510.0
    v[2 * n - 6 : 2 * n + 6] = [101.0] * 12
    got = found(series(spark, v))
    assert {i for i, k in got if k == "spike"} == {n - 1, n} and {i for i, k in got if k == "stuck"} == set(range(2 * n - 6, 2 * n + 6))


def test_edges_decide(monkeypatch):
    """Only readings between opposite edges are looked at: neither noise nor a new level is, and without edges nothing is a spike."""
    v = np.array(noise(300))
    v[50] *= 3
    v[100:] *= 2
    v[201:204] *= [1.6, 2.5, 1.6]  # a ramp up and down
    seen = spikes._look(v)
    usual = dict(zip(spikes.STATS, (0.006, float(np.median(np.abs(seen[4][0]))), float(np.median(np.abs(seen[4][1]))))))
    between = spikes.between_edges(*seen[4], (usual["fine"], usual["coarse"]))
    assert between[50] and between[202] and between.sum() <= 14 and not between[97:104].any()
    assert set(np.flatnonzero(spikes._kinds(v, usual, seen) == "spike")) == {50, 201, 202, 203}
    monkeypatch.setattr(spikes, "DETAIL", 1e9)
    assert not (spikes._kinds(v, usual, seen) == "spike").any()


def test_spikes_in_chunks_as_in_whole(spark):
    """A series in many chunks is judged by the same scales as in one."""
    rng = np.random.default_rng(5)
    v = (np.exp(rng.normal(0, 0.01, 3000)) * 100).tolist()
    for i in range(37, 3000, 211):
        v[i] *= 1.4
    df = series(spark, v)
    whole, cut = ({(r.row_id, r.kind) for r in spikes.implausible(df, "s", "t", "row_id", ["s", "t", "v"], ["v"], n).collect()} for n in (spikes.CHUNK, 256))
    assert whole == cut and {i for i, _ in whole} == set(range(37, 3000, 211))


def test_segments():
    b = pd.DataFrame({"k": list("aabbbc"), "n": [1, 1, 1, 2, 2, 2], "x": range(6)})
    for size in (1, 2, 3, 6):
        got = [g["x"].tolist() for g in chunks.segments((b[i : i + size] for i in range(0, 6, size)), ["k", "n"])]
        assert got == [[0, 1], [2], [3, 4], [5]]
    assert list(chunks.segments(iter([b[:0]]), ["k"])) == []


def test_spikes_edges(spark):
    df = at(spark, [(1, None, 5, -1.0), (2, "A", None, 3.0), (3, "A", None, -3.0), (4, "B", 1, 1.0), (5, "B", 1, 1.0)], "row_id long, s string, t long, v double")
    assert found(df) == {(1, "impossible"), (3, "impossible")}
    assert found(df.limit(0)) == set()


# -- lines --


def test_machine_equals_the_definition():
    """Any chunk boundary gives the states of a plain run."""
    rng = np.random.default_rng(1)
    for n in (1, 255, 256, 257, 5000):
        classes = rng.choice([0, 1, 2, 3], n, p=[0.6, 0.2, 0.15, 0.05]).astype(np.uint8)
        state, want = csv_machine.START, []
        for c in classes:
            want.append(state)
            state = csv_machine.STEP[c, state]
        assert csv_machine.states(classes).tolist() == want


def test_lines(spark):
    head = ",".join(csv_machine.COLUMNS["futures_aggtrades"])
    ok = "1,2.5,,3,4,1740967450206,T"
    lines = [ok, ok + "\r", head, "", "  \t\r", None, '"1","2.5","",3,4," 1740967450206 ",t', '1,2"5,,3,4,1740967450206,T', '1,"2.5,,3,4,1740967450206,T', ok + ",", "1,2", ok.replace("2.5", "1e999"), ok.replace("1740967450206", "1240967450206"), ok.replace("2.5", "x" * 300_000), ',"' + "y" * 1000 + '"z', ok]
    df = at(spark, [(i if i else None, "futures_aggtrades", None, None, x, 1) for i, x in enumerate(lines)] + [(99, None, None, None, ok, 1)], "raw_id long, file_kind string, file_name string, line_no long, line string, reason int")
    p = csv_machine.parse(df)
    got = {r.raw_id: (r.reason, r.error_at) for r in p.collect()}
    assert set(got) == {None, 1, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 99}
    assert all(got[i] == (None, None) for i in (None, 1, 6, 15))
    assert got[7] == ("broken_quoting", 3) and got[8] == ("broken_quoting", len(lines[8])) and got[14][0] == "broken_quoting"
    assert got[9] == ("wrong_column_count", len(ok) + 1) and got[10][0] == "wrong_column_count"
    assert all(got[i][0] == "invalid_value" for i in (11, 12, 13)) and got[11][1] == 2 and got[99][0] == "unknown_kind"
    rows = {r.raw_id: r for r in csv_machine.rows_of(p, "futures_aggtrades").collect()}
    assert rows[6].transact_time == 1740967450206 and rows[6].quantity is None and rows[6].is_buyer_maker is True
    assert csv_machine.parse(df.limit(0)).count() == 0


def test_settled_copies_are_not_shuffled(spark):
    """A message with a third of all deliveries: each copy but the last comes out once, and only one row a task goes into the window."""
    rows = spark.range(0, 600, numPartitions=4).select(F.lit("futures_aggtrades").alias("topic"), F.lit("A").alias("symbol"), F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") + 1000).alias("message_key"), F.col("id").alias("delivery_id"))
    out = bloom_dedupe.find_repeats(rows, bloom_dedupe.time_bucket())
    assert sorted(r.delivery_id for r in out.collect()) == list(range(0, 597, 3))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "NOT settled" in plan[plan.index("Window") :]


def test_settling_holds_few():
    """Whatever is let go of, the last of a message is never settled, and all but the last of those held together are."""
    d = pd.DataFrame({"topic": "t", "symbol": "A", "message_key": [1, 2, 1, 1, 3, 2, 1], "delivery_id": [5, 1, 2, 7, 9, 3, 6], "bucket": 0})
    for held in (1, 2, 100):
        bloom_dedupe.HELD, old = held, bloom_dedupe.HELD
        try:
            got = pd.concat(bloom_dedupe._settle(iter([d[:3], d[3:4], d[4:]])))
        finally:
            bloom_dedupe.HELD = old
        assert sorted(got.delivery_id) == sorted(d.delivery_id)
        assert not got[got.settled].delivery_id.isin([7, 3, 9]).any() and (held < 100 or got.settled.sum() == 4)


def test_filters_of_many_parts(spark, monkeypatch):
    """Buckets in many stored parts, of which a worker holds few."""
    monkeypatch.setattr(bloom_dedupe, "TOGETHER", 1)
    rows = spark.range(0, 4000, numPartitions=3).select(F.lit("futures_klines").alias("topic"), F.lit("A").alias("symbol"), ((F.col("id") % 3000) * 20_000_000).alias("message_key"), F.col("id").alias("delivery_id"))
    assert sorted(r.delivery_id for r in bloom_dedupe.find_repeats(rows, bloom_dedupe.time_bucket()).collect()) == list(range(1000))
