"""Microstructure operators against plain walks; one symbol has most of the rows, in any chunks."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketloom.core.specs import SCALE as S
from marketloom.operators import microstructure as m
from marketloom.operators import scan, stats, windows

TRADES = "exchange string, symbol string, trading_date date, ts_event_us long, file_id long, file_seq long, side string, price long, qty long"
WEEK = [1, 7, 86_400_000_000]


@pytest.fixture(scope="module")
def trades(spark):
    rng = random.Random(5)
    rows, ts = [], 0
    for i in range(600):
        ts += rng.choice([0, 1, 1, 2, 9, 40])
        symbol = "hot" if rng.random() < 0.8 else rng.choice("ab")
        rows.append(("x", symbol, None, ts, 1, i, rng.choice(["buy", "sell", "unknown"]), rng.randint(90, 110) * S, rng.choice([0, 1, 2, 5, 60])))
    return rows, spark.createDataFrame(rows, TRADES).repartition(5).cache()


def by_symbol(rows):
    out = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r[1], r[3], r[4], r[5])):
        out[r[1]].append(r)
    return out


def test_volume_buckets_split_trades(spark, trades):
    rows, df = trades
    size = 7
    want = {}
    for symbol, own in by_symbol(rows).items():
        units = [(r[3], r[6]) for r in own for _ in range(r[8])]  # each unit of quantity by itself
        for b in range(0, len(units), size):
            part = units[b : b + size]
            sides = [s for _, s in part]
            want[symbol, b // size] = (sides.count("buy"), sides.count("sell"), len(part), part[0][0], part[-1][0])
    found = m.volume_buckets(df, size)
    got = {(r["symbol"], r["bucket"]): (r["buy_qty"], r["sell_qty"], r["bucket_qty"], r["first_ts_us"], r["last_ts_us"]) for r in found.collect()}
    assert got == want
    for stretch in (5, 1 << 16):
        rolled = {(r["symbol"], r["bucket"]): r["vpin"] for r in m.vpin(found, size, 5, stretch=stretch).collect()}
        full = {k: abs(x[0] - x[1]) / size for k, x in want.items() if x[2] == size}
        assert set(rolled) == set(full)
        for (symbol, b), x in rolled.items():
            assert (x is None) == (b < 4) and (b < 4 or abs(x - np.mean([full[symbol, i] for i in range(b - 4, b + 1)])) < 1e-12)
    with pytest.raises(ValueError, match="must be > 0"):
        m.volume_buckets(df, 0)
    assert m.volume_buckets(df.limit(0), size).count() == 0


def test_one_trade_fills_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(m, "BLOCK", 7)
    df = spark.createDataFrame([("x", "s", None, 1, 1, 1, "buy", S, 3), ("x", "s", None, 2, 1, 2, "sell", S, 1000)], TRADES)
    got = m.volume_buckets(df, 10).orderBy("bucket").collect()
    assert [r["bucket_qty"] for r in got] == [10] * 100 + [3]
    assert (got[0]["buy_qty"], got[0]["sell_qty"], got[99]["sell_qty"]) == (3, 7, 10)


@pytest.mark.parametrize("small", [3, 40, 1 << 17])
def test_quantiles_are_exact_in_any_ranges(spark, small):
    rng = random.Random(small)
    rows = [("hot", rng.choice([5.0, 5.0, rng.gauss(0, 1), rng.random() ** 9 * 1e300, None])) for _ in range(900)]
    rows += [(None, rng.random()) for _ in range(20)] + [("one", 3.0), ("none", None)] + [("same", 7.0)] * 50
    shares = {"q0": 0.0, "q10": 0.1, "q50": 0.5, "q95": 0.95, "q100": 1.0}
    got = stats.quantiles(spark.createDataFrame(rows, "k string, v double").repartition(4), "v", shares, ["k"], small).collect()
    assert len(got) == 5
    for r in got:
        values = [x for k, x in rows if k == r["k"] and x is not None]
        for name, p in shares.items():
            assert r[name] is None if not values else np.isclose(r[name], np.quantile(values, p), rtol=1e-12, atol=0)
    whole = stats.quantiles(spark.createDataFrame(rows, "k string, v double"), "v", {"m": 0.5}, small=small).collect()
    assert len(whole) == 1 and np.isclose(whole[0]["m"], np.median([x for _, x in rows if x is not None]))
    assert stats.quantiles(spark.createDataFrame([], "k string, v double"), "v", {"m": 0.5}).collect()[0]["m"] is None


def test_above_quantile(spark):
    rng = random.Random(2)
    rows = [("hot" if i % 5 else "b", i % 2, rng.randint(1, 200)) for i in range(500)]
    df = spark.createDataFrame(rows, "symbol string, trading_date int, qty long")
    for r in m.above_quantile(df, 0.95, small=20).collect():
        own = [q for s, d, q in rows if (s, d) == (r["symbol"], r["trading_date"])]
        limit = np.quantile(own, 0.95)
        assert np.isclose(r["threshold"], limit / S) and r["n_large"] == sum(q > limit for q in own)
        assert np.isclose(r["large_volume_ratio"], sum(q for q in own if q > limit) / sum(own))


@pytest.mark.parametrize("stretch", [4, 50, 1 << 16])
def test_windows_with_a_halo(spark, trades, stretch):
    rows, df = trades

    def columns(w):
        return {"lag4": F.lag("qty", 4).over(w), "lead3": F.lead("qty", 3).over(w), "sum": F.sum("qty").over(w.rowsBetween(-4, 3))}

    found = windows.windowed(df, ("exchange", "symbol"), m.ORDER, columns, back=4, ahead=3, stretch=stretch, chunk=11)
    got = {r["file_seq"]: (r["lag4"], r["lead3"], r["sum"]) for r in found.collect()}
    assert found.columns == [*df.columns, "lag4", "lead3", "sum"]
    for own in by_symbol(rows).values():
        q = [r[8] for r in own]
        for i, r in enumerate(own):
            lag, lead = (q[i - 4] if i >= 4 else None), (q[i + 3] if i + 3 < len(q) else None)
            assert got[r[5]] == (lag, lead, sum(q[max(0, i - 4) : i + 4]))
    assert len(got) == len(rows)


@pytest.mark.parametrize("chunk", WEEK)
def test_sums_over_frames_of_time(spark, trades, chunk):
    rows, df = trades
    found = scan.trailing_sums(df, ("exchange", "symbol"), "ts_event_us", {"n": F.lit(1), "q": F.col("qty")}, 10, chunk)
    got = {r["file_seq"]: (int(r["n"]), int(r["q"])) for r in found.collect()}
    for own in by_symbol(rows).values():
        for r in own:
            frame = [x[8] for x in own if r[3] - 10 <= x[3] <= r[3]]
            assert got[r[5]] == (len(frame), sum(frame))
    assert len(got) == len(rows)


def test_trend_is_the_regression_of_the_frame(spark):
    rng = random.Random(4)
    start = 1_704_067_200_000_000
    rows = [("x", "hot", None, start + rng.randint(0, 6_000) * 1_000_000, 1, i, "buy", S, rng.randint(1, 99) * S) for i in range(200)]
    df = spark.createDataFrame(rows, TRADES)
    for r in m.trade_size_trend(df, 1_800_000_000).collect():
        frame = [(x[3] / 1e6 - start / 1e6, x[8] / S) for x in rows if r["ts_event_us"] - 1_800_000_000 <= x[3] <= r["ts_event_us"]]
        assert r["n_in_frame"] == len(frame)
        if len({t for t, _ in frame}) > 1:
            assert np.isclose(r["trade_size_trend"], np.polyfit(*zip(*frame), 1)[0], rtol=1e-6, atol=1e-9)
        else:
            assert r["trade_size_trend"] is None


def test_order_lifetimes_match_events(spark):
    key = "exchange string, symbol string, trading_date int, channel_id int, "
    orders = [(1, 100, "ADD", "BUY", 10), (1, 50_100, "CANCEL", "BUY", 4), (1, 90_000, "CANCEL", "BUY", 1), (2, 0, "ADD", "SELL", 5), (2, 100_000, "CANCEL", "SELL", 5), (3, 7, "CANCEL", "BUY", 2), (4, 9, "ADD", "BUY", 8)]
    ticks = [(1, 2, 500, "TRADE", 3), (0, 4, 600, "CANCEL", 1), (4, None, 700, "CANCEL", 2), (9, None, 800, "TRADE", 1)]
    o = spark.createDataFrame([("szse", "s", 1, 1, *r) for r in orders], key + "order_ref long, ts_event_us long, event_kind string, side string, qty long")
    t = spark.createDataFrame([("szse", "s", 1, 1, *r) for r in ticks], key + "bid_order_ref long, ask_order_ref long, ts_event_us long, event_kind string, qty long")
    lives = m.order_lifetimes(o, t)
    got = {r["order_ref"]: (r["side"], r["added_qty"], r["cancelled_qty"], r["traded_qty"], r["residual_qty"], r["lifetime_us"]) for r in lives.collect()}
    assert got[1] == ("BUY", 10, 5, 3, 2, 50_000) and got[2] == ("SELL", 5, 5, 3, -3, 100_000)
    assert got[3] == ("BUY", 0, 2, 0, -2, None) and got[9] == ("BUY", 0, 0, 1, -1, None)
    assert got[4] == ("BUY", 8, 3, 0, 5, 591)
    (day,) = m.fleeting_liquidity(lives).collect()
    assert (day["n_orders"], day["n_fleeting"], day["n_unmatched"]) == (3, 2, 2)
    assert np.isclose(day["fleeting_qty_ratio"], 8 / 23) and day["arrival_asymmetry"] == 2.0 and np.isclose(day["residual_qty"], 4 / S)


@pytest.mark.parametrize("chunk", [5, 60, 3_600_000_000])
def test_depth_at_the_touch_equals_a_plain_walk(spark, chunk):
    rng = random.Random(chunk)
    updates, ts = [], 0
    for i in range(500):
        ts += rng.choice([0, 1, 2, 9])
        symbol = "hot" if rng.random() < 0.8 else "b"
        side = rng.choice(["bid", "ask"])
        price = rng.randint(1, 12) if side == "bid" else rng.randint(10, 22)
        updates.append(("x", symbol, ts, 1, i, side, price, rng.choice([0, 0, 1, 5, 9]), False))
        if rng.random() < 0.03:  # a snapshot of several rows at a time of its own
            ts += 1
            updates += [("x", symbol, ts, 1, 10_000 + 10 * i + j, *r, True) for j, r in enumerate([("bid", 3, 4), ("bid", 2, 0), ("ask", 20, 7)])]
            ts += 1
    big = (1 << 60) + 1  # prices beyond what a double can tell apart
    updates = [(*u[:6], big + u[6], *u[7:]) for u in updates]
    points = [("x", s, t) for s in ("hot", "b", "none") for t in rng.sample(range(ts + 100), 60)]
    u = spark.createDataFrame(updates, "exchange string, symbol string, ts_event_us long, file_id long, file_seq long, side string, price long, qty long, is_snapshot boolean")
    p = spark.createDataFrame(points + points[:5], "exchange string, symbol string, ts_spine_us long")
    found = m.touch_depth(u.repartition(3), p, chunk_us=chunk)
    got = {(r["symbol"], r["ts_spine_us"]): tuple(r)[3:] for r in found.collect()}
    want = {}
    for _, symbol, t in points:
        book, last = {"bid": {}, "ask": {}}, None
        for r in sorted((x for x in updates if x[1] == symbol and x[2] <= t), key=lambda r: r[2:5]):
            if r[8] and last != r[2]:
                book, last = {"bid": {}, "ask": {}}, r[2]
            book[r[5]][r[6]] = r[7]
        live = {s: {k: q for k, q in levels.items() if q > 0} for s, levels in book.items()}
        bid, ask = max(live["bid"], default=None), min(live["ask"], default=None)
        want[symbol, t] = (bid, live["bid"].get(bid), ask, live["ask"].get(ask))
    assert got == want
    if chunk == 60:
        gone = {(r["symbol"], r["ts_spine_us"]): r["bid_depletion"] for r in m.touch_depletion(found).collect()}
        walk = sorted((k for k in want if k[0] == "hot"), key=lambda k: k[1])
        for a, b in zip(walk, walk[1:]):
            (old, q, *_), (new, r, *_) = want[a], want[b]
            expected = None if old is None and new is not None else q - r if old == new and q is not None else q if new is None or (old is not None and new < old) else 0
            assert gone[b] == expected


def test_lead_and_lag_find_the_delay(spark):
    rng = np.random.default_rng(3)
    lead = rng.normal(0, 1, 300)
    rows = [("l", i, float(x)) for i, x in enumerate(lead)] + [("f", i + 3, float(-x)) for i, x in enumerate(lead) if i % 7]
    returns = spark.createDataFrame(rows, "symbol string, step long, ret double")
    pairs = spark.createDataFrame([("l", "f"), ("f", "l"), ("l", "nothing")], "leader string, follower string")
    found = m.lead_lag(returns, pairs, 5)
    at = {s: {i: x for k, i, x in rows if k == s} for s in "lf"}
    for r in found.collect():
        both = [(x, at[r["follower"]][i + r["lag"]]) for i, x in at[r["leader"]].items() if i + r["lag"] in at[r["follower"]]]
        assert r["n"] == len(both) and abs(r["correlation"] - np.corrcoef(*zip(*both))[0, 1]) < 1e-9
    best = {(r["leader"], r["follower"]): r["lag"] for r in m.best_lag(found).collect()}
    assert best == {("l", "f"): 3, ("f", "l"): -3}


@pytest.mark.parametrize("chunk", WEEK)
def test_clusters_do_not_hang_on_chunks(spark, trades, chunk):
    rows, df = trades
    want = []
    for symbol, own in by_symbol(rows).items():
        runs = []
        for r in own:
            if runs and r[3] - runs[-1][-1][3] <= 8:
                runs[-1].append(r)
            else:
                runs.append([r])
        want += [(symbol, x[0][3], x[-1][3], len(x), sum(r[8] for r in x)) for x in runs]
    got = [(r["symbol"], r["start_us"], r["end_us"], r["n"], r["qty"]) for r in m.trade_clusters(df, 8, chunk_us=chunk).collect()]
    assert sorted(got) == sorted(want)


def test_streamed_clusters_equal_the_closed_ones(spark, tmp_path):
    from marketloom.streaming import jobs

    rng, ts = random.Random(6), 1_704_067_200_000_000
    rows = []
    for i in range(300):
        ts += rng.choice([1_000, 400_000, 999_999, 1_000_000, 1_500_000])
        rows.append(("x", "hot" if i % 4 else "b", None, ts, 1, i, rng.choice(["buy", "sell"]), S, rng.randint(1, 9)))
    df = spark.createDataFrame(rows, TRADES)
    for at in range(0, 300, 60):  # in order of time, a file at a time
        df.where(f"file_seq >= {at} and file_seq < {at + 60}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    run = jobs.stream_trade_clusters(stream, "1 second", "3 hours").writeStream.format("memory").queryName("clusters").outputMode("append").trigger(availableNow=True).start()
    run.awaitTermination()
    assert spark.table("clusters").count() == 0  # the watermark has not passed any end
    run = jobs.stream_trade_clusters(stream, "1 second", "1 second").writeStream.format("memory").queryName("clusters2").outputMode("append").trigger(availableNow=True).start()
    run.awaitTermination()
    columns = ["symbol", "start_us", "end_us", "n", "qty", "buy_share"]
    batch = {tuple(r) for r in m.trade_clusters(df, 1_000_000).select(*columns).collect()}
    closed = {tuple(r) for r in spark.table("clusters2").select(*columns).collect()}
    assert closed <= batch and len(closed) >= len(batch) - 4


def test_volume_curve_looks_back_only(spark):
    day = 86_400_000_000
    rows = [("x", "s", None, d * day + h * 3_600_000_000, 1, 10 * d + h, "buy", S, q * S) for d, h, q in [(0, 1, 4), (1, 1, 6), (1, 2, 8), (3, 1, 5), (3, 2, 3), (3, 2, 1)]]
    df = spark.createDataFrame(rows, TRADES).withColumn("trading_date", F.to_date(F.timestamp_micros("ts_event_us")))
    got = {(str(r["trading_date"])[-2:], r["step"]): (r["volume"], r["expected"], r["participation"]) for r in m.volume_curve(df, 3_600_000_000).collect()}
    assert got == {("01", 1): (4.0, None, None), ("02", 1): (6.0, 4.0, 1.5), ("02", 2): (8.0, 0.0, None), ("04", 1): (5.0, 5.0, 1.0), ("04", 2): (4.0, 4.0, 1.0)}


def test_kyle_lambda_is_the_days_slope(spark):
    step = 60_000_000
    q = [3, -2, 5, -7, 1, 4]
    price, rows = 1000, []
    for i, x in enumerate(q):
        price += 2 * x if i else 0
        rows.append(("x", "s", None, i * step, 1, i, "buy" if x > 0 else "sell", price * S, abs(x) * S))
    (r,) = m.kyle_lambda(spark.createDataFrame(rows, TRADES)).collect()
    assert r["n"] == 5 and np.isclose(r["kyle_lambda"], 2.0) and np.isclose(r["r2"], 1.0) and abs(r["intercept"]) < 1e-9


def test_flow_spreads_and_acceleration(spark, trades):
    rows, df = trades
    got = {r["symbol"]: r for r in m.trade_flow(df, 1, ("symbol",)).collect()}
    late = {r["symbol"]: r for r in m.window_imbalance(df, 0, 1, 30, ("symbol",)).collect()}
    for symbol, own in by_symbol(rows).items():
        net = sum({"buy": r[8], "sell": -r[8]}.get(r[6], 0) for r in own)
        assert np.isclose(got[symbol]["aggressor_volume"], net / S) and np.isclose(got[symbol]["retail_intensity"], np.mean([r[8] <= 1 for r in own]))
        assert np.isclose(late[symbol]["imbalance"], net / sum(r[8] for r in own))
    assert m.window_imbalance(df, 1, 2, 30, ("symbol",)).count() == 0
    quotes = spark.createDataFrame([("x", "s", 1, 99, 101), ("x", "s", 1, 100, 100), ("x", "s", 1, 101, 99), ("x", "s", 1, 0, 5)], "exchange string, symbol string, trading_date int, bid_price long, ask_price long")
    (r,) = m.spread_regime(quotes).collect()
    assert r["n"] == 2 and np.isclose(r["spread_pct"], 1.0)
    steps = {(r["symbol"], r["step_us"]): r["acceleration"] for r in m.volume_acceleration(df, 100).collect()}
    for symbol, own in by_symbol(rows).items():
        volume = defaultdict(int)
        for r in own:
            volume[r[3] // 100 * 100] += r[8]
        for i, at in enumerate(sorted(volume)):
            want = None if i == 0 else (volume[at] - volume.get(at - 100, 0)) / S / 1e-4
            assert (steps[symbol, at] is None) if want is None else np.isclose(steps[symbol, at], want)
