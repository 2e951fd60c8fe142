import numpy as np
import pytest
from pyspark.sql import functions as F

from marketloom.core.specs import OPEN_END
from marketloom.core.specs import SCALE as S
from marketloom.core.timeutil import micros
from marketloom.operators import asof, bars, cotrading, spine, stats, windows
from marketloom.operators.phases import add_trading_phase, filter_by_phase
from marketloom.operators.scan import running_sum
from marketloom.plans import registry

TRADES = [("BTC", 10, 1, 40 * S, 10 * S), ("BTC", 20, 1, 70 * S, 10 * S), ("BTC", 20, 2, 10 * S, 10 * S), ("BTC", 30, 3, 80 * S, 20 * S), ("ETH", 15, 1, 5 * S, 30 * S)]


@pytest.fixture(scope="module")
def trades(spark):
    rows = [("x", s, 1 if s == "BTC" else 2, t, 1, q, n, p) for s, t, q, n, p in TRADES]
    return spark.createDataFrame(rows, "exchange string, symbol string, symbol_id long, ts_event_us long, file_id long, file_seq long, qty long, price long")


def points(df, symbol="BTC"):
    return [r["ts_spine_us"] for r in df.where(F.col("symbol") == symbol).orderBy("ts_spine_us").collect()]


@pytest.mark.parametrize("chunk", [7, 86_400_000_000])
def test_spines(trades, chunk):
    assert points(spine.trades_spine(trades)) == [10, 20, 30]
    assert points(spine.volume_spine(trades, 100 * S, chunk_us=chunk)) == [20, 30]
    assert points(spine.dollar_spine(trades, 1000 * S, chunk_us=chunk)) == [20, 30]
    assert points(spine.volume_spine(trades, 1, chunk_us=chunk), "ETH") == [15]
    for f in (spine.volume_spine, spine.dollar_spine):
        with pytest.raises(ValueError, match="must be > 0"):
            f(trades, 0)


def test_clock_spine(spark):
    dim = spark.createDataFrame([("x", "BTC", 1001, 0, 100), ("x", "BTC", 1002, 100, OPEN_END)], "exchange string, exchange_symbol string, symbol_id long, valid_from_ts_us long, valid_until_ts_us long")
    got = spine.build_spine(spine.ClockSpine(50), dim=dim, start=0, end=200).orderBy("ts_spine_us").collect()
    assert [(r["ts_spine_us"], r["symbol_id"]) for r in got] == [(50, 1001), (100, 1001), (150, 1002), (200, 1002)]
    with pytest.raises(RuntimeError, match="too many rows"):
        spine.clock_spine(dim, 0, 200, 1, max_rows=10)
    with pytest.raises(TypeError):
        spine.build_spine("clock", dim=dim, start=0, end=200)
    with pytest.raises(ValueError):
        spine.build_spine(spine.ClockSpine(50), dim=dim, start=5, end=5)


@pytest.mark.parametrize("chunk", [50, 86_400_000_000])
def test_alignment(spark, chunk):
    events = spark.createDataFrame([("x", "s", t) for t in (59, 60, 119, 120)], "exchange string, symbol string, ts_event_us long")
    grid = spark.createDataFrame([("x", "s", 60), ("x", "s", 120), ("x", "s", None)], "exchange string, symbol string, ts_spine_us long")
    got = asof.align_to_spine(events, grid, chunk_us=chunk).orderBy("ts_event_us").collect()
    assert [r["ts_spine_us"] for r in got] == [60, 120, 120, None]
    back = asof.align_to_spine(events, grid, direction="backward", chunk_us=chunk).orderBy("ts_event_us").collect()
    assert [r["ts_spine_us"] for r in back] == [None, 60, 60, 120]


@pytest.mark.parametrize("chunk", [3, 10, 86_400_000_000])
def test_asof_equals_brute_force(spark, chunk):
    import random

    rng = random.Random(chunk)
    left = [(rng.choice("ab"), rng.randint(0, 60), i) for i in range(80)]
    right = [(rng.choice("ab"), rng.randint(0, 60), 1000 + i) for i in range(30)]
    l = spark.createDataFrame(left, "k string, t long, i long")  # noqa: E741
    r = spark.createDataFrame(right, "k string, u long, v long")
    got = {x["i"]: x["v"] for x in asof.asof_backward(l, r, ["k"], "t", "u", ["v"], tie=["v"], chunk_us=chunk).collect()}
    near = {x["i"]: (x["u2"], x["gap_us"]) for x in asof.asof_nearest(l, r.select("k", "u", F.col("u").alias("u2")).distinct(), ["k"], "t", "u", ["u2"], 5, chunk_us=chunk).collect()}
    for k, t, i in left:
        before = [(u, v) for kk, u, v in right if kk == k and u <= t]
        assert got[i] == (max(before)[1] if before else None)
        gaps = sorted((abs(u - t), u) for kk, u, _ in right if kk == k)
        assert near[i] == ((gaps[0][1], gaps[0][0]) if gaps and gaps[0][0] <= 5 else (None, None))
    assert len(got) == len(near) == 80


def test_running_sum_over_chunks(spark):
    rows = [("a", i, 1, i, i * i - 50) for i in range(100)]
    df = spark.createDataFrame(rows, "k string, t long, f long, n long, m long")
    got = running_sum(df, ["k"], ["t", "f", "n"], F.col("m"), "s", chunk_us=9).orderBy("t").collect()
    total = 0
    for r in got:
        total += r["m"]
        assert int(r["s"]) == total


def test_bars(trades):
    aligned = asof.align_to_spine(trades.withColumn("side", F.lit("buy")), spine.volume_spine(trades, 100 * S))
    got = {(r["symbol"], r["ts_spine_us"]): r for r in bars.trade_bars(aligned).collect()}
    first = got[("BTC", 20)]
    assert (first["open"], first["close"], first["volume"], first["trade_count"], first["flow_imbalance"]) == (10.0, 10.0, 40.0, 1, 1.0)
    second = got[("BTC", 30)]
    assert (second["volume"], second["trade_count"], second["vwap"], second["price_std"]) == (80.0, 2, 10.0, 0.0)
    assert ("BTC", None) not in got


def test_phases(spark):
    at = lambda t: micros(f"2024-01-02T{t}:00+08:00")
    cases = [("09:20", "szse", None, "PRE_OPEN"), ("09:31", "szse", None, "MORNING"), ("14:58", "szse", None, "CLOSING"), ("14:58", "sse", None, "CLOSED"), ("15:10", "szse", None, "CLOSED"), ("15:10", "szse", "growth_board", "AFTER_HOURS"), ("12:00", "SSE", None, "NOON_BREAK"), ("10:00", "x", None, None)]
    rows = spark.createDataFrame([(i, at(t), e, m) for i, (t, e, m, _) in enumerate(cases)], "i int, ts_event_us long, exchange string, m string")
    got = add_trading_phase(rows, market_type="m").orderBy("i").collect()
    assert [r["trading_phase"] for r in got] == [c[3] for c in cases]
    assert filter_by_phase(rows, ["morning"]).count() == 1
    with pytest.raises(ValueError):
        filter_by_phase(rows, [])


def test_rank_correlation_and_windows(spark):
    import pandas as pd

    frame = pd.DataFrame({"x": [1, 2, 2, 5, 4, None, 7, 7] * 20, "y": [3.0, 1.0, 2.0, 2.0, 8.0, 1.0, 9.0, 4.0] * 20})
    frame["y"] += frame.index // 30
    df = spark.createDataFrame(frame.astype(object).where(frame.notna(), None), "x double, y double")
    got = stats.rank_ic(df, ["x"], "y").first()
    ranks = frame.dropna().rank()
    assert abs(got["ic"] - ranks["x"].corr(ranks["y"])) < 1e-12 and got["n"] == 140
    assert stats.rank_ic(df, ["x"], "y", least=1000).count() == 0
    rows = spark.createDataFrame([("k", i, float(v)) for i, v in enumerate([5, 1, 4, 2, 3])], "k string, t long, v double")
    w = windows.by(["k"], ["t"])
    out = rows.select("t", windows.rolling_median("v", 3, w).alias("m"), windows.rolling_mean("v", 2, w, least=1).alias("a")).orderBy("t").collect()
    assert [r["m"] for r in out] == [None, None, 4.0, 2.0, 3.0] and out[0]["a"] == 5.0


def test_cotrading(spark):
    rows = [("a", 0, 1, 2 * S), ("b", 900, 2, S), ("b", 5000, 3, S), ("c", 5999, 4, 4 * S), ("a", 100_000, 5, S)]
    df = spark.createDataFrame([(s, t, 1, n, q) for s, t, n, q in rows], "symbol string, ts_event_us long, file_id long, file_seq long, qty long")
    got = {(r["sym_i"], r["sym_j"]): r for r in cotrading.similarity(df).collect()}
    assert set(got) == {("a", "b"), ("b", "c")}
    assert abs(got[("a", "b")]["similarity"] - 1 / 6**0.5) < 1e-12
    graph = cotrading.edges(cotrading.similarity(df), 3, top_k=1)
    assert cotrading.centrality(graph).count() in (0, 2)


def test_crowded_buckets_are_dealt_to_several_tasks(spark, monkeypatch):
    import random

    rng = random.Random(5)
    rows = [(rng.choice("abc"), rng.choice([7, rng.randint(0, 20_000)]), 1, i, rng.randint(1, 9) * S) for i in range(400)]
    df = spark.createDataFrame(rows, "symbol string, ts_event_us long, file_id long, file_seq long, qty long")
    order = ["sym_i", "sym_j", "ts_i", "id_i", "qty_j"]
    whole = [tuple(r) for r in cotrading.matched_trades(df).select(*order).orderBy(*order).collect()]
    monkeypatch.setattr(cotrading, "CROWDED", 20)
    assert [tuple(r) for r in cotrading.matched_trades(df).select(*order).orderBy(*order).collect()] == whole


@pytest.mark.parametrize("block", [3, 40, 100_000])
def test_cotrading_equals_all_pairs_without_forming_them(spark, monkeypatch, block):
    import random

    rng = random.Random(block)
    rows = [(rng.choice("abcd"), rng.choice([500, rng.randint(0, 9_000)]), 1, rng.randint(0, 400), rng.choice([1, 5, 2**62])) for _ in range(250)]
    rows = list({r[:4]: r for r in rows}.values())
    rows += rows[:9] + [("z", 500, 1, 900, None), ("a", None, 1, 901, 1), (None, 500, 1, 902, 1), ("y", 90_000, 1, 903, 1)]
    df = spark.createDataFrame(rows, "symbol string, ts_event_us long, file_id long, file_seq long, qty long").repartition(5)
    df = df.withColumn("file_id", F.lit(1).cast("long"))  # a constant, as in the views, which Spark folds into the order of the blocks
    monkeypatch.setattr(cotrading, "CROWDED", block)
    whole = {r for r in rows if r[0] is not None and r[1] is not None}
    want, sums = set(), {}
    for i in whole:
        for symbol in {r[0] for r in whole if r[0] > i[0]}:
            near = [(abs(j[1] - i[1]), j[1], j[2:4], j[4]) for j in whole if j[0] == symbol and abs(j[1] - i[1]) <= 300]
            if near:
                qty = min(near, key=lambda x: x[:3])[3]
                want.add((i[0], symbol, i[1], i[2:4], i[4], qty))
                n, shared = sums.get((i[0], symbol), (0, 0))
                sums[i[0], symbol] = n + 1, shared + min(q for q in (i[4], qty) if q is not None)
    got = [(*r[:3], tuple(r[3]), *r[4:]) for r in cotrading.matched_trades(df, 300).collect()]
    assert len(got) == len(want) and set(got) == want
    pairs = cotrading._shared(df, 300)
    assert {(r["sym_i"], r["sym_j"]): (r["matches"], int(r["shared"])) for r in pairs.collect()} == sums
    assert "FlatMapGroupsInArrow" in pairs._jdf.queryExecution().optimizedPlan().toString()


def test_graph_reads_the_kept_sums_and_not_the_trades_again(spark):
    rows = [("abc"[i % 3], 700 * i, 1, i, S) for i in range(30)]
    df = spark.createDataFrame(rows, "symbol string, ts_event_us long, file_id long, file_seq long, qty long")
    similar = cotrading.similarity(df)
    for found in (similar, cotrading.edges(similar, 3), cotrading.centrality(cotrading.edges(similar, 3))):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "Generate" not in plan and "FlatMapGroupsInArrow" not in plan


def test_similarity_is_kept_whole_so_that_clusters_read_no_trades(spark, tmp_path):
    rows = [("abc"[i % 3], 700 * i, 1, i, S) for i in range(30)]
    df = spark.createDataFrame(rows, "symbol string, ts_event_us long, file_id long, file_seq long, qty long")
    df.write.parquet(str(tmp_path / "trades"))
    similar = cotrading.similarity(spark.read.parquet(str(tmp_path / "trades")))
    for found in (similar, cotrading.edges(similar, 3), cotrading.clusters(similar, k=2)):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "parquet" not in plan and "LogicalRDD" in plan


def most_rows(spark, run):
    """The rows of ``run`` and the most rows that leave one operator of its plans, as Spark counts them."""
    store, bus = spark._jsparkSession.sharedState().statusStore(), spark.sparkContext._jsc.sc().listenerBus()
    bus.waitUntilEmpty()
    known = store.executionsList()
    last = known.last().executionId() if known.nonEmpty() else -1
    rows = sorted(tuple(r) for r in run().collect())
    bus.waitUntilEmpty()
    found = store.executionsList()
    most = 0
    for number in (found.apply(i).executionId() for i in range(found.size())):
        if number > last:
            values, nodes = store.executionMetrics(number), store.planGraph(number).allNodes()
            metrics = [nodes.apply(i).metrics() for i in range(nodes.size())]
            ids = [m.apply(k).accumulatorId() for m in metrics for k in range(m.size()) if m.apply(k).name() == "number of output rows"]
            most = max([most, *(int(values.apply(a).replace(",", "")) for a in ids if values.contains(a))])
    return rows, most


@pytest.mark.parametrize("query", ["cotrading_edges", "cotrading_centrality"])
def test_cotrading_queries_work_in_proportion_to_trades_inside_the_tolerance(spark, monkeypatch, tmp_path, query):
    monkeypatch.setattr(cotrading, "CROWDED", 500)
    found, most = [], []
    for copies in (4, 16):  # timestamps repeated, ids shifted
        c = F.col("id") % 500
        rows = spark.range(500 * copies).select(
            F.col("id").alias("event_id"), F.timestamp_micros(F.lit(1_704_067_200_000_000) + c * 7_000_000).alias("ts"),
            F.floor(c * c / 7).alias("user_id"), F.lit("click").alias("event_type"), F.lit(1.5).alias("value"), F.format_string('{"k": %d}', c % 90).alias("props"),
        )
        rows.write.parquet(str(tmp_path / f"{copies}/events.parquet"))
        rows, n = most_rows(spark, lambda d=str(tmp_path / str(copies)): registry.QUERIES[query](spark, d))
        found.append(rows)
        most.append(n)
    assert found[0] and [r[:2] for r in found[0]] == [r[:2] for r in found[1]]
    assert most[0] >= 500 * 4 and most[1] <= 1.1 * 4 * most[0]


def test_clusters_of_a_graph_with_two_parts(spark):
    rows = [(a, b, 1, w) for g, w in (("abcd", 0.9), ("xyz", 0.4)) for a in g for b in g if a < b] + [("d", "x", 1, 0.001)]
    similar = spark.createDataFrame(rows, "sym_i string, sym_j string, matches long, similarity double")
    found = {}
    for r in cotrading.clusters(similar, k=2).collect():
        found.setdefault(r["cluster"], set()).add(r["symbol"])
    assert sorted(map(sorted, found.values())) == [list("abcd"), list("xyz")]


def test_returns_of_volatility_buckets_cross_midnight(spark):
    import math

    day = 86_400_000_000
    rows = [("x", "s", t, 1, i, p * S) for i, (t, p) in enumerate([(day - 2, 1), (day - 1, 2), (day, 8), (day + 1, 4), (3 * day, 2), (3 * day + 1, 6)])]
    trades = spark.createDataFrame(rows, "exchange string, symbol string, ts_event_us long, file_id long, file_seq long, price long")
    got = [r["bucket_vol"] for r in bars.vol_buckets(trades).orderBy("bucket_us").collect()]
    spread = lambda a, b: abs(math.log(a) - math.log(b)) / 2**0.5
    assert got[0] is None and all(abs(x - y) < 1e-12 for x, y in zip(got[1:], [spread(4, 0.5), spread(0.5, 3)], strict=True))


def test_adaptive_spine_follows_the_regime(spark):
    rows = [("x", "s", 1, t, 1, t, S) for t in range(0, 1200, 10)]
    trades = spark.createDataFrame(rows, "exchange string, symbol string, symbol_id long, ts_event_us long, file_id long, file_seq long, qty long")
    regimes = spark.createDataFrame([("x", "s", 200, 50), ("x", "s", 500, 200)], "exchange string, symbol string, bucket_us long, bar_threshold int")
    got = points(spine.adaptive_spine(trades, regimes, S // 10, bucket_us=100), "s")
    shares = [(2 if t < 300 else 4 if t < 600 else 1) for t in range(0, 1200, 10)]
    total, expected = 0, []
    for t, s in zip(range(0, 1200, 10), shares, strict=True):
        if (total + s) // 20 > total // 20:
            expected.append(t)
        total += s
    assert got == expected


def test_p_values_are_those_of_student(spark):
    import math

    def exact(t, f):  # tail by the density's integral
        c = math.exp(math.lgamma((f + 1) / 2) - math.lgamma(f / 2)) / math.sqrt(f * math.pi)
        steps = 20_000
        width = abs(t) / steps
        return 1 - 2 * sum(c * (1 + (width * (i + 0.5)) ** 2 / f) ** (-(f + 1) / 2) * width for i in range(steps))

    cases = [(t, f) for t in (0.0, 0.5, -1.3, 2.1, 4.0) for f in (8, 30, 100, 1000)]
    df = spark.createDataFrame([(float(t), f) for t, f in cases], "t double, f long")
    for r in df.select("t", "f", stats.p_value(F.col("t"), F.col("f")).alias("p")).collect():
        assert abs(r["p"] - exact(r["t"], r["f"])) < (0.003 if r["f"] < 100 else 1e-4)


def test_percent_ranks_equal_windows(spark):
    import random

    from pyspark.sql import Window

    rng = random.Random(3)
    rows = [(rng.choice("ab"), rng.choice([None, 0.0, 0.0, rng.random()])) for _ in range(300)] + [("one", 5.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    both = stats.percent_ranks(df, ["k"], {"v": "got"}).withColumn("expected", F.percent_rank().over(Window.partitionBy("k").orderBy("v")))
    assert both.count() == 301 and both.where("abs(got - expected) > 1e-12").count() == 0


@pytest.mark.parametrize("chunk", [3, 1 << 18])
def test_order_flow_is_the_same_in_any_chunks(spark, chunk):
    import random

    from marketloom.operators import signals

    rng = random.Random(9)
    rows = [("s", i % 2, c, q, rng.choice(["BUY", "BUY", "SELL", "X"]), rng.choice(["ADD", "CANCEL"]), rng.randint(1, 9)) for c in range(3) for i, q in enumerate(sorted(rng.sample(range(100), 40)))]
    df = spark.createDataFrame(rows, "symbol string, trading_date int, channel_id int, channel_seq long, side string, event_kind string, qty long")
    got = {r["trading_date"]: r for r in signals.l3_order_flow(df, chunk).collect()}
    for day in (0, 1):
        own = sorted(r[2:] for r in rows if r[1] == day)
        signs = [{"BUY": 1, "SELL": -1}.get(r[2], 0) for r in own]
        longest = run = 1
        for a, b in zip(signs, signs[1:]):
            run = run + 1 if a == b else 1
            longest = max(longest, run)
        adds = [(s * r[4], r[4]) for s, r in zip(signs, own, strict=True) if r[3] == "ADD"]
        assert got[day]["longest_run"] == longest
        assert abs(got[day]["ofi"] - sum(a for a, _ in adds) / sum(b for _, b in adds)) < 1e-12
        kinds = [r[3] for r in own]
        assert got[day]["add_cancel_ratio"] == kinds.count("ADD") / kinds.count("CANCEL")
        pairs = []
        for channel in range(3):
            walk = [s for s, r in zip(signs, own, strict=True) if r[0] == channel]
            pairs += zip(walk[5:], walk)
        assert abs(got[day]["sign_correlation"] - np.corrcoef(*zip(*pairs))[0, 1]) < 1e-12


def test_long_clock_spines_come_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(spine, "TICKS", 3)
    dim = spark.createDataFrame([("x", "s", 1, 0, OPEN_END)], "exchange string, exchange_symbol string, symbol_id long, valid_from_ts_us long, valid_until_ts_us long")
    assert points(spine.clock_spine(dim, 5, 103, 10), "s") == list(range(10, 101, 10))


@pytest.mark.parametrize("name,most", [("volume_bars", 3), ("rank_ic", 4), ("fx_perp_spot", 4), ("align_to_spine", 3)])
def test_queries_read_their_source_few_times(spark, name, most):
    """Scans of files in the plans of all jobs that a query runs."""
    from marketloom.core import storage
    from marketloom.plans import registry

    seen, real = [], storage.kept

    def scans(df):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        return plan.count("Relation [") + plan.count("RelationV2")

    import marketloom.operators.spine as s1
    import marketloom.operators.stats as s2

    def counted(df):
        seen.append(scans(df))
        return real(df)

    before = s1.kept, s2.kept, registry.kept
    s1.kept = s2.kept = registry.kept = counted
    try:
        seen.append(scans(registry.QUERIES[name](spark, "/root/testdata/sf0.001")))
    finally:
        s1.kept, s2.kept, registry.kept = before
    assert max(seen) <= most and sum(seen) >= 1
