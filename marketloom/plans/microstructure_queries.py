"""Registered queries on microstructure, with views of order lives and book updates, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..core.specs import SCALE
from ..operators import microstructure as m
from ..operators import stats, windows
from ..operators import spine as spines
from . import views as v
from .registry import BY, TS, query

#: Quantity of a volume bucket, and buckets of a mean.
BUCKET, OVER = 200 * SCALE, 50
HOUR_US = 3_600_000_000


# Views: three consecutive events are one order's life; odd and even prices are two sides of a book.


def _lives(spark: SparkSession, d: str) -> DataFrame:
    e = v.events(spark, d)
    event = F.col("file_seq") - 1
    ref = (F.floor(event / 3) + 1).cast("long")
    return e.select(
        F.when(ref % 2 == 0, "szse").otherwise("sse").alias("exchange"),
        "trading_date",
        F.concat(F.lit("S"), (ref % 5).cast("string")).alias("symbol"),
        (F.floor(F.col("ts_event_us") / HOUR_US) * HOUR_US + event % 3 * 50_000 + F.col("k") * 1000).cast("long").alias("ts_event_us"),
        (ref % 3).cast("int").alias("channel_id"),
        ref.alias("ref"),
        (event % 3).alias("step"),
        "k",
        F.when(ref % 4 < 2, "BUY").otherwise("SELL").alias("side"),
    )


def life_orders(spark: SparkSession, d: str) -> DataFrame:
    """ADD of every order, CANCEL of some."""
    rows = _lives(spark, d).where("step = 0 OR (step = 2 AND k % 2 = 0)")
    kind = F.when(F.col("step") == 0, "ADD").otherwise("CANCEL")
    qty = F.when(F.col("step") == 0, 200).otherwise(F.col("k") + 1) * SCALE
    return rows.withColumns({"order_ref": F.col("ref"), "event_kind": kind, "qty": qty})


def life_ticks(spark: SparkSession, d: str) -> DataFrame:
    """Trades against the order before, and cancellations that the tick table tells."""
    rows = _lives(spark, d).where("step = 1 OR (step = 2 AND k % 2 = 1)")
    buy = F.col("side") == "BUY"
    other = F.when(F.col("step") == 1, F.col("ref") - 30)
    return rows.withColumns(
        {
            "bid_order_ref": F.when(buy, F.col("ref")).otherwise(other),
            "ask_order_ref": F.when(buy, other).otherwise(F.col("ref")),
            "event_kind": F.when(F.col("step") == 1, "TRADE").otherwise("CANCEL"),
            "qty": (F.col("k") + 1) * SCALE,
        }
    )


def book_updates(spark: SparkSession, d: str) -> DataFrame:
    e = v.events(spark, d)
    bid = F.col("k") % 2 == 0
    level = F.floor(F.col("k") / 10).cast("long")
    return e.select(
        *BY,
        "ts_event_us",
        "file_id",
        "file_seq",
        F.when(bid, "bid").otherwise("ask").alias("side"),
        (F.when(bid, 100 - level).otherwise(101 + level) * SCALE).cast("long").alias("price"),
        F.when(F.col("event_type") == "error", 0).otherwise((F.col("file_seq") % 50 + 1) * SCALE).cast("long").alias("qty"),
        ((F.col("event_type") == "signup") & (F.col("file_seq") % 7 == 0)).alias("is_snapshot"),
    )


_LIVES = f"""
, lives0 AS (SELECT e.*, (file_seq - 1) // 3 + 1 AS ref, (file_seq - 1) % 3 AS step FROM e),
lives AS (SELECT CASE WHEN ref % 2 = 0 THEN 'szse' ELSE 'sse' END AS x, trading_date, 'S' || (ref % 5) AS s, ref % 3 AS channel_id, ref, step, k,
  ts_event_us // {HOUR_US} * {HOUR_US} + step * 50000 + k * 1000 AS t, CASE WHEN ref % 4 < 2 THEN 'BUY' ELSE 'SELL' END AS side FROM lives0),
happened AS (
  SELECT x, s, trading_date, channel_id, ref, t, CASE WHEN step = 0 THEN 'ADD' WHEN step = 1 THEN 'TRADE' ELSE 'CANCEL' END AS kind, side,
         CASE WHEN step = 0 THEN 200 ELSE k + 1 END * {SCALE} AS qty FROM lives
  UNION ALL
  SELECT x, s, trading_date, channel_id, ref - 30, t, 'TRADE', CASE side WHEN 'BUY' THEN 'SELL' ELSE 'BUY' END, (k + 1) * {SCALE} FROM lives
  WHERE step = 1 AND ref <> 30),
orders_lived AS (
  SELECT x AS exchange, s AS symbol, trading_date, channel_id, ref AS order_ref,
         coalesce(max(CASE WHEN kind = 'ADD' THEN side END), max(side)) AS side, min(CASE WHEN kind = 'ADD' THEN t END) AS added_ts_us,
         CAST(sum(CASE WHEN kind = 'ADD' THEN qty ELSE 0 END) AS BIGINT) AS added_qty, min(CASE WHEN kind = 'CANCEL' THEN t END) AS first_cancel_ts_us,
         CAST(sum(CASE WHEN kind = 'CANCEL' THEN qty ELSE 0 END) AS BIGINT) AS cancelled_qty,
         CAST(sum(CASE WHEN kind = 'TRADE' THEN qty ELSE 0 END) AS BIGINT) AS traded_qty, max(t) AS last_ts_us FROM happened GROUP BY ALL)
"""


@query(
    _LIVES + "SELECT *, added_qty - cancelled_qty - traded_qty AS residual_qty, first_cancel_ts_us - added_ts_us AS lifetime_us FROM orders_lived"
)
def order_lifetimes(spark, d):
    return m.order_lifetimes(life_orders(spark, d), life_ticks(spark, d))


@query(
    _LIVES + ", f AS (SELECT *, added_ts_us IS NOT NULL AS added, coalesce(first_cancel_ts_us - added_ts_us BETWEEN 0 AND 99999, false) AS short FROM orders_lived)"
    " SELECT symbol, trading_date, count_if(added) AS n_orders, count_if(short) AS n_fleeting, count_if(short) / nullif(count_if(added)::DOUBLE, 0) AS fleeting_ratio,"
    " sum(CASE WHEN short THEN cancelled_qty ELSE 0 END)::DOUBLE / nullif(sum(CASE WHEN added THEN added_qty END)::DOUBLE, 0) AS fleeting_qty_ratio,"
    " sum(CASE WHEN added THEN added_qty - cancelled_qty - traded_qty ELSE 0 END)::DOUBLE / 1e9 AS residual_qty, count_if(NOT added) AS n_unmatched,"
    " count_if(added AND side = 'BUY') / nullif(count_if(added AND side = 'SELL')::DOUBLE, 0) AS arrival_asymmetry FROM f GROUP BY symbol, trading_date",
    "fleeting_ratio fleeting_qty_ratio residual_qty arrival_asymmetry",
)
def fleeting_liquidity(spark, d):
    return m.fleeting_liquidity(m.order_lifetimes(life_orders(spark, d), life_ticks(spark, d)))


# Volume buckets

_SPLIT = (
    f", cut AS (SELECT exchange, symbol, ts_event_us, side, s - qty AS a, s AS z, unnest(range(CAST((s - qty) // {BUCKET} AS BIGINT), CAST((s - 1) // {BUCKET} AS BIGINT) + 1)) AS bucket FROM run WHERE qty > 0),"
    f" part AS (SELECT *, least(z, (bucket + 1) * {BUCKET}) - greatest(a, bucket * {BUCKET}) AS q FROM cut),"
    " bucketed AS (SELECT exchange, symbol, bucket, CAST(sum(CASE side WHEN 'buy' THEN q ELSE 0 END) AS BIGINT) AS buy_qty,"
    " CAST(sum(CASE side WHEN 'sell' THEN q ELSE 0 END) AS BIGINT) AS sell_qty, CAST(sum(q) AS BIGINT) AS bucket_qty,"
    " min(ts_event_us) AS first_ts_us, max(ts_event_us) AS last_ts_us FROM part GROUP BY ALL)"
)
_GAP = f"abs(buy_qty - sell_qty) / CAST({BUCKET} AS DOUBLE)"
_OVER = f"OVER (PARTITION BY exchange, symbol ORDER BY bucket ROWS BETWEEN {OVER - 1} PRECEDING AND CURRENT ROW)"


def _buckets(spark: SparkSession, d: str) -> DataFrame:
    return m.volume_buckets(v.trades(spark, d), BUCKET)


@query(_SPLIT + " SELECT * FROM bucketed")
def volume_buckets(spark, d):
    return _buckets(spark, d)


@query(
    _SPLIT + f" SELECT *, {_GAP} AS imbalance, CASE WHEN count(*) {_OVER} >= {OVER} THEN avg({_GAP}) {_OVER} END AS vpin FROM bucketed WHERE bucket_qty = {BUCKET}",
    "imbalance vpin",
)
def vpin(spark, d):
    return m.vpin(_buckets(spark, d), BUCKET, OVER)


@query(
    _SPLIT + f" SELECT exchange, symbol, CAST(make_timestamp(last_ts_us) AS DATE) AS trading_date, avg({_GAP}) AS vpin, count(*) AS n_buckets FROM bucketed"
    f" WHERE bucket_qty = {BUCKET} GROUP BY ALL",
    "vpin",
)
def vpin_daily(spark, d):
    return m.vpin_daily(_buckets(spark, d), BUCKET)


# Impact and trends

_STEPS = (
    ", steps AS (SELECT exchange, symbol, trading_date, ts_event_us // 60000000 AS i, arg_max(price, ts_event_us) / 1e9 AS close,"
    " CAST(sum(CASE side WHEN 'buy' THEN qty WHEN 'sell' THEN -qty ELSE 0 END) AS DOUBLE) / 1e9 AS q FROM trades GROUP BY ALL),"
    " moves AS (SELECT *, close - lag(close) OVER (PARTITION BY exchange, symbol, trading_date ORDER BY i) AS move FROM steps)"
)


@query(
    _STEPS + " SELECT exchange, symbol, trading_date, CASE WHEN var_pop(q) > 0 THEN regr_slope(move, q) END AS kyle_lambda,"
    " CASE WHEN var_pop(q) > 0 THEN regr_intercept(move, q) END AS intercept, CASE WHEN var_pop(q) > 0 THEN regr_r2(move, q) END AS r2, count(*) AS n"
    " FROM moves WHERE move IS NOT NULL GROUP BY ALL",
    "kyle_lambda intercept r2",
)
def kyle_lambda(spark, d):
    return m.kyle_lambda(v.trades(spark, d))


_LAST_30 = "OVER (PARTITION BY exchange ORDER BY ts_event_us RANGE BETWEEN 1800000000 PRECEDING AND CURRENT ROW)"


@query(
    f"SELECT file_seq, round(CASE WHEN var_pop(x) {_LAST_30} > 0 THEN regr_slope(y, x) {_LAST_30} END, 4) + 0e0 AS trade_size_trend, count(*) {_LAST_30} AS n_in_frame"
    f" FROM (SELECT *, qty / 1e9 AS y, ((ts_event_us - {v.JAN_1}) // 1000) / 1e3 AS x FROM trades)"
)
def trade_size_trend(spark, d):
    found = m.trade_size_trend(v.trades(spark, d), keys=("exchange",))
    return found.select("file_seq", F.round("trade_size_trend", 4).alias("trade_size_trend"), "n_in_frame")


# Large trades

_LIMITS = (
    ", limits AS (SELECT symbol, trading_date, quantile_cont(qty, 0.95) AS threshold FROM {0} GROUP BY ALL)"
    " SELECT symbol, trading_date, max(threshold) / 1e9 AS threshold, CAST(sum(CASE WHEN qty > threshold THEN qty ELSE 0 END) AS DOUBLE)"
    " / CAST(sum(qty) AS DOUBLE) AS large_volume_ratio, count_if(qty > threshold) AS n_large, count(*) AS n FROM {0} JOIN limits USING (symbol, trading_date) GROUP BY ALL"
)


@query(_LIMITS.format("trades"), "threshold large_volume_ratio")
def large_trade_ratio_p95(spark, d):
    return m.above_quantile(v.trades(spark, d))


@query(", adds AS (SELECT * FROM orders_cn WHERE event_kind = 'ADD')" + _LIMITS.format("adds"), "threshold large_volume_ratio")
def large_orders_p95(spark, d):
    return m.above_quantile(v.orders(spark, d).where("event_kind = 'ADD'"))


@query(
    "SELECT event_type, quantile_cont(value, 0.01) AS q01, median(value) AS q50, quantile_cont(value, 0.99) AS q99 FROM events GROUP BY event_type",
    "q01 q50 q99",
    views=False,
)
def exact_quantiles(spark, d):
    """Quantiles of raw rows, in intervals of 512 rows, so that ranges are cut at any size of table."""
    rows = spark.read.parquet(f"{d}/events.parquet")
    return stats.quantiles(rows, "value", {"q01": 0.01, "q50": 0.5, "q99": 0.99}, ["event_type"], small=512)


# Flow, spreads and intensity

_SIGNED = "CAST(sum(CASE side WHEN 'buy' THEN qty WHEN 'sell' THEN -qty ELSE 0 END) AS DOUBLE)"


@query(
    f"SELECT symbol, trading_date, {_SIGNED} / 1e9 AS aggressor_volume, count_if(qty <= {10 * SCALE}) / count(*)::DOUBLE AS retail_intensity, count(*) AS n"
    " FROM trades GROUP BY symbol, trading_date",
    "aggressor_volume retail_intensity",
)
def trade_flow(spark, d):
    return m.trade_flow(v.trades(spark, d), 10 * SCALE)


@query(
    f"SELECT symbol, trading_date, {_SIGNED} / CAST(sum(qty) AS DOUBLE) AS imbalance, CAST(sum(qty) AS DOUBLE) / 1e9 AS volume FROM trades"
    f" WHERE (ts_event_us + {8 * HOUR_US}) % {v.DAY} // 60000000 BETWEEN 870 AND 899 GROUP BY symbol, trading_date",
    "imbalance volume",
)
def late_session_imbalance(spark, d):
    return m.window_imbalance(v.trades(spark, d), 870, 900, 8 * HOUR_US)


@query(
    "SELECT exchange, symbol, trading_date, avg((ask_price - bid_price)::DOUBLE / (ask_price + bid_price) * 200) AS spread_pct, count(*) AS n FROM quotes"
    " WHERE bid_price > 0 AND ask_price > 0 AND ask_price >= bid_price GROUP BY ALL",
    "spread_pct",
)
def spread_regime(spark, d):
    return m.spread_regime(v.quotes(spark, d))


@query(
    f", st AS (SELECT exchange, symbol, ts_event_us // {HOUR_US} * {HOUR_US} AS step_us, sum(qty) AS q FROM trades GROUP BY ALL),"
    " sl AS (SELECT *, lag(step_us) OVER o AS ls, lag(q) OVER o AS lq FROM st WINDOW o AS (PARTITION BY exchange, symbol ORDER BY step_us))"
    f" SELECT exchange, symbol, step_us, q::DOUBLE / 1e9 AS volume, (q - CASE WHEN ls = step_us - {HOUR_US} THEN lq WHEN ls IS NOT NULL THEN 0 END)::DOUBLE / 1e9 / 3600 AS acceleration FROM sl",
    "volume acceleration",
)
def volume_acceleration(spark, d):
    return m.volume_acceleration(v.trades(spark, d), HOUR_US)


_LAST_5 = "OVER (PARTITION BY exchange ORDER BY ts_event_us RANGE BETWEEN 300000000 PRECEDING AND CURRENT ROW)"


@query(
    f"SELECT file_seq, count(*) {_LAST_5} / 300e0 AS trade_intensity, CAST(sum(qty) {_LAST_5} AS DOUBLE) / 1e9 AS recent_volume FROM trades",
    "trade_intensity recent_volume",
)
def trade_intensity(spark, d):
    return m.trade_intensity(v.trades(spark, d), keys=("exchange",)).select("file_seq", "trade_intensity", "recent_volume")


# Depth at the touch

_BOOK = f"""
, book AS (SELECT exchange, symbol, ts_event_us AS t, file_id, file_seq, CASE WHEN k % 2 = 0 THEN 'bid' ELSE 'ask' END AS side,
  CASE WHEN k % 2 = 0 THEN 100 - k // 10 ELSE 101 + k // 10 END * {SCALE} AS price,
  CASE WHEN event_type = 'error' THEN 0 ELSE file_seq % 50 + 1 END * {SCALE} AS qty, event_type = 'signup' AND file_seq % 7 = 0 AS snap FROM e),
points AS (SELECT DISTINCT exchange, symbol, ts_spine_us AS p FROM v_spine),
reset AS (SELECT points.*, (SELECT max(t) FROM book b WHERE b.exchange = points.exchange AND b.symbol = points.symbol AND snap AND t <= p) AS r FROM points),
levels AS (SELECT b.exchange, b.symbol, p, side, price, arg_max(qty, (t, file_id, file_seq)) AS qty FROM reset x JOIN book b
  ON b.exchange = x.exchange AND b.symbol = x.symbol AND t <= p AND (r IS NULL OR t >= r) GROUP BY ALL),
tops AS (SELECT exchange, symbol, p, max(CASE WHEN side = 'bid' THEN price END) AS bid_price, arg_max(qty, price) FILTER (side = 'bid') AS bid_qty,
  min(CASE WHEN side = 'ask' THEN price END) AS ask_price, arg_min(qty, price) FILTER (side = 'ask') AS ask_qty FROM levels WHERE qty > 0 GROUP BY ALL),
touch AS (SELECT exchange, symbol, p AS ts_spine_us, bid_price, bid_qty, ask_price, ask_qty FROM points LEFT JOIN tops USING (exchange, symbol, p))
"""
_LAST_TOUCH = "lag({0}) OVER (PARTITION BY exchange, symbol ORDER BY ts_spine_us)"


def _gone(side: str, worse: str) -> str:
    price, qty = f"{side}_price", f"{side}_qty"
    old_price, old_qty = _LAST_TOUCH.format(price), _LAST_TOUCH.format(qty)
    first = f"row_number() OVER (PARTITION BY exchange, symbol ORDER BY ts_spine_us) = 1"
    return (
        f"CASE WHEN {first} THEN NULL WHEN {price} = {old_price} THEN {old_qty} - {qty} WHEN {price} IS NULL OR {price} {worse} {old_price} THEN {old_qty}"
        f" WHEN {old_price} IS NOT NULL THEN 0 END AS {side}_depletion"
    )


def _touch(spark: SparkSession, d: str) -> DataFrame:
    return m.touch_depth(book_updates(spark, d), spines.volume_spine(v.trades(spark, d), v.VOLUME), chunk_us=24 * HOUR_US)


@query(_BOOK + "SELECT * FROM touch")
def touch_depth(spark, d):
    return _touch(spark, d)


@query(_BOOK + f"SELECT exchange, symbol, ts_spine_us, {_gone('bid', '<')}, {_gone('ask', '>')} FROM touch")
def touch_depletion(spark, d):
    return m.touch_depletion(_touch(spark, d)).select(*BY, TS, "bid_depletion", "ask_depletion")


# Lead and lag, clusters, volume curve

_LAGS = (
    f", closes AS (SELECT exchange || ':' || symbol AS s, ts_event_us // {HOUR_US} AS step, arg_max(price, ts_event_us) AS close FROM trades WHERE price > 0 GROUP BY ALL),"
    " rs AS (SELECT s, step, ln(close::DOUBLE) - ln(lag(close) OVER (PARTITION BY s ORDER BY step)::DOUBLE) AS ret FROM closes),"
    " pairs2 AS (SELECT DISTINCT 'binance-futures:' || symbol AS leader, 'okx-futures:' || symbol AS follower FROM trades),"
    " correlated AS (SELECT leader, follower, lag, CASE WHEN var_pop(a.ret) > 0 AND var_pop(b.ret) > 0 THEN corr(a.ret, b.ret) END AS correlation, count(*) AS n FROM pairs2 CROSS JOIN (SELECT unnest(range(-6, 7)) AS lag)"
    " JOIN rs a ON a.s = leader JOIN rs b ON b.s = follower AND b.step = a.step + lag WHERE a.ret IS NOT NULL AND b.ret IS NOT NULL GROUP BY ALL)"
)


def _correlated(spark: SparkSession, d: str) -> DataFrame:
    trades = v.trades(spark, d)
    named = trades.withColumn("symbol", F.concat_ws(":", "exchange", "symbol"))
    pairs = trades.select(
        F.concat(F.lit("binance-futures:"), "symbol").alias("leader"), F.concat(F.lit("okx-futures:"), "symbol").alias("follower")
    ).distinct()
    return m.lead_lag(m.step_returns(named, HOUR_US, ("symbol",)), pairs, 6)


@query(_LAGS + " SELECT * FROM correlated", "correlation")
def lead_lag(spark, d):
    return _correlated(spark, d)


@query(
    _LAGS + " SELECT leader, follower, lag, correlation, n FROM (SELECT *, row_number() OVER (PARTITION BY leader, follower ORDER BY abs(round(correlation, 9)) DESC, abs(lag), lag DESC) AS r"
    " FROM correlated WHERE correlation IS NOT NULL) WHERE r = 1",
    "correlation",
)
def best_lag(spark, d):
    return m.best_lag(_correlated(spark, d).withColumn("correlation", F.round("correlation", 9)))


@query(
    ", g AS (SELECT *, CASE WHEN ts_event_us - lag(ts_event_us) OVER o <= 1800000000 THEN 0 ELSE 1 END AS f FROM trades WINDOW o AS (PARTITION BY exchange, symbol ORDER BY ts_event_us, file_id, file_seq)),"
    " c AS (SELECT *, sum(f) OVER (PARTITION BY exchange, symbol ORDER BY ts_event_us, file_id, file_seq ROWS UNBOUNDED PRECEDING) AS i FROM g)"
    " SELECT exchange, symbol, min(ts_event_us) AS start_us, max(ts_event_us) AS end_us, count(*) AS n, CAST(sum(qty) AS BIGINT) AS qty,"
    " CAST(sum(CASE side WHEN 'buy' THEN qty ELSE 0 END) AS DOUBLE) / CAST(sum(qty) AS DOUBLE) AS buy_share FROM c GROUP BY exchange, symbol, i",
    "buy_share",
)
def trade_clusters(spark, d):
    return m.trade_clusters(v.trades(spark, d), 1_800_000_000)


@query(
    f", vs AS (SELECT exchange, symbol, trading_date, CAST(ts_event_us % {v.DAY} // {HOUR_US} AS INTEGER) AS step, sum(qty) AS q FROM trades GROUP BY ALL),"
    " ds AS (SELECT exchange, symbol, trading_date, row_number() OVER (PARTITION BY exchange, symbol ORDER BY trading_date) - 1 AS earlier FROM (SELECT DISTINCT exchange, symbol, trading_date FROM vs)),"
    " ex AS (SELECT vs.*, coalesce(sum(q) OVER (PARTITION BY exchange, symbol, step ORDER BY trading_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE / nullif(earlier, 0) / 1e9 AS expected"
    " FROM vs JOIN ds USING (exchange, symbol, trading_date))"
    " SELECT exchange, symbol, trading_date, step, q::DOUBLE / 1e9 AS volume, expected, q::DOUBLE / 1e9 / nullif(expected, 0) AS participation FROM ex",
    "volume expected participation",
)
def volume_curve(spark, d):
    return m.volume_curve(v.trades(spark, d), HOUR_US)


@query(
    "SELECT file_seq, lag(price, 5) OVER w AS price_5, avg(price) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) / 1e9 AS mean_10, lead(price) OVER w AS next_price"
    " FROM trades WINDOW w AS (PARTITION BY exchange, symbol ORDER BY ts_event_us, file_id, file_seq)",
    "mean_10",
)
def halo_windows(spark, d):
    """Lags, leads and rolling frames over raw trades in stretches of 64 rows."""

    def columns(w):
        mean = F.avg("price").over(w.rowsBetween(-9, 0)) / 1e9
        return {"price_5": F.lag("price", 5).over(w), "mean_10": mean, "next_price": F.lead("price").over(w)}

    found = windows.windowed(v.trades(spark, d), BY, spines.ORDER, columns, back=9, ahead=1, stretch=64)
    return found.select("file_seq", "price_5", "mean_10", "next_price")
