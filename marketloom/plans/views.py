"""Market tables seen in the driver's tables, each with the same definition in SQL.

``events`` becomes trades, quotes, ticker, liquidations, options, orders and snapshots; the symbols in it become a
dimension of two versions each, one symbol with a gap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..core.specs import OPEN_END, SCALE

DAY = 86_400_000_000
JAN_1 = 1_704_067_200_000_000
JAN_10, JAN_15, JAN_20 = JAN_1 + 9 * DAY, JAN_1 + 14 * DAY, JAN_1 + 19 * DAY
#: Volume and notional of one bar.
VOLUME, DOLLARS = 1_000 * SCALE, 50_000 * SCALE
SLOW_VOLUME = 5_000 * SCALE


def events(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.read.parquet(f"{d}/events.parquet")
    k = F.get_json_object("props", "$.k").cast("long")
    return rows.select(
        F.when(F.col("event_id") % 2 == 0, "binance-futures").otherwise("okx-futures").alias("exchange"),
        F.to_date("ts").alias("trading_date"),
        F.concat(F.lit("S"), (F.col("user_id") % 5).cast("string")).alias("symbol"),
        (F.col("user_id") % 5 + 1 + 100 * (F.col("event_id") % 2)).cast("long").alias("symbol_id"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_event_us"),
        F.lit(1).cast("long").alias("file_id"),
        (F.col("event_id") + 1).alias("file_seq"),
        "event_type",
        F.rint(F.col("value") * 1e9).cast("long").alias("p"),
        k.alias("k"),
    )


_PREFIX = ("exchange", "trading_date", "symbol", "symbol_id", "ts_event_us", "file_id", "file_seq")


def trades(spark: SparkSession, d: str) -> DataFrame:
    side = F.when(F.col("event_type").isin("purchase", "signup"), "buy").when(F.col("event_type") == "error", "unknown").otherwise("sell")
    return events(spark, d).select(*_PREFIX, side.alias("side"), F.col("p").alias("price"), ((F.col("k") + 1) * SCALE).alias("qty"))


def quotes(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d)
    crossed = F.col("file_seq") % 97 == 0
    half = F.when(crossed, -10_000_000).otherwise(10_000_000)
    return e.withColumn("ts_event_us", F.col("ts_event_us") - 500_000).select(
        *_PREFIX,
        (F.col("p") - half).alias("bid_price"),
        ((F.col("k") + 1) * SCALE).alias("bid_qty"),
        (F.col("p") + half).alias("ask_price"),
        ((100 - F.col("k")) * SCALE).alias("ask_qty"),
    )


def ticker(spark: SparkSession, d: str) -> DataFrame:
    return events(spark, d).where("event_type = 'view'").select(
        *_PREFIX,
        F.col("p").alias("mark_price"),
        (F.col("p") + (F.col("k") - 50) * 10_000_000).alias("index_price"),
        ((F.col("k") + 1) * 10 * SCALE).alias("open_interest"),
        (F.col("k") / 1e4).alias("funding_rate"),
        ((99 - F.col("k")) / 1e4).alias("predicted_funding_rate"),
    )


def liquidations(spark: SparkSession, d: str) -> DataFrame:
    side = F.when(F.col("event_type") == "purchase", "buy").when(F.col("event_type") == "click", "sell").otherwise("none")
    rows = events(spark, d).where("event_type in ('purchase', 'click', 'error')")
    return rows.select(
        *_PREFIX, F.col("k").cast("string").alias("liquidation_id"), side.alias("side"), F.col("p").alias("price"), ((F.col("k") + 1) * SCALE).alias("qty")
    )


def options(spark: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.col("k") % 3 == 0, "call").when(F.col("k") % 3 == 1, "put").otherwise("Call")
    return events(spark, d).select(
        *_PREFIX,
        kind.alias("option_type"),
        F.col("p").alias("strike"),
        (F.lit(JAN_1) + (F.col("k") % 6) * 7 * DAY + 40 * DAY).alias("expiration_ts_us"),
        ((F.col("k") + 1) * SCALE).alias("open_interest"),
        F.col("p").alias("mark_price"),
        (F.col("k") * 1.5).alias("mark_iv"),
        F.col("symbol").alias("underlying_index"),
        ((F.col("k") - 50) / 49.0).alias("delta"),
        (F.col("k") / 1000.0).alias("gamma"),
    )


def orders(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d)
    exchange = F.when(F.col("file_seq") % 2 == 0, "sse").otherwise("szse")
    return e.withColumn("exchange", exchange).select(
        *_PREFIX,
        (F.col("k") % 3).cast("int").alias("channel_id"),
        F.col("file_seq").alias("channel_seq"),
        F.when(F.col("k") % 10 != 0, F.col("file_seq")).alias("channel_biz_seq"),
        F.when(F.col("k") % 15 != 0, F.col("file_seq")).alias("symbol_order_seq"),
        F.when(F.col("event_type").isin("error", "signup"), "CANCEL").otherwise("ADD").alias("event_kind"),
        F.when(F.col("k") % 2 == 0, "BUY").otherwise("SELL").alias("side"),
        F.col("p").alias("price"),
        ((F.col("k") + 1) * SCALE).alias("qty"),
    )


def snapshots(spark: SparkSession, d: str) -> DataFrame:
    step = lambda sign: F.transform(F.sequence(F.lit(1), F.lit(10)), lambda i: F.col("p") + sign * i.cast("long") * 10_000_000)
    return events(spark, d).select(
        *_PREFIX,
        step(-1).alias("bid_price_levels"),
        F.transform(F.sequence(F.lit(1), F.lit(10)), lambda i: F.col("k") + i.cast("long")).alias("bid_qty_levels"),
        step(1).alias("ask_price_levels"),
        F.transform(F.sequence(F.lit(1), F.lit(10)), lambda i: 100 - F.col("k") + i.cast("long")).alias("ask_qty_levels"),
    )


def dim(spark: SparkSession, d: str) -> DataFrame:
    pairs = events(spark, d).select("exchange", "symbol", "symbol_id").distinct()
    gap = F.col("symbol") == "S4"
    version = lambda start, end, tick, plus, now: F.struct(
        (F.col("symbol_id") + plus).alias("symbol_id"),
        F.lit(start).cast("long").alias("valid_from_ts_us") if not isinstance(start, F.Column) else start.cast("long").alias("valid_from_ts_us"),
        F.lit(end).cast("long").alias("valid_until_ts_us") if not isinstance(end, F.Column) else end.cast("long").alias("valid_until_ts_us"),
        F.lit(now).alias("is_current"),
        F.lit(tick).cast("long").alias("tick_size"),
    )
    first = version(JAN_1, F.when(gap, JAN_10).otherwise(JAN_15), SCALE // 100, 0, False)
    second = version(F.when(gap, JAN_20).otherwise(JAN_15), OPEN_END, SCALE // 50, 1000, True)
    rows = pairs.select("exchange", "symbol", F.explode(F.array(first, second)).alias("v"))
    return rows.select(
        "v.symbol_id",
        "exchange",
        F.col("symbol").alias("exchange_symbol"),
        F.concat(F.lower("symbol"), F.lit("-usdt")).alias("canonical_symbol"),
        F.lit("perpetual").alias("market_type"),
        F.col("symbol").alias("base_asset"),
        F.lit("USDT").alias("quote_asset"),
        "v.valid_from_ts_us",
        "v.valid_until_ts_us",
        "v.is_current",
        "v.tick_size",
        F.lit(SCALE).cast("long").alias("lot_size"),
        F.lit(None).cast("long").alias("contract_size"),
        F.col("v.valid_from_ts_us").alias("updated_at_ts_us"),
    )


def with_more_versions(known: DataFrame, versions: list[tuple]) -> DataFrame:
    """The dimension with more versions of each symbol: (added to the id, start, end, current, tick, condition)."""
    first = known.where("not is_current")
    out = known
    for plus, start, end, now, tick, condition in versions:
        extra = {
            "symbol_id": (F.col("symbol_id") + plus).cast("long"),
            "valid_from_ts_us": F.lit(start).cast("long"),
            "valid_until_ts_us": F.lit(end).cast("long"),
            "is_current": F.lit(now),
            "tick_size": F.lit(tick).cast("long"),
            "updated_at_ts_us": F.lit(start).cast("long"),
        }
        out = out.unionByName(first.where(condition).withColumns(extra))
    return out


#: Versions that overlap those of ``dim``, and versions that break each of its rules; lists for ``with_more_versions``.
OVERLAPPING = [
    (2000, JAN_1 + 5 * DAY, JAN_15 + 2 * DAY, False, 77, "true"),
    (3000, JAN_1 + 7 * DAY, JAN_1 + 8 * DAY, False, 88, "true"),
]
#: Another version of the same id, which the join of metadata can meet twice.
REPEATED = [(0, JAN_1 + 5 * DAY, JAN_20 + 2 * DAY, False, 77, "exchange_symbol <> 'S3'")]
BROKEN = [
    (4000, JAN_10, JAN_10, False, 1, "exchange_symbol = 'S0' AND exchange = 'okx-futures'"),
    (5000, JAN_20 + 3 * DAY, OPEN_END, True, 1, "exchange_symbol = 'S1'"),
    (1, JAN_20 + 50 * DAY, JAN_20 + 60 * DAY, False, 1, "exchange_symbol = 'S2'"),
]


def more_versions_sql(versions: list[tuple]) -> str:
    return "SELECT * FROM dim" + "".join(
        " UNION ALL SELECT * REPLACE (CAST(symbol_id + {0} AS BIGINT) AS symbol_id, CAST({1} AS BIGINT) AS valid_from_ts_us,"
        " CAST({2} AS BIGINT) AS valid_until_ts_us, {3} AS is_current, CAST({4} AS BIGINT) AS tick_size) FROM dim WHERE NOT is_current AND {5}".format(*x)
        for x in versions
    )


_E = "exchange, trading_date, symbol, symbol_id, ts_event_us, file_id, file_seq"
CTES = f"""
e AS (
  SELECT CASE WHEN event_id % 2 = 0 THEN 'binance-futures' ELSE 'okx-futures' END AS exchange, CAST(ts AS DATE) AS trading_date,
         'S' || (user_id % 5) AS symbol, CAST(user_id % 5 + 1 + 100 * (event_id % 2) AS BIGINT) AS symbol_id,
         epoch_us(ts) AS ts_event_us, CAST(1 AS BIGINT) AS file_id, event_id + 1 AS file_seq, event_type,
         CAST(round_even(value * 1e9, 0) AS BIGINT) AS p, CAST(json_extract(props, '$.k') AS BIGINT) AS k
  FROM events),
trades AS (
  SELECT {_E}, CASE WHEN event_type IN ('purchase', 'signup') THEN 'buy' WHEN event_type = 'error' THEN 'unknown' ELSE 'sell' END AS side,
         p AS price, (k + 1) * {SCALE} AS qty FROM e),
quotes AS (
  SELECT exchange, trading_date, symbol, symbol_id, ts_event_us - 500000 AS ts_event_us, file_id, file_seq,
         p - (CASE WHEN file_seq % 97 = 0 THEN -10000000 ELSE 10000000 END) AS bid_price, (k + 1) * {SCALE} AS bid_qty,
         p + (CASE WHEN file_seq % 97 = 0 THEN -10000000 ELSE 10000000 END) AS ask_price, (100 - k) * {SCALE} AS ask_qty FROM e),
ticker AS (
  SELECT {_E}, p AS mark_price, p + (k - 50) * 10000000 AS index_price, (k + 1) * 10 * {SCALE} AS open_interest,
         k / 1e4 AS funding_rate, (99 - k) / 1e4 AS predicted_funding_rate FROM e WHERE event_type = 'view'),
liquidations AS (
  SELECT {_E}, CAST(k AS VARCHAR) AS liquidation_id,
         CASE event_type WHEN 'purchase' THEN 'buy' WHEN 'click' THEN 'sell' ELSE 'none' END AS side, p AS price, (k + 1) * {SCALE} AS qty
  FROM e WHERE event_type IN ('purchase', 'click', 'error')),
options AS (
  SELECT {_E}, CASE k % 3 WHEN 0 THEN 'call' WHEN 1 THEN 'put' ELSE 'Call' END AS option_type, p AS strike,
         {JAN_1} + (k % 6) * 7 * {DAY} + 40 * {DAY} AS expiration_ts_us, (k + 1) * {SCALE} AS open_interest, p AS mark_price,
         CAST(k * 1.5 AS DOUBLE) AS mark_iv, symbol AS underlying_index, (k - 50) / 49e0 AS delta, k / 1000e0 AS gamma FROM e),
orders_cn AS (
  SELECT CASE WHEN file_seq % 2 = 0 THEN 'sse' ELSE 'szse' END AS exchange, trading_date, symbol, symbol_id, ts_event_us, file_id, file_seq,
         CAST(k % 3 AS INTEGER) AS channel_id, file_seq AS channel_seq, CASE WHEN k % 10 <> 0 THEN file_seq END AS channel_biz_seq,
         CASE WHEN k % 15 <> 0 THEN file_seq END AS symbol_order_seq,
         CASE WHEN event_type IN ('error', 'signup') THEN 'CANCEL' ELSE 'ADD' END AS event_kind,
         CASE WHEN k % 2 = 0 THEN 'BUY' ELSE 'SELL' END AS side, p AS price, (k + 1) * {SCALE} AS qty FROM e),
pairs AS (SELECT DISTINCT exchange, symbol, symbol_id FROM e),
dim AS (
  SELECT symbol_id, exchange, symbol AS exchange_symbol, lower(symbol) || '-usdt' AS canonical_symbol, 'perpetual' AS market_type,
         symbol AS base_asset, 'USDT' AS quote_asset, CAST({JAN_1} AS BIGINT) AS valid_from_ts_us,
         CAST(CASE WHEN symbol = 'S4' THEN {JAN_10} ELSE {JAN_15} END AS BIGINT) AS valid_until_ts_us, false AS is_current,
         CAST({SCALE // 100} AS BIGINT) AS tick_size, CAST({SCALE} AS BIGINT) AS lot_size FROM pairs
  UNION ALL
  SELECT symbol_id + 1000, exchange, symbol, lower(symbol) || '-usdt', 'perpetual', symbol, 'USDT',
         CAST(CASE WHEN symbol = 'S4' THEN {JAN_20} ELSE {JAN_15} END AS BIGINT), CAST({OPEN_END} AS BIGINT), true,
         CAST({SCALE // 50} AS BIGINT), CAST({SCALE} AS BIGINT) FROM pairs),
run AS (
  SELECT *, sum(qty) OVER w AS s, sum((CAST(price AS HUGEINT) * qty) // {SCALE}) OVER w AS m
  FROM trades WINDOW w AS (PARTITION BY exchange, symbol ORDER BY ts_event_us, file_id, file_seq ROWS UNBOUNDED PRECEDING)),
v_spine AS (
  SELECT exchange, symbol, symbol_id, ts_event_us AS ts_spine_us FROM run WHERE s // {VOLUME} > (s - qty) // {VOLUME}),
slow_spine AS (
  SELECT exchange, symbol, symbol_id, ts_event_us AS ts_spine_us FROM run WHERE s // {SLOW_VOLUME} > (s - qty) // {SLOW_VOLUME}),
d_spine AS (
  SELECT exchange, symbol, symbol_id, ts_event_us AS ts_spine_us FROM run
  WHERE m // {DOLLARS} > (m - (CAST(price AS HUGEINT) * qty) // {SCALE}) // {DOLLARS}),
aligned AS (
  SELECT t.*, x.ts_spine_us FROM trades t ASOF LEFT JOIN v_spine x
  ON t.exchange = x.exchange AND t.symbol = x.symbol AND t.ts_event_us < x.ts_spine_us),
slow_aligned AS (
  SELECT t.*, x.ts_spine_us FROM trades t ASOF LEFT JOIN slow_spine x
  ON t.exchange = x.exchange AND t.symbol = x.symbol AND t.ts_event_us < x.ts_spine_us),
"""
BARS_SQL = """
  SELECT exchange, symbol, ts_spine_us, arg_min(price, ts_event_us) / 1e9 AS open, max(price) / 1e9 AS high, min(price) / 1e9 AS low,
         arg_max(price, ts_event_us) / 1e9 AS close, CAST(sum(qty) AS DOUBLE) / 1e9 AS volume, count(*) AS trade_count,
         CAST(sum(CAST(price AS HUGEINT) * qty) AS DOUBLE) / CAST(sum(qty) AS DOUBLE) / 1e9 AS vwap,
         CAST(sum(CASE side WHEN 'buy' THEN qty WHEN 'sell' THEN -qty ELSE 0 END) AS DOUBLE) / CAST(sum(qty) AS DOUBLE) AS flow_imbalance,
         CAST(sum(qty) AS DOUBLE) / count(*) / 1e9 AS avg_size, median(qty) / 1e9 AS median_size, stddev_samp(price / 1e9) AS price_std
  FROM {0} WHERE ts_spine_us IS NOT NULL GROUP BY ALL"""
CTES += f"bars AS ({BARS_SQL.format('aligned')}), slow_bars AS ({BARS_SQL.format('slow_aligned')}),"
CTES += """
t_aligned AS (
  SELECT t.*, x.ts_spine_us FROM ticker t ASOF LEFT JOIN v_spine x
  ON t.exchange = x.exchange AND t.symbol = x.symbol AND t.ts_event_us < x.ts_spine_us),
f_bars AS (
  SELECT exchange, symbol, ts_spine_us, arg_min(funding_rate, ts_event_us) AS funding_open, arg_max(funding_rate, ts_event_us) AS funding_close,
         avg(funding_rate) AS funding_mean, arg_max(funding_rate, ts_event_us) - arg_min(funding_rate, ts_event_us) AS funding_step,
         arg_max(predicted_funding_rate, ts_event_us) AS predicted_funding_close, arg_min(open_interest, ts_event_us) / 1e9 AS oi_open,
         arg_max(open_interest, ts_event_us) / 1e9 AS oi_close,
         (arg_max(open_interest, ts_event_us) - arg_min(open_interest, ts_event_us)) / 1e9 AS oi_change
  FROM t_aligned WHERE ts_spine_us IS NOT NULL GROUP BY ALL),
rets AS (
  SELECT *, ln(price / 1e9) - lag(ln(price / 1e9)) OVER (PARTITION BY exchange, symbol ORDER BY ts_event_us, file_id, file_seq) AS ret
  FROM trades WHERE price > 0),
vol AS (
  SELECT exchange, symbol, ts_event_us // 300000000 * 300000000 AS bucket_us, stddev_samp(ret) AS bucket_vol,
         stddev_samp(ret) * sqrt(12e0) AS hourly_vol, min(ts_event_us) AS first_ts_us, max(ts_event_us) AS last_ts_us, count(*) AS trade_count
  FROM rets GROUP BY ALL)
"""


def sql(body: str) -> str:
    """A statement with all views in front; those that it does not name cost nothing."""
    return f"WITH {CTES.strip()} {body}" if not body.lstrip().startswith(",") else f"WITH {CTES.strip()}{body.lstrip()}"
