"""Registered queries of the normalisers, the ingest rules and the dimension's loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..core.specs import SCALE, normalize
from ..operators import dimension, validation
from ..sources import cn, crypto, files, ingest
from . import views as v
from .registry import query

_LEFT = "lower(trim(exchange)) AS exchange, symbol, coalesce(timestamp, local_timestamp) AS ts_event_us, local_timestamp AS ts_local_us"
_FIX = lambda c: f"CAST(round_even(CAST({c} AS DOUBLE) * 1e9, 0) AS BIGINT)"
#: Raw rows as a crypto vendor writes them, and as an exchange's files have them.
RAW = (
    ", raw AS (SELECT ' ' || upper(exchange) || ' ' AS exchange, symbol, CASE WHEN file_seq % 7 <> 0 THEN ts_event_us END AS timestamp, ts_event_us + 5 AS local_timestamp,"
    " 't' || file_seq AS id, CASE WHEN k % 2 = 0 THEN 'BUY' ELSE 'Sell' END AS side, p / 1e9 AS price, (k + 1) / 8e0 AS amount, k AS update_id, k % 2 = 0 AS is_snapshot,"
    " p / 1e9 - 0.5 AS bid_price, p / 1e9 + 0.5 AS ask_price, p / 1e9 AS mark_price, k / 1e4 AS funding_rate, CASE WHEN k % 2 = 0 THEN 'CALL' ELSE 'put' END AS type,"
    " k + 0.25 AS strike_price, ts_event_us + 86400000000 AS expiration, k / 100e0 AS delta, file_seq FROM e)"
)


def raw(spark, d):
    e = v.events(spark, d)
    return e.select(
        F.concat(F.lit(" "), F.upper("exchange"), F.lit(" ")).alias("exchange"),
        "symbol",
        F.when(F.col("file_seq") % 7 != 0, F.col("ts_event_us")).alias("timestamp"),
        (F.col("ts_event_us") + 5).alias("local_timestamp"),
        F.concat(F.lit("t"), F.col("file_seq").cast("string")).alias("id"),
        F.when(F.col("k") % 2 == 0, "BUY").otherwise("Sell").alias("side"),
        (F.col("p") / 1e9).alias("price"),
        ((F.col("k") + 1) / 8).alias("amount"),
        F.col("k").alias("update_id"),
        (F.col("k") % 2 == 0).alias("is_snapshot"),
        (F.col("p") / 1e9 - 0.5).alias("bid_price"),
        (F.col("p") / 1e9 + 0.5).alias("ask_price"),
        ((F.col("k") + 1) / 8).alias("bid_amount"),
        ((F.col("k") + 2) / 8).alias("ask_amount"),
        (F.col("p") / 1e9).alias("mark_price"),
        (F.col("k") / 1e4).alias("funding_rate"),
        F.when(F.col("k") % 2 == 0, "CALL").otherwise("put").alias("type"),
        (F.col("k") + 0.25).alias("strike_price"),
        (F.col("ts_event_us") + v.DAY).alias("expiration"),
        (F.col("k") / 100.0).alias("delta"),
        "file_seq",
    )


@query(RAW + f" SELECT {_LEFT}, id AS trade_id, lower(side) AS side, {_FIX('price')} AS price, {_FIX('amount')} AS qty FROM raw")
def norm_trades(spark, d):
    return crypto.trades(raw(spark, d)).drop("is_buyer_maker", "parse_error", "file_seq")


@query(
    RAW + f" SELECT {_LEFT}, {_FIX('bid_price')} AS bid_price, {_FIX('amount')} AS bid_qty, {_FIX('ask_price')} AS ask_price,"
    f" {_FIX('(update_id + 2) / 8e0')} AS ask_qty, update_id AS seq_num FROM raw"
)
def norm_quotes(spark, d):
    return crypto.quotes(raw(spark, d)).drop("parse_error", "file_seq")


@query(
    RAW + f" SELECT {_LEFT}, update_id AS book_seq, lower(side) AS side, {_FIX('price')} AS price, {_FIX('amount')} AS qty, is_snapshot FROM raw"
)
def norm_book(spark, d):
    return crypto.book(raw(spark, d)).drop("parse_error", "file_seq")


@query(RAW + f" SELECT {_LEFT}, {_FIX('mark_price')} AS mark_price, CAST(NULL AS BIGINT) AS index_price, round(funding_rate, 6) AS funding_rate FROM raw")
def norm_ticker(spark, d):
    out = crypto.ticker(raw(spark, d)).withColumn("funding_rate", F.round("funding_rate", 6))
    return out.select("exchange", "symbol", "ts_event_us", "ts_local_us", "mark_price", "index_price", "funding_rate")


@query(RAW + f" SELECT {_LEFT}, id AS liquidation_id, lower(side) AS side, {_FIX('price')} AS price, {_FIX('amount')} AS qty FROM raw")
def norm_liquidations(spark, d):
    return crypto.liquidations(raw(spark, d)).drop("parse_error", "file_seq")


@query(
    RAW + f" SELECT {_LEFT}, lower(type) AS option_type, {_FIX('strike_price')} AS strike, expiration AS expiration_ts_us, {_FIX('mark_price')} AS mark_price,"
    " round(delta, 6) AS delta FROM raw"
)
def norm_options(spark, d):
    out = crypto.options(raw(spark, d)).withColumn("delta", F.round("delta", 6))
    return out.select("exchange", "symbol", "ts_event_us", "ts_local_us", "option_type", "strike", "expiration_ts_us", "mark_price", "delta")


def _cn_time(e):
    local = F.from_utc_timestamp(F.timestamp_micros("ts_event_us"), "Asia/Shanghai")
    return F.concat(F.date_format(local, "yyyyMMddHHmmss"), F.lpad((F.col("k") * 10).cast("string"), 3, "0"))


_SECONDS = "ts_event_us // 1000000 * 1000000 + k * 10000"
_CN_SIDE = "CASE WHEN k % 3 = 0 THEN 'BUY' WHEN k % 3 = 1 THEN 'SELL' ELSE 'UNKNOWN' END"


def _cn_raw(spark, d):
    e = v.events(spark, d)
    return e.select(
        F.lit("1").alias("symbol"),
        _cn_time(e).alias("TransactTime"),
        F.col("file_seq").cast("string").alias("ApplSeqNum"),
        F.element_at(F.array(F.lit("1"), F.lit("2"), F.lit("x")), (F.col("k") % 3 + 1).cast("int")).alias("Side"),
        F.element_at(F.array(F.lit("1"), F.lit("2"), F.lit("U")), (F.col("k") % 3 + 1).cast("int")).alias("OrdType"),
        F.element_at(F.array(F.lit("F"), F.lit("4"), F.lit("f ")), (F.col("k") % 3 + 1).cast("int")).alias("ExecType"),
        (F.col("p") / 1e9).cast("string").alias("Price"),
        (F.col("k") + 1).cast("string").alias("OrderQty"),
        (F.col("k") + 1).cast("string").alias("Qty"),
        F.col("k").cast("string").alias("BidApplSeqNum"),
        F.lit("0").alias("OfferApplSeqNum"),
        F.lit("3").alias("ChannelNo"),
        F.col("file_seq"),
        F.col("k"),
    )


@query(f"SELECT file_seq, {_SECONDS} AS ts_event_us FROM e")
def cn_timestamp(spark, d):
    return _cn_raw(spark, d).select("file_seq", cn.timestamp_us("TransactTime").alias("ts_event_us"))


@query(
    f"SELECT '000001' AS symbol, {_SECONDS} AS ts_event_us, CAST(3 AS INTEGER) AS channel_id, file_seq AS channel_seq, {_CN_SIDE} AS side,"
    " CASE WHEN k % 3 = 0 THEN 'MARKET' WHEN k % 3 = 1 THEN 'LIMIT' ELSE 'UNKNOWN' END AS order_type, 'ADD' AS event_kind,"
    f" {_FIX('p / 1e9')} AS price, (k + 1) * {SCALE} AS qty FROM e"
)
def norm_cn_orders(spark, d):
    out = cn.orders(_cn_raw(spark, d), "szse")
    return out.select("symbol", "ts_event_us", "channel_id", "channel_seq", "side", "order_type", "event_kind", "price", "qty")


@query(
    f"SELECT file_seq AS channel_seq, k AS bid_order_ref, CASE WHEN k % 3 = 1 THEN 'CANCEL' ELSE 'TRADE' END AS event_kind, {_FIX('p / 1e9')} AS price,"
    f" (k + 1) * {SCALE} AS qty FROM e"
)
def norm_cn_ticks(spark, d):
    return cn.ticks(_cn_raw(spark, d), "szse").select("channel_seq", "bid_order_ref", "event_kind", "price", "qty")


@query(
    "SELECT file_seq AS snapshot_seq, CASE WHEN k % 5 = 0 THEN 'expected 10 levels' END AS parse_error, CASE WHEN k % 5 <> 0 THEN (k + 1) * 1000000000 END AS best_bid,"
    " CASE WHEN k % 5 <> 0 THEN k * 10 + 45 END AS bid_qty,"
    " CASE WHEN k % 5 <> 0 THEN array_to_string(list_transform(range(10), lambda i: (k + 1) * 1000000000 - i * 500000000), ',') END AS bid_prices,"
    " CASE WHEN k % 5 <> 0 THEN array_to_string(list_transform(range(10), lambda i: k * 1000000000 + 1500000000 + i * 1000000000), ',') END AS ask_prices,"
    " CASE WHEN k % 5 <> 0 THEN array_to_string(list_transform(range(10), lambda i: k + i), ',') END AS bid_qtys,"
    " CASE WHEN k % 5 <> 0 THEN array_to_string(range(10), ',') END AS ask_qtys FROM e"
)
def norm_cn_snapshots(spark, d):
    rows = _cn_raw(spark, d)
    levels = F.when(F.col("k") % 5 == 0, 2).otherwise(10)
    ladder = lambda f: F.to_json(F.transform(F.sequence(F.lit(0), levels - 1), f))
    made = rows.select(
        "symbol",
        F.col("file_seq").alias("MsgSeqNum"),
        F.col("TransactTime").alias("QuotTime"),
        ladder(lambda i: F.col("k") + 1.0 - i * 0.5).alias("BidPrice"),
        ladder(lambda i: F.col("k") + i).alias("BidOrderQty"),
        ladder(lambda i: F.col("k") + 1.5 + i).alias("OfferPrice"),
        ladder(lambda i: i).alias("OfferOrderQty"),
    )
    out = cn.snapshots(made, "szse")
    good = F.col("parse_error").isNull()
    total = F.aggregate("bid_qty_levels", F.lit(0).cast("long"), lambda a, x: a + x)
    ladders = {"bid_prices": "bid_price_levels", "ask_prices": "ask_price_levels", "bid_qtys": "bid_qty_levels", "ask_qtys": "ask_qty_levels"}
    return out.select(
        "snapshot_seq", "parse_error", F.when(good, F.col("bid_price_levels")[0]).alias("best_bid"), F.when(good, total).alias("bid_qty"),
        *(F.when(good, F.array_join(F.col(c).cast("array<string>"), ",")).alias(name) for name, c in ladders.items()),
    )


@query(
    ", r AS (SELECT file_seq % 20 AS f, *, CASE WHEN side NOT IN ('buy', 'sell', 'unknown') OR price <= 0 OR qty <= 0 THEN 'invalid_trade_side_or_values'"
    " WHEN NOT EXISTS (SELECT 1 FROM dim m WHERE m.exchange = trades.exchange AND m.exchange_symbol = trades.symbol AND m.valid_from_ts_us <= ts_event_us"
    " AND ts_event_us < m.valid_until_ts_us) THEN 'missing_pit_symbol_coverage' END AS reason FROM trades)"
    " SELECT f AS file_id, count(*) AS rows_total, count(CASE WHEN reason IS NULL THEN 1 END) AS rows_written, count(reason) AS rows_quarantined,"
    " min(CASE WHEN reason IS NULL THEN trading_date END) AS trading_date_min, coalesce(array_to_string(list_sort(list_distinct(list(reason))), '+'), '') AS reasons FROM r GROUP BY f"
)
def ingest_counts(spark, d):
    """The ingest job's rules over files of one batch, without its writes."""
    rows = v.trades(spark, d).withColumn("file_id", F.col("file_seq") % 20).drop("symbol_id", "trading_date")
    marked = ingest.mark_rows(rows, "trades", v.dim(spark, d), parser=lambda df: df)
    return marked.counts().select("file_id", "rows_total", "rows_written", "rows_quarantined", "trading_date_min", "reasons")


@query("SELECT file_id % 5 AS file_id, count(*) AS n FROM (SELECT file_seq % 5 AS file_id FROM quotes WHERE bid_price > ask_price OR bid_price <= 0 OR ask_price <= 0) GROUP BY 1")
def quarantine_split(spark, d):
    rejected = validation.split(v.quotes(spark, d), "quotes")[1]
    return rejected.groupBy((F.col("file_seq") % 5).alias("file_id")).agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS place FROM orders", views=False)
def file_seq(spark, d):
    """Places of rows in the order of reading; the rows are sorted first, so that SQL can tell the same."""
    orders = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", "o_orderpriority").orderBy("o_orderkey")
    return files.with_file_seq(orders, by="o_orderpriority", output="place").select("o_orderkey", "place")


@query("SELECT exchange, symbol, trading_date, symbol_id, ts_event_us, side, price, qty, CAST(NULL AS VARCHAR) AS trade_id FROM trades")
def normalize_to_spec(spark, d):
    out = normalize(v.trades(spark, d), "trades")
    return out.select("exchange", "symbol", "trading_date", "symbol_id", "ts_event_us", "side", "price", "qty", "trade_id")


@query(f"SELECT DISTINCT exchange, exchange_symbol, {v.JAN_1} AS valid_from_ts_us, true AS is_current FROM dim")
def dim_bootstrap(spark, d):
    snapshot = v.dim(spark, d).where("is_current")
    return dimension.bootstrap(snapshot, v.JAN_1).select("exchange", "exchange_symbol", "valid_from_ts_us", "is_current")


@query(
    "SELECT exchange, exchange_symbol, valid_from_ts_us FROM dim WHERE exchange <> 'okx-futures'"
    f" UNION ALL SELECT DISTINCT exchange, exchange_symbol, {v.JAN_1} FROM dim WHERE exchange = 'okx-futures'"
)
def dim_refresh(spark, d):
    current = v.dim(spark, d)
    history = dimension.bootstrap(current.where("is_current and exchange = 'okx-futures'"), v.JAN_1)
    return dimension.refresh(current, history).select("exchange", "exchange_symbol", "valid_from_ts_us")


@query()
def dim_symbol_id(spark, d):
    """Stable ids; blake2b has no SQL."""
    return dimension.with_ids(v.dim(spark, d).drop("symbol_id")).select("exchange", "exchange_symbol", "valid_from_ts_us", "symbol_id")


def _listing(spark, d):
    customers = spark.read.parquet(f"{d}/customer.parquet")
    key = F.col("c_custkey")
    return customers.select(
        F.concat(key.cast("string"), F.lit(".SX")).alias("ts_code"),
        key.cast("string").alias("symbol"),
        F.when(key % 4 != 0, F.col("c_name")).alias("name"),
        F.element_at(F.array(F.lit("SSE"), F.lit("szse "), F.lit("BSE")), (key % 3 + 1).cast("int")).alias("exchange"),
        F.when(key % 5 == 0, "科创板").otherwise("主板").alias("market"),
        F.element_at(F.array(F.lit("L"), F.lit("P"), F.lit("D"), F.lit("U")), (key % 4 + 1).cast("int")).alias("list_status"),
        F.lit("20200102").alias("list_date"),
        F.when(key % 8 == 2, "20230405").when(key % 8 == 6, "bad").alias("delist_date"),
    )


_L = "(SELECT c_custkey AS k, c_name FROM customer)"


@query(
    "SELECT CASE WHEN k % 3 = 0 THEN 'sse' ELSE 'szse' END AS exchange, CAST(k AS VARCHAR) AS exchange_symbol, CASE WHEN k % 4 <> 0 THEN c_name ELSE CAST(k AS VARCHAR) END AS base_asset,"
    f" CAST(CASE WHEN k % 5 = 0 THEN {200 * SCALE} ELSE {100 * SCALE} END AS BIGINT) AS lot_size, CAST(1577923200000000 AS BIGINT) AS valid_from_ts_us,"
    f" CAST(CASE WHEN k % 8 = 2 THEN 1680652800000000 WHEN k % 8 = 6 THEN -1 ELSE {2**63 - 1} END AS BIGINT) AS valid_until_ts_us, k % 4 <> 2 AS is_current"
    f" FROM {_L} WHERE k % 3 <> 2 AND k % 4 <> 3",
    views=False,
)
def dim_from_listing(spark, d):
    out = dimension.from_listing(_listing(spark, d), 5).withColumn("valid_until_ts_us", F.coalesce("valid_until_ts_us", F.lit(-1).cast("long")))
    return out.select("exchange", "exchange_symbol", "base_asset", "lot_size", "valid_from_ts_us", "valid_until_ts_us", "is_current")


@query(
    "SELECT CASE WHEN k % 3 = 0 THEN 'sse' ELSE 'szse' END AS exchange, CAST(k AS VARCHAR) AS exchange_symbol, CAST(1680652800000000 AS BIGINT) AS delisted_at_ts_us"
    f" FROM {_L} WHERE k % 3 <> 2 AND k % 8 = 2",
    views=False,
)
def dim_delistings(spark, d):
    return dimension.delistings(_listing(spark, d))


@query(
    "SELECT exchange, symbol, CAST(NULL AS VARCHAR) AS liquidation_id, qty FROM trades UNION ALL SELECT exchange, symbol, liquidation_id, qty FROM liquidations"
)
def union_diagonal(spark, d):
    a = v.trades(spark, d).select("exchange", "symbol", "qty")
    return a.unionByName(v.liquidations(spark, d).select("exchange", "symbol", "qty", "liquidation_id"), allowMissingColumns=True)
