"""Registered queries and their SQL.  Doubles are rounded on both sides, so that sums may meet in any order."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..core.numeric import decode_scaled
from ..core.specs import SCALE
from ..core.storage import kept
from ..core.timeutil import trading_date
from ..operators import asof, bars, cotrading, dimension, features, microstructure, quality, signals, stats, validation, windows
from ..operators import spine as spines
from ..operators.phases import add_trading_phase, filter_by_phase
from ..sources import files, lake, manifest
from . import views as v

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
DIGITS = 6


def query(body: str | None = None, doubles: str = "", views: bool = True):
    """Registers a function under its name; ``body`` is its SQL, ``doubles`` the columns to round."""
    names = doubles.split()

    def add(function):
        def run(spark: SparkSession, d: str) -> DataFrame:
            df = function(spark, d)
            return df.withColumns({c: F.round(c, DIGITS) for c in names}) if names else df

        run.__name__, run.__doc__ = function.__name__, function.__doc__
        QUERIES[function.__name__] = run
        if body is not None:
            replace = f" REPLACE ({', '.join(f'round(CAST({c} AS DOUBLE), {DIGITS}) + 0e0 AS {c}' for c in names)})" if names else ""
            own = body.lstrip()
            inner = f"WITH {own[1:]}" if own.startswith(",") else body  # views of its own
            text = f"SELECT *{replace} FROM ({inner}) AS q" if names else body
            text = re.sub(r"count_if(\(([^()]|\([^()]*\))*\))", r"CAST(count_if\1 AS BIGINT)", text)  # HUGEINT in DuckDB
            ORACLES[function.__name__] = v.sql(text) if views else text
        return run

    return add


def volume_aligned(spark: SparkSession, d: str, threshold: int = v.VOLUME) -> DataFrame:
    trades = v.trades(spark, d)
    return asof.align_to_spine(trades, spines.volume_spine(trades, threshold))


def volume_bars_of(spark: SparkSession, d: str, threshold: int = v.VOLUME) -> DataFrame:
    return bars.trade_bars(volume_aligned(spark, d, threshold))


def funding_bars_of(spark: SparkSession, d: str) -> DataFrame:
    points = spines.volume_spine(v.trades(spark, d), v.VOLUME)
    return bars.funding_bars(asof.align_to_spine(v.ticker(spark, d), points))


_BAR_DOUBLES = "open high low close volume vwap flow_imbalance avg_size median_size price_std"
BY, TS = ("exchange", "symbol"), "ts_spine_us"
_W = "(PARTITION BY exchange, symbol ORDER BY ts_spine_us)"

# Scans and discovery


@query(
    "SELECT exchange, symbol, trading_date, symbol_id, ts_event_us, side, price, qty FROM trades WHERE exchange = 'binance-futures'"
    f" AND symbol = 'S1' AND ts_event_us >= {v.JAN_10} AND ts_event_us < {v.JAN_20}"
)
def load_events(spark, d):
    columns = ["exchange", "symbol", "trading_date", "symbol_id", "ts_event_us", "side", "price", "qty"]
    return lake.select_events(v.trades(spark, d), "trades", " Binance-Futures", "S1", v.JAN_10, v.JAN_20, columns)


@query(
    "SELECT exchange, symbol, symbol_id, ts_event_us, file_id, file_seq, price, qty FROM trades WHERE exchange = 'okx-futures'"
    f" AND symbol IN ('S0', 'S2') AND ts_event_us >= {v.JAN_1} AND ts_event_us < {v.JAN_15}"
)
def load_trades_multi(spark, d):
    return lake.load_trades_multi(v.trades(spark, d), "okx-futures", ["S0", "S2"], v.JAN_1, v.JAN_15)


@query("SELECT exchange, exchange_symbol, symbol_id, valid_from_ts_us, tick_size FROM dim WHERE exchange = 'okx-futures' AND is_current")
def load_symbol_meta(spark, d):
    return lake.load_symbol_meta(
        v.dim(spark, d), "okx-futures", columns=["exchange", "exchange_symbol", "symbol_id", "valid_from_ts_us", "tick_size"]
    )


@query(
    "SELECT symbol_id, exchange, exchange_symbol, canonical_symbol, market_type, base_asset, quote_asset FROM dim"
    f" WHERE exchange = 'okx-futures' AND valid_from_ts_us <= {v.JAN_10} AND {v.JAN_10} < valid_until_ts_us"
    " AND contains(lower(canonical_symbol), 's1-')"
)
def discover_symbols(spark, d):
    return lake.discover_symbols(v.dim(spark, d), "okx-futures", "S1-", as_of=v.JAN_10)


@query("SELECT DISTINCT exchange FROM dim")
def list_exchanges(spark, d):
    return quality.list_exchanges(v.dim(spark, d))


@query(
    "SELECT exchange, exchange_symbol, canonical_symbol, market_type, base_asset, quote_asset, symbol_id FROM dim"
    " WHERE is_current AND base_asset = 'S3'"
)
def list_symbols(spark, d):
    return quality.list_symbols(v.dim(spark, d), base_asset="s3")


@query(
    "SELECT exchange, exchange_symbol, count(*) AS n_versions, min(valid_from_ts_us) AS first_valid_from_us,"
    " arg_max(tick_size, valid_from_ts_us) AS tick_size, max(is_current) AS is_current FROM dim"
    " WHERE exchange = 'okx-futures' AND exchange_symbol = 'S4' GROUP BY ALL"
)
def summarize_symbol(spark, d):
    return quality.summarize_symbol(v.dim(spark, d), "okx-futures", "S4")


@query(
    "SELECT 'trades' AS \"table\", true AS available, CAST(1102 AS BIGINT) AS symbol_id, count(*) AS n, CAST(NULL AS VARCHAR) AS reason"
    " FROM trades WHERE exchange = 'okx-futures' AND symbol = 'S1'"
    " UNION ALL SELECT 'liquidations', true, 1102, count(*), NULL FROM liquidations WHERE exchange = 'okx-futures' AND symbol = 'S1'"
)
def data_coverage(spark, d):
    tables = {"trades": v.trades(spark, d), "liquidations": v.liquidations(spark, d)}
    return quality.data_coverage(tables, v.dim(spark, d), "okx-futures", "S1")


@query(
    "SELECT 'trades' AS \"table\", exchange, symbol, min(trading_date) AS first_date, max(trading_date) AS last_date, count(*) AS n"
    " FROM trades GROUP BY ALL"
)
def coverage(spark, d):
    return quality.coverage(v.trades(spark, d), "trades")


# Projections and filters


@query("SELECT file_seq, price / 1e9 AS price_decoded, qty / 1e9 AS qty_decoded FROM trades", "price_decoded qty_decoded")
def decode_scaled_columns(spark, d):
    return decode_scaled(v.trades(spark, d), "trades").select("file_seq", "price_decoded", "qty_decoded")


@query("SELECT * FROM dim WHERE valid_from_ts_us <= {0} AND {0} < valid_until_ts_us".format(v.JAN_15))
def as_of_filter(spark, d):
    return dimension.as_of(v.dim(spark, d), v.JAN_15).drop("contract_size", "updated_at_ts_us")


def _marked(df: DataFrame, table: str) -> DataFrame:
    return validation.mark(df, table).groupBy(F.coalesce(validation.REASON, F.lit("valid")).alias("reason")).agg(
        F.count("*").alias("n"), F.sum("file_seq").cast("long").alias("seq_sum")
    )


def _marked_sql(table: str, broken: str, reason: str) -> str:
    return (
        f"SELECT CASE WHEN {broken} THEN '{reason}' ELSE 'valid' END AS reason, count(*) AS n, CAST(sum(file_seq) AS BIGINT) AS seq_sum"
        f" FROM {table} GROUP BY 1"
    )


@query(_marked_sql("trades", "side NOT IN ('buy', 'sell', 'unknown') OR price <= 0 OR qty <= 0", "invalid_trade_side_or_values"))
def quarantine_trades(spark, d):
    return _marked(v.trades(spark, d), "trades")


@query(
    _marked_sql("quotes", "bid_price <= 0 OR ask_price <= 0 OR bid_qty < 0 OR ask_qty < 0 OR bid_price > ask_price", "invalid_quote_top_of_book")
)
def quarantine_quotes(spark, d):
    return _marked(v.quotes(spark, d), "quotes")


@query(
    _marked_sql(
        "(SELECT *, CASE side WHEN 'buy' THEN 'bid' WHEN 'sell' THEN 'ask' ELSE side END AS b FROM trades)",
        "b NOT IN ('bid', 'ask') OR price <= 0 OR qty < 0 OR file_seq % 50 = 0",
        "invalid_orderbook_update_values",
    )
)
def quarantine_book(spark, d):
    side = F.when(F.col("side") == "buy", "bid").when(F.col("side") == "sell", "ASK ").otherwise(F.col("side"))
    flag = F.when(F.col("file_seq") % 50 != 0, F.lit(False))
    return _marked(v.trades(spark, d).withColumn("side", side).withColumn("is_snapshot", flag), "orderbook_updates")


@query(_marked_sql("ticker", "mark_price <= 0", "invalid_derivative_ticker_mark_price"))
def quarantine_ticker(spark, d):
    return _marked(v.ticker(spark, d), "derivative_ticker")


@query(_marked_sql("liquidations", "side NOT IN ('buy', 'sell') OR price <= 0 OR qty <= 0", "invalid_liquidation_side_or_values"))
def quarantine_liquidations(spark, d):
    return _marked(v.liquidations(spark, d), "liquidations")


@query(_marked_sql("options", "lower(option_type) NOT IN ('call', 'put') OR strike <= 0 OR expiration_ts_us <= 0", "invalid_options_chain_contract"))
def quarantine_options(spark, d):
    return _marked(v.options(spark, d), "options_chain")


@query(
    _marked_sql("orders_cn", "exchange = 'sse' AND (channel_biz_seq IS NULL OR symbol_order_seq IS NULL)", "missing_sse_order_sequence_fields")
)
def quarantine_cn_sequences(spark, d):
    return _marked(v.orders(spark, d), "cn_order_events")


_LOCAL = "CAST(extract(hour FROM ts + INTERVAL 8 HOUR) * 60 + extract(minute FROM ts + INTERVAL 8 HOUR) AS INTEGER)"
_PHASE = (
    "CASE WHEN m >= 555 AND m < 565 THEN 'PRE_OPEN' WHEN m >= 570 AND m < 690 THEN 'MORNING' WHEN m >= 690 AND m < 780 THEN 'NOON_BREAK'"
    " WHEN m >= 780 AND m < 897 THEN 'AFTERNOON' WHEN m >= 897 AND m < 900 THEN 'CLOSING' ELSE 'CLOSED' END"
)


@query(f"SELECT {_PHASE} AS trading_phase, count(*) AS n FROM (SELECT {_LOCAL} AS m FROM events) GROUP BY 1", views=False)
def trading_phase(spark, d):
    rows = add_trading_phase(v.trades(spark, d), exchange=F.lit("szse"))
    return rows.groupBy("trading_phase").agg(F.count("*").alias("n"))


@query(f"SELECT event_id + 1 AS file_seq FROM (SELECT event_id, {_LOCAL} AS m FROM events) WHERE (m >= 570 AND m < 690) OR (m >= 780 AND m < 897)", views=False)
def filter_phase(spark, d):
    return filter_by_phase(v.trades(spark, d), ["morning", "AFTERNOON"], exchange=F.lit("sse")).select("file_seq")


@query(
    "SELECT file_seq, CAST(CAST(make_timestamp(ts_event_us) AS TIMESTAMP) + INTERVAL 8 HOUR AS DATE) AS local_date FROM trades"
)
def trading_date_local(spark, d):
    return v.trades(spark, d).select("file_seq", trading_date(F.col("ts_event_us"), F.lit("SZSE ")).alias("local_date"))


@query("SELECT * FROM options WHERE gamma > 0.05 AND mark_iv < 100 AND abs(delta) BETWEEN 0.15 AND 0.35", "mark_iv delta gamma")
def high_gamma_filter(spark, d):
    return signals.high_gamma(v.options(spark, d))


# Joins


@query(
    "SELECT t.file_seq, m.symbol_id, CASE WHEN m.symbol_id IS NULL THEN 'missing_pit_symbol_coverage' END AS quarantine_reason"
    " FROM trades t LEFT JOIN dim m ON t.exchange = m.exchange AND t.symbol = m.exchange_symbol"
    " AND m.valid_from_ts_us <= t.ts_event_us AND t.ts_event_us < m.valid_until_ts_us"
)
def pit_coverage(spark, d):
    return dimension.pit_coverage(v.trades(spark, d), v.dim(spark, d)).select("file_seq", "symbol_id", "quarantine_reason")


@query(
    "SELECT t.file_seq, m.tick_size, m.lot_size FROM trades t LEFT JOIN dim m ON t.exchange = m.exchange AND t.symbol_id = m.symbol_id"
    " AND m.valid_from_ts_us <= t.ts_event_us AND t.ts_event_us < m.valid_until_ts_us"
)
def join_symbol_meta(spark, d):
    joined = dimension.join_symbol_meta(v.trades(spark, d), v.dim(spark, d), ["tick_size", "lot_size"])
    return joined.select("file_seq", "tick_size", "lot_size")


_VALID = " AND m.valid_from_ts_us <= t.ts_event_us AND t.ts_event_us < m.valid_until_ts_us GROUP BY t.file_seq"


@query(
    f", m AS ({v.more_versions_sql(v.OVERLAPPING)}) SELECT t.file_seq, arg_min(m.symbol_id, m.valid_from_ts_us) AS symbol_id,"
    " CASE WHEN count(m.symbol_id) = 0 THEN 'missing_pit_symbol_coverage' END AS quarantine_reason"
    f" FROM trades t LEFT JOIN m ON t.exchange = m.exchange AND t.symbol = m.exchange_symbol{_VALID}"
)
def pit_coverage_overlap(spark, d):
    """Versions that overlap, one of them inside another: the one that starts first counts."""
    dim = v.with_more_versions(v.dim(spark, d), v.OVERLAPPING)
    return dimension.pit_coverage(v.trades(spark, d), dim).select("file_seq", "symbol_id", "quarantine_reason")


@query(
    f", m AS ({v.more_versions_sql(v.REPEATED)}) SELECT t.file_seq, arg_min(m.tick_size, m.valid_from_ts_us) AS tick_size"
    f" FROM trades t LEFT JOIN m ON t.exchange = m.exchange AND t.symbol_id = m.symbol_id{_VALID}"
)
def join_symbol_meta_overlap(spark, d):
    dim = v.with_more_versions(v.dim(spark, d), v.REPEATED)
    return dimension.join_symbol_meta(v.trades(spark, d), dim, ["tick_size"]).select("file_seq", "tick_size")


@query("SELECT file_seq, ts_spine_us FROM aligned")
def align_to_spine(spark, d):
    return volume_aligned(spark, d).select("file_seq", "ts_spine_us")


@query(
    ", b AS (SELECT t.file_seq, x.ts_spine_us FROM trades t ASOF LEFT JOIN v_spine x ON t.exchange = x.exchange AND t.symbol = x.symbol"
    " AND t.ts_event_us >= x.ts_spine_us) SELECT * FROM b"
)
def assign_to_buckets(spark, d):
    trades = v.trades(spark, d)
    points = spines.volume_spine(trades, v.VOLUME)
    return asof.align_to_spine(trades, points, direction="backward").select("file_seq", "ts_spine_us")


@query(
    "SELECT t.file_seq, q.bid_price, q.ask_price FROM trades t ASOF LEFT JOIN quotes q ON t.exchange = q.exchange AND t.symbol = q.symbol"
    " AND t.ts_event_us >= q.ts_event_us"
)
def asof_backward(spark, d):
    joined = asof.asof_backward(
        v.trades(spark, d), v.quotes(spark, d), BY, "ts_event_us", "ts_event_us", ["bid_price", "ask_price"], tie=("file_id", "file_seq")
    )
    return joined.select("file_seq", "bid_price", "ask_price")


_NEAR = 60_000_000


@query(
    ", a AS (SELECT file_seq, symbol, ts_event_us AS t FROM trades WHERE exchange = 'binance-futures'),"
    " o AS (SELECT file_seq AS other_seq, symbol, ts_event_us AS t FROM trades WHERE exchange = 'okx-futures'),"
    " x AS (SELECT a.*, b.t AS bt, b.other_seq AS bs FROM a ASOF LEFT JOIN o b ON a.symbol = b.symbol AND a.t >= b.t),"
    " y AS (SELECT x.*, f.t AS ft, f.other_seq AS fs FROM x ASOF LEFT JOIN o f ON x.symbol = f.symbol AND x.t <= f.t),"
    " z AS (SELECT file_seq, CASE WHEN ft IS NULL OR t - bt <= ft - t THEN bs ELSE fs END AS s, least(t - bt, ft - t) AS gap FROM y)"
    f" SELECT file_seq, CASE WHEN gap <= {_NEAR} THEN s END AS other_seq, CASE WHEN gap <= {_NEAR} THEN gap END AS gap_us FROM z"
)
def asof_nearest_tol(spark, d):
    trades = v.trades(spark, d)
    left = trades.where("exchange = 'binance-futures'").select("file_seq", "symbol", "ts_event_us")
    right = trades.where("exchange = 'okx-futures'").select(F.col("file_seq").alias("other_seq"), "symbol", F.col("ts_event_us").alias("ts_other"))
    near = asof.asof_nearest(left, right, ["symbol"], "ts_event_us", "ts_other", ["other_seq"], _NEAR)
    return near.select("file_seq", "other_seq", "gap_us")


@query(
    "SELECT b.exchange, b.symbol, b.ts_spine_us, b.close, f.funding_close FROM bars b JOIN f_bars f USING (exchange, symbol, ts_spine_us)",
    "close funding_close",
)
def feature_join_inner(spark, d):
    both = volume_bars_of(spark, d).join(funding_bars_of(spark, d), [*BY, TS])
    return both.select(*BY, TS, "close", "funding_close")


@query(
    "SELECT b.exchange, b.symbol, b.ts_spine_us, b.close, f.funding_close FROM bars b LEFT JOIN f_bars f USING (exchange, symbol, ts_spine_us)",
    "close funding_close",
)
def feature_join_left(spark, d):
    both = volume_bars_of(spark, d).join(funding_bars_of(spark, d), [*BY, TS], "left")
    return both.select(*BY, TS, "close", "funding_close")


# Spines


@query(
    f", w AS (SELECT symbol_id, exchange, exchange_symbol AS symbol, greatest(valid_from_ts_us, {v.JAN_1}) AS a,"
    f" least(valid_until_ts_us, {v.JAN_20}) AS b FROM dim WHERE valid_from_ts_us < {v.JAN_20} AND valid_until_ts_us > {v.JAN_1})"
    " SELECT exchange, symbol, ts AS ts_spine_us, min(symbol_id) AS symbol_id FROM"
    " (SELECT *, unnest(range(a - a % 3600000000 + 3600000000, b + 1, 3600000000)) AS ts FROM w) GROUP BY ALL"
)
def clock_spine(spark, d):
    return spines.clock_spine(v.dim(spark, d), v.JAN_1, v.JAN_20, 3_600_000_000)


@query("SELECT DISTINCT exchange, symbol, symbol_id, ts_event_us AS ts_spine_us FROM trades")
def trades_spine(spark, d):
    return spines.trades_spine(v.trades(spark, d))


@query("SELECT * FROM v_spine")
def volume_spine(spark, d):
    return spines.volume_spine(v.trades(spark, d), v.VOLUME)


@query("SELECT * FROM d_spine")
def dollar_spine(spark, d):
    return spines.dollar_spine(v.trades(spark, d), v.DOLLARS)


# Aggregations


@query("SELECT * FROM bars", _BAR_DOUBLES)
def volume_bars(spark, d):
    """The flagship: trades, volume spine, strict alignment, bars."""
    return volume_bars_of(spark, d)


@query(
    "SELECT exchange, symbol, ts_event_us // 60000000 * 60000000 AS bar_start_us, arg_min(price, ts_event_us) / 1e9 AS open, max(price) / 1e9 AS high,"
    " min(price) / 1e9 AS low, arg_max(price, ts_event_us) / 1e9 AS close, CAST(sum(qty) AS DOUBLE) / 1e9 AS volume, count(*) AS trade_count"
    " FROM trades GROUP BY ALL",
    "open high low close volume",
)
def time_bars_1m(spark, d):
    return bars.time_bars(v.trades(spark, d))


_VWAP = "CAST(sum(CAST(price AS HUGEINT) * qty) AS DOUBLE) / CAST(sum(qty) AS DOUBLE) / 1e9"


@query(
    "SELECT min(price) / 1e9 AS min_price, max(price) / 1e9 AS max_price, CAST(sum(price) AS DOUBLE) / count(price) / 1e9 AS mean_price,"
    f" CAST(sum(qty) AS DOUBLE) / 1e9 AS volume, count(*) AS trade_count, {_VWAP} AS vwap FROM trades",
    "min_price max_price mean_price volume vwap",
)
def trade_stats(spark, d):
    return bars.trade_stats(v.trades(spark, d))


@query(
    "SELECT side, CAST(sum(qty) AS DOUBLE) / 1e9 AS volume, CAST(sum(price) AS DOUBLE) / count(price) / 1e9 AS mean_price, count(*) AS trade_count"
    " FROM trades GROUP BY side",
    "volume mean_price",
)
def stats_by_side(spark, d):
    return bars.stats_by_side(v.trades(spark, d))


@query(
    "SELECT exchange, symbol, ts_spine_us, close, vwap, volume, flow_imbalance, price_std AS volatility,"
    " (high - low) / nullif(close, 0) AS hl_spread FROM bars",
    "close vwap volume flow_imbalance volatility hl_spread",
)
def hl_spread_bar(spark, d):
    return bars.hl_spread_bars(volume_aligned(spark, d))


@query("SELECT * FROM f_bars", "funding_open funding_close funding_mean funding_step predicted_funding_close oi_open oi_close oi_change")
def funding_bars(spark, d):
    return funding_bars_of(spark, d)


@query("SELECT * FROM vol", "bucket_vol hourly_vol")
def vol_buckets(spark, d):
    return bars.vol_buckets(v.trades(spark, d))


@query(
    "SELECT exchange, min(vwap) AS min, quantile_cont(vwap, 0.25) AS q25, median(vwap) AS median, avg(vwap) AS mean, quantile_cont(vwap, 0.75) AS q75,"
    " max(vwap) AS max FROM bars GROUP BY exchange",
    "min q25 median mean q75 max",
)
def distribution_stats(spark, d):
    return stats.distribution(volume_bars_of(spark, d), "vwap", ["exchange"])


@query(
    ", g AS (SELECT exchange, symbol, (ts_spine_us - lag(ts_spine_us) OVER " + _W + ") / 1e6 AS s FROM bars)"
    " SELECT exchange, symbol, avg(s) AS mean_s, median(s) AS median_s, min(s) AS min_s, max(s) AS max_s FROM g GROUP BY ALL"
)
def bar_duration_stats(spark, d):
    return bars.bar_duration_stats(volume_bars_of(spark, d)).withColumns(
        {c: F.round(c, 3) for c in ("mean_s", "median_s", "min_s", "max_s")}
    )


ORACLES["bar_duration_stats"] = ORACLES["bar_duration_stats"].replace("avg(s) AS", "round(avg(s), 3) AS").replace(
    "median(s) AS", "round(median(s), 3) AS"
).replace("min(s) AS", "round(min(s), 3) AS").replace("max(s) AS", "round(max(s), 3) AS")

_REGIMES = (
    "SELECT *, CASE WHEN smooth_vol > 0.02 THEN 'HIGH' WHEN smooth_vol < 0.005 THEN 'LOW' ELSE 'MEDIUM' END AS regime FROM"
    " (SELECT *, avg(hourly_vol) OVER (PARTITION BY exchange, symbol ORDER BY bucket_us ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS smooth_vol FROM vol)"
)


def _regimes(spark, d):
    return features.adaptive_regime(bars.vol_buckets(v.trades(spark, d)))


@query(
    f", g AS ({_REGIMES}) SELECT exchange, symbol, bucket_us, regime, CASE regime WHEN 'HIGH' THEN 50 WHEN 'LOW' THEN 200 ELSE 100 END AS bar_threshold FROM g"
)
def fx_adaptive_regime(spark, d):
    return _regimes(spark, d).select(*BY, "bucket_us", "regime", "bar_threshold")


@query(f", g AS ({_REGIMES}) SELECT regime, count(*) AS n FROM g GROUP BY regime")
def regime_counts(spark, d):
    return features.regime_counts(_regimes(spark, d))


@query(
    f", g AS ({_REGIMES}), l AS (SELECT regime, lag(regime) OVER (PARTITION BY exchange, symbol ORDER BY bucket_us) AS prev_regime FROM g)"
    " SELECT prev_regime, regime, count(*) AS n FROM l WHERE prev_regime <> regime GROUP BY ALL"
)
def regime_transitions(spark, d):
    return features.regime_transitions(_regimes(spark, d))


_JOINED = (
    f", g AS ({_REGIMES}), j AS (SELECT b.*, g.regime, g.smooth_vol, (b.ts_spine_us - lag(b.ts_spine_us) OVER (PARTITION BY b.exchange, b.symbol"
    " ORDER BY b.ts_spine_us)) / 1e6 AS s FROM bars b LEFT JOIN g ON b.exchange = g.exchange AND b.symbol = g.symbol"
    " AND b.ts_spine_us // 300000000 * 300000000 = g.bucket_us)"
)


def _regime_bars(spark, d):
    return features.regime_join(volume_bars_of(spark, d), _regimes(spark, d))


@query(_JOINED + " SELECT exchange, symbol, ts_spine_us, regime FROM j")
def regime_join(spark, d):
    return _regime_bars(spark, d).select(*BY, TS, "regime")


@query(
    _JOINED + " SELECT regime, count(*) AS n_bars, round(avg(s), 3) AS mean_duration_s, round(median(s), 3) AS median_duration_s,"
    " round(avg(volume), 6) AS mean_volume, round(avg(trade_count), 6) AS mean_trades, round(avg(smooth_vol), 6) AS mean_vol FROM j GROUP BY regime"
)
def regime_stats(spark, d):
    places = {"mean_duration_s": 3, "median_duration_s": 3, "mean_volume": 6, "mean_trades": 6, "mean_vol": 6}
    return features.regime_stats(_regime_bars(spark, d)).withColumns({c: F.round(c, n) for c, n in places.items()})


_ZSCORE = "(vwap - avg(vwap) OVER ()) / nullif(stddev_samp(vwap) OVER (), 0)"


@query(f"SELECT exchange, symbol, ts_spine_us, {_ZSCORE} AS z FROM bars", "z")
def zscore_label(spark, d):
    return stats.zscore(volume_bars_of(spark, d), "vwap", "z").select(*BY, TS, "z")


@query(
    "SELECT 'funding_close' AS \"column\", avg(CASE WHEN funding_close IS NULL THEN 1e0 ELSE 0e0 END) AS null_share,"
    " avg(CASE WHEN funding_close IS NULL THEN 1e0 ELSE 0e0 END) > 0.05 AS flagged, CAST(0 AS BIGINT) AS n_infinite"
    " FROM bars b LEFT JOIN f_bars f USING (exchange, symbol, ts_spine_us) UNION ALL SELECT 'close', 0e0, false, 0",
    "null_share",
)
def null_inf_report(spark, d):
    both = volume_bars_of(spark, d).join(funding_bars_of(spark, d), [*BY, TS], "left")
    return stats.null_inf_report(both, ["funding_close", "close"])


def _ic_sql(source: str, feature: str, label: str, by: str = "") -> str:
    keys = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    again = f"PARTITION BY {by}, " if by else "PARTITION BY "
    found = (
        f"SELECT {keys}'{feature}' AS feature, corr(rx, ry) AS c, count(*) AS n FROM (SELECT *,"
        f" rank() OVER ({part}ORDER BY {feature}) + (count(*) OVER ({again}{feature}) - 1) / 2e0 AS rx,"
        f" rank() OVER ({part}ORDER BY {label}) + (count(*) OVER ({again}{label}) - 1) / 2e0 AS ry"
        f" FROM (SELECT * FROM {source} WHERE {feature} IS NOT NULL AND {label} IS NOT NULL)) GROUP BY ALL HAVING count(*) >= 10"
    )
    t = f"SELECT *, c * sqrt(n - 2e0) / nullif(sqrt(greatest(0, 1 - c * c)), 0) AS t FROM ({found})"
    z = f"SELECT *, abs(t) * (1 - 1 / (4e0 * (n - 2))) / sqrt(1 + t * t / (2e0 * (n - 2))) / sqrt(2) AS x FROM ({t})"
    k = f"SELECT *, 1 / (1 + 0.3275911e0 * x) AS k FROM ({z})"
    terms = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)
    tail = " + ".join(f"({c}e0) * power(k, {i})" for i, c in enumerate(terms, 1))
    return f"SELECT {keys}feature, round(c, 6) + 0e0 AS ic, round(exp(-x * x) * ({tail}), 6) + 0e0 AS p_value, n FROM ({k})"


_FWD = f"(SELECT *, lead(close, 5) OVER {_W} / nullif(close, 0) - 1 AS fwd_ret_5bar FROM bars)"


@query(f"{_ic_sql(_FWD, 'flow_imbalance', 'fwd_ret_5bar')} UNION ALL {_ic_sql(_FWD, 'avg_size', 'fwd_ret_5bar')}")
def rank_ic(spark, d):
    rows = windows.forward_returns(volume_bars_of(spark, d), BY, (TS,), steps=(5,))
    ic = stats.rank_ic(rows, ["flow_imbalance", "avg_size"], "fwd_ret_5bar", least=10)
    return ic.select("feature", F.round("ic", 6).alias("ic"), F.round("p_value", 6).alias("p_value"), "n")


@query(_ic_sql(_FWD, "flow_imbalance", "fwd_ret_5bar", "exchange"))
def rank_ic_by_group(spark, d):
    rows = windows.forward_returns(volume_bars_of(spark, d), BY, (TS,), steps=(5,))
    ic = stats.rank_ic(rows, ["flow_imbalance"], "fwd_ret_5bar", by=("exchange",), least=10)
    return ic.select("exchange", "feature", F.round("ic", 6).alias("ic"), F.round("p_value", 6).alias("p_value"), "n")


def _adaptive_ic_sql(source: str) -> str:
    fwd = f"(SELECT *, lead(close, 5) OVER {_W} / nullif(close, 0) - 1 AS fwd_ret_5bar FROM {source})"
    return _ic_sql(fwd, "flow_imbalance", "fwd_ret_5bar")


#: Volume that a bar threshold of 1 stands for.
_UNIT = 10 * SCALE
_ADAPTIVE = (
    f", g AS ({_REGIMES}), w AS (SELECT t.*, coalesce(CASE g.regime WHEN 'HIGH' THEN 4 WHEN 'LOW' THEN 1 ELSE 2 END, 2) AS share"
    " FROM trades t ASOF LEFT JOIN g ON t.exchange = g.exchange AND t.symbol = g.symbol AND t.ts_event_us >= g.bucket_us + 300000000),"
    " q AS (SELECT *, CAST(qty AS HUGEINT) * share AS m FROM w),"
    " r AS (SELECT *, sum(m) OVER (PARTITION BY exchange, symbol ORDER BY ts_event_us, file_id, file_seq ROWS UNBOUNDED PRECEDING) AS s FROM q),"
    f" a_spine AS (SELECT exchange, symbol, symbol_id, ts_event_us AS ts_spine_us FROM r WHERE s // {200 * _UNIT} > (s - m) // {200 * _UNIT})"
)
_ADAPTIVE_BARS = (
    _ADAPTIVE + ", a_aligned AS (SELECT t.*, x.ts_spine_us FROM trades t ASOF LEFT JOIN a_spine x ON t.exchange = x.exchange AND t.symbol = x.symbol"
    f" AND t.ts_event_us < x.ts_spine_us), a_bars AS ({v.BARS_SQL.format('a_aligned')})"
)


def _adaptive_points(spark, d):
    trades = v.trades(spark, d)
    return trades, spines.adaptive_spine(trades, _regimes(spark, d), _UNIT)


@query(_ADAPTIVE + " SELECT * FROM a_spine")
def adaptive_spine(spark, d):
    """Volume bars that are shorter while the market is volatile."""
    return _adaptive_points(spark, d)[1]


@query(
    f"{_ADAPTIVE_BARS}, a AS ({_adaptive_ic_sql('a_bars')}), f AS ({_adaptive_ic_sql('bars')})"
    " SELECT a.feature, a.ic AS ic_adaptive, f.ic AS ic_fixed, a.p_value AS p_adaptive, f.p_value AS p_fixed, a.n AS n_adaptive, f.n AS n_fixed,"
    " round((a.ic - f.ic) / nullif(abs(f.ic), 0), 4) + 0e0 AS improvement FROM a JOIN f USING (feature)"
)
def fx_adaptive_vs_fixed(spark, d):
    """Rank correlation over bars whose threshold follows the regime, against bars of the middle threshold."""

    def ic(rows, name):
        ahead = windows.forward_returns(rows, BY, (TS,), steps=(5,))
        found = stats.rank_ic(ahead, ["flow_imbalance"], "fwd_ret_5bar", least=10)
        return found.select(
            "feature", F.round("ic", 6).alias(f"ic_{name}"), F.round("p_value", 6).alias(f"p_{name}"), F.col("n").alias(f"n_{name}")
        )

    adaptive = bars.trade_bars(asof.align_to_spine(*_adaptive_points(spark, d)))
    both = ic(adaptive, "adaptive").join(ic(volume_bars_of(spark, d), "fixed"), "feature")
    step = F.col("ic_adaptive") - F.col("ic_fixed")
    return both.withColumn("improvement", F.round(step / F.nullif(F.abs("ic_fixed"), F.lit(0.0)), 4))


# Windows

_RETS = ", ".join(f"close / nullif(lag(close, {k}) OVER {_W}, 0) - 1 AS ret_{k}bar" for k in (1, 3, 5, 10))


@query(f"SELECT exchange, symbol, ts_spine_us, {_RETS} FROM bars", "ret_1bar ret_3bar ret_5bar ret_10bar")
def returns(spark, d):
    return windows.returns(volume_bars_of(spark, d), BY, (TS,)).select(*BY, TS, *(f"ret_{k}bar" for k in (1, 3, 5, 10)))


_FWDS = ", ".join(f"lead(close, {k}) OVER {_W} / nullif(close, 0) - 1 AS fwd_ret_{k}bar" for k in (5, 10, 20))


@query(f"SELECT exchange, symbol, ts_spine_us, {_FWDS} FROM bars", "fwd_ret_5bar fwd_ret_10bar fwd_ret_20bar")
def forward_returns(spark, d):
    return windows.forward_returns(volume_bars_of(spark, d), BY, (TS,)).select(*BY, TS, *(f"fwd_ret_{k}bar" for k in (5, 10, 20)))


_F = lambda n: f"OVER (PARTITION BY exchange, symbol ORDER BY ts_spine_us ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


@query(
    f"SELECT exchange, symbol, ts_spine_us, CASE WHEN count(close) {_F(5)} >= 5 THEN avg(close) {_F(5)} END AS mean5, avg(close) {_F(12)} AS mean12,"
    f" CASE WHEN count(close) {_F(50)} >= 50 THEN median(close) {_F(50)} END AS median50,"
    f" close - lag(close) OVER {_W} AS diff, close <> lag(close) OVER {_W} AS changed,"
    f" flow_imbalance * lag(flow_imbalance) OVER {_W} AS persistence FROM bars",
    "mean5 mean12 median50 diff persistence",
)
def rolling_windows(spark, d):
    def columns(w):
        return {
            "mean5": windows.rolling_mean("close", 5, w),
            "mean12": windows.rolling_mean("close", 12, w, least=1),
            "median50": windows.rolling_median("close", 50, w),
            "diff": windows.diff("close", w),
            "changed": windows.changed("close", w),
            "persistence": windows.persistence("flow_imbalance", w),
        }

    found = windows.windowed(volume_bars_of(spark, d), BY, (TS,), columns, back=49)
    return found.select(*BY, TS, "mean5", "mean12", "median50", "diff", "changed", "persistence")


@query(
    "SELECT file_seq, CAST(s AS BIGINT) AS running_qty FROM run"
)
def cum_sum_over(spark, d):
    from ..operators.scan import running_sum

    summed = running_sum(v.trades(spark, d), BY, spines.ORDER, F.col("qty"), "running_qty")
    return summed.select("file_seq", F.col("running_qty").cast("long").alias("running_qty"))


@query(
    ", s AS (SELECT exchange, symbol, ts_event_us - lag(ts_event_us) OVER (PARTITION BY exchange, symbol, file_id ORDER BY file_seq) AS g FROM trades)"
    " SELECT exchange, symbol, count(*) AS n_backwards FROM s WHERE g < 0 GROUP BY ALL"
)
def order_check(spark, d):
    return windows.order_check(v.trades(spark, d))


@query(
    ", f AS (SELECT *, row_number() OVER (PARTITION BY exchange, symbol, trading_date ORDER BY ts_event_us, file_id, file_seq) AS r FROM trades)"
    " SELECT exchange, symbol, trading_date, file_seq, price FROM f WHERE r = 1"
)
def first_per_group(spark, d):
    return windows.first_per_group(v.trades(spark, d), [*BY, "trading_date"], spines.ORDER, ["file_seq", "price"])


@query("SELECT file_seq, row_number() OVER (ORDER BY ts_event_us, file_id, file_seq) - 1 AS row_index FROM trades")
def row_index(spark, d):
    rows = v.trades(spark, d).select("ts_event_us", "file_id", "file_seq")
    return windows.row_index(rows, spines.ORDER).select("file_seq", "row_index")


# Feature packs


@query(
    f", b AS (SELECT *, CASE WHEN count(avg_size) {_F(50)} >= 50 THEN median(avg_size) {_F(50)} END AS m FROM bars)"
    f" SELECT exchange, symbol, ts_spine_us, (close - vwap) / nullif(vwap, 0) AS vwap_reversion,"
    f" close / nullif(lag(close) OVER {_W}, 0) - 1 AS ret_1bar, close / nullif(lag(close, 5) OVER {_W}, 0) - 1 AS ret_5bar,"
    f" close / nullif(lag(close, 10) OVER {_W}, 0) - 1 AS ret_10bar, trade_count / nullif(CAST(lag(trade_count) OVER {_W} AS DOUBLE), 0) - 1 AS trade_count_accel,"
    f" flow_imbalance * lag(flow_imbalance) OVER {_W} AS flow_persistence, (high - low) / nullif(close, 0) AS hl_range_pct,"
    " avg_size / nullif(m, 0) AS size_ratio, CAST(extract(hour FROM make_timestamp(ts_spine_us)) AS INTEGER) AS hour,"
    " CAST(isodow(make_timestamp(ts_spine_us)) AS INTEGER) AS weekday FROM b",
)
def fx_momentum(spark, d):
    doubles = ("vwap_reversion", "ret_1bar", "ret_5bar", "ret_10bar", "trade_count_accel", "flow_persistence", "hl_range_pct", "size_ratio")
    out = features.momentum(volume_bars_of(spark, d)).select(*BY, TS, *doubles, "hour", "weekday")
    return out.withColumns({c: F.round(c, DIGITS) for c in doubles})


def _round_columns(name: str, columns: str) -> None:
    prefix, _, body = ORACLES[name].rpartition(" SELECT exchange")
    names = ", ".join(f"round(CAST({c} AS DOUBLE), {DIGITS}) + 0e0 AS {c}" for c in columns.split())
    ORACLES[name] = f"{prefix}, final AS (SELECT exchange{body}) SELECT * REPLACE ({names}) FROM final"


_round_columns("fx_momentum", "vwap_reversion ret_1bar ret_5bar ret_10bar trade_count_accel flow_persistence hl_range_pct size_ratio")


@query(
    "SELECT b.exchange, b.symbol, b.ts_spine_us, funding_close * 365 * 3 AS funding_carry_annual,"
    " funding_close - predicted_funding_close AS funding_surprise, oi_change / nullif(oi_open, 0) AS oi_pct_change,"
    " funding_close * (oi_change / nullif(oi_open, 0)) AS funding_oi_pressure, flow_imbalance * funding_close AS flow_funding_interaction,"
    " funding_close - lag(funding_close) OVER (PARTITION BY b.exchange, b.symbol ORDER BY b.ts_spine_us) AS funding_momentum,"
    " oi_close / nullif(lag(oi_close, 5) OVER (PARTITION BY b.exchange, b.symbol ORDER BY b.ts_spine_us), 0) - 1 AS oi_momentum_5bar"
    " FROM bars b LEFT JOIN f_bars f USING (exchange, symbol, ts_spine_us)",
    "funding_carry_annual funding_surprise oi_pct_change funding_oi_pressure flow_funding_interaction funding_momentum oi_momentum_5bar",
)
def fx_funding(spark, d):
    both = volume_bars_of(spark, d).join(funding_bars_of(spark, d), [*BY, TS], "left")
    return features.funding(both).select(
        *BY, TS, "funding_carry_annual", "funding_surprise", "oi_pct_change", "funding_oi_pressure", "flow_funding_interaction",
        "funding_momentum", "oi_momentum_5bar",
    )


_PAIR = (
    ", h AS (SELECT exchange, symbol, ts_spine_us, close, vwap, volume, flow_imbalance, price_std AS volatility,"
    " (high - low) / nullif(close, 0) AS hl_spread FROM bars),"
    " p AS (SELECT a.symbol, a.ts_spine_us, a.close AS a_close, b.close AS b_close, a.vwap AS a_vwap, b.vwap AS b_vwap, a.volume AS a_volume,"
    " b.volume AS b_volume, a.flow_imbalance AS a_flow, b.flow_imbalance AS b_flow, a.volatility AS a_vol, b.volatility AS b_vol,"
    " a.hl_spread AS a_hl, b.hl_spread AS b_hl FROM (SELECT * FROM h WHERE exchange = 'binance-futures') a"
    " ASOF LEFT JOIN (SELECT * FROM h WHERE exchange = 'okx-futures') b ON a.symbol = b.symbol AND a.ts_spine_us >= b.ts_spine_us)"
)
_PW = "(PARTITION BY symbol ORDER BY ts_spine_us)"


def _pair(spark, d, first: str, second: str) -> DataFrame:
    # Bars are worked out once and split, not once for each side.
    rows = kept(bars.hl_spread_bars(volume_aligned(spark, d)))
    side = lambda e, p: features.prefixed(rows.where(F.col("exchange") == e).drop("exchange"), p, ["symbol", TS])
    a, b = side("binance-futures", first), side("okx-futures", second)
    return asof.asof_backward(a, b, ["symbol"], TS, TS, [c for c in b.columns if c not in ("symbol", TS)])


_CROSS = (
    _PAIR + ", c AS (SELECT symbol, ts_spine_us, (a_close - b_close) / nullif(b_close, 0) * 10000 AS spread_bps,"
    " (a_vwap - b_vwap) / nullif(b_vwap, 0) * 10000 AS vwap_spread_bps, (a_volume - b_volume) / nullif(a_volume + b_volume, 0) AS volume_imbalance,"
    " a_flow - b_flow AS flow_divergence, a_vol / nullif(b_vol, 0) AS volatility_ratio,"
    f" (a_close / nullif(lag(a_close, 5) OVER {_PW}, 0) - 1) - (b_close / nullif(lag(b_close, 5) OVER {_PW}, 0) - 1) AS momentum_divergence FROM p),"
    " o AS (SELECT *, abs(spread_bps) > 14 AS arb_opportunity,"
    " CASE WHEN abs(spread_bps) > 14 THEN abs(spread_bps) - 14 ELSE 0 END AS expected_profit_bps,"
    f" spread_bps - lag(spread_bps) OVER {_PW} AS spread_convergence FROM c)"
)
_CROSS_DOUBLES = (
    "spread_bps vwap_spread_bps volume_imbalance flow_divergence volatility_ratio momentum_divergence expected_profit_bps spread_convergence"
)


def _replaced(columns: str, digits: int = 4) -> str:
    return ", ".join(f"round(CAST({c} AS DOUBLE), {digits}) + 0e0 AS {c}" for c in columns.split())


@query(_CROSS + f" SELECT * REPLACE ({_replaced(_CROSS_DOUBLES)}) FROM o")
def fx_cross_exchange(spark, d):
    doubles = _CROSS_DOUBLES.split()
    out = features.cross_exchange(_pair(spark, d, "a_", "b_")).select("symbol", TS, *doubles, "arb_opportunity")
    return out.withColumns({c: F.round(c, 4) for c in doubles})


_SUMMARY = (
    " SELECT count(*) AS n_bars, count_if({0}) AS n_over, round(CAST(count_if({0}) AS DOUBLE) / count(*), 4) AS share_over,"
    " round(avg(CASE WHEN {0} THEN {2} END), 4) AS mean_profit_bps, round(median(CASE WHEN {0} THEN {2} END), 4) AS median_profit_bps,"
    " round(max(CASE WHEN {0} THEN {2} END), 4) AS max_profit_bps, count_if({0} AND {1} > 0) AS n_positive, count_if({0} AND {1} < 0) AS n_negative FROM o"
)
_SUMMARY_DOUBLES = ("share_over", "mean_profit_bps", "median_profit_bps", "max_profit_bps")


@query(_CROSS + _SUMMARY.format("abs(spread_bps) > 14", "spread_bps", "expected_profit_bps"))
def arb_summary(spark, d):
    rows = features.cross_exchange(_pair(spark, d, "a_", "b_"))
    out = features.opportunity_summary(rows, "spread_bps", "expected_profit_bps", features.EXCHANGE_COST_BPS)
    return out.withColumns({c: F.round(c, 4) for c in _SUMMARY_DOUBLES})


_PERP = (
    _PAIR + ", pf AS (SELECT p.*, f.funding_close FROM p LEFT JOIN f_bars f ON f.exchange = 'binance-futures' AND p.symbol = f.symbol"
    " AND p.ts_spine_us = f.ts_spine_us),"
    " c AS (SELECT symbol, ts_spine_us, funding_close, (a_close - b_close) / nullif(b_close, 0) * 10000 AS basis_bps,"
    " (a_vwap - b_vwap) / nullif(b_vwap, 0) * 10000 AS vwap_basis_bps, a_volume / nullif(b_volume, 0) AS volume_ratio,"
    " a_flow - b_flow AS flow_divergence, a_vol / nullif(b_vol, 0) AS volatility_ratio, a_hl / nullif(b_hl, 0) AS spread_ratio FROM pf),"
    f" o AS (SELECT *, basis_bps - lag(basis_bps) OVER {_PW} AS basis_momentum, funding_close * 10000 - basis_bps AS funding_basis_divergence,"
    " abs(basis_bps) > 48 AS cash_carry_opportunity, CASE WHEN abs(basis_bps) > 48 THEN abs(basis_bps) - 48 ELSE 0 END AS cash_carry_profit_bps,"
    " flow_divergence * basis_bps AS flow_basis_interaction FROM c)"
)
_PERP_DOUBLES = (
    "basis_bps vwap_basis_bps volume_ratio flow_divergence volatility_ratio spread_ratio basis_momentum funding_basis_divergence"
    " cash_carry_profit_bps flow_basis_interaction"
)


def _perp_rows(spark, d):
    rates = funding_bars_of(spark, d).where("exchange = 'binance-futures'").select("symbol", TS, "funding_close")
    return features.perp_spot(_pair(spark, d, "perp_", "spot_").join(rates, ["symbol", TS], "left"))


@query(_PERP + f" SELECT * EXCLUDE (funding_close) REPLACE ({_replaced(_PERP_DOUBLES)}) FROM o")
def fx_perp_spot(spark, d):
    doubles = _PERP_DOUBLES.split()
    out = _perp_rows(spark, d).select("symbol", TS, *doubles, "cash_carry_opportunity")
    return out.withColumns({c: F.round(c, 4) for c in doubles})


@query(_PERP + _SUMMARY.format("abs(basis_bps) > 48", "basis_bps", "cash_carry_profit_bps"))
def carry_summary(spark, d):
    out = features.opportunity_summary(_perp_rows(spark, d), "basis_bps", "cash_carry_profit_bps", features.CARRY_COST_BPS)
    return out.withColumns({c: F.round(c, 4) for c in _SUMMARY_DOUBLES})


_TREND = (
    "SELECT *, close / nullif(lag(close, 5) OVER {0}, 0) - 1 AS ret_5bar, CASE WHEN count(close) {1} >= 5 THEN avg(close) {1} END AS ma5 FROM {2}"
)
_MULTI_DOUBLES = (
    "momentum_divergence volatility_ratio flow_alignment price_position trend_confirmation volume_acceleration micro_trend_div slow_trend_strength"
)


@query(
    f", x AS ({_TREND.format(_W, _F(5), 'bars')}), y AS ({_TREND.format(_W, _F(5), 'slow_bars')}),"
    " p AS (SELECT x.*, y.ret_5bar AS s_ret, y.price_std AS s_std, y.flow_imbalance AS s_flow, y.low AS s_low, y.high AS s_high, y.close AS s_close,"
    " y.ma5 AS s_ma FROM x ASOF LEFT JOIN y ON x.exchange = y.exchange AND x.symbol = y.symbol AND x.ts_spine_us >= y.ts_spine_us),"
    " o AS (SELECT exchange, symbol, ts_spine_us, ret_5bar - s_ret AS momentum_divergence, price_std / nullif(s_std, 0) AS volatility_ratio,"
    " flow_imbalance * s_flow AS flow_alignment, (close - s_low) / nullif(s_high - s_low, 0) AS price_position,"
    " CAST(sign(ret_5bar) * sign(s_ret) AS DOUBLE) AS trend_confirmation,"
    f" volume / nullif(lag(volume) OVER {_W}, 0) - 1 AS volume_acceleration, (close - ma5) / nullif(ma5, 0) AS micro_trend_div,"
    f" (s_close - s_ma) / nullif(s_ma, 0) AS slow_trend_strength FROM p) SELECT * REPLACE ({_replaced(_MULTI_DOUBLES)}) FROM o"
)
def fx_multi_timeframe(spark, d):
    fast = features.prefixed(features.with_trend(volume_bars_of(spark, d)), "fast_", [*BY, TS])
    slow = features.prefixed(features.with_trend(volume_bars_of(spark, d, v.SLOW_VOLUME)), "slow_", [*BY, TS])
    both = asof.asof_backward(fast, slow, BY, TS, TS, [c for c in slow.columns if c not in (*BY, TS)])
    doubles = _MULTI_DOUBLES.split()
    return features.multi_timeframe(both).select(*BY, TS, *doubles).withColumns({c: F.round(c, 4) for c in doubles})


# Co-trading

_TOLERANCE = 30_000_000
_SIMILAR = (
    f", n AS (SELECT i.symbol AS sym_i, j.symbol AS sym_j, i.file_seq AS a, i.qty AS qi, arg_min(j.qty, (abs(i.ts_event_us - j.ts_event_us), j.ts_event_us)) AS qj"
    f" FROM trades i JOIN trades j ON i.symbol < j.symbol AND abs(i.ts_event_us - j.ts_event_us) <= {_TOLERANCE} GROUP BY ALL),"
    " s AS (SELECT sym_i, sym_j, count(*) AS matches, sum(least(qi, qj)) AS shared FROM n GROUP BY ALL),"
    " t AS (SELECT symbol, CAST(sum(qty) AS DOUBLE) / 1e9 AS v FROM trades GROUP BY symbol),"
    " sim AS (SELECT sym_i, sym_j, matches, CAST(shared AS DOUBLE) / 1e9 / sqrt(a.v * b.v) AS similarity FROM s"
    " JOIN t a ON a.symbol = sym_i JOIN t b ON b.symbol = sym_j)"
)


@query(_SIMILAR + f" SELECT sym_i, sym_j, matches, round(similarity, {DIGITS}) AS similarity FROM sim")
def cotrading_similarity(spark, d):
    return cotrading.similarity(v.trades(spark, d), _TOLERANCE).withColumn("similarity", F.round("similarity", DIGITS))


_EDGES = (
    _SIMILAR + ", l AS (SELECT sum(similarity) / 10 + sqrt(greatest(0, sum(similarity * similarity) / 10 - (sum(similarity) / 10) * (sum(similarity) / 10))) AS lim FROM sim),"
    " b AS (SELECT sym_i AS x, sym_j AS y, similarity FROM sim UNION ALL SELECT sym_j, sym_i, similarity FROM sim),"
    " k AS (SELECT *, row_number() OVER (PARTITION BY x ORDER BY similarity DESC, y) AS r FROM b, l WHERE similarity > lim),"
    " g AS (SELECT DISTINCT least(x, y) AS node_a, greatest(x, y) AS node_b, similarity FROM k WHERE r <= 2)"
)


def _graph(spark, d):
    return cotrading.edges(cotrading.similarity(v.trades(spark, d), _TOLERANCE), n_symbols=5, top_k=2)


@query(_EDGES + f" SELECT node_a, node_b, round(similarity, {DIGITS}) AS similarity FROM g")
def cotrading_edges(spark, d):
    return _graph(spark, d).withColumn("similarity", F.round("similarity", DIGITS))


@query(
    _EDGES + ", z AS (SELECT node_a AS node, similarity FROM g UNION ALL SELECT node_b, similarity FROM g)"
    f" SELECT node, count(*) AS degree, round(sum(similarity), {DIGITS}) AS weighted_degree FROM z GROUP BY node"
)
def cotrading_centrality(spark, d):
    return cotrading.centrality(_graph(spark, d)).withColumn("weighted_degree", F.round("weighted_degree", DIGITS))


@query()
def cotrading_clusters(spark, d):
    return cotrading.clusters(cotrading.similarity(v.trades(spark, d), _TOLERANCE), k=2)


# Dimension, manifest and files


@query("SELECT exchange, count(*) AS n_rows, CAST(sum(CAST(is_current AS INTEGER)) AS BIGINT) AS n_current, count(DISTINCT exchange_symbol) AS n_symbols FROM dim GROUP BY exchange")
def dim_summary(spark, d):
    return dimension.dim_summary(v.dim(spark, d))


@query(
    "SELECT 'exchange' AS dimension, exchange AS name, count(*) AS n FROM dim GROUP BY exchange"
    " UNION ALL SELECT 'market_type', market_type, count(*) FROM dim GROUP BY market_type"
)
def dim_market_summary(spark, d):
    return dimension.dim_market_summary(v.dim(spark, d))


def _snapshot(spark, d):
    """The symbols after a change: S0 gone, S1 with another tick, the rest as they were."""
    current = v.dim(spark, d).where("is_current and exchange_symbol <> 'S0'")
    tick = F.when(F.col("exchange_symbol") == "S1", F.lit(7).cast("long")).otherwise(F.col("tick_size"))
    return current.withColumn("tick_size", tick).select(*dimension.KEY, *dimension.TRACKED)


_UPSERT = v.JAN_20 + 5 * v.DAY


def _opened_unnamed(dim: DataFrame) -> DataFrame:
    """Ids of versions opened by the change are blake2b hashes, which SQL lacks; all others must be as they were."""
    opened = F.col("valid_from_ts_us") == _UPSERT
    made = dimension.symbol_id(F.col("exchange"), F.col("exchange_symbol"), F.col("valid_from_ts_us"))
    return dim.select(
        "exchange", "exchange_symbol", "valid_from_ts_us", "valid_until_ts_us", "is_current", "tick_size",
        F.when(~opened, F.col("symbol_id")).alias("symbol_id"), (~opened | (F.col("symbol_id") == made)).alias("id_is_right"),
    )


@query(
    f"SELECT exchange, exchange_symbol, valid_from_ts_us, CASE WHEN is_current AND exchange_symbol IN ('S0', 'S1') THEN {_UPSERT} ELSE valid_until_ts_us END AS valid_until_ts_us,"
    " is_current AND exchange_symbol NOT IN ('S0', 'S1') AS is_current, tick_size, symbol_id, true AS id_is_right FROM dim"
    f" UNION ALL SELECT exchange, exchange_symbol, {_UPSERT}, valid_until_ts_us, true, 7, NULL, true FROM dim WHERE is_current AND exchange_symbol = 'S1'"
)
def dim_upsert(spark, d):
    return _opened_unnamed(dimension.upsert(v.dim(spark, d), _snapshot(spark, d), _UPSERT))


@query(
    f"SELECT exchange, exchange_symbol, valid_from_ts_us, CASE WHEN is_current AND exchange_symbol = 'S0' AND exchange = 'okx-futures' THEN {_UPSERT - 5}"
    f" WHEN is_current AND exchange_symbol = 'S1' THEN {_UPSERT} ELSE valid_until_ts_us END AS valid_until_ts_us,"
    " is_current AND NOT (exchange_symbol = 'S1' OR (exchange_symbol = 'S0' AND exchange = 'okx-futures')) AS is_current, tick_size, symbol_id, true AS id_is_right FROM dim"
    f" UNION ALL SELECT exchange, exchange_symbol, {_UPSERT}, valid_until_ts_us, true, 7, NULL, true FROM dim WHERE is_current AND exchange_symbol = 'S1'"
)
def dim_delist_explicit(spark, d):
    current = v.dim(spark, d)
    gone = current.where("is_current and exchange = 'okx-futures' and exchange_symbol in ('S0', 'S2')")
    gone = gone.select("exchange", "exchange_symbol", F.lit(_UPSERT - 5).cast("long").alias("delisted_at_ts_us"))
    return _opened_unnamed(dimension.upsert(current, _snapshot(spark, d), _UPSERT, gone))


_DERIVATIVES = {"S0": "BTC-PERPETUAL", "S1": "btc-27JUN25-50000-C", "S2": "ETH-27JUN25", "S3": " eth_perpetual"}
_DERIVATIVE_TYPES = {"BTC-PERPETUAL": "perpetual", "btc-27JUN25-50000-C": "option", "ETH-27JUN25": "future", "eth_perpetual": "perpetual"}


@query(
    "SELECT DISTINCT exchange, CASE symbol "
    + " ".join(f"WHEN '{k}' THEN '{x.strip()}'" for k, x in _DERIVATIVES.items())
    + " ELSE symbol END AS exchange_symbol, CASE symbol "
    + " ".join(f"WHEN '{k}' THEN '{_DERIVATIVE_TYPES[x.strip()]}'" for k, x in _DERIVATIVES.items())
    + " ELSE 'unknown' END AS market_type, true AS is_current FROM trades"
)
def dim_from_events(spark, d):
    names = F.create_map(*[F.lit(x) for kv in _DERIVATIVES.items() for x in kv])
    events = v.trades(spark, d).withColumn("symbol", F.coalesce(F.try_element_at(names, F.col("symbol")), "symbol"))
    made = dimension.from_events(events, v.JAN_1)
    return made.select("exchange", "exchange_symbol", "market_type", "is_current")


@query(
    f", m AS ({v.more_versions_sql(v.BROKEN)}), k AS (SELECT *, lead(valid_from_ts_us) OVER (PARTITION BY exchange, exchange_symbol"
    " ORDER BY valid_from_ts_us, valid_until_ts_us) AS following, count(*) OVER (PARTITION BY symbol_id) AS same,"
    " row_number() OVER (PARTITION BY symbol_id ORDER BY exchange, exchange_symbol) AS i FROM m)"
    " SELECT 'empty_window' AS rule, exchange, exchange_symbol FROM k WHERE valid_until_ts_us <= valid_from_ts_us"
    " UNION ALL SELECT 'several_current', exchange, exchange_symbol FROM k WHERE is_current GROUP BY ALL HAVING count(*) > 1"
    " UNION ALL SELECT 'overlap', exchange, exchange_symbol FROM k WHERE valid_until_ts_us > following"
    " UNION ALL SELECT 'repeated_symbol_id', exchange, exchange_symbol FROM k WHERE same > 1 AND i = 1"
)
def dim_validate(spark, d):
    """Each rule is broken by some versions."""
    return dimension.violations(v.with_more_versions(v.dim(spark, d), v.BROKEN))


def _ledger(spark, d):
    """A ledger with a row for each part of the orders table."""
    orders = spark.read.parquet(f"{d}/orders.parquet")
    return orders.groupBy((F.col("o_orderkey") % 50).alias("file_id")).agg(
        F.count("*").alias("rows_total"), F.count_if(F.col("o_totalprice") > 1000).alias("rows_written")
    ).select(
        "file_id",
        F.when(F.col("file_id") % 2 == 0, "feed_a").otherwise("feed_b").alias("vendor"),
        F.when(F.col("file_id") % 3 == 0, "trades").otherwise("quotes").alias("data_type"),
        F.concat(F.lit("bronze/"), F.col("file_id").cast("string")).alias("bronze_path"),
        F.concat(F.lit("h"), F.col("file_id").cast("string")).alias("file_hash"),
        F.when(F.col("file_id") % 5 == 0, "failed").otherwise("success").alias("status"),
        "rows_total",
        "rows_written",
        (F.col("rows_total") - F.col("rows_written")).alias("rows_quarantined"),
        F.col("file_id").alias("created_at_ts_us"),
        F.col("file_id").alias("processed_at_ts_us"),
    )


_LEDGER = (
    "(SELECT o_orderkey % 50 AS file_id, CASE WHEN o_orderkey % 50 % 2 = 0 THEN 'feed_a' ELSE 'feed_b' END AS vendor,"
    " CASE WHEN o_orderkey % 50 % 3 = 0 THEN 'trades' ELSE 'quotes' END AS data_type, CASE WHEN o_orderkey % 50 % 5 = 0 THEN 'failed' ELSE 'success' END AS status,"
    " count(*) AS rows_total, count_if(o_totalprice > 1000) AS rows_written FROM orders GROUP BY ALL)"
)


@query(
    "SELECT vendor, data_type, status, count(*) AS n_files, CAST(sum(rows_written) AS BIGINT) AS rows_written,"
    f" CAST(sum(rows_total - rows_written) AS BIGINT) AS rows_quarantined FROM {_LEDGER} GROUP BY ALL",
    views=False,
)
def manifest_summary(spark, d):
    return manifest.manifest_summary(_ledger(spark, d))


@query(f"SELECT file_id, vendor, data_type, rows_total FROM {_LEDGER} WHERE status = 'failed' AND vendor = 'feed_a'", views=False)
def manifest_list(spark, d):
    return manifest.manifest_list(_ledger(spark, d), status="failed", vendor="feed_a").select("file_id", "vendor", "data_type", "rows_total")


@query(f"SELECT file_id, vendor, status, rows_total FROM {_LEDGER} WHERE file_id = 7", views=False)
def manifest_show(spark, d):
    return manifest.manifest_show(_ledger(spark, d), 7).select("file_id", "vendor", "status", "rows_total")


@query(f"SELECT 'bronze/' || file_id AS bronze_path FROM {_LEDGER} WHERE status <> 'success'", views=False)
def filter_pending(spark, d):
    ledger = _ledger(spark, d)
    return manifest.filter_pending(ledger.select(*manifest.IDENTITY), ledger).select("bronze_path")


@query(f"SELECT 'bronze/' || file_id AS bronze_path FROM {_LEDGER} WHERE vendor <> 'feed_a'", views=False)
def manifest_diff(spark, d):
    ledger = _ledger(spark, d)
    return manifest.manifest_diff(ledger.select("bronze_path"), ledger, "feed_a")


@query(
    f"SELECT 'bronze/' || file_id AS bronze_path, CASE WHEN file_id < 30 THEN file_id ELSE row_number() OVER (PARTITION BY file_id >= 30 ORDER BY vendor, data_type, 'bronze/' || file_id) + 29 END AS file_id FROM {_LEDGER}",
    views=False,
)
def manifest_ids(spark, d):
    ledger = _ledger(spark, d)
    return manifest.assign_ids(ledger.select(*manifest.IDENTITY), ledger.where("file_id < 30")).select("bronze_path", "file_id")


@query(
    "SELECT name, CASE WHEN k = 3 THEN NULL ELSE ['order_new', 'tick_new', 'L2_new'][k + 1] END AS stream,"
    " CASE WHEN k = 3 THEN NULL ELSE ['cn_order_events', 'cn_tick_events', 'cn_l2_snapshots'][k + 1] END AS \"table\","
    " CASE WHEN k = 3 THEN NULL ELSE 'szse' END AS exchange, CASE WHEN k <> 3 THEN o_orderdate::DATE END AS trading_date,"
    " CASE WHEN k = 3 THEN 'invalid archive name' END AS error FROM"
    " (SELECT o_orderdate, CAST(o_orderkey % 4 AS INTEGER) AS k, ['order_new', 'tick_new', 'L2_new', 'other'][CAST(o_orderkey % 4 AS INTEGER) + 1] || '_STK_SZ_'"
    " || strftime(o_orderdate, '%Y%m%d') || '.7z' AS name FROM orders)",
    views=False,
)
def parse_archive_names(spark, d):
    kinds = F.array(*(F.lit(x) for x in ("order_new", "tick_new", "L2_new", "other")))
    orders = spark.read.parquet(f"{d}/orders.parquet")
    kind = F.element_at(kinds, (F.col("o_orderkey") % 4 + 1).cast("int"))
    names = orders.select(F.concat(kind, F.lit("_STK_SZ_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit(".7z")).alias("name"))
    return files.parse_archive_names(names).select("name", "stream", "table", "exchange", "trading_date", "error")


# Data quality and signals


def _checks(table: str, checks: dict[str, str]) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{n}' AS \"check\", count(CASE WHEN {c} THEN 1 END) AS n_bad, count(CASE WHEN {c} THEN 1 END) = 0 AS passed FROM {table}"
        for n, c in checks.items()
    )
    return rows


def _null_checks(columns: str) -> dict[str, str]:
    return {f"null_{c}": f"{c} IS NULL" for c in columns.split()}


@query(
    _checks(
        "options",
        _null_checks("exchange symbol ts_event_us option_type strike")
        | {
            "wrong_trading_date": "trading_date <> CAST(make_timestamp(ts_event_us) AS DATE)",
            "negative_mark_price": "mark_price < 0",
            "mark_iv_out_of_range": "NOT mark_iv BETWEEN 0 AND 500",
            "delta_out_of_range": "abs(delta) > 1",
            "bad_option_type": "option_type NOT IN ('call', 'put')",
        },
    )
)
def dq_options(spark, d):
    return quality.options_report(v.options(spark, d))


@query(
    _checks(
        "liquidations",
        _null_checks("exchange symbol ts_event_us side price qty")
        | {"bad_side": "side NOT IN ('buy', 'sell')", "price_not_positive": "price <= 0", "qty_not_positive": "qty <= 0"},
    )
)
def dq_liquidations(spark, d):
    return quality.liquidations_report(v.liquidations(spark, d))


@query("SELECT symbol, count(*) AS n, CAST(sum(qty) AS DOUBLE) / 1e9 AS qty FROM liquidations GROUP BY symbol", "qty")
def dq_liquidations_by_symbol(spark, d):
    return quality.liquidations_by_symbol(v.liquidations(spark, d))


@query(
    "SELECT symbol, ts_event_us // 3600000000 AS ts_event_us, liquidation_id, count(*) AS n FROM liquidations GROUP BY ALL HAVING count(*) > 1"
)
def dq_repeated_liquidations(spark, d):
    hours = v.liquidations(spark, d).withColumn("ts_event_us", F.floor(F.col("ts_event_us") / F.lit(3_600_000_000)).cast("long"))
    return quality.repeated_liquidations(hours)


@query(
    _checks(
        "ticker",
        _null_checks("exchange symbol ts_event_us mark_price")
        | {
            "wrong_trading_date": "trading_date <> CAST(make_timestamp(ts_event_us) AS DATE)",
            "mark_not_positive": "mark_price <= 0",
            "funding_out_of_range": "abs(funding_rate) > 0.01",
            "index_not_positive": "index_price <= 0",
            "mark_far_from_index": "abs(mark_price - index_price) / CAST(nullif(index_price, 0) AS DOUBLE) > 0.01",
        },
    )
)
def dq_ticker(spark, d):
    return quality.ticker_report(v.ticker(spark, d))


@query(
    "SELECT symbol, count(*) AS n, avg(funding_rate) AS avg_funding, max(open_interest) / 1e9 AS max_oi FROM ticker GROUP BY symbol",
    "avg_funding max_oi",
)
def dq_ticker_by_symbol(spark, d):
    return quality.ticker_by_symbol(v.ticker(spark, d))


@query(
    "SELECT underlying_index, avg(mark_iv) AS avg_iv, median(mark_iv) AS median_iv, max(mark_iv) AS max_iv, count(*) AS n FROM options GROUP BY 1",
    "avg_iv median_iv max_iv",
)
def iv_summary(spark, d):
    return signals.iv_summary(v.options(spark, d))


@query(
    "SELECT underlying_index, avg(CASE WHEN abs(abs(delta) - 0.25) <= 0.05 AND option_type = 'call' THEN mark_iv END)"
    " - avg(CASE WHEN abs(abs(delta) - 0.25) <= 0.05 AND option_type = 'put' THEN mark_iv END) AS skew_25d FROM options GROUP BY 1",
    "skew_25d",
)
def iv_skew_25d(spark, d):
    return signals.iv_skew_25d(v.options(spark, d))


@query(
    "SELECT underlying_index, expiration_ts_us, avg(mark_iv) AS atm_iv, count(*) AS n FROM options WHERE abs(abs(delta) - 0.5) <= 0.1 GROUP BY ALL",
    "atm_iv",
)
def iv_term_structure(spark, d):
    return signals.iv_term_structure(v.options(spark, d))


@query("SELECT underlying_index, sum(gamma * open_interest) / sum(CAST(open_interest AS DOUBLE)) AS gamma_oi FROM options GROUP BY 1", "gamma_oi")
def gamma_oi_weighted(spark, d):
    return signals.gamma_oi_weighted(v.options(spark, d))


@query(
    ", o AS (SELECT *, (expiration_ts_us - ts_event_us) / 86400e6 AS t FROM options)"
    " SELECT underlying_index, round((avg(CASE WHEN abs(t - 30) <= 7 THEN mark_iv END) - avg(CASE WHEN abs(t - 7) <= 3.5 THEN mark_iv END)) / 23, 6) AS term_slope"
    " FROM o GROUP BY 1"
)
def term_slope(spark, d):
    return signals.term_slope(v.options(spark, d)).withColumn("term_slope", F.round("term_slope", 6))


@query(
    "SELECT symbol, avg(funding_rate) AS avg_funding, avg(funding_rate) * 3 * 365 AS annualised, max(open_interest) / 1e9 AS max_oi FROM ticker GROUP BY symbol",
    "avg_funding annualised max_oi",
)
def funding_rank(spark, d):
    return signals.funding_rank(v.ticker(spark, d))


_BASIS = "(mark_price - index_price) / CAST(nullif(index_price, 0) AS DOUBLE) * 10000"


@query(
    f"SELECT symbol, round(avg({_BASIS}), 3) AS avg_basis_bps, round(stddev_samp({_BASIS}), 3) AS std_basis_bps, round(max(abs({_BASIS})), 3) AS max_basis_bps FROM ticker GROUP BY symbol"
)
def basis_stats(spark, d):
    out = signals.basis_stats(v.ticker(spark, d))
    return out.withColumns({c: F.round(c, 3) for c in ("avg_basis_bps", "std_basis_bps", "max_basis_bps")})


@query("SELECT CAST(ts_event_us // 3600000000 % 24 AS INTEGER) AS hour, count(*) AS n FROM liquidations GROUP BY 1 HAVING count(*) > 5")
def liq_hourly_cascade(spark, d):
    return signals.liq_hourly_cascade(v.liquidations(spark, d), least=5)


@query(
    "SELECT symbol, side, count(*) AS n, CAST(sum(qty) AS DOUBLE) / 1e9 AS volume, max(qty) / 1e9 AS max_qty FROM liquidations GROUP BY ALL",
    "volume max_qty",
)
def liq_profile(spark, d):
    return signals.liq_profile(v.liquidations(spark, d))


@query(
    f", b AS (SELECT CASE WHEN qty < {10 * SCALE} THEN 0 WHEN qty < {50 * SCALE} THEN 1 WHEN qty < {90 * SCALE} THEN 2 ELSE 3 END AS band, count(*) AS n, sum(qty) AS q FROM liquidations GROUP BY 1)"
    " SELECT CAST(band AS INTEGER) AS band, n, round(CAST(q AS DOUBLE) / 1e9, 6) AS volume, round(CAST(n AS DOUBLE) / sum(n) OVER (), 6) AS share_n,"
    " round(CAST(q AS DOUBLE) / CAST(sum(q) OVER () AS DOUBLE), 6) AS share_volume FROM b"
)
def liq_size_buckets(spark, d):
    out = signals.liq_size_buckets(v.liquidations(spark, d), [10 * SCALE, 50 * SCALE, 90 * SCALE])
    return out.withColumns({c: F.round(c, 6) for c in ("volume", "share_n", "share_volume")})


@query("SELECT symbol, ts_event_us // 300000000 * 300000000 AS bucket_us, count(*) AS n FROM liquidations GROUP BY ALL")
def liq_velocity(spark, d):
    return signals.liq_velocity(v.liquidations(spark, d))


@query(
    f"SELECT symbol, CAST(sum(CASE WHEN qty >= {90 * SCALE} THEN qty ELSE 0 END) AS DOUBLE) / CAST(sum(qty) AS DOUBLE) AS whale_ratio FROM liquidations GROUP BY symbol",
    "whale_ratio",
)
def whale_ratio(spark, d):
    return signals.whale_ratio(v.liquidations(spark, d), 90 * SCALE)


_PR = "percent_rank() OVER (PARTITION BY symbol ORDER BY {0})"
_STEP = f"ts_event_us // {v.DAY} * {v.DAY} AS step_us"


@query(
    f", fu AS (SELECT symbol, {_STEP}, avg(funding_rate) AS funding FROM ticker GROUP BY ALL),"
    f" op AS (SELECT underlying_index AS symbol, {_STEP}, avg(mark_iv) AS iv, avg(CASE WHEN abs(abs(delta) - 0.25) <= 0.05 AND option_type = 'call' THEN mark_iv END)"
    " - avg(CASE WHEN abs(abs(delta) - 0.25) <= 0.05 AND option_type = 'put' THEN mark_iv END) AS call_skew FROM options GROUP BY ALL),"
    f" li AS (SELECT symbol, {_STEP}, count(*) / 288e0 AS velocity FROM liquidations GROUP BY ALL),"
    " four AS (SELECT * FROM fu JOIN op USING (symbol, step_us) JOIN li USING (symbol, step_us) WHERE call_skew IS NOT NULL),"
    " near AS (SELECT symbol, step_us, round(funding, 9) AS funding, round(call_skew, 9) AS call_skew, round(iv, 9) AS iv, velocity FROM four)"
    f" SELECT symbol, step_us, 30 * {_PR.format('funding')} + 30 * {_PR.format('call_skew')} + 20 * {_PR.format('iv')} + 20 * {_PR.format('velocity')} AS euphoria_index FROM near",
    "euphoria_index",
)
def euphoria_index(spark, d):
    four = signals.euphoria_inputs(v.ticker(spark, d), v.options(spark, d), v.liquidations(spark, d))
    four = four.withColumns({c: F.round(c, 9) for c in ("funding", "call_skew", "iv")})  # ties do not hang on the order of sums
    return signals.euphoria_index(four).select("symbol", "step_us", "euphoria_index")


@query(
    "SELECT file_seq, 0.02 / nullif(p / 1e9, 0) * 10000 AS spread_bps, 0.1 / nullif(p / 1e9, 0) * 10000 AS spread_deep_bps,"
    " ((5 * k + 15) - (515 - 5 * k)) / nullif(CAST((5 * k + 15) + (515 - 5 * k) AS DOUBLE), 0) AS depth_imbalance,"
    " 0.04 / nullif(CAST(4 * k + 14 AS DOUBLE), 0) AS bid_slope, 0.04 / nullif(CAST(414 - 4 * k AS DOUBLE), 0) AS ask_slope FROM e"
)
def book_features(spark, d):
    out = signals.book_features(v.snapshots(spark, d)).select("file_seq", "spread_bps", "spread_deep_bps", "depth_imbalance", "bid_slope", "ask_slope")
    return out.withColumns({c: F.round(c, 6 if c.endswith("slope") else 3) for c in out.columns[1:]})


ORACLES["book_features"] = ORACLES["book_features"].replace("SELECT file_seq, 0.02", "SELECT * REPLACE (" + ", ".join(
    f"round(CAST({c} AS DOUBLE), {6 if c.endswith('slope') else 3}) AS {c}" for c in ("spread_bps", "spread_deep_bps", "depth_imbalance", "bid_slope", "ask_slope")
) + ") FROM (SELECT file_seq, 0.02") + ")"

_DAILY = (
    ", daily AS (SELECT exchange, symbol, trading_date, arg_max(price, ts_event_us) / 1e9 AS close, CAST(sum(qty) AS DOUBLE) / 1e9 AS volume FROM trades GROUP BY ALL),"
)
_DW = "(PARTITION BY exchange, symbol ORDER BY trading_date)"
_D20 = "OVER (PARTITION BY exchange, symbol ORDER BY trading_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"
_DAILY_DOUBLES = "ret_1d ret_5d ret_20d vol_20d volume_z turnover_anomaly"


@query(
    _DAILY + " r AS (SELECT *, " + ", ".join(f"close / nullif(lag(close, {k}) OVER {_DW}, 0) - 1 AS ret_{k}d" for k in (1, 5, 20)) + " FROM daily),"
    f" x AS (SELECT exchange, symbol, trading_date, ret_1d, ret_5d, ret_20d, CASE WHEN count(ret_1d) {_D20} >= 20 THEN stddev_samp(ret_1d) {_D20} END * sqrt(252e0) AS vol_20d,"
    f" CASE WHEN count(volume) {_D20} >= 20 THEN (volume - avg(volume) {_D20}) / nullif(stddev_samp(volume) {_D20}, 0) END AS volume_z,"
    f" CASE WHEN count(volume) {_D20} >= 20 THEN volume / nullif(avg(volume) {_D20}, 0) END AS turnover_anomaly FROM r)"
    f" SELECT * REPLACE ({_replaced(_DAILY_DOUBLES)}) FROM x"
)
def daily_features(spark, d):
    daily = v.trades(spark, d).groupBy(*BY, "trading_date").agg(
        bars.decoded(bars.last_by_order("price")).alias("close"), bars.decoded(bars.exact_sum(F.col("qty"))).alias("volume")
    )
    doubles = _DAILY_DOUBLES.split()
    return signals.daily_features(daily).select(*BY, "trading_date", *doubles).withColumns({c: F.round(c, 4) for c in doubles})


@query(
    ", p AS (SELECT t.*, (ts_event_us // 60000000 + 480) % 1440 AS m FROM trades t)"
    f" SELECT symbol, trading_date, {_PHASE} AS trading_phase, round(CAST(sum(CASE side WHEN 'buy' THEN qty WHEN 'sell' THEN -qty ELSE 0 END) AS DOUBLE) / CAST(sum(qty) AS DOUBLE), 6) AS imbalance,"
    " round(CAST(sum(qty) AS DOUBLE) / 1e9, 6) AS volume FROM p GROUP BY ALL"
)
def session_imbalance(spark, d):
    rows = add_trading_phase(v.trades(spark, d), exchange=F.lit("szse"))
    return signals.session_imbalance(rows).withColumns({c: F.round(c, 6) for c in ("imbalance", "volume")})


_LARGE = f"CAST(price AS HUGEINT) * qty // {SCALE} > {3_000 * SCALE}"


@query(
    f"SELECT symbol, trading_date, CAST(sum(CASE WHEN {_LARGE} THEN qty ELSE 0 END) AS DOUBLE) / CAST(sum(qty) AS DOUBLE) AS large_trade_ratio,"
    f" CAST(count_if({_LARGE}) AS DOUBLE) / count(*) AS large_count_ratio, count(*) AS n FROM trades GROUP BY ALL",
    "large_trade_ratio large_count_ratio",
)
def large_trade_ratio(spark, d):
    return microstructure.large_trades(v.trades(spark, d), 3_000 * SCALE)


@query(
    "SELECT symbol, trading_date, count_if(event_kind = 'ADD') AS n_adds, count_if(event_kind = 'CANCEL') AS n_cancels,"
    " count_if(event_kind = 'ADD') / nullif(CAST(count_if(event_kind = 'CANCEL') AS DOUBLE), 0) AS order_to_cancel FROM orders_cn GROUP BY ALL",
    "order_to_cancel",
)
def order_to_cancel(spark, d):
    return signals.order_to_cancel(v.orders(spark, d))


@query(
    ", s AS (SELECT *, CASE side WHEN 'BUY' THEN 1 WHEN 'SELL' THEN -1 ELSE 0 END AS g FROM orders_cn),"
    " b AS (SELECT *, lag(g) OVER w AS h FROM s WINDOW w AS (PARTITION BY symbol, trading_date ORDER BY channel_id, channel_seq)),"
    " u AS (SELECT *, sum(CASE WHEN h IS NULL OR g <> h THEN 1 ELSE 0 END) OVER (PARTITION BY symbol, trading_date ORDER BY channel_id, channel_seq ROWS UNBOUNDED PRECEDING) AS run_no FROM b),"
    " l AS (SELECT symbol, trading_date, run_no, count(*) AS n FROM u GROUP BY ALL),"
    " x AS (SELECT symbol, trading_date, max(n) AS longest_run FROM l GROUP BY ALL),"
    " a AS (SELECT symbol, trading_date, CAST(sum(CASE WHEN event_kind = 'ADD' THEN g * qty END) AS DOUBLE) / nullif(CAST(sum(CASE WHEN event_kind = 'ADD' THEN qty END) AS DOUBLE), 0) AS ofi,"
    " CAST(sum(CASE WHEN event_kind = 'CANCEL' THEN g * qty END) AS DOUBLE) / nullif(CAST(sum(CASE WHEN event_kind = 'CANCEL' THEN qty END) AS DOUBLE), 0) AS cancel_imbalance,"
    " count_if(event_kind = 'ADD') / nullif(CAST(count_if(event_kind = 'CANCEL') AS DOUBLE), 0) AS add_cancel_ratio FROM u GROUP BY ALL),"
    " e5 AS (SELECT symbol, trading_date, g, lag(g, 5) OVER (PARTITION BY symbol, trading_date, channel_id ORDER BY channel_seq) AS h5 FROM s),"
    " c5 AS (SELECT symbol, trading_date, CASE WHEN var_pop(CASE WHEN h5 IS NOT NULL THEN g END) > 0 AND var_pop(h5) > 0 THEN corr(g, h5) END AS sign_correlation FROM e5 GROUP BY ALL)"
    " SELECT symbol, trading_date, round(ofi, 6) AS ofi, round(cancel_imbalance, 6) AS cancel_imbalance, round(add_cancel_ratio, 6) AS add_cancel_ratio,"
    " round(sign_correlation, 6) + 0e0 AS sign_correlation, longest_run FROM a JOIN x USING (symbol, trading_date) JOIN c5 USING (symbol, trading_date)"
)
def l3_order_flow(spark, d):
    out = signals.l3_order_flow(v.orders(spark, d))
    return out.withColumns({c: F.round(c, 6) for c in ("ofi", "cancel_imbalance", "add_cancel_ratio", "sign_correlation")})


_REPLAY = "exchange, symbol, channel_id NULLS FIRST, channel_seq NULLS FIRST, ts_event_us, file_id, file_seq, event_table"


@query(
    f"SELECT event_table, exchange, symbol, ts_event_us, file_seq, row_number() OVER (ORDER BY {_REPLAY}) - 1 AS place FROM (SELECT 'trades' AS event_table, * FROM trades"
    " UNION ALL BY NAME SELECT 'quotes' AS event_table, * FROM quotes UNION ALL BY NAME SELECT 'cn_order_events' AS event_table, * FROM orders_cn)"
)
def replay_event_table(spark, d):
    out = signals.replay_events(("trades", v.trades(spark, d)), ("quotes", v.quotes(spark, d)), ("cn_order_events", v.orders(spark, d)))
    order = ("exchange", "symbol", "channel_id", "channel_seq", "ts_event_us", "file_id", "file_seq", "event_table")
    placed = windows.row_index(out.select(*order), order, "place")
    return placed.select("event_table", *BY, "ts_event_us", "file_seq", "place")


_Z = "OVER (PARTITION BY underlying_index ORDER BY trading_date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"


@query(
    ", n AS (SELECT *, abs(abs(delta) - 0.25) <= 0.05 AS near FROM options), s AS (SELECT underlying_index, trading_date,"
    " avg(CASE WHEN near AND option_type = 'call' THEN mark_iv END) - avg(CASE WHEN near AND option_type = 'put' THEN mark_iv END) AS skew_25d"
    " FROM n GROUP BY ALL),"
    f" z AS (SELECT *, CASE WHEN count(skew_25d) {_Z} >= 5 THEN (skew_25d - avg(skew_25d) {_Z}) / nullif(stddev_samp(skew_25d) {_Z}, 0) END AS z FROM s)"
    " SELECT underlying_index, trading_date, round(skew_25d, 6) + 0e0 AS skew_25d, round(z, 6) + 0e0 AS z FROM z"
)
def skew_zscore(spark, d):
    skew = signals.iv_skew_25d(v.options(spark, d), by=("underlying_index", "trading_date"))
    out = signals.rolling_zscore(skew, "skew_25d", 5, ("underlying_index",), "trading_date", "z")
    return out.select("underlying_index", "trading_date", F.round("skew_25d", 6).alias("skew_25d"), F.round("z", 6).alias("z"))


@query(
    ", i AS (SELECT underlying_index AS symbol, avg(mark_iv) AS avg_iv FROM options GROUP BY 1), f AS (SELECT symbol, avg(funding_rate) AS funding_rate FROM ticker GROUP BY 1)"
    " SELECT symbol, round(avg_iv - funding_rate * 3 * 365, 6) AS iv_funding_spread FROM i JOIN f USING (symbol)"
)
def iv_funding_spread(spark, d):
    iv = signals.iv_summary(v.options(spark, d)).select(F.col("underlying_index").alias("symbol"), "avg_iv")
    rates = v.ticker(spark, d).groupBy("symbol").agg(F.avg("funding_rate").alias("funding_rate"))
    out = signals.iv_funding_spread(iv.join(rates, "symbol"))
    return out.select("symbol", F.round("iv_funding_spread", 6).alias("iv_funding_spread"))


@query(
    "SELECT p AS bronze_path, 'szse' AS exchange, 'order_new' AS data_type, o_orderdate::DATE AS \"date\", s AS symbol FROM"
    " (SELECT o_orderdate, CAST(o_custkey AS VARCHAR) AS s, 'bronze/exchange=SZSE/type=order_new/date=' || strftime(o_orderdate, '%Y-%m-%d') || '/symbol=' || o_custkey || '/' || o_orderkey || '.csv.gz' AS p FROM orders)",
    views=False,
)
def discover_bronze_partitions(spark, d):
    orders = spark.read.parquet(f"{d}/orders.parquet")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    path = F.format_string("bronze/exchange=SZSE/type=order_new/date=%s/symbol=%d/%d.csv.gz", day, "o_custkey", "o_orderkey")
    both = orders.select(path.alias("bronze_path")).unionByName(orders.select(F.lit("bronze/other.txt").alias("bronze_path")))
    return files.discover_partitions(both, exchange="szse")


# Joins and sums of the wide tables


@query(
    "SELECT n_name, count(*) AS n_orders, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM lineitem"
    " JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name",
    views=False,
)
def join_aggregate_wide(spark, d):
    read = lambda t: spark.read.parquet(f"{d}/{t}.parquet")
    joined = (
        read("lineitem")
        .join(read("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(read("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    return joined.groupBy("n_name").agg(
        F.count("*").alias("n_orders"), F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")).alias("cents")
    )


from . import ingest_queries, microstructure_queries  # noqa: E402, F401  register their queries
