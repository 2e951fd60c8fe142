"""Exchange-level files of sse and szse to table columns, straight from raw text columns.

Bad rows get ``parse_error``; the ingest job then leaves their whole file out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..core.numeric import to_fixed
from .crypto import _KEEP, ERROR, _need

LEVELS = 10


def timestamp_us(column: str) -> Column:
    """17 digits yyyyMMddHHmmssSSS in Shanghai as UTC microseconds; null where the shape is bad."""
    text = F.trim(F.col(column).cast("string"))
    part = lambda a, n: F.substring(text, a, n)
    plain = F.concat_ws(" ", F.concat_ws("-", part(1, 4), part(5, 2), part(7, 2)), F.concat_ws(":", part(9, 2), part(11, 2), part(13, 2)))
    local = F.try_to_timestamp(plain, F.lit("yyyy-MM-dd HH:mm:ss"))
    millis = F.try_to_number(part(15, 3), F.lit("999")).cast("long")
    at = F.unix_micros(F.to_utc_timestamp(local, "Asia/Shanghai")) + millis * 1000
    return F.when(text.rlike(r"^[0-9]{17}$"), at)


def symbol_code(column: Column) -> Column:
    """Numeric codes padded to six digits; others as they are."""
    text = F.trim(column.cast("string"))
    return F.when(text.rlike("^[0-9]+$") & (F.length(text) < 6), F.lpad(text, 6, "0")).otherwise(text)


def _code(df: DataFrame, column: str) -> Column:
    return F.upper(F.trim(F.col(column).cast("string"))) if column in df.columns else F.lit(None).cast("string")


def _long(df: DataFrame, column: str, kind: str = "long") -> Column:
    return F.col(column).cast(kind) if column in df.columns else F.lit(None).cast(kind)


def _side(code: Column) -> Column:
    return F.when(code.isin("1", "B"), "BUY").when(code.isin("2", "S"), "SELL").otherwise("UNKNOWN")


def _file_symbol(df: DataFrame, symbol: str | None) -> Column:
    return symbol_code(F.lit(symbol) if symbol is not None else F.col("symbol"))


def _select(df: DataFrame, exchange: str, symbol: str | None, ts: str, error: Column, columns: dict[str, Column]) -> DataFrame:
    at = timestamp_us(ts)
    made = {"ts_local_us": F.lit(None).cast("long")} | columns
    return df.select(
        F.lit(exchange).alias("exchange"),
        _file_symbol(df, symbol).alias("symbol"),
        at.alias("ts_event_us"),
        *(c.alias(n) for n, c in made.items()),
        *(F.col(c) for c in _KEEP if c in df.columns),
        F.coalesce(F.when(at.isNull(), F.lit("bad timestamp")), error).alias(ERROR),
    )


def _mismatch(df: DataFrame, symbol: str | None) -> Column:
    """The file's security must be the one that its path names."""
    return F.when(symbol_code(F.col("SecurityID")) != _file_symbol(df, symbol), F.lit("Symbol mismatch"))


def orders(df: DataFrame, exchange: str, symbol: str | None = None) -> DataFrame:
    """Order events.  ``symbol`` is the path's; without it a column ``symbol`` must hold it."""
    exchange = exchange.strip().lower()
    if exchange == "sse":
        _need(df, "SecurityID", "TransactTime", "OrderNo", "Price", "Balance", "OrderBSFlag", "OrdType", "ChannelNo")
        seq, qty, side, action = "OrderNo", "Balance", _code(df, "OrderBSFlag"), _code(df, "OrdType")
        kind = F.when(action == "A", "ADD").when(action == "D", "CANCEL").otherwise("UNKNOWN")
        order_type, error = F.lit(None).cast("string"), _mismatch(df, symbol)
    elif exchange == "szse":
        _need(df, "ApplSeqNum", "Side", "OrdType", "Price", "OrderQty", "TransactTime", "ChannelNo")
        seq, qty, side, code = "ApplSeqNum", "OrderQty", _code(df, "Side"), _code(df, "OrdType")
        kind = F.lit("ADD")
        order_type = F.when(code == "1", "MARKET").when(code == "2", "LIMIT").otherwise("UNKNOWN")
        error = F.lit(None).cast("string")
    else:
        raise ValueError(f"unsupported exchange {exchange!r}")
    return _select(
        df,
        exchange,
        symbol,
        "TransactTime",
        error,
        {
            "channel_id": _long(df, "ChannelNo", "int"),
            "channel_seq": _long(df, seq),
            "channel_biz_seq": _long(df, "BizIndex") if exchange == "sse" else F.lit(None).cast("long"),
            "symbol_order_seq": _long(df, "OrderIndex") if exchange == "sse" else F.lit(None).cast("long"),
            "order_ref": _long(df, seq),
            "event_kind": kind,
            "side": _side(side),
            "order_type": order_type,
            "price": to_fixed(F.col("Price")),
            "qty": to_fixed(F.col(qty)),
        },
    )


def ticks(df: DataFrame, exchange: str, symbol: str | None = None) -> DataFrame:
    """Trades and cancels.  An execution type other than F or 4 is an error of its file."""
    exchange = exchange.strip().lower()
    if exchange == "sse":
        _need(df, "SecurityID", "TradeTime", "TradePrice", "TradeQty", "BuyNo", "SellNo", "ChannelNo")
        ts, price, qty, bid, ask = "TradeTime", "TradePrice", "TradeQty", "BuyNo", "SellNo"
        seq, execution, error = F.coalesce(_long(df, "ApplSeqNum"), _long(df, "TradeIndex")), F.lit("F"), _mismatch(df, symbol)
        flag = _code(df, "TradeBSFlag")
        side = F.when(flag.isNull(), F.lit(None).cast("string")).when(flag == "B", "BUY").when(flag == "S", "SELL").otherwise("UNKNOWN")
        biz, trade = _long(df, "BizIndex"), _long(df, "TradeIndex")
    elif exchange == "szse":
        _need(df, "ApplSeqNum", "BidApplSeqNum", "OfferApplSeqNum", "Price", "Qty", "ExecType", "TransactTime", "ChannelNo")
        ts, price, qty, bid, ask = "TransactTime", "Price", "Qty", "BidApplSeqNum", "OfferApplSeqNum"
        seq, execution, side = _long(df, "ApplSeqNum"), _code(df, "ExecType"), F.lit(None).cast("string")
        error = F.when(~execution.isin("F", "4"), F.lit("unsupported execution type"))
        biz = trade = F.lit(None).cast("long")
    else:
        raise ValueError(f"unsupported exchange {exchange!r}")
    return _select(
        df,
        exchange,
        symbol,
        ts,
        error,
        {
            "channel_id": _long(df, "ChannelNo", "int"),
            "channel_seq": seq,
            "channel_biz_seq": biz,
            "symbol_trade_seq": trade,
            "bid_order_ref": _long(df, bid),
            "ask_order_ref": _long(df, ask),
            "event_kind": F.when(execution == "F", "TRADE").when(execution == "4", "CANCEL").otherwise("UNKNOWN"),
            "aggressor_side": side,
            "price": to_fixed(F.col(price)),
            "qty": to_fixed(F.col(qty)),
        },
    )


def snapshots(df: DataFrame, exchange: str, symbol: str | None = None) -> DataFrame:
    """Ten-level snapshots of szse.  Ladders are JSON arrays of ten items; others are an error of the file."""
    if exchange.strip().lower() != "szse":
        raise ValueError("snapshots are supported for szse only")
    _need(df, "MsgSeqNum", "QuotTime", "BidPrice", "BidOrderQty", "OfferPrice", "OfferOrderQty")
    ladder = lambda c, t: F.from_json(F.col(c).cast("string"), f"array<{t}>")
    prices = {n: F.transform(ladder(c, "double"), lambda x: to_fixed(x)) for n, c in (("bid_price_levels", "BidPrice"), ("ask_price_levels", "OfferPrice"))}
    sizes = {n: ladder(c, "bigint") for n, c in (("bid_qty_levels", "BidOrderQty"), ("ask_qty_levels", "OfferOrderQty"))}
    error = F.lit(None).cast("string")
    for column in (*prices.values(), *sizes.values()):
        whole = (F.size(column) == LEVELS) & ~F.exists(column, lambda x: x.isNull())
        error = F.coalesce(error, F.when(~F.coalesce(whole, F.lit(False)), F.lit(f"expected {LEVELS} levels")))
    return _select(
        df,
        "szse",
        symbol,
        "QuotTime",
        error,
        {
            "ts_local_us": timestamp_us("SendingTime") if "SendingTime" in df.columns else F.lit(None).cast("long"),
            "snapshot_seq": _long(df, "MsgSeqNum"),
            "image_status": _long(df, "ImageStatus", "string"),
            "trading_phase_code": _long(df, "TradingPhaseCode", "string"),
        }
        | prices
        | sizes,
    )
