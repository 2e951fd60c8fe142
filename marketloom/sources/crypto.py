"""Crypto vendor files to table columns.

Each function takes raw columns and returns the table's columns but for lineage, date and symbol_id.  A row
without any timestamp gets ``parse_error``; other columns of the input, such as the path, stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..core.numeric import to_fixed

ERROR = "parse_error"
_KEEP = ("bronze_path", "file_id", "file_seq")


def _need(df: DataFrame, *columns: str) -> None:
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"columns are missing: {missing}")


def _text(name: str) -> Column:
    return F.trim(F.col(name).cast("string"))


def _optional(df: DataFrame, names: str | tuple[str, ...], kind: str) -> Column:
    """The first of the columns that the file has, as fixed-point ('fixed') or a type; typed null otherwise."""
    for n in (names,) if isinstance(names, str) else names:
        if n in df.columns:
            return to_fixed(F.col(n)) if kind == "fixed" else F.col(n).cast(kind)
    return F.lit(None).cast("long" if kind == "fixed" else kind)


def _event(df: DataFrame, **columns: Column) -> DataFrame:
    _need(df, "exchange", "symbol")
    times = [F.col(c).cast("long") for c in ("timestamp", "local_timestamp") if c in df.columns]
    if not times:
        raise ValueError("columns are missing: timestamp or local_timestamp")
    at = F.coalesce(*times)
    return df.select(
        F.lower(_text("exchange")).alias("exchange"),
        _text("symbol").alias("symbol"),
        at.alias("ts_event_us"),
        _optional(df, "local_timestamp", "long").alias("ts_local_us"),
        *(c.alias(n) for n, c in columns.items()),
        *(F.col(c) for c in _KEEP if c in df.columns),
        F.when(at.isNull(), F.lit("missing timestamp")).alias(ERROR),
    )


def trades(df: DataFrame) -> DataFrame:
    _need(df, "side", "price", "amount")
    return _event(
        df,
        trade_id=_optional(df, "id", "string"),
        side=F.lower(_text("side")),
        is_buyer_maker=F.lit(None).cast("boolean"),
        price=to_fixed(F.col("price")),
        qty=to_fixed(F.col("amount")),
    )


def quotes(df: DataFrame) -> DataFrame:
    _need(df, "bid_price", "bid_amount", "ask_price", "ask_amount")
    return _event(
        df,
        bid_price=to_fixed(F.col("bid_price")),
        bid_qty=to_fixed(F.col("bid_amount")),
        ask_price=to_fixed(F.col("ask_price")),
        ask_qty=to_fixed(F.col("ask_amount")),
        seq_num=_optional(df, ("seq_num", "sequence_number", "last_update_id", "update_id"), "long"),
    )


def book(df: DataFrame) -> DataFrame:
    _need(df, "side", "price", "amount", "is_snapshot")
    return _event(
        df,
        book_seq=_optional(df, ("book_seq", "sequence_number", "seq_num", "update_id"), "long"),
        side=F.lower(_text("side")),
        price=to_fixed(F.col("price")),
        qty=to_fixed(F.col("amount")),
        is_snapshot=F.col("is_snapshot").cast("boolean"),
    )


def ticker(df: DataFrame) -> DataFrame:
    _need(df, "mark_price")
    return _event(
        df,
        mark_price=to_fixed(F.col("mark_price")),
        index_price=_optional(df, "index_price", "fixed"),
        last_price=_optional(df, "last_price", "fixed"),
        open_interest=_optional(df, "open_interest", "fixed"),
        funding_rate=_optional(df, "funding_rate", "double"),
        predicted_funding_rate=_optional(df, "predicted_funding_rate", "double"),
        funding_ts_us=_optional(df, "funding_timestamp", "long"),
    )


def liquidations(df: DataFrame) -> DataFrame:
    _need(df, "side", "price", "amount")
    return _event(
        df,
        liquidation_id=_optional(df, "id", "string"),
        side=F.lower(_text("side")),
        price=to_fixed(F.col("price")),
        qty=to_fixed(F.col("amount")),
    )


def options(df: DataFrame) -> DataFrame:
    _need(df, "type", "strike_price", "expiration")
    fixed = {
        "open_interest": "open_interest",
        "last_price": "last_price",
        "bid_price": "bid_price",
        "ask_price": "ask_price",
        "mark_price": "mark_price",
        "bid_qty": "bid_amount",
        "ask_qty": "ask_amount",
    }
    plain = ("bid_iv", "ask_iv", "mark_iv")
    greeks = ("delta", "gamma", "vega", "theta", "rho")
    return _event(
        df,
        option_type=F.lower(_text("type")),
        strike=to_fixed(F.col("strike_price")),
        expiration_ts_us=F.col("expiration").cast("long"),
        **{n: _optional(df, raw, "fixed") for n, raw in fixed.items()},
        **{n: _optional(df, n, "double") for n in plain},
        underlying_index=_optional(df, "underlying_index", "string"),
        underlying_price=_optional(df, "underlying_price", "fixed"),
        **{n: _optional(df, n, "double") for n in greeks},
    )
