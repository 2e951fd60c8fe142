"""Data-quality reports: rows of (check, n_bad, passed), and summaries per symbol."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..core.timeutil import trading_date
from .bars import decoded

#: Fixed value: largest absolute funding rate, and relative mark-to-index gap, that are not flagged.
FUNDING_LIMIT = MARK_GAP_LIMIT = 0.01


def _report(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One pass over ``df``: how many rows each condition finds."""
    one = df.agg(*(F.count_if(F.coalesce(c, F.lit(False))).alias(f"c{i}") for i, c in enumerate(checks.values())))
    rows = F.array(*(F.struct(F.lit(n).alias("check"), F.col(f"c{i}").alias("n_bad")) for i, n in enumerate(checks)))
    return one.select(F.inline(rows)).withColumn("passed", F.col("n_bad") == 0)


def _nulls(columns: Sequence[str]) -> dict[str, Column]:
    return {f"null_{c}": F.col(c).isNull() for c in columns}


def _wrong_date() -> Column:
    return F.col("trading_date") != trading_date(F.col("ts_event_us"), F.col("exchange"))


def options_report(df: DataFrame) -> DataFrame:
    return _report(
        df,
        _nulls(("exchange", "symbol", "ts_event_us", "option_type", "strike"))
        | {
            "wrong_trading_date": _wrong_date(),
            "negative_mark_price": F.col("mark_price") < 0,
            "mark_iv_out_of_range": ~F.col("mark_iv").between(0, 500),
            "delta_out_of_range": F.abs("delta") > 1,
            "bad_option_type": ~F.col("option_type").isin("call", "put"),
        },
    )


def liquidations_report(df: DataFrame) -> DataFrame:
    return _report(
        df,
        _nulls(("exchange", "symbol", "ts_event_us", "side", "price", "qty"))
        | {
            "bad_side": ~F.col("side").isin("buy", "sell"),
            "price_not_positive": F.col("price") <= 0,
            "qty_not_positive": F.col("qty") <= 0,
        },
    )


def liquidations_by_symbol(df: DataFrame) -> DataFrame:
    return df.groupBy("symbol").agg(F.count("*").alias("n"), decoded(F.sum(F.col("qty").cast("decimal(19,0)"))).alias("qty"))


def repeated_liquidations(df: DataFrame) -> DataFrame:
    """(symbol, ts_event_us, liquidation_id, n) that occur more than once."""
    return df.groupBy("symbol", "ts_event_us", "liquidation_id").agg(F.count("*").alias("n")).where("n > 1")


def ticker_report(df: DataFrame) -> DataFrame:
    gap = F.abs(F.col("mark_price") - F.col("index_price")) / F.when(F.col("index_price") != 0, F.col("index_price"))
    return _report(
        df,
        _nulls(("exchange", "symbol", "ts_event_us", "mark_price"))
        | {
            "wrong_trading_date": _wrong_date(),
            "mark_not_positive": F.col("mark_price") <= 0,
            "funding_out_of_range": F.abs("funding_rate") > FUNDING_LIMIT,
            "index_not_positive": F.col("index_price") <= 0,
            "mark_far_from_index": gap > MARK_GAP_LIMIT,
        },
    )


def ticker_by_symbol(df: DataFrame) -> DataFrame:
    return df.groupBy("symbol").agg(
        F.count("*").alias("n"), F.avg("funding_rate").alias("avg_funding"), decoded(F.max("open_interest")).alias("max_oi")
    )


def coverage(df: DataFrame, table: str) -> DataFrame:
    """(table, exchange, symbol, first_date, last_date, n) of an event table."""
    return df.groupBy(F.lit(table).alias("table"), "exchange", "symbol").agg(
        F.min("trading_date").alias("first_date"), F.max("trading_date").alias("last_date"), F.count("*").alias("n")
    )


def data_coverage(tables: dict[str, DataFrame], dim: DataFrame, exchange: str, symbol: str) -> DataFrame:
    """(table, available, symbol_id, n, reason) of one symbol for each table."""
    ids = dim.where((F.col("exchange") == exchange) & (F.col("exchange_symbol") == symbol)).agg(
        F.max_by("symbol_id", "valid_from_ts_us").alias("symbol_id")
    )
    out = None
    for name, df in tables.items():
        n = df.where((F.col("exchange") == exchange) & (F.col("symbol") == symbol)).agg(F.count("*").alias("n"))
        row = n.crossJoin(ids).select(  # a row each
            F.lit(name).alias("table"),
            (F.col("symbol_id").isNotNull() & (F.col("n") > 0)).alias("available"),
            "symbol_id",
            "n",
            F.when(F.col("symbol_id").isNull(), "unknown symbol").when(F.col("n") == 0, "no rows").alias("reason"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def list_exchanges(dim: DataFrame) -> DataFrame:
    return dim.select("exchange").distinct()


def list_symbols(
    dim: DataFrame, exchange: str | None = None, base_asset: str | None = None, quote_asset: str | None = None, market_type: str | None = None
) -> DataFrame:
    """Current symbols by equality on what is given."""
    rows = dim.where("is_current")
    for column, value in (("exchange", exchange), ("base_asset", base_asset), ("quote_asset", quote_asset), ("market_type", market_type)):
        if value is not None:
            rows = rows.where(F.lower(column) == value.strip().lower())
    return rows.select("exchange", "exchange_symbol", "canonical_symbol", "market_type", "base_asset", "quote_asset", "symbol_id")


def summarize_symbol(dim: DataFrame, exchange: str, symbol: str) -> DataFrame:
    """One row per symbol: versions, first start, and the current version's fields."""
    rows = dim.where((F.col("exchange") == exchange) & (F.col("exchange_symbol") == symbol))
    return rows.groupBy("exchange", "exchange_symbol").agg(
        F.count("*").alias("n_versions"),
        F.min("valid_from_ts_us").alias("first_valid_from_us"),
        F.max_by("tick_size", "valid_from_ts_us").alias("tick_size"),
        F.max("is_current").alias("is_current"),
    )
