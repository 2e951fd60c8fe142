"""Row rules with a quarantine reason.  Invalid rows get a reason and are kept, never dropped."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "quarantine_reason"


def _true(condition: Column) -> Column:
    """A rule that meets a null counts as broken."""
    return F.coalesce(condition, F.lit(True))


def _side_not(column: str, *allowed: str) -> Column:
    return _true(~F.lower(F.trim(column)).isin(*allowed))


def _not_positive(*columns: str) -> Column:
    return reduce(or_, (_true(F.col(c) <= 0) for c in columns))


def _negative(*columns: str) -> Column:
    return reduce(or_, (_true(F.col(c) < 0) for c in columns))


def _crossed() -> Column:
    return F.coalesce(F.col("bid_price") > F.col("ask_price"), F.lit(False))


def rules(table: str) -> list[tuple[str, Column]]:
    """(reason, broken) of each rule of a table, first reason first."""
    sse = F.coalesce(F.lower(F.trim("exchange")) == "sse", F.lit(False))
    missing = lambda *cs: sse & reduce(or_, (F.col(c).isNull() for c in cs))
    made = {
        "trades": lambda: [
            (
                "invalid_trade_side_or_values",
                _side_not("side", "buy", "sell", "unknown") | _not_positive("price", "qty"),
            )
        ],
        "quotes": lambda: [
            (
                "invalid_quote_top_of_book",
                _not_positive("bid_price", "ask_price") | _negative("bid_qty", "ask_qty") | _crossed(),
            )
        ],
        "orderbook_updates": lambda: [
            (
                "invalid_orderbook_update_values",
                _side_not("side", "bid", "ask") | _not_positive("price") | _negative("qty") | F.col("is_snapshot").isNull(),
            )
        ],
        "derivative_ticker": lambda: [("invalid_derivative_ticker_mark_price", _not_positive("mark_price"))],
        "liquidations": lambda: [
            ("invalid_liquidation_side_or_values", _side_not("side", "buy", "sell") | _not_positive("price", "qty"))
        ],
        "options_chain": lambda: [
            (
                "invalid_options_chain_contract",
                _side_not("option_type", "call", "put") | _not_positive("strike", "expiration_ts_us"),
            )
        ],
        "cn_order_events": lambda: [("missing_sse_order_sequence_fields", missing("channel_biz_seq", "symbol_order_seq"))],
        "cn_tick_events": lambda: [("missing_sse_tick_sequence_fields", missing("channel_biz_seq", "symbol_trade_seq"))],
    }
    return made.get(table, list)()


def mark(df: DataFrame, table: str) -> DataFrame:
    """Adds ``quarantine_reason``: the first broken rule, or null.  A reason that is there stays."""
    out = F.col(REASON) if REASON in df.columns else F.lit(None).cast("string")
    for reason, broken in rules(table):
        out = F.coalesce(out, F.when(broken, F.lit(reason)))
    return df.withColumn(REASON, out)


def split(df: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their reason)."""
    marked = mark(df, table)
    return marked.where(F.col(REASON).isNull()).drop(REASON), marked.where(F.col(REASON).isNotNull())


def reasons(df: DataFrame, by: str = "file_id") -> DataFrame:
    """(by, reasons): the distinct reasons of each file in order of name, joined by +."""
    return (
        df.where(F.col(REASON).isNotNull())
        .groupBy(by)
        .agg(F.concat_ws("+", F.array_sort(F.collect_set(REASON))).alias("reasons"))
    )
