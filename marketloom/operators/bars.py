"""Bars: aggregates of aligned events per spine point, or per minute.

Prices and quantities are fixed-point longs.  Sums of quantities and notionals are exact decimals, decoded once at
the end, so a bar does not depend on the order in which rows meet.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..core.numeric import divide, wide
from ..core.specs import SCALE
from .scan import previous

BAR = ("exchange", "symbol", "ts_spine_us")
ORDER = ("ts_event_us", "file_id", "file_seq")
#: 5-minute buckets, and buckets to the hour.
BUCKET_US, PER_HOUR = 300_000_000, 12


def decoded(value: Column) -> Column:
    return value.cast("double") / F.lit(float(SCALE))


def exact_sum(value: Column) -> Column:
    return F.sum(wide(value))


def vwap(price: str = "price", qty: str = "qty") -> Column:
    amount = F.sum((wide(F.col(price)) * wide(F.col(qty))).cast("decimal(38,0)"))
    return divide(amount, exact_sum(F.col(qty))) / F.lit(float(SCALE))


def first_by_order(column: str, order: Sequence[str] = ORDER) -> Column:
    return F.min_by(column, F.struct(*order))


def last_by_order(column: str, order: Sequence[str] = ORDER) -> Column:
    return F.max_by(column, F.struct(*order))


def _signed(side: str) -> Column:
    return F.coalesce(F.sum(F.when(F.col("side") == side, wide(F.col("qty")))), F.lit(0).cast("decimal(38,0)"))


def trade_bars(aligned: DataFrame, keys: Sequence[str] = BAR) -> DataFrame:
    """OHLC, volume, count, VWAP, flow imbalance, sizes and price deviation per bar; unassigned events are left out."""
    rows = aligned.where(F.col(keys[-1]).isNotNull())
    total = exact_sum(F.col("qty"))
    return rows.groupBy(*keys).agg(
        decoded(first_by_order("price")).alias("open"),
        decoded(F.max("price")).alias("high"),
        decoded(F.min("price")).alias("low"),
        decoded(last_by_order("price")).alias("close"),
        decoded(total).alias("volume"),
        F.count("*").alias("trade_count"),
        vwap().alias("vwap"),
        divide(_signed("buy") - _signed("sell"), total).alias("flow_imbalance"),
        decoded(divide(total, F.count("*"))).alias("avg_size"),
        decoded(F.median("qty")).alias("median_size"),
        F.stddev_samp(decoded(F.col("price"))).alias("price_std"),
    )


def time_bars(trades: DataFrame, width: str = "1 minute", ts: str = "ts_event_us") -> DataFrame:
    """Tumbling bars per exchange and symbol; works on a stream as well."""
    stamped = trades.withColumn("__ts", F.timestamp_micros(ts))
    return (
        stamped.groupBy("exchange", "symbol", F.window("__ts", width).alias("w"))
        .agg(
            decoded(first_by_order("price")).alias("open"),
            decoded(F.max("price")).alias("high"),
            decoded(F.min("price")).alias("low"),
            decoded(last_by_order("price")).alias("close"),
            decoded(exact_sum(F.col("qty"))).alias("volume"),
            F.count("*").alias("trade_count"),
        )
        .select("exchange", "symbol", F.unix_micros("w.start").alias("bar_start_us"), "open", "high", "low", "close", "volume", "trade_count")
    )


def trade_stats(trades: DataFrame) -> DataFrame:
    """One row: price range and mean, volume, count and VWAP."""
    return trades.agg(
        decoded(F.min("price")).alias("min_price"),
        decoded(F.max("price")).alias("max_price"),
        decoded(divide(exact_sum(F.col("price")), F.count("price"))).alias("mean_price"),
        decoded(exact_sum(F.col("qty"))).alias("volume"),
        F.count("*").alias("trade_count"),
        vwap().alias("vwap"),
    )


def stats_by_side(trades: DataFrame) -> DataFrame:
    return trades.groupBy("side").agg(
        decoded(exact_sum(F.col("qty"))).alias("volume"),
        decoded(divide(exact_sum(F.col("price")), F.count("price"))).alias("mean_price"),
        F.count("*").alias("trade_count"),
    )


def hl_spread_bars(aligned: DataFrame, keys: Sequence[str] = BAR, prefix: str = "") -> DataFrame:
    """(high - low) / close per bar, with VWAP, volume, flow and close, named with a prefix."""
    bars = trade_bars(aligned, keys)
    return bars.select(
        *keys,
        F.col("close").alias(f"{prefix}close"),
        F.col("vwap").alias(f"{prefix}vwap"),
        F.col("volume").alias(f"{prefix}volume"),
        F.col("flow_imbalance").alias(f"{prefix}flow_imbalance"),
        F.col("price_std").alias(f"{prefix}volatility"),
        divide(F.col("high") - F.col("low"), F.col("close")).alias(f"{prefix}hl_spread"),
    )


def funding_bars(aligned: DataFrame, keys: Sequence[str] = BAR) -> DataFrame:
    """Funding and open interest of ticker rows per bar."""
    rows = aligned.where(F.col(keys[-1]).isNotNull())
    first, last = first_by_order, last_by_order
    return rows.groupBy(*keys).agg(
        first("funding_rate").alias("funding_open"),
        last("funding_rate").alias("funding_close"),
        F.avg("funding_rate").alias("funding_mean"),
        (last("funding_rate") - first("funding_rate")).alias("funding_step"),
        last("predicted_funding_rate").alias("predicted_funding_close"),
        decoded(first("open_interest")).alias("oi_open"),
        decoded(last("open_interest")).alias("oi_close"),
        decoded(last("open_interest") - first("open_interest")).alias("oi_change"),
    )


def vol_buckets(trades: DataFrame, bucket_us: int = BUCKET_US) -> DataFrame:
    """Deviation of log returns per bucket of time, first and last time and count; hourly by the square root of 12.

    A return is against the trade before, whatever its day; a hot symbol is a task for each of its days.
    """
    rows = trades.where("price > 0").withColumn("__lp", F.log(decoded(F.col("price"))))
    rows = previous(rows, ("exchange", "symbol"), ORDER, F.col("__lp"), "__before")
    rows = rows.withColumn("__ret", F.col("__lp") - F.col("__before"))
    bucket = (F.floor(F.col("ts_event_us") / F.lit(bucket_us)) * bucket_us).cast("long")
    return rows.groupBy("exchange", "symbol", bucket.alias("bucket_us")).agg(
        F.stddev_samp("__ret").alias("bucket_vol"),
        (F.stddev_samp("__ret") * F.sqrt(F.lit(float(PER_HOUR)))).alias("hourly_vol"),
        F.min("ts_event_us").alias("first_ts_us"),
        F.max("ts_event_us").alias("last_ts_us"),
        F.count("*").alias("trade_count"),
    )


def bar_duration_stats(bars: DataFrame, by: Sequence[str] = ("exchange", "symbol"), ts: str = "ts_spine_us") -> DataFrame:
    """Seconds between bars: mean, median, min and max."""
    gap = (F.col(ts) - F.lag(ts).over(Window.partitionBy(*by).orderBy(ts))) / F.lit(1e6)
    return (
        bars.select(*by, gap.alias("s"))
        .groupBy(*by)
        .agg(
            F.avg("s").alias("mean_s"),
            F.median("s").alias("median_s"),
            F.min("s").alias("min_s"),
            F.max("s").alias("max_s"),
        )
    )
