"""Feature packs over bars.  Divisions by zero give null; windows run per symbol in bar order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..core.numeric import divide
from .spine import THRESHOLDS
from .windows import by, lagged, rolling_mean, rolling_median, windowed

KEYS, TS = ("exchange", "symbol"), "ts_spine_us"
#: Round-trip costs in basis points: two exchanges; perpetual against spot.
EXCHANGE_COST_BPS, CARRY_COST_BPS = 14.0, 48.0
#: Regimes by hourly volatility.
HIGH_VOL, LOW_VOL = 0.02, 0.005
BPS = 10_000.0


def momentum(bars: DataFrame, keys: Sequence[str] = KEYS, ts: str = TS) -> DataFrame:
    moment = F.timestamp_micros(ts)

    def columns(w) -> dict[str, Column]:
        return {f"ret_{k}bar": divide(F.col("close"), lagged("close", k, w)) - 1 for k in (1, 5, 10)} | {
            "vwap_reversion": divide(F.col("close") - F.col("vwap"), F.col("vwap")),
            "trade_count_accel": divide(F.col("trade_count"), lagged("trade_count", 1, w)) - 1,
            "flow_persistence": F.col("flow_imbalance") * lagged("flow_imbalance", 1, w),
            "hl_range_pct": divide(F.col("high") - F.col("low"), F.col("close")),
            "size_ratio": divide(F.col("avg_size"), rolling_median("avg_size", 50, w)),
            "hour": F.hour(moment),
            "weekday": F.weekday(moment) + 1,
        }

    return windowed(bars, keys, (ts,), columns, back=49)


def funding(bars: DataFrame, keys: Sequence[str] = KEYS, ts: str = TS) -> DataFrame:
    """``bars``: trade bars joined with funding bars."""
    change = divide(F.col("oi_change"), F.col("oi_open"))
    columns = lambda w: (
        {
            "funding_carry_annual": F.col("funding_close") * 365 * 3,
            "funding_surprise": F.col("funding_close") - F.col("predicted_funding_close"),
            "oi_pct_change": change,
            "funding_oi_pressure": F.col("funding_close") * change,
            "flow_funding_interaction": F.col("flow_imbalance") * F.col("funding_close"),
            "funding_momentum": F.col("funding_close") - lagged("funding_close", 1, w),
            "oi_momentum_5bar": divide(F.col("oi_close"), lagged("oi_close", 5, w)) - 1,
        }
    )
    return windowed(bars, keys, (ts,), columns, back=5)


def cross_exchange(both: DataFrame, keys: Sequence[str] = ("symbol",), ts: str = TS, a: str = "a_", b: str = "b_") -> DataFrame:
    """``both``: bars of exchange a with those of exchange b as of the same time, by prefix."""
    w = by(keys, (ts,))
    c = lambda p, n: F.col(f"{p}{n}")
    first = both.withColumns(
        {
            "price_spread": c(a, "close") - c(b, "close"),
            "spread_bps": divide(c(a, "close") - c(b, "close"), c(b, "close")) * BPS,
            "vwap_spread": c(a, "vwap") - c(b, "vwap"),
            "vwap_spread_bps": divide(c(a, "vwap") - c(b, "vwap"), c(b, "vwap")) * BPS,
            "volume_imbalance": divide(c(a, "volume") - c(b, "volume"), c(a, "volume") + c(b, "volume")),
            "flow_divergence": c(a, "flow_imbalance") - c(b, "flow_imbalance"),
            "volatility_ratio": divide(c(a, "volatility"), c(b, "volatility")),
            "momentum_divergence": (divide(c(a, "close"), lagged(f"{a}close", 5, w)) - 1)
            - (divide(c(b, "close"), lagged(f"{b}close", 5, w)) - 1),
        }
    )
    gap = F.abs("spread_bps")
    return first.withColumns(
        {
            "arb_opportunity": gap > EXCHANGE_COST_BPS,
            "expected_profit_bps": F.when(gap > EXCHANGE_COST_BPS, gap - EXCHANGE_COST_BPS).otherwise(F.lit(0.0)),
            "spread_convergence": F.col("spread_bps") - lagged("spread_bps", 1, w),
        }
    )


def perp_spot(both: DataFrame, keys: Sequence[str] = ("symbol",), ts: str = TS, perp: str = "perp_", spot: str = "spot_") -> DataFrame:
    """``both``: perpetual bars (with ``funding_close``) joined with spot bars, by prefix."""
    w = by(keys, (ts,))
    c = lambda p, n: F.col(f"{p}{n}")
    first = both.withColumns(
        {
            "basis_bps": divide(c(perp, "close") - c(spot, "close"), c(spot, "close")) * BPS,
            "vwap_basis_bps": divide(c(perp, "vwap") - c(spot, "vwap"), c(spot, "vwap")) * BPS,
            "momentum_divergence": (divide(c(perp, "close"), lagged(f"{perp}close", 5, w)) - 1)
            - (divide(c(spot, "close"), lagged(f"{spot}close", 5, w)) - 1),
            "volume_ratio": divide(c(perp, "volume"), c(spot, "volume")),
            "flow_divergence": c(perp, "flow_imbalance") - c(spot, "flow_imbalance"),
            "volatility_ratio": divide(c(perp, "volatility"), c(spot, "volatility")),
            "spread_ratio": divide(c(perp, "hl_spread"), c(spot, "hl_spread")),
        }
    )
    gap = F.abs("basis_bps")
    return first.withColumns(
        {
            "basis_momentum": F.col("basis_bps") - lagged("basis_bps", 1, w),
            "funding_basis_divergence": F.col("funding_close") * BPS - F.col("basis_bps"),
            "cash_carry_opportunity": gap > CARRY_COST_BPS,
            "cash_carry_profit_bps": F.when(gap > CARRY_COST_BPS, gap - CARRY_COST_BPS).otherwise(F.lit(0.0)),
            "flow_basis_interaction": F.col("flow_divergence") * F.col("basis_bps"),
        }
    )


def multi_timeframe(both: DataFrame, keys: Sequence[str] = KEYS, ts: str = TS, fast: str = "fast_", slow: str = "slow_") -> DataFrame:
    """``both``: fast bars with the latest slow bar as of each, by prefix; needs ret_5bar and ma5 of both."""
    w = by(keys, (ts,))
    c = lambda p, n: F.col(f"{p}{n}")
    return both.withColumns(
        {
            "momentum_divergence": c(fast, "ret_5bar") - c(slow, "ret_5bar"),
            "volatility_ratio": divide(c(fast, "price_std"), c(slow, "price_std")),
            "flow_alignment": c(fast, "flow_imbalance") * c(slow, "flow_imbalance"),
            "price_position": divide(c(fast, "close") - c(slow, "low"), c(slow, "high") - c(slow, "low")),
            "trend_confirmation": F.signum(c(fast, "ret_5bar")) * F.signum(c(slow, "ret_5bar")),
            "volume_acceleration": divide(c(fast, "volume"), lagged(f"{fast}volume", 1, w)) - 1,
            "micro_trend_div": divide(c(fast, "close") - c(fast, "ma5"), c(fast, "ma5")),
            "slow_trend_strength": divide(c(slow, "close") - c(slow, "ma5"), c(slow, "ma5")),
        }
    )


def with_trend(bars: DataFrame, keys: Sequence[str] = KEYS, ts: str = TS) -> DataFrame:
    """Adds ret_5bar and ma5, the mean of five closes."""

    def columns(w) -> dict[str, Column]:
        return {"ret_5bar": divide(F.col("close"), lagged("close", 5, w)) - 1, "ma5": rolling_mean("close", 5, w)}

    return windowed(bars, keys, (ts,), columns, back=5)


def adaptive_regime(buckets: DataFrame, vol: str = "hourly_vol", keys: Sequence[str] = KEYS, ts: str = "bucket_us") -> DataFrame:
    """Adds the smoothed volatility (mean of up to 12 buckets), regime and bar threshold."""
    smooth = lambda w: {"smooth_vol": rolling_mean(vol, 12, w, least=1)}
    out = windowed(buckets, keys, (ts,), smooth, back=11)
    regime = F.when(F.col("smooth_vol") > HIGH_VOL, "HIGH").when(F.col("smooth_vol") < LOW_VOL, "LOW").otherwise("MEDIUM")
    pairs = [F.lit(x) for kv in THRESHOLDS.items() for x in kv]
    return out.withColumn("regime", regime).withColumn("bar_threshold", F.create_map(*pairs)[F.col("regime")])


def regime_join(bars: DataFrame, regimes: DataFrame, bucket_us: int = 300_000_000, keys: Sequence[str] = KEYS, ts: str = TS) -> DataFrame:
    """Bars with the regime of their bucket, null without one."""
    bucket = (F.floor(F.col(ts) / F.lit(bucket_us)) * bucket_us).cast("long")
    return bars.withColumn("bucket_us", bucket).join(regimes.select(*keys, "bucket_us", "regime", "smooth_vol"), [*keys, "bucket_us"], "left")


def regime_counts(regimes: DataFrame) -> DataFrame:
    return regimes.groupBy("regime").agg(F.count("*").alias("n"))


def regime_stats(bars: DataFrame, keys: Sequence[str] = KEYS, ts: str = TS) -> DataFrame:
    """Per regime: bar seconds (mean, median), volume, trades and volatility (means)."""
    seconds = (F.col(ts) - lagged(ts, 1, by(keys, (ts,)))) / F.lit(1e6)
    return bars.withColumn("__s", seconds).groupBy("regime").agg(
        F.count("*").alias("n_bars"),
        F.avg("__s").alias("mean_duration_s"),
        F.median("__s").alias("median_duration_s"),
        F.avg("volume").alias("mean_volume"),
        F.avg("trade_count").alias("mean_trades"),
        F.avg("smooth_vol").alias("mean_vol"),
    )


def regime_transitions(regimes: DataFrame, keys: Sequence[str] = KEYS, ts: str = "bucket_us") -> DataFrame:
    """(prev_regime, regime, n) where the regime changes."""
    w = by(keys, (ts,))
    moved = regimes.withColumn("prev_regime", lagged("regime", 1, w)).where("prev_regime <> regime")
    return moved.groupBy("prev_regime", "regime").agg(F.count("*").alias("n"))


def opportunity_summary(rows: DataFrame, gap: str, profit: str, cost_bps: float) -> DataFrame:
    """One row: how many bars are over the cost, their share, profits and directions."""
    over = F.abs(gap) > cost_bps
    return rows.agg(
        F.count("*").alias("n_bars"),
        F.count_if(over).alias("n_over"),
        divide(F.count_if(over), F.count("*")).alias("share_over"),
        F.avg(F.when(over, F.col(profit))).alias("mean_profit_bps"),
        F.median(F.when(over, F.col(profit))).alias("median_profit_bps"),
        F.max(F.when(over, F.col(profit))).alias("max_profit_bps"),
        F.count_if(over & (F.col(gap) > 0)).alias("n_positive"),
        F.count_if(over & (F.col(gap) < 0)).alias("n_negative"),
    )


def prefixed(df: DataFrame, prefix: str, keep: Sequence[str]) -> DataFrame:
    return df.select(*keep, *(F.col(c).alias(f"{prefix}{c}") for c in df.columns if c not in keep))


