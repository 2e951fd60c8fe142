"""Time grids (spines): clock, trades, volume and dollar.

A spine has the columns (exchange, symbol, symbol_id, ts_spine_us), one row per exchange, symbol and time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..core.numeric import notional, wide
from ..core.specs import SCALE
from ..core.storage import kept
from ..core.timeutil import bounds
from .asof import asof_backward
from .scan import CHUNK_US, running_sum

ORDER = ("ts_event_us", "file_id", "file_seq")
#: Bar thresholds by regime; each divides the largest.
THRESHOLDS = {"HIGH": 50, "LOW": 200, "MEDIUM": 100}
COLUMNS = ("exchange", "symbol", "symbol_id", "ts_spine_us")


#: Ticks of a clock spine that one row becomes at a time.
TICKS = 4096


@dataclass(frozen=True)
class ClockSpine:
    step_us: int
    max_rows: int | None = None


@dataclass(frozen=True)
class TradesSpine:
    max_rows: int | None = None


@dataclass(frozen=True)
class VolumeSpine:
    threshold: int  # fixed-point quantity
    max_rows: int | None = None


@dataclass(frozen=True)
class DollarSpine:
    threshold: int  # fixed-point notional
    max_rows: int | None = None


def _positive(name: str, value: int) -> None:
    if value <= 0:
        raise ValueError(f"{name} must be > 0")


def within_rows(df: DataFrame, max_rows: int | None) -> DataFrame:
    """Raises if there are more rows; counting runs a job, so it is off unless asked for."""
    if max_rows is not None and df.limit(max_rows + 1).count() > max_rows:
        raise RuntimeError(f"the spine would produce too many rows, over {max_rows}")
    return df


def clock_spine(dim: DataFrame, start, end, step_us: int, max_rows: int | None = None) -> DataFrame:
    """Ticks at multiples of the step, strictly after the start of each version's window and up to its end.

    Versions of ``dim`` are cut to [start, end); a tick on a hand-over belongs to the old version.
    """
    _positive("step_us", step_us)
    a, b = bounds(start, end)
    low, high = F.greatest("valid_from_ts_us", F.lit(a)), F.least("valid_until_ts_us", F.lit(b))
    versions = (
        dim.where((F.col("valid_from_ts_us") < b) & (F.col("valid_until_ts_us") > a))
        .withColumn("__low", low)
        .withColumn("__first", F.col("__low") - F.pmod("__low", F.lit(step_us)) + step_us)
        .withColumn("__last", high)
        .where("__first <= __last")
    )
    if max_rows is not None:
        ticks = F.sum(F.expr(f"(__last - __first) div {step_us} + 1"))
        if (versions.agg(ticks.alias("n")).first()["n"] or 0) > max_rows:
            raise RuntimeError(f"the spine would produce too many rows, over {max_rows}")
    # Stretches first, then their ticks, so that no row becomes an array as long as a version.
    stretch = versions.withColumn("__at", F.explode(F.sequence("__first", "__last", F.lit(step_us * TICKS).cast("long"))))
    stretch = stretch.withColumn("__to", F.least("__last", F.col("__at") + F.lit(step_us * (TICKS - 1))))
    points = stretch.select(
        "exchange",
        F.col("exchange_symbol").alias("symbol"),
        "symbol_id",
        F.explode(F.sequence("__at", "__to", F.lit(step_us).cast("long"))).alias("ts_spine_us"),
    )
    return points.groupBy("exchange", "symbol", "ts_spine_us").agg(F.min("symbol_id").alias("symbol_id")).select(*COLUMNS)


def window_of(trades: DataFrame, start, end) -> DataFrame:
    a, b = bounds(start, end)
    return trades.where((F.col("ts_event_us") >= a) & (F.col("ts_event_us") < b))


def trades_spine(trades: DataFrame, max_rows: int | None = None) -> DataFrame:
    """A point at each distinct trade time."""
    points = trades.select("exchange", "symbol", "symbol_id", F.col("ts_event_us").alias("ts_spine_us")).distinct()
    return within_rows(points, max_rows)


def _threshold_spine(trades: DataFrame, measure: Column, threshold: int, max_rows, chunk_us: int) -> DataFrame:
    """A point at each trade that carries its symbol's running sum over a multiple of the threshold.

    The points, few next to the trades, are kept, so that whatever joins them does not walk the trades again.
    """
    summed = running_sum(trades, ("exchange", "symbol"), ORDER, measure, "__sum", chunk_us)
    step = F.lit(threshold).cast("decimal(38,0)")
    # The sum before a trade is its sum less its own measure, so no second window is needed.
    crossing = (F.col("__sum") - F.col("__sum") % step) > (F.col("__sum") - measure.cast("decimal(38,0)"))
    hits = summed.where(crossing & (F.col("__sum") >= step))
    points = hits.groupBy("exchange", "symbol", F.col("ts_event_us").alias("ts_spine_us")).agg(
        F.min_by("symbol_id", F.struct("file_id", "file_seq")).alias("symbol_id")
    )
    return within_rows(kept(points.select(*COLUMNS)), max_rows)


def volume_spine(trades: DataFrame, threshold: int, max_rows: int | None = None, chunk_us: int = CHUNK_US) -> DataFrame:
    """A point each time the traded quantity passes another ``threshold`` (fixed-point)."""
    _positive("threshold", threshold)
    return _threshold_spine(trades, wide(F.abs("qty")), threshold, max_rows, chunk_us)


def dollar_spine(trades: DataFrame, threshold: int, max_rows: int | None = None, chunk_us: int = CHUNK_US) -> DataFrame:
    """A point each time the traded notional passes another ``threshold`` (fixed-point)."""
    _positive("threshold", threshold)
    return _threshold_spine(trades, notional(F.col("price"), F.col("qty")), threshold, max_rows, chunk_us)


def adaptive_spine(
    trades: DataFrame,
    regimes: DataFrame,
    unit: int,
    bucket_us: int = 300_000_000,
    max_rows: int | None = None,
    chunk_us: int = CHUNK_US,
) -> DataFrame:
    """A volume spine whose threshold follows the regime: ``bar_threshold`` times ``unit`` (fixed-point).

    ``regimes`` has a row per exchange, symbol and bucket, with a ``bar_threshold`` of ``THRESHOLDS``.  A trade counts
    by the last bucket that had ended at its time, so nothing is looked ahead, and by the middle threshold before the
    first one.  A trade counts the more, the lower its threshold; one running sum crosses one step throughout.
    """
    _positive("unit", unit)
    ready = regimes.select("exchange", "symbol", (F.col("bucket_us") + bucket_us).alias("ready_us"), "bar_threshold")
    own = asof_backward(trades, ready, ("exchange", "symbol"), "ts_event_us", "ready_us", ["bar_threshold"], chunk_us=chunk_us)
    step = max(THRESHOLDS.values())
    share = F.lit(step) / F.coalesce("bar_threshold", F.lit(THRESHOLDS["MEDIUM"]))
    measure = wide(F.abs("qty")) * share.cast("decimal(10,0)")
    return _threshold_spine(own, measure, step * unit, max_rows, chunk_us)


def build_spine(config, *, trades: DataFrame | None = None, dim: DataFrame | None = None, start=None, end=None) -> DataFrame:
    """The spine that ``config`` names, over [start, end)."""
    if isinstance(config, ClockSpine):
        return clock_spine(dim, start, end, config.step_us, config.max_rows)
    kinds = {TradesSpine: trades_spine, VolumeSpine: volume_spine, DollarSpine: dollar_spine}
    if type(config) not in kinds:
        raise TypeError(f"unknown spine configuration {config!r}")
    rows = window_of(trades, start, end)
    if isinstance(config, TradesSpine):
        return trades_spine(rows, config.max_rows)
    return kinds[type(config)](rows, config.threshold, config.max_rows)


__all__ = ["SCALE", "ClockSpine", "DollarSpine", "TradesSpine", "VolumeSpine", "adaptive_spine", "build_spine", "clock_spine", "dollar_spine", "trades_spine", "volume_spine", "window_of"]
