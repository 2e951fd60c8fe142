"""Options, funding, liquidation, book and order-flow summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..core.numeric import divide, wide
from .bars import decoded, exact_sum
from .stats import beside_once, correlation, percent_ranks, quantiles
from .windows import by, lagged, rolling_mean, rolling_std, windowed

HOUR_US = 3_600_000_000


def high_gamma(options: DataFrame) -> DataFrame:
    return options.where((F.col("gamma") > 0.05) & (F.col("mark_iv") < 100) & F.abs("delta").between(0.15, 0.35))


def iv_summary(options: DataFrame) -> DataFrame:
    """Mean, exact median and greatest IV per underlying; an underlying with most rows is many tasks."""
    base = options.groupBy("underlying_index").agg(F.avg("mark_iv").alias("avg_iv"), F.max("mark_iv").alias("max_iv"), F.count("*").alias("n"))
    middle = quantiles(options, "mark_iv", {"median_iv": 0.5}, ["underlying_index"])
    return beside_once(base, middle, ["underlying_index"]).select("underlying_index", "avg_iv", "median_iv", "max_iv", "n")


def iv_skew_25d(options: DataFrame, width: float = 0.05, by: Sequence[str] = ("underlying_index",)) -> DataFrame:
    """Mean 25-delta call IV less put IV per underlying, or per ``by``."""
    near = F.abs(F.abs("delta") - 0.25) <= width
    side = lambda t: F.avg(F.when(near & (F.col("option_type") == t), F.col("mark_iv")))
    return options.groupBy(*by).agg((side("call") - side("put")).alias("skew_25d"))


def iv_term_structure(options: DataFrame, width: float = 0.1) -> DataFrame:
    """Mean at-the-money IV per underlying and expiry."""
    atm = options.where(F.abs(F.abs("delta") - 0.5) <= width)
    return atm.groupBy("underlying_index", "expiration_ts_us").agg(F.avg("mark_iv").alias("atm_iv"), F.count("*").alias("n"))


def gamma_oi_weighted(options: DataFrame) -> DataFrame:
    weight = F.col("open_interest").cast("double")
    return options.groupBy("underlying_index").agg(divide(F.sum(F.col("gamma") * weight), F.sum(weight)).alias("gamma_oi"))


def term_slope(options: DataFrame) -> DataFrame:
    """(IV at 30 days - IV at 7 days) / 23, by the mean IV of expiries within half a window of each."""
    days = (F.col("expiration_ts_us") - F.col("ts_event_us")) / F.lit(86_400e6)
    at = lambda d, width: F.avg(F.when(F.abs(days - d) <= width, F.col("mark_iv")))
    return options.groupBy("underlying_index").agg(((at(30, 7.0) - at(7, 3.5)) / 23).alias("term_slope"))


def rolling_zscore(df: DataFrame, column: str, n: int, keys: Sequence[str], ts: str, output: str) -> DataFrame:
    w = by(keys, (ts,))
    return df.withColumn(output, divide(F.col(column) - rolling_mean(column, n, w), rolling_std(column, n, w)))


def iv_funding_spread(df: DataFrame, iv: str = "avg_iv", funding: str = "funding_rate") -> DataFrame:
    return df.withColumn("iv_funding_spread", F.col(iv) - F.col(funding) * 3 * 365)


def funding_rank(ticker: DataFrame) -> DataFrame:
    return ticker.groupBy("symbol").agg(
        F.avg("funding_rate").alias("avg_funding"),
        (F.avg("funding_rate") * 3 * 365).alias("annualised"),
        decoded(F.max("open_interest")).alias("max_oi"),
    )


def basis_stats(ticker: DataFrame) -> DataFrame:
    basis = divide(F.col("mark_price") - F.col("index_price"), F.col("index_price")) * 10_000
    return ticker.groupBy("symbol").agg(
        F.avg(basis).alias("avg_basis_bps"), F.stddev_samp(basis).alias("std_basis_bps"), F.max(F.abs(basis)).alias("max_basis_bps")
    )


def liq_hourly_cascade(liquidations: DataFrame, least: int = 100) -> DataFrame:
    """(hour, n): UTC hours of the day, 0 to 23, with more than ``least`` liquidations."""
    hour = F.floor(F.pmod("ts_event_us", F.lit(24 * HOUR_US)) / F.lit(HOUR_US)).cast("int")
    return liquidations.groupBy(hour.alias("hour")).agg(F.count("*").alias("n")).where(F.col("n") > least)


def liq_profile(liquidations: DataFrame) -> DataFrame:
    return liquidations.groupBy("symbol", "side").agg(
        F.count("*").alias("n"), decoded(exact_sum(F.col("qty"))).alias("volume"), decoded(F.max("qty")).alias("max_qty")
    )


def liq_size_buckets(liquidations: DataFrame, edges: Sequence[int]) -> DataFrame:
    """(band, n, volume, share_n, share_volume) by three fixed-point edges: four bands."""
    band = F.lit(len(edges))
    for i, edge in reversed(list(enumerate(edges))):
        band = F.when(F.col("qty") < edge, F.lit(i)).otherwise(band)
    bands = liquidations.groupBy(band.alias("band")).agg(F.count("*").alias("n"), exact_sum(F.col("qty")).alias("v"))
    everything = Window.partitionBy()  # over the few bands
    return bands.select(
        "band",
        "n",
        decoded(F.col("v")).alias("volume"),
        divide(F.col("n"), F.sum("n").over(everything)).alias("share_n"),
        divide(F.col("v"), F.sum("v").over(everything)).alias("share_volume"),
    )


def liq_velocity(liquidations: DataFrame, bucket_us: int = 300_000_000) -> DataFrame:
    bucket = (F.floor(F.col("ts_event_us") / F.lit(bucket_us)) * bucket_us).cast("long")
    return liquidations.groupBy("symbol", bucket.alias("bucket_us")).agg(F.count("*").alias("n"))


def whale_ratio(liquidations: DataFrame, least_qty: int) -> DataFrame:
    """Share of each symbol's volume in rows of at least ``least_qty``."""
    big = F.coalesce(F.sum(F.when(F.col("qty") >= least_qty, wide(F.col("qty")))), F.lit(0).cast("decimal(38,0)"))
    return liquidations.groupBy("symbol").agg(divide(big, exact_sum(F.col("qty"))).alias("whale_ratio"))


#: Five minutes, in which liquidations are counted.
VELOCITY_US = 300_000_000


def euphoria_inputs(ticker: DataFrame, options: DataFrame, liquidations: DataFrame, step_us: int = 24 * HOUR_US) -> DataFrame:
    """(symbol, step_us, funding, call_skew, iv, velocity) of the steps that have all four.

    Mean funding rate, 25-delta call IV less put IV and mean IV of the symbol's options, and liquidations in five
    minutes in the mean of the step.
    """
    step = (F.col("ts_event_us") - F.pmod("ts_event_us", F.lit(step_us))).alias("step_us")
    funding = ticker.groupBy("symbol", step).agg(F.avg("funding_rate").alias("funding"))
    held = options.withColumns({"symbol": F.col("underlying_index"), "step_us": step})
    iv = held.groupBy("symbol", "step_us").agg(F.avg("mark_iv").alias("iv"))
    skew = iv_skew_25d(held, by=("symbol", "step_us")).withColumnRenamed("skew_25d", "call_skew")
    speed = liquidations.groupBy("symbol", step).agg((F.count("*") / F.lit(step_us / VELOCITY_US)).alias("velocity"))
    out = funding.join(skew, ["symbol", "step_us"]).join(iv, ["symbol", "step_us"]).join(speed, ["symbol", "step_us"])
    return out.where("funding is not null and call_skew is not null and iv is not null")


def euphoria_index(
    df: DataFrame,
    columns: Sequence[str] = ("funding", "call_skew", "iv", "velocity"),
    weights: Sequence[float] = (30, 30, 20, 20),
    keys: Sequence[str] = ("symbol",),
) -> DataFrame:
    """0 to 100: weighted percentile ranks of four columns inside each key; a key with most rows is many tasks."""
    names = {c: f"__rank{i}" for i, c in enumerate(columns)}
    total = sum((F.col(n) * w for n, w in zip(names.values(), weights, strict=True)), F.lit(0.0))
    return percent_ranks(df, keys, names).withColumn("euphoria_index", total).select(*df.columns, "euphoria_index")


def book_features(snapshots: DataFrame, levels: int = 5) -> DataFrame:
    """Spread, spread at a depth, depth imbalance, and slopes, from ladders (fixed-point prices, raw quantities).

    A slope is the price gap between the first and the last level over the quantity behind the first.
    """
    bid, ask = F.col("bid_price_levels"), F.col("ask_price_levels")
    total = lambda c, first=1: F.aggregate(F.slice(c, first, levels + 1 - first), F.lit(0).cast("long"), lambda a, x: a + x)
    mid = (decoded(bid[0]) + decoded(ask[0])) / 2
    bids, asks = total("bid_qty_levels"), total("ask_qty_levels")
    return snapshots.withColumns(
        {
            "spread_bps": divide(decoded(ask[0] - bid[0]), mid) * 10_000,
            "spread_deep_bps": divide(decoded(ask[levels - 1] - bid[levels - 1]), mid) * 10_000,
            "depth_imbalance": divide(bids - asks, bids + asks),
            "bid_slope": divide(decoded(bid[0] - bid[levels - 1]), total("bid_qty_levels", 2)),
            "ask_slope": divide(decoded(ask[levels - 1] - ask[0]), total("ask_qty_levels", 2)),
        }
    )


def daily_features(daily: DataFrame, keys: Sequence[str] = ("exchange", "symbol"), day: str = "trading_date") -> DataFrame:
    """Returns over 1, 5 and 20 days, annualised 20-day volatility, volume z-score and turnover anomaly."""
    w = by(keys, (day,))
    out = daily.withColumns({f"ret_{k}d": divide(F.col("close"), lagged("close", k, w)) - 1 for k in (1, 5, 20)})
    return out.withColumns(
        {
            "vol_20d": rolling_std("ret_1d", 20, w) * F.sqrt(F.lit(252.0)),
            "volume_z": divide(F.col("volume") - rolling_mean("volume", 20, w), rolling_std("volume", 20, w)),
            "turnover_anomaly": divide(F.col("volume"), rolling_mean("volume", 20, w)),
        }
    )


def session_imbalance(trades: DataFrame, phase: str = "trading_phase") -> DataFrame:
    signed = F.when(F.col("side") == "buy", wide(F.col("qty"))).when(F.col("side") == "sell", -wide(F.col("qty"))).otherwise(F.lit(0))
    return trades.groupBy("symbol", "trading_date", phase).agg(
        divide(F.sum(signed), exact_sum(F.col("qty"))).alias("imbalance"), decoded(exact_sum(F.col("qty"))).alias("volume")
    )


def order_to_cancel(orders: DataFrame) -> DataFrame:
    adds, cancels = F.count_if(F.col("event_kind") == "ADD"), F.count_if(F.col("event_kind") == "CANCEL")
    return orders.groupBy("symbol", "trading_date").agg(
        adds.alias("n_adds"), cancels.alias("n_cancels"), divide(adds, cancels).alias("order_to_cancel")
    )


#: Sequence numbers of a channel that one task walks.
FLOW_CHUNK = 1 << 18


def sign_correlation(orders: DataFrame, lag: int = 5, stretch: int = FLOW_CHUNK) -> DataFrame:
    """(symbol, trading_date, sign_correlation): corr(sign_t, sign_(t - lag)), each channel by its own sequence.

    Unknown sides are 0; null where all signs of a day are alike.  A channel's day is cut into stretches with a halo.
    """
    sign = F.when(F.col("side") == "BUY", 1).when(F.col("side") == "SELL", -1).otherwise(0)
    rows = orders.select("symbol", "trading_date", "channel_id", "channel_seq", sign.alias("sign"))
    earlier = lambda w: {"before": F.lag("sign", lag).over(w)}
    keys = ("symbol", "trading_date", "channel_id")
    both = windowed(rows, keys, ("channel_seq",), earlier, back=lag, stretch=stretch, chunk=FLOW_CHUNK)
    pair = F.col("before").isNotNull()
    both = both.withColumn("sign", F.when(pair, F.col("sign")))  # a day without pairs has its row
    return both.groupBy("symbol", "trading_date").agg(correlation("sign", "before").alias("sign_correlation"))


def l3_order_flow(orders: DataFrame, chunk: int = FLOW_CHUNK) -> DataFrame:
    """Per symbol and date: order-flow and cancel imbalance, adds per cancel, sign correlation at lag 5, longest run of
    one side.

    Orders are walked by channel and sequence in chunks.  A chunk becomes one row with its sums and its first and
    last run; runs that go on in the next chunk are joined there, so a symbol's day is many tasks.
    """
    day = ["symbol", "trading_date"]
    part = [*day, "channel_id", "k"]
    w = by(part, ("channel_seq",))
    sign = F.when(F.col("side") == "BUY", 1).when(F.col("side") == "SELL", -1).otherwise(0)
    rows = orders.withColumn("k", F.floor(F.col("channel_seq") / chunk)).withColumn("sign", sign).withColumn("before", lagged("sign", 1, w))
    rows = rows.withColumn("run", F.sum((F.col("sign") != F.coalesce("before", F.lit(9))).cast("int")).over(w))
    added, cancelled = (F.when(F.col("event_kind") == kind, wide(F.col("qty"))) for kind in ("ADD", "CANCEL"))
    runs = rows.groupBy(*part, "run").agg(
        F.count("*").alias("length"),
        F.min("sign").alias("sign"),
        F.sum(added * F.col("sign")).alias("add_flow"),
        F.sum(added).alias("adds"),
        F.sum(cancelled * F.col("sign")).alias("cancel_flow"),
        F.sum(cancelled).alias("cancels"),
        F.count_if(F.col("event_kind") == "ADD").alias("n_adds"),
        F.count_if(F.col("event_kind") == "CANCEL").alias("n_cancels"),
    )
    sums = ("add_flow", "adds", "cancel_flow", "cancels", "n_adds", "n_cancels")
    end = F.struct("run", "length", "sign")
    chunks = runs.groupBy(*part).agg(
        *(F.sum(c).alias(c) for c in sums), F.max("length").alias("longest"), F.min(end).alias("first"), F.max(end).alias("last")
    )
    # First and last run of each chunk, in order; the chunk's own sums stand beside the first.
    ends = F.when(F.col("first.run") == F.col("last.run"), F.array("first")).otherwise(F.array("first", "last"))
    edges = chunks.select(*part, *sums, "longest", F.posexplode(ends).alias("place", "e")).select(
        *part, "place", "longest", F.col("e.length").alias("length"), F.col("e.sign").alias("sign"),
        *(F.when(F.col("place") == 0, F.col(c)).alias(c) for c in sums),
    )
    walk = by(day, ("channel_id", "k", "place"))
    edges = edges.withColumn("before", F.when(F.col("place") == 0, lagged("sign", 1, walk)))
    edges = edges.withColumn("run", F.sum(F.coalesce((F.col("sign") != F.col("before")).cast("int"), F.lit(1))).over(walk))
    joined = edges.groupBy(*day, "run").agg(
        *(F.sum(c).alias(c) for c in sums),
        F.greatest(F.sum("length"), F.max("longest")).alias("longest"),
    )
    out = joined.groupBy(*day).agg(
        divide(F.sum("add_flow"), F.sum("adds")).alias("ofi"),
        divide(F.sum("cancel_flow"), F.sum("cancels")).alias("cancel_imbalance"),
        divide(F.sum("n_adds"), F.sum("n_cancels")).alias("add_cancel_ratio"),
        F.max("longest").alias("longest_run"),
    )
    return beside_once(out, sign_correlation(orders, stretch=chunk), day)


def replay_events(*tables: tuple[str, DataFrame]) -> DataFrame:
    """One event table out of several, dealt by symbol and date and sorted inside for replay."""
    order = ("exchange", "symbol", "channel_id", "channel_seq", "ts_event_us", "ts_local_us", "file_id", "file_seq")
    out = None
    for name, df in tables:
        rows = df.withColumn("event_table", F.lit(name))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    for c in order:
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast("long"))
    return out.repartition("exchange", "symbol", "trading_date").sortWithinPartitions(*order)
