"""Volume buckets, price impact, trends, order lifetimes, depth at the touch, lead and lag, clusters, volume curves.

Every function spreads one hot symbol over many tasks: by chunks of time with carried rows, by stretches with a halo,
or by keys that are finer than the symbol.  Prices and quantities are fixed-point longs.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..core.numeric import divide, notional, wide, whole_quotient
from .bars import decoded, exact_sum
from .scan import CHUNK_US, chunk_of, previous, running_sum, trailing_sums
from .stats import beside, correlation, quantiles
from .windows import windowed

KEYS = ("exchange", "symbol")
ORDER = ("ts_event_us", "file_id", "file_seq")
MINUTE_US = 60_000_000
#: Volume buckets that one row becomes at a time.
BLOCK = 4096
#: Times are counted in milliseconds from here, so that sums of their squares fit 38 digits.
ORIGIN_US = 1_577_836_800_000_000  # 2020-01-01


def _side(name: str, amount: Column) -> Column:
    return F.coalesce(F.sum(F.when(F.col("side") == name, amount)), F.lit(0).cast("decimal(38,0)"))


# Volume-synchronised probability of informed trading


def volume_buckets(trades: DataFrame, size: int, keys: Sequence[str] = KEYS, order: Sequence[str] = ORDER) -> DataFrame:
    """(keys, bucket, buy_qty, sell_qty, bucket_qty, first_ts_us, last_ts_us): buckets of just ``size`` quantity each.

    A trade is split over all buckets that its volume reaches: what lies between the running volume before it and with
    it, bucket by bucket.  The last bucket of a key may be smaller.  Trades without quantity are left out; those
    of unknown side count in ``bucket_qty`` alone.
    """
    if size <= 0:
        raise ValueError("size must be > 0")
    run = running_sum(trades.where("qty > 0"), keys, order, F.col("qty"), "__s")
    start = (F.col("__s") - F.col("qty")).cast("decimal(38,0)")
    first, last = (whole_quotient(x.cast("decimal(38,0)"), size).cast("long") for x in (start, F.col("__s") - 1))
    spans = run.select(*keys, order[0], "side", start.alias("__a"), "__s", first.alias("__first"), last.alias("__last"))
    # A trade of very many buckets is cut twice, so that no array is longer than a block.
    blocks = F.sequence(F.floor(F.col("__first") / BLOCK), F.floor(F.col("__last") / BLOCK))
    spans = spans.withColumn("__block", F.explode(blocks))
    reached = F.sequence(F.greatest("__first", F.col("__block") * BLOCK), F.least("__last", F.col("__block") * BLOCK + (BLOCK - 1)))
    split = spans.select(*keys, order[0], "side", "__a", "__s", F.explode(reached).alias("bucket"))
    edge = (F.col("bucket").cast("decimal(38,0)") * F.lit(size).cast("decimal(38,0)")).cast("decimal(38,0)")
    part = (F.least("__s", edge + size) - F.greatest("__a", edge)).cast("decimal(38,0)")
    return split.groupBy(*keys, "bucket").agg(
        _side("buy", part).cast("long").alias("buy_qty"),
        _side("sell", part).cast("long").alias("sell_qty"),
        F.sum(part).cast("long").alias("bucket_qty"),
        F.min(order[0]).alias("first_ts_us"),
        F.max(order[0]).alias("last_ts_us"),
    )


def vpin(buckets: DataFrame, size: int, over: int = 50, keys: Sequence[str] = KEYS, stretch: int = 1 << 16) -> DataFrame:
    """Full buckets with ``vpin``: mean of |buys - sells| / size over the last ``over`` buckets, null until there are so many."""
    full = buckets.where(F.col("bucket_qty") == size).withColumn("imbalance", F.abs(F.col("buy_qty") - F.col("sell_qty")) / F.lit(float(size)))

    def columns(w):
        frame = w.rowsBetween(1 - over, 0)
        return {"vpin": F.when(F.count("*").over(frame) >= over, F.avg("imbalance").over(frame))}

    return windowed(full, keys, ("bucket",), columns, back=over - 1, stretch=stretch, index="bucket")


def vpin_daily(buckets: DataFrame, size: int, keys: Sequence[str] = KEYS) -> DataFrame:
    """(keys, trading_date, vpin, n_buckets): full buckets by the UTC day of their last trade."""
    day = F.to_date(F.timestamp_micros("last_ts_us")).alias("trading_date")
    gap = exact_sum(F.abs(F.col("buy_qty") - F.col("sell_qty")))
    return buckets.where(F.col("bucket_qty") == size).groupBy(*keys, day).agg(
        divide(gap, F.count("*") * F.lit(float(size))).alias("vpin"), F.count("*").alias("n_buckets")
    )


# Price impact and trends


def kyle_lambda(trades: DataFrame, step_us: int = MINUTE_US, keys: Sequence[str] = KEYS) -> DataFrame:
    """(keys, trading_date, kyle_lambda, intercept, r2, n): regression of price changes on signed volume, by day.

    Steps of ``step_us`` have the last price and buys less sells; a step without trades is none.  Changes are those to
    the step before on the same day.  Null on a day whose signed volume does not vary.
    """
    step = (F.floor(F.col("ts_event_us") / step_us) * step_us).cast("long").alias("step_us")
    signed = (_side("buy", wide(F.col("qty"))) - _side("sell", wide(F.col("qty")))).cast("decimal(38,0)")
    rows = trades.groupBy(*keys, "trading_date", step).agg(
        decoded(F.max_by("price", F.struct(*ORDER))).alias("close"), decoded(signed).alias("signed_qty")
    )
    w = Window.partitionBy(*keys, "trading_date").orderBy("step_us")  # a day's steps
    moves = rows.withColumn("move", F.col("close") - F.lag("close").over(w)).where("move is not null")
    slope = F.try_divide(F.covar_pop("move", "signed_qty"), F.var_pop("signed_qty"))
    steady = (F.var_pop("move") == 0) & (F.var_pop("signed_qty") > 0)
    close = correlation("move", "signed_qty")
    return moves.groupBy(*keys, "trading_date").agg(
        slope.alias("kyle_lambda"),
        (F.avg("move") - slope * F.avg("signed_qty")).alias("intercept"),
        F.when(steady, F.lit(1.0)).otherwise(close * close).alias("r2"),
        F.count("*").alias("n"),
    )


def trade_size_trend(trades: DataFrame, width_us: int = 30 * MINUTE_US, keys: Sequence[str] = KEYS) -> DataFrame:
    """Adds ``trade_size_trend`` (quantity a second: the slope of trade sizes over the trades of the last ``width_us``,
    null where they are all at one time) and ``n_in_frame``."""
    x = F.floor((F.col("ts_event_us") - ORIGIN_US) / 1000).cast("decimal(38,0)")
    y = wide(F.col("qty")).cast("decimal(38,0)")
    measures = {"__n": F.lit(1), "__sx": x, "__sy": y, "__sxx": (x * x).cast("decimal(38,0)"), "__sxy": (x * y).cast("decimal(38,0)")}
    sums = trailing_sums(trades, keys, "ts_event_us", measures, width_us)

    def moment(a: str, b: str, c: str) -> Column:
        return ((F.col("__n") * F.col(a)).cast("decimal(38,0)") - (F.col(b) * F.col(c)).cast("decimal(38,0)")).cast("double")

    slope = divide(moment("__sxy", "__sx", "__sy"), moment("__sxx", "__sx", "__sx")) * F.lit(1000 / 1e9)
    out = sums.withColumns({"trade_size_trend": slope, "n_in_frame": F.col("__n").cast("long")})
    return out.drop(*measures)


# Large trades and orders


def large_trades(trades: DataFrame, least: int, day: Sequence[str] = ("symbol", "trading_date")) -> DataFrame:
    """(day, large_trade_ratio, large_count_ratio, n): share of volume, and of trades, in trades of more than ``least``
    fixed-point notional."""
    large = notional(F.col("price"), F.col("qty")) > F.lit(least)
    volume = F.coalesce(F.sum(F.when(large, wide(F.col("qty")))), F.lit(0).cast("decimal(38,0)"))
    return trades.groupBy(*day).agg(
        divide(volume, exact_sum(F.col("qty"))).alias("large_trade_ratio"),
        divide(F.count_if(large), F.count("*")).alias("large_count_ratio"),
        F.count("*").alias("n"),
    )


def above_quantile(rows: DataFrame, share: float = 0.95, day: Sequence[str] = ("symbol", "trading_date"), small: int = 1 << 17) -> DataFrame:
    """(day, threshold, large_volume_ratio, n_large, n): volume in rows above the exact quantile of their day's quantities."""
    limits = quantiles(rows, "qty", {"threshold": share}, day, small)
    marked = beside(rows.select(*day, "qty"), limits, day)
    large = F.col("qty") > F.col("threshold")
    volume = F.coalesce(F.sum(F.when(large, wide(F.col("qty")))), F.lit(0).cast("decimal(38,0)"))
    return marked.groupBy(*day).agg(
        decoded(F.max("threshold")).alias("threshold"),
        divide(volume, exact_sum(F.col("qty"))).alias("large_volume_ratio"),
        F.count_if(large).alias("n_large"),
        F.count("*").alias("n"),
    )


# Flow, spreads and intensity


def trade_flow(trades: DataFrame, lot: int, day: Sequence[str] = ("symbol", "trading_date")) -> DataFrame:
    """(day, aggressor_volume, retail_intensity, n): buys less sells, and the share of trades of at most ``lot``."""
    return trades.groupBy(*day).agg(
        decoded((_side("buy", wide(F.col("qty"))) - _side("sell", wide(F.col("qty")))).cast("decimal(38,0)")).alias("aggressor_volume"),
        divide(F.count_if(F.col("qty") <= lot), F.count("*")).alias("retail_intensity"),
        F.count("*").alias("n"),
    )


def window_imbalance(
    trades: DataFrame, first_minute: int, last_minute: int, offset_us: int, day: Sequence[str] = ("symbol", "trading_date")
) -> DataFrame:
    """(day, imbalance, volume) of the trades from ``first_minute`` of the local day up to, without, ``last_minute``.

    ``offset_us`` is the exchange's distance from UTC, so 14:30 to 15:00 in Shanghai is 870, 900 and eight hours.
    """
    minute = F.floor(F.pmod(F.col("ts_event_us") + offset_us, F.lit(CHUNK_US)) / MINUTE_US)
    rows = trades.where((minute >= first_minute) & (minute < last_minute))
    signed = (_side("buy", wide(F.col("qty"))) - _side("sell", wide(F.col("qty")))).cast("decimal(38,0)")
    return rows.groupBy(*day).agg(
        divide(signed, exact_sum(F.col("qty"))).alias("imbalance"), decoded(exact_sum(F.col("qty"))).alias("volume")
    )


def spread_regime(quotes: DataFrame, day: Sequence[str] = ("exchange", "symbol", "trading_date")) -> DataFrame:
    """(day, spread_pct, n): mean spread in percent of the middle, over quotes that are not crossed or empty."""
    sound = quotes.where("bid_price > 0 AND ask_price > 0 AND ask_price >= bid_price")
    spread = divide(F.col("ask_price") - F.col("bid_price"), F.col("ask_price") + F.col("bid_price")) * 200
    return sound.groupBy(*day).agg(F.avg(spread).alias("spread_pct"), F.count("*").alias("n"))


def volume_acceleration(trades: DataFrame, step_us: int = MINUTE_US, keys: Sequence[str] = KEYS) -> DataFrame:
    """(keys, step_us, volume, acceleration): change of a step's volume on the step right before it, for a second of the
    step; a step without trades has a volume of 0 when it is before one with trades."""
    step = (F.floor(F.col("ts_event_us") / step_us) * step_us).cast("long").alias("step_us")
    volume = trades.groupBy(*keys, step).agg(exact_sum(F.col("qty")).alias("v"))
    seen = previous(volume, keys, ("step_us",), F.struct("step_us", "v"), "__last")
    before = F.when(F.col("__last.step_us") == F.col("step_us") - step_us, F.col("__last.v")).when(F.col("__last").isNotNull(), F.lit(0).cast("decimal(38,0)"))
    change = decoded((F.col("v") - before).cast("decimal(38,0)")) / F.lit(step_us / 1e6)
    return seen.select(*keys, "step_us", decoded(F.col("v")).alias("volume"), change.alias("acceleration"))


def trade_intensity(trades: DataFrame, width_us: int = 5 * MINUTE_US, keys: Sequence[str] = KEYS) -> DataFrame:
    """Adds ``trade_intensity``, trades a second over the last ``width_us``, and ``recent_volume`` of the same frame."""
    sums = trailing_sums(trades, keys, "ts_event_us", {"__n": F.lit(1), "__q": F.col("qty")}, width_us)
    found = {"trade_intensity": F.col("__n").cast("double") / F.lit(width_us / 1e6), "recent_volume": decoded(F.col("__q"))}
    return sums.withColumns(found).drop("__n", "__q")


# Order lifetimes

_ORDER_KEY = ("exchange", "symbol", "trading_date", "channel_id", "order_ref")


def order_lifetimes(orders: DataFrame, ticks: DataFrame) -> DataFrame:
    """One row for each order of a day and channel, from both event tables.

    (key, side, added_ts_us, added_qty, first_cancel_ts_us, cancelled_qty, traded_qty, last_ts_us, residual_qty,
    lifetime_us).  Events meet by their order reference, so an order that is open for hours needs nothing carried; a
    trade counts for both its orders, a cancellation in the tick table for the order that it names.  An order without
    an ADD has null there.  ``lifetime_us`` is the time to the first cancellation, ``residual_qty`` what is left at the
    end.
    """
    columns = [*_ORDER_KEY, "ts_event_us", "event_kind", "side", "qty"]
    both = None
    for ref, side in (("bid_order_ref", "BUY"), ("ask_order_ref", "SELL")):
        part = ticks.where(F.col(ref).isNotNull() & (F.col(ref) != 0))
        part = part.withColumns({"order_ref": F.col(ref), "side": F.lit(side)}).select(*columns)
        both = part if both is None else both.unionByName(part)
    events = orders.select(*columns).unionByName(both)
    kind = F.col("event_kind")

    def total(which: str) -> Column:
        return F.coalesce(F.sum(F.when(kind == which, wide(F.col("qty")))), F.lit(0).cast("decimal(38,0)"))

    lives = events.groupBy(*_ORDER_KEY).agg(
        F.coalesce(F.max(F.when(kind == "ADD", F.col("side"))), F.max("side")).alias("side"),
        F.min(F.when(kind == "ADD", F.col("ts_event_us"))).alias("added_ts_us"),
        total("ADD").cast("long").alias("added_qty"),
        F.min(F.when(kind == "CANCEL", F.col("ts_event_us"))).alias("first_cancel_ts_us"),
        total("CANCEL").cast("long").alias("cancelled_qty"),
        total("TRADE").cast("long").alias("traded_qty"),
        F.max("ts_event_us").alias("last_ts_us"),
    )
    left = F.col("added_qty") - F.col("cancelled_qty") - F.col("traded_qty")
    return lives.withColumns({"residual_qty": left, "lifetime_us": F.col("first_cancel_ts_us") - F.col("added_ts_us")})


def fleeting_liquidity(lives: DataFrame, within_us: int = 100_000, day: Sequence[str] = ("symbol", "trading_date")) -> DataFrame:
    """(day, n_orders, n_fleeting, fleeting_ratio, fleeting_qty_ratio, residual_qty, n_unmatched, arrival_asymmetry).

    Fleeting orders are cancelled less than ``within_us`` after they were added.  ``arrival_asymmetry`` is the number of
    added buy orders over that of added sell orders.  Events of orders without an ADD count in ``n_unmatched`` alone.
    """
    added = F.col("added_ts_us").isNotNull()
    fleeting = added & (F.col("lifetime_us") >= 0) & (F.col("lifetime_us") < within_us)
    arrived = lambda side: F.count_if(added & (F.col("side") == side))
    short = F.coalesce(F.sum(F.when(fleeting, wide(F.col("cancelled_qty")))), F.lit(0).cast("decimal(38,0)"))
    return lives.groupBy(*day).agg(
        F.count_if(added).alias("n_orders"),
        F.count_if(fleeting).alias("n_fleeting"),
        divide(F.count_if(fleeting), F.count_if(added)).alias("fleeting_ratio"),
        divide(short, F.sum(F.when(added, wide(F.col("added_qty"))))).alias("fleeting_qty_ratio"),
        decoded(F.coalesce(F.sum(F.when(added, wide(F.col("residual_qty")))), F.lit(0).cast("decimal(38,0)"))).alias("residual_qty"),
        F.count_if(~added).alias("n_unmatched"),
        divide(arrived("BUY"), arrived("SELL")).alias("arrival_asymmetry"),
    )


# Depth at the touch

_TOUCH = "bid_price long, bid_qty long, ask_price long, ask_qty long"


def touch_depth(
    updates: DataFrame, points: DataFrame, keys: Sequence[str] = KEYS, ts: str = "ts_spine_us", chunk_us: int = 3_600_000_000
) -> DataFrame:
    """``points`` (keys, ts) with best bid and ask and the quantities there, as of each point (updates at its time count).

    An update sets the quantity of a price of a side, 0 takes it away; the rows of a snapshot, at one time, replace the
    book.  Time is cut into chunks; what a chunk inherits is the last quantity of each price before it, from one row for
    each price and chunk that sets it.  So a symbol is many tasks, and a task holds one chunk and one book.
    """
    keys = list(keys)
    u = updates.select(*keys, F.col("ts_event_us").alias("t"), "side", "price", "qty", "is_snapshot", F.struct("ts_event_us", "file_id", "file_seq").alias("o"))
    u = u.withColumn("c", chunk_of("t", chunk_us))
    p = points.select(*keys, F.col(ts).alias("t")).distinct().withColumn("c", chunk_of("t", chunk_us))
    # The book that a chunk inherits: a price's last quantity of each chunk holds until the chunk that sets it next.
    resets = u.where("is_snapshot").groupBy(*keys, "c").agg(F.max("t").alias("reset"))
    met = u.select(*keys, "c").unionByName(p.select(*keys, "c")).distinct()
    so_far = Window.partitionBy(*keys).orderBy("c").rowsBetween(Window.unboundedPreceding, -1)  # a row for each chunk
    chunks = met.join(resets, [*keys, "c"], "left").select(
        *keys, "c", F.max("reset").over(so_far).alias("reset"), F.row_number().over(Window.partitionBy(*keys).orderBy("c")).alias("i")
    )
    level = u.groupBy(*keys, "side", "price", "c").agg(F.max_by(F.struct("qty", "t"), "o").alias("x"))
    level = level.join(chunks.select(*keys, "c", "i"), [*keys, "c"])
    after = Window.partitionBy(*keys, "side", "price").orderBy("i")
    level = level.withColumn("until", F.coalesce(F.lead("i").over(after), F.lit(1 << 30))).where("x.qty > 0")
    most = chunks.groupBy(*keys).agg(F.max("i").alias("most"))
    held = level.join(most, keys).where("i < most").select(
        *keys, "side", "price", "x.qty", "x.t", F.explode(F.sequence(F.col("i") + 1, F.least("until", "most"))).alias("i")
    )
    held = held.join(chunks, [*keys, "i"]).where(F.col("reset").isNull() | (F.col("t") >= F.col("reset")))
    columns = [*keys, "c", "rank", "t", "o", "side", "price", "qty", "is_snapshot"]
    none = F.lit(None).cast("struct<ts_event_us:bigint,file_id:bigint,file_seq:bigint>").alias("o")
    rows = (
        u.withColumn("rank", F.lit(1)).select(*columns)
        .unionByName(held.select(*keys, "c", F.lit(0).alias("rank"), "t", none, "side", "price", "qty", F.lit(False).alias("is_snapshot")))
        .unionByName(p.select(*keys, "c", F.lit(2).alias("rank"), "t", none, F.lit(None).cast("string").alias("side"), *(F.lit(0).cast("long").alias(c) for c in ("price", "qty")), F.lit(False).alias("is_snapshot")))
    )  # fmt: skip  (no nulls among the longs, which pandas would turn to doubles)
    spread = rows.repartition(*keys, "c").sortWithinPartitions(*keys, "c", F.col("rank") > 0, "t", "rank", "o")
    kinds = ", ".join(f"{k} {t}" for k, t in p.select(*keys).dtypes)
    flat = spread.select(*keys, "c", "rank", "t", "side", "price", "qty", "is_snapshot")
    return flat.mapInPandas(_touches(len(keys)), f"{kinds}, {ts} long, {_TOUCH}").select(*keys, ts, *(x.split()[0] for x in _TOUCH.split(", ")))


class _Side:
    """Quantities by price, and the best price: a heap in which prices that are gone are dropped when they come up."""

    def __init__(self, sign: int):
        self.sign, self.qty, self.heap = sign, {}, []

    def set(self, price: int, qty: int) -> None:
        if qty > 0:
            if price not in self.qty:
                heapq.heappush(self.heap, -self.sign * price)
            self.qty[price] = qty
        else:
            self.qty.pop(price, None)

    def best(self) -> tuple[int | None, int | None]:
        while self.heap:
            price = -self.sign * self.heap[0]
            if price in self.qty:
                return price, self.qty[price]
            heapq.heappop(self.heap)
        return None, None


def _touches(n_keys: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, book, snapshot = None, {}, None
        for frame in frames:
            out = []
            for row in frame.itertuples(index=False, name=None):
                key, (rank, t, side, price, qty, is_snapshot) = row[: n_keys + 1], row[n_keys + 1 :]
                if key != part:
                    part, book, snapshot = key, {"bid": _Side(1), "ask": _Side(-1)}, None
                if rank == 2:
                    out.append((*key[:-1], t, *book["bid"].best(), *book["ask"].best()))
                    continue
                if is_snapshot and snapshot != t:
                    book, snapshot = {"bid": _Side(1), "ask": _Side(-1)}, t
                if side in book:
                    book[side].set(int(price), int(qty))
            names = [*frame.columns[:n_keys], "t", "bid_price", "bid_qty", "ask_price", "ask_qty"]
            kinds = {"t": "int64"} | dict.fromkeys(names[n_keys + 1 :], "Int64")
            # As objects first: a column of longs and None would pass through doubles.
            yield pd.DataFrame(out, columns=names, dtype=object).astype(kinds).rename(columns={"t": "ts_spine_us"})

    return run


def touch_depletion(touches: DataFrame, keys: Sequence[str] = KEYS, ts: str = "ts_spine_us") -> DataFrame:
    """Adds bid_depletion and ask_depletion: the quantity that has gone from the touch since the point before.

    At an unchanged price it is the decrease (negative if the queue has grown), at a worse or missing one the whole
    queue, at a better one nothing.  Null at the first point, and where there was no touch before.
    """
    last = F.struct(*(x.split()[0] for x in _TOUCH.split(", ")))
    seen = previous(touches, keys, (ts,), last, "__last")

    def gone(side: str, worse) -> Column:
        price, qty = F.col(f"{side}_price"), F.col(f"{side}_qty")
        old_price, old_qty = F.col("__last")[f"{side}_price"], F.col("__last")[f"{side}_qty"]
        return F.when(price == old_price, old_qty - qty).when(price.isNull() | worse(price, old_price), old_qty).when(old_price.isNotNull(), F.lit(0))

    return seen.withColumns({"bid_depletion": gone("bid", lambda a, b: a < b), "ask_depletion": gone("ask", lambda a, b: a > b)}).drop("__last")


# Lead and lag


def step_returns(trades: DataFrame, step_us: int, keys: Sequence[str] = KEYS) -> DataFrame:
    """(keys, step, ret): log return of the last price of each step on that of the step with trades before."""
    step = F.floor(F.col("ts_event_us") / step_us).cast("long").alias("step")
    closes = trades.where("price > 0").groupBy(*keys, step).agg(F.max_by("price", F.struct(*ORDER)).alias("close"))
    seen = previous(closes, keys, ("step",), F.col("close"), "__last", chunk_us=1 << 14)
    return seen.where("__last is not null").select(*keys, "step", (F.log(F.col("close").cast("double")) - F.log(F.col("__last").cast("double"))).alias("ret"))


def lead_lag(returns: DataFrame, pairs: DataFrame, most: int, key: str = "symbol") -> DataFrame:
    """(leader, follower, lag, correlation, n): correlation of the leader's return with the follower's ``lag`` steps later.

    ``returns`` has (key, step, ret), ``pairs`` (leader, follower).  A leader's return is sent to the steps of all lags
    from -most to most and meets the follower's there: one join for all lags, and moments for each pair and lag.
    """
    lead = returns.select(F.col(key).alias("leader"), "step", F.col("ret").alias("x")).join(pairs, "leader")
    lags = F.explode(F.sequence(F.lit(-most).cast("long"), F.lit(most).cast("long")))
    sent = lead.select("leader", "follower", "step", "x", lags.alias("lag")).withColumn("step", F.col("step") + F.col("lag"))
    follow = returns.select(F.col(key).alias("follower"), "step", F.col("ret").alias("y"))
    return sent.join(follow, ["follower", "step"]).groupBy("leader", "follower", "lag").agg(
        correlation("x", "y").alias("correlation"), F.count("*").alias("n")
    )


def best_lag(correlations: DataFrame) -> DataFrame:
    """The lag of the strongest correlation of each pair; of equal ones the shortest, then the positive one."""
    order = F.struct(F.abs("correlation").alias("a"), (-F.abs("lag")).alias("b"), F.col("lag").alias("c"))
    best = correlations.where("correlation is not null").groupBy("leader", "follower").agg(
        F.max_by(F.struct("lag", "correlation", "n"), order).alias("x")
    )
    return best.select("leader", "follower", "x.*")


# Clusters of trades


def trade_clusters(trades: DataFrame, gap_us: int, keys: Sequence[str] = KEYS, order: Sequence[str] = ORDER, chunk_us: int = CHUNK_US) -> DataFrame:
    """(keys, start_us, end_us, n, qty, buy_share): runs of trades, each at most ``gap_us`` after the one before."""
    seen = previous(trades, keys, order, F.col(order[0]), "__last", chunk_us)
    starts = F.when(F.col("__last").isNull() | (F.col(order[0]) - F.col("__last") > gap_us), 1).otherwise(0)
    numbered = running_sum(seen, keys, order, starts, "__cluster", chunk_us)
    return numbered.groupBy(*keys, "__cluster").agg(
        F.min(order[0]).alias("start_us"),
        F.max(order[0]).alias("end_us"),
        F.count("*").alias("n"),
        exact_sum(F.col("qty")).cast("long").alias("qty"),
        divide(_side("buy", wide(F.col("qty"))), exact_sum(F.col("qty"))).alias("buy_share"),
    ).drop("__cluster")


# Volume curve


def volume_curve(trades: DataFrame, step_us: int = MINUTE_US, keys: Sequence[str] = KEYS) -> DataFrame:
    """(keys, trading_date, step, volume, expected, participation): a step's volume and its mean on earlier days.

    ``step`` counts from midnight UTC.  The mean is over all earlier days on which the key traded, those without trades
    in the step as 0; null on the first day.  ``participation`` is volume / expected.
    """
    keys = list(keys)
    step = F.floor(F.pmod("ts_event_us", F.lit(CHUNK_US)) / step_us).cast("int").alias("step")
    volume = trades.groupBy(*keys, "trading_date", step).agg(exact_sum(F.col("qty")).alias("v"))
    days = volume.select(*keys, "trading_date").distinct()
    number = F.row_number().over(Window.partitionBy(*keys).orderBy("trading_date")) - 1  # a row for each day
    days = days.withColumn("__earlier", number)
    before = Window.partitionBy(*keys, "step").orderBy("trading_date").rowsBetween(Window.unboundedPreceding, -1)
    summed = volume.withColumn("__sum", F.coalesce(F.sum("v").over(before), F.lit(0).cast("decimal(38,0)")))
    both = summed.join(days, [*keys, "trading_date"])
    expected = divide(F.col("__sum"), F.col("__earlier")) / F.lit(1e9)
    return both.select(*keys, "trading_date", "step", decoded(F.col("v")).alias("volume"), expected.alias("expected")).withColumn(
        "participation", divide(F.col("volume"), F.col("expected"))
    )
