"""The slowly changing (type 2) symbol dimension, and joins to the version valid at a time."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..core.specs import OPEN_END, SCALE, spec
from .validation import REASON

KEY = ("exchange", "exchange_symbol")
#: A change of one of these closes a version and opens another.
TRACKED = ("canonical_symbol", "market_type", "base_asset", "quote_asset", "tick_size", "lot_size", "contract_size")
MISSING = "missing_pit_symbol_coverage"


def symbol_id(exchange: Column, symbol: Column, valid_from: Column) -> Column:
    """Signed little-endian 64-bit blake2b of exchange|symbol|valid_from.  Spark has no blake2b."""

    @F.pandas_udf("long")
    def hashed(keys):
        return keys.map(lambda k: int.from_bytes(hashlib.blake2b(k.encode(), digest_size=8).digest(), "little", signed=True))

    return hashed(F.concat_ws("|", exchange, symbol, valid_from.cast("string")))


def with_ids(df: DataFrame) -> DataFrame:
    """Gives ids to rows that have none; ids that are there stay, whatever they are, since events hold them."""
    made = symbol_id(F.col("exchange"), F.col("exchange_symbol"), F.col("valid_from_ts_us"))
    if "symbol_id" in df.columns:
        made = F.coalesce("symbol_id", made)
    return df.withColumn("symbol_id", made).select(*spec("dim_symbol").names)


def _opened(df: DataFrame, at: Column) -> DataFrame:
    return df.withColumns(
        {
            "valid_from_ts_us": at.cast("long"),
            "valid_until_ts_us": F.lit(OPEN_END),
            "is_current": F.lit(True),
            "updated_at_ts_us": at.cast("long"),
        }
    )


def bootstrap(snapshot: DataFrame, effective_ts_us: int) -> DataFrame:
    """A first dimension: every row of the snapshot is current from ``effective_ts_us`` on."""
    return with_ids(_opened(snapshot.select(*KEY, *TRACKED), F.lit(effective_ts_us)))


def upsert(dim: DataFrame, snapshot: DataFrame, effective_ts_us: int, delistings: DataFrame | None = None) -> DataFrame:
    """The dimension after a snapshot.

    Exchanges in neither the snapshot nor the delistings, and closed versions, stay untouched; a version keeps its
    ``symbol_id`` for good, and only opened ones get a new one.  A changed
    key's version is closed at ``effective_ts_us`` and a new one opened; new keys are opened; equal ones stay.
    Without ``delistings`` current keys that the snapshot lacks are closed at ``effective_ts_us``.  With
    them, only listed keys that the snapshot lacks are closed, each at its own ``delisted_at_ts_us``.
    """
    names = spec("dim_symbol").names
    scope = snapshot.select("exchange")
    if delistings is not None:
        scope = scope.unionByName(delistings.select("exchange"))
    scope = scope.distinct().withColumnRenamed("exchange", "__scope")
    scoped = F.col("is_current") & F.col("__scope").isNotNull()
    # A row per exchange: far below any broadcast bound.
    flagged = dim.join(F.broadcast(scope), F.col("exchange") == F.col("__scope"), "left")
    kept = flagged.where(~scoped).select(*names)
    current = flagged.where(scoped).select(F.struct(*names).alias("old"), *KEY)
    fresh = snapshot.select(F.struct(*KEY, *TRACKED).alias("new"), *KEY)
    both = current.join(fresh, list(KEY), "full_outer")
    if delistings is None:
        both = both.withColumn("gone_at", F.lit(effective_ts_us).cast("long"))
    else:
        ends = delistings.groupBy(*KEY).agg(F.min("delisted_at_ts_us").alias("gone_at"))
        both = both.join(ends, list(KEY), "left")
    same = F.lit(True)
    for c in TRACKED:
        same = same & F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
    at = F.lit(effective_ts_us).cast("long")

    def version(source: str, start: Column, until: Column, is_current: Column, updated: Column) -> Column:
        fixed = {
            "valid_from_ts_us": start,
            "valid_until_ts_us": until.cast("long"),
            "is_current": is_current,
            "updated_at_ts_us": updated,
        }
        id_ = F.col("old.symbol_id") if source == "old" else F.lit(None).cast("long")
        return F.struct(
            *(
                (id_ if n == "symbol_id" else fixed[n] if n in fixed else F.col(f"{source}.{n}")).alias(n)
                for n in names
            )
        )

    old_from = F.col("old.valid_from_ts_us")
    as_is = version("old", old_from, F.col("old.valid_until_ts_us"), F.lit(True), F.col("old.updated_at_ts_us"))
    closed = version("old", old_from, at, F.lit(False), at)
    ended = version("old", old_from, F.col("gone_at"), F.lit(False), F.col("gone_at"))
    opened = version("new", at, F.lit(OPEN_END), F.lit(True), at)
    rows = (
        F.when(F.col("old").isNull(), F.array(opened))
        .when(F.col("new").isNull() & F.col("gone_at").isNotNull(), F.array(ended))
        .when(F.col("new").isNull() | same, F.array(as_is))
        .otherwise(F.array(closed, opened))
    )
    return with_ids(kept.unionByName(both.select(F.inline(rows))))


def violations(dim: DataFrame) -> DataFrame:
    """(rule, exchange, exchange_symbol): broken invariants; empty for a sound dimension."""
    by_key = Window.partitionBy(*KEY).orderBy("valid_from_ts_us", "valid_until_ts_us")
    out = dim.where("valid_until_ts_us <= valid_from_ts_us").select(F.lit("empty_window").alias("rule"), *KEY)
    current = dim.where("is_current").groupBy(*KEY).count().where("count > 1")
    out = out.unionByName(current.select(F.lit("several_current").alias("rule"), *KEY))
    overlap = dim.withColumn("__next", F.lead("valid_from_ts_us").over(by_key)).where("valid_until_ts_us > __next")
    out = out.unionByName(overlap.select(F.lit("overlap").alias("rule"), *KEY))
    ids = dim.groupBy("symbol_id").agg(F.count("*").alias("n"), F.min(F.struct(*KEY)).alias("k")).where("n > 1")
    return out.unionByName(ids.select(F.lit("repeated_symbol_id").alias("rule"), "k.exchange", "k.exchange_symbol"))


def validate(dim: DataFrame) -> DataFrame:
    """``dim`` itself, or an error that names broken invariants."""
    if bad := violations(dim).limit(10).collect():
        raise ValueError("broken dimension: " + ", ".join(f"{r['rule']} {r['exchange']}/{r['exchange_symbol']}" for r in bad))
    return dim


def refresh(dim: DataFrame, history: DataFrame) -> DataFrame:
    """Replaces all rows of the exchanges that ``history`` has; other exchanges stay, with their ids.

    ``save_dim`` refuses a result whose windows overlap; ``validate`` tells of it before.
    """
    others = dim.join(history.select("exchange").distinct(), "exchange", "left_anti")
    return with_ids(others.unionByName(history, allowMissingColumns=True))


def as_of(dim: DataFrame, ts_us: int | None) -> DataFrame:
    """Versions valid at a time (start inclusive, end exclusive), or the current ones."""
    if ts_us is None:
        return dim.where("is_current")
    return dim.where((F.col("valid_from_ts_us") <= ts_us) & (F.lit(ts_us) < F.col("valid_until_ts_us")))


def without_overlaps(versions: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Windows of each key cut so that a time lies in one at most: the version with the earliest start keeps its whole
    window, the next one what is left of its own.  As large as the dimension, not as the events."""
    names = [c for c in versions.columns if c not in ("valid_from_ts_us", "valid_until_ts_us")]
    by_start = Window.partitionBy(*keys).orderBy("valid_from_ts_us", "valid_until_ts_us", *names)
    before = F.max("valid_until_ts_us").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    start = F.greatest("valid_from_ts_us", F.coalesce(before, "valid_from_ts_us"))
    return versions.withColumn("valid_from_ts_us", start).where("valid_from_ts_us < valid_until_ts_us")


def _valid_at(left: DataFrame, versions: DataFrame, keys: dict[str, str], ts: str) -> DataFrame:
    """Left rows with the version (columns prefixed by __d_) of their keys that is valid at their time.

    Equality on the keys with the window as a condition; Spark broadcasts the dimension while it is small.
    """
    right = without_overlaps(versions, keys.values())
    right = right.select(*(F.col(c).alias(f"__d_{c}") for c in right.columns))
    on = (F.col("__d_valid_from_ts_us") <= F.col(ts)) & (F.col(ts) < F.col("__d_valid_until_ts_us"))
    for own, other in keys.items():
        on = on & (F.col(own) == F.col(f"__d_{other}"))
    return left.join(right, on, "left")


def pit_coverage(events: DataFrame, dim: DataFrame, symbol: str = "symbol", ts: str = "ts_event_us") -> DataFrame:
    """Adds ``symbol_id`` of the version valid at each row's time, and a reason where there is none.

    Of several such versions the one with the earliest start counts; rows are neither lost nor repeated.
    """
    versions = dim.select("exchange", "exchange_symbol", "symbol_id", "valid_from_ts_us", "valid_until_ts_us")
    joined = _valid_at(events.drop("symbol_id"), versions, {"exchange": "exchange", symbol: "exchange_symbol"}, ts)
    found = F.col("__d_symbol_id")
    reason = F.when(found.isNull(), F.lit(MISSING))
    if REASON in events.columns:
        reason = F.coalesce(F.col(REASON), reason)
    return joined.withColumn("symbol_id", found).withColumn(REASON, reason).drop(*(f"__d_{c}" for c in versions.columns))


def join_symbol_meta(df: DataFrame, dim: DataFrame, columns: Iterable[str], ts: str = "ts_event_us") -> DataFrame:
    """Adds columns of the version with the row's (exchange, symbol_id) valid at its time; null without one.

    Of several such versions the one with the earliest start counts; rows are neither lost nor repeated.
    """
    columns = list(columns)
    blocked = {"exchange", "symbol_id", "valid_from_ts_us", "valid_until_ts_us"} & set(columns)
    if blocked or (clash := set(columns) & set(df.columns)):
        raise ValueError(f"cannot add columns {sorted(blocked or clash)}")
    if unknown := set(columns) - set(dim.columns):
        raise ValueError(f"the dimension has no columns {sorted(unknown)}")
    versions = dim.select("exchange", "symbol_id", "valid_from_ts_us", "valid_until_ts_us", F.struct(*columns).alias("m"))
    joined = _valid_at(df, versions, {"exchange": "exchange", "symbol_id": "symbol_id"}, ts)
    return joined.select(*(F.col(f"`{c}`") for c in df.columns), *(F.col("__d_m")[c].alias(c) for c in columns))


# Listing feeds

#: Exchanges of the feed, price tick, and share lots (STAR market and others).
FEED_EXCHANGES = {"SSE": "sse", "SZSE": "szse"}
TICK = SCALE // 100
LOT, STAR_LOT, STAR_MARKET = 100 * SCALE, 200 * SCALE, "科创板"


def _midnight(column: str) -> Column:
    """yyyyMMdd as microseconds of its UTC midnight; null where it is no date."""
    return F.unix_micros(F.try_to_timestamp(F.col(column).cast("string"), F.lit("yyyyMMdd")))


def _feed_exchange() -> Column:
    pairs = [F.lit(x) for kv in FEED_EXCHANGES.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), F.upper(F.trim(F.col("exchange").cast("string"))))


def from_listing(raw: DataFrame, effective_ts_us: int) -> DataFrame:
    """Full history from a listing feed: listed and paused rows are current, delisted ones end at their date."""
    gone = F.col("list_status") == "D"
    rows = raw.where(F.col("list_status").isin("L", "P", "D")).withColumn("exchange", _feed_exchange()).where("exchange is not null")
    return with_ids(
        rows.select(
            "exchange",
            F.col("symbol").alias("exchange_symbol"),
            F.col("ts_code").alias("canonical_symbol"),
            F.col("market").alias("market_type"),
            F.coalesce("name", "symbol").alias("base_asset"),
            F.lit("CNY").alias("quote_asset"),
            F.lit(TICK).cast("long").alias("tick_size"),
            F.when(F.col("market") == STAR_MARKET, STAR_LOT).otherwise(LOT).cast("long").alias("lot_size"),
            F.lit(None).cast("long").alias("contract_size"),
            _midnight("list_date").alias("valid_from_ts_us"),
            F.when(gone, _midnight("delist_date")).otherwise(F.lit(OPEN_END)).alias("valid_until_ts_us"),
            (~gone).alias("is_current"),
            F.lit(effective_ts_us).cast("long").alias("updated_at_ts_us"),
        )
    )


def delistings(raw: DataFrame) -> DataFrame:
    """(exchange, exchange_symbol, delisted_at_ts_us) of delisted rows with a date."""
    rows = raw.where("list_status = 'D'").withColumn("exchange", _feed_exchange())
    out = rows.select("exchange", F.col("symbol").alias("exchange_symbol"), _midnight("delist_date").alias("delisted_at_ts_us"))
    return out.where("exchange is not null and delisted_at_ts_us is not null")


def market_type_of(symbol: Column) -> Column:
    """perpetual, option, future or unknown, by the patterns of derivative symbols."""
    name = F.upper(F.trim(symbol))
    day = r"([0-9]{1,2}[A-Z]{3}[0-9]{2}|[0-9]{6,8})"
    return (
        F.when(name.rlike(r"(^|[-_])PERPETUAL$"), "perpetual")
        .when(name.rlike(rf"^[A-Z0-9_]+-{day}-[0-9]+-(C|P)$"), "option")
        .when(name.rlike(rf"^[A-Z0-9_]+-{day}$"), "future")
        .otherwise("unknown")
    )


def from_events(events: DataFrame, effective_ts_us: int) -> DataFrame:
    """A dimension of the (exchange, symbol) pairs that events have, current from before the data on."""
    pairs = events.select(F.lower(F.trim("exchange")).alias("exchange"), F.trim("symbol").alias("exchange_symbol")).distinct()
    none = {c: F.lit(None).cast("string") for c in ("base_asset", "quote_asset")}
    none |= {c: F.lit(None).cast("long") for c in ("tick_size", "lot_size", "contract_size")}
    snapshot = pairs.withColumns(
        {"canonical_symbol": F.col("exchange_symbol"), "market_type": market_type_of(F.col("exchange_symbol"))} | none
    )
    return bootstrap(snapshot, effective_ts_us)


def dim_summary(dim: DataFrame, exchange: str | None = None) -> DataFrame:
    rows = dim if exchange is None else dim.where(F.lower("exchange") == exchange.strip().lower())
    return rows.groupBy("exchange").agg(
        F.count("*").alias("n_rows"),
        F.sum(F.col("is_current").cast("long")).alias("n_current"),
        F.countDistinct("exchange_symbol").alias("n_symbols"),
    )


def dim_market_summary(dim: DataFrame) -> DataFrame:
    """(dimension, name, n): rows by exchange and by market type."""
    pairs = F.array(
        F.struct(F.lit("exchange").alias("dimension"), F.col("exchange").alias("name")),
        F.struct(F.lit("market_type").alias("dimension"), F.col("market_type").alias("name")),
    )
    return dim.select(F.inline(pairs)).groupBy("dimension", "name").agg(F.count("*").alias("n"))
