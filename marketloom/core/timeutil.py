"""Time bounds in microseconds, and the time zones of exchanges."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Exchanges and the zones of their trading dates.
ZONES = {
    "binance": "UTC",
    "binance-futures": "UTC",
    "binance-coin-futures": "UTC",
    "binance-us": "UTC",
    "coinbase": "UTC",
    "coinbase-pro": "UTC",
    "kraken": "UTC",
    "okx": "UTC",
    "okx-futures": "UTC",
    "huobi": "UTC",
    "gate": "UTC",
    "bitfinex": "UTC",
    "bitstamp": "UTC",
    "gemini": "UTC",
    "crypto-com": "UTC",
    "kucoin": "UTC",
    "deribit": "UTC",
    "bybit": "UTC",
    "bitmex": "UTC",
    "ftx": "UTC",
    "dydx": "UTC",
    "sse": "Asia/Shanghai",
    "szse": "Asia/Shanghai",
}
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def zone(exchange: str) -> str:
    """The zone of an exchange; an unknown one is an error."""
    try:
        return ZONES[exchange.strip().lower()]
    except KeyError:
        raise ValueError(f"unknown exchange {exchange!r}; there are {sorted(ZONES)}") from None


def zone_column(exchange: Column) -> Column:
    """The zone of a column of exchanges; null where unknown."""
    pairs = [F.lit(x) for kv in ZONES.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), F.lower(F.trim(exchange)))


def micros(value: int | str | date | datetime) -> int:
    """Microseconds since the epoch; naive times are UTC.  Exact: no floats on the way."""
    if isinstance(value, bool):
        raise TypeError("a bool is not a time")
    if isinstance(value, int):
        return value
    if isinstance(value, str):
        value = datetime.fromisoformat(value.strip().replace("Z", "+00:00"))
    elif not isinstance(value, datetime):
        value = datetime(value.year, value.month, value.day)
    if value.tzinfo is None:
        value = value.replace(tzinfo=timezone.utc)
    return (value - EPOCH) // timedelta(microseconds=1)


def bounds(start, end) -> tuple[int, int]:
    a, b = micros(start), micros(end)
    if b <= a:
        raise ValueError(f"end {end!r} must be after start {start!r}")
    return a, b


def date_bounds(start_us: int, end_us: int, exchange: str) -> tuple[date, date]:
    """First and last local date of [start, end)."""
    z = ZoneInfo(zone(exchange))
    return tuple((EPOCH + timedelta(microseconds=t)).astimezone(z).date() for t in (start_us, end_us - 1))


def timestamp(us: Column) -> Column:
    return F.timestamp_micros(us)


def trading_date(us: Column, exchange: Column) -> Column:
    """Exchange-local date; null where the exchange is unknown.  The session must run in UTC."""
    return F.to_date(F.from_utc_timestamp(F.timestamp_micros(us), zone_column(exchange)))
