"""Trading phases of the sse and szse exchanges, from the local minute of the day."""

from __future__ import annotations

from collections.abc import Iterable
from enum import Enum

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Phase(str, Enum):
    PRE_OPEN = "PRE_OPEN"
    MORNING = "MORNING"
    NOON_BREAK = "NOON_BREAK"
    AFTERNOON = "AFTERNOON"
    CLOSING = "CLOSING"
    AFTER_HOURS = "AFTER_HOURS"
    CLOSED = "CLOSED"


#: Local start and end (exclusive) of the phases that every day has.
HOURS = (
    (Phase.PRE_OPEN, "09:15", "09:25"),
    (Phase.MORNING, "09:30", "11:30"),
    (Phase.NOON_BREAK, "11:30", "13:00"),
    (Phase.AFTERNOON, "13:00", "14:57"),
    (Phase.CLOSING, "14:57", "15:00"),
    (Phase.AFTER_HOURS, "15:05", "15:30"),
)
#: Markets that trade after hours.
AFTER_HOURS_MARKETS = ("star_board", "growth_board", "star", "chinext")


def trading_phase(ts_us: Column, exchange: Column, market_type: Column | None = None) -> Column:
    """Name of the phase.  CLOSING is szse's alone, AFTER_HOURS that of some markets; null for other exchanges."""
    local = F.from_utc_timestamp(F.timestamp_micros(ts_us), "Asia/Shanghai")
    minute = F.hour(local) * 60 + F.minute(local)
    market = F.lower(F.trim(F.lit(None).cast("string") if market_type is None else market_type))
    where = F.lower(F.trim(exchange))
    out = None
    for phase, start, end in HOURS:
        a, b = (int(t[:2]) * 60 + int(t[3:]) for t in (start, end))
        inside = (minute >= a) & (minute < b)
        if phase is Phase.CLOSING:
            inside &= where == "szse"
        if phase is Phase.AFTER_HOURS:
            inside &= F.coalesce(market.isin(*AFTER_HOURS_MARKETS), F.lit(False))
        out = F.when(inside, phase.value) if out is None else out.when(inside, phase.value)
    return F.when(where.isin("sse", "szse"), out.otherwise(Phase.CLOSED.value))


def add_trading_phase(
    df: DataFrame, ts: str = "ts_event_us", exchange: str | Column = "exchange", market_type: str | Column | None = None, output: str = "trading_phase"
) -> DataFrame:
    """Adds the phase; ``exchange`` and ``market_type`` are columns, or ``F.lit`` of one value."""
    column = lambda x: F.col(x) if isinstance(x, str) else x
    return df.withColumn(output, trading_phase(F.col(ts), column(exchange), None if market_type is None else column(market_type)))


def filter_by_phase(df: DataFrame, phases: Iterable[Phase | str], keep: str | None = None, **where) -> DataFrame:
    """Rows in one of the phases (members or names in any case); ``keep`` names the phase's column to keep."""
    names = [p.value if isinstance(p, Phase) else str(p).strip().upper() for p in phases]
    if not names:
        raise ValueError("at least one phase is needed")
    if bad := [n for n in names if n not in Phase.__members__]:
        raise ValueError(f"unknown phases {bad}")
    name = keep or "__phase"
    rows = add_trading_phase(df, output=name, **where).where(F.col(name).isin(*names))
    return rows if keep else rows.drop(name)
